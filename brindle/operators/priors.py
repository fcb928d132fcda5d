"""Market priors from procurement history, and table profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions.numbers import norm_bonus, to_double_strict
from brindle.functions.text import class_division, clean_ws, is_nullish, squeeze_ws

# Names by which each role may go, in order of preference.
ROLES = {
    "country": ("country", "country_code", "buyer_country"),
    "cpv": ("cpv", "cpv_code", "main_cpv", "classification_id"),
    "buyer": ("buyer_name", "buyer", "contracting_authority"),
    "record_id": ("record_id", "source_record_id", "notice_id", "id"),
    "value": ("value", "award_value", "estimated_value"),
    "currency": ("currency", "award_currency"),
    "evidence": ("evidence_grain", "evidence_lane", "grain"),
    "source": ("source", "lane", "source_name", "portal"),
}
REQUIRED = ("country", "cpv", "buyer", "record_id")
# Sources whose records come from awards.
AWARD_SOURCES = ("USA", "USA_FEDERAL", "USASPENDING", "AU_AUSTENDER_AWARD_FIRST", "AUSTRALIA_AWARD_FIRST")


class MissingRolesError(ValueError):
    """Some required role has no column."""


def resolve_roles(df: DataFrame, roles: Mapping[str, Sequence[str]] = ROLES, required: Sequence[str] = REQUIRED) -> DataFrame:
    """The first column present for each role, without regard to case, under the role's name; only metadata is looked at."""
    present = {c.lower(): c for c in reversed(df.columns)}
    found = {role: next((present[n.lower()] for n in names if n.lower() in present), None) for role, names in roles.items()}
    missing = [r for r in required if not found.get(r)]
    if missing:
        raise MissingRolesError(f"no column for {missing}; columns are {sorted(df.columns)}")
    return df.select(*[F.col(f"`{c}`").alias(role) for role, c in found.items() if c])


def exclude_award_first(df: DataFrame) -> DataFrame:
    """P10: without award-first evidence and award sources, as far as these columns exist."""
    if "evidence" in df.columns:
        low = F.lower(F.coalesce(F.col("evidence").cast("string"), F.lit("")))
        df = df.filter(~low.like("%award-first%") & ~low.like("%award_first%"))
    if "source" in df.columns:
        df = df.filter(~F.upper(F.coalesce(F.col("source").cast("string"), F.lit(""))).isin(*AWARD_SOURCES))
    return df


def normalised(df: DataFrame) -> DataFrame:
    """Keys of the priors: country, division, buyer_key and record_id as clean text."""
    return df.withColumns({
        "country": F.upper(F.trim(F.col("country").cast("string"))),
        "division": class_division(F.col("cpv").cast("string")),
        "buyer_key": F.lower(squeeze_ws(F.trim(F.col("buyer").cast("string")))),
        "record_id": F.col("record_id").cast("string"),
    })


def country_class_prior(df: DataFrame, least: int = 20) -> DataFrame:
    """Records, buyers and records per buyer of each country and division with enough records.

    Two distinct counts: Spark expands the rows, de-duplicates them before the shuffle and sums in a second step.
    """
    rows = df.filter((F.col("country") != "") & F.col("division").rlike("^[0-9]{2}$") & (F.col("buyer_key") != ""))
    n = rows.groupBy("country", "division").agg(F.countDistinct("record_id").alias("sample_size"), F.countDistinct("buyer_key").alias("unique_buyers"), F.count("*").alias("n_rows"))
    n = n.filter(F.col("sample_size") >= least)
    return n.withColumn("per_buyer", F.col("n_rows") / F.greatest("unique_buyers", F.lit(1))).drop("n_rows")


def buyer_prior(df: DataFrame, least: int = 8) -> DataFrame:
    """Records and divisions of each country and buyer with enough records; no division counts as one."""
    rows = df.filter((F.col("country") != "") & (F.col("buyer_key") != ""))
    return rows.groupBy("country", "buyer_key").agg(F.countDistinct("record_id").alias("sample_size"), F.countDistinct("division").alias("cpv_diversity")).filter(F.col("sample_size") >= least)


def value_stats(df: DataFrame, least: int = 10, accuracy: int | None = None) -> DataFrame:
    """Number, median and upper quartile of values above 1 by country, division and currency.

    Without value and currency columns there are no rows. accuracy: approximate percentiles, for large groups.
    """
    if not {"value", "currency"} <= set(df.columns):
        return df.sparkSession.createDataFrame([], "country string, division string, currency string, n long, median double, p75 double")
    value = to_double_strict(F.col("value").cast("string"))
    rows = df.filter((F.col("country") != "") & F.col("division").rlike("^[0-9]{2}$")).withColumn("_v", F.when((value > 1) & ~F.isnan(value), value)).withColumn("currency", F.upper(F.trim(F.col("currency").cast("string"))))
    pick = (lambda q: F.percentile("_v", F.lit(q))) if accuracy is None else (lambda q: F.percentile_approx("_v", q, accuracy).cast("double"))
    n = rows.groupBy("country", "division", "currency").agg(F.count("_v").alias("n"), pick(0.5).alias("median"), pick(0.75).alias("p75"))
    return n.filter(F.col("n") >= least)


def rank_select(df: DataFrame, col: str, low: float = 0.25, high: float = 0.75, default: float = 1.0, ranges: int = 256) -> DataFrame:
    """One row with two order statistics picked by place: sorted[n*low - 1] and sorted[n*high], within the ends.

    Values are counted first. The distinct values are cut into ranges at approximate quantiles (one row of bounds), the
    ranges' counts are added up to offsets, and places are counted inside each range, so the result is exact whatever
    the bounds and no task sees more than a range. No rows give the default.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).cast("double").alias("v")).agg(F.count("*").alias("n"))
    bounds = counts.agg(F.percentile_approx("v", [k / ranges for k in range(1, ranges)], 100 * ranges).alias("bounds"))
    ranged = counts.crossJoin(F.broadcast(bounds))  # one row
    ranged = ranged.select("v", "n", F.size(F.filter("bounds", lambda b: b < F.col("v"))).alias("_range"))
    sums = ranged.groupBy("_range").agg(F.sum("n").alias("_n"))  # a row for each range
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    offsets = sums.select("_range", before.alias("_before"))
    inside = F.sum("n").over(Window.partitionBy("_range").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    upto = ranged.withColumn("_in", inside).join(F.broadcast(offsets), "_range").select("v", (F.col("_before") + F.col("_in")).alias("upto"))
    total = counts.agg(F.sum("n").alias("total"))
    at_low = F.greatest(F.lit(0), F.floor(F.col("total") * low) - 1)
    at_high = F.least(F.col("total") - 1, F.floor(F.col("total") * high))
    joined = upto.crossJoin(F.broadcast(total))  # one row
    picked = joined.agg(F.min(F.when(F.col("upto") > at_low, F.col("v"))).alias("lo"), F.min(F.when(F.col("upto") > at_high, F.col("v"))).alias("hi"))
    return picked.select(F.coalesce("lo", F.lit(default)).alias("lo"), F.coalesce("hi", F.lit(default)).alias("hi"))


def with_bonus(prior: DataFrame, col: str, span: int, default: float = 1.0) -> DataFrame:
    """Adds priority_bonus, the place of a column between its quartiles; their one row is broadcast."""
    quartiles = F.broadcast(rank_select(prior, col, default=default))
    return prior.crossJoin(quartiles).withColumn("priority_bonus", norm_bonus(F.col(col).cast("double"), F.col("lo"), F.col("hi"), span)).drop("lo", "hi")


def priors_qa(cells: DataFrame, buyers: DataFrame, values: DataFrame) -> DataFrame:
    """A10: how many cells each table has."""
    parts = [d.agg(F.count("*").alias(n)) for d, n in ((cells, "country_class_cells"), (buyers, "buyer_cells"), (values, "value_cells"))]
    return parts[0].crossJoin(parts[1]).crossJoin(parts[2])  # one row each


def profile_table(df: DataFrame, max_cols: int = 40, cap: int = 1000, approximate: bool = False, order: Column | None = None, sample_cols: int = 25, samples: int = 3) -> DataFrame:
    """For each of the first columns: rows, values that say nothing, and distinct trimmed values up to a cap.

    Equal values of a column are counted before they are shuffled. With an order (a file position) the first values of
    the first sample_cols columns are added, which come from `samples` rows.
    """
    names = df.columns[:max_cols]

    def long(rows: DataFrame, names: Sequence[str]) -> DataFrame:
        texts = rows.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(f"c{i}") for i, c in enumerate(names)])
        pair = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("value")) for i, c in enumerate(names)])).alias("p")
        return texts.select(pair).select("p.*").withColumn("value", clean_ws(F.col("value")))

    counts = long(df, names).groupBy("column", "value").agg(F.count("*").alias("n"))
    distinct = F.approx_count_distinct(F.nullif("value", F.lit(""))) if approximate else F.sum((F.col("value") != "").cast("long"))
    nullish = F.sum(F.when(is_nullish(F.col("value")), F.col("n")).otherwise(0))
    out = counts.groupBy("column").agg(F.sum("n").alias("n_rows"), nullish.alias("n_nullish"), distinct.alias("n_distinct"))
    out = out.withColumn("n_distinct", F.least("n_distinct", F.lit(cap).cast("long")))
    if order is None:
        return out
    first = df.withColumn("_at", order).orderBy("_at").limit(samples)  # so many rows in all
    some = long(first.drop("_at"), df.columns[:sample_cols]).groupBy("column").agg(F.collect_list("value").alias("samples"))
    return out.join(some, "column", "left")


def profile_summary(files: DataFrame, file_col: str = "file") -> DataFrame:
    """Number of files and of rows."""
    return files.agg(F.countDistinct(file_col).alias("files"), F.count("*").alias("n_rows"))


def check_constraints(df: DataFrame, keys: Sequence[str] = (), not_null: Sequence[str] = (), foreign: Sequence[tuple[str, DataFrame, str]] = ()) -> DataFrame:
    """V1: violations by rule: surplus rows of a unique key, nulls, and references to nothing."""
    spark = df.sparkSession
    out = spark.createDataFrame([], "rule string, violations long")
    if keys:
        extra = df.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("violations"))
        out = out.union(extra.select(F.lit("unique " + ",".join(keys)), "violations"))
    for c in not_null:
        out = out.union(df.agg(F.coalesce(F.sum(F.col(c).isNull().cast("long")), F.lit(0).cast("long")).alias("v")).select(F.lit(f"not null {c}"), "v"))
    for c, parent, key in foreign:
        lost = df.filter(F.col(c).isNotNull()).join(parent.select(F.col(key).alias(c)), c, "left_anti")
        out = out.union(lost.agg(F.count("*").alias("v")).select(F.lit(f"foreign {c}"), "v"))
    return out


