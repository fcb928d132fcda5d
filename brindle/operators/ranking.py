"""Ordering, numbering, keep-first and keep-best, limits and set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Order = Sequence[Column]


def number_from(df: DataFrame, by: Sequence[str], order: Order, start: int = 1, name: str = "number") -> DataFrame:
    """Numbers the rows of each group from start on."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)) + (start - 1))


def _first(df: DataFrame, by: Sequence[str], order: Order, n: int = 1) -> DataFrame:
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("_rank") <= n).drop("_rank")


def keep_first(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """The first row of each key in the given order."""
    return _first(df, keys, order)


def keep_best(df: DataFrame, key: str, score: str, tie: str) -> DataFrame:
    """The row of each key with the best score; of equals the one that came first."""
    return _first(df, [key], [F.desc(score), F.asc(tie)])


def rank_decay(df: DataFrame, by: Sequence[str], order: Order, base: float = 100.0, step: float = 1.1, name: str = "rank_score") -> DataFrame:
    """Base less step for every place after the first."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1
    return df.withColumn(name, F.lit(base) - place * F.lit(step))


def keep_first_group(df: DataFrame, group: Column, order: Order) -> DataFrame:
    """The first row of each value of an expression; apply it after all gates."""
    return _first(df.withColumn("_group", group), ["_group"], order).drop("_group")


def ordered(df: DataFrame, *order: Column) -> DataFrame:
    """L1."""
    return df.orderBy(*order)


def page(df: DataFrame, order: Order, limit: int = 500, offset: int = 0) -> DataFrame:
    """L2: rows offset to offset + limit in a total order; a limit of 0 is the default of 500."""
    return df.orderBy(*order).offset(offset).limit(limit or 500)


def page_after(df: DataFrame, order: Sequence[tuple[str, bool]], after: Sequence[object] | None, limit: int = 500) -> DataFrame:
    """L2: the rows that follow the last row of the page before, in the order of columns (name, descending).

    after: that row's values of the order's columns (None for the first page). They become a condition that the scan can
    use, so a deep page sorts what is behind it only to its limit, and never what is before it. Nulls are smallest. The
    order must be total, else equal rows are left out.
    """
    if after is not None:
        beyond, same = F.lit(False), F.lit(True)
        for (name, down), value in zip(order, after, strict=True):
            c = F.col(name)
            if value is None:
                further = F.lit(False) if down else c.isNotNull()
            else:
                further = (c < F.lit(value)) | c.isNull() if down else c > F.lit(value)
            beyond, same = beyond | (same & further), same & c.eqNullSafe(F.lit(value))
        df = df.filter(beyond)
    return df.orderBy(*[F.desc(name) if down else F.asc(name) for name, down in order]).limit(limit)


def recent(df: DataFrame, ts: str, tie: str, n: int) -> DataFrame:
    """L4: the last n rows by time."""
    return df.orderBy(F.desc(ts), F.desc(tie)).limit(n)


def category_order(df: DataFrame, priority: Sequence[str], category: str, title: str, tie: str) -> DataFrame:
    """Listed categories first in their order, then by title without regard to case."""
    place = reduce(lambda w, kv: w.when(F.col(category) == kv[1], kv[0]), enumerate(priority), F.when(F.lit(False), -1)).otherwise(len(priority))
    return df.orderBy(place, F.lower(title), tie)


def top_scored(df: DataFrame, by: Sequence[str], score: str, tie: str, n: int = 12) -> DataFrame:
    """The n best rows of each group (of all rows, if there are no group columns)."""
    order = [F.desc(score), F.asc(tie)]
    return _first(df, by, order, n) if by else df.orderBy(*order).limit(n)


def cap_per_group(df: DataFrame, by: Sequence[str], order: Order, cap: int) -> DataFrame:
    """At most cap rows of each group, before an expensive step."""
    return _first(df, by, order, cap)


def sample_first(df: DataFrame, order: str, n: int = 3) -> DataFrame:
    """The first n rows."""
    return df.orderBy(order).limit(n)


def union_candidates(*dfs: DataFrame) -> DataFrame:
    """All rows, columns by name; missing ones are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def distinct_last(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key wins."""
    return _first(df, [key], [F.desc(order)])


def distinct_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key wins."""
    return _first(df, [key], [F.asc(order)])


def unvisited(frontier: DataFrame, visited: DataFrame, key: str) -> DataFrame:
    """Distinct rows of the frontier that are not among the visited."""
    return frontier.join(visited.select(key), key, "left_anti").dropDuplicates([key])


def split_by_presence(groups: DataFrame, results: DataFrame, key: str, target: int) -> DataFrame:
    """Groups with their number of results: 'complete' from target on, 'partial', or 'missing'."""
    n = results.groupBy(key).agg(F.count("*").alias("n_results"))
    out = groups.join(n, key, "left").withColumn("n_results", F.coalesce("n_results", F.lit(0)))
    return out.withColumn("state", F.when(F.col("n_results") >= target, "complete").when(F.col("n_results") > 0, "partial").otherwise("missing"))


def minmax_norm(df: DataFrame, col: str, by: Sequence[str], name: str = "norm", epsilon: float = 1e-9) -> DataFrame:
    """A column scaled to 0 to 1 in each group; the ends of a group are added up before they are joined."""
    ends = df.groupBy(*[F.col(c).alias(f"_by{k}") for k, c in enumerate(by)]).agg(F.min(col).alias("_low"), F.max(col).alias("_high"))
    on = [F.col(c).eqNullSafe(F.col(f"_by{k}")) for k, c in enumerate(by)]
    both = df.join(ends, on) if by else df.crossJoin(F.broadcast(ends))  # one row
    return both.withColumn(name, (F.col(col) - F.col("_low")) / (F.col("_high") - F.col("_low") + epsilon)).select(*df.columns, name)


def gate_counts(df: DataFrame, by: str, target: int) -> DataFrame:
    """V3: for each group its count and whether it is exactly the target."""
    return df.groupBy(by).agg(F.count("*").alias("n")).withColumn("exact", F.col("n") == target)


def selection_summary(selected: DataFrame, groups: DataFrame, key: str, target: int) -> DataFrame:
    """One row: groups complete (with the target), with any row, and all rows selected."""
    n = split_by_presence(groups, selected, key, target)
    return n.agg(
        F.sum(F.when(F.col("n_results") >= target, 1).otherwise(0)).cast("long").alias("completed"),
        F.sum(F.when(F.col("n_results") > 0, 1).otherwise(0)).cast("long").alias("any_selected"),
        F.sum("n_results").cast("long").alias("selected"),
    )


def entropy(df: DataFrame, by: Sequence[str], value: Column) -> DataFrame:
    """Shannon entropy in bits of the values of each group."""
    n = df.groupBy(*by, value.alias("_v")).agg(F.count("*").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy(*by))
    return n.withColumn("p", share).groupBy(*by).agg((-F.sum(F.col("p") * F.log2("p"))).alias("entropy"))


def moments(df: DataFrame, by: Sequence[str], col: str, above: float) -> DataFrame:
    """Mean, population deviation and share of values above a limit."""
    return df.groupBy(*by).agg(F.avg(col).alias("mean"), F.stddev_pop(col).alias("std"), F.avg((F.col(col) > above).cast("double")).alias("share_above"))
