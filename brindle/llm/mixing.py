"""Mixes sources to target weights by capped water-filling and seeded repetitions of whole documents."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm.common import WORD, written


@dataclass(frozen=True)
class Target:
    """What one source gives to the mix."""

    source: str | None
    weight: float
    size: int
    target: float


def words(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def water_fill(sizes: Sequence[int], weights: Sequence[float], budget: float, epochs: float) -> list[float]:
    """Shares of budget by weight, none above epochs times its size; what is over goes to the others by weight.

    Each round clamps every source whose share is above its limit and shares the rest anew, until none is. A budget
    above all limits together fills every limit. Empty sources get nothing.
    """
    limits = [epochs * s for s in sizes]
    targets = [0.0] * len(limits)
    still = [i for i, limit in enumerate(limits) if limit > 0]
    left = min(float(budget), float(sum(limits)))
    while still:
        per_weight = left / sum(weights[i] for i in still)
        over = [i for i in still if per_weight * weights[i] >= limits[i]]
        for i in over:
            targets[i] = float(limits[i])
        if not over:
            for i in still:
                targets[i] = per_weight * weights[i]
            break
        left = max(0.0, left - sum(limits[i] for i in over))
        still = [i for i in still if i not in set(over)]
    return targets


def plan_targets(sized: DataFrame, weights: Sequence[float], share: float, epochs: float, max_sources: int = 100_000) -> list[Target]:
    """The target of each source, in the order of their code points, null last; weights repeat along this order.

    Only a row for each source comes to the driver, max_sources at most: more raise an error.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("size")).limit(max_sources + 1).collect()
    if len(sums) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    sums = sorted(sums, key=lambda r: (r["source"] is None, r["source"] or ""))
    own = [float(weights[i % len(weights)]) for i in range(len(sums))]
    sizes = [int(r["size"] or 0) for r in sums]
    targets = water_fill(sizes, own, share * sum(sizes), epochs)
    return [Target(r["source"], w, s, t) for r, w, s, t in zip(sums, own, sizes, targets, strict=True)]


def _order(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("size"))


def _cuts(sized: DataFrame, wanted: DataFrame, seed: int, bits: int) -> DataFrame:
    """For each source, the document at which its extra words are met: its order, and how many words it gives.

    Sums by the first bits of the seeded order find the bucket of the cut; only that bucket's rows are then added one by one.
    """
    placed = sized.withColumn("order", _order(seed)).withColumn("bucket", F.shiftright("order", 64 - bits))
    own = F.coalesce("source", F.lit("")), F.col("source").isNull()
    placed = placed.withColumn("s", own[0]).withColumn("z", own[1])
    wanted = F.broadcast(wanted.filter("extra > 0").select(F.coalesce("source", F.lit("")).alias("s"), F.col("source").isNull().alias("z"), "extra"))  # a row a source
    running = Window.partitionBy("s", "z").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = placed.groupBy("s", "z", "bucket").agg(F.sum("size").alias("size")).withColumn("upto", F.sum("size").over(running.orderBy("bucket")))
    edge = sums.join(wanted, ["s", "z"]).filter("upto - size < extra and upto >= extra").select("s", "z", "bucket", (F.col("extra") - F.col("upto") + F.col("size")).alias("need"))
    rows = placed.join(F.broadcast(edge), ["s", "z", "bucket"]).groupBy("s", "z", "order", "doc_id", "size", "need").agg(F.count("*").alias("copies"))
    rows = rows.withColumn("upto", F.sum(F.col("size") * F.col("copies")).over(running.orderBy("order", "doc_id", "size")))
    cut = rows.filter((F.col("upto") - F.col("size") * F.col("copies") < F.col("need")) & (F.col("upto") >= F.col("need")))
    part = F.col("need") - F.col("upto") + F.col("size") * F.col("copies")
    return cut.select(F.when(~F.col("z"), F.col("s")).alias("source"), "order", "doc_id", "size", F.floor(part / F.col("copies")).cast("long").alias("part"))


@dataclass(frozen=True)
class Mix:
    """The plan of a mix: a row for each source, whatever the number of documents."""

    rows: list[tuple]
    seed: int

    def apply(self, docs: DataFrame) -> DataFrame:
        """docs with source_size, target, taken and repeats added; needs doc_id, source and size."""
        kinds = "_of string, source_size long, target double, _whole int, _extra long, _order long, _id long, _size long, _part long"
        plan = F.broadcast(docs.sparkSession.createDataFrame(self.rows, kinds))  # a row for each source
        here = F.struct(_order(self.seed), F.coalesce("doc_id", F.lit(-(2**63))), "size")
        cut = F.struct("_order", "_id", "_size")
        more = F.when(F.col("_order").isNull(), 0).when(here < cut, F.col("size")).when(here == cut, F.col("_part")).otherwise(0)
        out = docs.join(plan, F.col("source").eqNullSafe(F.col("_of")), "left")
        out = out.withColumn("taken", (F.col("_whole") * F.col("size") + more).cast("long"))
        out = out.withColumn("repeats", F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0).cast("int"))
        return out.drop("_of", "_whole", "_extra", "_order", "_id", "_size", "_part")


def plan_mix(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    epochs: float = 2.0,
    seed: int = 17,
    bits: int = 12,
) -> tuple[Mix, DataFrame]:
    """The plan for docs (doc_id, text, source), and their sizes as a written table.

    Each source's target comes from water_fill. A rate of target / size gives every document floor(rate) whole
    repetitions; one more goes to documents in the order of a seeded hash until the source's target is met, and the
    document at which it is met gives only the words that lack, so a source's taken words differ from its target by
    less than one. Rows alike in doc_id and size at that place share these words alike (less than one each is lost).
    Nothing is drawn anew: reruns agree. Null texts have no words, and documents without words give none; a null
    source is a source of its own; no rows give an empty plan.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words(F.col("text")).alias("size"))
    sized = written(narrow, "mix-sizes")
    rows = []
    for t in plan_targets(sized, weights, share, epochs):
        whole = min(int(t.target // t.size), int(epochs)) if t.size else 0
        rows.append((t.source, t.size, t.target, whole, int(round(t.target)) - whole * t.size))
    wanted = docs.sparkSession.createDataFrame(rows, "source string, source_size long, target double, whole int, extra long")
    cuts = {r["source"]: (r["order"], r["doc_id"] if r["doc_id"] is not None else -(2**63), r["size"], r["part"]) for r in _cuts(sized, wanted, seed, bits).collect()}  # one a source
    return Mix([(*r, *cuts.get(r[0], (None,) * 4)) for r in rows], seed), sized


def mix(docs: DataFrame, **parameters) -> DataFrame:
    """How many words of every row of docs the mix takes: doc_id, source, size, source_size, target, taken, repeats."""
    plan, sized = plan_mix(docs, **parameters)
    return plan.apply(sized).select("doc_id", "source", "size", "source_size", "target", "taken", "repeats")


def mixed_documents(docs: DataFrame, **parameters) -> DataFrame:
    """The mix itself: a row for each whole repetition, and one with the first words for a part of one.

    Has the columns of docs (doc_id, text, lang, source, n_chars); n_chars is that of the text given.
    """
    plan, _ = plan_mix(docs, **parameters)
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("_row")
    taken = plan.apply(docs.select(row, F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words(F.col("text")).alias("size")))
    rest = F.col("taken") - F.col("repeats") * F.col("size")
    parts = F.concat(F.array_repeat(F.lit(0).cast("int"), F.col("repeats")), F.when(rest > 0, F.array(rest.cast("int"))).otherwise(F.array().cast("array<int>")))
    rows = taken.withColumn("_words", F.explode(parts))
    first = F.array_join(F.slice(F.regexp_extract_all(F.col("_row.text"), F.lit("[\\x20\\x09-\\x0D]*" + WORD), F.lit(0)), F.lit(1), F.col("_words")), "")
    text = F.when(F.col("_words") > 0, first).otherwise(F.col("_row.text"))
    own = {"text": text, "n_chars": F.length(text).cast("long")}
    return rows.select(*[own.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])
