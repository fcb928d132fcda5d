"""How filters overlap: what each order of applying them removes, step by step, by min-plus products of small matrices."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import WORD, small_batches, written

#: Stands for "never" in the tropical (min, +) matrices.
NEVER = 1 << 20
#: Filters at most: a part has a count for each of their 2**n masks, and n! orders.
MOST_FILTERS = 8


def failures(text: Column) -> dict[str, Column]:
    """The conditions of filters A to D on a text without nulls; E (repeats) needs the whole table."""
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    n = F.size(words)
    return {
        "A": n < 200,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < 50 * n.cast("long"),
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long") > 2 * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def masked_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (bit k: fails the k-th filter of ABCDE), good, toxic and n: documents that are alike in all of these.

    A repeat (E) is a row whose text a smaller doc_id has. Of each text only the smallest doc_id is kept aside and looked
    up by (text, doc_id), which no hot text shares; two 64-bit hashes stand for the text. Rows with a null doc_id are
    smaller than nothing and repeat nothing; rows that repeat as a whole are equally small.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    bits = [F.when(failed, 1 << k).otherwise(0) for k, failed in enumerate(failures(text).values())]
    mask = sum(bits[1:], bits[0])
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source"), F.lit("")).alias("part"),
        F.xxhash64(text).alias("h1"),
        F.xxhash64(F.lit(1), text).alias("h2"),
        mask.cast("int").alias("mask"),
    )
    # Written, so that texts are parsed once for both of what follows.
    rows = written(rows.groupBy("h1", "h2", "doc_id", "part", "mask").agg(F.count("*").alias("n")), "audit-masks")
    first = rows.filter("doc_id is not null").groupBy("h1", "h2").agg(F.min("doc_id").alias("doc_id")).withColumn("_first", F.lit(True))
    known = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    both = rows.join(first, ["h1", "h2", "doc_id"], "left").join(known, "doc_id", "left")
    repeat = F.when(F.col("doc_id").isNotNull() & F.col("_first").isNull(), 1 << len(bits)).otherwise(0)
    flags = [F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")]
    return both.select("part", (F.col("mask") + repeat).alias("mask"), *flags, "n").groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def removal_steps(filters: int) -> tuple[np.ndarray, np.ndarray]:
    """Orders (a row of filter numbers each) and, for each mask and order, the step that removes: 1 to filters, or NEVER.

    The mask matrix has 0 where a mask fails a filter and NEVER elsewhere; the position matrix has the step of each
    filter in each order, the inverse of its permutation. Their (min, +) product is the first failed filter's step.
    """
    orders = np.array(list(itertools.permutations(range(filters))), dtype=np.int64).reshape(-1, filters)
    positions = np.argsort(orders, axis=1).T + 1  # filter by order
    masks = np.arange(1 << filters)
    fails = np.where(masks[:, None] >> np.arange(filters) & 1, 0, NEVER)  # mask by filter
    return orders, np.minimum((fails[:, :, None] + positions[None]).min(axis=1), NEVER)


def _matrices(names: str) -> tuple[list[str], np.ndarray, dict[str, np.ndarray]]:
    """What a part's counts of masks are multiplied with: 0/1 matrices of masks by (order, step), and the filters' numbers."""
    k = len(names)
    orders, removed_at = removal_steps(k)
    steps = np.arange(1, k + 1)
    fails = (np.arange(1 << k)[:, None] >> np.arange(k) & 1).astype(bool)
    at = removed_at[:, :, None]
    here = at == steps
    own = fails[:, orders]  # mask, order, step: fails the filter of that step
    flat = {"kept": at > steps, "removed": here, "redundant": own & (at < steps)}
    alone = fails & (fails.sum(axis=1) == 1)[:, None]
    flat = {name: m.reshape(1 << k, -1).astype(np.int64) for name, m in flat.items()}
    return ["".join(names[f] for f in o) for o in orders], orders.ravel(), flat | {"alone": alone.astype(np.int64)}


def audit(counts: DataFrame, names: str = "ABCDE") -> DataFrame:
    """The rows of all orders and steps of every part, from counts (part, mask, n and further weights good and toxic).

    counts: long columns n, n_good and n_toxic for each part and mask; a part has 2**filters masks at most, so they fit
    one array. Parts are multiplied in batches by the same matrices, whatever their number; sums are exact integers.
    """
    k = len(names)
    if k > MOST_FILTERS:
        raise ValueError(f"{k} filters have too many orders; {MOST_FILTERS} at most")
    weights = ("n", "n_good", "n_toxic")
    wide = counts.groupBy("part").agg(F.collect_list(F.struct("mask", *weights)).alias("masks"))  # 2**k at most
    lists, orders, steps = math.factorial(k), None, np.arange(1, k + 1)
    out = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, order, m = _matrices(names)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                entries = some.column("masks").flatten()
                row = np.repeat(np.arange(some.num_rows), np.asarray(some.column("masks").value_lengths()))
                w = {c: np.zeros((some.num_rows, 1 << k), np.int64) for c in weights}
                mask = entries.field("mask").to_numpy()
                for c in weights:  # scatter
                    np.add.at(w[c], (row, mask), entries.field(c).to_numpy())
                removed = w["n"] @ m["removed"]
                shapley = np.zeros((some.num_rows, k), np.int64)
                for f in range(k):
                    shapley[:, f] = removed[:, order == f].sum(axis=1)
                columns = [w["n"] @ m["kept"], removed, w["n"] @ m["redundant"], (w["n"] @ m["alone"])[:, order], w["n_good"] @ m["removed"], w["n_toxic"] @ m["removed"], shapley[:, order]]
                part = some.column("part").take(pa.array(np.repeat(np.arange(some.num_rows), lists * k)))
                order_text = pa.array(np.tile(np.repeat(np.array(texts, object), k), some.num_rows), pa.string())
                step = pa.array(np.tile(steps, lists * some.num_rows).astype(np.int32))
                yield pa.RecordBatch.from_arrays([part, order_text, step, *[pa.array(c.ravel()) for c in columns]], names=[x.split()[0] for x in out.split(", ")])

    return wide.mapInArrow(rows, out)


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Applies five filters in all 120 orders to the documents of each part and counts what every step does.

    docs: doc_id, text and source; labels: doc_id, quality and toxic. Conditions of failure: A: fewer than 200 words;
    B: less than half of the words distinct; C: over 2 % of the code points are A-Z; D: holds one of #$%&*|; E: the text
    is that of a smaller doc_id in the whole table. Words are runs without ASCII white space.

    A null text is an empty one (it fails A, and E after a smaller doc_id's empty or null text); a null source is the
    part of empty strings; a null doc_id is no repeat and has no label. Rows that repeat are documents of their own, and
    of equal doc_ids none is smaller. Of several labels of a document any 1 counts. Further columns are ignored; an empty
    table gives no rows. Texts of any length are read whole: a text and its list of words have to fit a task's memory.

    Documents are reduced to counts by (part, mask of failed filters, labels) before anything is multiplied; only text
    hashes and doc_ids are shuffled. Returns part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost and shapley, 600 rows for each part.
    """
    small_batches(docs.sparkSession)
    found = masked_documents(docs, labels)
    counts = found.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("n_good"), F.sum(F.col("n") * F.col("toxic")).alias("n_toxic"))
    return audit(counts)


def shapley_share(steps: DataFrame, filters: Mapping[str, str] | None = None) -> DataFrame:
    """A report from audit(): for each part and filter, its share of all removals (mean over orders) and its overlap.

    filters: names for the letters. overlap is the share of its failures that another filter removes first, over all
    orders; null for a filter that nothing fails.
    """
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    n = steps.groupBy("part", letter.alias("filter")).agg(F.sum("removed").alias("removed"), F.sum("redundant").alias("redundant"), F.count("*").alias("orders"), F.first("unique_fails").alias("unique_fails"))
    name = F.col("filter") if filters is None else F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in filters.items() for x in kv]), F.col("filter")), F.col("filter"))
    return n.select("part", name.alias("filter"), (F.col("removed") / F.col("orders")).alias("removed_mean"), "unique_fails", (F.col("redundant") / F.nullif(F.col("removed") + F.col("redundant"), F.lit(0))).alias("overlap"))
