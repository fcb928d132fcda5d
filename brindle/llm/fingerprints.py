"""Document fingerprints by context-triggered piecewise hashing, compared by edit distance."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm.common import small_batches, written

WINDOW = 7
LEAST_BLOCK = 3
LENGTH = 64
COMMON = 4
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def rolling(data: np.ndarray) -> np.ndarray:
    """For each place, a 32-bit hash of the seven bytes that end there (bytes before the start count as 0)."""
    padded = np.concatenate([np.zeros(WINDOW - 1, np.uint32), data.astype(np.uint32)])
    n = len(data)
    out = np.zeros(n, np.uint32)
    for k in range(WINDOW):
        out = out * np.uint32(0x01000193) + padded[k : k + n]
    out ^= out >> np.uint32(15)
    out *= np.uint32(0x85EBCA6B)
    out ^= out >> np.uint32(13)
    return out


def _signature(data: bytes, ends: np.ndarray) -> str:
    """A letter for each chunk; what lies beyond the 63rd boundary is one chunk."""
    cuts = [0, *(ends[: LENGTH - 1] + 1).tolist(), len(data)]
    return "".join(LETTERS[zlib.crc32(data[a:b]) & 63] for a, b in zip(cuts, cuts[1:], strict=False) if b > a)


def fingerprint(data: bytes) -> str:
    """block:signature:signature at twice the block; the block is the least 3 * 2**k that gives about 64 chunks at most.

    A boundary follows every byte at which the rolling hash is -1 modulo the block, so an edit changes only the
    letters of the chunks around it. Only the length decides the block, so texts whose lengths differ by less than
    four times have blocks that can be compared. Empty data has the fingerprint '3::'.
    """
    block = LEAST_BLOCK
    while block * LENGTH < len(data):
        block *= 2
    hashes = rolling(np.frombuffer(data, np.uint8))
    ends = np.flatnonzero(hashes % np.uint32(block) == block - 1)
    double = ends[hashes[ends] % np.uint32(2 * block) == 2 * block - 1]
    return f"{block}:{_signature(data, ends)}:{_signature(data, double)}"


def edit_distance(a: str, b: str) -> int:
    """Least number of letters to insert and delete (a changed letter is both), by bit-parallel alignment."""
    places: dict[str, int] = {}
    for i, letter in enumerate(a):
        places[letter] = places.get(letter, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for letter in b:
        met = row & places.get(letter, 0)
        row = (row + met | row - met) & full
    common = len(a) - row.bit_count()
    return len(a) + len(b) - 2 * common


def _alike(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    run = max(1, min(COMMON, len(a) // 2, len(b) // 2))
    grams = {a[i : i + run] for i in range(len(a) - run + 1)}
    if not any(b[i : i + run] in grams for i in range(len(b) - run + 1)):
        return 0.0  # without a common run of letters, what matches does so by chance
    return 1.0 - edit_distance(a, b) / (len(a) + len(b))


def likeness(one: str, two: str) -> float:
    """0 to 1: one minus edit distance over total length, at the best pair of signatures of the same block.

    Equal fingerprints have 1. Blocks must be equal or one twice the other; others have 0, and so have signatures
    without a common run of four letters (of half the letters of a shorter one).
    """
    if one == two:
        return 1.0
    (a, a1, a2), (b, b1, b2) = one.split(":"), two.split(":")
    pairs = {(a, b): [(a1, b1), (a2, b2)], (str(2 * int(a)), b): [(a2, b1)], (a, str(2 * int(b))): [(a1, b2)]}
    found = [p for at, ps in pairs.items() if at[0] == at[1] for p in ps]
    return max((_alike(x, y) for x, y in found), default=0.0)


def edited(text: str, following: str) -> str:
    """text with its last half (rounded down) replaced by as many first code points of the next text, or all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


COLUMNS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _row(doc_id: int | None, text: str, own: str, following: str, next_print: str) -> tuple:
    changed = edited(text, following).encode("utf-8", "surrogatepass")
    print_ = fingerprint(changed)
    return doc_id, len(text), hashlib.sha256(changed).hexdigest(), own, print_, likeness(own, print_), likeness(own, next_print)


def _print(text: str) -> str:
    return fingerprint(text.encode("utf-8", "surrogatepass"))


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range in order: each is finished as its successor comes; the first and the last leave their texts."""
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    kinds = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), *((n, pa.string()) for n in names[2:5]), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("place", pa.int32()), ("text", pa.string())])
    before = None
    started = False
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            text = text or ""
            own = _print(text) if before is None or text != before[1] else before[2]
            if not started:
                rows.append((doc_id, None, None, own, None, None, None, 1, text))
                started = True
            if before is not None:
                rows.append((*_row(*before, text, own), 0, None))
            before = (doc_id, text, own)
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(kinds)], schema=kinds)
    if before is not None:
        doc_id, text, own = before
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((doc_id, None, None, own, None, None, None, 2, text), kinds, strict=True)], schema=kinds)


def fingerprint_documents(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Fingerprints of every text of docs (doc_id, text) and of its edited text, and how like they and the next one's are.

    The next document is that with the next smaller doc_id; the first follows the last. Null texts are empty. Null
    ids come after all others and equal ids stand in the order of their texts' hashes. A single document is its own
    successor; an empty table gives an empty result. Texts are dealt once, by ranges of doc_id; what a range lacks is
    the first text of the next one, and only these texts (two for each range) are kept for a second step.
    """
    spark = docs.sparkSession
    small_batches(spark, 256)
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("_tie", F.xxhash64("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("_tie")]
    dealt = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    made = written(dealt.select("doc_id", "text").mapInArrow(_along, COLUMNS + ", place int, text string").withColumn("range", F.spark_partition_id()), "fingerprints")
    done = made.filter("place = 0").drop("place", "text", "range")
    # Two rows for each range that has any: its first and its last document.
    ends = made.filter("place > 0").groupBy("range").agg(*[F.max(F.when(F.col("place") == k, F.struct("doc_id", "text", "fingerprint"))).alias(n) for k, n in ((1, "first"), (2, "last"))])
    by_range = Window.orderBy("range")
    following = F.coalesce(F.lead("first").over(by_range), F.first("first").over(by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = [_row(None if pd.isna(i) else int(i), t, p, ft, fp) for i, t, p, ft, fp in batch[["id", "t", "p", "ft", "fp"]].itertuples(index=False)]
            yield pd.DataFrame(done, columns=[c.split()[0] for c in COLUMNS.split(", ")]).astype({"doc_id": "Int64"})

    pairs = ends.select(F.col("last.doc_id").alias("id"), F.col("last.text").alias("t"), F.col("last.fingerprint").alias("p"), following.alias("next"))
    last = pairs.select("id", "t", "p", F.col("next.text").alias("ft"), F.col("next.fingerprint").alias("fp")).mapInPandas(finish, COLUMNS)
    return done.unionByName(last)
