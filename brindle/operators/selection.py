"""Near-duplicate suppression and diverse selection over candidate vectors."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.functions.similarity import PRESETS, dot, hamming, l2_normalize, median_signature, mixed_distance, ordinal_signature
from brindle.operators.tables import dropped, saved

#: Rows of a block; pairs of blocks are compared in one task each.
BLOCK = 2048
#: Picks after which the distances of a pool are written anew.
REFRESH = 8
#: Bits that a band must have to be worth a row of its own: narrower bands share their value with too many others.
BAND_BITS = 5


def with_features(items: DataFrame, vector: str = "embedding", bits: int = 64, seed: int = 7) -> DataFrame:
    """Adds unit (vector of length one) and sig, its signature.

    64 bits are one number, the median signature; more are an array of numbers from comparisons of components.
    """
    sig = median_signature(F.col(vector)) if bits == 64 else ordinal_signature(F.col(vector), bits, seed)
    return items.withColumn("unit", l2_normalize(F.col(vector))).withColumn("sig", sig)


def _words(items: DataFrame) -> Column:
    """The signature as an array of 64-bit numbers; null if any is."""
    words = F.col("sig") if items.schema["sig"].dataType.typeName() == "array" else F.array("sig")
    return F.when(~F.exists(words, lambda w: w.isNull()), words)


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _bits_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of each row of a and each row of b (words of signatures)."""
    apart = np.zeros((len(a), len(b)), np.int32)
    for k in range(a.shape[1]):
        apart += np.bitwise_count(a[:, k][:, None] ^ b[:, k][None, :])
    return apart


def _two_blocks(group: pa.Table, accept) -> tuple[np.ndarray, ...]:
    """Pairs (lower row, higher row, bits apart, ...) of the rows of two blocks, or of one with itself, that accept() takes."""
    i, j = group.column("_i")[0].as_py(), group.column("_j")[0].as_py()
    block = group.column("_block").to_numpy()
    sig = _matrix(group.column("sig"), len(block)).view(np.uint64)
    one, two = np.flatnonzero(block == i), np.flatnonzero(block == j)
    found = []
    for at in range(0, len(one), 512):
        rows = one[at : at + 512]
        apart = _bits_apart(sig[rows], sig[two])
        ok, *more = accept(rows, two, apart)
        if i == j:
            ok &= rows[:, None] < two[None, :]
        x, y = np.nonzero(ok)
        found.append((np.minimum(rows[x], two[y]), np.maximum(rows[x], two[y]), apart[x, y], *[m[x, y] for m in more]))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else ()


def _alike(rules: Sequence[tuple[int, float]]):
    """Compares the rows of one pair of blocks by matrix products; only pairs that meet a rule are given."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("_key")
        keys, unit = group.column("_key"), _matrix(group.column("unit"), group.num_rows)

        def accept(rows: np.ndarray, two: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            cosine = unit[rows] @ unit[two].T
            return reduce(np.logical_or, [(apart <= t) & (cosine >= c) for t, c in rules]), cosine

        a, b, apart, cosine = _two_blocks(group, accept) or (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.int32), np.zeros(0))
        return pa.table({"a": keys.take(pa.array(a)), "b": keys.take(pa.array(b)), "apart": apart, "cosine": np.round(cosine, 6)})

    return run


def _near_in_band(most: int, edges: Sequence[int]):
    """Compares the signatures of rows with one value of a band; a pair is given by the first band that it shares only."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("_key")
        keys, band = group.column("_key"), group.column("_band")[0].as_py()
        sig = _matrix(group.column("sig"), group.num_rows).view(np.uint64)
        a, b, apart = _two_blocks(group, lambda rows, two, apart: (apart <= most,)) or (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.int32),)
        own = np.ones(len(a), bool)
        differs = sig[a] ^ sig[b]
        for lo, hi in zip(edges[:band], edges[1 : band + 1], strict=True):
            same = np.ones(len(a), bool)
            for k in range(lo // 64, (hi - 1) // 64 + 1):
                low, high = max(lo, 64 * k) - 64 * k, min(hi, 64 * k + 64) - 64 * k
                same &= (differs[:, k] & np.uint64((1 << high) - (1 << low))) == 0
            own &= ~same
        return pa.table({"a": keys.take(pa.array(a[own])), "b": keys.take(pa.array(b[own])), "apart": apart[own]})

    return run


def band_edges(bits: int, most: int) -> list[int] | None:
    """Bounds of most + 1 bands of a signature, or None where they would be too narrow to tell rows apart.

    Signatures that differ in `most` bits at most are alike in one of most + 1 bands at least (pigeonhole).
    """
    bands = most + 1
    return [k * bits // bands for k in range(bands + 1)] if bits // bands >= BAND_BITS else None


def _band(sig: Column, lo: int, hi: int) -> Column:
    """Bits lo to hi of a signature, an array of 64-bit numbers; 64 bits at most."""
    word, at = divmod(lo, 64)
    value = F.shiftrightunsigned(F.get(sig, word), at)
    if at + hi - lo > 64:
        value = value.bitwiseOR(F.shiftleft(F.get(sig, word + 1), 64 - at))
    return value if hi - lo == 64 else value.bitwiseAND((1 << (hi - lo)) - 1)


def _dealt(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of a group dealt to blocks of BLOCK, each sent to all pairs of blocks (_i, _j) that it is in."""
    counts = rows.groupBy(*by).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_blocks"))
    dealt = rows.join(counts, list(by)).withColumn("_block", F.pmod(F.xxhash64("_key"), F.col("_blocks")).cast("int"))
    sent = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return sent.withColumns({"_i": F.least("_block", "_other"), "_j": F.greatest("_block", "_other")}).drop("_other", "_blocks")


def near_dup_pairs(items: DataFrame, key: str, by: Sequence[str], rules: Sequence[tuple[int, float]], bits: int = 64, banded: bool | None = None) -> DataFrame:
    """Pairs (a, b) of one group that meet any rule of (greatest Hamming distance, least cosine).

    items: key, group columns, unit and sig (a 64-bit number, or an array of them for longer signatures of `bits` bits).
    With limits that bands can serve, each signature is sent once for each of limit + 1 bands, and only rows with one
    value of a band are compared; vectors are looked up for pairs within the limit only, to check the cosine. Wider
    limits leave no equality to join by: then all rows of a group are compared. banded=True or False forces a way; both
    give the same pairs. Either way what has to be compared is dealt to blocks and each pair of blocks is a task of its
    own, so a group or a band's value with a third of all rows is spread over many tasks, and rows are made only for
    pairs that pass. Rows without a key, group, vector or signature are in no pair, nor are vectors of different lengths.
    """
    most = max(t for t, _ in rules)
    edges = band_edges(bits, most) if banded is not False else None
    if banded and edges is None:
        raise ValueError(f"{bits} bits have no {most + 1} bands of {BAND_BITS} bits")
    kind = items.schema[key].dataType.simpleString()
    size = F.size("unit").alias("_size")
    rows = items.select(F.col(key).alias("_key"), *by, "unit", _words(items).alias("sig"), size).filter(reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in ("_key", *by, "unit", "sig")]))
    if edges is None:
        return _dealt(rows, [*by, "_size"]).groupBy(*by, "_size", "_i", "_j").applyInArrow(_alike(rules), f"a {kind}, b {kind}, apart int, cosine double")
    sent = rows.select("_key", *by, "_size", "sig", F.posexplode(F.array(*[_band(F.col("sig"), lo, hi) for lo, hi in zip(edges, edges[1:], strict=False)])).alias("_band", "_value"))
    cells = [*by, "_size", "_band", "_value"]
    near = _dealt(sent, cells).groupBy(*cells, "_i", "_j").applyInArrow(_near_in_band(most, edges), f"a {kind}, b {kind}, apart int")
    vector = rows.select("_key", "unit")
    both = near.join(vector.select(F.col("_key").alias("a"), F.col("unit").alias("_u")), "a").join(vector.select(F.col("_key").alias("b"), F.col("unit").alias("_v")), "b")
    both = both.withColumn("_c", dot(F.col("_u"), F.col("_v")))
    ok = reduce(lambda x, y: x | y, [(F.col("apart") <= t) & (F.col("_c") >= c) for t, c in rules])
    return both.filter(ok).select("a", "b", "apart", F.round("_c", 6).alias("cosine"))


def suppress_near_dups(items: DataFrame, key: str, by: Sequence[str], rank: str, rules: Sequence[tuple[int, float]], bits: int = 64) -> DataFrame:
    """Items kept by going through each group from the best rank on and dropping what is like a kept one.

    rank: ascending and without ties in a group. Round by round, items without an undecided better neighbour are kept
    and their neighbours dropped, until all are decided: the result of the one-by-one loop. There are as many rounds as
    the longest chain of ever better neighbours has items; tables of a round are dropped when the next one is written.
    """
    items = saved(items, "near-items")  # vectors and signatures are computed once
    pairs = near_dup_pairs(items, key, by, rules, bits).select("a", "b")
    ranks = items.select(key, F.col(rank).alias("_r"))
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    ra, rb = ranks.select(F.col(key).alias("a"), F.col("_r").alias("ra")), ranks.select(F.col(key).alias("b"), F.col("_r").alias("rb"))
    edges = saved(both.join(ra, "a").join(rb, "b").filter("ra < rb").select("a", "b"), "near-edges")  # better to worse
    all_lost = None
    while not edges.isEmpty():  # each round decides the best undecided item of every group at least
        winners = edges.select("a").distinct().join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_anti")
        lost = saved(edges.join(winners, "a", "left_semi").select(F.col("b").alias(key)).distinct(), "near-lost")
        all_lost = lost if all_lost is None else all_lost.unionByName(lost)
        gone = lost.select(F.col(key).alias("x"))
        # What was dropped drops nothing itself; what was kept has done its work.
        rest = edges.join(winners, "a", "left_anti").join(gone, edges["a"] == gone["x"], "left_anti")
        rest = saved(rest.join(gone, rest["b"] == gone["x"], "left_anti").select("a", "b"), "near-edges")
        dropped(edges)
        edges = rest
    return items if all_lost is None else items.join(all_lost, key, "left_anti")


def diverse_topk(items: DataFrame, key: str, by: str, score: str, k: int, preset: str = "site", bits: int = 64, favoured: Column | None = None) -> DataFrame:
    """K items of each group, the best first and then those farthest from the chosen, weighed with quality.

    items: key, group, score, unit and sig. In each round all groups advance: the best of each group is picked by an
    aggregate; ties go to the smaller key. Groups with fewer items give them all. The pool is written once and again
    after every REFRESH picks, with each item's least distance to what is chosen; in between, a round reads it with the
    few picks since then (a row for each group). bits: length of the signatures. favoured: rows whose worth gets the
    preset's bonus from the second pick on.
    """
    p = PRESETS[preset]
    ends = items.groupBy(F.col(by).alias("_by")).agg(F.min(score).alias("_low"), F.max(score).alias("_high"))  # added up before the shuffle
    pool = items.withColumns({"sig": _words(items), "_bonus": F.when(F.lit(False) if favoured is None else favoured, p.bonus).otherwise(0.0)}).join(ends, F.col(by).eqNullSafe(F.col("_by")))
    pool = pool.withColumn("_q", (F.col(score) - F.col("_low")) / (F.col("_high") - F.col("_low") + 1e-9)).withColumn("_d", F.lit(1e9))
    pool = saved(pool.select(key, by, score, "unit", "sig", "_q", "_d", "_bonus"), "diverse")
    chosen: list[DataFrame] = []
    fresh: list[DataFrame] = []
    for i in range(k):
        now = pool
        if fresh:
            picks = reduce(DataFrame.unionByName, fresh).groupBy(F.col(by).alias("_by")).agg(F.collect_list("best").alias("_picks"))  # REFRESH a group at most

            def distance(b: Column) -> Column:
                return mixed_distance(dot(F.col("unit"), b["u"]), hamming(F.col("sig"), b["s"]), *p.distance, bits)

            now = pool.join(picks, F.col(by).eqNullSafe(F.col("_by"))).filter(~F.exists("_picks", lambda b: b["k"] == F.col(key)))
            now = now.withColumn("_d", F.least("_d", F.array_min(F.transform("_picks", distance)))).select(*pool.columns)
        if len(fresh) >= REFRESH:
            before, pool, fresh = pool, saved(now, "diverse"), []
            dropped(before)
            now = pool
        worth = F.col("_q") if i == 0 else F.col("_d") * p.pick[0] + F.col("_q") * p.pick[1] + F.col("_bonus")
        best = now.groupBy(by).agg(F.max_by(F.struct(F.col(key).alias("k"), F.col("unit").alias("u"), F.col("sig").alias("s"), F.col(score).alias("v")), F.struct(worth, -F.col(key))).alias("best"))
        best = saved(best, "diverse-pick")
        if best.isEmpty():
            break
        fresh.append(best)
        chosen.append(best.select(by, F.col("best.k").alias(key), F.col("best.v").alias(score), F.lit(i + 1).alias("place")))
    return reduce(DataFrame.unionByName, chosen) if chosen else items.select(by, key, score).withColumn("place", F.lit(1)).limit(0)
