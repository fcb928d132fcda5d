"""Long repeated strings of all texts, removed byte by byte: suffix arrays by two-stage sorting, in parts that share anchors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import discard, scratch_path, small_batches, written
from brindle.llm.words import _LETTER, _power_tables, mixed

#: Bytes that a task's suffix array covers, about; window starts that are hashed at a time.
SORTED_BYTES, CHUNK = 4 << 20, 1 << 19
#: Different segments of one anchor that are sorted in one task; more are dealt to blocks.
HOT = 8192
_LOW = np.uint64((1 << 20) - 1)


def _sliding_minimum(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w values in a row."""
    n = len(v) - w + 1
    whole = np.full(-(-len(v) // w) * w, np.iinfo(v.dtype).max, v.dtype)
    whole[: len(v)] = v
    ahead = np.minimum.accumulate(whole.reshape(-1, w), axis=1).ravel()
    back = np.minimum.accumulate(whole.reshape(-1, w)[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1 : w - 1 + n])


def anchors(data: np.ndarray, offsets: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, ...]:
    """Segments of the texts data[offsets[k]:offsets[k + 1]]: (text number, first start, starts, key, digest) of each.

    Each window of `span` bytes is owned by its anchor, the string of `gram` bytes in it with the smallest hash (of
    equals the first). A segment is a run of windows with one anchor: its window starts, and the bytes of these windows.
    Equal windows have equal anchors, so they are in segments of one key; equal segments have one digest.
    """
    found: list[tuple[np.ndarray, ...]] = []
    w, last = span - gram + 1, int(offsets[-1])
    for a in range(int(offsets[0]), last - span + 1, CHUNK):
        part = data[a : min(a + CHUNK + span - 1, last)]
        n = len(part) - span + 1
        up, down = _power_tables(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_LETTER[part] * up[: len(part)], out=sums[1:])
        grams = mixed((sums[gram:] - sums[:-gram]) * down[: len(part) - gram + 1])
        owner = (_sliding_minimum(grams & ~_LOW | np.arange(len(grams), dtype=np.uint64), w) & _LOW).astype(np.int64)
        # Windows that reach into the next text are no windows.
        for end in offsets[np.searchsorted(offsets, a, "right") : np.searchsorted(offsets, a + len(part), "left") + 1] - a:
            owner[max(0, end - span + 1) : max(0, end)] = -1
        edges = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1], [True])))
        first, count = edges[:-1], np.diff(edges)
        real = owner[first] >= 0
        first, count = first[real], count[real]
        ends = first + count + span - 1
        digest = mixed((sums[ends] - sums[first]) * down[first] + (ends - first).astype(np.uint64))
        text = np.searchsorted(offsets, a + first, "right") - 1
        found.append((text, a + first - offsets[text], count, grams[owner[first]].view(np.int64), digest.view(np.int64)))
    empty = np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else (empty,) * 5


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow column without nulls."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    values = column.buffers()[2]
    return (np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)), offsets


class TwoStage:
    """A suffix array over segments, sorted as far as `depth` bytes.

    data holds the segments one after the other; the suffixes that are asked for are the first wanted[k] of segment k.
    Suffixes end with their segment, and an end is smaller than any byte.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray, depth: int) -> None:
        self.n, self.depth = int(offsets[-1]), depth
        self.starts, self.ends = offsets[:-1], offsets[1:]
        self.data, place = data, np.arange(self.n)
        end_of = np.repeat(self.ends, np.diff(offsets))
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        self.words = np.zeros(self.n, np.uint64)
        for j in range(8):
            self.words = self.words << np.uint64(8) | padded[j : j + self.n]
        over = np.maximum(0, place + 8 - end_of).astype(np.uint64)
        self.words &= np.uint64(0xFFFFFFFFFFFFFFFF) << np.uint64(8) * over
        self.end_of = end_of
        # Whether a suffix is smaller than its successor: equal bytes are as the next that differ.
        sign = np.zeros(self.n, np.int8)
        sign[:-1] = np.sign(data[1:].astype(np.int16) - data[:-1])
        sign[self.ends - 1] = -1
        differs = np.minimum.accumulate(np.where(sign != 0, place, self.n)[::-1])[::-1]
        self.smaller = sign[differs] > 0
        # A larger suffix is induced from its successor, so the wanted ones need what follows up to a smaller one.
        nearest = np.minimum.accumulate(np.where(self.smaller, place, self.n)[::-1])[::-1]
        stop = np.minimum(nearest[self.starts + wanted - 1], self.ends - 1)
        inside = np.zeros(self.n + 1, np.int64)
        inside[self.starts] += 1
        np.subtract.at(inside, stop + 1, 1)
        self.needed = np.cumsum(inside[:-1]) > 0
        self.wanted = place < np.repeat(self.starts + wanted, np.diff(offsets))

    def _direct(self) -> np.ndarray:
        """The needed suffixes that are smaller than their successors, sorted eight bytes at a time."""
        at = np.flatnonzero(self.smaller & self.needed)
        key = self.words[at]
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        group = np.zeros(len(at), np.int64)  # the place of the first suffix that is alike so far
        fresh = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(at) else at
        group[fresh] = fresh
        group = np.maximum.accumulate(group)
        tied = np.arange(len(at))
        deepest = -(-self.depth // 8) * 8
        for depth in range(8, deepest + 8, 8):
            # Only suffixes in groups of two and more go on.
            more = np.bincount(group[tied], minlength=len(at)) > 1
            tied = tied[more[group[tied]]]
            if not len(tied):
                break
            p, g = at[tied] + depth, group[tied]
            end = self.end_of[at[tied]]
            key = np.where(p < end, self.words[np.minimum(p, self.n - 1)], np.uint64(0))
            if depth == deepest:  # what is alike so far ends sooner or later
                key = (end - at[tied]).astype(np.uint64)
            changed = np.zeros(len(at), bool)
            changed[g[1:][(g[1:] == g[:-1]) & (key[1:] != key[:-1])]] = True
            sort = changed[g]
            if not sort.any():
                continue
            rows, g, key = tied[sort], g[sort], key[sort]
            order = np.lexsort((key, g))
            at[rows] = at[rows[order]]
            key = key[order]
            new = np.concatenate(([True], (g[1:] != g[:-1]) | (key[1:] != key[:-1])))
            group[rows] = np.maximum.accumulate(np.where(new, rows, 0))
        return at

    def order(self) -> np.ndarray:
        """Starts of the wanted suffixes in order: bucket by bucket, larger suffixes are induced from their successors."""
        direct = self._direct()
        firsts = self.data[direct]
        larger = self.needed & ~self.smaller
        before = np.zeros(self.n, bool)  # whether the suffix one byte longer is induced from this one
        before[1:] = larger[:-1]
        before[self.starts] = False
        buckets: list[list[np.ndarray]] = [[] for _ in range(256)]

        def deal(suffixes: np.ndarray) -> None:
            byte = self.data[suffixes]
            order = np.argsort(byte, kind="stable")
            suffixes, byte = suffixes[order], byte[order]
            cuts = np.flatnonzero(byte[1:] != byte[:-1]) + 1
            for part in np.split(suffixes, cuts):
                if len(part):
                    buckets[self.data[part[0]]].append(part)

        last = self.ends - 1
        deal(last[larger[last]])  # induced from the empty suffixes
        out = []
        for c in range(256):
            wave = np.concatenate(buckets[c]) if buckets[c] else np.zeros(0, np.int64)
            waves = [wave]
            while len(wave):  # runs of one byte: each suffix from the one behind it
                wave = wave[before[wave]] - 1
                wave = wave[self.data[wave] == c]
                waves.append(wave)
            both = np.concatenate([*waves, direct[np.searchsorted(firsts, c) : np.searchsorted(firsts, c, "right")]])
            out.append(both)
            ahead = both[before[both]] - 1
            deal(ahead[self.data[ahead] > c])
        whole = np.concatenate(out)
        return whole[self.wanted[whole]]

    def common_prefixes(self, order: np.ndarray) -> np.ndarray:
        """Bytes that each suffix of the order shares with the one before it, `depth` at most; 0 for the first."""
        common = np.zeros(len(order), np.int64)
        alike = np.arange(1, len(order))
        for depth in range(0, self.depth, 8):
            a, b = order[alike] + depth, order[alike - 1] + depth
            inside = (a < self.end_of[order[alike]]) & (b < self.end_of[order[alike - 1]])
            alike, a, b = alike[inside], a[inside], b[inside]
            apart = self.words[a] ^ self.words[b]
            room = np.minimum(self.end_of[order[alike]] - a, self.end_of[order[alike - 1]] - b)
            high = np.zeros(len(apart), np.int64)  # equal bytes at the head of the word
            for k in range(1, 9):
                high += (apart >> np.uint64(64 - 8 * k)) == 0
            common[alike] += np.minimum(high, room)
            alike = alike[(apart == 0) & (room >= 8)]
        return np.minimum(common, self.depth)


def _window_digests(words: np.ndarray, starts: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of the `span` bytes at each start."""
    one, two = np.full(len(starts), 1, np.uint64), np.full(len(starts), 2, np.uint64)
    for k in range(0, span, 8):
        word = words[starts + k]
        if k + 8 > span:
            word = word >> np.uint64(8 * (k + 8 - span))
        one, two = mixed(one ^ word), mixed(two * np.uint64(0x9E3779B97F4A7C15) + word)
    return one.view(np.int64), two.view(np.int64)


FOUND = "key long, seg long, start int, stop int, w1 long, w2 long"


def _repeats(span: int):
    """Of one task's segments (key, seg, n, blocks, bytes): the window starts that occur elsewhere."""

    def run(group: pa.Table) -> pa.Table:
        data, offsets = _binary(group.column("bytes").combine_chunks())
        data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
        key, seg, n, blocks = (group.column(c).to_numpy() for c in ("key", "seg", "n", "blocks"))
        sorter = TwoStage(data, offsets, np.diff(offsets) - span + 1, span)
        order = sorter.order()
        common = sorter.common_prefixes(order)
        of = np.repeat(np.arange(len(key)), np.diff(offsets))
        twice = np.concatenate((common >= span, [False]))
        again = np.zeros(sorter.n + 1, bool)
        again[order] = twice[:-1] | twice[1:] | (n[of[order]] > 1)
        edges = np.diff(again.astype(np.int8), prepend=np.int8(0))
        start, stop = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        own = of[start]
        none = lambda k, kind=pa.int64(): pa.nulls(k, kind)
        parts = [[key[own], seg[own], start - offsets[own], stop - offsets[own], none(len(own)), none(len(own))]]
        # Of an anchor that is dealt to several blocks, one start of each different window goes on, to be held against
        # the other blocks'; windows that are known already only have to be there.
        heads = order[~twice[:-1]]
        heads = heads[blocks[of[heads]] > 1]
        if len(heads):
            w1, w2 = _window_digests(sorter.words, heads, span)
            open_, k = ~again[heads], of[heads]
            nulled = lambda x, kind=pa.int64(): pa.array(x, kind, mask=~open_)
            parts.append([key[k], nulled(seg[k]), nulled((heads - offsets[k]).astype(np.int32), pa.int32()), none(len(heads), pa.int32()), w1, w2])
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        names = [x.split()[0] for x in FOUND.split(", ")]
        return pa.concat_tables([pa.table([c.cast(t) if isinstance(c, pa.Array) else pa.array(c).cast(t) for c, t in zip(p, kinds, strict=True)], names=names) for p in parts])

    return run


def _anchor_rows(span: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, first, count, key, seg = anchors(*_binary(batch.column("text")), span, gram)
            rid = batch.column("rid").to_numpy()[text]
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(seg), pa.array(rid), pa.array(first << 16 | count)], names=["key", "seg", "rid", "at"])

    return run


def _segment_rows(span: int):
    """Rows of the segments (field `segments` of a text) with their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _binary(batch.column("text"))
            lists = batch.column("segments")
            s, row = lists.flatten(), np.repeat(np.arange(batch.num_rows), np.asarray(lists.value_lengths()))
            at = s.field("at").to_numpy()
            first, size = offsets[row] + (at >> 16), (at & 0xFFFF) + span - 1
            for a in range(0, len(at), 4096):
                whole = [data[f : f + k].tobytes() for f, k in zip(first[a : a + 4096], size[a : a + 4096], strict=True)]
                some = s.slice(a, 4096)
                yield pa.RecordBatch.from_arrays([*[some.field(c) for c in ("bucket", "block", "blocks", "key", "seg", "n")], pa.array(whole, pa.binary())], names=["bucket", "block", "blocks", "key", "seg", "n", "bytes"])

    return run


def removed_spans(starts: np.ndarray, stops: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes that are covered by windows with starts in start:stop."""
    order = np.argsort(starts, kind="stable")
    lo, hi = starts[order], np.maximum.accumulate(stops[order] + span - 1) if len(starts) else stops
    new = np.concatenate(([True], lo[1:] > hi[:-1])) if len(lo) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return lo[at], hi[np.concatenate((at[1:], [len(lo)])) - 1] if len(at) else hi


def _kept_rows(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _binary(batch.column("text"))
            lists = batch.column("windows")
            edges = np.concatenate(([0], np.cumsum(np.asarray(lists.value_lengths().fill_null(0)))))
            w = lists.flatten()
            start, stop = w.field("start").to_numpy(), w.field("stop").to_numpy()
            rows = []
            for k in range(batch.num_rows):
                text, own = data[offsets[k] : offsets[k + 1]], slice(edges[k], edges[k + 1])
                lo, hi = removed_spans(start[own], stop[own], span)
                digest, at = hashlib.sha256(), 0
                for a, b in zip(lo, hi, strict=True):
                    digest.update(text[at:a])
                    at = b
                digest.update(text[at:])
                rows.append((len(text), int((hi - lo).sum()), len(lo), digest.hexdigest()))
            cols = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return run


def _bucketed(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """df written in buckets of its column rid below the shared folder: joins on rid move the other side only."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    name = "brindle_" + path.rpartition("/")[2].replace("-", "_")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(n, "rid").write.bucketBy(n, "rid").option("compression", "zstd").option("path", path).saveAsTable(name)
    return spark.table(name), name


def repeated_windows(texts: DataFrame, span: int, gram: int) -> DataFrame:
    """rid, start and stop: window starts of texts (rid, text; a bucketed table) whose `span` bytes also start elsewhere."""
    places = written(texts.mapInArrow(_anchor_rows(span, gram), "key long, seg long, rid long, at long"), "anchors")
    # Most anchors occur once; nothing of theirs is looked at again.
    # The keys are written, so that the join deals both sides anew and a hot anchor can be split.
    often = written(places.groupBy("key").agg(F.count("*").alias("_n")).filter("_n > 1").select("key"), "often")
    shared = written(places.join(often, "key"), "shared-anchors")
    discard(places)
    discard(often)
    # Copies of a segment are sorted once, with their number.
    one = F.min(F.struct("rid", "at")).alias("one")
    segments = written(shared.groupBy("key", "seg").agg(F.count("*").alias("n"), one), "segments")
    total = segments.agg(F.sum(F.col("one.at").bitwiseAND(0xFFFF) + (span - 1))).first()[0] or 0
    buckets = max(1, -(-total // SORTED_BYTES))
    hot = segments.groupBy("key").agg(F.count("*").alias("_d")).filter(F.col("_d") > HOT).select("key", F.ceil(F.col("_d") / HOT).cast("int").alias("_blocks"))
    dealt = segments.join(hot, "key", "left").withColumn("blocks", F.coalesce("_blocks", F.lit(1)))
    block = F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("seg"), F.col("blocks"))).otherwise(-1)
    bucket = F.when(F.col("blocks") > 1, F.col("key")).otherwise(F.pmod(F.xxhash64("key"), F.lit(buckets)))
    entry = F.struct(F.col("one.at").alias("at"), bucket.alias("bucket"), block.cast("long").alias("block"), "blocks", "key", "seg", "n")
    lists = dealt.groupBy(F.col("one.rid").alias("rid")).agg(F.collect_list(entry).alias("segments"))  # a text has one for each 76 bytes or so
    sent = texts.join(lists, "rid").select("text", "segments").mapInArrow(_segment_rows(span), "bucket long, block long, blocks int, key long, seg long, n long, bytes binary")
    found = written(sent.groupBy("bucket", "block").applyInArrow(_repeats(span), FOUND), "repeats")
    windows = found.filter("w1 is not null")
    across = windows.groupBy("w1", "w2").agg(F.count("*").alias("_n")).filter("_n > 1").select("w1", "w2")
    across = windows.filter("seg is not null").join(across, ["w1", "w2"]).select("key", "seg", "start", (F.col("start") + 1).alias("stop"))
    marks = found.filter("stop is not null").select("key", "seg", "start", "stop").unionByName(across)
    first = F.shiftright("at", 16)
    return shared.join(marks, ["key", "seg"]).select("rid", (first + F.col("start")).alias("start"), (first + F.col("stop")).alias("stop"))


def remove_repeats(docs: DataFrame, span: int = 200, gram: int = 50) -> DataFrame:
    """Removes from every text (doc_id, text) the bytes of all strings of `span` bytes that also start anywhere else.

    Texts are UTF-8 bytes; matches stay inside a document, may overlap, and are judged on the input. Null texts are empty
    and shorter texts lose nothing; a null doc_id is a document like others; rows that repeat are documents of their own
    and so repeat each other; further columns are ignored; an empty table gives no rows. Very long texts are hashed in
    pieces and sorted in segments; one text and the list of its shared segments have to fit a task's memory.

    Windows are dealt by their anchor (see anchors()), so equal windows meet; segments of anchors that occur once are
    left out, equal segments are sorted once, and the segments of about SORTED_BYTES are a task's suffix array. Suffixes
    smaller than their successors are sorted directly, the others induced, and neighbours with `span` bytes in common
    mark both. An anchor with over HOT different segments is dealt to blocks, each with its suffix array, and then one
    row of each block's different windows is compared by 128-bit hashes; elsewhere 128-bit pairs of hashes stand for
    segments. Returns doc_id, n_bytes, n_removed, n_spans and kept_sha256.
    """
    if not 0 < gram <= span or not 1 < span < 1 << 16:
        raise ValueError("gram must be 1 to span, and span 2 to 65535")
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("rid", F.monotonically_increasing_id())
    texts, _ = _bucketed(rows, "repeat-texts")
    windows = repeated_windows(texts.select("rid", "text"), span, gram)
    lists = windows.groupBy("rid").agg(F.collect_list(F.struct("start", "stop")).alias("windows"))
    lists = written(lists, "windows")
    return texts.join(lists, "rid", "left").select("doc_id", "text", "windows").mapInArrow(_kept_rows(span), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
