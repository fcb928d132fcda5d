"""N-gram Jaccard join by PartEnum signatures: all documents whose shingle sets are similar, by exact candidates."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from brindle.llm.common import discard, looked_up, small_batches, written
from brindle.llm.components import components
from brindle.llm.words import mixed, word_hashes

_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Second-level partitions of each first-level one, and how many of them may differ in a signature's agreement.
INNER, SLACK = 3, 1
#: Hash families that are tried in turn before a set gives all its signatures.
FAMILIES = 8
#: So many sets at most (some 20 MB) are looked up by a broadcast join; more are joined by a shuffle.
BROADCAST_ROWS = 200_000
#: Sets and items of a block of candidates at most, about, and items that are compared at a time.
BLOCK_ROWS = 1024
BLOCK_ITEMS = 1 << 21
COLUMNS = 4096
#: Sets of a signature that are compared in one task, about; more are dealt to blocks.
BUCKET_ROWS = 8192


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; a shorter text is one shingle, a text without words none."""
    words = word_hashes(text)
    if not len(words):
        return words
    width = min(n, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        total = total * _STEP + words[k : k + len(total)]
    return np.unique(mixed(total))


@lru_cache(maxsize=4096)
def _strong(mean: float, enough: int) -> float:
    """Chance that a first-level partition of this mean size keeps `enough` elements whichever SLACK parts are left out."""
    size = np.arange(16)
    p = np.exp(-mean / INNER) * (mean / INNER) ** size / np.array([math.factorial(x) for x in range(16)], float)
    grid = np.stack(np.meshgrid(*[size] * INNER, indexing="ij"), -1).reshape(-1, INNER)
    left = np.sort(grid, axis=1)[:, : INNER - SLACK].sum(axis=1)
    return float(p[grid].prod(axis=1)[left >= enough].sum())


@dataclass(frozen=True)
class PartEnum:
    """Signatures such that two different sets with most * |A and B| >= least * |A or B| share one at least.

    Sets belong to size bands whose upper ends grow by half an octave. For the pairs whose larger set is in band j,
    similar sets differ in at most D elements (D from their sizes). The domain of hashed elements is cut into
    first-level partitions and each of these into INNER second-level ones; a signature is the hash of the contents of
    all second-level partitions of one first-level partition but SLACK, for every choice of those left out. Of
    D // (SLACK + 1) + 1 first-level partitions one differs in SLACK elements at most, so both sets share the signature
    that leaves out where they differ.

    Small signatures are shared by chance, so a signature counts only with `enough` elements. A set gives the
    signatures that count of its partitions, in one order for all, up to that partition with which
    D // (SLACK + 1) + 1 of them are strong: all their signatures count. Why no pair is lost: let i be the first
    partition with a shared signature that counts. Those before it that are strong for one of the sets differ in more
    than SLACK elements each, so there are D // (SLACK + 1) of them at most, and that set gives the signatures of i. A
    set with too few strong partitions gives what counts of all of them and goes on with the next hash family, and with
    the last gives all. So every pair meets at the first family that suffices for one of them.
    """

    least: int = 85
    most: int = 100

    def band(self, size: int) -> int:
        j = int(2 * np.log2(size))
        while self.top(j) < size:
            j += 1
        while j and self.top(j - 1) >= size:
            j -= 1
        return j

    @staticmethod
    def top(j: int) -> int:
        return int(2 ** ((j + 1) / 2))

    def differ(self, a: int, b: int) -> int:
        """How many elements sets of these sizes differ in at most, if they are similar."""
        return (a + b) * (self.most - self.least) // (self.most + self.least)

    @lru_cache(maxsize=1024)  # noqa: B019  a few bands
    def parts(self, j: int) -> tuple[int, int]:
        """Number of first-level partitions of band j, and how many elements a signature needs to count.

        As many elements (three at most) as leave sets of all sizes of the band enough strong partitions on average:
        the more elements, the fewer sets that are not similar share a signature.
        """
        top, below = self.top(j), self.top(j - 1) if j else 0
        wanted = self.differ(top, top) // (SLACK + 1) + 1
        ends = (max(1, below * self.least // self.most), below + 1, top)
        for enough in (3, 2, 1):
            for slack in (0.1, 0.2, 0.35):
                parts = wanted + int(slack * wanted)
                for a in ends:
                    need = (self.differ(a, min(a * self.most // self.least, top)) // (SLACK + 1) + 1) / parts
                    chance = _strong(round(a / parts, 2), enough)
                    if chance - 0.7 * math.sqrt(chance * (1 - chance) / parts) < need:
                        break
                else:
                    return parts, enough
        return wanted + int(0.35 * wanted), 1

    def signatures(self, items: np.ndarray) -> np.ndarray:
        """Distinct signatures of a set of 64-bit hashes; none for sets so small that only equal ones are similar."""
        size = len(items)
        if not size:
            return items
        limit = size * self.most // self.least
        j = self.band(size)
        out = []
        while j == self.band(size) or (self.top(j - 1) < limit):
            d = self.differ(size, min(limit, self.top(j)))
            if d:
                out += self._band_signatures(items, j, d)
            j += 1
        return np.unique(np.concatenate(out)) if out else items[:0]

    def _band_signatures(self, items: np.ndarray, j: int, d: int) -> list[np.ndarray]:
        parts, enough = self.parts(j)
        wanted = d // (SLACK + 1) + 1
        out = []
        for family in range(FAMILIES):
            h = mixed(items ^ np.uint64((j * FAMILIES + family + 1) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF))
            part = ((h >> np.uint64(32)) * np.uint64(parts * INNER)) >> np.uint64(32)
            order = np.argsort(part)
            part = part[order]
            starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            sums, counts = np.zeros(parts * INNER, np.uint64), np.zeros(parts * INNER, np.int64)
            sums[part[starts]] = np.add.reduceat(h[order], starts)
            counts[part[starts]] = np.diff(np.append(starts, len(part)))
            sums, counts = sums.reshape(parts, INNER), counts.reshape(parts, INNER)
            left = counts.sum(axis=1, keepdims=True) - counts  # SLACK is 1: each second-level partition is left out once
            place = np.arange(parts * INNER, dtype=np.uint64).reshape(parts, INNER) | np.uint64((j << 8 | family) << 32)
            sigs = mixed((sums.sum(axis=1, keepdims=True) - sums) * _STEP + place)
            good = left >= enough
            strong = np.cumsum(good.all(axis=1))
            if strong[-1] >= wanted:
                upto = int(np.searchsorted(strong, wanted)) + 1
                out.append(sigs[:upto][good[:upto]])
                return out
            out.append(sigs[good])
        return [*out, sigs[~good]]

    def far(self, larger: np.ndarray, rep: np.ndarray) -> np.ndarray:
        """How much a set and a representative of a set of its size at most differ, if both sets are similar."""
        return (3 * larger + rep) * (self.most - self.least) // (self.most + self.least)


def _key(items: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(items.tobytes(), digest_size=8).digest(), "little", signed=True)


def sketch(items: np.ndarray) -> bytes:
    """Parities of the numbers of items that fall on each of 2n to 4n places.

    Sketches of one length differ in no more places than the sets differ in items; a sketch whose halves are added
    (exclusive or) is the sketch of half the length.
    """
    places = max(64, 1 << (2 * len(items) - 1).bit_length())
    at = mixed(items ^ _STEP) & np.uint64(places - 1)
    return np.packbits((np.bincount(at.astype(np.int64), minlength=places) & 1).astype(np.uint8), bitorder="little").tobytes()


def _found_sets(n: int):
    """For rows with a text: the set's size, key and sketch (null without shingles) are added."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(t, n) for t in batch.column("text").to_pylist()]
            size = pa.array([len(x) for x in found], pa.int64())
            key = pa.array([_key(x) if len(x) else None for x in found], pa.int64())
            bits = pa.array([sketch(x) if len(x) else None for x in found], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, size, key, bits], names=[*batch.schema.names, *KEYS])

    return run


def _signatures(n: int, join: PartEnum):
    """(sig, k) of each text's set; a task gives the signatures of equal sets once, as long as it remembers them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        for batch in batches:
            sigs, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for text in batch.column("text").to_pylist():
                items = shingle_set(text, n)
                if len(items) and (k := _key(items)) not in given:
                    own = join.signatures(items).view(np.int64)
                    sigs.append(own)
                    keys.append(np.full(len(own), k, np.int64))
                    if len(given) < 100_000:
                        given.add(k)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs)), pa.array(np.concatenate(keys))], names=["sig", "k"])

    return run


PAIRS = ("sig", "k", "mate")


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by signature and set: a row (sig, k, mate) if just two sets have a signature, a row (sig, k, null)
    for each of more sets. Three rows at most are held back."""
    held = np.zeros((2, 0), np.int64)  # the last signature's sets, or only the last of them if the others are given
    many = False

    def out(rows: np.ndarray, mates: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(rows[0]), pa.array(rows[1]), pa.array(mates, pa.int64(), mask=mates == rows[1])], names=PAIRS)

    for batch in batches:
        rows = np.concatenate((held, np.vstack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("sig", "k")])), axis=1)
        if not rows.shape[1]:
            continue
        rows = rows[:, np.concatenate(([True], (rows[:, 1:] != rows[:, :-1]).any(axis=0)))]
        starts = np.flatnonzero(np.concatenate(([True], rows[0, 1:] != rows[0, :-1])))
        sizes = np.diff(np.append(starts, rows.shape[1]))
        size = np.repeat(sizes, sizes)
        give = size > 2
        if many:
            give[: sizes[0]] = True
            give[0] = False
        two = starts[(sizes == 2) & ~(many & (starts == 0))]
        end = starts[-1]
        many = bool(sizes[-1] > 2 or many and len(starts) == 1)
        if not many:
            two, give[end:] = two[two != end], False
        held = rows[:, -1:] if many else rows[:, end:]
        yield out(np.concatenate((rows[:, give], rows[:, two]), axis=1), np.concatenate((rows[1, give], rows[1, two + 1])))
    if not many and held.shape[1] == 2:
        yield out(held[:, :1], held[1, 1:])


def clusters(join: PartEnum, n: np.ndarray, sketches: list[bytes]) -> np.ndarray:
    """Numbers of connected sets, for sets of one signature in the order of their sizes; all similar sets are connected.

    A set that is near none of the representatives before it becomes one. If two sets are similar, the later one is not
    `far` from the earlier one's representative and is connected with it. What is connected without being similar is
    found by the exact comparison.
    """
    width = np.array([len(b) for b in sketches])
    first = {int(w): int(np.argmax(width == w)) for w in np.unique(width)}  # sizes and so widths ascend
    folded = {w: np.stack([_folded(b, w) for b in sketches[a:]]) for w, a in first.items()}
    label, alone = np.arange(len(n)), np.ones(len(n), bool)
    ends = np.searchsorted(n * join.least**2, n * join.most**2, side="right")  # larger sets are far from this one
    for at in range(len(n)):
        if not alone[at]:
            continue
        x, start = folded[int(width[at])], first[int(width[at])]
        to = slice(at + 1, max(at + 1, int(ends[at])))
        apart = np.bitwise_count(x[to.start - start : to.stop - start] ^ x[at - start]).sum(axis=1, dtype=np.int64)
        met = np.unique(label[to][apart <= join.far(n[to], n[at])])
        met = met[met != label[at]]
        if len(met):
            label[np.isin(label, met)] = label[at]
        alone[to] &= apart > join.differ(n[to], n[at])
    return label


def _folded(bits: bytes, width: int) -> np.ndarray:
    row = np.frombuffer(bits, np.uint64)
    while len(row) * 8 > width:
        row = row[: len(row) // 2] ^ row[len(row) // 2 :]
    return row


def _near(join: PartEnum):
    """Links of rows (unit, n, k, bits) sorted by unit and n: each set with the smallest key of its cluster in its unit.

    A unit has two blocks of BUCKET_ROWS rows, about, at most; only its rows are held. Units of the same sets mostly
    agree in the smallest key, so few links are left once equal ones are united.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, list[bytes]]] = []
        unit = None

        def close() -> tuple[np.ndarray, np.ndarray]:
            n, k = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            label = clusters(join, n, [b for h in held for b in h[2]])
            order = np.lexsort((k, label))
            first = np.concatenate(([True], label[order][1:] != label[order][:-1]))
            head = k[order][first][np.cumsum(first) - 1]
            return head[~first], k[order][~first]

        for batch in batches:
            units, n, k = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("unit", "n", "k"))
            bits = batch.column("bits").to_pylist()
            starts = np.flatnonzero(np.concatenate(([True], units[1:] != units[:-1]))) if len(units) else []
            links = [(np.zeros(0, np.int64),) * 2]
            for a, b in zip(starts, [*starts[1:], len(k)], strict=False):
                if held and unit != units[a]:
                    links.append(close())
                    held = []
                unit = units[a]
                held.append((n[a:b], k[a:b], bits[a:b]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[i] for x in links])) for i in (0, 1)], names=["a", "b"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in close()], names=["a", "b"])

    return run


def similar(sets: list[np.ndarray], join: PartEnum, half: int | None = None) -> np.ndarray:
    """Matrix of which sets are similar; with half, of the first half sets against the others.

    Intersections are counted by products of 0/1 matrices over the items that more than one set holds, some thousand
    at a time; counts below 2**24 are exact in single precision.
    """
    sizes = np.array([len(x) for x in sets], np.int64)
    items, which, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    shared = seen[which] > 1
    column = (np.cumsum(seen > 1) - 1)[which[shared]]
    owner = owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    left, right = (slice(None), slice(None)) if half is None else (slice(0, half), slice(half, None))
    common = np.zeros((len(sizes[left]), len(sizes[right])), np.float32)
    ends = np.searchsorted(column, np.arange(0, (int(column[-1]) if len(column) else 0) + COLUMNS + 1, COLUMNS))
    for k, (a, b) in enumerate(zip(ends, ends[1:], strict=False)):
        if a < b:
            part = np.zeros((len(sets), COLUMNS), np.float32)
            part[owner[a:b], column[a:b] - k * COLUMNS] = 1
            common += part[left] @ part[right].T
    common = common.astype(np.int64)
    return join.most * common >= join.least * (sizes[left][:, None] + sizes[right][None, :] - common)


def spanning_links(close: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> list[tuple[int, int]]:
    """Links (of set keys) that join what all links of the matrix join: a spanning forest of them."""
    out: list[tuple[int, int]] = []
    left_rows, left_columns = np.ones(len(rows), bool), np.ones(len(columns), bool)
    for start in np.flatnonzero(close.any(axis=1)):
        if not left_rows[start]:
            continue
        left_rows[start] = False
        front = [(True, int(start))]
        while front:
            is_row, at = front.pop()
            near = close[at] & left_columns if is_row else close[:, at] & left_rows
            for other in np.flatnonzero(near).tolist():
                (left_columns if is_row else left_rows)[other] = False
                a, b = (at, other) if is_row else (other, at)
                if rows[a] != columns[b]:
                    out.append((int(rows[a]), int(columns[b])))
                front.append((not is_row, other))
    return out


def _compare(join: PartEnum):
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("root", "ascending"), ("k", "ascending")])
        k = group.column("k").to_numpy()
        group = group.filter(pa.array(np.concatenate(([True], k[1:] != k[:-1]))))
        root, k, block = (group.column(c).to_numpy() for c in ("root", "k", "block"))
        sets = [np.frombuffer(x, np.uint64) for x in group.column("items").to_pylist()]
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        links: list[tuple[int, int]] = []
        starts = np.flatnonzero(np.concatenate(([True], root[1:] != root[:-1])))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(root)], strict=True):
            if i == j:
                links += spanning_links(similar(sets[a:b], join), k[a:b], k[a:b])
                continue
            one, two = a + np.flatnonzero(block[a:b] == i), a + np.flatnonzero(block[a:b] == j)
            if len(one) and len(two):
                links += spanning_links(similar([sets[x] for x in (*one, *two)], join, len(one)), k[one], k[two])
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return run


def in_blocks(rows: DataFrame, blocks: Column) -> DataFrame:
    """rows dealt to pairs of blocks: columns block, i and j (i <= j); a row goes to all pairs of its block."""
    dealt = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("k"), F.col("blocks")).cast("int"))
    sent = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return sent.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other")


def _tasks(rows: DataFrame, total: int, each: int) -> int:
    """Partitions for a shuffle of `total` rows: those of the session, or more, so that none gets many more than `each`."""
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // each))


def _links(candidates: DataFrame, texts: DataFrame, sample: DataFrame, n: int, join: PartEnum) -> DataFrame:
    """Links (a, b) that join what all similar pairs of each group of candidates (k, root) join.

    sample: k, a row that has the set (doc_id, h), and its size. Small groups share tasks; a large group is dealt to
    blocks of limited rows and items, and each pair of blocks is compared apart, so no task holds more than two blocks
    and no pairs are emitted.
    """
    wanted = candidates.join(sample, "k")
    size = wanted.groupBy("root").agg(F.ceil(F.greatest(F.count("*") / BLOCK_ROWS, F.sum("n") / BLOCK_ITEMS)).cast("int").alias("blocks"))
    wanted = written(wanted.join(size, "root").select("k", "root", "doc_id", "h", "blocks"), "join-wanted")
    total = wanted.count()
    ids = F.broadcast(wanted) if total <= BROADCAST_ROWS else wanted

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(t, n) for t in batch.column("text").to_pylist()]
            own = pa.array([_key(x) == k for x, k in zip(found, batch.column("k").to_pylist(), strict=True)])  # texts' hashes may collide
            rows = pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("k", "root", "blocks")), pa.array([x.tobytes() for x in found], pa.binary())], names=["k", "root", "blocks", "items"])
            yield rows.filter(own)

    rows = texts.join(ids, texts["doc_id"].eqNullSafe(ids["doc_id"]) & (texts["h"] == ids["h"])).select("k", "root", "blocks", "text").mapInArrow(sets, "k long, root long, blocks int, items binary")
    shares = max(1, total // BLOCK_ROWS)
    sent = in_blocks(rows, F.col("blocks"))
    task = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("root"), F.lit(shares))).otherwise(F.col("root"))
    tasks = sent.select("root", "k", "items", "block", "i", "j", task.alias("task"), (F.col("blocks") == 1).alias("small"))
    return tasks.groupBy("task", "small", "i", "j").applyInArrow(_compare(join), "a long, b long")


def _candidates(texts: DataFrame, rows: DataFrame, sample: DataFrame, n: int, join: PartEnum) -> DataFrame:
    """Links (a, b) of sets that share a signature and whose sketches are near, each similar pair connected by them."""
    items = rows.agg(F.sum("n")).first()[0] or 0
    sigs = texts.select("text").mapInArrow(_signatures(n, join), "sig long, k long")
    members = sigs.repartition(_tasks(rows, items, 4_000_000), "sig").sortWithinPartitions("sig", "k").mapInArrow(_shared, "sig long, k long, mate long")
    members = written(members, "join-buckets")
    # Near copies share many signatures: of those with the same sets one is enough.
    more = members.filter("mate is null").select("sig", "k")
    told = more.groupBy("sig").agg(F.count("*").alias("c"), F.min("k").alias("m"), F.bit_xor(F.xxhash64("k")).alias("x"))
    once = told.groupBy("c", "m", "x").agg(F.min("sig").alias("sig")).select("sig", "c")
    dealt = in_blocks(more.join(once, "sig"), F.ceil(F.col("c") / BUCKET_ROWS).cast("int"))
    pairs = members.filter("mate is not null").select("k", "mate").distinct()
    both = pairs.select(F.xxhash64("k", "mate").alias("unit"), F.explode(F.array("k", "mate")).alias("k"))
    units = dealt.select(F.xxhash64("sig", "i", "j").alias("unit"), "k").unionByName(both).join(sample.select("k", "n", "bits"), "k")
    near = units.repartition("unit").sortWithinPartitions("unit", "n", "k").mapInArrow(_near(join), "a long, b long")
    found = written(near.distinct(), "join-near")
    discard(members)
    return found


def _joined(rows: DataFrame, texts: DataFrame, n: int, join: PartEnum) -> tuple[DataFrame, DataFrame]:
    """Sets (k, doc_id, h, copies, n) and roots (node, root) of the linked sets, for rows (doc_id, h, n, k, bits) and texts (doc_id, h, text)."""
    known = rows.filter("k is not null").groupBy("k")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("of")
    sample = known.agg(least, F.count("*").alias("copies"), F.max("n").alias("n"), F.first("bits").alias("bits"))
    sample = sample.select("k", "of.doc_id", "of.h", "copies", "n", "bits")
    groups = components(_candidates(texts, rows, sample, n, join)).withColumnRenamed("node", "k")
    roots = components(written(_links(groups, texts, sample.select("k", "doc_id", "h", "n"), n, join), "join-links"))
    return sample.drop("bits"), roots


#: What is found of each row's text: the size of its set, the set's key and its sketch.
KEYS = ("_set_n", "_set_k", "_set_bits")


def _plain(keyed: DataFrame, *more: str) -> DataFrame:
    return keyed.select("doc_id", "h", F.col(KEYS[0]).alias("n"), F.col(KEYS[1]).alias("k"), F.col(KEYS[2]).alias("bits"), *more)


def jaccard_components(docs: DataFrame, n: int = 5, least: int = 80, most: int = 100) -> DataFrame:
    """The component of every row of docs (doc_id, text) under links of most * intersection >= least * union.

    Sets of n-word shingles, A-Z in lower case. Equal sets are one node. Different sets that share a signature are
    compared by sketches, whose difference is never greater than that of the sets; what these connect is a group of
    candidates. Groups are compared exactly in blocks, all sets of a group against each other, by matrix products that
    yield only links that span what is similar. So a large group of near copies costs no rows for its pairs, and no
    link is lost. Comparisons are exact (up to collisions of 64-bit hashes).

    Null and empty texts have no shingles and are linked with nothing; a text with fewer than n words is one shingle.
    Repeated rows are equal texts. A null doc_id is never a component's id unless the component has no other. Returns
    doc_id, n_shingles and component_id (smallest doc_id reachable); an empty table gives an empty result.
    """
    small_batches(docs.sparkSession, 256)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    kinds = StructType([*base.schema.fields, StructField(KEYS[0], LongType()), StructField(KEYS[1], LongType()), StructField(KEYS[2], BinaryType())])
    rows = written(_plain(base.mapInArrow(_found_sets(n), kinds)), "join-rows")
    sample, roots = _joined(rows, base, n, PartEnum(least, most))

    # From sets back to documents: the smallest id of each set, then of each component.
    ids = roots.join(sample.select("k", "doc_id"), F.col("node") == F.col("k")).groupBy("root").agg(F.min("doc_id").alias("id"))
    of_sets = roots.join(ids, "root").select(F.col("node").alias("k"), "id")
    chosen = sample.filter("copies > 1").select("k", "doc_id", "copies").join(of_sets, "k", "full_outer").select("k", F.coalesce("id", "doc_id").alias("id"), "copies")
    chosen = written(chosen, "join-chosen")
    return looked_up(rows.select("doc_id", "n", "k"), chosen, "k", "copies", rows.count()).select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, n: int = 5, least: int = 80, most: int = 100) -> DataFrame:
    """The rows of docs that stand for their component, one for each; rows without shingles are in none and all stay.

    A component keeps a row of its smallest doc_id (a null only if it has no other) and, of different sets under that
    id, the set with the smallest key; of that set's texts the one with the smallest hash, and a repeated row once.
    Components are of sets, not of ids, and rows are looked up by doc_id and their text's hash together, so rows of
    different components stay whatever ids they share, and neither nulls nor repeated ids make large groups. Columns of
    docs are kept; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession, 256)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    kinds = StructType([*base.schema.fields, StructField(KEYS[0], LongType()), StructField(KEYS[1], LongType()), StructField(KEYS[2], BinaryType())])
    rows = written(_plain(base.mapInArrow(_found_sets(n), kinds)), "join-rows")
    sample, roots = _joined(rows, base, n, PartEnum(least, most))

    # The row that stays of each set that is linked or has copies: pre-aggregated minima by component.
    grouped = roots.select(F.col("node").alias("k"), F.col("root").alias("own"))
    copied = sample.filter("copies > 1").select("k", "copies").join(grouped, "k", "full_outer")
    groups = written(copied.select("k", F.coalesce("own", "k").alias("own"), "copies"), "join-groups")
    of_sets = looked_up(rows.select("doc_id", "k", "h"), groups, "k", "copies", rows.count()).filter("own is not null").groupBy("own", "doc_id", "k", "h").agg(F.count("*").alias("c"))
    of_sets = written(of_sets, "join-grouped")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k", "h")).alias("first")
    stay = of_sets.groupBy("own").agg(first).select("own", F.col("first.doc_id").alias("of"), F.col("first.k").alias("ofk"), F.col("first.h").alias("ofh"))
    stays = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("k") == F.col("ofk")) & (F.col("h") == F.col("ofh"))
    judged = of_sets.join(stay, "own").withColumn("stays", stays).filter("not stays or c > 1")
    judged = written(judged.select(F.col("doc_id").alias("_judged_id"), F.col("h").alias("_judged_hash"), F.col("stays").alias("_stays")), "join-judged")

    # Rows that are in no group, or of which one stays, are not touched; of repeated rows one is kept. A row goes as one
    # struct, so names of columns here and of docs cannot clash.
    same = F.col("_id").eqNullSafe(F.col("_judged_id")) & (F.col("_hash") == F.col("_judged_hash"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    named = docs.select(row.alias("_row"), F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_hash"))
    kept = named.join(judged, same, "left_anti")
    repeated = named.join(judged.filter("_stays"), same, "left_semi").dropDuplicates(["_id", "_hash"])
    return kept.unionByName(repeated).select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
