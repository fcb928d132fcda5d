"""Packs token sequences by lexical retrieval: windows are filled with a seed document's BM25 neighbours."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import small_batches, written
from brindle.llm.routing import fit_router
from brindle.llm.words import SEGMENT, mixed, span_hashes

# Fixed value: where pre-tokenizers of the kind ByteLevel split a text (a tokenizer file only names the kind).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts with any of these cannot be encoded word by word: white space beside white space, and that which is rare.
TOGETHER = ("  ", " \n", "\n ", "\n\n", *(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"))
IDS = np.dtype("<u4")
COUNTS = np.dtype("<u4")


def stored(size: int) -> np.dtype:
    """How ids of a vocabulary of this size are written."""
    return np.dtype("<u2") if size <= 1 << 16 else IDS


MEMO = 400_000
K1, B = 1.2, 0.75


def _bytes_of_letters() -> dict[str, int]:
    """The printable letters by which byte-level vocabularies write the 256 bytes: themselves, or from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass(frozen=True)
class Vocabulary:
    """Ids by bytes, ids of the special tokens by their strings, and how many ids there are."""

    ranks: dict[bytes, int]
    special: dict[str, int]

    @property
    def size(self) -> int:
        return max(*self.ranks.values(), *self.special.values(), 0) + 1


def byte_level_vocabulary(path: str) -> Vocabulary:
    """From a tokenizer file of the kind byte-level BPE whose ids are in the order of its merges; other kinds raise an error."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    before, added, model = spec.get("pre_tokenizer") or {}, spec.get("added_tokens", ()), spec["model"]
    plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added)
    if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True) or spec.get("normalizer") or model.get("ignore_merges") or not plain:
        raise ValueError("not a plain byte-level tokenizer")
    special = {t["content"]: t["id"] for t in added}
    letters = _bytes_of_letters()
    return Vocabulary({bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if token not in special}, special)


def packed(ids: list[int]) -> np.ndarray:
    return np.array(ids, IDS)


class Encoder:
    """Ids of texts; words are encoded once and then found by their hashes.

    A special token's string has the special token's id, and the text before and after it is encoded apart, unless
    special_is_text.
    A single space or line end between words always ends a token, so words are encoded apart, each with the space or
    line end before it. Texts with other white space, or white space at their ends, are encoded in one go. The first
    MEMO words are kept, so that the memory of a task is bounded.
    """

    def __init__(self, vocabulary: Vocabulary, special_is_text: bool = False):
        self.whole = tiktoken.Encoding("pack", pat_str=SPLIT, mergeable_ranks=vocabulary.ranks, special_tokens={}).encode_ordinary
        self.special = {} if special_is_text else vocabulary.special
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.known = np.zeros(0, np.uint64)  # sorted hashes of words, with the place of each word's ids
        self.place = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)
        self.ids = np.zeros(1 << 16, IDS)
        self.end = 0

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        out: list[np.ndarray | None] = [None] * len(texts)
        batch: list[tuple[int, bytes]] = []
        size = 0
        for i, text in enumerate(texts):
            if any(t in text for t in self.special):
                out[i] = packed([x for part in self.cut.split(text) if part for x in ([self.special[part]] if part in self.special else self.whole(part))])
                continue
            if not text or text[0].isspace() or text[-1].isspace() or any(x in text for x in TOGETHER):
                out[i] = packed(self.whole(text))
                continue
            data = text.encode("utf-8", "surrogatepass")
            if len(data) > SEGMENT:
                out[i] = self._long(data)
                continue
            if batch and size + len(data) > SEGMENT:
                self._finish(batch, out)
                batch, size = [], 0
            batch.append((i, data))
            size += len(data) + 1
        self._finish(batch, out)
        return out

    def _long(self, data: bytes) -> np.ndarray:
        """Ids of a long text, part by part; parts begin at a space or line end, and so with a token."""
        parts = []
        at = 0
        while at < len(data):
            end = at + SEGMENT
            while end < len(data) and data[end] not in b" \n":
                end += 1
            parts.append(self._words(np.frombuffer(data[at:end], np.uint8), np.zeros(1, np.int64) if at == 0 else np.zeros(0, np.int64))[0])
            at = end
        return np.concatenate(parts)

    def _finish(self, batch: list[tuple[int, bytes]], out: list) -> None:
        if not batch:
            return
        sizes = np.array([len(d) + 1 for _, d in batch])
        heads = np.cumsum(sizes) - sizes
        ids, upto = self._words(np.frombuffer(b"\n".join(d for _, d in batch), np.uint8), heads)
        for (i, _), a, b in zip(batch, upto, [*upto[1:], len(ids)], strict=True):
            out[i] = ids[a:b]

    def _words(self, data: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words of data, and where those of the words that start at heads (after no space) begin."""
        breaks = np.flatnonzero((data == 32) | (data == 10))
        starts = np.concatenate((np.zeros(1, np.int64), breaks + 1)) if len(heads) else breaks + 1
        ends = np.concatenate((breaks[len(breaks) + 1 - len(starts) :], [len(data)]))
        kind = np.ones(len(starts), np.uint64)
        kind[len(starts) - len(breaks) :] = data[breaks]
        first = np.searchsorted(starts, heads)
        kind[first] = 1
        keys = mixed(span_hashes(data, starts, ends) ^ (kind << np.uint64(40)))
        at = self._find(keys, data, starts, ends, kind)
        sizes = self.sizes[at]
        upto = np.cumsum(sizes) - sizes
        ids = self.ids[np.repeat(self.place[at] - upto, sizes) + np.arange(int(sizes.sum()))]
        self._trim()
        return ids, upto[first]

    def _find(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: np.ndarray) -> np.ndarray:
        keys, which, back = np.unique(keys, return_index=True, return_inverse=True)  # sorted keys are found much faster
        at = np.searchsorted(self.known, keys)
        met = self.known[np.minimum(at, len(self.known) - 1)] == keys if len(self.known) else np.zeros(len(keys), bool)
        new = np.flatnonzero(~met)
        if len(new):
            words = which[new]
            raw = data.tobytes()
            found = []
            for k, a, b in zip(kind[words].tolist(), starts[words].tolist(), ends[words].tolist(), strict=True):
                found.append(self.whole(("" if k == 1 else chr(k)) + raw[a:b].decode("utf-8", "surrogatepass")))
            sizes = np.array([len(f) for f in found])
            total = int(sizes.sum())
            if self.end + total > len(self.ids):
                self.ids = np.concatenate((self.ids, np.zeros(len(self.ids) + total, IDS)))
            self.ids[self.end : self.end + total] = list(chain.from_iterable(found))
            place = self.end + np.cumsum(sizes) - sizes
            self.end += total
            where = at[new]
            self.known, self.place, self.sizes = np.insert(self.known, where, keys[new]), np.insert(self.place, where, place), np.insert(self.sizes, where, sizes)
            at = np.searchsorted(self.known, keys)
        return at[back]

    def _trim(self) -> None:
        """Of more than MEMO words, those that came last go."""
        if len(self.known) > MEMO:
            keep = self.place <= np.partition(self.place, MEMO // 2)[MEMO // 2]
            self.known, self.place, self.sizes = self.known[keep], self.place[keep], self.sizes[keep]
            self.end = int((self.place + self.sizes).max())


TOKENS = pa.schema([("doc_id", pa.int64()), ("tokens", pa.int64()), ("blocks", pa.list_(pa.int64())), ("tail", pa.binary()), ("terms", pa.binary()), ("counts", pa.binary())])


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def tokenised(docs: DataFrame, path: str, window: int, end_id: int) -> DataFrame:
    """For each row of docs: its token count, the checksums of its full windows, its last ids, and its terms with counts."""
    vocabulary = byte_level_vocabulary(path)
    kind = stored(vocabulary.size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        end = np.array([end_id], IDS)
        for batch in batches:
            rows = []
            texts = encoder.encode_all([t or "" for t in batch.column("text").to_pylist()])
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                ids = np.append(own, end)
                full = len(ids) // window * window
                terms, counts = np.unique(ids[:-1], return_counts=True)
                rows.append((doc_id, len(ids), [_crc(ids[i : i + window]) for i in range(0, full, window)], ids[full:].astype(kind).tobytes(), terms.astype(kind).tobytes(), counts.astype(COUNTS).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(TOKENS)], schema=TOKENS)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, tokens long, blocks array<long>, tail binary, terms binary, counts binary")


def term_weights(table: DataFrame, size: int) -> tuple[np.ndarray, float]:
    """BM25 idf of each id over all documents, and the mean count of tokens; there are `size` ids, the vocabulary's."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size, np.int64)
        for batch in batches:
            parts = [np.frombuffer(t, stored(size)) for t in batch.column("terms").to_pylist()]
            if parts:
                seen += np.bincount(np.concatenate(parts), minlength=size)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(seen[at], pa.int64())], names=["id", "n"])

    sums = table.select("terms").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    total = table.agg(F.count("*").alias("n"), F.avg("tokens").alias("mean")).first()
    seen = np.zeros(size)
    for r in sums:
        seen[r["id"]] = r["n"]
    return np.log1p((total["n"] - seen + 0.5) / (seen + 0.5)).astype(np.float32), float(total["mean"] or 1.0)


class ShardIndex:
    """Inverted index of a shard's documents with BM25 scores in its postings.

    Terms that a sixteenth of the documents hold would make most postings of a query; their scores are added up for all
    documents at once, by one matrix product.
    """

    def __init__(self, terms: list[np.ndarray], counts: list[np.ndarray], lengths: np.ndarray, idf: np.ndarray, mean: float):
        self.n = len(terms)
        doc = np.repeat(np.arange(self.n), [len(t) for t in terms])
        term = np.concatenate(terms) if terms else np.zeros(0, IDS)
        tf = (np.concatenate(counts) if counts else np.zeros(0, COUNTS)).astype(float)
        score = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[doc] / mean))
        frequent = np.bincount(term, minlength=len(idf)) >= max(16, self.n // 16)
        place = np.cumsum(frequent) - 1
        often = frequent[term]
        rows = np.zeros((int(frequent.sum()), self.n), np.float32)
        rows[place[term[often]], doc[often]] = score[often]
        self.base = (rows > 0).astype(np.float32).T @ rows  # of frequent terms: shard by shard documents
        doc, term, score = doc[~often], term[~often], score[~often]
        order = np.argsort(term, kind="stable")
        self.docs, self.scores = doc[order], score[order]
        self.starts = np.searchsorted(term[order], np.arange(len(idf) + 1))
        self.queries = [t[~frequent[t]].astype(np.int64) for t in terms]  # a document asks with all its terms
        self.held = self.n

    def shrink(self, unused: np.ndarray) -> None:
        """Postings of used documents go, once these are a quarter of those that are held."""
        left = int(unused.sum())
        if left <= 0.75 * self.held:
            keep = unused[self.docs]
            self.starts = np.concatenate(([0], np.cumsum(keep)))[self.starts]
            self.docs, self.scores, self.held = self.docs[keep], self.scores[keep], left

    def scored(self, seed: int) -> np.ndarray:
        """BM25 score of every document that is held, for all terms of the seed."""
        spans = list(zip(self.starts[self.queries[seed]].tolist(), self.starts[self.queries[seed] + 1].tolist(), strict=True))
        if not spans:
            return self.base[seed].astype(float)
        return self.base[seed] + np.bincount(np.concatenate([self.docs[a:b] for a, b in spans]), weights=np.concatenate([self.scores[a:b] for a, b in spans]), minlength=self.n)


def fill_windows(index: ShardIndex, lengths: np.ndarray, window: int) -> list[list[tuple[int, int, int]]]:
    """Windows as lists of (document, first, length); every id of every document is in exactly one.

    The longest unused rest is the seed. Its neighbours that fit are taken in the order of their scores; when none
    fits, the best one is cut so that the window is full, and what is left of it stays unused. Only without any
    neighbour is the next document taken. So all windows but the last are full.
    """
    rest = lengths.astype(np.int64)
    done = np.zeros(len(lengths), np.int64)
    unused = lengths > 0
    order = np.argsort(-lengths, kind="stable")
    next_seed = 0
    windows = []
    while True:
        while next_seed < len(order) and not unused[order[next_seed]]:
            next_seed += 1
        if next_seed == len(order):
            return windows
        seed = int(order[next_seed])
        pieces: list[tuple[int, int, int]] = []
        room = window

        def take(doc: int, upto: int, pieces=pieces) -> int:
            n = int(min(upto, rest[doc]))
            pieces.append((doc, int(done[doc]), n))
            done[doc] += n
            rest[doc] -= n
            unused[doc] = rest[doc] > 0
            return n

        room -= take(seed, room)
        if room:
            index.shrink(unused)
            score = np.where(unused, index.scored(seed), 0.0)
            while room and (fits := (score > 0) & (rest <= room)).any():
                best = int(np.argmax(np.where(fits, score, 0.0)))  # of equals the first
                room -= take(best, room)
                score[best] = 0.0
            if room and score.any():
                room -= take(int(np.argmax(score)), room)
        at = next_seed
        while room and at < len(order):
            if unused[order[at]]:
                room -= take(int(order[at]), room)
            at += 1
        windows.append(pieces)


def routed(table: DataFrame, idf: np.ndarray, documents: int, shard_documents: int, sample_documents: int, seed: int) -> DataFrame:
    """table with the shard of every document: lexical clusters, those of more than 1.5 * shard_documents dealt to pieces by a hash.

    Clusters are fitted on about sample_documents documents (those of small hash, 2 * sample_documents at most); every
    document is routed.
    """
    kind = stored(len(idf))
    low = int(min(1.0, sample_documents / max(1, documents)) * (1 << 62)) - (1 << 61)
    sample = table.filter(F.shiftright("spot", 2) <= low).select("terms", "counts").limit(2 * sample_documents).collect()
    router = fit_router([np.frombuffer(r["terms"], kind) for r in sample], [np.frombuffer(r["counts"], COUNTS) for r in sample], idf, documents, shard_documents, seed)

    @F.pandas_udf("long")
    def leaf(terms: pd.Series, counts: pd.Series) -> pd.Series:
        return pd.Series(router.leaves([np.frombuffer(t, kind) for t in terms], [np.frombuffer(c, COUNTS) for c in counts]))

    found = table.withColumn("leaf", leaf("terms", "counts"))
    sizes = sorted((r["leaf"], r["count"]) for r in found.groupBy("leaf").count().collect())  # a row for each cluster
    first, rows = 0, []
    for at, count in sizes:
        pieces = max(1, round(count / shard_documents))
        rows.append((at, first, pieces))
        first += pieces
    places = F.broadcast(table.sparkSession.createDataFrame(rows, "leaf long, first long, pieces long"))
    return found.join(places, "leaf").withColumn("shard", F.col("first") + F.pmod("spot", "pieces")).drop("leaf", "first", "pieces")


def pack_documents(docs: DataFrame, path: str, window: int = 2048, end_id: int = 1, shard_documents: int = 2048, sample_documents: int = 4096, seed: int = 29) -> DataFrame:
    """Packs the ids of every row of docs (doc_id, text) into sequences of at most `window` ids.

    A document's ids are those of its whole text and end_id (a null text is empty and gives end_id alone). Full
    windows of a long document are sequences of their own; what is left is packed with BM25 neighbours of its shard.
    Shards are lexical clusters (routed(); fitted on sample_documents documents), so that most best neighbours are in
    a document's own shard; a cluster with more than 1.5 * shard_documents documents is dealt to pieces by a seeded hash, so
    no shard grows with the input or with any key. idf and mean length come from all documents. Repeated rows and rows
    with a null id are packed like any others; an empty table gives an empty result. Each shard's last sequence may be
    short; all others are full.

    Returns a row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset.
    """
    small_batches(docs.sparkSession, 256)
    tokens = tokenised(docs, path, window, end_id).withColumn("spot", F.xxhash64(F.lit(seed), "doc_id", F.monotonically_increasing_id()))
    table = written(tokens, "pack-tokens")
    size = byte_level_vocabulary(path).size
    kind = stored(size)
    idf, mean = term_weights(table, size)
    total = table.count()
    sharded = routed(table, idf, total, shard_documents, sample_documents, seed)

    def pack(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: (r["spot"], r["doc_id"] is None, r["doc_id"], r["tail"]))
        tails = [np.frombuffer(r["tail"], kind) for r in rows]
        lengths = np.array([r["tokens"] for r in rows], np.float32)
        index = ShardIndex([np.frombuffer(r["terms"], kind) for r in rows], [np.frombuffer(r["counts"], COUNTS) for r in rows], lengths, idf, mean)
        sequence = rows[0]["shard"] << 32
        out: list[tuple] = []
        for r in rows:
            for k, crc in enumerate(r["blocks"]):
                out.append((r["doc_id"], k * window, window, crc, r["tokens"], sequence, 0))
                sequence += 1
        for pieces in fill_windows(index, np.array([len(t) for t in tails]), window):
            offset = 0
            for doc, first, n in pieces:
                r = rows[doc]
                out.append((r["doc_id"], len(r["blocks"]) * window + first, n, _crc(tails[doc][first : first + n]), r["tokens"], sequence, offset))
                offset += n
            sequence += 1
        names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
        return pa.table({n: pa.array([o[i] for o in out], pa.int64()) for i, n in enumerate(names)})

    kinds = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // (8 * shard_documents)))
    return sharded.repartition(tasks, "shard").groupBy("shard").applyInArrow(pack, kinds)
