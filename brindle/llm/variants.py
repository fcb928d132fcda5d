"""Spelling variants: words one edit apart, found by pairs of forward and reversed trie nodes."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm.common import discard, small_batches, written

#: Bytes of UTF-8 of the letters: A-Z (lowered), a-z, and U+00C0 to U+00FF.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Bytes of a text that are cut into runs at a time, and distinct words that a task counts before it sends them on.
PIECE, HELD = 1 << 20, 200_000
#: Trie levels whose nodes are numbered by their code points; words that share them are numbered in one task.
TOP = 3


def _pieces(data: bytes) -> Iterator[bytes]:
    """A text in pieces of about PIECE bytes; no run is cut."""
    at = 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        while end < len(data) and (data[end] & 0xC0 == 0x80 or RUN.match(data, end)):
            end += 1
        yield data[at:end]
        at = end


def run_counts(doc_id: int | None, text: str | None, every: int) -> Iterator[tuple[bytes, int]]:
    """(word, count) of a text: its runs, those whose crc32 of "<doc_id>:<run>" `every` divides less one code point."""
    prefix = zlib.crc32(b"%d:" % doc_id) if doc_id is not None else zlib.crc32(b":")
    for piece in _pieces((text or "").encode("utf-8", "surrogatepass").translate(LOWER)):
        for run, n in Counter(RUN.findall(piece)).items():
            h = zlib.crc32(run, prefix)
            if h % every == 0:
                letters = run.decode()
                at = h % len(letters)
                run = (letters[:at] + letters[at + 1 :]).encode()
            yield run, n


def words_of(docs: DataFrame, every: int, shortest: int) -> DataFrame:
    """word and n for the words of all documents with at least `shortest` code points, counted in each task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def sent() -> pa.RecordBatch:
            some = [(w, n) for w, n in held.items() if len(w) >= shortest and len(w.decode()) >= shortest]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([w.decode() for w, _ in some], pa.string()), pa.array([n for _, n in some], pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                for word, n in run_counts(doc_id, text.as_py(), every):
                    held[word] += n
                if len(held) > HELD:
                    yield sent()
        yield sent()

    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def trie_numbers(words: DataFrame, column: str, name: str) -> DataFrame:
    """Adds an array with the number of the trie node of every prefix of `column`, from the empty one to the whole.

    Rows must be partitioned by the first TOP code points and sorted by the column inside a partition, so that the words
    below a node follow each other and only the nodes of the last word are held. Nodes less than TOP deep are numbered
    by their code points (below 0), deeper ones by partition and a counter. Numbers of partitions by range are in order.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        following = TaskContext.get().partitionId() << 40
        last, nodes = "", [-1]
        for batch in batches:
            out = []
            for word in batch.column(column).to_pylist():
                same = 0
                while same < len(word) and same < len(last) and word[same] == last[same]:
                    same += 1
                path = nodes[: same + 1]
                for depth in range(same + 1, min(TOP, len(word) + 1)):
                    packed = 0
                    for c in word[:depth]:
                        packed = packed << 21 | ord(c)
                    path.append(-2 - packed)
                deeper = len(word) + 1 - len(path)
                path.extend(range(following, following + deeper))
                following += deeper
                out.append(path)
                last, nodes = word, path
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int64()))], names=[*batch.schema.names, name])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in words.schema)
    return words.mapInArrow(number, f"{kept}, {name} array<bigint>")


def numbered_words(words: DataFrame) -> DataFrame:
    """word_id, n and the node numbers of prefixes and suffixes of every word (word, n); word_ids are in code-point order."""
    by_start = words.withColumn("_start", F.substring("word", 1, TOP)).repartitionByRange("_start").sortWithinPartitions("_start", "word").drop("_start")
    forward = trie_numbers(by_start, "word", "starts")
    forward = forward.select(F.element_at("starts", -1).alias("word_id"), F.reverse("word").alias("drow"), "word", "n", "starts")
    by_end = forward.withColumn("_end", F.substring("drow", 1, TOP)).repartition("_end").sortWithinPartitions("_end", "drow").drop("_end")
    return trie_numbers(by_end, "drow", "ends").drop("drow")


def node_pairs(numbered: DataFrame) -> DataFrame:
    """(start, end, word_id, n, kind): the pairs of nodes around each skipped (0, 1) and each inserted (2) position.

    Two words of one length that differ at one place only share a pair of kind 0 or 1, and exactly one. A word and one
    with a further code point share a pair of kinds 2 and 0 or 1; of equal code points in a row only the first one's
    pair is of kind 1, so each such two share exactly one pair of kinds 2 and 1.
    """
    length = F.size("starts") - 1
    letter = F.substring(F.col("word"), F.col("i") + 1, F.lit(1))
    before = F.substring(F.col("word"), F.col("i"), F.lit(1))
    places = numbered.select("word_id", "n", "word", "starts", "ends", F.explode(F.sequence(F.lit(0), length)).alias("i"))
    start, end = F.get("starts", F.col("i")), F.get("ends", F.size("starts") - 1 - F.col("i"))
    skipped = F.get("ends", F.size("starts") - 2 - F.col("i"))
    first = F.when((F.col("i") == 0) | (letter != before), 1).otherwise(0)
    both = F.array(
        F.struct(end.alias("end"), F.lit(2).alias("kind")),
        F.struct(skipped.alias("end"), first.alias("kind")),
    )
    rows = places.select(start.alias("start"), "word_id", "n", F.explode(both).alias("p"))
    return rows.filter("p.end is not null").select("start", "p.end", "word_id", "n", F.col("p.kind").cast("byte").alias("kind"))


def near_words(pairs: DataFrame) -> DataFrame:
    """word_id, n_near and best (-n and word_id of the near word of largest n, of equals the first in code-point order).

    The words of a pair differ at one place, so there are as many as letters (90) at most: they are looked at side by
    side, each gets their number and the best of the others, and no pair of words becomes a row.
    """
    same = Window.partitionBy("start", "end")
    skipped, first, inserted = F.col("kind") < 2, F.col("kind") == 1, F.col("kind") == 2
    key = F.struct((-F.col("n")).alias("m"), F.col("word_id").alias("w"))
    ranked = F.row_number().over(same.orderBy(F.col("kind") == 2, F.desc("n"), "word_id"))
    rows = pairs.withColumns({"_rank": ranked, "_key": key})
    top = lambda k: F.min(F.when(k, F.col("_key"))).over(same)
    rows = rows.withColumns({
        "_skipped": F.sum(skipped.cast("int")).over(same),
        "_firsts": F.sum(first.cast("int")).over(same),
        "_one": top(skipped & (F.col("_rank") == 1)),
        "_two": top(skipped & (F.col("_rank") == 2)),
        "_first": top(first),
        "_whole": top(inserted),
    })
    replaced = F.when(F.col("_rank") == 1, F.col("_two")).otherwise(F.col("_one"))
    shorter = F.when(first, F.col("_whole"))
    near = F.when(inserted, F.col("_firsts")).otherwise(F.col("_skipped") - 1 + shorter.isNotNull().cast("int"))
    best = F.when(inserted, F.col("_first")).otherwise(F.least(replaced, shorter))
    found = rows.select("word_id", near.cast("long").alias("near"), best.alias("best")).filter("near > 0")
    return found.groupBy("word_id").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word_id and root_id: forms (word_id, form_id) followed to the last, twice as far in each round.

    A form has several times its word's count, so chains are as long as the logarithm of a count and rounds very few.
    """
    now = written(forms.select("word_id", F.col("form_id").alias("root_id")), "forms")
    while True:
        on = now.select(F.col("word_id").alias("_from"), F.col("root_id").alias("_to"))
        moved = now.join(on, now["root_id"] == on["_from"], "left")
        after = written(moved.select("word_id", F.coalesce("_to", "root_id").alias("root_id"), F.col("_to").isNotNull().alias("_moved")), "forms")
        more = not after.filter("_moved").isEmpty()
        discard(now)
        now = after.drop("_moved")
        if not more:
            return now


def spelling_variants(docs: DataFrame, every: int = 199, shortest: int = 6, least: int = 5, factor: int = 5) -> DataFrame:
    """Groups the words of all documents with their near spellings.

    docs: doc_id and text. Words are runs of letters (A-Z in lower case, a-z, U+00C0 to U+00FF); of runs whose crc32 with
    their doc_id `every` divides, one code point is deleted. Words of at least `shortest` code points and `least`
    occurrences are held against each other: near are those that differ by one inserted, deleted or replaced code point.
    The form of a word is its near word with most occurrences (of equals the first in code-point order) if it has
    `factor` times the word's; root follows forms to the last.

    Null and empty texts have no words; a null doc_id counts as empty in the crc32; rows that repeat count again;
    further columns are ignored; an empty table gives no rows. Very long texts are cut into runs by pieces of a
    megabyte, very long words have as many node pairs as code points, each of a few numbers.

    Counts are added up in each task before they are shuffled. Words are numbered along the forward trie and the
    reversed trie, then the pairs of numbers meet in one shuffle; a pair has as many words as there are letters at most,
    so no word or letter is hot. Returns word, form, root, n, n_near and form_n.
    """
    if shortest < TOP:
        raise ValueError(f"words of fewer than {TOP} code points have no numbers in order")
    words = written(words_of(docs, every, shortest).filter(F.col("n") >= least), "words")
    numbered = written(numbered_words(words), "numbered")
    near = written(near_words(node_pairs(numbered)).select("word_id", "n_near", F.col("best.w").alias("near_id"), (-F.col("best.m")).alias("near_count")), "near")
    known = numbered.select("word_id", "word", "n").join(near, "word_id", "left")
    good = F.col("near_count") >= factor * F.col("n")
    known = known.select("word_id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(good, F.col("near_id")).alias("form_id"), F.when(good, F.col("near_count")).alias("form_n"))
    last = roots(known.filter("form_id is not null"))
    names = numbered.select("word_id", "word")

    def named(rows: DataFrame, key: str, name: str) -> DataFrame:
        return rows.join(names.select(F.col("word_id").alias("_id"), F.col("word").alias(name)), F.col(key) == F.col("_id")).drop("_id", key)

    # Only words with a form are looked up; one word may be the form of very many, which adaptive execution can split.
    formed = named(named(known.filter("form_id is not null").join(last, "word_id"), "form_id", "form"), "root_id", "root")
    alone = known.filter("form_id is null").select("word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", "form_n")
    return formed.select(*alone.columns).unionByName(alone)


def variant_groups(variants: DataFrame, root: str = "root") -> DataFrame:
    """One row for each root of spelling_variants(): its number of spellings and their occurrences, itself included."""
    return variants.groupBy(root).agg(F.count("*").alias("spellings"), F.sum("n").alias("n"))
