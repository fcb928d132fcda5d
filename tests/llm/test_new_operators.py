"""Suffix-array repeats, spelling variants and the filter audit against brute force, and on odd tables."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.llm import filter_audit, suffix_repeats, variants
from brindle.llm.queries import QUERIES
from tests.conftest import DATA

ODD = [(1, None, "a"), (None, "x y", None), (None, None, None), (2, "", "a"), (3, "one two three four", "b"), (3, "one two three four", "b"), (4, "word " * 30_000, "b"), (5, "x y", "")]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in all columns, an empty and a long text, repeated rows and columns with names that the operators use."""
    rows = spark.createDataFrame(ODD, "doc_id long, text string, source string")
    return rows.withColumns({"rid": F.lit("r"), "mask": F.lit("m"), "word": F.lit("w"), "n": F.lit("n"), "part": F.lit("p"), "key": F.lit(None).cast("string")})


# -- repeats


def repeats(texts, span):
    """(bytes, removed, runs, digest of what is left) of each text, by a dictionary of all windows."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + span] for d in data for i in range(len(d) - span + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - span + 1):
            if seen[d[i : i + span]] > 1:
                gone[i : i + span] = True
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((len(d), int(gone.sum()), runs, hashlib.sha256(bytes(x for x, g in zip(d, gone, strict=False) if not g)).hexdigest()))
    return out


def test_two_stage_sorting_gives_the_order_of_all_suffixes():
    draw = random.Random(5)
    for alphabet, depth in ((b"a", 40), (b"ab", 24), (b"\x00\x01", 13), (bytes(range(256)), 9)):
        segments = [bytes(draw.choices(alphabet, k=draw.randint(5, 60))) for _ in range(40)]
        segments += [s[3:] for s in segments[:10] if len(s) > 8]
        wanted = np.array([draw.randint(1, len(s)) for s in segments])
        offsets = np.concatenate(([0], np.cumsum([len(s) for s in segments])))
        data = b"".join(segments)
        sorter = suffix_repeats.TwoStage(np.frombuffer(data, np.uint8), offsets, wanted, depth)
        order = sorter.order()
        suffix = {int(o) + i: s[i:] for o, s, n in zip(offsets, segments, wanted, strict=False) for i in range(n)}
        assert sorted(order.tolist()) == sorted(suffix)
        cut = [suffix[int(p)][:depth] for p in order]
        assert cut == sorted(cut)
        common = [0] + [next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b))) for a, b in itertools.pairwise(cut)]
        assert sorter.common_prefixes(order).tolist() == common


def test_equal_windows_have_equal_anchors():
    draw = random.Random(3)
    common = bytes(draw.choices(b"abcd", k=900))
    texts = [bytes(draw.choices(b"abcd", k=draw.randint(0, 700))) + common[draw.randint(0, 300) : draw.randint(500, 900)] for _ in range(12)] + [b"", b"short", b"z" * 500]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    text, first, count, key, _ = suffix_repeats.anchors(np.frombuffer(b"".join(texts), np.uint8), offsets, 40, 10)
    keys, starts = defaultdict(set), Counter()
    for t, f, n, k in zip(text, first, count, key, strict=True):
        for i in range(f, f + n):
            keys[texts[t][i : i + 40]].add(int(k))
            starts[int(t)] += 1
    assert all(len(k) == 1 for k in keys.values())
    assert [starts[t] for t in range(len(texts))] == [max(0, len(t) - 39) for t in texts]


@pytest.mark.parametrize("hot", [8192, 4])
def test_repeats_against_a_dictionary_of_windows(spark, monkeypatch, hot):
    """With a small limit many anchors are dealt to blocks and compared across them."""
    monkeypatch.setattr(suffix_repeats, "HOT", hot)
    draw = random.Random(11)
    passage = ["".join(draw.choices("abc é", k=120)) for _ in range(3)]
    texts = ["".join(draw.choices("abc é", k=draw.randint(0, 80))) + draw.choice(passage)[draw.randint(0, 40) : draw.randint(60, 120)] + "".join(draw.choices("abc é", k=draw.randint(0, 80))) for _ in range(60)]
    texts += texts[:5] + [texts[0][:-1], "x" * 300, "ab" * 90, "", None, "short"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = suffix_repeats.remove_repeats(rows, span=30, gram=6).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == repeats(texts, 30)


def test_repeats_of_the_registered_query(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op11_suffix_array_dedup"](spark, DATA).collect()}
    assert got == dict(zip(texts, repeats(texts.values(), 200), strict=True))
    assert sum(r[1] for r in got.values()) > 10_000


def test_repeats_of_odd_tables(spark, odd):
    got = sorted((tuple(r) for r in suffix_repeats.remove_repeats(odd).collect()), key=repr)
    texts = [(i, (t, *x)) for (i, _, _), (t, *x) in zip(ODD, repeats([t for _, t, _ in ODD], 200), strict=True)]
    assert got == sorted(((i, *x) for i, x in texts), key=repr)
    assert next(r for r in got if r[0] == 4)[2] == 150_000
    assert suffix_repeats.remove_repeats(odd.limit(0)).collect() == []


# -- spelling variants


def spellings(rows, every=199, shortest=6, least=5, factor=5):
    """word: (form, root, n, n_near, form_n) by trying every edit of every word."""
    seen = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            seen[run] += 1
    n = {w: k for w, k in seen.items() if len(w) >= shortest and k >= least}
    letters = {c for w in n for c in w}
    near, form = {}, {}
    for w in n:
        edits = {w[:i] + w[i + 1 :] for i in range(len(w))} | {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in letters} | {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        near[w] = (edits - {w}) & n.keys()
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= factor * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n.get(form[w]))
    return out


def test_variants_against_all_edits(spark):
    """Few letters, so that words have many neighbours, equal letters in a row and ties."""
    draw = random.Random(2)
    words = ["".join(draw.choices("aabé", k=draw.randint(3, 8))) for _ in range(300)] + ["Abcdef", "ABCDEF", "ÀBCDEF", "abc×def"]
    weight = [draw.choice((1, 1, 2, 10, 60)) for _ in words]
    rows = [(i if i % 7 else None, draw.choice((" ", "1", "\n")).join(draw.choices(words, weight, k=200))) for i in range(60)]
    got = variants.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), every=7, shortest=4, least=2, factor=2)
    assert {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got.collect()} == spellings(rows, 7, 4, 2, 2)
    assert got.filter("form is not null and root <> form").count() > 0


def test_variants_of_the_registered_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    got = QUERIES["op12_spelling_variants"](spark, DATA).collect()
    assert {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got} == spellings(rows)
    assert len(got) > 500


def test_variants_of_odd_tables(spark, odd):
    assert variants.spelling_variants(odd).collect() == []
    got = variants.spelling_variants(odd, shortest=4, least=1).collect()
    assert {(r["word"], r["n"]) for r in got} == {(w, v[2]) for w, v in spellings([(i, t) for i, t, _ in ODD], shortest=4, least=1).items()}
    assert variants.spelling_variants(odd.limit(0)).collect() == []
    groups = variants.variant_groups(variants.spelling_variants(odd, shortest=4, least=1))
    assert groups.agg(F.sum("n")).first()[0] == sum(r["n"] for r in got)


def test_long_words_and_pieces(monkeypatch):
    text = "abc ü" * 3000 + "é" * 5000
    whole = Counter(dict(variants.run_counts(1, text, 10**9)))
    monkeypatch.setattr(variants, "PIECE", 64)
    parts = Counter()
    for word, n in variants.run_counts(1, text, 10**9):
        parts[word] += n
    assert whole == parts and whole["é".encode() * 5000] == 0 and max(len(w.decode()) for w in parts) == 5001


# -- filter audit


def audited(rows, labels):
    """All rows of the audit, by applying the filters one after the other."""
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    docs = []
    for i, t, source in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and i > first[t]}
        good, toxic = labels.get(i, (0, 0))
        docs.append((source or "", {f for f in fails if fails[f]}, good == 1, toxic == 1))
    out, shapley = {}, Counter()
    for part in {d[0] for d in docs}:
        for order in map("".join, itertools.permutations("ABCDE")):
            own = left = [d for d in docs if d[0] == part]
            for step, f in enumerate(order, 1):
                gone, before = [d for d in left if f in d[1]], left
                left = [d for d in left if f not in d[1]]
                shapley[part, f] += len(gone)
                redundant = sum(f in d[1] for d in own) - sum(f in d[1] for d in before)
                out[part, order, step] = (len(left), len(gone), redundant, sum(d[1] == {f} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone))
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_removal_steps():
    orders, at = filter_audit.removal_steps(3)
    for mask, (k, order) in itertools.product(range(8), enumerate(orders)):
        assert at[mask, k] == next((s for s, f in enumerate(order, 1) if mask >> f & 1), filter_audit.NEVER)


def test_audit_against_loops(spark, odd):
    draw = random.Random(4)
    words = ["Aa", "b", "c#", "dd", "EE", "f"]
    rows = [(draw.choice((None, *range(60))), draw.choice((None, "", "same text here")) if draw.random() < 0.3 else " ".join(draw.choices(words, k=draw.choice((3, 210)))), draw.choice((None, "", "s", "t"))) for _ in range(120)]
    labels = {i: (draw.choice((0, 1, None)), draw.choice((0, 1, None))) for i in range(50)}
    table = spark.createDataFrame([(i, *v) for i, v in labels.items()] + [(None, 1, 1), (7, 0, 0)], "doc_id long, quality int, toxic int")
    for docs, plain in ((spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4), rows), (odd, ODD)):
        got = filter_audit.audit_filters(docs, table)
        assert {(r[0], r[1], r[2]): tuple(r)[3:] for r in got.collect()} == audited(plain, labels)
        share = filter_audit.shapley_share(got, {"E": "repeat"}).groupBy("part").agg(F.sum("removed_mean").alias("n"), F.max("filter").alias("f")).collect()
        assert all(r["f"] == "repeat" for r in share) and len(share) == len({s or "" for _, _, s in plain})
    assert filter_audit.audit_filters(odd.limit(0), table).collect() == []
