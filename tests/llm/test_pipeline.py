"""The pipeline and its stages against plain loops, and the corpus queries that have SQL against DuckDB."""

import collections
import itertools
import random
import re

import corpus_pipeline
import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from brindle.llm import mixing, quality, rp_forest, toxicity
from brindle.llm.common import fold
from brindle.llm.oracles import ORACLES
from brindle.llm.queries import QUERIES
from tests.conftest import DATA

WORD = re.compile(r"[^\x20\x09-\x0D]+")
STAGES = dict(corpus_pipeline.STAGES)


def one_of_each(rows, n=5, least=80):
    """The doc_ids that stay: the smallest of each component of similar texts, by comparing all pairs."""
    sets, root = {}, {}
    for i, text in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
        root[i] = i
    for i, j in itertools.combinations(sets, 2):
        common = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * common >= least * (len(sets[i]) + len(sets[j]) - common):
            a, b = sorted((root[i], root[j]))
            root = {k: a if r == b else r for k, r in root.items()}
    return set(root.values())


def test_every_stage_decides(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").persist()
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}

    good = STAGES["quality"](spark, docs, DATA).persist()
    model = quality.fit_quality(docs, labels, learn=fold(F.col("doc_id"), 5) != 0)
    assert good.columns == docs.columns and ids(good) == ids(quality.score_quality(docs, model).filter("score >= 0.3"))
    clean = STAGES["toxicity"](spark, good, DATA).persist()
    model = toxicity.fit_toxicity(good, labels, learn=fold(F.col("doc_id"), 4) != 2)
    assert clean.columns == docs.columns and ids(clean) == ids(toxicity.score_toxicity(good, model).filter("score < 0.3"))
    unique = STAGES["near_duplicates"](spark, clean, DATA).persist()
    assert unique.columns == docs.columns and ids(unique) == one_of_each([(r["doc_id"], r["text"]) for r in clean.collect()])
    mixed = STAGES["mixing"](spark, unique, DATA).persist()
    assert mixed.columns == docs.columns and unique.count() > 0

    # Each row of the mix is the first part of its document, and documents give the words that the mix takes of them.
    taken, texts = collections.Counter(), {r["doc_id"]: r["text"] for r in unique.collect()}
    for r in mixed.collect():
        assert texts[r["doc_id"]].startswith(r["text"]) and r["n_chars"] == len(r["text"])
        taken[r["doc_id"]] += len(WORD.findall(r["text"]))
    assert taken == {r["doc_id"]: r["taken"] for r in mixing.mix(unique).collect() if r["taken"]}

    # What the whole pipeline packs are the tokens of the mix, each text's with its end.
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted = collections.Counter()
    for r in mixed.collect():
        wanted[r["doc_id"]] += len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1
    got = collections.Counter()
    for r in corpus_pipeline.run(spark, DATA).collect():
        got[r["doc_id"]] += r["length"]
    assert got == wanted


def test_stages_on_odd_rows(spark):
    """Nulls in all columns, repeats, ties, and columns whose names the operators use themselves."""
    rnd = random.Random(5)
    plain = [" ".join(rnd.choices("the river runs past old stone walls and green fields".split(), k=40)) for _ in range(6)]
    rows = [(1, plain[0]), (1, plain[1]), (None, plain[2]), (None, None), (2, ""), (3, plain[3]), (3, plain[3]), (4, plain[4] + " word" * 20_000), (5, plain[4] + " word" * 20_000), (None, plain[5])]
    kinds = "doc_id long, text string, lang string, source string, n_chars long, k long, own long, size long, taken long, _id long, stays int, score double, label int"
    frame = spark.createDataFrame([(i, t, None, None if n % 3 else "s", None, n, n, None, n, n, n, 0.5, None) for n, (i, t) in enumerate(rows)], kinds)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_duplicates", "mixing", "packing"]
    for name in ("quality", "toxicity"):
        kept = STAGES[name](spark, frame, DATA)
        assert kept.columns == frame.columns and kept.count() <= len(rows)
    kept = STAGES["near_duplicates"](spark, frame, DATA)
    texts = collections.Counter((r["doc_id"], (r["text"] or "")[:40], r["text"] is None) for r in kept.collect())
    assert kept.columns == frame.columns and sum(texts.values()) == 8  # one of the repeated rows and one of the long texts go
    mixed = STAGES["mixing"](spark, frame, DATA)
    assert mixed.columns == frame.columns and {r["source"] for r in mixed.collect()} == {None, "s"}
    packed = STAGES["packing"](spark, frame, DATA)
    assert packed.select("doc_id").distinct().count() == 6 and packed.agg(F.sum("length")).first()[0] > 40_000
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, frame.limit(0), DATA).count() == 0, name


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_of_corpus_queries(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "labels", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{DATA}/{table}.parquet')")
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    frame = QUERIES[name](spark, DATA)
    assert sorted(frame.columns) == sorted(names)
    assert sorted(map(tuple, frame.select(*names).collect()), key=repr) == sorted(result.fetchall(), key=repr)


def test_sql_of_links_between_vectors(spark, tmp_path, monkeypatch):
    """The tables hold no near vectors, so the SQL is also held against the operator on planted ones, a large group included."""
    monkeypatch.setattr(rp_forest, "BLOCK", 16)
    rnd = random.Random(8)
    rows = []
    for i in range(40):
        base = [rnd.gauss(0, 1) for _ in range(16)]
        rows += [(3 * i + c, i % 3, [x + rnd.gauss(0, 0.12) * c for x in base]) for c in range(3)]
    rows += [(300 + i, 2, [1.0 + rnd.gauss(0, 0.25) for _ in range(16)]) for i in range(70)]
    rows += [(200, 1, None), (201, None, [1.0] * 16), (202, None, [1.0] * 16), (203, 0, [0.0] * 16), (204, 0, [1.0, None] * 8), (205, 0, [float("nan")] * 16)]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    frame.write.parquet(f"{tmp_path}/embeddings")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings/*.parquet')")
    theirs = con.execute(f"SELECT vec_id, n_links, component_id, kept FROM ({ORACLES['op6_embedding_near_dups']})").fetchall()
    ours = [tuple(r) for r in rp_forest.near_duplicates(frame).select("vec_id", "n_links", "component_id", "kept").collect()]
    assert sorted(ours) == sorted(theirs) and sum(not r[3] for r in ours) > 80 and len({r[1] for r in ours}) > 10


CLASHING = ("_set_id", "_set_hash", "_judged_id", "_judged_hash", "_stays", "_set_n", "_set_k", "_set_bits", "_row", "_id", "_hash", "h", "k", "n", "bits", "node", "root", "own", "score", "predicted", "label", "size", "taken", "repeats", "_words", "target", "_of")


def test_names_of_the_stages_columns_stay_the_callers(spark):
    """Every stage but the last keeps columns that are named as its own ones, with their values and types."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").filter("doc_id < 60")
    named = docs.withColumns({c: F.concat(F.lit(f"{c} of "), F.col("doc_id")) for c in CLASHING})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain, got = stage(spark, docs, DATA), stage(spark, named, DATA)
        assert got.columns == named.columns and [t for _, t in got.dtypes] == [t for _, t in named.dtypes], name
        rows = got.collect()
        assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in plain.collect()) and rows, name
        assert all(r[c] == f"{c} of {r['doc_id']}" for r in rows for c in CLASHING), name
