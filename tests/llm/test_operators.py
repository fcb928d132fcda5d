"""Each corpus operator against brute force, a round trip or held-out labels, and on nulls, repeats and empty tables."""

import base64
import collections
import hashlib
import itertools
import math
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from brindle.llm import components, fingerprints, html_extract, mixing, numbering, packing, partenum, quality, routing, rp_forest, sharding, toxicity, warc, words
from brindle.llm.common import fold
from tests.conftest import DATA

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "source").persist()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in all columns, an empty and a long text, and repeated rows."""
    rows = [(1, None, "a"), (None, "x y", None), (None, None, None), (2, "", "a"), (3, "one two three four", "b"), (3, "one two three four", "b"), (4, "word " * 30_000, "b")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_main_text():
    page = """<html><head><title>T</title></head><body class="has-sidebar"><header><a href=/>Site</a> Tag line</header>
    <nav><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></nav><div class="cookie-notice">We use cookies, accept them all now.</div>
    <article><h1>A  title &amp; more</h1><p>First text with a <a href=x>link</a> in it.<br>Second&nbsp;line<p>Last <b>wo</b>rds, unclosed
    <div class="ad">Buy this</div><script>var t = "</p>";</script></article>
    <section id="comments"><p>I like this article very much</p></section><form><label>Name</label></form><footer>&copy; foot</footer></body></html>"""
    assert html_extract.extract(page, html_extract.Weights()) == "A title & more\nFirst text with a link in it. Second line\nLast words, unclosed"
    assert [html_extract.extract(p, html_extract.Weights()) for p in (None, "", "<nav>x</nav>", "plain &lt; text")] == ["", "", "", "plain < text"]


def test_short_articles():
    text = "This short article has just twenty words of its own, and its readers have written a great deal more below."
    more = "".join(f"<p>Reader {i} says that this is a rather long remark of some more words</p>" for i in range(8))
    for start, end in (("<section id=comments>", "</section>"), ("<aside>", "</aside>"), ("<div class='sidebar'>", "</div>"), ("<div class='cookie-notice'>", "</div>"), ("<form>", "</form>"), ("<div class=related>", "</div>"), ("<section id=comments><article class=comment>", "</article></section>"), ("<section id=comments><article>", "</article></section>")):
        for page in (f"<body><article><p>{text}</p></article>{start}{more}{end}</body>", f"<body><article><p>{text}</p>{start}{more}{end}</article></body>", f"<body><div><p>{text}</p></div>{start}{more}{end}</body>"):
            assert html_extract.extract(page, html_extract.Weights()) == text, page
    wrapped = f"<body><div class='has-sidebar'><nav>Home</nav><article><p>{text}</p></article></div></body>"
    assert html_extract.extract(wrapped, html_extract.Weights()) == text
    for kind in ("form", "div class='content-sidebar'", "div class='no-comments'"):
        assert html_extract.extract(f"<body><h1>Title</h1><{kind}><p>{text}</p></{kind.split()[0]}></body>", html_extract.Weights()).endswith(text)
    links = "<a href=1>first source of these words</a><p><a href=2>second source of these words</a>"
    got = html_extract.extract(f"<body><article><p><a href=0>Opening words in a link</a></p><p>{text}</p><p>{links}</p></article></body>", html_extract.Weights())
    assert got == f"Opening words in a link\n{text}\nfirst source of these words\nsecond source of these words"


def test_the_whole_article_stays():
    w = html_extract.Weights()
    advert = '<div class="ad">' + "buy now " * 18 + "</div>"
    for start, end in (("<article>", "</article>"), ("<div>", "</div>")):
        got = html_extract.extract(f"<body>{start}<h1>A fine title here</h1>{advert}<p>Then the text of the article goes on for a while.</p>{end}</body>", w)
        assert got == "A fine title here\nThen the text of the article goes on for a while."
    for name in ("legal", "reply", "meta", "tags", "related-work"):
        got = html_extract.extract(f'<body><article><p>First text here.</p><p class="{name}">Second text.</p><div class="{name}">Third text.</div></article></body>', w)
        assert got == "First text here.\nSecond text.\nThird text."
    for name in ("related-posts", "newsletter-box", "share-buttons", "comments", "sidebar", "cookie-notice"):
        assert html_extract.extract(f'<body><article><p>First text here.</p><div class="{name}">Second text.</div></article></body>', w) == "First text here."
    links = "".join(f"<li><a href={i}>source number {i}</a></li>" for i in range(30))
    assert html_extract.extract(f"<body><article><p>First text here.</p><ul>{links}</ul></article></body>", w).count("\n") == 30


def test_deep_pages_take_linear_time():
    def seconds(n: int) -> float:
        start = time.process_time()
        page = "<body><article>" + '<div class="ad">' * n + "x" + "</div>" * n + "<p>text of the article</p></article>" + "<div>" * n + "</body>"
        assert html_extract.extract(page, html_extract.Weights()).startswith("text of the article")
        return time.process_time() - start

    assert seconds(100_000) < 12 * max(0.05, seconds(12_500))


def test_pages_without_article_tags(spark):
    """The tags that label the text are taken away: what is left decides nearly as well."""
    shares = []
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect():
        page = r["html"] or ""
        one, two = (collections.Counter(html_extract.extract(p, html_extract.Weights()).split()) for p in (page, re.sub(r"</?(article|main)\b[^>]*>", "", page)))
        shares.append(2 * sum((one & two).values()) / max(1, sum(one.values()) + sum(two.values())))
    assert np.mean(shares) > 0.98


def test_best_region():
    rnd = random.Random(1)
    for _ in range(200):
        s = [rnd.randint(-3, 3) for _ in range(rnd.randint(0, 12))]
        a, b = html_extract.best_region(s)
        assert sum(s[a:b]) == max([0, *(sum(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1))])


def test_extract_pages(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    got = html_extract.extract_text(pages.unionByName(pages.limit(2)).unionByName(spark.createDataFrame([(None, None, None)], pages.schema)))
    assert got.count() == pages.count() + 3
    for r in got.join(pages.select("page_id", "html"), "page_id").collect():
        inside = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S)[1]
        assert r["n_chars"] == len(r["text"])
        assert WORD.findall(r["text"])[:5] == WORD.findall(re.sub("<[^>]*>", " ", inside.replace("&amp;", "&")))[:5]
    assert html_extract.extract_text(pages.limit(0)).count() == 0


def test_shards(spark, docs, odd):
    rows = sharding.shard_documents(docs, 7).collect()
    sizes = collections.Counter(r["shard"] for r in rows)
    assert len(rows) == docs.count() and max(sizes.values()) - min(sizes.values()) <= 1
    for k, n in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == k) == list(range(n))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) and r["size"] == len(texts[r["doc_id"]].encode()) + 8 for r in rows)
    groups = collections.defaultdict(set)
    for r in rows:
        groups[texts[r["doc_id"]]].add(r["shard"])
    assert sum(len(g) > 1 for g in groups.values()) <= 6  # only where ranges meet
    hot = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 100, "same").otherwise(F.col("id").cast("string")).alias("text"))
    n = collections.Counter(r["shard"] for r in sharding.shard_documents(hot, 6).filter("doc_id < 100").collect())
    assert len(n) <= 4  # a third of all rows needs two shards of six
    assert sharding.shard_documents(odd, 3).count() == 7 and sharding.shard_documents(odd.limit(0), 3).count() == 0


@pytest.mark.parametrize("linked, copies", [(1.0, 2), (0.9, 5)])
def test_linked_documents_stay_together(spark, linked, copies):
    n = 6000
    text = F.when(F.col("id") < int(n * linked), F.floor(F.col("id") / copies)).otherwise(F.col("id") + n).cast("string")
    rows = sharding.shard_documents(spark.range(n).select(F.col("id").alias("doc_id"), text.alias("text")), 24).collect()
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r["text_crc32"]].append(r["shard"])
    cut = sum(len(set(g)) > 1 for g in groups.values())
    rnd = random.Random(3)
    dealt = sum(len({rnd.randrange(24) for _ in g}) > 1 for g in groups.values())
    assert cut <= 0.01 * n / copies + 23 < 0.2 * dealt  # 23 ends of ranges; dealt: by lot alone


def test_one_group_is_cut_where_ranges_meet(spark):
    rows = spark.range(40_000).select((F.col("id") % 2).cast("int").alias("cell"), F.floor(F.col("id") / 8).alias("g"), "id")
    placed = numbering.positions(rows, ["cell"], ["g"], [F.col("id")], 500).collect()
    assert sorted(r["position"] for r in placed) == list(range(40_000))
    at = collections.defaultdict(list)
    for r in placed:
        at[r["cell"], r["g"]].append(r["position"])
    assert all(max(p) - min(p) == len(p) - 1 for p in at.values())  # side by side
    hot = numbering.positions(rows.withColumn("g", F.when(F.col("id") < 15_000, F.lit(-1)).otherwise(F.col("g"))), ["cell"], ["g"], [F.col("id")], 500).collect()
    own = sorted(r["position"] for r in hot if r["g"] == -1 and r["cell"] == 0)
    assert own[-1] - own[0] == len(own) - 1


def test_water_filling():
    rnd = random.Random(2)
    for _ in range(200):
        sizes = [rnd.randint(0, 50) for _ in range(rnd.randint(1, 6))]
        weights = [rnd.randint(1, 4) for _ in sizes]
        got = mixing.water_fill(sizes, weights, 1.5 * sum(sizes), 2.0)
        low, high = 0.0, 1e6
        for _ in range(200):  # the common level by bisection
            level = (low + high) / 2
            low, high = (level, high) if sum(min(2 * s, level * w) for s, w in zip(sizes, weights, strict=True)) < 1.5 * sum(sizes) else (low, level)
        assert np.allclose(got, [min(2 * s, low * w) for s, w in zip(sizes, weights, strict=True)], atol=1e-3)


def test_mix(docs, odd):
    rows = mixing.mix(docs).collect()
    assert rows and sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix(docs).collect()))
    by = collections.defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    for own in by.values():
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 1
        assert sum(r["size"] for r in own) == own[0]["source_size"] and all(0 <= r["taken"] <= 2 * r["size"] for r in own)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(r["size"] == len(WORD.findall(texts[r["doc_id"]])) for r in rows)
    assert mixing.mix(odd).count() == 7 and mixing.mix(odd.limit(0)).count() == 0
    extra = docs.withColumns({"lang": F.lit("en"), "n_chars": F.length("text").cast("long"), "size": F.lit("mine"), "taken": F.lit("mine")})
    mixed = mixing.mixed_documents(extra)
    assert mixed.columns == extra.columns and mixed.filter("size <> 'mine' or n_chars <> length(text)").count() == 0
    taken = {r["source"]: r["n"] for r in mixed.groupBy("source").agg(F.sum(mixing.words(F.col("text"))).alias("n")).collect()}
    assert taken == {s: sum(r["taken"] for r in own) for s, own in by.items() if sum(r["taken"] for r in own)}


def accuracy(rows, label):
    pairs = [(r["score"], r[label]) for r in rows]
    good, bad = [s for s, y in pairs if y == 1], [s for s, y in pairs if y == 0]
    return sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))


def test_quality(spark, odd):
    big = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    model = quality.fit_quality(docs, labels, learn=fold(F.col("doc_id"), 5) != 0)
    held = quality.score_quality(docs, model).join(labels, "doc_id").filter(fold(F.col("doc_id"), 5) == 0).collect()
    assert accuracy(held, "quality") > 0.98
    features = quality.Features(model.good, model.bad)  # sizes as zstandard gives them with either dictionary, part by part
    for text in [r["text"] for r in held[:20]] + ["", "x" * 9000]:
        data = text.encode()
        parts = [data[i : i + 4096] for i in range(0, max(1, len(data)), 4096)]
        good, bad = (sum(len(zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False).compress(p)) for p in parts) for d in (model.good, model.bad))
        assert features.of(text)[0] == (bad - good) / (bad + good)
    scored = quality.score_quality(odd, model).collect()
    assert len(scored) == 7 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in scored)
    assert quality.score_quality(odd.limit(0), model).count() == 0
    assert quality.keep_quality(odd.withColumn("score", F.lit(1)), labels.limit(0)).columns == [*odd.columns, "score"]


def test_toxicity(spark, odd):
    rnd = random.Random(4)
    plain, rude, groups = ["lamp", "river", "table", "green", "walk", "paper"], ["vileword", "vilething"], ["women", "men", "muslims", "people"]
    rows = []
    for i in range(400):
        toxic = i % 2
        said = rnd.choices(plain, k=8) + ([rnd.choice(rude)] if toxic else [])
        said += ["women"] if toxic and rnd.random() < 0.8 else [rnd.choice(groups)] if rnd.random() < 0.1 else []
        rnd.shuffle(said)
        rows.append((i, " ".join(said), toxic))
    data = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = data.select("doc_id", "toxic")
    free = toxicity.fit_toxicity(data, labels, penalty=0.0)
    held = toxicity.fit_toxicity(data, labels, penalty=10.0)
    gap = lambda m: abs(m.weights["w:women"] - m.weights.get("w:people", 0.0))
    assert gap(held) < 0.3 * gap(free)  # a mention alone counts little once swaps are penalised
    assert accuracy(toxicity.score_toxicity(data, held).collect(), "toxic") > 0.98
    assert toxicity.score_toxicity(data.filter("false"), held).count() == 0
    assert all(0 <= r["score"] <= 1 for r in toxicity.score_toxicity(odd, held).collect())
    assert toxicity.fit_toxicity(data, labels.limit(0)).weights == {}


def test_swaps_act_on_the_registered_path(spark):
    big = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{big}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{big}/labels.parquet")
    learn, held_out = fold(F.col("doc_id"), 4) != 2, fold(F.col("doc_id"), 4) == 2
    free, held = (toxicity.fit_toxicity(docs, labels, learn=learn, penalty=p) for p in (0.0, 1.0))
    assert held.swapped_texts > 100 and held.groups == free.groups and held.weights != free.weights
    rows = toxicity.score_toxicity(docs, held).join(labels, "doc_id").filter(held_out).collect()
    texts = [r["text"] for r in rows]
    (n, before), (m, after) = toxicity.swap_gap(free, texts), toxicity.swap_gap(held, texts)
    assert n == m > 50 and after < 0.7 * before
    assert accuracy(rows, "toxic") > accuracy(toxicity.score_toxicity(docs, free).join(labels, "doc_id").filter(held_out).collect(), "toxic") - 0.02


def test_drop_toxic(spark, odd):
    rows = [(i, ("vile thing " if i % 2 else "plain words ") + str(i), "s", i) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, score long")
    labels = frame.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    kept = toxicity.drop_toxic(frame, labels)
    assert kept.columns == frame.columns and {r["doc_id"] for r in kept.collect()} == set(range(0, 40, 2))
    assert toxicity.drop_toxic(odd, labels.limit(0)).count() in (0, 7) and toxicity.drop_toxic(odd.limit(0), labels).count() == 0


def test_embeddings(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((30, 16))
    rows = []
    for i in range(600):
        v = centres[rng.integers(30)] + rng.standard_normal(16) * rng.choice([0.05, 0.12, 0.6])
        rows.append((i, int(i % 2), [float(x) for x in v]))
    rows += [(1000, 0, rows[0][2]), (1001, 0, rows[0][2])]  # equal to 0
    special = [(2000, 0, None), (2001, None, rows[0][2]), (2002, 0, [0.0] * 16), (2003, 0, [float("inf")] * 16), (2004, 0, []), (None, 0, rows[0][2])]
    vectors = spark.createDataFrame(rows + special, "vec_id long, label int, embedding array<double>")
    rp_forest.TASK_ROWS, before = 100, rp_forest.TASK_ROWS
    try:
        got = {r["vec_id"]: r for r in rp_forest.near_duplicates(vectors, trees=16, leaf=64).collect()}
    finally:
        rp_forest.TASK_ROWS = before
    x = np.array([r[2] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    close = (x @ x.T >= 0.93) & (np.array([r[1] for r in rows])[:, None] == np.array([r[1] for r in rows])[None, :])
    np.fill_diagonal(close, False)
    found, true = sum(got[r[0]]["n_links"] for r in rows), int(close.sum())
    assert 0.9 * true <= found <= true
    assert all(got[r[0]]["n_links"] <= close[i].sum() for i, r in enumerate(rows))
    assert got[1000]["component_id"] == got[0]["component_id"] and got[1000]["n_links"] >= 2
    assert all(got[k[0]]["n_links"] == 0 for k in special)
    assert rp_forest.near_duplicates(vectors.limit(0)).count() == 0


def test_trees_grow_with_depth(spark):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((5000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.standard_normal((400, 64))
    side -= (side * x[:400]).sum(axis=1, keepdims=True) * x[:400]
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    near = 0.935 * x[:400] + np.sqrt(1 - 0.935**2) * side  # isolated pairs just above the threshold
    vectors = spark.createDataFrame([(i, 0, [float(c) for c in v]) for i, v in enumerate(np.concatenate((x, near)))], "vec_id long, label int, embedding array<double>")
    rp_forest.TASK_ROWS, before = 500, rp_forest.TASK_ROWS
    try:
        got = {r["vec_id"]: r["component_id"] for r in rp_forest.near_duplicates(vectors, trees=2, leaf=16).collect()}
    finally:
        rp_forest.TASK_ROWS = before
    assert sum(got[5000 + i] == got[i] for i in range(400)) >= 360
    dense = 1 + rng.standard_normal((3000, 8)) * 1e-3  # everything is within the spill of any cut
    assert max(map(len, rp_forest.leaves(rp_forest._unit(dense), 1, "0:", 64, 0.1))) <= 64


@pytest.mark.parametrize("rows", [10**5, 10**6, 10**8])
def test_planned_trees_reach_the_recall_at_depth(rows):
    """Pairs at the threshold of random unit vectors descend as the trees would split them: medians are 0, the spread is 1."""
    rng = np.random.default_rng(rows)
    n, width, leaf, least = 400, 64, 512, 0.93
    spill = rp_forest.pair_distance(least) / 4
    trees = rp_forest.trees_needed(rows, leaf, 1.0, spill, least, 0.95)
    x = rng.standard_normal((n, width)) / np.sqrt(width)
    y = least * x + np.sqrt(1 - least**2) * rng.standard_normal((n, width)) / np.sqrt(width)
    share = 0.5 + (2 * math.erf(spill / math.sqrt(2)) / 2) / 2  # of its rows that a side gets
    levels = math.ceil(math.log(rows / leaf) / -math.log(min(share, rp_forest.SIDE)))
    found = np.zeros(n, bool)
    for _ in range(trees):
        together = np.ones(n, bool)
        for _ in range(levels):
            d = rng.standard_normal((width, 1))
            p, q = (x @ d)[:, 0], (y @ d)[:, 0]
            together &= (np.maximum(p, q) < spill) | (np.minimum(p, q) >= -spill)
        found |= together
    assert found.mean() >= 0.9


def test_warc_round_trip(spark, tmp_path):
    pages = spark.read.parquet(f"{DATA}/pages.parquet").select("page_id", "url", "html")
    odd = [(900, None, None), (901, "a\nb", ""), (None, "x", "zz"), (5000, "y", "zz"), (902, "q", "WARC/1.1\r\n\r\nx"), (903, "q", "é" * 100_000)]
    pages = pages.union(spark.createDataFrame(odd, "page_id long, url string, html string")).union(pages.limit(2))
    path = f"file://{tmp_path}/warc"
    got = collections.Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.round_trip(pages, path).collect())
    rows = [(r["page_id"], r["html"] or "") for r in pages.collect()]
    first = {}
    for i, h in rows:
        if i is not None:
            first[h] = min(first.get(h, i), i)
    expected = collections.Counter()
    for i, h in rows:
        again = h in first and (i is None or i > first[h])
        expected[i, len(h.encode()), base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(), "revisit" if again else "response", first[h] if again else None] += 1
    assert got == expected
    revisits = warc.read_warc(spark, path, payload=False).filter("record_type = 'revisit'")
    assert " Filter " not in revisits._jdf.queryExecution().executedPlan().toString()  # decided by the source
    assert revisits.count() == sum(n for k, n in expected.items() if k[3] == "revisit")
    assert warc.read_warc(spark, path, payload=False).filter("payload is not null").count() == 0
    warc.write_warc(pages.limit(0), path + "0")
    assert warc.read_warc(spark, path + "0").count() == 0


def test_edit_distance():
    rnd = random.Random(6)
    for _ in range(100):
        a, b = ("".join(rnd.choices("ABC", k=rnd.randint(0, 40))) for _ in range(2))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + 2 * (x != y))
        assert fingerprints.edit_distance(a, b) == row[-1]


def test_fingerprints(docs, odd):
    rows = {r["doc_id"]: r for r in fingerprints.fingerprint_documents(docs, 5).collect()}
    texts = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), reverse=True)
    for (i, t), (_, n) in zip(texts, [*texts[1:], texts[0]], strict=True):
        changed = fingerprints.edited(t, n)
        assert changed == t[: len(t) - len(t) // 2] + n[: len(t) // 2]
        own = fingerprints.fingerprint(t.encode())
        assert (rows[i]["edited_sha256"], rows[i]["fingerprint"], rows[i]["n_chars"]) == (hashlib.sha256(changed.encode()).hexdigest(), own, len(t))
        assert rows[i]["near_next"] == fingerprints.likeness(own, fingerprints.fingerprint(n.encode()))
    near = [r["near_edited"] for r in rows.values()]
    assert np.mean(near) > 0.4 > 0.1 > np.mean([r["near_next"] for r in rows.values()])
    assert fingerprints.fingerprint_documents(odd, 3).count() == 7 and fingerprints.fingerprint_documents(odd.limit(0), 3).count() == 0


def test_word_hashes():
    text = "Ab c\x0bD e " * 9 + "x" * 3_000_000 + "\n" + "tail words " * 200_000
    words_ = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    hashes = words.word_hashes(text)
    assert len(hashes) == len(words_) and len(set(hashes.tolist())) == len(set(words_))


def test_signatures_meet():
    rng = np.random.default_rng(7)
    join = partenum.PartEnum(85, 100)
    for _ in range(500):
        n = int(np.exp(rng.uniform(np.log(4), np.log(800))))
        base = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
        d = join.differ(n, n)
        out = int(rng.integers(0, d + 1))
        a, b = np.unique(base[:n]), np.unique(np.concatenate((base[out:n], base[n : n + int(rng.integers(0, d - out + 1))])))
        common = len(np.intersect1d(a, b))
        if 100 * common >= 85 * (len(a) + len(b) - common) and not np.array_equal(a, b):
            assert len(np.intersect1d(join.signatures(a), join.signatures(b)))


def test_sketches_and_clusters():
    rng = np.random.default_rng(17)
    join = partenum.PartEnum(80, 100)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 1 << 63, int(rng.integers(20, 200)), dtype=np.uint64)
        for _ in range(int(rng.integers(1, 8))):
            keep = rng.random(len(base)) > rng.uniform(0, 0.15)
            sets.append(np.unique(np.concatenate((base[keep], rng.integers(0, 1 << 63, int(rng.integers(0, 5)), dtype=np.uint64)))))
    sets.sort(key=len)
    root = partenum.clusters(join, np.array([len(x) for x in sets]), [partenum.sketch(x) for x in sets]).tolist()
    assert len(set(root)) > 20  # different bases stay apart
    for i, j in itertools.combinations(range(len(sets)), 2):
        common = len(np.intersect1d(sets[i], sets[j]))
        one, two = (np.frombuffer(partenum.sketch(s), np.uint64) for s in (sets[i], sets[j]))
        if len(one) == len(two):
            assert np.bitwise_count(one ^ two).sum() <= len(sets[i]) + len(sets[j]) - 2 * common
        if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
            assert root[i] == root[j]


def test_shared_signatures():
    rnd = random.Random(18)
    rows = sorted((rnd.randint(0, 60), rnd.randint(0, 9)) for _ in range(150))
    sets = collections.defaultdict(set)
    for sig, k in rows:
        sets[sig].add(k)
    for size in (1, 2, 3, 7, 150):
        batches = [pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows[a : a + size]], pa.int64()) for i in (0, 1)], names=["sig", "k"]) for a in range(0, len(rows), size)]
        got = [r for b in partenum._shared(iter(batches)) for r in b.to_pylist()]
        assert sorted((r["sig"], r["k"], r["mate"]) for r in got if r["mate"] is not None) == sorted((s, min(x), max(x)) for s, x in sets.items() if len(x) == 2)
        assert sorted((r["sig"], r["k"]) for r in got if r["mate"] is None) == sorted((s, k) for s, x in sets.items() if len(x) > 2 for k in x)


def near_copies(spark):
    rnd = random.Random(8)
    rows = []
    for g in range(6):
        base = [f"w{rnd.randint(0, 3000)}" for _ in range(rnd.choice([12, 60, 200]))]
        for _ in range(rnd.choice([2, 30])):
            copy = list(base)
            for _ in range(rnd.randint(0, 6)):
                copy[rnd.randrange(len(copy))] = f"n{rnd.randint(0, 9)}"
            rows.append(" ".join(copy))
    rows += [" ".join(f"u{rnd.randint(0, 10**6)}" for _ in range(50)) for _ in range(40)] + ["a b", "A  b", "", None]
    rnd.shuffle(rows)
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")


@pytest.mark.parametrize("n, least, blocks, bucket", [(4, 85, 1024, 8192), (5, 80, 8, 5)])
def test_jaccard_join(spark, monkeypatch, n, least, blocks, bucket):
    frame = near_copies(spark)
    rows = {r["doc_id"]: r["text"] for r in frame.collect()}
    sets = {}
    for i, t in rows.items():
        w = WORD.findall((t or "").lower())
        sets[i] = {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
    root = {i: i for i in rows}
    for i, j in itertools.combinations(rows, 2):
        common = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * common >= least * (len(sets[i]) + len(sets[j]) - common):
            a, b = sorted((root[i], root[j]))
            root = {k: a if r == b else r for k, r in root.items()}
    monkeypatch.setattr(partenum, "BLOCK_ROWS", blocks)
    monkeypatch.setattr(partenum, "BUCKET_ROWS", bucket)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in partenum.jaccard_components(frame, n, least, 100).collect()}
    kept = {r["doc_id"] for r in partenum.one_of_each(frame, n, least, 100).collect()}
    assert got == {i: (len(sets[i]), root[i]) for i in rows}
    assert kept == set(root.values())
    assert partenum.jaccard_components(frame.limit(0)).count() == 0


def test_jaccard_odd_rows(odd):
    got = collections.Counter((r["doc_id"], r["component_id"]) for r in partenum.jaccard_components(odd).collect())
    assert got == collections.Counter([(1, 1), (None, None), (None, None), (2, 2), (3, 3), (3, 3), (4, 4)])
    assert partenum.one_of_each(odd.filter("doc_id = 3")).count() == 1


def test_one_of_each_by_set_not_by_id(spark):
    rnd = random.Random(21)
    a, b, c, d, e, f, g = (" ".join(f"w{rnd.randint(0, 10**6)}" for _ in range(60)) for _ in range(7))
    near = g.rsplit(" ", 1)[0]
    rows = [(1, a), (None, a), (None, b), (None, c), (5, d), (5, e), (2, d), (None, None), (None, ""), (6, None), (6, None), (7, f), (7, f), (None, g), (None, near), (None, g)]
    frame = spark.createDataFrame([(i, t, None) for i, t in rows], "doc_id long, text string, source string").repartition(5)
    got = collections.Counter((r["doc_id"], r["text"]) for r in partenum.one_of_each(frame).collect())
    last = [(None, t) for t in (g, near) if (None, t) in got]
    assert len(last) == 1  # one of two similar sets without ids
    assert got == collections.Counter([(1, a), (None, b), (None, c), (5, e), (2, d), (None, None), (None, ""), (6, None), (6, None), (7, f), *last])


def test_components(spark):
    rnd = random.Random(9)
    links = [(rnd.randint(0, 80), rnd.randint(0, 80)) for _ in range(60)] + [(100, i) for i in range(101, 140)] + [(i, i + 1) for i in range(200, 240)]
    root = {x: x for p in links for x in p}
    for a, b in links:
        low, high = sorted((root[a], root[b]))
        root = {k: low if r == high else r for k, r in root.items()}
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame([*links, (None, 3)], "a long, b long")).collect()}
    assert got == {k: r for k, r in root.items() if any(k in p and p[0] != p[1] for p in links)}


def test_ids_are_the_tokenizers():
    path = public_tokenizers.path("byte_bpe_50k.json")
    reference, as_text = Tokenizer.from_file(path), Tokenizer.from_file(path)
    as_text.encode_special_tokens = True
    encoder = packing.Encoder(packing.byte_level_vocabulary(path))
    rnd = random.Random(10)
    texts = ["", " ", "  a", "a\n b", "don't it's", "x\r\ny", "日本 語", "a\x85b c", "<|endoftext|> x", "!!! a", "tail ", *("".join(rnd.choices("ab1 \n\t'.é s!", k=rnd.randint(0, 60))) for _ in range(500))]
    long = " ".join(f"w{rnd.randint(0, 5000)}," for _ in range(300_000))
    for text, ids in zip([*texts, long], encoder.encode_all([*texts, long]), strict=True):
        assert ids.tolist() == reference.encode(text, add_special_tokens=False).ids
    special = ["<|endoftext|>", "<|endoftext|> x", "a <|endoftext|>", "a  <|endoftext|><|endoftext|>\n b", "<|endoftext"]
    for text, ids, plain in zip(special, encoder.encode_all(special), packing.Encoder(packing.byte_level_vocabulary(path), True).encode_all(special), strict=True):
        assert ids.tolist() == reference.encode(text, add_special_tokens=False).ids
        assert plain.tolist() == as_text.encode(text, add_special_tokens=False).ids
    with pytest.raises(ValueError):
        packing.byte_level_vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def test_packing(docs, odd):
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = packing.Encoder(packing.byte_level_vocabulary(path))
    rows = packing.pack_documents(docs, path, shard_documents=60).collect()
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for d in docs.collect():
        ids = [*encoder.encode_all([d["text"]])[0].tolist(), 1]
        at = 0
        for r in sorted(by_doc[d["doc_id"]], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    short = 0
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
        short += at < 2048
    assert short <= 2 * -(-docs.count() // 60)
    assert packing.pack_documents(odd.select("doc_id", "text"), path).agg(F.sum("length")).first()[0] > 30_000
    assert packing.pack_documents(odd.limit(0), path).count() == 0


def test_neighbours_come_first():
    idf = np.ones(1 << 16, np.float32)
    terms = [np.array(t, packing.IDS) for t in ([1, 2, 3], [7, 8], [2, 3, 4], [9])]
    index = packing.ShardIndex(terms, [np.ones(len(t), np.uint8) for t in terms], np.full(4, 100.0, np.float32), idf, 100.0)
    windows = packing.fill_windows(index, np.array([100, 90, 80, 70]), 200)
    assert [p[0] for p in windows[0]] == [0, 2, 1]  # the neighbour, then the next document, cut
    assert sum(n for w in windows for _, _, n in w) == 340


def test_scores_are_bm25_of_all_terms():
    rnd = random.Random(19)
    docs = [collections.Counter(rnd.choices(range(30), k=rnd.randint(0, 40))) for _ in range(25)]
    lengths = [sum(d.values()) + 1 for d in docs]
    mean, n = sum(lengths) / len(lengths), len(docs)
    idf = [math.log1p((n - f + 0.5) / (f + 0.5)) for f in (sum(t in d for d in docs) for t in range(30))]
    terms = [np.array(sorted(d), packing.IDS) for d in docs]
    index = packing.ShardIndex(terms, [np.array([d[t] for t in sorted(d)], packing.COUNTS) for d in docs], np.array(lengths, np.float32), np.array(idf), mean)
    unused = np.ones(n, bool)
    for _ in range(2):
        for seed in range(n):
            want = [sum(idf[t] * docs[i][t] * 2.2 / (docs[i][t] + 1.2 * (0.25 + 0.75 * lengths[i] / mean)) for t in docs[seed]) if unused[i] else 0.0 for i in range(n)]
            assert np.allclose(index.scored(seed) * unused, want)
        unused = np.array([rnd.random() < 0.5 for _ in range(n)])
        index.shrink(unused)  # postings of used documents go


def test_like_documents_are_routed_together():
    rng = np.random.default_rng(20)
    kinds = [rng.choice(5000, 300, replace=False) for _ in range(6)]
    terms = [np.unique(rng.choice(kinds[i % 6], 60)).astype(packing.IDS) for i in range(600)]
    counts = [np.ones(len(t), packing.COUNTS) for t in terms]
    router = routing.fit_router(terms[:300], counts[:300], np.ones(5000, np.float32), 600, 100, 1)
    leaf = router.leaves(terms, counts)
    shares = [collections.Counter(leaf[k::6].tolist()).most_common(1)[0][1] for k in range(6)]
    assert min(shares) > 50 and len(set(leaf.tolist())) > 3


def test_all_terms_and_counts_are_used(spark):
    terms = [np.arange(1, 41, dtype=packing.IDS), np.array([50], packing.IDS), np.array([40], packing.IDS)]
    index = packing.ShardIndex(terms, [np.ones(len(t), "<u4") for t in terms], np.full(3, 100.0, np.float32), np.ones(1 << 16, np.float32), 100.0)
    assert np.flatnonzero(index.scored(0)).tolist() == [0, 2]  # shares the last of forty terms
    row = packing.tokenised(spark.createDataFrame([(1, "word" + " word" * 70_000)], "doc_id long, text string"), public_tokenizers.path("byte_bpe_50k.json"), 2048, 1).first()
    assert np.frombuffer(row["counts"], packing.COUNTS).max() == 70_000
