"""Indexes, numberings and walks that replace pairs of all rows or one task, against plain loops."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from brindle.functions import similarity, text, urls
from brindle.operators import campaigns, curation, priors, ranking, selection, tables
from brindle.plans import job_queries, registry
from brindle.plans.fixtures import view
from tests.conftest import DATA


def signed(n):
    return n - (1 << 64) if n >= 1 << 63 else n


def signatures(spark, bits, n, seed):
    """Vectors and signatures in groups of near ones: (key, grp, unit, sig as a whole number)."""
    draw, rows = random.Random(seed), []
    for k in range(n):
        if k % 4 == 0 or not rows:
            sig, unit = draw.getrandbits(bits), [draw.gauss(0, 1) for _ in range(4)]
        else:
            sig, unit = rows[-1][3], [x + draw.gauss(0, 0.1) for x in rows[-1][2]]
            for _ in range(draw.randint(0, 14)):
                sig ^= 1 << draw.randrange(bits)
        size = sum(x * x for x in unit) ** 0.5
        rows.append((k, draw.choice("ab"), [x / size for x in unit], sig))
    rows.append((n, "a", rows[0][2], None))
    rows.append((n + 1, None, rows[0][2], rows[0][3]))
    words = lambda s: None if s is None else [signed(s >> at & (2**64 - 1)) for at in range(0, bits, 64)]
    if bits == 64:
        frame = spark.createDataFrame([(k, g, u, None if s is None else signed(s)) for k, g, u, s in rows], "key int, grp string, unit array<double>, sig long")
    else:
        frame = spark.createDataFrame([(k, g, u, words(s)) for k, g, u, s in rows], "key int, grp string, unit array<double>, sig array<long>")
    return rows, frame.repartition(3)


@pytest.mark.parametrize(("bits", "rules"), [(64, [(3, -2.0)]), (64, [(9, 0.91)]), (144, [(10, 0.90)]), (256, [(16, -2.0), (25, 0.965)])])
def test_bands_find_what_all_pairs_find(spark, monkeypatch, bits, rules):
    monkeypatch.setattr(selection, "BLOCK", 40)  # cells of several blocks as well
    rows, frame = signatures(spark, bits, 160, bits)
    expected = set()
    for (a, ga, ua, sa), (b, gb, ub, sb) in itertools.combinations(rows, 2):
        if ga == gb and ga is not None and sa is not None and sb is not None:
            apart, cosine = (sa ^ sb).bit_count(), sum(x * y for x, y in zip(ua, ub, strict=True))
            if any(apart <= t and cosine >= c for t, c in rules):
                expected.add((a, b, apart, round(cosine, 6)))
    got = {way: selection.near_dup_pairs(frame, "key", ["grp"], rules, bits, banded=way) for way in (None, False)}
    for df in got.values():
        found = [tuple(r) for r in df.collect()]
        assert len(found) == len(expected) > 10 and {r[:3] for r in found} == {r[:3] for r in expected}
        assert all(abs(r[3] - next(e[3] for e in expected if e[:3] == r[:3])) < 1e-5 for r in found)
    assert "_band" in got[None]._jdf.queryExecution().toString() and "_band" not in got[False]._jdf.queryExecution().toString()


def test_wide_limits_have_no_bands(spark):
    assert selection.band_edges(64, 25) is None and selection.band_edges(256, 25)[-1] == 256
    with pytest.raises(ValueError, match="bands"):
        selection.near_dup_pairs(signatures(spark, 64, 4, 1)[1], "key", ["grp"], [(25, 0.9)], banded=True)


def test_ordinal_signature(spark):
    rows = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, [10.0, 20.0, 30.0]), (3, [3.0, 2.0, 1.0]), (4, None), (5, [])], "k int, v array<double>")
    got = {r["k"]: r["s"] for r in rows.select("k", similarity.ordinal_signature(F.col("v"), 144, 7).alias("s")).collect()}
    assert got[1] == got[2] and got[4] is None and got[5] is None and len(got[1]) == 3
    ones = [sum((x & (2**64 - 1)).bit_count() for x in got[k]) for k in (1, 3)]
    assert sum(ones) == 144 and 0 < ones[0] < 144 and 0 <= got[1][2] < 1 << 16


def test_suppression_of_longer_signatures_is_the_loop(spark):
    rows, frame = signatures(spark, 256, 120, 9)
    rules = similarity.PRESETS["game"].duplicate
    kept = []
    for k, g, u, s in rows:
        near = lambda o, g=g, u=u, s=s: o[1] == g and any((s ^ o[3]).bit_count() <= t and sum(x * y for x, y in zip(u, o[2], strict=True)) >= c for t, c in rules)
        if s is None or g is None or not any(near(o) for o in kept if o[3] is not None and o[1] is not None):
            kept.append((k, g, u, s))
    got = selection.suppress_near_dups(frame, "key", ["grp"], "key", rules, bits=256)
    assert {r["key"] for r in got.collect()} == {k[0] for k in kept} and len(kept) < len(rows)


def test_favoured_rows_are_picked_first_of_equals(spark):
    items = spark.createDataFrame([(k, 1, [1.0, 0.0] if k == 0 else [0.0, 1.0], 0 if k == 0 else 1, 0.5, k == 3) for k in range(5)], "key int, grp int, unit array<double>, sig long, score double, official boolean")
    pick = lambda favoured: [r["key"] for r in selection.diverse_topk(items, "key", "grp", "score", 2, "game", favoured=favoured).orderBy("place").collect()]
    assert pick(None) == [0, 1] and pick(F.col("official")) == [0, 3]


def test_entities_by_their_rarest_piece(spark):
    draw = random.Random(4)
    word = lambda: "".join(draw.choices("ab c#é", k=draw.randint(1, 7)))
    texts = [(i, " ".join(word() for _ in range(6))) for i in range(60)] + [(60, None), (61, ""), (61, ""), (62, "abc abc"), (63, "caba abab")]
    entities = [(f"e{i}", [word() for _ in range(draw.randint(0, 3))], [word() for _ in range(draw.randint(0, 1))]) for i in range(40)]
    entities += [("none", None, None), ("null", [None, "ab"], None), ("empty", [""], ["b"]), ("twice", ["abc abc", "abc"], []), ("twice", ["abc abc", "abc"], [])]
    one = spark.createDataFrame(texts, "id int, text string")
    two = spark.createDataFrame(entities, "entity string, aliases array<string>, rejects array<string>")
    plain = one.crossJoin(two).filter(text.alias_match(F.col("text"), F.col("aliases")) & ~text.reject_match(F.col("text"), F.col("rejects")))
    for gram in (4, 2):
        got = curation.match_entities(one, two, gram=gram)
        assert sorted(got.collect(), key=repr) == sorted(plain.collect(), key=repr)
    assert plain.count() > 100


def test_many_entities_need_no_nested_loop(spark):
    many = spark.range(100_000).select(F.col("id").alias("entity"), F.array(F.concat(F.lit("item number "), F.col("id").cast("string"))).alias("aliases"), F.array(F.lit("zzz")).alias("rejects"))
    texts = spark.createDataFrame([("this is item number 99321 here",), ("no number",)], "text string")
    got = curation.match_entities(texts, many)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    # Words of over two letters decide, wherever they stand: also the pieces 9932, 932, 321 and so on of the number.
    assert {r["entity"] for r in got.collect()} == {i for i in range(100_000) if (str(i) in "this is item number 99321 here") or (len(str(i)) < 3)}


def test_entities_are_not_sent_through_the_driver(spark, tmp_path):
    """Files of equal texts are tiny beside their rows, so Spark would plan to broadcast texts and pieces by their size."""
    rows = spark.range(20_000).select("id", F.concat(F.lit("customer number "), F.lpad((F.col("id") % 50).cast("string"), 9, "0")).alias("text"))
    rows.coalesce(1).write.parquet(str(tmp_path / "texts"))
    some = spark.range(100).select(F.col("id").alias("entity"), F.array(F.lpad((F.col("id") % 40).cast("string"), 9, "0")).alias("aliases"), F.array(F.lit("zzz")).alias("rejects"))
    some.coalesce(1).write.parquet(str(tmp_path / "entities"))
    got = curation.match_entities(spark.read.parquet(str(tmp_path / "texts")), spark.read.parquet(str(tmp_path / "entities")))
    pairs = got.groupBy("entity").agg(F.count("*").alias("n"), F.max(F.col("id") % 50 != F.col("entity") % 40).alias("bad"))
    assert [(r["n"], r["bad"]) for r in pairs.collect()] == [(400, False)] * 100
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_customers_and_suppliers_are_not_sent_through_the_driver(spark):
    got = registry.QUERIES["match_suppliers"](spark, DATA)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_copies_of_customers_and_suppliers_are_matched_whole(spark, tmp_path):
    """Repeated names on both sides: every pair of copies, and no broadcast in the plan as it ran."""
    for table, key, copies in (("customer", "c_custkey", 7), ("supplier", "s_suppkey", 5)):
        rows = view(spark, DATA, table)
        shifted = rows.crossJoin(spark.range(copies)).withColumn(key, F.col(key) + F.col("id") * 10_000).drop("id")
        shifted.coalesce(1).write.parquet(str(tmp_path / f"{table}.parquet"))
    got = registry.QUERIES["match_suppliers"](spark, str(tmp_path))
    pairs = sorted(map(tuple, got.collect()))
    ran = got._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in ran and "Broadcast" not in ran
    number = lambda name: F.substring(name, -9, 9)
    customers, suppliers = (spark.read.parquet(str(tmp_path / f"{t}.parquet")) for t in ("customer", "supplier"))
    same = customers.join(suppliers, number("c_name") == number("s_name")).filter("s_suppkey % 5 <> 0").select("c_custkey", "s_suppkey")
    assert pairs == sorted(map(tuple, same.collect())) and len(pairs) >= 35


def test_order_statistics_by_ranges(spark):
    draw = random.Random(6)
    for n in (1, 2, 7, 500):
        values = sorted(draw.choice((draw.uniform(-5, 5), draw.randint(0, 3))) for _ in range(n))
        df = spark.createDataFrame([(float(x),) for x in values] + [(None,)], "x double")
        for low, high in ((0.25, 0.75), (0.0, 1.0), (0.5, 0.9)):
            expected = (values[max(0, int(n * low) - 1)], values[min(n - 1, int(n * high))])
            assert tuple(priors.rank_select(df, "x", low, high, ranges=8).first()) == expected


def test_numbers_in_order(spark):
    draw = random.Random(1)
    values = [draw.choice((None, draw.randint(0, 50))) for _ in range(300)]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v int").repartition(7)
    got = {r["id"]: r["n"] for r in tables.number_rows(rows, [F.asc_nulls_first("v"), F.desc("id")], "n").collect()}
    order = sorted(range(300), key=lambda i: (values[i] is not None, values[i] or 0, -i))
    assert [got[i] for i in order] == list(range(1, 301))
    again = tables.renumber(rows.filter("id % 3 = 0"), "id", "n", width=40)
    assert {r["id"]: r["n"] for r in again.collect()} == {i: k for k, i in enumerate(range(0, 300, 3), 1)}
    assert tables.number_rows(rows.limit(0), ["id"]).collect() == []


def allocate(leads, boxes):
    """One lead after the other: its own inbox if that has room, else the least loaded one."""
    used, out = {b[0]: b[3] for b in boxes}, {}
    room = {b[0]: b[2] for b in boxes if b[4] == "active"}
    for lead, own in leads:
        if own in room and used[own] < room[own]:
            best = own
        else:
            free = [(used[b] / n, b) for b, n in room.items() if n > 0 and used[b] < n]
            if not free:
                break
            best = min(free)[1]
        out[lead] = (best, best == own)
        used[best] += 1
    return out


@pytest.mark.parametrize("seed", [0, 3])
def test_sticky_allocation_is_the_loop(spark, seed):
    draw = random.Random(seed)
    boxes = [(i, f"n{i}", draw.randint(0, 7), draw.randint(0, 3), draw.choice(("active", "active", "paused"))) for i in range(9)]
    leads = [(k, draw.choice((None, 0, 0, 1, *range(12)))) for k in range(70)]
    shuffled = {lead: draw.random() for lead, _ in leads}
    inboxes = spark.createDataFrame(boxes, "inbox_id int, name string, daily_limit int, sent_today int, status string")
    frame = spark.createDataFrame([(k, own, shuffled[k]) for k, own in leads], "lead_id int, assigned_inbox int, due double")
    got = {r["lead_id"]: (r["inbox_id"], r["sticky"]) for r in campaigns.allocate_sticky(frame, inboxes, ["due", "lead_id"]).collect()}
    expected = allocate(sorted(leads, key=lambda x: shuffled[x[0]]), boxes)
    assert got == expected and len(got) > 5


def test_registered_allocations(spark):
    leads = [(r["lead_id"], r["assigned_inbox"]) for r in view(spark, DATA, "fx_leads").orderBy("lead_id").collect()]
    boxes = [(r["inbox_id"], r["name"], r["daily_limit"], r["sent_today"], r["status"]) for r in view(spark, DATA, "fx_inboxes").collect()]
    got = registry.QUERIES["allocate_sticky"](spark, DATA)
    assert {r["lead_id"]: (r["inbox_id"], r["sticky"]) for r in got.collect()} == allocate(leads, boxes)

    zones = spark.createDataFrame([(z,) for z in registry.ZONES], "zone string")
    due = campaigns.due_leads(view(spark, DATA, "fx_due_leads"), view(spark, DATA, "fx_campaigns").select("campaign_id", "status"), registry.now(), None)
    opened = campaigns.send_window(due.join(view(spark, DATA, "fx_campaigns").drop("status", "name"), "campaign_id"), zones, registry.now()).filter("open")
    first = opened.orderBy(F.asc_nulls_first("next_send_at"), "lead_id").limit(200).collect()
    planned = registry.QUERIES["plan_batches"](spark, DATA).collect()
    assert {r["lead_id"]: (r["inbox_id"], r["sticky"]) for r in planned} == allocate([(r["lead_id"], r["assigned_inbox"]) for r in first], boxes)
    assert len(planned) > 0


def test_walk_is_breadth_first(spark):
    draw = random.Random(12)
    url = lambda k: f"https://a.org/d{k % 3}/p{k}"
    to = {k: [draw.randrange(40) for _ in range(draw.randint(0, 2))] for k in range(40)}
    html = {k: "".join(f'<a href="../d{t % 3}/./p{t}#x">t</a>' for t in ts) + '<a href="/gone">x</a>' for k, ts in to.items()}
    pages = spark.createDataFrame([(k, url(k), html[k]) for k in to] + [(99, None, "x"), (98, url(3), None)], "page_id int, url string, html string")
    seeds = spark.createDataFrame([(url(0),), (None,), ("https://b.org/none",)], "url string")
    for rounds, deny in ((50, None), (3, None), (50, "/p1")):
        depth, now = {0: 0}, [0]
        for level in range(1, rounds):
            now = sorted({t for k in now for t in to[k] if t not in depth and not (deny and f"/p{t}".startswith(deny))})
            depth |= dict.fromkeys(now, level)
        got = curation.frontier_walk(pages, seeds, rounds, deny)
        expected = [(url(k), d, k) for k, d in depth.items()] + [(url(3), depth[3], 98) for _ in range(3 in depth)]
        assert sorted(map(tuple, got.collect())) == sorted(expected)
    assert curation.frontier_walk(pages, seeds.limit(0)).collect() == []


def test_dots_in_links(spark):
    cases = {"https://a.b/x/../y": "https://a.b/y", "https://a.b/./x/.": "https://a.b/x/", "https://a.b/x/y/..": "https://a.b/x/", "https://a.b/../../z?u=/../v#w": "https://a.b/z?u=/../v#w", "https://a.b/x..y/.z/...": "https://a.b/x..y/.z/...", "https://a.b": "https://a.b", "mailto:x": "mailto:x"}
    rows = spark.createDataFrame([(k,) for k in cases], "u string").select("u", urls.remove_dots(F.col("u")).alias("v")).collect()
    assert {r["u"]: r["v"] for r in rows} == cases


def test_pages_after_a_row(spark, tmp_path):
    draw = random.Random(3)
    rows = [(i, draw.choice((None, 1, 2, 3)), draw.choice((None, "a", "b"))) for i in range(100)]
    spark.createDataFrame(rows, "id int, x int, y string").coalesce(1).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    order = [("x", True), ("y", False), ("id", True)]
    whole = [tuple(r) for r in ranking.page(df, [F.desc("x"), F.asc("y"), F.desc("id")], 100).collect()]
    seen, after = [], None
    while got := ranking.page_after(df, order, after, 7).collect():
        seen += [tuple(r) for r in got]
        after = tuple(got[-1][c] for c, _ in order)
    assert seen == whole
    plan = ranking.page_after(df, [("x", False), ("id", False)], (2, 50), 7)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(x,2)" in plan and "TakeOrderedAndProject" in plan


def test_dimensions_are_counted(spark):
    with pytest.raises(ValueError, match="dimension"):
        curation.cross_dims(spark.range(3), spark.range(11).withColumnRenamed("id", "b"), most=10)


def test_messages_are_the_loop(spark):
    out = {r["lead_id"]: r for r in registry.QUERIES["render_messages"](spark, DATA).collect()}
    leads = job_queries.message_leads(lambda name: view(spark, DATA, name)).collect()
    assert set(out) == {r["lead_id"] for r in leads if r["step_id"] % 5}
    seen = set()
    for r in leads:
        m = out.get(r["lead_id"])
        if m is None:
            continue
        hello = m["plain"].split()[0]
        greeting = m["subject"].split()[2]
        seen |= {hello, greeting, m["variant"]}
        assert m["subject"] == f"Hi {r['first_name']} {greeting} {m['variant']}" and m["plain"] == f"{hello} {r['first_name']}\n{m['variant']}"
        assert f"{hello} {r['first_name']}<br>{m['variant']}" in m["html"]
        shown = r["show_unsubscribe"] == 1
        assert (m["list_unsubscribe"] == f"https://example.org/unsub/{r['lead_id']}") == shown and (f"/unsub/{r['lead_id']}" in m["html"]) == shown
        assert (">Stop</a>" in m["html"]) == (shown and r["unsubscribe_text"] == "Stop") and (f"/t/{r['log_id']}" in m["html"]) == (r["track_opens"] == 1)
    assert seen == {"Dear", "Hello", "Hey", "A", "B"}


@pytest.mark.parametrize("name", ["message_bodies", "render_messages"])
def test_messages_are_made_once_and_by_all_tasks(spark, name):
    plan = registry.QUERIES[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and "RepartitionByExpression [lead_id" in plan


def test_leads_of_one_file_are_rendered_by_all_tasks(spark, tmp_path):
    for table, copies in (("customer", 3), ("nation", 1), ("region", 1)):
        rows = view(spark, DATA, table).crossJoin(spark.range(copies))
        shifted = rows.withColumn("c_custkey", F.col("c_custkey") + F.col("id") * 10_000) if table == "customer" else rows
        shifted.drop("id").coalesce(1).write.parquet(str(tmp_path / f"{table}.parquet"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # such small parts would be merged
    try:
        got = registry.QUERIES["render_messages"](spark, str(tmp_path))
        assert got.select(F.spark_partition_id().alias("task")).distinct().count() == 4  # spark.sql.shuffle.partitions
        rows = got.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    leads = job_queries.message_leads(lambda name: view(spark, str(tmp_path), name)).filter("step_id % 5 <> 0").select("lead_id").collect()
    assert sorted(r["lead_id"] for r in rows) == sorted(r["lead_id"] for r in leads)
    assert {r for r in rows if r["lead_id"] < 10_000} == set(registry.QUERIES["render_messages"](spark, DATA).collect())
