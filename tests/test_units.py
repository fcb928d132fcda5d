"""Literal cases: roundings, windows, templates, files, folds and loops."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from brindle.functions import numbers, similarity, text, urls
from brindle.operators import campaigns, priors, ranking, selection
from brindle.plans import fixtures, job_queries, registry
from brindle.sources import readers, writers
from brindle.streaming import jobs
from tests.conftest import DATA


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["x"] for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_text(spark):
    assert column(spark, ["abc", "CPV-4500", None], text.class_division) == ["", "45", None]
    assert column(spark, ["1d", "1f", "1_0", " 12 ", "1,2", "", "NaN", "1e3"], numbers.to_double_strict) == [None, None, None, 12.0, None, None, None, 1000.0]
    assert column(spark, ["1,2,x", "0, 6", "x", ""], text.parse_int_list) == [[1, 2], [0, 6], [], []]
    assert column(spark, ["Crème  Brûlée", None], text.ascii_fold) == ["creme brulee", None]
    assert column(spark, ["a@b.c", "a b@c.d", "a@b", None], text.is_email) == [True, False, False, None]
    assert column(spark, ["most", "cost", "x"], lambda c: text.deny_words([c], ["ost"])) == [False, False, True]
    assert column(spark, ["most", "ost"], lambda c: text.deny_words([c], ["ost"], word_boundary=True)) == [True, False]
    assert column(spark, ["{a|b}", "{x}", "no", "{x{a|b}y}"], lambda c: F.regexp_replace(text.spin(c, F.lit(1), 3), "[ab]", "_")) == ["_", "{x}", "no", "{x_y}"]
    filled = column(spark, ["{{a}}-{{b}}", "plain"], lambda c: text.fill_template(c, F.create_map(F.lit("a"), F.lit("1"))))
    assert filled == ["1-", "plain"]
    assert column(spark, ["{bad", '{"a":"b"}'], text.json_map_or_empty) == [{}, {"a": "b"}]
    match = [["blue"], ["big red"], ["of"], None]
    assert column(spark, match, lambda a: text.alias_match(F.lit("red and big"), a), "array<string>") == [False, True, False, False]


def test_numbers(spark):
    assert column(spark, [0.0, 5.0, 10.0, 99.0], lambda c: numbers.norm_bonus(c, F.lit(0.0), F.lit(10.0), 8), "double") == [-8, 0, 8, 8]
    assert column(spark, [1.0], lambda c: numbers.norm_bonus(c, F.lit(2.0), F.lit(2.0), 8), "double") == [0]
    assert column(spark, [2.5, 3.5], lambda c: F.bround(c, 0), "double") == [2.0, 4.0]
    assert column(spark, [1, 2, 3], numbers.backoff_minutes, "int") == [30, 60, 120]
    ranks = spark.createDataFrame([(float(i),) for i in range(1, 11)], "x double")
    assert tuple(priors.rank_select(ranks, "x").first()) == (2.0, 8.0)
    assert tuple(priors.rank_select(ranks.limit(0), "x").first()) == (1.0, 1.0)


def test_urls(spark):
    base = F.lit("https://a.example.com/x/y.html?q#f")
    assert column(spark, ["/z", "z", "//b.org/c", "http://d/e"], lambda c: urls.resolve_url(base, c)) == ["https://a.example.com/z", "https://a.example.com/x/z", "https://b.org/c", "http://d/e"]
    assert column(spark, ["HTTP://U@A.b:80/x", "nothing"], urls.url_host) == ["a.b", None]
    assert column(spark, ["a.b/c;d?e#f", "http://x/y"], urls.canonical_url) == ["https://a.b/c?e", "http://x/y"]
    assert column(spark, ["a.b.c"], urls.host_suffixes) == [["a.b.c", "b.c", "c"]]
    assert column(spark, [["x/1", "y/content/images/2", "longer/3"]], urls.prefer_urls, "array<string>") == [["y/content/images/2", "longer/3", "x/1"]]


def test_send_window(spark):
    rows = [(1, "Asia/Tokyo", "6", 0, 24), (2, "Asia/Tokyo", "5", 0, 24), (3, "UTC", "", 0, 24), (4, "UTC", "x", 0, 24), (5, "Bad/Zone", "0", 0, 1), (6, "UTC", "5", 22, 6), (7, None, "6", 0, 24)]
    frame = spark.createDataFrame(rows, "id int, timezone string, send_days string, send_start_hour int, send_end_hour int")
    zones = spark.createDataFrame([("Asia/Tokyo",), ("UTC",), ("Europe/Paris",)], "zone string")
    friday = F.lit("2024-01-19 23:30:00").cast("timestamp_ntz")
    got = {r["id"]: r["open"] for r in campaigns.send_window(frame, zones, friday).collect()}
    assert got == {1: True, 2: False, 3: True, 4: True, 5: True, 6: False, 7: True}


def test_empty_campaign(spark):
    leads = spark.createDataFrame([], "campaign_id int, status string, replied int, unsubscribed int")
    row = campaigns.campaign_funnel(leads, spark.createDataFrame([(1, "a")], "campaign_id int, name string")).first()
    assert row["total"] == 0 and row["completed"] is None


def test_missing_role(spark):
    with pytest.raises(priors.MissingRolesError):
        priors.resolve_roles(spark.range(1))


def test_sources(spark, tmp_path):
    (tmp_path / "leads.csv").write_text('﻿email,Email,note\na@b.c,, "x, y" \n\n,D@e.f,z\n')
    try:
        rows = readers.read_leads_csv(spark, str(tmp_path / "leads.csv"))
        assert [tuple(r) for r in rows.select(text.first_nonempty(F.col("email"), F.col("Email")), "note").collect()] == [("a@b.c", "x, y"), ("D@e.f", "z")]
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
    (tmp_path / "seeds.json").write_text('{"1": {"folder": "f", "game": "g", "ids": ["a", "b"]}}')
    assert [(r["index"], r["id"]) for r in readers.explode_seeds(spark, str(tmp_path / "seeds.json")).collect()] == [(1, "a"), (1, "b")]
    (tmp_path / "hits.jsonl").write_text('{"id": "a"}\nnot json\n{"id": "b"\n{"id": "c"}\n')
    assert [r["id"] for r in readers.read_jsonl_lenient(spark, str(tmp_path / "hits.jsonl"), "id string").orderBy("file_pos").collect()] == ["a", "c"]
    secret = spark.createDataFrame([("x",), (None,)], "v string")
    key = "k" * 32
    hidden = writers.encrypt_columns(secret, ["v"], key)
    assert hidden.filter("v rlike '^[0-9a-f]{32}:[0-9a-f]+$'").count() == 1
    assert sorted(map(str, (r["v"] for r in writers.decrypt_columns(hidden, ["v"], key).collect()))) == ["None", "x"]
    assert writers.decrypt_columns(secret, ["v"], key).filter("v = 'x'").count() == 1
    writers.write_manifest(secret, str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m" / "json")).count() >= 1


def test_pick_variation_shares(spark):
    leads = spark.range(4000).select(F.col("id").alias("lead_id"), F.lit(1).alias("step_id"))
    choices = spark.createDataFrame([(1, "A", 3), (1, "B", 0)], "step_id int, variant string, weight int")
    n = {r["variant"]: r["count"] for r in campaigns.pick_variation(leads, choices, 7).groupBy("variant").count().collect()}
    assert abs(n["A"] / 4000 - 0.75) < 0.03 and sum(n.values()) == 4000


def loop_suppress(rows, alike):
    kept = []
    for r in rows:
        if not any(alike(r, k) for k in kept):
            kept.append(r)
    return {r["vec_id"] for r in kept}


def candidates(spark):
    items = spark.read.parquet(f"{DATA}/embeddings.parquet").select("vec_id", F.col("label").alias("grp"), "embedding", ((F.col("vec_id") * 37) % 101 / 100.0).alias("score"))
    return selection.with_features(items).filter("grp < 2").persist()


def test_suppress_is_the_loop(spark):
    items = candidates(spark)
    ranked = ranking.number_from(items, ["grp"], [F.desc("score"), F.asc("vec_id")], name="place")
    got = {r["vec_id"] for r in selection.suppress_near_dups(ranked, "vec_id", ["grp"], "place", [(24, 0.1)]).collect()}

    def alike(a, b):
        return bin((a["sig"] ^ b["sig"]) & (2**64 - 1)).count("1") <= 24 and sum(x * y for x, y in zip(a["unit"], b["unit"], strict=True)) >= 0.1

    rows = sorted(ranked.collect(), key=lambda r: (r["grp"], r["place"]))
    expected = set().union(*(loop_suppress(list(g), alike) for _, g in itertools.groupby(rows, key=lambda r: r["grp"])))
    assert got == expected and len(got) < len(rows)


def test_diverse_is_the_loop(spark):
    items = candidates(spark)
    got = [(r["grp"], r["place"], r["vec_id"]) for r in selection.diverse_topk(items, "vec_id", "grp", "score", 4).orderBy("grp", "place").collect()]
    p, expected = similarity.PRESETS["site"], []
    for grp, group in itertools.groupby(sorted(items.collect(), key=lambda r: r["grp"]), key=lambda r: r["grp"]):
        pool = list(group)
        low, high = min(r["score"] for r in pool), max(r["score"] for r in pool)
        chosen = []
        while len(chosen) < 4:

            def worth(r, chosen=chosen, low=low, high=high):
                q = (r["score"] - low) / (high - low + 1e-9)
                if not chosen:
                    return (q, -r["vec_id"])
                far = min((1 - sum(x * y for x, y in zip(r["unit"], c["unit"], strict=True))) * p.distance[0] + bin((r["sig"] ^ c["sig"]) & (2**64 - 1)).count("1") / 64 * p.distance[1] for c in chosen)
                return (far * p.pick[0] + q * p.pick[1], -r["vec_id"])

            best = max(pool, key=worth)
            pool.remove(best)
            chosen.append(best)
        expected += [(grp, i + 1, c["vec_id"]) for i, c in enumerate(chosen)]
    assert got == expected


def test_allocation_is_the_loop(spark):
    rnd = random.Random(5)
    boxes = [(i, f"n{i}", rnd.randint(0, 6), rnd.randint(0, 4), "active") for i in range(8)]
    inboxes = spark.createDataFrame(boxes, "inbox_id int, name string, daily_limit int, sent_today int, status string")
    got = {r["lead_id"]: r["inbox_id"] for r in campaigns.allocate_least_loaded(spark.range(30).withColumnRenamed("id", "lead_id"), inboxes).collect()}
    used, expected = {b[0]: b[3] for b in boxes}, {}
    for lead in range(30):
        free = [(used[b[0]] / b[2], b[0]) for b in boxes if b[2] > 0 and used[b[0]] < b[2]]
        if free:
            expected[lead] = min(free)[1]
            used[min(free)[1]] += 1
    assert got == expected


def test_state_fold_and_stream(spark, tmp_path):
    rnd = random.Random(3)
    rows = [(f"e{rnd.randint(0, 9)}", i, i, rnd.choice(["send", "send", "fail", "reply", "unsubscribe"])) for i in range(60)]
    events = spark.createDataFrame(rows, "email string, ts long, seq long, kind string")
    batch = {r["email"]: tuple(r)[1:] for r in jobs.lead_state(events).collect()}
    assert batch == {e: jobs.fold_events([r[1:] for r in rows if r[0] == e]) for e in {r[0] for r in rows}}
    for part in range(2):  # two files, so that state is carried from one micro-batch to the next
        events.filter(F.col("seq").between(part * 30, part * 30 + 29)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = jobs.lead_state_stream(stream).writeStream.format("memory").queryName("states").outputMode("update").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination(120)
    assert {r["email"] for r in spark.table("states").collect()} == set(batch)


def test_state_of_every_address(spark):
    rnd = random.Random(8)
    kinds = ["send", "fail", "fail", "fail", "reply", "unsubscribe", "other"]
    rows = [(None if e == 0 else f"e{e}", rnd.randint(0, 30), i, rnd.choices(kinds, [4, 4, 1, 1, rnd.random() / 4, rnd.random() / 4, 1])[0]) for e in range(60) for i in range(rnd.randint(1, 40))]
    rows += [("hot", i, i, "fail" if i % 3 else "send") for i in range(5000)] + [("hot", 9999, 0, "unsubscribe"), ("none", 1, 1, "other")]
    events = spark.createDataFrame(rows, "email string, ts long, seq long, kind string").repartition(7)
    for steps, retries in ((3, 3), (1, 1), (5, 2)):
        out = jobs.lead_state(events, steps, retries)
        got = {r["email"]: tuple(r)[1:] for r in out.collect()}
        assert got == {e: jobs.fold_events([r[1:] for r in rows if r[0] == e], steps=steps, max_retries=retries) for e in {r[0] for r in rows}}
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()  # a hot address is cut down to its first events before the shuffle

    events, leads = (fixtures.view(spark, DATA, name) for name in ("events", "fx_leads"))
    every = job_queries.state_events(events, leads).select("email", "ts", "seq", "kind").collect()
    by_email = {}
    for r in every:
        by_email.setdefault(r["email"], []).append(tuple(r)[1:])
    registered = registry.QUERIES["lead_state_all"](spark, DATA)
    assert {r["email"]: tuple(r)[1:] for r in registered.collect()} == {e: jobs.fold_events(own) for e, own in by_email.items()}


def test_stream_counts_are_the_batch(spark, tmp_path):
    rows = spark.read.parquet(f"{DATA}/events.parquet").select((F.col("user_id") % 10).alias("inbox_id"), F.col("ts").cast("timestamp").alias("ts"))
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = jobs.daily_usage_stream(stream).writeStream.format("memory").queryName("usage").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(map(tuple, spark.table("usage").collect())) == sorted(map(tuple, jobs.daily_usage_stream(rows).collect()))
