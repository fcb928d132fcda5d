"""Streams over several micro-batches against their batch twins, with failures, restarts and late rows."""

import datetime
import random
import time

import pytest
from pyspark.sql import functions as F

from brindle.plans.fixtures import view
from brindle.streaming import jobs
from tests.conftest import DATA
from tests.test_scale_forms import allocate

START = datetime.datetime(2024, 1, 1)


def minutes(n):
    return START + datetime.timedelta(minutes=n)


def fed(spark, rows, schema, path, parts):
    """A stream that reads `parts` of rows, a file for each micro-batch, in order."""
    size = -(-len(rows) // parts)
    for k in range(parts):
        spark.createDataFrame(rows[k * size : (k + 1) * size], schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def run(df, name, path, mode="update"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).option("checkpointLocation", path).start()
    q.awaitTermination(180)
    assert q.exception() is None
    return q, df.sparkSession.table(name).collect()


def events(n, seed):
    draw = random.Random(seed)
    return [(f"e{draw.randint(0, 7)}", minutes(10 * i), i, draw.choices(["send", "fail", "reply", "unsubscribe"], [4, 4, 1, 1])[0]) for i in range(n)]


EVENT = "email string, ts timestamp, seq long, kind string"


@pytest.fixture
def rocks(spark):
    key, value = jobs.ROCKS_DB
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    yield
    spark.conf.set(key, before)


def test_lead_states_with_timers(spark, tmp_path, rocks):
    rows = events(80, 3)
    stream = fed(spark, rows, EVENT, str(tmp_path / "in"), 4)
    expected = sum(len({r[0] for r in rows[k * 20 : k * 20 + 20]}) for k in range(4))
    # Timers go by the clock, so the query runs until it is stopped.
    q = jobs.lead_state_timers(stream).writeStream.format("memory").queryName("timed_states").outputMode("update").option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        until = time.time() + 60
        while time.time() < until and (spark.table("timed_states").filter("not retry_due").count() < expected or spark.table("timed_states").filter("retry_due").isEmpty()):
            time.sleep(0.5)
    finally:
        q.stop()
    got = spark.table("timed_states").collect()
    batch = {r["email"]: tuple(r)[1:] for r in jobs.lead_state(spark.createDataFrame(rows, EVENT)).collect()}
    last = {r["email"]: tuple(r)[1:6] for r in got if not r["retry_due"]}  # rows of a memory table are in order of batches
    assert last == batch and len(got) > len(last)

    # A row is due for an address exactly when it waited for another try after one of its batches.
    waited, size = set(), 20
    for k in range(4):
        for e in {r[0] for r in rows[: (k + 1) * size]}:
            own = [r[1:] for r in rows[: (k + 1) * size] if r[0] == e]
            state = jobs.fold_events(own)
            if state[0] in ("pending", "active") and state[2] > 0 and any(r[0] == e and r[3] == "fail" for r in rows[k * size : (k + 1) * size]):
                waited.add((e, state))
    due = {(r["email"], tuple(r)[1:6]) for r in got if r["retry_due"]}
    assert due and due <= waited


def test_plain_lead_states_keep_their_values(spark, tmp_path):
    rows = events(60, 5)
    stream = fed(spark, rows, EVENT, str(tmp_path / "in"), 3)
    _, got = run(jobs.lead_state_stream(stream), "plain_states", str(tmp_path / "c"))
    batch = {r["email"]: tuple(r)[1:] for r in jobs.lead_state(spark.createDataFrame(rows, EVENT)).collect()}
    assert {r["email"]: tuple(r)[1:] for r in got} == batch


def test_openings_count_once(spark, tmp_path):
    draw = random.Random(2)
    rows = [(i, draw.randint(0, 5), minutes(30 * i)) for i in range(200)]
    twice = sorted(rows + draw.sample(rows, 80), key=lambda r: r[2])
    late = [(1000, 1, minutes(0))]  # two days behind the watermark by then
    schema = "event_id long, log_id long, ts timestamp"
    stream = fed(spark, twice + late, schema, str(tmp_path / "in"), 5)
    q, got = run(jobs.open_counts_once(stream, "1 hour"), "opens_once", str(tmp_path / "c"), "append")
    closed = {(r["log_id"], r["window"]["start"]): (r["opened_at"], r["open_count"]) for r in got}
    whole = {(r["log_id"], r["window"]["start"]): (r["opened_at"], r["open_count"]) for r in jobs.open_counts_once(spark.createDataFrame(twice, schema)).collect()}
    assert len(closed) == len(got) > 15 and all(whole[k] == v for k, v in closed.items())
    assert max(k[1] for k in whole if k not in closed) >= max(k[1] for k in closed)  # the last days are still open
    dropped = sum(o.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for o in p.get("stateOperators", []))
    assert dropped >= 1
    total = jobs.first_opens(jobs.open_counts_once(spark.createDataFrame(twice, schema))).collect()
    assert {r["log_id"]: (r["opened_at"], r["open_count"]) for r in total} == {k: (min(r[2] for r in rows if r[1] == k), sum(r[1] == k for r in rows)) for k in range(6)}


@pytest.mark.parametrize("job", ["open_counts", "rolling_7d", "daily_usage_stream"])
def test_aggregates_over_batches(spark, tmp_path, job):
    draw = random.Random(4)
    rows = [(draw.randint(0, 5), draw.randint(0, 5), minutes(90 * i + draw.randint(0, 40))) for i in range(200)]
    schema = "log_id long, inbox_id long, ts timestamp"
    form = getattr(jobs, job)
    stream = fed(spark, rows, schema, str(tmp_path / "in"), 5)
    _, got = run(form(stream), f"sums_{job}", str(tmp_path / "c"))
    keys = [c for c in got[0].__fields__ if c not in ("opened_at", "open_count", "used", "n")]
    last = {tuple(r[k] for k in keys): tuple(r) for r in got}  # a later batch replaces a key's row
    assert sorted(last.values()) == sorted(map(tuple, form(spark.createDataFrame(rows, schema)).collect())) and len(got) > len(last)


def test_a_reply_between_two_batches_is_seen(spark, tmp_path):
    schema = "lead_id long, ts timestamp"
    path, replies, out = str(tmp_path / "in"), str(tmp_path / "replies"), str(tmp_path / "out")
    spark.createDataFrame([(1,)], "lead_id long").write.parquet(replies)
    chosen = [(k, minutes(k)) for k in range(6)]
    spark.createDataFrame(chosen[:3], schema).coalesce(1).write.parquet(path)
    stream = lambda: spark.readStream.schema(schema).parquet(path)
    start = lambda: jobs.start_recheck(stream(), lambda: spark.read.parquet(replies), out, str(tmp_path / "c"), every=None)
    assert start().awaitTermination(120)
    spark.createDataFrame([(4,), (0,)], "lead_id long").write.mode("append").parquet(replies)
    spark.createDataFrame(chosen[3:], schema).coalesce(1).write.mode("append").parquet(path)
    assert start().awaitTermination(120)
    assert sorted((r["batch"], r["lead_id"]) for r in jobs.batch_table(spark, out).collect()) == [(0, 0), (0, 2), (1, 3), (1, 5)]
    assert jobs.batch_table(spark, str(tmp_path / "nothing")) is None


def test_plans_are_written_once_for_each_batch(spark, tmp_path, monkeypatch):
    folder = DATA
    leads = view(spark, folder, "fx_due_leads").persist()
    campaigns, inboxes = view(spark, folder, "fx_campaigns").persist(), view(spark, folder, "fx_inboxes").persist()
    zones = spark.createDataFrame([("Europe/Paris",), ("America/New_York",), ("Asia/Tokyo",), ("UTC",)], "zone string")
    path, ticks, checkpoint = str(tmp_path / "plans"), str(tmp_path / "ticks"), str(tmp_path / "c")
    replied = [str(tmp_path / "replies")]
    spark.createDataFrame([], "lead_id long").write.parquet(replied[0])
    tables = lambda: {"leads": leads, "campaigns": campaigns, "inboxes": inboxes, "zones": zones, "replies": spark.read.parquet(replied[0])}

    def tick(minute):
        spark.createDataFrame([(datetime.datetime(2024, 1, 19, 15, minute),)], "ts timestamp").coalesce(1).write.mode("append").parquet(ticks)

    def plans():
        stream = spark.readStream.schema("ts timestamp").parquet(ticks)
        q = jobs.start_plans(stream, tables, path, checkpoint, limit=10, every=None)
        q.awaitTermination(180)
        return q

    tick(0)
    assert plans().exception() is None
    tick(1)
    write = jobs.write_batch

    def fails_after_writing(rows, where, batch_id):
        write(rows.limit(1), where, batch_id)
        raise RuntimeError("lost")

    monkeypatch.setattr(jobs, "write_batch", fails_after_writing)
    with pytest.raises(Exception, match="lost"):
        plans()
    halfway = jobs.batch_table(spark, path).filter("batch = 1").count()
    monkeypatch.setattr(jobs, "write_batch", write)
    assert halfway == 1 and plans().exception() is None  # batch 1 runs again
    known = jobs.batch_table(spark, path).collect()
    due = [r["lead_id"] for r in known if r["batch"] == 0]
    spark.createDataFrame([(i,) for i in range(0, 150, 2)], "lead_id long").write.mode("append").parquet(replied[0])
    tick(2)
    assert plans().exception() is None

    rows = jobs.batch_table(spark, path).collect()
    assert {0, 1} <= {r["batch"] for r in rows} <= {0, 1, 2} and due and sum(r["batch"] == 1 for r in rows) > 1
    assert len({(r["lead_id"], r["step"]) for r in rows}) == len(rows)  # no message is planned twice
    assert all(r["lead_id"] % 2 for r in rows if r["batch"] == 2 and r["lead_id"] < 150)
    boxes = {r["inbox_id"]: [r["inbox_id"], r["name"], r["daily_limit"], r["sent_today"], r["status"]] for r in inboxes.collect()}
    order = [r["lead_id"] for r in leads.orderBy(F.asc_nulls_first("next_send_at"), "lead_id").collect()]
    own = {r["lead_id"]: r["assigned_inbox"] for r in leads.collect()}
    for batch in range(3):  # each plan is the loop over its leads, with the inboxes as the plans before left them
        chosen = {r["lead_id"]: (r["inbox_id"], r["sticky"]) for r in rows if r["batch"] == batch}
        assert chosen == allocate([(k, own[k]) for k in order if k in chosen], boxes.values())
        for inbox, _ in chosen.values():
            boxes[inbox][3] += 1
