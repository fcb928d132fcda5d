"""Structured Streaming forms of the campaign jobs; each has a batch twin over the same rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from brindle.operators.campaigns import allocate_least_loaded, allocate_sticky, due_leads, send_window

#: Which event sets which state, later events first decided by time; replies and unsubscribes override sends.
STATE_SCHEMA = "status string, step int, retries int, replied int, unsubscribed int"


def events_stream(spark, path: str) -> DataFrame:
    """The events table as a file stream; ts becomes a timestamp, which watermarks need."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rpartition("/")
    return spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def open_counts(stream: DataFrame, delay: str = "1 day", key: str = "log_id") -> DataFrame:
    """First opening and number of openings of each log row."""
    return stream.withWatermark("ts", delay).groupBy(key).agg(F.min("ts").alias("opened_at"), F.count("*").alias("open_count"))


def open_counts_once(stream: DataFrame, delay: str = "1 day", key: str = "log_id", event: str = "event_id") -> DataFrame:
    """T2 for openings that may be delivered twice: each event counts once if its copies are within the delay.

    Only keys of events are remembered, and only as long as the watermark lets copies in; a batch table is de-duplicated
    as a whole.
    """
    once = stream.withWatermark("ts", delay)
    once = once.dropDuplicatesWithinWatermark([event]) if stream.isStreaming else once.dropDuplicates([event])
    return once.groupBy(key, F.window("ts", "1 day")).agg(F.min("ts").alias("opened_at"), F.count("*").alias("open_count"))


def first_opens(daily: DataFrame, key: str = "log_id") -> DataFrame:
    """First opening and number of openings over all days, from the rows of open_counts_once()."""
    return daily.groupBy(key).agg(F.min("opened_at").alias("opened_at"), F.sum("open_count").alias("open_count"))


def daily_usage_stream(stream: DataFrame, delay: str = "1 day", key: str = "inbox_id") -> DataFrame:
    """Messages of each inbox and UTC day; works on a table as on a stream."""
    n = stream.withWatermark("ts", delay).groupBy(F.window("ts", "1 day"), key).agg(F.count("*").alias("used"))
    return n.select(F.col("window.start").alias("day"), key, "used")


def rolling_7d(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """T4: messages of the seven days up to each day."""
    n = stream.withWatermark("ts", delay).groupBy(F.window("ts", "7 days", "1 day")).agg(F.count("*").alias("n"))
    return n.select(F.col("window.end").alias("day_end"), "n")


def plan_batches(leads: DataFrame, campaigns: DataFrame, inboxes: DataFrame, zones: DataFrame, now: Column, limit: int = 20, window_first: bool = False) -> DataFrame:
    """T5: the send plan of one trigger: due leads, of these the ones in their window, each with an inbox.

    The first `limit` are taken before the window is looked at; window_first=True turns this round. Leads keep their
    assigned inbox while it has room (W9), in the order in which they are due; load is then not known. Leads without
    the column assigned_inbox are given to the least loaded inboxes (W8).
    """
    wanted = ("status", "timezone", "send_days", "send_start_hour", "send_end_hour")
    own = campaigns.select("campaign_id", *wanted)
    order = [F.asc_nulls_first("next_send_at"), F.asc("lead_id")]
    due = due_leads(leads, own.select("campaign_id", "status"), now, None if window_first else limit)
    opened = send_window(due.join(own.drop("status"), "campaign_id"), zones, now).filter("open")
    if window_first:
        opened = opened.orderBy(*order).limit(limit)
    if "assigned_inbox" not in leads.columns:
        return allocate_least_loaded(opened.select("lead_id", "campaign_id", "next_send_at"), inboxes, order).drop("next_send_at")
    chosen = opened.select("lead_id", "campaign_id", "assigned_inbox", "next_send_at")
    return chosen.select("lead_id", "campaign_id").join(allocate_sticky(chosen, inboxes, order), "lead_id")


def recheck_replied(batch: DataFrame, replies: DataFrame, key: str = "lead_id") -> DataFrame:
    """Rows of a batch whose lead has not replied meanwhile."""
    return batch.join(replies.select(key), key, "left_anti")


def batch_table(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """Rows that write_batch() wrote with their batch, of batches before a number only if one is given; None if there are none."""
    try:
        rows = spark.read.option("basePath", path).parquet(f"{path}/batch=*")
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return rows if before is None else rows.filter(F.col("batch") < before)


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """A sink that a batch can be run for again: its rows are in a folder of its own, which a rerun replaces as a whole."""
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def plan_after(planned: DataFrame | None, leads: DataFrame, inboxes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """T5: leads and inboxes as earlier plans (lead_id, step, inbox_id) leave them.

    A lead is planned once for each of its steps, and what an inbox is to send counts as sent.
    """
    if planned is None:
        return leads, inboxes
    steps = planned.select("lead_id", F.col("step").alias("current_step")).distinct()
    used = planned.groupBy("inbox_id").agg(F.count("*").cast("int").alias("_planned"))
    more = inboxes.join(used, "inbox_id", "left").withColumn("sent_today", F.col("sent_today") + F.coalesce("_planned", F.lit(0))).drop("_planned")
    return leads.join(steps, ["lead_id", "current_step"], "left_anti"), more


def start_plans(ticks: DataFrame, tables: Callable[[], Mapping[str, DataFrame]], path: str, checkpoint: str, limit: int = 20, every: str | None = "1 minute") -> StreamingQuery:
    """T5: at every trigger plans the leads that are due at the latest tick (ts) and writes the plan under its batch.

    tables gives leads, campaigns, inboxes, zones and, if there are any, replies; it is called anew in each batch, so a
    batch sees what came in meanwhile. A plan leaves out what earlier batches have planned and counts their messages
    against the inboxes' limits of that day (T6: and leads that have replied). A batch that fails and is run again after
    a restart has the same number and the same earlier batches, and replaces its own rows only. every=None plans what
    is there and ends.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        latest = batch.agg(F.max("ts").alias("now")).first()["now"]  # one value
        now, found = F.lit(latest), tables()
        planned = batch_table(batch.sparkSession, path, batch_id)
        today = None if planned is None else planned.filter(F.to_date("planned_at") == F.to_date(now))
        leads = found["leads"] if planned is None else plan_after(planned, found["leads"], found["inboxes"])[0]
        inboxes = found["inboxes"] if today is None else plan_after(today, found["leads"], found["inboxes"])[1]
        if "replies" in found:
            leads = recheck_replied(leads, found["replies"])
        plan = plan_batches(leads, found["campaigns"], inboxes, found["zones"], now, limit)
        steps = leads.select("lead_id", F.col("current_step").alias("step"))
        write_batch(plan.join(steps, "lead_id").withColumn("planned_at", now), path, batch_id)

    writer = ticks.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)).start()


def start_recheck(selected: DataFrame, replies: Callable[[], DataFrame], path: str, checkpoint: str, every: str | None = "1 minute") -> StreamingQuery:
    """A stream of selected leads without those that have replied by the time their batch runs.

    replies is called anew in each batch: a reply that was written after the stream began is seen.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        write_batch(recheck_replied(batch, replies()), path, batch_id)

    writer = selected.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)).start()


def fold_events(rows: list[tuple], state: tuple = ("pending", 1, 0, 0, 0), steps: int = 3, max_retries: int = 3) -> tuple:
    """The state of an address after events (ts, seq, kind) in order: send, fail, reply or unsubscribe."""
    status, step, retries, replied, out = state
    for _, _, kind in sorted(rows):
        if kind == "reply":
            replied, status = 1, "completed"
        elif kind == "unsubscribe":
            out, status = 1, "unsubscribed"
        elif status in ("pending", "active"):
            if kind == "send":
                retries = 0
                status, step = ("completed", step) if step >= steps else ("active", step + 1)
            elif kind == "fail":
                retries += 1
                status = "failed" if retries >= max_retries else status
    return status, step, retries, replied, out


def lead_state(events: DataFrame, steps: int = 3, max_retries: int = 3) -> DataFrame:
    """T1, batch: the last state of each address, folded over its events (email, ts, seq, kind) in the JVM.

    Sends and failures count only while an address is pending or active, and that ends after steps * max_retries events
    at most (each send follows fewer than max_retries failures) or with the first reply or unsubscribe. So step and
    retries come from so many first events, which each task selects before the shuffle, and later replies and
    unsubscribes from maxima: no address is gathered whole, whatever its number of events.
    """
    most = max(1, steps) * max(1, max_retries)
    place = F.row_number().over(Window.partitionBy("email").orderBy("ts", "seq", "kind"))
    first = events.filter(F.col("kind").isin("send", "fail", "reply", "unsubscribe")).withColumn("_place", place).filter(F.col("_place") <= most)
    ordered = F.array_sort(F.collect_list(F.struct("ts", "seq", "kind")))
    start = F.struct(F.lit("pending").alias("status"), F.lit(1).alias("step"), F.lit(0).alias("retries"), F.lit(0).alias("replied"), F.lit(0).alias("unsubscribed"))

    def fold(s: Column, e: Column) -> Column:
        kind, live = e["kind"], s["status"].isin("pending", "active")
        sent, failed = live & (kind == "send"), live & (kind == "fail")
        last = s["step"] >= steps
        status = (
            F.when(kind == "reply", "completed")
            .when(kind == "unsubscribe", "unsubscribed")
            .when(sent, F.when(last, "completed").otherwise("active"))
            .when(failed & (s["retries"] + 1 >= max_retries), "failed")
            .otherwise(s["status"])
        )
        return F.struct(
            status.alias("status"),
            F.when(sent & ~last, s["step"] + 1).otherwise(s["step"]).alias("step"),
            F.when(sent, 0).when(failed, s["retries"] + 1).otherwise(s["retries"]).alias("retries"),
            F.when(kind == "reply", 1).otherwise(s["replied"]).alias("replied"),
            F.when(kind == "unsubscribe", 1).otherwise(s["unsubscribed"]).alias("unsubscribed"),
        )

    folded = first.groupBy(F.col("email").alias("_email")).agg(F.aggregate(ordered, start, fold).alias("s"))
    ends = F.col("kind").isin("reply", "unsubscribe")
    given = [F.coalesce(F.max((F.col("kind") == kind).cast("int")), F.lit(0)).alias(name) for kind, name in (("reply", "replied"), ("unsubscribe", "unsubscribed"))]
    whole = events.groupBy("email").agg(F.max(F.when(ends, F.struct("ts", "seq", "kind"))).alias("last"), *given)
    joined = whole.join(folded, F.col("email").eqNullSafe(F.col("_email")), "left").withColumn("s", F.coalesce("s", start))
    status = F.when(F.col("last.kind") == "reply", "completed").when(F.col("last.kind") == "unsubscribe", "unsubscribed").otherwise(F.col("s.status"))
    return joined.select("email", status.alias("status"), "s.step", "s.retries", "replied", "unsubscribed")


def lead_state_stream(events: DataFrame, steps: int = 3, max_retries: int = 3) -> DataFrame:
    """T1, stream: the state of each address after every micro-batch, kept in the state store."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = tuple(state.get) if state.exists else ("pending", 1, 0, 0, 0)
        rows = [r for b in batches for r in b[["ts", "seq", "kind"]].itertuples(index=False, name=None)]
        now = fold_events(rows, now, steps, max_retries)
        state.update(now)
        yield pd.DataFrame([(*key, *now)], columns=["email", "status", "step", "retries", "replied", "unsubscribed"])

    return events.groupBy("email").applyInPandasWithState(step, "email string, " + STATE_SCHEMA, STATE_SCHEMA, "update", GroupStateTimeout.NoTimeout)


#: The state store that state variables, time to live and timers need; a session sets it before the query starts.
ROCKS_DB = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class LeadStates(StatefulProcessor):
    """The state of one address, with a timer for its next try after a failure.

    The state is forgotten after `keep` without an event. A failure that is not the last sets a timer half an hour later,
    twice as much after each further one; an address that is still waiting when it fires gives a row with retry_due.
    A later send, reply or unsubscribe takes the timer back.
    """

    def __init__(self, steps: int, max_retries: int, keep_ms: int, first_wait_ms: int) -> None:
        self.steps, self.max_retries, self.keep_ms, self.first_wait_ms = steps, max_retries, keep_ms, first_wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", STATE_SCHEMA, self.keep_ms)

    def _row(self, key: tuple, state: tuple, due: bool) -> pd.DataFrame:
        return pd.DataFrame([(*key, *state, due)], columns=["email", "status", "step", "retries", "replied", "unsubscribed", "retry_due"])

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        state = tuple(self.state.get()) if self.state.exists() else ("pending", 1, 0, 0, 0)
        events = sorted(r for b in rows for r in b[["ts", "seq", "kind"]].itertuples(index=False, name=None))
        state = fold_events(events, state, self.steps, self.max_retries)
        self.state.update(state)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        waits = state[0] in ("pending", "active") and state[2] > 0
        failed = max((ts for ts, _, kind in events if kind == "fail"), default=None)
        if waits and failed is not None:
            self.handle.registerTimer(int(failed.timestamp() * 1000) + self.first_wait_ms * 2 ** (state[2] - 1))
        yield self._row(key, state, False)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
        if self.state.exists():
            yield self._row(key, tuple(self.state.get()), True)

    def close(self) -> None:
        pass


def lead_state_timers(events: DataFrame, steps: int = 3, max_retries: int = 3, keep: int = 90 * 86_400, first_wait: int = 1800) -> DataFrame:
    """T1, stream: as lead_state_stream(), with time to live (seconds) and retry timers; needs the state store ROCKS_DB.

    Rows with retry_due false are the states after each micro-batch, those with true are addresses whose next try is due.
    """
    out = f"email string, {STATE_SCHEMA}, retry_due boolean"
    return events.groupBy("email").transformWithStateInPandas(LeadStates(steps, max_retries, keep * 1000, first_wait * 1000), out, "Update", "ProcessingTime")
