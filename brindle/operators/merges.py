"""Table changes as joins: a snapshot and changes in, a new snapshot out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions.numbers import backoff_minutes
from brindle.operators.campaigns import fan_out_by_email
from brindle.operators.ranking import keep_first


def upsert(base: DataFrame, changes: DataFrame, key: str, update: Sequence[str], defaults: Mapping[str, Column]) -> DataFrame:
    """M1: rows of changes update the given columns of rows with their key, or come in with defaults for the others."""
    new = changes.select(key, *[F.col(c).alias(f"_new_{c}") for c in update], F.lit(True).alias("_change"))
    both = base.withColumn("_base", F.lit(True)).join(new, key, "full_outer")
    columns = []
    for c in base.columns:
        value = F.col(c)
        if c in update:
            value = F.when(F.col("_change"), F.col(f"_new_{c}")).otherwise(value)
        elif c != key and c in defaults:
            value = F.when(F.col("_base").isNull(), defaults[c]).otherwise(value)
        columns.append(value.alias(c))
    return both.select(*columns)


def insert_ignore(base: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """M2: new rows whose key is not there yet; of several, the first."""
    fresh = keep_first(new, keys, order).join(base.select(*keys), list(keys), "left_anti")
    return base.unionByName(fresh.select(*base.columns))


def patch(base: DataFrame, patches: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """M3: fields that a patch supplies replace those of its row; has_<field> tells a null from a field left out."""
    new = patches.select(key, *[F.col(c).alias(f"_new_{c}") for c in fields], *[F.col(f"has_{c}").alias(f"_has_{c}") for c in fields])
    both = base.join(new, key, "left")
    return both.select(*[F.when(F.col(f"_has_{c}"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in base.columns])


def replace_children(children: DataFrame, parents: DataFrame, key: str, items: str, number: str, filled: str | None = None, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """M4: all children of the given parents replaced by the items of their arrays, numbered from 1; others stay.

    Items are structs with the other columns of children. Items whose column `filled` is null or blank are skipped, and
    nulls of the columns in `defaults` get the default. An empty array leaves a parent without children.
    """
    if filled:
        parents = parents.withColumn(items, F.filter(items, lambda x: F.trim(F.coalesce(x[filled], F.lit(""))) != ""))

    def with_defaults(x: Column) -> Column:
        for c, value in (defaults or {}).items():
            x = x.withField(c, F.coalesce(x[c], F.lit(value)))
        return x

    if defaults:
        parents = parents.withColumn(items, F.transform(items, with_defaults))
    new = parents.select(key, F.posexplode(items).alias("_pos", "_item")).select(key, (F.col("_pos") + 1).alias(number), "_item.*")
    return children.join(parents.select(key), key, "left_anti").unionByName(new.select(*children.columns))


def delete_cascade(tables: Mapping[str, DataFrame], root: str, keys: DataFrame, references: Sequence[tuple[str, str, str, str]]) -> dict[str, DataFrame]:
    """M5: rows of the root table with the given keys go, and with them all rows that refer to rows that went.

    references: (child table, its column, parent table, its key), parents before children.
    """
    key = keys.columns[0]
    gone = {root: tables[root].join(keys, key, "left_semi")}
    out = dict(tables) | {root: tables[root].join(keys, key, "left_anti")}
    for child, column, parent, parent_key in references:
        if parent in gone:
            lost = gone[parent].select(F.col(parent_key).alias(column)).distinct()
            gone[child] = tables[child].join(lost, column, "left_semi")
            out[child] = out[child].join(lost, column, "left_anti")
    return out


def replied_leads(leads: DataFrame, events: DataFrame) -> DataFrame:
    """M6: how many leads replies (lead_id, ts) affect, in one row: those of the addresses that have not replied before."""
    fresh = leads.filter(F.coalesce("replied", F.lit(0)) == 0).select("lead_id")
    return fan_out_by_email(events, leads).join(fresh, "lead_id", "left_semi").agg(F.countDistinct("lead_id").alias("affected"))


def apply_replies(leads: DataFrame, logs: DataFrame, events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """M6: leads and log rows after replies (lead_id, ts): every lead of the address is done, its last log row replied.

    Leads that have replied before stay as they are. The first reply time is kept, and nothing is due any more.
    """
    reached = fan_out_by_email(events, leads)
    first = reached.groupBy("lead_id").agg(F.min("ts").alias("_ts"))
    hit = F.col("_ts").isNotNull() & (F.coalesce("replied", F.lit(0)) == 0)
    leads_out = leads.join(first, "lead_id", "left").withColumn("_hit", hit)
    hit = F.col("_hit")
    if "next_send_at" in leads.columns:
        leads_out = leads_out.withColumn("next_send_at", F.when(~hit, F.col("next_send_at")))
    leads_out = leads_out.withColumn("replied_at", F.when(hit, F.coalesce("replied_at", "_ts")).otherwise(F.col("replied_at")))
    leads_out = leads_out.withColumn("replied", F.when(hit, 1).otherwise(F.col("replied"))).withColumn("status", F.when(hit, "completed").otherwise(F.col("status")))
    emails = reached.select("email").distinct()
    own = logs.join(leads.join(emails, "email", "left_semi").select("lead_id", "email"), "lead_id")
    last = own.groupBy("email").agg(F.max(F.struct("sent_at", "log_id")).alias("last")).select(F.col("last.log_id").alias("log_id"), F.lit(True).alias("_replied"))
    logs_out = logs.join(last, "log_id", "left").withColumn("status", F.when(F.col("_replied"), "replied").otherwise(F.col("status")))
    return leads_out.select(*leads.columns), logs_out.select(*logs.columns)


def apply_unsubscribes(leads: DataFrame, unsubscribes: DataFrame, events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """M7: leads and suppression list after requests (lead_id): all leads of the address, one row for the address.

    Nothing is due for these leads any more.
    """
    emails = fan_out_by_email(events, leads).select("email").distinct()
    flagged = leads.join(emails.withColumn("_out", F.lit(True)), "email", "left")
    if "next_send_at" in leads.columns:
        flagged = flagged.withColumn("next_send_at", F.when(F.col("_out").isNull(), F.col("next_send_at")))
    leads_out = flagged.withColumn("unsubscribed", F.when(F.col("_out"), 1).otherwise(F.col("unsubscribed"))).withColumn("status", F.when(F.col("_out"), "unsubscribed").otherwise(F.col("status")))
    return leads_out.select(*leads.columns), insert_ignore(unsubscribes.select("email"), emails, ["email"], [F.col("email")])


def advance(leads: DataFrame, sent: DataFrame, steps: DataFrame) -> DataFrame:
    """M8: leads after messages (lead_id, ts, inbox_id): the next step, when it is due, or completed after the last."""
    after = steps.withColumn("_delay", F.coalesce(F.lead("delay_days").over(Window.partitionBy("campaign_id").orderBy("step_number")), F.lit(0)))
    last = F.max("step_number").over(Window.partitionBy("campaign_id"))
    after = after.withColumn("_last", last).select("campaign_id", F.col("step_number").alias("current_step"), "_delay", "_last")
    both = leads.join(sent.select("lead_id", F.col("ts").alias("_ts"), F.col("inbox_id").alias("_inbox")), "lead_id", "left").join(after, ["campaign_id", "current_step"], "left")
    hit = F.col("_ts").isNotNull()
    done = F.col("_last").isNull() | (F.col("current_step") >= F.col("_last"))
    changed = {
        "status": F.when(done, "completed").otherwise("active"),
        "current_step": F.when(done, F.col("current_step")).otherwise(F.col("current_step") + 1),
        "next_send_at": F.when(~done, F.col("_ts") + F.make_dt_interval("_delay")),
        "retry_count": F.lit(0),
        "assigned_inbox": F.col("_inbox"),
    }
    return both.select(*[F.when(hit, changed[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c) for c in leads.columns])


def retry(leads: DataFrame, failures: DataFrame, limit: int = 3) -> DataFrame:
    """M9: leads after failures (lead_id, ts): one more try later, each wait twice the last; failed at the limit."""
    both = leads.join(failures.select("lead_id", F.col("ts").alias("_ts")), "lead_id", "left")
    hit, n = F.col("_ts").isNotNull(), F.col("retry_count") + 1
    changed = {
        "status": F.when(n >= limit, "failed").otherwise(F.col("status")),
        "next_send_at": F.when(n < limit, F.col("_ts") + F.make_dt_interval(F.lit(0), F.lit(0), backoff_minutes(n))).otherwise(F.col("next_send_at")),
        "retry_count": n,
    }
    return both.select(*[F.when(hit, changed[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c) for c in leads.columns])
