"""Outreach campaigns: import, due leads, allocation under caps, statistics and dashboards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions.numbers import in_send_window, pct1
from brindle.functions.text import clean_ws, fill_template, is_disposable, is_email, json_map_or_empty, message_html, message_text, parse_int_list, spin, template_variables, uniform
from brindle.operators.tables import dropped, number_rows, renumber, saved, sum_before

DEFAULT_DAYS = "1,2,3,4,5"
DEFAULT_ZONE = "Europe/Paris"


def redact(df: DataFrame, secrets: Sequence[str] = ("access_token", "refresh_token")) -> DataFrame:
    """Without the columns that hold secrets."""
    return df.drop(*secrets)


def pack_extras(df: DataFrame, known: Sequence[str], name: str = "custom_data") -> DataFrame:
    """Columns that are not known, packed into one JSON object (nulls kept)."""
    rest = [c for c in df.columns if c not in known]
    packed = F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}) if rest else F.lit("{}")
    return df.select(*[c for c in df.columns if c in known], packed.alias(name))


def with_campaign(leads: DataFrame, campaigns: DataFrame, columns: Sequence[str] = ("status",)) -> DataFrame:
    """Leads with columns of their campaign, prefixed by campaign_. AQE picks the join by the campaigns' size."""
    own = campaigns.select("campaign_id", *[F.col(c).alias(f"campaign_{c}") for c in columns])
    return leads.join(own, "campaign_id")


def due_leads(leads: DataFrame, campaigns: DataFrame, now: Column, limit: int | None = 20) -> DataFrame:
    """Leads of active campaigns that may be written to now, those never scheduled first, then by time and id.

    Needs status, unsubscribed, replied, retry_count and next_send_at. limit=None leaves all due leads.
    """
    ok = (F.col("campaign_status") == "active") & F.col("status").isin("pending", "active") & (F.col("unsubscribed") == 0) & (F.col("replied") == 0)
    ok = ok & (F.col("retry_count") < 3) & (F.col("next_send_at").isNull() | (F.col("next_send_at") <= now))
    due = with_campaign(leads, campaigns).filter(ok)
    return due if limit is None else due.orderBy(F.asc_nulls_first("next_send_at"), "lead_id").limit(limit)


def send_window(df: DataFrame, zones: DataFrame, now: Column) -> DataFrame:
    """P5: adds open, whether the local time is in the row's sending window.

    zones: the valid zone names (column zone). Unknown zones are open; empty zones and day lists take the defaults.
    """
    tz = F.coalesce(F.nullif("timezone", F.lit("")), F.lit(DEFAULT_ZONE))
    valid = zones.select(F.col("zone").alias("_zone")).distinct()
    rows = df.withColumn("_tz", tz).join(valid, F.col("_tz") == F.col("_zone"), "left")
    days = parse_int_list(F.coalesce(F.nullif("send_days", F.lit("")), F.lit(DEFAULT_DAYS)))
    within = in_send_window(now, F.coalesce("_zone", F.lit("UTC")), days, F.col("send_start_hour"), F.col("send_end_hour"))
    return rows.withColumn("open", F.when(F.col("_zone").isNull(), True).otherwise(within)).drop("_tz", "_zone")


def classify_import(rows: DataFrame, existing: DataFrame, unsubscribes: DataFrame) -> DataFrame:
    """P9 (J5, J6, W2): every uploaded row with its address in clean form and a reason.

    Reasons in order: invalid, disposable, unsubscribed, duplicate (of an existing lead of the campaign, or of an
    earlier accepted row of the file), ok. rows: file_pos, campaign_id, email and more.
    """
    clean = rows.withColumn("email", F.lower(clean_ws(F.coalesce("email", F.lit("")))))
    out = unsubscribes.select("email").distinct().withColumn("_out", F.lit(True))
    had = existing.select("campaign_id", "email").distinct().withColumn("_had", F.lit(True))
    flagged = clean.join(out, "email", "left").join(had, ["campaign_id", "email"], "left")
    early = F.when(~is_email(F.col("email")), "invalid").when(is_disposable(F.col("email")), "disposable").when(F.col("_out"), "unsubscribed").when(F.col("_had"), "duplicate")
    flagged = flagged.withColumn("_early", early)
    place = F.row_number().over(Window.partitionBy("campaign_id", "email", F.col("_early").isNull()).orderBy("file_pos"))
    reason = F.coalesce("_early", F.when(place > 1, "duplicate").otherwise("ok"))
    return flagged.withColumn("reason", reason).drop("_early", "_out", "_had")


def import_summary(classified: DataFrame) -> DataFrame:
    """Rows by reason."""
    return classified.groupBy("reason").agg(F.count("*").alias("n"))


def exclude_suppressed(df: DataFrame, unsubscribes: DataFrame, key: str = "email") -> DataFrame:
    """J5."""
    return df.join(unsubscribes.select(key), key, "left_anti")


def exclude_existing(new: DataFrame, base: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key the base does not have."""
    return new.join(base.select(*keys), list(keys), "left_anti")


exclude_pairs = exclude_existing


def campaign_logs(logs: DataFrame, leads: DataFrame, campaign_id: int, limit: int = 200) -> DataFrame:
    """The last log rows of a campaign with their leads' address and name."""
    own = logs.filter(F.col("campaign_id") == campaign_id).join(leads.select("lead_id", "email", "first_name"), "lead_id")
    return own.orderBy(F.desc("sent_at"), F.desc("log_id")).limit(limit)


def recent_logs(logs: DataFrame, leads: DataFrame, campaigns: DataFrame, n: int = 10) -> DataFrame:
    """The last log rows with address and campaign name. Only the rows of the result are joined."""
    last = logs.orderBy(F.desc("sent_at"), F.desc("log_id")).limit(n)
    names = campaigns.select("campaign_id", F.col("name").alias("campaign_name"))
    return last.join(leads.select("lead_id", "email"), "lead_id", "left").join(names, "campaign_id", "left")


def sticky_inbox(leads: DataFrame, inboxes: DataFrame) -> DataFrame:
    """Leads whose assigned inbox is active and has room left today."""
    free = inboxes.filter("status = 'active' and sent_today < daily_limit").select("inbox_id", F.col("name").alias("inbox_name"), (F.col("daily_limit") - F.col("sent_today")).alias("room"))
    return leads.join(free, leads["assigned_inbox"] == free["inbox_id"])


def with_step(leads: DataFrame, steps: DataFrame, offset: int = 0) -> DataFrame:
    """Leads with the step they are at (offset 1: the one after it); leads without such a step go."""
    wanted = steps.select("campaign_id", (F.col("step_number") - offset).alias("current_step"), "step_id", "delay_days")
    return leads.join(wanted, ["campaign_id", "current_step"])


def steps_with_variations(steps: DataFrame, variations: DataFrame) -> DataFrame:
    """Steps with their variations as an ordered array, empty for none."""
    nested = variations.groupBy("step_id").agg(F.array_sort(F.collect_list(F.struct("variant", "weight"))).alias("variations"))
    return steps.join(nested, "step_id", "left").withColumn("variations", F.coalesce("variations", F.array().cast("array<struct<variant:string,weight:int>>")))


def nest(parent: DataFrame, child: DataFrame, key: str, order: Sequence[str], name: str = "children") -> DataFrame:
    """Children of each parent as an array in the order of the given columns."""
    lists = child.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*order))).alias(name))
    return parent.join(lists, key, "left")


def total_steps(steps: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Number of steps of every campaign, 0 for none."""
    n = steps.groupBy("campaign_id").agg(F.count("*").alias("total_steps"))
    return campaigns.select("campaign_id").join(n, "campaign_id", "left").select("campaign_id", F.coalesce("total_steps", F.lit(0).cast("long")).alias("total_steps"))


def _count_if(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0)).cast("long")


def campaign_funnel(leads: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Leads of every campaign by state. Without leads the total is 0 and the sums are null."""
    n = leads.groupBy("campaign_id").agg(
        F.count("*").alias("total"),
        _count_if(F.col("status") == "completed").alias("completed"),
        _count_if(F.col("status") == "failed").alias("failed"),
        _count_if(F.col("replied") == 1).alias("replied"),
        _count_if(F.col("unsubscribed") == 1).alias("unsubscribed"),
    )
    return campaigns.select("campaign_id", "name").join(n, "campaign_id", "left").withColumn("total", F.coalesce("total", F.lit(0).cast("long")))


def campaign_stats(leads: DataFrame, campaign_id: int) -> DataFrame:
    """A2: one campaign's leads by status."""
    states = ("pending", "active", "completed", "failed")
    counts = [_count_if(F.col("status") == s).alias(s) for s in states]
    return leads.filter(F.col("campaign_id") == campaign_id).agg(F.count("*").alias("total"), *counts, _count_if(F.col("replied") == 1).alias("replied"), _count_if(F.col("unsubscribed") == 1).alias("unsubscribed"))


def variant_stats(logs: DataFrame) -> DataFrame:
    """A3: sent, opens and replies of each variant of a step, failed and unfinished rows left out."""
    n = logs.filter(~F.col("status").isin("failed", "sending")).groupBy("campaign_id", "step_number", "variant").agg(F.count("*").alias("sent"), _count_if(F.col("opened") == 1).alias("opens"), _count_if(F.col("status") == "replied").alias("replies"))
    return n.withColumn("open_rate", pct1(F.col("opens"), F.col("sent"))).withColumn("reply_rate", pct1(F.col("replies"), F.col("sent")))


def dashboard(inboxes: DataFrame, campaigns: DataFrame, leads: DataFrame, logs: DataFrame, now: Column) -> DataFrame:
    """A4: one row of totals. The five one-row aggregates are put side by side."""
    parts = [
        inboxes.agg(F.count("*").alias("inboxes"), F.sum("sent_today").alias("sent_today_total")),
        campaigns.agg(F.count("*").alias("campaigns"), _count_if(F.col("status") == "active").alias("active_campaigns")),
        leads.agg(F.count("*").alias("leads"), _count_if(F.col("replied") == 1).alias("replied")),
        logs.filter(F.to_date("sent_at") == F.to_date(now)).agg(_count_if(F.col("status") == "sent").alias("sent_today")),
        logs.filter(F.col("sent_at") >= now - F.expr("interval 7 days")).agg(_count_if(F.col("status") == "sent").alias("sent_week")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(p)  # one row each
    return out


def daily_usage(logs: DataFrame, inboxes: DataFrame, day: Column) -> DataFrame:
    """What every inbox sent on a day and what is left of its limit."""
    n = logs.filter(F.to_date("sent_at") == day).groupBy("inbox_id").agg(F.count("*").alias("used"))
    used = F.coalesce("used", F.lit(0).cast("long"))
    return inboxes.join(n, "inbox_id", "left").select("inbox_id", "daily_limit", used.alias("used"), F.greatest(F.col("daily_limit") - used, F.lit(0).cast("long")).alias("room"))


def open_stats(opens: DataFrame, logs: DataFrame) -> DataFrame:
    """First opening and number of openings of every log row; openings of unknown rows are ignored."""
    n = opens.groupBy("log_id").agg(F.min("ts").alias("opened_at"), F.count("*").alias("open_count"))
    out = logs.select("log_id").join(n, "log_id", "left").withColumn("open_count", F.coalesce("open_count", F.lit(0).cast("long")))
    return out.withColumn("opened", F.when(F.col("open_count") > 0, 1).otherwise(0))


def latest_log_per_email(logs: DataFrame, leads: DataFrame) -> DataFrame:
    """The last log row of each address, over all campaigns."""
    last = logs.join(leads.select("lead_id", "email"), "lead_id").groupBy("email").agg(F.max(F.struct("sent_at", "log_id", "status")).alias("last"))
    return last.select("email", F.col("last.log_id").alias("log_id"), F.col("last.sent_at").alias("sent_at"), F.col("last.status").alias("status"))


def logs_of_email(logs: DataFrame, leads: DataFrame, emails: DataFrame) -> DataFrame:
    """Log rows whose lead has one of the addresses."""
    own = leads.join(emails.select("email"), "email", "left_semi").select("lead_id")
    return logs.join(own, "lead_id", "left_semi")


def add_links(df: DataFrame, base: str, tracked: Column) -> DataFrame:
    """tracking_url (where wanted, by log_id) and unsubscribe_url (by lead_id)."""
    link = lambda kind, key: F.concat(F.lit(f"{base}/{kind}/"), F.col(key).cast("string"))
    return df.withColumn("tracking_url", F.when(tracked, link("t", "log_id"))).withColumn("unsubscribe_url", link("unsub", "lead_id"))


def fan_out_by_email(events: DataFrame, leads: DataFrame) -> DataFrame:
    """An event of one lead for every lead of the same address."""
    address = events.join(leads.select("lead_id", "email"), "lead_id").withColumnRenamed("lead_id", "source_lead")
    return address.join(leads.select("lead_id", "email", "campaign_id"), "email")


def lookup_lead(leads: DataFrame, refs: DataFrame) -> DataFrame:
    """Leads that a reference names by id or by address, as two equi joins."""
    by_id = leads.join(refs.select(F.col("ref").try_cast("long").alias("lead_id")).filter("lead_id is not null").distinct(), "lead_id", "left_semi")
    by_email = leads.join(refs.select(F.col("ref").alias("email")).distinct(), "email", "left_semi").select(*leads.columns)
    return by_id.union(by_email).dropDuplicates(["lead_id"])


def next_step_delay(steps: DataFrame) -> DataFrame:
    """Days until the next step, 0 after the last."""
    w = Window.partitionBy("campaign_id").orderBy("step_number")
    return steps.withColumn("next_delay", F.coalesce(F.lead("delay_days").over(w), F.lit(0)))


def pick_variation(leads: DataFrame, variations: DataFrame, seed: int, key: str = "lead_id") -> DataFrame:
    """One variation of each lead's step, with a chance by weight; weights of 0 or null count as 1.

    leads: key and step_id. The draw is a hash of key and seed. A step's variations are its bounded list of choices.
    """
    weight = F.coalesce(F.nullif("weight", F.lit(0)), F.lit(1))
    upto = F.sum("_w").over(Window.partitionBy("step_id").orderBy("variant"))
    ranges = variations.withColumn("_w", weight).withColumn("_hi", upto).groupBy("step_id").agg(F.sum("_w").alias("_total"), F.array_sort(F.collect_list(F.struct("_hi", "variant"))).alias("_choices"))
    joined = leads.join(ranges, "step_id").withColumn("_u", uniform(F.col(key), seed, "variant") * F.col("_total"))
    chosen = F.get(F.filter("_choices", lambda c: c["_hi"] > F.col("_u")), 0)["variant"]
    return joined.withColumn("variant", chosen).drop("_total", "_choices", "_u")


def render_messages(leads: DataFrame, variations: DataFrame, seed: int, base: str) -> DataFrame:
    """The next message of each lead: subject, HTML and plain text, with its variables and links filled in.

    leads: lead_id, step_id, first_name, last_name, email, company, custom_data (JSON), log_id, and the campaign's
    track_opens, show_unsubscribe and unsubscribe_text; variations: step_id, variant, weight, subject and body. Choices
    in braces are drawn by lead and seed, then {{name}} is replaced by the lead's variables, custom ones first. Opened
    messages are tracked and the unsubscribe line is added only where the campaign wants them (not 0). A null subject or
    body is empty; leads of steps without variations get no message.

    Leads are dealt over all tasks first, as a small file of leads may come as one part; a lead's variables are made once
    for all its templates.
    """
    picked = pick_variation(leads.repartition("lead_id"), variations.select("step_id", "variant", "weight"), seed)
    own = picked.join(variations.select("step_id", "variant", F.coalesce("subject", F.lit("")).alias("_subject"), F.coalesce("body", F.lit("")).alias("_body")), ["step_id", "variant"])
    variables = template_variables(F.col("first_name"), F.col("last_name"), F.col("email"), F.col("company"), json_map_or_empty(F.col("custom_data")))
    own = own.withColumn("_variables", variables)
    filled = {name: fill_template(spin(F.col(f"_{name}"), F.col("lead_id"), seed + k), F.col("_variables")) for k, name in enumerate(("subject", "body"))}
    linked = add_links(own.withColumns(filled), base, (F.coalesce("track_opens", F.lit(0)) != 0) & F.col("log_id").isNotNull())
    unsubscribe = F.when(F.coalesce("show_unsubscribe", F.lit(0)) != 0, F.col("unsubscribe_url"))
    html = message_html(F.col("body"), unsubscribe, F.col("unsubscribe_text"), F.col("tracking_url"))
    return linked.select("lead_id", "variant", "subject", html.alias("html"), message_text(F.col("body")).alias("plain"), unsubscribe.alias("list_unsubscribe"))


def _slots(inboxes: DataFrame) -> DataFrame:
    """A row for every message that an active inbox may still send, with the load at which it would."""
    free = inboxes.filter("status = 'active' and daily_limit > 0 and sent_today < daily_limit")
    slot = F.explode(F.sequence(F.col("sent_today"), F.col("daily_limit") - 1))
    return free.select("inbox_id", "daily_limit", slot.alias("slot")).withColumn("load", F.col("slot") / F.col("daily_limit"))


def allocate_least_loaded(leads: DataFrame, inboxes: DataFrame, order: Sequence[str | Column] = ("lead_id",)) -> DataFrame:
    """Each lead in order goes to the inbox with the lowest share of its limit used; leads beyond all limits go.

    Always taking the least loaded inbox is a merge of the inboxes' slots by load, so the n-th lead gets the n-th slot.
    Leads and slots are numbered by ranges of their order and joined by number; no task sees all of either.
    """
    ranked = number_rows(_slots(inboxes), ["load", "inbox_id", "slot"], "_n")
    numbered = number_rows(leads, order, "_n")
    return numbered.join(ranked, "_n").select(*leads.columns, "inbox_id", F.round("load", 6).alias("load"))


def allocate_sticky(leads: DataFrame, inboxes: DataFrame, order: Sequence[str | Column] = ("lead_id",)) -> DataFrame:
    """Leads one after the other; each takes its assigned inbox if that has room, else the least loaded one.

    leads: lead_id, assigned_inbox and the columns of the order. A lead whose inbox is unknown, inactive or full is like
    one without. Returns lead_id, inbox_id and sticky; leads beyond all limits go.

    The result is that of the loop, as the one solution of a condition on slots. Slots are numbered by load and inbox;
    leads without an inbox take them in that order, as loads only grow, and the leads of an inbox take its slots in
    order. So a slot goes to the earlier of two leads: the next one without an inbox, which is known from the number of
    smaller slots that such leads have taken, and the next one of its inbox, known from the number of the inbox's
    smaller slots that its own leads have taken. Leads that find their inbox full are those of it beyond the slots that
    its leads have taken; they stand among those without. Each slot depends on smaller ones only, so sums over the last
    round's answers, taken again and again, settle from the smallest slot on: in some 3 to 30 rounds on tables of
    84 to 9,681 slots. A lead beyond the number of all slots can get none and is left out before.

    Numbers and sums are made by ranges; a round writes one row for each slot, the day's sending limit.
    """
    slots = number_rows(_slots(inboxes).withColumnRenamed("inbox_id", "inbox"), ["load", "inbox", "slot"], "rank")
    inside = Window.partitionBy("inbox").orderBy("rank")  # an inbox has as many slots as its daily limit
    slots = saved(slots.withColumn("at", F.row_number().over(inside) - 1).select("rank", "inbox", "at"), "slots")
    known = slots.select(F.col("inbox").alias("assigned_inbox")).distinct().withColumn("_open", F.lit(True))
    queue = number_rows(leads, order, "place").select("place", "lead_id", "assigned_inbox")
    queue = queue.crossJoin(F.broadcast(slots.agg(F.count("*").alias("_room")))).filter("place <= _room").join(known, "assigned_inbox", "left")  # one row
    queue = saved(queue.select("place", "lead_id", "assigned_inbox", F.when(F.col("_open"), F.col("assigned_inbox")).alias("own")), "queue")
    turns = number_rows(queue.filter("own is not null").select("own", "place"), ["own", "place"], "_n")
    firsts = turns.groupBy("own").agg(F.min("_n").alias("_first"))
    turns = saved(turns.join(firsts, "own").select(F.col("own").alias("inbox"), (F.col("_n") - F.col("_first")).alias("turn"), F.col("place").alias("own_place")), "turns")
    free = queue.filter("own is null").select("place")
    # free: 1 for slots that go to leads without an inbox.
    state = saved(slots.select("rank", "inbox", "at", F.lit(1).alias("free")), "slots")
    while True:
        stay = state.groupBy("inbox").agg(F.sum(1 - F.col("free")).alias("_stay"))
        full = turns.join(stay, "inbox").filter("turn >= _stay").select(F.col("own_place").alias("place"))
        next_free = renumber(free.unionByName(full), "place", "_n").select((F.col("_n") - 1).alias("_taken"), F.col("place").alias("free_place"))
        before = F.coalesce(F.sum("free").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        asked = sum_before(state, "rank", F.col("free"), "_taken").withColumn("turn", F.col("at") - before)
        asked = asked.join(next_free, "_taken", "left").join(turns, ["inbox", "turn"], "left")
        wins = F.coalesce(F.col("free_place") < F.col("own_place"), F.col("free_place").isNotNull())
        place = F.when(wins, F.col("free_place")).otherwise(F.col("own_place"))
        now = saved(asked.select("rank", "inbox", "at", wins.cast("int").alias("free"), place.alias("place"), (wins.cast("int") != F.col("free")).alias("changed")), "slots")
        dropped(state)
        state = now
        if state.filter("changed").isEmpty():
            break
    taken = state.join(queue.select("place", "lead_id", "assigned_inbox"), "place")
    return taken.select("lead_id", F.col("inbox").alias("inbox_id"), F.coalesce(F.col("assigned_inbox") == F.col("inbox"), F.lit(False)).alias("sticky"))
