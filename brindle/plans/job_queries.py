"""Registered queries of table changes, streams and templates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.functions import numbers, text
from brindle.operators import campaigns, merges
from brindle.plans.base import ZONES, View, now, query
from brindle.sources import writers
from brindle.streaming import jobs


@query("SELECT coalesce(b.c_custkey, n.k) AS c_custkey, coalesce(n.name, b.c_name) AS c_name, CASE WHEN b.c_custkey IS NULL THEN 'NEW' ELSE b.c_mktsegment END AS c_mktsegment FROM customer b FULL JOIN (SELECT s_suppkey * 20 AS k, s_name AS name FROM supplier) n ON n.k = b.c_custkey")
def upsert(v: View) -> DataFrame:
    base = v("customer").select("c_custkey", "c_name", "c_mktsegment")
    changes = v("supplier").select((F.col("s_suppkey") * 20).alias("c_custkey"), F.col("s_name").alias("c_name"))
    return merges.upsert(base, changes, "c_custkey", ["c_name"], {"c_mktsegment": F.lit("NEW")})


@query("SELECT email FROM fx_unsubscribes UNION SELECT DISTINCT email FROM fx_leads WHERE lead_id % 11 = 0")
def insert_ignore(v: View) -> DataFrame:
    new = v("fx_leads").filter("lead_id % 11 = 0").select("email")
    return merges.insert_ignore(v("fx_unsubscribes"), new, ["email"], [F.col("email")])


@query("SELECT lead_id, CASE WHEN lead_id % 4 = 0 THEN 'patched' ELSE status END AS status, CASE WHEN lead_id % 6 = 0 THEN NULL ELSE company END AS company FROM fx_leads")
def patch(v: View) -> DataFrame:
    base = v("fx_leads").select("lead_id", "status", "company")
    patches = base.filter("lead_id % 4 = 0 or lead_id % 6 = 0").select("lead_id", F.lit("patched").alias("status"), (F.col("lead_id") % 4 == 0).alias("has_status"), F.lit(None).cast("string").alias("company"), (F.col("lead_id") % 6 == 0).alias("has_company"))
    return merges.patch(base, patches, "lead_id", ["status", "company"])


@query("SELECT campaign_id, step_number, step_id FROM fx_steps WHERE campaign_id % 5 <> 0 UNION ALL SELECT campaign_id, n, campaign_id * 100 + n FROM (SELECT DISTINCT campaign_id FROM fx_campaigns WHERE campaign_id % 5 = 0), (VALUES (1), (2)) t(n)")
def replace_children(v: View) -> DataFrame:
    parents = v("fx_campaigns").filter("campaign_id % 5 = 0").select("campaign_id", F.array(*[F.struct((F.col("campaign_id") * 100 + n).alias("step_id")) for n in (1, 2)]).alias("items"))
    return merges.replace_children(v("fx_steps").select("campaign_id", "step_number", "step_id"), parents, "campaign_id", "items", "step_number")


@query("SELECT 'leads' AS t, count(*) AS n FROM fx_leads WHERE campaign_id % 3 <> 0 UNION ALL SELECT 'logs', count(*) FROM fx_email_logs WHERE lead_id NOT IN (SELECT lead_id FROM fx_leads WHERE campaign_id % 3 = 0) UNION ALL SELECT 'steps', count(*) FROM fx_steps WHERE campaign_id % 3 <> 0")
def delete_cascade(v: View) -> DataFrame:
    tables = {"campaigns": v("fx_campaigns"), "leads": v("fx_leads"), "logs": v("fx_email_logs"), "steps": v("fx_steps")}
    keys = v("fx_campaigns").filter("campaign_id % 3 = 0").select("campaign_id")
    left = merges.delete_cascade(tables, "campaigns", keys, [("leads", "campaign_id", "campaigns", "campaign_id"), ("steps", "campaign_id", "campaigns", "campaign_id"), ("logs", "lead_id", "leads", "lead_id")])
    counts = [left[t].agg(F.count("*").alias("n")).select(F.lit(t).alias("t"), "n") for t in ("leads", "logs", "steps")]
    return counts[0].union(counts[1]).union(counts[2])


HIT = "(SELECT b.lead_id, min(r.ts) AS ts FROM fx_requests r JOIN fx_leads a ON a.lead_id = r.lead_id JOIN fx_leads b ON b.email = a.email GROUP BY 1)"


@query(f"SELECT l.lead_id, CASE WHEN h.lead_id IS NULL THEN l.replied ELSE 1 END AS replied, CASE WHEN h.lead_id IS NULL OR l.replied = 1 THEN l.status ELSE 'completed' END AS status, CASE WHEN h.lead_id IS NULL OR l.replied = 1 THEN epoch_us(next_send_at) END AS due_us FROM fx_due_leads l LEFT JOIN {HIT} h ON h.lead_id = l.lead_id")
def apply_replies(v: View) -> DataFrame:
    requests = v("fx_requests").withColumn("ts", F.col("ts").cast("timestamp"))
    return merges.apply_replies(v("fx_due_leads"), v("fx_email_logs"), requests)[0].select("lead_id", "replied", "status", F.unix_micros("next_send_at").alias("due_us"))


@query("WITH e AS (SELECT DISTINCT a.email FROM fx_requests r JOIN fx_leads a ON a.lead_id = r.lead_id), x AS (SELECT log_id, row_number() OVER (PARTITION BY email ORDER BY sent_at DESC, log_id DESC) AS r FROM fx_email_logs g JOIN fx_leads l ON l.lead_id = g.lead_id WHERE email IN (SELECT email FROM e)) SELECT log_id, CASE WHEN log_id IN (SELECT log_id FROM x WHERE r = 1) THEN 'replied' ELSE status END AS status FROM fx_email_logs")
def apply_replies_logs(v: View) -> DataFrame:
    requests = v("fx_requests").withColumn("ts", F.col("ts").cast("timestamp"))
    return merges.apply_replies(v("fx_due_leads"), v("fx_email_logs"), requests)[1].select("log_id", "status")


@query("WITH e AS (SELECT DISTINCT a.email FROM fx_requests r JOIN fx_leads a ON a.lead_id = r.lead_id) SELECT lead_id, CASE WHEN email IN (SELECT email FROM e) THEN 1 ELSE unsubscribed END AS unsubscribed, CASE WHEN email IN (SELECT email FROM e) THEN 'unsubscribed' ELSE status END AS status FROM fx_leads")
def apply_unsubscribes(v: View) -> DataFrame:
    return merges.apply_unsubscribes(v("fx_leads"), v("fx_unsubscribes"), v("fx_requests"))[0].select("lead_id", "unsubscribed", "status")


@query("SELECT email FROM fx_unsubscribes UNION SELECT b.email FROM fx_requests r JOIN fx_leads b ON b.lead_id = r.lead_id")
def suppressed_addresses(v: View) -> DataFrame:
    """M7: the second result."""
    return merges.apply_unsubscribes(v("fx_leads"), v("fx_unsubscribes"), v("fx_requests"))[1].select("email")


@query("SELECT l.lead_id, epoch_us(CASE WHEN r.lead_id IS NOT NULL AND retry_count < 2 THEN r.ts + INTERVAL '1' MINUTE * cast(30 * pow(2, retry_count) AS int) ELSE next_send_at END) AS due_us FROM fx_due_leads l LEFT JOIN fx_requests r ON r.lead_id = l.lead_id")
def retry_times(v: View) -> DataFrame:
    """M9: when failed leads are tried again."""
    failures = v("fx_requests").select("lead_id", F.col("ts").cast("timestamp").alias("ts"))
    return merges.retry(v("fx_due_leads"), failures).select("lead_id", F.unix_micros("next_send_at").alias("due_us"))


@query("""SELECT l.lead_id, CASE WHEN r.lead_id IS NULL THEN l.status WHEN l.current_step >= 3 THEN 'completed' ELSE 'active' END AS status, cast(CASE WHEN r.lead_id IS NOT NULL AND l.current_step < 3 THEN l.current_step + 1 ELSE l.current_step END AS int) AS current_step,
 CASE WHEN r.lead_id IS NULL THEN retry_count ELSE 0 END AS retry_count, date_diff('hour', TIMESTAMP '2024-01-01 00:00:00', date_trunc('hour', CASE WHEN r.lead_id IS NULL THEN next_send_at WHEN l.current_step < 3 THEN r.ts + INTERVAL '1' DAY * (CASE l.current_step WHEN 1 THEN 2 ELSE 4 END) END)) AS due_hour FROM fx_due_leads l LEFT JOIN fx_requests r ON r.lead_id = l.lead_id""")
def advance(v: View) -> DataFrame:
    sent = v("fx_requests").select("lead_id", F.col("ts").cast("timestamp").alias("ts"), F.lit(1).alias("inbox_id"))
    out = merges.advance(v("fx_due_leads"), sent, v("fx_steps"))
    hours = F.floor((F.unix_seconds("next_send_at") - F.unix_seconds(F.lit("2024-01-01 00:00:00").cast("timestamp"))) / 3600)
    return out.select("lead_id", "status", "current_step", "retry_count", hours.alias("due_hour"))


@query("SELECT l.lead_id, cast(CASE WHEN r.lead_id IS NULL THEN retry_count ELSE retry_count + 1 END AS int) AS retry_count, CASE WHEN r.lead_id IS NOT NULL AND retry_count + 1 >= 3 THEN 'failed' ELSE status END AS status FROM fx_due_leads l LEFT JOIN fx_requests r ON r.lead_id = l.lead_id")
def retry(v: View) -> DataFrame:
    failures = v("fx_requests").select("lead_id", F.col("ts").cast("timestamp").alias("ts"))
    return merges.retry(v("fx_due_leads"), failures).select("lead_id", "retry_count", "status")


@query("SELECT log_id, coalesce(nullif(variant, ''), 'A') AS variant, status FROM (SELECT log_id, CASE WHEN log_id % 5 = 0 THEN '' ELSE variant END AS variant, status FROM fx_email_logs)")
def log_defaults(v: View) -> DataFrame:
    logs = v("fx_email_logs").withColumn("variant", F.when(F.col("log_id") % 5 == 0, "").otherwise(F.col("variant")))
    return writers.log_defaults(logs).select("log_id", "variant", "status")


@query("SELECT lead_id, 'Dear ' || first_name || ' of ' || CASE WHEN lead_id % 2 = 0 THEN 'custom' ELSE company END || ': ' AS message FROM fx_leads")
def fill_template(v: View) -> DataFrame:
    custom = F.when(F.col("lead_id") % 2 == 0, F.create_map(F.lit("company"), F.lit("custom"))).otherwise(F.create_map().cast("map<string,string>"))
    variables = text.template_variables(F.col("first_name"), F.lit(None).cast("string"), F.col("email"), F.col("company"), custom)
    return v("fx_leads").select("lead_id", text.fill_template(F.lit("Dear {{firstName}} of {{company}}: {{nothing}}"), variables).alias("message"))


def message_leads(v: View) -> DataFrame:
    """Leads at their step with what messages need; every third campaign tracks openings, every second shows the link."""
    at = campaigns.with_step(v("fx_leads"), v("fx_steps"))
    custom = F.when(F.col("lead_id") % 4 == 0, '{"company":"custom"}').when(F.col("lead_id") % 4 == 1, "{bad")
    flags = {"track_opens": (F.col("campaign_id") % 3 == 0).cast("int"), "show_unsubscribe": (F.col("campaign_id") % 2).cast("int"), "unsubscribe_text": F.when(F.col("campaign_id") % 5 == 1, "Stop")}
    return at.withColumns({"last_name": F.lit("Doe"), "custom_data": custom, "log_id": F.col("lead_id") + 100, **flags})


BODY = "Dear {{fullName}},\n\nnews for {{company}}{{nothing}}.<br/>Bye"


@query()
def render_messages(v: View) -> DataFrame:
    """Each lead's next message, with choices in braces."""
    variations = v("fx_variations").withColumn("body", F.concat(F.lit("{Dear|Hello} {{firstName}}\n"), F.col("variant")))
    return campaigns.render_messages(message_leads(v), variations, 7, "https://example.org")


@query("""SELECT lead_id, 'A' AS variant, 'For ' || email AS subject, '<!DOCTYPE html><html><body style="font-family:Arial,sans-serif;">Dear ' || first_name || ' Doe,<br><br>news for ' || CASE WHEN lead_id % 4 = 0 THEN 'custom' ELSE company END || '.<br/>Bye'
 || CASE WHEN l.campaign_id % 2 = 1 THEN '<br><br><p style="font-size:11px;color:#999;font-family:Arial,sans-serif;"><a href="https://example.org/unsub/' || lead_id || '" style="color:#999;text-decoration:underline;">' || CASE WHEN l.campaign_id % 5 = 1 THEN 'Stop' ELSE 'Unsubscribe' END || '</a></p>' ELSE '' END
 || CASE WHEN l.campaign_id % 3 = 0 THEN '<img src="https://example.org/t/' || (lead_id + 100) || '" width="1" height="1" alt="" style="display:none;width:1px;height:1px;border:0;" />' ELSE '' END || '</body></html>' AS html,
 'Dear ' || first_name || ' Doe,' || chr(10) || chr(10) || 'news for ' || CASE WHEN lead_id % 4 = 0 THEN 'custom' ELSE company END || '.' || chr(10) || 'Bye' AS plain, CASE WHEN l.campaign_id % 2 = 1 THEN 'https://example.org/unsub/' || lead_id END AS list_unsubscribe
 FROM fx_leads l JOIN fx_steps s ON s.campaign_id = l.campaign_id AND s.step_number = l.current_step""")
def message_bodies(v: View) -> DataFrame:
    """D9 without choices: one variation for each step."""
    one = v("fx_steps").select("step_id", F.lit("A").alias("variant"), F.lit(1).alias("weight"), F.lit("For {{email}}").alias("subject"), F.lit(BODY).alias("body"))
    return campaigns.render_messages(message_leads(v), one, 7, "https://example.org")


@query("SELECT lead_id, email, company FROM fx_leads")
def encryption_round_trip(v: View) -> DataFrame:
    key = "0123456789abcdef0123456789abcdef"
    rows = v("fx_leads").select("lead_id", "email", "company")
    return writers.decrypt_columns(writers.encrypt_columns(rows, ["email", "company"], key), ["email", "company"], key)


KINDS = "CASE event_type WHEN 'purchase' THEN 'reply' WHEN 'error' THEN 'fail' WHEN 'signup' THEN 'unsubscribe' ELSE 'send' END"


def state_events(events: DataFrame, leads: DataFrame) -> DataFrame:
    rows = events.select(F.col("user_id").alias("lead_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"), F.expr(KINDS).alias("kind"))
    return rows.join(leads.select("lead_id", "email"), "lead_id")


@query(f"""WITH e AS (SELECT email, ts, event_id AS seq, {KINDS} AS kind FROM events JOIN fx_leads ON lead_id = user_id), l AS (SELECT email, max(CASE WHEN kind = 'reply' THEN 1 ELSE 0 END) AS replied, max(CASE WHEN kind = 'unsubscribe' THEN 1 ELSE 0 END) AS unsubscribed, arg_max(kind, (ts, seq)) FILTER (WHERE kind IN ('reply', 'unsubscribe')) AS last FROM e GROUP BY 1)
 SELECT email, replied, unsubscribed, CASE last WHEN 'reply' THEN 'completed' ELSE 'unsubscribed' END AS status FROM l WHERE last IS NOT NULL""")
def lead_state(v: View) -> DataFrame:
    out = jobs.lead_state(state_events(v("events"), v("fx_leads")))
    return out.filter("replied = 1 or unsubscribed = 1").select("email", "replied", "unsubscribed", "status")


@query()
def lead_state_all(v: View) -> DataFrame:
    """T1 for every address with all columns; lead_state above has only what its SQL can say."""
    return jobs.lead_state(state_events(v("events"), v("fx_leads")))


@query("SELECT epoch_us(time_bucket(INTERVAL '1' DAY, ts)) AS day_us, user_id % 10 AS inbox_id, count(*) AS used FROM events GROUP BY 1, 2")
def daily_usage_windows(v: View) -> DataFrame:
    rows = v("events").select((F.col("user_id") % 10).alias("inbox_id"), F.col("ts").cast("timestamp").alias("ts"))
    return jobs.daily_usage_stream(rows).select(F.unix_micros("day").alias("day_us"), "inbox_id", "used")


@query("WITH d AS (SELECT date_trunc('day', ts) AS d FROM events) SELECT epoch_us(d + INTERVAL '1' DAY * i) AS end_us, count(*) AS n FROM d, range(1, 8) t(i) GROUP BY 1")
def rolling_7d(v: View) -> DataFrame:
    rows = v("events").select(F.col("ts").cast("timestamp").alias("ts"))
    return jobs.rolling_7d(rows).select(F.unix_micros("day_end").alias("end_us"), "n")


@query("SELECT event_id % 500 AS log_id, epoch_us(min(ts)) AS first_us, count(*) AS open_count FROM events WHERE event_type = 'view' GROUP BY 1")
def open_counts(v: View) -> DataFrame:
    rows = v("events").filter("event_type = 'view'").select((F.col("event_id") % 500).alias("log_id"), F.col("ts").cast("timestamp").alias("ts"))
    return jobs.open_counts(rows).select("log_id", F.unix_micros("opened_at").alias("first_us"), "open_count")


@query("SELECT l, epoch_us(d) AS day_us, epoch_us(min(ts)) AS first_us, count(*) AS open_count FROM (SELECT DISTINCT event_id, event_id % 500 AS l, ts, date_trunc('day', ts) AS d FROM events WHERE event_type = 'view') GROUP BY 1, 2")
def open_counts_once(v: View) -> DataFrame:
    """T2 over a table in which every event comes twice."""
    rows = v("events").filter("event_type = 'view'").select("event_id", (F.col("event_id") % 500).alias("l"), F.col("ts").cast("timestamp").alias("ts"))
    daily = jobs.open_counts_once(rows.unionByName(rows), key="l")
    return daily.select("l", F.unix_micros("window.start").alias("day_us"), F.unix_micros("opened_at").alias("first_us"), "open_count")


@query()
def plan_batches(v: View) -> DataFrame:
    frame = v("fx_campaigns")
    zones = frame.sparkSession.createDataFrame([(z,) for z in ZONES], "zone string")
    return jobs.plan_batches(v("fx_due_leads"), frame, v("fx_inboxes"), zones, now(), 200, window_first=True)


@query("SELECT lead_id FROM fx_leads WHERE lead_id NOT IN (SELECT lead_id FROM fx_requests)")
def recheck_replied(v: View) -> DataFrame:
    return jobs.recheck_replied(v("fx_leads").select("lead_id"), v("fx_requests"))


@query("SELECT log_id, CASE WHEN variant = 'A' THEN concat('https://example.org/t/', cast(log_id AS varchar)) END AS tracking_url, concat('https://example.org/unsub/', cast(lead_id AS varchar)) AS unsubscribe_url FROM fx_email_logs")
def add_links(v: View) -> DataFrame:
    return campaigns.add_links(v("fx_email_logs"), "https://example.org", F.col("variant") == "A").select("log_id", "tracking_url", "unsubscribe_url")


@query(f"SELECT count(*) AS affected FROM {HIT} JOIN fx_leads USING (lead_id) WHERE replied = 0")
def replied_leads(v: View) -> DataFrame:
    return merges.replied_leads(v("fx_leads"), v("fx_requests").withColumn("ts", F.col("ts").cast("timestamp")))


@query("SELECT event_id, cast(cast(ts AS TIMESTAMP) + INTERVAL '3' DAY AS DATE) AS due FROM events")
def days_after(v: View) -> DataFrame:
    return v("events").select("event_id", F.to_date(numbers.days_after(F.col("ts").cast("timestamp"), F.lit(3))).alias("due"))
