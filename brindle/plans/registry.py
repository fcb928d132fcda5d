"""Registered queries of priors and campaigns: each applies an operator to whole tables; its DuckDB twin states the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.functions import text
from brindle.operators import campaigns, priors
from brindle.plans.base import NOW, ORACLES, QUERIES, ZONES, View, now, query
from brindle.sources import writers

# Market priors

CLEAN = """WITH t AS (SELECT upper(trim(country)) AS country, regexp_extract(cpv, '[0-9]{2}', 0) AS division, lower(regexp_replace(trim(buyer_name), '\\s+', ' ', 'g')) AS buyer_key, record_id, value, upper(trim(currency)) AS currency
 FROM fx_tenders WHERE lower(evidence_grain) NOT LIKE '%award_first%' AND upper(source) NOT IN ('USA','USA_FEDERAL','USASPENDING','AU_AUSTENDER_AWARD_FIRST','AUSTRALIA_AWARD_FIRST'))"""
CELLS = CLEAN + """, cells AS (SELECT country, division, count(DISTINCT record_id) AS sample_size, count(DISTINCT buyer_key) AS unique_buyers, count(*) / count(DISTINCT buyer_key) AS per_buyer FROM t
 WHERE country <> '' AND division <> '' AND buyer_key <> '' GROUP BY 1, 2 HAVING count(DISTINCT record_id) >= 20)"""
BUYERS = CLEAN + """, buyers AS (SELECT country, buyer_key, count(DISTINCT record_id) AS sample_size, count(DISTINCT division) AS cpv_diversity FROM t WHERE country <> '' AND buyer_key <> '' GROUP BY 1, 2 HAVING count(DISTINCT record_id) >= 8)"""


def picked(table: str, col: str) -> str:
    return f"SELECT list_sort(list({col}))[greatest(0, cast(floor(count(*) * 0.25) AS bigint) - 1) + 1] AS lo, list_sort(list({col}))[least(count(*) - 1, cast(floor(count(*) * 0.75) AS bigint)) + 1] AS hi FROM {table}"


def bonus(col: str, span: int) -> str:
    return f"CASE WHEN hi <= lo THEN 0 ELSE cast(round_even((greatest(0.0, least(1.0, ({col} - lo) / (hi - lo))) * 2 - 1) * {span}, 0) AS int) END"


def tenders(v: View) -> DataFrame:
    return priors.normalised(priors.exclude_award_first(priors.resolve_roles(v("fx_tenders"))))


@query(CELLS + " SELECT country, division, sample_size, unique_buyers, round(per_buyer, 6) AS per_buyer FROM cells")
def country_class_prior(v: View) -> DataFrame:
    return priors.country_class_prior(tenders(v)).withColumn("per_buyer", F.round("per_buyer", 6))


@query(BUYERS + " SELECT * FROM buyers")
def buyer_prior(v: View) -> DataFrame:
    return priors.buyer_prior(tenders(v))


@query(CLEAN + """ SELECT country, division, currency, count(d) AS n, round(median(d), 4) AS median, round(quantile_cont(d, 0.75), 4) AS p75 FROM (SELECT *, CASE WHEN try_cast(value AS double) > 1 THEN try_cast(value AS double) END AS d FROM t WHERE country <> '' AND division <> '')
 GROUP BY 1, 2, 3 HAVING count(d) >= 10""")
def value_stats(v: View) -> DataFrame:
    return priors.value_stats(tenders(v)).withColumns({"median": F.round("median", 4), "p75": F.round("p75", 4)})


@query(CELLS + f", q AS ({picked('cells', 'per_buyer')}) SELECT round(lo, 6) AS lo, round(hi, 6) AS hi FROM q")
def rank_select(v: View) -> DataFrame:
    return priors.rank_select(priors.country_class_prior(tenders(v)), "per_buyer").select(F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"))


@query(CELLS + f", q AS ({picked('cells', 'per_buyer')}) SELECT concat_ws('|', country, division) AS key, {bonus('per_buyer', 8)} AS priority_bonus FROM cells, q")
def country_class_bonus(v: View) -> DataFrame:
    scored = priors.with_bonus(priors.country_class_prior(tenders(v)), "per_buyer", 8)
    return scored.select(text.composite_key(F.col("country"), F.col("division")).alias("key"), "priority_bonus")


@query(BUYERS + f", q AS ({picked('buyers', 'sample_size')}) SELECT country, buyer_key, {bonus('sample_size', 6)} AS priority_bonus FROM buyers, q")
def buyer_bonus(v: View) -> DataFrame:
    return priors.with_bonus(priors.buyer_prior(tenders(v)), "sample_size", 6, 8.0).select("country", "buyer_key", "priority_bonus")


@query(CELLS + BUYERS.removeprefix(CLEAN) + ", vals AS (SELECT count(*) AS n FROM (SELECT 1 FROM t WHERE country <> '' AND division <> '' AND try_cast(value AS double) > 1 GROUP BY country, division, currency HAVING count(*) >= 10)) SELECT (SELECT count(*) FROM cells) AS country_class_cells, (SELECT count(*) FROM buyers) AS buyer_cells, (SELECT n FROM vals) AS value_cells")
def priors_qa(v: View) -> DataFrame:
    t = tenders(v)
    return priors.priors_qa(priors.country_class_prior(t), priors.buyer_prior(t), priors.value_stats(t))


@query()
def priors_document(v: View) -> DataFrame:
    t = tenders(v)
    cells = priors.with_bonus(priors.country_class_prior(t), "per_buyer", 8)
    return writers.priors_document(cells, priors.with_bonus(priors.buyer_prior(t), "sample_size", 6, 8.0), {"cpv": "cpv", "buyer": "buyer_name"})


@query(
    CELLS
    + BUYERS.removeprefix(CLEAN)
    + f""", q AS ({picked('cells', 'per_buyer')}), r AS ({picked('buyers', 'sample_size')})
 SELECT 'country_cpv' AS section, country || '|' || division AS key, sample_size, unique_buyers AS second, {bonus('per_buyer', 8)} AS priority_bonus FROM cells, q
 UNION ALL SELECT 'buyers', lower(country) || '|' || buyer_key, sample_size, cpv_diversity, {bonus('sample_size', 6)} FROM buyers, r"""
)
def prior_cells(v: View) -> DataFrame:
    t = tenders(v)
    rows = writers.prior_cells(priors.with_bonus(priors.country_class_prior(t), "per_buyer", 8), priors.with_bonus(priors.buyer_prior(t), "sample_size", 6, 8.0))
    part = lambda *names: F.coalesce(*[F.get_json_object("cell", f"$.{n}") for n in names]).cast("long")
    return rows.select("section", "key", part("sample_size").alias("sample_size"), part("unique_buyers", "cpv_diversity").alias("second"), part("priority_bonus").cast("int").alias("priority_bonus"))


@query("SELECT record_id, country, cpv, buyer_name AS buyer FROM fx_tenders")
def resolve_roles(v: View) -> DataFrame:
    return priors.resolve_roles(v("fx_tenders")).select("record_id", "country", "cpv", "buyer")


@query("""WITH u AS (UNPIVOT (SELECT coalesce(cast(event_id AS varchar), '') AS event_id, coalesce(cast(ts AS varchar), '') AS ts, coalesce(cast(user_id AS varchar), '') AS user_id, coalesce(event_type, '') AS event_type, coalesce(cast(value AS varchar), '') AS value, coalesce(props, '') AS props FROM events) ON event_id, ts, user_id, event_type, value, props INTO NAME col VALUE val)
 SELECT col AS "column", count(*) AS n_rows, count(*) FILTER (WHERE upper(trim(val)) IN ('', 'UNKNOWN', 'NULL', 'NONE', 'N/A')) AS n_nullish, least(count(DISTINCT nullif(trim(val), '')), 1000) AS n_distinct FROM u GROUP BY col""")
def profile_table(v: View) -> DataFrame:
    return priors.profile_table(v("events"))


@query("SELECT count(DISTINCT source) AS files, count(*) AS n_rows FROM documents")
def profile_summary(v: View) -> DataFrame:
    return priors.profile_summary(v("documents"), "source")


@query("""SELECT 'unique campaign_id,email' AS rule, cast(coalesce(sum(n - 1), 0) AS bigint) AS violations FROM (SELECT count(*) AS n FROM fx_leads GROUP BY campaign_id, email) UNION ALL SELECT 'not null assigned_inbox', count(*) FROM fx_leads WHERE assigned_inbox IS NULL
 UNION ALL SELECT 'foreign assigned_inbox', count(*) FROM fx_leads WHERE assigned_inbox IS NOT NULL AND assigned_inbox NOT IN (SELECT inbox_id FROM fx_inboxes)""")
def check_constraints(v: View) -> DataFrame:
    return priors.check_constraints(v("fx_leads"), ["campaign_id", "email"], ["assigned_inbox"], [("assigned_inbox", v("fx_inboxes"), "inbox_id")])


# Campaigns

FUNNEL = "count(*) AS total, sum(CASE WHEN status = 'completed' THEN 1 ELSE 0 END) AS completed, sum(CASE WHEN status = 'failed' THEN 1 ELSE 0 END) AS failed, sum(CASE WHEN replied = 1 THEN 1 ELSE 0 END) AS replied, sum(CASE WHEN unsubscribed = 1 THEN 1 ELSE 0 END) AS unsubscribed"


@query(f"SELECT c.campaign_id, c.name, coalesce(total, 0) AS total, cast(completed AS bigint) AS completed, cast(failed AS bigint) AS failed, cast(replied AS bigint) AS replied, cast(unsubscribed AS bigint) AS unsubscribed FROM fx_campaigns c LEFT JOIN (SELECT campaign_id, {FUNNEL} FROM fx_leads GROUP BY 1) l USING (campaign_id)")
def campaign_funnel(v: View) -> DataFrame:
    return campaigns.campaign_funnel(v("fx_leads"), v("fx_campaigns"))


@query("""SELECT count(*) AS total, cast(sum(CASE WHEN status = 'pending' THEN 1 ELSE 0 END) AS bigint) AS pending, cast(sum(CASE WHEN status = 'active' THEN 1 ELSE 0 END) AS bigint) AS active, cast(sum(CASE WHEN status = 'completed' THEN 1 ELSE 0 END) AS bigint) AS completed,
 cast(sum(CASE WHEN status = 'failed' THEN 1 ELSE 0 END) AS bigint) AS failed, cast(sum(CASE WHEN replied = 1 THEN 1 ELSE 0 END) AS bigint) AS replied, cast(sum(CASE WHEN unsubscribed = 1 THEN 1 ELSE 0 END) AS bigint) AS unsubscribed FROM fx_leads WHERE campaign_id = 7""")
def campaign_stats(v: View) -> DataFrame:
    return campaigns.campaign_stats(v("fx_leads"), 7)


@query("""WITH n AS (SELECT campaign_id, step_number, variant, count(*) AS sent, cast(sum(CASE WHEN opened = 1 THEN 1 ELSE 0 END) AS bigint) AS opens, cast(sum(CASE WHEN status = 'replied' THEN 1 ELSE 0 END) AS bigint) AS replies FROM fx_email_logs WHERE status NOT IN ('failed', 'sending') GROUP BY 1, 2, 3)
 SELECT *, cast(round(cast(opens * 100 / greatest(sent, 1) AS decimal(18,6)), 1) AS double) AS open_rate, cast(round(cast(replies * 100 / greatest(sent, 1) AS decimal(18,6)), 1) AS double) AS reply_rate FROM n""")
def variant_stats(v: View) -> DataFrame:
    return campaigns.variant_stats(v("fx_email_logs"))


@query(f"""SELECT (SELECT count(*) FROM fx_inboxes) AS inboxes, (SELECT cast(sum(sent_today) AS bigint) FROM fx_inboxes) AS sent_today_total, (SELECT count(*) FROM fx_campaigns) AS campaigns, (SELECT count(*) FROM fx_campaigns WHERE status = 'active') AS active_campaigns, (SELECT count(*) FROM fx_leads) AS leads,
 (SELECT count(*) FROM fx_leads WHERE replied = 1) AS replied, (SELECT count(*) FROM fx_email_logs WHERE status = 'sent' AND cast(sent_at AS date) = date '{NOW[:10]}') AS sent_today, (SELECT count(*) FROM fx_email_logs WHERE status = 'sent' AND sent_at >= timestamp '{NOW}' - INTERVAL '7' DAY) AS sent_week""")
def dashboard(v: View) -> DataFrame:
    return campaigns.dashboard(v("fx_inboxes"), v("fx_campaigns"), v("fx_leads"), v("fx_email_logs"), now().cast("timestamp_ntz"))


@query("SELECT i.inbox_id, daily_limit, coalesce(n, 0) AS used, cast(greatest(daily_limit - coalesce(n, 0), 0) AS bigint) AS room FROM fx_inboxes i LEFT JOIN (SELECT inbox_id, count(*) AS n FROM fx_email_logs WHERE cast(sent_at AS date) = date '2024-01-20' GROUP BY 1) l USING (inbox_id)")
def daily_usage(v: View) -> DataFrame:
    return campaigns.daily_usage(v("fx_email_logs"), v("fx_inboxes"), F.lit("2024-01-20").cast("date"))


DUE = f"FROM fx_due_leads l JOIN fx_campaigns c USING (campaign_id) WHERE c.status = 'active' AND l.status IN ('pending', 'active') AND unsubscribed = 0 AND replied = 0 AND retry_count < 3 AND (next_send_at IS NULL OR next_send_at <= timestamp '{NOW}')"


@query(f"SELECT lead_id, campaign_id {DUE} ORDER BY next_send_at NULLS FIRST, lead_id LIMIT 20")
def due_leads(v: View) -> DataFrame:
    return campaigns.due_leads(v("fx_due_leads"), v("fx_campaigns"), now()).select("lead_id", "campaign_id")


WINDOW = f"""SELECT campaign_id, CASE WHEN zone IS NULL THEN true ELSE (day IN (SELECT unnest(days)) OR len(days) = 0) AND hour >= send_start_hour AND hour < send_end_hour END AS open FROM (SELECT *, dayofweek(local) AS day, hour(local) AS hour,
 CASE send_days WHEN '' THEN [1,2,3,4,5] WHEN 'x' THEN [] WHEN '0, 6' THEN [0,6] ELSE [1,2,3,4,5] END AS days FROM (SELECT *, nullif(timezone, 'Bad/Zone') AS zone, timestamp '{NOW}' + CASE timezone WHEN 'Europe/Paris' THEN INTERVAL '1' HOUR WHEN 'America/New_York' THEN INTERVAL '-5' HOUR WHEN 'Asia/Tokyo' THEN INTERVAL '9' HOUR ELSE INTERVAL '0' HOUR END AS local FROM fx_campaigns))"""


@query(WINDOW.replace("day IN (SELECT unnest(days))", "list_contains(days, day)"))
def send_window(v: View) -> DataFrame:
    frame = v("fx_campaigns")
    zones = frame.sparkSession.createDataFrame([(z,) for z in ZONES], "zone string")
    return campaigns.send_window(frame, zones, F.lit(NOW).cast("timestamp_ntz")).select("campaign_id", "open")


REASON = """WITH c AS (SELECT file_pos, campaign_id, lower(trim(coalesce(email, ''))) AS email FROM fx_lead_import), e AS (SELECT c.*, CASE WHEN NOT regexp_matches(email, '^[^\\s@]+@[^\\s@]+\\.[^\\s@]+$') THEN 'invalid' WHEN split_part(email, '@', 2) = 'yopmail.com' THEN 'disposable'
 WHEN email IN (SELECT email FROM fx_unsubscribes) THEN 'unsubscribed' WHEN EXISTS (SELECT 1 FROM fx_leads l WHERE l.campaign_id = c.campaign_id AND l.email = c.email) THEN 'duplicate' END AS early FROM c),
 r AS (SELECT file_pos, campaign_id, email, coalesce(early, CASE WHEN row_number() OVER (PARTITION BY campaign_id, email, early IS NULL ORDER BY file_pos) > 1 THEN 'duplicate' ELSE 'ok' END) AS reason FROM e)"""


@query(REASON + " SELECT * FROM r")
def import_leads(v: View) -> DataFrame:
    return campaigns.classify_import(v("fx_lead_import"), v("fx_leads"), v("fx_unsubscribes")).select("file_pos", "campaign_id", "email", "reason")


@query(REASON + " SELECT reason, count(*) AS n FROM r GROUP BY 1")
def import_summary(v: View) -> DataFrame:
    return campaigns.import_summary(campaigns.classify_import(v("fx_lead_import"), v("fx_leads"), v("fx_unsubscribes")))


@query("SELECT * FROM fx_leads WHERE email NOT IN (SELECT email FROM fx_unsubscribes)")
def exclude_suppressed(v: View) -> DataFrame:
    return campaigns.exclude_suppressed(v("fx_leads"), v("fx_unsubscribes")).select(*v("fx_leads").columns)


@query("SELECT file_pos FROM fx_lead_import i WHERE NOT EXISTS (SELECT 1 FROM fx_leads l WHERE l.campaign_id = i.campaign_id AND l.email = lower(trim(i.email)))")
def exclude_existing(v: View) -> DataFrame:
    clean = v("fx_lead_import").withColumn("email", F.lower(text.clean_ws(F.col("email"))))
    return campaigns.exclude_existing(clean, v("fx_leads"), ["campaign_id", "email"]).select("file_pos")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE (o_custkey, o_orderpriority) NOT IN (SELECT DISTINCT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'P')")
def exclude_pairs(v: View) -> DataFrame:
    blocked = v("orders").filter("o_orderstatus = 'P'")
    return campaigns.exclude_pairs(v("orders"), blocked, ["o_custkey", "o_orderpriority"]).select("o_orderkey", "o_custkey")


@query("SELECT l.lead_id, l.campaign_id, c.status AS campaign_status FROM fx_leads l JOIN fx_campaigns c USING (campaign_id)")
def with_campaign(v: View) -> DataFrame:
    return campaigns.with_campaign(v("fx_leads"), v("fx_campaigns")).select("lead_id", "campaign_id", "campaign_status")


@query("SELECT log_id, g.lead_id, g.status, email FROM fx_email_logs g JOIN fx_leads l ON l.lead_id = g.lead_id WHERE g.campaign_id = 7 ORDER BY sent_at DESC, log_id DESC LIMIT 200")
def campaign_logs(v: View) -> DataFrame:
    return campaigns.campaign_logs(v("fx_email_logs"), v("fx_leads"), 7).select("log_id", "lead_id", "status", "email")


@query("SELECT log_id, email, c.name AS campaign_name FROM fx_email_logs g JOIN fx_leads l ON l.lead_id = g.lead_id JOIN fx_campaigns c ON c.campaign_id = g.campaign_id ORDER BY sent_at DESC, log_id DESC LIMIT 10")
def recent_logs(v: View) -> DataFrame:
    return campaigns.recent_logs(v("fx_email_logs"), v("fx_leads"), v("fx_campaigns")).select("log_id", "email", "campaign_name")


@query("SELECT lead_id, inbox_id, daily_limit - sent_today AS room FROM fx_leads JOIN fx_inboxes i ON assigned_inbox = inbox_id WHERE i.status = 'active' AND sent_today < daily_limit")
def sticky_inbox(v: View) -> DataFrame:
    return campaigns.sticky_inbox(v("fx_leads"), v("fx_inboxes")).select("lead_id", "inbox_id", "room")


@query("SELECT lead_id, step_id, delay_days FROM fx_leads l JOIN fx_steps s ON s.campaign_id = l.campaign_id AND s.step_number = l.current_step + 1")
def with_step(v: View) -> DataFrame:
    return campaigns.with_step(v("fx_leads"), v("fx_steps"), 1).select("lead_id", "step_id", "delay_days")


@query("SELECT s.step_id, v.variant, v.weight FROM fx_steps s LEFT JOIN fx_variations v USING (step_id)")
def steps_with_variations(v: View) -> DataFrame:
    nested = campaigns.steps_with_variations(v("fx_steps"), v("fx_variations"))
    return nested.select("step_id", F.explode_outer("variations").alias("x")).select("step_id", "x.variant", "x.weight")


@query("SELECT campaign_id, s.step_number, s.step_id FROM fx_campaigns LEFT JOIN fx_steps s USING (campaign_id)")
def nest_children(v: View) -> DataFrame:
    nested = campaigns.nest(v("fx_campaigns").select("campaign_id"), v("fx_steps"), "campaign_id", ["step_number", "step_id"])
    return nested.select("campaign_id", F.explode_outer("children").alias("x")).select("campaign_id", "x.step_number", "x.step_id")


@query("SELECT campaign_id, count(step_id) AS total_steps FROM fx_campaigns LEFT JOIN fx_steps USING (campaign_id) GROUP BY 1")
def total_steps(v: View) -> DataFrame:
    return campaigns.total_steps(v("fx_steps"), v("fx_campaigns"))


@query("WITH o AS (SELECT event_id % 500 AS log_id, ts FROM events WHERE event_type = 'view') SELECT l.log_id, count(ts) AS open_count, CASE WHEN count(ts) > 0 THEN 1 ELSE 0 END AS opened, epoch_us(min(ts)) AS first_us FROM fx_email_logs l LEFT JOIN o USING (log_id) GROUP BY l.log_id")
def open_stats(v: View) -> DataFrame:
    opens = v("events").filter("event_type = 'view'").select((F.col("event_id") % 500).alias("log_id"), F.col("ts").cast("timestamp").alias("ts"))
    return campaigns.open_stats(opens, v("fx_email_logs")).select("log_id", "open_count", "opened", F.unix_micros("opened_at").alias("first_us"))


@query("SELECT email, log_id, status FROM (SELECT email, log_id, g.status, row_number() OVER (PARTITION BY email ORDER BY sent_at DESC, log_id DESC) AS r FROM fx_email_logs g JOIN fx_leads l ON l.lead_id = g.lead_id) WHERE r = 1")
def latest_log_per_email(v: View) -> DataFrame:
    return campaigns.latest_log_per_email(v("fx_email_logs"), v("fx_leads")).select("email", "log_id", "status")


@query("SELECT log_id FROM fx_email_logs WHERE lead_id IN (SELECT lead_id FROM fx_leads WHERE email IN (SELECT email FROM fx_unsubscribes))")
def logs_of_email(v: View) -> DataFrame:
    return campaigns.logs_of_email(v("fx_email_logs"), v("fx_leads"), v("fx_unsubscribes")).select("log_id")


@query("SELECT r.lead_id AS source_lead, b.lead_id, b.campaign_id FROM fx_requests r JOIN fx_leads a ON a.lead_id = r.lead_id JOIN fx_leads b ON b.email = a.email")
def fan_out_by_email(v: View) -> DataFrame:
    return campaigns.fan_out_by_email(v("fx_requests"), v("fx_leads")).select("source_lead", "lead_id", "campaign_id")


@query("SELECT lead_id FROM fx_leads WHERE status = 'pending' OR email IN (SELECT email FROM fx_unsubscribes)")
def lookup_lead(v: View) -> DataFrame:
    ids = v("fx_leads").filter("status = 'pending'").select(F.col("lead_id").cast("string").alias("ref"))
    return campaigns.lookup_lead(v("fx_leads"), ids.union(v("fx_unsubscribes").select("email"))).select("lead_id")


@query("SELECT step_id, coalesce(lead(delay_days) OVER (PARTITION BY campaign_id ORDER BY step_number), 0) AS next_delay FROM fx_steps")
def next_step_delay(v: View) -> DataFrame:
    return campaigns.next_step_delay(v("fx_steps")).select("step_id", "next_delay")


@query()
def pick_variation(v: View) -> DataFrame:
    at = campaigns.with_step(v("fx_leads"), v("fx_steps")).select("lead_id", "step_id")
    return campaigns.pick_variation(at, v("fx_variations"), 7)


@query("""WITH s AS (SELECT inbox_id, slot, slot / daily_limit AS load, row_number() OVER (ORDER BY slot / daily_limit, inbox_id, slot) AS n FROM (SELECT inbox_id, daily_limit, unnest(range(sent_today, daily_limit)) AS slot FROM fx_inboxes WHERE status = 'active' AND daily_limit > 0 AND sent_today < daily_limit)),
 l AS (SELECT lead_id, row_number() OVER (ORDER BY lead_id) AS n FROM fx_leads) SELECT lead_id, inbox_id, round(load, 6) AS load FROM l JOIN s USING (n)""")
def allocate_least_loaded(v: View) -> DataFrame:
    return campaigns.allocate_least_loaded(v("fx_leads").select("lead_id"), v("fx_inboxes"))


@query()
def allocate_sticky(v: View) -> DataFrame:
    return campaigns.allocate_sticky(v("fx_leads"), v("fx_inboxes"))


@query("SELECT inbox_id, name, daily_limit, status FROM fx_inboxes")
def redact(v: View) -> DataFrame:
    return campaigns.redact(v("fx_inboxes"), ("sent_today",))


@query("SELECT lead_id, email, concat('{\"first_name\":\"', first_name, '\",\"company\":\"', company, '\"}') AS custom_data FROM fx_leads")
def pack_extras(v: View) -> DataFrame:
    return campaigns.pack_extras(v("fx_leads").select("lead_id", "email", "first_name", "company"), ("lead_id", "email"))


from brindle.plans import curation_queries, job_queries  # noqa: E402, F401  they register their queries
