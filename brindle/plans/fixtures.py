"""Views over the driver tables that stand for the native inputs; each statement runs alike on Spark and DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "fx_campaigns": r"""SELECT n_nationkey AS campaign_id, n_name AS name, CASE n_nationkey % 4 WHEN 0 THEN 'draft' WHEN 1 THEN 'paused' ELSE 'active' END AS status, CASE n_regionkey WHEN 0 THEN 'Europe/Paris' WHEN 1 THEN 'America/New_York' WHEN 2 THEN 'Asia/Tokyo' WHEN 3 THEN 'UTC' ELSE 'Bad/Zone' END AS timezone, 8 AS send_start_hour, 18 AS send_end_hour, CASE n_nationkey % 6 WHEN 0 THEN '' WHEN 1 THEN '0, 6' WHEN 2 THEN 'x' ELSE '1,2,3,4,5' END AS send_days FROM nation""",
    "fx_leads": r"""SELECT c_custkey AS lead_id, c_nationkey AS campaign_id, concat('user', cast(c_custkey % 900 AS varchar(20)), '@mail', cast((c_custkey % 900) % 7 AS varchar(20)), '.example.com') AS email, c_name AS first_name, c_mktsegment AS company, CASE c_custkey % 6 WHEN 0 THEN 'pending' WHEN 1 THEN 'active' WHEN 2 THEN 'active' WHEN 3 THEN 'completed' WHEN 4 THEN 'failed' ELSE 'unsubscribed' END AS status, cast(c_custkey % 3 + 1 AS int) AS current_step, cast(c_custkey % 4 AS int) AS retry_count, CASE WHEN c_custkey % 6 = 5 THEN 1 ELSE 0 END AS unsubscribed, CASE WHEN c_custkey % 12 = 3 THEN 1 ELSE 0 END AS replied, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE cast(c_custkey % 100 AS int) END AS assigned_inbox, c_acctbal AS acctbal FROM customer""",
    "fx_email_logs": r"""SELECT e.event_id AS log_id, e.user_id AS lead_id, l.campaign_id, cast(e.event_id % 3 + 1 AS int) AS step_number, CASE e.event_id % 2 WHEN 0 THEN 'A' ELSE 'B' END AS variant, cast(e.user_id % 10 AS int) AS inbox_id, e.ts AS sent_at, CASE e.event_type WHEN 'purchase' THEN 'replied' WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'sending' ELSE 'sent' END AS status, CASE WHEN e.value > 50 THEN 1 ELSE 0 END AS opened FROM events e JOIN fx_leads l ON l.lead_id = e.user_id""",
    "fx_inboxes": r"""SELECT s_suppkey AS inbox_id, s_name AS name, cast((s_suppkey % 7) * 5 AS int) AS daily_limit, cast(s_suppkey % 11 AS int) AS sent_today, CASE WHEN s_suppkey % 9 = 0 THEN 'paused' ELSE 'active' END AS status FROM supplier""",
    "fx_steps": r"""SELECT n_nationkey * 10 + r_regionkey + 1 AS step_id, n_nationkey AS campaign_id, r_regionkey + 1 AS step_number, r_regionkey * 2 AS delay_days FROM nation CROSS JOIN region WHERE r_regionkey < 3""",
    "fx_variations": r"""SELECT s.step_id, v.variant, v.weight, concat('Hi {{firstName}} {Hello|Hey} ', v.variant) AS subject FROM fx_steps s CROSS JOIN (SELECT 'A' AS variant, 3 AS weight UNION ALL SELECT 'B', 1) v WHERE s.step_id % 5 <> 0""",
    "fx_unsubscribes": r"""SELECT DISTINCT email FROM fx_leads WHERE lead_id % 13 = 0""",
    "fx_lead_import": r"""SELECT c_custkey AS file_pos, c_nationkey AS campaign_id, CASE c_custkey % 8 WHEN 0 THEN 'not-an-email' WHEN 1 THEN concat(' USER', cast(c_custkey % 900 AS varchar(20)), '@YOPMAIL.com ') WHEN 2 THEN '' ELSE concat(' User', cast(c_custkey % 400 AS varchar(20)), '@Mail', cast((c_custkey % 400) % 7 AS varchar(20)), '.Example.com') END AS email, c_name AS first_name, c_mktsegment AS company FROM customer""",
    "fx_tenders": r"""SELECT concat(cast(l_orderkey AS varchar(20)), '-', cast(l_linenumber AS varchar(20))) AS record_id, n_name AS country, p_brand AS cpv, concat(' ', s_name, '  Dept') AS buyer_name, cast(l_extendedprice AS varchar(40)) AS value, CASE n_regionkey WHEN 0 THEN 'usd' WHEN 1 THEN 'EUR' ELSE ' GBP ' END AS currency, CASE l_returnflag WHEN 'R' THEN 'Award_First' ELSE 'notice' END AS evidence_grain, CASE l_linestatus WHEN 'F' THEN 'USASPENDING' ELSE 'TED' END AS source FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey""",
    "fx_candidates": r"""SELECT vec_id, label AS grp, embedding, cast((vec_id * 37) % 101 AS double) / 100.0 AS score FROM embeddings""",
    "fx_pages_rich": r"""SELECT page_id, url, concat(html, '<a rel="next" href="/gallery?page=', cast(page_id % 5 + 2 AS varchar(20)), '">Next</a><meta property="og:image" content="/content/images/', cast(page_id AS varchar(20)), '.jpg"><a class="iusc" m="{&quot;murl&quot;:&quot;https://cdn', cast(page_id % 3 AS varchar(20)), '.example.com/p/', cast(page_id AS varchar(20)), '.jpg?w=9&quot;,&quot;purl&quot;:&quot;', split_part(url, '?', 1), '&quot;,&quot;t&quot;:&quot;Blue Widget ', cast(page_id AS varchar(20)), '&quot;}">x</a>') AS html FROM pages""",
    "fx_site": r"""SELECT p.page_id, p.url, concat(p.html, coalesce(concat('<a href="', a.url, '">first</a>'), ''), coalesce(concat('<a href="', b.url, '">second</a>'), '')) AS html FROM pages p LEFT JOIN pages a ON a.page_id = p.page_id * 2 + 1 LEFT JOIN pages b ON b.page_id = p.page_id * 2 + 2""",
    "fx_search_hits": r"""SELECT doc_id, concat('q', cast(doc_id % 6 AS varchar(20))) AS query, concat('vid', cast(doc_id % 300 AS varchar(20))) AS item_id, concat(p_name, ' ', CASE doc_id % 4 WHEN 0 THEN 'gameplay no commentary 1080p' WHEN 1 THEN 'review trailer' WHEN 2 THEN 'longplay hd' ELSE 'most ending' END) AS title, cast((doc_id * 61) % 20000 AS double) AS duration, source AS channel, doc_id AS arrival FROM documents JOIN part ON p_partkey = doc_id % 200""",
}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _used(sql: str, names) -> list[str]:
    return [n for n in names if re.search(rf"\b{n}\b", sql)]


def with_views(sql: str) -> str:
    """The statement with the views that it reads (and those that they read) as common table expressions."""
    wanted: list[str] = []

    def add(text: str) -> None:
        for n in _used(text, VIEWS):
            if n not in wanted:
                add(VIEWS[n])
                wanted.append(n)

    add(sql)
    if not wanted:
        return sql
    own = ", ".join(f"{n} AS ({VIEWS[n]})" for n in wanted)
    return re.sub(r"^\s*WITH\s+", f"WITH {own}, ", sql, count=1) if re.match(r"\s*WITH\s", sql) else f"WITH {own} {sql}"


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view, or a driver table, as a DataFrame over the files in sf_dir."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = with_views(f"SELECT * FROM {name}")
    used = _used(sql, TABLES)
    files = ", ".join(f"{t} AS (SELECT * FROM parquet.`{sf_dir}/{t}.parquet`)" for t in used)
    return spark.sql(re.sub(r"^WITH\s+", f"WITH {files}, ", sql, count=1))
