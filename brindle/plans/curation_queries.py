"""Registered queries of ranking, text, pages and selection."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.functions import numbers, similarity, text, urls
from brindle.operators import curation, ranking, selection
from brindle.plans.base import VIEWS, View, query

# Windows, limits, sets


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) + 15 AS number FROM orders")
def number_from(v: View) -> DataFrame:
    return ranking.number_from(v("orders"), ["o_custkey"], [F.asc("o_orderdate"), F.asc("o_orderkey")], 16).select("o_orderkey", "number")


@query("SELECT lead_id FROM (SELECT lead_id, row_number() OVER (PARTITION BY campaign_id, email ORDER BY lead_id) AS r FROM fx_leads) WHERE r = 1")
def keep_first(v: View) -> DataFrame:
    return ranking.keep_first(v("fx_leads"), ["campaign_id", "email"], [F.asc("lead_id")]).select("lead_id")


@query("SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY value DESC NULLS LAST, event_id) AS r FROM events) WHERE r = 1")
def keep_best(v: View) -> DataFrame:
    return ranking.keep_best(v("events"), "user_id", "value", "event_id").select("user_id", "event_id")


@query("SELECT doc_id, cast(round(100 - 1.1 * (row_number() OVER (PARTITION BY query ORDER BY doc_id) - 1), 6) AS double) AS rank_score FROM fx_search_hits")
def rank_decay(v: View) -> DataFrame:
    return ranking.rank_decay(v("fx_search_hits"), ["query"], [F.asc("arrival")]).select("doc_id", F.round("rank_score", 6).alias("rank_score"))


@query("SELECT p_partkey FROM (SELECT p_partkey, row_number() OVER (PARTITION BY p_brand, p_size % 5 ORDER BY p_retailprice DESC, p_partkey) AS r FROM part) WHERE r <= 4")
def cap_per_group(v: View) -> DataFrame:
    grouped = v("part").withColumn("g", F.col("p_size") % 5)
    return ranking.cap_per_group(grouped, ["p_brand", "g"], [F.desc("p_retailprice"), F.asc("p_partkey")], 4).select("p_partkey")


@query("SELECT p_partkey, p_name FROM (SELECT *, row_number() OVER (PARTITION BY lower(p_brand) || '|' || cast(p_size AS varchar) ORDER BY p_partkey) AS r FROM part) WHERE r = 1")
def keep_first_group(v: View) -> DataFrame:
    return ranking.keep_first_group(v("part"), F.concat_ws("|", F.lower("p_brand"), "p_size"), [F.asc("p_partkey")]).select("p_partkey", "p_name")


@query("SELECT o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 500 OFFSET 1000")
def page(v: View) -> DataFrame:
    return ranking.page(v("orders"), [F.desc("o_orderdate"), F.asc("o_orderkey")], 0, 1000).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1996-06-15' OR (o_orderdate = TIMESTAMP '1996-06-15' AND o_orderkey > 40) ORDER BY o_orderdate DESC, o_orderkey LIMIT 500")
def page_after(v: View) -> DataFrame:
    last = (datetime.datetime(1996, 6, 15), 40)
    return ranking.page_after(v("orders"), [("o_orderdate", True), ("o_orderkey", False)], last).select("o_orderkey")


@query("SELECT event_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 10")
def recent(v: View) -> DataFrame:
    return ranking.recent(v("events"), "ts", "event_id", 10).select("event_id")


@query("SELECT c_custkey, c_mktsegment FROM customer")
def category_order(v: View) -> DataFrame:
    return ranking.category_order(v("customer"), ["BUILDING", "MACHINERY"], "c_mktsegment", "c_name", "c_custkey").select("c_custkey", "c_mktsegment")


@query("SELECT p_brand, p_partkey FROM (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS r FROM part) WHERE r <= 12")
def top_scored(v: View) -> DataFrame:
    return ranking.top_scored(v("part"), ["p_brand"], "p_retailprice", "p_partkey").select("p_brand", "p_partkey")


@query("SELECT lead_id, email FROM fx_leads ORDER BY lead_id LIMIT 3")
def sample_first(v: View) -> DataFrame:
    return ranking.sample_first(v("fx_leads"), "lead_id").select("lead_id", "email")


@query("SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance, cast(NULL AS varchar) AS segment FROM supplier UNION ALL SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def union_candidates(v: View) -> DataFrame:
    suppliers = v("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    customers = v("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    return ranking.union_candidates(suppliers, customers)


@query("SELECT split_part(url, '?', 1) AS key, max(page_id) AS page_id FROM pages GROUP BY 1")
def distinct_last(v: View) -> DataFrame:
    return ranking.distinct_last(v("pages").withColumn("key", urls.strip_query(F.col("url"))), "key", "page_id").select("key", "page_id")


@query("SELECT split_part(url, '?', 1) AS key, min(page_id) AS page_id FROM pages GROUP BY 1")
def distinct_first(v: View) -> DataFrame:
    return ranking.distinct_first(v("pages").withColumn("key", urls.strip_query(F.col("url"))), "key", "page_id").select("key", "page_id")


@query("SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)")
def unvisited(v: View) -> DataFrame:
    orders = v("orders")
    return ranking.unvisited(orders.filter("o_orderstatus = 'F'").select("o_custkey"), orders.filter("o_totalprice > 450000"), "o_custkey")


@query("""WITH RECURSIVE s AS (SELECT page_id, regexp_replace(url, '#.*$', '') AS key FROM pages), e AS (SELECT a.key AS f, b.key AS t FROM s a JOIN s b ON b.page_id IN (a.page_id * 2 + 1, a.page_id * 2 + 2)),
 w(key, depth) AS (SELECT key, 0 FROM s WHERE page_id IN (0, 40) UNION SELECT t, depth + 1 FROM w JOIN e ON f = key WHERE depth < 6) SELECT key, min(depth) AS depth, page_id FROM w JOIN s USING (key) GROUP BY key, page_id""")
def frontier_walk(v: View) -> DataFrame:
    site = v("fx_site")
    return curation.frontier_walk(site, site.filter("page_id in (0, 40)").select("url"), rounds=7)


@query("SELECT p_partkey, count(l_orderkey) AS n_results, CASE WHEN count(l_orderkey) >= 30 THEN 'complete' WHEN count(l_orderkey) > 0 THEN 'partial' ELSE 'missing' END AS state FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY 1")
def split_by_presence(v: View) -> DataFrame:
    return ranking.split_by_presence(v("part").select("p_partkey"), v("lineitem").select(F.col("l_partkey").alias("p_partkey")), "p_partkey", 30)


@query("WITH n AS (SELECT p_partkey, count(l_orderkey) AS n FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY 1) SELECT count(*) FILTER (WHERE n >= 30) AS completed, count(*) FILTER (WHERE n > 0) AS any_selected, cast(sum(n) AS bigint) AS selected FROM n")
def selection_summary(v: View) -> DataFrame:
    return ranking.selection_summary(v("lineitem").select(F.col("l_partkey").alias("p_partkey")), v("part").select("p_partkey"), "p_partkey", 30)


@query("SELECT o_custkey, count(*) AS n, count(*) = 10 AS exact FROM orders GROUP BY 1")
def gate_counts(v: View) -> DataFrame:
    return ranking.gate_counts(v("orders"), "o_custkey", 10)


@query("SELECT vec_id, round((score - min(score) OVER (PARTITION BY grp)) / (max(score) OVER (PARTITION BY grp) - min(score) OVER (PARTITION BY grp) + 1e-9), 6) AS norm FROM fx_candidates")
def minmax_norm(v: View) -> DataFrame:
    return ranking.minmax_norm(v("fx_candidates"), "score", ["grp"]).select("vec_id", F.round("norm", 6).alias("norm"))


@query("WITH n AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2), p AS (SELECT user_id, n / sum(n) OVER (PARTITION BY user_id) AS p FROM n) SELECT user_id, round(-sum(p * log2(p)), 6) + 0.0 AS entropy FROM p GROUP BY 1")
def entropy(v: View) -> DataFrame:
    return ranking.entropy(v("events"), ["user_id"], F.col("event_type")).select("user_id", (F.round("entropy", 6) + 0.0).alias("entropy"))


@query("SELECT l_suppkey, round(avg(l_quantity), 6) AS mean, round(stddev_pop(l_quantity), 6) AS std, round(avg(CASE WHEN l_quantity > 25 THEN 1.0 ELSE 0.0 END), 6) AS share_above FROM lineitem GROUP BY 1")
def moments(v: View) -> DataFrame:
    m = ranking.moments(v("lineitem"), ["l_suppkey"], "l_quantity", 25)
    return m.select("l_suppkey", *[F.round(c, 6).alias(c) for c in ("mean", "std", "share_above")])


# Pages

ANCHORS = r"""WITH a AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a\b[^>]*?\bhref\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 1, 'is')) AS href, unnest(regexp_extract_all(html, '<a\b[^>]*?\bhref\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 2, 'is')) AS inner_html FROM fx_pages_rich),
 l AS (SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || href AS target, trim(regexp_replace(replace(replace(replace(replace(replace(inner_html, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '<[^>]+>', '', 'g')) AS text FROM a)"""


@query(ANCHORS + " SELECT * FROM l")
def extract_links(v: View) -> DataFrame:
    return curation.extract_links(v("fx_pages_rich").filter("html is not null")).select("page_id", "target", "text")


@query(ANCHORS + r" SELECT page_id, target FROM l WHERE regexp_matches(text, '\bnext\b', 'i') OR target LIKE '%page=%'")
def pagination_links(v: View) -> DataFrame:
    return curation.pagination_links(curation.extract_links(v("fx_pages_rich"))).select("page_id", "target")


@query(ANCHORS + " SELECT target, arg_max(text, (length(text), text)) AS title FROM l WHERE lower(text) NOT IN ('', 'next', 'image', 'photo') GROUP BY 1")
def best_title(v: View) -> DataFrame:
    return curation.best_title(curation.extract_links(v("fx_pages_rich")))


@query("SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || '/content/images/' || cast(page_id AS varchar) || '.jpg' AS asset FROM pages")
def extract_assets(v: View) -> DataFrame:
    return curation.extract_assets(v("fx_pages_rich")).select("page_id", "asset")


@query(r"""SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', ' ', 'gis'), '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\s+', ' ', 'g')) AS text FROM pages""")
def page_text(v: View) -> DataFrame:
    return curation.page_text(v("pages"))


@query("SELECT page_id, 'https://cdn' || cast(page_id % 3 AS varchar) || '.example.com/p/' || cast(page_id AS varchar) || '.jpg?w=9' AS image_url, split_part(url, '?', 1) AS page_url, 'Blue Widget ' || cast(page_id AS varchar) AS title FROM pages")
def extract_attr_json(v: View) -> DataFrame:
    return curation.extract_attr_json(v("fx_pages_rich")).select("page_id", "image_url", "page_url", "title")


HOST = "regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)"


@query(f"SELECT page_id FROM pages WHERE {HOST} LIKE '%.example.org' OR {HOST} = 'example.org'")
def trusted_domain_join(v: View) -> DataFrame:
    domains = v("pages").sparkSession.createDataFrame([("example.org",), ("no.such.host",)], "domain string")
    return curation.trusted_domain_join(v("pages"), "url", domains).select("page_id")


@query("WITH e(entity, alias, reject) AS (VALUES ('blue', 'blue', 'dark'), ('green', 'forest green', 'pale')) SELECT p_partkey, entity FROM part, e WHERE (contains(lower(p_name), alias) OR list_bool_and([contains(lower(p_name), x) FOR x IN string_split(alias, ' ')])) AND NOT contains(lower(p_name), reject)")
def match_entities(v: View) -> DataFrame:
    frame = v("part").withColumn("text", F.lower("p_name"))
    entities = frame.sparkSession.createDataFrame([("blue", ["blue"], ["dark"]), ("green", ["forest green"], ["pale"])], "entity string, aliases array<string>, rejects array<string>")
    return curation.match_entities(frame, entities).select("p_partkey", "entity")


@query("SELECT c_custkey, s_suppkey FROM customer, supplier WHERE contains(lower(c_name) || ' supplier', right(s_name, 9)) AND NOT (s_suppkey % 5 = 0 AND contains(lower(c_name), 'customer#' || right(s_name, 9)))")
def match_suppliers(v: View) -> DataFrame:
    """J12 with an entity for each supplier: its name's words are in the text of the customer with its number."""
    number = F.substring("s_name", -9, 9)
    rejects = F.when(F.col("s_suppkey") % 5 == 0, F.array(F.concat(F.lit("customer#"), number)))
    entities = v("supplier").select("s_suppkey", F.array(F.lower("s_name"), F.lit("no such name")).alias("aliases"), rejects.alias("rejects"))
    texts = v("customer").select("c_custkey", F.concat(F.lower("c_name"), F.lit(" supplier")).alias("text"))
    return curation.match_entities(texts, entities).select("c_custkey", "s_suppkey")


@query("WITH c AS (SELECT page_id, page_id % 3 AS grp, row_number() OVER (PARTITION BY page_id % 3 ORDER BY page_id) AS r FROM pages WHERE page_id % 3 <> 9 AND split_part(url, '?', 1) LIKE '%.example.org/%' AND NOT regexp_matches(lower(concat_ws(' ', 'Blue Widget ' || page_id, 'https://cdn' || (page_id % 3) || '.example.com/p/' || page_id || '.jpg?w=9', split_part(url, '?', 1))), 'logo|poster')) SELECT page_id FROM c WHERE r <= 10")
def curate_candidates(v: View) -> DataFrame:
    frame = curation.extract_attr_json(v("fx_pages_rich")).withColumn("arrival", F.col("page_id")).withColumn("grp", F.col("page_id") % 3)
    domains = frame.sparkSession.createDataFrame([("example.org",)], "domain string")
    return curation.curate_candidates(frame, domains, ["blue widget"], ["logo", "poster"], "grp", 10).select("page_id")


SCORES = " ".join(f"+ CASE WHEN contains(t, '{k}') THEN {b} ELSE 0 END" for k, b in text.GOOD_TERMS.items()) + " " + " ".join(f"- CASE WHEN contains(t, '{k}') THEN 75 ELSE 0 END" for k in text.BAD_TERMS)
SCORED = f"WITH s AS (SELECT *, lower(title) AS t, row_number() OVER (PARTITION BY query ORDER BY arrival) - 1 AS place FROM fx_search_hits), k AS (SELECT *, 0.0 {SCORES} + CASE WHEN duration BETWEEN 600 AND 14400 THEN 18 WHEN duration < 240 THEN -70 ELSE 0 END AS keyword FROM s)"


@query(SCORED + " SELECT doc_id, round(cast(keyword AS double), 4) AS score FROM k")
def keyword_score(v: View) -> DataFrame:
    score = text.keyword_score(F.lower("title"), F.col("duration"), F.col("channel"))
    return v("fx_search_hits").select("doc_id", F.round(score, 4).alias("score"))


@query(SCORED + ", b AS (SELECT item_id, round(cast(100 - 1.1 * place + keyword AS double), 4) AS score, arrival, row_number() OVER (PARTITION BY item_id ORDER BY round(cast(100 - 1.1 * place + keyword AS double), 4) DESC, arrival) AS r FROM k) SELECT item_id, score FROM b WHERE r = 1 ORDER BY score DESC, arrival LIMIT 12")
def rank_results(v: View) -> DataFrame:
    return curation.rank_results(v("fx_search_hits")).select("item_id", "score")


@query("SELECT vec_id, row_number() OVER (PARTITION BY grp ORDER BY score DESC, vec_id) AS number, round(score, 1) AS score FROM fx_candidates")
def build_manifest(v: View) -> DataFrame:
    return curation.build_manifest(v("fx_candidates"), ["grp"], [F.desc("score"), F.asc("vec_id")], {"score": 1}).select("vec_id", "number", "score")


@query("SELECT query, item_id, title, channel FROM fx_search_hits")
def build_sources(v: View) -> DataFrame:
    return curation.build_sources(v("fx_search_hits"), "query").select("query", F.explode("sources").alias("s")).select("query", "s.item_id", "s.title", "s.channel")


@query("SELECT user_id AS k, event_id AS id, 'primary' AS origin FROM events WHERE event_type = 'purchase' UNION ALL SELECT user_id, event_id, 'fallback' FROM events WHERE event_type = 'signup' AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase')")
def primary_or_fallback(v: View) -> DataFrame:
    rows = v("events").select(F.col("user_id").alias("k"), F.col("event_id").alias("id"), "event_type")
    first, second = (rows.filter(F.col("event_type") == t).drop("event_type") for t in ("purchase", "signup"))
    return curation.primary_or_fallback(first, second, "k")


@query("SELECT o_orderkey, coalesce(c_mktsegment, '') AS c_mktsegment FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 = 0) ON c_custkey = o_custkey")
def attach_metadata(v: View) -> DataFrame:
    meta = v("customer").filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return curation.attach_metadata(v("orders").select("o_orderkey", "o_custkey"), meta, "o_custkey").select("o_orderkey", "c_mktsegment")


@query("SELECT n_name, r_name FROM nation, region")
def cross_dims(v: View) -> DataFrame:
    return curation.cross_dims(v("nation").select("n_name"), v("region").select("r_name"))


# Expressions

@query(r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS squeezed, regexp_extract(text, '[0-9]{2}', 0) AS division, sha256(text) AS digest, CASE WHEN length(text) > 43 THEN substring(text, 1, 40) || '...' ELSE text END AS label FROM documents")
def text_expressions(v: View) -> DataFrame:
    t = F.col("text")
    return v("documents").select("doc_id", F.trim(text.squeeze_ws(t)).alias("squeezed"), text.class_division(t).alias("division"), text.content_sha256(t).alias("digest"), text.ellipsize(t).alias("label"))


@query(r"""SELECT p_partkey, coalesce(nullif(substring(lower(regexp_replace(regexp_replace(p_name, '[^a-zA-Z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')), 1, 70), ''), 'item') AS slug, lpad(cast(p_size AS varchar), 3, '0') || '_' || lower(p_brand) AS name, upper(trim(coalesce(p_type, ''))) IN ('', 'UNKNOWN', 'NULL', 'NONE', 'N/A') AS nullish, concat_ws('|', p_brand, p_type) AS key FROM part""")
def name_expressions(v: View) -> DataFrame:
    return v("part").select(
        "p_partkey",
        text.slugify(F.col("p_name")).alias("slug"),
        text.seq_name(F.col("p_size"), F.lower("p_brand")).alias("name"),
        text.is_nullish(F.col("p_type")).alias("nullish"),
        text.composite_key(F.col("p_brand"), F.col("p_type")).alias("key"),
    )


@query(r"""WITH w AS (SELECT doc_id, string_split(trim(regexp_replace(regexp_replace(regexp_replace(lower(title), '\b(?:gameplay|hd)\b', ' ', 'g'), '\b[0-9]+\b', ' ', 'g'), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM fx_search_hits) SELECT doc_id, array_to_string(list_slice([x FOR x IN w IF x <> '' AND x NOT IN ('the','a','an','in','at','on','with','and','of')], 1, 7), ' ') AS grp FROM w""")
def title_group(v: View) -> DataFrame:
    return v("fx_search_hits").select("doc_id", text.title_group(F.col("title"), ["gameplay", "hd"]).alias("grp"))


@query(f"SELECT page_id, {HOST} AS host, split_part(url, '?', 1) AS plain, regexp_replace(url, '#.*$', '') AS canonical, '.jpg' AS suffix FROM pages")
def url_expressions(v: View) -> DataFrame:
    u = F.col("url")
    return v("pages").select("page_id", urls.url_host(u).alias("host"), urls.strip_query(u).alias("plain"), urls.canonical_url(u).alias("canonical"), urls.url_suffix(u).alias("suffix"))


@query("SELECT l.lead_id, regexp_matches(email, '^[^\\s@]+@[^\\s@]+\\.[^\\s@]+$') AS valid, split_part(email, '@', 2) AS domain, rtrim(translate(to_base64(encode(email)), '+/', '-_'), '=') AS token, email AS back, concat_ws(' ', nullif(first_name, ''), nullif(company, '')) AS name FROM fx_leads l")
def lead_expressions(v: View) -> DataFrame:
    e = F.col("email")
    token = text.b64url_encode(e)
    return v("fx_leads").select("lead_id", text.is_email(e).alias("valid"), text.email_domain(e).alias("domain"), token.alias("token"), text.b64url_decode(token).alias("back"), text.full_name(F.col("first_name"), F.col("company")).alias("name"))


@query("SELECT l_orderkey, l_linenumber, l_extendedprice / greatest(l_quantity, 1) AS ratio, cast(30 * pow(2, l_linenumber - 1) AS int) AS wait, l_quantity / greatest(l_linenumber, 1) AS shape, round_even(l_quantity / 4, 0) AS even, cast(l_tax AS double) AS tax FROM lineitem")
def number_expressions(v: View) -> DataFrame:
    q, n = F.col("l_quantity"), F.col("l_linenumber")
    return v("lineitem").select(
        "l_orderkey", "l_linenumber", numbers.safe_ratio(F.col("l_extendedprice"), q).alias("ratio"), numbers.backoff_minutes(n).alias("wait"), numbers.aspect(q, n).alias("shape"), F.bround(q / 4, 0).alias("even"), numbers.to_double_strict(F.col("l_tax").cast("string")).alias("tax")
    )


@query("""WITH x AS (SELECT doc_id, duration AS d, list_extract([0.06, 0.23, 0.43, 0.63, 0.79], cast(doc_id % 5 + 1 AS int)) AS f FROM fx_search_hits), y AS (SELECT *, least(greatest(35.0, d * f), d - 315) AS s FROM x)
 SELECT doc_id, round(CASE WHEN d <= 360 THEN 20.0 ELSE s END, 4) AS start, round(CASE WHEN d <= 360 THEN CASE WHEN d > 0 THEN greatest(90.0, d - 30) ELSE 300.0 END ELSE least(300.0, d - s - 8) END, 4) AS length, round(greatest(3.0, d / 110), 4) AS stride FROM y""")
def segment_window(v: View) -> DataFrame:
    w = numbers.segment_window(F.col("duration"), F.col("doc_id"))
    return v("fx_search_hits").select("doc_id", F.round(w["start"], 4).alias("start"), F.round(w["length"], 4).alias("length"), F.round(numbers.sample_stride(F.col("duration")), 4).alias("stride"))


# Vectors

UNIT = "SELECT vec_id, grp, score, list_transform(embedding, lambda x: cast(x AS double)) AS e, sqrt(list_dot_product(list_transform(embedding, lambda x: cast(x AS double)), list_transform(embedding, lambda x: cast(x AS double)))) AS n FROM fx_candidates"


@query(f"WITH u AS ({UNIT}) SELECT vec_id, round(n, 5) AS norm, round(e[1] / n, 5) AS first FROM u")
def l2_normalize(v: View) -> DataFrame:
    e = F.col("embedding")
    return v("fx_candidates").select("vec_id", F.round(F.sqrt(similarity.dot(e, e)), 5).alias("norm"), F.round(similarity.l2_normalize(e)[0], 5).alias("first"))


SIGNED = f"WITH u AS ({UNIT}), m AS (SELECT *, (list_sort(e)[32] + list_sort(e)[33]) / 2 AS mid FROM u), s AS (SELECT *, list_transform(e, lambda x: CASE WHEN x > mid THEN '1' ELSE '0' END) AS bits FROM m)"


@query(SIGNED + " SELECT vec_id, len(list_filter(bits, lambda x: x = '1')) AS ones, bits[1] = '1' AS low FROM s")
def median_signature(v: View) -> DataFrame:
    sig = similarity.median_signature(F.col("embedding"))
    return v("fx_candidates").select("vec_id", F.bit_count(sig).cast("long").alias("ones"), (sig.bitwiseAND(F.lit(1)) == 1).alias("low"))


PAIRS = SIGNED + ", p AS (SELECT a.vec_id AS a, b.vec_id AS b, a.grp, len(list_filter(list_zip(a.bits, b.bits), lambda x: x[1] <> x[2])) AS apart, list_dot_product(a.e, b.e) / a.n / b.n AS cosine FROM s a JOIN s b ON a.grp = b.grp AND a.vec_id < b.vec_id)"


@query(PAIRS + " SELECT a, b, apart, round(cosine, 6) AS cosine FROM p WHERE apart <= 20 AND cosine >= 0.30")
def near_dup_pairs(v: View) -> DataFrame:
    return selection.near_dup_pairs(selection.with_features(v("fx_candidates")), "vec_id", ["grp"], [(20, 0.30)])


COPIES = """WITH c AS (SELECT vec_id, grp, embedding, score FROM fx_candidates UNION ALL SELECT vec_id + 1000000, grp, list_transform(embedding, lambda x, i: CASE WHEN i = vec_id % 64 + 1 THEN -x ELSE x END), score FROM fx_candidates)"""


def with_copies(v: View) -> DataFrame:
    """Every candidate, and a copy with one component turned round."""
    rows = v("fx_candidates").select("vec_id", "grp", "embedding", "score")
    turned = F.transform("embedding", lambda x, i: F.when(i == F.col("vec_id") % 64, -x).otherwise(x))
    return rows.unionByName(rows.select((F.col("vec_id") + 1_000_000).alias("vec_id"), "grp", turned.alias("embedding"), "score"))


@query(COPIES + ", " + PAIRS.removeprefix("WITH ").replace("FROM fx_candidates", "FROM c") + " SELECT a, b, apart, round(cosine, 6) AS cosine FROM p WHERE apart <= 9 AND cosine >= 0.91")
def near_dup_bands(v: View) -> DataFrame:
    """J16 with the limits of the `crawl` preset, which bands of the signature can serve."""
    return selection.near_dup_pairs(selection.with_features(with_copies(v)), "vec_id", ["grp"], similarity.PRESETS["crawl"].duplicate)


@query()
def suppress_game_dups(v: View) -> DataFrame:
    """N3 with the limits of the `game` preset on signatures of 256 bits; better scores first."""
    items = selection.with_features(with_copies(v), bits=256)
    ranked = ranking.number_from(items, ["grp"], [F.desc("score"), F.asc("vec_id")], name="place")
    return selection.suppress_near_dups(ranked, "vec_id", ["grp"], "place", similarity.PRESETS["game"].duplicate, bits=256).select("vec_id", "grp", "score")


@query()
def suppress_near_dups(v: View) -> DataFrame:
    items = selection.with_features(v("fx_candidates"))
    ranked = ranking.number_from(items, ["grp"], [F.desc("score"), F.asc("vec_id")], name="place")
    return selection.suppress_near_dups(ranked, "vec_id", ["grp"], "place", [(20, 0.3)]).select("vec_id", "grp", "score")


@query()
def diverse_topk(v: View) -> DataFrame:
    return selection.diverse_topk(selection.with_features(v("fx_candidates")), "vec_id", "grp", "score", 5)


@query("""SELECT doc_id, NOT regexp_matches(coalesce(text, ''), '(?i)(?:licen[cs]e)|(?:\\btrash\\b)') AS kept, coalesce(contains(lower(text), 'apache license'), false) AS mentions,
 length(replace(text, chr(10), '<br>')) AS n_html FROM documents""")
def text_gates(v: View) -> DataFrame:
    """P13, P22, F18."""
    c = F.col("text")
    mentions = F.coalesce(text.page_mentions(c, ["Apache License"]), F.lit(False))
    return v("documents").select("doc_id", text.deny_regex(c, ["licen[cs]e", r"\btrash\b"]).alias("kept"), mentions.alias("mentions"), F.length(text.nl_to_br(c)).cast("long").alias("n_html"))


#: Sizes, types and image features that stand for measured ones: functions of the page's number and length.
VIEWS["fx_images"] = """SELECT page_id, url, concat(url, '/images/', cast(page_id AS varchar(20)), '/x') AS image_url, CASE page_id % 3 WHEN 0 THEN 'Image/PNG' WHEN 1 THEN 'image/jpeg' ELSE 'text/html' END AS content_type, length(html) AS n,
 cast(300 + page_id * 37 % 2900 AS int) AS width, cast(200 + page_id * 53 % 1700 AS int) AS height, cast(page_id % 256 AS double) AS brightness, cast(page_id % 60 AS double) AS contrast, cast(page_id % 90 AS double) AS sharpness,
 (page_id % 10) / 10.0 AS dark_share, (page_id % 7) / 10.0 AS bright_share, cast(page_id % 100 AS double) AS saturation, (page_id % 11) / 10.0 AS center_activity, (page_id % 5) / 10.0 AS menu_penalty, cast(page_id % 80 AS double) AS colorfulness, (page_id % 8) / 1.0 AS entropy FROM pages"""


@query("SELECT page_id, content_type FROM fx_images WHERE content_type ILIKE '%image%' AND n BETWEEN 500 AND 5000")
def payload_gate(v: View) -> DataFrame:
    return curation.payload_gate(v("fx_images"), "content_type", "n", 500, 5000).select("page_id", "content_type")


@query("""WITH u AS (SELECT *, greatest(1.0::DOUBLE, 960.0::DOUBLE / width, 540.0::DOUBLE / height) AS up FROM fx_images)
 SELECT page_id, regexp_extract(image_url, '/images/(\\d+)', 1) AS id, cast(round_even(width * up * least(1.0::DOUBLE, 2560.0::DOUBLE / (width * up)), 0) AS int) AS w, cast(round_even(height * up * least(1.0::DOUBLE, 2560.0::DOUBLE / (width * up)), 0) AS int) AS h FROM u""")
def image_expressions(v: View) -> DataFrame:
    """F14, F36."""
    size = numbers.fit_dims(F.col("width").cast("double"), F.col("height").cast("double"))
    return v("fx_images").select("page_id", urls.path_id(F.col("image_url")).alias("id"), size["w"].alias("w"), size["h"].alias("h"))


@query("""SELECT page_id,
 width >= 800 AND height >= 430 AND width / greatest(height, 1) BETWEEN 1.30 AND 2.40 AND brightness BETWEEN 10 AND 247 AND contrast >= 15 AND sharpness >= 12 AND dark_share <= 0.62 AND bright_share <= 0.62 AS game_ok,
 width >= 320 AND height >= 180 AND brightness BETWEEN 10 AND 247 AND contrast >= 14 AND sharpness >= 10 AND dark_share <= 0.68 AND bright_share <= 0.68 AS crawl_ok,
 width >= 960 AND height >= 540 AND width / greatest(height, 1) BETWEEN 0.72 AND 2.45 AND brightness BETWEEN 12 AND 245 AND contrast >= 17 AND sharpness >= 20 AND dark_share <= 0.62 AND bright_share <= 0.62 AS site_ok,
 width >= 960 AND height >= 540 AND brightness BETWEEN 12 AND 245 AND contrast >= 18 AND sharpness >= 22 AND dark_share <= 0.58 AND bright_share <= 0.58 AS hd_ok,
 round(ln(1 + width::DOUBLE * height) + 0.7 * ln(1 + sharpness) + 0.012 * contrast, 4) AS game_score,
 round(1.8 * ln(1 + sharpness) + 0.03 * contrast + 0.009 * saturation + 9 * center_activity - 16 * menu_penalty, 4) AS crawl_score,
 round(1.9 * ln(1 + sharpness) + 0.03 * contrast + 0.01 * saturation + 10 * center_activity - 20 * menu_penalty, 4) AS site_score,
 round(1.7 * ln(1 + sharpness) + 0.025 * contrast + 0.008 * saturation + 0.012 * colorfulness + 2.2 * entropy + 8 * center_activity - 18 * menu_penalty - 2 * abs(brightness - 125) / 125, 4) AS hd_score FROM fx_images""")
def quality_presets(v: View) -> DataFrame:
    """Gate and score of the four presets."""
    rows = v("fx_images").withColumns({c: F.col(c).cast("double") for c in ("dark_share", "bright_share", "center_activity", "menu_penalty", "entropy")})
    gates = [similarity.quality_gate(p).alias(f"{p}_ok") for p in similarity.PRESETS]
    return rows.select("page_id", *gates, *[F.round(similarity.quality_score(p), 4).alias(f"{p}_score") for p in similarity.PRESETS])
