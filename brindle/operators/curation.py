"""Pages and candidates: links, assets, embedded data, matching, ranking and records."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.functions.text import alias_match, deny_words, html_to_text, keyword_score, reject_match, squeeze_ws, tokens_over_two, unescape_entities
from brindle.functions.urls import canonical_url, deny_asset_url, host_suffixes, resolve_url, strip_query, url_host
from brindle.operators.ranking import cap_per_group, distinct_first, keep_best, number_from, rank_decay, top_scored
from brindle.operators.tables import saved

ANCHOR = r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a>"""
NEXT_WORDS = r"(?i)\bnext\b"


def extract_links(pages: DataFrame) -> DataFrame:
    """A row for each anchor: its page, place, absolute URL, text (or alt or title of its image)."""
    hrefs = F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(1))
    inner = F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(2))
    tags = F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(0))
    rows = pages.select("page_id", "url", F.posexplode(F.arrays_zip(hrefs.alias("href"), inner.alias("inner"), tags.alias("tag"))).alias("place", "a"))
    plain = squeeze_ws(html_to_text(unescape_entities(F.col("a.inner"))))
    alt = F.regexp_extract("a.inner", r"""(?i)\b(?:alt|title)\s*=\s*["']([^"']*)["']""", 1)
    text = F.coalesce(F.nullif(plain, F.lit("")), alt)
    rel = F.regexp_extract("a.tag", r"""(?i)<a\b[^>]*\brel\s*=\s*["']([^"']*)["']""", 1)
    return rows.select("page_id", "place", resolve_url(F.col("url"), F.col("a.href")).alias("target"), text.alias("text"), rel.alias("rel"))


def pagination_links(links: DataFrame) -> DataFrame:
    """Links to a next page, by text, rel or a page parameter."""
    return links.filter(F.col("text").rlike(NEXT_WORDS) | (F.lower("rel") == "next") | F.col("target").contains("page="))


def extract_assets(pages: DataFrame) -> DataFrame:
    """Distinct URLs of images of each page: meta images, then image attributes, then links; no logos."""
    meta = F.regexp_extract_all("html", F.lit(r"""(?is)<meta\b[^>]*(?:og:image|twitter:image)["'][^>]*\bcontent\s*=\s*["']([^"']+)["']"""), F.lit(1))
    attributes = F.regexp_extract_all("html", F.lit(r"""(?is)\b(?:src|data-src|data-original)\s*=\s*["']([^"']+)["']"""), F.lit(1))
    links = F.filter(F.regexp_extract_all("html", F.lit(r"""(?is)<a\b[^>]*\bhref\s*=\s*["']([^"']+)["']"""), F.lit(1)), lambda u: u.rlike(r"(?i)\.(?:jpe?g|png|webp)(?:\?|$)"))
    urls = F.array_distinct(F.transform(F.concat(meta, attributes, links), lambda u: resolve_url(F.col("url"), u)))
    return pages.select("page_id", F.posexplode(urls).alias("place", "asset")).filter(deny_asset_url(F.col("asset")))


def page_text(pages: DataFrame) -> DataFrame:
    """The visible text of a page: no scripts, styles or comments, no tags, single spaces."""
    bare = F.regexp_replace("html", r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->", " ")
    return pages.select("page_id", F.trim(squeeze_ws(unescape_entities(F.regexp_replace(bare, "<[^>]*>", " ")))).alias("text"))


def extract_attr_json(pages: DataFrame, css_class: str = "iusc", attribute: str = "m") -> DataFrame:
    """Rows from JSON in an attribute of elements of a class: image_url, page_url, title (of two names)."""
    pattern = rf"""(?is)<a\b[^>]*\bclass\s*=\s*"[^"]*\b{css_class}\b[^"]*"[^>]*\b{attribute}\s*=\s*"([^"]*)\""""
    items = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(pattern), F.lit(1))).alias("place", "json"))
    data = items.withColumn("d", F.from_json(unescape_entities(F.col("json")), "murl string, purl string, t string, desc string")).filter("d.murl is not null")
    return data.select("page_id", "place", F.col("d.murl").alias("image_url"), F.coalesce("d.purl", F.lit("")).alias("page_url"), F.coalesce("d.t", "d.desc", F.lit("")).alias("title"))


def best_title(links: DataFrame, generic: Sequence[str] = ("", "next", "image", "photo")) -> DataFrame:
    """For each target the longest text of its links (of equals the last in order), generic ones left out."""
    named = links.filter(~F.lower("text").isin(*generic))
    best = named.groupBy("target").agg(F.max(F.struct(F.length("text").alias("l"), "text")).alias("b"))
    return best.select("target", F.col("b.text").alias("title"))


def trusted_domain_join(df: DataFrame, url_col: str, domains: DataFrame) -> DataFrame:
    """Rows whose host is one of the domains or under one; hosts' suffixes make it an equi join."""
    hosts = df.select(url_col).distinct().withColumn("domain", F.explode(host_suffixes(url_host(F.col(url_col)))))
    good = hosts.join(domains.select("domain").distinct(), "domain", "left_semi").select(url_col).distinct()
    return df.join(good, url_col, "left_semi")


def _grams(c: Column, sizes: Sequence[int]) -> Column:
    """Distinct substrings of the given sizes."""

    def of_size(n: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: F.substring(c, i, F.lit(n)))

    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(none, *[F.when(F.length(c) >= n, of_size(n)).otherwise(none) for n in sizes]))


def match_entities(texts: DataFrame, entities: DataFrame, text_col: str = "text", gram: int = 4) -> DataFrame:
    """Pairs of texts and entities whose aliases match and whose reject phrases do not.

    entities: entity, aliases and rejects (arrays in lower case). An alias is in a text as a whole or with all its words
    of over two letters, so the text holds every piece of these words (of the alias itself, if it has no such word).
    Pieces have twice `gram` letters in words that are so long, else `gram`; shorter words are pieces as a whole. Each
    alias is filed under the one of its pieces that the fewest different texts hold, texts meet it by an equality on
    that piece, and only then the alias is looked for. Equal texts are looked at once; they stand for themselves by two
    hashes of 64 bits. A pair comes once, by the first alias that matches. Null texts and null aliases match nothing, an
    empty alias every text. Rows that repeat give pairs that repeat.

    Both sides of the joins grow with the input, and Spark takes their sizes from compressed files before rows become
    many by pieces; so none of them is left to be sent whole through the driver as a broadcast.
    """
    pieces = lambda a: F.when(F.size(tokens_over_two(a)) > 0, F.array_distinct(tokens_over_two(a))).otherwise(F.array(a))
    named = entities.select(F.struct(*entities.columns).alias("_e")).select("_e", F.posexplode("_e.aliases").alias("_k", "_alias")).filter("_alias is not null")
    filed = named.select("_alias").distinct().withColumn("_piece", F.explode(pieces(F.col("_alias"))))
    cut = F.when(F.length("_piece") >= 2 * gram, 2 * gram).otherwise(F.least(F.length("_piece"), F.lit(gram)))
    filed = filed.withColumn("_gram", F.explode(F.filter(_grams(F.col("_piece"), [*range(gram + 1), 2 * gram]), lambda g: F.length(g) == cut)))
    sizes = sorted(r[0] for r in filed.select(F.length("_gram")).distinct().collect())  # gram + 2 rows at most
    text = F.col(text_col)
    at = texts.filter(text.isNotNull()).withColumns({"_h1": F.xxhash64(text), "_h2": F.xxhash64(F.lit(1), text)})
    own = at.select("_h1", "_h2", text.alias("_text")).distinct()
    held = own.select("_h1", "_h2", F.explode(_grams(F.col("_text"), sizes)).alias("_gram"))
    often = held.groupBy("_gram").agg(F.count("*").alias("_n"))
    keys = filed.select("_alias", "_gram").join(often.hint("merge"), "_gram").groupBy("_alias").agg(F.min(F.struct("_n", "_gram")).alias("_r"))
    keys = named.join(keys.select("_alias", F.col("_r._gram").alias("_gram")).hint("merge"), "_alias")
    both = held.hint("merge").join(keys, "_gram").drop("_gram").join(own.hint("merge"), ["_h1", "_h2"])
    earlier = F.slice(F.col("_e.aliases"), 1, F.col("_k"))
    ok = alias_match(F.col("_text"), F.array("_alias")) & ~alias_match(F.col("_text"), earlier) & ~reject_match(F.col("_text"), F.col("_e.rejects"))
    found = both.filter(ok).select("_h1", "_h2", "_e")
    return at.hint("merge").join(found, ["_h1", "_h2"]).select(*texts.columns, "_e.*")


def payload_gate(df: DataFrame, content_type: str, size: str, least: int = 8000, most: int = 25_000_000) -> DataFrame:
    """P20: rows whose content type names an image and whose size is in the limits; nulls do not pass."""
    return df.filter(F.contains(F.lower(content_type), F.lit("image")) & F.col(size).between(least, most))


def curate_candidates(candidates: DataFrame, domains: DataFrame, aliases: Sequence[str], deny: Sequence[str], by: str, cap: int) -> DataFrame:
    """Trusted candidates (image_url, page_url, title) that match an alias, hold no denied word, once, up to a cap."""
    rows = trusted_domain_join(candidates, "page_url", domains)
    text = F.lower(F.concat_ws(" ", "title", "page_url"))
    rows = rows.filter(alias_match(text, F.array(*[F.lit(a) for a in aliases]))).filter(deny_words([F.col("title"), F.col("image_url"), F.col("page_url")], deny))
    rows = distinct_first(rows.withColumn("_key", strip_query(F.col("image_url"))), "_key", "arrival").drop("_key")
    return cap_per_group(rows, [by], [F.asc("arrival")], cap)


def rank_results(hits: DataFrame, n: int = 12) -> DataFrame:
    """Search hits (query, item_id, title, duration, channel, arrival) scored, best row of an item kept, n best of all."""
    ranked = rank_decay(hits, ["query"], [F.asc("arrival")])
    scored = ranked.withColumn("score", F.round(F.col("rank_score") + keyword_score(F.lower("title"), F.col("duration"), F.col("channel")), 4))
    return top_scored(keep_best(scored, "item_id", "score", "arrival"), [], "score", "arrival", n)


def build_manifest(df: DataFrame, by: Sequence[str], order: Sequence[Column], metrics: dict[str, int], start: int = 1) -> DataFrame:
    """Numbered rows with rounded metrics."""
    out = number_from(df, by, order, start)
    return out.withColumns({c: F.round(c, digits) for c, digits in metrics.items()})


def build_sources(hits: DataFrame, by: str, per_chunk: int = 1000) -> DataFrame:
    """The collected sources of each group in ordered arrays, one for each of its parts of about per_chunk rows.

    A group's parts follow from its number of rows and are dealt by a hash of the whole row, so arrays stay small however
    many rows a group has; no source is left out. Rows of a null group are a group of their own.
    """
    parts = hits.groupBy(F.col(by).alias("_by")).agg(F.ceil(F.count("*") / per_chunk).cast("long").alias("_parts"))
    dealt = hits.join(parts, F.col(by).eqNullSafe(F.col("_by")))
    part = F.pmod(F.xxhash64(*hits.columns), F.col("_parts")).cast("int").alias("chunk")
    return dealt.groupBy(by, part).agg(F.array_sort(F.collect_list(F.struct("item_id", "title", "channel"))).alias("sources"))


def primary_or_fallback(primary: DataFrame, fallback: DataFrame, key: str) -> DataFrame:
    """All primary rows, and fallback rows of keys without any."""
    extra = fallback.join(primary.select(key), key, "left_anti")
    return primary.withColumn("origin", F.lit("primary")).unionByName(extra.withColumn("origin", F.lit("fallback")))


def attach_metadata(df: DataFrame, meta: DataFrame, key: str) -> DataFrame:
    """Columns of meta by key, '' where there is none."""
    names = [c for c in meta.columns if c != key]
    return df.join(meta, key, "left").withColumns({c: F.coalesce(c, F.lit("")) for c in names})


def cross_dims(*dims: DataFrame, most: int = 10_000) -> DataFrame:
    """All combinations of dimension tables; each is counted first, as far as its limit of rows."""
    for d in dims:
        if d.limit(most + 1).count() > most:
            raise ValueError(f"a table with over {most} rows is no dimension: {d.columns}")
    out = dims[0]
    for d in dims[1:]:
        out = out.crossJoin(F.broadcast(d))  # its size was counted
    return out


def frontier_walk(pages: DataFrame, seeds: DataFrame, rounds: int = 24, deny: str | None = None) -> DataFrame:
    """The stored pages that links lead to from the seeds (url), with their depth; breadth first.

    pages: page_id, url, html. Addresses are compared without fragment and in canonical form. In each round the pages
    of the frontier are joined, their links extracted, and targets that were met before left out by an anti join; the
    walk ends when nothing new is found or after `rounds` rounds. deny: a pattern of addresses that are not followed.
    A round's frontier and what it has met are written tables; only the next round's links are computed from html.
    Returns key (the canonical address), depth (0 for seeds) and page_id, a row for each stored page with that address.
    """
    stored = saved(pages.select("page_id", "url", "html", canonical_url(F.col("url")).alias("key")).filter("key is not null"), "walk-pages")

    def targets(rows: DataFrame) -> DataFrame:
        keys = rows.filter("key is not null").select("key").distinct()
        return keys if deny is None else keys.filter(~F.col("key").rlike(deny))

    met = [saved(targets(seeds.select(canonical_url(F.col("url")).alias("key"))).withColumn("depth", F.lit(0)), "walk")]
    for depth in range(1, rounds):
        reached = stored.join(met[-1].select("key"), "key", "left_semi")
        links = targets(extract_links(reached).select(canonical_url(F.col("target")).alias("key")))
        links = links.join(stored.select("key"), "key", "left_semi")
        new = saved(links.join(reduce(DataFrame.unionByName, met).select("key"), "key", "left_anti").withColumn("depth", F.lit(depth)), "walk")
        if new.isEmpty():
            break
        met.append(new)
    return reduce(DataFrame.unionByName, met).join(stored.select("key", "page_id"), "key").select("key", "depth", "page_id")
