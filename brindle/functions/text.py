"""Text expressions: cleaning, addresses, templates, matching. All are built-in functions unless stated."""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Mail domains that count as disposable.
DISPOSABLE_DOMAINS = (
    "mailinator.com", "guerrillamail.com", "tempmail.com", "throwaway.email", "yopmail.com", "guerrillamail.info", "grr.la", "sharklasers.com",
    "guerrillamail.net", "guerrillamail.de", "trbvm.com", "temp-mail.org", "dispostable.com", "trashmail.com", "fakeinbox.com", "mailnesia.com",
)
# Texts that count as no value.
NULLISH = ("", "UNKNOWN", "NULL", "NONE", "N/A")
# Bonus of a good term, malus of bad ones, and channels with a bonus, for keyword_score.
GOOD_TERMS = {"gameplay": 30, "no commentary": 25, "longplay": 20, "walkthrough": 15, "playthrough": 15, "full game": 10, "1080p": 18, "1440p": 20, "4k": 22, "60fps": 8, "hd": 8}
BAD_TERMS = ("review", "reaction", "retrospective", "analysis", "essay", "trailer", "teaser", "ost", "soundtrack", "music", "comparison", "speedrun", "ending", "all cutscenes", "movie", "podcast", "shorts", "livestream", "benchmark")
GOOD_CHANNELS = ("nintendocomplete", "world of longplays", "longplayarchive", "gameplayarchive", "shirrako", "mkiceandfire")
# Title words that title_group drops.
STOP_WORDS = ("the", "a", "an", "in", "at", "on", "with", "and", "of")
# Character references that unescape_entities resolves, the ampersand last.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def clean_ws(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def squeeze_ws(c: Column) -> Column:
    """Every run of white space as one space."""
    return F.regexp_replace(c, r"\s+", " ")


def class_division(c: Column) -> Column:
    """The first two digits that follow each other; '' without any, null for null."""
    return F.regexp_extract(c, "[0-9]{2}", 0)


@F.pandas_udf(T.StringType())
def ascii_fold(texts: pd.Series) -> pd.Series:
    """Compatibility decomposition, ASCII only, lower case, single spaces; Spark has no such function."""
    folded = texts.map(lambda t: None if t is None else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode().lower())
    return folded.str.replace(r"\s+", " ", regex=True).str.strip()


def slugify(c: Column, max_len: int = 70, default: str = "item") -> Column:
    """Letters and digits joined by underscores in lower case, cut to max_len; default where nothing is left."""
    slug = F.lower(F.regexp_replace(F.regexp_replace(c, "[^a-zA-Z0-9]+", "_"), "^_+|_+$", ""))
    return F.coalesce(F.nullif(F.substring(slug, 1, max_len), F.lit("")), F.lit(default))


def title_group(c: Column, brand: Sequence[str] = (), stop: Sequence[str] = STOP_WORDS, words: int = 7) -> Column:
    """Key of a title: lower case without brand words, numbers, punctuation and stop words; its first words."""
    low = F.lower(c)
    if brand:
        low = F.regexp_replace(low, r"\b(?:" + "|".join(brand) + r")\b", " ")
    low = F.regexp_replace(F.regexp_replace(low, r"\b[0-9]+\b", " "), "[^a-z0-9]+", " ")
    kept = F.filter(F.split(low, " "), lambda w: (w != "") & ~w.isin(*stop))
    return F.array_join(F.slice(kept, 1, words), " ")


def composite_key(*columns: Column) -> Column:
    return F.concat_ws("|", *columns)


def first_nonempty(*columns: Column) -> Column:
    """The first column that is neither null nor blank, trimmed; '' if none is."""
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in columns], F.lit(""))


def default_falsy(c: Column, default: Column, empty: object = 0) -> Column:
    """The default for null and for the empty value (0 or '')."""
    return F.coalesce(F.nullif(c, F.lit(empty)), default)


def is_email(c: Column) -> Column:
    return c.rlike(r"^[^\s@]+@[^\s@]+\.[^\s@]+$")


def email_domain(c: Column) -> Column:
    """What stands between the first and the second @; null without an @."""
    return F.get(F.split(c, "@"), 1)


def is_disposable(c: Column) -> Column:
    return F.coalesce(email_domain(c).isin(*DISPOSABLE_DOMAINS), F.lit(False))


def is_nullish(c: Column) -> Column:
    """Null, blank or a word for no value."""
    return F.upper(F.trim(F.coalesce(c, F.lit("")))).isin(*NULLISH)


def parse_int_list(c: Column) -> Column:
    """Leading integers of the parts of a comma-separated text; parts without one are left out."""
    parts = F.transform(F.split(c, ","), lambda x: F.regexp_extract(F.trim(x), r"^[+-]?[0-9]+", 0).try_cast("int"))
    return F.filter(parts, lambda x: x.isNotNull())


def deny_regex(c: Column, patterns: Sequence[str]) -> Column:
    """True for rows to keep: none of the patterns is found, in any case."""
    return ~F.coalesce(c, F.lit("")).rlike("(?i)" + "|".join(f"(?:{p})" for p in patterns))


def deny_words(columns: Sequence[Column], words: Sequence[str], word_boundary: bool = False) -> Column:
    """True for rows to keep: the joined texts hold none of the words, anywhere or (word_boundary) as whole words."""
    text = F.lower(F.concat_ws(" ", *columns))
    if word_boundary:
        return ~text.rlike("|".join(rf"\b\Q{w}\E\b" for w in words))
    return ~F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(text, w))


def tokens_over_two(c: Column) -> Column:
    return F.filter(F.regexp_extract_all(c, F.lit("[a-z0-9]+"), F.lit(0)), lambda t: F.length(t) > 2)


def alias_match(text: Column, aliases: Column) -> Column:
    """Whether any alias (an array in lower case) is in the text, or all of its longer words are; null array: no."""

    def one(a: Column) -> Column:
        words = tokens_over_two(a)
        return F.contains(text, a) | ((F.size(words) > 0) & F.forall(words, lambda w: F.contains(text, w)))

    return F.coalesce(F.exists(aliases, one), F.lit(False))


def reject_match(text: Column, rejects: Column) -> Column:
    """Whether the text holds any of the phrases; a null array holds none."""
    return F.coalesce(F.exists(rejects, lambda r: F.contains(text, r)), F.lit(False))


def page_mentions(text: Column, phrases: Sequence[str]) -> Column:
    low = F.lower(text)
    return F.exists(F.array(*[F.lit(p.lower()) for p in phrases]), lambda p: F.contains(low, p))


def ellipsize(c: Column, limit: int = 43) -> Column:
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit - 3), F.lit("..."))).otherwise(c)


def seq_name(n: Column, slug: Column) -> Column:
    return F.concat(F.lpad(n.cast("string"), F.greatest(F.lit(3), F.length(n.cast("string"))), F.lit("0")), F.lit("_"), slug)


def html_to_text(c: Column) -> Column:
    """Line ends for <br>, no other tags, trimmed."""
    return clean_ws(F.regexp_replace(F.regexp_replace(c, r"(?i)<br\s*/?>", "\n"), "<[^>]+>", ""))


def nl_to_br(c: Column) -> Column:
    return F.replace(c, F.lit("\n"), F.lit("<br>"))


def unescape_entities(c: Column) -> Column:
    """The five named references of markup; a full table would need a UDF."""
    for name, value in ENTITIES:
        c = F.replace(c, F.lit(name), F.lit(value))
    return c


@F.pandas_udf(T.StringType())
def unescape_all(texts: pd.Series) -> pd.Series:
    """every character reference of HTML, named or numbered; Spark has no table of them."""
    return texts.map(lambda t: None if t is None else html.unescape(t))


def b64url_encode(c: Column) -> Column:
    return F.rtrim(F.translate(F.base64(c.cast("binary")), "+/", "-_"), F.lit("="))


def b64url_decode(c: Column) -> Column:
    plain = F.translate(c, "-_", "+/")
    return F.unbase64(F.rpad(plain, (F.ceil(F.length(plain) / 4) * 4).cast("int"), F.lit("="))).cast("string")


def content_sha256(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def full_name(first: Column, last: Column) -> Column:
    return F.concat_ws(" ", F.nullif(first, F.lit("")), F.nullif(last, F.lit("")))


def json_map_or_empty(c: Column) -> Column:
    """A JSON object as a map of strings; anything else as an empty map."""
    return F.coalesce(F.from_json(c, "map<string,string>"), F.create_map().cast("map<string,string>"))


def drop_keys(m: Column, keys: Sequence[str]) -> Column:
    return F.map_filter(m, lambda k, _: ~k.isin(*keys))


def uniform(key: Column, seed: int, salt: str = "") -> Column:
    """A number in [0, 1) from the key and the seed alone, so that reruns agree."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(salt), key), 11) / F.lit(float(1 << 53))


def once(c: Column, f: Callable[[Column], Column]) -> Column:
    """f of a column that is evaluated once for a row, however often f uses it (also inside lambdas)."""
    return F.get(F.transform(F.array(c), f), 0)


def spin(c: Column, key: Column, seed: int) -> Column:
    """Every innermost {a|b|c} replaced by one of its options (trimmed), chosen by key, seed and place; {a} stays."""
    group = r"\{([^{}]+)\}"
    texts = F.split(c, group)
    groups = F.regexp_extract_all(c, F.lit(group), F.lit(1))

    def choose(g: Column, i: Column) -> Column:
        def one(options: Column) -> Column:
            n = F.size(options)
            pick = F.floor(F.shiftrightunsigned(F.xxhash64(F.lit(seed), key, i), 11) / F.lit(float(1 << 53)) * n).cast("int")
            return F.when(n > 1, F.trim(F.get(options, pick))).otherwise(F.concat(F.lit("{"), g, F.lit("}")))

        return once(F.split(g, r"\|"), one)

    chosen = F.concat(F.transform(groups, choose), F.array(F.lit("")))
    return F.array_join(F.zip_with(texts, chosen, lambda t, g: F.concat(t, F.coalesce(g, F.lit("")))), "")


def fill_template(c: Column, variables: Column) -> Column:
    """Every {{key}} replaced by its value in the map; unknown keys by nothing."""
    mark = r"\{\{(\w+)\}\}"

    def fill(x: Column) -> Column:
        texts = F.split(x["text"], mark)
        keys = F.concat(F.transform(F.regexp_extract_all(x["text"], F.lit(mark), F.lit(1)), lambda k: F.coalesce(F.try_element_at(x["variables"], k), F.lit(""))), F.array(F.lit("")))
        return F.array_join(F.zip_with(texts, keys, lambda t, k: F.concat(t, F.coalesce(k, F.lit("")))), "")

    return once(F.struct(c.alias("text"), variables.alias("variables")), fill)


def template_variables(first: Column, last: Column, email: Column, company: Column, custom: Column) -> Column:
    """Built-in variables of a message, overridden by the custom ones."""
    own = {"firstName": first, "lastName": last, "fullName": full_name(first, last), "email": email, "company": company}
    built_in = F.create_map(*[x for k, v in own.items() for x in (F.lit(k), F.coalesce(v, F.lit("")))])
    return once(custom, lambda m: F.map_concat(F.map_filter(built_in, lambda k, _: ~F.array_contains(F.map_keys(m), k)), m))


def message_html(body: Column, unsubscribe_url: Column, unsubscribe_text: Column, tracking_url: Column) -> Column:
    """The HTML of a message: line ends as <br>, then the unsubscribe line and the opening picture where they have a URL."""
    name = F.coalesce(F.nullif(unsubscribe_text, F.lit("")), F.lit("Unsubscribe"))
    line = F.concat(F.lit('<br><br><p style="font-size:11px;color:#999;font-family:Arial,sans-serif;"><a href="'), unsubscribe_url, F.lit('" style="color:#999;text-decoration:underline;">'), name, F.lit("</a></p>"))
    picture = F.concat(F.lit('<img src="'), tracking_url, F.lit('" width="1" height="1" alt="" style="display:none;width:1px;height:1px;border:0;" />'))
    whole = F.concat(nl_to_br(body), F.coalesce(line, F.lit("")), F.coalesce(picture, F.lit("")))
    return F.concat(F.lit('<!DOCTYPE html><html><body style="font-family:Arial,sans-serif;">'), whole, F.lit("</body></html>"))


def message_text(body: Column) -> Column:
    """The plain form of a message: line ends for <br>, no tags, trimmed."""
    return html_to_text(body)


def keyword_score(text: Column, duration: Column, channel: Column, good: Mapping[str, int] = GOOD_TERMS, bad: Sequence[str] = BAD_TERMS, channels: Sequence[str] = GOOD_CHANNELS) -> Column:
    """Bonus of good terms, 75 less for each bad one, the band of the duration and a bonus for known channels."""
    score = F.lit(0.0)
    for term, bonus in good.items():
        score = score + F.when(F.contains(text, F.lit(term)), float(bonus)).otherwise(0.0)
    for term in bad:
        score = score - F.when(F.contains(text, F.lit(term)), 75.0).otherwise(0.0)
    band = F.when(duration.between(600, 14400), 18.0).when(duration < 240, -70.0).otherwise(0.0)
    known = F.exists(F.array(*[F.lit(x) for x in channels]), lambda x: F.contains(F.lower(F.coalesce(channel, F.lit(""))), x))
    return score + band + F.when(known, 15.0).otherwise(0.0)
