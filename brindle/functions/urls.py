"""URL expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words in the path of an image that is no content.
ASSET_WORDS = ("logo", "avatar", "icon", "thumb")


def url_host(c: Column) -> Column:
    """The host in lower case without port or user; null without one."""
    return F.lower(F.nullif(F.regexp_extract(c, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def strip_query(c: Column) -> Column:
    return F.split(c, r"\?")[0]


def canonical_url(c: Column) -> Column:
    """https unless a scheme is given, without parameters after ';' and without fragment; the query stays."""
    bare = F.regexp_replace(c, "#.*$", "")
    bare = F.regexp_replace(bare, r";[^?/]*(?=\?|$)", "")
    return F.when(bare.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*://"), bare).otherwise(F.concat(F.lit("https://"), F.regexp_replace(bare, "^/+", "")))


def remove_dots(c: Column) -> Column:
    """A URL without '.' and '..' segments in its path: each '..' takes back the segment before it, the root at most."""
    head = F.regexp_extract(c, "^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(c, "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    rest = F.regexp_extract(c, "([?#].*)$", 1)
    up = F.array(F.lit(".."), F.lit("."))

    def step(kept: Column, s: Column) -> Column:
        return F.when(s == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(1)))).when(s == ".", kept).otherwise(F.concat(kept, F.array(s)))

    parts = F.split(path, "/")
    folder = F.when(F.array_contains(up, F.element_at(parts, -1)), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    plain = F.array_join(F.concat(F.aggregate(F.slice(parts, 2, F.size(parts)), F.array(F.lit("")), step), folder), "/")
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), F.concat(head, plain, rest)).otherwise(c)


def resolve_url(base: Column, href: Column) -> Column:
    """An absolute link: as it is, from the root or from the page's folder, without dot segments."""
    scheme = F.regexp_extract(base, "^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    root = F.regexp_extract(base, "^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    plain = F.regexp_replace(base, "[?#].*$", "")
    folder = F.when(plain == root, F.concat(root, F.lit("/"))).otherwise(F.regexp_replace(plain, "[^/]*$", ""))
    return remove_dots(
        F.when(href.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, href))
        .when(F.startswith(href, F.lit("/")), F.concat(root, href))
        .otherwise(F.concat(folder, href))
    )


def url_suffix(c: Column, allowed: Sequence[str] = (".jpg", ".jpeg", ".png", ".webp"), default: str = ".jpg") -> Column:
    suffix = F.lower(F.regexp_extract(strip_query(c), r"(\.[A-Za-z0-9]+)$", 1))
    return F.when(suffix.isin(*allowed), suffix).otherwise(F.lit(default))


def path_id(c: Column, pattern: str = r"/images/(\d+)") -> Column:
    return F.regexp_extract(c, pattern, 1)


def deny_asset_url(c: Column, words: Sequence[str] = ASSET_WORDS) -> Column:
    """True for rows to keep: the URL names no logo, avatar, icon or thumbnail."""
    return ~F.lower(c).rlike("|".join(words))


def prefer_urls(c: Column, content: str = "/content/images/") -> Column:
    """An array of URLs, those with the content path first, then longer ones."""
    keyed = F.transform(c, lambda u: F.struct(F.when(F.contains(u, F.lit(content)), 0).otherwise(1).alias("p"), (-F.length(u)).alias("l"), u.alias("u")))
    return F.transform(F.array_sort(keyed), lambda s: s["u"])


def ordered_distinct(c: Column) -> Column:
    """U4: an array of URLs, each where it stands first."""
    return F.array_distinct(c)


def host_suffixes(host: Column) -> Column:
    """a.b.c, b.c and c for the host a.b.c."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
