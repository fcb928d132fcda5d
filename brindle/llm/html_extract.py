"""Main text of web pages by the maximum-scoring subsequence of words and tags."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import small_batches

# Elements by their role in HTML.
HIDDEN = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "head", "title", "select", "textarea", "audio", "video", "map"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template"}
BOILERPLATE = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "fieldset"}
FIRM = {"nav", "footer", "menu", "dialog", "button"}  # never wrappers of content
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure",
    "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section",
    "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "caption", "hgroup", "search",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "br", "cite", "code", "dfn", "em", "font", "i", "img", "kbd", "mark", "q", "s", "samp", "small", "span", "strong", "sub", "sup", "time", "u", "var", "wbr"}
CONTENT = {"article", "main"}
#: Start tags that end an open element of the same kind, as browsers do.
CLOSED_BY = {"p": BLOCKS - {"html", "body"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot", "thead"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
#: Words in class, id or role that mark boilerplate, and such that mark content in spite of them.
MARKS = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookie\w*|consent|gdpr|notice\w*|alert\w*|popup|modal|overlay|newsletter|subscribe|signup|login|"
    r"nav\w*|menu\w*|breadcrumb\w*|crumbs?|toc|pagination|pager|sidebar\w*|side|aside|widget\w*|related|recommend\w*|share\w*|sharing|social\w*|"
    r"comment\w*|discussion\w*|disqus|replies|respond|reply|footer\w*|foot|masthead|topbar|toolbar|site-header|page-header|skip-link|hidden|sr-only|tags?|meta|copyright|legal|disclaimer|navigation|complementary|contentinfo|search)(?:$|[\s_-])",
    re.I,
)
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)|[^<]+|<", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z:-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
COMMENT_MARKS = re.compile(r"(?:^|[\s_-])(?:comment\w*|repl(?:y|ies)|respond|related|recommend\w*|teaser|promo\w*|sponsor\w*|ads?|advert\w*)(?:$|[\s_-])", re.I)
#: Inside an article or main element only these mark a container, and its text blocks are marked by adverts alone.
INNER_MARKS = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookie\w*|consent|gdpr|notice\w*|alert\w*|popup|modal|overlay|newsletter|subscribe|signup|login|"
    r"nav\w*|menu\w*|breadcrumb\w*|pagination|pager|sidebar\w*|aside|widget\w*|recommend\w*|share\w*|sharing|social\w*|comments?|comment-?(?:list|section|area|form|thread)s?|discussion\w*|disqus|respond|footer\w*|"
    r"related(?=$|\s|[_-](?:posts?|articles?|links?|stor(?:y|ies)|content|items?|reading|news))|hidden|sr-only|navigation|complementary|contentinfo|search)(?:$|[\s_-])",
    re.I,
)
ADVERT = re.compile(r"(?:^|[\s_-])(?:ad|ads|adv|advert\w*|adsense|sponsored|hidden|sr-only)(?:$|[\s_-])", re.I)
#: Text blocks of an article are left out by these alone; other names say what a block is about.
NOTES = re.compile(
    r"(?<!\bno)(?<!\bhas)(?<!\bwith)(?:^|[\s_-])(?:ad|ads|adv|advert\w*|adsense|sponsored|hidden|sr-only|notice\w*|cookie\w*|consent|gdpr|alert\w*|newsletter|subscribe|share\w*|sharing|social\w*|comments)(?:$|[\s_-])",
    re.I,
)
TEXT_BLOCKS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "blockquote", "pre", "figcaption", "td", "th", "span", "em", "strong", "b", "i", "a", "code"}
#: Marked elements of these kinds hold no main text of their own, however long they are ("no-comments" says nothing).
ASIDES = re.compile(
    r"(?<!\bno)(?<!\bhas)(?<!\bwith)(?:^|[\s_-])(?:comment\w*|discussion\w*|disqus|repl(?:y|ies)|respond|notice\w*|cookie\w*|consent|gdpr|alert\w*|popup|modal|overlay|disclaimer)(?:$|[\s_-])",
    re.I,
)
SPACE = re.compile(r"\s+")
LETTER = re.compile(r"\w")
#: A marked element may be a wrapper if it holds more of a page's words than this.
WRAPPER = 0.6
#: So many words outside marked elements and links, in runs of RUN at least, are running text.
RUNNING, RUN = 10, 5
#: Tags without words between them cost no more than this together: layout is no reason to end a text.
LAYOUT = 4.0
#: Articles count as labels if they hold this share of a page's words outside boilerplate.
LABELLED = 0.4


@dataclass(frozen=True)
class Weights:
    """Scores of tokens: words by their surroundings (positive in text), tags by name (never positive).

    Boilerplate inside the labelled region, or anywhere on a page without one, counts 0: it is skipped and ends no text.
    linked is for blocks of links alone on pages without a labelled region; links among other words are text, as are all
    inside the region.
    outside is for words outside the labelled region of a page that has one, where tags inside it weigh little.
    """

    word: float = 1.0
    linked: float = -0.5
    outside: float = -0.5
    boiler: float = -0.2
    tag: float = -0.4
    tags: tuple[tuple[str, float], ...] = ()


@dataclass
class Token:
    kind: str  # "word" holds a run of text; "open" and "close" hold a tag
    name: str
    text: str = ""
    words: int = 0
    linked: bool = False
    boiler: bool = False
    labelled: bool = False
    mark: int = 0  # the innermost marked element around it, 0 for none


def _marked(name: str, attributes: str, in_content: bool) -> bool:
    if name in BOILERPLATE:
        return True
    if name == "header":
        return not in_content  # an article's own header holds its title
    if not attributes or name in ("html", "body"):
        return False
    marks = COMMENT_MARKS if name in CONTENT else MARKS if not in_content else NOTES if name in TEXT_BLOCKS else INNER_MARKS
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), next((v for v in m.groups()[1:] if v is not None), "")
        if key in ("class", "id", "role", "aria-label") and marks.search(value):
            return True
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return False


def _names(attributes: str) -> Iterator[str]:
    """Values of the attributes that name what an element is for."""
    for m in ATTRIBUTE.finditer(attributes):
        if m[1].lower() in ("class", "id", "role", "aria-label"):
            yield next((v for v in m.groups()[1:] if v is not None), "")


def _raw_tokens(page: str, parents: list[int]) -> Iterator[tuple[Token, int]]:
    """Words and tags in order; with the start of an element that is marked as boilerplate comes its number, else 0.

    parents gets the enclosing marked element of each, by number. Nothing is looked for in the stack of open elements,
    so the time is in proportion to the page however deep it is nested.
    """
    stack: list[tuple[str, int]] = []  # name, number of a marked element or 0
    opened: Counter = Counter()
    at = hidden = content = mark = 0

    def left(name: str, own: int) -> None:
        nonlocal hidden, content, mark
        opened[name] -= 1
        hidden -= name in HIDDEN
        content -= name in CONTENT
        mark = parents[own] if own else mark

    while m := TOKEN.match(page, at):
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            if not hidden and (m[0][0] != "<" or len(m[0]) == 1):
                yield Token("word", "", m[0], len(m[0].split()), opened["a"] > 0, False, content > 0, mark), 0
            continue
        if m[1]:
            inside, own = content > 0, mark
            if opened[name] > 0:
                while stack:
                    top = stack.pop()
                    left(*top)
                    if top[0] == name:
                        break
            yield Token("close", name, labelled=inside, mark=own), 0
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\s*[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name == "body" and hidden:
            kept = [s for s in stack if s[0] not in HIDDEN]
            for top in reversed([s for s in stack if s[0] in HIDDEN]):
                left(top[0], 0)
            stack = kept
        while stack and name in CLOSED_BY.get(stack[-1][0], ()):
            left(*stack.pop())
        own, inside = 0, content > 0
        if name not in VOID:
            if _marked(name, m[3] or "", inside):
                parents.append(mark)
                own = mark = len(parents) - 1
            stack.append((name, own))
            opened[name] += 1
            hidden += name in HIDDEN
            content += name in CONTENT
        yield Token("open", name, m[3] or "" if own else "", labelled=inside, mark=mark), own


def tokens_of(page: str) -> list[Token]:
    """Words and tags of a page in order, each with its surroundings; scripts, styles, comments and the head are left out.

    A marked element is boilerplate unless it wraps the page's content: the article, if none is outside of marks, or
    most words, if there is no running text outside of marks and it is no aside, comments or notice.
    """
    tokens = []
    parents = [0]
    own_words: Counter = Counter()
    wraps: set[int] = set()
    total = running = 0
    firm: set[int] = set()
    asides: set[int] = set()
    free_article = False
    for t, own in _raw_tokens(page, parents):
        tokens.append(t)
        if own and t.name in FIRM:
            firm.add(own)
        if own and (t.name == "aside" or any(ASIDES.search(v) or ADVERT.search(v) for v in _names(t.text))):
            asides.add(own)
        total += t.words
        if not t.mark and not t.linked and t.words >= RUN:
            running += t.words
        own_words[t.mark] += t.words
        if t.kind == "open" and t.name in CONTENT:
            wraps.add(parents[t.mark] if t.labelled or own in asides else t.mark)
            free_article |= not t.mark
    # An element's words and articles are its parents' too; numbers ascend inwards.
    words = [own_words[k] for k in range(len(parents))]
    for k in range(len(parents) - 1, 0, -1):
        words[parents[k]] += words[k]
        if k in wraps:
            wraps.add(parents[k])
    plain = set() if free_article else {k for k in wraps if k and words[k] > (1 - WRAPPER) * total and (k not in asides or running < RUNNING)}
    if running < RUNNING:
        plain |= {k for k in range(1, len(parents)) if words[k] > WRAPPER * total and k not in asides}
    plain -= firm
    boiler = [False] * len(parents)
    for k in range(1, len(parents)):
        boiler[k] = boiler[parents[k]] or k not in plain
    labelled = free = 0
    for t in tokens:
        t.boiler = boiler[t.mark]
        if not t.boiler:
            free += t.words
            labelled += t.words * t.labelled
    if labelled < LABELLED * free:
        for t in tokens:
            t.labelled = False
    return tokens


def _in_text(tokens: list[Token]) -> list[bool]:
    """For each token whether its block has words outside links."""
    out: list[bool] = []
    start, plain = 0, False
    for i, t in enumerate(tokens):
        if t.kind != "word" and t.name in BLOCKS:
            out.extend([plain] * (i - start))
            start, plain = i, False
        else:
            plain |= t.words > 0 and not t.linked and bool(LETTER.search(t.text))
    return out + [plain] * (len(tokens) - start)


def _scores(tokens: list[Token], weights: Weights) -> list[float]:
    """A score for each token; a run of tags without words costs LAYOUT at most."""
    tags = dict(weights.tags)
    regions = any(t.labelled for t in tokens)
    out = []
    run = 0  # where the present run of tags began
    for i, (t, in_text) in enumerate(zip(tokens, _in_text(tokens), strict=True)):
        if t.kind == "word":
            linked = t.linked and not in_text
            each = 0.0 if t.boiler and (t.labelled or not regions) else weights.boiler if t.boiler else weights.word if t.labelled else weights.outside if regions and not t.labelled else weights.linked if linked else weights.word
            out.append(t.words * each)
        else:
            score = max(tags.get(t.name, weights.tag), -0.2 if t.name in INLINE else -1.0)
            out.append(0.0 if t.boiler and (t.labelled or not regions) else max(score, -0.1) if t.labelled else max(score, weights.boiler) if t.boiler else score)
        if t.words or i == len(tokens) - 1:
            end = i if t.words else i + 1
            cost = -sum(out[run:end])
            if cost > LAYOUT:
                out[run:end] = [x * LAYOUT / cost for x in out[run:end]]
            run = i + 1
    return out


def best_region(scores: list[float]) -> tuple[int, int]:
    """The contiguous run with the greatest sum, the longest and then the first of equals; (0, 0) if none is positive."""
    best, start, end = 0.0, 0, 0
    total, since = 0.0, 0
    for i, s in enumerate(scores):
        if total < 0:
            total, since = 0.0, i
        total += s
        if total > best or total == best and best > 0 and i + 1 - since > end - start:
            best, start, end = total, since, i + 1
    return start, end


def extract(page: str | None, weights: Weights) -> str:
    """The text of the best region: blocks joined by a line end, white space inside a block made one space.

    Words of navigation, adverts, forms, comments and the like inside the region are left out.
    """
    if not page:
        return ""
    tokens = tokens_of(page)
    start, end = best_region(_scores(tokens, weights))
    blocks: list[list[str]] = [[]]
    for t in tokens[start:end]:
        if t.kind == "word":
            if not t.boiler:
                blocks[-1].append(html.unescape(t.text))
        elif t.name in BLOCKS:
            blocks.append([])
        elif t.name == "br":
            blocks[-1].append(" ")
    lines = (SPACE.sub(" ", "".join(b)).strip() for b in blocks)
    return "\n".join(x for x in lines if x)


def _labelled_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Tokens inside and outside the article of pages that mark one, by kind."""
    for batch in batches:
        inside: Counter = Counter()
        outside: Counter = Counter()
        for page in batch["html"]:
            tokens = tokens_of(page or "")
            if not any(t.labelled for t in tokens):
                continue
            for t in tokens:
                if t.kind == "word":
                    key, n = "linked" if t.linked else "word", t.words
                else:
                    key, n = "tag:" + t.name, 1
                (inside if t.labelled and not t.boiler else outside)[key] += n
        keys = inside.keys() | outside.keys()
        yield pd.DataFrame([(k, inside[k], outside[k]) for k in keys], columns=["key", "inside", "outside"])


def fit_weights(pages: DataFrame, sample_pages: int = 2000, seed: int = 3) -> Weights:
    """Weights from pages that label their own main text with an article or main element.

    The sample is bounded: the sample_pages rows of smallest seeded hash of page_id and url. A word's score is the log
    odds of its surroundings inside against outside the labelled region, scaled so that a plain word scores 1; a tag's
    is the log odds of its name, at most 0 (and -0.2 at least for tags inside a line, -1 for others, so that a link or
    a list does not end a text). Without labelled pages the default weights hold.
    """
    small_batches(pages.sparkSession, 256)
    sample = pages.orderBy(F.xxhash64(F.lit(seed), "page_id", "url"), "page_id").select("page_id", "url").limit(sample_pages)
    keys = sample.withColumn("_h", F.xxhash64(F.lit(seed), "page_id", "url")).select("_h").distinct()
    texts = pages.withColumn("_h", F.xxhash64(F.lit(seed), "page_id", "url")).join(F.broadcast(keys), "_h", "left_semi").select("html")  # sample_pages keys at most
    counted = texts.mapInPandas(_labelled_counts, "key string, inside long, outside long").groupBy("key").agg(F.sum("inside").alias("i"), F.sum("outside").alias("o"))
    rows = {r["key"]: (r["i"], r["o"]) for r in counted.filter("i + o >= 20").orderBy(F.desc(F.col("i") + F.col("o")), "key").limit(500).collect()}
    if sum(i for i, _ in rows.values()) == 0:
        return Weights()
    default = Weights()

    def odds(key: str) -> float:
        i, o = rows.get(key, (0, 0))
        return float(np.log((i + 1.0) / (o + 1.0)))

    unit = max(1.0, odds("word"))
    linked = max(-2.0, min(default.linked, odds("linked") / unit)) if "linked" in rows else default.linked
    tags = {k[4:]: float(np.clip(odds(k) / unit, -3.0, 0.0)) for k in rows if k.startswith("tag:")}
    return Weights(default.word, linked, default.outside, default.boiler, default.tag, tuple(sorted(tags.items())))


def extract_text(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """The main text of every row of pages (page_id, url, html), from its whole html.

    Returns page_id, url, text and n_chars (code points). Null or empty html, and pages without any words outside
    boilerplate, give an empty text; repeated rows give repeated results; an empty table gives an empty result.
    """
    small_batches(pages.sparkSession, 256)
    weights = weights or fit_weights(pages)

    @F.pandas_udf("string")
    def main_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([extract(p, weights) for p in batch], dtype=object)

    return pages.select("page_id", "url", main_text("html").alias("text")).withColumn("n_chars", F.length("text").cast("long"))
