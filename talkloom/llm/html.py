"""Main text of web pages by the best-scoring run of words and tags.

A page is read as a row of tags and words. Words score positive and tags
negative on the whole; the weight of each kind (a word by the element it is in, a
tag by its name) is the log odds of lying inside the content, counted over labelled
pages: those whose markup names the content with exactly one ``article`` or
``main`` element, or one ``article`` in one ``main``. One linear scan finds the contiguous run with the largest sum.
Of that run the blocks are returned, without elements that never hold the article
(menus, footers, asides, scripts) and without those whose class, id or role names them
as furniture, forms and headers, unless they wrap the article: an element stays if it
holds the article or main element, holds over half of the words of the page or of the
content element around it, or is a heading block in the content. Inside the content only
whole names of containers count, not parts of names nor those of paragraphs, quotes, lists
and tables; and names that articles use as well (search, related, share, widget and the
like) only with form controls or where links hold half of the words.

Null or empty html, and pages without a run above 0, give an empty text. Of two
runs with the same sum the earlier and then the longer one wins. Rows are
independent, so repeated rows and further columns need no rule. Without labelled
pages every word weighs 1 and every tag -1.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkloom.llm.arrow import map_batches

SAMPLE_PAGES = 2_000

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"'/]++|"[^"]*+"|'[^']*+'|["']|/(?!>))*+)(/?)>""",
    re.S,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PARTS = re.compile(r"[a-z]+")

# Elements by their role in HTML.
_RAW = {"script", "style", "textarea", "title", "xmp", "noscript", "template"}
_VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
    "source", "track", "wbr",
}
_INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn",
    "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp",
    "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
_NEVER = {
    "head", "nav", "menu", "footer", "aside", "button", "select", "option", "iframe", "object", "svg", "canvas", "audio", "video", "dialog", "map",
}
# Words in class, id or role that name page furniture.
_FURNITURE = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored",
    "promo", "promotion", "banner", "nav", "navbar", "navigation", "menu", "breadcrumb",
    "breadcrumbs", "header", "masthead", "footer", "sidebar", "aside", "complementary",
    "contentinfo", "comment", "comments", "disqus", "replies", "reply", "cookie", "cookies",
    "consent", "notice", "notices", "popup", "modal", "overlay", "newsletter", "subscribe",
    "share", "sharing", "social", "related", "recommended", "search", "login", "signup", "widget",
}
# Opening one of these ends an open p.
_ENDS_P = {
    "address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul",
}
_SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
_CONTENT = {"article", "main"}
# These wrap a whole page at times, so they are judged like elements with a name of furniture.
_WRAPS = {"form", "fieldset"}
# Names that need the make-up of furniture beside them inside the content.
_DOUBTFUL = {
    "header", "masthead", "banner", "share", "sharing", "social", "related", "recommended", "search",
    "login", "signup", "widget", "reply", "popup", "modal", "overlay", "form", "fieldset",
}
_CONTROLS = {"tag input", "tag button", "tag select", "tag textarea"}
# Elements of running text, which no name makes furniture inside the content.
_TEXT = {
    "p", "blockquote", "pre", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "td", "th",
    "figure", "figcaption", "table", "tr", "tbody", "thead",
}
_HEADER = {"header", "masthead", "banner"}
_HEADINGS = {"tag h1", "tag h2", "tag h3", "tag h4", "tag h5", "tag h6"}
_WHITE = re.compile(r"\s")


def _furniture(name: str, attributes: str, in_content: bool) -> set[str]:
    """What names an element as furniture; inside the content only whole names count."""
    if name in _CONTENT or name in ("html", "body") or (in_content and name in _TEXT):
        return set()
    named = {name} if name in _WRAPS or (name == "header" and not in_content) else set()
    if "=" in attributes:
        for found in _NAMES.finditer(attributes):
            value = (found[1] or found[2] or found[3] or "").lower()
            named |= _FURNITURE.intersection(value.split() if in_content else _PARTS.findall(value))
    return named


@dataclass
class Token:
    """A tag (``text`` is None) or the text up to the next tag."""

    kind: str
    text: str | None
    block: int  # texts of one number belong to one block
    dropped: bool
    content: int  # how many content elements are open
    words: int = 1
    inside: tuple[int, ...] = ()  # open elements that are content or named as furniture


def tokens(page: str) -> list[Token]:
    """The tokens of a page, with furniture marked as dropped."""
    elements: list[set[str]] = []
    row = list(_read(page, elements))
    if not elements:
        return row
    words = [0] * len(elements)
    linked = [0] * len(elements)
    controls = [False] * len(elements)
    held: list[set[int]] = [set() for _ in elements]  # the content elements in each
    around = [-1] * len(elements)  # the content element around each
    heads = [False] * len(elements)
    seen: set[int] = set()
    total = 0
    for token in row:
        if token.kind in _CONTROLS:
            for e in token.inside:
                controls[e] = True
        if token.dropped:
            continue
        if token.text is not None:
            total += token.words
            for e in token.inside:
                words[e] += token.words
                linked[e] += token.words if token.kind.endswith(" a") else 0
        elif token.kind in _HEADINGS:
            for e in token.inside:
                heads[e] = True
        if token.inside and token.inside[-1] not in seen:
            seen.add(token.inside[-1])
            outer = -1
            for depth, e in enumerate(token.inside):
                around[e] = outer
                if not elements[e]:
                    outer = e
                    for other in token.inside[:depth]:
                        held[other].add(e)
    # teasers and comments may be article elements too; the content is the largest
    most = max((words[e] for e, named in enumerate(elements) if not named), default=0)
    kept = set()
    for e, named in enumerate(elements):
        whole = words[around[e]] if around[e] >= 0 else total
        if (
            not named
            or any(2 * words[c] >= most for c in held[e])
            or 2 * words[e] > whole
            or (around[e] >= 0 and named <= _DOUBTFUL and not controls[e] and 2 * linked[e] < words[e])
            or (around[e] >= 0 and heads[e] and named <= _HEADER)
        ):
            kept.add(e)
    for token in row:
        token.dropped = token.dropped or not kept.issuperset(token.inside)
    return row


def _read(page: str, elements: list[set[str]]) -> Iterator[Token]:
    """Read a page; unclosed and stray tags are taken as browsers take them, roughly.

    ``elements`` is filled with the names of furniture (none for content) of each
    element that ``inside`` counts; ``dropped`` holds for what never is content.
    """
    # open elements that are not inline, whether dropped, and what they are inside
    stack: list[tuple[str, bool, tuple[int, ...]]] = []
    anchors = 0
    block = 0
    at = 0
    content = 0
    end = len(page)

    def closed(down_to: int) -> None:
        nonlocal content
        while len(stack) > down_to:
            name = stack.pop()[0]
            content -= name in _CONTENT

    while at < end:
        found = _MARKUP.search(page, at)
        start, after = found.span() if found else (end, end)
        if start > at:
            text = page[at:start]
            where = stack[-1][0] if stack else "none"
            dropped = bool(stack) and stack[-1][1]
            kind = f"word {where}" + (" a" if anchors > 0 else "")
            inside = stack[-1][2] if stack else ()
            yield Token(kind, text, block, dropped, content, len(text.split()), inside)
        at = after
        if not found:
            return
        name = found[2]
        if name is None:
            continue
        name = name.lower()
        closing = bool(found[1])
        if not closing and name in _RAW:
            close = re.compile(rf"</{re.escape(name)}\b[^>]*+(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if name in _INLINE:
            if name == "a":
                anchors = max(0, anchors + (-1 if closing else 1))
            if name == "br":
                dropped, inside = stack[-1][1:] if stack else (False, ())
                yield Token("tag br", " ", block, dropped, content, 0, inside)
            continue
        block += 1
        furniture, inside = stack[-1][1:] if stack else (False, ())
        if closing:
            open_at = max((i for i, (n, _, _) in enumerate(stack) if n == name), default=-1)
            if open_at >= 0:
                closed(open_at)
                anchors = 0
        elif name not in _VOID and not found[4]:
            anchors = 0
            ends = {"p"} if name in _ENDS_P else set()
            ends |= _SIBLINGS.get(name, set())
            while stack and stack[-1][0] in ends:
                closed(len(stack) - 1)
            dropped, inside = stack[-1][1:] if stack else (False, ())
            dropped = dropped or name in _NEVER
            named = _furniture(name, found[3], content > 0)
            if named or name in _CONTENT:
                inside = (*inside, len(elements))
                elements.append(named)
            stack.append((name, dropped, inside))
            content += name in _CONTENT
            furniture = dropped
        yield Token(f"tag {'/' if closing else ''}{name}", None, block, furniture, content, 1, inside)


@dataclass
class Weights:
    """Log odds of each kind of token, and of a kind never seen."""

    kinds: dict[str, float] = field(default_factory=dict)
    word: float = 1.0
    tag: float = -1.0

    def of(self, token: Token) -> float:
        default = self.tag if token.kind.startswith("tag") else self.word
        return self.kinds.get(token.kind, default) * (token.words if token.text is not None else 1)


def best_run(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run with the largest positive sum, or (0, 0)."""
    best, at = 0.0, (0, 0)
    total, start = 0.0, 0
    for i, score in enumerate(scores):
        if total < 0:
            total, start = 0.0, i
        total += score
        if total > best or (total == best and best > 0 and at[0] == start):
            best, at = total, (start, i + 1)
    return at


def main_text(page: str, weights: Weights) -> str:
    """The blocks of the best run, joined by line feeds."""
    row = list(tokens(page))
    start, end = best_run([0.0 if t.dropped else weights.of(t) for t in row])
    blocks: dict[int, list[str]] = {}
    for token in row[start:end]:
        if token.text is not None and not token.dropped:
            blocks.setdefault(token.block, []).append(references.unescape(token.text))
    joined = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(text for text in joined if text)


def kind_counts(page: str) -> Counter:
    """Tokens in the content, outside of it, or (None) in furniture; empty if unlabelled."""
    row = list(tokens(page))
    opened = [t.kind for t in row if t.kind in ("tag article", "tag main")]
    counts: Counter = Counter()
    if len(opened) != 1 and opened != ["tag main", "tag article"]:
        return counts
    for token in row:
        if token.kind.removeprefix("tag ").lstrip("/") in _CONTENT:
            continue
        # of an article in a main element the article is the content
        inside = None if token.dropped else token.content >= len(opened)
        counts[token.kind, inside] += token.words if token.text is not None else 1
    return counts


def fit_weights(pages: DataFrame, html: str = "html", rows: int = SAMPLE_PAGES) -> Weights:
    """Weights from a sample of at most ``rows`` pages, chosen by a hash of the url and html.

    Only kinds of tokens and their counts come to the driver.
    """
    chosen = pages.select(html).where(F.col(html).isNotNull())
    chosen = chosen.orderBy(F.xxhash64(html), html).limit(rows)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for value in batch.column(0):
            counts.update(kind_counts(value.as_py() or ""))
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k for k, _ in keys], pa.string()),
                pa.array([i for _, i in keys], pa.bool_()),
                pa.array([counts[k] for k in keys], pa.int64()),
            ],
            ["kind", "inside", "n"],
        )

    found = map_batches(chosen, run, "kind string, inside boolean, n bigint")
    table = found.groupBy("kind").agg(
        F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("yes"),
        F.sum(F.when(~F.col("inside"), F.col("n")).otherwise(0)).alias("no"),
        F.sum(F.when(F.col("inside").isNull(), F.col("n")).otherwise(0)).alias("furniture"),
    )
    weights = Weights()
    for kind, yes, no, furniture in table.collect():  # bounded by the sample
        if yes + no:
            odds = max(-2.0, min(2.0, math.log((yes + 0.5) / (no + 0.5))))
        else:  # seen in furniture alone, which the scan leaves out: a weak sign
            odds = max(-0.5, math.log(0.5 / (furniture + 0.5)))
        # a tag never speaks for content by itself: its best weight is a small cost
        weights.kinds[kind] = min(odds, -0.1) if kind.startswith("tag") else odds
    return weights


def extract_text(
    pages: DataFrame, weights: Weights, keys: tuple[str, ...] = ("page_id", "url"), html: str = "html"
) -> DataFrame:
    """The keys, text and n_chars (code points) of every page."""
    kinds = dict(pages.dtypes)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = [main_text(x.as_py() or "", weights) for x in batch.column(len(keys))]
        arrays = [*batch.columns[: len(keys)], pa.array(texts, pa.string())]
        arrays.append(pa.array([len(t) for t in texts], pa.int64()))
        yield pa.RecordBatch.from_arrays(arrays, [*(f"k{i}" for i in range(len(keys))), "text", "n"])

    schema = ", ".join(f"k{i} {kinds[k]}" for i, k in enumerate(keys)) + ", text string, n bigint"
    return map_batches(pages.select(*keys, html), run, schema).toDF(*keys, "text", "n_chars")
