"""Main text of web pages by a maximum-scoring subsequence of words and tags.

A page is a sequence of words and tags. Words score zero or more and tags less than zero; one scan finds the contiguous
stretch of the highest sum, which is the content region. The weights are learned from labelled pages: those that mark their
own content with one ``article`` or ``main`` element. A word's weight depends on its block and on where it is (inside the
marked content, beside it, or on a page without marks), a tag's on its name too; both are log odds of being content,
cut at zero from below for words and from above for tags. To learn what content without marks looks like, a labelled page
also counts as if its marks were unknown. Elements that are never content (menus, footers, adverts, forms, scripts,
comments of readers, ...) score nothing for their words and are left out of the region's text.
"""

from __future__ import annotations

import html as markup
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.llm.common import fresh

#: Labelled pages from which weights are learned, about.
LABELLED_PAGES = 2000

# Element names of HTML.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select "
    "summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript")
# Elements, roles and words of classes and ids that are never content.
LEFT_OUT = frozenset(
    "aside button canvas datalist dialog embed fieldset footer form head iframe input menu nav noembed noframes noscript object "
    "script search select style svg template textarea title".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "copyright disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices overlay pager "
    "pagination popup promo promoted promotion recommended related share sharing sidebar signup skip social sponsor sponsored "
    "subscribe toolbar widget".split())
CONTENT_WORDS = frozenset("article articlebody content entry post story".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
ITEMS = frozenset("li dt dd option tr td th".split())
AROUND = frozenset("article main body html".split())
#: A token counts; lies in the header of an article, of which headings count; or in an element that never counts.
KEPT, HEADER, GONE = range(3)

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*))>|</[^a-zA-Z][^>]*>|<[a-zA-Z/][^>]*\Z", re.DOTALL)
_ATTRIBUTE = re.compile(r"(?:^|[\s\"'/])(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE) for name in RAW}
_SPLIT = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, rest) in page order: ``text`` with the raw text as rest, ``open`` with attributes, ``close``.

    Comments and declarations yield nothing; what scripts and the like hold is not split. A comment, script or tag that
    never ends goes to the end of the page.
    """
    at = 0
    while at < len(page):
        found = _TOKEN.search(page, at)
        if not found:
            yield "text", "", page[at:]
            return
        if found.start() > at:
            yield "text", "", page[at : found.start()]
        at = found.end()
        slash, name, rest = found.groups()
        if not name:
            continue
        name = name.lower()
        yield ("close", name, "") if slash else ("open", name, rest)
        if name in _RAW_END and not slash:
            end = _RAW_END[name].search(page, at)
            if name == "title" or name == "textarea":
                yield "text", "", page[at : end.start() if end else len(page)]
            yield "close", name, ""
            at = end.end() if end else len(page)


def _marks(name: str, attributes: str) -> tuple[bool, bool]:
    """Whether an element is never content, and whether its class or id says that it is content."""
    out, content = name in LEFT_OUT, False
    if "=" in attributes:
        for key, *values in _ATTRIBUTE.findall(attributes):
            value = next((v for v in values if v), "")
            if key.lower() == "role":
                out |= value.strip().lower() in ROLES
                content |= value.strip().lower() in ("main", "article")
            else:
                parts = set(_SPLIT.split(_CAMEL.sub("-", value).lower()))
                out |= bool(parts & WORDS)
                content |= bool(parts & CONTENT_WORDS)
    if name in ("html", "body", "main"):
        return False, content
    return (out and not content, content) if name == "article" else (out, content and not out)


class Page:
    """Texts and tags of a page in order, as parallel lists.

    ``text`` is null for a tag, ``feature`` its block or the tag's name. ``left_out`` says that it lies in an element that is
    never content, ``inside`` whether it lies in an ``article``, in a ``main`` and in one that class or role names as
    content, ``starts_block`` that a block began since the last text.
    """

    def __init__(self, page: str):
        self.text: list[str | None] = []
        self.feature: list[str] = []
        self.left_out: list[bool] = []
        self.inside: list[tuple[bool, bool, bool]] = []
        self.starts_block: list[bool] = []
        self.elements = Counter()
        stack: list[tuple[str, int, tuple[bool, bool, bool]]] = []
        out, inside, block, fresh_block = KEPT, (False, False, False), "body", True

        def reset() -> None:
            nonlocal out, inside, block
            out, inside = stack[-1][1:] if stack else (KEPT, (False, False, False))
            block = next((name for name, _, _ in reversed(stack) if name in BLOCKS or name == "a"), "body")

        def put(text: str | None, feature: str) -> None:
            self.text.append(text)
            self.feature.append(feature)
            self.left_out.append(out != KEPT)
            self.inside.append(inside)
            self.starts_block.append(fresh_block)

        def close_implied(name: str) -> None:
            """A new block ends an open paragraph, an item or cell one of its kind, the body the head."""
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in BLOCKS or stack[i][0] == "head"), None)
            if at is not None and (stack[at][0] == "p" or (stack[at][0] == name and name in ITEMS) or (stack[at][0] == "head" and name == "body")):
                del stack[at:]
                reset()

        for kind, name, rest in tokens(page):
            if kind == "text":
                put(rest, block)
                fresh_block = False
                continue
            if name == "br":
                put(" ", block)
                continue
            if name in BLOCKS:
                fresh_block = True
            if kind == "open":
                if name in BLOCKS:
                    close_implied(name)
                if name in VOID:
                    put(None, f"<{name}")
                    continue
                never, named = _marks(name, rest)
                if name == "header":
                    out = max(out, HEADER if any(inside[:2]) else GONE)
                elif name in HEADINGS and out == HEADER:
                    out = KEPT
                if never:
                    out = GONE
                kept = out == KEPT
                if kept and name in ("article", "main"):
                    self.elements[name] += not any(s[0] == name for s in stack)
                self.elements["named"] += kept and named
                inside = (inside[0] or (kept and name == "article"), inside[1] or (kept and name == "main"), inside[2] or (kept and named))
                stack.append((name, out, inside))
                if name in BLOCKS or name == "a":
                    block = name
                put(None, f"<{name}")
                continue
            put(None, f"</{name}")
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
                if stack[i][0] in AROUND and name not in AROUND:
                    break  # a stray end tag closes nothing around the content
            reset()

    def mark(self) -> int | None:
        """Which of the marks says where content is: the strongest one there is."""
        return next((i for i, name in enumerate(("article", "main", "named")) if self.elements[name]), None)

    def labelled(self) -> bool:
        """Whether the page marks its content without doubt."""
        return self.elements["article"] == 1 or (not self.elements["article"] and self.elements["main"] == 1)

    def features(self, known: bool = True) -> Iterator[tuple[str, bool]]:
        """(feature, whether the mark says content) of each token; with ``known`` false as on a page without marks."""
        mark = self.mark()
        for feature, out, inside in zip(self.feature, self.left_out, self.inside, strict=True):
            marked = mark is not None and inside[mark]
            shown = marked and known
            place = ("gap" if shown else "out") if out else "in" if shown else "free" if mark is None or not known else "beside"
            yield f"{place} {feature}", marked and not out


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, content, n) of a task's labelled pages; tags count one, texts their words."""
    seen: Counter = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            page = Page(text or "")
            if not page.labelled():
                continue
            for known in (True, False):
                for (feature, content), raw in zip(page.features(known), page.text, strict=True):
                    seen[_common(feature), content] += 1 if raw is None else len(raw.split())
    rows = list(seen.items())
    yield pa.RecordBatch.from_arrays(
        [pa.array([f for (f, _), _ in rows], pa.string()), pa.array([c for (_, c), _ in rows], pa.bool_()), pa.array([n for _, n in rows], pa.int64())],
        names=["feature", "content", "n"])


def _common(feature: str) -> str:
    """A feature with names that HTML does not have made one, so that there are few."""
    place, _, name = feature.partition(" ")
    bare = name.lstrip("</")
    return feature if bare in BLOCKS or bare in VOID or bare in LEFT_OUT or len(bare) <= 6 and bare.isalnum() and bare.isascii() else f"{place} {name[: len(name) - len(bare)]}other"


def learn_weights(pages: DataFrame, html: str = "html", page_id: str = "page_id", most: int = LABELLED_PAGES) -> dict[str, tuple[int, int]]:
    """Counts (content, other) of each feature over about ``most`` pages with a mark, those of smallest id hash.

    Without such pages the result is empty and only the prior weights are left. Features are names of elements in four
    places, so their number is bounded. Rows without html or id are not looked at.
    """
    marked = pages.where(F.col(page_id).isNotNull() & F.col(html).rlike("(?i)<(article|main)[\\s>]")).select(
        F.col(html).alias("html"), F.xxhash64(page_id).alias("h"))
    share = min(1.0, most / max(1, marked.count()))
    chosen = marked.where(F.col("h").cast("double") <= 2.0**64 * share - 2.0**63)
    rows = chosen.select("html").mapInArrow(_counts, "feature string, content boolean, n long").groupBy("feature", "content").agg(F.sum("n").alias("n"))
    out: dict[str, list[int]] = {}
    for r in rows.collect():
        out.setdefault(r.feature, [0, 0])[0 if r.content else 1] += r.n
    return {k: tuple(v) for k, v in out.items()}


class Weights:
    """Scores of tokens: log odds of content with a prior, at least 0 for words and below 0 for tags."""

    #: Words of these blocks are content if nothing is known; tags cost a little more than nothing, as in running text.
    PRIOR = {"p": 2.0, "h1": 2.0, "h2": 1.5, "h3": 1.5, "pre": 1.5, "blockquote": 1.5, "a": -2.0, "li": 0.5, "td": 0.3, "body": 0.3}
    LEAST = 0.01

    def __init__(self, counts: dict[str, tuple[int, int]]):
        self.counts, self.known = counts, {}

    def __call__(self, feature: str) -> float:
        if feature not in self.known:
            place, _, name = feature.partition(" ")
            tag = name.startswith("<")
            prior = {"in": 3.0, "gap": 0.0, "beside": -3.0, "out": -3.0}.get(place, -0.5 if tag else self.PRIOR.get(name, 0.5))
            content, other = self.counts.get(_common(feature), (0, 0))
            # the prior weighs as much as ten tokens
            odds = 1 / (1 + math.exp(-prior)) * 10
            score = math.log((content + odds) / (other + 10 - odds))
            if place == "gap":  # left out of the text anyway, so it must not part what stands around it
                score = 0.0
            self.known[feature] = min(score, -self.LEAST) if tag else 0.0 if place == "out" else max(score, 0.0)
        return self.known[feature]


def region(page: Page, weights: Weights) -> tuple[int, int]:
    """First token of the best stretch and the one after its last; the first and shortest of equal ones, (0, 0) if none is positive."""
    best, best_at, total, begin = 0.0, (0, 0), 0.0, 0
    for i, ((feature, _), text) in enumerate(zip(page.features(), page.text, strict=True)):
        total += weights(feature) * (1 if text is None else len(text.split()))
        if total <= 0:
            total, begin = 0.0, i + 1
        elif total > best:
            best, best_at = total, (begin, i + 1)
    return best_at


def main_text(page: str | None, weights: Weights) -> str:
    """Text of the content region: blocks joined by line feeds, white space inside a block as one space."""
    parsed = Page(page or "")
    begin, end = region(parsed, weights)
    blocks: list[list[str]] = [[]]
    for i in range(begin, end):
        if parsed.starts_block[i] and blocks[-1]:
            blocks.append([])
        if parsed.text[i] is not None and not parsed.left_out[i]:
            blocks[-1].append(markup.unescape(parsed.text[i]))
    lines = (" ".join("".join(b).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def extract(pages: DataFrame, counts: dict[str, tuple[int, int]], html: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with the main text of each row's html in a new column; empty for null, empty or contentless html.

    Pages of any length are read whole, one at a time. Other columns stay; a clashing name gets underscores.
    """
    weights = Weights(counts)

    @F.pandas_udf("string")
    def text_of(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(p, weights) for p in pages], dtype=object)

    return pages.withColumn(fresh(pages, name), text_of(F.col(html)))
