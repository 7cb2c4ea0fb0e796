"""Main text of web pages by maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive and tags negative; a linear scan finds the contiguous run
with the largest sum, the content region. The weights are log odds from labelled pages: pages that mark their main text
themselves (an ``article`` or ``main`` element) label their tokens as inside or outside, and at most ``TRAIN_PAGES``
different ones, those with the lowest hash of their html, are counted. Words in elements that are never main text (``SKIPPED``
elements, or a name in class, id or role made of ``SKIPPED_NAMES`` and ``PLAIN_NAMES`` alone) score nothing and their text
is left out of the region as well. Names do not count on article and main, nor ids on headings and sections, which are
often made from titles. A form with most of the page's words is never left out, and an element named so only if an article
or main element stands outside it.

The region is widened to the whole of the innermost container (article, main, section, div, td) around it, so that a
short last paragraph is not cut off by the tags before it.

Text: character references are decoded, white space in a block becomes one space, blocks are joined by one space.

Defined results: null or empty html, and a page without words outside skipped elements, give an empty text; unclosed and
stray tags are tolerated; an unclosed comment, script or style runs to the end; repeated rows and null ids are judged one
by one; extra columns are ignored; an empty table gives an empty result; without labelled pages fixed weights are used.
"""

from __future__ import annotations

import html as entities
import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import lowest_texts, steps, text_or_empty

TRAIN_PAGES = 2000
#: Weights that hold without labelled pages, and the range in which learned ones stay.
WORD_WEIGHT, TAG_WEIGHT = 1.0, -0.5
WORD_RANGE, TAG_RANGE = (0.5, 3.0), (-3.0, -0.1)

# HTML element names and common names of page furniture.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
INLINE = set("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
CONTAINERS = set("article main section div td".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
SKIPPED = set("head title nav footer aside button select textarea option dialog menu audio video canvas object map fieldset datalist".split())
SKIPPED_NAMES = re.compile(
    r"ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|sidebar|side|menu|navbar|nav|navigation|breadcrumbs?|masthead|topbar|toolbar|pager|pagination"
    r"|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscribe|signup|login|search|share|sharing|social|related|recommended|widget"
    r"|comments?|commentlist|disqus|replies|reply|respond|footer|foot|copyright|contentinfo|complementary|legal|disclaimer",
    re.I,
)
PLAIN_NAMES = re.compile(
    r"\d+(?:x\d+)?|lists?|area|box|bar|panel|left|right|top|bottom|upper|lower|container|wrapper|wrap|inner|outer|block|section|items?|links?|buttons?|icons?|form|title|header|heading|row|col|column"
    r"|site|page|global|main|primary|secondary|mobile|desktop|sticky|fixed|floating|media|posts?|entry|articles?|stories|js",
    re.I,
)
#: The rest of a tag; a quoted value may hold ">".
_REST = r"""(?:[^>=]++|=\s*+"[^"<]*+"|=\s*+'[^'<]*+'|=)*+>"""
_TOKEN = re.compile(rf"<!--.*?(?:-->|$)|<(script|style|noscript|template|svg|iframe)\b{_REST}.*?(?:</\1\s*+>|$)|<!?/?[a-zA-Z]{_REST}|<\?[^>]*>", re.I | re.S)
_ENDED = re.compile(r"(?:-->|</(?:script|style|noscript|template|svg|iframe)\s*>)\Z", re.I)
_NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDDEN = re.compile(r"""\shidden(?=[\s>/])|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)


class Page:
    """Tokens of a page in order. kind[k] is a tag name, or "" for a piece of text."""

    def __init__(self, source: str) -> None:
        self.kind: list[str] = []
        self.text: list[str] = []
        self.words: list[int] = []
        self.skipped: list[bool] = []
        self.breaks: list[bool] = []                          # a block ends or begins here
        self.inside: list[bool] = []                          # within an article or main element
        self.spans: list[tuple[int, int, str]] = []           # elements as [first token, end token)
        self.named: list[tuple[int, int, bool]] = []          # forms (True) and elements with a name that is skipped
        stack: list[tuple[str, int, bool, bool, bool]] = []
        self._skip, self._main = 0, 0
        opened: dict[str, list[int]] = {}                     # places in the stack of the open elements of a name
        barriers: list[int] = []                              # and of those that stray end tags do not reach out of

        def pop() -> None:
            element = stack.pop()
            opened[element[0]].pop()
            if barriers and barriers[-1] == len(stack):
                barriers.pop()
            self._close(element)

        at, tags = 0, source.rfind(">") + 1                   # no tag ends after that
        for m in _TOKEN.finditer(source, 0, tags):
            if m.start() > at:
                self._add_text(source[at : m.start()])
            at = m.end()
            if at == tags and (m.group(1) or m.group().startswith("<!--")) and not _ENDED.search(m.group()):
                at = len(source)                              # a comment or script without an end goes on to the page's end
            tag = _NAME.match(m.group())
            if m.group(1) or not tag:
                continue
            name, closing = tag[2].lower(), bool(tag[1])
            if closing:
                places = opened.get(name)
                if places and not (name in INLINE | {"p"} and barriers and barriers[-1] > places[-1]):
                    self._add_tag(name)
                    depth = places[-1]
                    while len(stack) > depth:
                        pop()
                continue
            if name not in VOID and not m.group().endswith("/>"):
                main = name in ("article", "main")
                skip = name in SKIPPED or (name == "header" and not self._main) or (name not in ("html", "body") and bool(_HIDDEN.search(m.group())))
                named = name == "form" or self._marked(m.group(), name)
                opened.setdefault(name, []).append(len(stack))
                if name in CONTAINERS or skip or named:
                    barriers.append(len(stack))
                stack.append((name, len(self.kind), skip, main, named))
                self._skip += skip
                self._main += main
            self._add_tag(name)
        rest = source[at:].partition("<!--")[0]
        if rest:
            self._add_text(rest)
        while stack:
            pop()
        self._skip_named()

    @staticmethod
    def _marked(tag: str, name: str) -> bool:
        if name in ("html", "body", "article", "main"):
            return False
        for kind, a, b, c in _ATTRIBUTE.findall(tag):
            if kind.lower() == "id" and (name in HEADINGS or name == "section"):
                continue
            for word in (a or b or c).split():
                parts = [x for x in re.split("[_-]+", word) if x]
                if any(SKIPPED_NAMES.fullmatch(x) for x in parts) and all(SKIPPED_NAMES.fullmatch(x) or PLAIN_NAMES.fullmatch(x) for x in parts):
                    return True
        return False

    def _skip_named(self) -> None:
        """Forms and named elements are skipped, the outer ones first, but for those that hold the page's main text."""
        words, marked = [0], [0]                              # sums of all words, and of those within article or main
        for n, skipped, inside in zip(self.words, self.skipped, self.inside, strict=True):
            words.append(words[-1] + (0 if skipped else n))
            marked.append(marked[-1] + (0 if skipped or not inside else n))
        named = sorted(self.named, key=lambda x: (x[0], -x[1]))
        bare = [marked[b] - marked[a] for a, b, _ in named]   # of each element, outside the named ones in it
        outside, around = marked[-1], []                      # words of article or main that no named element holds
        for k, (a, b, _) in enumerate(named):
            while around and named[around[-1]][1] <= a:
                around.pop()
            n = marked[b] - marked[a]
            if around:
                bare[around[-1]] -= n
            else:
                outside -= n
            around.append(k)
        done = 0
        for (a, b, form), own in zip(named, bare, strict=True):
            if a < done:
                continue                                      # within an element that is skipped
            if 2 * (words[b] - words[a]) > words[-1] and (form or not outside):
                outside += own
                continue
            self.skipped[a:b] = [True] * (b - a)
            done = b

    def _close(self, element: tuple[str, int, bool, bool, bool]) -> None:
        name, first, skip, main, named = element
        self.spans.append((first, len(self.kind), name))
        if named and not skip:
            self.named.append((first, len(self.kind), name == "form"))
        self._skip -= skip
        self._main -= main

    def _add(self, kind: str, text: str, words: int) -> None:
        self.kind.append(kind)
        self.text.append(text)
        self.words.append(words)
        self.skipped.append(self._skip > 0)
        self.inside.append(self._main > 0)
        self.breaks.append(bool(kind) and kind not in INLINE)

    def _add_tag(self, name: str) -> None:
        self._add(name, "", 0)

    def _add_text(self, raw: str) -> None:
        text = entities.unescape(raw)
        self._add("", text, len(text.split()))

    def best_region(self, weights: dict[str, float]) -> tuple[int, int]:
        """The run of tokens with the largest sum, as [first, end)."""
        word, other = weights[""], weights["*"]
        best, total, first, region = 0.0, 0.0, 0, (0, 0)
        for k, kind in enumerate(self.kind):
            if not self.skipped[k]:
                total += weights.get(kind, other) if kind else word * self.words[k]
            if total <= 0:
                total, first = 0.0, k + 1
            elif total > best:
                best, region = total, (first, k + 1)
        return region

    def widened(self, region: tuple[int, int]) -> tuple[int, int]:
        """The innermost container around the region, or the region if there is none."""
        a, b = region
        words = [k for k in range(a, b) if self.words[k] and not self.skipped[k]]
        if not words:
            return region
        around = [(e - s, s, e) for s, e, name in self.spans if s <= words[0] and words[-1] < e and name in CONTAINERS]
        return min(around)[1:] if around else region

    def main_text(self, weights: dict[str, float]) -> str:
        a, b = self.widened(self.best_region(weights))
        parts = []
        for k in range(a, b):
            if self.breaks[k]:
                parts.append(" ")
            if self.words[k] and self.skipped[k]:
                parts.append(" ")
            elif not self.kind[k] and not self.skipped[k]:
                parts.append(self.text[k])
        return " ".join("".join(parts).split())


def fixed_weights() -> dict[str, float]:
    return {"": WORD_WEIGHT, "*": TAG_WEIGHT}


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, inside, n) of the tokens of labelled pages; kind "" counts words."""
    seen: dict[tuple[str, bool], int] = {}
    for batch in batches:
        for source in batch.column(0).to_pylist():
            page = Page(source)
            for kind, inside, words, skipped in zip(page.kind, page.inside, page.words, page.skipped, strict=True):
                if not skipped:
                    seen[kind, inside] = seen.get((kind, inside), 0) + (1 if kind else words)
    rows = list(zip(*((k, i, n) for (k, i), n in seen.items()), strict=True)) or [[], [], []]
    yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.string()), pa.array(rows[1], pa.bool_()), pa.array(rows[2], pa.int64())], ["kind", "inside", "n"])


def learn(pages: DataFrame, html_col: str = "html", most: int = TRAIN_PAGES) -> dict[str, float]:
    """Log odds of a token kind inside against outside the main text, held in their ranges."""
    marked = pages.where(F.col(html_col).rlike("(?i)<(article|main)[ >]")).select(F.col(html_col).alias("text"))
    rows = lowest_texts(marked, most).mapInArrow(_count, "kind string, inside boolean, n long").groupBy("kind", "inside").agg(F.sum("n").alias("n")).orderBy(F.desc("n")).limit(400).collect()
    weights = fixed_weights()
    tokens = {(r.kind, r.inside): r.n for r in rows}
    total = {i: sum(n for (k, j), n in tokens.items() if j == i) for i in (True, False)}
    if not total[True]:
        return weights
    for kind in {k for k, _ in tokens}:
        odds = math.log((tokens.get((kind, True), 0) + 1) / (total[True] + 1)) - math.log((tokens.get((kind, False), 0) + 1) / (total[False] + 1))
        low, high = TAG_RANGE if kind else WORD_RANGE
        weights[kind] = min(max(odds, low), high)
    return weights


def _extract(weights: str, text_out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = json.loads(weights)
        for batch in steps(batches, "_html"):
            texts = [Page(s).main_text(own) for s in batch.column("_html").to_pylist()]
            rest = batch.drop_columns(["_html"])
            cols = [*rest.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, [*rest.schema.names, text_out, "n_chars"])

    return run


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url"), weights: dict[str, float] | None = None) -> DataFrame:
    """The kept columns, text and n_chars of every page."""
    own = learn(pages, html_col) if weights is None else weights
    narrow = pages.select(*keep, text_or_empty(html_col).alias("_html"))
    kinds = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)
    return narrow.mapInArrow(_extract(json.dumps(own), "text"), f"{kinds}, text string, n_chars long")
