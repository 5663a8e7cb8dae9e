"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks of text at the borders of block elements.  A linear classifier gives each
block a cost of being called content and of being called boilerplate (element and class names above it,
share of linked text, length); these costs are the capacities to the two terminals.  Blocks next to each
other, and blocks under the same element, are tied by smoothness edges, stronger the closer they are in
the document tree.  The minimum cut, found by maximum flow, is the cheapest labelling; the source's side
is the content.

Each page is a row and its graph has a few edges per block, so the work is linear in practice and needs
no shuffle.  Defined results: null and empty pages, and pages without content, give an empty text; broken
markup is read as far as it goes and an unfinished tag at the end is dropped; repeated rows give repeated
results; an empty table gives none.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tallyhouse.llm.mincut import Cut

BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Never text of the page.
SILENT = frozenset("head script style noscript template title svg iframe object select option button textarea canvas audio video datalist".split())
#: What a head holds.
HEAD = frozenset("html head base basefont bgsound link meta noscript script style template title".split())
#: An open element that the start of another one of the set ends.
CLOSES = {"p": BLOCK, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}

AWAY_TAGS = frozenset("nav aside footer menu dialog".split())
AWAY_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs sidebar "
    "footer masthead comment comments respond disqus cookie cookies consent popup modal newsletter subscribe signup login pagination pager copyright".split()
)
#: The same, unless the name also speaks of the article.
PERHAPS_AWAY = frozenset("aside header banner notice share sharing social related recommended widget toolbar legal skip".split())
#: Whole names that nothing nested lifts: menus, the foot of a page, comments.
FIRM_WORDS = frozenset("nav navbar navigation menu breadcrumb breadcrumbs footer pagination pager comment comments respond disqus".split())
#: Lists of teasers, whose items are articles too.
TEASER_WORDS = frozenset("related recommended sponsor sponsored promo promotion share sharing social".split())
#: Next to a word of the above in one name, these describe the layout or a switch: no-sidebar, comments-open.
STATE_WORDS = frozenset("no not without with has have is hide show open opened closed off on enabled disabled allowed layout".split())
MAIN_TAGS = frozenset("article main".split())
MAIN_WORDS = frozenset("article content post entry story main maincontent articlebody".split())

#: Weights of the classifier; positive speaks for content.
MAIN, AWAY, LINKED, LENGTH, SHORT, HEADING = 5.0, -9.0, -4.0, 0.6, -0.8, 0.6
#: For a block of a page that names no main text.
PLAIN = 0.8
#: What a wrapper named away costs the blocks below it, the less the more of the page's words it holds.
NAMED = -7.0
#: Strength of ties: neighbours, and blocks of the same parent.
NEAR, SIBLING = 0.6, 0.8
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre caption figcaption summary legend address center".split())


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    parent: int  # number of the element that holds the block
    hint: int  # 1 main, -1 away, -2 away whatever is nested in it, 0 nothing
    heading: bool
    wrapper: int = 0  # the innermost element above that is named away, a key of ``Wrappers.above``; 0 for none


class Wrappers:
    """Elements named away, each linked to the one above it.

    Inside an article only teasers count; these stand under their negative number, linked to the
    teasers above them.
    """

    def __init__(self):
        self.above: dict[int, int] = {}  # in order: a wrapper comes after those above it
        self.forms: set[int] = set()
        self._teaser: dict[int, int] = {0: 0}  # wrapper -> innermost teaser at or above it, by its negative number

    def add(self, number: int, above: int, teaser: bool) -> int:
        self.above[number] = above
        self._teaser[number] = self._teaser[above]
        if teaser:
            self.above[-number] = self._teaser[above]
            self._teaser[number] = -number
        self._teaser[-number] = self._teaser[number]
        return number

    def in_article(self, wrapper: int) -> int:
        return self._teaser[wrapper]


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, int, bool, int]] = []  # tag, number, hint, silent, wrapper
        self.open: Counter[str] = Counter()  # tags in the stack
        self.block_at: list[int] = []  # places of block elements in the stack
        self.wrappers = Wrappers()
        self.blocks: list[Block] = []
        self.count = self.links = 0
        self.parts: list[str] = []
        self.linked = 0

    def _end_block(self):
        text = " ".join("".join(self.parts).split())
        if text:
            above = [self.stack[k] for k in self.block_at[-2:]]
            tag = above[-1][0] if above else ""
            holder = above[:-1] if tag in LEAVES else above
            self.blocks.append(Block(text, self.linked, holder[-1][1] if holder else 0, above[-1][2] if above else 0, tag in ("h1", "h2", "h3", "h4", "h5", "h6"), above[-1][4] if above else 0))
        self.parts, self.linked = [], 0

    def _hint(self, tag: str, attrs) -> tuple[int, int]:
        above, wrapper = (self.stack[-1][2], self.stack[-1][4]) if self.stack else (0, 0)
        if above < -1:
            return above, 0  # nothing inside a menu is content
        if tag == "main":
            return 1, 0
        if tag == "article":
            return 1, self.wrappers.in_article(wrapper)
        if above < 0:
            return above, 0
        if tag in AWAY_TAGS:
            return -2, 0
        if tag == "header" and above == 0:
            return -1, 0
        names = [set(re.findall(r"[a-z]+", x)) for k, v in attrs if k in ("class", "id", "role") and v for x in v.lower().split()]
        main = any(x & MAIN_WORDS and not x & AWAY_WORDS for x in names)
        if tag not in ("html", "body"):
            whole = {w for x in names if len(x) == 1 for w in x}
            parts = {w for x in names if len(x) > 1 and not x & STATE_WORDS for w in x}
            if not main and (whole & FIRM_WORDS or any(x & {"comment", "comments"} and x & {"list", "area", "thread"} for x in names)):
                return -2, 0
            away = whole & AWAY_WORDS if main else (whole | parts) & (AWAY_WORDS | PERHAPS_AWAY)
            if away:
                return int(main), self.wrappers.add(self.count, wrapper, bool(away & TEASER_WORDS))
            if tag == "form":
                self.wrappers.forms.add(self.count)
                return int(main), self.wrappers.add(self.count, wrapper, False)
        return 1 if main else above, wrapper

    def handle_starttag(self, tag, attrs):
        if tag not in HEAD:
            self._end_head(tag == "body")
        if tag in BLOCK or tag == "br":
            if tag == "br":
                self.parts.append(" ")
            else:
                self._end_block()
        if tag in VOID:
            return
        while self.stack and tag in CLOSES.get(self.stack[-1][0], ()):
            self._pop()
        if tag in BLOCK:
            # inline elements left open do not keep a paragraph from ending
            for k in range(len(self.stack) - 1, -1, -1):
                name = self.stack[k][0]
                if name in BLOCK or name in SILENT:
                    if tag in CLOSES.get(name, ()):
                        while len(self.stack) > k:
                            self._pop()
                    break
        self.count += 1
        self.links += tag == "a"
        silent = tag in SILENT or bool(self.stack and self.stack[-1][3]) or (tag == "label" and self.open["form"] > 0)
        hint, wrapper = self._hint(tag, attrs)
        if tag in BLOCK:
            self.block_at.append(len(self.stack))
        self.open[tag] += 1
        self.stack.append((tag, self.count, hint, silent, wrapper))

    def _end_head(self, body: bool):
        """What cannot stand in a head ends it, the body also what is still open in it."""
        if self.stack and (self._top() == "head" or body and self.open["head"] > 0):
            while self._top() != "head":
                self._pop()
            self._pop()

    def _pop(self):
        tag = self.stack.pop()[0]
        self.open[tag] -= 1
        self.links -= tag == "a"
        if self.block_at and self.block_at[-1] == len(self.stack):
            self.block_at.pop()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.stack and self.stack[-1][0] == tag and tag not in ("p", "div"):
            self._pop()

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self._end_block()
        if self.open[tag] > 0:
            if tag not in BLOCK and tag not in SILENT:  # an inline end does not close the block around it
                if next(x[0] for x in reversed(self.stack) if x[0] == tag or x[0] in BLOCK) != tag:
                    return
            while self._top() != tag:
                self._pop()
            self._pop()

    def _top(self):
        return self.stack[-1][0]

    def handle_data(self, data):
        if data.strip():
            self._end_head(False)
        if not (self.stack and self.stack[-1][3]):
            self.parts.append(data)
            if self.links:
                self.linked += len(data.strip())

    def done(self) -> list[Block]:
        self.close()
        self._end_block()
        return self.blocks


_TAG_BEGINS = re.compile(r"<[a-zA-Z/!]")


def finished(html: str) -> str:
    """``html`` without a comment or tag that its end cuts off."""
    at = html.find("<!--")
    while at >= 0:
        end = html.find("-->", at + 4)
        if end < 0:
            return html[:at]
        at = html.find("<!--", end + 3)
    last = html.rfind("<")
    return html[:last] if last > html.rfind(">") and _TAG_BEGINS.match(html, last) else html


def blocks_of(html: str | None) -> tuple[list[Block], Wrappers]:
    """Blocks, and the elements named away."""
    reader = _Reader()
    reader.feed(finished(html or ""))
    return reader.done(), reader.wrappers


def wrapper_costs(blocks: list[Block], wrappers: Wrappers) -> list[float]:
    """What the wrappers above every block speak against it.

    A wrapper that holds most words of a page is its layout, so it says little.  One that only has a
    name counts in full where the page calls another part its main text; a form never does.
    """
    if not any(b.wrapper for b in blocks):
        return [0.0] * len(blocks)
    sizes = [b.text.count(" ") + 1 for b in blocks]
    below: Counter[int] = Counter()
    for b, n in zip(blocks, sizes, strict=True):
        if b.wrapper:
            below[b.wrapper] += n
    for w, above in reversed(wrappers.above.items()):  # from the innermost outwards
        if above:
            below[above] += below[w]
    told = any(b.hint > 0 and not b.wrapper for b in blocks)
    every = sum(sizes)
    cost = {0: 0.0}
    for w, above in wrappers.above.items():
        held = below[abs(w)] + below[-abs(w)]
        own = NAMED if told and abs(w) not in wrappers.forms else NAMED * (1 - held / every) ** 2
        cost[w] = min(own, cost[above]) if above else own
    return [cost[b.wrapper] for b in blocks]


def evidence(b: Block, wrapped: float = 0.0, told: bool = True) -> float:
    """Positive for content.

    Where nothing in a page is ``told`` to be its main text, shortness says nothing, and links only
    where they are most of a block: what nothing speaks against is kept.
    """
    words = b.text.count(" ") + 1
    linked = min(1.0, b.linked / len(b.text))
    if not told:
        linked = max(0.0, 2 * linked - 1)
    out = wrapped + LENGTH * math.log(words) + LINKED * linked + (MAIN if b.hint > 0 else AWAY if b.hint < 0 else 0.0)
    if not told and b.hint == 0 and not b.heading:
        return out + PLAIN
    return out + (HEADING if b.heading else SHORT if words < 8 and b.hint == 0 else 0.0)


def label(blocks: list[Block], wrappers: Wrappers) -> list[bool]:
    cut = Cut(len(blocks))
    wrapped = wrapper_costs(blocks, wrappers)
    told = any(b.hint > 0 for b in blocks)
    last: dict[int, int] = {}
    for k, b in enumerate(blocks):
        x = evidence(b, wrapped[k], told)
        cut.terminal(k, max(x, 0.0), max(-x, 0.0))
        if k:
            near = NEAR if (blocks[k - 1].hint, blocks[k - 1].wrapper) == (b.hint, b.wrapper) else NEAR / 4
            cut.edge(k - 1, k, near, near)
        if b.parent in last and last[b.parent] != k - 1:
            cut.edge(last[b.parent], k, SIBLING, SIBLING)
        last[b.parent] = k
    return cut.side()


def main_text(html: str | None) -> str:
    blocks, wrappers = blocks_of(html)
    return "\n\n".join(b.text for b, content in zip(blocks, label(blocks, wrappers), strict=True) if content)


def extract(pages: DataFrame, html="html", keep=("page_id", "url")) -> DataFrame:
    """``keep`` columns, ``text`` and ``n_chars`` of every page."""
    names = [f"c{k}" for k in range(len(keep))]
    base = pages.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.col(f"`{html}`").alias("html"))
    schema = StructType([*base.drop("html").schema.fields, StructField("text", StringType()), StructField("n_chars", LongType())])

    def run(batches):
        for batch in batches:
            texts = [main_text(h) for h in batch.column(len(names)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*names, "text", "n_chars"]
            )

    out = base.mapInArrow(run, schema)
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, keep, strict=True)], "text", "n_chars")


def op10(spark, pages: DataFrame) -> DataFrame:
    return extract(pages)
