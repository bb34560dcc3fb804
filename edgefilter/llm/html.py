"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass decides each
block by itself: by where it stands (menus, footers, forms, adverts, notices,
reader comments and the like, from tag names, roles and the names of class and
id; a name around the main text, as of a page "with-sidebar", marks nothing),
by link density, and by length with stop-word density. Long blocks with
many stop words are text, blocks of links are not; on pages in languages the
stop words don't cover, long blocks and whole sentences are text; short blocks, and those in
between, stay open. In the second pass an open block takes the label of its
nearest decided neighbour, first among the blocks of its own container, then of
the page; a heading goes with what follows it; between a text and another
label at the same distance a block that stands in an article is text. On a page
whose articles hold a third of the accepted text or more, and no less than any
other part, what stands outside of them is not text. An article is the tag
article or main, the role main, or an element whose class or id is "main". On a page
without any text block, or article, the open blocks are the text.

Defined cases: null or empty html gives an empty text; white space (as Unicode
has it, no-break space included) inside a block is one space; a line break is
white space; unclosed tags end with their container, a head with the first tag
or text that may not stand in it; an unclosed comment,
script or style takes the rest of the page; equal rows each come out, null ids
and urls are kept; other columns are ignored, so their names can't clash; an empty table gives no rows. A "<" that starts a tag
without an end is text; pages of any length and of broken tags are read in time linear in their length, one page
at a time.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgefilter.llm.common import register, table

# Frequent function words of the languages covered.
STOP_WORDS = frozenset("""
the of and to a in is it that was for on are as with his they at be this from have or by one had not but what all were
when we there can an your which their said if do will each about how up out them then she many some so these would
le la les de des du un une et est en que qui dans pour pas au aux sur avec ce il elle ne se plus par son sa ses ou mais
der die das und ist in den von zu mit sich auf für nicht ein eine einer dem im als auch es an werden aus er hat dass sie
el los las y que en un una es se no por con para su al lo como más del pero sus le ya o este sí porque esta entre
""".split())
BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section
summary table tbody td tfoot th thead tr ul""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What an opening tag ends first, if that is open in the same container.
ENDS = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("td", "th", "tr"), "td": ("td", "th"),
        "th": ("td", "th"), "option": ("option",)}
#: What may stand in a head; any other tag, or text, ends it.
HEAD_TAGS = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
SCOPES = frozenset("article aside body div footer form header main nav section table ul ol dl td th".split())
ASIDE_TAGS = frozenset("nav footer aside form menu dialog button select option textarea label fieldset head".split())
ASIDE_WORDS = frozenset("""ad adbox ads adslot advert advertisement advertising adverts banner breadcrumb breadcrumbs
comment comments consent cookie cookies discussion disqus footer login masthead menu menubar modal nav navbar navigation
newsletter notice notices pagination popup promo promoted promotion related replies reply responses search share sharing
sidebar signup social sponsor sponsored subscribe subscription toolbar topbar widget""".split())
#: What may follow one of the words in a name of two parts ("comments-list").
PART_WORDS = frozenset("""area bar block body box card container content form frame group holder inner item items label
links list outer panel row section slot title unit wrap wrapper x""".split())
#: Elements that no class or id marks as aside.
UNMARKED_TAGS = frozenset("html body main article".split())
#: A mark is lifted if the accepted text outside of all marks is less than this share of the text inside.
LIFT = 0.25
#: The least share of a page's accepted text that articles hold if what stands outside is left out.
MAIN_LEAST = 1 / 3
# "header" is a page's, unless it stands in an article, where it is the article's own
MAIN_TAGS = frozenset(["article", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

LINKS_MOST = 0.5
LONG, SHORT = 200, 70
STOP_HIGH, STOP_LOW = 0.30, 0.10
#: Share of stop words in the long blocks of a page from which on its language counts as one of the list's.
STOP_KNOWN = 0.20
#: A character of a script without spaces counts as so many.
DENSE_SCRIPT = 3

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|noscript|template|iframe|svg|textarea|title)\b.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9-]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?/][^>]*(?:>|\Z)",
    re.IGNORECASE | re.DOTALL)
#: The start of a tag, and what ends or quotes in it.
TAG_START = re.compile("</?[a-z]", re.IGNORECASE)
RAW_START = re.compile(r"<(?:script|style|noscript|template|iframe|svg|textarea|title)\b", re.IGNORECASE)
SPECIAL = re.compile("[>\"']")
NAMES = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
WORD = re.compile(r"[^\W\d_]+")
NO_SPACES = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
LATIN = re.compile("[A-Za-z\u00c0-\u024f]")
SENTENCE_END = re.compile("[.!?\u2026\u3002\uff01\uff1f\u061f\u06d4\u0964\u0589][\"'\u00bb\u201d\u2019\u300d\u300f)\uff09]*$")


@dataclass
class Block:
    """A run of text between block-level tags."""

    text: str
    link_chars: int
    container: int              # number of the nearest container
    aside: bool                 # stands in a menu, footer, form, advert, ...
    main: bool                  # stands in an article
    heading: bool
    label: str = "open"
    marks: frozenset = frozenset()      # names of classes and ids around it that speak of an aside
    around: frozenset = frozenset()     # those of them that stand around its article
    counts: tuple[int, int] | None = None       # stop words and words, once counted
    parents: list[int] = field(default_factory=lambda: [0])     # the page's: the container of each container


@dataclass
class _Element:
    tag: str
    aside: bool
    main: bool
    container: int
    marks: frozenset = frozenset()
    around: frozenset = frozenset()


def mark_of(name: str) -> bool:
    """Whether a class or id speaks of an aside: as a whole, by its last part, or by the first of two."""
    parts = [w for w in re.split(r"[^a-z]+", name) if w]
    return bool(parts) and (parts[-1] in ASIDE_WORDS or len(parts) == 2 and parts[0] in ASIDE_WORDS
                            and parts[1] in PART_WORDS)


class _Ends:
    """Where tags end: for each place of a page whether a tag that is open there has an end (worked out from the right)."""

    def __init__(self, html: str):
        self.at = [m.start() for m in SPECIAL.finditer(html)]
        closed, following = [False] * len(self.at), {}
        for k in range(len(self.at) - 1, -1, -1):
            c = html[self.at[k]]
            if c == ">":
                closed[k] = True
            else:
                q = following.get(c)                     # the quote that ends this one
                closed[k] = q is not None and q + 1 < len(closed) and closed[q + 1]
                following[c] = k
        self.closed = closed

    def __call__(self, place: int) -> bool:
        k = bisect_left(self.at, place)
        return k < len(self.closed) and self.closed[k]


@dataclass
class _Page:
    """Open elements and blocks so far."""

    blocks: list[Block] = field(default_factory=list)
    stack: list[_Element] = field(default_factory=lambda: [_Element("html", False, False, 0)])
    parts: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    links: int = 0
    parents: list[int] = field(default_factory=lambda: [0])
    head: bool = False
    places: dict[str, list[int]] = field(default_factory=dict)      # where in the stack a tag's elements are

    def say(self, text: str) -> None:
        if self.head and not text.isspace():
            self.end_head()
        if "&" in text:
            text = entities.unescape(text)
        self.parts.append(text)
        if self.links:
            self.linked.append(text)

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            top = self.stack[-1]
            heading = any(e.tag in HEADINGS for e in self.stack[-3:])
            self.blocks.append(Block(text, len("".join("".join(self.linked).split())), top.container, top.aside, top.main,
                                     heading, marks=top.marks, around=top.around, parents=self.parents))
        self.parts, self.linked = [], []

    def open(self, tag: str, rest: str) -> None:
        if tag == "head":
            self.head = True
        elif self.head and tag not in HEAD_TAGS:
            self.end_head()
        top = self.stack[-1]
        if tag in BLOCK_TAGS:
            self.flush()
            self.end_first(("p",) + ENDS.get(tag, ()) if tag != "hr" else ("p",))
            top = self.stack[-1]
        elif tag in ENDS:
            self.end_first(ENDS[tag])
            top = self.stack[-1]
        if tag == "br":
            self.say(" ")
        if tag in VOID_TAGS or rest.endswith("/") and tag not in BLOCK_TAGS and tag != "a":
            return
        names = NAMES.findall(rest) if "=" in rest else []
        named_main = tag not in ASIDE_TAGS and tag != "header" and any(
            "main" in "".join(m[1:]).lower().split() for m in names)
        main = top.main or tag in MAIN_TAGS or named_main
        aside = top.aside or tag in ASIDE_TAGS or tag == "header" and not main or any(
            m[0].lower() == "role" and not ASIDE_WORDS.isdisjoint("".join(m[1:]).lower().split()) for m in names)
        marks, around = top.marks, top.around
        if tag == "main" or named_main:
            marks = around = frozenset()
        elif tag == "article":
            around = marks
        elif names and tag not in UNMARKED_TAGS:
            own = {c for m in names if m[0].lower() != "role" for c in "".join(m[1:]).lower().split()
                   if mark_of(c) or not main and c.split("-")[-1] == "header"}
            marks = marks | own if own else marks
        container = top.container
        if tag in SCOPES:
            self.parents.append(container)
            container = len(self.parents) - 1
        if tag == "a":
            self.links += 1
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append(_Element(tag, aside, main, container, marks, around))

    def end_first(self, tags: tuple[str, ...]) -> None:
        """Ends the open elements among ``tags`` up to the nearest container."""
        mine = [p for t in tags if (p := self.places.get(t))]
        if mine:
            nearest = max((p[-1] for t in SCOPES if t not in tags and (p := self.places.get(t))), default=0)
            inside = [p[bisect_right(p, nearest)] for p in mine if p[-1] > nearest]
            if inside:
                self.pop_to(min(inside))

    def end_head(self) -> None:
        """Ends an open head, whose end tag may be left out."""
        self.head = False
        self.close("head")

    def pop_to(self, i: int) -> None:
        for e in self.stack[i:]:
            self.places[e.tag].pop()
            self.links -= e.tag == "a"
        del self.stack[i:]

    def close(self, tag: str) -> None:
        if tag in BLOCK_TAGS:
            self.flush()
        if self.places.get(tag):
            self.pop_to(self.places[tag][-1])


def blocks_of(html: str) -> list[Block]:
    """The blocks of a page in order."""
    page, at, look, ends = _Page(), 0, 0, None
    while (look := html.find("<", look)) >= 0:
        # once a tag was found to have no end, no other of the kind is tried: each would read on to the page's end
        m = None if ends and TAG_START.match(html, look) and not RAW_START.match(html, look) and not ends(look + 1) \
            else TOKEN.match(html, look)
        if m is None:
            if ends is None and TAG_START.match(html, look):
                ends = _Ends(html)
            look += 1
            continue
        if look > at:
            page.say(html[at:look])
        at = look = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        if m["end"]:
            page.close(tag.lower())
        else:
            page.open(tag.lower(), m["rest"] or "")
    if at < len(html):
        page.say(html[at:])
    page.flush()
    return page.blocks


def stops_of(b: Block) -> tuple[int, int]:
    """Stop words and words of a block."""
    if b.counts is None:
        words = WORD.findall(b.text.lower())
        b.counts = sum(w in STOP_WORDS for w in words), len(words)
    return b.counts


def foreign(b: Block) -> bool:
    """Whether most letters are of a script that no language of the stop words has."""
    letters = sum(map(len, WORD.findall(b.text)))
    return 2 * len(LATIN.findall(b.text)) < letters


def known_language(blocks: list[Block]) -> bool:
    """Whether the page's language is one that the stop words cover."""
    long = [b for b in blocks if not b.aside and b.link_chars <= LINKS_MOST * len(b.text) and len(b.text) >= SHORT]
    counts = [stops_of(b) for b in [b for b in long if not b.marks] or long]
    return sum(c[0] for c in counts) >= STOP_KNOWN * sum(c[1] for c in counts)


def decide(b: Block, known: bool = True) -> str:
    """First pass: a block by itself; ``known`` tells whether the stop words cover the page's language."""
    n = len(b.text)
    if b.aside:
        return "other"
    if b.link_chars > LINKS_MOST * n:
        # a linked sentence of an article goes with what stands around it
        return "open" if b.main and SENTENCE_END.search(b.text) else "other"
    if not b.main and (b.text.startswith("©") or "all rights reserved" in b.text.lower()[:80]):
        return "other"
    width = n if b.text.isascii() else n + (DENSE_SCRIPT - 1) * len(NO_SPACES.findall(b.text))
    if b.heading or width < SHORT:
        return "open"
    stops, words = stops_of(b)
    dense = stops / max(1, words)
    if n >= SHORT and dense >= STOP_HIGH or dense >= STOP_LOW and n >= LONG:
        return "text"
    if not b.main and (not known or not b.text.isascii() and foreign(b)):
        # without stop words to go by, long blocks and whole sentences are text
        return "text" if width >= LONG or SENTENCE_END.search(b.text) else "open"
    if dense < STOP_LOW and not b.main and n >= LONG:
        return "other"
    return "open"


def lift(blocks: list[Block]) -> None:
    """Blocks under a mark become "other", unless the mark stands around the main text.

    Such a mark holds all accepted text but a small rest. With an article inside
    only articles count as the rest, unless the mark is a word as a whole.
    """
    live = sorted({m for b in blocks for m in b.marks})
    if not live:
        return
    weight = {}
    for m in live:
        whole, sizes = m in ASIDE_WORDS, [0, 0]
        for b in blocks:
            if m in b.marks and (b.label == "text" or b.label == "open" and b.main and m in b.around) and (
                    whole or b.marks.isdisjoint(ASIDE_WORDS)):
                sizes[m in b.around] += len(b.text)
        weight[m] = (not sizes[1], whole, -sum(sizes), m)
    kept = set(live)
    for m in sorted(live, key=weight.get):
        no_article, whole, size, _ = weight[m]
        rest = sum(len(b.text) for b in blocks if kept.isdisjoint(b.marks) and (
            b.label == "text" and (b.main or whole or no_article) or b.label == "open" and b.main))
        if rest < LIFT * -size:
            kept.discard(m)
    for b in blocks:
        if not kept.isdisjoint(b.marks):
            b.label = "other"


def articles_are_all(blocks: list[Block]) -> bool:
    """Whether the articles' accepted text is the page's main text.

    It is if they hold a share of MAIN_LEAST of it, and no other part of the page holds more than they do.
    """
    inside = sum(len(b.text) for b in blocks if b.main and b.label == "text")
    outside = [b for b in blocks if not b.main and b.label == "text"]
    if not inside or not outside:
        return inside > 0
    if inside < MAIN_LEAST * (inside + sum(len(b.text) for b in outside)):
        return False
    parents = blocks[0].parents
    sizes, holds = [0] * len(parents), [False] * len(parents)
    for b in outside:
        sizes[b.container] += len(b.text)
    for b in blocks:
        if b.main:
            holds[b.container] = True
    # children have larger numbers; what holds an article counts with its own blocks only
    for c in range(len(parents) - 1, 0, -1):
        holds[parents[c]] |= holds[c]
    for c in range(len(parents) - 1, 0, -1):
        if not holds[parents[c]]:
            sizes[parents[c]] += sizes[c]
    return max(sizes) <= inside


def settle(blocks: list[Block]) -> None:
    """Second pass: open blocks take the label of their nearest decided neighbour."""
    known = known_language(blocks)
    for b in blocks:
        b.label = decide(b, known)
    lift(blocks)
    if articles_are_all(blocks):
        for b in blocks:
            b.label = b.label if b.main else "other"
    if not any(b.label == "text" or b.label == "open" and b.main for b in blocks):
        # nothing is long enough to be told from its words: what no menu, mark or link speaks against is the text
        for b in blocks:
            if b.label == "open":
                b.label = "text"
    first = [b.label for b in blocks]

    def sides(within: list[int]) -> tuple[dict, dict]:
        before, after, last = {}, {}, None
        for i in within:
            before[i] = last
            last = i if first[i] != "open" else last
        last = None
        for i in reversed(within):
            after[i] = last
            last = i if first[i] != "open" else last
        return before, after

    places: dict[int, list[int]] = {}
    for i, b in enumerate(blocks):
        places.setdefault(b.container, []).append(i)
    page = sides(list(range(len(blocks))))
    own = {c: sides(within) for c, within in places.items()}
    for i, b in enumerate(blocks):
        if first[i] != "open":
            continue
        for before, after in (own[b.container], page):
            p, q = before[i], after[i]
            if before is page[0] and b.main:
                b.label = "text"            # an article of open blocks only
            elif p is None and q is None:
                continue
            elif b.heading and q is not None:
                b.label = first[q]
            elif p is None or q is None or first[p] == first[q]:
                b.label = first[q if p is None else p]
            elif i - p != q - i:
                b.label = first[p if i - p < q - i else q]
            else:
                b.label = "text" if b.main else "other"
            break


def main_text(html: str | None) -> str:
    """The page's main text, blocks joined by newlines."""
    blocks = blocks_of(html or "")
    settle(blocks)
    return "\n".join(b.text for b in blocks if b.label == "text")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.slice(start, 256)
                texts = [main_text(h.as_py()) for h in part.column("html")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


@register("op9_html")
def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
