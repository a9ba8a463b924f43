"""Operator 10: main text of web pages by a decision tree over flat text blocks.

A page is cut at block tags into flat blocks of text, each with its number of words, its link
density, and those of the blocks before and after it. A decision tree trained on the labelled blocks of
a few pages says which blocks are content. What the markup itself says comes in as features: scripts,
styles and other invisible or interactive parts hold no text blocks, nor does a form unless it holds half of
the page's words; blocks inside navigation,
header, footer, sidebar or complementary elements, or ones whose class or id names a notice, advert,
menu or comments, carry that as a feature, and where a page marks an article, blocks outside it
carry that. A class or id counts if it is such a word, alone or with words of place ("site-header", "ad-slot-2"); where
the last word of a name is an advert, notice or the like, or its first or last one is comments, whatever stands beside it
("leaderboard-ad", "fb-comments", but neither "has-sidebar", "tag-news" nor "related-work"). The headline of a page that marks
no article counts inside a bare header too. An article or main
element sheds the names of elements around it where most of the articles' words would go, and names count
for nothing where they would leave nothing of a page.

Defined results: null or empty HTML, and a page without content blocks, give an empty text; unclosed
blocks and forms end with the block around them, unclosed links with their block, unclosed buttons and the like hide nothing, end tags of nothing are nothing, unclosed
scripts and other raw text end with their page; a page without any tag is one block; repeated rows give repeated results;
extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.tokens import text_blocks

# Elements by what they do to the text inside or around them.
RAW = ("script", "style", "textarea", "title", "iframe")  # hold no tags; unclosed ones end with the page
SKIPPED = ("noscript", "template", "svg", "math", "object", "canvas", "select", "button", "audio", "video")  # only with their end tag
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
BOILERPLATE = frozenset("nav header footer aside menu dialog".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NAMES = frozenset("ad ads adsbygoogle advert adverts advertisement advertisements advertising alert alerts banner banners breadcrumb breadcrumbs consent cookie cookies disclaimer foot footer gdpr head header login masthead menu menus modal nav navbar navigation newsletter notice notices popup promo promos promoted promotion search share sharing sidebar signup skip social sponsor sponsored subscribe subscription tag tags toolbar widget widgets".split())
#: Names that an article element or its surroundings don't shed.
OTHERS = frozenset("comment comments commentlist discussion discussions disqus outbrain related replies reply respond responses taboola".split())
#: Words that may stand beside a name in a class or id without changing what it says.
PLACES = frozenset("area aside bar block bottom box cloud col column container content entry fixed form global group inner item items label left link links list lists main mobile nested outer overlay page panel post posts primary right row secondary section site slot sticky thread top unit wrap wrapper".split())
#: Names that say what a thing is when they come last, whatever it is called; those that do so when they come first too.
LAST = frozenset("ad ads advert adverts advertisement advertisements advertising alert alerts banner banners comment comments consent disclaimer discussion footer modal navbar newsletter notice notices popup promo promos promotion replies responses sidebar sponsor".split())
FIRST = frozenset("ad ads adsbygoogle advert adverts advertisement advertising comments commentlist disqus outbrain replies sponsored taboola".split())
#: Words that make a name tell of something else: of what an element has, or how it is filed.
TURNS = frozenset("allow category closed count data disabled enabled filed format has hide is no not open show status tag type with without".split())
#: What related things are, if they aren't the text's own.
RELATED = frozenset("articles content items links news pages posts products reading stories topics videos".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar".split())

_REST = r"(?:\"[^\"]*\"|'[^']*'|[^'\">])*(?<!/)>"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<({'|'.join(RAW)})\b{_REST}.*?(?:</\1\s*>|\Z)"
    rf"|<(?P<skipped>{'|'.join(SKIPPED)})\b{_REST}"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\"<>])*)(?:>|(?=<)|\Z)|<[!?][^>]*(?:>|\Z)",
    re.S | re.I,
)
_SKIPS = re.compile(rf"<(?P<end>/?)(?P<name>{'|'.join(SKIPPED)}|article|main|body)\b(?P<close>\s*>)?", re.I)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_UNSEEN = re.compile(r"(?i)(display\s*:\s*none|visibility\s*:\s*hidden)")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_ANCHOR = re.compile(r"<(/?)a\b", re.I)


@dataclass
class Block:
    text: str
    words: int
    link_density: float
    boilerplate: bool
    article: bool
    heading: bool
    named: bool = False  # by a class or id inside the innermost article or main, or anywhere if there is none
    around: bool = False  # by a class or id of such an element or around it
    form: int = 0  # number of the form that holds it, 0 if none does
    bare: bool = False  # boilerplate for a header element alone


def attributes(rest: str) -> dict[str, str]:
    """Attributes of a tag by lower-case name; the first of a name counts."""
    found: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(rest):
        found.setdefault(name.lower(), a or b or c)
    return found


@lru_cache(maxsize=4096)
def named(token: str) -> str:
    """The word of NAMES or OTHERS that a class or id is made of, or an empty string."""
    parts = [p.lower() for p in _PART.findall(token)]
    words = [p for p in parts if not p.isdigit() and len(p) > 1]
    told = [p for p in words if p in NAMES or p in OTHERS]
    if not told:
        return ""
    if any(p not in NAMES and p not in OTHERS and p not in PLACES for p in words):
        if any(p in TURNS for p in words):
            return ""
        if words[0] == "related" and set(words[1:]) <= RELATED | PLACES:
            return "related"
        return words[-1] if words[-1] in LAST else words[0] if words[0] in FIRST else ""
    if told[-1] in ("head", "header", "foot") and words[0] in ("post", "entry"):
        return ""  # of an article
    return next((p for p in told if p in OTHERS), told[-1])


def names_of(found: dict[str, str]) -> set[str]:
    """Names that the class and the id of an element say."""
    return {n for t in f"{found.get('class', '')} {found.get('id', '')}".split() if (n := named(t))}


def unseen(found: dict[str, str]) -> bool:
    return found.get("hidden", "false").lower() != "false" or found.get("aria-hidden", "").lower() == "true" or bool(_UNSEEN.search(found.get("style", "")))


@dataclass(frozen=True)
class State:
    """What an open element, with those around it, says of the text inside."""

    boilerplate: bool = False
    article: bool = False
    unseen: bool = False
    named: bool = False
    around: bool = False
    form: int = 0
    bare: bool = False

    def inside(self, name: str, found: dict[str, str], form: int) -> State:
        names = names_of(found) if found and name not in ("body", "html") else set()
        article, around = self.article, self.around
        if article and name in ("header", "div", "section"):
            names -= {"head", "header"}  # the article's own
        role = found.get("role", "").lower() in ROLES
        boilerplate = self.boilerplate or name in BOILERPLATE and not (article and name == "header") or role
        bare = (self.bare or name == "header" and not self.boilerplate) and name not in BOILERPLATE - {"header"} and not role and not names
        strong, weak = bool(names & OTHERS), bool(names - OTHERS)
        told = self.named or strong or weak
        if name in ("article", "main") and not boilerplate and not strong:
            article, told, around = True, False, around or self.named or weak
        elif strong:
            boilerplate = True
        return State(boilerplate, article, self.unseen or unseen(found), told, around, form or self.form, bare and boilerplate)


class Skips:
    """Where elements that hold no text end: at their end tag, if neither one of their kind nor an article begins or ends before."""

    def __init__(self, source: str):
        self.closes: dict[str, list[tuple[int, int]]] = {}
        self.bars: dict[str, list[int]] = {}
        for m in _SKIPS.finditer(source):
            name = m["name"].lower()
            if name in SKIPPED:
                if not m["end"]:
                    self.bars.setdefault(name, []).append(m.start())
                elif m["close"]:
                    self.closes.setdefault(name, []).append((m.start(), m.end()))
            elif m["end"] or name != "body":
                self.bars.setdefault("", []).append(m.start())

    def end(self, name: str, at: int) -> int:
        """Where the element whose tag ends at ``at`` ends, or ``at``."""
        closes = self.closes.get(name, [])
        k = bisect_left(closes, (at, 0))
        if k == len(closes):
            return at
        for bars in (self.bars.get(name, []), self.bars.get("", [])):
            j = bisect_left(bars, at)
            if j < len(bars) and bars[j] < closes[k][0]:
                return at
        return closes[k][1]


def blocks(source: str) -> list[Block]:
    """The flat text blocks of a page, in order, in time that grows with its length."""
    out: list[Block] = []
    stack: list[tuple[str, State]] = []
    opened: Counter[str] = Counter()  # open elements by name
    skips = Skips(source)
    parts: list[str] = []
    anchor = -1  # open elements when the open link began, -1 if none is open
    torn = False  # whether the open link isn't closed before the next
    linked = 0  # characters of links in the block
    heading = False
    state = none = State()
    forms = 0

    def flush() -> None:
        nonlocal heading, linked, anchor
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text and not state.unseen:
                density = min(1.0, linked / max(1, sum(map(len, parts))))
                out.append(Block(text, text.count(" ") + 1, density, state.boilerplate, state.article, heading, state.named, state.around, state.form, state.bare))
            if text and torn:
                anchor = -1
            parts.clear()
        linked, heading = 0, False

    at = 0
    while m := _TOKEN.search(source, at):
        if m.start() > at:
            piece = source[at : m.start()]
            parts.append(piece)
            if anchor >= 0:
                linked += len(piece)
        at = m.end()
        if m["skipped"]:
            at = skips.end(m["skipped"].lower(), at)
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if name in BLOCKS:
            flush()
            if m["end"]:
                while opened[name]:  # whatever is open inside ends with it
                    last = stack.pop()[0]
                    opened[last] -= 1
                    if last == name:
                        break
            elif name not in VOID and not m["rest"].rstrip().endswith("/"):
                if name in ("p", "li") and stack and stack[-1][0] == name:
                    stack.pop()  # closed by the next of its kind
                    opened[name] -= 1
                state = stack[-1][1] if stack else none
                forms += name == "form"
                found = attributes(m["rest"]) if m["rest"] else {}
                stack.append((name, state.inside(name, found, forms if name == "form" else 0)))
                opened[name] += 1
                heading = name[0] == "h" and name[1:].isdigit()
            if len(stack) < anchor:
                anchor = -1
            state = stack[-1][1] if stack else none
        elif name == "a":
            if m["end"]:
                anchor = -1
            elif "href" in m["rest"].lower():
                after = _ANCHOR.search(source, at)
                anchor, torn = len(stack), after is None or not after[1]
        elif name == "br":
            parts.append(" ")
    if at < len(source):
        parts.append(source[at:])
        if anchor >= 0:
            linked += len(source) - at
    flush()
    return _settled(out)


def _settled(found: list[Block]) -> list[Block]:
    """Blocks without those of forms that hold less than half of the page's words, names shed where they cost the articles."""
    if any(b.form for b in found):
        main = [b for b in found if b.article and not b.boilerplate] or [b for b in found if not b.boilerplate]
        words = Counter()
        for b in main:
            words[b.form] += b.words
        found = [b for b in found if not b.form or 2 * words[b.form] >= sum(words.values()) > 0]
    if not any(b.article for b in found) and (title := next((b for b in found if b.bare and b.heading), None)):
        title.boilerplate = False
    inside = [b for b in found if b.article and not b.boilerplate and not b.named]
    shed = sum(b.words for b in inside if b.around) > sum(b.words for b in inside if not b.around)
    for b in found:
        b.named = b.named or b.around and not shed
        b.article = b.article and (shed or not b.around)
    return found


def features(found: list[Block], names: bool = True) -> np.ndarray:
    """Per block: words and link density of it and its neighbours, boilerplate, place (1 outside, -1 inside a marked article, 0 none marked), heading."""
    marked = any(b.article for b in found)
    words = np.array([0, *(b.words for b in found), 0], float)
    links = np.array([0, *(b.link_density for b in found), 0], float)
    own = np.array([(b.boilerplate or names and b.named, (marked and not b.article) - b.article, b.heading) for b in found], float).reshape(-1, 3)
    return np.column_stack([words[1:-1], words[:-2], words[2:], links[1:-1], links[:-2], links[2:], own])


#: Words that the labelled pages are filled with.
_PROSE = "the council met on monday and agreed after a long debate about the costs to build a new bridge over the river next year because the old one can no longer carry the buses that many people of the town take to work every day while others said that money should rather go to schools and roads".split()
#: Labelled pages: {+n} is a content block of n words, {-n} one of n words that isn't; the blocks between are cut by the markup around them.
LABELLED = (
    # an article with menu, notice, advert, links and short paragraphs of its own, comments, footer
    "<nav><ul><li><a href=a>{-1}</a><li><a href=b>{-2}</a></ul></nav><div class=cookie-notice>{-30}</div><div class=ad>{-12}</div><article><h1>{+7}</h1><p>{+60}<p>{+1}<p><a href=c>{+5}</a><p>{+90}<div class=ad>{-20}</div><p><a href=c>{+2}</a><ul><li>{+3}<li><a href=d>{+9}</a></ul><p>{+18}<aside>{-25}</aside></article><section class=comments><p>{-45}</section><footer>{-8}</footer>",
    "<header><h1>{-3}</h1><a href=a>{-2}</a></header><div>{-15}</div><main><h1>{+1}</h1><p>{+2}<p>{+4}</main><div>{-70}</div><div><a href=b>{-3}</a></div>",
    "<div>{-40}</div><div>{-2}</div><article><h2>{+6}</h2><h2><a href=a>{+1}</a></h2><p>{+35}</article><div>{-90}</div><p>{-3}",
    # whatever stands in an article is its text, whatever stands outside isn't
    "<article><p>{+1}<p>{+1}<p>{+4}<p>{+1}<p>{+9}<p>{+4}<p>{+4}<p>{+30}<p>{+1}<p>{+80}<p>{+2}<p>{+2}<p>{+9}<p>{+9}<p>{+3}<p>{+120}<p>{+4}</article><div>{-3}</div><div>{-40}</div><div>{-80}</div><div>{-1}</div>",
    "<div>{-60}</div><div>{-20}</div><div>{-5}</div><article><p><a href=a>{+1}</a><p>{+3}<p><a href=a>{+4}</a><p>{+40}<p><a href=a>{+2}</a><p><a href=a>{+12}</a><p>{+1}<p>{+6}<p><a href=a>{+6}</a></article><div>{-25}</div><div>{-9}</div>",
    "<div>{-7}</div><div>{-110}</div><main><h1><a href=a>{+3}</a></h1><p>{+2}<nav><a href=a>{-3}</a></nav><div class=share><a href=a>{-2}</a></div><h2>{+1}</h2><p>{+5}<aside><p><a href=a>{-9}</a></aside><h2>{+4}</h2><p>{+3}<p>{+14}<p>{+3}</main><div>{-30}</div><div>{-2}</div><div>{-16}</div>",
    # no article is marked: menus of links, short lines of headers and footers, paragraphs, short lines between them
    "<div><a href=a>{-1}</a></div><div><a href=b>{-1}</a></div><div><a href=c>{-2}</a></div><h1>{+8}</h1><p>{+55}<p>{+2}<p>{+70}<p>{+12}<p>{+48}<div><a href=d>{-1}</a></div><div><a href=e>{-3}</a></div><div>{-4}</div>",
    "<table><tr><td><a href=a>{-2}</a><td><a href=b>{-1}</a><td><h2>{+5}</h2><p>{+120}<p>{+30}<ul><li>{+6}<li>{+4}<li>{+9}</ul><p>{+64}</table><div>{-3}</div><div>{-2}</div><div>{-4}</div>",
    "<div><a href=a>{-4}</a></div><div>{-12}</div><div><a href=b>{-5}</a></div><div>{-14}</div><div><a href=c>{-3}</a></div><div>{-10}</div><div><a href=d>{-6}</a></div>",
    "<p>{+25}<p>{+18}<p>{+9}<p>{+22}<p>{+7}<p>{+30}",
    "<h1>{+4}</h1><p>{+40} <a href=a>{+12}</a><p><a href=b>{+10}</a> {+20}<p>{+33}<div><a href=c>{-12}</a></div><div><a href=d>{-9}</a></div>",
    "<div class=header>{-6}</div><div class=nav><a href=a>{-2}</a></div><div><p>{+80}<p>{+45}</div><div class=sidebar><p>{-35}<p>{-6}</div><div class=footer>{-20}</div>",
    "<p>{+90}<p>{+3}<p>{+80}<h2>{+2}</h2><p>{+110}<p>{+4}<p>{+40}<div>{-3}</div><div>{-4}</div><div>{-2}</div>",
    "<div><a href=a>{-2}</a></div><div><a href=b>{-1}</a></div><p>{+60}",
    "<div><a href=a>{-2}</a></div><p>{+35}<div><a href=b>{-1}</a></div>",
    "<p>{+8}", "<p>{+1}", "<h1>{+3}</h1>", "<h1>{+5}</h1><p>{+14}", "<h1>{+2}</h1><p>{+6}<p>{+5}<p>{+8}",
    "<p>{+50}<p>{+3}", "<p>{+21}<p>{+5}<p>{+2}<p>{+16}", "<h2>{+3}</h2><p>{+6}<h2>{+2}</h2><p>{+28}", "<h1>{+1}</h1><p>{+31}<p>{+2}<p>{+4}",
)


def labelled() -> np.ndarray:
    """Features of the blocks of the labelled pages, and in the last column whether each is content."""
    rows = []
    for page in LABELLED:
        filled = re.sub(r"\{([+-])(\d+)\}", lambda m: m[1] + " ".join((_PROSE * 3)[: int(m[2])]), page)
        found = blocks(filled)
        rows.append(np.column_stack([features(found), [b.text[0] == "+" for b in found]]))
    return np.vstack(rows)


def train(rows: np.ndarray, depth: int = 8, least: int = 1) -> tuple:
    """A tree as nested (feature, threshold, low side, high side), leaves as the share of content."""
    y = rows[:, -1]
    if depth == 0 or len(rows) < 2 * least or y.min() == y.max():
        return (float(y.mean()),)
    best = None
    for f in range(rows.shape[1] - 1):
        values = np.unique(rows[:, f])
        for t in (values[:-1] + values[1:]) / 2:
            low = rows[:, f] <= t
            if least <= low.sum() <= len(rows) - least:
                impurity = sum(len(s) * s.mean() * (1 - s.mean()) for s in (y[low], y[~low]))
                if best is None or impurity < best[0] - 1e-12:
                    best = (impurity, f, float(t), low)
    if best is None:
        return (float(y.mean()),)
    _, f, t, low = best
    return (f, t, train(rows[low], depth - 1, least), train(rows[~low], depth - 1, least))


def content(tree: tuple, x: np.ndarray) -> np.ndarray:
    """Share of content by the tree, for rows of features."""
    if len(tree) == 1:
        return np.full(len(x), tree[0])
    low = x[:, tree[0]] <= tree[1]
    out = np.empty(len(x))
    out[low], out[~low] = content(tree[2], x[low]), content(tree[3], x[~low])
    return out


def main_text(source: str, tree: tuple) -> str:
    """The content blocks of a page, joined by blanks."""
    found = blocks(source)
    if not found:
        return ""
    kept = content(tree, features(found)) >= 0.5
    if not kept.any() and any(b.named for b in found):  # names told of all
        kept = content(tree, features(found, names=False)) >= 0.5
    return " ".join(b.text for b, k in zip(found, kept, strict=True) if k)


def extract(pages: DataFrame, tree: tuple | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    tree = tree or train(labelled())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x for b in batches for x in text_blocks(b, "html")):
            texts = [main_text(x or "", tree) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    columns = [F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")]
    return pages.select(*columns).mapInArrow(rows, "page_id long, url string, text string, n_chars long")
