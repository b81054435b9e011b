"""Main text of web pages by two-pass block rules.

Markup cuts a page into blocks. The first pass judges each block alone: by the
share of its characters in links, the share of stop words among its words, and
its length. The second lets ambiguous blocks (short ones, and those with middling
stop words) take the label of the nearest decided neighbours before and behind:
a long one needs text on either side, a short one on both, and where no
neighbour is decided the region decides. Page furniture that names itself (menus, headers, footers,
sidebars, notices, adverts, forms, reader comments, scripts, styles) is left out
before. Where a page marks its article, only the article's blocks are judged, and
in it no block falls for want of stop words: the page has said what it is.

A name alone is weaker than an element: an article inside a wrapper that is only
named like furniture is judged by itself, and stands where it holds more text than
the rest of the page. Where nothing else is left, the rules judge the named blocks too.
Names that say what a page has or lacks (``has-sidebar``, ``no-comments``) count for nothing.

Edge cases: NULL, empty and text-less pages give the empty text; unclosed and
cut-off markup is read as far as it goes; character references are decoded, with
or without their semicolon; a page of any length is read whole; equal rows get
equal results; further columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Common function words of the supported languages.
STOP_WORDS = frozenset(
    """
    a about all an and are as at be been but by can could did do for from had has have he her his
    how i if in into is it its more no not of on one or our out she so some than that the their
    them then there these they this to up was we were what when which who will with would you your
    aber als am an auch auf aus bei bin bis das dass dem den der des die doch du ein eine einem
    einen einer er es für hat ich ihr im in ist ja mit nach nicht noch nur oder sich sie sind so
    über um und uns von vor war was wenn wie wir wird zu zum zur
    au aux avec ce ces cette comme dans de des du elle en est et eux il ils je la le les leur lui
    mais ne nous on ou où par pas plus pour qu que qui sa se ses si son sur tout un une vous à été
    al así como con cual cuando de del donde el ella en entre era es esta este fue ha hay la las lo
    los más me mi muy no o para pero por que se ser si sin sobre su sus también te un una y ya
    """.split()
)
# Names of elements.
RAW = "script|style|noscript|template|textarea|title|iframe|svg|math"
#: Those that are empty where their tag closes itself; the others read on as raw text.
SELF_CLOSED = "template|iframe|svg|math|object|audio|video|canvas"
#: What they hold is shown only where the element itself is not.
EMBEDDED = frozenset("audio canvas object video".split())
INLINE = frozenset(
    """
    a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby
    s samp small span strike strong sub sup time tt u var wbr
    """.split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
FURNITURE_TAGS = frozenset(
    """
    nav footer aside form button select option menu dialog label fieldset datalist legend optgroup
    output progress meter head frameset
    """.split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Parts of class, id and role names that page furniture carries.
JUNK_NAMES = frozenset(
    """
    ad ads adv advert adverts advertisement advertising adsense alert banner breadcrumb breadcrumbs
    byline comment comments complementary consent contentinfo cookie cookies disclaimer disqus
    footer form gdpr header login masthead menu menus modal nav navbar navigation newsletter notice
    notices notification overlay pager pagination popup popular promo promotion recommended related
    reply replies respond search share sharing sidebar sidebars signup skip social sponsor sponsored
    subscribe subscription tags teaser toolbar topbar widget widgets
    """.split()
)
#: Words that make a name describe a layout instead of the element.
LAYOUT_WORDS = frozenset("has have no not with without".split())
#: What may stand in a head; anything else ends one whose end tag is left out.
HEAD_TAGS = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
MAIN_TAGS = frozenset(["article", "main"])
# Names that say the same of a plain element, each word of them present.
MAIN_NAMES = tuple(
    frozenset(x.split())
    for x in (
        "articlebody",
        "article body",
        "article content",
        "article text",
        "entry content",
        "main",
        "post body",
        "post content",
        "story body",
    )
)
#: Names that are furniture around the article, but part of it inside.
TITLE_NAMES = frozenset(["byline", "header", "masthead", "tags"])


@dataclass(frozen=True)
class BlockRules:
    max_link_density: float = 0.33
    max_link_density_inside: float = 0.5  # of a marked article
    short_chars: int = 70
    long_chars: int = 100
    stop_low: float = 0.05
    stop_high: float = 0.20


_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    rf"|<(?P<empty>{SELF_CLOSED})(?=[\s/>])"
    r"(?:[^>\"'=/]++|=\s*(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++)|/(?!>)|[\"'=])*+/>"
    rf"|<(?P<raw>{RAW})(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?:/?[a-zA-Z]|[!?/])[^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_NAMING = ("class", "id", "role", "itemprop")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
_PARTS = re.compile(r"[^\W_]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _attributes(rest: str) -> dict[str, str]:
    """Values by attribute name; of a repeated one the first counts."""
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(rest):
        found.setdefault(name.lower(), value.strip("\"'"))
    return found


def _is_hidden(attributes: dict[str, str]) -> bool:
    return (
        "hidden" in attributes
        or attributes.get("aria-hidden", "").strip().lower() == "true"
        or bool(_NO_DISPLAY.search(attributes.get("style", "")))
    )


def _words(name: str) -> set[str]:
    return {p.lower() for p in _PARTS.findall(_CAMEL.sub(" ", name))}


def _names(attributes: dict[str, str]) -> set[str]:
    return set().union(*[_words(attributes.get(key, "")) for key in _NAMING])


def _junk_names(attributes: dict[str, str]) -> set[str]:
    parts: set[str] = set()
    for key in _NAMING:
        for name in attributes.get(key, "").split():
            words = _words(name)
            if not words & LAYOUT_WORDS:
                parts |= words
    return parts & JUNK_NAMES


@dataclass
class Block:
    text: str
    linked: int
    main: bool
    heading: bool
    named: bool  # like furniture, by a name alone
    held: bool  # of an article inside such a name


@dataclass
class _Open:
    name: str
    skips: bool
    named: bool
    main: bool
    outer: int  # names around an article that it sets aside


def blocks(page: str) -> list[Block]:
    """Text blocks of a page in order, without furniture elements and hidden ones."""
    found: list[Block] = []
    stack: list[_Open] = []
    pieces: list[str] = []
    linked: list[str] = []
    skips = mains = links = names = held = heads = 0
    heading = ""
    open_names: Counter[str] = Counter()
    last_ends: dict[str, int] = {}

    def ends_later(name: str, at: int) -> bool:
        """Whether an end tag of that name follows."""
        if name not in last_ends:
            found_at = [m.start() for m in re.finditer(rf"</{name}[\s>]", page, re.I)]
            last_ends[name] = max(found_at, default=-1)
        return last_ends[name] > at

    def close() -> None:
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                chars = len(" ".join("".join(linked).split()))
                found.append(Block(text, chars, mains > 0, bool(heading), names > 0, held > 0))
            pieces.clear()
            linked.clear()

    def pop(to: int) -> None:
        nonlocal skips, mains, names, held, heads
        while len(stack) > to:
            if stack[-1].named or stack[-1].outer:
                close()
            gone = stack.pop()
            open_names[gone.name] -= 1
            skips -= gone.skips
            mains -= gone.main
            names += gone.outer - gone.named
            held -= gone.outer > 0
            heads -= gone.name == "head"

    def end_head() -> None:
        pop(next(at for at, x in enumerate(stack) if x.name == "head"))

    for token in _TOKEN.finditer(page):
        kind = token.lastgroup
        if kind == "text":
            if heads and not token["text"].isspace():
                end_head()
            if not skips:
                text = html.unescape(token["text"])
                pieces.append(text)
                if links:
                    linked.append(text)
            continue
        if kind in ("raw", "empty"):
            if heads and token[kind].lower() not in HEAD_TAGS:
                end_head()
            pieces.append(" ") if not skips else None
            continue
        name = token["name"]
        if name is None:
            continue
        name = name.lower()
        if token["end"]:
            if name == "a":
                links = max(0, links - 1)
            if name not in INLINE:
                close()
                if name == heading:
                    heading = ""
            # searched only where it is found, and all above it goes
            if open_names[name]:
                at = len(stack) - 1
                while stack[at].name != name:
                    at -= 1
                pop(at)
            continue
        rest = token["rest"]
        if heads and name not in HEAD_TAGS:
            end_head()
        if name == "br":
            pieces.append(" ")
            continue
        if name in VOID:
            if name not in INLINE:
                close()
            continue
        if name not in INLINE:
            close()
            if stack and stack[-1].name == "p":
                pop(len(stack) - 1)
            links = 0
            heading = name if name in HEADINGS else ""
        attributes = _attributes(rest) if rest and not rest.isspace() else {}
        parts = _names(attributes) if attributes else set()
        hidden = bool(attributes) and _is_hidden(attributes)
        named = bool(parts & JUNK_NAMES) and bool(
            _junk_names(attributes) - (TITLE_NAMES if mains else set())
        )
        junk = named or hidden
        if name in ("html", "body"):
            junk = False
        elif name in FURNITURE_TAGS:
            junk = True
        elif name in EMBEDDED:
            hidden = junk = junk or ends_later(name, token.end())
        elif name == "header":
            junk = junk or not mains
        elif name in MAIN_TAGS:
            junk = bool(parts & {"comment", "comments", "reply"})
        plain = name in ("div", "section", "td") and any(m <= parts for m in MAIN_NAMES)
        main = not junk and (name in MAIN_TAGS or plain)
        if name == "a":
            links += 1
        if junk or main or name not in INLINE:
            hard = junk and (hidden or not named or name in FURNITURE_TAGS or name in INLINE)
            outer = names if main else 0
            stack.append(_Open(name, hard, junk and not hard, main, outer))
            open_names[name] += 1
            skips += hard
            mains += main
            names += (junk and not hard) - outer
            held += outer > 0
            heads += name == "head"
    close()
    return found


_EDGES = re.compile(r"^\W+|\W+$")


TEXT, FURNITURE, NEAR, SHORT = "text", "furniture", "near", "short"


_WIDE = re.compile("[\u2e80-\U0010ffff]")


def _size(text: str) -> int:
    """Length; a character of the scripts written without spaces says as much as
    three letters."""
    if text.isascii() or not _WIDE.search(text):
        return len(text)
    return len(text) + 2 * len(_WIDE.findall(text))


def _stops(text: str) -> tuple[int, int]:
    """Stop words and words of a text."""
    words = text.split()
    n = 0
    for w in words:
        if not (w[0].isalnum() and w[-1].isalnum()):
            w = _EDGES.sub("", w)
        n += w.lower() in STOP_WORDS
    return n, len(words)


def _labels(found: list[Block], rules: BlockRules) -> list[str]:
    """First pass: text, furniture, or one of the two ambiguous kinds.

    Where the longer blocks hardly have a stop word, in a language other than the
    known ones, length and links alone decide.
    """
    sizes = [_size(b.text) for b in found]
    stops = [
        None
        if size < rules.short_chars
        or b.linked > (rules.max_link_density_inside if b.main else rules.max_link_density) * len(b.text)
        else _stops(b.text)
        for b, size in zip(found, sizes)
    ]
    prose = [
        s
        for b, size, s in zip(found, sizes, stops)
        if s and size >= rules.long_chars and b.linked <= rules.max_link_density * len(b.text)
    ]
    known, words = map(sum, zip(*prose)) if prose else (0, 0)
    foreign = bool(words) and known < rules.stop_low * words
    return [_decided(b, size, s, rules, foreign) for b, size, s in zip(found, sizes, stops)]


def _decided(
    block: Block, size: int, stops: tuple[int, int] | None, rules: BlockRules, foreign: bool
) -> str:
    most = rules.max_link_density_inside if block.main else rules.max_link_density
    if block.linked > most * len(block.text):
        return FURNITURE
    if size < rules.short_chars or block.heading:
        return SHORT
    share = rules.stop_high if foreign else stops[0] / max(1, stops[1])
    if share >= rules.stop_high:
        return TEXT if size >= rules.long_chars or block.main else NEAR
    return NEAR if share >= rules.stop_low or block.main else FURNITURE


def _follow(labels: list[str], kind: str, inside: bool) -> list[str]:
    """Replace one ambiguous kind by what its nearest decided neighbours say. An
    edge of a marked article counts as text, any other says nothing."""
    decided = (TEXT, FURNITURE)
    edge = TEXT if inside else None
    behind, last = [], edge
    for label in reversed(labels):
        behind.append(last)
        last = label if label in decided else last
    behind.reverse()
    out, last = [], edge
    for label, after in zip(labels, behind):
        if label == kind:
            sides = {last, after} - {None}
            either = TEXT in sides and (inside or kind == NEAR)
            label = TEXT if sides <= {TEXT} or either else FURNITURE
        else:
            last = label if label in decided else last
        out.append(label)
    return out


def _settled(labels: list[str], inside: bool) -> list[bool]:
    """Second pass: near-text blocks first, then short ones."""
    for kind in (NEAR, SHORT):
        labels = _follow(labels, kind, inside)
    return [label == TEXT for label in labels]


def _judged(found: list[Block], inside: bool, rules: BlockRules) -> str:
    labels = _labels(found, rules)
    if not inside and not {TEXT, FURNITURE} & set(labels):
        # nothing to ask: short blocks are text if they are some together
        if sum(_size(b.text) for b in found) < rules.short_chars:
            return ""
    stay = _settled(labels, inside)
    if not inside:
        # a heading right above text belongs to it
        for i in range(len(found) - 2, -1, -1):
            stay[i] = stay[i] or (found[i].heading and stay[i + 1])
    return "\n".join(b.text for b, good in zip(found, stay) if good)


def main_text(page: str, rules: BlockRules = BlockRules()) -> str:
    found = blocks(page)
    open_ = [b for b in found if not b.named and not b.held]
    marked = [b for b in open_ if b.main]
    text = _judged(marked or open_, bool(marked), rules)
    if any(b.held for b in found):
        held = _judged([b for b in found if b.held and not b.named], True, rules)
        if len(held) > len(text):
            both = [b for b in found if not b.named and (b.held or b.main)]
            text = _judged(both, True, rules)
    if not text and any(b.named for b in found):
        marked = [b for b in found if b.main]
        text = _judged(marked or found, bool(marked), rules)
    return text


RESULT = "page_id long, url string, text string, n_chars long"


def page_texts(pages: DataFrame, rules: BlockRules = BlockRules()) -> DataFrame:
    """Per page its main text and the text's length in code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [main_text(p or "", rules) for p in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("page_id"),
                        part.column("url"),
                        pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()),
                    ],
                    names=["page_id", "url", "text", "n_chars"],
                )

    chosen = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html")
    return chosen.mapInArrow(run, RESULT)
