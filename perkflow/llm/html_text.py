"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. First pass, block by block: boilerplate elements
(navigation, headers and footers of the page, asides, forms, adverts, notices, reader comments) are
bad; blocks made of links are bad; blocks with many stop words and enough text are good; all others,
mostly short, are ambiguous. Second pass: an ambiguous block takes the label of the nearest decided
block in its own container (article, main or division), else of the nearest on the page; of two equally
near it prefers the good one. Ambiguous blocks of an article without any decided block are its text.

An element is boilerplate by its class or id if a whole name of them is a cue word, alone or with words
that only say where or what kind (`site-footer`, not `has-sidebar`). Names are weaker than elements and
roles: they do not reach into the outermost article or main, and an element with good blocks that
holds more than half of the page's text is not dropped by its names unless an article or main has text.

What is dropped never decides for others. Inside an article or main, paragraphs, headings and captions that
are mostly link are ambiguous, not bad. A form is dropped like an element with a cue in its names, so a form
around the whole page keeps its text.

Defined results: null and empty pages and pages without text give an empty string; unclosed tags,
comments and scripts end with the page; a less-than that opens no tag is text. Only page_id, url and html
are read.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_LENGTH = 60  # characters of a block that can decide for itself
STOP_DENSITY = 0.15
LINK_DENSITY = 0.5

# Element names of HTML, cue words of class and id attributes, function words.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main "
    "menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
DROPPED = frozenset(
    "aside button canvas datalist dialog fieldset footer head iframe map menu nav noscript object "
    "option select svg template title audio video".split()
)
RAW = frozenset("script style textarea xmp noembed noframes iframe".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote figcaption caption dd summary".split())
CONTAINERS = frozenset("article main section div body aside td blockquote".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
CUES = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead comment comments commentlist "
    "reply replies disqus cookie cookies consent notice gdpr popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social related recommended recommendations widget toolbar "
    "pagination pager search skip".split()
)
# Words that a cue may stand with in one name.
NEUTRAL = frozenset(
    "site global main primary secondary tertiary top bottom left right header head foot box list bar item items "
    "area section block slot unit zone post posts link links button buttons btn icon icons fixed sticky mobile "
    "desktop text recent form google user the".split()
)
STOP_WORDS = frozenset(
    "the of and to in a is that it was for on are as with be at by this from or an have not but "
    "der die das und ist ein eine zu den von mit sich auf für im dem nicht des als auch es an "
    "le la les de des et est un une du en que qui dans pour au pas sur par plus avec il elle ne "
    "el los las y es que en una por con para del se no lo su al como más o".split()
)
# End of fixed values.

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    # Attribute values stand in quotes, or without, and then may hold quotes.
    r"|<(/?)([a-zA-Z][^\s/>]*)"
    r"((?>[^<>\"'=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|=\s*[^\s\"'<>][^\s<>]*|=|\"[^\"]*\"|'[^']*')*+)>",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*))")
_PARTS = re.compile(r"[a-z]+")
_WORD = re.compile(r"[^\W\d_]+")
_END = re.compile(r"<[a-zA-Z/!?][^>]*\Z")


@dataclass
class Block:
    text: str
    links: int  # characters inside links
    dropped: bool  # inside a boilerplate element
    named: int  # number of the outermost element that is boilerplate by its names, or 0
    container: int  # number of the innermost container
    article: bool  # inside an article or main element
    prose: bool  # right inside a paragraph, heading or caption


HARD, NAMED = 2, 1


def is_cue(name: str, in_article: bool) -> bool:
    """Of a whole class or id name: cue words with nothing but neutral words beside them."""
    words = set(_PARTS.findall(name))
    cues = words & CUES or (not in_article and words & {"header"})
    return bool(cues) and words <= CUES | NEUTRAL


def boilerplate(tag: str, attributes: str, in_article: bool) -> int:
    """HARD by an element's name, role or visibility, NAMED by its class or id, else 0."""
    if tag in DROPPED or (tag == "header" and not in_article):
        return HARD
    if tag == "form":
        return NAMED
    if not attributes or tag in ("html", "body", "article", "main"):
        return 0
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    if found.get("role", "").lower() in ROLES:
        return HARD
    if "display:none" in found.get("style", "").replace(" ", "").lower():
        return HARD
    names = f"{found.get('class', '')} {found.get('id', '')}".lower().split()
    return NAMED if any(is_cue(name, in_article) for name in names) else 0


def blocks(page: str) -> list[Block]:
    """Non-empty blocks in page order."""
    out: list[Block] = []
    # Open elements that matter: name, whether boilerplate, number of the one that is so by its names,
    # container number, inside an article.
    stack: list[tuple[str, bool, int, int, bool]] = []
    opened: Counter[str] = Counter()  # names on the stack
    pieces: list[str] = []
    linked, link, containers, marked, at, inner = 0, False, 0, 0, 0, ""

    def close() -> None:
        nonlocal linked
        text = " ".join("".join(pieces).split())
        if text:
            _, dropped, named, container, article = stack[-1] if stack else ("", False, 0, 0, False)
            out.append(Block(text, linked, dropped, named, container, article, inner in PROSE))
        pieces.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        text = entities.unescape(raw)
        pieces.append(text)
        if link:
            linked += len("".join(text.split()))

    while at < len(page):
        match = _TOKEN.search(page, at)
        stop = match.start() if match else len(page)
        if stop > at:
            rest = page[at:stop]
            add(rest if match else _END.sub("", rest))
        if not match:
            break
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            if match[0].startswith("<![CDATA["):
                add(entities.escape(match[0][9:].removesuffix("]]>")))
            continue
        if match[1]:
            if tag == "a":
                link = False
            if tag in BLOCKS:
                close()
                inner = ""
            if opened[tag]:
                if tag not in BLOCKS:
                    close()
                while True:
                    name = stack.pop()[0]
                    opened[name] -= 1
                    if name == tag:
                        break
            elif tag == "br":
                pieces.append(" ")
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[^>]*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in VOID:
            if tag == "hr":
                close()
            pieces.append(" ")
            continue
        if tag == "a":
            link = True
        if tag in BLOCKS:
            close()
            link, inner = False, tag
        _, dropped, named, container, article = stack[-1] if stack else ("", False, 0, 0, False)
        bad = boilerplate(tag, match[3], article)
        if bad or tag in CONTAINERS or tag == "header":
            if tag not in BLOCKS:
                close()
            if tag in CONTAINERS:
                containers += 1
                container = containers
            if tag in ("article", "main") and not article:
                article, named = True, 0
            if bad == NAMED and not named:
                marked += 1
                named = marked
            stack.append((tag, dropped or bad == HARD, named, container, article))
            opened[tag] += 1
    close()
    return out


def label(block: Block) -> bool | None:
    """First pass: good, bad or, without an answer, ambiguous."""
    if block.dropped:
        return False
    length = len(block.text)
    if block.links > LINK_DENSITY * length:
        return None if block.article and block.prose else False
    words = _WORD.findall(block.text.lower())
    stops = sum(word in STOP_WORDS for word in words)
    if length >= LEAST_LENGTH and stops >= STOP_DENSITY * max(1, len(words)):
        return True
    return None


def spare_main_part(found: list[Block]) -> None:
    """Settle which blocks are dropped by the names of an element around them."""
    # Text that is not bad for itself, per element, and what of it is good.
    size: dict[int, int] = {}
    good: set[int] = set()
    for block in found:
        own = label(block)
        if own is False:
            continue
        if block.article and not block.named:
            good = set()
            break
        size[block.named] = size.get(block.named, 0) + len(block.text)
        if own:
            good.add(block.named)
    spared = {named for named in good if 2 * size[named] > sum(size.values())}
    for block in found:
        block.dropped = block.dropped or (block.named > 0 and block.named not in spared)


def _nearest(at: int, decided: list[int], labels: list[bool | None]) -> bool:
    """Label of the closest decided block; of two equally close ones the good one counts."""
    k = bisect_left(decided, at)
    around = decided[max(0, k - 1) : k + 1]
    low = min(abs(i - at) for i in around)
    return any(labels[i] for i in around if abs(i - at) == low)


def main_text(page: str | None) -> str:
    """Second pass over all blocks, then the good ones joined by line feeds."""
    found = blocks(page or "")
    if any(block.named for block in found):
        spare_main_part(found)
    labels = [label(block) for block in found]
    everywhere = [i for i, own in enumerate(labels) if own is not None and not found[i].dropped]
    own_container: dict[int, list[int]] = {}
    for i in everywhere:
        own_container.setdefault(found[i].container, []).append(i)
    kept = []
    for i, block in enumerate(found):
        good = labels[i]
        if good is None:
            if near := own_container.get(block.container):
                good = _nearest(i, near, labels)
            else:
                good = block.article or not everywhere or _nearest(i, everywhere, labels)
        if good:
            kept.append(block.text)
    return "\n".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page, from its whole html."""

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(page.as_py()) for page in batch], pa.string())

    out = pages.select("page_id", "url", run(F.col("html")).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
