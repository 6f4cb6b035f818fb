"""Main text of web pages by two-pass block rules.

A page becomes blocks of text.  The first pass decides on the clear ones by where they
stand, the share of text in links, length and, where the page is in a language of the list,
the density of stop words; the second lets what is left inherit from the nearest decided
neighbours.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Lengths in characters, densities as shares; above LINKS a block is made of links.
SHORT, LONG = 60, 200
LINKS = 0.33
DENSE, SPARSE = 0.25, 0.12

# Frequent function words of the languages that pages come in.
STOP_WORDS = frozenset(
    """
    the of and to in is that for it was on are as with be by at this have from or an not but
    der die das und den von zu mit ist nicht ein eine dem des im für auf als auch sich an aus
    de la le les et des en un une du que est pour qui dans par sur pas avec au il plus ce
    el los del las por con no para su se una al lo como más o pero sus y a e
    """.split()
)

# What HTML elements are.
RAW = frozenset("script style title textarea iframe".split())  # hold no markup
DROPPED = frozenset("noscript template svg math object select button".split())
APART = frozenset("nav aside form menu dialog footer fieldset".split())
NESTING = APART | frozenset(
    """
    header article main section div ul ol dl table tbody thead tfoot tr blockquote figure
    details body html address td th li dd dt
    """.split()
)
BLOCKS = NESTING | frozenset(
    """
    p h1 h2 h3 h4 h5 h6 pre hr br caption figcaption summary head legend option center
    """.split()
)
ARTICLES = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# What a class, id or role is made of that names what is not the article: these words, ...
MARKS = frozenset(
    """
    ad ads adv advert adverts advertisement advertising adbox adslot banner sponsor sponsored
    promo promotion nav navbar navigation menu sidebar aside widget comment comments disqus
    reply replies respond share sharing social related recommended breadcrumb breadcrumbs
    cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe
    signup login search pagination pager copyright toolbar masthead complementary contentinfo
    footer skip
    """.split()
)
PAGE_HEADER = frozenset(("header", "topbar"))
# ... and words that say where or of what form it is.  Any other word, as in no-comments or
# has-sidebar, names something else.
PLACES = frozenset(
    """
    site main top bottom left right primary secondary global mobile desktop area wrapper wrap
    container box bar slot block list item items links link posts articles buttons icons form
    section text inner outer nav
    """.split()
)
# Sections of comments; their articles are comments too.
COMMENTS = frozenset("comment comments disqus reply replies respond".split())
# Elements that hold whole pages on some sites: they are apart unless most text is in them.
WRAPPERS = frozenset("form fieldset header".split())

COMMENT_END = re.compile(r"--!?>")
NAME = r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)"
# A quote opens a value only right after its equals sign.
VALUE = r"=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*)?"
TAG = re.compile(rf"{NAME}((?:[^>=]|{VALUE})*+)>", re.S)
# The same where a value is left open to the end of the page: quotes mean nothing.
LOOSE_TAG = re.compile(rf"{NAME}([^>]*)>", re.S)
RAW_TAGS = {name: re.compile(rf"<(/?){name}(?=[\s/>])[^>]*>", re.I) for name in RAW}
RAW_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in RAW}
# A slash at the end of a tag belongs to a value without quotes, if there is one.
BARE_VALUE = re.compile(r"=\s*[^\s\"'=>]+\Z")
ATTRIBUTE = re.compile(
    r"([^\s=/]+)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.S
)
WORD = re.compile(r"\w+")
# Chinese, Japanese and Korean characters.
WIDE = re.compile(r"[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af\uf900-\ufaff\U00020000-\U0003ffff]")
PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass(eq=False)
class Place:
    """An open element that others nest in."""

    name: str
    around: Place | None
    in_article: bool
    why: str = ""  # it is apart: "hidden", "comments", "marked", "tag" or not at all
    chars: int = 0  # of text in it that can be main text
    free: int = 0  # the same, without what is apart
    holds_article: bool = False


@dataclass
class Block:
    text: str
    heading: bool
    in_article: bool
    apart: bool
    link_chars: int
    inside: Place | None = None
    density: float = 0.0  # share of stop words
    label: bool | None = None  # is it main text?


class Tag(NamedTuple):
    start: int
    end: int
    closing: bool
    name: str  # empty for a comment
    attributes: str
    alone: bool  # closed in itself


def _tags(page: str) -> list[Tag]:
    """The page's tags and comments in order; an element of raw text is one with its content."""
    found: list[Tag] = []
    unended: set[str] = set()
    last = page.rfind(">")
    tag_at = TAG.match
    at = 0
    while 0 <= (start := page.find("<", at)) < last:
        end, match = _comment_end(page, start, last), None
        if end is None:
            match = tag_at(page, start)
            if match is None and tag_at == TAG.match and LOOSE_TAG.match(page, start):
                # A value swallows the rest of the page: that is looked for once.
                tag_at = LOOSE_TAG.match
                match = tag_at(page, start)
            if match is None:
                at = start + 1
                continue
            end = match.end()
        closing, name, attributes = False, "", ""
        if match:
            closing, name, attributes = match[1] == "/", match[2].lower(), match[3]
        alone = attributes.endswith("/") and not BARE_VALUE.search(attributes)
        at = end
        if name in RAW and not closing:
            at = _raw_end(page, at, name, alone, unended)
        found.append(Tag(start, at, closing, name, attributes, alone))
    if page.startswith("<!--", start) and start >= 0:
        found.append(Tag(start, len(page), False, "", "", False))
    return found


def _comment_end(page: str, start: int, last: int) -> int | None:
    """Where what begins with ``<!`` or ``<?`` ends; None for anything else."""
    if page[start + 1 : start + 2] not in ("!", "?"):
        return None
    if not page.startswith("<!--", start):
        return page.find(">", start) + 1
    for empty in ("<!-->", "<!--->"):
        if page.startswith(empty, start):
            return start + len(empty)
    found = COMMENT_END.search(page, start + 4)
    return found.end() if found else len(page)


def _raw_end(page: str, at: int, name: str, alone: bool, unended: set[str]) -> int:
    """Where the raw element ends whose tag ends at ``at``."""
    if alone:  # its content is its own only if its end is what comes next of its name
        other = RAW_TAGS[name].search(page, at)
        return other.end() if other and other[1] else at
    end = None if name in unended else RAW_ENDS[name].search(page, at)
    if end:
        return end.end()
    if name in ("script", "style"):
        return len(page)
    unended.add(name)  # none follows the next one either
    following = page.find("<", at)
    return len(page) if following < 0 else following


def _dropped(tags: list[Tag]) -> dict[int, tuple[int, int]]:
    """For each tag that opens a dropped element: the tag to go on with and where text resumes.

    An element ends at its own end tag.  One that has none before an element around it ends
    is left open by mistake, and holds what stands before the next block.
    """
    ends: dict[int, tuple[int, int]] = {}
    open_: list[tuple[str, int]] = []
    depths: Counter[str] = Counter()
    for i, tag in enumerate(tags):
        if tag.name not in DROPPED and tag.name not in BLOCKS or tag.name in ("br", "hr"):
            continue
        if not tag.closing:
            if not tag.alone:
                open_.append((tag.name, i))
                depths[tag.name] += 1
        elif depths[tag.name]:
            while True:
                name, opened = open_.pop()
                depths[name] -= 1
                if name == tag.name:
                    break
            if name in DROPPED:
                ends[opened] = i + 1, tag.end
    following = len(tags)
    for i in range(len(tags) - 1, -1, -1):
        tag = tags[i]
        if tag.name in DROPPED and not tag.closing:
            if tag.alone:
                ends[i] = i + 1, tag.end
            elif i not in ends:
                at = tags[following].start if following < len(tags) else tags[-1].end
                ends[i] = following, at
        elif tag.name in BLOCKS and tag.name not in ("option", "hr"):
            following = i
    return ends


# How far a link goes: one that is closed goes over blocks, one left open ends with its block.
NO_LINK, TO_BLOCK, TO_END = 0, 1, 2


def _closed_links(tags: list[Tag]) -> set[int]:
    """Links that an end tag follows before another link begins."""
    closed, ends_next = set(), False
    for i in range(len(tags) - 1, -1, -1):
        if tags[i].name == "a":
            if not tags[i].closing and ends_next:
                closed.add(i)
            ends_next = tags[i].closing
    return closed


def blocks(page: str) -> list[Block]:
    """The page's blocks with text, in order; what is never shown is not among them."""
    tags = _tags(page)
    dropped = _dropped(tags)
    found: list[Block] = []
    open_: list[Place] = []
    places: list[Place] = []
    heading, link_chars = False, 0
    link, closed_links = NO_LINK, _closed_links(tags)
    names: Counter[str] = Counter()  # of open places
    parts: list[str] = []

    def add(text: str) -> None:
        nonlocal link_chars
        parts.append(text)
        if link:
            link_chars += len(text)

    def close_block() -> None:
        nonlocal parts, link_chars
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            inside = open_[-1] if open_ else None
            in_article = inside is not None and inside.in_article
            block = Block(text, heading, in_article, False, link_chars, inside)
            if _tells(block):
                words = WORD.findall(text.lower())
                block.density = sum(w in STOP_WORDS for w in words) / max(len(words), 1)
            found.append(block)
        parts, link_chars = [], 0

    at = i = 0
    while i < len(tags):
        tag, number = tags[i], i
        if tag.start > at:
            add(page[at : tag.start])
        i, at = dropped.get(i, (i + 1, tag.end))
        closing, name = tag.closing, tag.name
        if name in DROPPED or name in RAW:
            if not closing:
                close_block()
                link = NO_LINK if link == TO_BLOCK else link
            continue
        if name == "a":
            link = NO_LINK if closing else TO_END if number in closed_links else TO_BLOCK
        if name not in BLOCKS:
            continue
        close_block()
        link = NO_LINK if link == TO_BLOCK else link
        if name in HEADINGS:
            heading = not closing
        elif name != "br":
            heading = False
        if name not in NESTING:
            continue
        if closing:
            while names[name]:  # what is open within it ends too
                names[open_[-1].name] -= 1
                if open_.pop().name == name:
                    break
        elif not tag.alone:
            if name == "li" and open_ and open_[-1].name == "li":
                open_.pop()
                names["li"] -= 1
            around = open_[-1] if open_ else None
            in_article = name in ARTICLES or around is not None and around.in_article
            place = Place(name, around, in_article, _why_apart(name, tag.attributes, in_article))
            open_.append(place)
            names[name] += 1
            places.append(place)
    add(page[at:])
    close_block()
    _set_apart(found, places)
    return found


def _why_apart(name: str, attributes: str, in_article: bool) -> str:
    """Why an element is apart by itself; empty if it is not."""
    why = ""
    if name in APART or name == "header" and not in_article:
        why = "marked" if name in WRAPPERS else "tag"
    if not attributes.strip() or name in ("html", "body"):
        return why
    for found in ATTRIBUTE.finditer(attributes):
        key = found[1].lower()
        value = found[2] or found[3] or found[4] or ""
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return "hidden"
        if key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return "hidden"
        if key in ("class", "id", "role") and name != "main" and why != "comments":
            for whole in value.split():
                words = {w.lower() for w in PIECES.findall(whole)}
                marks = MARKS if in_article else MARKS | PAGE_HEADER
                if words & marks and words <= marks | PLACES:
                    why = "comments" if words & COMMENTS else why or "marked"
    return why


def _set_apart(found: list[Block], places: list[Place]) -> None:
    """Set ``apart`` of the blocks: they are in an element that is apart and stays so.

    A form or marked element stays apart unless most of the page's text is in it, links
    aside, and not just more than in an article beside it.  An article or main is apart only where it is a comment, hidden, or one of the
    small ones beside an article that stands free.
    """
    # Outer places come before inner ones.
    lost: dict[Place, bool] = {}  # hidden or in a comment section
    shut: dict[Place, bool] = {}  # inside something apart
    for place in places:
        around = place.around
        lost[place] = place.why in ("hidden", "comments") or around is not None and lost[around]
        shut[place] = bool(place.why) or around is not None and shut[around]
    total, listed = 0, _listed(found)
    for block in found:
        inside = block.inside
        if inside is not None and lost[inside] or _clear(block, listed) is False:
            continue
        total += len(block.text)
        if inside is not None:
            inside.chars += len(block.text)
            if not shut[inside]:
                inside.free += len(block.text)
    for place in reversed(places):
        around = place.around
        if around is not None:
            around.chars += place.chars
            around.free += place.free
            if place.holds_article or place.name in ARTICLES and not lost[place]:
                around.holds_article = True
    beside = any(p.name in ARTICLES and p.free for p in places)

    apart: dict[Place, bool] = {}
    for place in places:
        why = place.why
        most = 2 * place.chars > total
        if why == "marked" and place.name == "form" and place.holds_article:
            why = ""
        elif why == "marked" and most and (place.in_article or place.holds_article or not beside):
            why = ""
        elif why == "tag" and most and place.holds_article:
            why = ""
        inherited = place.around is not None and apart[place.around]
        if place.name in ARTICLES and not lost[place] and not why and not beside:
            inherited = False
        apart[place] = bool(why) or inherited
    for block in found:
        block.apart = block.inside is not None and apart[block.inside]


def classify(found: list[Block]) -> None:
    """Label the blocks of a page in place, in two passes."""
    listed = _listed(found)
    for block in found:
        block.label = _clear(block, listed)
    # With an article on the page that has text, what stands beside it is not part of it and
    # says nothing about it.
    article = any(b.in_article and b.label is not False for b in found)
    if article:
        for block in found:
            if not block.in_article:
                block.label = False
    # Structure says nothing about what is near it: only the rest are neighbours.
    near = [b for b in found if not b.apart and (b.in_article or not article)]
    decided = [(i, b.label) for i, b in enumerate(near) if b.label is not None]
    place = 0
    for i, block in enumerate(near):
        while place < len(decided) and decided[place][0] < i:
            place += 1
        if block.label is not None:
            continue
        before = decided[place - 1] if place else None
        after = decided[place] if place < len(decided) else None
        block.label = _inherit(block, i, before, after)


def _size(text: str) -> int:
    """Length in characters, those of scripts that write a word in one or two as three."""
    return len(text) if text.isascii() else len(text) + 2 * len(WIDE.findall(text))


def _tells(block: Block) -> bool:
    """Is it text enough, and not of links, for its words to say something?"""
    few_links = block.link_chars <= LINKS * len(block.text)
    return few_links and not block.heading and _size(block.text) >= SHORT


def _listed(found: list[Block]) -> bool:
    """Is the page as a whole in a language of the list?  Most of what tells has stop words."""
    telling = [b for b in found if not b.apart and _tells(b)]
    with_words = sum(_size(b.text) for b in telling if b.density >= SPARSE)
    return 2 * with_words >= sum(_size(b.text) for b in telling)


def _clear(block: Block, listed: bool) -> bool | None:
    """First pass: True, False, or None where the block alone does not tell."""
    if block.apart:
        return False
    if block.link_chars > LINKS * len(block.text):
        return None if block.in_article else False
    if not _tells(block):
        return None
    if not listed or block.density >= DENSE:
        return True
    if block.density >= SPARSE and len(block.text) >= LONG:
        return True
    if block.density < SPARSE and not block.in_article and len(block.text) < LONG:
        return False
    return None


def _inherit(block, at, before, after) -> bool:
    """Second pass: the nearest decided neighbour's label; headings look at what follows."""
    if before is None and after is None:
        return True
    if block.heading and after is not None:
        return after[1]
    if before is None or after is None:
        return (before or after)[1]
    ahead, behind = after[0] - at, at - before[0]
    if ahead == behind:
        return before[1] or after[1]
    return before[1] if behind < ahead else after[1]


def main_text(page: str | None) -> str:
    """The page's main text, blocks joined by one space; empty for a null or empty page."""
    found = blocks(page or "")
    classify(found)
    return " ".join(block.text for block in found if block.label)


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``page_id, url, html``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(
        run, "page_id bigint, url string, text string, n_chars bigint"
    )


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query over all pages."""
    return extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))
