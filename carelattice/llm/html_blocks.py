"""Main text of HTML pages by two-pass block rules.

The first pass cuts a page into blocks and decides those it can: blocks in
boilerplate containers and blocks made of links are out, long blocks rich in stop
words are in. The second pass gives every ambiguous block, most of them short, the
label of its nearest decided neighbours. A page is one row, so nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelattice.llm.common import by_record

# Element names and words.
_RAW = "script|style|title|textarea|noscript|template|iframe|xmp"
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section "
    "summary table tbody td tfoot th thead tr ul".split())
_BOILERPLATE = frozenset(
    "nav footer aside form menu dialog button select head svg math object audio video canvas".split())
_MAIN = frozenset(["article", "main"])
# Elements that end when the next one of them starts.
_ITEMS = frozenset("li dt dd td th tr".split())
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_HINT = re.compile(
    r"(?:^|[_-])(?:nav\w*|menu\w*|header|masthead|footer|foot|sidebar|side|aside|ad|ads|advert\w*|banner\w*|"
    r"promo\w*|sponsor\w*|cookie\w*|consent|gdpr|notice\w*|alert|popup|modal|overlay|newsletter|subscribe|"
    r"signup|login|social|shar(?:e|ing)\w*|related|recommend\w*|comment\w*|disqus|replies|breadcrumbs?|"
    r"pagination|pager|widget\w*|toolbar|skip)(?:$|[_-])", re.IGNORECASE)
# Words that make a name speak of a thing instead of being it: has-sidebar, no-comments, side-by-side.
_ABOUT = re.compile(r"(?:^|[_-])(?:has|have|with|without|no|not|by|is|on|off|enabled|disabled)(?:$|[_-])", re.IGNORECASE)
# The head of an article, not of a page.
_OWN_HEAD = re.compile(r"^(?:post|entry|article|story|content|section)[_-]+(?:header|masthead)$", re.IGNORECASE)
_HEAD = re.compile(r"(?:^|[_-])(?:header|masthead)(?:$|[_-])", re.IGNORECASE)
_ROLE = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu".split())
_STOP_WORDS = frozenset(
    # en
    "the of and to in is that it was for on are as with be at by this have from or an not but a he they you "
    # de
    "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an er sie "
    # fr
    "de la le et les des en un une du dans est que pour qui par sur au avec pas ne se il ce "
    # es
    "el los del las por con una su para lo como más al o y no".split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})\b(?:[^>\"']|\"[^\"<]*\"|'[^'<]*'|[\"'])*+(?:(?<=/)>|>.*?(?:</\1\s*>|\Z)|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-zA-Z][^>]*>|<[!?][^>]*>|<[a-zA-Z/!?][^>]*\Z",
    re.DOTALL | re.IGNORECASE)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_LETTERS = re.compile(r"[^\W\d_]+")
_WORD = re.compile(r"[^\W\d_]{2}")

# Rules of the first pass.
LONG = 60
LINKED = 0.5
STOP_SHARE = 0.12


@dataclass
class Block:
    text: str
    links: float
    boilerplate: bool
    inside: bool
    heading: bool
    # Numbers of the elements around it whose class or id hints at boilerplate, outermost first.
    hints: tuple[int, ...] = ()


@dataclass
class _Page:
    blocks: list[Block] = field(default_factory=list)
    parts: list[tuple[str, bool]] = field(default_factory=list)
    # Hints around each <article> or <main> that is in no other, in page order.
    around: list[tuple[int, ...]] = field(default_factory=list)


def _attributes(name: str, attributes: str) -> dict[str, str]:
    if not attributes or name in ("body", "html"):
        return {}
    return {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)}


def _hidden(found: dict[str, str]) -> bool:
    """Whether an element is not shown, or its role is none of an article."""
    return bool(
        "hidden" in found or found.get("aria-hidden", "").lower() == "true"
        or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""))
        or found.get("role", "").lower() in _ROLE)


def _hinted(found: dict[str, str], inside: bool) -> bool:
    """Whether a class or an id names something beside the article; ``inside`` it, a head is its own."""
    return any(
        _HINT.search(name) and not _ABOUT.search(name) and not _OWN_HEAD.match(name) and not (inside and _HEAD.search(name))
        for name in f"{found.get('class', '')} {found.get('id', '')}".split())


def _without_wrappers(page: _Page) -> None:
    """Settle which blocks are boilerplate: hints count unless they would take the article away.

    If all articles are in hinted elements, the hints around the first one with text do not count
    (comments and related articles follow), nor does the outermost hint around most of the prose of a page without an article or
    other prose.
    """
    blocks = page.blocks
    void: set[int] = set()
    shown = [b for b in blocks if not b.boilerplate]
    mains = [b for b in shown if b.inside]
    if mains:
        if all(b.hints for b in mains):
            held = {b.hints for b in mains}
            void = set(next((h for h in page.around if h in held), mains[0].hints))
    else:
        prose = [b for b in shown if _is_prose(b)]
        if prose and all(b.hints for b in prose):
            sizes: dict[int, int] = {}
            for b in prose:
                sizes[b.hints[0]] = sizes.get(b.hints[0], 0) + len(b.text)
            void = {max(sizes, key=lambda h: (sizes[h], -h))}
    for b in blocks:
        b.boilerplate = b.boilerplate or any(h not in void for h in b.hints)


def _linked(attributes: str) -> bool:
    """Whether an <a> is a link: one that only names a place is none."""
    names = {k.lower() for k, _ in _ATTRIBUTE.findall(attributes)} if attributes else set()
    return "href" in names or not names & {"name", "id"}


def blocks_of(html: str) -> list[Block]:
    """The blocks of a page in page order, without markup."""
    page = _Page()
    # Open elements that matter: (name, boilerplate, main, hint). Unclosed ones end with their parent.
    stack: list[tuple[str, bool, bool, int | None]] = []
    hints = 0
    anchor = heading = False
    # Blocks open around the link; it ends with the innermost of them.
    around = 0

    def close_block() -> None:
        nonlocal heading
        text = " ".join("".join(t for t, _ in page.parts).split())
        if text:
            linked = sum(len("".join(t.split())) for t, a in page.parts if a)
            size = max(1, len(text.replace(" ", "")))
            page.blocks.append(Block(text, min(1.0, linked / size), any(s[1] for s in stack),
                                     any(s[2] for s in stack), heading, tuple(s[3] for s in stack if s[3] is not None)))
        page.parts.clear()

    at = 0
    for token in _TOKEN.finditer(html):
        if token.start() > at:
            page.parts.append((unescape(html[at:token.start()]), anchor))
        at = token.end()
        name = (token[3] or "").lower()
        if not name:
            continue
        if name == "a":
            anchor = not token[2] and _linked(token[4])
            around = len(stack)
        if name == "br":
            page.parts.append((" ", False))
        block = name in _BLOCKS
        if block:
            close_block()
            heading = name[0] == "h" and name[1:].isdigit() and not token[2]
        if name in ("td", "th", "option"):
            page.parts.append((" ", False))
        if token[2]:
            if any(s[0] == name for s in stack):
                if not block:
                    close_block()
                while stack.pop()[0] != name:
                    pass
                anchor = anchor and len(stack) >= around
            continue
        if name in _VOID or token[4].endswith("/"):
            continue
        if block and stack and stack[-1][0] == "p":
            stack.pop()
            anchor = anchor and len(stack) >= around
        if name in _ITEMS and stack and stack[-1][0] in _ITEMS and len(stack) == around:
            anchor = False
        main = name in _MAIN
        inside = any(s[2] for s in stack)
        found = _attributes(name, token[4])
        out = name in _BOILERPLATE or (name == "header" and not inside) or _hidden(found)
        hint = None
        if not out and not main and _hinted(found, inside):
            hint = hints = hints + 1
        if main and not inside:
            page.around.append(tuple(s[3] for s in stack if s[3] is not None))
        if out or hint or main or block:
            if (out or hint) and not block:
                close_block()
            stack.append((name, out, main, hint))
    if at < len(html):
        page.parts.append((unescape(html[at:]), anchor))
    close_block()
    _without_wrappers(page)
    return page.blocks


def _is_prose(block: Block) -> bool:
    """Whether a block is long, rich in stop words and not made of links."""
    if block.links > LINKED or len(block.text) < LONG:
        return False
    words = _LETTERS.findall(block.text.lower())
    return bool(words) and sum(w in _STOP_WORDS for w in words) >= STOP_SHARE * len(words)


def _first_pass(block: Block, has_main: bool) -> bool | None:
    """True: article, False: not, None: undecided."""
    if block.boilerplate or block.links > LINKED or (has_main and not block.inside):
        return False
    return True if _is_prose(block) else None


def _seeded(blocks: list[Block], labels: list[bool | None]) -> list[bool | None]:
    """``labels``; if the first pass found no article, undecided blocks become one.

    Stop words say nothing then: the page has none in long blocks, or is in a language
    without a list. Long blocks are taken, or else all that hold a word of two letters.
    """
    if any(labels) or any(b.inside for b, label in zip(blocks, labels) if label is None):
        return labels
    wordy = [i for i, label in enumerate(labels) if label is None and _WORD.search(blocks[i].text)]
    seeds = {i for i in wordy if len(blocks[i].text) >= LONG} or set(wordy)
    return [True if i in seeds else label for i, label in enumerate(labels)]


def _second_pass(blocks: list[Block], labels: list[bool | None]) -> list[bool]:
    """Undecided blocks take the label of the nearest decided block of their part of the page.

    At equal distance one article block is enough; a heading goes with what follows. Inside the
    article element only a decided article block or a link block beside it decides;
    if there is none the block is part of the article.
    """
    settled = list(labels)
    for inside in (False, True):
        mine = [i for i, b in enumerate(blocks) if b.inside == inside and not b.boilerplate]
        before: dict[int, int] = {}
        last = None
        for i in mine:
            if labels[i] is not None:
                last = i
            elif last is not None:
                before[i] = last
        after: dict[int, int] = {}
        last = None
        for i in reversed(mine):
            if labels[i] is not None:
                last = i
            elif last is not None:
                after[i] = last
        for i in mine:
            if labels[i] is not None:
                continue
            near = [j for j in (after.get(i), before.get(i)) if j is not None]
            if inside and not any(labels[j] for j in near):
                settled[i] = True
            elif not near:
                settled[i] = inside
            elif blocks[i].heading:
                settled[i] = bool(labels[near[0]])
            else:
                least = min(abs(j - i) for j in near)
                settled[i] = any(labels[j] for j in near if abs(j - i) == least)
    return [bool(s) for s in settled]


def main_text(html: str | None) -> str:
    """The article of a page: its blocks joined by blank lines; empty if there is none."""
    blocks = blocks_of(html or "")
    has_main = any(b.inside and not b.boilerplate for b in blocks)
    labels = _seeded(blocks, [_first_pass(b, has_main) for b in blocks])
    kept = _second_pass(blocks, labels)
    return "\n\n".join(b.text for b, keep in zip(blocks, kept) if keep)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text) of every page; NULL and empty pages have an empty text.

    Repeated rows and NULL ids or addresses are kept as they are; other columns are
    ignored; the text is neither cut nor filtered further.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_record(batches):
            texts = [main_text(h.as_py()) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    chosen = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                          F.col(html_col).cast("string").alias("html"))
    kinds = [chosen.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return chosen.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string")
