"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass classifies a block by its link density, its length and
its density of stop words: much linked text and long text without stop words is boilerplate (bad), long text with many
is content (good), what lies between is near to content, and short blocks stay open. Markup counts as evidence beside
these measures: inside menus, headers, footers, sidebars, notices, adverts, forms or comments a class is lowered, and
inside an article or main element what would be bad for its words alone is near to content.

The second pass gives each open block the label of its nearest decided neighbours in its own section of the page; where
they differ, near-content blocks are content and short ones take the nearer label. The ends of a section count as
neighbours: good ones of an article or main element, bad ones of anything else and of the page.

Defined results: null, empty and text-free pages have the empty text; broken and unclosed markup is read as far as it
goes; a page of ambiguous blocks alone is kept; blocks are kept whole, in page order, joined by one line feed. Rows are read one by one, so repeats and ties need
no rule.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    """the of and to in is that for it as was with be by on not he his but at are this have from or had an they which one
    you were all her she there would their we him been has when who will no more if out so up said what its about than
    into them can only other time new some could these two may first then do any like my now over such our man me even
    most made after also did many off before must well back through years where much your way down should because each
    der die das und ist von den mit zu sich des auf nicht ein eine als auch es an werden aus er hat dass sie nach wird
    bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde
    le la les de des et un une en du que qui dans est pour pas par sur au plus ne se ce avec sont il elle cette aux mais
    ou son sa ses nous vous comme leur être ont été même aussi fait deux entre tout sans
    el los las y del se por con para su al lo como más pero sus ya muy sin sobre entre cuando todo esta ser son dos
    también fue había era hasta desde está nos durante este si porque esto sí yo eso mi qué""".split()
)
_RAW = "script|style|noscript|template|textarea|svg|math|iframe|select|object|title"
_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<({_RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][\w:-]*)((?:[^<>\"']|\"[^\"<>]*\"|'[^'<>]*')*+)[^<>]*>", re.S | re.I)
_OPEN = re.compile(r"<[/!a-zA-Z][^<>]*\Z")
#: Tags inside a block.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE = frozenset("nav footer aside form header menu dialog button fieldset head".split())
CONTENT = frozenset(("article", "main"))
_NAMED = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscribe|signup|login|sidebar|side|widget|menu|nav\w*|breadcrumbs?|pager|pagination|toolbar|topbar|masthead|header|footer|foot|social|share|sharing|related|recommended|comments?|commentlist|disqus|reply|replies|respond|copyright|legal|skip|search)(?:$|[\s_-])", re.I)
_ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
_LETTERS = re.compile(r"[^\W\d_]+")

SHORT, LONG = 90, 140
FEW, MANY = 0.10, 0.20
#: Share of linked text that makes a block boilerplate; within content, a link may fill more of one.
LINKS, MOST_LINKS = 0.33, 0.6


class Block:
    """A block's text, how much of it is linked, the evidence of its markup (-1, 0, 1) and its section."""

    __slots__ = ("linked", "place", "section", "text")

    def __init__(self, text: str, linked: int, place: int, section: int):
        self.text, self.linked, self.place, self.section = text, linked, place, section


def _place(tag: str, attributes: str, outer: int) -> int:
    """-1 inside boilerplate, 1 inside content, 0 elsewhere; boilerplate stays so within."""
    if outer < 0:
        return outer
    if tag in CONTENT:
        outer = 1
    named = False
    if attributes and not attributes.isspace():
        for m in _ATTR.finditer(attributes):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name in ("class", "id"):
                named |= tag not in ("html", "body", "article", "main") and bool(_NAMED.search(value))
            elif name == "role":
                named |= value.lower() in _ROLES
            else:
                named |= name == "hidden" or value.lower() == "true"
    if named or tag in BOILERPLATE and not (tag == "header" and outer > 0):
        return -1
    return outer


def blocks_of(page: str) -> list[Block]:
    """The blocks that hold any text, in page order."""
    out: list[Block] = []
    parts: list[str] = []
    linked = links = place = section = sections = breaks = 0
    stack: list[tuple[str, int, int]] = []

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, linked, place, section))
            parts.clear()
        linked = 0

    def enter(tag: str, inner: int) -> None:
        nonlocal place, section, sections
        stack.append((tag, place, section))
        if inner != place or tag in CONTENT:
            sections += 1
            section = sections
        place = inner

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            piece = page[at : m.start()]
            parts.append(piece)
            if not piece.isspace():
                breaks = 0
                if links:
                    linked += len(" ".join(piece.split()))
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:  # a comment, a declaration or an element without text
            if m[1]:
                flush()
            continue
        if tag == "br":
            parts.append(" ")
            breaks += 1
            if breaks > 1:
                flush()
            continue
        if tag == "a":
            links = max(0, links + (-1 if m[2] else 1))
        if tag in INLINE:
            if not m[2] and tag != "a" and tag not in VOID and _place(tag, m[4], place) < 0 <= place:
                flush()
                enter(tag, -1)
            elif m[2] and stack and stack[-1][0] == tag:
                flush()
                _, place, section = stack.pop()
            continue
        flush()
        links = 0
        if m[2]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    _, place, section = stack[i]
                    del stack[i:]
                    break
        elif tag not in VOID and tag not in ("p", "li", "tr", "td", "th", "dt", "dd", "option") and not m[4].rstrip().endswith("/"):
            enter(tag, _place(tag, m[4], place))
        elif tag in ("p", "li") and m[4]:
            inner = _place(tag, m[4], place)
            if inner != place:
                enter(tag, inner)
    if at < len(page):
        parts.append(_OPEN.sub("", page[at:].split("<!--")[0]))
    flush()
    return out


def classify(block: Block) -> str:
    """First pass: good, bad, near (to good) or short."""
    n = len(block.text)
    if block.linked > (LINKS if block.place <= 0 else MOST_LINKS) * n:
        return "bad"
    words = _LETTERS.findall(block.text.lower())
    stops = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    if n < SHORT:
        notice = block.text.startswith("©") or "copyright" in block.text.lower()
        return "bad" if block.place <= 0 and (block.linked or notice and stops < FEW) else "short"
    if stops >= MANY and n > LONG:
        return "near" if block.place < 0 else "good"
    if stops >= FEW:
        return "short" if block.place < 0 else "near"
    return "near" if block.place > 0 else "bad"


def labels(blocks: list[Block]) -> list[str]:
    """Second pass: good or bad for each block."""
    first = [classify(b) for b in blocks]
    if not any(b.section for b in blocks) and not {"good", "bad"}.intersection(first):  # nothing tells content from the rest
        return ["good"] * len(blocks)
    sections: dict[int, list[int]] = {}
    for i, b in enumerate(blocks):
        sections.setdefault(b.section, []).append(i)
    out = list(first)
    for members in sections.values():
        edge = "good" if blocks[members[0]].place > 0 else "bad"
        before: list[tuple[str, int]] = []
        label, since = edge, 0
        for i in members:
            since += 1
            before.append((label, since))
            if first[i] in ("good", "bad"):
                label, since = first[i], 0
        label, since = edge, 0
        for i, (previous, far) in zip(reversed(members), reversed(before), strict=True):
            since += 1
            if first[i] in ("good", "bad"):
                label, since = first[i], 0
            elif previous == label:
                out[i] = label
            elif first[i] == "near":
                out[i] = "good"
            else:
                out[i] = previous if far < since else label if since < far else edge
    return out


def main_text(page: str) -> str:
    blocks = blocks_of(page)
    return "\n".join(b.text for b, label in zip(blocks, labels(blocks), strict=True) if label == "good")


def extract(pages: DataFrame, body: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns, the main text of every page, and its length in code points."""
    source = pages.select(*keep, F.coalesce(F.col(body), F.lit("")).alias("__html"))
    schema = source.select(*keep).schema.simpleString()[7:-1] + ", text string, n_chars long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x) for x in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*batch.schema.names[:-1], "text", "n_chars"])

    return common.in_arrow(source, work, schema)


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(common.table(spark, sf_dir, "pages"))
