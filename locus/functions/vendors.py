"""Vendor cards of directory pages: a small element tree on the standard parser, and the rules that read it."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
DROPPED = {"script", "style", "noscript", "svg", "nav", "footer", "header", "form"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Longest text of a card, of a description beside a flat title, of a name, and levels that a card may rise. Fixed values.
CARD_TEXT, SIBLING_TEXT, NAME_TEXT, LEVELS = 700, 300, 60, 4
# Labels that are no vendor, signs of a product, of a line that is no name, of a vendor not open.
LABELS = "eat|drink|eat\\s*&\\s*drink|eat and drink|vendors?|our vendors|directory|tenants?|shops?|dine|dining|restaurants?|food|food hall|menu|menus|hours|events?|visit|about|contact|order|order now|order online|view menu|learn more|more info|website|read more|see more|shop|stores?|map|parking|careers|faq"
PRODUCT = re.compile(r"\d+\s*(?:var|p|pk|pc|pcs|ct|oz|g|ml|lb)\b\.?|\bcup\b|\bpack\b|\binstant\b|\bbag\b|\bbox\b|\bnoodle soup mix\b|\$\s*\d", re.I)
NO_NAME = re.compile(
    r"\d{1,2}(?::\d\d)?\s*(?:am|pm)\b|^\(?\d{3}\)?[-. ]\d{3}|\b(?:mon|tue|wed|thu|fri|sat|sun)(?:day)?s?\b|catering|delivery|ordering|order online|takeout|pick ?up|reservations?|gift cards?|parking|available|food stalls|stalls|vendors|neighborhood|location",
    re.I,
)
NOT_OPEN = re.compile("coming soon|opening soon|permanently closed|now closed|has closed|closing", re.I)
OPENINGS = ("welcome", "open ", "hours", "©", "copyright", "follow us")
_LABEL = re.compile(f"(?:{LABELS})", re.I)


class Element:
    __slots__ = ("tag", "kind", "parent", "parts", "place")

    def __init__(self, tag: str, kind: str, parent: Element | None):
        self.tag, self.kind, self.parent, self.parts, self.place = tag, kind, parent, [], 0

    def walk(self) -> Iterator[Element]:
        for part in self.parts:
            if isinstance(part, Element):
                yield part
                yield from part.walk()

    def strings(self) -> Iterator[str]:
        for part in self.parts:
            if isinstance(part, str):
                yield part
            else:
                yield from part.strings()

    @property
    def text(self) -> str:
        return clean(" ".join(self.strings()))


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("", "", None)

    def handle_starttag(self, tag, attrs):
        new = Element(tag, dict(attrs).get("class") or "", self.at)
        new.place = len(self.at.parts)
        self.at.parts.append(new)
        if tag not in VOID:
            self.at = new

    def handle_endtag(self, tag):
        up = self.at
        while up is not None and up.tag != tag:
            up = up.parent
        if up is not None and up.parent is not None:
            self.at = up.parent

    def handle_data(self, data):
        self.at.parts.append(data)


def clean(text: str) -> str:
    return re.sub(r"\s+", " ", text).strip(" -–—|:·•")


def tree(html: str) -> Element:
    parser = _Tree()
    parser.feed(html)
    parser.close()
    for e in [parser.root, *parser.root.walk()]:
        e.parts = ["" if isinstance(p, Element) and p.tag in DROPPED else p for p in e.parts]
    return parser.root


def is_name(text: str, hall: str, says: re.Pattern) -> bool:
    latin = bool(re.search("[A-Za-z]", text)) or bool(says.search(text))
    refused = _LABEL.fullmatch(text) or text.lower() == hall.lower() or PRODUCT.search(text) or NO_NAME.search(text) or text.lower().startswith(OPENINGS)
    return latin and 2 <= len(text) <= NAME_TEXT and not refused


def short_name(name: str) -> str:
    """A name without a tagline after a dash, colon or bar."""
    return re.split(r"\s*[-–—:|]\s*[\"“]|\s+[–—|]\s+", name)[0].strip() or name


def _card(title: Element) -> str:
    """The text of the block around a title: up to the level that holds too much or another heading; beside a flat title, what
    follows it."""
    block = title
    for _ in range(LEVELS):
        up = block.parent
        inner = {id(title), *(id(e) for e in title.walk())}
        if up is None or len(up.text) > CARD_TEXT or any(e.tag in HEADINGS and id(e) not in inner for e in up.walk()):
            break
        block = up
    if block is not title:
        return block.text if sum(e.tag in HEADINGS for e in block.walk()) <= 2 else title.text
    after = next((p for p in title.parent.parts[title.place + 1 :] if isinstance(p, Element)), None) if title.parent else None
    return f"{title.text} {after.text}" if after is not None and after.tag not in HEADINGS and len(after.text) <= SIBLING_TEXT else title.text


def _from_lines(lines: list[str], hall: str, says: re.Pattern) -> Iterator[tuple[str, str]]:
    """Names and descriptions of pages without titles: a short name that says so before a longer line, or the nearest name above a
    description that does."""
    for i, line in enumerate(lines):
        if not says.search(line) or NOT_OPEN.search(line):
            continue
        if is_name(line, hall, says) and len(line) <= 40 and i + 1 < len(lines) and len(lines[i + 1]) > 25:
            yield line, lines[i + 1]
        elif len(line) > 25:
            above = [x for x in lines[max(0, i - 4) : i][::-1] if not NO_NAME.search(x) and not _LABEL.fullmatch(x)]
            if above and is_name(above[0], hall, says) and len(above[0]) <= 40 and not above[0].endswith((".", "!", "?", ",")):
                yield above[0], line


def vendors(html: str, hall: str, says: re.Pattern) -> list[tuple[str, str]]:
    """(name, description) of each vendor of a directory page whose name or description says so; each name once."""
    root = tree(html)
    titles = [e for e in root.walk() if e.tag in HEADINGS] + [e for e in root.walk() if re.search("title|name|vendor|tenant", e.kind, re.I)]
    found: dict[str, tuple[str, str]] = {}
    for title in titles:
        name, about = title.text, _card(title)
        if is_name(name, hall, says) and says.search(f"{name} {about}") and not NOT_OPEN.search(about) and not PRODUCT.search(about[:160]):
            short = short_name(name)
            found.setdefault(short.lower(), (short.title() if short.isupper() else short, about[:200]))
    if not found:
        for name, about in _from_lines([x for x in map(clean, root.strings()) if x], hall, says):
            found.setdefault(name.lower(), (name.title() if name.isupper() else name, about[:200]))
    return list(found.values())


def vendor_page(html: str, hall: str, says: re.Pattern) -> tuple[str, str] | None:
    """The vendor of a page of its own: its main heading, if the page's opening says so."""
    root = tree(html)
    head = next((e for tag in ("h1", "h2") for e in root.walk() if e.tag == tag), None)
    if head is None or not is_name(head.text, hall, says):
        return None
    opening = root.text[max(0, root.text.find(head.text)) :][:1500]
    if not says.search(f"{head.text} {opening}") or NOT_OPEN.search(opening[:400]):
        return None
    return (head.text.title() if head.text.isupper() else head.text), opening[:200]


def vendor_rows(pages: DataFrame, key: str, html: str, hall: str, says: str) -> DataFrame:
    """(key, name, about) of every vendor of every page: a narrow map over pages."""
    kind, pattern = pages.schema[key].dataType.simpleString(), says

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        said = re.compile(pattern, re.I)
        for batch in batches:
            rows = [(k, *v) for k, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for v in vendors(h or "", hall, said)]
            columns = list(zip(*rows, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], batch.schema.field(0).type), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())], names=[key, "name", "about"])

    return pages.select(key, html).mapInArrow(run, f"`{key}` {kind}, name string, about string")
