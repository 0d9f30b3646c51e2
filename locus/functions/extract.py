"""Extraction from pages and free text: visible text, links, structured data, US addresses, map pins, updates, closing notices.

What is one regular expression is a Column; what needs a parser is a Python function, wrapped as an Arrow function or a table
function where rows come out.
"""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HIDDEN = {"script", "style", "noscript", "svg", "iframe"}
#: States and their codes. Fixed values.
STATES = dict(
    x.split("=")
    for x in (
        "Alabama=AL Alaska=AK Arizona=AZ Arkansas=AR California=CA Colorado=CO Connecticut=CT Delaware=DE Florida=FL Georgia=GA Hawaii=HI Idaho=ID Illinois=IL Indiana=IN Iowa=IA Kansas=KS "
        "Kentucky=KY Louisiana=LA Maine=ME Maryland=MD Massachusetts=MA Michigan=MI Minnesota=MN Mississippi=MS Missouri=MO Montana=MT Nebraska=NE Nevada=NV New_Hampshire=NH New_Jersey=NJ "
        "New_Mexico=NM New_York=NY North_Carolina=NC North_Dakota=ND Ohio=OH Oklahoma=OK Oregon=OR Pennsylvania=PA Rhode_Island=RI South_Carolina=SC South_Dakota=SD Tennessee=TN Texas=TX "
        "Utah=UT Vermont=VT Virginia=VA Washington=WA West_Virginia=WV Wisconsin=WI Wyoming=WY District_of_Columbia=DC"
    ).split()
)
STATES = {k.replace("_", " "): v for k, v in STATES.items()}
SUFFIX = "Street|St|Avenue|Ave|Boulevard|Blvd|Road|Rd|Drive|Dr|Lane|Ln|Way|Court|Ct|Place|Pl|Square|Sq|Parkway|Pkwy|Highway|Hwy|Circle|Cir|Terrace|Ter|Plaza|Plz|Pike|Broadway|Alley|Row|Loop|Trail|Trl|Commons|Crossing|Walk|Expressway|Expy|Route|Rte"
#: Streets have up to so many words before their suffix, cities up to so many. Fixed values.
STREET_WORDS, CITY_WORDS = 6, 4
UNITS = {"suite", "ste", "unit", "apt", "bldg", "floor", "fl"}
DIRECTIONS = set("N S E W NE NW SE SW North South East West".split())
_SUFFIXES = set(SUFFIX.split("|"))
_CODES = set(STATES.values())
_WORD = re.compile(r"[^\s,]+")
SOON = re.compile(r"\b(?:coming|opening)\s+soon\b", re.I)
#: How far "coming soon" may stand from the address it is said of.
SOON_CHARACTERS = 150
MONTHS = {m: i for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split(), start=1)}


class _Page(HTMLParser):
    """Visible text pieces, links with their labels, title and named meta contents."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.text: list[str] = []
        self.links: list[list[str]] = []
        self.title, self.meta, self.headings = "", {}, []
        self._hidden, self._link, self._in_title, self._heading = 0, False, False, False

    def handle_starttag(self, tag, attrs):
        values = {k: v or "" for k, v in attrs}
        if tag in HIDDEN:
            self._hidden += 1
        elif tag == "a":
            self.links.append([values.get("href", ""), ""])
            self._link = True
        elif tag == "meta":
            self.meta.setdefault((values.get("property") or values.get("name") or "").lower(), values.get("content", ""))
        self._in_title |= tag == "title"
        self._heading |= bool(re.fullmatch("h[1-6]", tag))

    def handle_endtag(self, tag):
        if tag in HIDDEN:
            self._hidden = max(0, self._hidden - 1)
        self._link &= tag != "a"
        self._in_title &= tag != "title"
        self._heading &= not re.fullmatch("h[1-6]", tag)

    def handle_data(self, data):
        if self._in_title:
            self.title += data
        elif not self._hidden and (clean := re.sub(r"\s+", " ", data).strip()):
            self.text.append(clean)
            if self._heading:
                self.headings.append(clean)
            if self._link:
                self.links[-1][1] = f"{self.links[-1][1]} {clean}".strip()


def read_page(html: str) -> _Page:
    page = _Page()
    page.feed(html)
    page.close()
    return page


def visible_text(html: str) -> str:
    return "\n".join(read_page(html).text)


def page_title(html: str) -> str:
    """og:site_name, else og:title, else the title, up to the first separator."""
    page = read_page(html)
    chosen = page.meta.get("og:site_name") or page.meta.get("og:title") or page.title
    return re.split(r"\s+[|–—-]\s+|\s*[|·]\s*", chosen.strip())[0].strip()


def structured_items(html: str) -> list[dict]:
    """All JSON-LD objects of a page, nested ones too."""
    out: list[dict] = []

    def walk(node):
        if isinstance(node, dict):
            out.append(node)
            node = list(node.values())
        if isinstance(node, list):
            for x in node:
                walk(x)

    for block in re.findall(r"<script[^>]*ld\+json[^>]*>(.*?)</script>", html, re.I | re.S):
        try:
            walk(json.loads(block))
        except ValueError:
            continue
    return out


def _state_at(words: list[re.Match], i: int) -> tuple[str, int] | None:
    """The code of the state that begins at word i, and the word after it."""
    for n in range(min(3, len(words) - i), 0, -1):
        name = " ".join(w[0] for w in words[i : i + n]).rstrip(".")
        if name in STATES or (n == 1 and name in _CODES):
            return STATES.get(name, name), i + n
    return None


def _address_at(words: list[re.Match], text: str, i: int) -> tuple[dict, int] | None:
    """The address whose house number is word i, and the word after it.

    Words are read on from the number: street words to the first suffix, a direction, a unit, then as many capitalized words of a
    city as leave a state behind them, and a zip.
    """
    if not re.fullmatch(r"\d{1,6}[A-Z]?", words[i][0]) or text[words[i].start() - 1 : words[i].start()] in ("$", "#", "."):
        return None
    end = next((k for k in range(i + 1, min(len(words), i + STREET_WORDS + 2)) if words[k][0].rstrip(".") in _SUFFIXES and k > i + 1), None)
    if end is None or not all(re.fullmatch(r"[A-Z0-9][\w'’.-]*", w[0]) for w in words[i + 1 : end + 1]):
        return None
    at = end + 1
    if at < len(words) and words[at][0].rstrip(".") in DIRECTIONS:
        at += 1
    street, unit = " ".join(w[0] for w in words[i:at]), None
    if at < len(words):
        first = words[at][0]
        if first.rstrip(".").lower() in UNITS and at + 1 < len(words):
            unit, at = f"{first} {words[at + 1][0]}", at + 2
        elif re.fullmatch(r"#[\w-]+|[A-Z]-?\d{1,4}", first):
            unit, at = first, at + 1
    for n in range(CITY_WORDS, 0, -1):
        named = words[at : at + n]
        found = _state_at(words, at + n) if len(named) == n and all(re.fullmatch(r"[A-Z][A-Za-z'’.]+", w[0]) for w in named) else None
        if found:
            state, after = found
            code = re.match(r"(\d{5})(?:-\d{4})?\b", words[after][0]) if after < len(words) else None
            after += bool(code)
            stop = words[after - 1].end() if not code else words[after - 1].start() + code.end()
            return {"street": f"{street} {unit}" if unit else street, "city": " ".join(w[0] for w in named), "state": state, "zip": code and code[1], "at": (words[i].start(), stop), "soon": False}, after
    return None


def location_key(a: dict) -> str:
    """House number with the zip, or the city: letters and digits only."""
    return re.sub(r"\W", "", f"{a['street'].split()[0]}{a['zip'] or a['city']}").lower()


def addresses(text: str) -> list[dict]:
    """US addresses in running text, each once, with `soon` where "coming soon" stands nearest to it (the one after, on ties)."""
    words, found, i = list(_WORD.finditer(text)), {}, 0
    while i < len(words):
        read = _address_at(words, text, i)
        if read:
            found.setdefault(location_key(read[0]), read[0])
        i = read[1] if read else i + 1
    found = list(found.values())
    for s in SOON.finditer(text):
        gaps = []
        for i, a in enumerate(found):
            begin, end = a["at"]
            gap = 0 if begin <= s.start() < end else min(abs(s.start() - end), abs(begin - s.end()))
            gaps.append((gap, begin < s.start(), i))
        if gaps and min(gaps)[0] <= SOON_CHARACTERS:
            found[min(gaps)[2]]["soon"] = True
    return found


def one_line(a: dict) -> str:
    return f"{a['street']}, {a['city']}, {a['state']}" + (f" {a['zip']}" if a["zip"] else "")


def structured_addresses(html: str) -> list[dict]:
    """Addresses of JSON-LD items that have street, city, state and zip."""
    out = []
    for item in structured_items(html):
        a = item.get("address")
        if isinstance(a, dict) and all(a.get(k) for k in ("streetAddress", "addressLocality", "addressRegion", "postalCode")):
            geo = item.get("geo") if isinstance(item.get("geo"), dict) else {}
            region = str(a["addressRegion"])
            out.append({"street": a["streetAddress"], "city": a["addressLocality"], "state": STATES.get(region, region), "zip": str(a["postalCode"])[:5], "soon": False, "lat": geo.get("latitude"), "lon": geo.get("longitude")})
    return out


def map_pins(html: str) -> list[tuple[float, float]]:
    """Distinct coordinates in map links: "@lat,lon", "q=lat,lon" or "!3dlat!4dlon"."""
    found = re.findall(r"(?:@|[?&](?:q|ll|query|center)=|!3d)(-?\d{1,2}\.\d{3,})(?:,|%2C|!4d)(-?\d{1,3}\.\d{3,})", html)
    return [p for p in dict.fromkeys((float(a), float(b)) for a, b in found) if abs(p[0]) <= 90 and abs(p[1]) <= 180]


def locations(html: str) -> list[dict]:
    """Structured addresses first, then those of the text; a single map pin goes with a single address, as a fallback."""
    out = structured_addresses(html)
    known = {location_key(a) for a in out if a["street"]}
    out += [a for a in addresses(visible_text(html)) if location_key(a) not in known]
    pins = map_pins(html)
    if len(out) == 1 and len(pins) == 1 and out[0].get("lat") is None:
        out[0]["pin"] = pins[0]
    return out


def location_rows(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, pos, street, city, state, zip, soon, pin_lat, pin_lon) of every location of every page: a narrow map over pages."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for i, a in enumerate(locations(h or "")):
                    pin = a.get("pin") or (None, None)
                    rows.append({key: k, "pos": i, "street": a["street"], "city": a["city"], "state": a["state"], "zip": a["zip"], "soon": a["soon"], "pin_lat": pin[0], "pin_lon": pin[1]})
            types = [batch.schema.field(0).type, pa.int32(), pa.string(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.float64(), pa.float64()]
            names = [key, "pos", "street", "city", "state", "zip", "soon", "pin_lat", "pin_lon"]
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types, strict=True)], names=names)

    return pages.select(key, html).mapInArrow(run, f"`{key}` {kind}, pos int, street string, city string, state string, zip string, soon boolean, pin_lat double, pin_lon double")


def link_rows(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """(key, pos, href, label) of every link, resolved against the page's own address."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k, u, h in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                for i, (href, label) in enumerate(read_page(h or "").links):
                    try:
                        rows.append((k, i, urljoin(u or "", href), label))
                    except ValueError:
                        rows.append((k, i, href, label))
            columns = list(zip(*rows, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], batch.schema.field(0).type), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.string()), pa.array(columns[3], pa.string())], names=[key, "pos", "href", "label"])

    return pages.select(key, url, html).mapInArrow(run, f"`{key}` {kind}, pos int, href string, label string")


def sitemap_urls(xml: Column, most: int = 5000) -> Column:
    return F.slice(F.array_distinct(F.regexp_extract_all(xml, F.lit(r"<loc>\s*([^<\s]+)\s*</loc>"), F.lit(1))), 1, most)


def has_code(html: str, code: str, name: str) -> bool:
    """The code stands in the page's visible text, or is the content of the meta tag of this name."""
    page = read_page(html)
    return page.meta.get(name.lower(), "").strip().lower() == code or code in " ".join(page.text).lower()


# What says that a place has closed for good, what says that it has not, and what a page without its owner says.
CLOSED = ["permanently closed", "closed permanently", "closed for good", "(?:have|has) (?:now |officially |permanently )?closed (?:our|its) doors", "closing (?:our|its) doors (?:for good|permanently)", "we(?:'ve| have) (?:officially )?closed\\b(?! on)(?! for (?:the|a|today|tonight|lunch|dinner|holiday|vacation|private|renovation))"]
TEMPORARY = ["temporar", "reopen", "re-open", "renovat", "vacation", "holiday", "for the day", "tonight", "today"]
PARKED = ["domain (?:is |may be )?for sale", "buy this domain", "this domain (?:name )?(?:is|may be) for sale", "parked (?:free|domain|by)", "domain (?:has )?expired", "this domain has expired", "renew (?:this|your) domain", "account (?:has been )?suspended", "website (?:has been )?suspended", "hugedomains", "dan\\.com", "sedo(?:parking)?\\b", "afternic"]
#: Characters of visible text that are read for each, and around a notice. Fixed values.
CLOSED_TEXT, PARKED_TEXT, AROUND = 6000, 4000, 120
_CLOSED, _TEMPORARY, _PARKED = (re.compile("|".join(x), re.I) for x in (CLOSED, TEMPORARY, PARKED))


def closed_for_good(visible: str) -> bool:
    """The visible text has a notice of closing for good with no word of a temporary one around it."""
    text = visible[:CLOSED_TEXT]
    return any(not _TEMPORARY.search(text[max(0, m.start() - AROUND) : m.end() + AROUND]) for m in _CLOSED.finditer(text))


def parked(visible: str) -> bool:
    return bool(_PARKED.search(visible[:PARKED_TEXT]))


def _notices(html: pd.Series) -> pd.DataFrame:
    texts = [" ".join(read_page(h or "").text) for h in html]
    return pd.DataFrame({"closed": [closed_for_good(t) for t in texts], "parked": [parked(t) for t in texts], "length": [len(t) for t in texts]})


def notices(html: Column) -> Column:
    """struct(closed, parked, length) of a page's visible text."""
    return F.pandas_udf(_notices, "struct<closed: boolean, parked: boolean, length: int>")(html)


def update_lines(html: str, whole_page: bool = False, most: int = 8, heading: str = "updates") -> list[tuple[str, str]]:
    """Lines "Special: ...", "Closed: ...", "Hours: ...", "Note: ..." of the 14 lines below a heading, up to the first other line after
    one of them; or anywhere on the page."""
    page = read_page(html)
    lines = page.text
    if not whole_page:
        at = next((i for i, x in enumerate(lines) if x in page.headings and heading in x.lower()), None)
        if at is None:
            return []
        lines = lines[at + 1 : at + 15]
    out = []
    for line in lines:
        m = re.match(r"(special|closed|hours|note)\s*[:\-–]\s*(.+)", line, re.I)
        if m:
            out.append((m[1].lower(), m[2]))
        elif out and not whole_page:
            break
    return out[:most]


def limited(text: str, most: int = 120) -> str:
    """A clean short text: no addresses of pages, no control characters or angle brackets."""
    return re.sub(r"\s+", " ", re.sub(r"[\x00-\x1f<>]", " ", re.sub(r"https?://\S+|www\.\S+", "", text))).strip()[:most]


def closed_range(text: str, base: dt.date) -> tuple[dt.date, dt.date] | None:
    """First and last day of "Nov 27 - Dec 2", "Nov 27-28", "11/27-11/28" or one day; the year is the one near `base`."""
    part = r"(?:([A-Za-z]{3,9})\.?\s+(\d{1,2})(?:st|nd|rd|th)?|(\d{1,2})/(\d{1,2}))"
    m = re.search(rf"{part}(?:\s*(?:-|–|to|through)\s*(?:{part}|(\d{{1,2}})(?:st|nd|rd|th)?\b))?", text)
    if not m:
        return None

    def day(month: int | None, number: str) -> dt.date | None:
        try:
            d = dt.date(base.year, month or 0, int(number))
        except ValueError:
            return None
        return d.replace(year=d.year + 1) if (base - d).days > 60 else d

    month = MONTHS.get(m[1][:3].lower()) if m[1] else int(m[3])
    first = day(month, m[2] or m[4])
    last = first
    if m[5] or m[7]:
        last = day(MONTHS.get(m[5][:3].lower()) if m[5] else int(m[7]), m[6] or m[8])
    elif m[9]:
        last = day(month, m[9])
    if first is None or last is None:
        return None
    return first, (last.replace(year=last.year + 1) if last < first else last)


def update_rows(pages: DataFrame, key: str, html: str, heading: str) -> DataFrame:
    """(key, pos, kind, text) of every page's update lines: a narrow map over pages."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(k, i, what, limited(text)) for k, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for i, (what, text) in enumerate(update_lines(h or "", heading=heading))]
            columns = list(zip(*rows, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], batch.schema.field(0).type), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.string()), pa.array(columns[3], pa.string())], names=[key, "pos", "kind", "text"])

    return pages.select(key, html).mapInArrow(run, f"`{key}` {kind}, pos int, kind string, text string")


def _ranges(base: dt.date):
    def run(texts: pd.Series) -> pd.DataFrame:
        found = [closed_range(t, base) if t else None for t in texts]
        return pd.DataFrame({"first": [f[0] if f else None for f in found], "last": [f[1] if f else None for f in found]})

    return run


def closed_range_column(text: Column, base: dt.date) -> Column:
    """struct(first, last) of the days that a text names, near `base`."""
    return F.pandas_udf(_ranges(base), "struct<first: date, last: date>")(text)


def _titles(html: pd.Series) -> pd.Series:
    return html.map(lambda h: page_title(h or ""))


def title_column(html: Column) -> Column:
    return F.pandas_udf(_titles, "string")(html)


def domain_status(reached: Column, host: Column, final: Column, dish_host: Column, length: Column, parked_page: Column, dish: Column, other: Column, locations: Column, located: Column) -> Column:
    """What a newly seen domain turned out to be; locations and located are how many addresses it has and how many are on the map."""
    none = locations == 0
    return (
        F.when(~reached, "unreachable")
        .when((final != "") & ~final.endswith(host) & ~dish_host, "elsewhere")
        .when((length < 200) & none, "empty")
        .when(parked_page & none, "parked")
        .when(~dish, "not ramen")
        .when(other & none, "not a restaurant")
        .when(located == 0, "no US address")
        .otherwise("ok")
    )


def store_slugs(url: Column, base: str, state: Column) -> Column:
    """struct(city, slug) of a store page below a chain's directory ("base/state/city/number-street"); null for other pages."""
    depth = len([x for x in base.split("//", 1)[-1].split("/")[1:] if x])
    parts = F.filter(F.split(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")), "/"), lambda x: x != "")
    at = lambda i: F.get(parts, F.lit(depth + i))
    return F.when((F.size(parts) == depth + 3) & (at(0) == state) & at(2).rlike(r"^\d+[a-z]?-"), F.struct(at(1).alias("city"), at(2).alias("slug")))
