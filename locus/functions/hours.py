"""Weekly opening hours from free text, schema.org data and hand-written lines.

A week is seven lists (Monday first) of (open, close) minutes; a close after midnight is over 1440. Parsers return None where the
text is ambiguous. Row-wise parsing cannot be an expression, so `week_column` wraps it in an Arrow function; what follows from a
week (open now, late nights, runs of equal days) stays relational.
"""

from __future__ import annotations

import json
import re
from html import unescape

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .extract import structured_items

Week = list[list[tuple[int, int]]]
DAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
DAY = r"mon(?:days?)?|tue(?:s(?:days?)?)?|wed(?:nesdays?)?|thu(?:r(?:s(?:days?)?)?)?|fri(?:days?)?|sat(?:urdays?)?|sun(?:days?)?|mo|tu|we|th|fr|sa|su"
CLOCK = r"(?:\d{1,2}(?:[:.]\d\d)?\s*(?:[ap]\.?\s?m\b\.?)?|noon|midnight)"
DASH = r"\s*(?:-|–|—|~|\bto\b|\buntil\b)\s*"
TOKEN = re.compile(
    rf"(?P<span>(?<![\d.$:/]){CLOCK}{DASH}{CLOCK}(?![\d:/]))|(?P<range>\b(?:{DAY})\b\.?{DASH}(?:{DAY})\b)|(?P<day>\b(?:{DAY})\b)|(?P<closed>\bclosed\b)|(?P<all>\b(?:daily|every\s?day|(?:open\s+)?[67] days(?: a week)?)\b)|(?P<stop>\b(?:happy hour|brunch menu|holiday|delivery hours|last call)\b)|(?P<word>[^\W\d_]{{3,}})",
    re.I,
)
#: Words between parts of a table of hours that change nothing.
NEUTRAL = {"hours", "open", "opening", "business", "store", "lunch", "dinner", "and", "from", "today", "info", "hour", "operation", "our", "the"}


def minutes(text: str, half: str | None = None) -> tuple[int, str | None] | None:
    """Minutes of a clock time and its own am/pm mark."""
    t = text.strip().lower().replace(" ", "")
    if t in ("noon", "midnight"):
        return (720, "pm") if t == "noon" else (0, "am")
    m = re.fullmatch(r"(\d{1,2})(?:[:.](\d\d)(?::\d\d(?:\.\d+)?)?)?([ap])?\.?m?\.?", t)
    if not m or int(m[1]) > 24 or int(m[2] or 0) > 59:
        return None
    return int(m[1]) * 60 + int(m[2] or 0), f"{m[3]}m" if m[3] else None


def _apply(value: int, mark: str) -> int:
    return value % 720 + (720 if mark == "pm" else 0)


def span(opens: str, closes: str, full_day: bool = False) -> tuple[int, int] | None:
    """Open and close minutes. Unmarked times: 24-hour clock where an hour is over 12 or has a leading zero; else the close is pm
    and the open follows it if its hour is smaller, or is pm at 12 and from 1 to 6. From 1 to 20 hours, to 6 in the morning."""
    a, b = minutes(opens), minutes(closes)
    if a is None or b is None:
        return None
    (o, om), (c, cm) = a, b
    if full_day or (not om and not cm and (o >= 780 or c >= 780 or opens.strip().startswith("0") or closes.strip().startswith("0"))):
        o, c = o % 1440, c
    else:
        if max(o, c) >= 780 and not (om and cm):
            return None
        hour_o, hour_c = o // 60, c // 60
        if om:
            open_at = _apply(o, om)
        elif hour_o == 12 or (not cm and 1 <= hour_o <= 6):
            open_at = _apply(o, "pm")
        else:
            open_at = _apply(o, "pm" if cm == "pm" and hour_o < hour_c and hour_c != 12 else "am")
        c = (1440 if hour_c == 12 and not cm else _apply(c, cm or "pm"))
        o = open_at
    if c <= o:
        c += 1440
    return (o, c) if 60 <= c - o <= 1200 and c <= 1800 and o < 1440 else None


def _day(text: str) -> int:
    return [d[:2] for d in DAYS].index(text.strip().lower()[:2])


def day_range(first: int, last: int) -> list[int]:
    return [(first + i) % 7 for i in range((last - first) % 7 + 1)]


def valid(week: Week | None, least: int = 3) -> bool:
    return week is not None and sum(map(bool, week)) >= least and all(0 <= o < 1440 and o < c <= 1800 for d in week for o, c in d)


def merged(week: Week) -> Week:
    """Sorted, with overlapping and touching spans made one."""
    out: Week = []
    for day in week:
        spans: list[tuple[int, int]] = []
        for o, c in sorted(set(day)):
            if spans and o <= spans[-1][1]:
                spans[-1] = (spans[-1][0], max(c, spans[-1][1]))
            else:
                spans.append((o, c))
        out.append(spans)
    return out


def from_schema(entries: list[str]) -> Week | None:
    """schema.org strings: "Mo-Fr 11:00-14:00 17:00-21:00"; days by name, range or list."""
    week: Week = [[] for _ in DAYS]
    for entry in entries:
        m = re.match(rf"\s*((?:{DAY})\b(?:\s*[-–,]\s*(?:{DAY})\b)*)\s+(.*)", entry, re.I)
        if not m:
            return None
        days: list[int] = []
        for part in m[1].split(","):
            ends = [_day(x) for x in re.split(r"[-–]", part)]
            days += day_range(ends[0], ends[-1])
        for o, c in re.findall(r"(\d{1,2}:\d\d)\s*[-–]\s*(\d{1,2}:\d\d)", m[2]):
            if (s := span(o, c, full_day=True)) is None:
                return None
            for d in days:
                week[d].append(s)
    return merged(week)


def from_jsonld(html: str) -> Week | None:
    for node in structured_items(unescape(html) if "&quot;" in html else html):
        spec, text = node.get("openingHoursSpecification"), node.get("openingHours")
        week: Week | None = None
        if spec:
            week = [[] for _ in DAYS]
            for row in spec if isinstance(spec, list) else [spec]:
                if not isinstance(row, dict) or row.get("validFrom") or row.get("validThrough"):
                    continue
                days = row.get("dayOfWeek") or []
                s = span(str(row.get("opens", "")), str(row.get("closes", "")), full_day=True)
                for day in days if isinstance(days, list) else [days]:
                    name = str(day).rsplit("/", 1)[-1].lower()
                    if s and name in DAYS:
                        week[DAYS.index(name)].append(s)
            week = merged(week)
        elif text:
            week = from_schema(text if isinstance(text, list) else [text])
        if valid(week):
            return week
    return None


def from_microdata(html: str) -> Week | None:
    found = [m[1] or m[2] for m in re.finditer(r"""itemprop=["']openingHours["'][^>]*?(?:datetime|content)=["']([^"']+)|(?:datetime|content)=["']([^"']+)["'][^>]*itemprop=["']openingHours""", html, re.I)]
    week = from_schema(found) if found else None
    return week if valid(week) else None


def from_schedule(html: str) -> Week | None:
    """Embedded "schedule" lists; more than one distinct week is ambiguous."""
    weeks = []
    for m in re.finditer(r'"schedule"\s*:\s*(?=\[)', html):
        try:
            rows, _ = json.JSONDecoder().raw_decode(html, m.end())
        except ValueError:
            continue
        week: Week = [[] for _ in DAYS]
        for row in (r for r in rows if isinstance(r, dict)):
            for part in (p for p in row.get("intervals") or [] if isinstance(p, dict)):
                s = span(str(part.get("startTime", ""))[:5], str(part.get("endTime", ""))[:5], full_day=True)
                for day in row.get("days") or []:
                    if s and day in DAYS:
                        week[DAYS.index(day)].append(s)
        if valid(week) and merged(week) not in weeks:
            weeks.append(merged(week))
    return weeks[0] if len(weeks) == 1 else None


def from_text(text: str) -> Week | None:
    """Hours in running text: days then times, times then (days), all days then all times, or all week but named days."""
    text = re.sub(r"\s+", " ", text)
    start = re.search(rf"\b(?:hours|open|store info)\b|\b(?:{DAY})\b", text, re.I)
    if not start or re.search(r"\bhappy hour\b", text[max(0, start.start() - 25) : start.start()], re.I):
        return None
    tokens: list[tuple[str, object]] = []
    at, strangers = None, 0
    for m in TOKEN.finditer(text[: start.start() + 900], start.start()):
        kind = m.lastgroup
        if kind == "stop":
            break
        if kind == "day" and m[0].islower() and len(m[0]) == 2:
            continue  # "we" is no Wednesday in running text
        if kind == "word":
            strangers += m[0].lower() not in NEUTRAL
            continue
        if at is not None and tokens and (m.start() - at > 60 or strangers > 5):
            break
        strangers = 0
        at = m.end()
        if kind == "span":
            parts = re.split(r"\s*(?:-|–|—|~|\bto\b|\buntil\b)\s*", m[0], maxsplit=1, flags=re.I)
            s = span(*parts)
            if s is None:
                return None
            tokens.append(("time", s))
        elif kind == "range":
            ends = re.findall(rf"\b(?:{DAY})\b", m[0], re.I)
            tokens.append(("days", day_range(_day(ends[0]), _day(ends[-1]))))
        elif kind == "day":
            tokens.append(("days", [_day(m[0])]))
        elif kind == "all":
            tokens.append(("days", list(range(7))))
        else:
            tokens.append(("closed", None))
    return _assemble(_closed_last(tokens))


def _closed_last(tokens: list[tuple[str, object]]) -> list[tuple[str, object]]:
    """"... 9pm, closed Sunday and Monday": where the days after a "closed" have no times of their own, it is said after them."""
    out, i = [], 0
    while i < len(tokens):
        after = i + 1
        while after < len(tokens) and tokens[after][0] == "days":
            after += 1
        said_before = tokens[i][0] == "closed" and out and out[-1][0] == "time" and after > i + 1
        if said_before and (after == len(tokens) or tokens[after][0] != "time"):
            out += [*tokens[i + 1 : after], tokens[i]]
            i = after
        else:
            out.append(tokens[i])
            i += 1
    return out


def _assemble(tokens: list[tuple[str, object]]) -> Week | None:
    """A week from alternating groups of days and of times; each day set is told the times next to it."""
    groups: list[tuple[str, list]] = []
    for kind, value in tokens:
        side = "days" if kind == "days" else "times"
        if not groups or groups[-1][0] != side:
            groups.append((side, []))
        groups[-1][1].append(value if kind != "closed" else None)
    if groups and groups[0] == ("times", [None]) and sum(k == "days" for k, _ in groups) > 1:
        groups = groups[1:]  # a state label ahead of the table
    sides = [k for k, _ in groups]
    if "days" not in sides or "times" not in sides:
        return None
    pairs: list[tuple[list[int], list]] = []
    if len(groups) == 2 and sides == ["days", "times"] and len(groups[0][1]) == len(groups[1][1]) > 2:
        pairs = [(d, [t]) for d, t in zip(groups[0][1], groups[1][1], strict=True)]
    else:
        if len(groups) > 1 and sides[0] == "times":
            groups = [g for i in range(0, len(groups) - 1, 2) for g in (groups[i + 1], groups[i])]
            if sides[-1] == "times":
                return None
        elif sides[-1] == "days" and len(sides) % 2:
            return None
        for (_, days), (_, times) in zip(groups[::2], groups[1::2], strict=True):
            pairs.append((sorted({x for d in days for x in d}), times))
    week: Week = [[] for _ in DAYS]
    named: set[int] = set()
    shut: set[int] = set()
    for days, times in pairs:
        named.update(days)
        if None in times:
            if any(t is not None for t in times):
                return None
            shut.update(days)
            continue
        for d in days:
            week[d] += times
    for d in shut:
        week[d] = []
    week = merged(week)
    return week if valid(week) and len(named) >= 3 else None


def from_hand(text: str) -> Week | None:
    """The strict language of hand-kept lists: groups by ";", days (ranges, lists) then times with am/pm; any doubt is None."""
    week: Week = [[] for _ in DAYS]
    for group in text.split(";"):
        m = re.fullmatch(rf"\s*((?:(?:{DAY})\b(?:\s*[-–]\s*(?:{DAY})\b)?(?:\s*(?:,|&|and)\s*)?)+)\s+(.+?)\s*", group, re.I)
        if not m:
            return None
        days: list[int] = []
        for part in re.findall(rf"\b({DAY})\b(?:\s*[-–]\s*({DAY})\b)?", m[1], re.I):
            days += day_range(_day(part[0]), _day(part[1] or part[0]))
        for part in m[2].split(","):
            ends = re.split(r"\s*[-–]\s*", part.strip())
            if len(ends) != 2 or not all(re.search(r"[ap]m$|^noon$|^midnight$", e.lower()) for e in ends):
                return None
            s = span(*ends)
            if s is None:
                return None
            for d in days:
                week[d].append(s)
    return merged(week)


def parse(html: str) -> tuple[Week | None, str | None]:
    """The first strategy that finds a week names it."""
    visible = re.sub(r"<[^>]+>", " ", re.sub(r"<(script|style)\b.*?</\1>", " ", html, flags=re.I | re.S))
    for how, find, source in (("jsonld", from_jsonld, html), ("microdata", from_microdata, html), ("schedule", from_schedule, html), ("text", from_text, unescape(visible))):
        week = find(source)
        if week:
            return week, how
    return None, None


def clock(minute: int) -> str:
    h, m = divmod(minute % 1440, 60)
    return f"{(h - 1) % 12 + 1}{f':{m:02d}' if m else ''}{'pm' if h >= 12 else 'am'}"


def said(week: Week) -> str:
    """Runs of equal days: "Mon–Thu 11am–9pm · Fri Closed"."""
    texts = [", ".join(f"{clock(o)}–{clock(c)}" for o, c in d) or "Closed" for d in week]
    out, i = [], 0
    while i < 7:
        j = i
        while j < 6 and texts[j + 1] == texts[i]:
            j += 1
        names = DAYS[i][:3].title() + (f"–{DAYS[j][:3].title()}" if j > i else "")
        out.append(f"{names} {texts[i]}")
        i = j + 1
    return " · ".join(out)


def _weeks(html: pd.Series) -> pd.DataFrame:
    found = [parse(h or "") for h in html]
    return pd.DataFrame({"week": [json.dumps(w) if w else None for w, _ in found], "how": [h for _, h in found]})


def week_column(html: Column) -> Column:
    """struct(week, how): the week as array of days of (open, close) arrays, and the strategy that found it."""
    r = F.pandas_udf(_weeks, "struct<week: string, how: string>")(html)
    return F.struct(F.from_json(r["week"], "array<array<array<int>>>").alias("week"), r["how"].alias("how"))


def owner_hours(text: str | None) -> Week | None:
    """An owner's posted hours, where they read cleanly."""
    week = from_text(f"Hours: {text}") if text else None
    return week if valid(week) else None


def _said(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if (w := owner_hours(t)) is None else said(w))


def owner_hours_column(text: Column) -> Column:
    """The week of an owner's posted hours as text; null where they do not read cleanly."""
    return F.pandas_udf(_said, "string")(text)
