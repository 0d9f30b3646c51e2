"""Hours parsers, one case for each branch of their rules."""

import json

import pytest
from pyspark.sql import functions as F

from locus.functions import hours as H


def block(value):
    return f'<script type="application/ld+json">{json.dumps(value)}</script>'


def week(**days):
    return [days.get(d[:3], []) for d in H.DAYS]


def test_structured_rows():
    rows = [
        {"dayOfWeek": ["Wednesday", "http://schema.org/Thursday"], "opens": "06:15", "closes": "10:45"},
        {"dayOfWeek": "Sunday", "opens": "18:00", "closes": "03:30"},
        {"dayOfWeek": "Monday", "opens": "01:00", "closes": "05:00", "validThrough": "2027-01-02"},
        {"dayOfWeek": "Tuesday", "opens": "09:00", "closes": "09:20"},
    ]
    got = H.parse(block([{"name": "x"}, {"inner": {"openingHoursSpecification": rows}}]))
    assert got == (week(wed=[(375, 645)], thu=[(375, 645)], sun=[(1080, 1650)]), "jsonld")
    assert H.parse(block({"openingHoursSpecification": rows[:1]})) == (None, None)  # two open days are too few


def test_structured_strings():
    got = H.parse(block({"openingHours": ["Fr,Sa 16:00-23:59", "Sa-Mo 08:00-12:30"]}))
    assert got[0] == week(mon=[(480, 750)], fri=[(960, 1439)], sat=[(480, 750), (960, 1439)], sun=[(480, 750)])
    assert H.from_schema(["by appointment"]) is None
    assert H.parse("<script type='application/ld+json'>{broken</script>") == (None, None)


def test_microdata_in_either_order():
    got = H.parse('<meta content="Th-Sa 13:00-19:00" itemprop="openingHours"><span itemprop="openingHours" content="Su 13:00-16:00"></span>')
    assert got == (week(thu=[(780, 1140)], fri=[(780, 1140)], sat=[(780, 1140)], sun=[(780, 960)]), "microdata")


def test_embedded_schedules():
    def schedule(start):
        return "window.data = " + json.dumps({"schedule": [{"days": ["friday", "saturday", "sunday"], "intervals": [{"startTime": start, "endTime": "23:15:00"}, None]}]}) + ";"

    assert H.parse(schedule("17:45:00"))[0] == week(fri=[(1065, 1395)], sat=[(1065, 1395)], sun=[(1065, 1395)])
    assert H.parse(schedule("17:45:00") * 2)[1] == "schedule"
    assert H.parse(schedule("17:45:00") + schedule("16:00:00")) == (None, None)


@pytest.mark.parametrize(
    ("opens", "closes", "want"),
    [
        ("7", "3", (420, 900)),  # a smaller close is the afternoon's
        ("4", "9:30", (960, 1290)),  # an unmarked open from 1 to 6 is the afternoon's
        ("12", "7", (720, 1140)),
        ("10am", "12", (600, 1440)),  # an unmarked 12 closes at midnight
        ("8pm", "2am", (1200, 1560)),
        ("09:00", "17:30", (540, 1050)),  # a leading zero: 24 hours
        ("18", "23", (1080, 1380)),
        ("noon", "midnight", (720, 1440)),
        ("9am", "9:30am", None),  # under an hour
        ("6am", "5am", None),  # over twenty hours
        ("10pm", "6:30am", None),  # past six in the morning
        ("8", "half past", None),
    ],
)
def test_spans(opens, closes, want):
    assert H.span(opens, closes) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Our hours Wed to Fri 7am - 1pm; Saturday 8am - noon", "Mon–Tue Closed · Wed–Fri 7am–1pm · Sat 8am–12pm · Sun Closed"),
        ("Opening hours: 6am - 2pm (Mon - Wed) 4pm - 8pm (Thu)", "Mon–Wed 6am–2pm · Thu 4pm–8pm · Fri–Sun Closed"),
        ("Open every day 7:15 a.m. until 3:45 p.m.", "Mon–Sun 7:15am–3:45pm"),
        ("Open 7 days a week 4-10", "Mon–Sun 4pm–10pm"),
        ("Hours Thu Fri Sat 9-1 10-2 11-3", "Mon–Wed Closed · Thu 9am–1pm · Fri 10am–2pm · Sat 11am–3pm · Sun Closed"),
        ("Hours: Mon-Sat 8am-4pm, closed Wednesdays", "Mon–Tue 8am–4pm · Wed Closed · Thu–Sat 8am–4pm · Sun Closed"),
        ("Hours: Mon-Wed 8am-11am Mon-Wed 10am-1pm", "Mon–Wed 8am–1pm · Thu–Sun Closed"),
        ("Hours Mon-Wed 8am-1pm holiday Thu-Sun 8am-1pm", "Mon–Wed 8am–1pm · Thu–Sun Closed"),
        ("Sat-Mon 20:00-01:30", "Mon 8pm–1:30am · Tue–Fri Closed · Sat–Sun 8pm–1:30am"),
        ("Happy hour Sun-Sat 4-6", None),
        ("Hours: Tue 9am-5pm", None),
        ("Open: Mon-Fri 5am-5:30am", None),
        ("Hours by chance; call 555 0134", None),
    ],
)
def test_text(text, want):
    found = H.from_text(text)
    assert (found and H.said(found)) == want


def test_hand_lines():
    assert H.from_hand("Sat-Tue 7am-11am; Thu & Fri 6pm-12:30am, noon-2pm") == week(mon=[(420, 660)], tue=[(420, 660)], thu=[(720, 840), (1080, 1470)], fri=[(720, 840), (1080, 1470)], sat=[(420, 660)], sun=[(420, 660)])
    for doubtful in ("Sat 7-11", "weekends 7am-11am", "Sat", "Sat 7am-11am-2pm", "Sat 7am-7:10am", ""):
        assert H.from_hand(doubtful) is None


def test_owner_hours():
    assert H.said(H.owner_hours("Wed-Sun 3pm-9pm")) == "Mon–Tue Closed · Wed–Sun 3pm–9pm"
    assert H.owner_hours("see the door") is None and H.owner_hours(None) is None


def test_valid_and_merged():
    assert H.merged([[(60, 120), (120, 200), (300, 400), (60, 120)]] + [[]] * 6)[0] == [(60, 200), (300, 400)]
    assert not H.valid([[(0, 100)]] * 2 + [[]] * 5) and not H.valid([[(10, 1900)]] * 7) and not H.valid(None)
    assert H.day_range(5, 1) == [5, 6, 0, 1]


def test_column(spark):
    df = spark.createDataFrame([(1, "<p>Open daily 9am-1pm</p>"), (2, None), (3, "<script>Open daily 9am-1pm</script>")], "id int, html string")
    out = {r.id: r.h for r in df.select("id", H.week_column(F.col("html")).alias("h")).collect()}
    assert (out[1].how, out[1].week) == ("text", [[[540, 780]]] * 7) and out[2].week is None and out[3].how is None
