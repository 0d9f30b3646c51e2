"""Extraction, readers, vendor cards and closure fusion, one case for each branch of their rules."""

import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from locus.functions import extract as E
from locus.functions import vendors as V
from locus.operators import closures as C
from locus.sources import readers as R
from locus.sources.adapters import written

BASE = dt.date(2031, 5, 10)


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Come to 88 Lakeview Terrace, Boise, ID 83702-0011!", ["88 Lakeview Terrace, Boise, ID 83702"]),
        ("501 SE Granite Hill Pkwy Unit 9 Salt Lake City Utah", ["501 SE Granite Hill Pkwy Unit 9, Salt Lake City, UT"]),
        ("6B Ferry Row #12,\nSanta Fe,\nNew Mexico 87501", ["6B Ferry Row #12, Santa Fe, NM 87501"]),
        ("14 9th Ave N, Fargo, ND and again 14 9th Avenue N, Fargo, ND", ["14 9th Ave N, Fargo, ND"]),
        ("Bowl 12 Dollar Way", []),  # no city and state
        ("$44 Winter Lane, Reno, NV", []),  # a price is no house number
        ("3 dark lane, Reno, NV", []),  # streets are capitalized
        ("77 Mill Rd, Utica, Ontario", []),
    ],
)
def test_addresses(text, want):
    assert [E.one_line(a) for a in E.addresses(text)] == want


def test_soon_is_said_of_the_nearest_address():
    near = "2 Ash Way, Ely, NV 89301 . . . . opening soon . . . . 4 Ash Way, Ely, NV 89302"
    assert [a["soon"] for a in E.addresses(near)] == [False, True]  # a tie goes to the address after
    far = "2 Ash Way, Ely, NV 89301" + " x" * 90 + " coming soon"
    assert [a["soon"] for a in E.addresses(far)] == [False]


def test_locations_and_links(spark):
    page = '<title>Fern Room – menus</title><p>9 Depot Plaza, Bend, OR 97701</p><a href="../map?ll=44.0581,-121.3153&z=9">Where</a><a>none</a>'
    assert E.page_title(page) == "Fern Room" and E.page_title('<meta property="og:title" content="Two · x">') == "Two"
    df = spark.createDataFrame([(1, "https://fern.example/a/b/", page), (2, "https://fern.example", None)], "id int, url string, html string")
    (row,) = E.location_rows(df, "id", "html").collect()
    assert (row.id, row.street, row.city, row.state, row.zip, row.soon, row.pin_lat, row.pin_lon) == (1, "9 Depot Plaza", "Bend", "OR", "97701", False, 44.0581, -121.3153)
    links = E.link_rows(df, "id", "url", "html").orderBy("pos").collect()
    assert [(r.href, r.label) for r in links] == [("https://fern.example/a/map?ll=44.0581,-121.3153&z=9", "Where"), ("https://fern.example/a/b/", "none")]


def test_structured_addresses_come_first():
    item = {"@type": "Cafe", "address": {"streetAddress": "70 Union Sq", "addressLocality": "Lynn", "addressRegion": "Massachusetts", "postalCode": "01901-2"}, "geo": {"latitude": 42.4, "longitude": -70.9}}
    abroad = {"address": {"streetAddress": "1 Rue X", "addressLocality": "Lyon", "postalCode": "69001"}}
    found = E.locations(f'<script type="application/ld+json">{json.dumps([abroad, {"a": [item]}])}</script><p>70 Union Sq, Lynn, MA 01901</p><p>5 Pier Walk, Hull, MA 02045</p>')
    assert [(a["street"], a["state"], a["zip"]) for a in found] == [("70 Union Sq", "MA", "01901"), ("5 Pier Walk", "MA", "02045")]
    assert found[0]["lat"] == 42.4 and E.map_pins("!3d95.1234!4d10.1234 q=1.5,2.5 @12.3456,-77.1234,9z") == [(12.3456, -77.1234)]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("away June 3rd to July 2nd", ((2031, 6, 3), (2031, 7, 2))),
        ("Aug 14", ((2031, 8, 14),) * 2),
        ("Sept 1–4", ((2031, 9, 1), (2031, 9, 4))),
        ("5/30 through 6/2", ((2031, 5, 30), (2031, 6, 2))),
        ("Dec 30 - Jan 3", ((2031, 12, 30), (2032, 1, 3))),
        ("Feb 2", ((2032, 2, 2),) * 2),  # over sixty days past: next year's
        ("Apr 20", ((2031, 4, 20),) * 2),
        ("13/40", None),
        ("until further notice", None),
    ],
)
def test_closed_range(text, want):
    assert E.closed_range(text, BASE) == (want and tuple(dt.date(*x) for x in want))


def test_updates():
    page = "<h3>News and updates</h3><p>ahead of them</p><p>Hours - from 9am</p><p>Special: plum tart www.x.example/y &lt;new&gt;</p><p>thanks</p><p>Note: not read</p><h3>x</h3>"
    assert E.update_lines(page) == [("hours", "from 9am"), ("special", "plum tart www.x.example/y <new>")]
    assert E.update_lines("<p>Note: alone</p>") == [] and E.update_lines("<p>Note: alone</p>" * 9, whole_page=True) == [("note", "alone")] * 8
    assert E.limited("plum tart www.x.example/y <new>\x07") == "plum tart new" and len(E.limited("ab " * 99)) <= 120


def test_notices(spark):
    pages = [
        "<head><style>" + "a{}" * 3000 + "</style></head><p>Sadly we have officially closed.</p>",  # the head is not text
        "<p>Permanently closed while we renovate</p>" + "<p>word</p>" * 60 + "<p>Our branch closed for good.</p>",  # each notice is judged alone
        "<p>We have closed for the day</p>",
        "<script>permanently closed</script><p>Website suspended</p>",
        "<p>" + "x " * 3000 + "closed for good</p>",  # too far down
        None,
    ]
    out = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, h string").select("i", E.notices(F.col("h")).alias("n")).orderBy("i").collect()
    assert [(r.n.closed, r.n.parked) for r in out] == [(True, False), (True, False), (False, False), (False, True), (False, False), (False, False)]
    assert E.has_code('<meta name="Own-Check" content=" KX-9 ">', "kx-9", "own-check") and not E.has_code("<script>kx-9</script>", "kx-9", "own-check")


def test_vendors():
    says = re.compile("(?<![a-z])ramen", re.I)
    flat = "<h4>Tide Pool</h4><div>Ramen by the sea</div><h4>Bread</h4><div>Loaves</div>"
    assert V.vendors(flat, "Pier Hall", says) == [("Tide Pool", "Tide Pool Ramen by the sea")]
    cards = "<section><div><h2>Pier Hall</h2></div><div><h3>MOSS — “broths”</h3><p>ramen</p></div><div><h3>Moss</h3><p>ramen again</p></div><div><h3>Vendors</h3><p>ramen</p></div><div><span class='item-title'>Late One</span><p>ramen, now closed</p></div></section>"
    assert [n for n, _ in V.vendors(cards, "Pier Hall", says)] == ["Moss"]
    lines = "<p>Gale Ramen</p><p>A counter of eight seats on the quay</p><p>11am - 2pm</p><p>Salt Room</p><p>Open Mon</p><p>Smoked fish, and ramen in the winter months</p>"
    assert V.vendors(lines, "Pier Hall", says) == [("Gale Ramen", "A counter of eight seats on the quay"), ("Salt Room", "Smoked fish, and ramen in the winter months")]
    assert V.vendor_page("<nav>x</nav><h1>REED BAR</h1><p>House ramen</p>", "Pier Hall", says) == ("Reed Bar", "REED BAR House ramen")
    assert V.vendor_page("<h1>Reed Bar</h1><p>Ramen, opening soon</p>", "Pier Hall", says) is None and V.vendor_page("<p>ramen</p>", "Pier Hall", says) is None


def test_lists(spark, tmp_path):
    (tmp_path / "l.txt").write_text("Quay | 1.5, 2.5 | site\n#all\n  lone  # why\n\na|b|c|d\n")
    rows = R.listed(spark, str(tmp_path / "l.txt"), ["name", "spot", "site"], least=2).orderBy("seq").collect()
    assert [(r.name, r.spot, r.site, r.ok) for r in rows] == [("Quay", "1.5, 2.5", "site", True), ("lone", None, None, False), ("a", "b", "c", True)]
    spots = spark.createDataFrame([("1.5, 2.5",), ("1.5",), (None,)], "s string").select(R.spot(F.col("s")).alias("p")).collect()
    assert (spots[0].p.lat, spots[0].p.lon) == (1.5, 2.5) and spots[1].p is None and spots[2].p is None


def test_features_and_elements(spark, tmp_path):
    def feature(kind, coordinates, **properties):
        return json.dumps({"geometry": {"type": kind, "coordinates": coordinates}, "properties": properties})

    square = [[1, 1], [5, 1], [5, 9], [1, 9], [1, 1]]
    lines = [feature("Point", [3.5, 7.5], **{"@type": "node", "@id": 8, "name": "P", "drop": "me"}), "{oops", "\x1e" + feature("MultiPolygon", [[square]], **{"@type": "area", "@id": 31, "name": ""})]
    (tmp_path / "g.txt").write_text("\n".join(lines))
    got = R.geojson_sequence(spark, str(tmp_path / "g.txt"), ["name"]).orderBy("id").collect()
    assert [(r.type, r.id, r.lat, r.lon, r.tags) for r in got] == [("node", 8, 7.5, 3.5, {"name": "P"}), ("relation", 15, 5.0, 3.0, {})]
    (tmp_path / "e.json").write_text(json.dumps({"elements": [{"type": "way", "id": 4, "center": {"lat": 6.5, "lon": 1.5}, "tags": {"name": "W", "z": "1"}}, {"type": "node", "id": 3, "lat": 1.0, "lon": 1.0, "tags": {"z": "1"}}]}))
    assert [(r.type, r.id, r.lat, r.lon, r.tags) for r in R.elements(spark, str(tmp_path / "e.json"), ["name"]).collect()] == [("way", 4, 6.5, 1.5, {"name": "W"})]
    paths = spark.createDataFrame([("x/dt=2030-02-01/a",), ("x/dt=2030-11-09/b",), ("x/dt=soon",)], "p string")
    assert R.latest_release(paths, "p").first().release == "2030-11-09"
    with pytest.raises(ValueError):
        R.gate(13, 20)
    R.gate(14, 20)


def test_category_text_needs_a_column(spark):
    df = spark.createDataFrame([("A b", ("T", ["U"]))], "basic_category string, taxonomy struct<primary: string, alternates: array<string>>")
    assert df.select(R.category_text(df).alias("c")).first().c == "t u a b"
    with pytest.raises(ValueError):
        R.category_text(df.select(F.lit(1).alias("x")))
    assert R.state(spark, "/no/such/table", "id int").count() == 0


@pytest.fixture(scope="module")
def listed(spark):
    rows = [(1, "Alder", 10.51, 20.11, "https://www.alder.example/x", "3 Low Rd, Hay, KS"), (2, "Briar", 10.62, 20.22, "briar.example", "4 Low Rd, Hay, KS"), (3, "Cedar Room", 10.73, 20.33, None, "5 Low Rd, Ost, NE"), (4, "Dune", 10.84, 20.44, "dune.example", None)]
    return C.listing(spark.createDataFrame(rows, "id int, name string, lat double, lon double, website string, address string"))


def fused(spark, listed, opens=(), **given):
    def entries(name):
        return spark.createDataFrame([tuple(e.get(x) for x in ("k", "h", "n", "la", "lo", "why", "t")) for e in given.get(name, [])], C.ENTRY)

    parts = [entries(x) for x in ("manual", "several", "reports")]
    rest = [entries(x) for x in ("automatic", "site", "confirmed")]
    hidden, warned = C.fuse(listed, *parts, spark.createDataFrame(list(opens), "k string, last date"), *rest, BASE, written)
    return sorted((r.n or r.h or r.k, r.why) for r in hidden.collect()), sorted((r.h or r.k, r.why) for r in warned.collect())


def test_keys(listed):
    assert [r.k for r in listed.orderBy("id").collect()] == ["alder.example@10.51,20.11", "briar.example@10.62,20.22", "cedar-room@10.73,20.33", "dune.example@10.84,20.44"]


GONE = {"n": "briar", "la": 10.6201, "lo": 20.2201, "why": "second"}


def test_a_visit_beats_an_automatic_signal(spark, listed):
    key = "briar.example@10.62,20.22"
    assert fused(spark, listed, automatic=[GONE], opens=[(key, BASE - dt.timedelta(120))]) == ([], [])
    assert fused(spark, listed, automatic=[GONE], opens=[(key, BASE - dt.timedelta(121))]) == ([("briar", "second")], [])
    assert fused(spark, listed, several=[{"k": key, "why": "reports"}], opens=[(key, BASE)]) == ([(key, "reports")], [])


def test_two_kinds_of_warnings_hide(spark, listed):
    site = [{"h": "dune.example", "why": "site-down"}, {"h": "alder.example", "why": "site-dns"}, {"h": "alder.example", "why": "site-parked"}]
    hidden, warned = fused(spark, listed, reports=[{"k": "dune.example@10.84,20.44", "why": "report"}], site=site)
    assert hidden == [("Dune", "signals")] and len(warned) == 4


def test_confirmed_places_lose_weak_entries(spark, listed):
    given = {"automatic": [GONE], "site": [{"h": "briar.example", "why": "site-dns"}], "manual": [{"h": "briar.example", "why": "manual"}]}
    for sure in ({"h": "briar.example"}, {"k": "briar.example@10.62,20.22"}, {"n": "Briar", "la": 10.62, "lo": 20.22}):
        assert fused(spark, listed, confirmed=[sure], **given) == ([("briar.example", "manual")], [])
    assert fused(spark, listed, confirmed=[{"h": "alder.example"}], **given)[1] == [("briar.example", "site-dns")]


def test_labels_and_matches(spark, listed):
    e = spark.createDataFrame([(1, None, "alder.example", None, None, None), (2, None, None, "Cedar room ", 10.7301, 20.3301), (3, None, None, "Cedar Room", 10.74, 20.33)], "eid long, k string, h string, n string, la double, lo double")
    assert {(r.eid, r.id) for r in C.matches(e, listed).collect()} == {(1, 1), (2, 3)}
    assert {r.eid: r.label for r in C.labels(e, listed).collect()} == {1: "Alder, Hay, KS", 2: "Cedar Room, Ost, NE"}


def test_trouble_and_missing_stores(spark, listed):
    days = lambda n: (BASE - dt.timedelta(n), BASE)
    health = spark.createDataFrame([("alder.example", "parked", *days(6), 2), ("briar.example", "parked", *days(5), 9), ("dune.example", "down", *days(14), 3), ("far.example", "dns", *days(99), 9)], "host string, bad string, first date, last date, n int")
    assert sorted((r.h, r.why) for r in C.site_trouble(health, listed).collect()) == [("alder.example", "site-parked"), ("dune.example", "site-down")]
    schema = "id int, chain string, state string, house string, city string, words array<string>"
    rows = [(i, "m", "KS", f"{i}", "hay", [f"s{i}"]) for i in range(4)] + [(9, "n", "KS", "1", "hay", ["x"])]
    stores = [("m", "KS", "0", "z", ["z"]), ("m", "KS", "1", "z", ["z"]), ("m", "KS", "99", "hay", ["s2"]), ("n", "NE", "1", "hay", ["x"])]
    out = C.missing_stores(spark.createDataFrame(rows, schema), spark.createDataFrame(stores, schema.split(", ", 1)[1]))
    assert [r.id for r in out.collect()] == [3]  # a quarter of m is missing; all of n, which is too much to believe
