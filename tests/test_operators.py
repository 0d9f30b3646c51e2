"""Operators on rows of our own."""

import random

import pytest
from pyspark.sql import functions as F

from locus.functions import text as T
from locus.functions import urls as U
from locus.functions.geo import grid_join, haversine
from locus.operators.match import greedy_dedupe
from locus.operators.windows import equal_runs, keep_last_good, last_write, longest_run, merged_spans
from locus.streaming.counters import suppress_repeats


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("url", "host", "page"),
    [
        ("https://www.Example.com/Menu/", "example.com", "example.com/menu"),
        ("example.com", "example.com", None),
        (" http://a.b.co.uk/x.pdf", "a.b.co.uk", None),
        ("https://a.com/x?y=1", "a.com", "a.com/x"),
        (None, "", None),
        ("", "", None),
        ("https://bad url/", "", None),
    ],
)
def test_urls(spark, url, host, page):
    assert one(spark, url, U.host_of) == host
    assert one(spark, url, U.page_key) == page


def test_registrable(spark):
    assert [one(spark, x, U.registrable) for x in ("*.kaiyo.com", "a.b.co.uk", "x.y.z.org", "solo")] == ["kaiyo.com", "b.co.uk", "z.org", "solo"]


def test_clean_query(spark):
    def clean(x):
        return one(spark, x, lambda c: U.clean_query(c, ("utm_", "rwg_token")))

    assert clean("https://a.com/p?utm_source=x&b=1&RWG_TOKEN=2&c=") == "https://a.com/p?b=1&c="
    assert clean("https://a.com/p?utm_source=x") == "https://a.com/p"
    assert clean("https://a.com/p") == "https://a.com/p"


def test_address_variants(spark):
    got = one(spark, "http://www.a.com/m?x=1", U.address_variants)
    assert got == ["http://www.a.com/m?x=1", "https://www.a.com/m?x=1", "https://a.com/m?x=1", "http://a.com/m?x=1"]


def test_lines(spark):
    assert one(spark, "Tonkotsu $12\n  a\nMiso   ramen    spicy • Shoyu\xa0 bowl\n" + "x" * 161, T.lines) == ["Tonkotsu $12", "Miso", "ramen", "spicy", "Shoyu bowl"]
    assert one(spark, "Spicy Miso $12.50 (ラーメン) 12.50!", T.line_key) == "spicy miso ラーメン"


def test_nick_and_code(spark):
    assert one(spark, "B00bies!!", T.nick_key) == "bobies"
    assert len(one(spark, "a.com", lambda c: T.claim_code(c, "s:", "ab-"))) == 9


def test_haversine(spark):
    d = spark.range(1).select(haversine(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)).alias("d")).first()["d"]
    assert abs(d - 111194.93) < 0.1


@pytest.mark.parametrize("within", [150, 2500])
def test_grid_join_is_a_distance_join(spark, within):
    rng = random.Random(within)
    a = [(i, rng.choice([0.0, 45.0, -45.0, 70.0]) + rng.uniform(-0.03, 0.03), rng.uniform(-0.05, 0.05)) for i in range(150)]
    df = spark.createDataFrame(a, "id int, lat double, lon double")
    b = df.select(F.col("id").alias("bid"), F.col("lat").alias("blat"), F.col("lon").alias("blon"))
    near = haversine(F.col("lat"), F.col("lon"), F.col("blat"), F.col("blon")) <= within
    want = {tuple(r) for r in df.crossJoin(b).where(near).select("id", "bid").collect()}
    got = [tuple(r) for r in grid_join(df, b, within).select("id", "bid").collect()]
    assert set(got) == want and len(got) == len(want) > 150


def test_greedy_dedupe_follows_order(spark, tmp_path):
    rng = random.Random(5)
    links = sorted({tuple(sorted(rng.sample(range(80), 2))) for _ in range(90)})
    kept: list[int] = []
    for i in range(80):
        if not any((k, i) in set(links) for k in kept):
            kept.append(i)
    number = iter(range(10_000))

    def write(df):
        path = f"{tmp_path}/{next(number)}"
        df.write.parquet(path)
        return spark.read.parquet(path)

    rows = spark.range(80).select("id", F.col("id").alias("seq"))
    out = greedy_dedupe(rows, spark.createDataFrame(links, "a long, b long"), write)
    assert sorted(r.id for r in out.collect()) == kept


def test_windows(spark):
    s = spark.createDataFrame([(1, 0, 10), (1, 10, 20), (1, 5, 6), (1, 21, 22), (2, 3, 4), (2, 3, 4)], "k int, o int, c int")
    assert sorted(map(tuple, merged_spans(s, ["k"], "o", "c").collect())) == [(1, 0, 20), (1, 21, 22), (2, 3, 4)]
    w = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (1, 4), (2, 9)], "k int, week int")
    assert sorted(map(tuple, longest_run(w, "k", "week").collect())) == [(1, 2), (2, 1)]
    d = spark.createDataFrame([(1, 0, "a"), (1, 1, "a"), (1, 3, "a"), (1, 4, None), (1, 5, None)], "k int, d int, v string")
    assert sorted(map(str, map(tuple, equal_runs(d, ["k"], "d", "v").collect()))) == sorted(map(str, [(1, 0, 1, "a"), (1, 3, 3, "a"), (1, 4, 5, None)]))
    u = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (2, 1, None)], "k int, seq int, v string")
    assert sorted(map(tuple, last_write(u, ["k"], "seq").select("k", "v").collect())) == [(1, "y"), (2, None)]
    new, old = spark.createDataFrame([(1, "n")], "k int, v string"), spark.createDataFrame([(1, "o", 1), (2, "o", 60), (3, "o", 61)], "k int, v string, age int")
    assert sorted(map(tuple, keep_last_good(new, old, "k", "v", "age", 60).collect()), key=lambda r: r[0]) == [(1, "n", "new"), (2, "o", "kept"), (3, None, "gone")]


def test_suppression_counts_from_kept(spark):
    rows = [("a", t, i) for i, t in enumerate([0, 20, 40, 55, 61, 100])] + [("b", 5, 9)]
    out = suppress_repeats(spark.createDataFrame(rows, "who string, t long, seq long"), ["who"], "t", "seq", 30)
    assert sorted((r.who, r.t) for r in out.collect()) == [("a", 0), ("a", 40), ("a", 100), ("b", 5)]


def chain_of_links(spark, n):
    rows = spark.range(n).select("id", F.col("id").alias("seq"))
    return rows, rows.where(f"id < {n - 1}").select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))


def test_greedy_dedupe_finishes_or_raises(spark):
    """A chain of neighbours keeps every other row; too few rounds are an error, no silent answer."""
    from locus.sources.adapters import written

    rows, links = chain_of_links(spark, 20)
    assert sorted(r.id for r in greedy_dedupe(rows, links, written, most_rounds=12).collect()) == list(range(0, 20, 2))
    with pytest.raises(RuntimeError):
        greedy_dedupe(rows, links, written, most_rounds=4)


def test_stream_drops_late_events_and_frees_state(spark, tmp_path):
    """With files read one after another: an event behind the watermark is not counted, one within it is."""
    from locus.streaming import counters

    batches = [[("2026-03-01 08:00:00", 1), ("2026-03-01 09:00:00", 1)], [("2026-03-20 08:00:00", 1)], [("2026-03-20 09:00:00", 1)], [("2026-03-21 00:00:00", 1), ("2026-03-01 10:00:00", 1), ("2026-03-18 10:00:00", 1)]]
    for i, rows in enumerate(batches):
        df = spark.createDataFrame([(t, '{"k": %d}' % k, "view") for t, k in rows], "t string, props string, event_type string")
        df.select(F.col("t").cast("timestamp_ntz").alias("ts"), "props", "event_type").coalesce(1).write.parquet(f"{tmp_path}/{i}")
    stream = spark.readStream.schema("ts timestamp_ntz, props string, event_type string").option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(f"{tmp_path}/*")
    out = {str(r.day): r.n for r in counters.fold(spark, counters.day_counts(stream, "3 days")).collect()}
    assert out == {"2026-03-01": 2, "2026-03-18": 1, "2026-03-20": 2, "2026-03-21": 1}


def test_deny_list_and_details_are_null_safe(spark):
    from locus.operators import listings as L

    places = spark.createDataFrame([(None, None), ("Fir  Bar", None), ("fir bar", "1 A St, Ost"), ("Hay Barn", "x"), ("Hay Barn Kitchen", "x")], "name string, address string")
    listed = spark.createDataFrame([("fir bar", "ost")], "name string, place string")
    out = {(r.name, r.address) for r in L.denied(places, listed, "barn", "kitchen").collect() if r.denied}
    assert out == {("fir bar", "1 A St, Ost"), ("Hay Barn", "x")}
    spots = spark.createDataFrame([(1, "Fir", 1.0, 2.0, None), (2, None, None, 2.0, "w")], "id int, name string, lat double, lon double, website string")
    fixes = spark.createDataFrame([("FIR", 1.0001, 1.9999, "Fir Bar", "")], "n string, la double, lo double, better string, site string")
    assert [tuple(r) for r in L.fixed_details(spots, fixes).orderBy("id").collect()] == [(1, "Fir Bar", None, True), (2, None, "w", False)]


def test_open_state_at_boundaries(spark):
    from locus.functions import dates as D

    spans = spark.createDataFrame([(1, 6, 1200, 1530), (2, 0, 600, 660), (3, 0, 100, 200), (4, 3, 60, 120), (5, 0, 615, 700)], "k int, dow int, o int, c int")
    at = lambda dow, minute: {r.k: (r.state, r.opens_in, r.opens) for r in D.open_state(spans, "k", F.struct(F.lit(dow).alias("dow"), F.lit(minute).alias("minute"))).collect()}
    assert at(0, 50) == {1: ("closes soon", None, None), 2: ("later", 0, 600), 3: ("later", 0, 100), 4: ("day", 3, 60), 5: ("later", 0, 615)}
    assert at(0, 615) == {1: ("day", 6, 1200), 2: ("closes soon", None, None), 3: ("day", 7, 100), 4: ("day", 3, 60), 5: ("open", None, None)}
    assert at(6, 90)[3] == ("tomorrow", 1, 100)


def test_menu_rules_on_edges(spark):
    from locus.operators import menus as M

    def verdict(lines, name=None):
        df = spark.createDataFrame([(1, name, i, x) for i, x in enumerate(lines)], "id int, name string, pos int, line string")
        r = M.classify(df, ["id"]).first()
        return r.kind, r.dishes, r.broths

    assert verdict(["Shio Ramen", "Miso Ramen"]) == ("serves", 2, 0)
    assert verdict(["Shio Ramen $9", "Seasonal Menu", "a", "b", "Miso soup $3", "Tea $2"]) == ("serves", 1, 0)
    assert verdict(["Seasonal Menu", "a", "b", "Shio Ramen $9", "Miso soup $3", "Tea $2"]) == ("none", 1, 0)
    assert verdict(["House ramen", "pick miso or chicken", "x"]) == ("serves", 1, 2)
    assert verdict(["RAMEN MENU", "Add egg $1", "Bowl five $9", "Tea $2", "Rice $2"]) == ("none", 0, 0)  # an option ends the section
    assert verdict(["Ramen " + "so good " * 14]) == ("none", 0, 0)
    assert verdict(["Ramen " + "so good " * 14 + "$9", "Tea $2", "Rice $2"]) == ("none", 1, 0)  # long lines name no dish
