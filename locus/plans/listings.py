"""Listing queries: scans, rules, lists, joins and orders on places: (Spark, DuckDB SQL) under each name."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import urls as U
from ..functions.geo import cell, grid_join, planar
from ..functions.text import all_words, folded
from ..operators import closures as C
from ..operators import listings as L
from ..sources import readers as R
from ..sources.adapters import HOST, METRES, PLACES, chosen, chosen_sql, others, places, shared_folder, table

#: Names that reach every arm of the rules; a place carries the one of its number.
_NAMES = ["Blue Lantern Ramen", "Riverside Stables", "Stables Sushi Kitchen", "Noodle Corner", "Udon Noodle Bar", "Kettle & Co", "Mazemen Lab", "Hoshino Table", "First Bank", "Plain Diner", "Café Olé", "Old Oak"]
_CATS = ["restaurant japanese", "horse farm", "sushi japanese", "noodle japanese", "noodle japanese", "restaurant", "noodle japanese", "restaurant japanese", "bank", "diner", "cafe", "ramen shop"]
_PRIMARY = [None, "", "japanese_restaurant"]
_BRANDS = ["Q1", None, "Q7", None, None]
_SITES = ["https://www.ramen-yard.example/", "http://plain.example", "", "https://order.platform.example/x", "https://noodles.co.uk/a"]
_WORDS = {"app": "(?<![a-z])(?:ramen|tonkotsu)", "category": "ramen", "food": "restaurant|noodle|sushi|cafe|diner", "extra": "(?<![a-z])(?:mazemen|tsukemen)", "chain": "(?<![a-z])hoshino(?![a-z])", "host": "ramen", "noodle": "(?<![a-z])noodles?(?![a-z])", "other": "udon|soba"}


def _sites(spark, d):
    i = F.col("c_custkey")
    return table(spark, d, "customer").select(i.alias("id"), chosen(i, _NAMES).alias("name"), chosen(i, _CATS).alias("category"), chosen(i, _PRIMARY).alias("primary"), chosen(i, _BRANDS).alias("brand_id"), chosen(i * 3, _SITES).alias("website"), F.concat((i % 90).cast("string"), F.lit(" Hill Rd, "), chosen(i, ["Salem", "Dover", "Troy"]), F.lit(", NY")).alias("address"))


_SITES_SQL = f"sites AS (SELECT c_custkey AS id, {chosen_sql('c_custkey', _NAMES)} AS name, {chosen_sql('c_custkey', _CATS)} AS category, {chosen_sql('c_custkey', _PRIMARY)} AS prim, {chosen_sql('c_custkey', _BRANDS)} AS brand_id, {chosen_sql('c_custkey * 3', _SITES)} AS website, CAST(c_custkey % 90 AS VARCHAR) || ' Hill Rd, ' || {chosen_sql('c_custkey', ['Salem', 'Dover', 'Troy'])} || ', NY' AS address FROM customer)"


def name_rules(spark, d):
    """Why each place belongs: the first rule of the cascade that holds."""
    s = _sites(spark, d)
    why = L.place_rule(F.col("name"), F.col("category"), F.array(U.host_of(F.col("website"))), F.col("brand_id"), F.lit(None).cast("string"), F.col("primary"), _WORDS, ["Q7"])
    return s.select("id", why.alias("why"))


NAME_RULES = f"""WITH {_SITES_SQL}, h AS (SELECT *, {HOST.replace('url', 'website')} AS host, regexp_matches(category, 'restaurant|noodle|sushi|cafe|diner') AS food FROM sites)
SELECT id, CASE WHEN regexp_matches(lower(name), '(^|[^a-z])(ramen|tonkotsu)') OR contains(category, 'ramen') THEN 'app' WHEN food AND (regexp_matches(lower(name), '(^|[^a-z])(mazemen|tsukemen)') OR regexp_matches(lower(name), '(^|[^a-z])hoshino([^a-z]|$)')) THEN 'name'
WHEN food AND coalesce(brand_id, '') = 'Q7' THEN 'brand' WHEN food AND contains(host, 'ramen') THEN 'site' WHEN food AND regexp_matches(lower(name), '(^|[^a-z])noodles?([^a-z]|$)') AND contains(CASE WHEN coalesce(prim, '') <> '' THEN prim ELSE category END, 'japanese') AND NOT regexp_matches(lower(name), 'udon|soba') THEN 'noodle' END AS why FROM h"""


def deny_list(spark, d):
    """Places that a list or their name excludes; every 17th is vouched for and stays."""
    listed = spark.createDataFrame([("plain diner", "dover"), ("old oak", None), ("kettle & co", "salem")], "name string, place string")
    out = L.denied(_sites(spark, d), listed, r"\b(stables?|bank|farm)\b", "sushi|kitchen|noodle")
    return out.select("id", "denied", (~F.col("denied") | (F.col("id") % 17 == 0)).alias("kept"))


DENY_LIST = rf"""WITH {_SITES_SQL}, x AS (SELECT id, (regexp_matches(lower(name), '\b(stables?|bank|farm)\b') AND NOT regexp_matches(lower(name), 'sushi|kitchen|noodle')) OR (lower(name) = 'plain diner' AND contains(lower(address), 'dover')) OR lower(name) = 'old oak' OR (lower(name) = 'kettle & co' AND contains(lower(address), 'salem')) AS denied FROM sites)
SELECT id, denied, NOT denied OR id % 17 = 0 AS kept FROM x"""


def own_hosts(spark, d):
    """Places' own hosts: blocked domains and shared platforms have none; opted-out domains are marked."""
    s = _sites(spark, d)
    h = U.host_of(F.col("website"))
    out = U.under(h, F.lit("noodles.co.uk")) | U.under(h, F.lit("nowhere.example"))
    return s.select("id", h.alias("host"), L.own_host(F.col("website"), ["platform"], ["plain.example", "yelp."]).alias("own"), out.alias("opted_out"))


OWN_HOSTS = f"WITH {_SITES_SQL}, h AS (SELECT id, {HOST.replace('url', 'website')} AS host FROM sites) SELECT id, host, CASE WHEN host <> '' AND host <> 'plain.example' AND NOT contains(host, '.plain.example') AND NOT contains(host, 'yelp.') AND NOT contains(host, 'platform') THEN host END AS own, host = 'noodles.co.uk' OR host LIKE '%.noodles.co.uk' AS opted_out FROM h"


def nested_scan(spark, d):
    """Canonical places of a nested table: list heads, box midpoints, category text of the columns there are, confidence and status."""
    i = F.col("c_custkey")
    lon, lat = -(F.lit(70.0) + i % 40), F.lit(25.0) + i % 24
    raw = table(spark, d, "customer").select(
        i.alias("id"), F.struct(F.concat(F.lit("N"), i.cast("string")).alias("primary")).alias("names"), F.struct((lon - 0.25).alias("xmin"), (lon + 0.25).alias("xmax"), (lat - 0.25).alias("ymin"), (lat + 0.25).alias("ymax")).alias("bbox"),
        F.struct(F.lower("c_mktsegment").alias("primary"), F.array(F.lit("Food"), F.lit("Late")).alias("alternate")).alias("categories"),
        F.when(i % 3 > 0, F.array(F.concat(F.lit("https://w"), (i % 7).cast("string"), F.lit(".example")))).otherwise(F.array().cast("array<string>")).alias("websites"),
        F.array(F.struct(F.when(i % 4 > 0, F.concat(i.cast("string"), F.lit(" Elm St"))).alias("freeform"), F.lit("Troy").alias("locality"), F.lit("NY").alias("region"))).alias("addresses"),
        F.when(i % 5 > 0, (i % 10) / F.lit(10.0)).alias("confidence"), F.when(i % 11 == 0, "permanently_closed").when(i % 7 == 0, "open").alias("operating_status"), F.struct(chosen(i, ["Q1", "Q2", None]).alias("wikidata")).alias("brand"),
    )
    kept = raw.where((F.size("websites") > 0) | F.array_contains("categories.alternate", "Late")).withColumn("known", F.coalesce(F.col("brand.wikidata").isin("Q1", "Q9"), F.lit(False)))
    placed = R.nested_places(kept, (-109.0, 25.0, -70.0, 48.0))
    return placed.join(kept.select(F.col("id").alias("kid"), "known"), F.col("id") == F.col("kid")).drop("kid")


NESTED_SCAN = """WITH r AS (SELECT c_custkey AS i, -(70.0::DOUBLE + c_custkey % 40) AS lon, 25.0::DOUBLE + c_custkey % 24 AS lat, c_mktsegment FROM customer)
SELECT i AS id, 'N' || CAST(i AS VARCHAR) AS name, lat, lon, CASE WHEN i % 4 > 0 THEN CAST(i AS VARCHAR) || ' Elm St, ' ELSE '' END || 'Troy, NY' AS address, CASE WHEN i % 3 > 0 THEN 'https://w' || CAST(i % 7 AS VARCHAR) || '.example' END AS website, lower(c_mktsegment) || ' food late' AS category, i % 3 = 0 AS known
FROM r WHERE CASE WHEN i % 5 > 0 THEN (i % 10) / 10.0 ELSE 1 END >= 0.35 AND i % 11 <> 0 AND lon - 0.25 BETWEEN -109 AND -70 AND lat - 0.25 BETWEEN 25 AND 48"""


def flat_scan(spark, d):
    """A flat source: not closed, without flags, fresh enough, filed or named, with a street; another cuisine's name needs the
    dish's word; a column that this release lacks counts as null."""
    i = F.col("s_suppkey")
    raw = table(spark, d, "supplier").select(i.alias("id"), chosen(i, _NAMES).alias("name"), F.when(i % 6 > 0, F.concat(i.cast("string"), F.lit(" Elm St"))).alias("address"), F.when(i % 13 == 0, F.lit("2020-01-01").cast("date")).alias("date_closed"), F.when(i % 4 > 0, F.date_sub(F.lit("2026-10-01").cast("date"), (i * 37 % 2000).cast("int"))).alias("date_refreshed"), F.when(i % 9 == 0, F.array(F.lit("dup"))).otherwise(F.array().cast("array<string>")).alias("unresolved_flags"), F.array(F.lit("Dining"), chosen(i, ["Ramen Restaurant", "Bar"])).alias("labels"))
    return R.flat_places(raw, F.lit("2026-10-01").cast("date"), "ramen", "(?<![a-z])(?:ramen|mazemen)", "udon|bank")


FLAT_SCAN = f"""WITH r AS (SELECT s_suppkey AS id, {chosen_sql('s_suppkey', _NAMES)} AS name, s_suppkey AS i FROM supplier)
SELECT id, name, CAST(i AS VARCHAR) || ' Elm St' AS address, CAST(NULL AS VARCHAR) AS website, i % 2 = 0 AS filed FROM r WHERE i % 13 <> 0 AND i % 9 <> 0 AND (i % 4 = 0 OR i * 37 % 2000 <= 1095) AND i % 6 > 0
AND (i % 2 = 0 OR regexp_matches(lower(name), '(^|[^a-z])(ramen|mazemen)')) AND (regexp_matches(lower(name), '(^|[^a-z])(ramen|mazemen)') OR NOT regexp_matches(lower(name), 'udon|bank'))"""


def geo_features(spark, d):
    """Features of a text sequence, one a line: points, areas at the mean of their ring, broken lines skipped; tags that are kept."""
    i = F.col("s_suppkey").cast("string")
    point = F.concat(F.lit('\x1e{"geometry":{"type":"Point","coordinates":[-80.5,'), i, F.lit('.25]},"properties":{"@type":"node","@id":"'), i, F.lit('","name":"A'), i, F.lit('","note":"x"}}'))
    area = F.concat(F.lit('{"geometry":{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,'), i, F.lit('],[0,'), i, F.lit('],[0,0]]]},"properties":{"@type":"area","@id":"'), i, F.lit('","name":"","cuisine":"noodle"}}'))
    path = shared_folder(spark)
    k = F.col("s_suppkey")
    table(spark, d, "supplier").select(F.when(k % 5 == 0, "{broken").when(k % 2 == 0, area).otherwise(point)).write.text(path)
    out = R.geojson_sequence(spark, path, ["name", "cuisine"])
    return out.select("type", "id", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), F.coalesce(F.try_element_at("tags", F.lit("name")), F.lit("-")).alias("name"), F.coalesce(F.try_element_at("tags", F.lit("cuisine")), F.lit("-")).alias("cuisine"))


GEO_FEATURES = """WITH s AS (SELECT s_suppkey AS k FROM supplier WHERE s_suppkey % 5 <> 0)
SELECT CASE WHEN k % 2 = 1 THEN 'node' ELSE 'way' END AS type, CASE WHEN k % 2 = 1 THEN k ELSE k // 2 END AS id, CASE WHEN k % 2 = 1 THEN k + 0.25::DOUBLE ELSE k / 2.0::DOUBLE END AS lat, CASE WHEN k % 2 = 1 THEN -80.5::DOUBLE ELSE 2.0 END AS lon, CASE WHEN k % 2 = 1 THEN 'A' || CAST(k AS VARCHAR) ELSE '-' END AS name, CASE WHEN k % 2 = 1 THEN '-' ELSE 'noodle' END AS cuisine FROM s"""


def tagged_places(spark, d):
    """Tagged places that serve the dish: of a dining kind, by cuisine or by a name in either language."""
    i = F.col("s_suppkey")
    tags = F.create_map(F.lit("amenity"), chosen(i, ["restaurant", "bank", "cafe"]), F.lit("cuisine"), chosen(i, ["ramen;sushi", "pizza"]), F.lit("name"), chosen(i, ["Ippon", "Ramen Bar", "Sacramento Grill", "Tori"]), F.lit("name:en"), chosen(i, ["", "", "", "", "Tori Ramen"]))
    return table(spark, d, "supplier").select(i.alias("id"), R.dish_place(tags, "ramen", "(?i)(?<![a-z])ramen").alias("serves"), F.size(F.map_filter(tags, lambda k, v: k.isin("name", "cuisine") & (v != ""))).alias("kept"))


TAGGED_PLACES = f"""WITH s AS (SELECT s_suppkey AS id, {chosen_sql('s_suppkey', ['restaurant', 'bank', 'cafe'])} AS amenity, {chosen_sql('s_suppkey', ['ramen;sushi', 'pizza'])} AS cuisine, {chosen_sql('s_suppkey', ['Ippon', 'Ramen Bar', 'Sacramento Grill', 'Tori'])} AS name, {chosen_sql('s_suppkey', ['', '', '', '', 'Tori Ramen'])} AS en FROM supplier)
SELECT id, amenity <> 'bank' AND (contains(cuisine, 'ramen') OR regexp_matches(lower(name || ' ' || en), '(^|[^a-z])ramen')) AS serves, 2 AS kept FROM s"""

_LINES = ["Oak Grill | 40.5, -80.25", "closed.example  # gone", "# only a comment", "no such line here", "Elm Bar | 1 Elm St, Troy, NY 12180 | elm.example | 41.5, -73.5", "Fir Cafe | Somewhere", "www.Pine.example | Pine", "Ash | 40.25, -80.5 | 9 Ash Rd, Troy, NY | 40.5, -80.5", "Yew | x, y | 9 Ash Rd", "Bay | 42.5, -71.5 | Bay Two | bay.example", "Ivy | 42.5, -71.5 | Mo-Fr 11:00-14:00"]
_FORMATS = ["closed", "closed", "deny", "closed", "vouched", "vouched", "add", "fix", "fix", "details", "tags"]


def hand_lists(spark, d):
    """Hand-kept lists: each format's own columns; comments away, malformed lines marked."""
    i = F.col("s_suppkey")
    raw = table(spark, d, "supplier").select(i.alias("id"), chosen(i, _FORMATS).alias("format"), chosen(i, _LINES).alias("value"))
    return R.hand_list(raw, "value", "format").select("id", "format", "ok", "name", "host", "lat", "lon", "text")


_L = "CASE id % 11 "
HAND_LISTS = f"""WITH s AS (SELECT s_suppkey AS id, {chosen_sql('s_suppkey', _FORMATS)} AS format FROM supplier WHERE s_suppkey % 11 <> 2)
SELECT id, format, id % 11 NOT IN (3, 5, 8) AS ok, {_L}WHEN 0 THEN 'Oak Grill' WHEN 4 THEN 'Elm Bar' WHEN 6 THEN 'Pine' WHEN 7 THEN 'Ash' WHEN 9 THEN 'Bay' WHEN 10 THEN 'Ivy' END AS name, {_L}WHEN 1 THEN 'closed.example' WHEN 4 THEN 'elm.example' WHEN 6 THEN 'pine.example' WHEN 9 THEN 'bay.example' END AS host,
{_L}WHEN 0 THEN 40.5::DOUBLE WHEN 4 THEN 41.5 WHEN 7 THEN 40.25 WHEN 9 THEN 42.5 WHEN 10 THEN 42.5 END AS lat, {_L}WHEN 0 THEN -80.25::DOUBLE WHEN 4 THEN -73.5 WHEN 7 THEN -80.5 WHEN 9 THEN -71.5 WHEN 10 THEN -71.5 END AS lon,
{_L}WHEN 4 THEN '1 Elm St, Troy, NY 12180' WHEN 7 THEN '9 Ash Rd, Troy, NY' WHEN 9 THEN 'Bay Two' WHEN 10 THEN 'Mo-Fr 11:00-14:00' END AS text FROM s"""


def json_config(spark, d):
    """A JSON configuration of chains, one row a chain; ones without a page take the default."""
    text = '{"chains": [{"name": "A", "pages": ["a1", "a2"], "skip": true}, {"name": "B", "pages": []}, {"name": "C"}]}'
    path = shared_folder(spark)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    c = R.json_config(spark, path, "chains array<struct<name: string, pages: array<string>, skip: boolean>>", "chains")
    n = table(spark, d, "nation").select(chosen(F.col("n_nationkey"), ["A", "B", "C", "D"]).alias("chain"))
    return n.join(F.broadcast(c), F.col("chain") == F.col("name"), "left").groupBy("chain").agg(F.count(F.lit(1)).alias("n"), F.max(F.coalesce(F.size("pages"), F.lit(0))).alias("pages"), F.bool_or(F.coalesce("skip", F.lit(False))).alias("skipped"))


JSON_CONFIG = f"SELECT {chosen_sql('n_nationkey', ['A', 'B', 'C', 'D'])} AS chain, count(*) AS n, CAST(max(CASE n_nationkey % 4 WHEN 0 THEN 2 ELSE 0 END) AS INT) AS pages, bool_or(n_nationkey % 4 = 0) AS skipped FROM nation GROUP BY 1"


def state_default(spark, d):
    """State that does not exist yet reads as empty, so that every place is new."""
    old = R.state(spark, f"{d}/no_such_state.parquet", "id bigint, seen int")
    now = table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"))
    return now.join(old, F.col("key") == F.col("id"), "left").select("key", F.col("id").isNull().alias("new"))


STATE_DEFAULT = "SELECT s_suppkey AS key, true AS new FROM supplier"


def partitioned_scan(spark, d):
    """Orders written by status and read back through a glob: the filter on the folder's name prunes folders."""
    path = shared_folder(spark)
    table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus").write.partitionBy("o_orderstatus").parquet(path)
    kept = spark.read.option("basePath", path).parquet(f"{path}/o_orderstatus=*").where("o_orderstatus = 'F'")
    return kept.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


PARTITIONED_SCAN = "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderstatus = 'F' GROUP BY 1"


def schema_probe(spark, d):
    """A table's columns without reading its rows."""
    return R.columns_of(table(spark, d, "customer"))


SCHEMA_PROBE = "SELECT column_name AS column, CAST(column_index AS INT) AS position FROM duckdb_columns() WHERE false UNION ALL SELECT * FROM (VALUES ('c_custkey', 0), ('c_name', 1), ('c_nationkey', 2), ('c_acctbal', 3), ('c_mktsegment', 4)) t(c, p)"


def releases(spark, d):
    """The latest release among folder names."""
    paths = table(spark, d, "nation").select(F.concat(F.lit("s3://x/places/dt=2026-"), F.lpad((F.col("n_nationkey") % 12 + 1).cast("string"), 2, "0"), F.lit("-15/part-0.parquet")).alias("path"))
    latest = R.latest_release(paths, "path")
    memo = spark.createDataFrame([("2026-12-15", 3)], "done string, rules int")
    return latest.join(memo, F.col("release") == F.col("done"), "left").select("release", (F.col("rules").isNull() | (F.col("rules") < 4)).alias("due"))


RELEASES = "WITH p AS (SELECT max('2026-' || lpad(CAST(n_nationkey % 12 + 1 AS VARCHAR), 2, '0') || '-15') AS release FROM nation) SELECT release, true AS due FROM p"


def reverse_search(spark, d):
    """Names found by the beginning of their reversed form, with the first day each was seen."""
    i = F.col("event_id")
    e = table(spark, d, "events").select(F.concat(chosen(i, ["shop", "menu", "old"]), (i % 40).cast("string"), chosen(i, [".ramen.example", ".noodle.example"])).alias("name"), F.to_date("ts").alias("day"))
    found = e.where(F.reverse("name").startswith("elpmaxe.nemar"))
    return found.groupBy(U.registrable(F.col("name")).alias("domain"), "name").agg(F.min("day").alias("first")).orderBy("name").limit(100000)


REVERSE_SEARCH = f"WITH e AS (SELECT {chosen_sql('event_id', ['shop', 'menu', 'old'])} || CAST(event_id % 40 AS VARCHAR) || {chosen_sql('event_id', ['.ramen.example', '.noodle.example'])} AS name, CAST(ts AS DATE) AS day FROM events) SELECT 'ramen.example' AS domain, name, min(day) AS first FROM e WHERE starts_with(reverse(name), 'elpmaxe.nemar') GROUP BY name"


def json_out(spark, d):
    """Published documents: compact JSON, conditional keys left out when they say nothing."""
    i = F.col("s_suppkey")
    row = F.struct(i.alias("id"), F.col("s_name").alias("n"), F.when(i % 4 >= 2, (i % 4).cast("int")).alias("b"), F.when(i % 3 == 0, F.lit(1)).alias("nw"))
    return table(spark, d, "supplier").select(i.alias("id"), F.to_json(row).alias("json"))


JSON_OUT = """SELECT s_suppkey AS id, '{"id":' || CAST(s_suppkey AS VARCHAR) || ',"n":"' || s_name || '"' || CASE WHEN s_suppkey % 4 >= 2 THEN ',"b":' || CAST(s_suppkey % 4 AS VARCHAR) ELSE '' END || CASE WHEN s_suppkey % 3 = 0 THEN ',"nw":1' ELSE '' END || '}' AS json FROM supplier"""


def sink_actions(spark, d):
    """What a write-if-changed sink does with each file: write, keep, or delete those no longer wanted."""
    p = table(spark, d, "pages")
    wanted = p.where("page_id % 4 <> 0").select(F.concat(F.lit("p/"), F.col("page_id").cast("string")).alias("path"), F.lower("html").alias("body"))
    there = p.where("page_id % 3 <> 0").select(F.concat(F.lit("p/"), F.col("page_id").cast("string")).alias("path"), F.when(F.col("page_id") % 5 == 0, F.col("html")).otherwise(F.lower("html")).alias("body"))
    return R.sink_plan(wanted, there, "path", "body").groupBy("action").agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("first"))


SINK_ACTIONS = """WITH w AS (SELECT 'p/' || CAST(page_id AS VARCHAR) AS path, lower(html) AS body FROM pages WHERE page_id % 4 <> 0), t AS (SELECT 'p/' || CAST(page_id AS VARCHAR) AS path, CASE WHEN page_id % 5 = 0 THEN html ELSE lower(html) END AS body FROM pages WHERE page_id % 3 <> 0),
a AS (SELECT coalesce(w.path, t.path) AS path, CASE WHEN w.path IS NULL THEN 'delete' WHEN w.body IS NOT DISTINCT FROM t.body THEN 'keep' ELSE 'write' END AS action FROM w FULL JOIN t ON w.path = t.path) SELECT action, count(*) AS n, min(path) AS first FROM a GROUP BY action"""


def publish_gate(spark, d):
    """Sources whose new result has lost over three tenths of its rows are not published."""
    i = F.col("event_id")
    e = table(spark, d, "events").select(chosen(i, ["a", "b", "c"]).alias("source"), ((i % 3 != 1) | (i % 2 == 0)).alias("still"))
    counts = e.groupBy("source").agg(F.count(F.lit(1)).alias("old"), F.count_if("still").alias("new"))
    return counts.withColumn("published", R.enough(F.col("new"), F.col("old")))


PUBLISH_GATE = f"SELECT {chosen_sql('event_id', ['a', 'b', 'c'])} AS source, count(*) AS old, count(*) FILTER (event_id % 3 <> 1 OR event_id % 2 = 0) AS new, count(*) FILTER (event_id % 3 <> 1 OR event_id % 2 = 0) >= 0.7 * count(*) AS published FROM events GROUP BY 1"


def search_index(spark, d):
    """The search index in order of lower-cased names, and the first hits of a query that ignores accents."""
    s = _sites(spark, d).select("id", "name", "address")
    hay = folded(F.concat_ws(" ", "name", "address"))
    hits = s.withColumn("hay", hay).where(all_words(F.col("hay"), "Ole hill"))
    return hits.select("id", "name", F.lower("name").alias("place_key")).orderBy("place_key", "id").limit(25)


SEARCH_INDEX = f"WITH {_SITES_SQL} SELECT id, name, lower(name) AS place_key FROM sites WHERE contains(strip_accents(lower(name || ' ' || address)), 'ole') AND contains(strip_accents(lower(name || ' ' || address)), 'hill') ORDER BY lower(name), id LIMIT 25"


def _same():
    from .entities import _same as same

    return same()


def closed_elsewhere(spark, d):
    """Places that a second source calls closed, that are listed, and that the same source does not also list as open."""
    o = others(spark, d)
    shut, still = o.where("bid % 2 = 0"), o.where("bid % 5 = 1")
    swap = lambda x: x.select(F.col("bid").alias("id"), F.col("bname").alias("name"), F.col("blat").alias("lat"), F.col("blon").alias("lon"), F.col("bhost").alias("host"))
    back = places(spark, d).select(F.col("id").alias("bid"), F.col("name").alias("bname"), F.col("lat").alias("blat"), F.col("lon").alias("blon"), F.col("host").alias("bhost"))
    listed = grid_join(swap(shut), back, 150, _same(), how="left_semi")
    return grid_join(listed, still, 150, _same(), how="left_anti").select("id", "name")


def _pair(x: str, y: str) -> str:
    from .entities import _words

    dist = METRES.format(a=f"{x}.", b=f"{y}.")
    return f"({dist} <= 150 AND (lower(trim({x}.name)) = lower(trim({y}.name)) OR ({dist} < 20 AND (contains(lower({x}.name), lower({y}.name)) OR contains(lower({y}.name), lower({x}.name)))) OR ({dist} < 120 AND list_has_any({_words(x + '.name')}, {_words(y + '.name')})) OR ({x}.host <> '' AND {x}.host = {y}.host AND {dist} < 150)))"


CLOSED_ELSEWHERE = f"WITH {PLACES}, o AS (SELECT bid AS id, bname AS name, blat AS lat, blon AS lon, bhost AS host FROM others) SELECT s.id, s.name FROM o s WHERE s.id % 2 = 0 AND EXISTS (SELECT 1 FROM places p WHERE p.lat BETWEEN s.lat - 0.01 AND s.lat + 0.01 AND {_pair('s', 'p')}) AND NOT EXISTS (SELECT 1 FROM o q WHERE q.id % 5 = 1 AND {_pair('s', 'q')})"


def overlap_study(spark, d):
    """Second-source places by whether the first has them, and what they add."""
    o = others(spark, d)
    found = grid_join(places(spark, d), o, 150, _same()).groupBy("bid").agg(F.min("id").alias("id"))
    t = o.select("bid").join(found, "bid", "left").select(F.col("id").isNull().alias("only"), (F.col("bid") % 3 == 0).alias("hours"), (F.col("bid") % 4 == 0).alias("phone"), (F.col("id") % 2 == 0).alias("has_phone"))
    return t.agg(F.count(F.lit(1)).alias("places"), F.count_if("only").alias("only"), F.count_if("hours").alias("hours"), F.count_if(F.col("hours") & F.col("only")).alias("hours_only"), F.count_if(~F.col("only") & F.col("phone") & ~F.col("has_phone")).alias("phone_added"))


OVERLAP_STUDY = f"WITH {PLACES}, o AS (SELECT bid AS id, bname AS name, blat AS lat, blon AS lon, bhost AS host FROM others), f AS (SELECT o.id AS bid, (SELECT min(p.id) FROM places p WHERE p.lat BETWEEN o.lat - 0.01 AND o.lat + 0.01 AND {_pair('p', 'o')}) AS id FROM o) SELECT count(*) AS places, count(*) FILTER (id IS NULL) AS only, count(*) FILTER (bid % 3 = 0) AS hours, count(*) FILTER (bid % 3 = 0 AND id IS NULL) AS hours_only, count(*) FILTER (id IS NOT NULL AND bid % 4 = 0 AND id % 2 <> 0) AS phone_added FROM f"


def closed_spots(spark, d):
    """Spots that a closed spot hides: within 0.15 miles and names that agree or are missing."""
    p = places(spark, d)
    shut = others(spark, d).where("bid % 3 = 0").withColumn("bname", F.when(F.col("bid") % 2 == 0, F.lit("")).otherwise(F.lower("bname")))
    n = F.lower("name")
    agree = (F.col("bname") == "") | (n == F.col("bname")) | F.contains(n, F.col("bname")) | F.contains(F.col("bname"), n)
    near = (F.abs(F.col("lat") - F.col("blat")) < 0.01) & (F.abs(F.col("lon") - F.col("blon")) < 0.01) & (planar(F.col("lat"), F.col("lon"), F.col("blat"), F.col("blon")) < 0.15)
    return grid_join(p, shut, 400, agree & near, how="left_anti").select("id")


_PLANAR = "69.0::DOUBLE * sqrt(pow({b}lat - {a}lat, 2) + pow(({b}lon - {a}lon) * cos(radians(({a}lat + {b}lat) / 2)), 2))"
CLOSED_SPOTS = f"WITH {PLACES}, s AS (SELECT CASE WHEN bid % 2 = 0 THEN '' ELSE lower(bname) END AS bname, blat, blon FROM others WHERE bid % 3 = 0) SELECT id FROM places WHERE NOT EXISTS (SELECT 1 FROM s WHERE abs(lat - blat) < 0.01 AND abs(lon - blon) < 0.01 AND {_PLANAR.format(a='', b='b')} < 0.15 AND (bname = '' OR lower(name) = bname OR contains(lower(name), bname) OR contains(bname, lower(name))))"


def _cities(spark, d):
    return places(spark, d).withColumn("city", F.concat((cell(F.col("lat"), 2)).cast("string"), F.lit("/"), (cell(F.col("lon"), 2)).cast("string"), F.when(F.floor(F.col("id") / 100) % 2 == 0, "e").otherwise("w")))


def city_centroids(spark, d):
    """Cities' centroids, with pages for those of three places or more."""
    return _cities(spark, d).groupBy("city").agg(F.round(F.avg("lat"), 4).alias("lat"), F.round(F.avg("lon"), 4).alias("lon"), F.count(F.lit(1)).alias("n")).withColumn("page", F.col("n") >= 3)


_CITIES = f"{PLACES}, cities AS (SELECT *, CAST(CAST(trunc(lat * 2) AS INT) AS VARCHAR) || '/' || CAST(CAST(trunc(lon * 2) AS INT) AS VARCHAR) || CASE WHEN id // 100 % 2 = 0 THEN 'e' ELSE 'w' END AS city FROM places)"
CITY_CENTROIDS = f"WITH {_CITIES} SELECT city, round(avg(lat), 4) AS lat, round(avg(lon), 4) AS lon, count(*) AS n, count(*) >= 3 AS page FROM cities GROUP BY city"


def nearby_places(spark, d):
    """The twelve nearest places outside each city, within 15 miles of its centroid."""
    c = _cities(spark, d)
    centres = c.groupBy("city").agg(F.round(F.avg("lat"), 4).alias("clat"), F.round(F.avg("lon"), 4).alias("clon"), F.count(F.lit(1)).alias("n")).where("n >= 3").drop("n")
    return L.nearby(centres, c.select("id", "city", "lat", "lon"), 15, 12)


NEARBY_PLACES = f"WITH {_CITIES}, c AS (SELECT city AS of_city, round(avg(lat), 4) AS clat, round(avg(lon), 4) AS clon FROM cities GROUP BY city HAVING count(*) >= 3), p AS (SELECT of_city, id, round({_PLANAR.format(a='c', b='')}, 4) AS miles FROM c JOIN cities ON city <> of_city AND abs(lat - clat) < 0.3) SELECT of_city AS city, id, miles, CAST(row_number() OVER (PARTITION BY of_city ORDER BY miles, id) AS INT) AS rank FROM p WHERE miles <= 15 QUALIFY rank <= 12"


def detail_fixes(spark, d):
    """Better names and websites for listings matched by listed or new name and spot; a second run changes nothing."""
    p = places(spark, d).select("id", "name", "lat", "lon", F.lit(None).cast("string").alias("website"))
    f = p.where("id % 40 = 3").select(F.col("name").alias("n"), F.col("lat").alias("la"), F.col("lon").alias("lo"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("The "), "name")).otherwise(F.lit("")).alias("better"), F.lit("https://fixed.example").alias("site"))
    once = L.fixed_details(p, f)
    again = L.fixed_details(once.join(p.select("id", "lat", "lon"), "id"), f)
    return once.join(again.select("id", F.col("changed").alias("changed_again")), "id")


DETAIL_FIXES = f"WITH {PLACES}, f AS (SELECT id AS fid, lower(trim(name)) AS n, lat AS la, lon AS lo, CASE WHEN id % 3 > 0 THEN 'The ' || name ELSE '' END AS better FROM places WHERE id % 40 = 3) SELECT id, CASE WHEN fid IS NOT NULL AND better <> '' THEN better ELSE name END AS name, CASE WHEN fid IS NOT NULL THEN 'https://fixed.example' END AS website, fid IS NOT NULL AS changed, false AS changed_again FROM places LEFT JOIN f ON lower(trim(name)) = n AND abs(lat - la) < 2e-4 AND abs(lon - lo) < 2e-4"


def tag_fixes(spark, d):
    """Opening hours put into the tags of places by name and spot; other tags stay."""
    p = places(spark, d).withColumn("tags", F.create_map(F.lit("name"), F.col("name"), F.lit("opening_hours"), F.lit("Mo 09:00-10:00")))
    f = places(spark, d).where("id % 30 = 4").select(F.lower("name").alias("fn"), F.col("lat").alias("la"), F.col("lon").alias("lo"), F.concat(F.lit("Tu 1"), (F.col("id") % 5).cast("string"), F.lit(":00-20:00")).alias("oh"))
    f, p = L.spot_cells(f, "la", "lo", ("fi", "fj"), True), L.spot_cells(p, "lat", "lon", ("ci", "cj"), False)
    joined = p.join(f, (F.lower(F.trim("name")) == F.col("fn")) & (F.col("ci") == F.col("fi")) & (F.col("cj") == F.col("fj")) & L.near_spot(F.col("lat"), F.col("lon"), F.col("la"), F.col("lo")), "left")
    tags = F.when(F.col("oh").isNotNull(), F.map_concat(F.map_filter("tags", lambda k, _: k != "opening_hours"), F.create_map(F.lit("opening_hours"), F.col("oh")))).otherwise(F.col("tags"))
    return joined.select("id", tags["opening_hours"].alias("hours"), F.size(tags).alias("tags"))


TAG_FIXES = f"WITH {PLACES}, f AS (SELECT id AS fid, name AS n, lat AS la, lon AS lo, 'Tu 1' || CAST(id % 5 AS VARCHAR) || ':00-20:00' AS oh FROM places WHERE id % 30 = 4) SELECT id, coalesce(oh, 'Mo 09:00-10:00') AS hours, 2 AS tags FROM places LEFT JOIN f ON name = n AND abs(lat - la) < 2e-4 AND abs(lon - lo) < 2e-4"


def chain_missing(spark, d):
    """A chain's listings that its directory lacks: neither the house number in the state nor the street in the city; a chain that
    lacks over a quarter gives none."""
    i = F.col("c_custkey")
    base = table(spark, d, "customer").select(i.alias("id"), chosen(i, ["A", "B"]).alias("chain"), chosen(F.floor(i / 2), ["ny", "ca", "tx"]).alias("state"), (i * 7 % 500).cast("string").alias("house"), chosen(i, ["troy", "dover"]).alias("city"), F.array(chosen(F.floor(i / 3), ["main", "hill", "oak"])).alias("words"))
    stores = base.where(F.when(F.col("chain") == "A", i % 10 != 0).otherwise(i % 10 < 3)).select("chain", "state", "house", F.lit("nowhere").alias("city"), "words")
    return C.missing_stores(base, stores)


CHAIN_MISSING = f"""WITH b AS (SELECT c_custkey AS id, {chosen_sql('c_custkey', ['A', 'B'])} AS chain, {chosen_sql('c_custkey // 2', ['ny', 'ca', 'tx'])} AS state, c_custkey * 7 % 500 AS house FROM customer), s AS (SELECT DISTINCT chain, state, house FROM b WHERE CASE WHEN chain = 'A' THEN id % 10 <> 0 ELSE id % 10 < 3 END),
m AS (SELECT * FROM b ANTI JOIN s USING (chain, state, house)) SELECT id FROM m WHERE chain IN (SELECT b.chain FROM b GROUP BY b.chain HAVING (SELECT count(*) FROM m WHERE m.chain = b.chain) BETWEEN 1 AND 0.25 * count(*))"""
