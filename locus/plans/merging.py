"""Unions, merging, orders, folds and closure queries: (Spark, DuckDB SQL) under each name."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.geo import cell, grid_join, planar
from ..functions.hours import owner_hours_column
from ..operators import closures as C
from ..operators import listings as L
from ..operators.match import greedy_dedupe, keep_or_merge
from ..operators.windows import first_filled, miss_runs, sessions
from ..sources.adapters import ACTIVITY, HOST, METRES, PLACES, activity, chosen, chosen_sql, others, places, table, written
from .entities import _same, _words

TODAY = "DATE '2026-10-01'"
_FILLER = ["ramen", "restaurant", "house", "bar", "shop", "noodles?", "kitchen", "the", "and"]


def _pair(x: str, y: str) -> str:
    dist = METRES.format(a=f"{x}.", b=f"{y}.")
    return f"({dist} <= 150 AND (lower(trim({x}.name)) = lower(trim({y}.name)) OR ({dist} < 20 AND (contains(lower({x}.name), lower({y}.name)) OR contains(lower({y}.name), lower({x}.name)))) OR ({dist} < 120 AND list_has_any({_words(x + '.name')}, {_words(y + '.name')})) OR ({x}.host <> '' AND {x}.host = {y}.host AND {dist} < 150)))"


def _feeds(spark, d):
    p = places(spark, d)
    o = others(spark, d).select((F.col("bid") + 1_000_000).alias("id"), F.col("bname").alias("name"), F.col("blat").alias("lat"), F.col("blon").alias("lon"), F.col("bhost").alias("host"))
    return [(p.where("id % 50 = 7"), True), (o, False), (p.where("id % 50 <> 7 and id % 3 <> 0"), False)], p.where("id % 3 = 0 and id % 50 <> 7 and id < 400")


def published(spark, d):
    """The priority union: vouched places always, then a second source, then the first; a place goes in unless a known or admitted
    one is the same. Opted-out hosts never go in."""
    feeds, known = _feeds(spark, d)
    rows = written(L.by_priority(feeds, ["id", "name", "lat", "lon", "host"]).where("host not like '%.example.net' or always"))
    side = lambda x: x.select(F.col("id").alias("bid"), F.col("name").alias("bname"), F.col("lat").alias("blat"), F.col("lon").alias("blon"), F.col("host").alias("bhost"), *[F.col(c).alias(f"b_{c}") for c in x.columns if c in ("prio", "always")])
    fresh = rows.where("always").unionByName(grid_join(rows.where("not always"), side(known), 150, _same(), how="left_anti").select(*rows.columns))
    fresh = written(fresh)
    before = (F.col("prio") < F.col("b_prio")) | ((F.col("prio") == F.col("b_prio")) & (F.col("id") < F.col("bid")))
    # Vouched rows are never dropped: no link ends at one.
    links = grid_join(fresh, side(fresh), 150, before & ~F.col("b_always") & _same()).select(F.col("id").alias("a"), F.col("bid").alias("b"))
    kept = greedy_dedupe(fresh.select("id", F.struct("prio", "id").alias("seq")), links, written)
    return fresh.join(kept, "id").groupBy("prio").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"), F.sum("id").alias("ids"))


_FEEDS = f"""{PLACES}, o AS (SELECT bid + 1000000 AS id, bname AS name, blat AS lat, blon AS lon, bhost AS host FROM others),
f0 AS (SELECT *, 0 AS prio, true AS always FROM places WHERE id % 50 = 7 UNION ALL SELECT *, 1, false FROM o UNION ALL SELECT *, 2, false FROM places WHERE id % 50 <> 7 AND id % 3 <> 0),
f AS (SELECT * FROM f0 WHERE host NOT LIKE '%.example.net' OR always),
known AS (SELECT * FROM places WHERE id % 3 = 0 AND id % 50 <> 7 AND id < 400),
fresh AS (SELECT *, row_number() OVER (ORDER BY prio, id) AS seq FROM f WHERE always OR NOT EXISTS (SELECT 1 FROM known k WHERE k.lat BETWEEN f.lat - 0.01 AND f.lat + 0.01 AND {_pair('f', 'k')})),
links AS MATERIALIZED (SELECT x.seq AS a, y.seq AS b FROM fresh x JOIN fresh y ON y.lat BETWEEN x.lat - 0.01 AND x.lat + 0.01 AND x.seq < y.seq AND NOT y.always AND {_pair('x', 'y')}),"""
#: Rows are decided when all their earlier neighbours are: each step of the recursion carries what is decided so far.
_GREEDY = """
walk(step, seq, kept) AS (SELECT 0, seq, true FROM {rows} WHERE seq NOT IN (SELECT b FROM links)
 UNION ALL SELECT * FROM (
  WITH done AS (SELECT step, seq, kept FROM walk), now AS (SELECT max(step) AS s FROM done),
  ready AS (SELECT l.b AS seq, bool_or(coalesce(dn.kept, false)) AS hit, bool_and(dn.seq IS NOT NULL) AS all_known FROM links l LEFT JOIN done dn ON dn.seq = l.a WHERE l.b NOT IN (SELECT seq FROM done) GROUP BY l.b)
  SELECT (SELECT s FROM now) + 1, seq, kept FROM done WHERE EXISTS (SELECT 1 FROM ready WHERE hit OR all_known) UNION ALL SELECT (SELECT s FROM now) + 1, seq, NOT hit FROM ready WHERE hit OR all_known))"""
PUBLISHED = f"WITH RECURSIVE {_FEEDS}{_GREEDY.format(rows='fresh')} SELECT prio, count(*) AS n, min(id) AS least, CAST(sum(id) AS BIGINT) AS ids FROM fresh WHERE seq IN (SELECT seq FROM walk WHERE step = (SELECT max(step) FROM walk) AND kept) GROUP BY prio"

PLACE_DEDUPE_SQL = f"WITH RECURSIVE {PLACES}, fresh AS (SELECT *, id AS seq FROM places), links AS MATERIALIZED (SELECT x.seq AS a, y.seq AS b FROM fresh x JOIN fresh y ON y.lat BETWEEN x.lat - 0.01 AND x.lat + 0.01 AND x.seq < y.seq AND {_pair('x', 'y')}),{_GREEDY.format(rows='fresh')} SELECT seq AS id FROM walk WHERE step = (SELECT max(step) FROM walk) AND kept"


def all_listings(spark, d):
    """The bag union of three sources with different columns, counted by host."""
    a = places(spark, d).select("id", "name", "host")
    b = others(spark, d).select(F.col("bid").alias("id"), F.col("bname").alias("name"), F.lit("b").alias("source"))
    both = a.unionByName(b, allowMissingColumns=True).unionByName(a.where("id % 9 = 0").select("id", "name"), allowMissingColumns=True)
    return both.groupBy(F.coalesce("source", F.lit("a")).alias("source"), F.col("host").isNull().alias("no_host")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("name").alias("names"))


ALL_LISTINGS = f"WITH {PLACES}, u AS (SELECT id, name, host, NULL AS source FROM places UNION ALL SELECT bid, bname, NULL, 'b' FROM others UNION ALL SELECT id, name, NULL, NULL FROM places WHERE id % 9 = 0) SELECT coalesce(source, 'a') AS source, host IS NULL AS no_host, count(*) AS n, count(DISTINCT name) AS names FROM u GROUP BY 1, 2"


def host_listings(spark, d):
    """Listings of each host from two sources; of those with one name within 0.002 degrees of latitude of a listing already taken,
    the first stays."""
    a = places(spark, d).select("id", "name", "lat", "host", F.lit(0).alias("src"))
    b = others(spark, d).select((F.col("bid") + 1_000_000).alias("id"), F.col("bname").alias("name"), F.col("blat").alias("lat"), F.col("bhost").alias("host"), F.lit(1).alias("src"))
    rows = written(a.unionByName(b).where("host <> ''").withColumn("seq", F.struct("src", "id")).withColumn("ci", cell(F.col("lat"), 500)))
    other = rows.select(F.col("id").alias("bid"), F.col("name").alias("bname"), F.col("host").alias("bhost"), F.col("lat").alias("blat"), F.col("seq").alias("bseq"), F.explode(F.sequence(F.col("ci") - 1, F.col("ci") + 1)).alias("bi"))
    near = (F.col("host") == F.col("bhost")) & (F.col("name") == F.col("bname")) & (F.col("ci") == F.col("bi")) & (F.abs(F.col("lat") - F.col("blat")) < 0.002) & (F.col("seq") < F.col("bseq"))
    kept = greedy_dedupe(rows.select("id", "seq"), rows.join(other, near).select(F.col("id").alias("a"), F.col("bid").alias("b")), written)
    return rows.join(kept, "id").groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"))


HOST_LISTINGS = f"""WITH RECURSIVE {PLACES}, u AS (SELECT id, name, lat, host, 0 AS src FROM places UNION ALL SELECT bid + 1000000, bname, blat, bhost, 1 FROM others), fresh AS (SELECT *, row_number() OVER (ORDER BY src, id) AS seq FROM u WHERE host <> ''),
links AS MATERIALIZED (SELECT x.seq AS a, y.seq AS b FROM fresh x JOIN fresh y ON x.host = y.host AND x.name = y.name AND abs(x.lat - y.lat) < 0.002 AND x.seq < y.seq),{_GREEDY.format(rows='fresh')}
SELECT host, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids FROM fresh WHERE seq IN (SELECT seq FROM walk WHERE step = (SELECT max(step) FROM walk) AND kept) GROUP BY host"""


def merged_spots(spark, d):
    """Spots of several feeds, duplicates merged into the last spot they match, which then takes a better kind and a website."""
    i = F.col("id")
    a = places(spark, d).where("id % 4 > 0").select("id", T.name_key(F.col("name"), _FILLER).alias("name"), "lat", "lon", F.when(i % 3 == 0, F.lit("")).otherwise(F.col("host")).alias("host"), F.when(i % 5 == 0, "shop").otherwise("menu").alias("kind"))
    rows = written(a)
    b = rows.select(F.col("id").alias("bid"), F.col("name").alias("bname"), F.col("lat").alias("blat"), F.col("lon").alias("blon"), F.col("host").alias("bhost"))
    miles = planar(F.col("lat"), F.col("lon"), F.col("blat"), F.col("blon"))
    links = grid_join(rows, b, 300, (F.col("id") < F.col("bid")) & L.same_listing(F.col("name"), F.col("host"), F.col("bname"), F.col("bhost"), miles), per_degree=200).select(F.col("id").alias("a"), F.col("bid").alias("b"))
    return keep_or_merge(rows, written(links), written, {"kind": lambda own, new: F.when((own == "menu") & (new == "shop"), "shop").otherwise(own)}, {"host": ""})


_MILES = "69.0::DOUBLE * sqrt(pow(y.lat - x.lat, 2) + pow((y.lon - x.lon) * cos(radians((x.lat + y.lat) / 2)), 2))"
_KEYED = "trim(regexp_replace(regexp_replace(lower(name), '\\b(ramen|restaurant|house|bar|shop|noodles?|kitchen|the|and)\\b', ' ', 'g'), '[^a-z0-9]+', '', 'g'))"
MERGED_SPOTS = f"""WITH RECURSIVE {PLACES}, fresh AS (SELECT id, {_KEYED} AS name, lat, lon, CASE WHEN id % 3 = 0 THEN '' ELSE host END AS host, CASE WHEN id % 5 = 0 THEN 'shop' ELSE 'menu' END AS kind, id AS seq FROM places WHERE id % 4 > 0),
links AS MATERIALIZED (SELECT x.seq AS a, y.seq AS b FROM fresh x JOIN fresh y ON y.lat BETWEEN x.lat - 0.01 AND x.lat + 0.01 AND x.seq < y.seq WHERE ({_MILES} < 0.12 AND ((x.name <> '' AND y.name <> '' AND (x.name = y.name OR (length(y.name) >= 4 AND (contains(x.name, y.name) OR contains(y.name, x.name))))) OR (x.host <> '' AND x.host = y.host))) OR {_MILES} < 0.02),{_GREEDY.format(rows='fresh')},
fin AS (SELECT seq, kept FROM walk WHERE step = (SELECT max(step) FROM walk)),
into_spot AS (SELECT l.b AS seq, max(l.a) AS into_seq FROM links l JOIN fin k ON k.seq = l.a AND k.kept JOIN fin n ON n.seq = l.b AND NOT n.kept GROUP BY l.b),
m AS (SELECT i.into_seq, bool_or(f.kind = 'shop') AS shop, arg_min(f.host, f.seq) FILTER (f.host <> '') AS host, count(*) AS merged FROM into_spot i JOIN fresh f ON f.seq = i.seq GROUP BY 1)
SELECT f.id, f.name, f.lat, f.lon, CASE WHEN f.host <> '' THEN f.host ELSE coalesce(m.host, '') END AS host, CASE WHEN f.kind = 'menu' AND m.shop THEN 'shop' ELSE f.kind END AS kind, coalesce(m.merged, 0) AS merged FROM fresh f JOIN fin ON fin.seq = f.seq AND fin.kept LEFT JOIN m ON m.into_seq = f.seq"""

_WEEK = [[[660, 1260]]] * 7
_HOUR_TEXTS = ["Tue-Sun 11:30am-9pm", "whenever we like", None, "Mon-Fri 10am-3pm, Sat 12pm-4pm", "daily 5pm-1am"]


def hours_priority(spark, d):
    """A listing's week of hours by priority: kept by hand, then the owner's, then its website's where the host has one listing;
    a page's own hours win over its host's."""
    i = F.col("c_custkey")
    rows = table(spark, d, "customer").select(i.alias("id"), F.when(i % 7 == 0, "hand 7x").alias("hand"), owner_hours_column(chosen(i, _HOUR_TEXTS)).alias("owner"), F.when((i % 3 == 0) & (i % 100 == 1), "site 7x").alias("site"), F.when(i % 11 == 0, "page 7x").alias("page"))
    value, way = L.first_of([("page", "page"), ("hand", "hand"), ("owner", "owner"), ("site", "site")])
    return rows.select("id", value.alias("hours"), way.alias("way"))


_OWNER = ["Mon Closed · Tue–Sun 11:30am–9pm", None, None, "Mon–Fri 10am–3pm · Sat 12pm–4pm · Sun Closed", "Mon–Sun 5pm–1am"]
HOURS_PRIORITY = f"WITH r AS (SELECT c_custkey AS id, {chosen_sql('c_custkey', _OWNER)} AS owner FROM customer) SELECT id, CASE WHEN id % 11 = 0 THEN 'page 7x' WHEN id % 7 = 0 THEN 'hand 7x' WHEN owner IS NOT NULL THEN owner WHEN id % 3 = 0 AND id % 100 = 1 THEN 'site 7x' END AS hours, CASE WHEN id % 11 = 0 THEN 'page' WHEN id % 7 = 0 THEN 'hand' WHEN owner IS NOT NULL THEN 'owner' WHEN id % 3 = 0 AND id % 100 = 1 THEN 'site' END AS way FROM r"


def hand_hours(spark, d):
    """Hours kept by hand put over published ones: keys with a path go to pages, others to shops."""
    i = F.col("page_id")
    old = table(spark, d, "pages").where("page_id % 4 <> 0").select(F.concat(F.lit("h"), (i % 60).cast("string"), F.when(i % 3 == 0, "/menu").otherwise("")).alias("key"), F.lit("old").alias("week")).distinct()
    new = table(spark, d, "pages").where("page_id % 5 = 0").select(F.concat(F.lit("h"), (i % 60).cast("string"), F.when(i % 2 == 0, "/menu").otherwise("")).alias("key"), F.when(i % 15 == 0, "old").otherwise("hand").alias("week")).groupBy("key").agg(F.max("week").alias("week"))
    return L.upserted(old, new, "key", "week").withColumn("part", F.when(F.contains("key", F.lit("/")), "pages").otherwise("shops"))


HAND_HOURS = """WITH o AS (SELECT DISTINCT 'h' || CAST(page_id % 60 AS VARCHAR) || CASE WHEN page_id % 3 = 0 THEN '/menu' ELSE '' END AS key FROM pages WHERE page_id % 4 <> 0), n AS (SELECT 'h' || CAST(page_id % 60 AS VARCHAR) || CASE WHEN page_id % 2 = 0 THEN '/menu' ELSE '' END AS key, max(CASE WHEN page_id % 15 = 0 THEN 'old' ELSE 'hand' END) AS week FROM pages WHERE page_id % 5 = 0 GROUP BY 1)
SELECT coalesce(n.key, o.key) AS key, coalesce(n.week, 'old') AS week, n.key IS NOT NULL AND (o.key IS NULL OR n.week <> 'old') AS changed, CASE WHEN contains(coalesce(n.key, o.key), '/') THEN 'pages' ELSE 'shops' END AS part FROM o FULL JOIN n ON o.key = n.key"""


def claim_misses(spark, d):
    """Hosts that two checks in a row, both reached, found without their code lose their claim; a found code starts anew."""
    e = activity(spark, d).select((F.col("k") % 60).alias("host"), "seq", F.when(F.col("event_type") == "error", F.lit(None).cast("boolean")).otherwise(F.col("event_type") != "view").alias("found"))
    return miss_runs(e, "host", "seq", "found", 2)


CLAIM_MISSES = f"""WITH {ACTIVITY}, e AS (SELECT k % 60 AS host, seq, CASE WHEN event_type <> 'error' THEN event_type <> 'view' END AS found FROM activity), r AS (SELECT * FROM e WHERE found IS NOT NULL),
g AS (SELECT *, sum(CASE WHEN found THEN 1 ELSE 0 END) OVER (PARTITION BY host ORDER BY seq) AS run FROM r)
SELECT host, CAST(count(*) FILTER (NOT found AND run = (SELECT max(run) FROM g q WHERE q.host = g.host)) AS INT) AS misses, count(*) FILTER (NOT found AND run = (SELECT max(run) FROM g q WHERE q.host = g.host)) < 2 AND max(run) > 0 AS claimed FROM g GROUP BY host"""


def token_clusters(spark, d):
    """Events of a visitor in clusters: a gap of over 6 hours begins a new one."""
    e = activity(spark, d).select("device", (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6) / 3600).alias("hour"), "seq")
    return sessions(e, "device", ["hour", "seq"], "hour", 6).groupBy("device").agg(F.max("cluster").alias("clusters"), F.count(F.lit(1)).alias("n"))


TOKEN_CLUSTERS = f"WITH {ACTIVITY}, g AS (SELECT device, seq, epoch(ts) / 3600 AS hour, CASE WHEN epoch(ts) / 3600 - lag(epoch(ts) / 3600) OVER (PARTITION BY device ORDER BY ts, seq) <= 6 THEN 0 ELSE 1 END AS new FROM activity), c AS (SELECT *, sum(new) OVER (PARTITION BY device ORDER BY hour, seq) AS cluster FROM g) SELECT device, CAST(max(cluster) AS BIGINT) AS clusters, count(*) AS n FROM c GROUP BY device"


def focus_order(spark, d):
    """The check queue ordered anew by distance from a point, ties by class and age."""
    p = places(spark, d).withColumn("class", (F.col("id") % 3).cast("int")).withColumn("miles", F.round(69 * F.hypot(F.col("lat") - 40.0, (F.col("lon") + 80.0) * F.cos(F.radians(F.lit(40.0)))), 6))
    return L.top_per(p.withColumn("one", F.lit(1)), ["one"], ["miles", "class", "id"], 40).select("id", "class", "miles", "rank")


FOCUS_ORDER = f"WITH {PLACES}, m AS (SELECT id, CAST(id % 3 AS INT) AS class, round(69 * sqrt(pow(lat - 40.0::DOUBLE, 2) + pow((lon + 80.0::DOUBLE) * cos(radians(40.0::DOUBLE)), 2)), 6) AS miles FROM places) SELECT *, CAST(row_number() OVER (ORDER BY miles, class, id) AS INT) AS rank FROM m QUALIFY rank <= 40"

#: Days until a domain is read again, by status. Fixed values.
DOMAIN_DAYS = {"ok": 60, "no US address": 60, "unreachable": 30, "empty": 45, "parked": 45}
DOMAIN_DEFAULT = 120
_STATUSES = ["ok", "no US address", "unreachable", "empty", "parked", "elsewhere", "not ramen", "not a restaurant", None]


def domain_queue(spark, d):
    """Domains to read: those added by hand first, then the newest; read ones again after their status' days; limited to 30."""
    i = F.col("c_custkey")
    rows = table(spark, d, "customer").select(i.alias("id"), chosen(i, _STATUSES).alias("status"), F.date_sub(F.expr(TODAY), (i * 31 % 300).cast("int")).alias("first"), F.when(i % 6 > 0, F.date_sub(F.expr(TODAY), (i * 13 % 150).cast("int"))).alias("checked"), (i % 29 == 0).alias("manual"))
    days = F.lit(DOMAIN_DEFAULT)
    for status, n in DOMAIN_DAYS.items():
        days = F.when(F.col("status") == status, n).otherwise(days)
    due = rows.where(F.col("status").isNull() | (F.coalesce(F.datediff(F.expr(TODAY), "checked"), F.lit(10_000)) >= days))
    return due.orderBy(F.desc("manual"), F.desc("first"), "id").limit(30).select("id", "status", "first", "manual")


DOMAIN_QUEUE = f"""WITH r AS (SELECT c_custkey AS id, {chosen_sql('c_custkey', _STATUSES)} AS status, {TODAY} - CAST(c_custkey * 31 % 300 AS INT) AS first, CASE WHEN c_custkey % 6 > 0 THEN c_custkey * 13 % 150 ELSE 10000 END AS age, c_custkey % 29 = 0 AS manual FROM customer)
SELECT id, status, first, manual FROM r WHERE status IS NULL OR age >= CASE {' '.join(f"WHEN status = '{k}' THEN {n}" for k, n in DOMAIN_DAYS.items())} ELSE {DOMAIN_DEFAULT} END ORDER BY manual DESC, first DESC, id LIMIT 30"""


def hours_candidates(spark, d):
    """Up to three pages of a site that may state hours: named so, then places to visit, then others; by address."""
    label = F.lower(F.col("href"))
    hrefs = table(spark, d, "pages").select("page_id", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1)))).alias("href")).unionByName(table(spark, d, "pages").select("page_id", F.concat(F.lit("/"), chosen(F.col("page_id"), ["hours", "visit-us", "about", "contact"])).alias("href")))
    rank = F.when(F.contains(label, F.lit("hour")), 0).when(label.rlike("locat|visit|find|contact"), 1).otherwise(2)
    kept = hrefs.where(~label.rlike(r"\.(pdf|jpe?g|png)$")).withColumn("class", rank)
    return L.top_per(kept, ["page_id"], ["class", "href"], 3).select("page_id", "href", "class", "rank")


HOURS_CANDIDATES = f"""WITH h AS (SELECT page_id, unnest(list_distinct(regexp_extract_all(html, 'href="([^"]+)"', 1))) AS href FROM pages UNION ALL SELECT page_id, '/' || {chosen_sql('page_id', ['hours', 'visit-us', 'about', 'contact'])} FROM pages),
k AS (SELECT page_id, href, CAST(CASE WHEN contains(lower(href), 'hour') THEN 0 WHEN regexp_matches(lower(href), 'locat|visit|find|contact') THEN 1 ELSE 2 END AS INT) AS class FROM h WHERE NOT regexp_matches(lower(href), '\\.(pdf|jpe?g|png)$'))
SELECT page_id, href, class, CAST(row_number() OVER (PARTITION BY page_id ORDER BY class, href) AS INT) AS rank FROM k QUALIFY rank <= 3"""


def spot_order(spark, d):
    """The order of a city's spots: shops, halls, menus; those with hours first; by lower-cased name."""
    p = places(spark, d).withColumn("kind", chosen(F.col("id"), ["menu", "shop", "hall"])).withColumn("no_hours", F.col("id") % 4 == 0).withColumn("area", cell(F.col("lat"), 1))
    order = F.when(F.col("kind") == "shop", 0).when(F.col("kind") == "hall", 1).otherwise(2)
    by = Window.partitionBy("area").orderBy(order, "no_hours", F.lower("name"), "id")
    return p.select("id", "area", F.row_number().over(by).alias("position"))


SPOT_ORDER = f"WITH {PLACES} SELECT id, CAST(trunc(lat) AS INT) AS area, CAST(row_number() OVER (PARTITION BY CAST(trunc(lat) AS INT) ORDER BY CASE {chosen_sql('id', ['menu', 'shop', 'hall'])} WHEN 'shop' THEN 0 WHEN 'hall' THEN 1 ELSE 2 END, id % 4 = 0, lower(name), id) AS INT) AS position FROM places"


def city_lists(spark, d):
    """States' cities by size: a state's 30 largest besides the largest, and the 24 largest of all."""
    c = places(spark, d).groupBy(cell(F.col("lat"), 1).alias("state"), "name").agg(F.count(F.lit(1)).alias("n"))
    ranked = c.withColumn("of_state", F.row_number().over(Window.partitionBy("state").orderBy(F.desc("n"), "name")))
    best = ranked.orderBy(F.desc("n"), "state", "name").limit(24).select("state", "name", F.lit(True).alias("top"))  # 24 rows
    return ranked.where("of_state <= 31").join(F.broadcast(best), ["state", "name"], "left").select("state", "name", "n", "of_state", F.coalesce("top", F.lit(False)).alias("top"))


CITY_LISTS = f"WITH {PLACES}, c AS (SELECT CAST(trunc(lat) AS INT) AS state, name, count(*) AS n FROM places GROUP BY 1, 2) SELECT state, name, n, CAST(row_number() OVER (PARTITION BY state ORDER BY n DESC, name) AS INT) AS of_state, row_number() OVER (ORDER BY n DESC, state, name) <= 24 AS top FROM c QUALIFY of_state <= 31"


def latest_events(spark, d):
    """The latest 20 events of each kind, with the total beside them."""
    a = activity(spark, d)
    latest = L.top_per(a, ["event_type"], [F.desc("ts"), F.desc("seq")], 20)
    return latest.join(F.broadcast(a.groupBy("event_type").agg(F.count(F.lit(1)).alias("total"), F.min("seq").alias("least"))), "event_type").where("seq >= least").select("event_type", "seq", "rank", "total")


LATEST_EVENTS = f"WITH {ACTIVITY} SELECT event_type, seq, CAST(row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, seq DESC) AS INT) AS rank, (SELECT count(*) FROM activity b WHERE b.event_type = a.event_type) AS total FROM activity a WHERE seq >= (SELECT min(seq) FROM activity) QUALIFY rank <= 20"


def open_order(spark, d):
    """Listings as shown: open ones, then unknown hours, then closed; their own order inside."""
    p = places(spark, d).withColumn("state", chosen(F.col("id"), ["closed", "open", "unknown", "closes soon"]))
    order = F.when(F.col("state").isin("open", "closes soon"), 0).when(F.col("state") == "unknown", 1).otherwise(2)
    return L.top_per(p.withColumn("city", cell(F.col("lat"), 1)), ["city"], [order, "id"], 1_000_000, "place").select("id", "state", F.col("place").alias("position"))


OPEN_ORDER = f"WITH {PLACES} SELECT id, {chosen_sql('id', ['closed', 'open', 'unknown', 'closes soon'])} AS state, CAST(row_number() OVER (PARTITION BY CAST(trunc(lat) AS INT) ORDER BY CASE id % 4 WHEN 0 THEN 2 WHEN 2 THEN 1 ELSE 0 END, id) AS INT) AS position FROM places"


def ways_found(spark, d):
    """Listings by the way they were found and by verdict, and the distinct signatures of trusted installs."""
    e = activity(spark, d)
    signatures = e.where("event_type = 'signup'").select((F.col("k") % 7).alias("sig")).distinct()
    marked = e.join(F.broadcast(signatures.withColumn("trusted", F.lit(True))), F.col("k") % 11 == F.col("sig"), "left")  # at most seven rows
    return marked.groupBy(F.col("event_type").alias("way")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("trusted").isNull()).alias("untrusted"), F.sum((F.col("stars") > 3).cast("int")).alias("good"))


WAYS_FOUND = f"WITH {ACTIVITY}, s AS (SELECT DISTINCT k % 7 AS sig FROM activity WHERE event_type = 'signup') SELECT event_type AS way, count(*) AS n, count(*) FILTER (k % 11 NOT IN (SELECT sig FROM s)) AS untrusted, CAST(sum(CASE WHEN stars > 3 THEN 1 ELSE 0 END) AS BIGINT) AS good FROM activity GROUP BY 1"


def first_installs(spark, d):
    """A device's first row, its nulls filled from the first later row that has a value."""
    a = activity(spark, d).select("device", "seq", F.col("event_type").alias("source"), F.when(F.col("k") % 3 == 0, (F.col("k") % 20).cast("int")).alias("city"), F.when(F.col("k") % 5 == 0, F.col("stars")).alias("region"))
    return first_filled(a, "device", "seq", ["source", "city", "region"])


FIRST_INSTALLS = f"WITH {ACTIVITY} SELECT device, arg_min(event_type, seq) AS source, CAST(arg_min(k % 20, seq) FILTER (k % 3 = 0) AS INT) AS city, arg_min(stars, seq) FILTER (k % 5 = 0) AS region FROM activity GROUP BY device"


def trouble_sites(spark, d):
    """Websites in trouble long enough and often enough to warn of, for hosts of one to three listings."""
    i = F.col("page_id")
    health = table(spark, d, "pages").where("page_id < 120").select(F.concat(F.lit("h"), i.cast("string"), F.lit(".example")).alias("host"), chosen(i, ["dns", "down", "parked"]).alias("bad"), F.date_sub(F.expr(TODAY), (i % 20).cast("int")).alias("first"), F.expr(TODAY).alias("last"), (i % 5).cast("int").alias("n"))
    listed = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.concat(F.lit("h"), F.when(F.col("c_custkey") % 7 == 0, 5).otherwise(F.col("c_custkey") % 400).cast("string"), F.lit(".example")).alias("h"))
    return C.site_trouble(health, listed)


TROUBLE_SITES = f"""WITH h AS (SELECT 'h' || CAST(page_id AS VARCHAR) || '.example' AS h, {chosen_sql('page_id', ['dns', 'down', 'parked'])} AS bad, page_id % 20 AS days, page_id % 5 AS n FROM pages WHERE page_id < 120),
l AS (SELECT 'h' || CAST(CASE WHEN c_custkey % 7 = 0 THEN 5 ELSE c_custkey % 400 END AS VARCHAR) || '.example' AS h, count(*) AS listings FROM customer GROUP BY 1)
SELECT h, 'site-' || bad AS why FROM h JOIN l USING (h) WHERE listings BETWEEN 1 AND 3 AND ((bad IN ('dns', 'parked') AND n >= 2 AND days >= 6) OR (bad = 'down' AND n >= 3 AND days >= 14))"""


def pulled_list(spark, d):
    """The published hides with the pulled entries replaced as a whole, and whether anything changed; warnings they match go."""
    i = F.col("s_suppkey")
    hides = table(spark, d, "supplier").select(F.concat(F.lit("k"), i.cast("string")).alias("k"), chosen(i, ["manual", "dev", "reports"]).alias("why"))
    pulled = table(spark, d, "supplier").where("s_suppkey % 4 = 1").select(F.concat(F.lit("k"), i.cast("string")).alias("k"))
    out, changed = C.with_pulled(hides, pulled)
    return out.groupBy("why").agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("least")).join(changed)


PULLED_LIST = f"""WITH h AS (SELECT 'k' || CAST(s_suppkey AS VARCHAR) AS k, {chosen_sql('s_suppkey', ['manual', 'dev', 'reports'])} AS why, s_suppkey AS i FROM supplier), o AS (SELECT k, why FROM h WHERE why <> 'dev' UNION ALL SELECT k, 'dev' FROM h WHERE i % 4 = 1)
SELECT why, count(*) AS n, min(k) AS least, (SELECT bool_or((i % 3 = 1) <> (i % 4 = 1)) FROM h) AS changed FROM o GROUP BY why"""


def open_updates(spark, d):
    """Owners' posted closures that have passed drop off."""
    i = F.col("s_suppkey")
    u = table(spark, d, "supplier").select(i.alias("id"), F.when(i % 3 > 0, F.date_add(F.expr(TODAY), ((i % 9) - 4).cast("int"))).alias("closed_to"))
    return u.select("id", F.when(F.col("closed_to") >= F.expr(TODAY), F.col("closed_to")).alias("closed_to"))


OPEN_UPDATES = f"SELECT s_suppkey AS id, CASE WHEN s_suppkey % 3 > 0 AND s_suppkey % 9 >= 4 THEN {TODAY} + CAST(s_suppkey % 9 - 4 AS INT) END AS closed_to FROM supplier"


def resync_due(spark, d):
    """Subscriptions to ask about again: those not final, least recently asked, 40 of them, and 20 sign-ups that are pending."""
    i = F.col("o_orderkey")
    o = table(spark, d, "orders").select(i.alias("sub"), chosen(i, ["ACTIVE", "CANCELLED", "SUSPENDED", "PENDING"]).alias("status"), (i * 7 % 10007).alias("asked"))
    live = o.where("status in ('ACTIVE', 'SUSPENDED')").orderBy("asked", "sub").limit(40)
    return live.unionByName(o.where("status = 'PENDING'").orderBy("asked", "sub").limit(20))


RESYNC_DUE = f"WITH o AS (SELECT o_orderkey AS sub, {chosen_sql('o_orderkey', ['ACTIVE', 'CANCELLED', 'SUSPENDED', 'PENDING'])} AS status, o_orderkey * 7 % 10007 AS asked FROM orders) (SELECT * FROM o WHERE status IN ('ACTIVE', 'SUSPENDED') ORDER BY asked, sub LIMIT 40) UNION ALL (SELECT * FROM o WHERE status = 'PENDING' ORDER BY asked, sub LIMIT 20)"


def closure_build(spark, d):
    """Hides and warnings from all signals: by hand, reports, automatic signals not found open, site trouble, two kinds of warnings;
    confirmed places lose warnings and weak hides. Rolling overrides run this again on the same tables."""
    i = F.col("id")
    listed = written(places(spark, d).where("id < 300").select("id", "name", F.concat(F.lit("k"), i.cast("string")).alias("k"), F.concat(F.lit("h"), i.cast("string"), F.lit(".example")).alias("h"), "lat", "lon", F.lit("1 Elm St, Troy, NY").alias("address")))
    entry = lambda rows, why, host=False: rows.select((F.lit(None).cast("string") if host else F.col("k")).alias("k"), (F.col("h") if host else F.lit(None).cast("string")).alias("h"), F.lit(None).cast("string").alias("n"), F.lit(None).cast("double").alias("la"), F.lit(None).cast("double").alias("lo"), F.lit(why).alias("why"), F.lit("").alias("t"))
    opens = listed.where("id % 6 = 0").select("k", F.date_sub(F.expr(TODAY), (i % 200).cast("int")).alias("last"))
    hidden, warned = C.fuse(listed, entry(listed.where("id % 41 = 0"), "manual"), entry(listed.where("id % 23 = 0"), "reports"), entry(listed.where("id % 7 = 0"), "report"), opens, entry(listed.where("id % 10 = 0"), "foursquare"), entry(listed.where("id % 14 = 0"), "site-dns", True), entry(listed.where("id % 35 = 0"), "confirmed"), dt.date(2026, 10, 1), written)
    return hidden.withColumn("part", F.lit("hide")).unionByName(warned.withColumn("part", F.lit("warn"))).groupBy("part", "why").agg(F.count(F.lit(1)).alias("n"))


CLOSURE_BUILD = """WITH l AS (SELECT c_custkey AS id FROM customer WHERE c_custkey < 300), o AS (SELECT id, id % 6 = 0 AND id % 200 <= 120 AS opened, id % 35 = 0 AS sure FROM l),
e AS (SELECT id, 'hide' AS part, 'manual' AS why FROM o WHERE id % 41 = 0 UNION ALL SELECT id, 'hide', 'reports' FROM o WHERE id % 23 = 0 UNION ALL SELECT id, 'hide', 'foursquare' FROM o WHERE id % 10 = 0 AND NOT opened AND NOT sure
UNION ALL SELECT id, 'warn', 'report' FROM o WHERE id % 7 = 0 AND NOT sure UNION ALL SELECT id, 'warn', 'site-dns' FROM o WHERE id % 14 = 0 AND NOT opened AND NOT sure UNION ALL SELECT id, 'hide', 'signals' FROM o WHERE id % 14 = 0 AND NOT opened AND NOT sure)
SELECT part, why, count(*) AS n FROM e GROUP BY ALL"""
