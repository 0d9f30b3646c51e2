"""Place and page queries: (Spark, DuckDB SQL) under each name."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U
from ..functions.geo import cell, grid_join, haversine, nearest, planar
from ..operators.listings import near_spot, spot_cells
from ..operators.match import by_keys, greedy_dedupe, same_place
from ..operators.windows import keep_last_good
from ..sources.adapters import HOST, METRES, PLACES, others, places, table, written

FILLER = ("the", "and", "restaurant", "house")


def _a():
    return {"name": F.col("name"), "lat": F.col("lat"), "lon": F.col("lon"), "host": F.col("host")}


def _b():
    return {"name": F.col("bname"), "lat": F.col("blat"), "lon": F.col("blon"), "host": F.col("bhost")}


def _same():
    return same_place(_a(), _b(), lambda n: T.words(n, FILLER))


def _words(x):
    return f"list_filter(regexp_split_to_array(lower({x}), '[^a-z0-9]+'), lambda w: length(w) >= 3 AND w NOT IN ('the', 'and', 'restaurant', 'house'))"


_D = METRES.format(a="", b="b")
SAME = f"({_D} <= 150 AND (lower(trim(name)) = lower(trim(bname)) OR ({_D} < 20 AND (contains(lower(name), lower(bname)) OR contains(lower(bname), lower(name)))) OR ({_D} < 120 AND list_has_any({_words('name')}, {_words('bname')})) OR (host <> '' AND host = bhost AND {_D} < 150)))"


def place_semi(spark, d):
    """Places that a second source has too, by grid cell."""
    return grid_join(places(spark, d), others(spark, d), 150, _same(), how="left_semi").select("id", "name")


PLACE_SEMI = f"WITH {PLACES} SELECT id, name FROM places WHERE EXISTS (SELECT 1 FROM others WHERE blat BETWEEN lat - 0.01 AND lat + 0.01 AND {SAME})"


def place_anti(spark, d):
    """Places of the second source that the first lacks."""
    a, b = places(spark, d), others(spark, d)
    swapped = b.select(F.col("bid").alias("id"), F.col("bname").alias("name"), F.col("blat").alias("lat"), F.col("blon").alias("lon"), F.col("bhost").alias("host"))
    back = a.select(F.col("id").alias("bid"), F.col("name").alias("bname"), F.col("lat").alias("blat"), F.col("lon").alias("blon"), F.col("host").alias("bhost"))
    return grid_join(swapped, back, 150, _same(), how="left_anti").select("id", "name")


PLACE_ANTI = f"WITH {PLACES} SELECT bid AS id, bname AS name FROM others WHERE NOT EXISTS (SELECT 1 FROM places WHERE blat BETWEEN lat - 0.01 AND lat + 0.01 AND {SAME})"


def place_dedupe(spark, d):
    """Greedy admission in id order: a place stays unless it is the same as one that stayed before."""
    p = places(spark, d)
    b = p.select(F.col("id").alias("bid"), F.col("name").alias("bname"), F.col("lat").alias("blat"), F.col("lon").alias("blon"), F.col("host").alias("bhost"))
    links = grid_join(p, b, 150, (F.col("id") < F.col("bid")) & _same()).select(F.col("id").alias("a"), F.col("bid").alias("b"))
    return greedy_dedupe(p.select("id", F.col("id").alias("seq")), links, written)


def nearest_k(spark, d):
    """The three nearest places of the first source around each one of the second, within 300 m."""
    pairs = grid_join(places(spark, d), others(spark, d), 300).select("bid", "id", F.round(haversine(F.col("lat"), F.col("lon"), F.col("blat"), F.col("blon")), 2).alias("metres"))
    return nearest(pairs, "bid", "metres", "id", 3)


NEAREST_K = f"WITH {PLACES}, pairs AS (SELECT bid, id, round({_D}, 2) AS metres FROM others JOIN places ON blat BETWEEN lat - 0.01 AND lat + 0.01 WHERE {_D} <= 300) SELECT bid, id, metres, CAST(row_number() OVER (PARTITION BY bid ORDER BY metres, id) AS INT) AS rank FROM pairs QUALIFY rank <= 3"


def cell_histogram(spark, d):
    return places(spark, d).groupBy(cell(F.col("lat")).alias("ci"), cell(F.col("lon")).alias("cj")).agg(F.count(F.lit(1)).alias("n"))


CELL_HISTOGRAM = f"WITH {PLACES} SELECT CAST(trunc(lat * 100) AS INT) AS ci, CAST(trunc(lon * 100) AS INT) AS cj, count(*) AS n FROM places GROUP BY 1, 2"


def metro_members(spark, d):
    """Places within 25 km of fixed points; the points are a table of constants."""
    points = spark.createDataFrame([("south", 28.0, -80.0), ("middle", 35.0, -95.0), ("north", 45.0, -110.0)], "metro string, mlat double, mlon double")
    near = (F.abs(F.col("lat") - F.col("mlat")) < 4) & (planar(F.col("lat"), F.col("lon"), F.col("mlat"), F.col("mlon"), 111.0) <= 250)
    return places(spark, d).join(F.broadcast(points), near).groupBy("metro").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("host").alias("hosts"))


METRO_MEMBERS = f"WITH {PLACES}, points(metro, mlat, mlon) AS (VALUES ('south', 28.0::DOUBLE, -80.0::DOUBLE), ('middle', 35.0, -95.0), ('north', 45.0, -110.0)) SELECT metro, count(*) AS n, count(DISTINCT host) AS hosts FROM places JOIN points ON abs(lat - mlat) < 4 AND 111.0::DOUBLE * sqrt(pow(mlat - lat, 2) + pow((mlon - lon) * cos(radians((lat + mlat) / 2)), 2)) <= 250 GROUP BY metro"


def multi_key_match(spark, d):
    """Second-source places looked up by exact spot, else by host, else by name in one area."""
    spot = lambda la, lo: F.concat_ws(",", F.round(la * 1000).cast("bigint").cast("string"), F.round(lo * 1000).cast("bigint").cast("string"))
    e = others(spark, d).select("bid", spot(F.col("blat"), F.col("blon")).alias("spot"), F.nullif(F.col("bhost"), F.lit("")).alias("host"), F.concat_ws("@", "bname", cell(F.col("blat"), 10), cell(F.col("blon"), 10)).alias("name"))
    items = places(spark, d).select("id", spot(F.col("lat"), F.col("lon")).alias("spot"), F.nullif(F.col("host"), F.lit("")).alias("host"), F.concat_ws("@", "name", cell(F.col("lat"), 10), cell(F.col("lon"), 10)).alias("name"))
    return by_keys(e, items, ["spot", "host", "name"], "bid", "id").groupBy("bid", "way").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"))


_SPOT = "CAST(CAST(round({0}lat * 1000) AS BIGINT) AS VARCHAR) || ',' || CAST(CAST(round({0}lon * 1000) AS BIGINT) AS VARCHAR)"
MULTI_KEY_MATCH = f"""WITH {PLACES}, f AS (SELECT bid, id, 0 AS r, 'spot' AS way FROM others JOIN places ON {_SPOT.format('b')} = {_SPOT.format('')} UNION ALL SELECT bid, id, 1, 'host' FROM others JOIN places ON bhost = host AND host <> '' UNION ALL SELECT bid, id, 2, 'name' FROM others JOIN places ON bname = name AND trunc(blat * 10) = trunc(lat * 10) AND trunc(blon * 10) = trunc(lon * 10))
SELECT bid, way, count(*) AS n, min(id) AS least FROM f WHERE r = (SELECT min(r) FROM f g WHERE g.bid = f.bid) GROUP BY bid, way"""


def hand_fix(spark, d):
    """A fix table (every 50th place moved and renamed) joined by name and spot; applied fixes do not apply again."""
    p = places(spark, d)
    fixes = p.where("id % 50 = 0").select(F.col("name").alias("fname"), F.col("lat").alias("flat"), F.col("lon").alias("flon"), F.concat(F.lit("New "), "name").alias("new_name"))
    # By name and grid cell: a name that many places share is no hot key.
    fixes, p = spot_cells(fixes, "flat", "flon", ("fi", "fj"), True), spot_cells(p, "lat", "lon", ("ci", "cj"), False)
    at = (F.lower(F.trim("name")) == F.lower(F.trim("fname"))) & (F.col("ci") == F.col("fi")) & (F.col("cj") == F.col("fj")) & near_spot(F.col("lat"), F.col("lon"), F.col("flat"), F.col("flon"))
    return p.join(fixes, at, "left").select("id", F.coalesce("new_name", "name").alias("name"), F.col("new_name").isNotNull().alias("fixed"))


HAND_FIX = f"WITH {PLACES}, f AS (SELECT name AS fname, lat AS flat, lon AS flon, 'New ' || name AS new_name FROM places WHERE id % 50 = 0) SELECT id, coalesce(new_name, name) AS name, new_name IS NOT NULL AS fixed FROM places LEFT JOIN f ON lower(trim(name)) = lower(trim(fname)) AND abs(lat - flat) < 2e-4 AND abs(lon - flon) < 2e-4"


def city_rollup(spark, d):
    """Places by nation ("state") and slug of segment ("city"): spelling merged, centroid, threshold, then the state's sums."""
    c = table(spark, d, "customer").select("c_nationkey", F.when(F.col("c_custkey") % 5 == 0, F.upper("c_mktsegment")).otherwise(F.initcap(F.lower("c_mktsegment"))).alias("city"), "c_acctbal")
    spelt = c.groupBy("c_nationkey", T.slug(F.col("city")).alias("slug"), "city").agg(F.count(F.lit(1)).alias("n"), F.sum("c_acctbal").alias("bal"))
    cities = spelt.groupBy("c_nationkey", "slug").agg(F.max_by("city", F.struct("n", "city")).alias("city"), F.sum("n").alias("n"), F.round(F.sum("bal") / F.sum("n"), 2).alias("mean"))
    total = F.sum("n").over(Window.partitionBy("c_nationkey"))
    return cities.withColumn("of_state", total).where("n >= 3")


CITY_ROLLUP = """WITH c AS (SELECT c_nationkey, CASE WHEN c_custkey % 5 = 0 THEN upper(c_mktsegment) ELSE upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) END AS city, c_acctbal FROM customer),
s AS (SELECT c_nationkey, trim(regexp_replace(lower(city), '[^a-z0-9]+', '-', 'g'), '-') AS slug, city, count(*) AS n, sum(c_acctbal) AS bal FROM c GROUP BY 1, 2, 3),
g AS (SELECT c_nationkey, slug, arg_max(city, (n, city)) AS city, CAST(sum(n) AS BIGINT) AS n, round(sum(bal) / sum(n), 2) AS mean FROM s GROUP BY 1, 2)
SELECT * FROM (SELECT *, CAST(sum(n) OVER (PARTITION BY c_nationkey) AS BIGINT) AS of_state FROM g) WHERE n >= 3"""


def url_keys(spark, d):
    u = F.col("url")
    return table(spark, d, "pages").select("page_id", U.host_of(u).alias("host"), U.site_key(u).alias("site"), U.page_key(u).alias("page"), U.registrable(U.host_of(u)).alias("domain"), U.last_labels(U.host_of(u)).alias("labels"), U.same_page(u).alias("same"))


_P = "regexp_replace(lower(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1)), '/+$', '')"
_PX = "regexp_replace(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/+$', '')"
_AUTH = "regexp_replace(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1), '^www\\.', '')"
URL_KEYS = f"""SELECT page_id, {HOST} AS host, lower({_AUTH} || {_PX}) AS site, CASE WHEN {_P} <> '' AND NOT regexp_matches({_P}, '\\.(pdf|jpg|png)$') THEN {HOST} || {_P} END AS page,
CASE WHEN regexp_matches({HOST}, '\\.(co|com|net|org|gov|edu|ac)\\.[a-z]{{2}}$') THEN regexp_extract({HOST}, '[^.]+\\.[^.]+\\.[^.]+$') ELSE regexp_extract({HOST}, '[^.]+\\.[^.]+$') END AS domain, regexp_extract({HOST}, '[^.]+\\.[^.]+$') AS labels,
{HOST} || {_PX} || CASE WHEN contains(url, '?') THEN '?' || regexp_extract(url, '\\?([^#]*)', 1) ELSE '' END AS same FROM pages"""


def host_counts(spark, d):
    return table(spark, d, "pages").groupBy(U.host_of(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("n"))


HOST_COUNTS = f"SELECT {HOST} AS host, count(*) AS n FROM pages GROUP BY 1"


def single_host(spark, d):
    """Pages whose host has few pages only: a chain's host stays out."""
    few = host_counts(spark, d).where("n <= 3").select("host")
    return table(spark, d, "pages").select("page_id", U.host_of(F.col("url")).alias("host")).join(few, "host").select("page_id", "host")


SINGLE_HOST = f"WITH p AS (SELECT page_id, {HOST} AS host FROM pages) SELECT page_id, host FROM p WHERE host IN (SELECT host FROM p GROUP BY host HAVING count(*) <= 3)"


def blocked_hosts(spark, d):
    """Pages by rule: blocked when their host is or is under a listed domain, or contains a listed part."""
    listed = ["example.com", "example.org"]
    h = U.host_of(F.col("url"))
    blocked = F.lit(False)
    for x in listed:
        blocked = blocked | U.under(h, F.lit(x))
    return table(spark, d, "pages").select("page_id", blocked.alias("blocked"), F.contains(h, F.lit("site")).alias("platform"))


BLOCKED_HOSTS = f"WITH p AS (SELECT page_id, {HOST} AS host FROM pages) SELECT page_id, host = 'example.com' OR host LIKE '%.example.com' OR host = 'example.org' OR host LIKE '%.example.org' AS blocked, contains(host, 'site') AS platform FROM p"


def claim_codes(spark, d):
    hosts = host_counts(spark, d).select("host")
    return hosts.select("host", T.claim_code(F.col("host"), "claim:", "pl-").alias("code"))


CLAIM_CODES = f"SELECT DISTINCT {HOST} AS host, 'pl-' || substr(sha256('claim:' || {HOST}), 1, 6) AS code FROM pages"


def shard_today(spark, d):
    """A seventh of the hosts each day: the host's 256-bit hash modulo 7 equals the day's ordinal modulo 7."""
    digits = F.split(F.sha2("host", 256), "")
    mod = F.aggregate(F.filter(digits, lambda x: x != ""), F.lit(0), lambda a, x: ((a * 16 + F.conv(x, 16, 10).cast("int")) % 7).cast("int"))
    return host_counts(spark, d).select("host", mod.alias("shard"), (mod == 19723 % 7).alias("today"))


SHARD_TODAY = f"WITH h AS (SELECT DISTINCT {HOST} AS host FROM pages), m AS (SELECT host, CAST(list_reduce(list_prepend(0, list_transform(string_split(sha256(host), ''), lambda x: CAST(instr('0123456789abcdef', x) - 1 AS BIGINT))), lambda a, x: (a * 16 + x) % 7) AS INT) AS shard FROM h) SELECT host, shard, shard = 19723 % 7 AS today FROM m"


def link_rank(spark, d):
    """The three best links of a page by words in them, first position first among equals."""
    hrefs = F.regexp_extract_all("html", F.lit(r'href="([^"]+)"'), F.lit(1))
    links = table(spark, d, "pages").select("page_id", F.posexplode(hrefs).alias("pos", "href"))
    score = F.when(F.col("href").rlike("(?i)menu|food"), 3).otherwise(0) + F.when(F.col("href").rlike("(?i)about|home|/a"), 1).otherwise(0) - F.when(F.col("href").rlike("(?i)login|gift"), 5).otherwise(0) + 1
    once = links.groupBy("page_id", "href").agg(F.min("pos").alias("pos")).withColumn("score", score).where("score > 0")
    order = Window.partitionBy("page_id").orderBy(F.desc("score"), "pos")
    return once.withColumn("rank", F.row_number().over(order)).where("rank <= 3")


LINK_RANK = """WITH l AS (SELECT page_id, unnest(x) AS href, CAST(generate_subscripts(x, 1) - 1 AS INT) AS pos FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]+)"', 1) AS x FROM pages)),
o AS (SELECT page_id, href, min(pos) AS pos FROM l GROUP BY 1, 2), s AS (SELECT *, CAST(CASE WHEN regexp_matches(href, '(?i)menu|food') THEN 3 ELSE 0 END + CASE WHEN regexp_matches(href, '(?i)about|home|/a') THEN 1 ELSE 0 END - CASE WHEN regexp_matches(href, '(?i)login|gift') THEN 5 ELSE 0 END + 1 AS INT) AS score FROM o)
SELECT page_id, href, pos, score, CAST(row_number() OVER (PARTITION BY page_id ORDER BY score DESC, pos) AS INT) AS rank FROM s WHERE score > 0 QUALIFY rank <= 3"""


def word_boundary(spark, d):
    """Pages with the word as a beginning of a word: one regular expression with a lookbehind."""
    return table(spark, d, "pages").select("page_id", F.lower("html").rlike("(?<![a-z])ramen").alias("found"))


WORD_BOUNDARY = "SELECT page_id, regexp_matches(lower(html), '(^|[^a-z])ramen') AS found FROM pages"


def due_queue(spark, d):
    """Sites due for a check: class 0 new, 1 outdated rules, 2 aged by status; oldest first; limited to 40 sites, not rows."""
    policy = spark.createDataFrame([("none", 90), ("shop", 30), ("error", 14)], "kind string, days int")
    i = F.col("page_id")
    s = table(spark, d, "pages").select("page_id", U.host_of(F.col("url")).alias("host"), F.when(i % 3 == 0, "none").when(i % 3 == 1, "shop").otherwise("error").alias("kind"), (i % 9).cast("int").alias("rules"), (i * 13 % 120).cast("int").alias("age"))
    s = s.join(F.broadcast(policy), "kind")
    prio = F.when(i % 10 == 0, 0).when((F.col("rules") < 7) & (F.col("kind") == "shop"), 1).when(F.col("age") >= F.col("days"), 2)
    due = s.withColumn("prio", prio).where("prio is not null")
    first = due.groupBy("host").agg(F.min(F.struct("prio", F.negative("age").alias("a"), "page_id")).alias("first"))
    admitted = first.orderBy("first", "host").limit(40).select("host")
    return due.join(F.broadcast(admitted), "host", "left_semi").select("page_id", "host", "prio", "age")


DUE_QUEUE = f"""WITH s AS (SELECT page_id, {HOST} AS host, CASE page_id % 3 WHEN 0 THEN 'none' WHEN 1 THEN 'shop' ELSE 'error' END AS kind, page_id % 9 AS rules, CAST(page_id * 13 % 120 AS INT) AS age FROM pages),
due AS (SELECT page_id, host, CAST(CASE WHEN page_id % 10 = 0 THEN 0 WHEN rules < 7 AND kind = 'shop' THEN 1 WHEN age >= CASE kind WHEN 'none' THEN 90 WHEN 'shop' THEN 30 ELSE 14 END THEN 2 END AS INT) AS prio, age FROM s),
f AS (SELECT host, min((prio, -age, page_id)) AS first FROM due WHERE prio IS NOT NULL GROUP BY host ORDER BY first, host LIMIT 40)
SELECT page_id, host, prio, age FROM due WHERE prio IS NOT NULL AND host IN (SELECT host FROM f)"""


def last_good(spark, d):
    """New results replace old ones; missing ones keep the old for a time."""
    p = table(spark, d, "pages").select("page_id", F.length("html").cast("bigint").alias("size"))
    new = p.where("page_id % 3 <> 0")
    old = p.where("page_id % 2 = 0").select("page_id", (F.col("size") - 1).alias("size"), (F.col("page_id") % 100).alias("age"))
    return keep_last_good(new, old, "page_id", "size", "age", 60)


LAST_GOOD = """WITH p AS (SELECT page_id, CAST(length(html) AS BIGINT) AS size FROM pages), n AS (SELECT * FROM p WHERE page_id % 3 <> 0), o AS (SELECT page_id, size - 1 AS size, page_id % 100 AS age FROM p WHERE page_id % 2 = 0)
SELECT coalesce(n.page_id, o.page_id) AS page_id, coalesce(n.size, CASE WHEN age <= 60 THEN o.size END) AS size, CASE WHEN n.size IS NOT NULL THEN 'new' WHEN age <= 60 THEN 'kept' ELSE 'gone' END AS origin FROM n FULL JOIN o ON n.page_id = o.page_id"""


def tz_assign(spark, d):
    """Time zone by state rules with a split by longitude, default Eastern."""
    zone = F.when((F.col("id") % 25 == 3) & (F.col("lon") < -90), "America/Denver").when(F.col("id") % 25 == 3, "America/Chicago").when(F.col("id") % 25 < 8, "America/Chicago").when(F.col("id") % 25 > 20, "America/Los_Angeles").otherwise("America/New_York")
    return places(spark, d).groupBy(zone.alias("zone")).agg(F.count(F.lit(1)).alias("n"))


TZ_ASSIGN = f"WITH {PLACES} SELECT CASE WHEN id % 25 = 3 AND lon < -90 THEN 'America/Denver' WHEN id % 25 = 3 THEN 'America/Chicago' WHEN id % 25 < 8 THEN 'America/Chicago' WHEN id % 25 > 20 THEN 'America/Los_Angeles' ELSE 'America/New_York' END AS zone, count(*) AS n FROM places GROUP BY 1"


def rule_cascade(spark, d):
    """Why a place belongs: the first rule that holds names it."""
    n = F.lower("name")
    why = F.when(n.rlike("automobile"), "app").when(n.rlike("(?<![a-z])house"), "name").when(F.col("id") % 40 == 7, "brand").when(F.col("host").rlike("[0-9]"), "site")
    return places(spark, d).select("id", why.alias("why"), F.round(F.col("lat"), 6).alias("lat"))


RULE_CASCADE = f"WITH {PLACES} SELECT id, CASE WHEN regexp_matches(lower(name), 'automobile') THEN 'app' WHEN regexp_matches(lower(name), '(^|[^a-z])house') THEN 'name' WHEN id % 40 = 7 THEN 'brand' WHEN regexp_matches(host, '[0-9]') THEN 'site' END AS why, round(lat, 6) AS lat FROM places"


def addresses(spark, d):
    """Addresses built from parts that may be missing, and taken apart again."""
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    joined = c.join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
    a = joined.select("c_custkey", T.joined_address(F.when(F.col("c_custkey") % 4 > 0, F.concat(F.col("c_custkey").cast("string"), F.lit(" Main St"))), F.initcap("c_mktsegment"), F.concat(F.upper(F.substring("n_name", 1, 2)), F.lit(" 0"), F.col("c_nationkey").cast("string"))).alias("address"))
    s = T.split_address(F.col("address"))
    return a.select("c_custkey", "address", s["city"].alias("city"), s["state"].alias("state"), s["house"].alias("house"))


ADDRESSES = """WITH a AS (SELECT c_custkey, concat_ws(', ', CASE WHEN c_custkey % 4 > 0 THEN CAST(c_custkey AS VARCHAR) || ' Main St' END, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]), upper(substr(n_name, 1, 2)) || ' 0' || CAST(c_nationkey AS VARCHAR)) AS address FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, address, string_split(address, ', ')[-2] AS city, nullif(regexp_extract(string_split(address, ', ')[-1], '^([A-Z]{2})\\b', 1), '') AS state, nullif(regexp_extract(address, '^(\\d+)\\b', 1), '') AS house FROM a"""


def search_words(spark, d):
    """The first 25 places, in order, whose name has every word of a query."""
    return places(spark, d).where(T.all_words(F.col("name"), "build 1")).orderBy("id").limit(25).select("id", "name")


SEARCH_WORDS = f"WITH {PLACES} SELECT id, name FROM places WHERE contains(lower(name), 'build') AND contains(lower(name), '1') ORDER BY id LIMIT 25"


def nick_keys(spark, d):
    return table(spark, d, "part").select("p_partkey", T.nick_key(F.col("p_name")).alias("key"), T.slug(F.col("p_type")).alias("slug"))


NICK_KEYS = "SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(" + "regexp_replace(translate(lower(p_name), '0134578$@', 'oieastbsa'), '[^a-z]', '', 'g')" + "".join(f", '{c}{c}+', '{c}', 'g')" for c in "abcdefghijklmnopqrstuvwxyz") + ", '^$', '', 'g') AS key, trim(regexp_replace(lower(p_type), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM part"


def set_operations(spark, d):
    """Pages wanted but not present, present but no longer wanted, and both."""
    p = table(spark, d, "pages")
    wanted, there = p.where("page_id % 3 = 0").select("page_id"), p.where("page_id % 2 = 0").select("page_id")
    return wanted.exceptAll(there).withColumn("act", F.lit("write")).union(there.exceptAll(wanted).withColumn("act", F.lit("delete"))).union(wanted.intersect(there).withColumn("act", F.lit("keep")))


SET_OPERATIONS = "WITH w AS (SELECT page_id FROM pages WHERE page_id % 3 = 0), t AS (SELECT page_id FROM pages WHERE page_id % 2 = 0) SELECT page_id, 'write' AS act FROM (SELECT * FROM w EXCEPT ALL SELECT * FROM t) UNION ALL SELECT page_id, 'delete' FROM (SELECT * FROM t EXCEPT ALL SELECT * FROM w) UNION ALL SELECT page_id, 'keep' FROM (SELECT * FROM w INTERSECT SELECT * FROM t)"


def sitemap(spark, d):
    """Sorted distinct page addresses of each host as one text."""
    p = table(spark, d, "pages").select(U.host_of(F.col("url")).alias("host"), U.same_page(F.col("url")).alias("loc")).distinct()
    return p.groupBy("host").agg(F.array_join(F.transform(F.array_sort(F.collect_list("loc")), lambda x: F.concat(F.lit("<loc>"), x, F.lit("</loc>"))), "").alias("map"))


SITEMAP = f"WITH p AS (SELECT DISTINCT {HOST} AS host, {HOST} || {_PX} || CASE WHEN contains(url, '?') THEN '?' || regexp_extract(url, '\\?([^#]*)', 1) ELSE '' END AS loc FROM pages) SELECT host, string_agg('<loc>' || loc || '</loc>', '' ORDER BY loc) AS map FROM p GROUP BY host"
