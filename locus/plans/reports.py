"""Report queries over activity, reports, installs and subscriptions: (Spark, DuckDB SQL) under each name."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.geo import haversine
from ..operators.windows import capped, first_write, last_write, longest_run
from ..sources.adapters import ACTIVITY, METRES, REPORTS, SUBS, activity, reports, subs, table

TODAY = "DATE '2024-02-01'"


def rating_averages(spark, d):
    a = activity(spark, d).withColumn("shop", F.col("seq") * 7 % 3000).select("shop", "device", "stars", "seq")
    return last_write(a, ["shop", "device"], "seq").groupBy("shop").agg(F.round(F.avg("stars"), 1).alias("average"), F.count(F.lit(1)).alias("n")).where("n >= 3")


RATING_AVERAGES = f"WITH {ACTIVITY}, last AS (SELECT seq * 7 % 3000 AS shop, device, arg_max(stars, seq) AS stars FROM activity GROUP BY 1, 2) SELECT shop, round(avg(stars), 1) AS average, count(*) AS n FROM last GROUP BY shop HAVING count(*) >= 3"


def closed_reports(spark, d):
    r = last_write(reports(spark, d).select("shop", "device", "kind", "day", "seq"), ["shop", "device"], "seq").where(F.col("day") >= F.expr(f"{TODAY} - INTERVAL 365 DAYS"))
    closed, here = F.col("kind").startswith("closed"), F.col("kind") == "closed-here"
    g = r.groupBy("shop").agg(F.count_distinct(F.when(closed, F.col("device"))).alias("n"), F.count_distinct(F.when(here, F.col("device"))).alias("here"), F.max(F.when(closed, F.col("day"))).alias("last_closed"), F.max(F.when(~closed, F.col("day"))).alias("last_open"))
    return g.where("n > 0 and (last_open is null or last_open < last_closed)").select("shop", "n", "here", "last_closed", F.when((F.col("n") >= 2) | (F.col("here") >= 1), "hide").otherwise("warn").alias("verdict"))


CLOSED_REPORTS = f"""WITH {REPORTS}, last AS (SELECT shop, device, arg_max(kind, seq) AS kind, arg_max(day, seq) AS day FROM reports GROUP BY 1, 2),
g AS (SELECT shop, count(DISTINCT device) FILTER (kind LIKE 'closed%') AS n, count(DISTINCT device) FILTER (kind = 'closed-here') AS here, max(day) FILTER (kind LIKE 'closed%') AS last_closed, max(day) FILTER (kind NOT LIKE 'closed%') AS last_open FROM last WHERE day >= DATE '2024-02-01' - INTERVAL 365 DAY GROUP BY shop)
SELECT shop, n, here, last_closed, CASE WHEN n >= 2 OR here >= 1 THEN 'hide' ELSE 'warn' END AS verdict FROM g WHERE n > 0 AND (last_open IS NULL OR last_open < last_closed)"""


def open_overrides(spark, d):
    r = reports(spark, d)
    opened = r.where("kind = 'open-here'").groupBy("shop").agg(F.max("day").alias("opened"))
    closed = r.where("kind = 'closed'").groupBy("shop", "day").agg(F.count(F.lit(1)).alias("n"))
    late = (F.col("opened") > F.col("day")) & (F.datediff("opened", "day") <= 10)
    return closed.join(opened.withColumnRenamed("shop", "s"), (F.col("shop") == F.col("s")) & late, "left_anti")


OPEN_OVERRIDES = f"WITH {REPORTS}, opened AS (SELECT shop, max(day) AS opened FROM reports WHERE kind = 'open-here' GROUP BY 1) SELECT shop, day, count(*) AS n FROM reports r WHERE kind = 'closed' AND NOT EXISTS (SELECT 1 FROM opened o WHERE o.shop = r.shop AND o.opened > r.day AND o.opened - r.day <= 10) GROUP BY 1, 2"


def activity_pivot(spark, d):
    a = activity(spark, d)
    kinds = ["click", "error", "purchase", "signup", "view"]
    stats = a.groupBy("shop").pivot("event_type", kinds).agg(F.count(F.lit(1))).fillna(0)
    people = a.groupBy("shop", "device").agg(F.count(F.lit(1)).alias("n")).groupBy("shop").agg(F.count(F.lit(1)).alias("people"), F.count_if(F.col("n") >= 2).alias("again"))
    return stats.join(people, "shop", "left").select("shop", *kinds, "people", "again")


ACTIVITY_PIVOT = f"WITH {ACTIVITY}, p AS (SELECT shop, count(*) AS people, count(*) FILTER (n >= 2) AS again FROM (SELECT shop, device, count(*) AS n FROM activity GROUP BY 1, 2) GROUP BY 1) SELECT shop, " + ", ".join(f"count(*) FILTER (event_type = '{k}') AS {k}" for k in ("click", "error", "purchase", "signup", "view")) + ", any_value(people) AS people, any_value(again) AS again FROM activity LEFT JOIN p USING (shop) GROUP BY shop"


def people_repeat(spark, d):
    who = F.substring(F.sha2(F.concat(F.lit("salt|"), F.date_format("day", "yyyy-MM"), F.lit("|"), F.col("device").cast("string")), 256), 1, 16)
    v = activity(spark, d).groupBy("shop", who.alias("who")).agg(F.count(F.lit(1)).alias("n"))
    return v.groupBy("shop").agg(F.count(F.lit(1)).alias("people"), F.count_if(F.col("n") >= 2).alias("again"), F.min("who").alias("first_id"))


PEOPLE_REPEAT = f"WITH {ACTIVITY}, v AS (SELECT shop, substr(sha256('salt|' || strftime(day, '%Y-%m') || '|' || CAST(device AS VARCHAR)), 1, 16) AS who, count(*) AS n FROM activity GROUP BY 1, 2) SELECT shop, count(*) AS people, count(*) FILTER (n >= 2) AS again, min(who) AS first_id FROM v GROUP BY shop"


def busy_hours(spark, d):
    return activity(spark, d).groupBy(F.weekday("ts").alias("dow"), F.hour("ts").alias("hour")).agg(F.count(F.lit(1)).alias("n"))


BUSY_HOURS = f"WITH {ACTIVITY} SELECT CAST(isodow(ts) - 1 AS INT) AS dow, CAST(hour(ts) AS INT) AS hour, count(*) AS n FROM activity GROUP BY 1, 2"


def style_histogram(spark, d):
    return activity(spark, d).groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "event_type")


STYLE_HISTOGRAM = f"WITH {ACTIVITY} SELECT event_type, count(*) AS n FROM activity GROUP BY 1 ORDER BY n DESC, event_type"


def day_taps(spark, d):
    return activity(spark, d).groupBy("shop").agg(F.count(F.lit(1)).alias("taps"), F.count_if(F.col("day") == F.expr("DATE '2024-01-15'")).alias("that_day"), F.count_distinct("device").alias("devices"))


DAY_TAPS = f"WITH {ACTIVITY} SELECT shop, count(*) AS taps, count(*) FILTER (day = DATE '2024-01-15') AS that_day, count(DISTINCT device) AS devices FROM activity GROUP BY 1"


def _installs(spark, d):
    clicks = activity(spark, d).where("event_type = 'click'").select("device", (F.col("k") % 4).alias("src"), (F.col("k") % 20).alias("city"), (F.lit(30.0) + F.col("k") / F.lit(4.0)).alias("lat"), "seq")
    return first_write(clicks, ["device"], "seq")


INSTALLS = ACTIVITY + ", installs AS (SELECT device, arg_min(k % 4, seq) AS src, arg_min(k % 20, seq) AS city, arg_min(30.0::DOUBLE + k / 4.0::DOUBLE, seq) AS lat, min(seq) AS seq FROM activity WHERE event_type = 'click' GROUP BY device)"


def install_map(spark, d):
    per = _installs(spark, d).groupBy("city", "src").agg(F.count(F.lit(1)).alias("n"), F.sum("lat").alias("lat"))
    return per.groupBy("city").agg(F.round(F.sum("lat") / F.sum("n"), 4).alias("lat"), F.sum("n").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("src", "n"))), lambda x: F.concat(x["src"].cast("string"), F.lit(":"), x["n"].cast("string"))), ",").alias("sources"))


INSTALL_MAP = f"WITH {INSTALLS}, per AS (SELECT city, src, count(*) AS n, sum(lat) AS lat FROM installs GROUP BY 1, 2) SELECT city, round(sum(lat) / sum(n), 4) AS lat, CAST(sum(n) AS BIGINT) AS n, string_agg(CAST(src AS VARCHAR) || ':' || CAST(n AS VARCHAR), ',' ORDER BY src) AS sources FROM per GROUP BY city"


def store_histogram(spark, d):
    names = F.create_map(F.lit(0), F.lit("App store"), F.lit(1), F.lit("Web"), F.lit(2), F.lit("Side load"))
    return _installs(spark, d).groupBy(F.coalesce(F.try_element_at(names, F.col("src")), F.col("src").cast("string")).alias("store")).agg(F.count(F.lit(1)).alias("n"))


STORE_HISTOGRAM = f"WITH {INSTALLS} SELECT CASE src WHEN 0 THEN 'App store' WHEN 1 THEN 'Web' WHEN 2 THEN 'Side load' ELSE CAST(src AS VARCHAR) END AS store, count(*) AS n FROM installs GROUP BY 1"


def unplaced_by_region(spark, d):
    n = table(spark, d, "nation").where("n_regionkey <> 2")
    return table(spark, d, "customer").join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"), "left").groupBy(F.coalesce("n_name", F.lit("(unknown)")).alias("place")).agg(F.count(F.lit(1)).alias("n"))


UNPLACED_BY_REGION = "SELECT coalesce(n_name, '(unknown)') AS place, count(*) AS n FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON c_nationkey = n_nationkey GROUP BY 1"


def _board(spark, d):
    s = activity(spark, d).groupBy("device").agg(F.count_distinct(F.when(F.col("day") >= F.expr("DATE '2024-01-15'"), F.col("shop"))).alias("month_shops"), F.count_distinct("shop").alias("all_shops"), F.min("day").alias("joined"))
    return s


BOARD = ACTIVITY + ", board AS (SELECT device, count(DISTINCT shop) FILTER (day >= DATE '2024-01-15') AS month_shops, count(DISTINCT shop) AS all_shops, min(day) AS joined FROM activity GROUP BY device)"


def board_top(spark, d):
    return _board(spark, d).orderBy(F.desc("month_shops"), F.desc("all_shops"), "joined", "device").limit(25)


BOARD_TOP = f"WITH {BOARD} SELECT device, month_shops, all_shops, joined FROM board ORDER BY month_shops DESC, all_shops DESC, joined, device LIMIT 25"


def top_shops(spark, d):
    return activity(spark, d).groupBy("shop").agg(F.count_distinct("device").alias("devices"), F.max("ts").cast("date").alias("latest")).orderBy(F.desc("devices"), F.desc("latest"), "shop").limit(20)


TOP_SHOPS = f"WITH {ACTIVITY} SELECT shop, count(DISTINCT device) AS devices, CAST(max(ts) AS DATE) AS latest FROM activity GROUP BY shop ORDER BY devices DESC, latest DESC, shop LIMIT 20"


def board_rank(spark, d):
    """Competition rank by counts of equal values: the ranked table has one row per distinct value, not per device."""
    b = _board(spark, d)
    values = b.where("month_shops > 0").groupBy("month_shops").agg(F.count(F.lit(1)).alias("n"))
    rank = values.select(F.col("month_shops").alias("v"), (F.coalesce(F.sum("n").over(Window.orderBy(F.desc("month_shops")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + 1).alias("rank"))
    return b.join(F.broadcast(rank), F.col("month_shops") == F.col("v"), "left").select("device", "month_shops", "rank")


BOARD_RANK = f"WITH {BOARD}, r AS (SELECT device, rank() OVER (ORDER BY month_shops DESC) AS rank FROM board WHERE month_shops > 0) SELECT device, month_shops, rank FROM board LEFT JOIN r USING (device)"


def best_streak(spark, d):
    weeks = activity(spark, d).select("device", F.floor((F.unix_date("day") + 3) / 7).alias("week")).union(activity(spark, d).where("event_type = 'view'").select("device", F.unix_date("day").cast("bigint")))
    return longest_run(weeks, "device", "week")


BEST_STREAK = f"WITH {ACTIVITY}, w AS (SELECT DISTINCT device, week FROM (SELECT device, CAST(floor((date_diff('day', DATE '1970-01-01', day) + 3) / 7) AS BIGINT) AS week FROM activity UNION ALL SELECT device, date_diff('day', DATE '1970-01-01', day) FROM activity WHERE event_type = 'view')), i AS (SELECT device, week - row_number() OVER (PARTITION BY device ORDER BY week) AS island FROM w) SELECT device, max(n) AS best FROM (SELECT device, island, count(*) AS n FROM i GROUP BY 1, 2) GROUP BY device"


def daily_cap(spark, d):
    return capped(activity(spark, d).select("device", "day", "shop").distinct(), ["device", "day"], ["shop"], 6)


DAILY_CAP = f"WITH {ACTIVITY} SELECT device, day, shop FROM (SELECT DISTINCT device, day, shop FROM activity) QUALIFY row_number() OVER (PARTITION BY device, day ORDER BY shop) <= 6"


def rate_limit(spark, d):
    a = activity(spark, d)
    n = F.row_number().over(Window.partitionBy("device", "day").orderBy("seq"))
    return a.withColumn("n", n).groupBy("day").agg(F.count_if(F.col("n") <= 3).alias("accepted"), F.count_if(F.col("n") > 3).alias("refused"))


RATE_LIMIT = f"WITH {ACTIVITY}, n AS (SELECT day, row_number() OVER (PARTITION BY device, day ORDER BY seq) AS n FROM activity) SELECT day, count(*) FILTER (n <= 3) AS accepted, count(*) FILTER (n > 3) AS refused FROM n GROUP BY day"


def day_spread(spark, d):
    """Days on which a device's first six shops are more than 300 km apart; a group has at most 15 pairs."""
    s = daily_cap(spark, d).select("device", "day", "shop", (F.lit(30.0) + F.col("shop") * 0.05).alias("lat"), (F.lit(-90.0) + F.col("shop") % 10 * 0.07).alias("lon"))
    t = s.select(F.col("device").alias("d2"), F.col("day").alias("y2"), F.col("shop").alias("s2"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    km = haversine(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"), 6371.0)
    pairs = s.join(t, (F.col("device") == F.col("d2")) & (F.col("day") == F.col("y2")) & (F.col("shop") < F.col("s2")))
    return pairs.groupBy("device", "day").agg(F.round(F.max(km), 3).alias("km")).where("km > 300")


DAY_SPREAD = f"WITH {ACTIVITY}, s AS (SELECT *, 30.0::DOUBLE + shop * 0.05::DOUBLE AS lat, -90.0::DOUBLE + shop % 10 * 0.07::DOUBLE AS lon FROM (SELECT DISTINCT device, day, shop FROM activity) QUALIFY row_number() OVER (PARTITION BY device, day ORDER BY shop) <= 6) SELECT a.device, a.day, round(max({METRES.format(a='a.', b='b.')} / 1000), 3) AS km FROM s a JOIN s b ON a.device = b.device AND a.day = b.day AND a.shop < b.shop GROUP BY 1, 2 HAVING km > 300"


def first_area(spark, d):
    a = activity(spark, d)
    placed = _installs(spark, d).where("city < 10").select("device")
    first = a.join(placed, "device", "left_anti").groupBy("device").agg(F.min_by("shop", F.struct("day", "seq")).alias("shop"))
    lat = F.floor((F.lit(30.0) + F.col("shop") / F.lit(40.0)) * 10 + 0.5) / F.lit(10.0)
    return first.groupBy(lat.alias("lat")).agg(F.count(F.lit(1)).alias("n"))


FIRST_AREA = f"WITH {INSTALLS}, f AS (SELECT device, arg_min(shop, seq) AS shop FROM activity WHERE (device, day) IN (SELECT (device, min(day)) FROM activity GROUP BY device) AND device NOT IN (SELECT device FROM installs WHERE city < 10) GROUP BY device) SELECT floor((30.0::DOUBLE + shop / 40.0::DOUBLE) * 10 + 0.5) / 10.0::DOUBLE AS lat, count(*) AS n FROM f GROUP BY 1"


def funnel_30d(spark, d):
    return activity(spark, d).where("day > DATE '2024-01-31' - INTERVAL 30 DAYS and cast(device as string) not like '1%'").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("device").alias("devices"))


FUNNEL_30D = f"WITH {ACTIVITY} SELECT event_type, count(*) AS n, count(DISTINCT device) AS devices FROM activity WHERE day > DATE '2024-01-31' - INTERVAL 30 DAY AND CAST(device AS VARCHAR) NOT LIKE '1%' GROUP BY 1"


def shop_info(spark, d):
    """Latest name, and the latest coordinate that was given."""
    a = activity(spark, d).withColumn("lat", F.when(F.col("event_type") == "signup", F.col("value")))
    return a.groupBy("shop").agg(F.max_by("event_type", "seq").alias("name"), F.max_by("lat", F.when(F.col("lat").isNotNull(), F.col("seq"))).alias("lat"), F.min("day").alias("since"))


SHOP_INFO = f"WITH {ACTIVITY} SELECT shop, arg_max(event_type, seq) AS name, arg_max(value, seq) FILTER (event_type = 'signup') AS lat, min(day) AS since FROM activity GROUP BY shop"


def insight_order(spark, d):
    p = activity_pivot(spark, d).withColumn("total", F.lit(1))
    n = p.agg(F.count(F.lit(1)).alias("shops"))
    return p.drop("total").orderBy(F.desc("purchase"), F.desc("click"), F.desc("view"), "shop").limit(30).join(F.broadcast(n)).select("shop", "purchase", "click", "view", "shops")


INSIGHT_ORDER = f"WITH {ACTIVITY}, p AS (SELECT shop, count(*) FILTER (event_type = 'purchase') AS purchase, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'view') AS view FROM activity GROUP BY shop) SELECT shop, purchase, click, view, (SELECT count(*) FROM p) AS shops FROM p ORDER BY purchase DESC, click DESC, view DESC, shop LIMIT 30"


def sub_changes(spark, d):
    w = Window.partitionBy("sub").orderBy("day", "seq")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    s = subs(spark, d)
    was = F.lag("status").over(w)
    ever = F.max((F.col("status") == "ACTIVE").cast("int")).over(before)
    change = F.when((F.col("status") == "ACTIVE") & (F.coalesce(ever, F.lit(0)) == 0), "new").when(was.isNull() | (was != F.col("status")), F.lower("status")).when(F.lag("tier").over(w) != F.col("tier"), "tier").otherwise("paid")
    paid = F.max(F.date_add("day", 31)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return s.select("sub", "seq", change.alias("change"), paid.alias("paid_through"))


SUB_CHANGES = f"WITH {SUBS} SELECT sub, seq, CASE WHEN status = 'ACTIVE' AND coalesce(max(CAST(status = 'ACTIVE' AS INT)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0 THEN 'new' WHEN lag(status) OVER w IS NULL OR lag(status) OVER w <> status THEN lower(status) WHEN lag(tier) OVER w <> tier THEN 'tier' ELSE 'paid' END AS change, max(day + 31) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS paid_through FROM subs WINDOW w AS (PARTITION BY sub ORDER BY day, seq)"


def mrr(spark, d):
    now = last_write(subs(spark, d).withColumn("at", F.struct("day", "seq")), ["sub"], "at")
    price = F.when(F.col("tier") == 1, 20).when(F.col("tier") == 2, 12).otherwise(6)
    founding = F.col("sub") % 7 == 0
    return now.groupBy("tier").agg(F.sum(F.when(F.col("status") == "ACTIVE", price * F.when(founding, 0.5).otherwise(1.0)).otherwise(0.0)).alias("mrr"), F.count_if(F.col("status") == "ACTIVE").alias("active"), F.count_if(founding).alias("founding"))


MRR = f"WITH {SUBS}, now AS (SELECT sub, arg_max(tier, (day, seq)) AS tier, arg_max(status, (day, seq)) AS status FROM subs GROUP BY sub) SELECT tier, CAST(sum(CASE WHEN status = 'ACTIVE' THEN (CASE tier WHEN 1 THEN 20 WHEN 2 THEN 12 ELSE 6 END) * (CASE WHEN sub % 7 = 0 THEN 0.5 ELSE 1.0 END) ELSE 0 END) AS DOUBLE) AS mrr, count(*) FILTER (status = 'ACTIVE') AS active, count(*) FILTER (sub % 7 = 0) AS founding FROM now GROUP BY tier"


def best_tier(spark, d):
    """The best live tier per shop (customers in nations): live is ACTIVE, or CANCELLED and paid until two days ago."""
    s = subs(spark, d)
    live = (F.col("status") == "ACTIVE") | ((F.col("status") == "CANCELLED") & (F.date_add("day", 33) > F.expr("DATE '1998-01-01'")))
    return s.where(live).groupBy((F.col("sub") % 50).alias("shop")).agg(F.min_by(F.struct("tier", "seq"), F.struct("tier", "seq")).alias("b")).select("shop", "b.tier", "b.seq")


BEST_TIER = f"WITH {SUBS} SELECT sub % 50 AS shop, min(tier) AS tier, arg_min(seq, (tier, seq)) AS seq FROM subs WHERE status = 'ACTIVE' OR (status = 'CANCELLED' AND day + 33 > DATE '1998-01-01') GROUP BY 1"


def pending_signups(spark, d):
    s = subs(spark, d).where("status <> 'SUSPENDED'").select("sub")
    return table(spark, d, "customer").join(s, F.col("c_custkey") == F.col("sub"), "left_anti").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


PENDING_SIGNUPS = f"WITH {SUBS} SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_custkey NOT IN (SELECT sub FROM subs WHERE status <> 'SUSPENDED') GROUP BY 1"


def earliest_by_search(spark, d):
    a = activity(spark, d)
    return a.groupBy("shop").agg(F.min("day").alias("first"), F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("searches"))


EARLIEST_BY_SEARCH = f"WITH {ACTIVITY} SELECT shop, min(day) AS first, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS searches FROM activity GROUP BY shop"


def endpoint_latency(spark, d):
    ok = F.col("event_type") != "error"
    return activity(spark, d).groupBy((F.col("k") % 3).alias("endpoint")).agg(F.count_if(ok).alias("ok"), F.count_if(~ok).alias("failed"), F.round(F.avg(F.when(ok, F.col("stars"))), 4).alias("mean"))


ENDPOINT_LATENCY = f"WITH {ACTIVITY} SELECT k % 3 AS endpoint, count(*) FILTER (event_type <> 'error') AS ok, count(*) FILTER (event_type = 'error') AS failed, round(avg(stars) FILTER (event_type <> 'error'), 4) AS mean FROM activity GROUP BY 1"


def novelty(spark, d):
    """Items first seen after the baseline day, by a kind of event that had been seen by then."""
    a = activity(spark, d).withColumn("item", F.col("seq") * 7 % 3000)
    first = a.groupBy("item").agg(F.min("day").alias("first"), F.min_by("event_type", "seq").alias("way"))
    answered = a.where("day <= DATE '2024-01-08'").select(F.col("event_type").alias("way")).distinct()
    old = a.where("day <= DATE '2024-01-08'").select("item").distinct()
    return first.join(old, "item", "left_anti").join(answered, "way", "left_semi").select("item", "first", "way")


NOVELTY = f"WITH {ACTIVITY}, i AS (SELECT *, seq * 7 % 3000 AS item FROM activity) SELECT item, min(day) AS first, arg_min(event_type, seq) AS way FROM i WHERE item NOT IN (SELECT item FROM i WHERE day <= DATE '2024-01-08') GROUP BY item HAVING arg_min(event_type, seq) IN (SELECT event_type FROM i WHERE day <= DATE '2024-01-08')"


def event_bounds(spark, d):
    age = F.datediff(F.expr("DATE '2024-02-20'"), "day")
    return activity(spark, d).where((age <= 45) & (age >= -2)).groupBy("day").agg(F.count(F.lit(1)).alias("n"))


EVENT_BOUNDS = f"WITH {ACTIVITY} SELECT day, count(*) AS n FROM activity WHERE DATE '2024-02-20' - day BETWEEN -2 AND 45 GROUP BY day"


def eastern_days(spark, d):
    return activity(spark, d).groupBy(F.date_format(F.from_utc_timestamp("ts", "America/New_York"), "yyyy-MM-dd").alias("eastern_day")).agg(F.count(F.lit(1)).alias("n"))


EASTERN_DAYS = f"WITH {ACTIVITY} SELECT strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%d') AS eastern_day, count(*) AS n FROM activity GROUP BY 1"
