"""Text, address, link and date queries: (Spark, DuckDB SQL) under each name."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as T
from ..functions import urls as U
from ..sources.adapters import ACTIVITY, PLACES, WEEK, activity, chosen, chosen_sql, places, table, week

_NAMES = ["The Café Olé", "Ramen-ya No. 9", "", "Bún Chả House & Bar", "Zürich Kitchen", "OAK STREET NOODLES", "東京"]
_FILLER = ["ramen", "restaurant", "house", "bar", "shop", "noodles?", "kitchen", "the", "and"]


def name_keys(spark, d):
    """Names without accents as slugs and as keys without filler words; texts cleaned of odd spaces; cut at a word."""
    i = F.col("c_custkey")
    n = table(spark, d, "customer").select(i.alias("id"), chosen(i, _NAMES).alias("name"))
    spaced = F.trim(F.regexp_replace(F.concat(F.lit("  "), "name", F.lit(" \t x")), r"(?U)\s+", " "))
    long = F.concat(F.repeat(F.lit("word "), 11), "name")
    return n.select("id", T.plain_slug(F.col("name")).alias("slug"), T.name_key(F.col("name"), _FILLER).alias("key"), spaced.alias("clean"), T.cut_at_word(long).alias("cut"))


_SLUG = "trim(regexp_replace(strip_accents(lower(name)), '[^a-z0-9]+', '-', 'g'), '-')"
NAME_KEYS = f"""WITH n AS (SELECT c_custkey AS id, {chosen_sql('c_custkey', _NAMES)} AS name FROM customer)
SELECT id, CASE WHEN {_SLUG} = '' THEN 'city' ELSE {_SLUG} END AS slug, regexp_replace(regexp_replace(strip_accents(lower(name)), '\\b(ramen|restaurant|house|bar|shop|noodles?|kitchen|the|and)\\b', ' ', 'g'), '[^a-z0-9]+', '', 'g') AS key, trim(name || ' x') AS clean,
CASE WHEN length(repeat('word ', 11) || name) <= 60 THEN repeat('word ', 11) || name WHEN regexp_extract(substr(repeat('word ', 11) || name, 1, 60), '^(.*)\\s\\S*$', 1) <> '' THEN regexp_extract(substr(repeat('word ', 11) || name, 1, 60), '^(.*)\\s\\S*$', 1) ELSE substr(repeat('word ', 11) || name, 1, 60) END AS cut FROM n"""

_ADDRESSES = ["12 Oak St, TROY, NY 12180", "7 Elm Rd, Suite 4, new york, New York", "9 Fir Ave, Suite 100, Dover, DE", "Nowhere, 8, 9 Suite, DE", "1 Main St, Paris, France", "Salem, MA", "2255 N Main St, Winston-Salem, NC 27105-1234", None]


def split_addresses(spark, d):
    """Street, city and state of addresses: a suite in the city's place, states by name, cities' case; house number and the words
    of a street that tell it apart."""
    i = F.col("c_custkey")
    a = table(spark, d, "customer").select(i.alias("id"), chosen(i, _ADDRESSES).alias("address"))
    s = T.address_parts(F.col("address"))
    return a.select("id", s["street"].alias("street"), s["city"].alias("city"), s["state"].alias("state"), s["house"].alias("house"), F.array_join(F.array_sort(T.street_words(F.col("address"))), " ").alias("words"))


_PARTS = [("12 Oak St", "Troy", "NY", "12", "oak"), ("7 Elm Rd, Suite 4", "New York", "NY", "7", "elm"), ("9 Fir Ave, Suite 100", "Dover", "DE", "9", "fir"), (None, None, None, None, "nowhere"), (None, None, None, "1", "main"), (None, None, None, None, "salem"), ("2255 N Main St", "Winston-Salem", "NC", "2255", "main"), (None, None, None, None, "")]
SPLIT_ADDRESSES = "SELECT c_custkey AS id, " + ", ".join(f"{chosen_sql('c_custkey', [p[j] for p in _PARTS])} AS {c}" for j, c in enumerate(("street", "city", "state", "house", "words"))) + " FROM customer"

_NICKS = ["Fuuun_n", "b4d w0rd", "Ok Name", "Ba  dWor-d", "nice.one", "x!", "admin5"]


def nicknames(spark, d):
    """Nicknames by form and by a list of words that they may not contain, look-alike letters undone."""
    i = F.col("c_custkey")
    n = table(spark, d, "customer").select(i.alias("id"), chosen(i, _NICKS).alias("nick"))
    valid = F.col("nick").rlike(r"^[A-Za-z0-9][A-Za-z0-9 _.\-]{1,14}[A-Za-z0-9]$")
    return n.select("id", valid.alias("valid"), T.blocked_nick(T.nick_key(F.col("nick")), ["badword", "admins"]).alias("blocked"))


NICKNAMES = "SELECT c_custkey AS id, c_custkey % 7 <> 5 AS valid, c_custkey % 7 IN (1, 3, 6) AS blocked FROM customer"


def valid_inputs(spark, d):
    """Inputs that pass their form: shop keys, device numbers, tags and signatures cleaned."""
    i = F.col("c_custkey")
    raw = table(spark, d, "customer").select(i.alias("id"), F.concat(chosen(i, ["oak.example", "Oak", "elm-bar"]), F.lit("@"), chosen(i, ["41.50,-73.25", "41.5,-73.2", "-41.50,173.25"])).alias("shop"), chosen(i, ["0123456789abcdef", "short", "x" * 65]).alias("device"), chosen(i, ["Spring Sale!", "a_b-c.9", ""]).alias("tag"), chosen(i, ["AB:CD:EF:01:23:45:67:89", "12", None]).alias("sig"))
    return raw.select("id", T.is_shop_key(F.col("shop")).alias("shop"), F.col("device").rlike(r"^[A-Za-z0-9\-]{16,64}$").alias("device"), T.clean_tag(F.col("tag")).alias("tag"), T.clean_signature(F.col("sig")).alias("sig"))


VALID_INPUTS = f"SELECT c_custkey AS id, c_custkey % 3 <> 1 AS shop, c_custkey % 3 = 0 AS device, {chosen_sql('c_custkey', ['springsale', 'a_b-c.9', ''])} AS tag, {chosen_sql('c_custkey', ['abcdef0123456789', None, None])} AS sig FROM customer"

_URLS = ["https://www.Oak.example/menu/?utm_source=x&id=7&fbclid=9#top", "oak.example", "http://elm.example:8080/a/b/?b=&a=1", "https://ELM.example/?UTM_campaign=z"]


def url_variants(spark, d):
    """Addresses without tracking parameters, and the variants of an address to try."""
    i = F.col("c_custkey")
    u = table(spark, d, "customer").select(i.alias("id"), chosen(i, _URLS).alias("url"))
    return u.select("id", U.clean_query(F.col("url"), ("utm_", "fbclid", "gclid")).alias("clean"), F.array_join(U.address_variants(F.col("url")), " ").alias("variants"))


_CLEAN = ["https://www.Oak.example/menu/?id=7", "oak.example", "http://elm.example:8080/a/b/?b=&a=1", "https://ELM.example/"]
_VARIANTS = [
    "https://www.Oak.example/menu/?utm_source=x&id=7&fbclid=9#top https://www.oak.example/menu/?utm_source=x&id=7&fbclid=9 https://oak.example/menu/?utm_source=x&id=7&fbclid=9 http://www.oak.example/menu/?utm_source=x&id=7&fbclid=9 http://oak.example/menu/?utm_source=x&id=7&fbclid=9",
    "https://oak.example https://www.oak.example http://oak.example http://www.oak.example",
    "http://elm.example:8080/a/b/?b=&a=1 https://elm.example/a/b/?b=&a=1 https://www.elm.example/a/b/?b=&a=1 http://elm.example/a/b/?b=&a=1 http://www.elm.example/a/b/?b=&a=1",
    "https://ELM.example/?UTM_campaign=z https://elm.example/?UTM_campaign=z https://www.elm.example/?UTM_campaign=z http://elm.example/?UTM_campaign=z http://www.elm.example/?UTM_campaign=z",
]
URL_VARIANTS = f"SELECT c_custkey AS id, {chosen_sql('c_custkey', _CLEAN)} AS clean, {chosen_sql('c_custkey', _VARIANTS)} AS variants FROM customer"

_DOMAINS = ["kaiyoramen.com", "sacramento.com", "ramenbar.us", "dramendola.com", "ramen-nyc.org", "gramener.com", "ramenking.de", "noodles.com"]


def dish_domains(spark, d):
    """Domains that name the dish at the start or end of their label, or before a plain word, under an accepted ending."""
    i = F.col("c_custkey")
    return table(spark, d, "customer").select(i.alias("id"), U.names_dish(chosen(i, _DOMAINS), "ramen", ("sacramento",), ("bar", "house", "shop", "king", "nyc"), ("com", "us", "org")).alias("named"))


DISH_DOMAINS = "SELECT c_custkey AS id, c_custkey % 8 IN (0, 2, 4) AS named FROM customer"

_SHARED = ["https://s.example/?n=Oak%20Grill&la=40.5&lo=-80.25&a=1%20Elm%20St&w=oak.example", "https://s.example/?n=&la=1&lo=2", "https://s.example/?n=Fir&la=91&lo=0", "https://s.example/?n=Elm&la=40&lo=-70&w=Not%20a%20host", "https://s.example/?la=40&lo=-70"]


def share_links(spark, d):
    """Places from shared links, checked and cut to length; and the store link of a place's page."""
    i = F.col("c_custkey")
    p = U.shared_place(chosen(i, _SHARED))
    return table(spark, d, "customer").select(i.alias("id"), p.alias("p")).select("id", "p.name", "p.lat", "p.lon", "p.address", "p.site", U.store_link(F.lit("https://play.example/d?id=x"), F.concat(F.lit("city page "), (F.col("id") % 3).cast("string"))).alias("link"))


SHARE_LINKS = f"SELECT c_custkey AS id, {chosen_sql('c_custkey', ['Oak Grill', None, None, 'Elm', None])} AS name, CASE c_custkey % 5 WHEN 0 THEN 40.5::DOUBLE WHEN 3 THEN 40 END AS lat, CASE c_custkey % 5 WHEN 0 THEN -80.25::DOUBLE WHEN 3 THEN -70 END AS lon, CASE c_custkey % 5 WHEN 0 THEN '1 Elm St' WHEN 3 THEN '' END AS address, CASE c_custkey % 5 WHEN 0 THEN 'oak.example' WHEN 3 THEN '' END AS site, 'https://play.example/d?id=x&referrer=utm_source%3Dweb%26utm_medium%3Dcity%20page%20' || CAST(c_custkey % 3 AS VARCHAR) AS link FROM customer"


def zones(spark, d):
    """Time zones of places by state, with the states that two zones share split by a line."""
    states = ["FL", "TN", "KY", "IN", "MI", "TX", "KS", "NE", "ND", "SD", "ID", "OR", "NY", "IL", "CO", "CA", "AZ", "HI", "AK", "PR", "??"]
    p = places(spark, d).withColumn("state", chosen(F.col("id"), states))
    return p.groupBy(D.zone_of(F.col("state"), F.col("lat"), F.col("lon")).alias("zone")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("state").alias("states"))


ZONES = f"""WITH {PLACES}, s AS (SELECT *, {chosen_sql('id', ["FL", "TN", "KY", "IN", "MI", "TX", "KS", "NE", "ND", "SD", "ID", "OR", "NY", "IL", "CO", "CA", "AZ", "HI", "AK", "PR", "??"])} AS state FROM places),
z AS (SELECT state, CASE state WHEN 'FL' THEN CASE WHEN lon < -85.0 AND lat > 29.5 THEN 'C' ELSE 'E' END WHEN 'TN' THEN CASE WHEN lon > -85.4 THEN 'E' ELSE 'C' END WHEN 'KY' THEN CASE WHEN lon > -86.2 THEN 'E' ELSE 'C' END WHEN 'IN' THEN CASE WHEN lon < -86.9 AND (lat > 41.0 OR lat < 38.4) THEN 'C' ELSE 'E' END
WHEN 'MI' THEN CASE WHEN lon < -87.5 AND lat > 45.0 THEN 'C' ELSE 'E' END WHEN 'TX' THEN CASE WHEN lon < -104.8 THEN 'M' ELSE 'C' END WHEN 'KS' THEN CASE WHEN lon < -101.4 THEN 'M' ELSE 'C' END WHEN 'NE' THEN CASE WHEN lon < -101.4 THEN 'M' ELSE 'C' END WHEN 'ND' THEN CASE WHEN lon < -100.6 THEN 'M' ELSE 'C' END
WHEN 'SD' THEN CASE WHEN lon < -100.6 THEN 'M' ELSE 'C' END WHEN 'ID' THEN CASE WHEN lat > 45.6 THEN 'P' ELSE 'M' END WHEN 'OR' THEN CASE WHEN lon < -117.4 AND lat < 44.6 THEN 'M' ELSE 'P' END WHEN 'IL' THEN 'C' WHEN 'CO' THEN 'M' WHEN 'CA' THEN 'P' WHEN 'AZ' THEN 'America/Phoenix' WHEN 'HI' THEN 'Pacific/Honolulu' WHEN 'AK' THEN 'America/Anchorage' WHEN 'PR' THEN 'America/Puerto_Rico' ELSE 'E' END AS z FROM s)
SELECT CASE z WHEN 'E' THEN 'America/New_York' WHEN 'C' THEN 'America/Chicago' WHEN 'M' THEN 'America/Denver' WHEN 'P' THEN 'America/Los_Angeles' ELSE z END AS zone, count(*) AS n, count(DISTINCT state) AS states FROM z GROUP BY 1"""


def date_bounds(spark, d):
    """Days since a date, 10,000 without one; the first day of the last n days, or the beginning of time."""
    i = F.col("s_suppkey")
    day = F.when(i % 4 > 0, F.date_sub(F.lit("2026-10-01").cast("date"), i.cast("int")))
    return table(spark, d, "supplier").select(i.alias("id"), D.days_since(day, F.lit("2026-10-01").cast("date")).alias("days"), D.since_day(F.when(i % 5 > 0, (i % 5).cast("int")), F.lit("2026-10-01").cast("date")).alias("since"))


DATE_BOUNDS = "SELECT s_suppkey AS id, CAST(CASE WHEN s_suppkey % 4 > 0 THEN s_suppkey ELSE 10000 END AS INT) AS days, CASE WHEN s_suppkey % 5 > 0 THEN CAST(DATE '2026-10-01' - CAST(s_suppkey % 5 - 1 AS INT) AS VARCHAR) ELSE '0000-00-00' END AS since FROM supplier"


def next_opening(spark, d):
    """The state of each week at Saturday 23:30 of its own zone, with the next opening day where it is closed; labels of clocks."""
    from ..operators.windows import merged_spans

    merged = merged_spans(week(spark, d), ["user_id", "dow"], "o", "c")
    now = D.local_minute(F.lit("2024-01-07 04:30:00").cast("timestamp"), chosen(F.col("user_id"), ["America/New_York", "America/Los_Angeles"]))
    return D.open_state(merged, "user_id", now).select("user_id", "state", "opens_in", T.clock_label(F.col("opens")).alias("opens"))


_LABEL = "CASE WHEN o % 1440 = 0 THEN 'midnight' WHEN o % 1440 = 720 THEN 'noon' ELSE CAST((o % 1440 // 60 + 11) % 12 + 1 AS VARCHAR) || CASE WHEN o % 60 > 0 THEN ':' || lpad(CAST(o % 60 AS VARCHAR), 2, '0') ELSE '' END || CASE WHEN o % 1440 < 720 THEN ' am' ELSE ' pm' END END"
NEXT_OPENING = f"""WITH {WEEK}, x AS (SELECT DISTINCT user_id, dow, o, c FROM spans), y AS (SELECT *, max(c) OVER (PARTITION BY user_id, dow ORDER BY o, c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM x),
z AS (SELECT *, sum(CASE WHEN before IS NULL OR o > before THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, dow ORDER BY o, c) AS g FROM y), m AS (SELECT user_id, dow, min(o) AS o, max(c) AS c, CASE WHEN user_id % 2 = 0 THEN 1410 ELSE 1230 END AS t FROM z GROUP BY user_id, dow, g),
w AS (SELECT user_id, max(CASE WHEN dow = 4 AND c - 1440 > t THEN c - 1440 - t WHEN dow = 5 AND o <= t AND c > t THEN c - t END) AS rest, min(CASE WHEN (dow = 5 AND o > t) THEN (0, o) WHEN dow <> 5 THEN ((dow + 2) % 7, o) WHEN dow = 5 THEN (7, o) END) AS nxt FROM m GROUP BY user_id),
v AS (SELECT user_id, CASE WHEN rest IS NOT NULL THEN CASE WHEN rest <= 45 THEN 'closes soon' ELSE 'open' END WHEN nxt[1] = 0 THEN 'later' WHEN nxt[1] = 1 THEN 'tomorrow' WHEN nxt IS NOT NULL THEN 'day' ELSE 'closed' END AS state, CASE WHEN rest IS NULL THEN CAST(nxt[1] AS INT) END AS opens_in, CASE WHEN rest IS NULL THEN nxt[2] END AS o FROM w)
SELECT user_id, state, opens_in, CASE WHEN o IS NOT NULL THEN {_LABEL} END AS opens FROM v"""


def eastern_summer(spark, d):
    """Civil days in the east through the year's two clock changes."""
    at = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("k") * 3_600 * 89 + F.col("seq") % 24 * 3_600)
    return activity(spark, d).select("seq", D.civil_day(at, "America/New_York").alias("day"))


EASTERN_SUMMER = f"WITH {ACTIVITY}, a AS (SELECT seq, 1704067200 + k * 3600 * 89 + seq % 24 * 3600 AS s FROM activity) SELECT seq, strftime(CAST(to_timestamp(s - CASE WHEN s >= 1710054000 AND s < 1730613600 THEN 4 ELSE 5 END * 3600) AS TIMESTAMP), '%Y-%m-%d') AS day FROM a"
