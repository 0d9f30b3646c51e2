"""Closure fusion: signals that a place has closed become hides and warnings.

listed: (id, name, k, h, cell keys by lat and lon, address). Entries: any of k (shop key), h (host), n + la + lo, and why, t. An
entry is matched to listings by shop key, else by host, else by name and spot. Everything is equi-joins on keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import grid_join
from ..functions.text import slug
from ..functions.urls import host_of

#: Checks and days of trouble after which a site counts: kind -> (checks, days). Fixed values.
TROUBLE = {"dns": (2, 6), "parked": (2, 6), "down": (3, 14)}
ENTRY = "k string, h string, n string, la double, lo double, why string, t string"


def shop_key(name: Column, website: Column, lat: Column, lon: Column) -> Column:
    """Host, or slug of the name, "@" and the spot to two decimals."""
    who = F.coalesce(F.nullif(host_of(website), F.lit("")), F.substring(slug(name), 1, 60))
    return F.concat(F.substring(who, 1, 80), F.lit("@"), F.format_string("%.2f,%.2f", lat, lon))


def listing(places: DataFrame) -> DataFrame:
    """(id, name, k, h, lat, lon, address) of places (id, name, lat, lon, website, address)."""
    return places.select("id", "name", shop_key(F.col("name"), F.col("website"), F.col("lat"), F.col("lon")).alias("k"), F.nullif(host_of(F.col("website")), F.lit("")).alias("h"), "lat", "lon", "address")


def matches(entries: DataFrame, listed: DataFrame, within_m: float = 150) -> DataFrame:
    """(eid, id) of entries (eid, ...) and the listings they mean, by the first kind of key that finds any."""
    e = entries.select("eid", "k", "h", F.lower(F.trim("n")).alias("n"), "la", "lo")
    by_k = e.where("k is not null").join(listed.select("id", "k"), "k").select("eid", "id", F.lit(0).alias("r"))
    by_h = e.where("h is not null").join(listed.select("id", "h"), "h").select("eid", "id", F.lit(1).alias("r"))
    # By name and grid cell: a name that many places share is no hot key.
    spots = listed.select("id", F.lower(F.trim("name")).alias("n"), F.col("lat").alias("blat"), F.col("lon").alias("blon"))
    named = e.where("n is not null").select("eid", F.col("n").alias("en"), F.col("la").alias("lat"), F.col("lo").alias("lon"))
    by_n = grid_join(named, spots, within_m, F.col("en") == F.col("n")).select("eid", "id", F.lit(2).alias("r"))
    found = by_k.union(by_h).union(by_n)
    return found.join(found.groupBy("eid").agg(F.min("r").alias("r")), ["eid", "r"]).select("eid", "id")


def site_trouble(health: DataFrame, listed: DataFrame, most_listings: int = 3) -> DataFrame:
    """Warnings (h, why) of sites (host, bad, first, last, n) in trouble long enough, for hosts of one to three listings."""
    counts = listed.where("h is not null").groupBy("h").agg(F.count(F.lit(1)).alias("listings"))
    enough = F.lit(False)
    for kind, (checks, days) in TROUBLE.items():
        enough = enough | ((F.col("bad") == kind) & (F.col("n") >= checks) & (F.datediff("last", "first") >= days))
    return health.where(enough).join(counts, health["host"] == counts["h"]).where(F.col("listings").between(1, most_listings)).select("h", F.concat(F.lit("site-"), "bad").alias("why"))


def missing_stores(listed: DataFrame, stores: DataFrame, most_share: float = 0.25) -> DataFrame:
    """(id) of a chain's listings (id, chain, state, house, city, words) that its directory (chain, state, house, city, words) lacks:
    no store of that state with the house number, nor in that city with a word of the street. A chain of which over a quarter
    is missing gives none: its directory was not read well."""
    s = stores.select(F.col("chain").alias("c2"), F.col("state").alias("s2"), F.col("house").alias("h2"), F.col("city").alias("ci2"), F.col("words").alias("w2"))
    same = (F.col("chain") == F.col("c2")) & (F.col("state") == F.col("s2")) & ((F.col("house") == F.col("h2")) | ((F.col("city") == F.col("ci2")) & F.arrays_overlap("words", "w2")))
    lost = listed.join(s, same, "left_anti")
    shares = listed.groupBy("chain").agg(F.count(F.lit(1)).alias("n")).join(lost.groupBy("chain").agg(F.count(F.lit(1)).alias("gone")), "chain")
    return lost.join(shares.where(F.col("gone") <= most_share * F.col("n")).select("chain"), "chain", "left_semi").select("id")


def _with_ids(entries: DataFrame) -> DataFrame:
    """eid: a digest of the entry, equal wherever it is computed."""
    return entries.withColumn("eid", F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in ("k", "h", "n", "la", "lo", "why")])).dropDuplicates(["eid"])


def fuse(listed: DataFrame, manual: DataFrame, reported_closed: DataFrame, reports: DataFrame, opens: DataFrame, automatic: DataFrame, site: DataFrame, confirmed: DataFrame, today, write, recent_days: int = 120) -> tuple[DataFrame, DataFrame]:
    """(hidden, warned) entries.

    Hidden: manual, reports of several people, automatic signals, and listings warned of in two or more distinct ways ("signals",
    all site-* being one). Found open in person (opens: k, last) within `recent_days`: automatic signals and site warnings of that
    listing go. Confirmed open: warnings go, and hides other than manual and reported ones.

    All entries are tagged and matched to listings in one pass; `write` cuts lineage (a table or checkpoint), so that the rules
    below read tables instead of repeating the match.
    """
    columns = [c.split()[0] for c in ENTRY.split(", ")]
    opened = opens.where(F.datediff(F.lit(today), "last") <= recent_days).selectExpr("k", "null as h", "null as n", "double(null) as la", "double(null) as lo", "'open' as why", "'' as t")
    tagged = None
    for tag, part in (("manual", manual), ("several", reported_closed), ("report", reports), ("open", opened), ("auto", automatic), ("site", site), ("ok", confirmed)):
        one = _with_ids(part.select(*columns)).withColumn("tag", F.lit(tag))
        tagged = one if tagged is None else tagged.unionByName(one)
    tagged = write(tagged.withColumn("eid", F.xxhash64("tag", "eid")))
    # What an entry means: listings, and its own keys, which may name a place that is not listed.
    ids = matches(tagged, listed).select("eid", F.concat(F.lit("i"), F.col("id").cast("string")).alias("what"))
    own = tagged.select("eid", F.explode(F.array(F.concat(F.lit("k"), "k"), F.concat(F.lit("h"), "h"))).alias("what")).where("what is not null")
    means = write(ids.union(own).join(tagged.select("eid", "tag", "why"), "eid").select("eid", "tag", "why", "what"))

    def spoken_of(tag: str) -> DataFrame:
        other = means.where(F.col("tag") == tag).select("what").distinct()
        return means.join(other, "what", "left_semi").select("eid").distinct()

    found_open, sure = spoken_of("open"), write(spoken_of("ok"))
    left = write(tagged.where("tag in ('manual', 'several', 'report')").unionByName(tagged.where("tag in ('auto', 'site')").join(found_open, "eid", "left_anti")))
    warned = left.where("tag in ('report', 'site')")
    kind = F.when(F.col("why").startswith("site-"), "site").otherwise(F.col("why"))
    twice = means.where("what like 'i%'").join(warned.select("eid"), "eid", "left_semi").groupBy("what").agg(F.count_distinct(kind).alias("kinds")).where("kinds >= 2")
    twice = twice.join(means.where("tag = 'ok'").select("what").distinct(), "what", "left_anti")
    signals = listed.withColumn("what", F.concat(F.lit("i"), F.col("id").cast("string"))).join(twice, "what", "left_semi").selectExpr("null as k", "null as h", "name as n", "lat as la", "lon as lo", "'signals' as why", "'' as t")
    kept = left.join(sure, "eid", "left_anti")
    hidden = left.where("tag in ('manual', 'several')").select(*columns).unionByName(kept.where("tag = 'auto'").select(*columns)).unionByName(signals)
    return hidden, kept.where("tag in ('report', 'site')").select(*columns)


def labels(entries: DataFrame, listed: DataFrame) -> DataFrame:
    """(eid, label): up to three names of the listings meant, sorted, and the place if it is only one."""
    city = F.regexp_extract("address", r"([^,]+, [A-Z]{2})\b", 1)
    per = matches(entries, listed).join(listed.select("id", "name", F.trim(city).alias("city")), "id").groupBy("eid").agg(F.array_sort(F.collect_set("name")).alias("names"), F.collect_set(F.nullif("city", F.lit(""))).alias("cities"))
    where = F.when(F.size("cities") == 1, F.concat(F.lit(", "), F.get("cities", F.lit(0)))).otherwise(F.lit(""))
    return per.select("eid", F.substring(F.concat(F.array_join(F.slice("names", 1, 3), " / "), where), 1, 100).alias("label"))


def with_pulled(hides: DataFrame, pulled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The hides (k, why) with all "dev" ones replaced by the pulled (k), and a single row (changed)."""
    out = hides.where("why <> 'dev'").unionByName(pulled.select("k", F.lit("dev").alias("why")))
    old, new = hides.where("why = 'dev'").select("k", F.lit(1).alias("was")), pulled.select("k", F.lit(1).alias("now"))
    diff = old.join(new, "k", "full").agg(F.coalesce(F.bool_or(F.col("was").isNull() | F.col("now").isNull()), F.lit(False)).alias("changed"))
    return out, diff
