"""Operators on place listings: rules, deny lists, fixes, priority unions, merging, orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import cell, haversine, planar
from ..functions.urls import host_of, under

#: How near a listing must be to the spot a fix was made for, in degrees. Fixed value.
NEAR_DEGREES = 2e-4


def first_rule(rules: list[tuple[str, Column]]) -> Column:
    """The label of the first rule that holds; null if none does."""
    out = None
    for label, holds in rules:
        out = F.when(holds, label) if out is None else out.when(holds, label)
    return out


def place_rule(name: Column, category: Column, hosts: Column, brand_id: Column, brand: Column, primary: Column, words: dict[str, str], brands: list[str]) -> Column:
    """Why a place belongs, by patterns `app, food, extra, chain, host, noodle, other` for lower-cased text: its name or category
    is the app's own; then, for places filed under food only, its name, its brand, its own domain, or a plain noodle name."""
    n, b = F.lower(name), F.lower(F.coalesce(brand, F.lit("")))
    food = category.rlike(words["food"])
    japanese = F.contains(F.when(F.coalesce(primary, F.lit("")) != "", primary).otherwise(category), F.lit("japanese"))
    return first_rule(
        [
            ("app", n.rlike(words["app"]) | F.contains(category, F.lit(words["category"]))),
            ("name", food & (n.rlike(words["extra"]) | n.rlike(words["chain"]))),
            ("brand", food & (F.coalesce(brand_id, F.lit("")).isin(brands) | b.rlike(words["app"]) | b.rlike(words["chain"]))),
            ("site", food & F.exists(hosts, lambda h: h.rlike(words["host"]))),
            ("noodle", food & n.rlike(words["noodle"]) & japanese & ~n.rlike(words["other"])),
        ]
    )


def denied(places: DataFrame, listed: DataFrame, not_food: str, food: str) -> DataFrame:
    """Adds `denied` to places (name, address): the name says something else and nothing of food; or it is listed (name, place),
    for a place that the address contains, or for any. The list is a hand-kept one; it joins by name."""
    n = F.trim(F.regexp_replace(F.lower(F.coalesce("name", F.lit(""))), r"\s+", " "))
    named = listed.groupBy(F.col("name").alias("listed_name")).agg(F.collect_set(F.coalesce("place", F.lit(""))).alias("listed_places"))
    p = places.withColumn("_n", n).join(named, F.col("_n") == F.col("listed_name"), "left")
    at = F.exists("listed_places", lambda w: (w == "") | F.contains(F.lower(F.coalesce("address", F.lit(""))), w))
    return p.withColumn("denied", (F.col("_n").rlike(not_food) & ~F.col("_n").rlike(food)) | F.coalesce(at, F.lit(False))).drop("_n", "listed_name", "listed_places")


def blocked(host: Column, listed: list[str]) -> Column:
    """A host equal to or under a listed domain; patterns that end in "." match anywhere."""
    out = F.lit(False)
    for x in listed:
        out = out | (F.contains(host, F.lit(x)) if x.endswith(".") else under(host, F.lit(x)))
    return out


def near_spot(lat: Column, lon: Column, la: Column, lo: Column) -> Column:
    return (F.abs(lat - la) < NEAR_DEGREES) & (F.abs(lon - lo) < NEAR_DEGREES)


def spot_cells(df: DataFrame, lat: str, lon: str, names: tuple[str, str], around: bool) -> DataFrame:
    """Adds the spot's cell (hundredths of a degree); `around`: one row for each cell that NEAR_DEGREES reach."""
    for c, name in zip((lat, lon), names, strict=True):
        if around:
            cells = F.array_distinct(F.array(cell(F.col(c) - NEAR_DEGREES), cell(F.col(c) + NEAR_DEGREES)))
            df = df.withColumn(name, F.explode(cells))
        else:
            df = df.withColumn(name, cell(F.col(c)))
    return df


def fixed_details(places: DataFrame, fixes: DataFrame) -> DataFrame:
    """Places (id, name, lat, lon, website) with a better name and website from fixes (n, la, lo, better, site), matched by the
    listed or the new name and the spot; blanks change nothing. The join is on name and grid cell: a common name is no hot key."""
    both = fixes.select("la", "lo", "better", "site", F.explode(F.array_distinct(F.array(F.lower(F.trim("n")), F.lower(F.trim("better"))))).alias("fn")).where("fn <> ''")
    f = spot_cells(both, "la", "lo", ("fi", "fj"), True)
    p = spot_cells(places, "lat", "lon", ("ci", "cj"), False)
    at = (F.lower(F.trim("name")) == F.col("fn")) & (F.col("ci") == F.col("fi")) & (F.col("cj") == F.col("fj")) & near_spot(F.col("lat"), F.col("lon"), F.col("la"), F.col("lo"))
    out = p.join(f, at, "left")
    name, site = F.coalesce(F.nullif("better", F.lit("")), "name"), F.coalesce(F.nullif("site", F.lit("")), "website")
    return out.select("id", name.alias("name"), site.alias("website"), (~name.eqNullSafe(F.col("name")) | ~site.eqNullSafe(F.col("website"))).alias("changed"))


def upserted(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, changed): new values win."""
    n = new.select(F.col(key).alias("_k"), F.col(value).alias("_v"))
    both = old.select(key, value).join(n, F.col(key) == F.col("_k"), "full")
    return both.select(F.coalesce("_k", key).alias(key), F.coalesce("_v", value).alias(value), (F.col("_k").isNotNull() & ~F.col("_v").eqNullSafe(F.col(value))).alias("changed"))


def first_of(columns: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The first non-null of (label, column) pairs, and its label."""
    value = F.coalesce(*[F.col(c) for _, c in columns])
    label = None
    for name, c in columns:
        label = F.when(F.col(c).isNotNull(), name) if label is None else label.when(F.col(c).isNotNull(), name)
    return value, label


def by_priority(feeds: list[tuple[DataFrame, bool]], columns: list[str]) -> DataFrame:
    """The feeds in order of priority: adds `prio` and `always`."""
    out = None
    for i, (feed, always) in enumerate(feeds):
        one = feed.select(*columns).withColumn("prio", F.lit(i)).withColumn("always", F.lit(always))
        out = one if out is None else out.unionByName(one)
    return out


def same_listing(name_a: Column, host_a: Column, name_b: Column, host_b: Column, miles: Column) -> Column:
    """The looser rule for pages: within 0.12 miles with a like name or an equal host; or within 0.02 miles, whatever the names.
    b is the later one: its name counts as contained, or containing, from four letters on."""
    like = (name_a != "") & (name_b != "") & ((name_a == name_b) | ((F.length(name_b) >= 4) & (F.contains(name_a, name_b) | F.contains(name_b, name_a))))
    return ((miles < 0.12) & (like | ((host_a != "") & (host_a == host_b)))) | (miles < 0.02)


def top_per(df: DataFrame, keys: list[str], order: list, most: int, name: str = "rank") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= most)


def nearby(centres: DataFrame, spots: DataFrame, within: float, most: int) -> DataFrame:
    """(city, id, miles, rank): the `most` nearest spots (id, city, lat, lon) outside each centre's city (city, clat, clon), within
    so many miles; by grid cells of a tenth of a degree, of which as many are probed as the distance spans."""
    rows = 3
    span = F.ceil(F.lit(within / 69.0 * 10) / F.cos(F.radians(F.least(F.lit(80.0), F.abs("clat") + 0.3)))).cast("int")
    c = centres.withColumn("bi", F.explode(F.sequence(cell(F.col("clat"), 10) - rows, cell(F.col("clat"), 10) + rows)))
    c = c.withColumn("bj", F.explode(F.sequence(cell(F.col("clon"), 10) - span - 1, cell(F.col("clon"), 10) + span + 1))).withColumnRenamed("city", "of")
    s = spots.withColumn("ci", cell(F.col("lat"), 10)).withColumn("cj", cell(F.col("lon"), 10))
    miles = planar(F.col("clat"), F.col("clon"), F.col("lat"), F.col("lon"))
    pairs = s.join(c, (F.col("ci") == F.col("bi")) & (F.col("cj") == F.col("bj"))).where((F.col("of") != F.col("city")) & (F.abs(F.col("lat") - F.col("clat")) < 0.3)).withColumn("miles", F.round(miles, 4)).where(F.col("miles") <= within)
    return top_per(pairs, ["of"], ["miles", "id"], most).select(F.col("of").alias("city"), "id", "miles", "rank")


def within_metres(lat: Column, lon: Column, la: Column, lo: Column, metres: float) -> Column:
    return haversine(lat, lon, la, lo) <= metres


def own_host(website: Column, shared: list[str], listed: list[str]) -> Column:
    """The website's host unless it is blocked or a shared platform's."""
    h = host_of(website)
    platform = F.lit(False)
    for x in shared:
        platform = platform | F.contains(h, F.lit(x))
    return F.when((h != "") & ~blocked(h, listed) & ~platform, h)
