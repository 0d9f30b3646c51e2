"""Readers and sinks: text lists, JSON configurations and state, GeoJSON sequences, element lists, place tables, dated releases, write-if-changed plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def listed(spark: SparkSession, path: str, columns: list[str], least: int = 1) -> DataFrame:
    """Pipe-delimited lines without "#" comments: columns in order, missing ones null, `ok` false where fewer than `least` are
    given. Malformed lines are marked, never fatal."""
    bare = F.trim(F.element_at(F.split("value", "#"), 1))
    parts = F.transform(F.split("line", r"\|"), lambda x: F.trim(x))
    rows = spark.read.text(path).select(F.monotonically_increasing_id().alias("seq"), bare.alias("line")).where("line <> ''").withColumn("parts", parts)
    given = F.size(F.filter("parts", lambda x: x != ""))
    return rows.select("seq", *[F.nullif(F.get("parts", F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(columns)], (given >= least).alias("ok"))


def spot(text: Column) -> Column:
    """struct(lat, lon) of "lat, lon"; null where it is none."""
    lat = F.regexp_extract(text, r"^\s*(-?\d+(?:\.\d+)?)\s*,\s*(-?\d+(?:\.\d+)?)\s*$", 1)
    lon = F.regexp_extract(text, r"^\s*(-?\d+(?:\.\d+)?)\s*,\s*(-?\d+(?:\.\d+)?)\s*$", 2)
    return F.when(lat != "", F.struct(lat.try_cast("double").alias("lat"), lon.try_cast("double").alias("lon")))


GEO = "struct<geometry: struct<type: string, coordinates: string>, properties: map<string, string>>"


def geojson_sequence(spark: SparkSession, path: str, keep: list[str]) -> DataFrame:
    """(type, id, lat, lon, tags) of the features of a text sequence, one a line, with or without record separators; lines that are
    no JSON are skipped. Areas are at the mean of their outer ring and get back the id of what they were made of."""
    raw = spark.read.text(path).select(F.from_json(F.regexp_replace("value", "\\x1e", ""), GEO, {"mode": "PERMISSIVE"}).alias("f")).where("f.geometry.type is not null")
    kind, shape = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    point = F.from_json(shape, "array<double>")
    ring = F.when(kind == "Polygon", F.get(F.from_json(shape, "array<array<array<double>>>"), F.lit(0))).when(kind == "MultiPolygon", F.get(F.get(F.from_json(shape, "array<array<array<array<double>>>>"), F.lit(0)), F.lit(0))).when(kind == "LineString", F.from_json(shape, "array<array<double>>"))
    closed = F.when(F.get(ring, F.lit(0)) == F.element_at(ring, -1), F.slice(ring, 1, F.size(ring) - 1)).otherwise(ring)
    mean = lambda i: F.aggregate(closed, F.lit(0.0), lambda a, p: a + p[i]) / F.size(closed)
    tags = F.map_filter("f.properties", lambda k, v: k.isin(*keep) & (v != ""))
    number = F.element_at(F.col("f.properties"), "@id").try_cast("bigint")
    of = F.element_at(F.col("f.properties"), "@type")
    return raw.select(
        F.when(of == "area", F.when(number % 2 == 0, "way").otherwise("relation")).otherwise(of).alias("type"),
        F.when(of == "area", F.floor(number / 2)).otherwise(number).alias("id"),
        F.when(kind == "Point", F.get(point, F.lit(1))).otherwise(mean(1)).alias("lat"),
        F.when(kind == "Point", F.get(point, F.lit(0))).otherwise(mean(0)).alias("lon"),
        tags.alias("tags"),
    )


def elements(spark: SparkSession, path: str, keep: list[str]) -> DataFrame:
    """(type, id, lat, lon, tags) of a document's elements that have a name; a way is at its centre."""
    schema = "elements array<struct<type: string, id: bigint, lat: double, lon: double, center: struct<lat: double, lon: double>, tags: map<string, string>>>"
    e = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("elements").alias("e")).where("e.tags['name'] is not null")
    return e.select("e.type", "e.id", F.coalesce("e.lat", "e.center.lat").alias("lat"), F.coalesce("e.lon", "e.center.lon").alias("lon"), F.map_filter("e.tags", lambda k, v: k.isin(*keep)).alias("tags"))


def dish_place(tags: Column, cuisine: str, name: str) -> Column:
    """A restaurant whose cuisine has the dish or whose name says so."""
    at = lambda k: F.coalesce(F.try_element_at(tags, F.lit(k)), F.lit(""))
    return at("amenity").isin("restaurant", "fast_food", "cafe") & (F.contains(at("cuisine"), F.lit(cuisine)) | F.concat_ws(" ", at("name"), at("name:en")).rlike(name))


def latest_release(paths: DataFrame, column: str, pattern: str = r"dt=(\d{4}-\d\d-\d\d)") -> DataFrame:
    """(release): the greatest dated folder among paths."""
    return paths.select(F.nullif(F.regexp_extract(column, pattern, 1), F.lit("")).alias("release")).agg(F.max("release").alias("release"))


def has_field(df: DataFrame, *path: str) -> bool:
    schema = df.schema
    for name in path:
        schema = getattr(schema, "elementType", schema)
        if not hasattr(schema, "fieldNames") or name not in schema.fieldNames():
            return False
        schema = schema[name].dataType
    return True


def category_text(df: DataFrame) -> Column:
    """Lower-case text of the category columns that this release has; raises where it has none."""
    parts = []
    if has_field(df, "categories"):
        parts += [F.col("categories.primary"), F.array_join(F.col("categories.alternate"), " ")]
    if has_field(df, "taxonomy"):
        alternates = "alternates" if has_field(df, "taxonomy", "alternates") else "alternate"
        parts += [F.col("taxonomy.primary"), F.array_join(F.col(f"taxonomy.{alternates}"), " ")]
    if has_field(df, "basic_category"):
        parts.append(F.col("basic_category"))
    if not parts:
        raise ValueError("no category column")
    return F.lower(F.concat_ws(" ", *[F.coalesce(p, F.lit("")) for p in parts]))


def nested_places(df: DataFrame, box: tuple[float, float, float, float] | None = None, least_confidence: float = 0.35) -> DataFrame:
    """Canonical places (id, name, lat, lon, address, website, category) of a nested place table: inside the box (west, south,
    east, north), sure enough and not closed. Filters on nested fields reach the scan."""
    mid = lambda a, b: (F.col(f"bbox.{a}") + F.col(f"bbox.{b}")) / 2
    kept = df.where(F.coalesce("confidence", F.lit(1.0)) >= least_confidence)
    if has_field(df, "operating_status"):
        kept = kept.where(~F.contains(F.coalesce("operating_status", F.lit("open")), F.lit("closed")))
    if box:
        west, south, east, north = box
        kept = kept.where(F.col("bbox.xmin").between(west, east) & F.col("bbox.ymin").between(south, north))
    first = F.get("addresses", F.lit(0))
    address = F.nullif(F.concat_ws(", ", *[F.nullif(F.trim(first[c]), F.lit("")) for c in ("freeform", "locality", "region")]), F.lit(""))
    return kept.select("id", F.col("names.primary").alias("name"), F.bround(mid("ymin", "ymax"), 6).alias("lat"), F.bround(mid("xmin", "xmax"), 6).alias("lon"), address.alias("address"), F.get("websites", F.lit(0)).alias("website"), category_text(df).alias("category"))


def gate(new_rows: int, old_rows: int, least_share: float = 0.7) -> None:
    """Refuses a result that has lost too many rows against the last one."""
    if new_rows < least_share * old_rows:
        raise ValueError(f"{new_rows} rows after {old_rows}")


def enough(new_rows: Column, old_rows: Column, least_share: float = 0.7) -> Column:
    """The gate as a Column: the new result has kept enough rows."""
    return new_rows >= least_share * old_rows


def columns_of(df: DataFrame) -> DataFrame:
    """(column, position) of a table, from its schema alone."""
    return df.sparkSession.createDataFrame([(c, i) for i, c in enumerate(df.columns)], "column string, position int")


def json_config(spark: SparkSession, path: str, schema: str, field: str) -> DataFrame:
    """The entries of one list of a JSON configuration."""
    return spark.read.schema(schema).json(path, multiLine=True).select(F.explode(field).alias("e")).select("e.*")


def state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """State of an earlier run, or an empty table where there is none; other failures are raised."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def flat_places(df: DataFrame, today: Column, label: str, named: str, other: str, years: int = 3) -> DataFrame:
    """(id, name, address, website, filed) of a flat place table: neither closed nor flagged, refreshed in the last years (or never
    dated), with a street, filed under the label or named so; a name of another cuisine must be named so. Columns that a release
    lacks count as null."""
    at = lambda c: F.col(c) if c in df.columns else F.lit(None)
    flags = at("unresolved_flags") if "unresolved_flags" in df.columns else F.lit(None).cast("array<string>")
    name = F.lower("name")
    filed = F.coalesce(F.contains(F.lower(F.array_join("labels", " | ")), F.lit(label)), F.lit(False))
    kept = df.where(at("date_closed").isNull() & (flags.isNull() | (F.size(flags) == 0)) & (at("date_refreshed").isNull() | (at("date_refreshed") >= F.date_sub(today, 365 * years))))
    kept = kept.where((filed | name.rlike(named)) & (F.coalesce("address", F.lit("")) != "") & (name.rlike(named) | ~name.rlike(other)))
    return kept.select("id", "name", "address", at("website").cast("string").alias("website"), filed.alias("filed"))


ADDRESS = r"^[^,|]+, *[^,|]+, *[A-Z]{2} *(\d{5})?$"


def hand_list(rows: DataFrame, line: str, kind: str) -> DataFrame:
    """Adds name, host, lat, lon, text and ok to lines of hand-kept lists by their format. Comments go; blank lines are left out.

    closed: "name | lat, lon" or a host; deny: "name | place"; vouched: "name | street, city, ST zip | website | lat, lon" (the last
    two in any order); add: "website | name"; fix: "name | lat, lon | address | lat, lon"; details: "name | lat, lon | better name |
    website"; tags: "name | lat, lon | opening hours". ok is false, and the columns null, where a line is not of its format.
    """
    bare = rows.withColumn("_l", F.trim(F.split(line, "#", 2)[0])).where("_l <> ''").withColumn("_p", F.transform(F.split("_l", r"\|"), lambda x: F.trim(x)))
    part = lambda i: F.nullif(F.get("_p", F.lit(i)), F.lit(""))
    host = lambda c: F.nullif(F.regexp_replace(F.lower(F.regexp_replace(c, r"^[a-z]+://|/.*$", "")), r"^www\.", ""), F.lit(""))
    spotted = spot(F.col("_at"))
    is_host = F.lower(F.col("_l")).rlike(r"^[a-z0-9.\-]+\.[a-z]{2,}$")
    rest = F.filter(F.slice("_p", 3, 9), lambda x: x != "")
    coords = F.filter(rest, lambda x: x.rlike(r"^-?\d{1,2}\.\d+ *, *-?\d{1,3}\.\d+$"))
    sites = F.filter(rest, lambda x: ~x.rlike(r"^-?\d{1,2}\.\d+ *, *-?\d{1,3}\.\d+$"))
    k = F.col(kind)
    t = bare.withColumn("_at", F.when(k == "vouched", F.get(coords, F.lit(0))).otherwise(part(1))).withColumn("_s", spotted)
    ok = (
        F.when(k == "closed", (part(0).isNotNull() & F.col("_s").isNotNull()) | is_host)
        .when(k == "deny", part(0).isNotNull())
        .when(k == "vouched", part(0).isNotNull() & F.coalesce(part(1).rlike(ADDRESS), F.lit(False)))
        .when(k == "add", F.contains(F.coalesce(host(part(0)), F.lit("")), F.lit(".")))
        .when(k == "fix", F.col("_s").isNotNull() & part(2).isNotNull())
        .when(k == "details", F.col("_s").isNotNull())
        .when(k == "tags", F.col("_s").isNotNull() & F.coalesce(part(2).rlike(r"^[A-Za-z0-9 :;,\-+]+$"), F.lit(False)))
    )
    t = t.withColumn("ok", F.coalesce(ok, F.lit(False)))
    name = F.when(k == "add", part(1)).when((k == "closed") & is_host, F.lit(None)).otherwise(part(0))
    site = F.when((k == "closed") & is_host, host(F.col("_l"))).when(k == "vouched", host(F.get(sites, F.lit(0)))).when(k == "add", host(part(0))).when(k == "details", host(part(3)))
    text = F.when(k.isin("vouched", "deny"), part(1)).when(k.isin("fix", "details", "tags"), part(2))
    when_ok = lambda c: F.when(F.col("ok"), c)
    return t.select(*rows.columns, "ok", when_ok(F.substring(name, 1, 60)).alias("name"), when_ok(site).alias("host"), when_ok(F.col("_s.lat")).alias("lat"), when_ok(F.col("_s.lon")).alias("lon"), when_ok(text).alias("text"))


def sink_plan(wanted: DataFrame, there: DataFrame, key: str, body: str) -> DataFrame:
    """(key, action): write new and changed files, keep equal ones, delete those no longer wanted; bodies are compared by hash."""
    w = wanted.select(F.col(key).alias("_w"), F.sha2(body, 256).alias("_new"))
    t = there.select(F.col(key).alias("_t"), F.sha2(body, 256).alias("_old"))
    action = F.when(F.col("_w").isNull(), "delete").when(F.col("_new") == F.col("_old"), "keep").otherwise("write")
    return w.join(t, F.col("_w") == F.col("_t"), "full").select(F.coalesce("_w", "_t").alias(key), action.alias("action"))
