"""The driver's tables in the shapes that the operators work on, in Spark and as DuckDB SQL (`WITH` entries) side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import host_of

ACTIVITY = "activity AS (SELECT event_id AS seq, user_id AS device, CAST(json_extract_string(props, '$.k') AS INT) AS k, CAST(json_extract_string(props, '$.k') AS INT) AS shop, CAST(ts AS DATE) AS day, ts, event_type, CAST(1 + event_id % 5 AS INT) AS stars, value FROM events)"
REPORTS = ACTIVITY + ", reports AS (SELECT *, CASE event_type WHEN 'error' THEN 'closed' WHEN 'signup' THEN 'closed-here' WHEN 'view' THEN 'open-here' END AS kind FROM activity WHERE event_type IN ('error', 'signup', 'view'))"
HOST = "regexp_replace(lower(regexp_extract(CASE WHEN lower(url) LIKE 'http%' THEN url ELSE 'https://' || url END, '^[A-Za-z]+://([^/?#:]*)', 1)), '^www\\.', '')"
PLACES = (
    "n_pages AS (SELECT count(*) AS n FROM pages), "
    "places AS (SELECT c_custkey AS id, c_mktsegment || ' ' || CAST(c_custkey % 100 % 40 AS VARCHAR) AS name, 25 + (c_custkey % 100 * 7919 % 2400) / 100.0::DOUBLE + (c_custkey // 100) * 0.0006::DOUBLE AS lat, "
    f"-(70 + (c_custkey % 100 * 104729 % 5000) / 100.0::DOUBLE) AS lon, coalesce((SELECT {HOST} FROM pages p WHERE p.page_id = c_custkey % (SELECT n FROM n_pages)), '') AS host FROM customer), "
    "others AS (SELECT s_suppkey AS bid, name AS bname, lat + (s_suppkey % 10) * 0.0001::DOUBLE AS blat, lon - (s_suppkey % 10) * 0.0005::DOUBLE AS blon, host AS bhost FROM supplier JOIN places ON id = s_suppkey * 3 % (SELECT count(*) FROM customer))"
)
METRES = "12742000.0::DOUBLE * asin(sqrt(least(1.0::DOUBLE, pow(sin(radians({b}lat - {a}lat) / 2), 2) + cos(radians({a}lat)) * cos(radians({b}lat)) * pow(sin(radians({b}lon - {a}lon) / 2), 2))))"
LINES = (
    "raw AS (SELECT doc_id, unnest(regexp_split_to_array(text, '\\n|[•·|]')) AS part, generate_subscripts(regexp_split_to_array(text, '\\n|[•·|]'), 1) AS nth FROM documents), "
    "clean AS (SELECT doc_id, nth, trim(regexp_replace(part, '\\s+', ' ', 'g')) AS line FROM raw), "
    "lines AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY nth) - 1 AS pos, line FROM clean WHERE length(line) BETWEEN 3 AND 160)"
)
WEEK = (
    "spans AS (SELECT user_id, CAST(isodow(ts) - 1 AS INT) AS dow, CAST(hour(ts) * 60 + minute(ts) AS INT) AS o, CAST(hour(ts) * 60 + minute(ts) + 60 + event_id % 300 AS INT) AS c FROM events)"
)
SUBS = (
    "subs AS (SELECT o_custkey AS sub, o_orderkey AS seq, CAST(o_orderdate AS DATE) AS day, CASE o_orderstatus WHEN 'F' THEN 'CANCELLED' WHEN 'O' THEN 'ACTIVE' ELSE 'SUSPENDED' END AS status, "
    "CAST(substr(o_orderpriority, 1, 1) AS INT) AS tier FROM orders)"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("seq"), F.col("user_id").alias("device"), k.alias("k"), k.alias("shop"), F.to_date("ts").alias("day"), "ts", "event_type", (F.col("event_id") % 5 + 1).cast("int").alias("stars"), "value")


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "error", "closed").when(F.col("event_type") == "signup", "closed-here").when(F.col("event_type") == "view", "open-here")
    return activity(spark, sf_dir).where(F.col("event_type").isin("error", "signup", "view")).withColumn("kind", kind)


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as places in chains of near neighbours; hosts from pages."""
    pages = table(spark, sf_dir, "pages")
    n = pages.count()
    b, j = F.col("c_custkey") % 100, F.floor(F.col("c_custkey") / 100)
    p = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.concat("c_mktsegment", F.lit(" "), (b % 40).cast("string")).alias("name"),
        (F.lit(25.0) + (b * 7919 % 2400) / F.lit(100.0) + j * F.lit(0.0006)).alias("lat"),
        (-(F.lit(70.0) + (b * 104729 % 5000) / F.lit(100.0))).alias("lon"),
        (F.col("c_custkey") % max(1, n)).alias("page"),
    )
    hosts = pages.select(F.col("page_id").alias("page"), host_of(F.col("url")).alias("host"))
    return p.join(hosts, "page", "left").select("id", "name", "lat", "lon", F.coalesce("host", F.lit("")).alias("host"))


def others(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as places of a second source, each some metres off a customer's place."""
    n = table(spark, sf_dir, "customer").count()
    p = places(spark, sf_dir)
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("bid"), (F.col("s_suppkey") * 3 % max(1, n)).alias("id"))
    off = F.col("bid") % 10
    return s.join(p, "id").select("bid", F.col("name").alias("bname"), (F.col("lat") + off * F.lit(0.0001)).alias("blat"), (F.col("lon") - off * F.lit(0.0005)).alias("blon"), F.col("host").alias("bhost"))


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.text import lines

    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(lines(F.col("text"))).alias("pos", "line"))


def week(spark: SparkSession, sf_dir: str) -> DataFrame:
    minute = F.hour("ts") * 60 + F.minute("ts")
    return table(spark, sf_dir, "events").select("user_id", F.weekday("ts").alias("dow"), minute.alias("o"), (minute + 60 + F.col("event_id") % 300).cast("int").alias("c"))


def subs(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "CANCELLED").when(F.col("o_orderstatus") == "O", "ACTIVE").otherwise("SUSPENDED")
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("sub"), F.col("o_orderkey").alias("seq"), F.to_date("o_orderdate").alias("day"), status.alias("status"), F.substring("o_orderpriority", 1, 1).cast("int").alias("tier"))


def chosen(key, values: list):
    """The value of a key's number, values repeating."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (key % len(values) + 1).cast("int"))


def literal(value) -> str:
    if value is None:
        return "NULL"
    return str(value) if isinstance(value, (int, float)) else "'" + str(value).replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def chosen_sql(key: str, values: list) -> str:
    return f"[{', '.join(literal(v) for v in values)}][({key}) % {len(values)} + 1]"


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the cluster's shared checkpoint folder. On a cluster it must be set; only local runs fall back to a
    temporary folder of this machine."""
    import tempfile
    import uuid

    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/locus/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The same rows from a table in the shared folder: cuts lineage. Joins with it are merge joins: its size on disk, compressed,
    says little of its rows' size in the driver."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).hint("merge")
