"""Sharding by proportional stratified interleaving, in DataFrame functions.

Rows of a source get ranks in a seeded hash order; (rank + 1/2) / rows of the source is a fractional rank, and all rows sorted by
it mix the sources evenly. That order is cut into shards whose row counts differ by at most one, so each shard, and each stretch
of one, has the sources in the mixture's proportions.

Both rankings are global orders without a single-task sort: rows are counted by (source, hash bucket) or by fraction bucket, a
running sum over these small tables gives each bucket its offset, and only rows inside a bucket are sorted together.

Defined results: null text has no bytes (size 16, crc 0); a null source is a source of its own; repeated rows are dealt out like
others. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Hash buckets per source and fraction buckets over all; more rows mean more rows in a bucket, never one task for all.
BUCKETS = 4096
BYTES_PER_ROW = 16


def interleave(rows: DataFrame, shards: int, seed: int = 11) -> DataFrame:
    """Adds shard and slot to rows (doc_id, source, tie): tie tells apart rows with equal doc_id as far as possible. The order inside
    a source is that of a digest that other engines have too."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "tie").cast("binary"))
    rows = rows.withColumn("h", digest).withColumn("src", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    rows = rows.withColumn("hb", F.conv(F.substring("h", 1, 3), 16, 10).cast("int"))
    sums = rows.groupBy("src", "hb").agg(F.count(F.lit(1)).alias("n"))
    per_source = Window.partitionBy("src")
    offsets = sums.select("src", "hb", (F.sum("n").over(per_source.orderBy("hb")) - F.col("n")).alias("before"), F.sum("n").over(per_source).alias("of_source"))
    inside = Window.partitionBy("src", "hb").orderBy("h")
    ranked = rows.withColumn("k", F.row_number().over(inside)).join(offsets, ["src", "hb"])
    ranked = ranked.withColumn("fraction", (F.col("before") + F.col("k") - 0.5) / F.col("of_source")).drop("before", "k", "of_source", "hb")
    ranked = materialize(ranked.withColumn("fb", F.floor(F.col("fraction") * BUCKETS).cast("int")))
    by_fraction = ranked.groupBy("fb").agg(F.count(F.lit(1)).alias("n"))
    starts = by_fraction.select("fb", (F.sum("n").over(Window.orderBy("fb")) - F.col("n")).alias("before"), F.sum("n").over(Window.partitionBy()).alias("total"))
    order = Window.partitionBy("fb").orderBy("fraction", "src", "h")
    placed = ranked.withColumn("k", F.row_number().over(order) - 1).join(F.broadcast(starts), "fb").withColumn("at", F.col("before") + F.col("k"))  # at most BUCKETS rows
    # Shard s holds the places from ceil(s * total / shards) on.
    shard = F.expr(f"(at * {shards}) div total")
    first = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard).withColumn("slot", F.col("at") - first).withColumn("shard", F.col("shard").cast("int")).drop("src", "h", "fb", "k", "before", "total", "at")


def shard_documents(docs: DataFrame, shards: int = 40, seed: int = 11) -> DataFrame:
    """(doc_id, source, size, text_crc32, fraction, shard, slot) of each row (doc_id, source, text)."""
    crc = F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0).cast("long"))
    rows = docs.select("doc_id", "source", (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + BYTES_PER_ROW).alias("size"), crc.alias("text_crc32"))
    return interleave(materialize(rows.withColumn("tie", F.col("text_crc32").cast("string"))), shards, seed).drop("tie")


def op8_sharding(spark, sf_dir: str) -> DataFrame:
    out = shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source")


#: The same rows in DuckDB, whose crc32 is computed by bits of each byte: 8 steps of the polynomial a byte.
OP8_SQL = """
WITH t AS (SELECT i, list_reduce([CAST(i AS UBIGINT)] || CAST(range(8) AS UBIGINT[]), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) AS c FROM range(256) r(i)),
tab AS (SELECT list(c ORDER BY i) AS c FROM t),
texts AS (SELECT DISTINCT text FROM documents WHERE text IS NOT NULL),
crc AS (SELECT text, xor(list_reduce([4294967295::UBIGINT] || list_transform(string_split(regexp_replace(hex(encode(text)), '(..)', '\\1 ', 'g'), ' ')[:-2], lambda b: CAST('0x' || b AS UBIGINT)), lambda s, b: xor(tab.c[CAST(xor(s, b) & 255 AS BIGINT) + 1], s >> 8)), 4294967295::UBIGINT) AS crc FROM texts, tab),
d AS (SELECT doc_id, source, coalesce(strlen(documents.text), 0) + 16 AS size, coalesce(CAST(crc AS BIGINT), 0) AS text_crc32, coalesce('s' || source, 'n') AS src FROM documents LEFT JOIN crc ON documents.text = crc.text),
h AS (SELECT *, md5('11|' || coalesce(CAST(doc_id AS VARCHAR), '-') || '|' || CAST(text_crc32 AS VARCHAR)) AS h FROM d),
f AS (SELECT *, (row_number() OVER (PARTITION BY src ORDER BY h) - 0.5::DOUBLE) / count(*) OVER (PARTITION BY src) AS fraction FROM h),
o AS (SELECT *, row_number() OVER (ORDER BY fraction, src, h) - 1 AS k, count(*) OVER () AS total FROM f)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(k * 40 // total AS INTEGER) AS shard, k - (k * 40 // total * total + 39) // 40 AS slot, CAST(NULL AS INTEGER) AS grown_shard, source FROM o
"""
