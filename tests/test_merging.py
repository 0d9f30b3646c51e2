"""Merging queries on tables of our own, against their SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from locus.functions.geo import grid_join
from locus.sources.adapters import written


@pytest.fixture
def equal(spark, tmp_path):
    """Whether a query's rows are its SQL's on the given tables."""

    def run(name, **tables):
        c = duckdb.connect()
        for t, df in tables.items():
            df.coalesce(1).write.parquet(f"{tmp_path}/{t}.parquet")
            c.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
        got = __spark_entry__.catalog.QUERIES[name](spark, str(tmp_path))
        want = c.sql(__spark_entry__.catalog.ORACLES[name])
        assert sorted(got.columns) == sorted(want.columns)
        rows = sorted(map(tuple, got.select(*want.columns).collect()))
        assert rows == sorted(want.fetchall())
        return rows

    return run


def customers(spark, n):
    segment = F.element_at(F.array(*[F.lit(x) for x in ("BUILDING", "MACHINERY", "FURNITURE")]), (F.xxhash64("id") % 3 + 3).cast("int") % 3 + 1)
    return spark.range(n).select(F.col("id").alias("c_custkey"), segment.alias("c_mktsegment"))


def pages(spark, n):
    return spark.range(n).select(F.col("id").alias("page_id"), F.concat(F.lit("https://h"), F.col("id").cast("string"), F.lit(".example.com/")).alias("url"))


def test_clusters_at_parts_of_a_second(spark, equal):
    """A gap of six hours and some milliseconds begins a cluster, one of six hours or a microsecond less does not."""
    times = ["2024-01-01 00:00:00.1", "2024-01-01 06:00:00.9", "2024-01-01 12:00:00.9", "2024-01-01 18:00:00.899999", "2024-01-02 00:00:00.9"]
    rows = [(i, t, 1, "view", '{"k": 1}', 1.0) for i, t in enumerate(times)]
    events = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, props string, value double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    assert [r[1] for r in equal("token_clusters", events=events)] == [3]


def test_order_of_a_large_area(spark, equal):
    """An area of over 10,000 spots has them all."""
    rows = equal("spot_order", customer=customers(spark, 300_000), pages=pages(spark, 7), supplier=spark.range(1).select(F.col("id").alias("s_suppkey")))
    assert len(rows) == 300_000 and max(r[2] for r in rows) > 10_000


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_grid_joins_gather_nothing_in_the_driver(spark, tmp_path):
    """A side that is small on disk is large once it is sent to all its cells."""
    spark.range(50).select("id", *[(F.col("id") / 1000).alias(c) for c in ("lat", "lon")]).write.parquet(f"{tmp_path}/p")
    p = spark.read.parquet(f"{tmp_path}/p")
    for how in ("inner", "left_anti"):
        assert "Broadcast" not in plan(grid_join(p, p.select(F.col("id").alias("bid"), F.col("lat").alias("blat"), F.col("lon").alias("blon")), 150, how=how))


def test_written_tables_are_not_gathered_in_the_driver(spark):
    a, b = written(spark.range(9)), written(spark.range(5))
    assert "Broadcast" not in plan(a.join(b, "id")) + plan(a.join(b.distinct(), "id", "left_anti"))
    assert a.join(b, "id", "left_anti").count() == 4
