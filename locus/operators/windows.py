"""Window operators: islands, runs, merged spans, caps, upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def last_write(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key: one aggregation with map-side combine, no sort."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("r")).select(*keys, "r.*")


def first_write(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("r")).select(*keys, "r.*")


def capped(df: DataFrame, keys: list[str], order: list, most: int) -> DataFrame:
    """At most `most` rows of each key, in order."""
    return df.withColumn("n_th", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("n_th") <= most).drop("n_th")


def longest_run(df: DataFrame, key: str, step: str) -> DataFrame:
    """(key, best): the longest run of consecutive integers `step` of each key."""
    numbered = df.select(key, step).distinct().withColumn("island", F.col(step) - F.row_number().over(Window.partitionBy(key).orderBy(step)))
    return numbered.groupBy(key, "island").agg(F.count(F.lit(1)).alias("n")).groupBy(key).agg(F.max("n").alias("best"))


def merged_spans(df: DataFrame, keys: list[str], begin: str, end: str) -> DataFrame:
    """Spans of each key with overlapping and touching ones made one."""
    by = Window.partitionBy(*keys).orderBy(begin, end)
    before = F.max(end).over(by.rowsBetween(Window.unboundedPreceding, -1))
    flagged = df.select(*keys, begin, end).distinct().withColumn("new", F.when(before.isNull() | (F.col(begin) > before), 1).otherwise(0))
    islands = flagged.withColumn("island", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy(*keys, "island").agg(F.min(begin).alias(begin), F.max(end).alias(end)).drop("island")


def equal_runs(df: DataFrame, keys: list[str], position: str, value: str) -> DataFrame:
    """Runs of neighbouring positions with equal values: (keys, first, last, value)."""
    by = Window.partitionBy(*keys).orderBy(position)
    new = F.when(F.lag(value).over(by).eqNullSafe(F.col(value)) & (F.lag(position).over(by) == F.col(position) - 1), 0).otherwise(1)
    runs = df.withColumn("new", new).withColumn("run", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*keys, "run").agg(F.min(position).alias("first"), F.max(position).alias("last"), F.first(value).alias(value)).drop("run")


def keep_last_good(new: DataFrame, old: DataFrame, key: str, value: str, age: str, most_age: int) -> DataFrame:
    """New values, else old ones that are not too old."""
    o = old.select(F.col(key).alias("old_key"), F.col(value).alias("old_value"), F.col(age).alias("old_age"))
    both = new.select(key, value).join(o, F.col(key) == F.col("old_key"), "full")
    kept = F.coalesce(F.col(value), F.when(F.col("old_age") <= most_age, F.col("old_value")))
    return both.select(F.coalesce(key, "old_key").alias(key), kept.alias(value), F.when(F.col(value).isNotNull(), "new").when(kept.isNotNull(), "kept").otherwise("gone").alias("origin"))


def first_filled(df: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """A key's first row, each null filled from its first later row that has a value: one aggregation."""
    return df.groupBy(key).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns])


def miss_runs(df: DataFrame, key: str, order: str, found: str, most: int) -> DataFrame:
    """(key, misses, claimed): misses since the last row that was found; null rows count as not looked. `most` misses in a row end
    a claim, which begins with the first row found."""
    last = df.groupBy(key).agg(F.max(F.when(F.col(found), F.col(order))).alias("last"))
    seen = df.where(F.col(found).isNotNull()).join(last, key)
    misses = seen.groupBy(key).agg(F.count_if(~F.col(found) & (F.col("last").isNull() | (F.col(order) > F.col("last")))).cast("int").alias("misses"), F.max("last").alias("last"))
    return misses.select(key, "misses", ((F.col("misses") < most) & F.col("last").isNotNull()).alias("claimed"))


def sessions(df: DataFrame, key: str, order: list[str], position: str, gap: float) -> DataFrame:
    """Adds cluster: a key's rows in order, a new cluster after each gap in `position` of more than `gap`."""
    by = Window.partitionBy(key).orderBy(*order)
    new = F.when(F.col(position) - F.lag(position).over(by) <= gap, 0).otherwise(1)
    return df.withColumn("new", new).withColumn("cluster", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0))).drop("new")
