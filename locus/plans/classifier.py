"""The line classifier, with its term tables as parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import line_key


def verdicts(lines: DataFrame, key: str, terms: str, excluded: str, priced: str) -> DataFrame:
    """(key, dishes, priced, verdict) of lines (key, pos, line).

    A dish line meets the terms and no exclusion, and is short or priced; dishes are distinct line keys. shop: at least 5 dishes
    that make up a quarter of at least 8 priced lines. serves: 2 dishes, or one short dish with a price on it or the next two lines
    in a text of 3 priced lines. All else is none. One shuffle: the window and the aggregation share the key's partitioning.
    """
    low = F.lower("line")
    met = low.rlike(terms) & ~low.rlike(excluded)
    f = lines.select(key, "pos", met.alias("met"), F.when(met, line_key(F.col("line"))).alias("line_key"), F.col("line").rlike(priced).alias("priced"), F.length("line").alias("len"))
    next_two = Window.partitionBy(key).orderBy("pos").rowsBetween(0, 2)
    f = f.withColumn("dish", F.col("met") & ((F.col("len") <= 110) | F.col("priced"))).withColumn("near_price", F.bool_or("priced").over(next_two))
    g = f.groupBy(key).agg(F.size(F.collect_set(F.when(F.col("dish"), F.col("line_key")))).cast("bigint").alias("dishes"), F.count_if("priced").alias("priced"), F.count_if(F.col("dish") & F.col("near_price") & (F.col("len") <= 70)).alias("single"))
    shop = (F.col("dishes") >= 5) & (F.col("priced") >= 8) & (F.col("dishes") >= 0.25 * F.greatest("priced", "dishes"))
    verdict = F.when(shop, "shop").when(F.col("dishes") >= 2, "serves").when((F.col("single") >= 1) & (F.col("priced") >= 3), "serves").otherwise("none")
    return g.select(key, "dishes", "priced", verdict.alias("verdict"))
