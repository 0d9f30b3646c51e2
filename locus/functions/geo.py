"""Geographic functions as Columns, and joins by grid cell."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = EARTH_M) -> Column:
    """Great-circle distance in the radius' unit."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * radius) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def planar(lat1: Column, lon1: Column, lat2: Column, lon2: Column, per_degree: float = 69.0) -> Column:
    """Flat distance at the mean latitude; miles by default."""
    return F.lit(per_degree) * F.hypot(lat2 - lat1, (lon2 - lon1) * F.cos(F.radians((lat1 + lat2) / 2)))


def cell(degrees: Column, per_degree: int = 100) -> Column:
    """Grid cell, truncated toward zero."""
    return (degrees * per_degree).cast("int")


def grid_join(a: DataFrame, b: DataFrame, within_m: float, condition: Column | None = None, per_degree: int = 100, how: str = "inner") -> DataFrame:
    """Pairs of a (lat, lon) and b (blat, blon) at most within_m apart that meet `condition`; how: inner, left_semi or left_anti.

    The side `b` is sent to the cells it can be reached from, so the join is an equi-join on cells and no cross join. At high
    latitudes cells get narrow: as many columns are probed as the distance can span there. It is a merge join: Spark takes a side's
    size before its rows are multiplied by cells, and would gather it in the driver.
    """
    rows = math.ceil(within_m / (EARTH_M * math.pi / 180) * per_degree)
    a = a.withColumn("ci", cell(F.col("lat"), per_degree)).withColumn("cj", cell(F.col("lon"), per_degree))
    span = F.ceil(F.lit(rows * 1.0) / F.cos(F.radians(F.least(F.lit(89.0), F.abs("blat") + rows / per_degree)))).cast("int")
    b = b.withColumn("bi", F.explode(F.sequence(cell(F.col("blat"), per_degree) - rows, cell(F.col("blat"), per_degree) + rows)))
    b = b.withColumn("bj", F.explode(F.sequence(cell(F.col("blon"), per_degree) - span, cell(F.col("blon"), per_degree) + span)))
    near = (F.col("ci") == F.col("bi")) & (F.col("cj") == F.col("bj")) & (haversine(F.col("lat"), F.col("lon"), F.col("blat"), F.col("blon")) <= within_m)
    return a.join(b.hint("merge"), near if condition is None else near & condition, how).drop("ci", "cj", "bi", "bj")


def nearest(pairs: DataFrame, key: str, distance: str, tie: str, most: int) -> DataFrame:
    """The `most` nearest of each key."""
    order = Window.partitionBy(key).orderBy(distance, tie)
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
