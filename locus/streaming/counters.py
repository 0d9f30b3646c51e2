"""Streaming twins: counters folded from an event stream, and suppression of repeats."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.adapters import shared_folder


def day_counts(events: DataFrame, late: str) -> DataFrame:
    """(shop, day, event_type, n) of a stream of events (ts, props, event_type).

    Counters are kept by a day's window of the event time, which carries the watermark: a day's state is freed once the watermark
    has passed its end, and events that are later than that are dropped.
    """
    k = F.get_json_object("props", "$.k").cast("int")
    marked = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    counts = marked.groupBy(F.window("at", "1 day").alias("w"), k.alias("shop"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("shop", F.to_date("w.start").alias("day"), "event_type", "n")


def fold(spark: SparkSession, counts: DataFrame) -> DataFrame:
    """The last state of every counter of a stream read to its end. Each micro-batch's changed counters are a table of their own,
    overwritten if the batch is repeated; the last batch wins."""
    at = shared_folder(spark)

    def upsert(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{at}/out/part={number}")

    query = counts.writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    out = spark.read.option("basePath", f"{at}/out").parquet(f"{at}/out")
    keys = [c for c in counts.columns if c != "n"]
    return out.groupBy(*keys).agg(F.max_by("n", "batch").alias("n"))


def counted(spark: SparkSession, sf_dir: str, late: str = "45 days") -> DataFrame:
    """(shop, day, event_type, n) from a stream over the events table, read to its end with availableNow."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")
    return fold(spark, day_counts(events, late))


def suppress_repeats(df: DataFrame, keys: list[str], time: str, order: str, within: int) -> DataFrame:
    """Rows kept when a row is dropped that follows a kept row of its key within `within`: only kept rows suppress.

    Sequential in a key, so each key's rows are sorted and passed by once: from a kept row a binary search finds the next one
    that is late enough. Batches stream; one key and the time of its last kept row are held between them.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, last = None, None
        for pdf in batches:
            if pdf.empty:
                continue
            times = pdf[time].to_numpy()
            own = pdf[keys].reset_index(drop=True)
            new = (own != own.shift()).any(axis=1).to_numpy()
            new[0] = True
            starts = np.append(np.flatnonzero(new), len(pdf))
            keep = np.zeros(len(pdf), bool)
            for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                key = tuple(own.iloc[lo])
                at = lo if key != now or last is None else lo + int(np.searchsorted(times[lo:hi], last + within, side="right"))
                now = key
                while at < hi:
                    keep[at] = True
                    last = times[at]
                    at += int(np.searchsorted(times[at:hi], last + within, side="right"))
            yield pdf[keep]

    return df.repartition(*keys).sortWithinPartitions(*keys, time, order).mapInPandas(run, df.schema)
