"""Entity matching: the same-place predicate, lookup by several keys, and greedy deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import haversine


def same_place(a: dict[str, Column], b: dict[str, Column], words) -> Column:
    """Within 150 m and: equal names; or below 20 m one name in the other; or below 120 m a common word; or an equal host.

    a and b have name, lat, lon, host. `words` maps a name to its array of words.
    """
    d = haversine(a["lat"], a["lon"], b["lat"], b["lon"])
    n1, n2 = F.lower(F.trim(a["name"])), F.lower(F.trim(b["name"]))
    inside = F.contains(n1, n2) | F.contains(n2, n1)
    return (d <= 150) & ((n1 == n2) | ((d < 20) & inside) | ((d < 120) & F.arrays_overlap(words(a["name"]), words(b["name"]))) | ((a["host"] != "") & (a["host"] == b["host"]) & (d < 150)))


def by_keys(entries: DataFrame, listed: DataFrame, keys: list[str], entry: str, item: str) -> DataFrame:
    """(entry, item, way) by the first of `keys` on which an entry finds anything: one equi-join per key."""
    found = None
    for rank, key in enumerate(keys):
        one = entries.where(F.col(key).isNotNull()).select(entry, key).join(listed.select(item, key), key).select(entry, item, F.lit(rank).alias("rank"), F.lit(key).alias("way"))
        found = one if found is None else found.unionByName(one)
    best = found.groupBy(entry).agg(F.min("rank").alias("rank"))
    return found.join(best, [entry, "rank"]).select(entry, item, "way")


def greedy_dedupe(rows: DataFrame, links: DataFrame, write, most_rounds: int = 100) -> DataFrame:
    """Ids of `rows` (id, seq) that stay when rows are admitted in seq order unless linked to a row admitted before.

    links: (a, b) with a before b. The rule is not transitive, so components would differ: rounds decide every row whose earlier
    neighbours are all decided, so they are as many as the longest chain of links. `write` cuts lineage after a round (a table or
    checkpoint). Raises if `most_rounds` leave rows undecided.
    """
    open_links = write(links.select("a", "b").distinct())
    dropped = None
    for _ in range(most_rounds):
        if open_links.isEmpty():
            break
        heads = open_links.select(F.col("a").alias("id")).distinct().join(open_links.select(F.col("b").alias("id")).distinct(), "id", "left_anti")
        out = write(open_links.join(heads, F.col("a") == heads["id"], "left_semi").select(F.col("b").alias("id")).distinct())
        dropped = out if dropped is None else dropped.unionByName(out)
        left = open_links.join(out, open_links["a"] == out["id"], "left_anti").join(out, F.col("b") == out["id"], "left_anti")
        open_links = write(left.join(heads, left["a"] == heads["id"], "left_anti"))
    else:
        if not open_links.isEmpty():
            raise RuntimeError(f"rows are undecided after {most_rounds} rounds")
    return rows.select("id") if dropped is None else rows.join(dropped, "id", "left_anti").select("id")


def keep_or_merge(rows: DataFrame, links: DataFrame, write, better: dict, fill: dict) -> DataFrame:
    """`greedy_dedupe` of rows by id; a dropped row goes into the last kept row it is linked to. better: column -> rule of the kept
    value and the greatest of the merged ones; fill: column -> value that counts as missing, filled from the first merged row.
    Adds merged, the number of rows that went in."""
    kept = write(greedy_dedupe(rows.select("id", F.col("id").alias("seq")), links, write))
    into = links.join(kept.select(F.col("id").alias("a")), "a").join(kept.select(F.col("id").alias("b")), "b", "left_anti").groupBy("b").agg(F.max("a").alias("into"))
    facts = into.join(rows, into["b"] == rows["id"])
    merged = facts.groupBy("into").agg(F.count(F.lit(1)).alias("merged"), *[F.max(c).alias(f"_{c}") for c in better], *[F.min_by(c, F.when(F.col(c) != none, F.col("b"))).alias(f"_{c}") for c, none in fill.items()])
    out = rows.join(kept, "id").join(merged, F.col("id") == F.col("into"), "left")
    for c, rule in better.items():
        out = out.withColumn(c, F.when(F.col(f"_{c}").isNull(), F.col(c)).otherwise(rule(F.col(c), F.col(f"_{c}"))))
    for c, none in fill.items():
        out = out.withColumn(c, F.when(F.col(c) == none, F.coalesce(f"_{c}", F.lit(none))).otherwise(F.col(c)))
    return out.withColumn("merged", F.coalesce("merged", F.lit(0)).cast("bigint")).select(*rows.columns, "merged")
