"""Embedding near-duplicates by collision-counting projections.

Vectors, scaled to length 1 and to one byte a component, are projected on many random lines. On each line they are sorted, and two
vectors collide if one lies in the window centred on the other. One line alone is weak (its window holds a good part of all
vectors), so each line's order is prefixed by `bits` signs of further projections: that keeps a window at a bounded number of rows
as the table grows. The number of lines is calibrated: a pair at the very threshold collides at least LEAST_COLLISIONS times with
probability RECALL; closer pairs are found more surely.

A line's row carries an id and the bytes, from which its place on every line follows; so the first line on which a pair collides
counts all its collisions. Pairs that pass send one link a vector, to the smallest of their group. What is reachable over them is a
cluster; its whole vectors meet once, where all pairs are verified with the exact cosine, link counts are summed and links united.
Equal vectors are one item throughout, with a multiplicity. Hot cells and large clusters are cut into blocks of bounded size.

Defined results: a vector that is null, empty, zero or holds null, NaN or infinite components has no link and is its own component.
Vectors of different length never link. Repeated rows are copies of each other; a null vec_id names a component only where there is
no other. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, components, forest, group_starts, materialize, per_group, split_hot, spread

RECALL = 0.97
LEAST_COLLISIONS = 2
#: Window half-width over the standard deviation that a pair at the threshold has on a line.
WIDTH = 1.8
#: Rows a cell is to hold on average, and half of what a task compares at once.
CELL_ROWS = 256
MOST_ROWS = 4096
#: Vectors of one block of a cluster; a task compares twice as many.
MOST_VECTORS = 2048
#: What quantizing to bytes may take off the cosine of a pair.
MARGIN = 0.02
PAIRS = 1_000_000


def calibrate(threshold: float, bits: int) -> tuple[int, float]:
    """Lines needed for RECALL at LEAST_COLLISIONS, and the window's half-width, for pairs of cosine `threshold`."""
    p = (1 - math.acos(threshold) / math.pi) ** bits * math.erf(WIDTH / math.sqrt(2))
    lines = LEAST_COLLISIONS
    while sum(math.comb(lines, i) * p**i * (1 - p) ** (lines - i) for i in range(LEAST_COLLISIONS)) > 1 - RECALL:
        lines += 1
    return lines, WIDTH * math.sqrt(2 - 2 * threshold)


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, key, vec): key is a digest of the vector's doubles; both null for vectors that cannot link."""
    for batch in batches:
        keys, vecs = [], []
        for v in batch.column("embedding").to_pylist():
            x = np.array(v, dtype=np.float64) + 0.0 if v and None not in v else np.zeros(0)
            if len(x) and np.isfinite(x).all() and x.any():
                vecs.append(x.tobytes())
                keys.append(hashlib.blake2b(vecs[-1], digest_size=16).hexdigest())
            else:
                vecs.append(None)
                keys.append(None)
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(keys, pa.string()), pa.array(vecs, pa.binary())], names=["vec_id", "key", "vec"])


def unit(vecs: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(vecs), dtype=np.float64).reshape(len(vecs), -1)
    x = x / np.abs(x).max(1, keepdims=True)  # neither over- nor underflow
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def quantized(x: np.ndarray) -> np.ndarray:
    """Rows as bytes, the greatest component of each at 127."""
    return np.rint(x / np.abs(x).max(1, keepdims=True) * 127).astype(np.int8)


def from_bytes(q: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(q), dtype=np.int8).reshape(len(q), -1).astype(np.float64)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _places(x: np.ndarray, lines: int, bits: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells and places (rows x lines) of unit vectors."""
    directions = np.random.default_rng((seed, x.shape[1])).standard_normal((x.shape[1], lines * (bits + 1)))
    p = (x @ directions).reshape(len(x), lines, bits + 1)
    return ((p[:, :, :bits] > 0).astype(np.int64) << np.arange(bits)).sum(2), p[:, :, bits]


def _project(lines: int, bits: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs, by_size = batch.column("vec").to_pylist(), {}
            for i, v in enumerate(vecs):
                by_size.setdefault(len(v) // 8, []).append(i)
            for size, rows in by_size.items():
                q = [r.tobytes() for r in quantized(unit([vecs[i] for i in rows]))]
                cell, _ = _places(from_bytes(q), lines, bits, seed)
                item, sent, n = batch.column("item").take(pa.array(rows)), pa.array(q, pa.binary()), len(rows)
                for j in range(lines):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, j, np.int32)), pa.array(np.full(n, size, np.int32)), pa.array(cell[:, j]), item, sent], names=["line", "size", "cell", "item", "q"])

    return run


def _candidates(threshold: float, half: float, lines: int, bits: int, seed: int):
    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = [table[k].to_numpy() for k in ("line", "size", "cell", "block_lo", "block_hi")]
        starts = group_starts(*keys)
        line, part, items = keys[0], table["part"].to_numpy(), table["item"].to_numpy()
        out = []
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            if b - a < 2:
                continue
            j = int(line[a])
            x = from_bytes(table["q"].slice(a, b - a).to_pylist())
            cells, places = _places(x, lines, bits, seed)
            order = np.argsort(places[:, j], kind="stable")
            x, cells, places, own, item = x[order], cells[order], places[order], part[a:b][order], items[a:b][order]
            right = np.searchsorted(places[:, j], places[:, j] + half, side="right")
            width = right - np.arange(b - a) - 1
            reach = np.cumsum(width)
            at, ga, gb = 0, [], []
            while at < b - a:
                to = max(at + 1, int(np.searchsorted(reach, (reach[at - 1] if at else 0) + PAIRS, side="right")))
                w = width[at:to]
                p = np.repeat(np.arange(at, min(to, b - a)), w)
                q = p + 1 + np.arange(len(p)) - np.repeat(np.cumsum(w) - w, w)
                at = to
                if keys[3][a] != keys[4][a]:  # a pair within a part meets in that part's own block
                    apart = own[p] != own[q]
                    p, q = p[apart], q[apart]
                collide = (cells[p] == cells[q]) & (np.abs(places[p] - places[q]) <= half)
                good = ~collide[:, :j].any(1) & (collide.sum(1) >= LEAST_COLLISIONS)
                p, q = p[good], q[good]
                good = np.einsum("ij,ij->i", x[p], x[q]) >= threshold - MARGIN
                ga.append(p[good])
                gb.append(q[good])
                if sum(map(len, ga)) > 4 * PAIRS:
                    root = forest(np.concatenate(ga), np.concatenate(gb))
                    ga, gb = [root], [np.arange(len(root))]
            ga, gb = np.concatenate(ga), np.concatenate(gb)
            if len(ga):
                root = forest(ga, gb)
                least = item[: len(root)].copy()
                np.minimum.at(least, root, item[: len(root)])
                rest = least[root] != item[: len(root)]
                out.append((least[root][rest], item[: len(root)][rest]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[i] for x in out])) for i in range(2)], names=["a", "b"])

    return work


def _verified(threshold: float):
    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        """Of whole blocks: each item's links in it (copies counted) and the smallest item it is united with."""
        starts = group_starts(*[table[k].to_numpy() for k in ("cluster", "block_lo", "block_hi")])
        part, items, copies = table["part"].to_numpy(), table["item"].to_numpy(), table["copies"].to_numpy().astype(np.float64)
        lo, hi = table["block_lo"].to_numpy(), table["block_hi"].to_numpy()
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            x, own = unit(table["vec"].slice(a, b - a).to_pylist()), part[a:b]
            links, ga, gb = np.zeros(b - a), [], []
            for at in range(0, b - a, 256):
                y = slice(at, at + 256)
                near = x[y] @ x.T >= threshold
                near[np.arange(near.shape[0]), np.arange(at, at + near.shape[0])] = False
                if lo[a] != hi[a]:
                    near &= own[y, None] != own[None, :]
                links[y] = near @ copies[a:b]
                p, q = np.nonzero(near)
                ga.append(p + at)
                gb.append(q)
                if sum(map(len, ga)) > 4 * PAIRS:
                    root = forest(np.concatenate(ga), np.concatenate(gb))
                    ga, gb = [root], [np.arange(len(root))]
            some = np.flatnonzero(links)
            if len(some):
                root = forest(np.concatenate(ga), np.concatenate(gb))
                yield pa.RecordBatch.from_arrays([pa.array(items[a:b][some]), pa.array(links[some].astype(np.int64)), pa.array(items[a:b][root[some]])], names=["item", "links", "root"])

    return work


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, seed: int = 5) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row (vec_id, embedding)."""
    spark = vectors.sparkSession
    arrow_batches(spark)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    prepared = materialize(vectors.select("vec_id", "embedding").mapInArrow(_prepare, f"vec_id {kind}, key string, vec binary"))
    items = prepared.where("key is not null").groupBy("key").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("vec").alias("vec"))
    items = materialize(items.withColumn("item", F.xxhash64("key")))
    bits = max(2, round(math.log2(max(1, items.count()) / CELL_ROWS)))
    lines, half = calibrate(threshold, bits)
    rows = items.select("item", "vec").mapInArrow(_project(lines, bits, seed), "line int, size int, cell long, item long, q binary")
    keys = ["line", "size", "cell"]
    split = split_hot(rows.withColumn("salt", F.xxhash64("item")), keys, "salt", MOST_ROWS).drop("salt")
    keys += ["block_lo", "block_hi"]
    near = materialize(spread(split, *keys).mapInArrow(per_group(keys, _candidates(threshold, half, lines, bits, seed)), "a long, b long").distinct())
    # Clusters of candidates; only their vectors move.
    members = near.select(F.col("a").alias("id")).union(near.select("b")).distinct()
    clusters = components(members, near).withColumnRenamed("component", "cluster")
    held = items.join(clusters, items["item"] == clusters["id"]).select("cluster", "item", "copies", "vec", F.xxhash64("item", F.lit(1)).alias("salt"))
    keys = ["cluster", "block_lo", "block_hi"]
    blocks = split_hot(materialize(held), ["cluster"], "salt", MOST_VECTORS).drop("salt")
    compared = materialize(spread(blocks, *keys).mapInArrow(per_group(keys, _verified(threshold)), "item long, links long, root long"))
    found = components(items.select(F.col("item").alias("id")), compared.select(F.col("root").alias("a"), F.col("item").alias("b")))
    links = compared.groupBy("item").agg(F.sum("links").alias("links"))
    per_item = items.select("key", "item", "least", "copies").join(links, "item", "left").join(found.withColumnRenamed("id", "item"), "item")
    named = per_item.groupBy("component").agg(F.min("least").alias("component_id"))
    per_item = per_item.join(named, "component").select("key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), "component_id")
    return (
        prepared.select("vec_id", "key")
        .join(materialize(per_item), "key", "left")
        .select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
        .withColumn("kept", F.col("vec_id") == F.col("component_id"))
    )


def op5_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


#: All pairs, for tables of some thousand vectors; components by recursion.
OP5_SQL = """
WITH RECURSIVE ok AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a)
SELECT e.vec_id, (SELECT count(*) FROM l WHERE l.a = e.vec_id) AS n_links, c.component_id, e.vec_id = c.component_id AS kept FROM embeddings e JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = e.vec_id
"""
