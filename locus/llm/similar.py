"""Near-duplicate texts by SimHash candidates of a wide radius, each verified on whole shingle sets (Jaccard 4/5 or more).

At similarity 4/5 a SimHash bit differs with probability 0.152 (a cosine of 8/9), so 64 bits differ in 10 on average, far beyond
what blocks of a radius-4 search can find. Candidates therefore come from TABLES keys of KEY_BITS bits each, sampled from 128
SimHash bits: pairs of a similarity s agree on a key with probability (1 - p(s)) ** KEY_BITS, hence the recall of `recall`
(measured on random sets: 0.92 at 0.8, 0.98 at 0.85, all but a few of a thousand from 0.9 on). Inside
a key's group the Gray-order index of `simhash` finds fingerprints of the first 64 bits within RADIUS bits, of which those stay that
are within RADIUS_BOTH bits of all 128; a group sends one link for each core, which is what the plain search within four bits joins. Candidates reachable from one another make a cluster. A cluster's sets meet in blocks of bounded size, where candidate
pairs, nearest first, are verified unless already connected. A cluster of several blocks that one round over blocks leaves
unconnected is compared again in all pairs of its blocks, between its components only.

Defined results: texts with equal shingle sets are one item, texts without words among them; shingles as in `simhash`. Repeated
rows fall into one component. A null doc_id never names a component unless its component has no other. Very long texts are hashed
whole. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, components, distilled, forest, group_starts, materialize, per_group, split_hot, spread
from .simhash import gray_rank, links, majority, near_links, shingle_hashes

#: Tables and bits of a key. More bits a key keep groups small in larger corpora and need more tables for the same recall.
TABLES, KEY_BITS = 96, 18
#: Bits of the first 64 in which candidates may differ: the mean at similarity 4/5 is 9.7, the standard deviation 2.9.
RADIUS = 16
#: Bits of all 128 in which they may differ (mean 19.5, standard deviation 4.1). Of unrelated pairs with a key in common about one in
#: 600 is within RADIUS, one in 200,000 within this: without it chains of unrelated texts make one cluster of a large corpus.
RADIUS_BOTH = 32
#: Rows of one part of a large group of fingerprints, and sets of one block of a cluster.
MOST_ROWS, MOST_SETS = 20_000, 2_000
SECOND = np.uint64(0x9E3779B97F4A7C15)


def recall(similarity: float, tables: int = TABLES, key_bits: int = KEY_BITS) -> float:
    """The probability that two sets of this Jaccard similarity share a key (bits taken as independent)."""
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return 1 - (1 - (1 - p) ** key_bits) ** tables


def shingle_set(text: str | None, words: int, seed: int) -> np.ndarray:
    return np.unique(shingle_hashes((text or "").encode("utf-8", "surrogatepass"), words, seed))


def second_hash(h: np.ndarray) -> np.ndarray:
    """Another 64 bits of each shingle hash."""
    h = (h ^ SECOND) * np.uint64(0xBF58476D1CE4E5B9)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)


def table_keys(fp: np.ndarray, tables: int = TABLES, key_bits: int = KEY_BITS) -> np.ndarray:
    """(rows, tables): each table's number and its sampled bits of rows of two 64-bit words."""
    rng = np.random.default_rng(11)
    weights = np.zeros((128, tables))
    for t in range(tables):
        weights[rng.choice(128, key_bits, replace=False), t] = 2.0 ** np.arange(key_bits)
    bits = np.unpackbits(fp.view(np.uint8).reshape(len(fp), 16), axis=1, bitorder="little")
    return (bits @ weights).astype(np.int64) + (np.arange(tables, dtype=np.int64) << 40)


def _items(words: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [shingle_set(text, words, seed) for text in batch.column("text").to_pylist()]
            items = np.array([xxhash.xxh64_intdigest(x.tobytes(), seed) for x in own], np.uint64)
            first, second = (np.array([majority(f(x)) for x in own], np.uint64) for f in (lambda x: x, second_hash))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tid"), *[pa.array(x.view(np.int64)) for x in (items, first, second)]], names=["doc_id", "tid", "item", "fp", "fp2"])

    return run


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = np.stack([batch.column("fp").to_numpy(), batch.column("fp2").to_numpy()], axis=1)
        key = table_keys(np.ascontiguousarray(fp))
        n = key.shape[1]
        yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), *[pa.array(np.repeat(x, n)) for x in (batch.column("item").to_numpy(), fp[:, 0], fp[:, 1])]], names=["key", "item", "fp", "fp2"])


def _candidates(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """One link an item to others of its group within RADIUS bits of the first 64 and RADIUS_BOTH of all 128."""
    starts = group_starts(*(table[k].to_numpy() for k in ("key", "block_lo", "block_hi")))
    size = np.diff(starts)
    keep = np.repeat(size > 1, size)
    group, item = np.repeat(np.arange(len(size)), size)[keep], table["item"].to_numpy()[keep]
    fp, fp2 = (table[k].to_numpy().view(np.uint64)[keep] for k in ("fp", "fp2"))
    order = np.lexsort((gray_rank(fp), group))
    group, fp, fp2, item = group[order], fp[order], fp2[order], item[order]
    a, b = links(group, fp, RADIUS, True, fp2, RADIUS_BOTH)
    if len(a):
        # A tree's links go to its smallest item, so that the links of one cluster's many groups are mostly the same.
        root = forest(a, b)
        least = item[: len(root)].copy()
        np.minimum.at(least, root, item[: len(root)])
        first, own = least[root], item[: len(root)]
        rest = first != own
        yield pa.RecordBatch.from_arrays([pa.array(first[rest]), pa.array(own[rest])], names=["a", "b"])


def _sets(words: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column("text").to_pylist()):
                own = pa.array(shingle_set(text, words, seed).view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column("tid").slice(i, 1), pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own)], names=["tid", "shingles"])

    return run


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Jaccard similarity 4/5 or more of two sorted sets."""
    if 5 * min(len(a), len(b)) < 4 * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 9 * both >= 4 * (len(a) + len(b))


def _verified(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Of whole blocks: links of similarity 4/5 or more that connect all such candidate pairs of the block; rows of one
    component are connected from the start."""
    starts = group_starts(*(table[k].to_numpy() for k in ("cluster", "block_lo", "block_hi")))
    for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        if hi - lo < 2:
            continue
        part = table.slice(lo, hi - lo)
        fp = part["fp"].to_numpy().view(np.uint64)
        order = np.argsort(gray_rank(fp), kind="stable")
        fp, item = fp[order], part["item"].to_numpy()[order]
        _, root = np.unique(part["component"].to_numpy()[order], return_inverse=True)
        a, b = links(np.zeros(len(fp), np.int64), fp, RADIUS)
        near = np.argsort(np.bitwise_count(fp[a] ^ fp[b]), kind="stable")
        a, b = a[near], b[near]
        lists = part["shingles"].combine_chunks()
        offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
        sets = [values[offsets[i] : offsets[i + 1]] for i in order.tolist()]
        out = []
        while len(a):
            open_ = root[a] != root[b]
            a, b = a[open_], b[open_]
            for x, y in zip(a[:1000].tolist(), b[:1000].tolist(), strict=True):
                if root[x] != root[y] and similar(sets[x], sets[y]):
                    out.append((item[x], item[y]))
                    root[root == root[y]] = root[x]
            a, b = a[1000:], b[1000:]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])


def near_texts(docs: DataFrame, words: int = 5, seed: int = 42) -> DataFrame:
    """(doc_id, tid, component, component_id) of each row: tid is xxhash64 of the text; the component's smallest item, and the
    smallest doc_id reachable over verified pairs."""
    arrow_batches(docs.sparkSession)
    texts = docs.select("doc_id", F.xxhash64("text").alias("tid"), "text")
    rows = materialize(texts.mapInArrow(_items(words, seed), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, tid long, item long, fp long, fp2 long"))
    items = materialize(rows.groupBy("item").agg(F.min("doc_id").alias("least"), F.min("tid").alias("tid"), F.first("fp").alias("fp"), F.first("fp2").alias("fp2")))

    # Cores: fingerprints linked by steps of few bits. Candidates link cores, so that copies of one text, which meet in most of the
    # tables, send few links of their own.
    prints = items.select("fp").distinct()
    cores = components(prints.select(F.col("fp").alias("id")), near_links(prints)).toDF("core_fp", "core")
    items = materialize(items.join(cores, F.col("fp") == F.col("core_fp")).drop("core_fp"))

    # Candidates: a key that occurs once is dropped where its group meets; keys of very many items are cut into blocks.
    def candidates() -> DataFrame:
        keyed = items.select(F.col("core").alias("item"), "fp", "fp2").mapInArrow(_keys, "key long, item long, fp long, fp2 long")
        hot = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > MOST_ROWS)
        parts = materialize(hot.select("key", F.ceil(F.col("rows") / MOST_ROWS).cast("int").alias("parts")))
        keys = ["key", "block_lo", "block_hi"]
        if parts.isEmpty():
            split = keyed.withColumns({"block_lo": F.lit(0), "block_hi": F.lit(0)})
        else:
            split = split_hot(keyed.withColumn("salt", F.xxhash64("fp")), ["key"], "salt", MOST_ROWS).select(*keys, "item", "fp", "fp2")
        return spread(split, *keys).mapInArrow(per_group(keys, _candidates), "a long, b long").distinct()

    near = distilled(docs.sparkSession, candidates)

    # Clusters of candidates; only their texts move.
    clusters = components(items.select(F.col("core").alias("id")).distinct(), near).toDF("core_id", "cluster")
    members = materialize(items.join(clusters, F.col("core") == F.col("core_id")).select("item", "tid", "fp", "cluster"))
    sized = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("cluster", F.ceil(F.col("n") / MOST_SETS).cast("int").alias("parts"))
    members = materialize(members.join(sized, "cluster"))
    once = texts.groupBy("tid").agg(F.first("text").alias("text")).join(members.select("tid"), "tid", "left_semi")
    sets = once.mapInArrow(_sets(words, seed), "tid long, shingles array<long>")
    held = materialize(members.join(sets, "tid").withColumn("salt", F.xxhash64("item")))
    keys = ["cluster", "block_lo", "block_hi"]

    def verified(rows: DataFrame) -> DataFrame:
        rows = rows.select(*keys, "item", "fp", "component", "shingles")
        return materialize(spread(rows, *keys).mapInArrow(per_group(keys, _verified), "a long, b long"))

    block = F.pmod("salt", F.col("parts")).cast("int")
    found = verified(held.withColumns({"block_lo": block, "block_hi": block, "component": F.col("item")}))
    large = held.where("parts > 1")
    if not large.isEmpty():
        grouped = large.join(components(large.select(F.col("item").alias("id")).distinct(), found), F.col("item") == F.col("id")).drop("id")
        mixed = materialize(grouped.groupBy("cluster").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("cluster"))
        split = split_hot(grouped.join(mixed, "cluster"), ["cluster"], "salt", MOST_SETS)
        found = found.union(verified(split))
    labelled = items.join(components(items.select(F.col("item").alias("id")), found), F.col("item") == F.col("id")).select("item", "least", "component")
    named = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    of = materialize(labelled.join(named, "component").select("item", "component", "component_id"))
    return rows.select("doc_id", "tid", "item").join(of, "item").select("doc_id", "tid", "component", "component_id")
