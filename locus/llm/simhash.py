"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprints of 64 bits are the bitwise majority over the XXH64 hashes of a text's word shingles. Equal fingerprints are one item
from then on. Two fingerprints that differ in at most `most_bits` bits agree on two of most_bits + 2 blocks of bits, so items are
dealt out by (pair of blocks, their bits): for four bits 15 rows an item in place of 5, with keys of 21 bits in place of 13, so
groups stay small to some million times more items. Inside such a group they are sorted by Gray rank, so that neighbours share
bits; eight neighbours make a node that holds the bits all of them share, eight nodes an upper node, and a node keeps only the bits its parent does not
hold. A search adds up differences from the top down and drops a node, with all below it, once they exceed the limit.

Groups send no pairs: each unites its links locally and sends one link per item. Hot groups are cut into blocks of bounded size.

Defined results: null or blank text has fingerprint zero and is linked like any other. Fewer words than a shingle: the whole
sequence is the only shingle. Repeated rows fall into one component. A null doc_id never names a component unless its component
has no other; rows keep their own line. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, components, forest, group_starts, materialize, per_group, split_hot, spread

FAN = 8
#: Rows that are compared in one task of a hot group, half of it.
MOST_ROWS = 20_000
#: (query, row) pairs that may come up at once.
FRONTIER = 4_000_000
BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def shingle_hashes(text: bytes, words: int, seed: int) -> np.ndarray:
    """XXH64 of each shingle of a text; A-Z are lower-cased, words are runs of other bytes than \\x20, \\x09-\\x0D."""
    found = text.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    joined = b" ".join(found)
    if len(found) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found)) + 1) - 1
    begins = np.append(0, ends[:-1] + 1)
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(begins[: len(found) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)), dtype=np.uint64, count=len(found) - words + 1)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half the hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 65536):
        part = hashes[a : a + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.bitwise_or.reduce(BITS[ones * 2 > len(hashes)], initial=np.uint64(0)))


def _fingerprints(words: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = [majority(shingle_hashes((t or "").encode("utf-8", "surrogatepass"), words, seed)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.array(fp, dtype=np.uint64).view(np.int64))], names=["doc_id", "fp"])

    return run


def gray_rank(x: np.ndarray) -> np.ndarray:
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


def links(group: np.ndarray, fp: np.ndarray, most_bits: int, thin: bool = False, second: np.ndarray | None = None, most_both: int = 128) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of the same group that differ in at most most_bits bits, and with `second`, further 64 bits of each row, in at most
    most_both of all; rows are sorted by (group, Gray rank). thin: when they become many, only links that connect the same rows are
    kept."""
    n = len(fp)
    # Levels of nodes from the leaves up: first row, row after the last, shared pattern, shared mask, first child.
    bounds = group_starts(group)
    ones = np.uint64(0xFFFFFFFFFFFFFFFF)
    begin, end, pattern, mask = np.arange(n), np.arange(1, n + 1), fp, np.full(n, ones)
    of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    levels = []
    while True:
        first = group_starts(of)[:-1]
        width = np.diff(np.append(first, len(of)))
        if width.max(initial=0) <= 1 and levels:
            break
        rank = np.arange(len(of)) - np.repeat(first, width)
        head = np.flatnonzero(rank % FAN == 0)
        low, high = np.bitwise_and.reduceat(np.where(mask == ones, pattern, pattern & mask), head), np.bitwise_or.reduceat(np.where(mask == ones, pattern, pattern | ~mask), head)
        same = ~(low ^ high) & np.bitwise_and.reduceat(mask, head)
        up = np.cumsum(rank % FAN == 0) - 1
        levels.append((begin, end, pattern, mask & ~same[up]))
        children = np.append(head, len(of))
        begin, end, pattern, mask, of = begin[head], end[children[1:] - 1], low & same, same, of[head]
        levels[-1] += (children,)
    top_of = group_starts(of)[:-1]
    tops = np.diff(np.append(top_of, len(of)))
    own = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    # A query may reach its whole group: as many queries at a time as keep that bounded.
    reach = np.cumsum(np.diff(bounds)[own])
    found_a, found_b, held, a = [], [], 0, 0
    while a < n:
        z = max(a + 1, int(np.searchsorted(reach, (reach[a - 1] if a else 0) + FRONTIER, side="right")))
        rows = np.arange(a, min(n, z))
        a = z
        count = tops[own[rows]]
        q = np.repeat(rows, count)
        node = np.repeat(top_of[own[rows]], count) + np.arange(len(q)) - np.repeat(np.cumsum(count) - count, count)
        so_far = np.bitwise_count((fp[q] ^ pattern[node]) & mask[node]).astype(np.int64)
        go = (so_far <= most_bits) & (end[node] > q + 1)
        q, node, so_far = q[go], node[go], so_far[go]
        for _, hi, pat, rest, children in reversed(levels):
            width = children[node + 1] - children[node]
            q, so_far = np.repeat(q, width), np.repeat(so_far, width)
            node = np.repeat(children[node], width) + np.arange(len(q)) - np.repeat(np.cumsum(width) - width, width)
            so_far = so_far + np.bitwise_count((fp[q] ^ pat[node]) & rest[node])
            go = (so_far <= most_bits) & (hi[node] > q + 1)
            q, node, so_far = q[go], node[go], so_far[go]
        if second is not None:
            go = so_far + np.bitwise_count(second[q] ^ second[node]) <= most_both
            q, node = q[go], node[go]
        found_a.append(q)
        found_b.append(node)
        held += len(q)
        if thin and held > 2 * FRONTIER:
            root = forest(np.concatenate(found_a), np.concatenate(found_b))
            rest_of = np.flatnonzero(root != np.arange(len(root)))
            found_a, found_b, held = [root[rest_of]], [rest_of], len(rest_of)
    return np.concatenate(found_a or [np.zeros(0, np.int64)]), np.concatenate(found_b or [np.zeros(0, np.int64)])


def _link_groups(most_bits: int):
    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = [table[k].to_numpy() for k in ("block", "value", "block_lo", "block_hi")]
        starts = group_starts(*keys)
        group = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        fp = table["fp"].to_numpy().view(np.uint64)
        order = np.lexsort((gray_rank(fp), group))
        group, fp = group[order], fp[order]
        a, b = links(group, fp, most_bits, thin=True)
        if len(a):
            root = forest(a, b)
            touched = np.unique(np.concatenate([a, b]))
            touched = touched[root[touched] != touched]
            yield pa.RecordBatch.from_arrays([pa.array(fp[root[touched]].view(np.int64)), pa.array(fp[touched].view(np.int64))], names=["a", "b"])

    return work


def fingerprints(docs: DataFrame, words: int = 5, seed: int = 42) -> DataFrame:
    """(doc_id, fp) of each row (doc_id, text); fp is the unsigned fingerprint as a signed long."""
    arrow_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_fingerprints(words, seed), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


def near_links(items: DataFrame, most_bits: int = 4) -> DataFrame:
    """Links (a, b) of distinct fingerprints (fp) that join all those reachable by steps of at most most_bits bits."""
    n = most_bits + 2
    cuts = [64 * i // n for i in range(n + 1)]
    masks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]
    both = [masks[i] | masks[j] for i in range(n) for j in range(i)]
    signed = [x - (1 << 64) if x >> 63 else x for x in both]
    blocks = F.array(*[F.struct(F.lit(i).alias("block"), F.col("fp").bitwiseAND(F.lit(x)).alias("value")) for i, x in enumerate(signed)])
    rows = items.select("fp", F.inline(blocks)).withColumn("salt", F.xxhash64("fp"))
    split = split_hot(rows, ["block", "value"], "salt", MOST_ROWS).select("block", "value", "block_lo", "block_hi", "fp")
    keys = ["block", "value", "block_lo", "block_hi"]
    return spread(split, *keys).mapInArrow(per_group(keys, _link_groups(most_bits)), "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, most_bits: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fingerprint, component_id) of each row: 16 hex digits; the smallest doc_id reachable over links."""
    prints = materialize(fingerprints(docs, words, seed))
    items = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = components(items.select(F.col("fp").alias("id")), near_links(items.select("fp"), most_bits))
    labelled = items.join(found, items["fp"] == found["id"]).select("fp", "least", "component")
    named = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    of = materialize(labelled.join(named, "component").select("fp", "component_id"))
    return prints.join(of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_simhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=4)
