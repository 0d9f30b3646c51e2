"""Document fingerprints by Order MinHash.

A text's elements are its k-mers of code points, numbered by occurrence (the third "abcdefgh" is another element than the first).
Each of m hash functions selects the l elements with the smallest hashes; put back into text order and hashed together they form
one 16-bit part of the signature. Because order counts, likeness (the share of equal parts) follows edit distance, not only the
set of k-mers.

Defined results: null text counts as empty. Texts below k code points have one element, the text itself. Empty texts have the
fingerprint of no element (all zeros), so two empty texts are alike 1.0. Equal texts have equal fingerprints, wherever they are;
repeated rows follow one another. Rows with a null doc_id come first. A single row follows itself. An empty table gives an empty
result. Very long texts are handled in bounded chunks. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_batches, materialize

K = 8
M = 64
L = 2
#: Elements hashed at once by all functions: keeps the working set in the processor's cache.
CHUNK = 2048
_rng = np.random.default_rng(20240607)
MULTIPLIERS = _rng.integers(0, 1 << 32, M, dtype=np.uint32) | np.uint32(1)
MASKS = _rng.integers(0, 1 << 32, M, dtype=np.uint32)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x846CA68B)
    return x ^ (x >> np.uint32(16))


def elements(cp: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the occurrence-numbered k-mers of code points, and their positions; sorted by k-mer."""
    n = len(cp) - k + 1
    if len(cp) == 0:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    if n < 1:
        n, k = 1, len(cp)
    h = np.full(n, k, dtype=np.uint32)
    for i in range(k):
        h *= np.uint32(0x01000193)
        h ^= cp[i : i + n]
    h = _mix(h)
    both = np.sort((h.astype(np.uint64) << np.uint64(32)) | np.arange(n, dtype=np.uint64))
    h = (both >> np.uint64(32)).astype(np.uint32)
    new = np.ones(n, dtype=bool)
    new[1:] = h[1:] != h[:-1]
    at = np.arange(n)
    occurrence = at - np.maximum.accumulate(np.where(new, at, 0))
    return _mix(h + occurrence.astype(np.uint32) * np.uint32(0x9E3779B9)), (both & np.uint64(0xFFFFFFFF)).astype(np.int64)


def signature(cp: np.ndarray) -> np.ndarray:
    """M parts of 16 bits."""
    h, position = elements(cp)
    if not len(h):
        return np.zeros(M, np.uint16)
    least = np.full((M, 0), 0, np.uint32)
    which = np.zeros((M, 0), np.int64)
    rows = np.arange(M)
    for a in range(0, len(h), CHUNK):
        v = (h[None, a : a + CHUNK] ^ MASKS[:, None]) * MULTIPLIERS[:, None]
        for i in range(min(L, v.shape[1])):
            j = v.argmin(1)
            least = np.concatenate([least, v[rows, j][:, None]], axis=1)
            which = np.concatenate([which, (j + a)[:, None]], axis=1)
            if i + 1 < L:
                v[rows, j] = 0xFFFFFFFF
        if least.shape[1] > 16 * L or a + CHUNK >= len(h):
            order = np.lexsort((position[which], least), axis=1)[:, :L]
            least, which = np.take_along_axis(least, order, 1), np.take_along_axis(which, order, 1)
    chosen = np.take_along_axis(which, np.argsort(position[which], axis=1), 1)
    part = np.full(M, 0x811C9DC5, np.uint32) ^ MASKS
    for i in range(chosen.shape[1]):
        part = _mix(part * np.uint32(0x01000193) + h[chosen[:, i]])
    return (part >> np.uint32(16)).astype(np.uint16)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


#: Columns of a result row; an edge row (one a partition) also has the partition's number and its first and last text.
RESULT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
KINDS = "n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def compared(text: str, sign: np.ndarray, after: str, after_sign: np.ndarray) -> tuple:
    """A result row's columns but its doc_id, for a text and the next one."""
    half = len(text) // 2
    edited = text[: len(text) - half] + after[:half]
    edited_sign = signature(code_points(edited))
    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).digest()
    return len(text), digest, sign.tobytes(), edited_sign.tobytes(), float((sign == edited_sign).mean()), float((sign == after_sign).mean())


def _inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a partition in order: a result for all but the last one, then an edge row."""
    first = last = None
    with np.errstate(over="ignore"):
        for batch in batches:
            rows, kind = [], batch.column("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                text = text or ""
                sign = signature(code_points(text))
                if last is None:
                    first = text
                else:
                    rows.append((last[0], *compared(last[1], last[2], text, sign)))
                last = doc_id, text, sign
            part = batch.column("part")[0].as_py() if batch.num_rows else 0
            if rows:
                values = [pa.array(v, k) for v, k in zip(zip(*rows, strict=True), [kind, pa.int64(), *[pa.binary()] * 3, *[pa.float64()] * 2], strict=True)]
                yield pa.RecordBatch.from_arrays([*values, pa.nulls(len(rows), pa.int32()), *[pa.nulls(len(rows), pa.string())] * 2], names=[*RESULT, "part", "first", "last"])
        if last is not None:
            values = [pa.array([last[0]], kind), pa.nulls(1, pa.int64()), *[pa.nulls(1, pa.binary())] * 3, *[pa.nulls(1, pa.float64())] * 2]
            yield pa.RecordBatch.from_arrays([*values, pa.array([part], pa.int32()), pa.array([first]), pa.array([last[1]])], names=[*RESULT, "part", "first", "last"])


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last row of a partition with the first text of the next partition that has rows."""
    with np.errstate(over="ignore"):
        for batch in batches:
            rows = [compared(text, signature(code_points(text)), after, signature(code_points(after))) for text, after in zip(batch.column("last").to_pylist(), batch.column("after").to_pylist(), strict=True)]
            if rows:
                values = [pa.array(v, k) for v, k in zip(zip(*rows, strict=True), [pa.int64(), *[pa.binary()] * 3, *[pa.float64()] * 2], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *values], names=RESULT)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row (doc_id, text).

    "Next" is the next row by (doc_id, hash of the text), nulls first, the first row after the last. Texts are shuffled once, by
    ranges of that order, so that rows with one doc_id (or none) need not share a range. A partition's last row meets the next
    partition's first text by a join on partition numbers; the numbers alone are ordered in one task.
    """
    arrow_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    order = [F.col("doc_id").asc_nulls_first(), F.col("tid").asc()]
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("tid")).repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = rows.select("doc_id", "text", F.spark_partition_id().alias("part"))
    found = materialize(numbered.mapInArrow(_inside, f"doc_id {kind}, {KINDS}, part int, first string, last string"))
    edges = found.where("part is not null")
    in_order = Window.orderBy("part")
    numbers = edges.select("part").withColumn("next", F.coalesce(F.lead("part").over(in_order), F.min("part").over(in_order)))
    firsts = edges.select(F.col("part").alias("next"), F.col("first").alias("after"))
    across = edges.select("doc_id", "last", "part").join(numbers, "part").join(firsts, "next").select("doc_id", "last", "after")
    every = found.where("part is null").select(*RESULT).unionByName(across.mapInArrow(_across, f"doc_id {kind}, {KINDS}"))
    return every.select(*[F.lower(F.hex(c)).alias(c) if c.endswith(("sha256", "fingerprint")) else F.col(c) for c in RESULT])


def op3_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
