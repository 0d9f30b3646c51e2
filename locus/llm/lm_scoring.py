"""LM scoring by context-tree weighting over binary-decomposed bytes, beside an exact unigram base score.

The model predicts a text's bytes and one closing NUL, bit by bit: 255 binary trees (one per prefix of a byte's bits), each node
a Krichevsky-Trofimov estimator, mixed over all context depths 0..4 with weight 1/2 at every node. Trees are learnt from the
training texts and then frozen, so the counts can be summed in any order, by bucket and then over buckets. A context that the
training texts lack is predicted as at its longest suffix that they have.

Contexts are whole bytes. Two bytes make a branch of at most 65,536 contexts: the tree is worked off by branches, up to the root and
down again, and only the numbers of the 257 upper contexts are collected for that. Nothing is left out: however many contexts the
corpus has, the probability of each pair of context and byte that occurs in any text is a row of a table.

Texts are dealt into buckets. A bucket sends each of its distinct tokens once, with its training count; the totals of tokens that
more than one bucket knows come back to it. It asks once for each of its distinct pairs of context and byte, by a join.

Defined results: null text counts as empty: one token (the end), score of the closing NUL alone. Equal texts get equal scores.
Without training rows N = V = 0 and every byte has probability 1/256. Very long texts are scored in chunks; an empty table gives an
empty result; tokens with equal counts are told apart by their 64-bit hashes. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, group_starts, materialize, per_group, text_buffer
from .language_id import holds_out

#: Bits of a context's byte at distance 1, 2, ...
CLASS_BITS = (8, 8, 8, 8)
DEPTH = len(CLASS_BITS)
SLOT_BITS = sum(CLASS_BITS)
#: Bytes of text in a bucket of the base score, about.
BUCKET_BYTES = 10 << 20
CHUNK = 1 << 20


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with DEPTH NULs before and one after each, and the places of the bytes to predict (the closing NUL included)."""
    lengths = np.diff(offsets)
    total = int(lengths.sum())
    starts = np.cumsum(lengths + DEPTH + 1) - lengths - 1
    out = np.zeros(total + len(lengths) * (DEPTH + 1), np.uint8)
    keep = np.arange(total) + np.repeat(starts - (offsets[:-1] - offsets[0]), lengths)
    out[keep] = data[offsets[0] : offsets[-1]]
    at = np.arange(total + len(lengths)) + np.repeat(DEPTH * (np.arange(len(lengths)) + 1), lengths + 1)
    return out, at


def keys(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """slot << 8 | byte for each byte to predict of each text."""
    text, at = padded(data, offsets)
    key = np.zeros(len(text), np.uint64)
    for d in range(DEPTH):
        key[d + 1 :] = (key[d + 1 :] << np.uint64(CLASS_BITS[d])) | text[: len(text) - d - 1]
    return ((key << np.uint64(8)) | text)[at]


def chunks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of at most CHUNK texts with about CHUNK bytes."""
    a = 0
    while a < len(offsets) - 1:
        b = min(a + CHUNK, max(a + 1, int(np.searchsorted(offsets, offsets[a] + CHUNK, side="right")) - 1))
        yield a, b
        a = b


def _merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    k, n = (np.concatenate([np.zeros(0, np.int64), *[x[i] for x in found]]) for i in range(2))
    order = np.argsort(k, kind="stable")
    cut = group_starts(k[order])[:-1]
    return k[order][cut], np.add.reduceat(n[order], cut) if len(k) else n


def key_counts(data: np.ndarray, offsets: np.ndarray, training: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of texts in ascending order, and how often each occurs in training texts."""
    found = []
    for a, b in chunks(offsets):
        flag = np.repeat(training[a:b].astype(np.uint64), np.diff(offsets[a : b + 1]) + 1)
        ranked = np.sort((keys(data, offsets[a : b + 1]) << np.uint64(1)) | flag).astype(np.int64)
        cut = group_starts(ranked >> 1)[:-1]
        found.append((ranked[cut] >> 1, np.add.reduceat(ranked & 1, cut)))
        if len(found) > 16:
            found = [_merged(found)]
    return _merged(found)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = []
    for batch in batches:
        found.append(key_counts(*text_buffer(batch.column("text")), batch.column("training").to_numpy(zero_copy_only=False)))
        if len(found) > 16:
            found = [_merged(found)]
    k, n = _merged(found)
    for a in range(0, len(k), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(k[a : a + 100_000]), pa.array(n[a : a + 100_000])], names=["key", "n"])


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """log of the KT block probability of so many zeros and ones, in any order."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - np.log(np.pi)


def _stirling(x: np.ndarray) -> np.ndarray:
    """log gamma for x >= 0.5: Stirling's series after 8 steps of the recurrence; good to about 1e-12."""
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        shift += np.log(y)
        y += 1
    z = 1 / (y * y)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y - shift


#: log gamma at 0.5, 1, 1.5, ...
HALVES = _stirling(np.arange(1, 8193) / 2)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """log gamma at multiples of 0.5."""
    out = HALVES[np.minimum(2 * x - 1, len(HALVES) - 1).astype(np.int64)]
    large = 2 * x > len(HALVES)
    out[large] = _stirling(x[large])
    return out


def bit_counts(slots: np.ndarray, key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones per slot and bit prefix (column p - 1 belongs to prefix p in 1..255)."""
    tree = np.zeros((len(slots), 512))  # the slots of a branch, as many as texts have
    tree[np.searchsorted(slots, key >> 8), 256 + (key & 255)] = n
    for p in range(255, 0, -1):
        tree[:, p] = tree[:, 2 * p] + tree[:, 2 * p + 1]
    return tree[:, 2::2], tree[:, 3::2]


#: Bits of a slot below the context of each depth: the nearest class is the highest.
BELOW = [SLOT_BITS - sum(CLASS_BITS[:d]) for d in range(DEPTH + 1)]


def climb(slots: np.ndarray, z: np.ndarray, o: np.ndarray, top: int) -> list[tuple]:
    """Nodes (contexts, zeros, ones, log weighted probability, weight of the own estimate) of depths DEPTH down to `top`."""
    levels = [(slots, z, o, log_kt(z, o), np.ones_like(z))]
    for d in range(DEPTH - 1, top - 1, -1):
        ids, z, o, below, _ = levels[-1]
        parent = ids >> (BELOW[d] - BELOW[d + 1])
        starts = np.flatnonzero(np.append(True, parent[1:] != parent[:-1]))
        z, o = np.add.reduceat(z, starts, axis=0), np.add.reduceat(o, starts, axis=0)
        kt = log_kt(z, o)
        w = np.logaddexp(kt, np.add.reduceat(below, starts, axis=0)) - np.log(2)
        levels.append((parent[starts], z, o, w, np.exp(kt - np.log(2) - w)))
    return levels[::-1]


def branches(key: np.ndarray) -> Iterator[slice]:
    """The ranges of sorted keys whose two nearest classes agree."""
    cut = group_starts(key >> (8 + BELOW[2]))
    return map(slice, cut[:-1], cut[1:])


def upward(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For whole branches, by nearest class: zeros, ones and log weighted probability (class, 3, 255), summed over its branches."""
    near, sums = [], []
    for at in branches(key):
        slots = np.unique(key[at] >> 8)
        _, z, o, w, _ = climb(slots, *bit_counts(slots, key[at], n[at].astype(np.float64)), 2)[0]
        near.append(int(key[at][0] >> (8 + BELOW[1])))
        sums.append(np.stack([z[0], o[0], w[0]]))
    cut = group_starts(np.array(near))[:-1]
    return np.array(near, np.int64)[cut], np.add.reduceat(np.array(sums), cut, axis=0)


def crown(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From `upward` sums of each class (2^bits, 3, 255), for the context of that class, or the root where training texts lack it:
    P(one) if it is the longest known context, the mixture so far, and the weight left for longer contexts (each 2^bits x 255)."""
    z, o, below = sums[:, 0], sums[:, 1], sums[:, 2]
    kt = log_kt(z, o)
    w = np.logaddexp(kt, below) - np.log(2)
    own = np.exp(kt - np.log(2) - w)
    root_kt = log_kt(z.sum(0), o.sum(0))
    root_own = np.exp(root_kt - np.logaddexp(root_kt, w.sum(0)))
    root = (o.sum(0) + 0.5) / (z.sum(0) + o.sum(0) + 1.0)
    base, left = np.tile(root_own * root, (len(z), 1)), np.tile(1 - root_own, (len(z), 1))
    return _descend(z, o, own, np.tile(root, (len(z), 1)), base, left)


def _descend(z, o, own, one, base, left) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`one`, `base` and `left` of contexts from those of their parents; contexts not known keep the parent's."""
    known = (z[:, :1] + o[:, :1]) > 0  # prefix 1: all bytes
    estimate = (o + 0.5) / (z + o + 1.0)
    return (
        np.where(known, base + left * estimate, one),
        np.where(known, base + left * own * estimate, base),
        np.where(known, left * (1 - own), left),
    )


def downward(key: np.ndarray, n: np.ndarray, top: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """log10 probability of each key's byte after its context, for whole branches of sorted keys (n = 0: not in training)."""
    out = np.zeros(len(key))
    for at in branches(key):
        k = key[at]
        slots = np.unique(k >> 8)
        near = int(k[0] >> (8 + BELOW[1]))
        state, ids = tuple(x[near : near + 1] for x in top), np.array([near])
        for d, (contexts, z, o, _, own) in enumerate(climb(slots, *bit_counts(slots, k, n[at].astype(np.float64)), 2), start=2):
            up = np.searchsorted(ids, contexts >> CLASS_BITS[d - 1])
            state, ids = _descend(z, o, own, *(x[up] for x in state)), contexts
        out[at] = _byte_logs(state[0])[np.searchsorted(slots, k >> 8), k & 255]
    return out


def _byte_logs(one: np.ndarray) -> np.ndarray:
    """log10 P(byte) for each row from P(one) by bit prefix."""
    out = np.zeros((len(one), 512))
    with np.errstate(divide="ignore"):
        hi, lo = np.log10(one), np.log10(1 - one)
    for p in range(1, 256):
        out[:, 2 * p], out[:, 2 * p + 1] = out[:, p] + lo[:, p - 1], out[:, p] + hi[:, p - 1]
    return out[:, 256:]


def text_scores(data: np.ndarray, offsets: np.ndarray, key: np.ndarray, log: np.ndarray) -> np.ndarray:
    """log10 probability of each text with its closing NUL, from sorted keys (all of these texts' among them) and their logs."""
    out = np.zeros(len(offsets) - 1)
    for a, b in chunks(offsets):
        k = keys(data, offsets[a : b + 1])
        of = np.repeat(np.arange(b - a, dtype=np.uint64), np.diff(offsets[a : b + 1]) + 1)
        ranked = np.sort((k << np.uint64(20)) | of)  # 8 + SLOT_BITS bits of key, at most 2^20 texts
        k = (ranked >> np.uint64(20)).astype(np.int64)
        cut = group_starts(k)
        logs = np.repeat(log[np.searchsorted(key, k[cut[:-1]])], np.diff(cut))
        out[a:b] = np.bincount((ranked & np.uint64((1 << 20) - 1)).astype(np.int64), weights=logs, minlength=b - a)
    return out


def _up(table: pa.Table) -> Iterator[pa.RecordBatch]:
    near, sums = upward(table["key"].to_numpy(), table["n"].to_numpy())
    width = sums.shape[2]
    columns = [np.repeat(near, width), np.tile(np.arange(width), len(near)), *(sums[:, i].ravel() for i in range(3))]
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["near", "prefix", "z", "o", "w"])


def _down(top):
    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        logs = downward(table["key"].to_numpy(), table["n"].to_numpy(), top.value)
        yield pa.RecordBatch.from_arrays([table["key"].combine_chunks(), pa.array(logs.astype(np.float32))], names=["key", "log"])

    return work


def key_logs(counts: DataFrame) -> DataFrame:
    """(key, log): log10 probability of each distinct key of counts (key, n), where n sums to how often training texts have it.

    A task works off whole branches, each at most 2^16 contexts with 256 bytes. Collected: 256 x 255 rows of sums."""
    sums = counts.groupBy("key").agg(F.sum("n").alias("n"))
    sums = materialize(sums.withColumn("branch", F.shiftright("key", 8 + BELOW[2]).cast("int")))
    dealt = sums.repartition("branch").sortWithinPartitions("branch", "key")
    raised = dealt.mapInArrow(per_group(["branch"], _up), "near long, prefix long, z double, o double, w double")
    rows = raised.groupBy("near", "prefix").agg(*[F.sum(c).alias(c) for c in "zow"]).toArrow()
    total = np.zeros((1 << CLASS_BITS[0], 3, 255))
    for i, c in enumerate("zow"):
        total[rows["near"].to_numpy(), i, rows["prefix"].to_numpy()] = rows[c].to_numpy()
    top = counts.sparkSession.sparkContext.broadcast(crown(total))
    return materialize(dealt.mapInArrow(per_group(["branch"], _down(top)), "key long, log float"))


def _tokens(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) runs of bytes other than space, \\t, \\n, \\v, \\f, \\r."""
    return text.lower().split()


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words)).view(np.int64)


def bucket_counts(table: pa.Table) -> pa.Table:
    """(bucket, token, n): each distinct token of a bucket's texts once, as a 64-bit hash, with its count in training texts."""
    known: Counter = Counter()
    other: set[bytes] = set()
    data, offsets = text_buffer(table["text"].combine_chunks())
    for a, b, train in zip(offsets[:-1], offsets[1:], table["training"].to_pylist(), strict=True):
        words = _tokens(data[a:b].tobytes())
        if train:
            known.update(words)
        else:
            other.update(words)
    other -= known.keys()
    n = np.fromiter(known.values(), dtype=np.int64, count=len(known))
    token = _hashes([*known, *other])
    return pa.table({"bucket": pa.array(np.full(len(token), table["bucket"][0].as_py(), np.int32)), "token": token, "n": np.concatenate([n, np.zeros(len(other), np.int64)])})


def _bucket_keys(table: pa.Table) -> pa.Table:
    """(bucket, key): each distinct key of a bucket's texts."""
    key = key_counts(*text_buffer(table["text"].combine_chunks()), np.zeros(table.num_rows, bool))[0]
    return pa.table({"bucket": pa.array(np.full(len(key), table["bucket"][0].as_py(), np.int32)), "key": key})


def _score_bucket(docs: pa.Table, totals: pa.Table) -> pa.Table:
    """docs: rows of a bucket; totals: (bucket, tree, token, value): the training counts of tokens that other buckets know
    too, and, under tree, the logs of the bucket's keys."""
    if not docs.num_rows:
        return pa.table({"doc_id": docs["doc_id"], "n_tokens": pa.array([], pa.int64()), "n_known": pa.array([], pa.int64()), "logs": pa.array([], pa.float64()), "score": pa.array([], pa.float64())})
    counts: Counter = Counter()
    data, offsets = text_buffer(docs["text"].combine_chunks())
    texts = [data[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]  # views
    for text, train in zip(texts, docs["training"].to_pylist(), strict=True):
        words = _tokens(text.tobytes())
        if train:
            counts.update(words)
        else:
            for w in words:
                if w not in counts:
                    counts[w] = 0
    words = list(counts)
    n = np.fromiter(counts.values(), dtype=np.int64, count=len(words))
    tree, token, value = totals["tree"].to_numpy(), totals["token"].to_numpy(), totals["value"].to_numpy()
    order = np.lexsort((token, tree))
    tokens = len(tree) - int(tree.sum())
    token, value = token[order], value[order]
    if tokens:
        own = _hashes(words)
        at = np.minimum(np.searchsorted(token[:tokens], own), tokens - 1)
        n = np.where(token[at] == own, value[at].astype(np.int64), n)
    place = dict(zip(words, range(len(words)), strict=True))
    logs, known = np.log10(n + 0.5), n > 0
    lengths = np.zeros(len(texts), np.int64)
    sums, knows = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        at = np.fromiter(map(place.__getitem__, _tokens(text.tobytes())), dtype=np.int64)
        lengths[i], sums[i], knows[i] = len(at), logs[at].sum(), known[at].sum()
    return pa.table({"doc_id": docs["doc_id"], "n_tokens": lengths, "n_known": knows, "logs": sums, "score": text_scores(data, offsets, token[tokens:], value[tokens:])})


def score_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of rows (doc_id, text, training boolean).

    n_tokens counts the end token; base_score = sum over tokens of log10((c + 0.5) / (N + 0.5 * (V + 1))).
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    rows = docs.select("doc_id", "text", F.coalesce("training", F.lit(False)).alias("training"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    logs = key_logs(rows.select("text", "training").mapInArrow(_count, "key long, n long"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES), min(12, rows.limit(12).count()))
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy("bucket").applyInArrow(bucket_counts, "bucket int, token long, n long")
    counts = materialize(counts)
    # Totals by partial aggregation; a common word's row meets the buckets that know it in a join, where hot keys can be split.
    tokens = materialize(counts.groupBy("token").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("in_buckets")))
    v, n = tokens.where("total > 0").agg(F.count(F.lit(1)), F.sum("total")).first()
    ends = rows.where("training").count()
    v, n = v + (ends > 0), (n or 0) + ends
    several = tokens.where("in_buckets > 1").select("token", "total")
    totals = counts.select("bucket", "token").join(several, "token").select("bucket", F.lit(False).alias("tree"), "token", F.col("total").cast("double").alias("value"))
    asked = dealt.groupBy("bucket").applyInArrow(_bucket_keys, "bucket int, key long")
    totals = totals.unionByName(asked.join(logs, "key").select("bucket", F.lit(True).alias("tree"), F.col("key").alias("token"), F.col("log").cast("double").alias("value")))
    scored = dealt.groupBy("bucket").cogroup(totals.groupBy("bucket")).applyInArrow(_score_bucket, f"doc_id {kind}, n_tokens long, n_known long, logs double, score double")
    end_log = float(np.log10(ends + 0.5))
    unit = float(np.log10(n + 0.5 * (v + 1)))
    return scored.select(
        "doc_id",
        (F.col("n_tokens") + 1).alias("n_tokens"),
        (F.col("n_known") + int(ends > 0)).alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("logs") + end_log - (F.col("n_tokens") + 1) * unit).alias("base_score"),
        "score",
    )


def op4_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held = holds_out(F.col("doc_id"), 1)
    scored = score_texts(docs.withColumn("training", ~held))
    return scored.select("doc_id", holds_out(F.col("doc_id"), 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
