"""Removal of every byte covered by a `length`-byte string that also starts elsewhere, over all documents.

Blockwise suffix sorting with a difference cover, one bucket of suffixes at a time. A suffix's bucket is its anchor: the leftmost
smallest hash among the 32-byte strings in its first `length` bytes. Equal suffixes have equal anchors, and neighbouring suffixes
with one anchor are one run (about 2 runs per `length` bytes), which is all that is shuffled; a bucket of one run is done. Runs
that are equal as a whole decide all their suffixes. Other runs of a bucket are sorted only if they agree with another one on half
of `length` to either side of the anchor; then their bytes (at most 2 x length) meet in blocks of whole buckets.

In a block, positions at cover residues (a difference cover of PERIOD: any two positions have a common distance below PERIOD to
cover positions) are ranked by prefix doubling, with the lengths of their common prefixes. All suffixes are sorted by their first
PERIOD bytes; ties, which are long, are resolved by the ranks of the cover positions at that common distance. So a block needs
memory in proportion to its bytes, whatever the length of the ties, and suffixes are compared by their bytes.

Defined results: null text counts as empty; texts shorter than `length` lose nothing; copies (repeated rows included) remove each
other wholly; an empty table gives an empty result. Whole runs, and suffixes of buckets that are cut into several blocks, are
compared by 64-bit hashes beside the anchor's. Very long texts are worked off in pieces, which cuts runs but changes no result.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, distilled, group_starts, materialize, per_group, spread, text_buffer

ANCHOR = 32
PIECE = 1 << 19
#: Runs of a bucket that are compared in one block.
MOST_ROWS = 8_192
#: Period of the difference cover, and bytes that suffixes are first sorted by.
PERIOD = 32
_rng = np.random.default_rng(97)
TABLE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
ODD = _rng.integers(0, 1 << 63, 16, dtype=np.uint64) | np.uint64(1)


def _join(a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    return ((a ^ (a >> np.uint64(29))) * ODD[level]) + (b ^ (b >> np.uint64(32)))


def string_hashes(data: np.ndarray, *lengths: int) -> list[np.ndarray]:
    """For each length, hashes of the strings of that many bytes at every position."""
    needed = np.bitwise_or.reduce(lengths)
    powers, h, k, level = {}, TABLE[data], 1, 0
    while True:
        if needed & k:
            powers[k] = h
        if 2 * k > max(lengths):
            break
        h = _join(h[: max(0, len(h) - k)], h[k:], level)
        k, level = 2 * k, level + 1
    out = []
    for length in lengths:
        n = max(0, len(data) - length + 1)
        at, whole = 0, None
        for bit in reversed(range(length.bit_length())):
            if length >> bit & 1:
                part = powers[1 << bit][at : at + n]
                whole = part if whole is None else _join(whole, part, 12)
                at += 1 << bit
        out.append(whole)
    return out


def piecewise_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """`string_hashes` of one length, worked off in pieces: it takes many times the bytes that it reads."""
    return np.concatenate([string_hashes(data[a : a + PIECE + length - 1], length)[0] for a in range(0, max(1, len(data) - length + 1), PIECE)])


def window_minima(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` consecutive keys."""
    n = len(key) - width + 1
    if n <= 0:
        return key[:0]
    blocks = -(-len(key) // width)
    square = np.full(blocks * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    square[: len(key)] = key
    square = square.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    behind = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def pieces(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int]]:
    """Overlapping stretches [a, b) of a buffer: each start of a `length`-byte string is in just one, [a, b - length]."""
    a, end = int(offsets[0]), int(offsets[-1])
    while a <= end - length:
        b = min(end, a + PIECE + length)
        yield a, b
        a = b - length + 1


def valid_starts(a: int, b: int, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts (from a on) of `length`-byte strings inside one text of [a, b), and which text that is."""
    lo, hi = int(np.searchsorted(offsets, a, side="right")) - 1, int(np.searchsorted(offsets, b, side="left"))
    docs = np.arange(lo, hi)
    first = np.maximum(offsets[docs], a)
    count = np.maximum(0, np.minimum(offsets[docs + 1], b) - length + 1 - first)
    of = np.repeat(docs, count)
    return np.repeat(first - a, count) + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count), of


def _runs(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for a, b in pieces(offsets, length):
                start, of = valid_starts(a, b, offsets, length)
                if not len(start):
                    continue
                part = data[a:b]
                side = length // 2  # bytes from the anchor on, or up to its end, that two runs must share to be compared
                part_of = 1 << (side.bit_length() - 1)
                gram, half, full = string_hashes(part, ANCHOR, part_of, length)
                key = (gram & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(gram), dtype=np.uint64)
                anchor = (window_minima(key, length - ANCHOR + 1)[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
                cut = group_starts(anchor, of)
                s, e = start[cut[:-1]], start[cut[1:] - 1]
                where, doc = anchor[cut[:-1]], of[cut[:-1]]
                whole = _join(_join(full[s], full[e], 13), (e - s).astype(np.uint64), 14) ^ (where - s).astype(np.uint64)
                right_ok, left_ok = where + side <= e + length, where - (side - ANCHOR) >= s
                last = len(half) - 1
                w = np.minimum(where, last)
                right = _join(half[w], half[np.minimum(where + side - part_of, last)], 13)
                left = _join(half[np.minimum(np.maximum(where - (side - ANCHOR), 0), last)], half[np.minimum(np.maximum(where + ANCHOR - part_of, 0), last)], 15)
                shift = a - offsets[doc]
                rows = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(rows), batch.column("rid").take(rows), pa.array((s + shift).astype(np.int32)), pa.array((e + shift).astype(np.int32)), pa.array(gram[where].view(np.int64)), pa.array(whole.view(np.int64)), pa.array(right.view(np.int64), mask=~right_ok), pa.array(left.view(np.int64), mask=~left_ok)],
                    names=["doc_id", "rid", "s", "e", "anchor", "whole", "right", "left"],
                )

    return run


def _cut_out(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bytes of the runs asked for: rows (text, runs) to rows of a run each."""
        for batch in batches:
            out = []
            for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                data = text.encode("utf-8", "surrogatepass")
                out += [(r["doc_id"], r["rid"], r["s"], r["alone"], r["bucket"], r["block"], r["blocks"], data[r["s"] : r["e"] + length]) for r in runs]
            if out:
                names = ["doc_id", "rid", "s", "alone", "bucket", "block", "blocks", "string"]
                kinds = [batch.schema.field("runs").type.value_type.field(n).type for n in names[:-1]] + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return run


def difference_cover(period: int) -> np.ndarray:
    """Residues of which some two have any given difference modulo `period`; taken greedily."""
    cover, missing = [0], set(range(1, period))
    while missing:
        gains = [({(x - c) % period for c in cover} | {(c - x) % period for c in cover}) & missing for x in range(period)]
        best = max(range(period), key=lambda x: len(gains[x]))
        cover.append(best)
        missing -= gains[best]
    return np.array(sorted(cover))


COVER = difference_cover(PERIOD)


def dense(key: np.ndarray) -> np.ndarray:
    """Ranks of keys, equal ones sharing one; in less memory than np.unique takes."""
    order = np.argsort(key)
    ordered = key[order]
    new = np.zeros(len(key), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    del ordered
    out = np.empty(len(key), np.int32)
    out[order] = np.cumsum(new, dtype=np.int32)
    return out


def paired(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Keys of two ranks each."""
    key = high.astype(np.int64)
    key <<= 32
    key |= low
    return key


class CoverRanks:
    """Ranks of a buffer's cover positions by their suffixes, to a depth of `length` bytes or more, and their common prefixes.

    Cover positions are numbered in order, so that a step of PERIOD bytes is one of len(COVER) numbers.
    """

    def __init__(self, data: np.ndarray, length: int):
        n = len(data)
        padded = np.concatenate([data, np.zeros(2 * PERIOD, np.uint8)])
        word, k = padded, 1
        for kind in (np.uint16, np.uint32, np.uint64):
            low = word[k:]
            word = word[: len(word) - k].astype(kind)
            word <<= kind(8 * k)
            word |= low
            k *= 2
        # Ranks by the first 8, 16 and 32 bytes, at all positions.
        rank = np.zeros(n + 2 * PERIOD, np.int32)
        rank[: n + PERIOD] = dense(word[: n + PERIOD]) + 1
        del word, low
        while k < PERIOD:
            m = len(rank) - k
            rank[:m] = dense(paired(rank[:m], rank[k:])) + 1
            rank[m:] = 0
            k *= 2
        self.first = rank[:n]
        # Prefix doubling over cover positions: a step of PERIOD * 2^j leads from one to another.
        places = (np.arange(0, n, PERIOD)[:, None] + COVER).ravel()
        places = places[places < n]
        m, step, depth = len(places), len(COVER), PERIOD
        own = np.arange(m)
        levels = [np.append(self.first[places], np.int32(0))]
        while depth < length:
            now = levels[-1]
            levels.append(np.append(dense(paired(now[:m], now[np.minimum(own + step, m)])) + np.int32(1), np.int32(0)))
            step, depth = 2 * step, 2 * depth
        self.order = np.argsort(levels[-1][:m], kind="stable")
        # Common prefix of each cover suffix with the one before it: whole blocks by rank, the rest by bytes.
        p, q = self.order[:-1], self.order[1:]
        ahead = np.zeros(len(p), np.int64)
        for j in reversed(range(len(levels))):
            a, b = levels[j][np.minimum(p + ahead, m)], levels[j][np.minimum(q + ahead, m)]
            ahead += (len(COVER) << j) * ((a == b) & (a > 0))
        p, q, same = places[p], places[q], ahead // len(COVER) * PERIOD
        words = np.lib.stride_tricks.sliding_window_view(padded, 8)
        open_ = same < length
        for _ in range(PERIOD // 8):
            x = np.flatnonzero(open_)
            a, b = (words[np.minimum(at[x] + same[x], n + PERIOD - 1)].view(">u8")[:, 0].astype(np.uint64) for at in (p, q))
            differ = a ^ b
            bits = np.zeros(len(x), np.int64)
            for s in (32, 16, 8):
                high = differ >> np.uint64(64 - s) == 0
                bits += s * high
                differ = np.where(high, differ << np.uint64(s), differ)
            bits = np.where(a == b, 64, bits)
            same[x] += bits // 8
            open_[x] = bits == 64
        self.common = np.concatenate([[0], np.minimum(same, length)])

    def classes(self, depth: int, at: np.ndarray) -> np.ndarray:
        """Cover positions whose suffixes agree on their first `depth` bytes share a number."""
        out = np.empty(len(self.order), np.int32)
        out[self.order] = np.cumsum(self.common < depth, dtype=np.int32)
        return out[at // PERIOD * len(COVER) + np.searchsorted(COVER, at % PERIOD)]


def repeated_suffixes(data: np.ndarray, starts: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Which of the starts of `length`-byte strings (of a group each, within the buffer) have an equal one in their group."""
    found = np.zeros(len(starts), bool)
    if len(starts) < 2:
        return found
    ranks = CoverRanks(data, length)
    # Sort by the first PERIOD bytes; what is alone then is done.
    first = dense(paired(group, ranks.first[starts]))
    tied = np.flatnonzero(np.bincount(first)[first] > 1)
    residue = starts[tied] % PERIOD
    for ahead in range(PERIOD):
        own = tied[np.isin((residue + ahead) % PERIOD, COVER)]
        if len(own) < 2:
            continue
        of = dense(paired(first[own], ranks.classes(length - ahead, starts[own] + ahead)))
        found[own] |= np.bincount(of)[of] > 1
    return found


def _resolve(length: int):
    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        """Of whole blocks: spans s..e of starts whose suffix is equal to another one in its block, for runs that stand alone.
        Of buckets with several blocks also each distinct suffix (cross), to be compared across
        blocks: undecided are those that occur once in their block."""
        bucket = table["bucket"].to_numpy()
        groups = group_starts(bucket, table["block"].to_numpy())
        group = np.repeat(np.arange(len(groups) - 1), np.diff(groups))
        blocks, alone, first = table["blocks"].to_numpy(), table["alone"].to_numpy(zero_copy_only=False), table["s"].to_numpy()
        ids, rids = table["doc_id"].combine_chunks(), table["rid"].to_numpy()
        data, offsets = text_buffer(table["string"].combine_chunks())
        g = 0
        while g < len(groups) - 1:  # some whole blocks at a time
            to = max(g + 1, int(np.searchsorted(offsets[groups], offsets[groups[g]] + 2 * PIECE, side="right")) - 1)
            lo, hi = int(groups[g]), int(groups[to])
            g = to
            part = data[offsets[lo] : offsets[hi]]
            start, row = valid_starts(int(offsets[lo]), int(offsets[hi]), offsets[lo : hi + 1], length)
            row += lo
            begin = (start + int(offsets[lo]) - offsets[row] + first[row]).astype(np.int32)
            many = repeated_suffixes(part, start, group[row] - group[lo], length)
            pick = many & alone[row]
            # Across blocks: each distinct suffix of a block once, by its hash.
            cross, h = np.zeros(0, np.int64), np.zeros(0, np.uint64)
            split = np.flatnonzero(blocks[row] > 1)
            if len(split):
                h = piecewise_hashes(part, length)[start[split]]
                once = np.unique(h ^ (group[row[split]].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]
                cross, h = split[once], h[once]
            at, where = begin[pick], row[pick]
            # Neighbouring starts of a run make a span.
            cut = group_starts(where, at - np.arange(len(at)))
            s, e, rows = at[cut[:-1]], at[cut[1:] - 1] if len(at) else at, where[cut[:-1]]
            rows = np.concatenate([rows, row[cross]])
            undecided = np.concatenate([np.zeros(len(s), bool), alone[row[cross]] & ~many[cross]])
            for x in range(0, len(rows), 100_000):
                y = slice(x, x + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(rows[y])), pa.array(rids[rows[y]]), pa.array(np.concatenate([s, begin[cross]])[y].astype(np.int32)), pa.array(np.concatenate([e, begin[cross]])[y].astype(np.int32)), pa.array(bucket[rows[y]]), pa.array(np.concatenate([np.zeros(len(s), np.uint64), h]).view(np.int64)[y]), pa.array(np.arange(len(rows))[y] >= len(s)), pa.array(undecided[y])],
                    names=["doc_id", "rid", "s", "e", "bucket", "suffix", "cross", "undecided"],
                )

    return work


def _remove(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_bytes, removed, spans, digests, texts = [], [], [], [], []
            data, offsets = text_buffer(batch.column("text"))
            for i, runs in enumerate(batch.column("runs").to_pylist()):
                kept = own = data[offsets[i] : offsets[i + 1]]
                count = 0
                if runs:
                    marks = np.zeros(len(own) + 1, np.int32)
                    np.add.at(marks, [r["s"] for r in runs], 1)
                    np.add.at(marks, [r["e"] + length for r in runs], -1)
                    cover = np.cumsum(marks[:-1]) > 0
                    count = int(cover[0]) + int((cover[1:] & ~cover[:-1]).sum())
                    kept = own[~cover]
                raw = kept.tobytes()
                n_bytes.append(len(own))
                removed.append(len(own) - len(kept))
                spans.append(count)
                digests.append(hashlib.sha256(raw).hexdigest())
                texts.append(raw.decode("utf-8", "ignore"))  # a cut may split a character: its rest goes
            counts = [pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string())]
            others = [c for c in batch.schema.names if c not in ("text", "runs")]
            yield pa.RecordBatch.from_arrays([*counts, pa.array(texts, pa.string()), *[batch.column(c) for c in others]], names=[*NEW, "text", *others])

    return run


#: Columns added; columns of the input by these names give way.
NEW = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]


def in_blocks(keyed: DataFrame) -> DataFrame:
    """keyed (n, one, bucket) of buckets in which something is to be compared, beside block and blocks: large buckets are cut. A run goes
    by its text and start, so that the runs of one text are cut too."""
    sizes = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least")).where("k > 1 and least = 1")
    sizes = materialize(sizes.select("bucket", F.ceil(F.col("k") / MOST_ROWS).cast("int").alias("blocks")))
    # A bucket's rows meet its size by one join, where hot buckets can be split.
    return keyed.select("n", "one", "bucket").join(sizes, "bucket").withColumn("block", F.pmod(F.xxhash64("one.rid", "one.s"), F.col("blocks")).cast("int"))


def repeated_runs(rows: DataFrame, length: int = 400) -> DataFrame:
    """(doc_id, rid, s, e): spans of starts s..e of `length`-byte strings that also start elsewhere, for rows (doc_id, rid, text);
    rid is a hash of the row's doc_id and text, so that repeated rows share what is found."""
    if length < 4 * ANCHOR:
        raise ValueError(f"length must be {4 * ANCHOR} or more")
    spark = rows.sparkSession
    arrow_batches(spark)
    kind = rows.schema["doc_id"].dataType.simpleString()
    # Runs by content; an anchor that occurs once has no equal.
    def often() -> DataFrame:
        runs = materialize(rows.where(F.octet_length("text") >= length).select("doc_id", "rid", "text").mapInArrow(_runs(length), f"doc_id {kind}, rid long, s int, e int, anchor long, whole long, right long, left long"))
        several = materialize(runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"))
        return runs.join(several, "anchor")

    shared = distilled(spark, often)
    strings = materialize(shared.groupBy("anchor", "whole").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("rid", "s", "e", "doc_id")).alias("one"), F.first("right").alias("right"), F.first("left").alias("left")))
    full = shared.join(strings.where("n > 1").select("anchor", "whole"), ["anchor", "whole"]).select("doc_id", "rid", "s", "e")
    sides = F.array(*[F.struct(F.lit(side).alias("side"), F.col(side).alias("at")) for side in ("right", "left")])
    keyed = strings.select("n", "one", F.inline(sides), "anchor").where(F.col("at").isNotNull()).withColumn("bucket", F.xxhash64("side", "anchor", "at"))
    asked = in_blocks(keyed).select(F.struct(F.col("one.doc_id").alias("doc_id"), F.col("one.rid").alias("rid"), F.col("one.s").alias("s"), F.col("one.e").alias("e"), (F.col("n") == 1).alias("alone"), "bucket", "block", "blocks").alias("r"))
    # A text's runs are at most as many as its bytes.
    per_text = asked.groupBy(F.col("r.doc_id").alias("of"), F.col("r.rid").alias("rid")).agg(F.collect_list("r").alias("runs"))
    once = rows.select("doc_id", "rid", "text")
    cut = once.join(per_text, (once["rid"] == per_text["rid"]) & once["doc_id"].eqNullSafe(per_text["of"])).select("text", "runs")
    cut = cut.mapInArrow(_cut_out(length), f"doc_id {kind}, rid long, s int, alone boolean, bucket long, block int, blocks int, string binary")
    keys = ["bucket", "block"]
    found = materialize(spread(cut, *keys).mapInArrow(per_group(keys, _resolve(length)), f"doc_id {kind}, rid long, s int, e int, bucket long, suffix long, cross boolean, undecided boolean"))
    across = found.where("cross").groupBy("bucket", "suffix").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket", "suffix")
    whole = found.where("not cross").select("doc_id", "rid", "s", "e")
    crossed = found.where("cross and undecided").join(across, ["bucket", "suffix"]).select("doc_id", "rid", "s", "e")
    return full.unionByName(whole).unionByName(crossed)


def remove_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """n_bytes, n_removed, n_spans, kept_sha256 of each row of docs (doc_id, text) beside its columns, text being what is left (null
    becomes empty)."""
    arrow_batches(docs.sparkSession)
    rows = docs.drop(*NEW, "rid", "runs").withColumn("rid", F.xxhash64("doc_id", "text"))
    found = distilled(docs.sparkSession, lambda: repeated_runs(rows.select("doc_id", "rid", "text"), length))
    per_text = found.groupBy(F.col("doc_id").alias("of"), F.col("rid").alias("id")).agg(F.collect_list(F.struct("s", "e")).alias("runs"))
    per_text = per_text.toDF("_of", "_id", "runs")
    joined = rows.join(per_text, (F.col("rid") == F.col("_id")) & F.col("doc_id").eqNullSafe(F.col("_of")), "left").drop("_of", "_id", "rid")
    others = [c for c in joined.columns if c not in ("text", "runs")]
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in others)
    return joined.mapInArrow(_remove(length), f"n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string, {kinds}")


def op6_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """The contract's columns, and text: what is left (a character that a cut splits goes as a whole from it, not from kept_sha256)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text")
