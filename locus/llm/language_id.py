"""Language identification of whole, possibly mixed-language texts.

Words are scored per language by hashed character trigrams; Unicode script ranges narrow a word's candidate languages; a Viterbi
pass with a switching penalty labels the words, so that spans of different languages come out. Training counts cover every
training row (no sample); they are summed per (language, bucket), which bounds the model by languages x 2^15 numbers.

Defined results: null text, empty text or text without letters -> `und`, score 0, no spans. Ties go to the language that sorts
first. Repeated rows and equal texts get equal results. Very long texts are labelled whole. Of more than MOST_LANGUAGES values of
lang (a dirty column) those with most training letters are learnt. Without training rows every text is `und`. An empty table gives
an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
#: First code points of script ranges and their scripts (0: Latin and all that is not told apart here). Fixed values (Unicode).
SCRIPT_STARTS = np.array([0, 0x370, 0x400, 0x530, 0x590, 0x600, 0x780, 0x900, 0xE00, 0xE80, 0x10A0, 0x1100, 0x1200, 0x1D00, 0x1F00, 0x2000, 0x3040, 0x3100, 0x3400, 0xA000, 0xAC00, 0xD7B0, 0xF900, 0xFB00, 0xFB1D, 0xFB50, 0xFE00, 0xFE70, 0xFF00, 0x20000], dtype=np.uint32)
SCRIPT_NAMES = np.array([0, 1, 2, 3, 4, 5, 0, 6, 7, 0, 8, 9, 0, 0, 1, 0, 10, 0, 11, 0, 9, 0, 11, 0, 4, 5, 0, 5, 0, 11], dtype=np.int64)
SCRIPTS = 12
#: Languages learnt at most, those with most training letters; the model and the score rows are dense in them.
MOST_LANGUAGES = 256
#: A script belongs to a language if at least this share of its training letters is in it.
SCRIPT_SHARE = 0.001
#: Words whose scores are held at once by a task (divided by the number of languages; a third where their places are held, too).
WORDS_HELD = 12_000_000
WORD = re.compile(r"[^\W\d_]+")


def holds_out(doc_id: Column, remainder: int) -> Column:
    """crc32 of doc_id as text, mod 5, equals `remainder`."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == remainder, F.lit(False))


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For non-empty words: the hashed trigrams around each letter, where each word's begin, and the words' scripts."""
    cp = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    with np.errstate(over="ignore"):
        h = cp[:-2] * np.uint32(0x9E3779B1) ^ (cp[1:-1] * np.uint32(0x85EBCA77) + np.uint32(0x27D4EB2F)) ^ (cp[2:] * np.uint32(0xC2B2AE3D) + np.uint32(0x165667B1))
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    letter = cp[1:-1] != 32
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    starts = np.cumsum(lengths) - lengths
    script = SCRIPT_NAMES[np.searchsorted(SCRIPT_STARTS, cp[1:-1][letter][starts], side="right") - 1]
    return (h[letter] >> np.uint32(32 - BUCKET_BITS)).astype(np.int64), starts, script


def count_languages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, n) of a partition: trigram buckets, then at BUCKETS + script the letters by script."""
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        words: dict[str, Counter] = {}
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
            words.setdefault(lang, Counter()).update(WORD.findall(text.lower()))
        for lang, counts in words.items():
            if counts:
                keys, n = list(counts), np.fromiter(counts.values(), dtype=np.float64, count=len(counts))
                grams, starts, script = trigrams(keys)
                lengths = np.diff(np.append(starts, len(grams)))
                total = totals.setdefault(lang, np.zeros(BUCKETS + SCRIPTS))
                total[:BUCKETS] += np.bincount(grams, weights=np.repeat(n, lengths), minlength=BUCKETS)
                total[BUCKETS:] += np.bincount(script, weights=n * lengths, minlength=SCRIPTS)
    for lang, total in totals.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(total[at].astype(np.int64))], names=["lang", "bucket", "n"])


def fit(training: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages in order, log-probabilities (BUCKETS x languages), allowed (SCRIPTS x languages), from columns text and lang."""
    arrow_batches(training.sparkSession)
    counts = training.where("text is not null and lang is not null").select("text", "lang").mapInArrow(count_languages, "lang string, bucket int, n long")
    # At most MOST_LANGUAGES x (BUCKETS + SCRIPTS) rows are collected.
    summed = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).persist()
    letters = summed.where(F.col("bucket") >= BUCKETS).groupBy("lang").agg(F.sum("n").alias("n"))
    languages = sorted(r[0] for r in letters.orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect())
    rows = summed.where(F.col("lang").isin(languages)).toArrow()
    summed.unpersist()
    table = np.zeros((BUCKETS + SCRIPTS, len(languages)))
    if languages:
        table[rows["bucket"].to_numpy(), np.searchsorted(np.array(languages, dtype=object), rows["lang"].to_numpy(zero_copy_only=False).astype(object))] = rows["n"].to_numpy()
    grams, scripts = table[:BUCKETS], table[BUCKETS:]
    logs = np.log((grams + 0.5) / (grams.sum(0) + 0.5 * BUCKETS)) if languages else grams
    return languages, logs.astype(np.float32), scripts >= np.maximum(SCRIPT_SHARE * scripts.sum(0), 1)


def word_scores(words: list[str], logs: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    """Per word and language the log posterior, at least -12; languages not written in the word's script get -30."""
    grams, starts, script = trigrams(words)
    s = np.add.reduceat(logs[grams], starts, axis=0)
    open_to = allowed[script]
    open_to |= ~open_to.any(1, keepdims=True)
    s = np.where(open_to, s, -np.inf)
    s -= s.max(1, keepdims=True)
    s -= np.log(np.exp(s).sum(1, keepdims=True))
    return np.where(open_to, np.maximum(s, -12), -30).astype(np.float32)


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """The best language of each word; all documents take a step together, longest documents first. Rows of `scores` are the
    documents' words one after another; a change of language costs `penalty`."""
    best = np.zeros(len(scores), dtype=np.int16)
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    starts, sorted_lengths = starts[order], lengths[order]
    steps = int(sorted_lengths[0]) if len(order) else 0
    if not steps:
        return best
    active = np.searchsorted(-sorted_lengths, -np.arange(1, steps + 1), side="right")  # documents with over t words
    origin = np.zeros(len(scores), dtype=np.int16)  # the best language of the word before
    moved = np.zeros(scores.shape, dtype=bool)
    v = scores[starts[: active[0]]].copy()
    for t in range(1, steps):
        m = active[t]
        v_m = v[:m]
        at = starts[:m] + t
        top = v_m.argmax(1)
        change = v_m[np.arange(m), top] - penalty
        go = change[:, None] > v_m
        origin[at] = top
        moved[at] = go
        v[:m] = np.where(go, change[:, None], v_m) + scores[at]
    now = v.argmax(1)
    for t in range(steps - 1, -1, -1):
        m = active[t]
        at = starts[:m] + t
        best[at] = now[:m]
        now[:m] = np.where(moved[at, now[:m]], origin[at], now[:m])
    return best


def _predictor(model, penalty: float, with_spans: bool, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, logs, allowed = model.value
        rows_of: dict[str, int] = {}
        held: list[tuple] = []
        room = max(1, WORDS_HELD // (3 if with_spans else 1) // max(1, len(languages)))
        table = np.zeros((0, len(languages)), np.float32)
        n_held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, n_held
            lengths = np.concatenate([x[1] for x in held])
            letters = np.concatenate([x[2] for x in held])
            best = viterbi(np.concatenate([x[0] for x in held]), lengths, penalty)
            docs = np.repeat(np.arange(len(lengths)), lengths)
            share = np.bincount(docs * len(languages) + best, weights=letters, minlength=len(lengths) * len(languages)).reshape(len(lengths), -1)
            total = share.sum(1)
            top = share.argmax(1)
            score = share[np.arange(len(top)), top] / np.maximum(total, 1)
            pred = np.array(languages, dtype=object)[top]
            pred[total == 0] = "und"
            ids = pa.concat_arrays([x[3] for x in held])
            spans = []
            if with_spans:
                ends = np.cumsum(lengths)
                places = [p for x in held for p in x[4]]
                for d, (hi, n) in enumerate(zip(ends.tolist(), lengths.tolist(), strict=True)):
                    own, at = best[hi - n : hi], places[d]
                    cuts = group_cuts(own)
                    spans.append([{"begin": at[a][0], "end": at[b - 1][1], "lang": languages[own[a]]} for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
            else:
                spans = [None] * len(top)
            kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
            yield pa.RecordBatch.from_arrays([ids, pa.array(pred, pa.string()), pa.array(np.where(total > 0, score, 0.0)), pa.array(spans, kind), *[pa.concat_arrays([x[5][k] for x in held]) for k in range(len(keep))]], names=["doc_id", "lang_pred", "score", "spans", *keep])
            held, n_held = [], 0

        for batch in batches:
            texts = batch.column("text").to_pylist()
            if not languages:
                n = len(texts)
                kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(["und"] * n, pa.string()), pa.array(np.zeros(n)), pa.array([[] if with_spans else None] * n, kind), *[batch.column(c) for c in keep]], names=["doc_id", "lang_pred", "score", "spans", *keep])
                continue
            places = []
            if with_spans:
                places = [[m.span() for m in WORD.finditer(t or "")] for t in texts]
                found = [[t[a:b].lower() for a, b in p] for t, p in zip(texts, places, strict=True)]
            else:
                found = [WORD.findall(t.lower()) if t else [] for t in texts]
            lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            if len(rows_of) > 300_000:
                rows_of, table = {}, table[:0]
            fresh = list({w for words in found for w in words if w not in rows_of})
            if fresh:
                rows_of.update(zip(fresh, range(len(rows_of), len(rows_of) + len(fresh)), strict=True))
                table = np.concatenate([table, word_scores(fresh, logs, allowed)])
            get = rows_of.__getitem__
            at = np.fromiter((get(w) for words in found for w in words), dtype=np.int64, count=int(lengths.sum()))
            letters = np.fromiter((len(w) for words in found for w in words), dtype=np.int64, count=len(at))
            held.append((table[at], lengths, letters, batch.column("doc_id"), places, [batch.column(c) for c in keep]))
            n_held += len(at)
            if n_held > room:
                yield from flush()
        if held:
            yield from flush()

    return run


def group_cuts(labels: np.ndarray) -> list[int]:
    """Bounds of runs of equal labels."""
    return [0, *(np.flatnonzero(labels[1:] != labels[:-1]) + 1).tolist(), len(labels)] if len(labels) else []


def identify(docs: DataFrame, training: DataFrame, penalty: float = 6.0, with_spans: bool = True, keep: list[str] | None = None) -> DataFrame:
    """(doc_id, lang_pred, score, spans) of every row of docs (doc_id, text), learnt from training (text, lang); columns of docs
    named in `keep` follow.

    score is the share of the text's letters in words labelled lang_pred; spans are (begin, end, lang) in code points, end
    excluded. Prediction is a narrow map over the scan; the model is broadcast at its proven bound.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(fit(training))
    arrow_batches(spark)
    keep = keep or []
    kinds = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = docs.select(*dict.fromkeys(["doc_id", "text", *keep]))
    return columns.mapInArrow(_predictor(model, penalty, with_spans, keep), f"doc_id {kind}, lang_pred string, score double, spans array<struct<begin int, end int, lang string>>{kinds}")


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = identify(docs, docs.where(~holds_out(F.col("doc_id"), 0)))
    return out.select("doc_id", holds_out(F.col("doc_id"), 0).alias("held_out"), "lang_pred", "score", "spans")
