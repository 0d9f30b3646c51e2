"""Toxicity by a classifier chain: categories are predicted one after another, and each category's logistic model also sees the
probabilities of the categories before it. In training those come from out-of-fold predictions, so that later models learn from
probabilities as unsure as the ones they will get.

Features are words and word beginnings of 4 to 6 letters (stems, whatever the language's endings), chosen by their log-odds for
each category; for out-of-fold predictions they are chosen without the fold that is predicted, too. Models are fitted on a bounded sample of labelled documents (`most_rows`, those with the smallest hash of their id);
all documents are scored.

Defined results: null text or text without letters scores as no feature at all. Labelled rows whose label is null are left out of
that category. Without labels, or with one class only, a category's probability is its share of ones (0 without labels). Repeated
rows and equal texts get equal probabilities. Very long texts are read whole. Ties among features go to the one that sorts first.
An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches

#: Labelled documents that models are fitted on, at most.
MOST_ROWS = 6000
#: Features chosen per category.
FEATURES = 300
FOLDS = 5
WORD = re.compile(r"[^\W\d_]+")


def stems(word: str) -> list[str]:
    return [f"{word}$", *(word[:n] for n in (4, 5, 6) if len(word) >= n)]


def document_counts(categories: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(feature, fold, docs, ones): documents with a feature, and of them those labelled one by category; summed by partition."""
        docs = [Counter() for _ in range(FOLDS)]
        ones = [[Counter() for _ in categories] for _ in range(FOLDS)]
        for batch in batches:
            labels = [batch.column(c).to_pylist() for c in categories]
            folds = batch.column("fold").to_pylist()
            for i, text in enumerate(batch.column("text").to_pylist()):
                found = {s for w in set(WORD.findall((text or "").lower())) for s in stems(w)}
                docs[folds[i]].update(found)
                for of, label in zip(ones[folds[i]], labels, strict=True):
                    if label[i]:
                        of.update(found)
        for fold in range(FOLDS):
            names = list(docs[fold])
            for a in range(0, len(names), 50_000):
                part = names[a : a + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([fold] * len(part), pa.int32()), pa.array([docs[fold][x] for x in part], pa.int64()), *[pa.array([of[x] for x in part], pa.int64()) for of in ones[fold]]], names=["feature", "fold", "docs", *[f"ones{k}" for k in range(len(categories))]])

    return run


def feature_rows(texts: list[str | None], place: dict[str, int]) -> np.ndarray:
    """log(1 + count) of each feature, one row per text, and a last column of ones."""
    out = np.zeros((len(texts), len(place) + 1), np.float32)
    known: dict[str, list[int]] = {}
    for i, text in enumerate(texts):
        row = out[i]
        for word in WORD.findall((text or "").lower()):
            at = known.get(word)
            if at is None:
                at = known[word] = [place[s] for s in stems(word) if s in place]
            for k in at:
                row[k] += 1
    np.log1p(out, out=out)
    out[:, -1] = 1
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 25, ridge: float = 1.0) -> np.ndarray:
    """Weights by Newton's method; the last feature is the constant and is hardly held back."""
    if not len(y) or y.min() == y.max():
        w = np.zeros(x.shape[1])
        share = float(y.mean()) if len(y) else 0.0
        w[-1] = 30.0 if share == 1 else -30.0
        return w
    # Features in units of their own spread: a rare word's weight is then no more held back than a common one's.
    spread = x.std(0)
    spread[spread < 1e-9] = 1
    x = x / spread
    hold = np.full(x.shape[1], ridge)
    hold[-1] = 1e-6

    def loss(w: np.ndarray) -> float:
        m = x @ w
        return float((np.logaddexp(0, m) - y * m).sum() + 0.5 * (hold * w * w).sum())

    w, now = np.zeros(x.shape[1]), len(y) * np.log(2)
    for _ in range(steps):
        p = sigmoid(x @ w)
        gradient = x.T @ (y - p) - hold * w
        move = np.linalg.solve((x.T * np.maximum(p * (1 - p), 1e-6)) @ x + np.diag(hold), gradient)
        while (then := loss(w + move)) > now and np.abs(move).max() > 1e-9:
            move /= 2
        w, gain, now = w + move, now - then, then
        if gain < 1e-6 * max(1.0, now):
            break
    return w / spread


def fit_chain(x: np.ndarray, labels: list[np.ndarray], folds: np.ndarray, columns: list[np.ndarray]) -> list[np.ndarray]:
    """Weights of each category's model: earlier categories' probabilities stand before the features. NaN labels are left out.
    columns: those of x that a model may see if it is to predict a fold, by fold, and at last those of the final models."""
    models, before = [], np.zeros((len(x), 0))
    for k, y in enumerate(labels):
        ok = ~np.isnan(y)
        models.append(logistic(np.concatenate([before, x[:, columns[FOLDS]]], axis=1)[ok], y[ok]))
        if k + 1 < len(labels):
            unseen = np.zeros(len(x))
            for fold in range(FOLDS):
                part = folds == fold
                if part.any():
                    full = np.concatenate([before, x[:, columns[fold]]], axis=1)
                    unseen[part] = full[part] @ logistic(full[ok & ~part], y[ok & ~part])
            before = np.concatenate([before, sigmoid(unseen)[:, None]], axis=1)
    return models


def apply_chain(x: np.ndarray, models: list[np.ndarray]) -> np.ndarray:
    """Probabilities, one column per category."""
    out = np.zeros((len(x), 0))
    for w in models:
        out = np.concatenate([out, sigmoid(np.concatenate([out, x], axis=1) @ w)[:, None]], axis=1)
    return out


def _score(state):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, models = state.value
        for batch in batches:
            p = apply_chain(feature_rows(batch.column("text").to_pylist(), place), models)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(p[:, k]) for k in range(p.shape[1])]], names=["doc_id", *[f"p{k}" for k in range(p.shape[1])]])

    return run


def toxicity(docs: DataFrame, labels: DataFrame, categories: list[str], most_rows: int = MOST_ROWS, seed: int = 3) -> DataFrame:
    """(doc_id, p_<category>...) of each row of docs (doc_id, text), learnt from labels (doc_id, <category> 0/1 ...).

    Collected, by bound: the sampled ids and labels, FEATURES names per category, and the sample's feature counts.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    names = [f"y{k}" for k in range(len(categories))]
    labelled = labels.where("doc_id is not null").groupBy("doc_id").agg(*[F.max(F.col(c).cast("double")).alias(n) for c, n in zip(categories, names, strict=True)])
    sample = labelled.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(most_rows)
    sample = spark.createDataFrame(sample.toArrow()) if sample.limit(1).count() else sample  # at most most_rows short rows
    fold = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(FOLDS)).cast("int")
    texts = docs.select("doc_id", "text").join(F.broadcast(sample.withColumn("fold", fold)), "doc_id")
    ones = ", ".join(f"ones{k} long" for k in range(len(categories)))
    counted = texts.select("text", "fold", *names).mapInArrow(document_counts(names), f"feature string, fold int, docs long, {ones}")
    counts = ["docs", *[f"ones{k}" for k in range(len(categories))]]
    without = [F.sum(F.when(F.col("fold") != f, F.col(c)).otherwise(0)).alias(f"{c}_{f}") for c in counts for f in range(FOLDS)]
    summed = counted.groupBy("feature").agg(*[F.sum(c).alias(f"{c}_{FOLDS}") for c in counts], *without).where(f"docs_{FOLDS} >= 4").persist()
    totals = texts.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(n), F.lit(0.0)).alias(n) for n in names]).collect()
    chosen: list[set[str]] = []
    for f in range(FOLDS + 1):
        # Without fold f; at last with all. Features that speak for the rarer label (what speaks for the other is everywhere and says
        # little), by log-odds shrunk as if one more document of the other label had each: documents that all are of one label
        # count by their number.
        known = [r for r in totals if r["fold"] != f]
        chosen.append(set())
        for k, n in enumerate(names):
            a, b = F.col(f"ones{k}_{f}"), F.col(f"docs_{f}") - F.col(f"ones{k}_{f}")
            rare, other = (a, b) if sum(r[n] for r in known) * 2 <= sum(r["n"] for r in known) else (b, a)
            odds = F.log((rare + 0.1) / (other + 1.0))
            chosen[f].update(r[0] for r in summed.where(rare >= 4).orderBy(odds.desc(), "feature").limit(FEATURES).select("feature").collect())
    summed.unpersist()
    place = {x: i for i, x in enumerate(sorted(set().union(*chosen)))}
    # One row per sampled document, of features that occur: at most most_rows x FEATURES x categories x (FOLDS + 1) numbers.
    shared = spark.sparkContext.broadcast(place)

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = feature_rows(batch.column("text").to_pylist(), shared.value)
            at = [np.flatnonzero(r).astype(np.int32) for r in x]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("fold"), *[batch.column(n) for n in names], pa.array(at, pa.list_(pa.int32())), pa.array([r[i] for r, i in zip(x, at, strict=True)], pa.list_(pa.float32()))], names=["doc_id", "fold", *names, "at", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = sorted(texts.select("doc_id", "fold", *names, "text").mapInArrow(sparse, f"doc_id {kind}, fold int, {', '.join(n + ' double' for n in names)}, at array<int>, x array<float>").toArrow().to_pylist(), key=lambda r: r["doc_id"])
    x = np.zeros((len(rows), len(place) + 1), np.float32)
    for i, r in enumerate(rows):
        x[i, r["at"]] = r["x"]
    y = [np.array([np.nan if r[n] is None else r[n] for r in rows], dtype=np.float64) for n in names]
    columns = [np.array([*(place[c] for c in sorted(own)), len(place)]) for own in chosen]
    models = fit_chain(x.astype(np.float64), y, np.array([r["fold"] for r in rows], dtype=np.int64), columns)
    state = spark.sparkContext.broadcast(({c: i for i, c in enumerate(sorted(chosen[FOLDS]))}, models))
    scored = docs.select("doc_id", "text").mapInArrow(_score(state), f"doc_id {kind}, {', '.join(f'p{k} double' for k in range(len(names)))}")
    return scored.toDF("doc_id", *[f"p_{c}" for c in categories])


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity(docs, labels, ["quality", "toxic"])
    return scored.select("doc_id", (F.col("p_toxic") >= 0.5).alias("toxic"), F.col("p_toxic").alias("score"), "p_toxic", "p_quality")
