"""The pipeline's stages on the operators' fixture."""

import random
import shutil
from collections import Counter

import corpus_pipeline
import numpy as np
import pyarrow as pa
from locus.llm import common, mixing, similar
from tests.llm.test_operators import CLASHES, ROWS, SCHEMA

from pyspark.sql import functions as F


def test_stages(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    docs.select("*", *[F.lit(1).alias(c) for c in CLASHES]).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    steps = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if i + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == columns
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        steps[name] = docs.collect()
    first = Counter(r.doc_id for r in steps["language_id"])
    assert first[104] == first[105] == first[106] == first[107] == 0 and first[109] == 3 and first[111] == 1 and first[None] == 1
    second = Counter(r.doc_id for r in steps["near_dedup"])
    assert max(second.values()) == 1 and second[3] == 1 and second[109] == 0 and second[None] == 1
    assert sum(second[i] for i in range(96, 104)) < 8 and second[96] == 1
    third = {r.doc_id: r for r in steps["repeated_passages"]}
    assert all(r.n_chars == len(r.text) for r in third.values())
    assert all(len(third[i].text) < len(dict((x[0], x[1]) for x in ROWS)[i]) for i in range(90, 96))
    ids = Counter(r.doc_id for r in steps["mixing"])
    assert Counter(r.doc_id for r in steps["encoding"]) == ids
    assert len(steps["encoding"]) == sum(ids.values())


def test_empty(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_dedup_links_pairs_of_similarity_four_fifths(spark):
    """Copies of a text with words changed, at 0.8 or more and below, against brute force: no other pair is linked, and nearly all of
    these are (the candidate search is a random one); a passage in many texts links none."""
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(30))
    rows = []
    for i in range(40):
        base = [f"w{i}x{j}" for j in range(100 + i)]
        rows.append(" ".join(base) + " " + passage)
        for edits in (1, 2, 3, 4, 5, 7):
            copy = list(base)
            for at in rng.sample(range(len(base)), edits):
                copy[at] = f"e{rng.random()}"
            rows.append(" ".join(copy) + " " + passage)
    sets = [{tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for t in rows]
    least = list(range(len(rows)))
    pairs = [(a, b) for b in range(len(rows)) for a in range(b) if len(sets[a] & sets[b]) * 5 >= len(sets[a] | sets[b]) * 4]
    for _ in rows:
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(rows)], SCHEMA)
    kept = sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect())
    assert pairs and set(least) <= set(kept) and 40 < len(kept) <= 1.05 * len(set(least))
    small = [i for i, t in enumerate(rows) if least[i] in (0, 7, 8, 14)]
    docs = docs.where(F.col("doc_id").isin(small)).withColumn("doc_id", F.lit(None).cast("long"))
    assert corpus_pipeline.near_dedup(spark, docs, "").count() >= len({least[i] for i in small})
    far = spark.createDataFrame([(None, rows[0], "en", "s", 0), (None, rows[1], "en", "s", 0), (None, "alone", "en", "s", 0)], SCHEMA)
    assert corpus_pipeline.near_dedup(spark, far, "").count() == 2


def test_language_id_keeps_texts_with_letters_when_no_language_is_known(spark):
    docs = spark.createDataFrame([(1, "some words", None, "s", 10), (2, "日本語", None, "s", 3), (3, "12 34", None, "s", 5), (4, None, "en", "s", 0)], SCHEMA)
    assert sorted((r.doc_id, r.lang) for r in corpus_pipeline.language_id(spark, docs, "").collect()) == [(1, "und"), (2, "und")]


def test_near_dedup_of_large_clusters(spark, monkeypatch):
    """Clusters cut into blocks give the same groups; null and repeated ids with several texts keep one row a group."""
    rng = random.Random(8)
    base = [f"w{j}" for j in range(300)]
    rows = []
    for i in range(60):
        copy = list(base)
        for at in rng.sample(range(300), 2):
            copy[at] = f"e{i}x{at}"
        rows.append((i // 2 if i % 5 else None, " ".join(copy), ["en", "fr"][i % 2], f"s{i % 3}", i))
    rows += [(7, f"another text of its own {i}", "en", "s0", 1) for i in range(3)] + [(None, "nameless", "en", "s1", 1), (None, "nameless", "fr", None, 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for most in (2000, 7):
        monkeypatch.setattr(similar, "MOST_SETS", most)
        monkeypatch.setattr(similar, "MOST_ROWS", 10 * most)
        out = corpus_pipeline.near_dedup(spark, docs, "").collect()
        assert sorted((r.doc_id is None, r.doc_id or 0) for r in out) == [(False, 0), (False, 7), (False, 7), (False, 7), (True, 0)]
        assert [(r.lang, r.source) for r in out if r.doc_id is None] == [("en", "s1")]


def test_mixing_takes_every_row_once(spark):
    """Rows out are the copies taken, with null ids in several sources, one id with two texts and many equal rows."""
    rng = random.Random(3)
    rows = []
    for i in range(400):
        rows.append((i if i % 10 else None, " ".join("w" for _ in range(rng.randint(1, 26))) + f" {i}", "en", f"s{i % 4}", i))
    rows += [(5, "other text", "en", "s1", 0)] * 3 + [(None, "same words here", "en", None, 0)] * 50 + [(None, None, None, "s2", None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    size = {r: len((r[1] or "").split()) for r in rows}
    out = Counter(tuple(r) for r in corpus_pipeline.mixing(spark, docs, "").collect())
    assert set(out) <= set(rows)
    plain = mixing.mix_documents(docs).collect()
    target = {}
    for r in plain:
        target.setdefault((r.source_size, r.target), 0)
    assert all(n <= 3 * rows.count(r) for r, n in out.items())
    taken, whole = Counter(), Counter()
    for r, n in out.items():
        taken[r[3]] += n * size[r]
    for r in rows:
        whole[r[3]] += size[r]
    targets = {size: t for size, t in target}
    for source, n in taken.items():
        assert abs(n - targets[whole[source]]) <= 28 / 2
    for col in ("taken", "copies"):
        assert all(getattr(r, col) >= 0 for r in plain)
    assert len(plain) == len(rows)


def test_repeated_passages_of_fifty_words(spark):
    """Passages of over fifty words go though they are shorter than op6's strings; texts of their own stay whole."""
    rng = random.Random(4)
    own = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))
    passage = own(56)
    assert 256 <= len(passage) < 400
    rows = [(i, f"{own(30)} {passage} {own(25)}" if i < 6 else own(80), "en", "s", 0) for i in range(12)]
    out = {r.doc_id: r.text for r in corpus_pipeline.repeated_passages(spark, spark.createDataFrame(rows, SCHEMA), "").collect()}
    for i, text, *_ in rows:
        assert (len(out[i]) <= len(text) - len(passage)) if i < 6 else out[i] == text


def test_unrelated_texts_of_one_key_are_no_candidates():
    """A key's group of a large corpus: chains of unrelated texts would make it one cluster. Pairs at similarity 0.8 stay linked."""
    rng = np.random.default_rng(3)
    fp = rng.integers(0, 1 << 63, (2_000, 2), dtype=np.uint64)
    fp[:, 0] &= ~np.uint64(0x1FF)  # eighteen bits in common
    fp[:, 1] &= ~np.uint64(0x1FF)
    flips = np.array([sum(1 << int(b) for b in 10 + rng.choice(54, 10, replace=False)) for _ in range(400)], np.uint64).reshape(200, 2)
    fp[:200] = fp[200:400] ^ flips  # twenty bits of each first 200 differ from the row 200 on
    n = len(fp)
    zero = pa.array(np.zeros(n, np.int64))
    table = pa.table({"key": zero, "block_lo": zero, "block_hi": zero, "item": pa.array(np.arange(n)), "fp": pa.array(fp[:, 0].view(np.int64)), "fp2": pa.array(fp[:, 1].view(np.int64))})
    found = [(r["a"], r["b"]) for batch in similar._candidates(table) for r in batch.to_pylist()]
    root = common.forest(*(np.append(x, n - 1) for x in zip(*found, strict=True)))
    assert (root[:200] == root[200:400]).all() and len(found) < 260


def test_stages_leave_one_table(spark, tmp_path, monkeypatch):
    """A stage's tables are gone once its result depends on one of them only."""
    monkeypatch.setattr(common, "shared_dir", lambda _: str(tmp_path))
    text = "ein langer Absatz, der in zwei Texten steht und sich wiederholt " * 6
    docs = spark.createDataFrame([(i, f"{' '.join(f'w{i}x{j}' for j in range(60))} {text}", "de", "a", 1) for i in range(8)], SCHEMA)
    for stage in (corpus_pipeline.near_dedup, corpus_pipeline.repeated_passages):
        out = stage(spark, docs, "")
        assert len(list((tmp_path / "tables").iterdir())) == 1
        assert out.count() == 8
        shutil.rmtree(tmp_path / "tables")
