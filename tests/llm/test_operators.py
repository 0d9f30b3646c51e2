"""Each operator against brute force on a small fixture with nulls, empty and long texts, copies, repeated rows and clashing columns."""

import hashlib
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from locus.llm import bpe, embedding_dedup, fingerprint, language_id, lm_scoring, mixing, sharding, simhash, suffix_dedup, toxicity

SYLLABLES = {"en": ["the", "er", "ing", "tion", "an", "ou"], "fr": ["é", "que", "eau", "ment", "le", "aux"], "ru": ["ст", "но", "ра", "пре", "ов", "ать"]}


def words(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def make_rows():
    rng = random.Random(1)
    rows = []
    for i in range(90):
        lang = ["en", "fr", "ru"][i % 3]
        rows.append((i, words(rng, lang, rng.randint(30, 150)), lang, f"s{i % 4}", 0))
    passage = words(rng, "en", 120)
    for i in range(90, 96):
        rows.append((i, words(rng, "en", 20 + i) + " " + passage + " " + words(rng, "fr", 15), "en", "s0", 0))
    base = words(rng, "en", 200).split()
    for i in range(96, 104):  # near copies
        copy = list(base)
        copy[rng.randrange(200)] = "changed"
        rows.append((i, " ".join(copy), "en", "s1", 0))
    rows += [(104, None, "en", "s1", None), (105, "", None, None, 0), (106, " \t\n", "fr", "s2", 3), (107, "123 456", None, "s2", 7), (108, "a" * 3000, "en", "s3", 0)]
    rows += [(109, rows[3][1], "en", "s1", 0)] * 3  # repeated rows and a copy
    rows += [(110, words(rng, "ru", 6000), "ru", "s3", 0), (111, "日本語 テキスト ½²", "en", "s3", 0), (112, "Mixed " + words(rng, "en", 40) + " " + words(rng, "ru", 40), "en", "s0", 0), (None, "no id here at all", None, "s0", 1)]
    return rows


ROWS = make_rows()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ["h", "n", "key", "bucket", "fp", "size", "rid", "runs", "rate", "score", "spans", "component_id", "fraction", "shard", "y0", "line"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.select("*", *[F.lit(1).alias(c) for c in CLASHES]).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def tokens(text):
    return (text or "").encode().lower().split()


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_language_id(docs, empty):
    out = language_id.identify(docs, docs).collect()
    assert len(out) == len(ROWS)
    by = defaultdict(list)
    for r in out:
        by[r.doc_id].append(r)
    assert all(by[i][0].lang_pred == ["en", "fr", "ru"][i % 3] for i in range(90))
    for i in (104, 105, 106, 107):
        assert (by[i][0].lang_pred, by[i][0].score, by[i][0].spans) == ("und", 0.0, [])
    assert {s.lang for s in by[112][0].spans} >= {"en", "ru"}
    text = dict((r[0], r[1]) for r in ROWS)[112]
    for s in by[112][0].spans:
        assert 0 <= s.begin < s.end <= len(text)
    assert all(0 <= r.score <= 1 for r in out)
    assert language_id.identify(empty, docs).count() == 0
    assert {r.lang_pred for r in language_id.identify(docs, empty).collect()} == {"und"}


def test_viterbi_is_best():
    rng = np.random.default_rng(0)
    for _ in range(20):
        n = int(rng.integers(1, 7))
        s = rng.normal(size=(n, 3)).astype(np.float32)
        got = language_id.viterbi(s, np.array([n]), 0.7)

        def value(path):
            return sum(s[i, p] for i, p in enumerate(path)) - 0.7 * sum(a != b for a, b in zip(path, path[1:], strict=False))

        best = max(value(p) for p in np.ndindex(*[3] * n))
        assert abs(value(tuple(got)) - best) < 1e-5


def test_mixing(docs, empty):
    out = mixing.mix_documents(docs).toPandas()
    assert len(out) == len(ROWS)
    text = {r[0]: r[1] for r in ROWS}
    for r in out.itertuples():
        assert r.size == len(tokens(text[None if r.doc_id != r.doc_id else int(r.doc_id)]))
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
    # Targets by the rule, exactly.
    source = [r[3] for r in ROWS]
    size = Counter()
    for r in ROWS:
        size[r[3]] += len(tokens(r[1]))
    order = sorted(x for x in size if x is not None) + [None] * (None in size)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), Fraction(sum(size.values()))
    while free:
        unit = left / sum(weight[s] for s in free)
        over = [s for s in free if unit * weight[s] > 3 * size[s]]
        for s in over or list(free):
            target[s] = Fraction(3 * size[s]) if over else unit * weight[s]
            left -= target[s]
            free.discard(s)
    longest, taken = Counter(), Counter()
    assert set(source) == set(order)
    by_id = {r[0]: r for r in ROWS}
    for r in out.itertuples():
        s = by_id[None if r.doc_id != r.doc_id else int(r.doc_id)][3]
        assert abs(r.target - float(target[s])) < 1e-6 and r.source_size == size[s]
        longest[s] = max(longest[s], r.size)
        taken[s] += r.taken
    for s in order:
        assert abs(taken[s] - float(target[s])) <= longest[s]
    again = mixing.mix_documents(docs.repartition(5)).toPandas()
    assert sorted(map(tuple, out[["size", "taken"]].values)) == sorted(map(tuple, again[["size", "taken"]].values))
    assert mixing.mix_documents(empty).count() == 0


def test_balance_meets_overlapping_targets(spark):
    """Sources and languages at once: both margins are met, and rates are a product of one factor a group (the tilted solution)."""
    rng = random.Random(6)
    rows = [(i, f"s{rng.randrange(3)}" if i % 50 else None, ["en", "fr"][rng.random() < 0.3], rng.randint(1, 60)) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, source string, lang string, size long").withColumns({"n": F.lit(1).cast("long"), "k": F.md5(F.col("id").cast("string").cast("binary"))})
    total = sum(r[3] for r in rows)
    words = Counter()
    for _, s, x, n in rows:
        words["s", s] += n
        words["l", x] += n
    shares = {"s0": 0.5, "s1": 0.2, "s2": 0.27, None: 0.03}
    sources = spark.createDataFrame([(s, w * total) for s, w in shares.items()], "source string, target double")
    languages = spark.createDataFrame([("en", 0.5 * total), ("fr", 0.5 * total)], "lang string, target double")
    lam = mixing.balance(df, {"source": sources, "lang": languages})
    factor = {("s", r.source): np.exp(r.lam) for r in lam["source"].collect()} | {("l", r.lang): np.exp(r.lam) for r in lam["lang"].collect()}
    got = Counter()
    for _, s, x, n in rows:
        rate = factor["s", s] * factor["l", x]
        got["s", s] += n * rate
        got["l", x] += n * rate
    assert all(abs(got["s", s] / total - w) < 1e-9 for s, w in shares.items()) and abs(got["l", "fr"] / total - 0.5) < 1e-9
    out = mixing.by_targets(df, {"source": sources, "lang": languages}, most=9.0).collect()
    taken = Counter()
    for r in out:
        copies = r.whole + (r.extra > 0)
        assert copies <= np.ceil(r.rate)
        taken["s", rows[r.id][1]] += copies * r.size
        taken["l", rows[r.id][2]] += copies * r.size
    assert len(out) == len(rows) and all(abs(taken["s", s] - w * total) <= 60 for s, w in shares.items()) and abs(taken["l", "en"] - 0.5 * total) <= 4 * 30


def test_fingerprints(docs, empty):
    out = fingerprint.fingerprints(docs).collect()
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    got = sorted(out, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.n_chars))
    assert len(got) == len(order)
    prints = {}
    for i, (row, r) in enumerate(zip(order, got, strict=True)):
        text, after = row[1] or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert (r.doc_id, r.n_chars) == (row[0], len(text))
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        a, b = (np.frombuffer(bytes.fromhex(x), np.uint16) for x in (r.fingerprint, r.edited_fingerprint))
        assert abs(r.near_edited - (a == b).mean()) < 1e-12
    plain = [r for r in got if r.n_chars > 100 and r.doc_id is not None and r.doc_id < 90]
    assert np.mean([r.near_edited > r.near_next for r in plain]) > 0.95
    assert fingerprint.fingerprints(empty).count() == 0


def test_order_min_hash_by_definition():
    rng = random.Random(3)
    text = words(rng, "en", 800)
    cp = fingerprint.code_points(text)
    with np.errstate(over="ignore"):
        h, position = fingerprint.elements(cp)
        seen, number = Counter(), {}
        for i in range(len(text) - fingerprint.K + 1):
            gram = text[i : i + fingerprint.K]
            number[i] = (gram, seen[gram])
            seen[gram] += 1
        by_element = {number[p]: int(x) for x, p in zip(h.tolist(), position.tolist(), strict=True)}
        assert len(by_element) == len(h)
        at = {int(p): np.uint32(x) for x, p in zip(h, position, strict=True)}
        got = fingerprint.signature(cp)
        for m in range(fingerprint.M):
            least = sorted(at, key=lambda p: (int((at[p] ^ fingerprint.MASKS[m]) * fingerprint.MULTIPLIERS[m]), p))[: fingerprint.L]
            part = np.full(1, 0x811C9DC5, np.uint32) ^ fingerprint.MASKS[m]
            for p in sorted(least):
                part = fingerprint._mix(part * np.uint32(0x01000193) + at[p])
            assert int(part[0] >> 16) == int(got[m])


def test_lm_scoring(docs, empty):
    train = F.coalesce(F.col("doc_id") % 5 != 1, F.lit(True))
    out = lm_scoring.score_texts(docs.withColumn("training", train)).collect()
    counts, n_train = Counter(), 0
    for r in ROWS:
        if r[0] is None or r[0] % 5 != 1:
            counts.update(tokens(r[1]))
            n_train += 1
    n, v = sum(counts.values()) + n_train, len(counts) + 1
    text = {r[0]: r[1] for r in ROWS}
    assert len(out) == len(ROWS)
    for r in out:
        t = tokens(text[r.doc_id])
        base = sum(np.log10(counts[w] + 0.5) for w in t) + np.log10(n_train + 0.5) - (len(t) + 1) * np.log10(n + 0.5 * (v + 1))
        assert r.n_tokens == len(t) + 1 and r.train_tokens == n
        assert r.n_known == sum(counts[w] > 0 for w in t) + 1
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base))
    texts = sorted(((r[1] or "", r[0] is None or r[0] % 5 != 1) for r in ROWS))
    data, offsets = lm_scoring.text_buffer(pa.array([x for x, _ in texts]))
    training = np.array([x for _, x in texts])
    key, n = lm_scoring.key_counts(data, offsets, training)
    total = np.zeros((256, 3, 255))
    near, sums = lm_scoring.upward(key, n)
    total[near] = sums
    want = lm_scoring.text_scores(data, offsets, key, lm_scoring.downward(key, n, lm_scoring.crown(total)))
    want = dict(zip((x for x, _ in texts), want, strict=True))
    assert all(abs(r.score - want[text[r.doc_id] or ""]) < 1e-6 * abs(r.score) for r in out)
    assert lm_scoring.score_texts(empty.withColumn("training", F.lit(True))).count() == 0
    none = lm_scoring.score_texts(docs.withColumn("training", F.lit(False))).collect()
    assert all(abs(r.score + ((len((text[r.doc_id] or "").encode()) + 1) * np.log10(256))) < 1e-6 * abs(r.score) for r in none)
    assert all(r.train_tokens == 0 and r.n_known == 0 for r in none)


def test_context_tree_sums_to_one_and_equals_recursion():
    """The frozen model's probability of a byte against the plain recursion over nodes."""
    import math

    import pyarrow as pa

    data = pa.array(["abracadabra", "abra cadabra", "banana ☃é"])
    d, o = lm_scoring.text_buffer(data)
    k, n = lm_scoring.key_counts(d, o, np.ones(3, bool))
    whole = np.unique(np.repeat((k >> 8) << 8, 256) + np.tile(np.arange(256), len(k)))  # every byte after every context
    text = b"abracab"
    d2, o2 = lm_scoring.text_buffer(pa.array([text.decode()]))
    whole = np.union1d(whole, lm_scoring.key_counts(d2, o2, np.zeros(1, bool))[0])
    times = np.zeros(len(whole), np.int64)
    times[np.searchsorted(whole, k)] = n
    total = np.zeros((256, 3, 255))
    near, sums = lm_scoring.upward(whole, times)
    total[near] = sums
    logs = lm_scoring.downward(whole, times, lm_scoring.crown(total))
    slots, at = np.unique(whole >> 8, return_inverse=True)
    full = np.bincount(at) == 256
    assert full.sum() == len(np.unique(k >> 8)) and np.allclose(np.bincount(at, weights=10.0**logs)[full], 1)
    depth = lm_scoring.DEPTH
    nodes = defaultdict(lambda: [0, 0])
    for t in data.to_pylist():
        s = b"\0" * depth + t.encode() + b"\0"
        for i in range(depth, len(s)):
            bits = f"{s[i]:08b}"
            for level in range(depth + 1):
                for j in range(8):
                    nodes[level, s[i - level : i], bits[:j]][int(bits[j])] += 1

    def pe(a, b):
        return math.exp(math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1)) / math.pi

    def pw(level, ctx, prefix):
        a, b = nodes[level, ctx, prefix]
        if level == depth:
            return pe(a, b)
        below = 1.0
        for c in {k2[1][0] for k2 in list(nodes) if k2[0] == level + 1 and k2[1][1:] == ctx and k2[2] == prefix and sum(nodes[k2])}:
            below *= pw(level + 1, bytes([c]) + ctx, prefix)
        return 0.5 * pe(a, b) + 0.5 * below

    def one(full, prefix, level=0):
        ctx = full[depth - level :]
        a, b = nodes[level, ctx, prefix]
        kt = (b + 0.5) / (a + b + 1)
        if level == depth or not any(sum(nodes.get((d2, full[depth - d2 :], p), [0, 0])) for d2, p in [(level + 1, "")]):
            return kt
        w = 0.5 * pe(a, b) / pw(level, ctx, prefix)
        return w * kt + (1 - w) * one(full, prefix, level + 1)

    want, s = 0.0, b"\0" * depth + text + b"\0"
    for i in range(depth, len(s)):
        bits = f"{s[i]:08b}"
        for j in range(8):
            p = one(s[i - depth : i], bits[:j])
            want += math.log10(p if bits[j] == "1" else 1 - p)
    assert abs(lm_scoring.text_scores(d2, o2, whole, logs)[0] - want) < 1e-9


def vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(300)]
    for c in range(5):
        centre = rng.normal(size=16)
        rows += [(300 + 40 * c + i, (centre + rng.normal(size=16) * 0.1).tolist()) for i in range(40)]
    rows += [(500, rows[0][1]), (501, rows[0][1]), (501, rows[0][1]), (502, None), (503, [0.0] * 16), (504, [float("nan")] * 16), (505, [1.0, None] * 8), (506, [float("inf")] + [1.0] * 15), (507, []), (508, [1.0, 2.0]), (509, [2.0, 4.0]), (None, rows[1][1])]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>")


@pytest.mark.parametrize("most", [4096, 8])
def test_embeddings(spark, most, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "MOST_ROWS", most)
    monkeypatch.setattr(embedding_dedup, "MOST_VECTORS", most)
    rows, df = vectors(spark)
    out = embedding_dedup.near_duplicates(df.withColumn("label", F.lit(1)).withColumn("item", F.lit(2))).collect()
    assert len(out) == len(rows)
    ok = [(i, np.array(v, float)) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)]
    links, parent = Counter(), {i: i for i, _ in ok}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(ok)):
        for b in range(a):
            (i, x), (j, y) = ok[a], ok[b]
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.95:
                links[a] += 1
                links[b] += 1
                if i is not None and j is not None:
                    lo, hi = sorted((find(i), find(j)))
                    parent[hi] = lo
    got, want = Counter(), Counter()
    for r in out:
        got[r.vec_id] += r.n_links
    for a, (i, _) in enumerate(ok):
        want[i] += links[a]
    assert sum(got.values()) >= 0.97 * sum(want.values()) and all(got[i] <= want[i] for i in got)
    by = {r.vec_id: r for r in out}
    assert by[501].n_links == by[500].n_links == want[0] and by[501].component_id == 0 and not by[501].kept
    for i in (502, 503, 504, 505, 506, 507):
        assert (by[i].n_links, by[i].component_id, by[i].kept) == (0, i, True)
    assert by[509].component_id == 508
    assert np.mean([by[i].component_id == find(i) for i in parent if i is not None]) > 0.98
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("most", [24576, 2])
def test_suffix_dedup(docs, empty, most, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MOST_ROWS", most)
    monkeypatch.setattr(suffix_dedup, "PIECE", 5000)
    out = suffix_dedup.remove_repeats(docs).collect()
    count = Counter()
    for r in ROWS:
        b = (r[1] or "").encode()
        count.update(b[i : i + 400] for i in range(len(b) - 399))
    want = Counter()
    for r in ROWS:
        b = (r[1] or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 399):
            if count[b[i : i + 400]] > 1:
                gone[i : i + 400] = True
        spans = int((gone[:-1][:1]).sum() + (gone[1:-1] & ~gone[:-2]).sum()) if len(b) else 0
        kept = bytes(x for x, g in zip(b, gone[:-1], strict=True) if not g)
        want[(r[0], len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore"))] += 1
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.text) for r in out) == want
    assert sum(1 for r in out if r.n_removed) > 10 and {"lang", "h", "n"} <= set(out[0].asDict())
    assert suffix_dedup.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("length", [128, 256, 400, 401])
def test_cover_ranks_against_plain_comparison(length):
    """Repeated strings of a buffer by difference-cover ranks and by comparing all strings; long ties, periods and near misses."""
    rng = np.random.default_rng(length)
    base = rng.integers(97, 100, 900, dtype=np.uint8)
    rows = [base.copy(), base.copy(), base[:700].copy(), np.tile(base[:3], 300), np.tile(base[:7], 100), rng.integers(97, 99, 800, dtype=np.uint8)]
    rows[1][450] ^= 1
    rows.append(np.concatenate([base[100:620], base[50:140]]))
    data = np.concatenate(rows)
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    for groups in ([0] * 7, [0, 0, 1, 1, 0, 1, 0]):
        starts, of = suffix_dedup.valid_starts(0, len(data), offsets, length)
        group = np.array(groups)[of]
        got = suffix_dedup.repeated_suffixes(data, starts, group, length)
        seen = Counter((g, data[s : s + length].tobytes()) for s, g in zip(starts.tolist(), group.tolist(), strict=True))
        assert got.tolist() == [seen[g, data[s : s + length].tobytes()] > 1 for s, g in zip(starts.tolist(), group.tolist(), strict=True)]
        assert got.any() and not got.all()


def test_memory_of_a_block(monkeypatch):
    """A block of 2,000 runs that share half their bytes is sorted, and hashed, in less than 60 bytes a byte."""
    rng = np.random.default_rng(8)
    rows = rng.integers(97, 123, (2000, 799), dtype=np.uint8)
    rows[:, 200:400] = rows[0, 200:400]
    offsets = np.arange(2001) * 799
    table = pa.table({"doc_id": np.arange(2000), "rid": np.arange(2000), "s": np.zeros(2000, np.int32), "alone": np.ones(2000, bool), "bucket": np.zeros(2000, np.int64), "block": np.zeros(2000, np.int32), "blocks": np.full(2000, 2, np.int32), "string": pa.array([r.tobytes() for r in rows], pa.binary())})
    data = rows.ravel()
    starts, _ = suffix_dedup.valid_starts(0, len(data), offsets, 400)
    monkeypatch.setattr(suffix_dedup, "PIECE", 1 << 16)
    tracemalloc.start()
    try:
        assert not suffix_dedup.repeated_suffixes(data, starts, np.zeros(len(starts), np.int64), 400).any()
        sorting = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        out = pa.Table.from_batches(suffix_dedup._resolve(400)(table))
        whole = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sorting < 60 * len(data) and whole < 80 * len(data)
    h = suffix_dedup.string_hashes(data, 400)[0][starts].view(np.int64)
    assert out.num_rows == len(starts) and sorted(out["suffix"].to_pylist()) == sorted(h.tolist())


def test_blocks_of_one_text(spark, monkeypatch):
    """The runs of one text are cut into blocks too: a passage that it repeats 600 times, each time with its own neighbours."""
    rng = np.random.default_rng(6)
    own = lambda n: bytes(rng.integers(97, 123, n, dtype=np.uint8)).decode()
    passage = own(300)
    text = "".join(own(300) + passage for _ in range(600))
    sizes, spread = [], suffix_dedup.spread

    def counted(df, *keys):
        sizes.append(df.groupBy(*keys).count().agg(F.max("count"), F.countDistinct(*keys)).first())
        return spread(df, *keys)

    monkeypatch.setattr(suffix_dedup, "MOST_ROWS", 50)
    monkeypatch.setattr(suffix_dedup, "spread", counted)
    out = suffix_dedup.remove_repeats(spark.createDataFrame([(1, text), (2, own(2000)), (3, text[-1000:])], "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed) for r in out} == {1: (360_000, 1000), 2: (2000, 0), 3: (1000, 1000)}
    assert sizes[0][0] <= 2 * 50 and sizes[0][1] >= 12


def test_difference_cover():
    for period in (7, 31, 32, 64):
        cover = suffix_dedup.difference_cover(period)
        assert {(a - b) % period for a in cover for b in cover} == set(range(period)) and len(cover) ** 2 < 3 * period



@pytest.mark.parametrize("most", [20000, 3])
def test_simhash(docs, empty, most, monkeypatch):
    monkeypatch.setattr(simhash, "MOST_ROWS", most)
    out = simhash.near_duplicates(docs, words=4).collect()
    prints = []
    for r in ROWS:
        w = tokens(r[1])
        grams = [b" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([b" ".join(w)] if w else [])
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    parent = list(range(len(ROWS)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(ROWS)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                parent[find(a)] = find(b)
    least = {}
    for a, r in enumerate(ROWS):
        if r[0] is not None:
            least[find(a)] = min(least.get(find(a), r[0]), r[0])
    want = Counter((r[0], f"{prints[a]:016x}", least.get(find(a))) for a, r in enumerate(ROWS))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in out) == want
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("spread", [3, 20, 64])
def test_gray_index_finds_all(spread):
    rng = np.random.default_rng(spread)
    fp = rng.integers(0, 1 << 63, 6, dtype=np.uint64)[rng.integers(0, 6, 400)]
    for _ in range(3):
        fp = fp ^ (np.uint64(1) << rng.integers(0, spread, 400, dtype=np.uint64))
    group = np.sort(rng.integers(0, 5, 400))
    order = np.lexsort((simhash.gray_rank(fp), group))
    group, fp = group[order], fp[order]
    a, b = simhash.links(group, fp, 4)
    got = set(zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist(), strict=True))
    assert len(got) == len(a)
    assert got == {(i, j) for i in range(400) for j in range(i + 1, 400) if group[i] == group[j] and int(fp[i] ^ fp[j]).bit_count() <= 4}


def test_sharding(docs, empty):
    out = sharding.shard_documents(docs, shards=7).toPandas()
    assert len(out) == len(ROWS)
    per = out.groupby("shard").slot.agg(["size", "min", "max", "nunique"])
    assert len(per) == 7 and per["size"].max() - per["size"].min() <= 1
    assert (per["min"] == 0).all() and (per["max"] == per["size"] - 1).all() and (per["nunique"] == per["size"]).all()
    want = Counter((zlib.crc32((r[1] or "").encode()), len((r[1] or "").encode()) + 16) for r in ROWS)
    assert Counter(zip(out.text_crc32, out["size"], strict=True)) == want
    # Every shard has the mixture: no source is off by more than two rows.
    share = out.fillna({"source": "-"}).groupby(["shard", "source"]).size().unstack(fill_value=0)
    assert ((share - share.sum() / 7).abs() <= 2).all().all()
    assert sharding.shard_documents(empty).count() == 0


def test_toxicity(spark, docs, empty):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 6 == 0
        w = words(rng, "en", rng.randint(20, 120)).split()
        if toxic:
            for _ in range(3):
                w[rng.randrange(len(w))] = rng.choice(["idiot", "scumming", "moronic"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 4 != 1), int(toxic)))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    held = spark.createDataFrame([x for x in labels if x[0] < 400] + [(401, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in toxicity.toxicity(d, held, ["quality", "toxic"]).collect()}
    right = [(out[i].p_toxic >= 0.5) == (i % 6 == 0) for i in range(400, 600)]
    assert np.mean(right) > 0.98
    same = toxicity.toxicity(d.repartition(5), held, ["quality", "toxic"]).collect()
    assert all(abs(out[r.doc_id].p_toxic - r.p_toxic) < 1e-6 for r in same)
    none = toxicity.toxicity(docs, held.limit(0), ["toxic"]).collect()
    assert len(none) == len(ROWS) and all(r.p_toxic < 1e-6 for r in none)
    assert toxicity.toxicity(empty, held, ["toxic"]).count() == 0


def test_out_of_fold_predictions_have_not_seen_the_fold(spark, monkeypatch):
    """With labels that nothing in the texts explains, the first category's out-of-fold probabilities say nothing either."""
    rng = random.Random(2)
    vocabulary = words(rng, "en", 3000).split()
    rows = [(i, " ".join(rng.choices(vocabulary, k=40))) for i in range(500)]
    labels = [(i, rng.randint(0, 1), rng.randint(0, 1)) for i in range(500)]
    seen = {}
    fit = toxicity.fit_chain

    def spy(x, y, folds, columns):
        seen.update(folds=folds, columns=columns, x=x, y=y)
        return fit(x, y, folds, columns)

    monkeypatch.setattr(toxicity, "fit_chain", spy)
    toxicity.toxicity(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), ["quality", "toxic"])
    guess = np.zeros(500)
    for f in range(toxicity.FOLDS):
        own = seen["folds"] == f
        x = seen["x"][:, seen["columns"][f]]
        guess[own] = x[own] @ toxicity.logistic(x[~own], seen["y"][0][~own])
    y = seen["y"][0] == 1
    ranks = guess.argsort().argsort()
    auc = (ranks[y].mean() - (y.sum() - 1) / 2) / (~y).sum()
    assert set(seen["folds"]) == set(range(toxicity.FOLDS)) and 0.4 < auc < 0.6
    assert any(set(seen["columns"][f]) != set(seen["columns"][toxicity.FOLDS]) for f in range(toxicity.FOLDS))


def test_language_id_learns_the_commonest_of_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MOST_LANGUAGES", 2)
    docs = spark.createDataFrame([(1, "aaa bbb aaa bbb", "x"), (2, "ccc ddd ccc", "y"), (3, "e", "z")], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in language_id.identify(docs, docs).collect()} == {"x", "y"}


def test_language_id_against_brute_force(docs):
    """Scores and predictions again from their definitions: trigram counts, script ranges, best labelling by dynamic programming."""
    from locus.llm.language_id import BUCKETS, WORD, fit, trigrams, word_scores

    train = [r for r in ROWS if r[1] and r[2]]
    languages = sorted({r[2] for r in train})
    counts = {x: Counter() for x in languages}
    for r in train:
        for w in WORD.findall(r[1].lower()):
            counts[r[2]].update(trigrams([w])[0].tolist())
    total = {x: sum(c.values()) for x, c in counts.items()}
    _, _, allowed = fit(docs)
    out = {r.doc_id: r for r in language_id.identify(docs, docs).collect()}
    for r in ROWS[:110:7]:
        found = WORD.findall((r[1] or "").lower())
        if not found:
            continue
        grams = [trigrams([w])[0].tolist() for w in found]
        logs = np.array([[sum(np.log((counts[x][g] + 0.5) / (total[x] + 0.5 * BUCKETS)) for g in gs) for x in languages] for gs in grams])
        post = logs - logs.max(1, keepdims=True)
        post = np.maximum(post - np.log(np.exp(post).sum(1, keepdims=True)), -12)
        ok = allowed[[int(trigrams([w])[2][0]) for w in found]]
        ok |= ~ok.any(1, keepdims=True)
        if not ok.all():
            continue  # scores are narrowed by script before they are normed: tested through word_scores
        best, back = [post[0]], []
        for p in post[1:]:
            move = best[-1][:, None] - 6.0 * (1 - np.eye(len(languages)))
            back.append(move.argmax(0))
            best.append(move.max(0) + p)
        at = [int(best[-1].argmax())]
        for b in reversed(back):
            at.append(int(b[at[-1]]))
        share = Counter()
        for w, x in zip(found, reversed(at), strict=True):
            share[languages[x]] += len(w)
        assert out[r[0]].lang_pred == max(sorted(share), key=lambda x: share[x])
        assert abs(out[r[0]].score - max(share.values()) / sum(share.values())) < 1e-9


def test_bpe(docs, empty):
    import public_tokenizers
    import tiktoken

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    tool = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = bpe.encode_decode(docs).collect()
    text = {r[0]: r[1] or "" for r in ROWS}
    assert len(out) == len(ROWS)
    for r in out:
        ids = tool.encode_ordinary(text[r.doc_id])
        assert r.ids == ids and r.n_tokens == len(ids) and bytes(r.decoded) == text[r.doc_id].encode()
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()
    assert bpe.encode_decode(empty).count() == 0
    voc = bpe.Vocabulary(ranks)
    odd = ["aaaaaaa", "  \n\n x", "\x1c\x1d \x85 y", "ab'll we're!!??", "0" * 60, "=-" * 90, "👍🏽👍🏽 ☃", " x　 y"]
    split = bpe.split_pattern(public_tokenizers.PATTERN)
    for t in odd:
        ids, _ = bpe.replay([p.encode() for p in split.findall(t)], voc)
        assert ids.tolist() == tool.encode_ordinary(t), t


def test_components(spark):
    from locus.llm.common import components

    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 560)]
    parent = list(range(600))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        lo, hi = sorted((find(a), find(b)))
        parent[hi] = lo
    out = components(spark.range(600), spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.id: r.component for r in out} == {i: find(i) for i in range(600)}
