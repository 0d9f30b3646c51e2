"""Byte-level BPE encoding and decoding by corpus-level merge replay.

A block of texts is cut into pieces by the tokenizer's pattern; its distinct pieces form one corpus of byte tokens. An inverted
index leads from a merge's rank to the places of the token pairs it joins. The merges are replayed once, in rank order, each at all
its places at once; only the pairs left and right of a joined place change, and they enter the index under their own, always higher
ranks. That equals joining the lowest-ranked pair of every piece again and again.

Defined results: null text counts as empty: no tokens, decoded to the empty text. Decoding gives back the text's bytes. Equal
texts have equal ids. Long texts and pieces without spaces are one piece each, worked off like others. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import arrow_batches, restored

#: White space as Unicode defines it; the regex module's own class differs in a few control characters.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Code points of text in a block.
BLOCK = 6 << 20


def split_pattern(pattern: str) -> regex.Pattern:
    """The tokenizer's pattern with white space as an explicit class."""
    inside = pattern.replace(r"[^\s", f"[^{SPACE}")
    return regex.compile(inside.replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]"))


class Vocabulary:
    """Ranks of byte strings, and the merges they allow: pairs of known strings whose concatenation is known."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        size = max(ranks.values(), default=0) + 1
        self.strings = [b""] * size
        for s, r in ranks.items():
            self.strings[r] = s
        self.byte = np.array([ranks.get(bytes([i]), -1) for i in range(256)], dtype=np.int64)
        if (self.byte < 0).any():
            raise ValueError("a byte-level vocabulary has all 256 bytes")
        pairs = [(ranks[s[:i]], ranks[s[i:]], r) for s, r in ranks.items() for i in range(1, len(s)) if s[:i] in ranks and s[i:] in ranks]
        a, b, r = np.array(pairs, dtype=np.int64).reshape(-1, 3).T
        keys = a * size + b
        order = np.argsort(keys)
        self.size, self.keys, self.joined = size, np.append(keys[order], np.iinfo(np.int64).max), np.append(r[order], -1)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair's concatenation, -1 if it is none; tokens below 0 stand for no token."""
        key = a * self.size + b
        at = np.searchsorted(self.keys, key)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.joined[at], -1)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def replay(pieces: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces, one after another, and where each piece's begin (with the number of ids at the end)."""
    lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
    data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    n = len(data)
    starts = np.cumsum(lengths) - lengths
    token = np.append(vocabulary.byte[data], -1)  # place n stands for no neighbour
    after = np.arange(1, n + 2)
    after[np.append(starts + lengths - 1, n)] = n
    before = np.arange(-1, n)
    before[starts] = n
    before = np.append(before[:n], n) if len(before) != n + 1 else before
    before[n] = n
    # The index: rank -> arrays of places whose token and the next have that rank.
    index: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def enter(places: np.ndarray) -> None:
        rank = vocabulary.rank(token[places], token[after[places]])
        known = rank >= 0
        places, rank = places[known], rank[known]
        if not len(places):
            return
        order = np.argsort(rank, kind="stable")
        places, rank = places[order], rank[order]
        cut = np.flatnonzero(np.append(True, rank[1:] != rank[:-1]))
        for r, part in zip(rank[cut].tolist(), np.split(places, cut[1:]), strict=True):
            if r in index:
                index[r].append(part)
            else:
                index[r] = [part]
                heapq.heappush(queue, r)

    enter(np.arange(n))
    while queue:
        r = heapq.heappop(queue)
        found = index.pop(r)
        places = np.sort(np.concatenate(found)) if len(found) > 1 else np.sort(found[0])
        # Places that were joined away or whose pair has changed meanwhile are out of date.
        left, right = token[places], after[places]
        places = places[(left >= 0) & (vocabulary.rank(left, token[right]) == r)]
        if len(places) > 1 and (after[places[:-1]] == places[1:]).any():
            places = np.unique(places)
            chain = np.append(False, after[places[:-1]] == places[1:])
            run = np.arange(len(places)) - np.maximum.accumulate(np.where(chain, 0, np.arange(len(places))))
            places = places[run % 2 == 0]  # of overlapping pairs the leftmost is joined first
        elif len(places) > 1:
            places = places[np.append(True, places[1:] != places[:-1])]
        if not len(places):
            continue
        right = after[places]
        beyond = after[right]
        token[places], token[right] = r, -1
        after[places] = beyond
        before[beyond] = places
        token[n], before[n], after[n] = -1, n, n
        previous = before[places]
        enter(np.concatenate([previous[previous < n], places[beyond < n]]))
    alive = token[:n] >= 0
    count = np.cumsum(alive)
    ends = np.append(0, count)[np.append(starts, n)]
    return token[:n][alive], ends


def _encode(vocabulary, pattern: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = restored(Vocabulary, vocabulary.value)
        find = split_pattern(pattern).findall
        held: list[tuple] = []
        pieces: dict[str, int] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            ids, cut = replay([p.encode("utf-8", "surrogatepass") for p in pieces], voc)
            counts = np.diff(cut)
            numbers = list(map(str, ids.tolist()))
            cuts = cut.tolist()
            said = [" ".join(numbers[a:b]).encode() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            strings = voc.strings
            spelt = [strings[x] for x in ids.tolist()]
            decoded = [b"".join(spelt[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            for doc_ids, of in held:
                n_tokens = [int(counts[o].sum()) for o in of]
                sha_ids = [hashlib.sha256(b" ".join(map(said.__getitem__, o.tolist()))).hexdigest() for o in of]
                back = [b"".join(map(decoded.__getitem__, o.tolist())) for o in of]
                out = [doc_ids, pa.array(n_tokens, pa.int64()), pa.array(sha_ids), pa.array([hashlib.sha256(x).hexdigest() for x in back])]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    whole = [np.concatenate([ids[cuts[p] : cuts[p + 1]] for p in o.tolist()] or [ids[:0]]).astype(np.int32) for o in of]
                    out += [pa.array(whole, pa.list_(pa.int32())), pa.array(back, pa.binary())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(out, names=names)
            held.clear()
            pieces.clear()

        size = 0
        for batch in batches:
            of = []
            for text in batch.column("text").to_pylist():
                found = find(text) if text else []
                for p in found:
                    if p not in pieces:
                        pieces[p] = len(pieces)
                of.append(np.fromiter(map(pieces.__getitem__, found), dtype=np.int32, count=len(found)))
                size += len(text or "")
            held.append((batch.column("doc_id"), of))
            if size > BLOCK:
                yield from flush()
                size = 0
        if held:
            yield from flush()

    return run


def encode_decode(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None, with_ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), with_ids also ids and decoded (bytes), of each row (doc_id, text).

    The vocabulary is a fixed table (path a parameter), read on the driver and broadcast; texts are mapped where they are read.
    """
    import public_tokenizers

    spark = docs.sparkSession
    arrow_batches(spark)
    vocabulary = spark.sparkContext.broadcast(Vocabulary(read_ranks(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"))).__dict__)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded binary" * with_ids
    return docs.select("doc_id", "text").mapInArrow(_encode(vocabulary, pattern or public_tokenizers.PATTERN, with_ids), schema)


def op10_bpe(spark, sf_dir: str) -> DataFrame:
    return encode_decode(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_ids=False)
