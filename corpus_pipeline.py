"""The corpus pipeline: language ID, near-dedup by shingles, repeated passages, mixing to target weights, BPE encoding.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns a DataFrame that is written as Parquet
and read again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locus.llm.bpe import encode_decode
from locus.llm.common import distilled, materialize
from locus.llm.similar import near_texts
from locus.llm.language_id import identify
from locus.llm.mixing import repeat_documents
from locus.llm.suffix_dedup import remove_repeats

#: Bytes of the strings that count as a repeated passage: fifty words of the shortest language take more (267 and up were seen).
PASSAGE = 256
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has no letter of any language (null texts included) go; others keep all columns, lang filled in from the
    prediction where it is null: `und` if there is no language to learn."""
    found = identify(docs, docs, with_spans=False, keep=[c for c in COLUMNS if c != "doc_id"])
    return found.where((F.col("lang_pred") != "und") | F.col("text").rlike(r"\p{L}")).select("doc_id", "text", F.coalesce("lang", "lang_pred").alias("lang"), "source", "n_chars")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (SimHash candidates of Jaccard similarity 0.8 or more in five-word shingles)
    stays: the one with the smallest doc_id, among several texts under it the one with the smallest hash, among equal ones the one
    with the smallest lang, source and n_chars (nulls first). A row without doc_id stays only where its whole group has none."""

    def firsts() -> DataFrame:
        labelled = near_texts(docs, words=5)
        first = labelled.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), "tid")).alias("f"))
        return first.select("f.*").distinct()

    kept = distilled(spark, firsts)
    # Rows are counted down to one an id and text before the join, on its keys.
    keyed = docs.select(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("tid"), *COLUMNS)
    once = keyed.groupBy("none", "id", "tid").agg(F.min(F.struct("lang", "source", "n_chars")).alias("r"), F.first("text").alias("text"))
    return once.join(kept, ["none", "id", "tid"]).select(F.when(~F.col("none"), F.col("id")).alias("doc_id"), "text", "r.lang", "r.source", "r.n_chars")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of strings of PASSAGE bytes that also start elsewhere in the documents go; documents of which nothing is left go. A
    null text becomes empty and stays; n_chars counts what is left."""
    left = remove_repeats(docs.select(*COLUMNS), length=PASSAGE).where("n_removed < n_bytes or n_bytes = 0")
    return left.select("doc_id", "text", "lang", "source", F.char_length("text").cast("long").alias("n_chars"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document is repeated as often as the mix takes it; documents that it does not take (those without words among them) go.
    Rows without doc_id and repeated rows are documents of their own."""
    return repeat_documents(docs.select(*COLUMNS))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row."""
    return encode_decode(docs, with_ids=False)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("repeated_passages", repeated_passages), ("mixing", mixing), ("encoding", encoding)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs)
    return docs
