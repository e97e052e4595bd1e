"""The corpus pipeline: quality rules, line dedup, near-duplicate removal,
benchmark decontamination, tokenization.

Each stage takes (spark, docs, sf_dir) and gives the documents that it keeps,
with the columns of ``documents``; the last one gives the encodings. ``run``
writes every stage to the shared checkpoint folder as Parquet and reads it
again, so a stage is never computed twice and a lost executor costs one stage
at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import decontaminate, line_runs, near_duplicates, quality_ledger, sentencepiece_codec
from ledgerlake.llm.common import stored, table
from ledgerlake.llm.queries import tokenizer_file

#: Near duplicates here: shingles of five words, similarity of 0.8 or more.
SHINGLE_WORDS = 5
MIN_SIMILARITY_PCT = 80


def _with_length(docs: DataFrame) -> DataFrame:
    """n_chars follows the text where the table has that column."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_ledger.keep(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_length(line_runs.deduplicate(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.distinct_documents(docs, SHINGLE_WORDS, MIN_SIMILARITY_PCT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_digests(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", tokenize),
]

#: SQL cannot express the last three stages (similarity components, ranked
#: retrieval, merges); the tests compare every stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
