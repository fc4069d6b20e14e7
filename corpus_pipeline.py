"""The corpus pipeline: language ID, line dedup, near-duplicates, benchmark
decontamination, byte-level BPE. Each stage calls one operator of
``lexispark.llm`` on all that the stage before kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's documents. All but the last return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexispark.llm import bpe, decontam, langid, linededup, neardup
from lexispark.llm.common import stage, table
from lexispark.llm.queries import vocabulary

#: Documents whose language is less sure than this are rejected.
MIN_LANGUAGE_SCORE = 0.4
#: SQL has no string kernels; the stages are tested against brute force.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language, which becomes their ``lang``. It is
    learned from the rows that have one."""
    return langid.accept(docs, langid.fit(docs, F.col("doc_id").isNotNull()), MIN_LANGUAGE_SCORE)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with lines found in ten documents or more left only where
    they come first, so that one copy of a passage survives."""
    out = linededup.without_repeats(docs, min_docs=10, keep_first=True)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in out.columns else out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return neardup.representatives(docs, threshold=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that share no ten consecutive words with the benchmark."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), window=10)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document: doc_id, n_tokens, ids, and the digest of the
    bytes that the ids decode to."""
    path, pattern = vocabulary("byte_bpe_multi_50k.tiktoken")
    return bpe.encode(docs, path, pattern, columns=("n_tokens", "ids", "decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{name}")
    return docs
