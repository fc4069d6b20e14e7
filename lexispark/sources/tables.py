"""The given parquet tables, and the comment-corpus view over them.

``documents`` stands in for the comment corpus: ``source`` -> subreddit,
``text`` -> body, ``doc_id`` -> id.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comment corpus (id BIGINT, subreddit STRING, body STRING)."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("source").alias("subreddit"), F.col("text").alias("body"))


def comment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus as JSON text lines (``value``), as the jobs read it."""
    return comments(spark, sf_dir).select(
        "id", F.to_json(F.struct("id", "subreddit", "body")).alias("value"))
