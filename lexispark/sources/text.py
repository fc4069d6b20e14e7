"""Line and JSON-lines sources (A1, A2, A7) and the comment reader."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import jsonfn


def read_lines(spark: SparkSession, paths: str | Sequence[str], min_partitions: int | None = None) -> DataFrame:
    """Text lines (``value``) of one path, a glob or a list of paths.
    ``min_partitions`` only adds a round-robin split when the input has fewer
    splits (small inputs ahead of CPU-heavy annotation)."""
    df = spark.read.text(list(paths) if not isinstance(paths, str) else paths)
    if min_partitions and df.rdd.getNumPartitions() < min_partitions:
        df = df.repartition(min_partitions)
    return df


def parse_lines(lines: DataFrame) -> DataFrame:
    """A2: add ``json`` (VARIANT, NULL for a malformed line)."""
    return lines.withColumn("json", jsonfn.parse("value"))


def read_comments(spark: SparkSession, paths, min_partitions: int | None = None) -> DataFrame:
    """Comments as (value, id, subreddit, body, error): a malformed line keeps
    its raw text and gets an ``error`` instead of failing the job (B4, Q12)."""
    d = parse_lines(read_lines(spark, paths, min_partitions))
    return d.select("value",
                    jsonfn.string_field("json", "id").alias("id"),
                    jsonfn.string_field("json", "subreddit").alias("subreddit"),
                    jsonfn.string_field("json", "body").alias("body"),
                    F.when(F.col("json").isNull(), F.lit(jsonfn.PARSE_ERROR)).alias("error"))
