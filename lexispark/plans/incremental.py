"""Incremental word_count (A7, H4): a run reads only the input files that no
earlier run has read, and adds their counts to what those have counted.

The state folder holds one batch for each run: partial counts of casings (E4) and
adjectives (E6), which add up, sentences, errors and, written last, the files that
they come from (path, bytes, time of change). A batch counts only when this last part
is complete, so a run that was cut off has counted nothing and its files are read again.
A file that changed or disappeared after it was counted can't be taken back out
of the counts: such a run fails and says so.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.outputs import finished, input_files


class Counts(NamedTuple):
    casings: DataFrame
    adjs: DataFrame
    sentences: DataFrame
    errors: DataFrame


SCHEMAS = Counts("org_lower string, subreddit string, org string, n bigint",
                 "org_lower string, subreddit string, adj string, is_direct boolean, adj_count bigint",
                 "subreddit string, sentence string", "error string, lines bigint")
FILES = "path string, bytes bigint, changed bigint, options string"


def _batches(spark: SparkSession, state: str) -> list[str]:
    return [f"{state}/{name}" for name in finished(spark, state, "batch=", "files")]


def processed(spark: SparkSession, state: str) -> DataFrame:
    """The files counted so far."""
    paths = [f"{b}/files" for b in _batches(spark, state)]
    return spark.read.schema(FILES).parquet(*paths) if paths else spark.createDataFrame([], FILES)


def advance(spark: SparkSession, inp: str, state: str, count: Callable[[list[str]], Counts], options: str = "") -> Counts:
    """The counts of all files below ``inp``: ``count`` is called with the paths
    that are new, if any. ``options`` names what else the counts depend on."""
    there = spark.createDataFrame(input_files(spark, inp), "path string, bytes bigint, changed bigint")
    known = processed(spark, state)
    both = there.withColumnRenamed("bytes", "b").withColumnRenamed("changed", "c").join(known, "path", "full")
    same = (F.col("b").eqNullSafe(F.col("bytes")) & F.col("c").eqNullSafe(F.col("changed")) & (F.col("options") == F.lit(options)))
    odd = both.filter(F.col("options").isNotNull() & ~same)
    changed = odd.select("path").limit(3).collect()
    if changed:
        raise ValueError(f"counted files changed, disappeared or had other options, e.g. {[r['path'] for r in changed]}: "
                         "use a new state folder")
    new = both.filter(F.col("options").isNull()).select("path", F.col("b").alias("bytes"), F.col("c").alias("changed"),
                                                        F.lit(options).alias("options"))
    paths = sorted(r["path"] for r in new.select("path").toLocalIterator())
    if paths:
        batch = f"{state}/batch={uuid.uuid4().hex}"
        for name, part in zip(Counts._fields, count(paths), strict=True):
            part.write.parquet(f"{batch}/{name}")
        spark.createDataFrame([tuple(r) for r in new.collect()], FILES).coalesce(1).write.parquet(f"{batch}/files")
    return merged(spark, state)


def merged(spark: SparkSession, state: str) -> Counts:
    """The sums of all finished batches."""
    batches = _batches(spark, state)

    def read(name: str) -> DataFrame:
        schema = getattr(SCHEMAS, name)
        return spark.read.schema(schema).parquet(*[f"{b}/{name}" for b in batches]) if batches else spark.createDataFrame([], schema)

    casings = read("casings").groupBy("org_lower", "subreddit", "org").agg(F.sum("n").alias("n"))
    adjs = read("adjs").groupBy("org_lower", "subreddit", "adj", "is_direct").agg(F.sum("adj_count").alias("adj_count"))
    errors = read("errors").groupBy("error").agg(F.sum("lines").alias("lines"))
    return Counts(casings, adjs, read("sentences"), errors)
