"""Structured Streaming form of the annotation and mention counting.

The annotation and sequence operators are row-local expressions, so they run
unchanged on a streaming DataFrame. The mention count per (organization,
community) is Spark's own stateful streaming aggregation (state store,
checkpointed), emitted in ``update`` or ``complete`` mode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import jsonfn
from ..operators import orgs as O
from ..operators.annotate import TEST_LEXICON, Lexicon


def read_comment_stream(spark: SparkSession, input_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New JSON-lines files under ``input_dir`` -> (id, subreddit, body, error)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    v = jsonfn.parse("value")
    return r.load(input_dir).select(
        F.when(jsonfn.value_type(v, "id") == "BIGINT", F.variant_get(v, "$.id", "string"))
        .otherwise(jsonfn.string_field(v, "id")).alias("id"),
        jsonfn.string_field(v, "subreddit").alias("subreddit"),
        jsonfn.string_field(v, "body").alias("body"),
        jsonfn.error_of("value").alias("error"))


def tagged_stream(comments: DataFrame, lexicon: Lexicon = TEST_LEXICON) -> DataFrame:
    return O.tagged_from_text(comments.filter(F.col("error").isNull()), lexicon)


def mention_counts(tagged: DataFrame) -> DataFrame:
    """Running mentions per (lower org, community): stateful aggregation."""
    return O.org_counts(tagged)


def start_counts(spark: SparkSession, input_dir: str, checkpoint_dir: str, sink: str = "memory",
                 query_name: str = "org_mention_counts", mode: str = "update",
                 trigger_available_now: bool = False) -> StreamingQuery:
    counts = mention_counts(tagged_stream(read_comment_stream(spark, input_dir)))
    w = (counts.writeStream.outputMode(mode).format(sink).queryName(query_name)
         .option("checkpointLocation", checkpoint_dir))
    if trigger_available_now:
        w = w.trigger(availableNow=True)
    return w.start()
