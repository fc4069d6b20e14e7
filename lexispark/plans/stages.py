"""Stage boundaries.

The original pipeline chains jobs through files (annotated corpus ->
profiles/sentences -> embeddings). ``materialize`` keeps that boundary in a
single Spark application: the stage output is written once as Parquet into
the shared folder named by ``spark.checkpoint.dir`` and read back. This

* cuts lineage: a lost executor does not replay the annotation;
* computes the stage once even when several branches read it (a reliable
  ``Dataset.checkpoint`` would run the plan twice unless it was cached);
* lets later stages read only the columns they need (Parquet pruning);
* stops the optimizer from pushing filters that re-evaluate the whole
  annotation below the boundary.

``remove_stages`` deletes what an application has staged; the jobs call it when
their output is written. (A query's result still reads its stages.)
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import ensure_checkpoint_dir

_STAGED: dict[str, list[str]] = {}


def stage_path(df: DataFrame, name: str = "stage") -> str:
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/lexispark-{name}-{uuid.uuid4().hex}"
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove_stages(spark: SparkSession) -> int:
    """Deletes the folders that this application has staged so far."""
    paths = _STAGED.pop(spark.sparkContext.applicationId, [])
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    return len(paths)


#: For rows of megabytes: Parquet's writer looks at its sizes after every row, not after 100,
#: and a row group, which its writer and its reader hold whole, ends at 16 MB.
WIDE_ROWS = {"parquet.page.size.row.check.min": "1", "parquet.block.size": str(16 << 20)}


def materialize(df: DataFrame, name: str = "stage", options: dict[str, str] | None = None) -> DataFrame:
    path = stage_path(df, name)
    df.write.mode("error").options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_by(df: DataFrame, column: str, name: str = "stage") -> DataFrame:
    """Stage output clustered by ``column``: one folder for each hash of it (at
    most ``FOLDERS``), the column itself kept in the files, so that empty, NULL
    and odd values come back as they were; a filter on the column reads little
    else than its rows. The rows go through a REBALANCE: adaptive execution
    splits a value holding a large share of all rows into advisory-sized tasks
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``) and merges small ones,
    so a hot value is written by many tasks and a cold one does not become many
    tiny files."""
    path = stage_path(df, name)
    keyed = df.withColumn(FOLDER, F.pmod(F.xxhash64(column), F.lit(FOLDERS)).cast("int"))
    keyed.hint("rebalance", FOLDER, column).write.mode("error").partitionBy(FOLDER).parquet(path)
    return df.sparkSession.read.schema(keyed.schema).parquet(path)


#: Folders of a clustered stage, and the column that names them.
FOLDERS, FOLDER = 1024, "_folder"


def of_value(staged: DataFrame, column: str, value) -> DataFrame:
    """The rows of one value (or NULL) of a clustered stage, from its folder."""
    spark = staged.sparkSession
    folder = spark.range(1).select(F.pmod(F.xxhash64(F.lit(value).cast(staged.schema[column].dataType)),
                                          F.lit(FOLDERS)).cast("int")).collect()[0][0]
    return staged.filter((F.col(FOLDER) == folder) & F.col(column).eqNullSafe(F.lit(value))).drop(FOLDER)
