"""Sinks (A3-A6, A9, A13). Writes are distributed (one file per partition);
``mode="overwrite"`` replaces an old output as a whole, once the new one is
complete (A6, ``outputs.replace_output``)."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from ..plans.stages import materialize
from .outputs import replace_output

log = logging.getLogger("lexispark")

#: Bytes of one file of a folder per value, about.
TARGET_BYTES = 128 << 20
#: Values of several files that are sent to the tasks; beyond, a join.
FEW_VALUES = 500_000


def _put(df: DataFrame, path: str, mode: str, write: Callable[[str], None]) -> None:
    if mode == "overwrite":
        replace_output(df.sparkSession, path, write)
    else:
        write(path)


def write_text(df: DataFrame, col: str, path: str, mode: str = "overwrite", escape: bool = True) -> None:
    """A3: one line per row. Backslashes and newlines inside a value are
    escaped so that a row stays one line (Q10); ``escape=False`` for lines that
    hold neither, such as JSON."""
    c = F.regexp_replace(F.regexp_replace(F.col(col), r"\\", r"\\\\"), "\n", r"\\n") if escape else F.col(col)
    _put(df, path, mode, lambda p: df.select(c.alias("value")).write.text(p))


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A4."""
    _put(df, path, mode, lambda p: df.write.option("ignoreNullFields", "false").json(p))


def write_by_value(df: DataFrame, column: str, path: str, mode: str = "overwrite", target_bytes: int = TARGET_BYTES) -> int:
    """JSON lines in one folder per value of ``column`` (names escaped).

    The rows are staged and each value's bytes counted; a value of several times
    ``target_bytes`` is dealt to as many salts, and each (value, salt) to one task, so
    a folder gets at most its bytes / ``target_bytes`` + 1 files. A task's rows come
    in the order of the values, so it has one file open at a time. Returns
    the number of values with more than one file."""
    own = materialize(df.withColumn("_at", F.monotonically_increasing_id()), "by-value")
    size = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})) + 1
    files = F.ceil(F.sum(size) / target_bytes).cast("int")
    large = materialize(own.groupBy(F.col(f"`{column}`").alias("_value")).agg(files.alias("_files")).filter("_files > 1"), "large-values")
    n, pieces = large.agg(F.count(F.lit(1)), F.coalesce(F.sum("_files"), F.lit(0))).collect()[0]
    dealt = own.join(F.broadcast(large) if n <= FEW_VALUES else large, F.col(f"`{column}`").eqNullSafe(F.col("_value")), "left")
    salted = dealt.withColumn("_salt", F.coalesce(F.pmod(F.col("_at"), F.col("_files")), F.lit(0)))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (salted.repartition(max(tasks, min(4 * pieces, 10_000)), F.col(f"`{column}`"), "_salt")
            .sortWithinPartitions(F.col(f"`{column}`")).select(*[F.col(f"`{c}`") for c in df.columns]))
    _put(df, path, mode, lambda p: rows.write.option("ignoreNullFields", "false").partitionBy(column).json(p))
    return n


def guarded_write(write, path: str, on_error: str = "raise") -> bool:
    """A5: run ``write(path)``; with ``on_error="log"`` a failure is logged and
    the job goes on (the original behaviour); the default is to fail."""
    try:
        write(path)
        return True
    except Exception:  # noqa: BLE001
        if on_error != "log":
            raise
        log.exception("could not write to %s", path)
        return False


def write_report(items: DataFrame, path: str, mode: str = "overwrite", partitions: int | None = None) -> None:
    """Report items (id, data) as JSON lines in id order; files follow
    the id ranges, no single-task collect."""
    ranged = items.repartitionByRange(partitions, "id") if partitions else items.repartitionByRange("id")
    _put(items, path, mode, lambda p: ranged.sortWithinPartitions("id").write.json(p))
