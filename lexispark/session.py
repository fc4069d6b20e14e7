"""Spark session helpers.

The library never hard-codes a cluster layout. ``tuned_conf`` lists the
settings the jobs rely on (AQE, skew handling, a runtime-measured broadcast
threshold); ``get_session`` applies them for local runs and tests.  On a
cluster the submitter's settings win: ``ensure_checkpoint_dir`` only sets a
checkpoint folder when the session has none.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Runtime-measured broadcast: AQE converts a sort-merge join into a broadcast
# join only when the *measured* shuffle output of one side is below this size,
# so a broadcast never depends on an estimate that can grow with the data.
AQE_BROADCAST_BYTES = 64 * 1024 * 1024


def tuned_conf(shuffle_partitions: int | None = None) -> dict[str, str]:
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(AQE_BROADCAST_BYTES),
        # Static (plan-time) broadcast off: estimates of derived tables are not
        # a proven bound. Explicit broadcasts in this library are size-checked.
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return conf


def get_session(master: str | None = None, app: str = "lexispark",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**tuned_conf(shuffle_partitions), **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a local one only when
    none is configured (local runs and tests). On a cluster the shared folder
    named by ``spark.checkpoint.dir`` is used as is."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError(
                "spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="lexispark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (Arrow batch
    functions run there): zip it once and ``addPyFile`` it, once per
    application. Not needed when the package is installed on the workers or
    passed with ``spark-submit --py-files``."""
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="lexispark-pkg-"), "lexispark.zip")
    with zipfile.ZipFile(target, "w") as z:
        for dirpath, _, files in os.walk(root):
            for fn in files:
                if fn.endswith(".py"):
                    full = os.path.join(dirpath, fn)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(target)
    _SHIPPED.add(key)
