"""Spark session helpers.

Nothing here changes how a query computes; it only provides a sane local
session for tests / bench and a shared checkpoint directory.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
from contextlib import contextmanager

from pyspark.sql import SparkSession

_LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
    "spark.scheduler.mode": "FAIR",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cpus: int | str = "*", app: str = "orderlens", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (the cluster brings its own)."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(_LOCAL_CONF)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local session (tests, bench) may go without: it gets one private folder that is
    removed when the process ends.  A cluster session without a folder is an error, as each
    executor would write to its own disk.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = tempfile.mkdtemp(prefix="orderlens-ckpt-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    sc.setCheckpointDir(own)
    return sc.getCheckpointDir() or own


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared checkpoint folder for written intermediate tables."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning = threading.Lock()
_cleaners: dict[int, list] = {}


@contextmanager
def shuffles_end_with_their_job(spark):
    """What runs inside deletes its shuffle files when it ends, not when the driver's heap is collected.  For jobs whose
    plan nothing runs again, as those that write a table; the setting is a session's, so writes at a time share it."""
    key = id(spark._jsparkSession)
    with _cleaning:
        held = _cleaners.setdefault(key, [0, None])
        if not held[0]:
            held[1] = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        held[0] += 1
    try:
        yield
    finally:
        with _cleaning:
            held[0] -= 1
            if not held[0]:
                del _cleaners[key]
                if held[1] is None:
                    spark.conf.unset(_CLEANUP)
                else:
                    spark.conf.set(_CLEANUP, held[1])


def materialize(df, name: str = "table"):
    """Write ``df`` once as parquet below the shared checkpoint folder and read it back.

    One pass to write (no recomputation), columnar reads with pruning and
    pushdown afterwards, and the lineage is cut: a lost executor re-reads the
    written files instead of replaying the upstream joins, whose shuffle files go when the table is written.
    """
    import uuid

    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    with shuffles_end_with_their_job(spark):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
