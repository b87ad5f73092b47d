"""Session helpers.

Library functions never create sessions; they take DataFrames. These helpers
exist for tests, the bench and command-line use on a single machine.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "blotter", extra: dict | None = None) -> SparkSession:
    """A local session configured like the tests and the bench.

    Shuffle partitions follow the core count (200 is wrong for one machine),
    AQE stays on so joins and partition counts are re-planned at run time, the
    UI is off, and timestamps are read in UTC.
    """
    n = os.cpu_count() if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.default.parallelism", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BLOTTER_DRIVER_MEMORY", "8g"))
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared file system and is used as is;
    if it is unset there, this raises. Only in local mode (tests, a laptop)
    is a fresh local folder created and registered instead.
    """
    try:
        context = spark.sparkContext
    except Exception:  # a Spark Connect session has no context: use the setting
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder") from None
        return current
    existing = context.getCheckpointDir()
    if existing:
        return existing
    current = context.getConf().get("spark.checkpoint.dir", None)
    if current:
        context.setCheckpointDir(current)
        return context.getCheckpointDir() or current
    # Unset. A local folder is only valid when the whole job runs on this
    # machine (tests, a laptop); on a cluster it must name shared storage.
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or object storage)")
    folder = tempfile.mkdtemp(prefix="blotter-ckpt-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir() or folder


def checkpoint_root(spark: SparkSession) -> str:
    """The configured ``spark.checkpoint.dir`` itself (stable across runs),
    for state that a restarted application must find again, such as the
    progress of a streaming query. ``checkpoint_dir`` instead returns the
    per-session subfolder Spark creates inside it. Falls back to that
    subfolder when the setting is unset (local mode only)."""
    try:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    except Exception:  # Spark Connect: no context
        configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured or checkpoint_dir(spark)
