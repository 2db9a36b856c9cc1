"""Session and scratch-space helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str, cores: int | str = 8) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("OFFERLOOM_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        # call-site capture costs a JVM round trip per column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    Only when no such folder is configured (tests, local runs) a machine-local
    one is created.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        base = tempfile.mkdtemp(prefix="offerloom-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame, columns: list[str] | None = None, waves: int = 1) -> DataFrame:
    """Use all cores for work that is heavy per row.

    A small file gives few input splits; only then the narrow rows are
    redistributed before the heavy step. With as many splits as cores, which
    is any large input, the plan is left alone. ``waves`` asks for that many
    tasks per core, where the work behind each row is so heavy that one task
    per core would run for long.
    """
    tasks = df.sparkSession.sparkContext.defaultParallelism * waves
    if df.rdd.getNumPartitions() >= tasks:
        return df
    return df.repartition(tasks, *(columns or []))
