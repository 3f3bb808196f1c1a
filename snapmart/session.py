"""Spark session settings and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "snapmart", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """A session with UTC timestamps and adaptive execution.

    On a cluster leave ``master`` and the sizing settings to the submit command;
    they are set here only for local runs.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master is not None:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = (
                builder.config("spark.sql.shuffle.partitions", "8")
                .config("spark.ui.enabled", "false")
                .config("spark.driver.bindAddress", "127.0.0.1")
                .config("spark.driver.host", "127.0.0.1")
            )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder that ``DataFrame.checkpoint`` writes to, named in ``spark.checkpoint.dir``.

    On a cluster it must be set to a folder that all executors share. Only a local
    session may leave it out; it then gets a folder that is removed when it ends.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="snapmart-checkpoint-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return folder


@contextmanager
def held(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` kept by the executors while the block runs; lost parts are worked out again."""
    kept = df.persist()
    try:
        yield kept
    finally:
        kept.unpersist()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
