"""Spark session settings shared by tests, bench and library helpers."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

DEFAULT_CONF = {
    # Time semantics: local wall-clock readings stay TIMESTAMP_NTZ; instants
    # such as extraction times are interpreted in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # join partitions, switch to broadcast when a side turns out small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Without this every Column call asks the JVM several times for its call site, which is
    # most of the time that building a plan takes.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "dayframe", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster the master and shuffle partitions come from spark-submit; the
    arguments are only for local runs and tests.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (distributed) folder there; it is only set here
    when absent, which happens in local tests. Without it, only a local master
    may go on: executors on other machines would not see a local folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local") or \
                spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = os.environ.get("DAYFRAME_CHECKPOINT_DIR", "/tmp/dayframe-checkpoints")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def path_missing(error: AnalysisException) -> bool:
    """Whether an analysis failed because there is no such path, or no file in it."""
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder, for tables a job writes and re-reads."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "dayframe", *parts])
