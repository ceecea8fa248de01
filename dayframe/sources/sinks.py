"""Sinks: full replace, described tables, work tables, CSV with header, snapshot partitions."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayframe.functions import path_safe_timestamp
from dayframe.session import scratch_path


def write_table(df: DataFrame, path: str) -> None:
    """Idempotent full replace of a Parquet table."""
    df.write.mode("overwrite").parquet(path)


_SCOPES = threading.local()


@contextmanager
def work_tables(spark: SparkSession) -> Iterator[None]:
    """Delete the work tables made inside when the block ends. Use it around
    code whose results are written before the end."""
    outer, made = getattr(_SCOPES, "made", None), []
    _SCOPES.made = made
    try:
        yield
    finally:
        _SCOPES.made = outer
        for path in made:
            delete(spark, path)


def stored(df: DataFrame, what: str, folder: str = "work") -> DataFrame:
    """Write ``df`` as a Parquet work table in the shared folder and read it back.

    What the plan above computes is computed once however often the table is
    used, and a lost executor costs a re-read of it. The table stays until the
    surrounding ``work_tables`` block ends, or for good without one.
    """
    path = scratch_path(df.sparkSession, folder, f"{what}-{uuid.uuid4().hex}")
    if getattr(_SCOPES, "made", None) is not None:
        _SCOPES.made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def described(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """Attach column descriptions as field metadata, which Parquet keeps."""
    for f in df.schema.fields:
        if f.name in comments:
            df = df.withMetadata(f.name, {**f.metadata, "comment": comments[f.name]})
    return df


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared file system, if it is there."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header row, replacing what was there."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_snapshot(df: DataFrame, path: str, run_col: str = "extracted_at") -> bool:
    """Append the rows as one ``extracted_at=<run>`` partition per run.

    The partition value has ':' replaced by '-' so it is a valid folder name.
    Nothing is written for an empty input (checked with a one-row probe).
    Returns whether anything was written.
    """
    if df.isEmpty():
        return False
    out = df.withColumn(run_col, path_safe_timestamp(run_col))
    out.write.mode("append").partitionBy(run_col).parquet(path)
    return True
