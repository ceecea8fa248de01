"""Incremental fact tables: high-water-mark append and key-based upsert.

A table is a Parquet folder, partitioned by columns that a row's key
determines (a date that is part of the key, say). An upsert replaces only the
partitions that its rows fall in, with Spark's dynamic partition overwrite;
the files of all other partitions are neither read nor written.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from dayframe.session import path_missing
from dayframe.sources.sinks import stored, work_tables

FIRST_RUN_FLOOR = dt.datetime(1900, 1, 1)
# Up to this many touched partitions are named in the reading filter, which
# prunes the folders before any join; the join that follows does without.
NAMED_PARTITIONS = 10_000


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The table's rows, or None if there is no table yet.

    With ``schema`` no file is opened to learn the columns, and those that old
    files lack are NULL; without it the files' schemas are merged.
    """
    try:
        if schema is None:
            return spark.read.option("mergeSchema", "true").parquet(path)
        df = spark.read.schema(schema).parquet(path)
        return df.select(*schema.fieldNames())
    except AnalysisException as e:
        if path_missing(e):
            return None
        raise


def high_water_mark(spark: SparkSession, path: str, ts_col: str) -> dt.datetime:
    """max(ts_col) of the target, or 1900-01-01 when the target is empty/missing.

    Evaluated eagerly (a one-row aggregate) so the incremental filter becomes
    a literal that Spark pushes into the source scan.
    """
    target = read_table(spark, path)
    if target is None:
        return FIRST_RUN_FLOOR
    v = target.agg(F.max(ts_col)).first()[0]
    return v if v is not None else FIRST_RUN_FLOOR


def append_new(spark: SparkSession, new_rows: DataFrame, path: str, ts_col: str,
               partition_by: Sequence[str] = ()) -> None:
    """Insert rows strictly newer than the target's high-water mark.

    First run (no target) takes everything. Rows whose timestamp is not newer
    than the mark are never inserted, even when their key is absent from the
    target (see ``upsert_by_key``). Columns that the target lacks are added:
    its older rows read them as NULL.
    """
    hwm = high_water_mark(spark, path, ts_col)
    new_rows.filter(F.col(ts_col) > F.lit(hwm)).write.mode("append").partitionBy(
        *partition_by).parquet(path)


def _same(left: DataFrame, right: DataFrame, columns: dict[str, str]) -> Column:
    return reduce(Column.__and__, [left[a].eqNullSafe(right[b]) for a, b in columns.items()])


def touched(current: DataFrame, batch: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The rows of ``current`` in partitions that ``batch`` has rows in."""
    values = batch.select(*partition_by).distinct()
    first = partition_by[0]
    named = [r[0] for r in values.select(first).distinct().limit(NAMED_PARTITIONS + 1).collect()]
    if len(named) <= NAMED_PARTITIONS:
        here = F.col(first).isin([v for v in named if v is not None])
        current = current.where(here | F.col(first).isNull() if None in named else here)
    other = values.select(*[F.col(c).alias(f"__p_{c}") for c in partition_by])
    return current.join(other, _same(current, other, {c: f"__p_{c}" for c in partition_by}), "left_semi")


def upsert_by_key(spark: SparkSession, new_rows: DataFrame, path: str, key: str,
                  partition_by: Sequence[str]) -> None:
    """Replace rows whose key appears in ``new_rows``, keep the others.

    Each partition that the new rows fall in is written again as (its rows LEFT
    ANTI JOIN new ON key) UNION new; the others keep their files. A key must
    determine its partition, since a row's older version is only looked for
    there. Columns missing on either side are filled with NULL. NULL keys and
    partition values match each other. Running it twice with the same rows gives
    the same table, also after a run that broke off.
    """
    with work_tables(spark):
        batch = stored(new_rows, "upsert")
        current = read_table(spark, path)
        if current is None:
            merged = batch
        else:
            for c in partition_by:  # folder names do not keep the type
                current = current.withColumn(c, F.col(c).cast(new_rows.schema[c].dataType))
            fresh = batch.select(F.col(key).alias("__key"))
            old = touched(current, batch, partition_by)
            kept = old.join(fresh, old[key].eqNullSafe(fresh["__key"]), "left_anti")
            # written before the partitions are replaced, so that they can be restored from it
            merged = stored(kept.unionByName(batch, allowMissingColumns=True), "upsert-merged")
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            *partition_by).parquet(path)
