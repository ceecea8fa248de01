"""Structured Streaming versions of the daily rollup and the snapshot loader.

* ``daily_rollup_stream``  hourly readings -> finalised day rows. Event time
  is the local wall-clock reading time cast to TIMESTAMP through the UTC
  session zone (so day windows are local days); the watermark lets Spark drop
  a day's state once it is closed, and append mode emits each day once.
* ``exact_daily_rollup``   the same day rows through ``foreachBatch``, with a
  watermark per entity: readings of open days are kept in a versioned table
  and closed days are rolled up by the batch rollup, so the exact percentile
  never keeps a day's values in one state row (see ``operators.percentile``).
* ``with_bands``           stream-static range join to the band table.
* ``snapshot_upserts``     new snapshot files -> key-based upsert of a fact
  table, one ``foreachBatch`` call per micro-batch.

Sinks are file sinks with a checkpoint location in the shared checkpoint
folder, so a restarted query resumes where it stopped (exactly-once files).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayframe.functions import any_not_null, surrogate_key
from dayframe.operators import bands as band_ops
from dayframe.operators import incremental
from dayframe.operators.rollup import AQ_AVG_MAX, AQ_P95, AQ_REQUIRE_ANY, hourly_to_daily
from dayframe.sources.sinks import delete, stored, work_tables


def daily_rollup_stream(hourly: DataFrame, delay: str,
                        keys: Sequence[str] = ("location_id", "city_name", "country_code"),
                        ts_col: str = "reading_timestamp",
                        measures: Sequence[str] = AQ_AVG_MAX, p95: Sequence[str] = AQ_P95,
                        require_any: Sequence[str] = AQ_REQUIRE_ANY) -> DataFrame:
    """Streaming hourly -> daily rollup with the batch rollup's columns.

    Readings of days that closed more than ``delay`` before the newest reading
    are dropped, so ``delay`` must cover the latest arrival.
    """
    ev = hourly.withColumn("__event_time", F.col(ts_col).cast("timestamp")) \
        .withWatermark("__event_time", delay)
    if require_any:
        ev = ev.filter(any_not_null(*require_any))
    aggs = []
    for m in measures:
        aggs += [F.avg(m).alias(f"avg_{m}"), F.max(m).alias(f"max_{m}")]
        if m in p95:
            aggs.append(F.percentile(F.col(m), F.lit(0.95)).alias(f"p95_{m}"))
    aggs.append(F.count(F.lit(1)).alias("hourly_readings_count"))
    out = ev.groupBy(F.window("__event_time", "1 day"), *keys).agg(*aggs)
    day = F.to_date(F.col("window.start"))
    return out.select(*keys, day.alias("air_quality_date"),
                      *[c for c in out.columns if c not in ("window", *keys)]) \
        .withColumn("air_quality_daily_sk", surrogate_key("location_id", "air_quality_date"))


def exact_daily_rollup(hourly: DataFrame, base: str, checkpoint: str, delay: dt.timedelta,
                       ts_col: str = "reading_timestamp",
                       finish: Callable[[DataFrame], DataFrame] | None = None,
                       date_col: str = "air_quality_date", entity: str = "location_id",
                       idle: dt.timedelta | None = None) -> str:
    """Stream hourly readings into finalised day rows under ``base + "/days"``.

    Every entity has a watermark of its own: its newest reading less ``delay``.
    A day of an entity is closed once its end is at or before that, so an entity
    whose readings arrive long after the others' loses none. ``idle`` limits
    the wait for silent entities: days also close once they ended ``idle`` or
    more before the newest reading of all (None: never). Closed days are rolled up with
    ``hourly_to_daily`` (distributed exact percentile), passed through ``finish``
    (e.g. a band join) and written. Readings for days already emitted are
    dropped, as a watermarked aggregation would drop them. Processes what is
    available now, then returns the output path.
    """

    def load(batch: DataFrame, epoch: int) -> None:
        finalise_closed_days(batch, epoch, base, delay, ts_col, finish, date_col, entity, idle)

    q = (hourly.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return base + "/days"


def _versions(spark: SparkSession, path: str) -> list[int]:
    """The complete versions (folders ``v=<epoch>``) under a path."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [(s.getPath().getName(), s.getPath().toString()) for s in fs.listStatus(folder)]
    return sorted(int(n[2:]) for n, full in names
                  if n.startswith("v=") and fs.exists(hadoop.Path(full + "/_SUCCESS")))


def finalise_closed_days(batch: DataFrame, epoch: int, base: str, delay: dt.timedelta,
                         ts_col: str = "reading_timestamp",
                         finish: Callable[[DataFrame], DataFrame] | None = None,
                         date_col: str = "air_quality_date", entity: str = "location_id",
                         idle: dt.timedelta | None = None) -> None:
    """One micro-batch of ``exact_daily_rollup``.

    ``pending/v=<epoch>`` holds the readings of open days after the batch and
    ``state/v=<epoch>`` one row an entity (newest reading, first open day). Each
    batch reads the version before and writes its own, then deletes older ones,
    so both stay as large as what is open. Emitted days go to
    ``days/_batch=<epoch>``, which a replay of the batch replaces.
    """
    spark = batch.sparkSession
    pending, state, out = base + "/pending", base + "/state", base + "/days"
    before = [v for v in _versions(spark, state) if v < epoch]
    with work_tables(spark):
        rows = stored(batch.withColumn("__day", F.to_date(F.col(ts_col))), "batch")
        newest = rows.groupBy(entity).agg(F.max(ts_col).alias("newest"))
        if before:
            last = spark.read.parquet(f"{state}/v={before[-1]}")
            open_from = last.select(F.col(entity).alias("__entity"), "open_from")
            rows = rows.join(open_from, rows[entity].eqNullSafe(open_from["__entity"]), "left").where(
                F.col("open_from").isNull() | (F.col("__day") >= F.col("open_from"))).drop(
                "__entity", "open_from")
            rows = rows.unionByName(spark.read.schema(rows.schema).parquet(
                f"{pending}/v={before[-1]}"))
            newest = newest.withColumn("open_from", F.lit(None).cast("date")).unionByName(last)
            newest = newest.groupBy(entity).agg(F.max("newest").alias("newest"),
                                                F.max("open_from").alias("open_from"))
        else:
            newest = newest.withColumn("open_from", F.lit(None).cast("date"))
        close = F.to_date(F.col("newest") - F.lit(delay))  # days before this one have ended
        if idle is not None:
            latest = newest.select(F.max("newest")).scalar()
            close = F.greatest(close, F.to_date(latest - F.lit(idle)))
        after = stored(newest.select(entity, "newest", F.greatest("open_from", close).alias(
            "open_from")), "state")
        first_open = after.select(F.col(entity).alias("__entity"), "open_from")
        judged = stored(rows.join(first_open, rows[entity].eqNullSafe(first_open["__entity"]),
                                  "left").withColumn("__closed", F.col("__day") < F.col(
                                      "open_from")).drop("__entity", "open_from"), "judged")
        ready = judged.where("__closed").drop("__closed", "__day")
        if not ready.isEmpty():
            days = hourly_to_daily(ready, ts_col=ts_col, date_alias=date_col)
            (finish(days) if finish else days).write.mode("overwrite").parquet(
                f"{out}/_batch={epoch}")
        judged.where("not coalesce(__closed, false)").drop("__closed").write.mode(
            "overwrite").parquet(f"{pending}/v={epoch}")
        after.write.mode("overwrite").parquet(f"{state}/v={epoch}")  # makes the version complete
    for v in before[:-1]:
        delete(spark, f"{state}/v={v}")
        delete(spark, f"{pending}/v={v}")


def read_days(spark: SparkSession, out: str) -> DataFrame:
    """The emitted days."""
    return spark.read.option("basePath", out).parquet(out).drop("_batch")


def with_bands(daily: DataFrame, band_table: DataFrame, value: str = "avg_european_aqi") -> DataFrame:
    """Stream-static left range join (the static side is the small band table)."""
    b = band_table.select("band_order", "aqi_band", "aqi_min", "aqi_max")
    return band_ops.range_join(daily, value, b).drop("aqi_min", "aqi_max")


def run_to_parquet(df: DataFrame, path: str, checkpoint: str, output_mode: str = "append") -> None:
    """Process everything available now into a Parquet sink, then stop."""
    q = (df.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode(output_mode)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def snapshot_upserts(spark: SparkSession, snapshot_dir: str, schema: T.StructType, target: str,
                     key: str, checkpoint: str, partition_by: Sequence[str],
                     drop: Sequence[str] = ()) -> None:
    """Load snapshot partitions as they land and upsert them into ``target``;
    only the target's partitions that a batch touches are written again."""
    stream = spark.readStream.schema(schema).parquet(snapshot_dir)

    def load(batch: DataFrame, _epoch: int) -> None:
        incremental.upsert_by_key(batch.sparkSession, batch.drop(*drop), target, key,
                                  partition_by)

    q = (stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
