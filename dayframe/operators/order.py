"""Ordering operators: top-k, top+bottom, arg-max per group, positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LOW33 = (1 << 33) - 1


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First k rows in ``order`` (TakeOrderedAndProject: a per-partition top-k
    then a merge of k rows per partition; the input is never fully sorted)."""
    return df.orderBy(*order).limit(k)


def top_k_with_position(df: DataFrame, order: Sequence[Column], k: int,
                        name: str = "position") -> DataFrame:
    """Top k plus a 1-based position. The window runs on the k-row result only."""
    top = top_k(df, order, k)
    return top.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def with_position(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """1-based position of every row in ``order``, computed distributed.

    The rows are range-partitioned and sorted by Spark; each row gets
    (partition, index within partition) from ``monotonically_increasing_id``;
    the sorted rows are checkpointed to the shared checkpoint folder so the ids
    are fixed; per-partition counts (one row per partition, a proven small
    table) give each partition's offset. No step holds all rows in one task.
    ``order`` must be a total order (end it with a key) for stable positions.
    """
    spark = df.sparkSession
    from dayframe.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    ranked = df.orderBy(*order).withColumn("__mid", F.monotonically_increasing_id()).checkpoint()
    pid = F.shiftrightunsigned(F.col("__mid"), 33)
    counts = ranked.groupBy(pid.alias("__pid")).agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.withColumn(
        "__off",
        F.coalesce(F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)))
    out = ranked.withColumn("__pid", pid).join(F.broadcast(offsets.select("__pid", "__off")), "__pid")
    return out.withColumn(name, F.col("__off") + F.col("__mid").bitwiseAND(F.lit(_LOW33)) + 1) \
        .drop("__mid", "__pid", "__off")


def top_and_bottom(df: DataFrame, order: Sequence[Column], reverse: Sequence[Column],
                   top: int = 10, bottom: int = 5, only_above: int = 16) -> DataFrame:
    """All rows when there are at most ``only_above``; else the first ``top``
    plus the last ``bottom`` rows. The row count is a scalar subquery, both
    halves are top-k operators; nothing is collected."""
    n = df.select(F.count(F.lit(1))).scalar()
    small = df.filter(n <= F.lit(only_above)).withColumn("part", F.lit("all"))
    head = top_k(df, order, top).withColumn("part", F.lit("top"))
    tail = top_k(df, reverse, bottom).withColumn("part", F.lit("bottom"))
    big = head.unionByName(tail).filter(n > F.lit(only_above))
    return small.unionByName(big)


def arg_max_by_group(df: DataFrame, group: Sequence[str], value: str,
                     order: Sequence[Column], alias: str) -> DataFrame:
    """``value`` of the row with the greatest ``order`` struct per group
    (partial aggregation; no sort of the group's rows)."""
    return df.groupBy(*group).agg(F.max_by(F.col(value), F.struct(*order)).alias(alias))
