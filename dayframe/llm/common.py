"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dayframe.session import scratch_path
from dayframe.sources import sinks

# A word is a maximal run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

# Groups with more than 1/HOT_PARTS of all rows are joined by broadcast: there are fewer than
# HOT_PARTS such groups, whatever the input's size.
HOT_PARTS = 2048


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text as an array, in order; empty for a text without words."""
    return F.array_remove(F.split(text, SPACE), "")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shared_path(spark: SparkSession, what: str) -> str:
    """A new path in the folder that driver and executors share."""
    return scratch_path(spark, "llm", f"{what}-{uuid.uuid4().hex}")


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: a lost executor then costs a re-read, and what the plan above computes is
    computed once however often the table is used. The table stays until the surrounding
    ``work_tables`` block ends, or for good without one.
    """
    return sinks.stored(df, what, "llm")


def filesystem(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a URI or absolute path, and the path in it (usable inside tasks)."""
    return pa.fs.FileSystem.from_uri(path)


def running_total(df: DataFrame, group: Sequence[str], bucket: str, order: Sequence[Column],
                  value: Column, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of the same group that come before.

    Rows are ordered by ``bucket`` and, inside it, by ``order``. A group is never sorted in one
    task: bucket totals give each bucket's offset, and only a bucket's rows are sorted together.
    With about sqrt(rows) buckets both steps handle about sqrt(rows) rows of a group.
    """
    keys = [*group, bucket]
    totals = df.groupBy(*keys).agg(F.sum(value).alias("__total"))
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(k).alias(f"__o_{k}") for k in keys], F.coalesce(
        F.sum("__total").over(before), F.lit(0)).alias("__offset"))
    on = None
    for k in keys:
        same = df[k].eqNullSafe(offsets[f"__o_{k}"])
        on = same if on is None else on & same
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1)
    joined = df.join(offsets, on).drop(*[f"__o_{k}" for k in keys])
    return joined.withColumn(name, F.col("__offset") + F.coalesce(
        F.sum(value).over(inside), F.lit(0))).drop("__offset")


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """Inner join of every row with its group's row, whatever share of the rows a group holds.

    ``groups`` has one row per ``key`` with its number of rows in ``size``. Groups with more than
    1/HOT_PARTS of the rows (fewer than HOT_PARTS of them) are broadcast, so that their rows stay
    where they are; no other group is large enough to make one task slow. If there are no more
    than HOT_PARTS groups, all are broadcast. Both inputs are read twice: pass stored tables. NULL
    keys match NULL keys.
    """
    if groups.limit(HOT_PARTS + 1).count() <= HOT_PARTS:
        few = F.broadcast(groups.withColumnRenamed(key, "__key"))
        return rows.join(few, F.col(key).eqNullSafe(F.col("__key")), "inner").drop("__key")
    total = groups.agg(F.sum(size).alias("n")).first()["n"] or 0
    hot = F.col(size) * HOT_PARTS > F.lit(total)
    small = groups.withColumnRenamed(key, "__key")
    on = F.col(key).eqNullSafe(F.col("__key"))
    few = F.broadcast(small.where(hot))
    a = rows.join(few, on, "inner")
    b = rows.join(F.broadcast(small.where(hot).select("__key")), on, "left_anti").join(
        small.where(~hot), on, "inner")
    return a.unionByName(b).drop("__key")


def numbered(df: DataFrame, order: Sequence[str], values: Sequence[str], what: str) -> DataFrame:
    """Add ``<v>_before`` for each long column ``v`` of ``values``: its sum over all rows that come
    before in the order of ``order``.

    One range-partitioned sort; each task sums its own rows, and the offsets of the partitions
    (one row each) are joined afterwards. ``order`` must be unique enough to split hot values.
    """
    local = pa.schema([("__part", pa.int32()), *[(f"{v}_before", pa.int64()) for v in values]])
    names = list(values)

    def number(batches):
        import numpy as np
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        seen = dict.fromkeys(names, 0)
        for b in batches:
            cols = [pa.array(np.full(b.num_rows, part, np.int32))]
            for v in names:
                x = b.column(v).to_numpy(zero_copy_only=False).astype(np.int64)
                ends = np.cumsum(x) + seen[v]
                cols.append(pa.array(ends - x))
                seen[v] = int(ends[-1]) if len(ends) else seen[v]
            yield pa.RecordBatch.from_arrays([*b.columns, *cols],
                                             names=[*b.schema.names, *local.names])

    fields = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields],
                        "__part int", *[f"`{v}_before` bigint" for v in values]])
    parts = stored(df.repartitionByRange(*order).sortWithinPartitions(*order)
                   .mapInArrow(number, fields), what)
    totals = parts.groupBy("__part").agg(*[F.sum(v).alias(f"__{v}") for v in values])
    w = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("__part").alias("__p"), *[
        F.coalesce(F.sum(f"__{v}").over(w), F.lit(0)).alias(f"__o_{v}") for v in values])
    joined = parts.join(F.broadcast(offsets), F.col("__part") == F.col("__p"))  # a row a partition
    return joined.select(*[F.col(c) for c in df.columns], *[
        (F.col(f"{v}_before") + F.col(f"__o_{v}")).alias(f"{v}_before") for v in values])
