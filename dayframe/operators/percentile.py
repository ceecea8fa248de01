"""Exact continuous percentiles that stay distributed for hot groups.

``F.percentile`` keeps one value->count map per group and merges it in the
task that finalises the group, so a group holding a large share of all rows
lands in one task's memory. ``grouped_percentiles`` reads its input once and
works on one stored count table:

1. Equal values of a group and measure are collapsed to counts (partial
   aggregate). The counts are sorted by (group, measure, value) over range
   partitions, which also split a hot group, and are written once.
2. Per (group, measure, range partition) the counts are summed; running sums
   over a group's few partitions say which of them hold the two ranks around
   ``pos = q * (n - 1)``.
3. Only those partitions' rows are numbered, each partition by itself, and
   give the two values; then linear interpolation
   ``(ceil(pos) - pos) * lo + (pos - floor(pos)) * hi``.

No Python step. A window never holds more than one range partition of a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayframe.sources.sinks import stored


def _joined(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on the keys, NULL matching NULL; keeps the left side's keys."""
    other = right.select(*[F.col(k).alias(f"__j_{k}") for k in keys],
                         *[c for c in right.columns if c not in keys])
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(other[f"__j_{k}"])
    return left.join(other, on, "inner").drop(*[f"__j_{k}" for k in keys])


def grouped_percentiles(df: DataFrame, keys: Sequence[str], values: Sequence[str], q: float,
                        alias: str = "p_{}") -> DataFrame:
    """One row per group of ``keys``: the exact ``q`` percentile of each value
    column (NULLs ignored), named by ``alias``. Equal to ``F.percentile``
    bit for bit. A column with no value in a group gives NULL; a group with
    no value in any column has no row (callers left-join their groups).

    The count table is computed and written when this is called."""
    if not 0.0 <= q <= 1.0:
        raise ValueError("q must be in [0, 1]")
    keys = list(keys)
    numbers = range(len(values))
    entries = F.array_compact(F.array(*[
        F.when(F.col(v).isNotNull(), F.struct(F.lit(i).alias("__m"), F.col(v).cast("double").alias("__v")))
        for i, v in enumerate(values)]))
    order = [*keys, "__m", "__v"]
    counts = df.select(*keys, F.inline(entries)).groupBy(*order).agg(F.count("*").alias("__c"))
    table = stored(counts.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "__part", F.spark_partition_id()), "percentile")

    by_part = [*keys, "__m", "__part"]
    earlier = Window.partitionBy(*keys, "__m").orderBy("__part").rowsBetween(
        Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys, "__m")
    places = table.groupBy(*by_part).agg(F.sum("__c").alias("__n")).select(
        *by_part, "__n", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
        ((F.sum("__n").over(whole) - F.lit(1)).cast("double") * F.lit(float(q))).alias("__pos"))
    places = places.withColumns({"__k1": F.floor("__pos"), "__k2": F.ceil("__pos")}).where(
        (F.col("__before") <= F.col("__k2")) & (F.col("__k1") < F.col("__before") + F.col("__n")))
    inside = Window.partitionBy(*by_part).orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    near = _joined(table, places.drop("__n"), by_part).withColumn(
        "__at", F.col("__before") + F.coalesce(F.sum("__c").over(inside), F.lit(0)))

    def covers(k: str):
        return (F.col("__at") <= F.col(k)) & (F.col(k) < F.col("__at") + F.col("__c"))

    found = near.groupBy(*keys).agg(*[
        F.max(F.when((F.col("__m") == i) & condition, F.col(column))).alias(f"__{name}{i}")
        for i in numbers for name, condition, column in (
            ("lo", covers("__k1"), "__v"), ("hi", covers("__k2"), "__v"),
            ("pos", F.lit(True), "__pos"))])

    def value(i: int):
        lo, hi, pos = F.col(f"__lo{i}"), F.col(f"__hi{i}"), F.col(f"__pos{i}")
        # same arithmetic as Spark's own percentile, so both agree bit for bit
        return F.when(F.floor(pos) == F.ceil(pos), lo).otherwise(
            (F.ceil(pos) - pos) * lo + (pos - F.floor(pos)) * hi)

    return found.select(*keys, *[value(i).alias(alias.format(v)) for i, v in enumerate(values)])
