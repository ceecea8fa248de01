"""Consecutive-run lengths of boolean day flags (gaps and islands).

For each flag the island id is ``row_number() over (entity order by day)``
minus ``row_number() over (entity, flag order by day)``; it is constant along a
run of equal flag values, so ``count(*) over (entity, flag, island)`` is the
run length. All windows are partitioned by the entity first, so Spark plans a
single exchange on the entity and only re-sorts inside partitions.

Rows per entity are bounded by the number of calendar days (the input is an
entity-day table produced by an aggregate), so an entity partition stays small
however large the raw data is; a hot entity makes one long series, not an
unbounded group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RunSpec:
    flag: str          # boolean column
    streak: str        # output: run length on flagged rows, else 0
    label: str         # output: flag AND run length >= min_len
    min_len: int


WEATHER_RUNS = (
    RunSpec("is_hot", "heat_streak", "in_heatwave", 3),
    RunSpec("is_freezing", "cold_streak", "in_cold_snap", 3),
    RunSpec("is_heavy_rain", "wet_streak", "in_wet_spell", 2),
)


def run_lengths(df: DataFrame, entity: str, order: str, runs=WEATHER_RUNS,
                contiguous: bool = False) -> DataFrame:
    """Add streak and label columns for every ``RunSpec``.

    ``contiguous=False`` (default) counts consecutive rows, so a missing day
    does not break a run. ``contiguous=True`` counts consecutive calendar days:
    the island id is then ``day - row_number() over (entity, flag)``.
    A NULL flag forms its own runs, gets streak 0 and a label that is FALSE or
    NULL by three-valued AND.
    """
    out = df
    if not contiguous:
        out = out.withColumn("__rn_all", F.row_number().over(
            Window.partitionBy(entity).orderBy(order)))
    for r in runs:
        rn_flag = F.row_number().over(Window.partitionBy(entity, r.flag).orderBy(order))
        if contiguous:
            base = F.datediff(F.col(order), F.lit("1970-01-01").cast("date"))
        else:
            base = F.col("__rn_all")
        island = f"__island_{r.flag}"
        run_len = f"__run_{r.flag}"
        out = out.withColumn(island, base - rn_flag)
        out = out.withColumn(run_len, F.count(F.lit(1)).over(
            Window.partitionBy(entity, r.flag, island)))
        out = out.withColumns({
            r.streak: F.when(F.col(r.flag), F.col(run_len)).otherwise(F.lit(0).cast("long")),
            r.label: F.col(r.flag) & (F.col(run_len) >= F.lit(r.min_len)),
        })
        out = out.drop(island, run_len)
    return out.drop("__rn_all") if not contiguous else out
