"""Deviation of a value from its group's mean, in units and in standard deviations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayframe.functions import sql_round
from dayframe.operators.joins import join_back


def group_stats(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Mean and sample standard deviation of ``value`` per key group."""
    return df.groupBy(*keys).agg(
        F.avg(value).alias("__mean"),
        F.stddev_samp(value).alias("__sd"),
    )


def group_zscore(df: DataFrame, keys: Sequence[str], value: str, k: float = 2.0) -> DataFrame:
    """Adds season_mean_c, anomaly_c, anomaly_z and is_extreme_day.

    The group statistics are a partial-then-final aggregate joined back on the
    keys, instead of an unordered window: no sort of the detail rows, and a
    hot group is pre-aggregated on the map side. ``is_extreme_day`` compares
    the unrounded |z| with ``k`` (inclusive); a single-row group or zero
    variance gives NULL z and NULL flag.
    """
    stats = group_stats(df, keys, value)
    joined = join_back(df, stats, list(keys))
    dev = F.col(value) - F.col("__mean")
    z = dev / F.nullif(F.col("__sd"), F.lit(0.0))
    return joined.withColumns({
        "season_mean_c": sql_round(F.col("__mean"), 1),
        "anomaly_c": sql_round(dev, 1),
        "anomaly_z": sql_round(z, 2),
        "is_extreme_day": F.abs(dev) / F.nullif(F.col("__sd"), F.lit(0.0)) >= F.lit(float(k)),
    }).drop("__mean", "__sd")
