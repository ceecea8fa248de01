"""Threshold flags and the composite comfort flag on an entity-day table.

Flags are nullable booleans: a NULL measure gives a NULL flag, which
``count_if`` does not count and which propagates through AND/NOT.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class DayRules:
    """Which column and threshold defines each day type.

    Defaults are the weather definitions: rainy rain > 1 mm, windy wind > 40
    km/h, hot max > 35 C, freezing min < 0 C (all strict), heavy rain >= 20 mm
    (inclusive), comfortable mean in [18, 26] C and none of the four flags.
    """

    max_col: str = "temperature_2m_max"
    min_col: str = "temperature_2m_min"
    mean_col: str = "temperature_2m_mean"
    rain_col: str = "rain_sum"
    wind_col: str = "wind_speed_10m_max"
    heavy_col: str = "rain_sum"
    rainy_above: float = 1.0
    windy_above: float = 40.0
    hot_above: float = 35.0
    freezing_below: float = 0.0
    heavy_at_least: float = 20.0
    comfort_low: float = 18.0
    comfort_high: float = 26.0
    heatwave_min_days: int = 3
    cold_snap_min_days: int = 3
    wet_spell_min_days: int = 2


WEATHER = DayRules()


def threshold_flags(df: DataFrame, rules: DayRules = WEATHER) -> DataFrame:
    """Adds temp_range_c, is_rainy, is_windy, is_hot, is_freezing."""
    r = rules
    return df.withColumns({
        "temp_range_c": F.col(r.max_col) - F.col(r.min_col),
        "is_rainy": F.col(r.rain_col) > F.lit(r.rainy_above),
        "is_windy": F.col(r.wind_col) > F.lit(r.windy_above),
        "is_hot": F.col(r.max_col) > F.lit(r.hot_above),
        "is_freezing": F.col(r.min_col) < F.lit(r.freezing_below),
    })


def heavy_rain_flag(df: DataFrame, rules: DayRules = WEATHER) -> DataFrame:
    return df.withColumn("is_heavy_rain", F.col(rules.heavy_col) >= F.lit(rules.heavy_at_least))


def comfort_flag(df: DataFrame, rules: DayRules = WEATHER) -> DataFrame:
    """is_comfortable = mean BETWEEN low AND high AND NOT each adverse flag."""
    mild = F.col(rules.mean_col).between(F.lit(rules.comfort_low), F.lit(rules.comfort_high))
    cond = mild
    for f in ("is_rainy", "is_windy", "is_hot", "is_freezing"):
        cond = cond & ~F.col(f)
    return df.withColumn("is_comfortable", cond)
