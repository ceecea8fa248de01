"""Forecast vs actual alignment and error measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayframe.functions import surrogate_key

# forecast measure -> (output suffix)
ALIGNED = [
    ("temperature_2m_max", "temp_max"),
    ("temperature_2m_min", "temp_min"),
    ("temperature_2m_mean", "temp_mean"),
    ("precipitation_sum", "precipitation"),
    ("wind_speed_10m_max", "wind_speed_max"),
]
SIGNED_ERRORS = [
    ("temperature_2m_max", "temperature_max_error"),
    ("temperature_2m_min", "temperature_min_error"),
    ("temperature_2m_mean", "temperature_mean_error"),
    ("precipitation_sum", "precipitation_error"),
    ("wind_speed_10m_max", "wind_speed_error"),
]


def align(forecast: DataFrame, actual: DataFrame) -> DataFrame:
    """Inner join on (location_id, date); signed (forecast - actual) and
    absolute errors. Both sides are large facts, so the join is a shuffle
    join on the composite key (AQE splits skewed keys)."""
    f = forecast.alias("f")
    a = actual.alias("a")
    joined = f.join(a, (F.col("f.location_id") == F.col("a.location_id"))
                    & (F.col("f.forecast_date") == F.col("a.weather_date")), "inner")
    cols = [
        F.col("f.location_id").alias("location_id"),
        F.col("f.city_name").alias("city_name"),
        F.col("f.country_code").alias("country_code"),
        F.col("f.forecast_date").alias("forecast_date"),
        F.col("f.extracted_at").alias("forecast_extracted_at"),
    ]
    cols += [F.col(f"f.{m}").alias(f"forecast_{s}") for m, s in ALIGNED]
    cols += [F.col(f"a.{m}").alias(f"actual_{s}") for m, s in ALIGNED]
    cols += [(F.col(f"f.{m}") - F.col(f"a.{m}")).alias(n) for m, n in SIGNED_ERRORS]
    cols += [
        F.abs(F.col("f.temperature_2m_mean") - F.col("a.temperature_2m_mean")).alias("abs_temperature_error"),
        F.abs(F.col("f.precipitation_sum") - F.col("a.precipitation_sum")).alias("abs_precipitation_error"),
    ]
    out = joined.select(*cols)
    return out.withColumn("forecast_vs_actual_sk",
                          surrogate_key("location_id", "forecast_date", "forecast_extracted_at"))


def forecast_fact(aligned: DataFrame) -> DataFrame:
    """Fact grain: location x forecast date x snapshot."""
    return aligned.select(
        surrogate_key("location_id", "forecast_date", "forecast_extracted_at").alias("forecast_city_day_sk"),
        surrogate_key("location_id").alias("location_sk"),
        *[c for c in aligned.columns if c != "forecast_vs_actual_sk"],
    )


def mean_abs_error(fact: DataFrame, by: str = "city_name",
                   metric: str = "abs_temperature_error") -> DataFrame:
    """Group mean of an error after dropping rows where it is NULL."""
    return fact.dropna(subset=[metric]).groupBy(by).agg(F.avg(metric).alias(metric))
