"""Cast-and-rename projections of the four raw tables (one grain each)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayframe.functions import surrogate_key


def _cast(name: str, type_: str, alias: str | None = None):
    return F.col(name).cast(type_).alias(alias or name)


def _instant(name: str):
    """Extraction time as a zone-less UTC timestamp (text with an offset, or
    TIMESTAMP, is converted through the UTC session zone)."""
    return F.col(name).cast("timestamp").cast("timestamp_ntz").alias(name)


def stage_locations(raw: DataFrame) -> DataFrame:
    """Grain: one row per location; adds ``location_sk``."""
    return raw.select(
        _cast("location_id", "int"),
        _cast("city_name", "string"),
        _cast("country", "string"),
        _cast("country_code", "string"),
        _cast("admin1", "string"),
        _cast("latitude", "double"),
        _cast("longitude", "double"),
        _cast("timezone", "string"),
        _cast("elevation", "double"),
        _cast("population", "int"),
        _instant("extracted_at"),
        surrogate_key("location_id").alias("location_sk"),
    )


DAILY_MEASURES = ["temperature_2m_max", "temperature_2m_min", "temperature_2m_mean",
                  "precipitation_sum", "rain_sum", "snowfall_sum", "wind_speed_10m_max"]


def _stage_daily(raw: DataFrame, date_alias: str, key_cols: list[str], sk_name: str) -> DataFrame:
    return raw.select(
        _cast("location_id", "int"),
        _cast("city_name", "string"),
        _cast("country_code", "string"),
        _cast("date", "date", date_alias),
        _cast("latitude", "double"),
        _cast("longitude", "double"),
        _cast("timezone", "string"),
        *[_cast(m, "double") for m in DAILY_MEASURES],
        _instant("extracted_at"),
        surrogate_key(*key_cols).alias(sk_name),
    )


def stage_weather_daily(raw: DataFrame) -> DataFrame:
    """Grain: location x day; ``source_name`` is dropped."""
    return _stage_daily(raw, "weather_date", ["location_id", "date"], "weather_daily_sk")


def stage_forecast_daily(raw: DataFrame) -> DataFrame:
    """Grain: location x day x extraction run."""
    return _stage_daily(raw, "forecast_date", ["location_id", "date", "extracted_at"],
                        "forecast_daily_sk")


HOURLY_MEASURES = ["pm10", "pm2_5", "carbon_monoxide", "nitrogen_dioxide", "ozone", "european_aqi"]


def stage_air_quality_hourly(raw: DataFrame) -> DataFrame:
    """Grain: location x local hour. Readings stay zone-less (local wall clock)."""
    return raw.select(
        _cast("location_id", "int"),
        _cast("city_name", "string"),
        _cast("country_code", "string"),
        _cast("timestamp", "timestamp_ntz", "reading_timestamp"),
        _cast("latitude", "double"),
        _cast("longitude", "double"),
        _cast("timezone", "string"),
        *[_cast(m, "double") for m in HOURLY_MEASURES],
        _instant("extracted_at"),
        surrogate_key("location_id", "timestamp").alias("air_quality_hourly_sk"),
    )
