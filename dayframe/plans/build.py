"""Persisted marts: one build in dependency order, and readers of the result.

Staging and intermediate models are views (plans, evaluated where they are
used); marts are tables. The build writes each mart once, as Parquet with a
description of every column, and later models read it from there instead of
computing it again. ``mart_docs`` holds the marts' own descriptions.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayframe.plans.marts import Marts
from dayframe.sources.readers import read_mart
from dayframe.sources.sinks import described, work_tables, write_table


@dataclass(frozen=True)
class Mart:
    """A table of the build: the tables it is made from, and what it holds."""
    needs: tuple[str, ...]
    description: str


# Marts written at the same time.
WRITERS = 4

# In dependency order.
TABLES = {
    "dim_location": Mart((), "Places with their coordinates and attributes, one row a place"),
    "fct_city_weather_day": Mart((), "Weather of a place and day with its day types"),
    "fct_air_quality_city_day": Mart((), "Air quality of a place and day with its health band"),
    "fct_forecast_city_day": Mart((), "Forecast and actual weather of a place, day and forecast run"),
    "mart_extreme_events": Mart(("fct_city_weather_day",), "Extreme days and longest runs of a place"),
    "mart_temperature_anomaly": Mart(("fct_city_weather_day",),
                                     "Each day's temperature against the place's season"),
    "mart_city_season_summary": Mart(("fct_city_weather_day",), "Weather of a place and season"),
    "mart_city_month_summary": Mart(("fct_city_weather_day",),
                                    "Weather of a place and month of the year"),
    "mart_city_weather_summary": Mart(
        ("dim_location", "fct_city_weather_day", "fct_air_quality_city_day"),
        "Weather, air quality and scores of a place over all days"),
}

# What a column means; the same in every mart that has it.
COLUMNS = {
    "location_sk": "Key of the place (hash of its id)", "location_id": "Id of the place",
    "city_name": "Name of the place", "country": "Country", "country_code": "Code of the country",
    "admin1": "Region in the country", "latitude": "Degrees north", "longitude": "Degrees east",
    "timezone": "Time zone", "elevation": "Metres above sea level", "population": "Inhabitants",
    "city_weather_day_sk": "Key of the place and day", "weather_date": "Local day",
    "season": "Season of the day", "temperature_2m_max": "Highest temperature",
    "temperature_2m_min": "Lowest temperature", "temperature_2m_mean": "Mean temperature",
    "temp_range_c": "Highest less lowest temperature", "precipitation_sum": "Precipitation",
    "rain_sum": "Rain", "snowfall_sum": "Snowfall", "wind_speed_10m_max": "Strongest wind",
    "is_rainy": "More rain than the limit", "is_windy": "More wind than the limit",
    "is_hot": "Highest temperature above the limit",
    "is_freezing": "Lowest temperature below the limit",
    "is_comfortable": "Mild, and neither rainy, windy, hot nor freezing",
    "air_quality_city_day_sk": "Key of the place and day", "air_quality_date": "Local day",
    "avg_pm10": "Mean PM10", "max_pm10": "Highest PM10", "p95_pm10": "95th percentile of PM10",
    "avg_pm2_5": "Mean PM2.5", "max_pm2_5": "Highest PM2.5", "p95_pm2_5": "95th percentile of PM2.5",
    "avg_carbon_monoxide": "Mean CO", "max_carbon_monoxide": "Highest CO",
    "avg_nitrogen_dioxide": "Mean NO2", "max_nitrogen_dioxide": "Highest NO2",
    "avg_ozone": "Mean O3", "max_ozone": "Highest O3", "avg_european_aqi": "Mean air quality index",
    "max_european_aqi": "Highest air quality index",
    "p95_european_aqi": "95th percentile of the air quality index",
    "hourly_readings_count": "Readings of the day", "aqi_band": "Health band of the mean index",
    "aqi_band_order": "Place of the band, best first",
    "forecast_city_day_sk": "Key of the place, day and forecast run",
    "forecast_date": "Day that was forecast", "forecast_extracted_at": "Time of the forecast run",
    "forecast_temp_max": "Forecast highest temperature", "forecast_temp_min": "Forecast lowest temperature",
    "forecast_temp_mean": "Forecast mean temperature", "forecast_precipitation": "Forecast precipitation",
    "forecast_wind_speed_max": "Forecast strongest wind", "actual_temp_max": "Actual highest temperature",
    "actual_temp_min": "Actual lowest temperature", "actual_temp_mean": "Actual mean temperature",
    "actual_precipitation": "Actual precipitation", "actual_wind_speed_max": "Actual strongest wind",
    "temperature_max_error": "Forecast less actual highest temperature",
    "temperature_min_error": "Forecast less actual lowest temperature",
    "temperature_mean_error": "Forecast less actual mean temperature",
    "precipitation_error": "Forecast less actual precipitation",
    "wind_speed_error": "Forecast less actual strongest wind",
    "abs_temperature_error": "Size of the error of the mean temperature",
    "abs_precipitation_error": "Size of the error of the precipitation",
    "total_days": "Days with weather", "hot_days": "Hot days", "heatwave_days": "Days in heatwaves",
    "longest_heatwave": "Days of the longest run of hot days", "freezing_days": "Freezing days",
    "cold_snap_days": "Days in cold snaps", "longest_cold_snap": "Days of the longest run of freezing days",
    "heavy_rain_days": "Days of heavy rain", "longest_wet_spell": "Days of the longest run of heavy rain",
    "anomaly_sk": "Key of the place and day", "season_mean_c": "Mean temperature of the place and season",
    "anomaly_c": "Day's mean less the season's", "anomaly_z": "Anomaly in standard deviations",
    "is_extreme_day": "Anomaly of at least the set number of deviations",
    "city_season_sk": "Key of the place and season", "city_month_sk": "Key of the place and month",
    "month_num": "Month, 1 to 12", "month_name": "Name of the month",
    "avg_temperature_c": "Mean of the daily means", "avg_max_temperature_c": "Mean of the daily highest",
    "avg_min_temperature_c": "Mean of the daily lowest", "total_precipitation_mm": "Precipitation in all",
    "comfortable_days": "Comfortable days", "rainy_days": "Rainy days", "windy_days": "Windy days",
    "comfort_score": "Comfortable days in percent of all days",
    "overall_comfort_index": "Comfort score less half the mean air quality index",
    "first_date": "First day with weather", "last_date": "Last day with weather",
    "avg_air_quality_index": "Mean of the daily mean indexes",
    "worst_air_quality_index": "Highest index of all days",
}


def needed(names) -> list[str]:
    """The marts to write for ``names``, in dependency order."""
    want, todo = set(), list(names)
    while todo:
        name = todo.pop()
        if name not in TABLES:
            raise ValueError(f"no mart named {name}")
        if name not in want:
            want.add(name)
            todo.extend(TABLES[name].needs)
    return [n for n in TABLES if n in want]


class Warehouse:
    """The written marts under a folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str, columns: list[str] | None = None,
             where: Column | None = None) -> DataFrame:
        """A mart, its rows filtered and its columns pruned at the Parquet scan."""
        df = read_mart(self.spark, self.path(name))
        df = df if where is None else df.where(where)
        return df.select(*columns) if columns else df

    def comments(self, name: str) -> dict[str, str]:
        """The descriptions of a mart's columns, as they were written."""
        return {f.name: f.metadata["comment"] for f in self.read(name).schema.fields
                if "comment" in f.metadata}


def build(spark: SparkSession, models: Marts, root: str, names=None) -> Warehouse:
    """Write the marts ``names`` (all by default) and those they are made from.

    Each mart replaces its folder as a whole, so a build that is run again
    gives the same tables; a mart that was written is what the later ones read.
    Marts that do not need each other are written at the same time, since the
    small ones leave most of a cluster idle.
    A mart whose inputs are missing (no forecast) is left out.
    """
    made = Warehouse(spark, root)
    todo = needed(TABLES if names is None else names)
    docs: list[str] = []

    def write(df: DataFrame, name: str) -> None:
        write_table(described(df, COLUMNS) if name in TABLES else df, made.path(name))

    with work_tables(spark), ThreadPoolExecutor(WRITERS) as pool:
        while todo:
            ready = [n for n in todo if not set(TABLES[n].needs) & set(todo)]
            frames = {}
            jobs = []
            for name in ready:
                df = getattr(models, name)
                if df is not None:
                    frames[name] = df
                    jobs.append(pool.submit(inheritable_thread_target(spark)(write), df, name))
            for job in jobs:
                job.result()
            for name, df in frames.items():  # later models read the tables
                models.__dict__[name] = spark.read.schema(df.schema).parquet(made.path(name))
            docs += frames
            todo = [n for n in todo if n not in ready]
        write(spark.range(1).select(F.inline(F.array(*[F.struct(
            F.lit(n).alias("mart"), F.lit(TABLES[n].description).alias("description"))
            for n in docs]))), "mart_docs")
    return made
