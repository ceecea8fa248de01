"""Bindings of the operators to the benchmark tables.

The benchmark tables are not weather data, so each input of the pipeline is
derived from them with Spark (joins and aggregates whose work grows with the
tables), in the raw-table shapes the staging layer expects:

* locations      nation JOIN region; coordinates from a fixed rule on the key
* weather days   orders JOIN customer, per (customer nation, order day):
                 max/min/avg/sum of o_totalprice and the order count
* AQ readings    events JOIN customer: one reading per event, located in the
                 customer's nation; measures derived from ``value``
* forecast       'view' events per (nation, day), issued in weekly snapshots
* actual         'purchase' events per (nation, day)

The small tables are joined without hints: their file sizes are known to the
planner, which broadcasts a side only below its own size bound.

``BENCH_RULES`` sets thresholds that make every day type and streak label
occur at every scale factor.

Amounts are scaled by an irrational factor (pi / 3000 for order prices,
pi / 3 for event values) before they are aggregated. Prices and values have
two decimals, so their averages and sums would often sit exactly on the ties
of the marts' ``round(x, 1)``, where last-bit differences of floating
summation order decide the result; scaled amounts are never short decimals.
"""

from __future__ import annotations

import math
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayframe.operators import staging
from dayframe.operators.flags import DayRules
from dayframe.plans import marts as M
from dayframe.schemas import BENCH_TABLES
from dayframe.sources.readers import aqi_bands

PRICE_SCALE = math.pi / 3000
VALUE_SCALE = math.pi / 3

BENCH_RULES = DayRules(
    rain_col="rain_sum", rainy_above=1.0,                                # more than one order
    wind_col="wind_speed_10m_max", windy_above=450000 * PRICE_SCALE,     # day total > 450k
    max_col="temperature_2m_max", hot_above=385000 * PRICE_SCALE,        # largest order > 385k
    min_col="temperature_2m_min", freezing_below=60000 * PRICE_SCALE,    # smallest order < 60k
    heavy_col="precipitation_sum", heavy_at_least=400000 * PRICE_SCALE,  # day total >= 400k
    mean_col="temperature_2m_mean", comfort_low=180000 * PRICE_SCALE,
    comfort_high=360000 * PRICE_SCALE,
)
LOCATIONS_EXTRACTED_AT = "2024-02-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A benchmark table with its declared schema, so that opening it reads no file."""
    return spark.read.schema(BENCH_TABLES[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def nation_coords(key: str = "n_nationkey", lat_factor: int = 37, lon_factor: int = 73):
    k = F.col(key)
    return ((k * lat_factor) % 120 - 60).cast("double"), ((k * lon_factor) % 360 - 180).cast("double")


def raw_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    lat, lon = nation_coords()
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "inner").select(
        F.col("n_nationkey").alias("location_id"),
        F.col("n_name").alias("city_name"),
        F.col("r_name").alias("country"),
        F.col("n_regionkey").cast("string").alias("country_code"),
        F.col("r_name").alias("admin1"),
        lat.alias("latitude"), lon.alias("longitude"),
        F.lit("UTC").alias("timezone"),
        (F.col("n_regionkey") * 100).cast("double").alias("elevation"),
        (F.col("n_nationkey") * 1000 + 500).cast("int").alias("population"),
        F.lit(LOCATIONS_EXTRACTED_AT).cast("timestamp_ntz").alias("extracted_at"),
    )


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("location_id"), F.col("n_name").alias("city_name"),
        F.col("n_regionkey").cast("string").alias("country_code"))


def _daily_raw(grouped: DataFrame, names: DataFrame, source: str) -> DataFrame:
    return grouped.join(names, "location_id", "inner").select(
        F.lit(source).alias("source_name"), "extracted_at", "location_id", "city_name",
        "country_code", "date", F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"), F.lit("UTC").alias("timezone"),
        "temperature_2m_max", "temperature_2m_min", "temperature_2m_mean", "precipitation_sum",
        "rain_sum", "snowfall_sum", "wind_speed_10m_max")


def _day_measures(v: str) -> list:
    precip = F.sum(v)
    return [
        F.max(v).alias("temperature_2m_max"),
        F.min(v).alias("temperature_2m_min"),
        F.avg(v).alias("temperature_2m_mean"),
        precip.alias("precipitation_sum"),
        F.count(F.lit(1)).cast("double").alias("rain_sum"),
        F.lit(0.0).alias("snowfall_sum"),
        F.sum(v).alias("wind_speed_10m_max"),
    ]


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per (customer nation, order day). Both inputs are facts at
    scale, so the join is left to the planner (shuffle join, or broadcast
    when AQE sees a small side)."""
    o = table(spark, sf_dir, "orders").select(
        "o_custkey", (F.col("o_totalprice") * F.lit(PRICE_SCALE)).alias("amount"), "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = o.join(c, o.o_custkey == c.c_custkey, "inner")
    grouped = joined.groupBy(F.col("c_nationkey").alias("location_id"),
                             F.to_date("o_orderdate").alias("date")).agg(
        F.max("o_orderdate").alias("extracted_at"), *_day_measures("amount"))
    return _daily_raw(grouped, _names(spark, sf_dir), "orders")


def _events_located(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    e = (events if events is not None else table(spark, sf_dir, "events")).select(
        "ts", "user_id", "event_type", (F.col("value") * F.lit(VALUE_SCALE)).alias("value"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return e.join(c, e.user_id == c.c_custkey, "inner").withColumnRenamed("c_nationkey", "location_id")


def raw_air_hourly(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """One AQ reading per event; ``events`` may be a stream of event rows."""
    ev = _events_located(spark, sf_dir, events).join(_names(spark, sf_dir), "location_id", "inner")
    t, v = F.col("event_type"), F.col("value")
    return ev.select(
        F.lit("events").alias("source_name"), F.col("ts").alias("extracted_at"),
        "location_id", "city_name", "country_code", F.col("ts").alias("timestamp"),
        F.lit(None).cast("double").alias("latitude"), F.lit(None).cast("double").alias("longitude"),
        F.lit("UTC").alias("timezone"),
        F.when(t != "signup", v).alias("pm10"),
        F.when(t.isin("view", "click"), v).alias("pm2_5"),
        v.alias("carbon_monoxide"),
        F.when(t == "error", v).alias("nitrogen_dioxide"),
        F.when(t == "purchase", v).alias("ozone"),
        F.when(t != "signup", v).alias("european_aqi"),
    )


def _events_daily(spark: SparkSession, sf_dir: str, event_type: str, snapshot: str) -> DataFrame:
    ev = _events_located(spark, sf_dir).filter(F.col("event_type") == event_type)
    day = F.to_date("ts")
    grouped = ev.groupBy("location_id", day.alias("date")).agg(
        F.max("ts").alias("__last"), *_day_measures("value"))
    if snapshot == "weekly":
        # forecasts are issued in weekly runs: the run after the day's week
        extracted = F.next_day(F.col("date"), "Mon").cast("timestamp_ntz")
    else:
        extracted = F.col("__last")
    grouped = grouped.withColumn("extracted_at", extracted).drop("__last")
    return _daily_raw(grouped, _names(spark, sf_dir), f"events:{event_type}")


def raw_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events_daily(spark, sf_dir, "view", "weekly")


def raw_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events_daily(spark, sf_dir, "purchase", "last")


class Inputs:
    """The staged inputs, each built when it is first used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def locations(self) -> DataFrame:
        return staging.stage_locations(raw_locations(self.spark, self.sf_dir))

    @cached_property
    def weather(self) -> DataFrame:
        return staging.stage_weather_daily(raw_weather(self.spark, self.sf_dir))

    @cached_property
    def air_hourly(self) -> DataFrame:
        return staging.stage_air_quality_hourly(raw_air_hourly(self.spark, self.sf_dir))

    @cached_property
    def band_table(self) -> DataFrame:
        return aqi_bands(self.spark)

    @cached_property
    def forecast(self) -> DataFrame:
        return staging.stage_forecast_daily(raw_forecast(self.spark, self.sf_dir))

    @cached_property
    def actual(self) -> DataFrame:
        return staging.stage_weather_daily(raw_actual(self.spark, self.sf_dir))


def marts(spark: SparkSession, sf_dir: str) -> M.Marts:
    """The model graph over the benchmark tables (lazy, built anew on every call)."""
    return M.Marts(Inputs(spark, sf_dir), rules=BENCH_RULES)
