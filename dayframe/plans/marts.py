"""The star schema: intermediate models and marts composed from operators.

Every function is lazy (DataFrame in, DataFrame out). ``build_all`` wires the
whole graph from staged inputs; callers persist what they need with
``sources.sinks.write_table``.
"""

from __future__ import annotations

from functools import cached_property
from types import SimpleNamespace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayframe.functions import season_from_date, surrogate_key
from dayframe.operators import anomaly, bands, flags, forecast, rollup, streaks
from dayframe.operators.flags import WEATHER, DayRules
from dayframe.sources.sinks import stored


def dim_location(locations: DataFrame) -> DataFrame:
    """One row per location (the staged columns minus ``extracted_at``)."""
    return locations.select("location_sk", "location_id", "city_name", "country", "country_code",
                            "admin1", "latitude", "longitude", "timezone", "elevation",
                            "population")


def city_day_weather(weather: DataFrame, locations: DataFrame, rules: DayRules = WEATHER) -> DataFrame:
    """Weather days INNER JOIN locations; location attributes come from the
    dimension. No hint: the planner broadcasts the dimension only while its
    size (of its files, or measured at run time) is below its bound."""
    loc = locations.select(
        "location_id", "city_name", "country", "country_code", "latitude", "longitude",
        "timezone", "population", "elevation")
    w = weather.select("location_id", "weather_date", "temperature_2m_max", "temperature_2m_min",
                       "temperature_2m_mean", "precipitation_sum", "rain_sum", "snowfall_sum",
                       "wind_speed_10m_max", "extracted_at",
                       F.col("weather_daily_sk").alias("city_day_weather_sk"))
    joined = w.join(loc, "location_id", "inner").select(
        "location_id", "city_name", "country", "country_code", "latitude", "longitude",
        "timezone", "population", "elevation", "weather_date", "temperature_2m_max",
        "temperature_2m_min", "temperature_2m_mean", "precipitation_sum", "rain_sum",
        "snowfall_sum", "wind_speed_10m_max", "extracted_at", "city_day_weather_sk")
    return flags.threshold_flags(joined, rules)


def city_weather_day(cdw: DataFrame, rules: DayRules = WEATHER) -> DataFrame:
    """Fact: adds location_sk, season and the comfort flag."""
    out = cdw.withColumns({
        "location_sk": surrogate_key("location_id"),
        "season": season_from_date("weather_date"),
    })
    out = flags.comfort_flag(out, rules)
    return out.select(
        F.col("city_day_weather_sk").alias("city_weather_day_sk"), "location_sk", "location_id",
        "city_name", "country_code", "weather_date", "season", "temperature_2m_max",
        "temperature_2m_min", "temperature_2m_mean", "temp_range_c", "precipitation_sum",
        "rain_sum", "snowfall_sum", "wind_speed_10m_max", "is_rainy", "is_windy", "is_hot",
        "is_freezing", "is_comfortable")


def air_quality_daily(hourly: DataFrame, percentile_method: str = "distributed") -> DataFrame:
    """The readings are stored first: they come from a join, and the averages and
    the percentiles both read them."""
    readings = stored(hourly.select("location_id", "city_name", "country_code",
                                    "reading_timestamp", *rollup.AQ_AVG_MAX), "readings")
    return rollup.hourly_to_daily(readings, percentile_method=percentile_method)


def air_quality_city_day(aq_daily: DataFrame, band_table: DataFrame) -> DataFrame:
    """Daily AQ fact with the band containing the day's mean AQI."""
    b = band_table.select("band_order", "aqi_band", "aqi_min", "aqi_max")
    joined = bands.range_join(aq_daily, "avg_european_aqi", b)
    return joined.select(
        F.col("air_quality_daily_sk").alias("air_quality_city_day_sk"),
        surrogate_key("location_id").alias("location_sk"),
        "location_id", "city_name", "country_code", "air_quality_date",
        "avg_pm10", "max_pm10", "p95_pm10", "avg_pm2_5", "max_pm2_5", "p95_pm2_5",
        "avg_carbon_monoxide", "max_carbon_monoxide", "avg_nitrogen_dioxide",
        "max_nitrogen_dioxide", "avg_ozone", "max_ozone", "avg_european_aqi",
        "max_european_aqi", "p95_european_aqi", "hourly_readings_count", "aqi_band",
        F.col("band_order").alias("aqi_band_order"))


def extreme_streaks(cdw: DataFrame, rules: DayRules = WEATHER, contiguous: bool = False) -> DataFrame:
    cols = ["location_id", "city_name", "country_code", "weather_date", "temperature_2m_max",
            "temperature_2m_min", "rain_sum", "is_hot", "is_freezing"]
    if rules.heavy_col not in cols:
        cols.append(rules.heavy_col)
    daily = flags.heavy_rain_flag(cdw.select(*cols), rules)
    runs = (
        streaks.RunSpec("is_hot", "heat_streak", "in_heatwave", rules.heatwave_min_days),
        streaks.RunSpec("is_freezing", "cold_streak", "in_cold_snap", rules.cold_snap_min_days),
        streaks.RunSpec("is_heavy_rain", "wet_streak", "in_wet_spell", rules.wet_spell_min_days),
    )
    out = streaks.run_lengths(daily, "location_id", "weather_date", runs, contiguous=contiguous)
    return out.select(
        surrogate_key("location_id", "weather_date").alias("extreme_streak_sk"),
        "location_id", "city_name", "country_code", "weather_date", "temperature_2m_max",
        "temperature_2m_min", "rain_sum", "is_hot", "is_freezing", "is_heavy_rain",
        "heat_streak", "cold_streak", "wet_streak", "in_heatwave", "in_cold_snap", "in_wet_spell")


def temperature_anomaly(fct_day: DataFrame, k: float = 2.0) -> DataFrame:
    """Each day's mean vs its entity's mean for the same season."""
    daily = fct_day.select("location_id", "city_name", "country_code", "weather_date", "season",
                           "temperature_2m_mean")
    z = anomaly.group_zscore(daily, ["location_id", "season"], "temperature_2m_mean", k)
    return z.select(
        surrogate_key("location_id", "weather_date").alias("anomaly_sk"),
        surrogate_key("location_id").alias("location_sk"),
        "location_id", "city_name", "country_code", "weather_date", "season",
        "temperature_2m_mean", "season_mean_c", "anomaly_c", "anomaly_z", "is_extreme_day")


def forecast_city_day(forecast_stg: DataFrame, actual_stg: DataFrame) -> DataFrame:
    return forecast.forecast_fact(forecast.align(forecast_stg, actual_stg))


class Marts:
    """The model graph over staged inputs. Each model is built on first
    access (lazy DataFrame, nothing is computed), so a query that needs one
    mart does not pay for planning the others."""

    def __init__(self, inputs, rules: DayRules = WEATHER, anomaly_k: float = 2.0):
        """``inputs`` has the staged inputs as attributes: locations, weather, air_hourly,
        band_table, forecast, actual. Only those that a model needs are read."""
        self.inputs, self.rules, self.anomaly_k = inputs, rules, anomaly_k

    @cached_property
    def dim_location(self) -> DataFrame:
        return dim_location(self.inputs.locations)

    @cached_property
    def int_city_day_weather(self) -> DataFrame:
        return city_day_weather(self.inputs.weather, self.inputs.locations, self.rules)

    @cached_property
    def fct_city_weather_day(self) -> DataFrame:
        return city_weather_day(self.int_city_day_weather, self.rules)

    @cached_property
    def int_air_quality_daily(self) -> DataFrame:
        return air_quality_daily(self.inputs.air_hourly)

    @cached_property
    def fct_air_quality_city_day(self) -> DataFrame:
        return air_quality_city_day(self.int_air_quality_daily, self.inputs.band_table)

    @cached_property
    def int_weather_extreme_streaks(self) -> DataFrame:
        return extreme_streaks(self.fct_city_weather_day, self.rules)

    @cached_property
    def mart_extreme_events(self) -> DataFrame:
        return rollup.extreme_event_summary(self.int_weather_extreme_streaks)

    @cached_property
    def mart_temperature_anomaly(self) -> DataFrame:
        return temperature_anomaly(self.fct_city_weather_day, self.anomaly_k)

    @cached_property
    def mart_city_season_summary(self) -> DataFrame:
        return rollup.season_summary(self.fct_city_weather_day)

    @cached_property
    def mart_city_month_summary(self) -> DataFrame:
        return rollup.month_summary(self.fct_city_weather_day)

    @cached_property
    def mart_city_weather_summary(self) -> DataFrame:
        return rollup.city_summary(self.dim_location, self.fct_city_weather_day,
                                   self.fct_air_quality_city_day)

    @cached_property
    def fct_forecast_city_day(self) -> DataFrame | None:
        if self.inputs.forecast is None or self.inputs.actual is None:
            return None
        return forecast_city_day(self.inputs.forecast, self.inputs.actual)

    MODELS = ("dim_location", "int_city_day_weather", "fct_city_weather_day",
              "int_air_quality_daily", "fct_air_quality_city_day", "int_weather_extreme_streaks",
              "mart_extreme_events", "mart_temperature_anomaly", "mart_city_season_summary",
              "mart_city_month_summary", "mart_city_weather_summary", "fct_forecast_city_day")


def build_all(locations: DataFrame, weather: DataFrame, air_hourly: DataFrame,
              band_table: DataFrame, forecast_stg: DataFrame | None = None,
              actual_stg: DataFrame | None = None, rules: DayRules = WEATHER,
              anomaly_k: float = 2.0) -> Marts:
    """All models from staged inputs (lazy)."""
    return Marts(SimpleNamespace(locations=locations, weather=weather, air_hourly=air_hourly,
                                 band_table=band_table, forecast=forecast_stg, actual=actual_stg),
                 rules, anomaly_k)
