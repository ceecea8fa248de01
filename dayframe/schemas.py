"""Explicit schemas: raw tables (no inference), the band seed, mart contracts."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, DT, TS, TSN, B = (T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(),
                              T.DateType(), T.TimestampType(), T.TimestampNTZType(),
                              T.BooleanType())


def struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RAW_LOCATIONS = struct(
    ("location_id", I), ("city_name", S), ("country", S), ("country_code", S), ("admin1", S),
    ("latitude", D), ("longitude", D), ("timezone", S), ("elevation", D), ("population", I),
    ("extracted_at", S))

_DAILY = [("temperature_2m_max", D), ("temperature_2m_min", D), ("temperature_2m_mean", D),
          ("precipitation_sum", D), ("rain_sum", D), ("snowfall_sum", D), ("wind_speed_10m_max", D)]
RAW_WEATHER_DAILY = struct(
    ("source_name", S), ("extracted_at", S), ("location_id", I), ("city_name", S),
    ("country_code", S), ("date", DT), ("latitude", D), ("longitude", D), ("timezone", S), *_DAILY)
RAW_FORECAST_DAILY = RAW_WEATHER_DAILY

_HOURLY = [("pm10", D), ("pm2_5", D), ("carbon_monoxide", D), ("nitrogen_dioxide", D),
           ("ozone", D), ("european_aqi", D)]
RAW_AIR_QUALITY_HOURLY = struct(
    ("source_name", S), ("extracted_at", S), ("location_id", I), ("city_name", S),
    ("country_code", S), ("timestamp", TSN), ("latitude", D), ("longitude", D), ("timezone", S),
    *_HOURLY)

RAW_TABLES = {
    "raw_locations": RAW_LOCATIONS,
    "raw_weather_daily": RAW_WEATHER_DAILY,
    "raw_forecast_daily": RAW_FORECAST_DAILY,
    "raw_air_quality_hourly": RAW_AIR_QUALITY_HOURLY,
}

AQI_BANDS = struct(("band_order", I), ("aqi_band", S), ("aqi_min", D), ("aqi_max", D),
                   ("health_note", S))

# Contracts: enforced names and types of three marts.
DIM_LOCATION = struct(
    ("location_sk", S), ("location_id", I), ("city_name", S), ("country", S), ("country_code", S),
    ("admin1", S), ("latitude", D), ("longitude", D), ("timezone", S), ("elevation", D),
    ("population", I))

MART_CITY_SEASON_SUMMARY = struct(
    ("city_season_sk", S), ("location_sk", S), ("location_id", I), ("city_name", S),
    ("country_code", S), ("season", S), ("total_days", L), ("avg_temperature_c", D),
    ("avg_max_temperature_c", D), ("avg_min_temperature_c", D), ("total_precipitation_mm", D),
    ("comfortable_days", L), ("rainy_days", L), ("hot_days", L), ("freezing_days", L),
    ("comfort_score", D))

MART_EXTREME_EVENTS = struct(
    ("location_sk", S), ("location_id", I), ("city_name", S), ("country_code", S),
    ("total_days", L), ("hot_days", L), ("heatwave_days", L), ("longest_heatwave", L),
    ("freezing_days", L), ("cold_snap_days", L), ("longest_cold_snap", L),
    ("heavy_rain_days", L), ("longest_wet_spell", L))

CONTRACTS = {
    "dim_location": DIM_LOCATION,
    "mart_city_season_summary": MART_CITY_SEASON_SUMMARY,
    "mart_extreme_events": MART_EXTREME_EVENTS,
}

# The benchmark tables.
BENCH_TABLES = {
    "region": struct(("r_regionkey", I), ("r_name", S)),
    "nation": struct(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "customer": struct(("c_custkey", L), ("c_name", S), ("c_nationkey", I), ("c_acctbal", D),
                       ("c_mktsegment", S)),
    "supplier": struct(("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", D)),
    "orders": struct(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S), ("o_totalprice", D),
                     ("o_orderdate", TSN), ("o_orderpriority", S)),
    "events": struct(("event_id", L), ("ts", TSN), ("user_id", L), ("event_type", S), ("value", D),
                     ("props", S)),
    "documents": struct(("doc_id", L), ("text", S), ("lang", S), ("source", S), ("n_chars", L)),
    "labels": struct(("doc_id", L), ("quality", I), ("toxic", I)),
}
