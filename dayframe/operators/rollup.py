"""Rollups: hourly readings to days, days to months / seasons / entities.

All rollups are ``groupBy().agg()`` so Spark runs a partial (map-side)
aggregate before the shuffle: a hot key costs one partial row per input
partition, not one shuffled row per reading.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayframe.functions import any_not_null, ratio_pct, sql_round, surrogate_key


def percentile_col(c: str, q: float, method: str = "exact", accuracy: int = 10000) -> Column:
    """Continuous percentile with linear interpolation (NULLs ignored).

    ``exact`` keeps a value->count map per group, merged in the task that
    finalises the group: right only when groups have a bounded number of
    distinct values. ``approx`` is a bounded-memory sketch. For exact answers
    on groups of any size use ``percentile_method="distributed"`` in the
    rollups (``operators.percentile.grouped_percentiles``).
    """
    if method == "exact":
        return F.percentile(F.col(c), F.lit(q))
    if method == "approx":
        return F.percentile_approx(F.col(c), F.lit(q), F.lit(accuracy)).cast("double")
    raise ValueError(f"unknown percentile method {method!r}")


AQ_AVG_MAX = ["pm10", "pm2_5", "carbon_monoxide", "nitrogen_dioxide", "ozone", "european_aqi"]
AQ_P95 = ("pm10", "pm2_5", "european_aqi")
AQ_REQUIRE_ANY = ("pm10", "pm2_5", "european_aqi")


def hourly_to_daily(hourly: DataFrame,
                    keys: Sequence[str] = ("location_id", "city_name", "country_code"),
                    ts_col: str = "reading_timestamp",
                    date_alias: str = "air_quality_date",
                    measures: Sequence[str] = AQ_AVG_MAX,
                    p95: Sequence[str] = AQ_P95,
                    require_any: Sequence[str] = AQ_REQUIRE_ANY,
                    quantile: float = 0.95,
                    percentile_method: str = "distributed",
                    count_alias: str = "hourly_readings_count",
                    sk_alias: str = "air_quality_daily_sk",
                    sk_entity: str = "location_id") -> DataFrame:
    """Daily avg / max / p95 per measure and a reading count.

    Rows where every ``require_any`` measure is NULL are dropped before the
    aggregate, so they count neither in averages nor in the reading count.
    The day is the local calendar day of the zone-less reading time.

    ``percentile_method``: ``distributed`` (default) is exact and keeps a hot
    entity-day spread over many tasks (see ``operators.percentile``);
    ``exact`` / ``approx`` compute the percentile inside the aggregate.
    """
    day = F.to_date(F.col(ts_col))
    filtered = hourly.filter(any_not_null(*require_any)) if require_any else hourly
    filtered = filtered.withColumn(date_alias, day)
    group = [*keys, date_alias]
    inline = percentile_method != "distributed"
    aggs, order = [], []
    for m in measures:
        aggs.append(F.avg(m).alias(f"avg_{m}"))
        aggs.append(F.max(m).alias(f"max_{m}"))
        order += [f"avg_{m}", f"max_{m}"]
        if m in p95:
            if inline:
                aggs.append(percentile_col(m, quantile, percentile_method).alias(f"p95_{m}"))
            order.append(f"p95_{m}")
    aggs.append(F.count(F.lit(1)).alias(count_alias))
    out = filtered.groupBy(*group).agg(*aggs)
    if not inline and p95:
        from dayframe.operators.joins import join_back
        from dayframe.operators.percentile import grouped_percentiles

        pct = grouped_percentiles(filtered, group, list(p95), quantile, alias="p95_{}")
        # both sides hold one row per group: a plain key join, left so groups
        # without any percentile input keep NULLs
        out = join_back(out, pct, group, "left")
    out = out.select(*group, *order, count_alias)
    return out.withColumn(sk_alias, surrogate_key(sk_entity, date_alias))


def _day_type_counts(flags: Sequence[str]) -> list[Column]:
    return [F.count_if(F.col(f"is_{f}")).alias(f"{f}_days") for f in flags]


def season_summary(day: DataFrame) -> DataFrame:
    """One row per entity x season over a flagged day table with ``season``."""
    keys = ["location_id", "city_name", "country_code", "season"]
    out = day.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_days"),
        sql_round(F.avg("temperature_2m_mean"), 1).alias("avg_temperature_c"),
        sql_round(F.avg("temperature_2m_max"), 1).alias("avg_max_temperature_c"),
        sql_round(F.avg("temperature_2m_min"), 1).alias("avg_min_temperature_c"),
        sql_round(F.sum("precipitation_sum"), 1).alias("total_precipitation_mm"),
        *_day_type_counts(["comfortable", "rainy", "hot", "freezing"]),
    )
    return out.select(
        surrogate_key("location_id", "season").alias("city_season_sk"),
        surrogate_key("location_id").alias("location_sk"),
        *keys, "total_days", "avg_temperature_c", "avg_max_temperature_c",
        "avg_min_temperature_c", "total_precipitation_mm", "comfortable_days",
        "rainy_days", "hot_days", "freezing_days",
        sql_round(ratio_pct("comfortable_days", "total_days"), 1).alias("comfort_score"),
    )


def month_summary(day: DataFrame) -> DataFrame:
    """One row per entity x month number: years collapse into one month."""
    month = F.month("weather_date")
    out = day.groupBy(
        "location_id", "city_name", "country_code",
        month.alias("month_num"),
        F.date_format("weather_date", "MMMM").alias("month_name"),
        "season",
    ).agg(
        F.count(F.lit(1)).alias("total_days"),
        sql_round(F.avg("temperature_2m_mean"), 1).alias("avg_temperature_c"),
        sql_round(F.avg("temperature_2m_max"), 1).alias("avg_max_temperature_c"),
        sql_round(F.sum("precipitation_sum"), 1).alias("total_precipitation_mm"),
        *_day_type_counts(["comfortable", "rainy", "hot", "freezing"]),
    )
    return out.select(
        surrogate_key("location_id", "month_num").alias("city_month_sk"),
        surrogate_key("location_id").alias("location_sk"),
        "location_id", "city_name", "country_code",
        F.col("month_num").cast("int").alias("month_num"),
        "month_name", "season", "total_days", "avg_temperature_c",
        "avg_max_temperature_c", "total_precipitation_mm", "comfortable_days",
        "rainy_days", "hot_days", "freezing_days",
        sql_round(ratio_pct("comfortable_days", "total_days"), 1).alias("comfort_score"),
    )


def entity_weather_rollup(day: DataFrame) -> DataFrame:
    """Whole-range rollup per entity (first step of the city summary)."""
    return day.groupBy("location_sk", "location_id").agg(
        F.count(F.lit(1)).alias("total_days"),
        F.min("weather_date").alias("first_date"),
        F.max("weather_date").alias("last_date"),
        sql_round(F.avg("temperature_2m_mean"), 1).alias("avg_temperature_c"),
        sql_round(F.avg("temperature_2m_max"), 1).alias("avg_max_temperature_c"),
        sql_round(F.avg("temperature_2m_min"), 1).alias("avg_min_temperature_c"),
        sql_round(F.sum("precipitation_sum"), 1).alias("total_precipitation_mm"),
        *_day_type_counts(["comfortable", "rainy", "windy", "hot", "freezing"]),
    )


def entity_air_rollup(aq_day: DataFrame) -> DataFrame:
    """Second-level rollup: mean of daily means, max of daily maxima."""
    return aq_day.groupBy("location_sk").agg(
        sql_round(F.avg("avg_european_aqi"), 1).alias("avg_air_quality_index"),
        sql_round(F.avg("avg_pm2_5"), 1).alias("avg_pm2_5"),
        sql_round(F.max("max_european_aqi"), 1).alias("worst_air_quality_index"),
    )


def city_summary(dim: DataFrame, weather_day: DataFrame, aq_day: DataFrame,
                 aqi_penalty: float = 0.5) -> DataFrame:
    """dim LEFT JOIN weather rollup LEFT JOIN air rollup, plus two scores.

    Both rollups are computed before the joins, so the joins see one row per
    entity on each side. ``overall_comfort_index`` subtracts the penalty times
    the (rounded) mean AQI, 0 when the entity has no air data.
    """
    w = entity_weather_rollup(weather_day)
    a = entity_air_rollup(aq_day)
    joined = (dim.select("location_sk", "location_id", "city_name", "country", "country_code",
                         "latitude", "longitude", "population")
              .join(w.drop("location_id"), "location_sk", "left")
              .join(a, "location_sk", "left"))
    comfort = ratio_pct("comfortable_days", "total_days")
    return joined.select(
        "location_sk", "location_id", "city_name", "country", "country_code",
        "latitude", "longitude", "population", "total_days", "first_date", "last_date",
        "avg_temperature_c", "avg_max_temperature_c", "avg_min_temperature_c",
        "total_precipitation_mm", "comfortable_days", "rainy_days", "windy_days",
        "hot_days", "freezing_days", "avg_air_quality_index", "avg_pm2_5",
        "worst_air_quality_index",
        sql_round(comfort, 1).alias("comfort_score"),
        sql_round(comfort - F.coalesce(F.col("avg_air_quality_index"), F.lit(0.0))
                  * F.lit(aqi_penalty), 1).alias("overall_comfort_index"),
    )


def extreme_event_summary(streaks: DataFrame) -> DataFrame:
    """Per entity: flagged-day counts and longest run of each kind."""
    out = streaks.groupBy("location_id", "city_name", "country_code").agg(
        F.count(F.lit(1)).alias("total_days"),
        F.count_if("is_hot").alias("hot_days"),
        F.count_if("in_heatwave").alias("heatwave_days"),
        F.max("heat_streak").cast("long").alias("longest_heatwave"),
        F.count_if("is_freezing").alias("freezing_days"),
        F.count_if("in_cold_snap").alias("cold_snap_days"),
        F.max("cold_streak").cast("long").alias("longest_cold_snap"),
        F.count_if("is_heavy_rain").alias("heavy_rain_days"),
        F.max("wet_streak").cast("long").alias("longest_wet_spell"),
    )
    return out.select(surrogate_key("location_id").alias("location_sk"), *out.columns)
