"""Dashboard datasets: each chart or table is a DataFrame built from marts.

Filters on entity and date are applied to the mart DataFrames (and reach the
Parquet scan when the marts are read from files); global quantities such as
min/max for normalisation are scalar subqueries, never collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayframe.functions import (band_label, clamp, min_max_norm, ratio_pct, score_class,
                                season_ordinal, sql_round, temperature_class)
from dayframe.operators.order import arg_max_by_group, top_k, with_position


def slice_days(df: DataFrame, entity_col: str, entities: Sequence[str] | None,
               date_col: str, start=None, end=None) -> DataFrame:
    """Entity IN list AND date BETWEEN start AND end (inclusive)."""
    cond = F.lit(True)
    if entities is not None:
        cond = cond & F.col(entity_col).isin(*entities)
    if start is not None:
        cond = cond & (F.col(date_col) >= F.lit(start).cast("date"))
    if end is not None:
        cond = cond & (F.col(date_col) <= F.lit(end).cast("date"))
    return df.filter(cond)


def ranking(weather_day: DataFrame, aq_day: DataFrame, wide: bool = False,
            fill_aqi: bool = False) -> DataFrame:
    """Per-entity ranking over the (filtered) days.

    comfort_score = round(100 * comfortable / days, 1); overall index =
    round(comfort_score - 0.5 * mean daily AQI (0 when missing), 1).
    ``wide`` adds freezing days, extremes and mean wind as the map variant does.
    """
    aggs = [
        F.count("weather_date").alias("days"),
        F.count_if("is_comfortable").alias("comfortable_days"),
        F.count_if("is_rainy").alias("rainy_days"),
        F.count_if("is_windy").alias("windy_days"),
        F.count_if("is_hot").alias("hot_days"),
        F.avg("temperature_2m_mean").alias("avg_temp"),
    ]
    if wide:
        aggs += [
            F.count_if("is_freezing").alias("freezing_days"),
            F.max("temperature_2m_max").alias("max_temp"),
            F.min("temperature_2m_min").alias("min_temp"),
            F.sum("precipitation_sum").alias("rain_mm"),
            F.avg("wind_speed_10m_max").alias("wind_kmh"),
        ]
    r = weather_day.groupBy("city_name").agg(*aggs)
    aqi = aq_day.groupBy("city_name").agg(F.avg("avg_european_aqi").alias("avg_european_aqi"))
    r = r.join(aqi, "city_name", "left")
    if fill_aqi:
        r = r.withColumn("avg_european_aqi", F.coalesce("avg_european_aqi", F.lit(0.0)))
    r = r.withColumn("comfort_score", sql_round(ratio_pct("comfortable_days", "days"), 1))
    return r.withColumn("overall_comfort_index", sql_round(
        F.col("comfort_score") - F.lit(0.5) * F.coalesce("avg_european_aqi", F.lit(0.0)), 1))


def rank_order():
    """Best index first, ties by name."""
    return [F.col("overall_comfort_index").desc_nulls_last(), F.col("city_name").asc()]


def rank_reverse():
    return [F.col("overall_comfort_index").asc_nulls_first(), F.col("city_name").desc()]


# --- fixed values (must equal the reference's results) -----------------------
# Leaderboard sort labels: column, ascending.
LEADERBOARD_SORTS = {
    "Overall index": ("overall_comfort_index", False),
    "Comfort score": ("comfort_score", False),
    "Warmest": ("avg_temp", False),
    "Cleanest air": ("avg_european_aqi", True),
}
# Day-type labels of the ranking's counts.
DAY_TYPES = {
    "comfortable_days": "Comfortable",
    "rainy_days": "Rainy",
    "windy_days": "Windy",
    "hot_days": "Hot",
    "freezing_days": "Freezing",
}
# Planner weights of the five criteria.
PLANNER_WEIGHTS = {"n_warm": 3, "n_comfort": 5, "n_air": 3, "n_dry": 3, "n_calm": 2}
# -----------------------------------------------------------------------------


def leaderboard_order(sort_label: str):
    col, asc = LEADERBOARD_SORTS[sort_label]
    c = F.col(col)
    return [c.asc_nulls_last() if asc else c.desc_nulls_last(), F.col("city_name").asc()]


def leaderboard(rank: DataFrame, sort_label: str) -> DataFrame:
    """The ranking in the chosen order with each row's position, the length of its score bar (4 to
    100), the class of its comfort score and the band label of its mean AQI."""
    placed = with_position(rank, leaderboard_order(sort_label), "position")
    return placed.withColumns({
        "score_bar": clamp("comfort_score", 4.0, 100.0),
        "score_class": score_class("comfort_score"),
        "aqi_label": band_label("avg_european_aqi")})


def kpis(weather_day: DataFrame, rank: DataFrame) -> DataFrame:
    """One row: number of entities, mean of the daily means, comfortable days,
    best entity and its index. Values from other inputs are scalar subqueries."""
    avg_temp = weather_day.select(F.avg("temperature_2m_mean")).scalar()
    top = top_k(rank, rank_order(), 1)
    return rank.agg(
        F.count(F.lit(1)).alias("cities"),
        F.sum("comfortable_days").alias("comfortable_days"),
    ).select(
        "cities", avg_temp.alias("avg_temp"), "comfortable_days",
        top.select("city_name").scalar().alias("top_city"),
        top.select("overall_comfort_index").scalar().alias("top_index"),
    )


def meters(rank: DataFrame, aq_day: DataFrame) -> DataFrame:
    """One row: means over the entities of the overall index and the comfort
    score, and the mean daily AQI (0 without data)."""
    aqi = aq_day.select(F.avg("avg_european_aqi")).scalar()
    return rank.agg(F.avg("overall_comfort_index").alias("overall_comfort"),
                    F.avg("comfort_score").alias("comfort_score")).withColumn(
        "air_quality", F.coalesce(aqi, F.lit(0.0)))


def city_map(rank: DataFrame, dim: DataFrame) -> DataFrame:
    """The ranking with coordinates and population, and a marker size of the
    square root of the population (1 at least)."""
    places = dim.select("city_name", "latitude", "longitude", "population")
    return rank.join(places, "city_name", "left").withColumn(
        "marker_size", F.sqrt(F.greatest(F.col("population"), F.lit(1))))


def season_chart(rank: DataFrame, season_summary: DataFrame, k: int = 8) -> DataFrame:
    """The season rows of the k best entities, with the season's place in the year."""
    best = top_k(rank, rank_order(), k).select("city_name")
    return season_sorted(season_summary.join(best, "city_name", "left_semi").select(
        "city_name", "season", "avg_temperature_c", "comfort_score"))


def thermal_grid(weather_day: DataFrame) -> DataFrame:
    """Mean temperature per entity and day in long form; a chart pivots it over
    the days that it shows."""
    return weather_day.groupBy("city_name", "weather_date").agg(
        F.avg("temperature_2m_mean").alias("temperature_2m_mean"))


def melt_counts(rank: DataFrame, columns: dict[str, str], id_col: str = "city_name",
                var: str = "condition", value: str = "day_count") -> DataFrame:
    """Wide counts to long rows, with display labels for the variable names."""
    long = rank.unpivot([id_col], list(columns), var, value)
    mapping = F.create_map(*[F.lit(x) for kv in columns.items() for x in kv])
    return long.withColumn(var, mapping[F.col(var)])


def radar(rank: DataFrame, k: int = 8) -> DataFrame:
    """Five 0-100 axes for the top-k entities; the AQI scale is the maximum
    over all entities (a scalar subquery)."""
    aqi_max = rank.select(F.greatest(F.max(F.coalesce("avg_european_aqi", F.lit(0.0))),
                                     F.lit(1.0))).scalar()
    top = top_k(rank, rank_order(), k)
    aqi = F.coalesce(F.col("avg_european_aqi"), F.lit(0.0))
    return top.select(
        "city_name",
        clamp(F.col("avg_temp") / 30.0 * 100.0, 0.0, 100.0).alias("warmth"),
        F.col("comfort_score").alias("comfort"),
        (F.lit(100.0) - F.least(F.lit(100.0), aqi / aqi_max * 100.0)).alias("clean_air"),
        (F.lit(100.0) - F.col("windy_days") / F.col("days") * 100.0).alias("calm"),
        (F.lit(100.0) - F.col("rainy_days") / F.col("days") * 100.0).alias("dry"),
    )


def season_cards(season_summary: DataFrame, seasons: DataFrame) -> DataFrame:
    """Mean over entities of season temperature and comfort, one row per
    season of ``seasons`` (season, season_order); a season without data is
    kept with NULLs."""
    agg = season_summary.groupBy("season").agg(
        F.avg("avg_temperature_c").alias("t"), F.avg("comfort_score").alias("cs"))
    out = seasons.join(agg, "season", "left")
    return out.withColumn("t_class", temperature_class("t"))


def best_month(month_summary: DataFrame) -> DataFrame:
    """Month with the highest comfort score per entity (earlier month on ties)."""
    return arg_max_by_group(month_summary, ["city_name"], "month_name",
                            [F.col("comfort_score"), F.lit(0) - F.col("month_num")], "best_month")


def planner(summary: DataFrame, season_summary: DataFrame, month_summary: DataFrame,
            extremes: DataFrame, season_pref: str | None = None, avoid_heat: bool = False,
            weights: dict[str, float] | None = None) -> DataFrame:
    """Score every entity 0-100 from five normalised criteria.

    Normalisation bounds are global min/max (scalar subqueries); missing AQI is
    filled with the median AQI over entities. With ``avoid_heat`` the match
    loses 0.35 x normalised heatwave days. Weights default to warm 3,
    comfort 5, air 3, dry 3, calm 2; all zero gives match 0.
    """
    w = {**PLANNER_WEIGHTS, **(weights or {})}
    days = F.greatest(F.col("total_days"), F.lit(1))
    plan = summary.select(
        "city_name", "comfort_score", "avg_temperature_c", "avg_air_quality_index",
        (F.col("rainy_days") / days).alias("rainy_ratio"),
        (F.col("windy_days") / days).alias("windy_ratio"))
    if season_pref:
        sj = season_summary.filter(F.col("season") == season_pref).select(
            "city_name", F.col("comfort_score").alias("s_comfort"),
            F.col("avg_temperature_c").alias("s_temp"))
        plan = plan.join(sj, "city_name", "left").withColumns({
            "use_comfort": F.coalesce("s_comfort", "comfort_score"),
            "use_temp": F.coalesce("s_temp", "avg_temperature_c"),
        }).drop("s_comfort", "s_temp")
    else:
        plan = plan.withColumns({"use_comfort": F.col("comfort_score"),
                                 "use_temp": F.col("avg_temperature_c")})
    med = summary.select(F.median("avg_air_quality_index")).scalar()
    plan = plan.withColumn("use_air", F.coalesce(F.col("avg_air_quality_index"), med))
    # all normalisation bounds in one one-row aggregate (one scalar subquery,
    # reused by every reference)
    norm_cols = ("use_temp", "use_air", "rainy_ratio", "windy_ratio")
    b = plan.select(F.struct(*[F.min(c).alias(f"lo_{c}") for c in norm_cols],
                             *[F.max(c).alias(f"hi_{c}") for c in norm_cols])).scalar()
    bounds = {c: (b.getField(f"lo_{c}"), b.getField(f"hi_{c}")) for c in norm_cols}
    plan = plan.withColumns({
        "n_warm": min_max_norm("use_temp", *bounds["use_temp"]),
        "n_comfort": clamp("use_comfort", 0.0, 100.0),
        "n_air": min_max_norm("use_air", *bounds["use_air"], invert=True),
        "n_dry": min_max_norm("rainy_ratio", *bounds["rainy_ratio"], invert=True),
        "n_calm": min_max_norm("windy_ratio", *bounds["windy_ratio"], invert=True),
    })
    wsum = sum(w.values()) or 1
    match = sum((F.col(k) * F.lit(float(v)) for k, v in w.items()), F.lit(0.0)) / F.lit(float(wsum))
    plan = plan.withColumn("match", match)
    if avoid_heat:
        hw = extremes.select("city_name", F.coalesce("heatwave_days", F.lit(0)).alias("hw"))
        plan = plan.join(hw, "city_name", "left").withColumn("hw", F.coalesce("hw", F.lit(0)))
        hb = plan.select(F.struct(F.min("hw").alias("lo"), F.max("hw").alias("hi"))).scalar()
        plan = plan.withColumn("match", F.col("match") - min_max_norm(
            "hw", hb.getField("lo"), hb.getField("hi")) * 0.35).drop("hw")
    plan = plan.withColumn("match", clamp("match", 0.0, 100.0))
    return plan.join(best_month(month_summary), "city_name", "left")


def unusual_days(anomalies: DataFrame, k: int = 6) -> DataFrame:
    """The k days with the largest |z| (ties: entity, then date)."""
    order = [F.abs("anomaly_z").desc_nulls_last(), F.col("city_name"), F.col("weather_date")]
    return top_k(anomalies, order, k).select(
        "city_name", "weather_date", F.date_format("weather_date", "dd MMM yyyy").alias("day_label"),
        "anomaly_c", "anomaly_z")


def extreme_champions(extremes: DataFrame) -> DataFrame:
    """Entity with the most heatwave / cold-snap / heavy-rain days (smallest
    name on ties), with its longest streak: three top-1 operators."""
    kinds = [("MOST HEATWAVE DAYS", "heatwave_days", "longest_heatwave"),
             ("MOST COLD-SNAP DAYS", "cold_snap_days", "longest_cold_snap"),
             ("MOST HEAVY-RAIN DAYS", "heavy_rain_days", "longest_wet_spell")]
    parts = [top_k(extremes, [F.col(value).desc_nulls_last(), F.col("city_name")], 1).select(
        F.lit(title).alias("kind"), "city_name", F.col(value).alias("days"),
        F.col(streak).alias("longest")) for title, value, streak in kinds]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def band_labels(aq_day: DataFrame) -> DataFrame:
    return aq_day.select("location_id", "air_quality_date", "avg_european_aqi",
                         band_label("avg_european_aqi").alias("aqi_label"))


def season_sorted(df: DataFrame) -> DataFrame:
    return df.withColumn("season_order", season_ordinal("season"))
