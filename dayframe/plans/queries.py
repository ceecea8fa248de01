"""Registered queries: one per operator / model / dataset, over the benchmark
tables (see ``bindings``). Each takes (spark, sf_dir) and returns a DataFrame.

Doubles in results are rounded (half away from zero) so results compare by
value with a SQL engine despite last-bit differences of floating sums.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayframe.functions import SEASON_ORDER, season_from_date, slug, sql_round, surrogate_key
from dayframe.operators import geo, incremental, quality
from dayframe.operators.forecast import mean_abs_error
from dayframe.operators.order import top_and_bottom, top_k, with_position
from dayframe.plans import bindings as B
from dayframe.plans import views as V
from dayframe.plans.build import TABLES, Warehouse, build
from dayframe.session import scratch_path
from dayframe.sources import payload as P
from dayframe.sources.readers import (city_list_with_ids, load_csv, newest_run, read_mart,
                                      read_runs)
from dayframe.sources.sinks import write_csv, write_snapshot, write_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def finish(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every DOUBLE column to ``digits`` decimals."""
    return df.select(*[sql_round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


def _marts(spark, d):
    return B.marts(spark, d)


def _built(spark, d, *names) -> Warehouse:
    """The named marts and those they are made from, written once."""
    return build(spark, B.marts(spark, d), scratch_path(spark, "marts", uuid.uuid4().hex), names)


# --- staging / projection ----------------------------------------------------

@query("q_stage_orders")
def q_stage_orders(spark, d):
    return finish(B.Inputs(spark, d).weather, 2)


@query("q_stage_events")
def q_stage_events(spark, d):
    return finish(B.Inputs(spark, d).air_hourly, 2)


@query("q_dim")
def q_dim(spark, d):
    return _marts(spark, d).dim_location


@query("q_project")
def q_project(spark, d):
    """Persist the day fact (full replace), read back a column subset."""
    path = scratch_path(spark, "marts", uuid.uuid4().hex, "fct_city_weather_day")
    write_table(_marts(spark, d).fct_city_weather_day, path)
    cols = ["city_name", "weather_date", "season", "temperature_2m_mean", "is_comfortable"]
    return finish(read_mart(spark, path, cols), 2)


@query("q_build")
def q_build(spark, d):
    """Every mart written once with its description: rows, columns and described columns, read back
    from the tables."""
    m = _built(spark, d, *TABLES)
    docs = m.read("mart_docs")
    sizes = reduce(DataFrame.unionByName, [m.read(n).agg(F.count("*").alias("n_rows")).select(
        F.lit(n).alias("mart"), "n_rows", F.lit(len(m.read(n).columns)).alias("n_columns"),
        F.lit(len(m.comments(n))).alias("n_described")) for n in TABLES])
    return sizes.join(docs, "mart")


@query("q_synth_id")
def q_synth_id(spark, d):
    sup = B.table(spark, d, "supplier").select("s_suppkey", "s_name")
    return city_list_with_ids(sup, "s_suppkey")


@query("q_surrogate_key")
def q_surrogate_key(spark, d):
    o = B.table(spark, d, "orders")
    return o.select("o_orderkey",
                    surrogate_key("o_orderkey").alias("order_sk"),
                    surrogate_key("o_custkey", F.to_date("o_orderdate"), "o_orderstatus").alias("cust_day_sk"),
                    surrogate_key("o_orderkey", "o_orderdate").alias("order_ts_sk"))


@query("q_season")
def q_season(spark, d):
    o = B.table(spark, d, "orders")
    return o.select("o_orderkey", F.to_date("o_orderdate").alias("order_date"),
                    season_from_date("o_orderdate").alias("season"))


# --- intermediate models and facts -------------------------------------------

@query("q_enrich")
def q_enrich(spark, d):
    cdw = _marts(spark, d).int_city_day_weather
    return finish(cdw.drop("temp_range_c", "is_rainy", "is_windy", "is_hot", "is_freezing"), 2)


@query("q_flags")
def q_flags(spark, d):
    return finish(_marts(spark, d).int_city_day_weather, 2)


@query("q_comfort")
def q_comfort(spark, d):
    return finish(_marts(spark, d).fct_city_weather_day, 2)


@query("q_slice")
def q_slice(spark, d):
    fct = _marts(spark, d).fct_city_weather_day
    s = V.slice_days(fct, "city_name", ["NATION_1", "NATION_3", "NATION_7", "NATION_12", "NATION_20"],
                     "weather_date", "1996-01-01", "1997-12-31")
    return finish(s, 2)


@query("q_hourly_daily")
def q_hourly_daily(spark, d):
    return finish(_marts(spark, d).int_air_quality_daily, 4)


@query("q_band_join")
def q_band_join(spark, d):
    return finish(_marts(spark, d).fct_air_quality_city_day, 4)


@query("q_band_label")
def q_band_label(spark, d):
    return finish(V.band_labels(_marts(spark, d).int_air_quality_daily), 4)


@query("q_streaks")
def q_streaks(spark, d):
    return finish(_marts(spark, d).int_weather_extreme_streaks, 2)


@query("q_extreme_events")
def q_extreme_events(spark, d):
    return _marts(spark, d).mart_extreme_events


@query("q_anomaly")
def q_anomaly(spark, d):
    return finish(_marts(spark, d).mart_temperature_anomaly, 2)


@query("q_month_summary")
def q_month_summary(spark, d):
    return _marts(spark, d).mart_city_month_summary


@query("q_season_summary")
def q_season_summary(spark, d):
    return _marts(spark, d).mart_city_season_summary


@query("q_city_summary")
def q_city_summary(spark, d):
    return _marts(spark, d).mart_city_weather_summary


@query("q_forecast_error")
def q_forecast_error(spark, d):
    return finish(_marts(spark, d).fct_forecast_city_day, 4)


@query("q_forecast_mae")
def q_forecast_mae(spark, d):
    return finish(mean_abs_error(_marts(spark, d).fct_forecast_city_day), 4)


def _snapshot_runs(spark, d):
    """Forecast fact split into two loads: snapshots issued up to mid-month,
    then the complete set (which repeats the first load)."""
    fact = _built(spark, d, "fct_forecast_city_day").read("fct_forecast_city_day")
    cutoff = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return fact.filter(F.col("forecast_extracted_at") <= cutoff), fact


@query("q_incremental_hwm")
def q_incremental_hwm(spark, d):
    first, everything = _snapshot_runs(spark, d)
    path = scratch_path(spark, "incremental", uuid.uuid4().hex)
    for rows in (first, everything):
        incremental.append_new(spark, rows, path, "forecast_extracted_at", ["forecast_date"])
    return finish(incremental.read_table(spark, path), 4)


@query("q_incremental_upsert")
def q_incremental_upsert(spark, d):
    first, everything = _snapshot_runs(spark, d)
    path = scratch_path(spark, "incremental", uuid.uuid4().hex)
    for rows in (first, everything):
        incremental.upsert_by_key(spark, rows, path, "forecast_city_day_sk", ["forecast_date"])
    return finish(incremental.read_table(spark, path, everything.schema), 4)


# --- dashboard datasets --------------------------------------------------------

def _ranking(spark, d, wide=False, fill=False):
    m = _built(spark, d, "fct_city_weather_day", "fct_air_quality_city_day")
    return _ranked(m, wide, fill)


def _ranked(m: Warehouse, wide=False, fill=False):
    return V.ranking(m.read("fct_city_weather_day"), m.read("fct_air_quality_city_day"), wide=wide,
                     fill_aqi=fill)


@query("q_ranking")
def q_ranking(spark, d):
    return finish(_ranking(spark, d), 4)


@query("q_ranking_wide")
def q_ranking_wide(spark, d):
    return finish(_ranking(spark, d, wide=True, fill=True), 2)


@query("q_leaderboard")
def q_leaderboard(spark, d):
    r = _ranking(spark, d)
    return finish(with_position(r, V.leaderboard_order("Cleanest air"), "position"), 4)


@query("q_leaderboard_rows")
def q_leaderboard_rows(spark, d):
    return finish(V.leaderboard(_ranking(spark, d), "Overall index"), 4)


@query("q_top_bottom")
def q_top_bottom(spark, d):
    return finish(top_and_bottom(_ranking(spark, d), V.rank_order(), V.rank_reverse()), 4)


@query("q_kpis")
def q_kpis(spark, d):
    m = _built(spark, d, "fct_city_weather_day", "fct_air_quality_city_day")
    return finish(V.kpis(m.read("fct_city_weather_day"), _ranked(m)), 2)


@query("q_meters")
def q_meters(spark, d):
    m = _built(spark, d, "fct_city_weather_day", "fct_air_quality_city_day")
    return finish(V.meters(_ranked(m), m.read("fct_air_quality_city_day")), 4)


@query("q_city_map")
def q_city_map(spark, d):
    m = _built(spark, d, "dim_location", "fct_city_weather_day", "fct_air_quality_city_day")
    return finish(V.city_map(_ranked(m), m.read("dim_location")), 4)


@query("q_season_chart")
def q_season_chart(spark, d):
    m = _built(spark, d, "mart_city_season_summary", "fct_air_quality_city_day")
    return finish(V.season_chart(_ranked(m), m.read("mart_city_season_summary")), 4)


@query("q_thermal_grid")
def q_thermal_grid(spark, d):
    return finish(V.thermal_grid(_marts(spark, d).fct_city_weather_day), 4)


@query("q_city_table")
def q_city_table(spark, d):
    r = _ranking(spark, d)
    return finish(r.select("city_name", "days", "avg_temp", "comfortable_days", "rainy_days",
                           "windy_days", "hot_days", "comfort_score", "avg_european_aqi",
                           "overall_comfort_index").withColumnsRenamed({
        "city_name": "City", "days": "Days", "avg_temp": "Avg_C",
        "comfortable_days": "Comfortable", "rainy_days": "Rainy", "windy_days": "Windy",
        "hot_days": "Hot", "comfort_score": "Comfort_score", "avg_european_aqi": "Avg_AQI",
        "overall_comfort_index": "Overall_index"}), 2)


@query("q_weather_x_air")
def q_weather_x_air(spark, d):
    """Daily 'purchase' rollup (weather-shaped) joined to the AQ fact on
    (name, day), with the day label and marker size."""
    w = B.Inputs(spark, d).actual
    a = _marts(spark, d).fct_air_quality_city_day.withColumnRenamed("air_quality_date", "weather_date")
    j = w.select("city_name", "weather_date", "temperature_2m_mean", "precipitation_sum").join(
        a.select("city_name", "weather_date", "avg_european_aqi", "aqi_band"),
        ["city_name", "weather_date"], "inner")
    return finish(j.withColumns({
        "day": F.date_format("weather_date", "dd MMM"),
        "precip_size": F.greatest(F.col("precipitation_sum"), F.lit(0.0)) + F.lit(2.0),
    }), 4)


def _planner(spark, d, season=None, avoid_heat=False):
    """The planner reads its marts several times (scores and global bounds), so
    they are built first."""
    names = ["mart_city_weather_summary", "mart_city_season_summary", "mart_city_month_summary",
             "mart_extreme_events"]
    m = _built(spark, d, *(n for n in names if avoid_heat or n != "mart_extreme_events"))
    extremes = m.read("mart_extreme_events") if avoid_heat else None
    return V.planner(*[m.read(n) for n in names[:3]], extremes, season, avoid_heat)


@query("q_planner")
def q_planner(spark, d):
    return finish(_planner(spark, d), 4)


@query("q_planner_season")
def q_planner_season(spark, d):
    return finish(_planner(spark, d, "Winter", True), 4)


@query("q_planner_top")
def q_planner_top(spark, d):
    p = _planner(spark, d)
    order = [F.col("match").desc_nulls_last(), F.col("city_name")]
    from dayframe.operators.order import top_k_with_position
    return finish(top_k_with_position(p, order, 5, "position"), 4)


@query("q_best_month")
def q_best_month(spark, d):
    return V.best_month(_marts(spark, d).mart_city_month_summary)


@query("q_radar")
def q_radar(spark, d):
    return finish(V.radar(_ranking(spark, d)), 4)


@query("q_season_cards")
def q_season_cards(spark, d):
    seasons = spark.createDataFrame([(s, i + 1) for i, s in enumerate(SEASON_ORDER)],
                                    "season string, season_order int")
    return finish(V.season_cards(_marts(spark, d).mart_city_season_summary, seasons), 4)


@query("q_pivot")
def q_pivot(spark, d):
    fct = _marts(spark, d).fct_city_weather_day
    p = fct.groupBy("city_name").pivot("season", SEASON_ORDER).avg("temperature_2m_mean")
    return finish(p, 2)


MELT_LABELS = {k: v for k, v in V.DAY_TYPES.items() if k != "freezing_days"}


@query("q_melt")
def q_melt(spark, d):
    return V.melt_counts(_ranking(spark, d), MELT_LABELS)


@query("q_day_types")
def q_day_types(spark, d):
    return V.melt_counts(_ranking(spark, d, wide=True), V.DAY_TYPES)


@query("q_extreme_long")
def q_extreme_long(spark, d):
    ext = _marts(spark, d).mart_extreme_events
    top = top_k(ext, [F.col("heatwave_days").desc(), F.col("city_name")], 10)
    return V.melt_counts(top, {"heatwave_days": "Heatwave", "cold_snap_days": "Cold snap",
                               "heavy_rain_days": "Heavy rain"}, var="kind", value="days")


@query("q_extreme_champions")
def q_extreme_champions(spark, d):
    return V.extreme_champions(_marts(spark, d).mart_extreme_events)


@query("q_unusual_days")
def q_unusual_days(spark, d):
    return finish(V.unusual_days(_marts(spark, d).mart_temperature_anomaly), 2)


@query("q_rain_cells")
def q_rain_cells(spark, d):
    fct = _marts(spark, d).fct_city_weather_day
    return finish(fct.groupBy("weather_date", "city_name").agg(
        F.sum("precipitation_sum").alias("precipitation_sum")), 2)


# --- geography -----------------------------------------------------------------

def _suppliers_located(spark, d):
    s = B.table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    lat, lon = B.nation_coords("s_suppkey", 31, 59)
    return s.select(F.col("s_name").alias("city"), "s_suppkey", "s_nationkey",
                    lat.alias("lat"), lon.alias("lon"),
                    F.col("s_nationkey").cast("string").alias("region"))


@query("q_nearest")
def q_nearest(spark, d):
    sup = _suppliers_located(spark, d)
    dim = _marts(spark, d).dim_location
    near = geo.nearest(sup, dim, "s_suppkey", "location_id", "lat", "lon", "latitude", "longitude")
    return finish(near, 4)


def _proxy(spark, d, start=None, end=None):
    m = _built(spark, d, "dim_location", "fct_city_weather_day")
    dim = m.read("dim_location", ["location_id", "city_name", "latitude", "longitude"])
    sup = _suppliers_located(spark, d)
    near = geo.nearest(sup, dim, "s_suppkey", "location_id", "lat", "lon", "latitude", "longitude")
    days = V.slice_days(m.read("fct_city_weather_day"), "city_name", None, "weather_date", start, end)
    out = geo.proxy_series(sup, near, dim.drop("longitude"), days)
    return out.withColumn("pulse_size", sql_round("pulse_size", 2))


@query("q_proxy_estimate")
def q_proxy_estimate(spark, d):
    return _proxy(spark, d)


@query("q_proxy_fallback")
def q_proxy_fallback(spark, d):
    """One day only: places whose nearest source has no weather that day get the
    days of all sources."""
    return _proxy(spark, d, "1995-03-01", "1995-03-01")


# --- payloads and text -------------------------------------------------------------

def pack_event_payloads(spark, d) -> DataFrame:
    """Events of each (user, day, block of 256 event ids) packed as one JSON
    payload with parallel arrays, the shape of an hourly API response."""
    e = B.table(spark, d, "events")
    grouped = e.groupBy("user_id", F.to_date("ts").alias("day"),
                        F.floor(F.col("event_id") / 256).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("ts", "event_id", "event_type", "value"))).alias("r"))
    body = F.to_json(F.struct(
        F.lit(0.0).alias("latitude"), F.lit(0.0).alias("longitude"), F.lit("UTC").alias("timezone"),
        F.struct(F.transform("r", lambda x: x["ts"].cast("string")).alias("time"),
                 F.transform("r", lambda x: x["event_id"]).alias("event_id"),
                 F.transform("r", lambda x: x["value"]).alias("value")).alias("hourly")))
    return grouped.select("user_id", body.alias("payload"))


@query("q_payload")
def q_payload(spark, d):
    packed = pack_event_payloads(spark, d)
    rows = P.payload_rows(packed, "payload", "hourly",
                          {"event_id": T.LongType(), "value": T.DoubleType()},
                          time_alias="ts", time_type="timestamp_ntz",
                          tags={"source_name": F.lit("events"), "user_id": F.col("user_id")})
    return rows.select("source_name", "user_id", "event_id", "ts", "value")


ORDER_ARRAYS = {"order_id": T.LongType(), "price": T.DoubleType()}


def pack_order_payloads(spark, d) -> DataFrame:
    """Each customer's orders (in blocks of 4,096 order keys) packed as a daily
    payload; customers without orders answer ``{}``. Every 50th customer's answer
    is cut off, the next one's is an error answer, the one after has an array that
    is too long."""
    o = B.table(spark, d, "orders")
    c = B.table(spark, d, "customer").select("c_custkey")
    days = o.groupBy("o_custkey", F.floor(F.col("o_orderkey") / 4096).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("o_orderkey", "o_orderdate", "o_totalprice"))).alias("r"))
    body = F.to_json(F.struct(
        F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"), F.lit("UTC").alias("timezone"),
        F.struct(F.transform("r", lambda x: F.to_date(x["o_orderdate"]).cast("string")).alias("time"),
                 F.transform("r", lambda x: x["o_orderkey"]).alias("order_id"),
                 F.when(F.col("c_custkey") % 50 == 2, F.concat(
                     F.transform("r", lambda x: x["o_totalprice"]), F.array(F.lit(0.0)))).otherwise(
                     F.transform("r", lambda x: x["o_totalprice"])).alias("price")).alias("daily")))
    packed = c.join(days, c.c_custkey == days.o_custkey, "left").withColumn(
        "full", F.when(F.col("r").isNull(), F.lit("{}")).otherwise(body))
    kind = F.col("c_custkey") % 50
    return packed.select("c_custkey", F.when(
        kind == 0, F.expr("left(full, length(full) - 1)")).when(
        kind == 1, F.lit('{"error": true, "reason": "quota"}')).otherwise(
        F.col("full")).alias("payload"))


@query("q_payload_daily")
def q_payload_daily(spark, d):
    return P.payload_rows(pack_order_payloads(spark, d), "payload", "daily", ORDER_ARRAYS,
                          time_alias="order_date", tags={"c_custkey": F.col("c_custkey")})


@query("q_payload_rejects")
def q_payload_rejects(spark, d):
    return P.payload_rejects(pack_order_payloads(spark, d), "payload", "daily", ORDER_ARRAYS,
                             tags={"c_custkey": F.col("c_custkey")}).groupBy(
        "c_custkey", "reason").agg(F.count("*").alias("payloads"))


def _geocoded(spark, d):
    """Suppliers looked up by name: the answer is their nation, none, or cut off."""
    n = B.table(spark, d, "nation").join(B.table(spark, d, "region"),
                                         F.col("n_regionkey") == F.col("r_regionkey"))
    hit = n.select("n_nationkey", F.to_json(F.struct(F.array(F.struct(
        F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"),
        F.col("r_name").alias("country"), F.col("n_regionkey").cast("string").alias("country_code"),
        F.lit(1.5).alias("latitude"), F.lit(2.5).alias("longitude"), F.lit("UTC").alias("timezone"),
        F.lit(7).alias("population")), F.struct(
        F.lit(-1).cast("long").alias("id"), F.lit("second").alias("name"), F.lit("").alias("country"),
        F.lit("").alias("country_code"), F.lit(0.0).alias("latitude"), F.lit(0.0).alias("longitude"),
        F.lit("").alias("timezone"), F.lit(0).alias("population"))).alias("results"))).alias("answer"))
    s = B.table(spark, d, "supplier")
    k = F.col("s_suppkey") % 10
    asked = s.join(hit, s.s_nationkey == hit.n_nationkey).select("s_suppkey", "s_name", F.when(
        k == 0, F.lit('{"results": []}')).when(k == 1, F.lit("{}")).when(
        k == 2, F.lit('{"results": [')).otherwise(F.col("answer")).alias("payload"),
        F.lit("2024-02-01").alias("extracted_at"))
    return P.geocode_locations(asked, "payload", "s_name")


@query("q_geocode")
def q_geocode(spark, d):
    return _geocoded(spark, d)[0].groupBy("location_id", "city_name", "country", "country_code").agg(
        F.count("*").alias("hits"), F.max("latitude").alias("latitude"))


@query("q_geocode_rejects")
def q_geocode_rejects(spark, d):
    return _geocoded(spark, d)[1]


# --- files -------------------------------------------------------------------------

def _orders_csv(spark, d):
    """Orders written as CSV, with lines that do not fit beside them, and read again."""
    o = B.table(spark, d, "orders")
    path = scratch_path(spark, "csv", uuid.uuid4().hex)
    write_csv(o, path)
    bad = o.where(F.col("o_orderkey") % 89 == 0)
    text = [F.col(c).cast("string").alias(c) for c in o.columns]
    bad.select(*text).withColumn("o_totalprice", F.lit("n/a")).write.mode("append").option(
        "header", True).csv(path)
    return load_csv(spark, path, o.schema)


@query("q_csv_orders")
def q_csv_orders(spark, d):
    return _orders_csv(spark, d)[0]


@query("q_csv_rejects")
def q_csv_rejects(spark, d):
    return _orders_csv(spark, d)[1].select(
        F.split("line", ",")[0].cast("long").alias("o_orderkey"),
        F.split("line", ",")[3].alias("value"))


@query("q_many_runs")
def q_many_runs(spark, d):
    """A run a year lands what each customer ordered in it; all runs are read
    together, the run taken from the path, and each customer's newest kept."""
    o = B.table(spark, d, "orders").withColumn("landed", F.date_trunc("year", "o_orderdate"))
    runs = o.groupBy("o_custkey", "landed").agg(
        F.count("*").alias("n_orders"), F.max("o_totalprice").alias("top_price"))
    path = scratch_path(spark, "runs", uuid.uuid4().hex)
    write_snapshot(runs, path, "landed")
    schema = T.StructType([f for f in runs.schema.fields if f.name != "landed"])
    every = read_runs(spark, path, schema, folder="landed")
    return newest_run(every.drop("file"), ["o_custkey"])


@query("q_optional_mart")
def q_optional_mart(spark, d):
    """Forecast errors beside the places: from the mart where it was built, and
    from the empty relation of its type where it was not."""
    m = _built(spark, d, "dim_location", "fct_forecast_city_day")
    schema = m.read("fct_forecast_city_day").schema
    parts = []
    for state, path in (("built", m.path("fct_forecast_city_day")), ("missing", m.path("no_such_mart"))):
        mae = mean_abs_error(read_mart(spark, path, schema=schema))
        parts.append(m.read("dim_location").select("city_name").join(mae, "city_name", "left").select(
            F.lit(state).alias("mart"), "city_name", "abs_temperature_error"))
    return finish(parts[0].unionByName(parts[1]), 4)


@query("q_new_columns")
def q_new_columns(spark, d):
    """The first load has no error columns; a later one brings them."""
    first, everything = _snapshot_runs(spark, d)
    path = scratch_path(spark, "incremental", uuid.uuid4().hex)
    late = ["abs_temperature_error", "abs_precipitation_error"]
    for rows in (first.drop(*late), everything):
        incremental.append_new(spark, rows, path, "forecast_extracted_at", ["forecast_date"])
    return finish(incremental.read_table(spark, path).select(
        "forecast_city_day_sk", "forecast_extracted_at", *late), 4)


@query("q_slug")
def q_slug(spark, d):
    doc = B.table(spark, d, "documents")
    return doc.select("doc_id", slug("text").alias("text_slug"), slug("source").alias("source_slug"))


# --- data quality --------------------------------------------------------------------

@query("q_dq_unique")
def q_dq_unique(spark, d):
    return quality.unique(B.table(spark, d, "orders"), "o_custkey")


@query("q_dq_not_null")
def q_dq_not_null(spark, d):
    stg = B.Inputs(spark, d).air_hourly
    return finish(quality.not_null(stg, "pm2_5").select("air_quality_hourly_sk", "location_id",
                                                        "reading_timestamp", "pm10"), 2)


@query("q_dq_relationships")
def q_dq_relationships(spark, d):
    return quality.relationships(B.table(spark, d, "documents").select("doc_id", "source"),
                                 "doc_id", B.table(spark, d, "labels"), "doc_id")


@query("q_dq_accepted")
def q_dq_accepted(spark, d):
    return quality.accepted_values(B.table(spark, d, "orders").select("o_orderkey", "o_orderstatus"),
                                   "o_orderstatus", ["F", "O"])


@query("q_dq_between")
def q_dq_between(spark, d):
    return quality.between(B.table(spark, d, "orders").select("o_orderkey", "o_totalprice"),
                           "o_totalprice", 1000.0, 400000.0)


@query("q_dq_non_negative")
def q_dq_non_negative(spark, d):
    return quality.non_negative(B.table(spark, d, "customer").select("c_custkey", "c_acctbal"),
                                "c_acctbal")


@query("q_dq_singular")
def q_dq_singular(spark, d):
    fct = _marts(spark, d).fct_city_weather_day
    return finish(quality.out_of_range(
        fct, "temperature_2m_min", "temperature_2m_max", 1500 * B.PRICE_SCALE, 450000 * B.PRICE_SCALE,
        ["location_id", "weather_date", "temperature_2m_min", "temperature_2m_max",
         "temperature_2m_mean"]), 2)


@query("q_dq_report")
def q_dq_report(spark, d):
    names = ["dim_location", "fct_city_weather_day", "mart_city_weather_summary",
             "fct_air_quality_city_day"]
    m = _built(spark, d, *names)
    tables = {n: m.read(n) for n in names} | {"orders": B.table(spark, d, "orders")}
    return quality.run_suite(tables, dq_checks())


def dq_checks() -> list[quality.Check]:
    Q = quality
    measures = ["avg_pm10", "avg_pm2_5", "avg_carbon_monoxide", "avg_nitrogen_dioxide", "avg_ozone",
                "avg_european_aqi"]
    return [
        Q.Check("dim_location.location_sk unique", "dim_location", Q.Unique("location_sk")),
        Q.Check("dim_location.city_name not_null", "dim_location", Q.RowRule(Q.is_missing("city_name"))),
        Q.Check("fct_city_weather_day.season accepted", "fct_city_weather_day",
                Q.RowRule(Q.is_outside("season", SEASON_ORDER))),
        Q.Check("fct_city_weather_day.location_sk relationships", "fct_city_weather_day",
                Q.Relationship("location_sk", "dim_location", "location_sk")),
        Q.Check("mart_city_weather_summary.comfort_score between", "mart_city_weather_summary",
                Q.RowRule(Q.is_beyond("comfort_score", 0, 100))),
        Q.Check("fct_air_quality_city_day.aqi non_negative", "fct_air_quality_city_day",
                Q.RowRule(Q.is_any_negative(["avg_european_aqi"]))),
        Q.Check("fct_air_quality_city_day aqi singular", "fct_air_quality_city_day",
                Q.RowRule(Q.is_any_negative(measures))),
        Q.Check("orders.o_custkey unique", "orders", Q.Unique("o_custkey"), severity="warn"),
    ]


@query("q_dq_panel")
def q_dq_panel(spark, d):
    m = _marts(spark, d)
    fct = m.fct_city_weather_day
    return fct.agg(F.count(F.lit(1)).alias("city_days"),
                   F.max("weather_date").alias("latest_obs")).select(
        m.mart_city_weather_summary.select(F.count(F.lit(1))).scalar().alias("cities"),
        "city_days", "latest_obs",
        F.date_format("latest_obs", "dd MMM yyyy").alias("latest_label"))


@query("q_freshness")
def q_freshness(spark, d):
    raw = B.raw_air_hourly(spark, d)
    return finish(quality.freshness(raw, "extracted_at", dt.datetime(2024, 2, 1)), 4)


@query("q_contracts")
def q_contracts(spark, d):
    """Enforce the three mart contracts; returns the contracted marts' row counts."""
    from dayframe import schemas
    m = _marts(spark, d)
    parts = []
    for name, df in [("dim_location", m.dim_location),
                     ("mart_city_season_summary", m.mart_city_season_summary),
                     ("mart_extreme_events", m.mart_extreme_events)]:
        checked = quality.enforce_contract(df, schemas.CONTRACTS[name])
        parts.append(checked.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("model"), "n_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- streaming -------------------------------------------------------------------------

@query("q_stream_daily")
def q_stream_daily(spark, d):
    """Events read as a file stream -> located hourly readings -> watermarked
    daily windows -> stream-static band join -> Parquet sink. Days whose
    window has closed (end <= newest event time) are emitted."""
    from dayframe.operators.staging import stage_air_quality_hourly
    from dayframe.sources.readers import aqi_bands
    from dayframe.streaming import daily as S
    events = spark.readStream.schema(B.table(spark, d, "events").schema) \
        .option("pathGlobFilter", "events.parquet").parquet(d)
    hourly = stage_air_quality_hourly(B.raw_air_hourly(spark, d, events))
    days = S.with_bands(S.daily_rollup_stream(hourly, "0 seconds"), aqi_bands(spark))
    out = scratch_path(spark, "stream", uuid.uuid4().hex)
    S.run_to_parquet(days, out + "/data", out + "/_checkpoint")
    res = spark.read.parquet(out + "/data")
    return finish(res.select(
        F.col("air_quality_daily_sk").alias("air_quality_city_day_sk"),
        surrogate_key("location_id").alias("location_sk"),
        *[c for c in res.columns if c not in ("air_quality_daily_sk", "band_order")],
        F.col("band_order").alias("aqi_band_order")), 4)


def _stream_exact(spark, d, idle):
    from dayframe.operators.staging import stage_air_quality_hourly
    from dayframe.sources.readers import aqi_bands
    from dayframe.streaming import daily as S
    events = spark.readStream.schema(B.table(spark, d, "events").schema) \
        .option("pathGlobFilter", "events.parquet").parquet(d)
    hourly = stage_air_quality_hourly(B.raw_air_hourly(spark, d, events))
    bands = aqi_bands(spark)
    base = scratch_path(spark, "stream-exact", uuid.uuid4().hex)
    out = S.exact_daily_rollup(hourly, base, base + "/_checkpoint", dt.timedelta(0),
                               finish=lambda days: S.with_bands(days, bands), idle=idle)
    res = S.read_days(spark, out)
    return finish(res.select(
        F.col("air_quality_daily_sk").alias("air_quality_city_day_sk"),
        surrogate_key("location_id").alias("location_sk"),
        *[c for c in res.columns if c not in ("air_quality_daily_sk", "band_order")],
        F.col("band_order").alias("aqi_band_order")), 4)


@query("q_stream_daily_exact")
def q_stream_daily_exact(spark, d):
    """q_stream_daily through ``foreachBatch``: closed days are rolled up by the
    batch rollup with the distributed exact percentile (no per-day percentile
    state); silent entities are not waited for."""
    return _stream_exact(spark, d, dt.timedelta(0))


@query("q_stream_entity_days")
def q_stream_entity_days(spark, d):
    """The same with a watermark per entity only: a day is emitted once its own
    entity has a reading behind it."""
    return _stream_exact(spark, d, None)


@query("q_stream_snapshots")
def q_stream_snapshots(spark, d):
    """Forecast snapshots land as timestamped partitions in two rounds; a
    file stream upserts each round into the fact table by key."""
    from dayframe.streaming import daily as S
    first, everything = _snapshot_runs(spark, d)
    later = everything.filter(F.col("forecast_extracted_at")
                              > F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    base = scratch_path(spark, "stream-snapshots", uuid.uuid4().hex)
    snaps, target, ckpt = base + "/snapshots", base + "/fact", base + "/_checkpoint"
    schema = T.StructType([*everything.schema.fields, T.StructField("run", T.StringType())])
    for part in (first, later):
        write_snapshot(part.withColumn("run", F.col("forecast_extracted_at")), snaps, "run")
        S.snapshot_upserts(spark, snaps, schema, target, "forecast_city_day_sk", ckpt,
                           ["forecast_date"], drop=["run"])
    return finish(incremental.read_table(spark, target, everything.schema), 4)
