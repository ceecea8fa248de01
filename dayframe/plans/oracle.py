"""Reference SQL (DuckDB dialect) for the registered queries.

The CTEs restate the bindings and models in plain SQL over the benchmark
views; the Spark side is checked against them row by row.
"""

from __future__ import annotations

from dayframe.functions.columns import SURROGATE_NULL_TOKEN
from dayframe.plans.build import TABLES


def sk(*exprs: str) -> str:
    parts = ", ".join(f"coalesce(CAST({e} AS VARCHAR), '{SURROGATE_NULL_TOKEN}')" for e in exprs)
    return f"md5(concat_ws('-', {parts}))"


def rnd(sql: str, cols: list[str], digits: int) -> str:
    rep = ", ".join(f"round({c}, {digits}) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) q"


def season(col: str) -> str:
    return (f"CASE WHEN month({col}) IN (12, 1, 2) THEN 'Winter' "
            f"WHEN month({col}) IN (3, 4, 5) THEN 'Spring' "
            f"WHEN month({col}) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END")


def measures(v: str) -> str:
    precip = f"sum({v})"
    return (f"max({v}) AS temperature_2m_max, min({v}) AS temperature_2m_min, "
            f"avg({v}) AS temperature_2m_mean, {precip} AS precipitation_sum, "
            f"CAST(count(*) AS DOUBLE) AS rain_sum, CAST(0 AS DOUBLE) AS snowfall_sum, "
            f"sum({v}) AS wind_speed_10m_max")


MEAS = ["temperature_2m_max", "temperature_2m_min", "temperature_2m_mean", "precipitation_sum",
        "rain_sum", "snowfall_sum", "wind_speed_10m_max"]
MEAS_LIST = ", ".join(MEAS)

CTES = {
    "names": """SELECT n_nationkey AS location_id, n_name AS city_name,
        CAST(n_regionkey AS VARCHAR) AS country_code FROM nation""",
    "locs": f"""SELECT n.n_nationkey AS location_id, n.n_name AS city_name, r.r_name AS country,
        CAST(n.n_regionkey AS VARCHAR) AS country_code, r.r_name AS admin1,
        CAST((n.n_nationkey * 37) % 120 - 60 AS DOUBLE) AS latitude,
        CAST((n.n_nationkey * 73) % 360 - 180 AS DOUBLE) AS longitude,
        'UTC' AS timezone, CAST(n.n_regionkey * 100 AS DOUBLE) AS elevation,
        CAST(n.n_nationkey * 1000 + 500 AS INTEGER) AS population,
        TIMESTAMP '2024-02-01 00:00:00' AS extracted_at, {sk('n.n_nationkey')} AS location_sk
        FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "dim": """SELECT location_sk, location_id, city_name, country, country_code, admin1, latitude,
        longitude, timezone, elevation, population FROM locs""",
    "wraw": f"""SELECT c.c_nationkey AS location_id, CAST(o.o_orderdate AS DATE) AS d,
        max(o.o_orderdate) AS extracted_at, {measures('o.o_totalprice * (pi() / 3000)')}
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2""",
    "wstg": f"""SELECT w.location_id, nm.city_name, nm.country_code, w.d AS weather_date,
        CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude, 'UTC' AS timezone,
        {MEAS_LIST}, w.extracted_at, {sk('w.location_id', 'w.d')} AS weather_daily_sk
        FROM wraw w JOIN names nm ON w.location_id = nm.location_id""",
    "cdw": """SELECT w.location_id, l.city_name, l.country, l.country_code, l.latitude, l.longitude,
        l.timezone, l.population, l.elevation, w.weather_date, w.temperature_2m_max,
        w.temperature_2m_min, w.temperature_2m_mean, w.precipitation_sum, w.rain_sum,
        w.snowfall_sum, w.wind_speed_10m_max, w.extracted_at,
        w.weather_daily_sk AS city_day_weather_sk,
        w.temperature_2m_max - w.temperature_2m_min AS temp_range_c,
        w.rain_sum > 1.0 AS is_rainy, w.wind_speed_10m_max > 450000 * (pi() / 3000) AS is_windy,
        w.temperature_2m_max > 385000 * (pi() / 3000) AS is_hot,
        w.temperature_2m_min < 60000 * (pi() / 3000) AS is_freezing
        FROM wstg w JOIN locs l ON w.location_id = l.location_id""",
    "fct": f"""SELECT city_day_weather_sk AS city_weather_day_sk, {sk('location_id')} AS location_sk,
        location_id, city_name, country_code, weather_date, {season('weather_date')} AS season,
        temperature_2m_max, temperature_2m_min, temperature_2m_mean, temp_range_c,
        precipitation_sum, rain_sum, snowfall_sum, wind_speed_10m_max,
        is_rainy, is_windy, is_hot, is_freezing,
        (temperature_2m_mean BETWEEN 180000 * (pi() / 3000) AND 360000 * (pi() / 3000) AND NOT is_rainy AND NOT is_windy
         AND NOT is_hot AND NOT is_freezing) AS is_comfortable FROM cdw""",
    "ev": """SELECT e.* REPLACE (e.value * (pi() / 3) AS value), c.c_nationkey AS location_id FROM events e
        JOIN customer c ON e.user_id = c.c_custkey""",
    "aqstg": f"""SELECT e.location_id, nm.city_name, nm.country_code, e.ts AS reading_timestamp,
        CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude, 'UTC' AS timezone,
        CASE WHEN e.event_type <> 'signup' THEN e.value END AS pm10,
        CASE WHEN e.event_type IN ('view', 'click') THEN e.value END AS pm2_5,
        e.value AS carbon_monoxide,
        CASE WHEN e.event_type = 'error' THEN e.value END AS nitrogen_dioxide,
        CASE WHEN e.event_type = 'purchase' THEN e.value END AS ozone,
        CASE WHEN e.event_type <> 'signup' THEN e.value END AS european_aqi,
        e.ts AS extracted_at, {sk('e.location_id', 'e.ts')} AS air_quality_hourly_sk
        FROM ev e JOIN names nm ON e.location_id = nm.location_id""",
    "aqd": f"""SELECT location_id, city_name, country_code,
        CAST(reading_timestamp AS DATE) AS air_quality_date,
        avg(pm10) AS avg_pm10, max(pm10) AS max_pm10, quantile_cont(pm10, 0.95) AS p95_pm10,
        avg(pm2_5) AS avg_pm2_5, max(pm2_5) AS max_pm2_5, quantile_cont(pm2_5, 0.95) AS p95_pm2_5,
        avg(carbon_monoxide) AS avg_carbon_monoxide, max(carbon_monoxide) AS max_carbon_monoxide,
        avg(nitrogen_dioxide) AS avg_nitrogen_dioxide, max(nitrogen_dioxide) AS max_nitrogen_dioxide,
        avg(ozone) AS avg_ozone, max(ozone) AS max_ozone,
        avg(european_aqi) AS avg_european_aqi, max(european_aqi) AS max_european_aqi,
        quantile_cont(european_aqi, 0.95) AS p95_european_aqi,
        count(*) AS hourly_readings_count,
        {sk('location_id', 'CAST(reading_timestamp AS DATE)')} AS air_quality_daily_sk
        FROM aqstg WHERE pm10 IS NOT NULL OR pm2_5 IS NOT NULL OR european_aqi IS NOT NULL
        GROUP BY location_id, city_name, country_code, CAST(reading_timestamp AS DATE)""",
    "bands": """SELECT CAST(band_order AS INTEGER) AS band_order, aqi_band,
        CAST(aqi_min AS DOUBLE) AS aqi_min, CAST(aqi_max AS DOUBLE) AS aqi_max FROM (VALUES
        (1, 'Good', 0, 20), (2, 'Fair', 20, 40), (3, 'Moderate', 40, 60), (4, 'Poor', 60, 80),
        (5, 'Very Poor', 80, 100), (6, 'Extremely Poor', 100, 100000))
        t(band_order, aqi_band, aqi_min, aqi_max)""",
    "aqf": f"""SELECT a.air_quality_daily_sk AS air_quality_city_day_sk,
        {sk('a.location_id')} AS location_sk, a.location_id, a.city_name, a.country_code,
        a.air_quality_date, a.avg_pm10, a.max_pm10, a.p95_pm10, a.avg_pm2_5, a.max_pm2_5,
        a.p95_pm2_5, a.avg_carbon_monoxide, a.max_carbon_monoxide, a.avg_nitrogen_dioxide,
        a.max_nitrogen_dioxide, a.avg_ozone, a.max_ozone, a.avg_european_aqi,
        a.max_european_aqi, a.p95_european_aqi, a.hourly_readings_count, b.aqi_band,
        b.band_order AS aqi_band_order
        FROM aqd a LEFT JOIN bands b
          ON a.avg_european_aqi >= b.aqi_min AND a.avg_european_aqi < b.aqi_max""",
    "sdaily": """SELECT location_id, city_name, country_code, weather_date, temperature_2m_max,
        temperature_2m_min, rain_sum, is_hot, is_freezing,
        precipitation_sum >= 400000 * (pi() / 3000) AS is_heavy_rain FROM cdw""",
    "sisl": """SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY weather_date) AS rn,
        row_number() OVER (PARTITION BY location_id, is_hot ORDER BY weather_date) AS rn_h,
        row_number() OVER (PARTITION BY location_id, is_freezing ORDER BY weather_date) AS rn_c,
        row_number() OVER (PARTITION BY location_id, is_heavy_rain ORDER BY weather_date) AS rn_w
        FROM sdaily""",
    "sruns": """SELECT *,
        count(*) OVER (PARTITION BY location_id, is_hot, rn - rn_h) AS len_h,
        count(*) OVER (PARTITION BY location_id, is_freezing, rn - rn_c) AS len_c,
        count(*) OVER (PARTITION BY location_id, is_heavy_rain, rn - rn_w) AS len_w FROM sisl""",
    "streaks": f"""SELECT {sk('location_id', 'weather_date')} AS extreme_streak_sk, location_id,
        city_name, country_code, weather_date, temperature_2m_max, temperature_2m_min, rain_sum,
        is_hot, is_freezing, is_heavy_rain,
        CASE WHEN is_hot THEN len_h ELSE 0 END AS heat_streak,
        CASE WHEN is_freezing THEN len_c ELSE 0 END AS cold_streak,
        CASE WHEN is_heavy_rain THEN len_w ELSE 0 END AS wet_streak,
        (is_hot AND len_h >= 3) AS in_heatwave, (is_freezing AND len_c >= 3) AS in_cold_snap,
        (is_heavy_rain AND len_w >= 2) AS in_wet_spell FROM sruns""",
    "extremes": f"""SELECT {sk('location_id')} AS location_sk, location_id, city_name, country_code,
        count(*) AS total_days, count(*) FILTER (WHERE is_hot) AS hot_days,
        count(*) FILTER (WHERE in_heatwave) AS heatwave_days,
        CAST(max(heat_streak) AS BIGINT) AS longest_heatwave,
        count(*) FILTER (WHERE is_freezing) AS freezing_days,
        count(*) FILTER (WHERE in_cold_snap) AS cold_snap_days,
        CAST(max(cold_streak) AS BIGINT) AS longest_cold_snap,
        count(*) FILTER (WHERE is_heavy_rain) AS heavy_rain_days,
        CAST(max(wet_streak) AS BIGINT) AS longest_wet_spell
        FROM streaks GROUP BY location_id, city_name, country_code""",
    "anom_stats": """SELECT location_id, city_name, country_code, weather_date, season,
        temperature_2m_mean,
        avg(temperature_2m_mean) OVER (PARTITION BY location_id, season) AS sm,
        stddev_samp(temperature_2m_mean) OVER (PARTITION BY location_id, season) AS sd FROM fct""",
    "anomaly": f"""SELECT {sk('location_id', 'weather_date')} AS anomaly_sk,
        {sk('location_id')} AS location_sk, location_id, city_name, country_code, weather_date,
        season, temperature_2m_mean, round(sm, 1) AS season_mean_c,
        round(temperature_2m_mean - sm, 1) AS anomaly_c,
        round((temperature_2m_mean - sm) / nullif(sd, 0), 2) AS anomaly_z,
        abs(temperature_2m_mean - sm) / nullif(sd, 0) >= 2.0 AS is_extreme_day FROM anom_stats""",
    "season_sum": f"""SELECT {sk('location_id', 'season')} AS city_season_sk,
        {sk('location_id')} AS location_sk, location_id, city_name, country_code, season,
        count(*) AS total_days, round(avg(temperature_2m_mean), 1) AS avg_temperature_c,
        round(avg(temperature_2m_max), 1) AS avg_max_temperature_c,
        round(avg(temperature_2m_min), 1) AS avg_min_temperature_c,
        round(sum(precipitation_sum), 1) AS total_precipitation_mm,
        count(*) FILTER (WHERE is_comfortable) AS comfortable_days,
        count(*) FILTER (WHERE is_rainy) AS rainy_days, count(*) FILTER (WHERE is_hot) AS hot_days,
        count(*) FILTER (WHERE is_freezing) AS freezing_days,
        round(CAST(100 AS DOUBLE) * count(*) FILTER (WHERE is_comfortable) / nullif(count(*), 0), 1)
          AS comfort_score
        FROM fct GROUP BY location_id, city_name, country_code, season""",
    "month_sum": f"""SELECT {sk('location_id', 'month(weather_date)')} AS city_month_sk,
        {sk('location_id')} AS location_sk, location_id, city_name, country_code,
        CAST(month(weather_date) AS INTEGER) AS month_num, strftime(weather_date, '%B') AS month_name,
        season, count(*) AS total_days, round(avg(temperature_2m_mean), 1) AS avg_temperature_c,
        round(avg(temperature_2m_max), 1) AS avg_max_temperature_c,
        round(sum(precipitation_sum), 1) AS total_precipitation_mm,
        count(*) FILTER (WHERE is_comfortable) AS comfortable_days,
        count(*) FILTER (WHERE is_rainy) AS rainy_days, count(*) FILTER (WHERE is_hot) AS hot_days,
        count(*) FILTER (WHERE is_freezing) AS freezing_days,
        round(CAST(100 AS DOUBLE) * count(*) FILTER (WHERE is_comfortable) / nullif(count(*), 0), 1)
          AS comfort_score
        FROM fct GROUP BY location_id, city_name, country_code, month(weather_date),
          strftime(weather_date, '%B'), season""",
    "wsum": """SELECT location_sk, location_id, count(*) AS total_days,
        min(weather_date) AS first_date, max(weather_date) AS last_date,
        round(avg(temperature_2m_mean), 1) AS avg_temperature_c,
        round(avg(temperature_2m_max), 1) AS avg_max_temperature_c,
        round(avg(temperature_2m_min), 1) AS avg_min_temperature_c,
        round(sum(precipitation_sum), 1) AS total_precipitation_mm,
        count(*) FILTER (WHERE is_comfortable) AS comfortable_days,
        count(*) FILTER (WHERE is_rainy) AS rainy_days, count(*) FILTER (WHERE is_windy) AS windy_days,
        count(*) FILTER (WHERE is_hot) AS hot_days, count(*) FILTER (WHERE is_freezing) AS freezing_days
        FROM fct GROUP BY location_sk, location_id""",
    "aqsum": """SELECT location_sk, round(avg(avg_european_aqi), 1) AS avg_air_quality_index,
        round(avg(avg_pm2_5), 1) AS avg_pm2_5, round(max(max_european_aqi), 1) AS worst_air_quality_index
        FROM aqf GROUP BY location_sk""",
    "city_sum": """SELECT l.location_sk, l.location_id, l.city_name, l.country, l.country_code,
        l.latitude, l.longitude, l.population, w.total_days, w.first_date, w.last_date,
        w.avg_temperature_c, w.avg_max_temperature_c, w.avg_min_temperature_c,
        w.total_precipitation_mm, w.comfortable_days, w.rainy_days, w.windy_days, w.hot_days,
        w.freezing_days, a.avg_air_quality_index, a.avg_pm2_5, a.worst_air_quality_index,
        round(CAST(100 AS DOUBLE) * w.comfortable_days / nullif(w.total_days, 0), 1) AS comfort_score,
        round(CAST(100 AS DOUBLE) * w.comfortable_days / nullif(w.total_days, 0)
              - coalesce(a.avg_air_quality_index, 0) * 0.5, 1) AS overall_comfort_index
        FROM dim l LEFT JOIN wsum w ON l.location_sk = w.location_sk
        LEFT JOIN aqsum a ON l.location_sk = a.location_sk""",
    "fraw": f"""SELECT location_id, CAST(ts AS DATE) AS d,
        CAST(CAST(ts AS DATE) + CAST(8 - isodow(CAST(ts AS DATE)) AS INTEGER) AS TIMESTAMP) AS extracted_at,
        {measures('value')} FROM ev WHERE event_type = 'view' GROUP BY 1, 2""",
    "fstg": f"""SELECT f.location_id, nm.city_name, nm.country_code, f.d AS forecast_date,
        {MEAS_LIST}, f.extracted_at FROM fraw f JOIN names nm ON f.location_id = nm.location_id""",
    "araw": f"""SELECT location_id, CAST(ts AS DATE) AS d, max(ts) AS extracted_at,
        {measures('value')} FROM ev WHERE event_type = 'purchase' GROUP BY 1, 2""",
    "astg": f"""SELECT a.location_id, nm.city_name, nm.country_code, a.d AS weather_date,
        {MEAS_LIST}, a.extracted_at FROM araw a JOIN names nm ON a.location_id = nm.location_id""",
    "fcast": f"""SELECT {sk('f.location_id', 'f.forecast_date', 'f.extracted_at')} AS forecast_city_day_sk,
        {sk('f.location_id')} AS location_sk, f.location_id, f.city_name, f.country_code,
        f.forecast_date, f.extracted_at AS forecast_extracted_at,
        f.temperature_2m_max AS forecast_temp_max, f.temperature_2m_min AS forecast_temp_min,
        f.temperature_2m_mean AS forecast_temp_mean, f.precipitation_sum AS forecast_precipitation,
        f.wind_speed_10m_max AS forecast_wind_speed_max,
        a.temperature_2m_max AS actual_temp_max, a.temperature_2m_min AS actual_temp_min,
        a.temperature_2m_mean AS actual_temp_mean, a.precipitation_sum AS actual_precipitation,
        a.wind_speed_10m_max AS actual_wind_speed_max,
        f.temperature_2m_max - a.temperature_2m_max AS temperature_max_error,
        f.temperature_2m_min - a.temperature_2m_min AS temperature_min_error,
        f.temperature_2m_mean - a.temperature_2m_mean AS temperature_mean_error,
        f.precipitation_sum - a.precipitation_sum AS precipitation_error,
        f.wind_speed_10m_max - a.wind_speed_10m_max AS wind_speed_error,
        abs(f.temperature_2m_mean - a.temperature_2m_mean) AS abs_temperature_error,
        abs(f.precipitation_sum - a.precipitation_sum) AS abs_precipitation_error
        FROM fstg f JOIN astg a ON f.location_id = a.location_id AND f.forecast_date = a.weather_date""",
    "ranking": """SELECT r.*, round(CAST(100 AS DOUBLE) * comfortable_days / nullif(days, 0), 1) AS comfort_score
        FROM (SELECT w.city_name, count(w.weather_date) AS days,
          count(*) FILTER (WHERE is_comfortable) AS comfortable_days,
          count(*) FILTER (WHERE is_rainy) AS rainy_days, count(*) FILTER (WHERE is_windy) AS windy_days,
          count(*) FILTER (WHERE is_hot) AS hot_days, avg(temperature_2m_mean) AS avg_temp
          FROM fct w GROUP BY w.city_name) r""",
    "rank": """SELECT r.*, a.avg_european_aqi,
        round(r.comfort_score - 0.5 * coalesce(a.avg_european_aqi, 0), 1) AS overall_comfort_index
        FROM ranking r LEFT JOIN (SELECT city_name, avg(avg_european_aqi) AS avg_european_aqi
          FROM aqf GROUP BY city_name) a ON r.city_name = a.city_name""",
    "sups": """SELECT s_name AS city, s_suppkey, s_nationkey,
        CAST((s_suppkey * 31) % 120 - 60 AS DOUBLE) AS lat,
        CAST((s_suppkey * 59) % 360 - 180 AS DOUBLE) AS lon,
        CAST(s_nationkey AS VARCHAR) AS region FROM supplier""",
    "near": """SELECT s_suppkey, arg_min(location_id, struct_pack(d := d, id := location_id)) AS location_id,
        min(d) AS distance_km FROM (
          SELECT s.s_suppkey, l.location_id,
            2 * 6371.0 * asin(sqrt(pow(sin((radians(l.latitude) - radians(s.lat)) / 2), 2)
              + cos(radians(s.lat)) * cos(radians(l.latitude))
              * pow(sin((radians(l.longitude) - radians(s.lon)) / 2), 2))) AS d
          FROM sups s CROSS JOIN dim l) GROUP BY s_suppkey""",
}

# dependency order matters: a CTE may only use earlier ones
ORDER = list(CTES)


def with_ctes(body: str, *needed: str) -> str:
    """Prefix ``body`` with the CTEs it needs (and their dependencies)."""
    import re
    want: set[str] = set()

    def add(name):
        if name in want:
            return
        want.add(name)
        for other in ORDER:
            if other != name and re.search(rf"\b{other}\b", CTES[name]):
                add(other)
    for n in needed:
        add(n)
    parts = [f"{n} AS ({CTES[n]})" for n in ORDER if n in want]
    return "WITH " + ",\n".join(parts) + "\n" + body


def _doubles(cols: str) -> list[str]:
    return [c.strip() for c in cols.split(",") if c.strip()]


WSTG_D = MEAS + ["latitude", "longitude"]
CDW_D = ["latitude", "longitude", "elevation"] + MEAS + ["temp_range_c"]
FCT_D = MEAS + ["temp_range_c"]
AQ_D = [f"{p}_{m}" for m in ["pm10", "pm2_5", "carbon_monoxide", "nitrogen_dioxide", "ozone", "european_aqi"]
        for p in ("avg", "max")] + ["p95_pm10", "p95_pm2_5", "p95_european_aqi"]
FC_D = ["forecast_temp_max", "forecast_temp_min", "forecast_temp_mean", "forecast_precipitation",
        "forecast_wind_speed_max", "actual_temp_max", "actual_temp_min", "actual_temp_mean",
        "actual_precipitation", "actual_wind_speed_max", "temperature_max_error",
        "temperature_min_error", "temperature_mean_error", "precipitation_error", "wind_speed_error",
        "abs_temperature_error", "abs_precipitation_error"]
RANK_D = ["avg_temp", "comfort_score", "avg_european_aqi", "overall_comfort_index"]

SQL: dict[str, str] = {}


def q(name: str, sql: str) -> None:
    SQL[name] = sql


q("q_stage_orders", rnd(with_ctes("SELECT * FROM wstg", "wstg"), WSTG_D, 2))
q("q_stage_events", rnd(with_ctes("SELECT * FROM aqstg", "aqstg"),
                        ["latitude", "longitude", "pm10", "pm2_5", "carbon_monoxide",
                         "nitrogen_dioxide", "ozone", "european_aqi"], 2))
q("q_dim", with_ctes("SELECT * FROM dim", "dim"))
q("q_project", rnd(with_ctes("""SELECT city_name, weather_date, season, temperature_2m_mean,
    is_comfortable FROM fct""", "fct"), ["temperature_2m_mean"], 2))
_BUILD = [
    ("dim_location", "dim", 11), ("fct_city_weather_day", "fct", 20),
    ("fct_air_quality_city_day", "aqf", 24), ("fct_forecast_city_day", "fcast", 24),
    ("mart_extreme_events", "extremes", 13), ("mart_temperature_anomaly", "anomaly", 12),
    ("mart_city_season_summary", "season_sum", 16), ("mart_city_month_summary", "month_sum", 17),
    ("mart_city_weather_summary", "city_sum", 25)]
q("q_build", with_ctes(" UNION ALL ".join(
    f"""SELECT '{m}' AS mart, count(*) AS n_rows, {n} AS n_columns, {n} AS n_described,
    '{TABLES[m].description.replace("'", "''")}' AS description FROM {cte}""" for m, cte, n in _BUILD),
    *[cte for _, cte, _ in _BUILD]))
q("q_synth_id", """SELECT s_suppkey, s_name,
    CAST(900000 + row_number() OVER (ORDER BY s_suppkey) AS INTEGER) AS location_id FROM supplier""")
q("q_surrogate_key", f"""SELECT o_orderkey, {sk('o_orderkey')} AS order_sk,
    {sk('o_custkey', 'CAST(o_orderdate AS DATE)', 'o_orderstatus')} AS cust_day_sk,
    {sk('o_orderkey', 'o_orderdate')} AS order_ts_sk FROM orders""")
q("q_season", f"""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
    {season('o_orderdate')} AS season FROM orders""")
q("q_enrich", rnd(with_ctes("""SELECT * EXCLUDE (temp_range_c, is_rainy, is_windy, is_hot,
    is_freezing) FROM cdw""", "cdw"), ["latitude", "longitude", "elevation"] + MEAS, 2))
q("q_flags", rnd(with_ctes("SELECT * FROM cdw", "cdw"), CDW_D, 2))
q("q_comfort", rnd(with_ctes("SELECT * FROM fct", "fct"), FCT_D, 2))
q("q_slice", rnd(with_ctes("""SELECT * FROM fct WHERE city_name IN ('NATION_1', 'NATION_3',
    'NATION_7', 'NATION_12', 'NATION_20') AND weather_date BETWEEN DATE '1996-01-01'
    AND DATE '1997-12-31'""", "fct"), FCT_D, 2))
q("q_hourly_daily", rnd(with_ctes("SELECT * FROM aqd", "aqd"), AQ_D, 4))
q("q_band_join", rnd(with_ctes("SELECT * FROM aqf", "aqf"), AQ_D, 4))
q("q_band_label", rnd(with_ctes("""SELECT location_id, air_quality_date, avg_european_aqi,
    CASE WHEN avg_european_aqi IS NULL THEN 'NO DATA' WHEN avg_european_aqi < 20 THEN 'GOOD'
    WHEN avg_european_aqi < 40 THEN 'FAIR' WHEN avg_european_aqi < 60 THEN 'MODERATE'
    WHEN avg_european_aqi < 80 THEN 'POOR' WHEN avg_european_aqi < 100 THEN 'VERY POOR'
    ELSE 'EXTREME' END AS aqi_label FROM aqd""", "aqd"), ["avg_european_aqi"], 4))
q("q_streaks", rnd(with_ctes("SELECT * FROM streaks", "streaks"),
                   ["temperature_2m_max", "temperature_2m_min", "rain_sum"], 2))
q("q_extreme_events", with_ctes("SELECT * FROM extremes", "extremes"))
q("q_anomaly", rnd(with_ctes("SELECT * FROM anomaly", "anomaly"),
                   ["temperature_2m_mean", "season_mean_c", "anomaly_c", "anomaly_z"], 2))
q("q_month_summary", with_ctes("SELECT * FROM month_sum", "month_sum"))
q("q_season_summary", with_ctes("SELECT * FROM season_sum", "season_sum"))
q("q_city_summary", with_ctes("SELECT * FROM city_sum", "city_sum"))
q("q_forecast_error", rnd(with_ctes("SELECT * FROM fcast", "fcast"), FC_D, 4))
q("q_forecast_mae", rnd(with_ctes("""SELECT city_name, avg(abs_temperature_error) AS abs_temperature_error
    FROM fcast WHERE abs_temperature_error IS NOT NULL GROUP BY city_name""", "fcast"),
    ["abs_temperature_error"], 4))
q("q_incremental_hwm", SQL["q_forecast_error"])
q("q_incremental_upsert", SQL["q_forecast_error"])
q("q_ranking", rnd(with_ctes("SELECT * FROM rank", "rank"), RANK_D, 4))
q("q_ranking_wide", rnd(with_ctes("""SELECT r.*, coalesce(a.avg_european_aqi, 0) AS avg_european_aqi,
    round(r.comfort_score - 0.5 * coalesce(a.avg_european_aqi, 0), 1) AS overall_comfort_index FROM (
      SELECT w.city_name, count(w.weather_date) AS days,
        count(*) FILTER (WHERE is_comfortable) AS comfortable_days,
        count(*) FILTER (WHERE is_rainy) AS rainy_days, count(*) FILTER (WHERE is_windy) AS windy_days,
        count(*) FILTER (WHERE is_hot) AS hot_days, avg(temperature_2m_mean) AS avg_temp,
        count(*) FILTER (WHERE is_freezing) AS freezing_days, max(temperature_2m_max) AS max_temp,
        min(temperature_2m_min) AS min_temp, sum(precipitation_sum) AS rain_mm,
        avg(wind_speed_10m_max) AS wind_kmh,
        round(CAST(100 AS DOUBLE) * count(*) FILTER (WHERE is_comfortable)
          / nullif(count(w.weather_date), 0), 1) AS comfort_score
      FROM fct w GROUP BY w.city_name) r
    LEFT JOIN (SELECT city_name, avg(avg_european_aqi) AS avg_european_aqi FROM aqf
      GROUP BY city_name) a ON r.city_name = a.city_name""", "fct", "aqf"),
    ["avg_temp", "max_temp", "min_temp", "rain_mm", "wind_kmh", "comfort_score", "avg_european_aqi",
     "overall_comfort_index"], 2))
q("q_leaderboard", rnd(with_ctes("""SELECT *, row_number() OVER (ORDER BY avg_european_aqi ASC NULLS LAST,
    city_name) AS position FROM rank""", "rank"), RANK_D, 4))
q("q_top_bottom", rnd(with_ctes("""SELECT * FROM (
      SELECT *, 'all' AS part FROM rank WHERE (SELECT count(*) FROM rank) <= 16
      UNION ALL SELECT * FROM (SELECT *, 'top' AS part FROM rank
        WHERE (SELECT count(*) FROM rank) > 16
        ORDER BY overall_comfort_index DESC NULLS LAST, city_name LIMIT 10)
      UNION ALL SELECT * FROM (SELECT *, 'bottom' AS part FROM rank
        WHERE (SELECT count(*) FROM rank) > 16
        ORDER BY overall_comfort_index ASC NULLS FIRST, city_name DESC LIMIT 5))""", "rank"),
    RANK_D, 4))
q("q_kpis", rnd(with_ctes("""SELECT count(*) AS cities, (SELECT avg(temperature_2m_mean) FROM fct) AS avg_temp,
    sum(comfortable_days) AS comfortable_days,
    (SELECT city_name FROM rank ORDER BY overall_comfort_index DESC NULLS LAST, city_name LIMIT 1) AS top_city,
    (SELECT overall_comfort_index FROM rank ORDER BY overall_comfort_index DESC NULLS LAST, city_name LIMIT 1)
      AS top_index FROM rank""", "rank", "fct"), ["avg_temp", "top_index"], 2))
q("q_meters", rnd(with_ctes("""SELECT avg(overall_comfort_index) AS overall_comfort,
    avg(comfort_score) AS comfort_score,
    coalesce((SELECT avg(avg_european_aqi) FROM aqf), 0) AS air_quality FROM rank""", "rank", "aqf"),
    ["overall_comfort", "comfort_score", "air_quality"], 4))
q("q_city_map", rnd(with_ctes("""SELECT r.*, d.latitude, d.longitude, d.population,
    sqrt(greatest(d.population, 1)) AS marker_size
    FROM rank r LEFT JOIN dim d ON r.city_name = d.city_name""", "rank", "dim"),
    RANK_D + ["marker_size"], 4))
q("q_season_chart", rnd(with_ctes("""SELECT city_name, season, avg_temperature_c, comfort_score,
    CASE season WHEN 'Winter' THEN 1 WHEN 'Spring' THEN 2 WHEN 'Summer' THEN 3 ELSE 4 END AS season_order
    FROM season_sum WHERE city_name IN (SELECT city_name FROM rank
      ORDER BY overall_comfort_index DESC NULLS LAST, city_name LIMIT 8)""", "season_sum", "rank"),
    ["avg_temperature_c", "comfort_score"], 4))
q("q_thermal_grid", rnd(with_ctes("""SELECT city_name, weather_date,
    avg(temperature_2m_mean) AS temperature_2m_mean FROM fct GROUP BY ALL""", "fct"),
    ["temperature_2m_mean"], 4))
q("q_city_table", rnd(with_ctes("""SELECT city_name AS "City", days AS "Days", avg_temp AS "Avg_C",
    comfortable_days AS "Comfortable", rainy_days AS "Rainy", windy_days AS "Windy", hot_days AS "Hot",
    comfort_score AS "Comfort_score", avg_european_aqi AS "Avg_AQI",
    overall_comfort_index AS "Overall_index" FROM rank""", "rank"),
    ["Avg_C", "Comfort_score", "Avg_AQI", "Overall_index"], 2))
q("q_weather_x_air", rnd(with_ctes("""SELECT w.city_name, w.weather_date, w.temperature_2m_mean,
    w.precipitation_sum, a.avg_european_aqi, a.aqi_band, strftime(w.weather_date, '%d %b') AS day,
    greatest(w.precipitation_sum, 0) + 2.0 AS precip_size
    FROM astg w JOIN aqf a ON w.city_name = a.city_name AND w.weather_date = a.air_quality_date""",
    "astg", "aqf"), ["temperature_2m_mean", "precipitation_sum", "avg_european_aqi", "precip_size"], 4))


def _planner_sql(season_pref: str | None, avoid_heat: bool) -> str:
    if season_pref:
        base = f"""SELECT c.city_name, c.comfort_score, c.avg_temperature_c, c.avg_air_quality_index,
          c.rainy_days / greatest(c.total_days, 1) AS rainy_ratio,
          c.windy_days / greatest(c.total_days, 1) AS windy_ratio,
          coalesce(s.comfort_score, c.comfort_score) AS use_comfort,
          coalesce(s.avg_temperature_c, c.avg_temperature_c) AS use_temp
          FROM city_sum c LEFT JOIN (SELECT * FROM season_sum WHERE season = '{season_pref}') s
          ON c.city_name = s.city_name"""
    else:
        base = """SELECT city_name, comfort_score, avg_temperature_c, avg_air_quality_index,
          rainy_days / greatest(total_days, 1) AS rainy_ratio,
          windy_days / greatest(total_days, 1) AS windy_ratio,
          comfort_score AS use_comfort, avg_temperature_c AS use_temp FROM city_sum"""

    def norm(c, inv=False):
        z = (f"(CASE WHEN (SELECT max({c}) FROM p1) > (SELECT min({c}) FROM p1) "
             f"THEN ({c} - (SELECT min({c}) FROM p1)) / ((SELECT max({c}) FROM p1) - (SELECT min({c}) FROM p1)) * 100.0 "
             f"WHEN {c} IS NULL THEN NULL ELSE 50.0 END)")
        return f"(100.0 - {z})" if inv else z
    heat = ""
    if avoid_heat:
        heat = """, p3 AS (SELECT p2.*, coalesce(e.heatwave_days, 0) AS hw FROM p2
            LEFT JOIN extremes e ON p2.city_name = e.city_name),
          p4 AS (SELECT p3.* REPLACE (match - (CASE WHEN (SELECT max(hw) FROM p3) > (SELECT min(hw) FROM p3)
            THEN (hw - (SELECT min(hw) FROM p3)) / ((SELECT max(hw) FROM p3) - (SELECT min(hw) FROM p3)) * 100.0
            ELSE 50.0 END) * 0.35 AS match) FROM p3)"""
    last = "p4" if avoid_heat else "p2"
    body = f"""p0 AS ({base}),
      p1 AS (SELECT *, coalesce(avg_air_quality_index, (SELECT median(avg_air_quality_index) FROM city_sum))
        AS use_air FROM p0),
      p2 AS (SELECT *, (n_warm * 3 + n_comfort * 5 + n_air * 3 + n_dry * 3 + n_calm * 2) / 16.0 AS match
        FROM (SELECT *, {norm('use_temp')} AS n_warm,
          CASE WHEN use_comfort IS NULL THEN NULL ELSE least(greatest(use_comfort, 0), 100) END AS n_comfort,
          {norm('use_air', True)} AS n_air, {norm('rainy_ratio', True)} AS n_dry,
          {norm('windy_ratio', True)} AS n_calm FROM p1)){heat},
      bm AS (SELECT city_name, arg_max(month_name, struct_pack(s := comfort_score, m := -month_num))
        AS best_month FROM month_sum GROUP BY city_name)
      SELECT x.* EXCLUDE (match{', hw' if avoid_heat else ''}),
        CASE WHEN x.match IS NULL THEN NULL ELSE least(greatest(x.match, 0), 100) END AS match,
        bm.best_month FROM {last} x LEFT JOIN bm ON x.city_name = bm.city_name"""
    return body


_PLAN_D = ["comfort_score", "avg_temperature_c", "avg_air_quality_index", "rainy_ratio", "windy_ratio",
           "use_comfort", "use_temp", "use_air", "n_warm", "n_comfort", "n_air", "n_dry", "n_calm", "match"]


def _planner_query(season_pref, avoid_heat):
    needed = ["city_sum", "season_sum", "month_sum"] + (["extremes"] if avoid_heat else [])
    full = with_ctes("SELECT 1", *needed)
    # splice the planner CTEs after the model CTEs
    head = full[: full.rindex("\nSELECT 1")]
    return head + ",\n" + _planner_sql(season_pref, avoid_heat)


q("q_planner", rnd(_planner_query(None, False), _PLAN_D, 4))
q("q_planner_season", rnd(_planner_query("Winter", True), _PLAN_D, 4))
q("q_planner_top", rnd(f"""SELECT *, row_number() OVER (ORDER BY match DESC NULLS LAST, city_name) AS position
    FROM ({_planner_query(None, False)}) z ORDER BY match DESC NULLS LAST, city_name LIMIT 5""", _PLAN_D, 4))
q("q_best_month", with_ctes("""SELECT city_name, arg_max(month_name, struct_pack(s := comfort_score,
    m := -month_num)) AS best_month FROM month_sum GROUP BY city_name""", "month_sum"))
q("q_radar", rnd(with_ctes("""SELECT city_name,
    CASE WHEN avg_temp IS NULL THEN NULL ELSE least(greatest(avg_temp / 30.0 * 100.0, 0), 100) END AS warmth,
    comfort_score AS comfort,
    100.0 - least(100.0, coalesce(avg_european_aqi, 0) /
      (SELECT greatest(max(coalesce(avg_european_aqi, 0)), 1.0) FROM rank) * 100.0) AS clean_air,
    100.0 - windy_days / days * 100.0 AS calm, 100.0 - rainy_days / days * 100.0 AS dry
    FROM rank ORDER BY overall_comfort_index DESC NULLS LAST, city_name LIMIT 8""", "rank"),
    ["warmth", "comfort", "clean_air", "calm", "dry"], 4))
q("q_season_cards", rnd(with_ctes("""SELECT s.season, s.season_order, a.t, a.cs,
    CASE WHEN a.t IS NULL THEN 'none' WHEN a.t < 6 THEN 'cold' WHEN a.t < 12 THEN 'cool'
      WHEN a.t < 18 THEN 'mild' WHEN a.t < 24 THEN 'warm' ELSE 'hot' END AS t_class
    FROM (VALUES ('Winter', 1), ('Spring', 2), ('Summer', 3), ('Autumn', 4)) s(season, season_order)
    LEFT JOIN (SELECT season, avg(avg_temperature_c) AS t, avg(comfort_score) AS cs FROM season_sum
      GROUP BY season) a ON s.season = a.season""", "season_sum"), ["t", "cs"], 4))
q("q_pivot", rnd(with_ctes("""SELECT city_name,
    avg(temperature_2m_mean) FILTER (WHERE season = 'Winter') AS "Winter",
    avg(temperature_2m_mean) FILTER (WHERE season = 'Spring') AS "Spring",
    avg(temperature_2m_mean) FILTER (WHERE season = 'Summer') AS "Summer",
    avg(temperature_2m_mean) FILTER (WHERE season = 'Autumn') AS "Autumn"
    FROM fct GROUP BY city_name""", "fct"), ['"Winter"', '"Spring"', '"Summer"', '"Autumn"'], 2))
q("q_melt", with_ctes("""SELECT city_name, CASE condition WHEN 'comfortable_days' THEN 'Comfortable'
    WHEN 'rainy_days' THEN 'Rainy' WHEN 'windy_days' THEN 'Windy' WHEN 'hot_days' THEN 'Hot' END AS condition,
    day_count FROM (UNPIVOT (SELECT city_name, comfortable_days, rainy_days, windy_days, hot_days FROM rank)
    ON comfortable_days, rainy_days, windy_days, hot_days INTO NAME condition VALUE day_count)""", "rank"))
q("q_extreme_long", with_ctes("""SELECT city_name, CASE kind WHEN 'heatwave_days' THEN 'Heatwave'
    WHEN 'cold_snap_days' THEN 'Cold snap' WHEN 'heavy_rain_days' THEN 'Heavy rain' END AS kind, days
    FROM (UNPIVOT (SELECT city_name, heatwave_days, cold_snap_days, heavy_rain_days FROM extremes
      ORDER BY heatwave_days DESC, city_name LIMIT 10)
    ON heatwave_days, cold_snap_days, heavy_rain_days INTO NAME kind VALUE days)""", "extremes"))
q("q_extreme_champions", with_ctes("""
    SELECT * FROM (SELECT 'MOST HEATWAVE DAYS' AS kind, city_name, heatwave_days AS days,
      longest_heatwave AS longest FROM extremes ORDER BY heatwave_days DESC, city_name LIMIT 1)
    UNION ALL SELECT * FROM (SELECT 'MOST COLD-SNAP DAYS', city_name, cold_snap_days, longest_cold_snap
      FROM extremes ORDER BY cold_snap_days DESC, city_name LIMIT 1)
    UNION ALL SELECT * FROM (SELECT 'MOST HEAVY-RAIN DAYS', city_name, heavy_rain_days, longest_wet_spell
      FROM extremes ORDER BY heavy_rain_days DESC, city_name LIMIT 1)""", "extremes"))
q("q_unusual_days", rnd(with_ctes("""SELECT city_name, weather_date,
    strftime(weather_date, '%d %b %Y') AS day_label, anomaly_c, anomaly_z FROM anomaly
    ORDER BY abs(anomaly_z) DESC NULLS LAST, city_name, weather_date LIMIT 6""", "anomaly"),
    ["anomaly_c", "anomaly_z"], 2))
q("q_rain_cells", rnd(with_ctes("""SELECT weather_date, city_name, sum(precipitation_sum) AS precipitation_sum
    FROM fct GROUP BY weather_date, city_name""", "fct"), ["precipitation_sum"], 2))
q("q_nearest", rnd(with_ctes("SELECT * FROM near", "near"), ["distance_km"], 4))
q("q_proxy_estimate", with_ctes("""SELECT city, region, lat, lon, weather_date,
    strftime(weather_date, '%d %b') AS frame, day_number, round(t, 1) AS temperature_c,
    round(r, 1) AS rain_mm,
    round(least(greatest(100.0 - abs(t - 22.0) * 5.2 - r * 7.0, 0.0), 100.0), 1) AS comfort,
    signal_city, round(distance_km, 0) AS signal_distance_km,
    round(greatest(7.0, 13.0 + r * 3.2 + greatest(0.0, t - 25.0) * 0.5), 2) AS pulse_size
    FROM (SELECT s.city, s.region, s.lat, s.lon, f.weather_date, f.day_number,
      f.temperature_2m_mean + (40.4 - s.lat) * 0.42
        + (CASE WHEN abs(s.lon) < 1.0 THEN -0.8 ELSE 0.0 END)
        + (f.latitude - s.lat) * 0.12
        + sin(f.day_number * 0.92 + (CAST('0x' || substr(md5(s.city), 1, 8) AS BIGINT) % 628) / 100.0) * 0.9 AS t,
      greatest(0.0, f.precipitation_sum * (1.0 + least(n.distance_km, 850.0) / 2400.0)) AS r,
      f.city_name AS signal_city, n.distance_km
      FROM sups s JOIN near n ON s.s_suppkey = n.s_suppkey
      JOIN dim l ON n.location_id = l.location_id
      JOIN (SELECT w.city_name, w.weather_date, w.temperature_2m_mean, w.precipitation_sum, d.latitude,
              row_number() OVER (PARTITION BY w.city_name ORDER BY w.weather_date) - 1 AS day_number
            FROM fct w JOIN dim d ON w.city_name = d.city_name) f ON f.city_name = l.city_name) z""",
    "sups", "near", "fct", "dim"))
q("q_proxy_fallback", with_ctes("""SELECT city, region, lat, lon, weather_date,
    strftime(weather_date, '%d %b') AS frame, CAST(day_number AS INTEGER) AS day_number,
    round(t, 1) AS temperature_c, round(r, 1) AS rain_mm,
    round(least(greatest(100.0 - abs(t - 22.0) * 5.2 - r * 7.0, 0.0), 100.0), 1) AS comfort,
    signal_city, round(distance_km, 0) AS signal_distance_km,
    round(greatest(7.0, 13.0 + r * 3.2 + greatest(0.0, t - 25.0) * 0.5), 2) AS pulse_size
    FROM (SELECT s.city, s.region, s.lat, s.lon, f.weather_date, f.day_number,
      f.temperature_2m_mean + (40.4 - s.lat) * 0.42
        + (CASE WHEN abs(s.lon) < 1.0 THEN -0.8 ELSE 0.0 END) + (l.latitude - s.lat) * 0.12
        + sin(f.day_number * 0.92 + (CAST('0x' || substr(md5(s.city), 1, 8) AS BIGINT) % 628) / 100.0) * 0.9 AS t,
      greatest(0.0, f.precipitation_sum * (1.0 + least(n.distance_km, 850.0) / 2400.0)) AS r,
      l.city_name AS signal_city, n.distance_km
      FROM sups s JOIN near n ON s.s_suppkey = n.s_suppkey
      JOIN dim l ON n.location_id = l.location_id
      JOIN (WITH w AS (SELECT * FROM fct WHERE weather_date = DATE '1995-03-01')
            SELECT location_id AS series, *, row_number() OVER (PARTITION BY location_id
              ORDER BY weather_date) - 1 AS day_number FROM w
            UNION ALL SELECT -1 AS series, *, row_number() OVER (ORDER BY weather_date, location_id) - 1
              AS day_number FROM w) f
        ON f.series = CASE WHEN EXISTS (SELECT 1 FROM fct x WHERE x.location_id = l.location_id
          AND x.weather_date = DATE '1995-03-01') THEN l.location_id ELSE -1 END) z""",
    "sups", "near", "fct", "dim"))
q("q_payload_daily", """SELECT o_custkey AS c_custkey, CAST(o_orderdate AS DATE) AS order_date,
    CAST(1 AS DOUBLE) AS latitude, CAST(2 AS DOUBLE) AS longitude, 'UTC' AS timezone,
    o_orderkey AS order_id, o_totalprice AS price
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_custkey % 50 > 2""")
q("q_payload_rejects", """SELECT c_custkey, CASE c_custkey % 50 WHEN 0 THEN 'not readable'
      WHEN 1 THEN 'error answer: quota' ELSE 'more values than times' END AS reason,
    greatest(blocks, 1) AS payloads
    FROM (SELECT c_custkey, count(DISTINCT o_orderkey // 4096) AS blocks FROM customer
      LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey) p
    WHERE c_custkey % 50 < 2 OR (c_custkey % 50 = 2 AND blocks > 0)""")
q("q_geocode", """SELECT n_nationkey AS location_id, n_name AS city_name, r_name AS country,
    CAST(n_regionkey AS VARCHAR) AS country_code, count(*) AS hits, CAST(1.5 AS DOUBLE) AS latitude
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE s_suppkey % 10 > 2 GROUP BY ALL""")
q("q_geocode_rejects", """SELECT s_name AS query, CASE WHEN s_suppkey % 10 = 2
      THEN 'unreadable geocoding answer for ' ELSE 'no geocoding result for ' END || s_name AS error
    FROM supplier WHERE s_suppkey % 10 <= 2""")
q("q_csv_orders", "SELECT * FROM orders")
q("q_csv_rejects", "SELECT o_orderkey, 'n/a' AS value FROM orders WHERE o_orderkey % 89 = 0")
q("q_many_runs", """SELECT o_custkey, strftime(landed, '%Y-%m-%d 00-00-00') AS run, n_orders, top_price
    FROM (SELECT o_custkey, date_trunc('year', o_orderdate) AS landed, count(*) AS n_orders,
      max(o_totalprice) AS top_price,
      row_number() OVER (PARTITION BY o_custkey ORDER BY date_trunc('year', o_orderdate) DESC) AS rn
      FROM orders GROUP BY 1, 2) WHERE rn = 1""")
q("q_optional_mart", rnd(with_ctes("""SELECT 'built' AS mart, d.city_name, e.abs_temperature_error
    FROM dim d LEFT JOIN (SELECT city_name, avg(abs_temperature_error) AS abs_temperature_error
      FROM fcast WHERE abs_temperature_error IS NOT NULL GROUP BY 1) e ON d.city_name = e.city_name
    UNION ALL SELECT 'missing', city_name, NULL FROM dim""", "dim", "fcast"), ["abs_temperature_error"], 4))
q("q_new_columns", rnd(with_ctes("""SELECT forecast_city_day_sk, forecast_extracted_at,
    CASE WHEN forecast_extracted_at > TIMESTAMP '2024-01-15' THEN abs_temperature_error END
      AS abs_temperature_error,
    CASE WHEN forecast_extracted_at > TIMESTAMP '2024-01-15' THEN abs_precipitation_error END
      AS abs_precipitation_error FROM fcast""", "fcast"),
    ["abs_temperature_error", "abs_precipitation_error"], 4))
q("q_leaderboard_rows", rnd(with_ctes("""SELECT *, row_number() OVER (ORDER BY overall_comfort_index
      DESC NULLS LAST, city_name) AS position, least(greatest(comfort_score, 4.0), 100.0) AS score_bar,
    CASE WHEN comfort_score >= 50 THEN 'high' WHEN comfort_score >= 25 THEN 'medium' ELSE 'low' END
      AS score_class,
    CASE WHEN avg_european_aqi IS NULL THEN 'NO DATA' WHEN avg_european_aqi < 20 THEN 'GOOD'
      WHEN avg_european_aqi < 40 THEN 'FAIR' WHEN avg_european_aqi < 60 THEN 'MODERATE'
      WHEN avg_european_aqi < 80 THEN 'POOR' WHEN avg_european_aqi < 100 THEN 'VERY POOR'
      ELSE 'EXTREME' END AS aqi_label FROM rank""", "rank"), RANK_D + ["score_bar"], 4))
q("q_day_types", with_ctes("""SELECT r.city_name, t.condition, t.day_count FROM (
      SELECT city_name, 'Comfortable' AS condition, count(*) FILTER (WHERE is_comfortable) AS day_count
        FROM fct GROUP BY 1
      UNION ALL SELECT city_name, 'Rainy', count(*) FILTER (WHERE is_rainy) FROM fct GROUP BY 1
      UNION ALL SELECT city_name, 'Windy', count(*) FILTER (WHERE is_windy) FROM fct GROUP BY 1
      UNION ALL SELECT city_name, 'Hot', count(*) FILTER (WHERE is_hot) FROM fct GROUP BY 1
      UNION ALL SELECT city_name, 'Freezing', count(*) FILTER (WHERE is_freezing) FROM fct GROUP BY 1) t
    JOIN (SELECT DISTINCT city_name FROM fct) r ON r.city_name = t.city_name""", "fct"))
q("q_payload", """SELECT 'events' AS source_name, user_id, event_id, ts, value FROM events""")
q("q_slug", """SELECT doc_id, regexp_replace(lower(strip_accents(text)), '[^a-z0-9]', '', 'g') AS text_slug,
    regexp_replace(lower(strip_accents(source)), '[^a-z0-9]', '', 'g') AS source_slug FROM documents""")
q("q_dq_unique", """SELECT o_custkey, count(*) AS n_records FROM orders WHERE o_custkey IS NOT NULL
    GROUP BY o_custkey HAVING count(*) > 1""")
q("q_dq_not_null", rnd(with_ctes("""SELECT air_quality_hourly_sk, location_id, reading_timestamp, pm10
    FROM aqstg WHERE pm2_5 IS NULL""", "aqstg"), ["pm10"], 2))
q("q_dq_relationships", """SELECT d.doc_id, d.source FROM documents d WHERE d.doc_id IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
q("q_dq_accepted", """SELECT o_orderkey, o_orderstatus FROM orders
    WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O')""")
q("q_dq_between", """SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_totalprice IS NOT NULL AND (o_totalprice < 1000.0 OR o_totalprice > 400000.0)""")
q("q_dq_non_negative", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0")
q("q_dq_singular", rnd(with_ctes("""SELECT location_id, weather_date, temperature_2m_min, temperature_2m_max,
    temperature_2m_mean FROM fct WHERE temperature_2m_min < 1500 * (pi() / 3000)
    OR temperature_2m_max > 450000 * (pi() / 3000)
    OR temperature_2m_min > temperature_2m_max""", "fct"),
    ["temperature_2m_min", "temperature_2m_max", "temperature_2m_mean"], 2))
q("q_dq_report", with_ctes("""
    SELECT 'dim_location.location_sk unique' AS check_name, count(*) AS failures FROM (
      SELECT location_sk FROM dim WHERE location_sk IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'dim_location.city_name not_null', count(*) FROM dim WHERE city_name IS NULL
    UNION ALL SELECT 'fct_city_weather_day.season accepted', count(*) FROM fct
      WHERE season IS NOT NULL AND season NOT IN ('Winter', 'Spring', 'Summer', 'Autumn')
    UNION ALL SELECT 'fct_city_weather_day.location_sk relationships', count(*) FROM fct f
      WHERE f.location_sk IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim d WHERE d.location_sk = f.location_sk)
    UNION ALL SELECT 'mart_city_weather_summary.comfort_score between', count(*) FROM city_sum
      WHERE comfort_score IS NOT NULL AND (comfort_score < 0 OR comfort_score > 100)
    UNION ALL SELECT 'fct_air_quality_city_day.aqi non_negative', count(*) FROM aqf WHERE avg_european_aqi < 0
    UNION ALL SELECT 'fct_air_quality_city_day aqi singular', count(*) FROM aqf
      WHERE avg_pm10 < 0 OR avg_pm2_5 < 0 OR avg_carbon_monoxide < 0 OR avg_nitrogen_dioxide < 0
        OR avg_ozone < 0 OR avg_european_aqi < 0
    UNION ALL SELECT 'orders.o_custkey unique', count(*) FROM (
      SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
    """, "dim", "fct", "city_sum", "aqf"))
SQL["q_dq_report"] = f"""SELECT check_name, failures, CASE WHEN failures = 0 THEN 'pass'
    WHEN check_name = 'orders.o_custkey unique' THEN 'warn' ELSE 'fail' END AS status
    FROM ({SQL['q_dq_report']}) r"""
q("q_dq_panel", with_ctes("""SELECT (SELECT count(*) FROM city_sum) AS cities, count(*) AS city_days,
    max(weather_date) AS latest_obs, strftime(max(weather_date), '%d %b %Y') AS latest_label FROM fct""",
    "city_sum", "fct"))
q("q_freshness", """SELECT max(e.ts) AS max_loaded_at,
    round(epoch(TIMESTAMP '2024-02-01 00:00:00' - max(e.ts)) / 3600.0, 4) AS age_hours,
    CASE WHEN max(e.ts) IS NULL THEN 'error'
      WHEN epoch(TIMESTAMP '2024-02-01 00:00:00' - max(e.ts)) > 604800 THEN 'error'
      WHEN epoch(TIMESTAMP '2024-02-01 00:00:00' - max(e.ts)) > 129600 THEN 'warn' ELSE 'pass' END AS status
    FROM events e JOIN customer c ON e.user_id = c.c_custkey""")
q("q_contracts", with_ctes("""SELECT 'dim_location' AS model, count(*) AS n_rows FROM dim
    UNION ALL SELECT 'mart_city_season_summary', count(*) FROM season_sum
    UNION ALL SELECT 'mart_extreme_events', count(*) FROM extremes""", "dim", "season_sum", "extremes"))

q("q_stream_daily", rnd(with_ctes("""SELECT * FROM aqf
    WHERE CAST(air_quality_date + 1 AS TIMESTAMP) <= (SELECT max(ts) FROM ev)""", "aqf", "ev"), AQ_D, 4))
q("q_stream_daily_exact", SQL["q_stream_daily"])
q("q_stream_entity_days", rnd(with_ctes("""SELECT aqf.* FROM aqf JOIN (
      SELECT location_id, max(ts) AS newest FROM ev GROUP BY location_id) n USING (location_id)
    WHERE CAST(air_quality_date + 1 AS TIMESTAMP) <= newest""", "aqf", "ev"), AQ_D, 4))
q("q_stream_snapshots", SQL["q_forecast_error"])
