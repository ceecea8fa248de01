"""Logic fixtures (mocked rows -> expected columns) and edge cases."""
import datetime as dt

from pyspark.sql import functions as F

from dayframe.operators import anomaly, bands, flags, rollup, streaks
from dayframe.plans import marts as M
from dayframe.sources.readers import aqi_bands

D = dt.date


def days(spark, rows, schema="location_id int, weather_date date, temperature_2m_max double, "
         "temperature_2m_min double, temperature_2m_mean double, rain_sum double, "
         "wind_speed_10m_max double"):
    return spark.createDataFrame(rows, schema)


def test_flags_fixture(spark):
    df = days(spark, [(1, D(2025, 7, 15), 24.0, 15.0, 20.0, 0.0, 10.0),
                      (1, D(2026, 1, 10), 37.0, -2.0, 30.0, 5.0, 50.0)])
    out = flags.threshold_flags(df).orderBy("weather_date").collect()
    assert [(r.is_rainy, r.is_windy, r.is_hot, r.is_freezing, r.temp_range_c) for r in out] == [
        (False, False, False, False, 9.0), (True, True, True, True, 39.0)]


def test_thresholds_are_strict_and_heavy_inclusive(spark):
    df = days(spark, [(1, D(2025, 7, 1), 35.0, 0.0, 18.0, 1.0, 40.0),
                      (1, D(2025, 7, 2), 35.0, 0.0, 26.0, 20.0, 40.0)])
    out = flags.heavy_rain_flag(flags.comfort_flag(flags.threshold_flags(df))).orderBy("weather_date").collect()
    assert [(r.is_rainy, r.is_windy, r.is_hot, r.is_freezing) for r in out][0] == (False, False, False, False)
    assert out[0].is_comfortable is True   # mean 18.0 inclusive
    assert out[1].is_heavy_rain is True and out[1].is_comfortable is False


def test_comfort_and_season_fixture(spark):
    df = spark.createDataFrame([
        (D(2025, 7, 15), 22.0, False, False, False, False),
        (D(2026, 1, 10), 10.0, False, False, False, False),
        (D(2025, 10, 10), 21.0, True, False, False, False),
    ], "weather_date date, temperature_2m_mean double, is_rainy boolean, is_windy boolean, "
       "is_hot boolean, is_freezing boolean")
    out = flags.comfort_flag(df).withColumn("season", M.season_from_date("weather_date")) \
        .orderBy("weather_date").collect()
    assert [(r.is_comfortable, r.season) for r in out] == [
        (True, "Summer"), (False, "Autumn"), (False, "Winter")]


def test_null_measure_gives_null_flag_not_counted(spark):
    df = days(spark, [(1, D(2025, 7, 1), None, 5.0, 20.0, 0.0, 5.0)])
    f = M.city_weather_day(flags.threshold_flags(df).withColumns({
        "city_name": F.lit("x"), "country_code": F.lit("y"), "precipitation_sum": F.lit(0.0),
        "snowfall_sum": F.lit(0.0), "city_day_weather_sk": F.lit("k")}))
    r = f.first()
    assert r.is_hot is None and r.is_comfortable is None
    s = rollup.season_summary(f).first()
    assert s.hot_days == 0 and s.comfortable_days == 0


def _streak_input(spark, rows):
    return spark.createDataFrame(rows, "location_id int, weather_date date, is_hot boolean, "
                                       "is_freezing boolean, is_heavy_rain boolean")


def test_heatwave_fixture(spark):
    df = _streak_input(spark, [(1, D(2025, 7, 1), False, False, False),
                               (1, D(2025, 7, 2), True, False, False),
                               (1, D(2025, 7, 3), True, False, False),
                               (1, D(2025, 7, 4), True, False, False)])
    out = streaks.run_lengths(df, "location_id", "weather_date").orderBy("weather_date").collect()
    assert [(r.in_heatwave, r.heat_streak) for r in out] == [(False, 0), (True, 3), (True, 3), (True, 3)]


def test_missing_day_does_not_break_run_unless_contiguous(spark):
    rows = [(1, D(2025, 1, 1), False, True, True), (1, D(2025, 1, 2), False, True, True),
            (1, D(2025, 1, 4), False, True, False)]
    df = _streak_input(spark, rows)
    parity = streaks.run_lengths(df, "location_id", "weather_date").orderBy("weather_date").collect()
    assert [r.cold_streak for r in parity] == [3, 3, 3] and all(r.in_cold_snap for r in parity)
    assert [r.wet_streak for r in parity] == [2, 2, 0] and parity[0].in_wet_spell
    contig = streaks.run_lengths(df, "location_id", "weather_date", contiguous=True) \
        .orderBy("weather_date").collect()
    assert [r.cold_streak for r in contig] == [2, 2, 1] and not any(r.in_cold_snap for r in contig)


def test_null_flag_breaks_run_and_scores_zero(spark):
    df = _streak_input(spark, [(1, D(2025, 1, 1), True, False, False),
                               (1, D(2025, 1, 2), None, False, False),
                               (1, D(2025, 1, 3), True, False, False)])
    out = streaks.run_lengths(df, "location_id", "weather_date").orderBy("weather_date").collect()
    assert [r.heat_streak for r in out] == [1, 0, 1]
    assert out[1].in_heatwave is False  # NULL AND (1 >= 3) = FALSE


def test_streak_lengths_sum_property(spark):
    import random
    rnd = random.Random(7)
    rows = [(e, D(2025, 1, 1) + dt.timedelta(days=i), rnd.random() < 0.5, False, False)
            for e in range(3) for i in range(60)]
    out = streaks.run_lengths(_streak_input(spark, rows), "location_id", "weather_date").collect()
    by = {}
    for r in out:
        by.setdefault(r.location_id, []).append(r)
    for e, rs in by.items():
        rs.sort(key=lambda r: r.weather_date)
        i = 0
        while i < len(rs):
            j = i
            while j < len(rs) and rs[j].is_hot == rs[i].is_hot:
                j += 1
            want = (j - i) if rs[i].is_hot else 0
            assert all(r.heat_streak == want for r in rs[i:j])
            i = j


def test_band_join_edges(spark):
    df = spark.createDataFrame([(20.0,), (100.0,), (-1.0,), (None,), (100000.0,), (19.999,)], "v double")
    out = bands.range_join(df, "v", aqi_bands(spark)).collect()
    got = {r.v: r.aqi_band for r in out}
    assert got[20.0] == "Fair" and got[100.0] == "Extremely Poor" and got[19.999] == "Good"
    assert got[-1.0] is None and got[100000.0] is None and got[None] is None
    assert len(out) == 6


def test_band_join_bucketed_path_matches_broadcast(spark):
    import random
    rnd = random.Random(3)
    df = spark.createDataFrame([(rnd.uniform(-5, 130),) for _ in range(300)], "v double")
    a = sorted((r.v, r.aqi_band) for r in bands.range_join(df, "v", aqi_bands(spark)).collect())
    b = sorted((r.v, r.aqi_band) for r in bands.range_join(
        df, "v", aqi_bands(spark), bucket_width=10.0, max_broadcast=0).collect())
    assert a == b


def test_zscore_zero_variance_and_single_row(spark):
    df = spark.createDataFrame([(1, "Winter", 5.0), (1, "Winter", 5.0), (2, "Summer", 9.0)],
                               "id int, season string, v double")
    out = anomaly.group_zscore(df, ["id", "season"], "v").collect()
    assert all(r.anomaly_z is None and r.is_extreme_day is None for r in out)


def test_zscore_exactly_k_is_extreme(spark):
    # values -1, 1: mean 0, sample sd sqrt(2); |z| = 1/sqrt(2)
    df = spark.createDataFrame([(1, "W", -1.0), (1, "W", 1.0)], "id int, season string, v double")
    out = anomaly.group_zscore(df, ["id", "season"], "v", k=1 / 2 ** 0.5).collect()
    assert all(r.is_extreme_day for r in out)


def test_hourly_rollup_drops_rows_with_only_co(spark):
    rows = [(1, "c", "x", dt.datetime(2025, 1, 1, h), float(h), None, 1.0, None, None, float(h))
            for h in range(4)]
    rows.append((1, "c", "x", dt.datetime(2025, 1, 1, 5), None, None, 9.0, None, None, None))
    df = spark.createDataFrame(rows, "location_id int, city_name string, country_code string, "
                               "reading_timestamp timestamp_ntz, pm10 double, pm2_5 double, "
                               "carbon_monoxide double, nitrogen_dioxide double, ozone double, "
                               "european_aqi double")
    r = rollup.hourly_to_daily(df).first()
    assert r.hourly_readings_count == 4 and r.max_carbon_monoxide == 1.0
    assert abs(r.p95_pm10 - (2 + 0.85)) < 1e-12  # linear interpolation over 0,1,2,3


def test_same_month_in_two_years_is_one_row(spark):
    f = spark.createDataFrame([
        (1, "c", "x", D(2025, 6, 10), "Summer", 20.0, 25.0, 1.0, True, False, False, False),
        (1, "c", "x", D(2026, 6, 10), "Summer", 22.0, 27.0, 2.0, False, True, False, False),
    ], "location_id int, city_name string, country_code string, weather_date date, season string, "
       "temperature_2m_mean double, temperature_2m_max double, precipitation_sum double, "
       "is_comfortable boolean, is_rainy boolean, is_hot boolean, is_freezing boolean")
    out = rollup.month_summary(f).collect()
    assert len(out) == 1 and out[0].total_days == 2 and out[0].comfort_score == 50.0
    assert out[0].month_name == "June"


def test_city_without_weather_or_air_is_kept(spark):
    dim = spark.createDataFrame([("a", 1, "A", "X", "XX", 0.0, 0.0, 1), ("b", 2, "B", "X", "XX", 0.0, 0.0, 1)],
                                "location_sk string, location_id int, city_name string, country string, "
                                "country_code string, latitude double, longitude double, population int")
    w = spark.createDataFrame([("a", 1, D(2025, 1, 1), 20.0, 21.0, 19.0, 1.0, True, False, False, False, False)],
                              "location_sk string, location_id int, weather_date date, "
                              "temperature_2m_mean double, temperature_2m_max double, "
                              "temperature_2m_min double, precipitation_sum double, is_comfortable boolean, "
                              "is_rainy boolean, is_windy boolean, is_hot boolean, is_freezing boolean")
    aq = spark.createDataFrame([], "location_sk string, avg_european_aqi double, avg_pm2_5 double, "
                                   "max_european_aqi double")
    out = {r.city_name: r for r in rollup.city_summary(dim, w, aq).collect()}
    assert out["A"].comfort_score == 100.0 and out["A"].overall_comfort_index == 100.0
    assert out["B"].total_days is None and out["B"].comfort_score is None


def test_range_join_forms_agree_beyond_the_bound_and_at_infinite_bounds(spark):
    inf = float("inf")
    rows = [(i, float(i), float(i) + 1.5) for i in range(300)] + [
        (900, -inf, 2.0), (901, 250.0, inf), (902, 3.0, 3.0), (903, None, 4.0), (904, 0.0, 1e6)]
    table = spark.createDataFrame(rows, "band int, lo double, hi double")
    df = spark.createDataFrame([(x,) for x in [-1e300, -5.0, 0.0, 2.0, 2.25, 299.0, 301.0, 1e9,
                                               1e300, None]], "v double")

    def got(bound):
        return sorted((str(r.v), str(r.band)) for r in bands.range_join(
            df, "v", table, "lo", "hi", max_broadcast=bound).collect())
    assert got(10) == got(1000)
