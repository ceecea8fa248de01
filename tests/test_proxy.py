"""The proxy series: its fan-out of places to days is dealt to tasks by rows, not by source."""

import datetime

from pyspark.sql import functions as F

from dayframe.operators import geo

N_PLACES, N_DAYS = 60, 90


def _series(spark, day_sources):
    """N_PLACES places, all nearest to source 1; source 2 is nearest to none."""
    atlas = spark.createDataFrame(
        [(i, f"P{i}", "r", float(i % 50), float(i)) for i in range(N_PLACES)],
        "s_suppkey long, city string, region string, lat double, lon double")
    near = spark.createDataFrame([(i, 1, 10.0 * i) for i in range(N_PLACES)],
                                 "s_suppkey long, location_id int, distance_km double")
    sources = spark.createDataFrame([(1, "A", 40.0), (2, "B", 50.0)],
                                    "location_id int, city_name string, latitude double")
    first = datetime.date(2024, 1, 1)
    days = spark.createDataFrame(
        [(s, first + datetime.timedelta(days=d), float(s), 0.5) for s in day_sources
         for d in range(N_DAYS)],
        "location_id int, weather_date date, temperature_2m_mean double, precipitation_sum double")
    return geo.proxy_series(atlas, near, sources, days)


def _check(spark, monkeypatch, day_sources, n_days):
    # blocks of some 32 days and 4 places, so that both sides are cut
    monkeypatch.setattr(geo, "BLOCK_DAYS", 32, raising=False)
    monkeypatch.setattr(geo, "BLOCK_ROWS", 128, raising=False)
    out = _series(spark, day_sources)
    got = out.withColumn("task", F.spark_partition_id()).select("city", "day_number", "task").collect()
    assert sorted((r["city"], r["day_number"]) for r in got) == sorted(
        (f"P{i}", d) for i in range(N_PLACES) for d in range(n_days))
    per_task = {}
    for r in got:
        per_task[r["task"]] = per_task.get(r["task"], 0) + 1
    assert max(per_task.values()) < len(got) / 3, per_task


def test_places_of_one_source_are_spread_over_tasks(spark, monkeypatch):
    _check(spark, monkeypatch, (1, 2), N_DAYS)


def test_places_without_days_are_spread_over_tasks(spark, monkeypatch):
    _check(spark, monkeypatch, (2, 3), 2 * N_DAYS)


def test_no_days_at_all(spark):
    assert _series(spark, ()).count() == 0
