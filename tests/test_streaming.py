"""Streaming rollup: closed days equal the batch rollup; the open day is held back."""
import datetime as dt
import os
import random
import uuid

from pyspark.sql import functions as F

from dayframe.operators.rollup import hourly_to_daily
from dayframe.session import scratch_path
from dayframe.streaming import daily as S

SCHEMA = ("location_id int, city_name string, country_code string, reading_timestamp timestamp_ntz, "
          "pm10 double, pm2_5 double, carbon_monoxide double, nitrogen_dioxide double, ozone double, "
          "european_aqi double")

NO_DELAY = dt.timedelta(0)


def test_stream_daily_matches_batch_on_closed_days(spark):
    rnd = random.Random(1)
    rows = []
    for loc in (1, 2):
        for h in range(24 * 3 + 5):
            v = round(rnd.uniform(0, 90), 2)
            rows.append((loc, f"c{loc}", "XX", dt.datetime(2026, 3, 1) + dt.timedelta(hours=h),
                         v, v / 2, 1.0, None, None, v))
    src = scratch_path(spark, "test-stream-src", uuid.uuid4().hex)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(src)
    stream = spark.readStream.schema(SCHEMA).parquet(src)
    out = scratch_path(spark, "test-stream-out", uuid.uuid4().hex)
    S.run_to_parquet(S.daily_rollup_stream(stream, "0 seconds"), out + "/data", out + "/_ck")
    got = spark.read.parquet(out + "/data")
    assert sorted(r.air_quality_date for r in got.select("air_quality_date").distinct().collect()) == [
        dt.date(2026, 3, 1), dt.date(2026, 3, 2), dt.date(2026, 3, 3)]  # 4 March still open
    batch = hourly_to_daily(spark.createDataFrame(rows, SCHEMA)).filter(
        F.col("air_quality_date") < F.lit("2026-03-04").cast("date"))
    cols = ["location_id", "air_quality_date", "avg_pm10", "p95_pm10", "max_european_aqi",
            "hourly_readings_count", "air_quality_daily_sk"]
    norm = lambda df: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r)
                             for r in df.select(*cols).collect())
    assert norm(got) == norm(batch)


def test_exact_daily_rollup_over_several_batches(spark):
    rnd = random.Random(2)
    rows = []
    for loc in (1, 2, 3):
        for h in range(24 * 4 + 7):
            v = round(rnd.uniform(0, 90), 2)
            rows.append((loc, f"c{loc}", "XX", dt.datetime(2026, 3, 1) + dt.timedelta(hours=h),
                         v, None if h % 5 == 0 else v / 2, 1.0, None, None, v))
    src = scratch_path(spark, "test-stream-src", uuid.uuid4().hex)
    # one file per time slice, read one file per micro-batch
    df = spark.createDataFrame(rows, SCHEMA)
    slices = [("2026-03-01", "2026-03-02 12:00:00"), ("2026-03-02 12:00:00", "2026-03-04"),
              ("2026-03-04", "2026-03-09")]
    for i, (lo, hi) in enumerate(slices):
        part = df.filter((F.col("reading_timestamp") >= F.lit(lo).cast("timestamp_ntz"))
                         & (F.col("reading_timestamp") < F.lit(hi).cast("timestamp_ntz")))
        part.coalesce(1).write.parquet(f"{src}/slice={i}")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", "true").parquet(src)
    base = scratch_path(spark, "test-stream-exact", uuid.uuid4().hex)
    out = S.exact_daily_rollup(stream, base, base + "/_ck", NO_DELAY)
    got = S.read_days(spark, out)
    batch = hourly_to_daily(df).filter(F.col("air_quality_date") < F.lit("2026-03-05").cast("date"))
    cols = ["location_id", "air_quality_date", "avg_pm10", "p95_pm10", "p95_pm2_5",
            "max_european_aqi", "hourly_readings_count", "air_quality_daily_sk"]
    norm = lambda df: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r)
                             for r in df.select(*cols).collect())
    assert got.count() == 12  # 3 places x 4 closed days; 5 March is still open
    assert norm(got) == norm(batch)


def test_finalise_closed_days_replay_and_late_rows(spark):
    def reading(loc, ts, v):
        return (loc, f"c{loc}", "XX", ts, v, v, 1.0, None, None, v)
    day1 = [reading(1, dt.datetime(2026, 3, 1, h), float(h)) for h in range(24)]
    day2 = [reading(1, dt.datetime(2026, 3, 2, h), float(h)) for h in range(3)]
    base = scratch_path(spark, "test-stream-replay", uuid.uuid4().hex)
    batch0 = spark.createDataFrame(day1 + day2, SCHEMA)
    S.finalise_closed_days(batch0, 0, base, NO_DELAY)
    S.finalise_closed_days(batch0, 0, base, NO_DELAY)  # replay of the same micro-batch
    out = spark.read.parquet(base + "/days")
    assert [(r.air_quality_date, r.hourly_readings_count) for r in out.collect()] == [
        (dt.date(2026, 3, 1), 24)]
    # a late reading for the emitted day is dropped; 2 March closes once 3 March starts
    late = spark.createDataFrame([reading(1, dt.datetime(2026, 3, 1, 5), 99.0),
                                  reading(1, dt.datetime(2026, 3, 3, 0), 1.0)], SCHEMA)
    S.finalise_closed_days(late, 1, base, NO_DELAY)
    got = sorted((r.air_quality_date, r.hourly_readings_count, r.max_pm10)
                 for r in spark.read.parquet(base + "/days").collect())
    assert got == [(dt.date(2026, 3, 1), 24, 23.0), (dt.date(2026, 3, 2), 3, 2.0)]


def _reading(loc, ts, v):
    return (loc, f"c{loc}", "XX", ts, v, v, 1.0, None, None, v)


def test_late_entity_loses_nothing(spark):
    """The first place's readings all arrive before the second's of the same days."""
    base = scratch_path(spark, "test-stream-late", uuid.uuid4().hex)
    hours = [dt.datetime(2026, 3, 1) + dt.timedelta(hours=h) for h in range(0, 24 * 4 + 1, 3)]
    for epoch, loc in enumerate((1, 2)):
        rows = [_reading(loc, ts, float(i)) for i, ts in enumerate(hours)]
        S.finalise_closed_days(spark.createDataFrame(rows, SCHEMA), epoch, base, NO_DELAY)
    got = S.read_days(spark, base + "/days").groupBy("location_id").count().collect()
    assert sorted(map(tuple, got)) == [(1, 4), (2, 4)]
    # with ``idle`` silent places are not waited for
    base = scratch_path(spark, "test-stream-idle", uuid.uuid4().hex)
    rows = [_reading(1, ts, 1.0) for ts in hours[:9]] + [_reading(2, ts, 1.0) for ts in hours]
    S.finalise_closed_days(spark.createDataFrame(rows, SCHEMA), 0, base, NO_DELAY,
                           idle=dt.timedelta(days=2))
    days = S.read_days(spark, base + "/days").groupBy("location_id").count().collect()
    assert sorted(map(tuple, days)) == [(1, 2), (2, 4)]


def test_state_stays_bounded_over_many_batches(spark):
    """Six-hourly batches over weeks, one place always ten days behind: what is kept is the open days
    of each place, in the last two versions, and every day is emitted once."""
    base = scratch_path(spark, "test-stream-bounded", uuid.uuid4().hex)
    folder = base.removeprefix("file:")
    start, sizes = dt.datetime(2026, 3, 1), []
    for epoch in range(30):
        at = start + dt.timedelta(hours=12 * epoch)
        rows = [_reading(1, at + dt.timedelta(hours=h), 1.0) for h in (0, 4, 8)]
        rows += [_reading(2, at + dt.timedelta(days=-10, hours=h), 2.0) for h in (1, 5)]
        S.finalise_closed_days(spark.createDataFrame(rows, SCHEMA), epoch, base, NO_DELAY)
        for name in ("state", "pending"):
            assert len([f for f in os.listdir(f"{folder}/{name}") if f.startswith("v=")]) <= 2
        sizes.append(spark.read.parquet(f"{base}/pending/v={epoch}").count())
    assert max(sizes) <= 10 and spark.read.parquet(f"{base}/state/v=29").count() == 2
    days = S.read_days(spark, base + "/days")
    assert days.count() == days.select("location_id", "air_quality_date").distinct().count() == 28
    assert {r.hourly_readings_count for r in days.collect()} == {6, 4}
