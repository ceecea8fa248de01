"""Payload parsing, nearest join, positions, top/bottom, incremental, quality."""
import datetime as dt
import json
import math
import os
import random

import numpy as np
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayframe import schemas
from dayframe.operators import geo, incremental, quality
from dayframe.operators.order import top_and_bottom, with_position
from dayframe.session import scratch_path
from dayframe.sources import payload as P
from dayframe.sources.readers import load_csv, newest_run, read_mart, read_raw_tables, read_runs
from dayframe.sources.sinks import write_csv, write_snapshot

DAY = {"high": T.DoubleType(), "visits": T.LongType()}


def _answers(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "n int, answer string")


def _days(spark, *texts):
    df = _answers(spark, *texts)
    rows = P.payload_rows(df, "answer", "daily", DAY, tags={"n": F.col("n")})
    bad = P.payload_rejects(df, "answer", "daily", DAY, tags={"n": F.col("n")})
    return ([(r.n, r.date.isoformat(), r.high, r.visits) for r in rows.orderBy("n", "date").collect()],
            {r.n: r.reason for r in bad.collect()})


def test_payload_keeps_types_and_pads_short_arrays(spark):
    big = 2 ** 60 + 1
    text = json.dumps({"latitude": -12.25, "daily": {
        "time": ["2031-02-27", "2031-02-28", "2031-03-01"], "high": [None, 4], "visits": [big]}})
    rows, bad = _days(spark, text)
    assert rows == [(0, "2031-02-27", None, big), (0, "2031-02-28", 4.0, None),
                    (0, "2031-03-01", None, None)] and bad == {}


def test_payload_without_rows_is_no_reject(spark):
    for text in ("{}", '{"latitude": 1}', '{"daily": {}}', '{"daily": {"time": []}}', '{"daily": null}'):
        assert _days(spark, text) == ([], {})


def test_payload_rejects_and_their_reasons(spark):
    good = json.dumps({"daily": {"time": ["2031-05-05"], "visits": [3]}})
    rows, bad = _days(spark, good, good[:-2], "", None, '{"error": true, "reason": "too many calls"}',
                      json.dumps({"daily": {"time": ["2031-05-05"], "visits": [3, 4]}}),
                      json.dumps({"daily": {"time": ["2031-05-05"], "visits": ["many"]}}))
    assert rows == [(0, "2031-05-05", None, 3)]
    assert bad == {1: "not readable", 2: "no payload", 3: "no payload",
                   4: "error answer: too many calls", 5: "more values than times", 6: "not readable"}


def test_payload_of_hours_with_a_list_of_variables(spark):
    text = json.dumps({"hourly": {"time": ["2031-07-09T22:30", "2031-07-09T23:30"], "ozone": [7, 8.5]}})
    got = P.payload_rows(_answers(spark, text), "answer", "hourly", ["ozone", "pm10"], time_alias="at",
                         time_type="timestamp_ntz").orderBy("at").collect()
    assert [(r["at"], r.ozone, r.pm10) for r in got] == [
        (dt.datetime(2031, 7, 9, 22, 30), 7.0, None), (dt.datetime(2031, 7, 9, 23, 30), 8.5, None)]


def test_geocode_takes_the_first_hit_and_rejects_the_rest(spark):
    two = json.dumps({"results": [{"id": 71, "name": "Aville", "latitude": 3.5, "population": 12},
                                  {"id": 72, "name": "Bville"}]})
    asked = spark.createDataFrame([("a", two), ("b", '{"results": []}'), ("c", "{}"), ("d", two[:9]),
                                   ("e", None)], "place string, answer string").withColumn(
        "extracted_at", F.lit("2031-01-01"))
    ok, bad = P.geocode_locations(asked, "answer", "place")
    assert [(r.location_id, r.city_name, r.latitude, r.population, r.country)
            for r in ok.collect()] == [(71, "Aville", 3.5, 12, None)]
    assert {r.query: r.error for r in bad.collect()} == {
        "b": "no geocoding result for b", "c": "no geocoding result for c",
        "d": "unreadable geocoding answer for d", "e": "no geocoding result for e"}


@pytest.mark.parametrize("max_broadcast", [10_000, 0])  # broadcast arrays / shuffle join
def test_nearest_matches_brute_force(spark, max_broadcast):
    rnd = random.Random(11)
    pts = [(i, rnd.uniform(-80, 80), rnd.uniform(-180, 180)) for i in range(60)]
    pts += [(100, pts[0][1], pts[0][2])]  # duplicate coordinates: smaller id wins
    qs = [(j, rnd.uniform(-89, 89), rnd.uniform(-180, 180)) for j in range(200)]
    right = spark.createDataFrame(pts, "id int, latitude double, longitude double")
    left = spark.createDataFrame(qs, "qid int, lat double, lon double")
    got = {r.qid: (r.id, r.distance_km)
           for r in geo.nearest(left, right, "qid", "id", max_broadcast=max_broadcast).collect()}

    def hav(a, b, c, d):
        la1, lo1, la2, lo2 = map(math.radians, (a, b, c, d))
        h = math.sin((la2 - la1) / 2) ** 2 + math.cos(la1) * math.cos(la2) * math.sin((lo2 - lo1) / 2) ** 2
        return 2 * 6371.0 * math.asin(math.sqrt(h))
    for j, la, lo in qs:
        best = min((hav(la, lo, p[1], p[2]), p[0]) for p in pts)
        assert got[j][0] == best[1] and abs(got[j][1] - best[0]) < 1e-6


def _unit(rows):
    la, lo = np.radians([r[1] for r in rows]), np.radians([r[2] for r in rows])
    return np.c_[np.cos(la) * np.cos(lo), np.cos(la) * np.sin(lo), np.sin(la)]


def test_nearest_with_clustered_candidates(spark):
    """Dense clusters, lone points and places of their own: exact, and the pairs that are compared
    stay far below all pairs, for queries inside, beside and far from a cluster."""
    rnd = random.Random(5)
    pts = [(i, 40 + rnd.gauss(0, 0.01), -3 + rnd.gauss(0, 0.01)) for i in range(3000)]
    pts += [(5000 + i, 10 + rnd.gauss(0, 1e-6), 10 + rnd.gauss(0, 1e-6)) for i in range(300)]
    pts += [(8000 + i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(150)]
    pts += [(9000, 0.0, 180.0), (9001, 90.0, 0.0), (9002, -90.0, 17.0)]
    qs = [(j, 40 + rnd.gauss(0, 0.02), -3 + rnd.gauss(0, 0.02)) for j in range(150)]
    qs += [(300 + j, 40.2 + rnd.uniform(0, 0.1), -3.0) for j in range(50)]
    qs += [(400 + j, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for j in range(200)]
    qs += [(700, 10.0, 10.0), (701, 89.9, 55.0), (702, 0.1, -179.9), (703, -90.0, 0.0)]
    right = spark.createDataFrame(pts, "id int, latitude double, longitude double")
    left = spark.createDataFrame(qs, "qid int, lat double, lon double")
    counted = {}
    got = {r.qid: (r.id, r.distance_km) for r in geo.nearest(
        left, right, "qid", "id", max_broadcast=0, counted=counted).collect()}
    chords = ((_unit(qs)[:, None] - _unit(pts)[None]) ** 2).sum(axis=2) ** 0.5
    at = {p[0]: i for i, p in enumerate(pts)}
    assert len(got) == len(qs)
    for k, q in enumerate(qs):
        assert chords[k, at[got[q[0]][0]]] <= chords[k].min() + 1e-12
    assert counted["pairs"] < len(qs) * len(pts) / 15


def test_with_position_is_dense_and_ordered(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(7)
    out = with_position(df, [F.col("v").desc()], "pos").collect()
    assert sorted((r.pos, r.v) for r in out) == [(i + 1, 999 - i) for i in range(1000)]


def test_top_and_bottom(spark):
    df = spark.createDataFrame([(f"c{i:02d}", float(i)) for i in range(20)], "city_name string, s double")
    out = top_and_bottom(df, [F.col("s").desc()], [F.col("s").asc()]).collect()
    parts = {r.part for r in out}
    assert len(out) == 15 and parts == {"top", "bottom"}
    small = top_and_bottom(df.limit(10), [F.col("s").desc()], [F.col("s").asc()]).collect()
    assert len(small) == 10 and {r.part for r in small} == {"all"}


FACT = "k string, ts timestamp_ntz, v double, part int"


def _fact(spark, *rows):
    return spark.createDataFrame([(k, dt.datetime(2026, 1, day), v, part) for k, day, v, part in rows], FACT)


def _files(path):
    folder = path.removeprefix("file:")
    return {os.path.relpath(os.path.join(d, f), folder): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_incremental_high_water_mark(spark):
    path = scratch_path(spark, "test-hwm", str(random.random()))
    for rows in ([("a", 1, 1.0, 0)], [("a", 1, 1.0, 0)],   # the same snapshot again: no rows
                 [("b", 2, 2.0, 1), ("late", 1, 3.0, 0)]):
        incremental.append_new(spark, _fact(spark, *rows), path, "ts", ["part"])
    got = sorted(r.k for r in incremental.read_table(spark, path).collect())
    assert got == ["a", "b"]  # the late row is not newer than the mark


def test_append_brings_new_columns(spark):
    path = scratch_path(spark, "test-columns", str(random.random()))
    incremental.append_new(spark, _fact(spark, ("a", 1, 1.0, 0)).drop("v"), path, "ts")
    incremental.append_new(spark, _fact(spark, ("b", 2, 2.0, 0)), path, "ts")
    for table in (incremental.read_table(spark, path),
                  incremental.read_table(spark, path, _fact(spark).schema)):
        assert sorted((r.k, r.v) for r in table.collect()) == [("a", None), ("b", 2.0)]


def test_upsert_is_idempotent_and_adds_late_rows(spark):
    path = scratch_path(spark, "test-upsert", str(random.random()))
    for rows in ([("a", 1, 1.0, 0)], [("a", 1, 1.0, 0)], [("a", 2, 5.0, 0), ("late", 1, 3.0, 0)]):
        incremental.upsert_by_key(spark, _fact(spark, *rows), path, "k", ["part"])
    got = sorted((r.k, r.v) for r in incremental.read_table(spark, path).collect())
    assert got == [("a", 5.0), ("late", 3.0)]


def test_upsert_leaves_untouched_partitions_alone(spark):
    path = scratch_path(spark, "test-partitions", str(random.random()))
    rows = [(f"k{p}-{i}", 1, float(i), p) for p in (0, 1, 2, None) for i in range(5)]
    incremental.upsert_by_key(spark, _fact(spark, *rows), path, "k", ["part"])
    before = _files(path)
    incremental.upsert_by_key(spark, _fact(spark, ("k1-3", 2, 99.0, 1), ("new", 2, 7.0, 7),
                                           (None, 2, 8.0, None)), path, "k", ["part"])
    after = _files(path)
    kept = {f for f in before if f.startswith(("part=0/", "part=2/"))}
    assert kept and all(after[f] == before[f] for f in kept)
    assert not any(f in after for f in before if f not in kept)
    expected = {k: (v, p) for k, _, v, p in rows} | {"k1-3": (99.0, 1), "new": (7.0, 7), None: (8.0, None)}
    read = incremental.read_table(spark, path, _fact(spark).schema).collect()
    assert {r.k: (r.v, r.part) for r in read} == expected and len(read) == len(expected)
    # a row with a NULL key in a NULL partition replaces its like
    incremental.upsert_by_key(spark, _fact(spark, (None, 3, 9.0, None)), path, "k", ["part"])
    got = incremental.read_table(spark, path).where("k is null").collect()
    assert [r.v for r in got] == [9.0]


def test_runs_are_told_apart_by_their_path(spark):
    path = scratch_path(spark, "test-runs", str(random.random()))
    for run, rows in (("2026-01-01 06:00", [("a", 1), ("b", 1)]), ("2026-01-02 06:00", [("a", 2), ("a", 2)])):
        write_snapshot(spark.createDataFrame([(*r, run) for r in rows], "k string, v int, landed string"),
                       path, "landed")
    every = read_runs(spark, path, T._parse_datatype_string("k string, v int"), folder="landed")
    assert sorted((r.k, r.v, r.run) for r in every.collect()) == [
        ("a", 1, "2026-01-01 06-00"), ("a", 2, "2026-01-02 06-00"), ("a", 2, "2026-01-02 06-00"),
        ("b", 1, "2026-01-01 06-00")]
    assert all(r.file.endswith(".parquet") for r in every.collect())
    newest = newest_run(every.drop("file"), ["k"])
    assert sorted((r.k, r.v, r.run) for r in newest.collect()) == [
        ("a", 2, "2026-01-02 06-00"), ("b", 1, "2026-01-01 06-00")]


def test_csv_round_trip_with_rejects(spark, tmp_path):
    path = str(tmp_path / "csv")
    schema = T._parse_datatype_string("id long, name string, at timestamp_ntz, x double")
    rows = [(1, "plain", dt.datetime(2026, 1, 1, 2, 3, 4), 0.1), (2, 'comma, "quote"', None, None),
            (3, None, dt.datetime(2026, 1, 2), -1e300)]
    write_csv(spark.createDataFrame(rows, schema), path)
    with open(f"{path}/zz.csv", "w") as f:
        f.write("id,name,at,x\n4,ok,2026-01-03 00:00:00,4\nfive,bad id,,5\n6,few\n"
                "7,many,2026-01-03 00:00:00,7,8\n")
    good, bad = load_csv(spark, path, schema)
    assert sorted(map(tuple, good.collect())) == sorted(
        [*rows, (4, "ok", dt.datetime(2026, 1, 3), 4.0)])
    assert good.select("name").count() == 4  # the judgement does not depend on the columns read
    assert sorted((r.file, r.line.split(",")[0]) for r in bad.collect()) == [
        ("zz.csv", "6"), ("zz.csv", "7"), ("zz.csv", "five")]


def test_raw_tables_skip_what_is_missing(spark, tmp_path):
    tables = {"one": T._parse_datatype_string("a int"), "two": T._parse_datatype_string("b int")}
    with pytest.raises(FileNotFoundError):
        read_raw_tables(spark, str(tmp_path), tables)
    write_csv(spark.createDataFrame([(7,)], tables["one"]), str(tmp_path / "one.csv"))
    got = read_raw_tables(spark, str(tmp_path), tables)
    assert list(got) == ["one"] and got["one"].first().a == 7


def test_optional_mart(spark, tmp_path):
    schema = T._parse_datatype_string("a int, b string")
    assert read_mart(spark, str(tmp_path / "none"), ["b"], schema).collect() == []
    with pytest.raises(AnalysisException):
        read_mart(spark, str(tmp_path / "none"))


def test_snapshot_partition_names_and_empty(spark):
    path = scratch_path(spark, "test-snap", str(random.random()))
    df = spark.createDataFrame([("x", "2026-06-01T00:00:00+00:00")], "a string, extracted_at string")
    assert write_snapshot(df, path)
    assert not write_snapshot(df.limit(0), path)
    back = spark.read.parquet(path).collect()
    assert back[0].extracted_at == "2026-06-01T00-00-00+00-00"


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (1, None, -1.0), (None, "z", 200.0)],
                               "k int, s string, v double")
    assert quality.unique(df, "k").collect()[0].n_records == 2
    assert quality.not_null(df, "s").count() == 1
    assert quality.accepted_values(df, "s", ["a"]).count() == 1   # NULL passes
    assert quality.between(df, "v", 0, 100).count() == 2
    assert quality.non_negative(df, "v").count() == 1
    parent = spark.createDataFrame([(2,)], "k int")
    assert quality.relationships(df, "k", parent, "k").count() == 2  # NULL child key passes


def test_suite_equals_the_single_checks_in_one_pass(spark, tmp_path):
    rnd = random.Random(3)
    rows = [(rnd.choice([None, *range(40)]), rnd.choice([None, "a", "b", "z"]), rnd.choice(
        [None, -1.0, 5.0, 200.0])) for _ in range(300)]
    spark.createDataFrame(rows, "k int, s string, v double").write.parquet(str(tmp_path / "t"))
    spark.createDataFrame([(k,) for k in [*range(0, 40, 2), None, 4]], "k long").write.parquet(
        str(tmp_path / "p"))
    t, p = spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "p"))
    Q = quality
    checks = [
        (Q.Check("unique", "t", Q.Unique("k")), Q.unique(t, "k")),
        (Q.Check("not null", "t", Q.RowRule(Q.is_missing("v")), "warn"), Q.not_null(t, "v")),
        (Q.Check("accepted", "t", Q.RowRule(Q.is_outside("s", ["a", "b"]))), Q.accepted_values(t, "s", ["a", "b"])),
        (Q.Check("between", "t", Q.RowRule(Q.is_beyond("v", 0, 100))), Q.between(t, "v", 0, 100)),
        (Q.Check("negative", "t", Q.RowRule(Q.is_any_negative(["v"]))), Q.any_negative(t, ["v"], [])),
        (Q.Check("clean", "t", Q.RowRule(Q.is_beyond("v", -5, 1000))), Q.between(t, "v", -5, 1000)),
        (Q.Check("known", "t", Q.Relationship("k", "p", "k")), Q.relationships(t, "k", p, "k")),
        (Q.Check("parent unique", "p", Q.Unique("k"), "warn"), Q.unique(p, "k")),
        (Q.Check("back", "p", Q.Relationship("k", "t", "k")), Q.relationships(p, "k", t, "k")),
    ]
    report = Q.run_suite({"t": t, "p": p}, [c for c, _ in checks])
    plan = report._jdf.queryExecution().executedPlan().toString()
    got = {r.check_name: (r.failures, r.status) for r in report.collect()}
    for c, single in checks:
        n = single.count()
        assert got[c.name] == (n, "pass" if n == 0 else "fail" if c.severity == "error" else "warn")
    assert plan.count("FileScan parquet") == 2 and got["unique"][0] > 1 and got["known"][0] > 1
    with pytest.raises(ValueError):
        Q.run_suite({"t": t}, [c for c, _ in checks])


def test_contract_enforced(spark):
    good = spark.createDataFrame([], schemas.DIM_LOCATION)
    assert quality.contract_violations(good, schemas.DIM_LOCATION) == []
    bad = good.withColumn("population", F.col("population").cast("long"))
    with pytest.raises(ValueError):
        quality.enforce_contract(bad, schemas.DIM_LOCATION)


def test_freshness_levels(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 1),)], "ts timestamp_ntz")
    st = lambda h: quality.freshness(df, "ts", dt.datetime(2026, 1, 1) + dt.timedelta(hours=h)).first().status
    assert (st(1), st(40), st(24 * 8)) == ("pass", "warn", "error")


def test_nearest_forms_agree_on_repeated_and_null_ids(spark):
    left = spark.createDataFrame([(1, 10.0, 10.0), (1, 50.0, 50.0), (None, 10.0, 10.0), (2, -30.0, 5.0),
                                  (3, None, 1.0)], "qid int, lat double, lon double")
    right = spark.createDataFrame([(7, 11.0, 10.0), (8, 49.0, 52.0), (9, -31.0, 6.0)],
                                  "id int, latitude double, longitude double")

    def got(bound):
        return sorted((str(r.qid), r.id, round(r.distance_km, 6)) for r in geo.nearest(
            left, right, "qid", "id", max_broadcast=bound).collect())
    assert len(got(0)) == 4 and got(0) == got(100)
