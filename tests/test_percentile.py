"""Distributed exact percentile: equal to Spark's in-aggregate percentile, also for a group with
many more values than the others."""
import random

import pytest
from pyspark.sql import functions as F

from dayframe.operators.percentile import grouped_percentiles
from dayframe.sources import sinks


@pytest.fixture(scope="module")
def readings(spark):
    rng = random.Random(11)
    rows = []
    for g in range(30):
        n = 12000 if g == 0 else rng.randint(1, 25)
        for _ in range(n):
            a = rng.choice([None, round(rng.uniform(0, 50), 1), rng.uniform(-5, 5)])
            b = None if g == 5 else rng.choice([1.0, 2.0, None])
            rows.append((g, None if g == 3 else f"c{g % 3}", a, b))
    return spark.createDataFrame(rows, "g int, name string, a double, b double").repartition(6)


@pytest.mark.parametrize("q", [0.0, 0.37, 0.5, 0.95, 1.0])
def test_matches_spark_percentile(spark, readings, q):
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ref = readings.groupBy("g", "name").agg(F.percentile("a", q).alias("p_a"),
                                                F.percentile("b", q).alias("p_b"))
        got = grouped_percentiles(readings, ["g", "name"], ["a", "b"], q)
        ref_rows = {(r.g, r.name): (r.p_a, r.p_b) for r in ref.collect()
                    if r.p_a is not None or r.p_b is not None}
        got_rows = {(r.g, r.name): (r.p_a, r.p_b) for r in got.collect()}
        assert got_rows == ref_rows
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_reads_its_input_once(spark, readings):
    """Two measures, one pass: the plan over the source is only run for the count table."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = readings.mapInArrow(count, readings.schema)
    got = grouped_percentiles(rows, ["g"], ["a", "b"], 0.95)
    assert got.count() == 30 and seen.value == readings.count()
    assert "Python" not in got._jdf.queryExecution().toString()


def test_hot_group_is_spread_over_partitions(spark, readings, monkeypatch):
    """No window holds a whole hot group: its counts lie in several range partitions."""
    from dayframe.operators import percentile
    kept = []
    monkeypatch.setattr(percentile, "stored", lambda df, what: kept.append(sinks.stored(df, what)) or kept[-1])
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.g: r.p_a for r in grouped_percentiles(readings, ["g"], ["a"], 0.5).collect()}
        ref = {r.g: r.p for r in readings.groupBy("g").agg(F.percentile("a", 0.5).alias("p")).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == {g: p for g, p in ref.items() if p is not None}
    hot = kept[0].where("g = 0").groupBy("__part").agg(F.sum("__c").alias("n")).collect()
    assert len(hot) > 4


def test_results_follow_the_input(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.range(5000).selectExpr("id % 2 as g", "cast(id as double) as a")
    base.write.parquet(path)
    before = {r.g: r.p_a for r in grouped_percentiles(
        spark.read.parquet(path), ["g"], ["a"], 0.95).collect()}
    base.withColumn("a", F.col("a") * 10).write.mode("overwrite").parquet(path)
    after = {r.g: r.p_a for r in grouped_percentiles(
        spark.read.parquet(path), ["g"], ["a"], 0.95).collect()}
    assert {g: p * 10 for g, p in before.items()} == pytest.approx(after)


def test_rejects_bad_quantile(spark, readings):
    with pytest.raises(ValueError):
        grouped_percentiles(readings, ["g"], ["a"], 1.5)
