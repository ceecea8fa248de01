"""The persisted marts: written once, in order, with descriptions, and read with pushed filters."""
import uuid

import pytest
from pyspark.sql import functions as F

from dayframe.plans import bindings as B
from dayframe.plans import build as W
from dayframe.session import scratch_path


@pytest.fixture(scope="module")
def models(spark, sf_small):
    return B.marts(spark, sf_small)


@pytest.fixture(scope="module")
def made(spark, models):
    return W.build(spark, models, scratch_path(spark, "test-build", uuid.uuid4().hex))


def _rows(df):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r)
                   for r in df.collect()), key=str)


@pytest.mark.parametrize("name", W.TABLES)
def test_tables_equal_the_models(spark, sf_small, made, name):
    lazy = getattr(B.marts(spark, sf_small), name)
    read = made.read(name)
    assert read.columns == lazy.columns and _rows(read) == _rows(lazy)


@pytest.mark.parametrize("name", W.TABLES)
def test_every_column_is_described(made, name):
    assert set(made.comments(name)) == set(made.read(name).columns)
    assert all(made.comments(name).values())


def test_order_and_needs():
    names = list(W.TABLES)
    for i, name in enumerate(names):
        assert set(W.TABLES[name].needs) <= set(names[:i])
    assert W.needed(["mart_city_weather_summary"]) == [
        "dim_location", "fct_city_weather_day", "fct_air_quality_city_day", "mart_city_weather_summary"]
    with pytest.raises(ValueError):
        W.needed(["no_such_mart"])


def test_later_models_read_the_written_tables(spark, sf_small):
    models = B.marts(spark, sf_small)
    root = scratch_path(spark, "test-build", uuid.uuid4().hex)
    W.build(spark, models, root, ["mart_extreme_events"])
    plan = models.mart_temperature_anomaly._jdf.queryExecution().optimizedPlan().toString()
    assert "orders" not in plan and models.fct_city_weather_day.inputFiles()[0].find("test-build") > 0


def test_filters_and_columns_reach_the_scan(made):
    df = made.read("fct_city_weather_day", ["city_name", "weather_date"],
                   F.col("weather_date") > F.lit("1997-01-01").cast("date"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(weather_date" in plan and "temperature_2m_max" not in plan


def test_docs_and_a_second_build(spark, sf_small, made):
    docs = {r.mart: r.description for r in made.read("mart_docs").collect()}
    assert docs == {n: m.description for n, m in W.TABLES.items()}
    before = made.read("dim_location").count()
    W.build(spark, B.marts(spark, sf_small), made.root, ["dim_location"])
    assert made.read("dim_location").count() == before


def test_work_tables_go_with_the_block(spark):
    from dayframe.sources.sinks import stored, work_tables
    with work_tables(spark):
        t = stored(spark.range(5), "test")
        path = t.inputFiles()[0].rsplit("/", 1)[0]
        with work_tables(spark):
            stored(spark.range(3), "inner")
        assert t.count() == 5
    import os
    assert not os.path.exists(path.removeprefix("file://"))
