import datetime as dt
import hashlib

from pyspark.sql import functions as F

from dayframe.functions import (band_label, clamp, haversine_km, season_from_date, slug, sql_round,
                                surrogate_key)
from dayframe.functions.columns import SURROGATE_NULL_TOKEN


def test_surrogate_key_matches_md5_of_joined_text(spark):
    df = spark.createDataFrame([(1, dt.date(2025, 7, 1), None)], "a int, d date, s string")
    got = df.select(surrogate_key("a", "d", "s").alias("k")).first().k
    want = hashlib.md5(f"1-2025-07-01-{SURROGATE_NULL_TOKEN}".encode()).hexdigest()
    assert got == want


def test_season_from_date_null_is_autumn(spark):
    rows = [(dt.date(2025, m, 1),) for m in range(1, 13)] + [(None,)]
    df = spark.createDataFrame(rows, "d date")
    got = [r.s for r in df.select(season_from_date("d").alias("s")).collect()]
    assert got == ["Winter", "Winter", "Spring", "Spring", "Spring", "Summer", "Summer", "Summer",
                   "Autumn", "Autumn", "Autumn", "Winter", "Autumn"]


def test_sql_round_half_away_on_doubles(spark):
    df = spark.createDataFrame([(0.285,), (1.005,), (-2.5,), (2.5,), (None,)], "x double")
    got = [r.r for r in df.select(sql_round("x", 2).alias("r")).collect()]
    # rounding the double x*100: 0.285*100 = 28.499999..., 1.005*100 = 100.49999...
    assert got[:2] == [0.28, 1.0]
    got0 = [r.r for r in df.select(sql_round("x", 0).alias("r")).collect()]
    assert got0[2:] == [-3.0, 3.0, None]


def test_clamp_keeps_null(spark):
    df = spark.createDataFrame([(-5.0,), (50.0,), (150.0,), (None,)], "x double")
    assert [r.c for r in df.select(clamp("x", 0, 100).alias("c")).collect()] == [0.0, 50.0, 100.0, None]


def test_band_label_edges(spark):
    df = spark.createDataFrame([(None,), (0.0,), (19.99,), (20.0,), (99.9,), (100.0,)], "x double")
    got = [r.b for r in df.select(band_label("x").alias("b")).collect()]
    assert got == ["NO DATA", "GOOD", "GOOD", "FAIR", "VERY POOR", "EXTREME"]


def test_slug_strips_accents(spark):
    df = spark.createDataFrame([("Almería",), ("A Coruña",), ("L'Hospitalet de Llobregat",),
                                ("Castelló de la Plana",)], "c string")
    got = [r.s for r in df.select(slug("c").alias("s")).collect()]
    assert got == ["almeria", "acoruna", "lhospitaletdellobregat", "castellodelaplana"]


def test_haversine_known_distance(spark):
    df = spark.createDataFrame([(40.4168, -3.7038, 41.3874, 2.1686)], "a double, b double, c double, d double")
    km = df.select(haversine_km("a", "b", "c", "d").alias("km")).first().km
    assert 500 < km < 510  # Madrid - Barcelona


def test_sql_round_keeps_sign_of_zero(spark):
    import math
    df = spark.createDataFrame([(-0.001,), (0.001,)], "x double")
    got = [r.r for r in df.select(sql_round("x", 1).alias("r")).collect()]
    assert math.copysign(1, got[0]) == -1 and math.copysign(1, got[1]) == 1


def test_slug_matches_unicode_folding_for_every_code_point(spark):
    import re
    import unicodedata

    def expected(text):
        ascii_only = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()
        return re.sub("[^a-z0-9]+", "", ascii_only.lower())

    chars = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF]
    folding = [ch for ch in chars if ch < "\x80" or unicodedata.decomposition(ch)]
    rest = "".join(ch for ch in chars if ch >= "\x80" and not unicodedata.decomposition(ch))
    texts = [f"a{ch}Z é" for ch in folding] + [rest[i:i + 5000] for i in range(0, len(rest), 5000)]
    texts += ["Café™", "№ 7", "5㎏", "Ⅳ x", "㎒", "ﬃ Ǆ ¾", "x\ufdd0y½ﬁ", ""]
    got = spark.createDataFrame([(t,) for t in texts], "s string").select("s", slug("s").alias("v"))
    wrong = [(r.s[:20], r.v) for r in got.collect() if r.v != expected(r.s)]
    assert wrong == []
    assert spark.createDataFrame([(None,)], "s string").select(slug("s")).first()[0] is None


def test_checkpoint_folder_needs_a_shared_path_off_a_local_master():
    from types import SimpleNamespace

    import pytest

    from dayframe.session import ensure_checkpoint_dir
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: None),
                           sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(fake)
