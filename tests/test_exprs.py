"""Column helpers against Python / numpy / pandas semantics."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voltwatch.functions import categories as C
from voltwatch.functions import exprs as X
from voltwatch.operators.health import normalize


def _values():
    rnd = random.Random(7)
    vals = [0.0, 0.5, 1.5, 2.5, 12.25, 12.35, 0.15, 30.5, 31.45, 2.675, 1.015, -0.04, 99.95, 1e-7, 123456.785]
    vals += [round(rnd.uniform(-1000, 1000), rnd.randint(0, 4)) for _ in range(400)]
    vals += [rnd.uniform(0, 400) for _ in range(200)]
    return vals


@pytest.fixture(scope="module")
def vals_df(spark):
    return spark.createDataFrame([(float(v),) for v in _values()], "x double")


@pytest.mark.parametrize("n", [0, 1, 2])
def test_py_fixed_matches_python_format(vals_df, n):
    got = vals_df.select("x", X.py_fixed("x", n).alias("s")).collect()
    for r in got:
        assert r["s"] == format(r["x"], f".{n}f"), r


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_np_round_matches_numpy(vals_df, n):
    got = vals_df.select("x", X.np_round("x", n).alias("r")).collect()
    for r in got:
        assert r["r"] == float(np.round(r["x"], n)), r


def test_clamp_missing_goes_high(spark):
    df = spark.createDataFrame([(v,) for v in [-10.0, -5.0, 0.0, 25.0, 100.0, 120.0, None]], "x double")
    got = [r[0] for r in df.select(X.clamp_missing_high("x")).collect()]
    assert got == [0.0, 0.0, 0.0, 25.0, 100.0, 100.0, 100.0]


def test_normalize_constant_and_cap(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 50.0, 100.0, 200.0, 500.0]], "x double")
    got = [r[0] for r in normalize(df, "x", cap=100.0).orderBy("x").select("x_norm").collect()]
    assert got == [0.0, 0.5, 1.0, 1.0, 1.0]
    const = spark.createDataFrame([(5.0,), (5.0,), (5.0,)], "x double")
    assert [r[0] for r in normalize(const, "x").select("x_norm").collect()] == [0.0, 0.0, 0.0]


def test_cut_matches_pandas(spark):
    vals = [-1.0, 0.0, 0.5, 10.0, 10.5, 20.0, 55.0, 80.0, 100.0, 101.0, 150.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(X.cut("x", C.BATTERY_BINS, C.BATTERY_LABELS)).collect()]
    want = pd.cut(pd.Series(vals), bins=C.BATTERY_BINS, labels=C.BATTERY_LABELS).astype(object)
    want = [None if (isinstance(w, float) and math.isnan(w)) else w for w in want]
    assert got == want


def test_device_types(spark):
    raw = ["ZM1", " um3 ", "M3", "U-M3", "None", "", None, "mm3", "UM3+", "NULL", "nan", "zm-1", "X9", "UM3"]
    df = spark.createDataFrame([(v,) for v in raw], "t string")
    a = [r[0] for r in df.select(X.device_type_a("t")).collect()]
    assert a == ["ZM1", "UM3+", "MM3", "UM3+", None, None, None, "MM3", "UM3+", None, None, "ZM1", "X9", "UM3+"]
    b = [r[0] for r in df.select(X.device_type_b(X.device_type_upper(F.col("t")))).collect()]
    assert b == ["ZM1", "UM3", "M3", "U-M3", "NONE", "", "NAN", "MM3", "UM3", "NULL", "NAN", "ZM-1", "X9", "UM3"]


def test_numeric_cleaning(spark):
    raw = ["60", "NULL", "1,234", "", "85%", "N/A", "--", " 12 ", "1e3"]
    df = spark.createDataFrame([(v,) for v in raw], "s string")
    r = df.select(X.to_num("s").alias("a"), X.to_num_tokens("s").alias("b"), X.sanitize_num("s").alias("c")).collect()
    assert [x["a"] for x in r] == [60.0, None, None, None, None, None, None, 12.0, 1000.0]
    assert [x["b"] for x in r] == [60.0, None, 1234.0, None, None, None, None, 12.0, 1000.0]
    assert [x["c"] for x in r] == [60.0, None, 1234.0, None, 85.0, None, None, 12.0, 13.0]


def test_to_ts_formats(spark):
    raw = ["2025-01-15", "2025-01-15 10:30:00", "1/15/2025", "2025-13-01", "garbage", None]
    df = spark.createDataFrame([(v,) for v in raw], "s string")
    got = [r[0] for r in df.select(F.date_format(X.to_ts("s"), "yyyy-MM-dd HH:mm").alias("t")).collect()]
    assert got == ["2025-01-15 00:00", "2025-01-15 10:30", "2025-01-15 00:00", None, None, None]


def test_haversine(spark):
    df = spark.createDataFrame([(27.90, -82.40, 27.91, -82.41)], "a double, b double, c double, d double")
    got = df.select(X.haversine("a", "b", "c", "d")).first()[0]
    lat1, lon1, lat2, lon2 = map(math.radians, (27.90, -82.40, 27.91, -82.41))
    a = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    assert got == pytest.approx(2 * 6371000.0 * math.asin(math.sqrt(a)), rel=1e-12)
