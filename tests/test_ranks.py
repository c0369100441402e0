"""Prefix sums, exact quantiles and exact cut-offs against pandas and plain Python."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voltwatch.operators import ranks as R


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(1)
    data = [(rnd.choice(["a", "a", "a", "b", None]), rnd.choice([None, rnd.gauss(0, 5), float(rnd.randrange(4))]), rnd.randrange(-50, 50), k) for k in range(3000)]
    data += [("c", 1.5, 0, 3000), ("d", None, 1, 3001)]
    return spark.createDataFrame(data, "g string, x double, k int, id bigint").repartition(5), data


def test_cumulative_by_group(spark, rows):
    df, data = rows
    got = R.cumulative(df.groupBy("g", "k").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("s")), F.col("k").desc(), {"n": "upto", "s": "sum"}, ["g"])
    seen = {(r.g, r.k): (r.upto, r["sum"]) for r in got.collect()}
    for (g, k), (n, s) in seen.items():
        some = [d for d in data if d[0] == g and d[2] >= k]
        assert (n, s) == (len(some), sum(d[3] for d in some))


@pytest.mark.parametrize("accuracy", [10_000, 100])  # 100: most values lie outside the brackets
def test_quantiles(rows, monkeypatch, accuracy):
    monkeypatch.setattr(R, "ACCURACY", accuracy)
    df, data = rows
    ps = [0.0, 0.25, 0.5, 0.777, 1.0]
    got = {r.g: r for r in R.exact_quantiles(df, {"x": ps, "k": [0.5]}, ["g"]).collect()}
    for g in ("a", "b", "c", None):
        xs = pd.Series([d[1] for d in data if d[0] == g and d[1] is not None])
        assert np.allclose(got[g].x, xs.quantile(ps), atol=1e-9)
        assert np.allclose(got[g].k, np.quantile([d[2] for d in data if d[0] == g], [0.5]))
    assert got["d"].x is None and got["d"].k == [1.0]
    whole = R.exact_quantiles(df, {"x": [0.75]}).first()
    assert np.allclose(whole.x, np.quantile([d[1] for d in data if d[1] is not None], [0.75]))
    assert R.exact_quantiles(df.limit(0), {"x": [0.75]}).first().x is None


def test_first_rows(rows):
    df, data = rows
    got = R.first_rows(df, F.floor(F.col("_n") * 0.3), [F.col("k"), F.col("id")], "first", ["g"])
    seen = {r.id: r["first"] for r in got.collect()}
    assert len(seen) == len(data)
    for g in {d[0] for d in data}:
        order = sorted([d for d in data if d[0] == g], key=lambda d: (d[2], d[3]))
        assert [seen[d[3]] for d in order] == [i < int(len(order) * 0.3) for i in range(len(order))]


def test_rows_that_agree_stay_together_and_nulls_are_last(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 5), (4, -9), (5, 5)], "id bigint, k bigint")
    took = lambda n: sorted(r.id for r in R.first_rows(df, F.lit(n), [F.col("k")], "first").where("first").collect())
    assert [took(n) for n in (0, 1, 2, 4, 5)] == [[], [4], [4], [2, 3, 4, 5], [1, 2, 3, 4, 5]]
    assert R.first_rows(df.limit(0), F.lit(1), [F.col("k")], "first").count() == 0
