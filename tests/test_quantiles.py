import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from lathe.operators import quantiles
from lathe.operators.quantiles import column_statistics, exact_medians, median_of, middle_ranks


def test_exact_medians_match_numpy(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(3001):
        a = rnd.gauss(0, 1)
        b = float(rnd.randint(0, 20))  # heavy ties
        c = None if i % 7 == 0 else rnd.uniform(-5, 5)  # missing values
        rows.append((a, b, c))
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = exact_medians(df, ["a", "b", "c"])
    for j, name in enumerate("abc"):
        vals = [r[j] for r in rows if r[j] is not None]
        assert got[name] == pytest.approx(float(np.median(vals)), abs=1e-12)


def test_median_even_count_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert exact_medians(df, ["x"]) == {"x": 2.5}


def test_median_all_missing(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert exact_medians(df, ["x"]) == {"x": None}


def test_heavy_ties_resolve(spark):
    # 60% of the rows share the median value; the region must not stall on it
    vals = [5.0] * 600 + [float(i) for i in range(200)] + [float(1000 + i) for i in range(200)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = exact_medians(df, ["x"])
    assert got["x"] == float(np.median(vals))


def test_even_and_odd_counts(spark):
    rng = np.random.default_rng(11)
    for n in (1001, 1000):
        vals = rng.integers(0, 30, n).astype(float)
        df = spark.createDataFrame([(float(v),) for v in vals], "x double")
        assert exact_medians(df, ["x"])["x"] == float(np.median(vals))


def _hard_columns(n=3001):
    rng = np.random.default_rng(1)
    return {
        "scales": np.exp(rng.normal(size=n) * 100), "negative": -np.exp(rng.normal(size=n) * 100), "zero": np.zeros(n),
        "infinite": np.where(rng.random(n) < 0.6, np.inf, 1.0), "near": 1e15 + rng.integers(0, 3, n), "subnormal": rng.normal(size=n) * 5e-322,
        "mixed": rng.normal(size=n) * 10.0 ** rng.integers(-300, 300, n),
    }


@pytest.mark.parametrize("parts", [2, 7, 1024])
def test_medians_of_hard_columns(spark, monkeypatch, parts):
    monkeypatch.setattr(quantiles, "PARTS", parts)
    cols = _hard_columns(801)
    df = spark.createDataFrame([tuple(float(x) for x in r) for r in zip(*cols.values(), strict=True)], ", ".join(f"{c} double" for c in cols))
    assert exact_medians(df, list(cols)) == {c: float(np.median(v)) for c, v in cols.items()}


def test_statistics_without_each_fold(spark):
    rng = np.random.default_rng(5)
    n = 900
    x, y, fold = rng.normal(size=n) * 100, rng.integers(0, 6, n).astype(float), rng.integers(0, 4, n)
    y[rng.random(n) < 0.3] = np.nan
    fold[fold == 3] = 2  # fold 3 is empty: its complement is the whole table
    rows = [(float(a), None if np.isnan(b) else float(b), int(f)) for a, b, f in zip(x, y, fold, strict=True)]
    df = spark.createDataFrame(rows, "x double, y double, f int")
    got = column_statistics(df, {"x": F.col("x"), "y": F.col("y")}, middle_ranks, F.col("f"), [0, 1, 2, 3])
    for f in range(4):
        for name, v in (("x", x), ("y", y)):
            own = v[(fold != f) & ~np.isnan(v)]
            s = got[name][f]
            assert (s.n, median_of(s)) == (len(own), float(np.median(own)))
            assert s.mean == pytest.approx(own.mean(), rel=1e-9) and s.var_pop == pytest.approx(own.var(), rel=1e-9)


def test_no_rows_and_no_columns(spark):
    df = spark.createDataFrame([], "x double")
    assert exact_medians(df, ["x"]) == {"x": None} and exact_medians(df, []) == {}
