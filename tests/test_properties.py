"""Property tests: split sizes and disjointness, metrics against numpy."""

import math

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lathe.operators.metrics import regression_metrics
from lathe.operators.split import split_exact

FAST = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@FAST
@given(n=st.integers(1, 400), frac=st.floats(0.0, 1.0), seed=st.integers(0, 10_000))
def test_exact_split_sizes(spark, n, frac, seed):
    df = spark.range(0, n).withColumnRenamed("id", "k")
    flagged = split_exact(df, "k", frac, seed, max_boundary_rows=7)
    got = flagged.filter("is_test").count()
    assert got == min(n, math.ceil(frac * n))
    assert flagged.count() == n


@FAST
@given(vals=st.lists(st.tuples(st.floats(-1e6, 1e6), st.floats(-1e6, 1e6)), min_size=2, max_size=60))
def test_metrics_property(spark, vals):
    df = spark.createDataFrame([(float(a), float(b)) for a, b in vals], "y double, prediction double")
    r = regression_metrics(df, "y").collect()[0]
    y = np.array([a for a, _ in vals])
    p = np.array([b for _, b in vals])
    e = y - p
    assert math.isclose(r["mae"], float(np.mean(np.abs(e))), rel_tol=1e-9, abs_tol=1e-6)
    assert math.isclose(r["rmse"], float(np.sqrt(np.mean(e * e))), rel_tol=1e-9, abs_tol=1e-6)
    sst = float(np.sum((y - y.mean()) ** 2))
    if sst > 1e-6:
        assert math.isclose(r["r2"], 1 - float(np.sum(e * e)) / sst, rel_tol=1e-6, abs_tol=1e-6)


@FAST
@given(
    vals=st.lists(st.one_of(st.none(), st.integers(-20, 20).map(float), st.floats(-1e3, 1e3)), min_size=1, max_size=80),
)
def test_exact_median_property(spark, vals):
    from lathe.operators.quantiles import exact_medians

    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = exact_medians(df, ["x"])["x"]
    clean = [v for v in vals if v is not None]
    if not clean:
        assert got is None
    else:
        assert math.isclose(got, float(np.median(clean)), rel_tol=1e-12, abs_tol=1e-12)


def test_mode_ties_prefer_smallest_negative(spark):
    from lathe.operators.impute import fit_imputer

    df = spark.createDataFrame([(-3.0,), (-1.0,), (-3.0,), (-1.0,), (2.0,)], "x double").repartition(3)
    assert fit_imputer(df, ["x"], "most_frequent").values["x"] == -3.0
