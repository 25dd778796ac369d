import numpy as np
import pytest
from pyspark.sql import functions as F

from lathe.operators.linear import fit_ols, kfold_ols
from lathe.operators.metrics import regression_metrics


def test_metrics_match_numpy(spark):
    rng = np.random.default_rng(0)
    y = rng.normal(100, 20, 500)
    p = y + rng.normal(0, 5, 500)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, prediction double")
    r = regression_metrics(df, "y").collect()[0]
    e = y - p
    assert r["mae"] == pytest.approx(np.mean(np.abs(e)), rel=1e-12)
    assert r["rmse"] == pytest.approx(np.sqrt(np.mean(e**2)), rel=1e-12)
    assert r["r2"] == pytest.approx(1 - np.sum(e**2) / np.sum((y - y.mean()) ** 2), rel=1e-10)


def test_r2_constant_label(spark):
    perfect = spark.createDataFrame([(3.0, 3.0), (3.0, 3.0)], "y double, prediction double")
    off = spark.createDataFrame([(3.0, 2.0), (3.0, 3.0)], "y double, prediction double")
    assert regression_metrics(perfect, "y").collect()[0]["r2"] == 1.0
    assert regression_metrics(off, "y").collect()[0]["r2"] == 0.0


def test_grouped_metrics(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 3.0, 3.0), ("b", 5.0, 1.0)], "g string, y double, prediction double")
    got = {r["g"]: r for r in regression_metrics(df, "y", by=["g"]).collect()}
    assert got["a"]["mae"] == 0.5 and got["b"]["mae"] == 4.0 and got["b"]["n_rows"] == 1


def _design(spark, n=400, seed=1):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, 3))
    y = 2.0 + X @ np.array([1.5, -2.0, 0.5]) + rng.normal(0, 0.1, n)
    rows = [(i, i % 5, *map(float, X[i]), float(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "k long, fold int, a double, b double, c double, y double"), X, y


def test_ols_matches_lstsq(spark):
    df, X, y = _design(spark)
    m = fit_ols(df, ["a", "b", "c"], "y")
    A = np.c_[np.ones(len(y)), X]
    coef = np.linalg.lstsq(A, y, rcond=None)[0]
    assert m.intercept == pytest.approx(coef[0], abs=1e-9)
    np.testing.assert_allclose(m.coef, coef[1:], atol=1e-9)
    pred = np.array([r["prediction"] for r in m.transform(df).orderBy("k").collect()])
    np.testing.assert_allclose(pred, A @ coef, atol=1e-8)


def test_kfold_ols_matches_refits(spark):
    df, X, y = _design(spark, 300, 2)
    got = {r["fold"]: r for r in kfold_ols(df, ["a", "b", "c"], "y")}
    folds = np.arange(300) % 5
    A = np.c_[np.ones(300), X]
    for f in range(5):
        tr, te = folds != f, folds == f
        coef = np.linalg.lstsq(A[tr], y[tr], rcond=None)[0]
        assert got[f]["test_mse"] == pytest.approx(np.mean((y[te] - A[te] @ coef) ** 2), rel=1e-7)
        assert got[f]["train_mse"] == pytest.approx(np.mean((y[tr] - A[tr] @ coef) ** 2), rel=1e-7)


def test_ols_matches_mllib(spark):
    from lathe.operators.learners import fit_model, linear_regression

    df, _, _ = _design(spark, 200, 3)
    ours = fit_ols(df, ["a", "b", "c"], "y").transform(df).select("k", F.col("prediction").alias("p1"))
    ml = fit_model(linear_regression(), df, ["a", "b", "c"], "y").transform(df).select("k", F.col("prediction").alias("p2"))
    diff = ours.join(ml, "k").select(F.max(F.abs(F.col("p1") - F.col("p2")))).collect()[0][0]
    assert diff < 1e-8


def test_ols_prediction_is_plain_projection(spark):
    df, _, _ = _design(spark, 50)
    plan = fit_ols(df, ["a", "b", "c"], "y").transform(df)._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan


def test_factors_are_merged_in_a_tree(spark, monkeypatch):
    from lathe.operators import linear

    monkeypatch.setattr(linear, "MERGED", 3)
    df, X, y = _design(spark, 500, 3)
    m = fit_ols(df.repartition(20), ["a", "b", "c"], "y")
    coef = np.linalg.lstsq(np.c_[np.ones(len(y)), X], y, rcond=None)[0]
    np.testing.assert_allclose([m.intercept, *m.coef], coef, atol=1e-9)


def test_nearly_dependent_columns(spark):
    """Cross-products would square the condition number: 1e-9 beside 1 is lost in them."""
    rng = np.random.default_rng(5)
    a, e = rng.normal(size=600), rng.normal(size=600) * 1e-9
    df = spark.createDataFrame([(float(x), float(x + d), float(3 * x + 2 * d * 1e9)) for x, d in zip(a, e, strict=True)], "a double, b double, y double")
    m = fit_ols(df, ["a", "b"], "y")
    r = regression_metrics(m.transform(df), "y").first()
    assert r.rmse < 1e-4


def test_few_rows_and_equal_columns(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0), (2.0, 2.0, 4.0), (None, 1.0, 1.0)], "a double, b double, y double")
    m = fit_ols(df, ["a", "b"], "y")
    assert m.coef == pytest.approx((1.0, 1.0)) and m.intercept == pytest.approx(0.0, abs=1e-12)
    with pytest.raises(ValueError):
        fit_ols(df.limit(0), ["a", "b"], "y")
