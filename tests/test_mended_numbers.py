"""Least squares far from zero, metrics with missing labels, constant folds, one feature a split."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lathe.operators.learners import feature_subset
from lathe.operators.linear import fit_ols, kfold_ols
from lathe.operators.metrics import regression_metrics
from lathe.operators.search import _score_expr


def test_ols_far_from_zero(spark):
    rng = np.random.default_rng(1)
    x, noise = rng.normal(size=900), rng.normal(scale=0.01, size=900)
    rows = [(i % 3, float(1e8 + a), float(1e8 + 2 * a + e)) for i, (a, e) in enumerate(zip(x, noise, strict=True))]
    df = spark.createDataFrame(rows, "fold long, x double, y double")
    model = fit_ols(df, ["x"], "y")
    assert model.coef[0] == pytest.approx(2.0, abs=2e-3)
    assert all(f["test_mse"] == pytest.approx(1e-4, rel=0.3) for f in kfold_ols(df, ["x"], "y"))


def test_metrics_leave_out_rows_without_label_or_prediction(spark):
    rows = [(1.0, 1.5), (2.0, 2.0), (3.0, 2.0), (None, 5.0), (9.0, None)]
    r = regression_metrics(spark.createDataFrame(rows, "y double, prediction double"), "y").first()
    assert (r.n_rows, r.r2) == (3, pytest.approx(1 - 1.25 / 2))


def test_r2_score_of_a_constant_label(spark):
    df = spark.createDataFrame([(0, 5.0, 5.0), (0, 5.0, 5.0), (1, 5.0, 4.0), (1, 5.0, 5.0)], "fold int, y double, prediction double")
    got = {r.fold: r.s for r in df.groupBy("fold").agg(_score_expr("r2", "y").alias("s")).collect()}
    assert got == {0: 1.0, 1: 0.0}


def test_feature_subset_tells_one_from_all():
    assert feature_subset(1.0) == feature_subset(None) == "all"
    assert feature_subset(1) not in ("all", "1") and feature_subset(2) == "2"
    with pytest.raises(ValueError):
        feature_subset(True)
