"""Learners on a synthetic label with known signal (SURVEY §5 (d), §7.2).

label = 50*sum_qty - 100*n_lines + 500*(returned_qty > 40) + 0.001*o_totalprice,
missing line aggregates filled with 0, at sf0.01.
"""

import pytest
from pyspark.sql import functions as F

from lathe.operators.learners import fit_model, random_forest
from lathe.operators.linear import kfold_ols
from lathe.operators.metrics import regression_metrics
from lathe.operators.split import contiguous_folds, hash_folds
from lathe.sources.tables import order_features

FEATS = ["n_lines", "sum_qty", "returned_qty", "avg_tax"]


@pytest.fixture(scope="module")
def synth(spark):
    f = order_features(spark, "/root/testdata/sf0.01").fillna(0, subset=["sum_qty", "returned_qty", "n_lines", "avg_tax"])
    y = 50 * F.col("sum_qty") - 100 * F.col("n_lines") + 500 * (F.col("returned_qty") > 40).cast("double") + 0.001 * F.col("o_totalprice")
    return f.withColumn("y", y).persist()


def test_ols_cv_mse_matches_probe(synth):
    # figure from the survey's probe: 5-fold CV MSE of OLS ~ 41,022
    contiguous = kfold_ols(contiguous_folds(synth, "o_orderkey", 5), FEATS, "y")
    hashed = kfold_ols(hash_folds(synth, "o_orderkey", 5), FEATS, "y")
    mean_c = sum(r["test_mse"] for r in contiguous) / 5
    mean_h = sum(r["test_mse"] for r in hashed) / 5
    assert mean_c == pytest.approx(41022, rel=1e-3)
    assert mean_h == pytest.approx(41022, rel=2e-2)


def test_forest_learns_signal(synth):
    m = fit_model(random_forest(seed=42, n_estimators=10, max_depth=12), synth, FEATS, "y", key="o_orderkey")
    r = regression_metrics(m.transform(synth), "y").collect()[0]
    assert r["r2"] > 0.99
