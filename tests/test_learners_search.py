import json

import pytest
from pyspark.sql import functions as F

from lathe.operators.baseline import fit_group_mean
from lathe.operators.learners import deterministic_layout, feature_subset, fit_model, random_forest
from lathe.operators.search import (
    best_candidate,
    grid_search,
    group_mean_cv,
    param_grid,
    sample_candidates,
    summarize_cv,
)
from lathe.operators.split import hash_folds


def test_param_grid_order():
    g = param_grid({"n_estimators": [3, 10], "bootstrap": [True, False], "max_features": [2, 6]})
    assert g[0] == {"bootstrap": True, "max_features": 2, "n_estimators": 3}
    assert g[1] == {"bootstrap": True, "max_features": 2, "n_estimators": 10}
    assert g[-1] == {"bootstrap": False, "max_features": 6, "n_estimators": 10}
    assert len(g) == 8


def test_random_sample_is_seeded_subset():
    cands = param_grid({"a": [1, 2, 3, 4], "b": [0, 1]})
    s1, s2 = sample_candidates(cands, 3, seed=7), sample_candidates(cands, 3, seed=7)
    assert s1 == s2 and len(s1) == 3 and len({i for i, _ in s1}) == 3


def test_feature_subset_mapping():
    assert feature_subset(None) == "all" and feature_subset(1.0) == "all"
    assert feature_subset(6) == "6" and feature_subset("sqrt") == "sqrt"


def _part(spark, sf):
    return spark.read.parquet(f"{sf}/part.parquet").select("p_partkey", F.col("p_size").cast("double").alias("size"),
                                                         F.col("p_partkey").cast("double").alias("pk"), "p_retailprice")


def test_forest_is_layout_independent(spark, sf0001):
    part = _part(spark, sf0001)
    sums = []
    for n in (1, 7):
        data = part.repartition(n)
        m = fit_model(random_forest(seed=42, n_estimators=5, max_depth=6), data, ["pk", "size"], "p_retailprice", key="p_partkey")
        sums.append(m.transform(part).agg(F.sum("prediction")).collect()[0][0])
    assert sums[0] == pytest.approx(sums[1], rel=1e-12)


def test_grid_search_small(spark, sf0001):
    part = hash_folds(_part(spark, sf0001), "p_partkey", 3)
    grid = param_grid({"n_estimators": [2, 4], "max_features": [1, 2]})
    res = grid_search(random_forest(seed=42, max_depth=4), grid, part, ["pk", "size"], "p_retailprice", parallelism=2, key="p_partkey")
    cv = res.cv_results.orderBy("candidate_id").collect()
    assert len(cv) == 4 and res.folds == 3
    assert min(r["rank_test_score"] for r in cv) == 1
    best = min(cv, key=lambda r: (r["rank_test_score"], r["candidate_id"]))
    assert res.best_index == best["candidate_id"] and json.loads(best["params"]) == res.best_params
    assert res.scores.filter("split = 'train'").count() == 12  # train scores kept
    assert res.best_model is not None


def test_summarize_cv_rank_ties_and_best(spark):
    scores = spark.createDataFrame(
        [(0, 0, "test", -2.0), (0, 1, "test", -2.0), (1, 0, "test", -1.0), (1, 1, "test", -3.0), (2, 0, "test", -1.0), (2, 1, "test", -1.0)],
        "candidate_id long, fold int, split string, score double",
    )
    cv = {r["candidate_id"]: r for r in summarize_cv(scores).collect()}
    assert cv[2]["rank_test_score"] == 1 and cv[0]["rank_test_score"] == 2 and cv[1]["rank_test_score"] == 2
    assert cv[1]["std_test_score"] == pytest.approx(1.0)  # population std
    assert best_candidate(summarize_cv(scores)).collect()[0]["candidate_id"] == 2


def test_group_mean_cv_matches_explicit(spark):
    rows = [(i, i % 4, ["a", "b", None][i % 3], float((i * 37) % 101)) for i in range(240)]
    df = spark.createDataFrame(rows, "k long, fold int, g string, y double")
    got = {(r["fold"], r["split"]): r["score"] for r in group_mean_cv(df, "y", ["g"]).collect()}
    for f in range(4):
        tr = [r for r in rows if r[1] != f]
        glob = sum(r[3] for r in tr) / len(tr)
        means = {}
        for g in {r[2] for r in tr}:
            vals = [r[3] for r in tr if r[2] == g]
            means[g] = sum(vals) / len(vals)
        for split, part in (("test", [r for r in rows if r[1] == f]), ("train", tr)):
            mse = sum((r[3] - means.get(r[2], glob)) ** 2 for r in part) / len(part)
            assert got[(f, split)] == pytest.approx(-mse, rel=1e-9)


def test_group_mean_model_fallback(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 10.0)], "g string, y double")
    m = fit_group_mean(train, "y", ["g"])
    test = spark.createDataFrame([("a",), ("c",)], "g string")
    got = {r["g"]: r["prediction"] for r in m.transform(test).collect()}
    assert got == {"a": 2.0, "c": pytest.approx(14.0 / 3)}


def test_deterministic_layout_partitions(spark):
    df = spark.range(0, 100).withColumnRenamed("id", "k")
    assert deterministic_layout(df, "k", 5).rdd.getNumPartitions() == 5
