"""Registered queries for metrics, cross-validation, learners and tracking."""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathe.operators.baseline import fit_group_mean
from lathe.operators.forest import Forest, tree
from lathe.operators.learners import fit_model, linear_regression
from lathe.operators.linear import fit_ols, kfold_ols
from lathe.operators.metrics import regression_metrics
from lathe.operators.prep import apply_by_fold
from lathe.operators.profile import input_example
from lathe.operators.search import (
    best_candidate,
    grid_search,
    group_mean_cv_many,
    param_grid,
    sample_candidates,
    summarize_cv,
)
from lathe.operators.split import hash_folds
from lathe.plans.cases import CV_LABEL, FOLDS, KEY, LABEL, MEAN_GRID, NUMERIC, SEED, OrderCase, base_spec, cv_table
from lathe.plans.flows import CV_METRIC, EVAL_METRICS, EVAL_RUN, FOREST_GRID, INGEST_RUN, PARENT_RUN
from lathe.plans.queries import fin
from lathe.session import ensure_checkpoint_dir
from lathe.sources.models import load_model, save_model
from lathe.tracking import TrackingStore, cv_run_records, run_tree

# --- metrics -------------------------------------------------------------------


def _mean_model_scored(case: OrderCase) -> DataFrame:
    train = case.train.withColumn(CV_LABEL, F.col(LABEL) / F.lit(1000.0))
    test = case.test.withColumn(CV_LABEL, F.col(LABEL) / F.lit(1000.0))
    model = fit_group_mean(train, CV_LABEL, ["o_orderpriority"])
    return model.transform(test)


def q_regression_metrics(spark, sf):
    return fin(regression_metrics(_mean_model_scored(OrderCase(spark, sf)), CV_LABEL))


def q_regression_metrics_by_group(spark, sf):
    return fin(regression_metrics(_mean_model_scored(OrderCase(spark, sf)), CV_LABEL, by=["o_orderpriority"]))


# --- cross-validation with the group-mean stand-in --------------------------------


def _mean_candidates():
    return param_grid(MEAN_GRID)


def _mean_scores(case: OrderCase, chosen: list[tuple[int, dict]] | None = None) -> DataFrame:
    data = cv_table(case)
    chosen = chosen or list(enumerate(_mean_candidates()))
    scores = group_mean_cv_many(data, CV_LABEL, [p["group_by"] for _, p in chosen], FOLDS)
    # map positions back to the grid's candidate ids
    ids = F.create_map(*[x for pos, (cid, _) in enumerate(chosen) for x in (F.lit(pos), F.lit(cid))])
    return scores.withColumn("candidate_id", F.element_at(ids, F.col("candidate_id").cast("int")).cast("long"))


def _cands_df(spark, chosen):
    return spark.createDataFrame([(cid, json.dumps(p, sort_keys=True)) for cid, p in chosen], "candidate_id long, params string")


def q_cv_fold_scores(spark, sf):
    s = _mean_scores(OrderCase(spark, sf))
    return fin(s.select("candidate_id", "fold", "split", "score"), 4)


def _cv_results(spark, sf, chosen=None):
    case = OrderCase(spark, sf)
    chosen = chosen or list(enumerate(_mean_candidates()))
    # one row per candidate: cached, as the run-record queries read it several times
    return summarize_cv(_mean_scores(case, chosen), _cands_df(spark, chosen)).persist()


_CV_COLS = ["candidate_id", "mean_test_score", "std_test_score", "mean_train_score", "std_train_score", "rank_test_score"]


def q_cv_results_ranked(spark, sf):
    return fin(_cv_results(spark, sf).select(*_CV_COLS), 4)


def q_cv_best(spark, sf):
    return fin(best_candidate(_cv_results(spark, sf)).select("candidate_id", "mean_test_score", "rank_test_score"), 4)


def q_random_candidates(spark, sf):
    chosen = sample_candidates(_mean_candidates(), n_iter=2, seed=SEED)
    return fin(_cv_results(spark, sf, chosen).select(*_CV_COLS), 4)


# --- linear models ------------------------------------------------------------------


def q_linreg_one_feature(spark, sf):
    case = OrderCase(spark, sf)
    train = case.prepared("train").withColumn(CV_LABEL, F.col(LABEL) / F.lit(1000.0))
    model = fit_ols(train, ["sum_qty"], CV_LABEL)
    r2 = regression_metrics(model.transform(train), CV_LABEL).select("r2")
    out = r2.select(
        F.lit(model.coef[0]).alias("slope"), F.lit(model.intercept).alias("intercept"), F.col("r2")
    )
    return fin(out)


def q_ols_predict_one_feature(spark, sf):
    """OLS on one prepared feature, fitted on train, predictions on the hold-out."""
    case = OrderCase(spark, sf)
    train = case.prepared("train").withColumn(CV_LABEL, F.col(LABEL) / F.lit(1000.0))
    model = fit_ols(train, ["sum_qty"], CV_LABEL)
    return fin(model.transform(case.prepared("test")).select(KEY, "prediction"))


def q_fit_ols_predict(spark, sf):
    case = OrderCase(spark, sf)
    p = case.prep
    model = fit_ols(p.apply(case.train), p.feature_names, LABEL)
    return fin(model.transform(p.apply(case.test)).select(KEY, "prediction"), 3)


def q_kfold_ols(spark, sf):
    case = OrderCase(spark, sf)
    p = case.prep
    data = hash_folds(p.apply(case.train), KEY, FOLDS, SEED)
    rows = kfold_ols(data, p.feature_names, LABEL)
    out = spark.createDataFrame(
        [(r["fold"], r["n_test"], r["n_train"], r["test_mse"], r["train_mse"]) for r in rows],
        "fold int, n_test long, n_train long, test_mse double, train_mse double",
    )
    return fin(out, 0)  # squared errors of prices: about 2e10


def q_kfold_ols_one_feature(spark, sf):
    """Closed-form 5-fold CV of OLS on one prepared feature (label in thousands)."""
    case = OrderCase(spark, sf)
    data = hash_folds(case.prepared("train").withColumn(CV_LABEL, F.col(LABEL) / F.lit(1000.0)), KEY, FOLDS, SEED)
    rows = kfold_ols(data, ["sum_qty"], CV_LABEL)
    out = spark.createDataFrame(
        [(r["fold"], r["n_test"], r["n_train"], r["test_mse"], r["train_mse"]) for r in rows],
        "fold int, n_test long, n_train long, test_mse double, train_mse double",
    )
    return fin(out, 4)


# --- trees and forests (rows-only checks) -----------------------------------------------


def q_fit_tree_predict(spark, sf):
    case = OrderCase(spark, sf)
    p = case.prep
    model = fit_model(tree(SEED), p.apply(case.train), p.feature_names, LABEL, key=KEY)
    return model.transform(p.apply(case.test)).select(KEY, "prediction")


def q_fit_forest_predict(spark, sf):
    case = OrderCase(spark, sf)
    p = case.prep
    est = Forest(10, 6, False, seed=SEED)
    model = fit_model(est, p.apply(case.train), p.feature_names, LABEL, key=KEY)
    return model.transform(p.apply(case.test)).select(KEY, "prediction")


def q_grid_search_forest(spark, sf):
    case = OrderCase(spark, sf)
    p = case.prep
    data = hash_folds(p.apply(case.train), KEY, FOLDS, SEED)
    res = grid_search(Forest(seed=SEED), param_grid(FOREST_GRID), data, p.feature_names, LABEL, key=KEY)
    return res.cv_results.withColumn("is_best", F.col("candidate_id") == F.lit(res.best_index))


def q_fold_prep_stats(spark, sf):
    """Per fold: median, mean and deviation of every column, fitted on the other folds."""
    case = OrderCase(spark, sf)
    data = hash_folds(case.train, KEY, FOLDS, SEED)
    rows = [
        (f, c, p.imputation.values[c], p.scaling.mean[c], p.scaling.std[c])
        for f, p in base_spec().fit_without(data, "fold", list(range(FOLDS))).items()
        for c in NUMERIC
    ]
    return fin(spark.createDataFrame(rows, "fold int, column_name string, median double, mean double, std double"), 5)


def q_fold_prep_rows(spark, sf):
    """Every training row prepared by the statistics of the other folds."""
    case = OrderCase(spark, sf)
    data = hash_folds(case.train, KEY, FOLDS, SEED)
    return fin(apply_by_fold(base_spec().fit_without(data, "fold", list(range(FOLDS))), data, "fold"), 5)


def q_grid_search_by_fold(spark, sf):
    """The forest search with each fold prepared by the other folds' statistics."""
    case = OrderCase(spark, sf)
    data = hash_folds(case.train, KEY, FOLDS, SEED)
    grid = param_grid({"n_estimators": [3], "max_features": [2, 6]})
    res = grid_search(Forest(bootstrap=False, seed=SEED), grid, data, [], LABEL, key=KEY, prep=base_spec(), refit=False)
    return res.cv_results.withColumn("is_best", F.col("candidate_id") == F.lit(res.best_index))


def q_score_many_models(spark, sf):
    case = OrderCase(spark, sf)
    p = case.prep
    train, test = p.apply(case.train), p.apply(case.test)
    feats = p.feature_names
    train = train.persist()  # four fits read it
    fits = {
        "ols": lambda: fit_ols(train, feats, LABEL),
        "linear_regression": lambda: fit_model(linear_regression(), train, feats, LABEL),
        "decision_tree": lambda: fit_model(tree(SEED), train, feats, LABEL, key=KEY),
        "random_forest": lambda: fit_model(Forest(10, seed=SEED), train, feats, LABEL, key=KEY),
    }
    # independent fits: submit them as concurrent Spark jobs
    with ThreadPoolExecutor(max_workers=len(fits)) as pool:
        futures = {name: pool.submit(f) for name, f in fits.items()}
        models = {name: fut.result() for name, fut in futures.items()}
    parts = [m.transform(test).select(F.lit(name).alias("model"), KEY, "prediction") for name, m in models.items()]
    return reduce(DataFrame.unionByName, parts)


def q_model_roundtrip(spark, sf):
    case = OrderCase(spark, sf)
    p = case.prep
    est = Forest(5, seed=SEED)
    model = fit_model(est, p.apply(case.train), p.feature_names, LABEL, key=KEY)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/models/{uuid.uuid4().hex}"
    save_model(spark, model, path)
    return load_model(spark, path).transform(p.apply(case.test)).select(KEY, "prediction")


# --- learners whose result SQL can follow --------------------------------------------


def _one_feature_predictions(spark, sf, estimator):
    """Fitted on the prepared line count alone: few values, so an uncapped tree holds a leaf for each."""
    case = OrderCase(spark, sf)
    train = case.prepared("train").withColumn(CV_LABEL, F.col(LABEL) / F.lit(1000.0))
    model = fit_model(estimator, train, ["n_lines"], CV_LABEL, key=KEY)
    return fin(model.transform(case.prepared("test")).select(KEY, "prediction"))


def q_tree_one_feature(spark, sf):
    return _one_feature_predictions(spark, sf, tree(SEED))


def q_forest_one_feature(spark, sf):
    return _one_feature_predictions(spark, sf, Forest(3, bootstrap=False, seed=SEED))


#: Features whose values are the same numbers in every engine (averages of doubles are not), so that equal splits can be asked for.
EXACT_FEATURES = ["sum_qty", "returned_qty", "n_supp", "n_lines", "c_acctbal"]


def _exact_predictions(spark, sf, forest):
    """Grown without a cap on imputed columns and the price in cents: SQL can follow every split."""
    case = OrderCase(spark, sf)
    train, test = (case.prep.imputation.apply(part) for part in (case.train, case.test))
    cents = F.round(F.col(LABEL) * 100).alias("cents")
    model = fit_model(forest, train.select(KEY, *EXACT_FEATURES, cents), EXACT_FEATURES, "cents", key=KEY)
    return fin(model.transform(test).select(KEY, (F.col("prediction") / 100).alias("prediction")), 4)


def q_tree_exact(spark, sf):
    return _exact_predictions(spark, sf, tree(SEED))


def q_forest_exact(spark, sf):
    return _exact_predictions(spark, sf, Forest(3, 2, True, seed=SEED))


def q_ols_residuals(spark, sf):
    """Mean product of the residual and each feature on the training part: zero for least squares."""
    case = OrderCase(spark, sf)
    train = case.prepared("train").withColumn(CV_LABEL, F.col(LABEL) / F.lit(1000.0))
    feats = case.prep.feature_names
    off = F.col(CV_LABEL) - F.col("prediction")
    sums = fit_ols(train, feats, CV_LABEL).transform(train).agg(*[F.avg(off * F.col(f"`{c}`")).alias(c) for c in feats])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("mean_product")) for c in feats])
    return fin(sums.select(F.explode(rows).alias("r")).select("r.feature", "r.mean_product"))


def q_model_roundtrip_equal(spark, sf):
    """Hold-out rows, and those that a saved and reloaded forest predicts as the fitted one did."""
    case = OrderCase(spark, sf)
    p = case.prep
    model = fit_model(Forest(5, seed=SEED), p.apply(case.train), p.feature_names, LABEL, key=KEY)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/models/{uuid.uuid4().hex}"
    save_model(spark, model, path)
    before = model.transform(p.apply(case.test)).withColumnRenamed("prediction", "was")
    both = load_model(spark, path).transform(before)
    return both.agg(F.count("*").alias("n_rows"), F.count_if(F.col("was") == F.col("prediction")).alias("n_equal"))


# --- tracking -------------------------------------------------------------------------------

EXPERIMENT_ID = "cv-stand-in"


def _cv_records(spark, sf, best_only=False):
    cv = _cv_results(spark, sf)
    return cv_run_records(cv, EXPERIMENT_ID, "Group_Mean", FOLDS, log_best_only=best_only, tags={"label": CV_LABEL}, now_ms=0)


def q_run_metrics(spark, sf):
    rec = _cv_records(spark, sf)
    out = rec["metrics"].join(rec["runs"].select("run_id", "run_name"), "run_id").select("run_id", "run_name", "key", "value")
    return fin(out, 4)


def q_run_params(spark, sf):
    rec = _cv_records(spark, sf, best_only=True)
    params = rec["params"].join(rec["runs"].select("run_id", "run_name"), "run_id")
    tags = rec["tags"].join(rec["runs"].select("run_id", "run_name"), "run_id")
    return params.select("run_name", F.lit("param").alias("kind"), "key", "value").unionByName(
        tags.select("run_name", F.lit("tag").alias("kind"), "key", "value")
    )


def q_run_tree(spark, sf):
    """The pipeline's run tree: parent, ingestion, best model, evaluation."""
    case = OrderCase(spark, sf)
    cv = _cv_results(spark, sf)
    best = best_candidate(cv).collect()[0]
    group_by = json.loads(best["params"])["group_by"]
    scored = _mean_model_scored_with(case, group_by)
    ev = regression_metrics(scored, CV_LABEL)
    store = TrackingStore(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/tracking/{uuid.uuid4().hex}")
    exp = store.experiment(EXPERIMENT_ID)
    with store.start_run(PARENT_RUN, exp) as parent:
        with store.start_run(INGEST_RUN, exp, parent):
            pass
        with store.start_run("Group_Mean_best_model", exp, parent) as run:
            store.log_metrics(run, {CV_METRIC: best["mean_test_score"]})
        with store.start_run(EVAL_RUN, exp, parent) as run:
            got = ev.first()
            store.log_metrics(run, dict(zip(EVAL_METRICS, (got["mae"], got["rmse"], got["r2"]))))
    runs, metrics = store.read("runs"), store.read("metrics")
    tree = run_tree(runs, metrics)
    return fin(tree.select("run_name", "parent_run_name", "key", "value"), 4)


def _mean_model_scored_with(case: OrderCase, group_by: list[str]) -> DataFrame:
    train = case.train.withColumn(CV_LABEL, F.col(LABEL) / F.lit(1000.0))
    test = case.test.withColumn(CV_LABEL, F.col(LABEL) / F.lit(1000.0))
    return fit_group_mean(train, CV_LABEL, group_by).transform(test)


def q_input_example(spark, sf):
    """Rows at positions 0, 50 and 100 of the prepared training table in key order."""
    return fin(input_example(OrderCase(spark, sf).prepared("train"), KEY))


def q_pipeline_full(spark, sf):
    """The whole flow: parent run, ingestion, grid-searched forest, evaluation.

    Tracking tables and the model go to the session's checkpoint folder; the
    result is the run tree with every logged metric, read back from the
    tracking tables (self-join child -> parent).
    """
    from lathe.plans.flows import full_pipeline
    from lathe.sources.tables import ORDER_RATIOS, ORDER_ROLES, order_features

    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline/{uuid.uuid4().hex}"
    store = TrackingStore(spark, f"{root}/tracking")
    ratios = {k: v for k, v in ORDER_RATIOS.items() if k != "bedrooms_per_room"}
    full_pipeline(
        spark, order_features(spark, sf), ORDER_ROLES, store, f"{root}/work", ratios=ratios,
        test_size=0.25, seed=SEED, grid=FOREST_GRID,
    )
    tree = run_tree(store.read("runs"), store.read("metrics"))
    return tree.select("run_name", "parent_run_name", "key", "value")


MODEL_QUERIES = {
    "regression_metrics": q_regression_metrics,
    "regression_metrics_by_group": q_regression_metrics_by_group,
    "cv_fold_scores": q_cv_fold_scores,
    "cv_results_ranked": q_cv_results_ranked,
    "cv_best": q_cv_best,
    "random_candidates": q_random_candidates,
    "linreg_one_feature": q_linreg_one_feature,
    "ols_predict_one_feature": q_ols_predict_one_feature,
    "kfold_ols_one_feature": q_kfold_ols_one_feature,
    "run_metrics": q_run_metrics,
    "run_params": q_run_params,
    "run_tree": q_run_tree,
    "input_example": q_input_example,
    "tree_one_feature": q_tree_one_feature,
    "forest_one_feature": q_forest_one_feature,
    "fold_prep_stats": q_fold_prep_stats,
    "fold_prep_rows": q_fold_prep_rows,
    "tree_exact": q_tree_exact,
    "forest_exact": q_forest_exact,
    "ols_residuals": q_ols_residuals,
    "model_roundtrip_equal": q_model_roundtrip_equal,
    # rows-only: learner outputs
    "fit_ols_predict": q_fit_ols_predict,
    "kfold_ols": q_kfold_ols,
    "fit_tree_predict": q_fit_tree_predict,
    "fit_forest_predict": q_fit_forest_predict,
    "grid_search_forest": q_grid_search_forest,
    "grid_search_by_fold": q_grid_search_by_fold,
    "score_many_models": q_score_many_models,
    "model_roundtrip": q_model_roundtrip,
    "pipeline_full": q_pipeline_full,
}
