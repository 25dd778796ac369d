"""End-to-end flows built from the operators.

* ``flagship``: the minimum slice (features -> split -> prep -> OLS -> metrics).
* ``ingest``: split, fit the preparation on the training part, apply it to
  both parts, optionally write them (label kept in the row).
* ``train_models``: linear regression, regression tree, a grid-searched forest
  and, where its parameters are given, a forest without search, each evaluated
  on the training data and logged as its own run; every model is saved.
* ``score``: load a model and a labelled table, return MAE, RMSE and R^2.
* ``score_models``: score a table with every model in a folder and write
  per-model prediction tables.
* ``full_pipeline``: parent run with three child runs (ingestion, best model,
  evaluation), logging parameters, the CV score, the CV table, an input
  example, the model and both datasets.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.operators.forest import Forest, tree
from lathe.operators.learners import fit_model, linear_regression, params_of
from lathe.operators.linear import fit_ols
from lathe.operators.metrics import evaluate, regression_metrics
from lathe.operators.prep import FittedPrep, PrepSpec
from lathe.operators.profile import check_signature, input_example, signature
from lathe.operators.search import grid_search, param_grid
from lathe.operators.split import hash_folds, split_approx, split_exact
from lathe.plans.cases import LABEL, OrderCase
from lathe.roles import Roles
from lathe.session import materialize
from lathe.sources.files import land_once, load_labelled, write_predictions, write_table
from lathe.sources.models import has_folder, is_model, load_model, save_model
from lathe.tracking import TrackingStore, cv_run_records

# The names the tracked run logs under, and the forest grid.
PARENT_RUN = "Parent run"
INGEST_RUN = "data_ingestion_and_preprocessing"
BEST_RUN = "Random_Forest_best_model"
EVAL_RUN = "evaluation"
INGEST_PARAMS = ("Feature columns", "Label column", "Numerical Features", "Categorical Features")
CV_FOLDS_PARAM = "CV Folds"
CV_METRIC = "neg_mean_squared_error"
EVAL_METRICS = ("mean_absolute_error", "root_mean_squared_error", "r_squared")
FOREST_GRID = {"bootstrap": [True, False], "n_estimators": [3, 10], "max_features": [2, 6]}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """features -> exact split -> fitted prep -> OLS on train -> metrics on test."""
    case = OrderCase(spark, sf_dir)
    prep = case.prep
    train = prep.apply(case.train)
    model = fit_ols(train, prep.feature_names, LABEL)
    scored = model.transform(prep.apply(case.test))
    return regression_metrics(scored, LABEL).select(F.lit("linear_regression").alias("model"), "*")


@dataclass
class Ingested:
    train_raw: DataFrame
    test_raw: DataFrame
    train: DataFrame
    test: DataFrame
    prep: FittedPrep


def ingest(
    df: DataFrame,
    roles: Roles,
    ratios: dict | None = None,
    test_size: float = 0.2,
    seed: int = 42,
    exact: bool = True,
    out_dir: str | None = None,
    fmt: str = "parquet",
    materialize_input: str = "persist",
    land_dir: str | None = None,
    **spec_kw,
) -> Ingested:
    if land_dir:
        # raw table written once; later runs read the stored copy instead
        df = land_once(df, land_dir)
    # the split and every fit pass read the input: materialise it once
    # ("persist", or "checkpoint" to the shared checkpoint folder)
    df = materialize(df, materialize_input)
    flagged = split_exact(df, roles.key, test_size, seed) if exact else split_approx(df, roles.key, test_size, seed)
    train_raw = flagged.filter(~F.col("is_test")).drop("is_test")
    test_raw = flagged.filter(F.col("is_test")).drop("is_test")
    spec = PrepSpec(numeric=roles.numeric, categorical=roles.categorical, ratios=ratios or {}, **spec_kw)
    prep = spec.fit(train_raw)
    train, test = prep.apply(train_raw), prep.apply(test_raw)
    if out_dir:
        write_table(train, os.path.join(out_dir, "train"), fmt)
        write_table(test, os.path.join(out_dir, "test"), fmt)
    return Ingested(train_raw, test_raw, train, test, prep)


def train_models(
    train: DataFrame,
    features: list[str],
    label: str,
    key: str,
    store: TrackingStore | None = None,
    experiment: str = "model_training",
    model_dir: str | None = None,
    grid: dict | None = None,
    folds: int = 5,
    seed: int = 42,
    max_depth: int | None = None,
    forest: dict | None = None,
) -> dict:
    """Linear, tree and grid-searched forest; each logged as a run.

    ``forest`` holds the parameters of a forest trained without search beside
    the tuned one. Models go to folders of ``model_dir`` by name, the tuned forest
    to ``model``, so that ``score_models`` can take the folder as it is.
    """
    out: dict = {}
    exp_id = store.experiment(experiment) if store else None
    learners = {
        "Linear_Regression": (linear_regression(), None),
        "Decision_tree": (tree(seed, max_depth), key),
    }
    if forest is not None:
        learners["Random_Forest_untuned"] = (Forest(seed=seed, max_depth=max_depth).with_params(forest), key)
    for name, (est, layout_key) in learners.items():
        model = fit_model(est, train, features, label, key=layout_key)
        m = evaluate(model, train, label)
        out[name] = {"model": model, "train_metrics": m}
        if model_dir:
            save_model(train.sparkSession, model, os.path.join(model_dir, name))
        if store:
            with store.start_run(name, exp_id) as run:
                store.log_params(run, params_of(est))
                store.log_metrics(run, {"mae": m["mae"], "rmse": m["rmse"]})
                if model_dir:
                    # the model with its input signature (names, types, required)
                    path = os.path.join(model_dir, "runs", run.run_id)
                    save_model(train.sparkSession, model, path)
                    write_table(signature(train.select(*features)), path + "_signature")
    data = hash_folds(train, key, folds, seed)
    res = grid_search(
        Forest(seed=seed, max_depth=max_depth), param_grid(grid or FOREST_GRID), data, features, label, key=key
    )
    out["Random_Forest"] = {"model": res.best_model, "search": res}
    if store:
        records = cv_run_records(res.cv_results, exp_id, "Random_Forest", res.folds, log_best_only=True, search_id=uuid.uuid4().hex)
        store.append_records(records)
        if model_dir:
            # the best run keeps its model, input signature and CV table
            path = os.path.join(model_dir, "best", records["runs"].first()["run_id"])
            save_model(train.sparkSession, res.best_model, path)
            write_table(signature(train.select(*features)), path + "_signature")
            write_table(res.cv_results, path + "_cv_results")
    if model_dir:
        write_table(res.cv_results, os.path.join(model_dir, "cv_results"))
    if model_dir:
        save_model(train.sparkSession, res.best_model, os.path.join(model_dir, "model"))
    return out


def score(spark: SparkSession, model_path: str, data_path: str, target_col: str, fmt: str = "parquet") -> dict:
    model = load_model(spark, model_path)
    df, _ = load_labelled(spark, data_path, target_col, fmt)
    enforce_signature(spark, model_path, df)
    return evaluate(model, df, target_col)


def enforce_signature(spark: SparkSession, model_path: str, df: DataFrame) -> None:
    """Raise where a signature is kept beside the model and ``df`` does not match it."""
    if has_folder(spark, model_path + "_signature"):
        kept = spark.read.parquet(model_path + "_signature").orderBy("position").collect()
        check_signature([(r["column_name"], r["data_type"]) for r in kept], df)


def list_models(spark: SparkSession, model_dir: str) -> list[tuple[str, str]]:
    """(name, path) of every model directly under ``model_dir``; signatures, examples and other tables beside them are passed over."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(model_dir)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        if st.isDirectory() and not name.startswith(("_", ".")) and is_model(spark, st.getPath().toString()):
            out.append((name, st.getPath().toString()))
    return sorted(out)


def score_models(
    spark: SparkSession,
    model_dir: str,
    data_path: str,
    output_path: str,
    key: str,
    target_col: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Score one table with every model in a folder; write per-model predictions.

    Each model is loaded once and applied to the same table; the predictions
    of all models go out as one table partitioned by model name (one folder
    per model), with the key and, if given, the label kept next to them.
    """
    df, _ = load_labelled(spark, data_path, target_col, fmt)
    keep = [key] + ([target_col] if target_col else [])
    parts = []
    for name, path in list_models(spark, model_dir):
        enforce_signature(spark, path, df)
        model = load_model(spark, path)
        parts.append(model.transform(df).select(F.lit(name).alias("model"), *keep, F.col("prediction").alias("Predictions")))
    if not parts:
        raise ValueError(f"no models under {model_dir}")
    scored = parts[0]
    for p in parts[1:]:
        scored = scored.unionByName(p)
    write_predictions(scored, output_path, fmt=fmt)
    return spark.read.format(fmt).load(output_path) if fmt != "csv" else spark.read.option("header", True).csv(output_path)


def full_pipeline(
    spark: SparkSession,
    df: DataFrame,
    roles: Roles,
    store: TrackingStore,
    work_dir: str,
    ratios: dict | None = None,
    test_size: float = 0.25,
    seed: int = 42,
    grid: dict | None = None,
    max_depth: int | None = None,
    experiment: str = "Full pipeline",
) -> dict:
    exp_id = store.experiment(experiment)
    with store.start_run(PARENT_RUN, exp_id) as parent:
        with store.start_run(INGEST_RUN, exp_id, parent) as run:
            ing = ingest(df, roles, ratios, test_size, seed)
            # raw split tables, kept for lineage next to the run's outputs
            write_table(ing.train_raw, os.path.join(work_dir, "data", parent.run_id, "train"))
            write_table(ing.test_raw, os.path.join(work_dir, "data", parent.run_id, "test"))
            values = (
                [c for c in df.columns if c not in (roles.key, roles.label)],
                roles.label,
                list(roles.numeric),
                list(roles.categorical),
            )
            store.log_params(run, dict(zip(INGEST_PARAMS, values)))
        feats = ing.prep.feature_names
        data = hash_folds(ing.train, roles.key, 5, seed)
        res = grid_search(
            Forest(seed=seed, max_depth=max_depth), param_grid(grid or FOREST_GRID), data, feats, roles.label, key=roles.key
        )
        with store.start_run(BEST_RUN, exp_id, parent) as run:
            store.log_params(run, {CV_FOLDS_PARAM: res.folds, **res.best_model.params})
            store.log_metrics(run, {CV_METRIC: res.best_score})
            model_path = os.path.join(work_dir, "models", run.run_id)
            save_model(spark, res.best_model, model_path)
            write_table(input_example(ing.train, roles.key), model_path + "_input_example")
            write_table(res.cv_results, os.path.join(work_dir, "cv_results", run.run_id))
            write_table(signature(ing.train, exclude=(roles.key, roles.label)), model_path + "_signature")
            store.log_input(run, ing.train_raw, "train", "training", roles.label)
        with store.start_run(EVAL_RUN, exp_id, parent) as run:
            m = evaluate(res.best_model, ing.test, roles.label)
            store.log_metrics(run, dict(zip(EVAL_METRICS, (m["mae"], m["rmse"], m["r2"]))))
            store.log_input(run, ing.test_raw, "test", "testing", roles.label)
    return {"ingested": ing, "search": res, "evaluation": m, "experiment_id": exp_id, "parent_run_id": parent.run_id,
            "best_params": json.dumps(res.best_params, sort_keys=True)}
