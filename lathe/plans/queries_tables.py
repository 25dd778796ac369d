"""Registered queries for sources, sinks, roles, matrices, wide categories, scoring folders and run records."""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.operators.baseline import fit_group_mean
from lathe.operators.forest import tree
from lathe.operators.learners import fit_model, linear_regression
from lathe.operators.metrics import regression_metrics
from lathe.operators.onehot import category_table, sparse_onehot
from lathe.operators.prep import vector_column
from lathe.operators.profile import column_profile, set_apart, signature_violations
from lathe.operators.search import param_grid, sample_distributions
from lathe.operators.split import hash_folds
from lathe.plans.cases import CATEGORICAL, CV_LABEL, FOLDS, KEY, LABEL, SEED, OrderCase
from lathe.plans.flows import BEST_RUN, EVAL_RUN, FOREST_GRID, INGEST_RUN, PARENT_RUN, full_pipeline, score_models, train_models
from lathe.plans.queries import fin
from lathe.roles import numeric_by_schema, roles_from_schema
from lathe.session import ensure_checkpoint_dir
from lathe.sources.files import land_once, load_labelled, read_csv, write_table
from lathe.sources.models import save_model
from lathe.sources.tables import ORDER_ROLES, order_features, read_table
from lathe.tracking import TrackingStore, run_durations, run_tree, runs_per_parent


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}/{uuid.uuid4().hex}"


# --- sources and sinks ----------------------------------------------------------


def q_csv_roundtrip(spark, sf):
    """The feature table written as headered CSV and read with its schema: empty fields are missing."""
    feat = order_features(spark, sf)
    path = _folder(spark, "csv")
    write_table(feat, path, "csv")
    got = read_csv(spark, path, feat.schema)
    return fin(got.withColumns({c: F.col(c).cast("double") for c in ("n_supp", "n_lines")}))


def q_prepared_roundtrip(spark, sf):
    """Both prepared parts written and read again; the test part is written and read without a label."""
    case = OrderCase(spark, sf)
    root = _folder(spark, "prepared")
    write_table(case.prepared("train"), f"{root}/train")
    write_table(case.prepared("test").drop(LABEL), f"{root}/test")
    train, _ = load_labelled(spark, f"{root}/train", LABEL)
    test, _ = load_labelled(spark, f"{root}/test")
    parts = [df.withColumn("part", F.lit(name)) for name, df in (("train", train), ("test", test))]
    return fin(parts[0].unionByName(parts[1], allowMissingColumns=True))


def q_land_once(spark, sf):
    """A second landing with other prices leaves the stored table as it is."""
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    path = _folder(spark, "landed")
    land_once(orders, path)
    return land_once(orders.withColumn("o_totalprice", F.col("o_totalprice") * 2), path)


def q_roles_by_schema(spark, sf):
    """The roles of the feature table's columns, whether the type alone makes them numeric, and their values."""
    feat = order_features(spark, sf)
    roles = roles_from_schema(feat, KEY, LABEL, list(CATEGORICAL))
    by_type = numeric_by_schema(feat, exclude=(KEY, LABEL))
    named = {KEY: "key", LABEL: "label"} | dict.fromkeys(roles.numeric, "numeric") | dict.fromkeys(roles.categorical, "categorical")
    role = F.create_map(*[F.lit(x) for pair in named.items() for x in pair])
    profile = column_profile(feat)
    return profile.select("column_name", role[F.col("column_name")].alias("role"), F.col("column_name").isin(by_type).alias("numeric_type"), "n_non_null")


# --- matrices and wide categories ---------------------------------------------------


def q_vector_matrix(spark, sf):
    """The prepared test matrix as one vector per row, entry by entry."""
    case = OrderCase(spark, sf)
    matrix = vector_column(case.prepared("test").na.fill(0.0, list(case.prep.ratios)), case.prep.feature_names)
    return fin(matrix.select(KEY, F.posexplode(vector_to_array("features")).alias("position", "value")))


def q_onehot_sparse(spark, sf):
    """Two categorical columns of orders, one with a value per customer, as sorted positions of the ones."""
    orders = read_table(spark, sf, "orders")
    cats = ["o_orderpriority", "o_custkey"]
    table = category_table(orders.where("o_orderstatus = 'O'"), cats)
    got = sparse_onehot(orders, cats, table)
    return got.select("o_orderkey", "n_dims", F.concat_ws(",", F.col("ones").cast("array<string>")).alias("ones"))


# --- search ---------------------------------------------------------------------


def q_grid_candidates(spark, sf):
    """Every candidate of the forest grid with the rows that each of its fits trains on and scores."""
    train = hash_folds(OrderCase(spark, sf).train.select(KEY), KEY, FOLDS, SEED)
    folds = train.groupBy("fold").agg(F.count("*").alias("n_test"))
    total = folds.agg(F.sum("n_test")).first()[0]
    cands = [json.dumps(c, sort_keys=True) for c in param_grid(FOREST_GRID)]
    fits = folds.select("fold", "n_test", F.posexplode(F.array(*[F.lit(c) for c in cands])).alias("candidate_id", "params"))
    return fits.select(F.col("candidate_id").cast("long").alias("candidate_id"), "params", "fold", (F.lit(total) - F.col("n_test")).alias("n_train"), "n_test")


# --- scoring ---------------------------------------------------------------------


def q_train_metrics(spark, sf):
    """The group-mean model evaluated on the rows it was fitted on."""
    train = OrderCase(spark, sf).train.withColumn(CV_LABEL, F.col(LABEL) / F.lit(1000.0))
    return fin(regression_metrics(fit_group_mean(train, CV_LABEL, ["o_orderpriority"]).transform(train), CV_LABEL))


def q_score_models_tables(spark, sf):
    """Models saved to a folder, all scored from there; one prediction table a model."""
    case = OrderCase(spark, sf)
    train = case.prepared("train").withColumn(CV_LABEL, F.col(LABEL) / F.lit(1000.0)).persist()
    root = _folder(spark, "scored")
    try:
        for name, est, feature, key in (
            ("Decision_tree", tree(SEED), "n_lines", KEY),
            ("Linear_Regression", linear_regression(), "sum_qty", None),
        ):
            save_model(spark, fit_model(est, train, [feature], CV_LABEL, key=key), f"{root}/models/{name}")
    finally:
        train.unpersist()
    write_table(case.prepared("test"), f"{root}/test")
    got = score_models(spark, f"{root}/models", f"{root}/test", f"{root}/predictions", KEY)
    return fin(got.select("model", KEY, F.col("Predictions").alias("prediction")))


# --- tracking ---------------------------------------------------------------------


def q_experiment_upsert(spark, sf):
    """An experiment for each order priority: some there before, each only once after two bulk upserts."""
    store = TrackingStore(spark, _folder(spark, "tracking"))
    names = read_table(spark, sf, "orders").select(F.col("o_orderpriority").alias("name")).where("name is not null")
    store.upsert_experiments(names.where("name < '3'"))
    store.upsert_experiments(names)
    return store.upsert_experiments(names)


def _logged_case(spark: SparkSession, sf: str) -> TrackingStore:
    case = OrderCase(spark, sf)
    store = TrackingStore(spark, _folder(spark, "tracking"))
    exp = store.experiment("inputs")
    with store.start_run(PARENT_RUN, exp) as parent:
        for name, part, context in ((INGEST_RUN, case.train, "training"), (EVAL_RUN, case.test, "testing")):
            with store.start_run(name, exp, parent) as run:
                store.log_input(run, part, context, context, LABEL)
                store.log_metrics(run, {"n_rows": part.count()})
    return store


def q_run_inputs(spark, sf):
    """The data sets that each run read, with their profile and digest."""
    store = _logged_case(spark, sf)
    inputs = store.read("inputs").join(store.read("runs").select("run_id", "run_name"), "run_id")
    return inputs.join(store.read("datasets"), "dataset_id").select("run_name", "context", "name", "num_rows", "num_elements", "digest", "targets")


def q_run_durations(spark, sf):
    """Finished runs, their parent, whether a child's time lies within its parent's, children and logged rows."""
    store = _logged_case(spark, sf)
    runs = store.read("runs")
    took: DataFrame = run_durations(runs).select("run_id", "seconds")
    parents = runs_per_parent(runs).select(F.col("parent_run_id").alias("run_id"), "n_children", "span_seconds")
    got = run_tree(runs, store.read("metrics")).join(took, "run_id").join(parents, "run_id", "left")
    fits = (F.col("seconds") >= 0) & (F.coalesce("span_seconds", F.lit(0.0)) <= F.col("seconds"))
    return got.select("run_name", "parent_run_name", "status", fits.alias("times_fit"), F.coalesce("n_children", F.lit(0)).alias("n_children"), F.col("value").alias("n_rows"))


def q_csv_inferred(spark, sf):
    """Types inferred from CSV files of which only the last one has a fraction in a column of whole numbers."""
    feat = order_features(spark, sf)
    most = feat.agg(F.max(KEY)).first()[0]
    quoted = F.concat(F.lit('a, "'), F.col("o_orderpriority"), F.lit('"')).alias("quoted")
    half = F.when(F.col(KEY) == most, F.lit("0.5")).otherwise((F.col(KEY) % 7).cast("string")).alias("half")
    path = _folder(spark, "csv")
    table = feat.select(KEY, "n_lines", "c_acctbal", quoted, half, F.lit(None).cast("string").alias("blank"), (F.col(KEY) % 2 == 0).alias("even"))
    write_table(table.repartitionByRange(4, KEY), path, "csv")
    got = read_csv(spark, path)
    sums = got.agg(F.count("n_lines").alias("a"), F.round(F.sum("half"), 3).alias("b"), F.count_if(F.col("quoted").like('a, "%"')).alias("c")).first()
    rows = [(k, f.name, f.dataType.simpleString(), *(float(x) for x in sums)) for k, f in enumerate(got.schema.fields)]
    return spark.createDataFrame(rows, "position long, column_name string, data_type string, n_lines double, half double, quoted double")


def _damaged_features(spark, sf):
    """Features as a careless export has them: counts as text, some of it no number."""
    feat = order_features(spark, sf)
    text = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("n/a")).otherwise(F.col("n_supp").cast("string"))
    return feat.withColumn("n_supp", text).drop("avg_tax")


SIGNATURE = [(KEY, "bigint", True), ("avg_tax", "double", True), ("sum_qty", "double", True), ("returned_qty", "double", False), ("n_supp", "bigint", False), ("n_lines", "bigint", True)]


def q_signature_violations(spark, sf):
    """Rows that break each rule of a signature, and how many rows stay and are set apart."""
    df = _damaged_features(spark, sf)
    good, bad = set_apart([x for x in SIGNATURE if x[0] != "avg_tax"], df)
    parts = good.agg(F.lit("").alias("column_name"), F.lit("kept").alias("rule"), F.count(F.col("n_supp") + 1).alias("n_rows")).unionByName(
        bad.agg(F.lit("").alias("column_name"), F.lit("set apart").alias("rule"), F.count("*").alias("n_rows"))
    )
    return signature_violations(SIGNATURE, df).unionByName(parts)


def q_run_states(spark, sf):
    """A run per priority, the last one without an end; the log is compacted on the way."""
    sizes = read_table(spark, sf, "orders").groupBy("o_orderpriority").count().orderBy("o_orderpriority").collect()  # five rows
    store = TrackingStore(spark, _folder(spark, "tracking"))
    exp = store.experiment("states")
    for k, r in enumerate(sizes):
        run = store.begin_run(r["o_orderpriority"], exp)
        store.log_metrics(run, {"n_rows": r["count"]})
        if k == 2:
            store.compact("runs")
        if k + 1 < len(sizes):
            store.end_run(run, "FAILED" if k == 1 else "FINISHED")
    got = run_tree(store.read("runs"), store.read("metrics"))
    return got.select("run_name", "status", F.col("end_time").isNotNull().alias("ended"), F.col("value").cast("long").alias("n_rows"))


#: A space of the group-mean stand-in's candidates, with parameters of each kind.
SPACE = {"group_by": ("choice", [0, 1, 2, 3]), "depth": ("int", 3, 12), "rate": ("loguniform", 0.001, 1.0), "share": ("uniform", 0.2, 0.8)}


def q_random_search_draws(spark, sf):
    """Candidates drawn from distributions, with their cross-validated scores."""
    from lathe.plans.queries_models import _cv_results

    draws = sample_distributions(SPACE, 8, SEED)
    rows = [(i, d["group_by"], d["depth"], d["rate"], d["share"]) for i, d in enumerate(draws)]
    table = spark.createDataFrame(rows, "draw long, candidate_id long, depth long, rate double, share double")
    scores = _cv_results(spark, sf).select("candidate_id", "mean_test_score")
    return fin(table.join(scores, "candidate_id").select("draw", "candidate_id", "depth", F.round("rate", 4).alias("rate"), F.round("share", 4).alias("share"), F.round("mean_test_score", 4).alias("mean_test_score")))


def q_train_models_saved(spark, sf):
    """The four models that the train flow saves, each loaded again and scored on the hold-out."""
    case = OrderCase(spark, sf)
    p = case.prep
    root = _folder(spark, "models")
    train_models(p.apply(case.train), p.feature_names, LABEL, KEY, model_dir=f"{root}/m", grid={"n_estimators": [2], "max_features": [2, 6]}, forest={"n_estimators": 3})
    write_table(p.apply(case.test), f"{root}/test")
    scored = score_models(spark, f"{root}/m", f"{root}/test", f"{root}/predictions", KEY, LABEL)
    return scored.groupBy("model").agg(F.count("Predictions").alias("n_rows"), F.countDistinct(KEY).alias("n_keys"))


def q_pipeline_files(spark, sf):
    """Rows of the files that the tracked pipeline writes, read again: raw split, CV table, input example."""
    root = _folder(spark, "pipeline")
    store = TrackingStore(spark, f"{root}/tracking")
    full_pipeline(spark, order_features(spark, sf), ORDER_ROLES, store, f"{root}/work", test_size=0.25, seed=SEED, grid={"n_estimators": [2], "max_features": [2, 6]})
    runs = {r["run_name"]: r["run_id"] for r in store.read("runs").collect()}  # four runs
    parent, best = runs[PARENT_RUN], runs[BEST_RUN]
    files = {"raw train": f"data/{parent}/train", "raw test": f"data/{parent}/test", "cv table": f"cv_results/{best}", "input example": f"models/{best}_input_example"}
    tables = [spark.read.parquet(f"{root}/work/{at}").agg(F.lit(name).alias("what"), F.count("*").alias("n_rows")) for name, at in files.items()]
    raw = [spark.read.parquet(f"{root}/work/{files[f'raw {part}']}").agg(F.lit(f"label sum {part}").alias("what"), F.round(F.sum(LABEL)).cast("long").alias("n_rows")) for part in ("train", "test")]
    return reduce(DataFrame.unionByName, tables + raw)


TABLE_QUERIES = {
    "train_models_saved": q_train_models_saved,
    "pipeline_files": q_pipeline_files,
    "csv_inferred": q_csv_inferred,
    "signature_violations": q_signature_violations,
    "run_states": q_run_states,
    "random_search_draws": q_random_search_draws,
    "csv_roundtrip": q_csv_roundtrip,
    "prepared_roundtrip": q_prepared_roundtrip,
    "land_once": q_land_once,
    "roles_by_schema": q_roles_by_schema,
    "vector_matrix": q_vector_matrix,
    "onehot_sparse": q_onehot_sparse,
    "grid_candidates": q_grid_candidates,
    "train_metrics": q_train_metrics,
    "score_models_tables": q_score_models_tables,
    "experiment_upsert": q_experiment_upsert,
    "run_inputs": q_run_inputs,
    "run_durations": q_run_durations,
}
