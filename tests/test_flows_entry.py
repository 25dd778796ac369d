import os

import pytest
from pyspark.sql import functions as F

from lathe.plans.cases import OrderCase
from lathe.plans.flows import full_pipeline, ingest, score
from lathe.sources.tables import ORDER_RATIOS, ORDER_ROLES, order_features
from lathe.streaming import start_scoring
from lathe.tracking import TrackingStore, run_tree


def test_entry_contract(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and {"mae", "rmse", "r2"} <= set(df.columns)
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 40


def test_ingest_writes_prepared_tables(spark, sf0001, tmp_path):
    feat = order_features(spark, sf0001)
    ing = ingest(feat, ORDER_ROLES, ORDER_RATIOS, test_size=0.2, out_dir=str(tmp_path / "processed"))
    tr = spark.read.parquet(str(tmp_path / "processed" / "train"))
    te = spark.read.parquet(str(tmp_path / "processed" / "test"))
    assert tr.count() + te.count() == feat.count()
    assert te.count() == 300  # ceil(0.2 * 1500)
    assert "o_totalprice" in tr.columns and "o_orderpriority" not in tr.columns


def test_full_pipeline_run_tree_and_score(spark, sf0001, tmp_path):
    feat = order_features(spark, sf0001)
    store = TrackingStore(spark, str(tmp_path / "track"))
    out = full_pipeline(
        spark, feat, ORDER_ROLES, store, str(tmp_path / "work"), ratios=ORDER_RATIOS,
        grid={"n_estimators": [2], "max_features": [2, 4], "bootstrap": [False]}, max_depth=3,
    )
    tree = run_tree(store.read("runs"), store.read("metrics")).collect()
    children = {r["run_name"] for r in tree if r["parent_run_name"] == "Parent run"}
    assert children == {"data_ingestion_and_preprocessing", "Random_Forest_best_model", "evaluation"}
    keys = {r["key"] for r in tree if r["run_name"] == "evaluation"}
    assert keys == {"mean_absolute_error", "root_mean_squared_error", "r_squared"}
    assert store.read("inputs").select("context").distinct().count() == 2
    # score the saved model against the prepared test table
    best_run = [r for r in store.read("runs").collect() if r["run_name"] == "Random_Forest_best_model"][0]
    test_path = str(tmp_path / "test_prepared")
    out["ingested"].test.write.parquet(test_path)
    m = score(spark, os.path.join(str(tmp_path / "work"), "models", best_run["run_id"]), test_path, "o_totalprice")
    assert abs(m["mae"] - out["evaluation"]["mae"]) < 1e-6


def test_stream_scoring(spark, sf0001, tmp_path):
    case = OrderCase(spark, sf0001)
    from lathe.operators.linear import fit_ols

    model = fit_ols(case.prepared("train"), case.prep.feature_names, "o_totalprice")
    src = str(tmp_path / "incoming")
    case.test.write.parquet(src)
    stream = spark.readStream.schema(case.test.schema).parquet(src)
    got = []
    q = start_scoring(stream, case.prep, model, ["o_orderkey"], lambda b, i: got.append(b.count()), str(tmp_path / "ckpt"))
    q.processAllAvailable()
    q.stop()
    assert sum(got) == case.test.count()


def test_train_models_logs_and_saves(spark, sf0001, tmp_path):
    from lathe.plans.flows import train_models
    from lathe.roles import numeric_by_schema

    feat = order_features(spark, sf0001)
    ing = ingest(feat, ORDER_ROLES, ORDER_RATIOS, test_size=0.2)
    feats = numeric_by_schema(ing.train, exclude=("o_orderkey", "o_totalprice"))
    assert feats == ing.prep.feature_names  # every prepared feature is numeric
    store = TrackingStore(spark, str(tmp_path / "track"))
    out = train_models(
        ing.train, feats, "o_totalprice", "o_orderkey", store=store, model_dir=str(tmp_path / "models"),
        grid={"n_estimators": [2], "max_features": [2, 3], "bootstrap": [True]}, max_depth=3,
    )
    assert set(out) == {"Linear_Regression", "Decision_tree", "Random_Forest"}
    names = {r["run_name"] for r in store.read("runs").collect()}
    assert {"Linear_Regression", "Decision_tree"} <= names and any(n.startswith("Random_Forest_") for n in names)
    assert os.path.isdir(str(tmp_path / "models" / "model"))
    sigs = [d for d in os.listdir(str(tmp_path / "models" / "runs")) if d.endswith("_signature")]
    assert len(sigs) == 2
    sig = spark.read.parquet(str(tmp_path / "models" / "runs" / sigs[0]))
    assert sig.count() == len(feats) and sig.filter("required").count() == len(feats)
    assert out["Linear_Regression"]["train_metrics"]["rmse"] > 0


def test_vector_column_sparse_for_indicators(spark):
    from lathe.operators.prep import vector_column

    df = spark.createDataFrame([(0.0, 0.0, 0.0, 0.0, 1.0)], "a double, b double, c double, d double, e double")
    v = vector_column(df, ["a", "b", "c", "d", "e"]).collect()[0]["features"]
    assert v.toArray().tolist() == [0.0, 0.0, 0.0, 0.0, 1.0]


def test_ingest_with_checkpointed_input(spark, sf0001):
    feat = order_features(spark, sf0001)
    a = ingest(feat, ORDER_ROLES, ORDER_RATIOS, test_size=0.2, materialize_input="checkpoint")
    b = ingest(feat, ORDER_ROLES, ORDER_RATIOS, test_size=0.2)
    assert a.prep.imputation.values == b.prep.imputation.values
    assert a.test.count() == b.test.count() == 300


def test_score_models_directory(spark, sf0001, tmp_path):
    from lathe.operators.learners import decision_tree, fit_model, linear_regression
    from lathe.operators.linear import fit_ols
    from lathe.plans.flows import score_models
    from lathe.sources.models import save_model

    case = OrderCase(spark, sf0001)
    p = case.prep
    train, test = case.prepared("train"), case.prepared("test")
    mdir = str(tmp_path / "models")
    save_model(spark, fit_ols(train, p.feature_names, "o_totalprice"), f"{mdir}/ols")
    save_model(spark, fit_model(linear_regression(), train, p.feature_names, "o_totalprice"), f"{mdir}/linear")
    save_model(spark, fit_model(decision_tree(max_depth=3), train, p.feature_names, "o_totalprice", key="o_orderkey"), f"{mdir}/tree")
    test.write.parquet(str(tmp_path / "test"))
    out = score_models(spark, mdir, str(tmp_path / "test"), str(tmp_path / "preds"), "o_orderkey", "o_totalprice")
    counts = {r["model"]: r["count"] for r in out.groupBy("model").count().collect()}
    assert counts == {"linear": 375, "ols": 375, "tree": 375}
    # the two least-squares models agree
    pl = out.filter("model = 'linear'").select("o_orderkey", F.col("Predictions").alias("a"))
    po = out.filter("model = 'ols'").select("o_orderkey", F.col("Predictions").alias("b"))
    assert pl.join(po, "o_orderkey").select(F.max(F.abs(F.col("a") - F.col("b")))).collect()[0][0] < 1e-4


def test_ingest_landing_table_written_once(spark, sf0001, tmp_path):
    land = str(tmp_path / "raw")
    feat = order_features(spark, sf0001)
    first = ingest(feat, ORDER_ROLES, ORDER_RATIOS, test_size=0.2, land_dir=land)
    # a second run with other input still reads the landed table
    second = ingest(feat.limit(10), ORDER_ROLES, ORDER_RATIOS, test_size=0.2, land_dir=land)
    assert first.test.count() == second.test.count() == 300


def test_trained_folder_scores_with_every_model(spark, sf0001, tmp_path):
    from lathe.plans.flows import score_models, train_models

    ing = ingest(order_features(spark, sf0001), ORDER_ROLES, ORDER_RATIOS, test_size=0.2)
    store, mdir = TrackingStore(spark, str(tmp_path / "track")), str(tmp_path / "models")
    train_models(
        ing.train, ing.prep.feature_names, "o_totalprice", "o_orderkey", store=store, model_dir=mdir,
        grid={"n_estimators": [2], "max_features": [2], "bootstrap": [True]}, max_depth=2, forest={"n_estimators": 2},
    )
    ing.test.write.parquet(str(tmp_path / "test"))
    # signatures and the CV table beside the models are no models
    for folder, names in ((mdir, {"Linear_Regression", "Decision_tree", "Random_Forest_untuned", "model"}), (f"{mdir}/runs", None)):
        out = score_models(spark, folder, str(tmp_path / "test"), f"{folder}-preds", "o_orderkey", "o_totalprice")
        counts = {r["model"]: r["count"] for r in out.groupBy("model").count().collect()}
        assert set(counts.values()) == {300}
        assert set(counts) == names if names else len(counts) == 3
    # the best run of the search keeps its model under its own id
    best = store.read("runs").where("run_name like 'Random_Forest_%' and run_name <> 'Random_Forest_untuned'").first()["run_id"]
    out = score_models(spark, f"{mdir}/best", str(tmp_path / "test"), str(tmp_path / "best-preds"), "o_orderkey")
    assert {r["model"] for r in out.select("model").distinct().collect()} == {best}
    # a table without a column of the signature is refused before it is scored
    ing.test.drop("n_lines").write.parquet(str(tmp_path / "narrow"))
    with pytest.raises(ValueError, match="signature"):
        score_models(spark, f"{mdir}/runs", str(tmp_path / "narrow"), str(tmp_path / "none"), "o_orderkey")
