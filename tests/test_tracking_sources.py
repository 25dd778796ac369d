import os

from pyspark.sql import functions as F

from lathe.operators.profile import check_signature, column_profile, dataset_profile, signature
from lathe.sources.files import land_once, read_csv, write_predictions
from lathe.tracking import TrackingStore, cv_run_records, run_tree, runs_per_parent


def test_store_experiment_upsert_and_run_tree(spark, tmp_path):
    store = TrackingStore(spark, str(tmp_path / "track"))
    e1 = store.experiment("exp A")
    assert store.experiment("exp A") == e1
    assert store.read("experiments").count() == 1
    with store.start_run("Parent run", e1) as parent:
        with store.start_run("child", e1, parent) as child:
            store.log_params(child, {"lists": ["a", "b"], "n": 3})
            store.log_metrics(child, {"mae": 1.5})
            store.set_tags(child, {"best": True})
    runs = store.read("runs")
    tree = {r["run_name"]: r["parent_run_name"] for r in run_tree(runs).collect()}
    assert tree == {"Parent run": None, "child": "Parent run"}
    assert runs_per_parent(runs).collect()[0]["n_children"] == 1
    params = {r["key"]: r["value"] for r in store.read("params").collect()}
    assert params == {"lists": '["a", "b"]', "n": "3"}
    assert store.read("metrics").collect()[0]["value"] == 1.5


def test_log_input_profile(spark, tmp_path):
    store = TrackingStore(spark, str(tmp_path / "track"))
    df = spark.createDataFrame([(1, 2.0, "x"), (2, None, "y")], "k long, v double, s string")
    with store.start_run("r", store.experiment("e")) as run:
        ds = store.log_input(run, df, "train", "training", "v")
    rec = store.read("datasets").collect()[0]
    assert rec["dataset_id"] == ds and rec["num_rows"] == 2 and rec["num_elements"] == 6
    assert store.read("inputs").collect()[0]["context"] == "training"


def test_digest_is_order_free(spark):
    df = spark.createDataFrame([(i, float(i) / 3, str(i)) for i in range(50)], "k long, v double, s string")
    a = dataset_profile(df.repartition(1)).collect()[0]["digest"]
    b = dataset_profile(df.orderBy(F.desc("k")).repartition(7)).collect()[0]["digest"]
    c = dataset_profile(df.filter("k > 0")).collect()[0]["digest"]
    assert a == b and a != c


def test_column_profile_and_signature(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None)], "k long, v double")
    prof = {r["column_name"]: r for r in column_profile(df).collect()}
    assert prof["v"]["has_missing"] and not prof["k"]["has_missing"]
    sig = [(r["column_name"], r["data_type"], r["required"]) for r in signature(df).orderBy("position").collect()]
    assert sig == [("k", "bigint", True), ("v", "double", False)]
    check_signature([("k", "bigint")], df)
    try:
        check_signature([("k", "string")], df)
        raise AssertionError("expected a mismatch")
    except ValueError:
        pass


def test_cv_run_records_best_only(spark):
    cv = spark.createDataFrame(
        [(0, -5.0, 1.0, 2, '{"a": 1}'), (1, -3.0, 0.5, 1, '{"a": 2}')],
        "candidate_id long, mean_test_score double, std_test_score double, rank_test_score long, params string",
    )
    rec = cv_run_records(cv, "e1", "Model", 5, log_best_only=True, tags={"t": "v"}, now_ms=0)
    runs = rec["runs"].collect()
    assert [r["run_name"] for r in runs] == ["Model_1"]
    params = {r["key"]: r["value"] for r in rec["params"].collect()}
    assert params == {"folds": "5", "a": "2"}
    metrics = {r["key"]: r["value"] for r in rec["metrics"].collect()}
    assert metrics == {"mean_test_score": -3.0, "std_test_score": 0.5}
    assert {r["key"] for r in rec["tags"].collect()} == {"t", "best_run"}


def test_csv_blank_and_nan_are_missing(spark, tmp_path):
    p = tmp_path / "h.csv"
    p.write_text("a,b,c\n1.5,,x\nNaN,2,y\n")
    df = read_csv(spark, str(p), "a double, b double, c string")
    rows = df.collect()
    assert rows[0]["b"] is None and rows[1]["a"] is None and rows[1]["b"] == 2.0


def test_land_once_keeps_first(spark, tmp_path):
    path = str(tmp_path / "landing")
    land_once(spark.range(3), path)
    assert land_once(spark.range(10), path).count() == 3


def test_write_predictions_partitioned(spark, tmp_path):
    df = spark.createDataFrame([("m1", 1, 0.5), ("m2", 1, 0.7)], "model string, k long, prediction double")
    path = str(tmp_path / "preds")
    write_predictions(df, path)
    assert sorted(d for d in os.listdir(path) if d.startswith("model=")) == ["model=m1", "model=m2"]


def test_bulk_experiment_upsert(spark, tmp_path):
    store = TrackingStore(spark, str(tmp_path / "track"))
    first = store.experiment("a")
    names = spark.createDataFrame([("a",), ("b",), ("b",)], "name string")
    out = {r["name"]: r["experiment_id"] for r in store.upsert_experiments(names).collect()}
    assert out["a"] == first and set(out) == {"a", "b"}
    assert store.upsert_experiments(names).count() == 2


def test_roles_from_schema(spark):
    from lathe.roles import numeric_by_schema, roles_from_schema

    df = spark.createDataFrame([(1, 2.0, 3, "a", 4.0)], "k long, x double, n long, cat string, y double")
    r = roles_from_schema(df, key="k", label="y", categorical=["cat"])
    assert r.numeric == ("x", "n") and r.categorical == ("cat",)
    assert r.passthrough(df) == ["k", "y"]
    assert numeric_by_schema(df, exclude=["k", "y"]) == ["x", "n"]


def test_compact_keeps_rows(spark, tmp_path):
    store = TrackingStore(spark, str(tmp_path / "track"))
    eid = store.experiment("e")
    with store.start_run("r", eid) as run:
        for i in range(5):
            store.log_metrics(run, {"m": float(i)}, step=i)
    before = sorted((r["step"], r["value"]) for r in store.read("metrics").collect())
    store.compact("metrics")
    after = sorted((r["step"], r["value"]) for r in store.read("metrics").collect())
    assert before == after and len(after) == 5
    # the new generation is one file; those that it covers stay for readers who have them open
    _, now = store._generation("metrics")
    assert len(store._files(now["folder"])) == 1 and len(store._files(store.path("metrics"))) == len(now["covers"]) > 1


def test_two_searches_of_a_model_get_their_own_runs(spark):
    cv = spark.createDataFrame([(0, "{}", -1.0, 0.1, 1)], "candidate_id long, params string, mean_test_score double, std_test_score double, rank_test_score long")
    ids = {cv_run_records(cv, "e", "m", 5, search_id=s)["runs"].first()["run_id"] for s in (None, "a", "b")}
    assert len(ids) == 3


def test_digest_of_odd_numbers(spark):
    """NaN, infinities and very large values have a digest; rows that differ have different ones."""
    from lathe.operators.profile import dataset_profile

    def digest(rows, schema):
        return dataset_profile(spark.createDataFrame(rows, schema)).first().digest

    odd = [float("nan"), float("inf"), float("-inf"), 9.3e12, 1e300, 1.0000000000000002e300, -1e300, 2.0**53, 2.0**53 + 2, 2.0**93, 2.0**133 * 1.5, 0.0, 5e-324, 8796093022208.0, 8796093022208.002, None]
    got = [digest([(x,)], "x double") for x in odd]
    # 5e-324 is no millionth: it is told from nothing but 0
    assert len(set(got)) == len(odd) - 1 and got[odd.index(0.0)] == got[odd.index(5e-324)]
    pairs = [("a|b", "c"), ("a", "b|c"), (None, "x"), ("-;", "x"), ("", "x"), ("x", None), ("1:a", "b"), ("1", ":ab")]
    assert len({digest([p], "a string, b string") for p in pairs}) == len(pairs)


def test_runs_without_an_end_and_generations(spark, tmp_path):
    store = TrackingStore(spark, str(tmp_path / "t"))
    exp = store.experiment("e")
    a, b = store.begin_run("a", exp), store.begin_run("b", exp)
    before = store.read("runs")  # a reader from before the compaction
    store.compact("runs", 1)
    store.end_run(a)
    c = store.begin_run("c", exp, b)
    state = {r.run_name: (r.status, r.end_time is None) for r in store.read("runs").collect()}
    assert state == {"a": ("FINISHED", False), "b": ("RUNNING", True), "c": ("RUNNING", True)}
    assert before.count() == 2 and store.log("runs").count() == 4
    store.compact("runs", 2)
    store.end_run(c, "FAILED")
    assert {r.run_name: r.status for r in store.read("runs").collect()} == {"a": "FINISHED", "b": "RUNNING", "c": "FAILED"}
    assert store.log("runs").count() == 5 and before.count() == 2


def test_types_from_all_files(spark, tmp_path):
    from lathe.sources.files import infer_schema, read_csv

    path = tmp_path / "csv"
    path.mkdir()
    (path / "a.csv").write_text('i,d,s,b,e,q,n\n1,1,x,true,,"a,b",1\n2,2,y,FALSE,,"c ""d""",\n')
    (path / "b.csv").write_text("i,d,s,b,e,q,n\n-3,2.5,7,false,,z,NaN\n")
    assert [(f.name, f.dataType.simpleString()) for f in infer_schema(spark, str(path))] == [("i", "bigint"), ("d", "double"), ("s", "string"), ("b", "boolean"), ("e", "string"), ("q", "string"), ("n", "double")]
    rows = {r.i: (r.d, r.s, r.b, r.q, r.n) for r in read_csv(spark, str(path)).collect()}
    assert rows == {1: (1.0, "x", True, "a,b", 1.0), 2: (2.0, "y", False, 'c "d"', None), -3: (2.5, "7", False, "z", None)}


def test_rows_set_apart_by_signature(spark):
    from lathe.operators.profile import set_apart, signature_violations

    df = spark.createDataFrame([("1", 1.0, "a"), ("x", 2.0, "b"), (None, None, "c"), ("3", float("nan"), None)], "a string, b double, c string")
    expected = [("a", "bigint", False), ("b", "double", True), ("c", "string", False), ("d", "double", True)]
    assert {(r.column_name, r.rule): r.n_rows for r in signature_violations(expected, df).collect()} == {("a", "type"): 1, ("b", "required"): 2, ("d", "missing"): 4}
    good, bad = set_apart(expected[:3], df)
    assert [tuple(r) for r in good.collect()] == [(1, 1.0, "a")]
    assert sorted(r.violations for r in bad.collect()) == [["a:type"], ["b:required"], ["b:required"]]


def test_draws_from_distributions():
    from lathe.operators.search import sample_distributions

    space = {"a": ("uniform", 2.0, 3.0), "b": ("loguniform", 1e-4, 1.0), "c": ("int", 1, 3), "d": ("choice", ["x", "y"])}
    got = sample_distributions(space, 2000, 7)
    assert got[:5] == sample_distributions(space, 5, 7) and got != sample_distributions(space, 2000, 8)
    assert all(2 <= g["a"] < 3 and 1e-4 <= g["b"] < 1 for g in got)
    assert {g["c"] for g in got} == {1, 2, 3} and {g["d"] for g in got} == {"x", "y"}
    assert abs(sum(g["b"] < 1e-2 for g in got) / 2000 - 0.5) < 0.05  # half of the logarithms
