"""Trees and forests: against a plain recursion, whatever the layout, and above the size of a task."""

import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lathe.operators import forest as forest_module
from lathe.operators.forest import Forest, cross_validated, cut_points, fit_forest, lay_out, tree
from lathe.operators.prep import PrepSpec
from lathe.operators.search import grid_search, param_grid
from lathe.operators.split import hash_folds
from lathe.operators.tree_growth import Orders, bag_weights, child_hash, grow, mix32, tree_hash
from lathe.sources.models import load_model, save_model

COLS = ["a", "b", "c"]


def plain_tree(x, y, w, m, root, depth=None, least=1):
    """One node at a time, every split tried; exact sums, as labels are whole numbers."""

    def node(rows, h, level):
        weight, total = w[rows].sum(), (w * y)[rows].sum()
        if len(set(y[rows])) == 1 or level == depth:
            return total / weight
        differ = [f for f in range(len(x)) if len(set(x[f][rows])) > 1]
        lots = {f: int(mix32(np.uint64(h) ^ mix32(np.uint64(f + 1)))) for f in differ}
        best = None
        for f in sorted(sorted(differ, key=lots.get)[:m]):
            values = sorted(set(x[f][rows]))
            for a, b in zip(values[:-1], values[1:], strict=True):
                left = rows[x[f][rows] <= a]
                wl, sl = w[left].sum(), (w * y)[left].sum()
                if wl >= least and weight - wl >= least:
                    gain = sl * sl / wl + (total - sl) * (total - sl) / (weight - wl)
                    if best is None or gain > best[0]:
                        best = (gain, f, a, a + (b - a) * 0.5)
        if best is None:
            return total / weight
        _, f, a, cut = best
        left = x[f][rows] <= a
        return f, cut, node(rows[left], int(child_hash(h, 0)), level + 1), node(rows[~left], int(child_hash(h, 1)), level + 1)

    return node(np.flatnonzero(w > 0), root, 0)


def nested(t, k=0):
    if t.feature[k] < 0:
        return t.value[k]
    return int(t.feature[k]), t.value[k], nested(t, t.left[k]), nested(t, t.left[k] + 1)


@pytest.mark.parametrize("trial", range(24))
def test_growth_equals_plain_recursion(trial):
    rng = np.random.default_rng(trial)
    n, p = int(rng.integers(1, 120)), int(rng.integers(1, 5))
    x, y = rng.integers(0, rng.integers(2, 40), (p, n)).astype(float), rng.integers(0, rng.integers(2, 50), n).astype(float)
    w = bag_weights(rng.integers(0, 2**32, n), 7) if trial % 2 else np.ones(n)
    m, depth, least = int(rng.integers(1, p + 1)), None if trial % 3 else 3, 1 if trial % 4 else 3
    if (w > 0).any():
        assert nested(grow(Orders(x), y, w, m, 12345, depth, least)) == plain_tree(x, y, w, m, 12345, depth, least)


def test_no_depth_limit():
    # every split takes one row off: a tree as deep as the table is long
    n = 200
    x, y = np.arange(n, dtype=float)[None], 10.0 ** np.arange(n, 0, -1)
    y = np.array([4.0**k for k in range(24)])
    x = np.arange(24, dtype=float)[None]
    t = grow(Orders(x), y, np.ones(24), 1, 1)
    assert (t.predict(x) == y).all() and len(t.feature) == 47


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    n = 2500
    t = pd.DataFrame({"k": np.arange(n), "a": rng.integers(0, 50, n).astype(float), "b": rng.normal(size=n), "c": rng.integers(0, 3, n).astype(float)})
    t["y"] = np.round(100 * np.sin(t.b) + t.a * 3 + rng.normal(size=n) * 20)
    return t, spark.createDataFrame(t)


def predictions(model, df, **kw):
    return model.transform(df, **kw).orderBy("k").toPandas().prediction.to_numpy()


def key_hashes(t):
    return np.array([int(hashlib.md5(f"{k}#0".encode()).hexdigest()[:8], 16) for k in t.k], np.uint32)


def test_forest_equals_its_trees_by_numpy(spark, data, tmp_path):
    t, df = data
    x, kh = np.stack([t[c].to_numpy() for c in COLS]), key_hashes(t)
    model = fit_forest(df.repartition(3), COLS, "y", "k", Forest(3, 2, True, seed=7))
    orders = Orders(x)
    want = np.mean([grow(orders, t.y.to_numpy(), bag_weights(kh, tree_hash(7, k)), 2, tree_hash(7, k)).predict(x) for k in range(3)], axis=0)
    assert np.array_equal(predictions(model, df), want)
    assert np.array_equal(predictions(model, df, model_bytes=0), want)
    save_model(spark, model, str(tmp_path / "m"))
    assert np.array_equal(predictions(load_model(spark, str(tmp_path / "m")), df), want)


def test_tables_above_a_task(data):
    t, df = data
    spec = Forest(2, 2, True, seed=7)
    models = [fit_forest(df.repartition(n), COLS, "y", "k", spec, cells=1200) for n in (2, 5)]
    assert all(len(top.feature) > 3 for top in models[0].tops)
    got = [predictions(m, df) for m in models]
    assert np.array_equal(*got) and np.array_equal(predictions(models[0], df, model_bytes=0), got[0])
    whole = predictions(fit_forest(df, COLS, "y", "k", spec), df)
    # cuts of the upper levels lie at bin borders; the fit is as close
    assert np.mean((got[0] - t.y) ** 2) == pytest.approx(np.mean((whole - t.y) ** 2), rel=0.1)


def test_few_values_give_the_same_splits_above_a_task(spark):
    rng = np.random.default_rng(3)
    n = 3000
    t = pd.DataFrame({"k": np.arange(n), "a": rng.integers(0, 12, n).astype(float), "b": rng.integers(0, 9, n).astype(float), "c": rng.integers(-2, 3, n).astype(float)})
    t["y"] = np.round(t.a * t.b * 10 + t.c**2 + rng.normal(size=n) * 5)
    df = spark.createDataFrame(t)
    for spec in (tree(1), Forest(2, 1, False, max_depth=6, seed=5)):
        # bins hold one value each, so that the upper levels' splits are the exact ones
        assert np.array_equal(predictions(fit_forest(df, COLS, "y", "k", spec), df), predictions(fit_forest(df, COLS, "y", "k", spec, cells=1500), df))


def test_a_node_inside_one_bin_is_still_split(spark, monkeypatch):
    monkeypatch.setattr(forest_module, "BINS", 4)
    n = 1200
    t = pd.DataFrame({"k": np.arange(n), "a": 1e6 + np.arange(n) * 1e-3, "b": np.zeros(n), "c": np.where(np.arange(n) < 1190, 5.0, 7.0)})
    t["y"] = np.floor(np.arange(n) / 7)
    df = spark.createDataFrame(t)
    model = fit_forest(df, COLS, "y", "k", tree(), cells=60)
    assert np.array_equal(predictions(model, df), t.y.to_numpy())


def test_equal_rows_with_different_labels_end_in_a_leaf(spark):
    t = pd.DataFrame({"k": np.arange(400), "a": np.ones(400), "b": np.ones(400), "c": np.repeat([0.0, 1.0], 200), "y": np.arange(400) % 2.0})
    df = spark.createDataFrame(t)
    for cells in (forest_module.CELLS, 90):
        assert np.array_equal(predictions(fit_forest(df, COLS, "y", "k", tree(), cells=cells), df), np.full(400, 0.5))


def test_cut_points_split_evenly(spark):
    rng = np.random.default_rng(2)
    cols = np.stack([rng.normal(size=4000), np.exp(rng.normal(size=4000) * 30), rng.integers(0, 5, 4000) - 2.0])
    df = spark.createDataFrame(pd.DataFrame(cols.T, columns=COLS)).withColumn("y", F.lit(1.0)).withColumn("k", F.lit(1))
    laid = lay_out(df.repartition(3), COLS, "y", "k")
    cuts = cut_points(laid.table, 4000, 3)
    for v, own in zip(cols[:2], cuts[:2], strict=True):
        share = np.bincount(np.searchsorted(own, v, "left"))
        assert len(own) > 100 and share.max() < 2.5 * 4000 / forest_module.BINS
    assert cuts[2].tolist() == [-2.0, -1.0, 0.0, 1.0, 2.0]


@pytest.mark.parametrize("cells", [forest_module.CELLS, 1500])
def test_search_equals_separate_fits(spark, data, cells):
    folded = hash_folds(data[1], "k", 3, 42)
    candidates = [Forest(n, m, b, seed=7) for b in (True, False) for m in (1, 2) for n in (1, 3)]
    got = {(r.candidate, r.fold, r.test): r for r in cross_validated(lay_out(folded, COLS, "y", "k", "fold", cells), candidates, [0, 1, 2]).collect()}
    assert len(got) == len(candidates) * 3 * 2
    if cells < forest_module.CELLS:
        return  # the fit on a part has cut points of its own there
    for c in (1, 6):
        model = fit_forest(folded.where("fold <> 1"), COLS, "y", "k", candidates[c])
        off = F.col("y") - F.col("prediction")
        sums = model.transform(folded).groupBy((F.col("fold") == 1).alias("test")).agg(F.count("*").alias("n"), F.sum(off * off).alias("sse"), F.sum(F.abs(off)).alias("sae"))
        for r in sums.collect():
            s = got[c, 1, r.test]
            assert (s.n, s.sse, s.sae) == (r.n, pytest.approx(r.sse, rel=1e-9), pytest.approx(r.sae, rel=1e-9))


@pytest.mark.parametrize("scoring", ["neg_mean_squared_error", "neg_root_mean_squared_error", "neg_mean_absolute_error", "r2"])
def test_search_scores(spark, data, scoring):
    folded = hash_folds(data[1], "k", 3, 42)
    res = grid_search(Forest(2, bootstrap=False, seed=1), param_grid({"max_features": [1, 3]}), folded, COLS, "y", scoring=scoring, key="k", refit=False)
    best = res.scores.where(f"candidate_id = {res.best_index} and split = 'test' and fold = 0").first().score
    model = fit_forest(folded.where("fold <> 0"), COLS, "y", "k", Forest(2, res.best_params["max_features"], False, seed=1))
    t = model.transform(folded.where("fold = 0")).toPandas()
    off = t.y - t.prediction
    want = {"neg_mean_squared_error": -(off**2).mean(), "neg_root_mean_squared_error": -np.sqrt((off**2).mean()), "neg_mean_absolute_error": -off.abs().mean(), "r2": 1 - (off**2).sum() / ((t.y - t.y.mean()) ** 2).sum()}
    assert best == pytest.approx(want[scoring], rel=1e-9)


def test_search_with_preparation_by_fold(spark, data):
    folded = hash_folds(data[1].withColumn("c", F.when(F.col("k") % 3 > 0, F.col("c"))).withColumn("d", F.concat(F.lit("d"), F.col("k") % 4)), "k", 3, 42)
    spec = PrepSpec(("a", "b", "c"), ("d",))
    res = grid_search(Forest(2, bootstrap=False, seed=1), param_grid({"max_features": [2]}), folded, [], "y", key="k", prep=spec)
    for f, own in spec.fit_without(folded, "fold", [0, 1, 2]).items():
        alone = spec.fit(folded.where(f"fold <> {f}"))
        assert own.imputation.values == alone.imputation.values and own.onehot == alone.onehot
        assert [*own.scaling.mean.values(), *own.scaling.std.values()] == pytest.approx([*alone.scaling.mean.values(), *alone.scaling.std.values()], rel=1e-9)
        model = fit_forest(own.apply(folded.where(f"fold <> {f}")), own.feature_names, "y", "k", Forest(2, 2, False, seed=1))
        t = model.transform(own.apply(folded.where(f"fold = {f}"))).toPandas()
        assert res.scores.where(f"fold = {f} and split = 'test'").first().score == pytest.approx(-((t.y - t.prediction) ** 2).mean(), rel=1e-6)
    assert res.best_model.transform(res.prep.apply(folded)).count() == folded.count()


def test_missing_features_are_an_error(spark):
    df = spark.createDataFrame([(1, 1.0, None, 2.0), (2, 1.0, 3.0, 2.0)], "k long, a double, b double, y double")
    with pytest.raises(Exception, match="impute"):
        fit_forest(df, ["a", "b"], "y", "k", tree())


def test_subtrees_are_copied_by_the_rows_that_reach_them(spark):
    """Each subtree went to 64 tasks, however few rows reached it (F1, F2, F3, F6, F10, F11, F12)."""
    rng = np.random.default_rng(5)
    n = 3000
    rows = [(k, *map(float, rng.integers(0, 500, 3)), float(rng.integers(0, 900))) for k in range(n)]
    df = spark.createDataFrame(rows, ["k", *COLS, "y"]).repartition(3)
    model = fit_forest(df, COLS, "y", "k", Forest(2, 2, True), cells=1500)
    table = df.select(F.monotonically_increasing_id().alias("_row"), *COLS)
    units = model.subtrees.count()
    assert set(model.copies(table).values()) == {1}
    # a hot subtree still goes to several tasks; all copies hold no more bytes than the model and the dealt rows
    some = model.copies(table, 1000)
    nodes = {(r["tree"], r["unit"]): 20 * r["nodes"] for r in model.subtrees.collect()}
    assert max(some.values()) > 1 and len(some) <= units
    assert sum(c * nodes[k] for k, c in some.items()) <= sum(nodes.values()) + 2 * n * 36
    want = [r["prediction"] for r in model._by_broadcast(df, "prediction").orderBy("k").collect()]
    for share in (1000, 32 << 20):
        assert [r["prediction"] for r in model._by_subtree(df, "prediction", share).orderBy("k").collect()] == want


def test_few_features_count_a_row_for_more(spark):
    """With one feature a task took as many rows as values fit it, with a score of arrays each (F13, F14); closed leaves' rows were dealt to be thrown away."""
    n = 2000
    df = spark.createDataFrame([(k, float(k % 4), float(k % 4 + k % 3)) for k in range(n)], "k long, a double, y double")
    laid = lay_out(df, ["a"], "y", "k", None, n)
    model = fit_forest(df, ["a"], "y", "k", Forest(2, None, False), cells=n)
    assert len(laid.quantiles) == 1 and all(len(top.feature) == 7 for top in model.tops)
    assert {r["nodes"] for r in model.subtrees.collect()} == {1}
    tops = model.tops
    units = [forest_module.Unit((t,), k, 0.0) for t in range(2) for k, f in enumerate(tops[t].feature) if f < 0]
    specs = forest_module.tree_specs(Forest(2, None, False), 1)
    assert not laid.table.mapInArrow(forest_module._deal(units, tops, 1, specs), forest_module._PART).count()
    assert set(np.round(predictions(model, df) - np.arange(n) % 4, 1)) == {1.0}


def test_constant_label_above_a_task(spark):
    df = spark.createDataFrame([(k, float(k % 50), 7.0) for k in range(600)], "k long, a double, y double")
    model = fit_forest(df, ["a"], "y", "k", Forest(2, None, True), cells=100)
    assert set(predictions(model, df)) == {7.0} and [r["nodes"] for r in model.subtrees.collect()] == [1, 1]


@pytest.mark.parametrize("listed", [forest_module.LISTED, 40])
def test_size_changes_no_split(spark, monkeypatch, listed):
    """Nodes above a task's share were split at borders of bins, so that predictions hung on ``cells`` (F8, F9)."""
    monkeypatch.setattr(forest_module, "LISTED", listed)  # few: stretches are first parted by finer bins
    rng = np.random.default_rng(11)
    n = 2400
    a, b, d = rng.normal(size=n) - 1, np.exp(rng.normal(size=n) * 20), np.round(rng.normal(size=n) * 9) * 1e-3
    t = pd.DataFrame({"k": np.arange(n), "a": a, "b": b, "c": rng.integers(0, 300, n).astype(float), "d": d, "e": np.where(np.arange(n) < 9, 1.0, 0.0)})
    t["y"] = np.round(60 * np.sin(3 * a) + 8 * np.log(b) + rng.normal(size=n) * 30)
    df = spark.createDataFrame(t).repartition(3)
    cols = ["e", "a", "b", "c", "d"]
    for spec in (tree(1), Forest(2, 2, True, seed=3), Forest(2, 1, False, max_depth=5, min_leaf=4, seed=5)):
        small, whole = (fit_forest(df, cols, "y", "k", spec, cells=c) for c in (3000, forest_module.CELLS))
        assert len(small.tops[0].feature) > 3 and len(whole.tops[0].feature) == 1
        assert np.array_equal(predictions(small, df), predictions(whole, df))
