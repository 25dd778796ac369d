"""Hyper-parameter search and cross-validation results.

* ``param_grid``: every combination, keys in sorted order, the last key
  varying fastest (the usual grid order); ``candidates_frame`` puts it in a
  DataFrame with a ``candidate_id``.
* ``sample_candidates``: random search as a seeded hash sample of the grid;
  ``sample_distributions``: candidates drawn from distributions.
* ``grid_search`` of a ``Forest``: the trees of all candidates and folds grow
  together over one packed table, a fold being a weight of 0 (``forest``); the
  scans don't depend on the number of candidates. Test and train errors come
  from the tasks that grew the trees; the best candidate is refit on all rows.
* ``grid_search`` of an MLlib regressor: each candidate x fold is one fit on
  the other folds plus one scoring pass that yields test and train error
  together; fits run in a thread pool (``parallelism``) over a persisted,
  assembled table.
* ``group_mean_cv``: cross-validation of a group-mean regressor in closed
  form from one ``groupBy(group, fold)`` of count, sum and sum of squares.
* ``summarize_cv``: fold scores -> mean, population std and rank per
  candidate (ties share the lowest rank); ``best_candidate`` takes rank 1,
  first candidate on ties.

Scores follow the "greater is better" convention: ``neg_mean_squared_error``
is -MSE, ``neg_mean_absolute_error`` is -MAE, ``r2`` is R^2.
"""

from __future__ import annotations

import itertools
import json
import math
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Estimator
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lathe.operators.metrics import r2_of
from lathe.functions.hashing import key_hash
from lathe.operators.forest import Forest, cross_validated, fit_laid_out, lay_out
from lathe.operators.learners import deterministic_layout, layout_partitions
from lathe.operators.prep import PrepSpec

SCORINGS = {
    "neg_mean_squared_error": ("mse", -1.0),
    "neg_root_mean_squared_error": ("rmse", -1.0),
    "neg_mean_absolute_error": ("mae", -1.0),
    "r2": ("r2", 1.0),
}

#: Folds with a preparation of their own that are grown at a time: jobs waiting for cores, their tasks are no larger.
FOLDS_AT_ONCE = 8


def param_grid(grid: dict[str, list]) -> list[dict]:
    keys = sorted(grid)
    return [dict(zip(keys, combo)) for combo in itertools.product(*[grid[k] for k in keys])]


def candidates_frame(spark: SparkSession, cands: list[dict]) -> DataFrame:
    rows = [(i, json.dumps(c, sort_keys=True)) for i, c in enumerate(cands)]
    return spark.createDataFrame(rows, "candidate_id long, params string")


def sample_candidates(cands: list[dict], n_iter: int, seed: int = 42) -> list[tuple[int, dict]]:
    """Seeded sample without replacement: the n_iter smallest md5(id#seed)."""
    import hashlib

    order = sorted(range(len(cands)), key=lambda i: hashlib.md5(f"{i}#{seed}".encode()).hexdigest())
    return [(i, cands[i]) for i in sorted(order[:n_iter])]


def sample_distributions(space: dict[str, tuple], n_iter: int, seed: int = 42) -> list[dict]:
    """``n_iter`` candidates drawn from distributions, each parameter by the inverse CDF of a hashed (candidate, parameter).

    ``("uniform", a, b)``, ``("loguniform", a, b)``, ``("int", a, b)`` (both ends
    included) or ``("choice", [...])``.
    """
    import hashlib

    def draw(u: float, kind: str, *args):
        if kind == "choice":
            return args[0][int(u * len(args[0]))]
        a, b = args
        if kind == "int":
            return a + int(u * (b - a + 1))
        if kind == "uniform":
            return a + u * (b - a)
        if kind == "loguniform":
            return math.exp(math.log(a) + u * (math.log(b) - math.log(a)))
        raise ValueError(f"unknown distribution {kind!r}")

    def unit(i: int, name: str) -> float:
        return int(hashlib.md5(f"{i}#{name}#{seed}".encode()).hexdigest()[:13], 16) / float(1 << 52)

    return [{name: draw(unit(i, name), *space[name]) for name in sorted(space)} for i in range(n_iter)]


def sample_candidates_frame(cands_df: DataFrame, n_iter: int, seed: int = 42) -> DataFrame:
    """The same sample as a DataFrame operation (top n by key hash, no global sort)."""
    h = key_hash("candidate_id", seed)
    return cands_df.withColumn("_h", h).orderBy("_h").limit(n_iter).drop("_h")


def _score_expr(scoring: str, label: str, pred: str = "prediction"):
    metric, sign = SCORINGS[scoring]
    y = F.col(label).cast("double")
    e = y - F.col(pred)
    if metric == "mse":
        return F.lit(sign) * F.avg(e * e)
    if metric == "rmse":
        return F.lit(sign) * F.sqrt(F.avg(e * e))
    if metric == "mae":
        return F.lit(sign) * F.avg(F.abs(e))
    return r2_of(F.sum(e * e), F.var_pop(F.when(e.isNotNull(), y)), F.count(e))


@dataclass
class SearchResult:
    scores: DataFrame  # candidate_id, fold, split, score
    cv_results: DataFrame
    best_index: int
    best_params: dict
    best_score: float
    best_model: object | None
    folds: int
    prep: object | None = None  # with preparation by fold: the one fitted on all rows, which the best model expects


def summarize_cv(scores: DataFrame, cands_df: DataFrame | None = None) -> DataFrame:
    """mean/std (population) per candidate and split, rank by mean test score."""
    agg = scores.groupBy("candidate_id").agg(
        F.avg(F.when(F.col("split") == "test", F.col("score"))).alias("mean_test_score"),
        F.stddev_pop(F.when(F.col("split") == "test", F.col("score"))).alias("std_test_score"),
        F.avg(F.when(F.col("split") == "train", F.col("score"))).alias("mean_train_score"),
        F.stddev_pop(F.when(F.col("split") == "train", F.col("score"))).alias("std_train_score"),
    )
    # the candidate table is small (one row per candidate): a global window is fine here
    ranked = agg.withColumn("rank_test_score", F.rank().over(Window.orderBy(F.desc("mean_test_score"))).cast("long"))
    if cands_df is not None:
        ranked = ranked.join(cands_df, "candidate_id", "left")
    return ranked


def best_candidate(cv_results: DataFrame) -> DataFrame:
    return cv_results.orderBy("rank_test_score", "candidate_id").limit(1)


def _score_of(scoring: str, r) -> float:
    """The score from sums of errors, as ``_score_expr`` has it from rows."""
    metric, sign = SCORINGS[scoring]
    if metric == "r2":
        sst = r["syy"] - r["sy"] * r["sy"] / r["n"]
        return 1.0 - r["sse"] / sst if sst > 0 else float(r["sse"] == 0)
    mean = r["sae"] / r["n"] if metric == "mae" else r["sse"] / r["n"]
    return sign * (math.sqrt(mean) if metric == "rmse" else mean)


def _forest_search(estimator: Forest, cands, df, features, label, fold_col, scoring, return_train_score, refit, key, prep: PrepSpec | None) -> SearchResult:
    if key is None:
        raise ValueError("a forest's rows are named by a key")
    spark, features = df.sparkSession, list(features)
    indexed = [c if isinstance(c, tuple) else (i, c) for i, c in enumerate(cands)]
    folds = sorted(r[0] for r in df.select(fold_col).distinct().collect())
    forests = [estimator.with_params(p) for _, p in indexed]
    # sums: a row per candidate, fold and side
    fitted = None
    if prep is None:
        laid = lay_out(df, features, label, key, fold_col)
        sums = cross_validated(laid, forests, folds).collect()
    else:
        # a fold's passes are many and short: those of several folds fill each other's gaps
        def without(f: int, own) -> list:
            return cross_validated(lay_out(own.apply(df), own.feature_names, label, key, fold_col), forests, [f]).collect()

        with ThreadPoolExecutor(max_workers=FOLDS_AT_ONCE) as pool:
            sums = [r for rows in pool.map(without, *zip(*prep.fit_without(df, fold_col, folds).items(), strict=True)) for r in rows]
        if refit:
            fitted = prep.fit(df)
            features = fitted.feature_names
            laid = lay_out(fitted.apply(df), features, label, key, fold_col)
    results = [(indexed[r["candidate"]][0], int(r["fold"]), "test" if r["test"] else "train", float(_score_of(scoring, r))) for r in sums if r["test"] or return_train_score]
    scores = spark.createDataFrame(results, "candidate_id long, fold int, split string, score double")
    named = spark.createDataFrame([(cid, json.dumps(p, sort_keys=True)) for cid, p in indexed], "candidate_id long, params string")
    cv = summarize_cv(scores, named)
    best = best_candidate(cv).collect()[0]
    params = dict(indexed)[best["candidate_id"]]
    model = fit_laid_out(laid, estimator.with_params(params), features) if refit else None
    return SearchResult(scores, cv, int(best["candidate_id"]), params, float(best["mean_test_score"]), model, len(folds), fitted)


def grid_search(
    estimator: Estimator | Forest,
    cands: list[dict] | list[tuple[int, dict]],
    df: DataFrame,
    features: list[str],
    label: str,
    fold_col: str = "fold",
    scoring: str = "neg_mean_squared_error",
    parallelism: int = 4,
    return_train_score: bool = True,
    refit: bool = True,
    key: str | None = None,
    apply_params: Callable[[Estimator, dict], Estimator] | None = None,
    prep: PrepSpec | None = None,
) -> SearchResult:
    """With ``prep`` (forests only), ``df`` holds unprepared columns and each fold is prepared by the other folds' statistics."""
    from lathe.operators.learners import with_params

    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import VectorAssembler

    spark = df.sparkSession
    if isinstance(estimator, Forest):
        return _forest_search(estimator, cands, df, features, label, fold_col, scoring, return_train_score, refit, key, prep)
    if prep is not None:
        raise ValueError("preparation by fold is for forests; prepare the table first")
    apply_params = apply_params or with_params
    indexed = [c if isinstance(c, tuple) else (i, c) for i, c in enumerate(cands)]
    # assemble the feature vector once (by name); every fit reads the same rows
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    data = assembler.transform(df.select(*features, label, fold_col, *([key] if key else []))).select(
        "features", label, fold_col, *([key] if key else [])
    )
    fold_counts = {r[0]: r[1] for r in data.groupBy(fold_col).count().collect()}
    folds = sorted(fold_counts)
    if key:
        # one deterministic layout for every fit (fold filters are narrow and keep it)
        data = deterministic_layout(data, key, layout_partitions(sum(fold_counts.values())))
    data = data.persist(StorageLevel.MEMORY_AND_DISK)

    def fit_on(rows: DataFrame, params: dict):
        est = apply_params(estimator, params)
        est.setFeaturesCol("features").setLabelCol(label).setPredictionCol("prediction")
        return est.fit(rows)

    try:

        def run(task):
            cid, params, f = task
            model = fit_on(data.filter(F.col(fold_col) != f), params)
            scored = model.transform(data).withColumn("_test", F.col(fold_col) == f)
            if not return_train_score:
                scored = scored.filter("_test")
            rows = scored.groupBy("_test").agg(_score_expr(scoring, label).alias("score")).collect()
            return [(cid, int(f), "test" if r["_test"] else "train", float(r["score"])) for r in rows]

        tasks = [(cid, p, f) for cid, p in indexed for f in folds]
        with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(tasks)))) as pool:
            results = [row for rows in pool.map(run, tasks) for row in rows]
        scores = spark.createDataFrame(results, "candidate_id long, fold int, split string, score double")
        cands_df = spark.createDataFrame(
            [(cid, json.dumps(p, sort_keys=True)) for cid, p in indexed], "candidate_id long, params string"
        )
        cv = summarize_cv(scores, cands_df)
        best = best_candidate(cv).collect()[0]
        best_params = dict(indexed)[best["candidate_id"]]
        model = PipelineModel(stages=[assembler, fit_on(data, best_params)]) if refit else None
        return SearchResult(scores, cv, int(best["candidate_id"]), best_params, float(best["mean_test_score"]), model, len(folds))
    finally:
        data.unpersist()


# --- closed-form CV of a group-mean regressor -----------------------------------


def group_mean_cv_many(
    df: DataFrame, label: str, groupings: list[list[str]], k: int, fold_col: str = "fold"
) -> DataFrame:
    """Fold scores of "predict the group's training mean" for several groupings.

    One partially aggregated pass computes (n, sum y, sum y^2) per (finest
    group, fold); each candidate rolls that table up to its own grouping.
    A window per group (at most k rows: one per fold) gives the group totals
    and the per-fold stats, so the model of fold m uses group total minus
    fold m, falling back to the training mean of all rows when the group is
    absent from the training folds. The squared error of a block of rows with
    constant prediction p is sum y^2 - 2 p sum y + n p^2. Returns
    (candidate_id, fold, split, score) with score = -MSE.
    """
    y = F.col(label).cast("double")
    cols = list(dict.fromkeys(c for g in groupings for c in g))
    fine = df.groupBy(*cols, F.col(fold_col).alias("_f")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(y).alias("s"), F.sum(y * y).alias("q")
    )
    # training mean of all rows for each model m: (total - fold m), k rows
    per_fold = fine.groupBy("_f").agg(F.sum("n").alias("fn"), F.sum("s").alias("fs"))
    totals = per_fold.agg(F.sum("fn").alias("tn"), F.sum("fs").alias("ts"))
    models = F.sequence(F.lit(0), F.lit(k - 1))
    glob = (
        totals.select("tn", "ts", F.explode(models).alias("_m"))
        .join(per_fold.withColumnRenamed("_f", "_m"), "_m", "left")
        .select(
            "_m",
            F.try_divide(F.col("ts") - F.coalesce("fs", F.lit(0.0)), F.col("tn") - F.coalesce("fn", F.lit(0))).alias("glob"),
        )
    )
    # every candidate in one plan: each finest-grain row is repeated once per
    # candidate, keyed by (candidate, that candidate's group values as text)
    keyed = fine.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(cid).cast("long").alias("candidate_id"),
                        (F.to_json(F.struct(*[F.col(c) for c in g])) if g else F.lit("")).alias("gk"),
                    )
                    for cid, g in enumerate(groupings)
                ]
            )
        ).alias("c"),
        "_f", "n", "s", "q",
    ).select("c.candidate_id", "c.gk", "_f", "n", "s", "q")
    gf = keyed.groupBy("candidate_id", "gk", "_f").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
    w = Window.partitionBy("candidate_id", "gk")  # at most k rows per group
    gf = gf.select(
        "candidate_id", "_f", "n", "s", "q",
        F.sum("n").over(w).alias("gn"),
        F.sum("s").over(w).alias("gs"),
        F.map_from_entries(F.collect_list(F.struct("_f", F.struct("n", "s"))).over(w)).alias("fm"),
    )
    own = F.element_at(F.col("fm"), F.col("_m"))
    left_n = F.col("gn") - F.coalesce(own.getField("n"), F.lit(0))
    left_s = F.col("gs") - F.coalesce(own.getField("s"), F.lit(0.0))
    pred = F.coalesce(F.when(left_n > 0, left_s / left_n), F.col("glob"))
    blocks = (
        gf.select("*", F.explode(models).alias("_m"))
        .join(F.broadcast(glob), "_m")  # k rows
        .select(
            "candidate_id",
            F.col("_m"),
            F.when(F.col("_f") == F.col("_m"), F.lit("test")).otherwise(F.lit("train")).alias("split"),
            F.col("n"),
            (F.col("q") - F.lit(2.0) * pred * F.col("s") + F.col("n") * pred * pred).alias("sse"),
        )
    )
    return blocks.groupBy("candidate_id", F.col("_m").cast("int").alias("fold"), "split").agg(
        (-F.sum("sse") / F.sum("n")).alias("score")
    )


def group_mean_cv(df: DataFrame, label: str, group_by: list[str], k: int = 5, fold_col: str = "fold") -> DataFrame:
    """Single-grouping form: (fold, split, score)."""
    return group_mean_cv_many(df, label, [list(group_by)], k, fold_col).drop("candidate_id")
