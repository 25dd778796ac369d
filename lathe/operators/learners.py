"""Regressors with the reference learners' defaults: MLlib's, and one ``fit_model`` for these and for ``Forest``s.

Trees and forests without a depth cap are in ``forest``; MLlib's end at depth 30
and split at bin borders only.

Features are assembled by name (``VectorAssembler``), never by position, and
the fitted ``PipelineModel`` carries the assembler, so scoring a table with
the columns in any order gives the same predictions.

Tree learners depend on how rows are laid out over partitions (sampling and
binning are per partition). ``fit_model(..., key=...)`` first lays the rows
out by a fixed hash of the key into a fixed number of partitions and sorts
them inside each partition, so the same seed gives the same model however the
input was partitioned.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathe.operators.forest import Forest, ForestModel, fit_forest

MAX_DEPTH = 30  # MLlib's limit; an uncapped tree maps to it


def linear_regression(**kw) -> LinearRegression:
    """Plain least squares: normal-equation solver, no regularisation."""
    return LinearRegression(solver="normal", regParam=0.0, elasticNetParam=0.0, fitIntercept=True, **kw)


def decision_tree(seed: int = 42, max_depth: int | None = None, max_bins: int = 32, min_instances: int = 1) -> DecisionTreeRegressor:
    return DecisionTreeRegressor(
        seed=seed, maxDepth=MAX_DEPTH if max_depth is None else max_depth, maxBins=max_bins, minInstancesPerNode=min_instances
    )


def feature_subset(max_features) -> str:
    """Map a max_features setting to MLlib's featureSubsetStrategy."""
    if isinstance(max_features, bool):
        raise ValueError("max_features must be a number or a strategy name")
    if isinstance(max_features, int):
        # "1" could also be read as the fraction 1.0; a fraction just above 0 is one feature
        return str(max_features) if max_features != 1 else "0.000001"
    if max_features is None or max_features == 1.0:
        return "all"
    if isinstance(max_features, float):
        return repr(max_features)
    return {"sqrt": "sqrt", "log2": "log2"}.get(max_features, max_features)


def random_forest(
    seed: int = 42,
    n_estimators: int = 100,
    max_features=1.0,
    bootstrap: bool = True,
    max_depth: int | None = None,
    max_bins: int = 32,
) -> RandomForestRegressor:
    return RandomForestRegressor(
        seed=seed,
        numTrees=int(n_estimators),
        featureSubsetStrategy=feature_subset(max_features),
        bootstrap=bool(bootstrap),
        maxDepth=MAX_DEPTH if max_depth is None else max_depth,
        maxBins=max_bins,
    )


def with_params(estimator: Estimator, params: dict) -> Estimator:
    """Copy of an MLlib regressor with reference-style parameter names applied."""
    mapping = {
        "n_estimators": ("numTrees", int),
        "max_features": ("featureSubsetStrategy", feature_subset),
        "bootstrap": ("bootstrap", bool),
        "max_depth": ("maxDepth", lambda v: MAX_DEPTH if v is None else int(v)),
        "random_state": ("seed", int),
        "max_bins": ("maxBins", int),
    }
    est = estimator.copy()
    for k, v in params.items():
        name, conv = mapping.get(k, (k, lambda x: x))
        est._set(**{name: conv(v)})
    return est


def layout_partitions(n_rows: int, rows_per_partition: int = 30_000, lo: int = 2) -> int:
    """Partition count for tree training, a function of the row count only."""
    return max(lo, -(-n_rows // rows_per_partition))


def deterministic_layout(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Fixed hash layout by key, sorted inside partitions.

    The partition count depends only on the number of rows (not on how the
    input happens to be split), so a seeded tree learner sees the same
    partitions for the same rows.
    """
    n = partitions if partitions is not None else layout_partitions(df.count())
    return df.repartition(n, F.col(key)).sortWithinPartitions(key)


def fit_model(
    estimator: Estimator | Forest,
    df: DataFrame,
    features: list[str],
    label: str,
    key: str | None = None,
    partitions: int | None = None,
) -> PipelineModel | ForestModel:
    if isinstance(estimator, Forest):
        if key is None:
            raise ValueError("a forest's rows are named by a key")
        return fit_forest(df, features, label, key, estimator)
    data = deterministic_layout(df, key, partitions) if key else df
    if hasattr(estimator, "setLabelCol"):
        estimator = estimator.copy()
        estimator.setLabelCol(label).setFeaturesCol("features").setPredictionCol("prediction")
    pipe = Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error"), estimator])
    return pipe.fit(data)


def params_of(estimator: Estimator | Forest) -> dict:
    """A regressor's parameters by name."""
    if isinstance(estimator, Forest):
        return vars(estimator)
    return {p.name: v for p, v in estimator.extractParamMap().items()}


def predict(model, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    out = model.transform(df)
    if keep is not None:
        out = out.select(*keep, "prediction")
    return out
