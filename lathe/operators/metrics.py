"""Regression metrics in a single aggregation pass.

MAE, MSE, RMSE and R^2 come from one ``agg`` (optionally per group) with
partial aggregation: ``sum(|e|)``, ``sum(e^2)``, ``count`` and the population
variance of the label (a numerically stable merge of partial moments, not a
sum-of-squares difference). R^2 follows the usual finite convention: when
the label is constant, 1.0 if the predictions are perfect, else 0.0. Only rows with
both label and prediction count, in ``n_rows`` and in every metric.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRIC_COLUMNS = ("n_rows", "mae", "mse", "rmse", "r2")


def _metric_aggs(label: str, pred: str) -> list[Column]:
    y = F.col(label).cast("double")
    e = y - F.col(pred).cast("double")
    return [
        F.count(e).alias("n_rows"),
        F.avg(F.abs(e)).alias("mae"),
        F.avg(e * e).alias("mse"),
        F.sum(e * e).alias("_sse"),
        F.var_pop(F.when(e.isNotNull(), y)).alias("_var"),
    ]


def r2_of(sse: Column, var: Column, n: Column) -> Column:
    """R^2 from the sum of squared errors, the label's population variance and the rows."""
    sst = var * n
    return F.when(sst == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(F.lit(1.0) - F.try_divide(sse, sst))


def _finish(df: DataFrame, keys: list[str]) -> DataFrame:
    r2 = r2_of(F.col("_sse"), F.col("_var"), F.col("n_rows"))
    return df.select(
        *keys,
        F.col("n_rows"),
        F.col("mae"),
        F.col("mse"),
        F.sqrt("mse").alias("rmse"),
        r2.alias("r2"),
    )


def regression_metrics(df: DataFrame, label: str, pred: str = "prediction", by: list[str] | None = None) -> DataFrame:
    keys = list(by or [])
    grouped = df.groupBy(*keys) if keys else df
    return _finish(grouped.agg(*_metric_aggs(label, pred)), keys)


def evaluate(model, df: DataFrame, label: str, pred: str = "prediction") -> dict[str, float]:
    """Predict with a fitted model and return MAE, RMSE and R^2 together."""
    scored = model.transform(df)
    row = regression_metrics(scored, label, pred).collect()[0]
    return {"mae": row["mae"], "rmse": row["rmse"], "r2": row["r2"], "mse": row["mse"], "n_rows": row["n_rows"]}
