"""Ordinary least squares by tall-skinny QR, in one scan.

``fit_ols`` never forms cross-products: each task takes the triangular factor R
of its Arrow batches of [1, X, y], folding every batch into the factor so far,
and emits one small R per group. Factors are merged by a QR of two stacked
ones, in a tree of grouped tasks, so what reaches the driver is one R of
(p + 2)^2 numbers per group, however many rows or partitions there are. The
condition number is that of X, not its square. A SQL aggregate would need p^2
sums, beyond what whole-stage codegen compiles.

R's rows below the first are the factor of the centred columns, so the slopes
are its least-squares solution (minimum norm where columns depend on each
other), and the model's prediction is a plain column expression: scoring runs
inside whole-stage codegen, no UDF.

``kfold_ols`` evaluates k-fold cross-validation in the same single scan: one R
per fold, the training factor of a fold being the merged factors of the
others. Test and train errors are norms of R times (-b, 1): sums of squares
are never subtracted from each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Factors that one task merges.
MERGED = 64


@dataclass(frozen=True)
class LinearModel:
    features: tuple[str, ...]
    coef: tuple[float, ...]
    intercept: float

    def prediction(self) -> Column:
        expr = F.lit(float(self.intercept))
        for c, b in zip(self.features, self.coef):
            expr = expr + F.lit(float(b)) * F.col(c).cast("double")
        return expr

    def transform(self, df: DataFrame, pred: str = "prediction") -> DataFrame:
        return df.withColumn(pred, self.prediction())


def _merged(factors: Iterator[np.ndarray], p: int) -> np.ndarray:
    """The factor of all rows that the factors stand for; its diagonal not negative."""
    out = np.zeros((0, p))
    for r in factors:
        out = np.linalg.qr(np.vstack([out, r]), mode="r")
    return out * np.where(np.diagonal(out) < 0, -1.0, 1.0)[:, None] if len(out) else out


def factors(df: DataFrame, features: list[str], label: str, group_col: str | None = None) -> dict[int, np.ndarray]:
    """Per group: the triangular factor of [1, features, label].

    Rows with a missing feature or label are left out (a least-squares fit
    needs complete rows).
    """
    cols = list(features) + [label]
    p = len(cols) + 1
    g = F.col(group_col).cast("long") if group_col else F.lit(0).cast("long")
    rows = df.select(g.alias("_g"), *[F.col(f"`{c}`").cast("double").alias(f"_x{i}") for i, c in enumerate(cols)]).na.drop()

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        found: dict[int, np.ndarray] = {}
        for b in batches:
            x = np.column_stack([np.ones(b.num_rows), *[b.column(k + 1).to_numpy() for k in range(p - 1)]])
            group = b.column(0).to_numpy()
            for k in np.unique(group).tolist():
                found[k] = _merged([found.get(k, np.zeros((0, p))), x[group == k]], p)
        if found:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array([part] * len(found), pa.int64()), pa.array([r.tobytes() for r in found.values()])], names=["g", "part", "r"])

    def of_group(parts: pa.Table) -> pa.Table:
        order = np.argsort(parts["part"].to_numpy(), kind="stable").tolist()  # sums don't depend on arrival
        r = _merged([np.frombuffer(parts["r"][k].as_buffer()).reshape(-1, p) for k in order], p)
        return pa.table({"g": [parts["g"][0].as_py()], "part": [parts["part"][order[0]].as_py() // MERGED], "r": [r.tobytes()]})

    schema = "g long, part long, r binary"
    got = rows.mapInArrow(of_task, schema)
    # two levels of the tree are tasks; of 100,000 partitions the last one merges 25 factors a group
    for _ in range(2):
        got = got.groupBy("g", F.floor(F.col("part") / MERGED).alias("next")).applyInArrow(of_group, schema)
    out: dict[int, list] = {}
    for r in sorted(got.collect()):
        out.setdefault(r["g"], []).append(np.frombuffer(bytes(r["r"])).reshape(-1, p))
    return {k: _merged(v, p) for k, v in out.items()}


def _rows(r: np.ndarray) -> int:
    return int(round(float(r[0, 0]) ** 2)) if len(r) else 0


def _solve(r: np.ndarray) -> tuple[np.ndarray, float]:
    p = r.shape[1] - 2
    if not len(r):
        raise ValueError("no rows to fit")
    centred = r[1 : p + 1]
    beta = np.linalg.lstsq(centred[:, 1 : p + 1], centred[:, p + 1], rcond=None)[0] if p and len(centred) else np.zeros(p)
    return beta, float((r[0, p + 1] - r[0, 1 : p + 1] @ beta) / r[0, 0])


def _sse(r: np.ndarray, beta: np.ndarray, b0: float) -> float:
    """Sum of squared residuals of (beta, b0) over the rows that ``r`` stands for."""
    off = r @ np.concatenate([[-b0], -beta, [1.0]])
    return float(off @ off)


def fit_ols(df: DataFrame, features: list[str] | tuple[str, ...], label: str) -> LinearModel:
    feats = list(features)
    r = factors(df, feats, label).get(0)
    if r is None:
        raise ValueError("no complete rows to fit")
    beta, b0 = _solve(r)
    return LinearModel(tuple(feats), tuple(float(b) for b in beta), b0)


def kfold_ols(
    df: DataFrame, features: list[str] | tuple[str, ...], label: str, fold_col: str = "fold"
) -> list[dict]:
    """Per fold: n_test, n_train, test_mse, train_mse of OLS fitted without the fold."""
    feats = list(features)
    per = factors(df, feats, label, fold_col)
    out = []
    for f in sorted(per):
        test, train = per[f], _merged([per[k] for k in sorted(per) if k != f], len(feats) + 2)
        beta, b0 = _solve(train)
        n_test, n_train = _rows(test), _rows(train)
        out.append({"fold": int(f), "n_test": n_test, "n_train": n_train, "test_mse": _sse(test, beta, b0) / n_test, "train_mse": _sse(train, beta, b0) / n_train})
    return out
