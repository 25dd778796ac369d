"""Standard scaling: (x - mean) / population std; a zero std divides by 1.

The statistics can be fitted by a pass over the data (``fit_scaler``) or, when
the scaled columns are imputed columns, derived without any pass from the
imputer's moments (``scaler_from_imputation``): the imputed column is the
non-missing values plus ``n_missing`` copies of the fill value, and mean and
population variance of that union follow from the parallel-variance formula.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathe.operators.impute import Imputation, moments


@dataclass(frozen=True)
class Scaling:
    mean: dict[str, float | None]
    std: dict[str, float | None]

    def divisor(self, c: str) -> float | None:
        s = self.std[c]
        if s is None:
            return None
        return 1.0 if s == 0.0 else s

    def expr(self, c: str, source: Column | None = None) -> Column:
        x = source if source is not None else F.col(c).cast("double")
        mu, d = self.mean[c], self.divisor(c)
        if mu is None or d is None:
            return F.lit(None).cast("double")
        return (x - F.lit(mu)) / F.lit(d)

    def apply(self, df: DataFrame) -> DataFrame:
        """Scale the fitted columns; they move to the end of the table."""
        keep = [c for c in df.columns if c not in self.mean]
        return df.select(*keep, *[self.expr(c).alias(c) for c in self.mean])


def fit_scaler(df: DataFrame, cols: list[str] | tuple[str, ...]) -> Scaling:
    m = moments(df, list(cols))
    return Scaling(
        mean=dict(m.mean),
        std={c: (math.sqrt(v) if v is not None else None) for c, v in m.var_pop.items()},
    )


def scaler_from_imputation(imp: Imputation, cols: list[str] | tuple[str, ...]) -> Scaling:
    """Scaler statistics of imputed columns, from the imputer's moments alone."""
    mom = imp.moments
    if mom is None:
        raise ValueError("imputation was fitted without moments")
    means, stds = {}, {}
    n = mom.rows
    for c in cols:
        cnt, mu_c, var_c, fill = mom.count[c], mom.mean[c], mom.var_pop[c], imp.values[c]
        if fill is None or n == 0:
            means[c] = mu_c
            stds[c] = math.sqrt(var_c) if var_c is not None else None
            continue
        missing = n - cnt
        if cnt == 0:
            means[c], stds[c] = float(fill), 0.0
            continue
        mean = (cnt * mu_c + missing * fill) / n
        delta = fill - mu_c
        m2 = var_c * cnt + delta * delta * cnt * missing / n
        means[c] = mean
        stds[c] = math.sqrt(max(m2 / n, 0.0))
    return Scaling(mean=means, std=stds)
