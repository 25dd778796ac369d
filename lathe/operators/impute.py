"""Missing-value imputation: fit one statistic per column, fill with literals.

Strategies: ``median`` (exact, see ``quantiles``), ``mean``, ``most_frequent``
(highest count, smallest value on ties) and ``constant``. Missing = NULL or
NaN. ``fit`` runs distributed aggregates and keeps only the statistics;
``apply`` is a projection with the statistics as literals, so the fitted
plan never re-reads the training table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathe.functions.exprs import to_double_nullable
from lathe.operators.quantiles import ColumnStats, column_statistics, median_of, middle_ranks

STRATEGIES = ("median", "mean", "most_frequent", "constant")


@dataclass(frozen=True)
class Moments:
    """Per-column count, mean and population variance of the non-missing values."""

    rows: int
    count: dict[str, int]
    mean: dict[str, float | None]
    var_pop: dict[str, float | None]


def moment_aggs(cols: list[str]) -> list[Column]:
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        v = to_double_nullable(c)
        aggs += [F.count(v).alias(f"c{i}"), F.avg(v).alias(f"m{i}"), F.var_pop(v).alias(f"v{i}")]
    return aggs


def moments_from_row(row, cols: list[str]) -> Moments:
    return Moments(
        rows=row["_rows"],
        count={c: row[f"c{i}"] for i, c in enumerate(cols)},
        mean={c: row[f"m{i}"] for i, c in enumerate(cols)},
        var_pop={c: row[f"v{i}"] for i, c in enumerate(cols)},
    )


def moments(df: DataFrame, cols: list[str]) -> Moments:
    return moments_from_row(df.agg(*moment_aggs(cols)).collect()[0], cols)


def most_frequent(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    """Mode per column; ties go to the smallest value.

    Values are counted with a partially aggregated group-by on (column, value),
    then reduced with ``max(struct(count, -value))`` per column, so no group
    is ever gathered into one task.
    """
    if not cols:
        return {}
    parts = [
        F.when(to_double_nullable(c).isNotNull(), F.struct(F.lit(i).alias("i"), to_double_nullable(c).alias("v")))
        for i, c in enumerate(cols)
    ]
    pairs = df.select(F.explode(F.filter(F.array(*parts), lambda x: x.isNotNull())).alias("e")).select("e.i", "e.v")
    counted = pairs.groupBy("i", "v").count()
    best = counted.groupBy("i").agg(F.max(F.struct(F.col("count"), (-F.col("v")).alias("nv"))).alias("b"))
    got = {r["i"]: -r["b"]["nv"] for r in best.collect()}
    return {c: (float(got[i]) + 0.0 if i in got else None) for i, c in enumerate(cols)}


@dataclass(frozen=True)
class Imputation:
    strategy: str
    values: dict[str, float | None]
    moments: Moments | None = field(default=None, compare=False)

    def expr(self, c: str) -> Column:
        v = self.values[c]
        base = to_double_nullable(c)
        return base if v is None else F.coalesce(base, F.lit(float(v)))

    def columns(self) -> list[Column]:
        return [self.expr(c).alias(c) for c in self.values]

    def apply(self, df: DataFrame) -> DataFrame:
        """Fill missing values; imputed columns move to the end (as dropped and re-appended)."""
        keep = [c for c in df.columns if c not in self.values]
        return df.select(*keep, *self.columns())


def statistics(df: DataFrame, cols: list[str], medians: bool, fold: Column | None = None, folds: list | None = None) -> dict:
    """{without: (rows, {column: ColumnStats})}: counts, moments and middle values of every column from the same passes."""
    sources = {c: to_double_nullable(c) for c in cols}
    every = column_statistics(df, {**sources, "": F.lit(0.0)}, middle_ranks, fold, folds, want=cols if medians else [])
    rows = every.pop("")
    return {g: (rows[g].n, {c: s[g] for c, s in every.items()}) for g in rows}


def imputation_from(strategy: str, rows: int, stats: dict[str, ColumnStats], values: dict[str, float | None] | None = None) -> Imputation:
    """Median, mean or given values, with the moments that a scaler needs."""
    if values is None:
        values = {c: median_of(s) if strategy == "median" else s.mean for c, s in stats.items()}
    mom = Moments(rows, {c: s.n for c, s in stats.items()}, {c: s.mean for c, s in stats.items()}, {c: s.var_pop for c, s in stats.items()})
    return Imputation(strategy, values, mom)


def fit_imputer(
    df: DataFrame,
    cols: list[str] | tuple[str, ...],
    strategy: str = "median",
    fill_value: float = 0.0,
    with_moments: bool = True,
) -> Imputation:
    cols = list(cols)
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown imputation strategy {strategy!r}; expected one of {STRATEGIES}")
    if strategy == "median":
        rows, stats = statistics(df, cols, True)[None]
        imp = imputation_from(strategy, rows, stats)
        return imp if with_moments else Imputation(strategy, imp.values)
    mom = moments(df, cols) if with_moments or strategy == "mean" else None
    if strategy == "mean":
        vals = dict(mom.mean)
    elif strategy == "most_frequent":
        vals = most_frequent(df, cols)
    else:
        vals = {c: float(fill_value) for c in cols}
    return Imputation(strategy, vals, mom)
