"""The preprocessing pipeline: impute -> ratios -> scale, then one-hot.

``PrepSpec.fit(train)`` runs a small number of distributed aggregate passes
and keeps only statistics:

* histogram passes over all columns at once (``quantiles``): counts, moments
  and, for the median strategy, exact medians;
* one ``distinct`` over (column, value) pairs for the category lists.

``PrepSpec.fit_without(train, fold, folds)`` fits one preparation per fold on
the rows of all other folds, in the same passes: histograms and category
lists are counted by fold. So a cross-validation need not let a fold's own
rows into the statistics that prepare it.

Scaler statistics of imputed columns are derived from the pass-1 moments, so
the scaler costs no pass of its own. ``FittedPrep.apply(df)`` is a single
projection with literals; Catalyst collapses impute, ratio, scale and encode
into one whole-stage-codegen ``Project`` next to the scan.

Output column order: passthrough columns (key, label, ...), ratio columns,
scaled numerics, indicator columns.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathe.operators.impute import Imputation, fit_imputer, imputation_from, statistics
from lathe.operators.onehot import OneHot, fit_onehot, fit_onehot_without
from lathe.operators.ratios import ratio_columns
from lathe.operators.scale import Scaling, fit_scaler, scaler_from_imputation


@dataclass(frozen=True)
class PrepSpec:
    numeric: tuple[str, ...]
    categorical: tuple[str, ...] = ()
    impute: str = "median"
    fill_value: float = 0.0
    ratios: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    scale: tuple[str, ...] | None = None  # default: the numeric list (ratios stay unscaled)
    drop_first: bool = True
    max_categories: int = 1000

    def fit(self, df: DataFrame) -> FittedPrep:
        numeric = list(self.numeric)
        cats = list(self.categorical)
        imp = fit_imputer(df, numeric, self.impute, self.fill_value, with_moments=True)
        scale_cols = list(self.scale) if self.scale is not None else numeric
        from_imputed = [c for c in scale_cols if c in imp.values]
        others = [c for c in scale_cols if c not in imp.values]
        scaling = scaler_from_imputation(imp, from_imputed)
        if others:
            # ratio (or other) columns asked to be scaled need their own pass
            derived = df.select(*imp.columns(), *[F.col(c) for c in df.columns if c not in imp.values])
            derived = derived.select("*", *ratio_columns({k: v for k, v in self.ratios.items() if k in others}))
            extra = fit_scaler(derived, others)
            scaling = Scaling({**scaling.mean, **extra.mean}, {**scaling.std, **extra.std})
        onehot = fit_onehot(df, cats, self.drop_first, self.max_categories)
        return FittedPrep(self, imp, dict(self.ratios), scaling, scale_cols, onehot)


    def fit_without(self, df: DataFrame, fold: str, folds: list[int]) -> dict[int, FittedPrep]:
        """{fold: the preparation fitted on all other folds}."""
        numeric, cats = list(self.numeric), list(self.categorical)
        if self.impute not in ("median", "mean", "constant") or (self.scale is not None and set(self.scale) - set(numeric)):
            raise ValueError("by fold, columns are imputed by median, mean or constant, and only numeric ones are scaled")
        stats = statistics(df, numeric, self.impute == "median", F.col(f"`{fold}`").cast("int"), folds)
        onehots = fit_onehot_without(df, cats, fold, folds, self.drop_first, self.max_categories)
        scale_cols = list(self.scale) if self.scale is not None else numeric
        out = {}
        for f in folds:
            rows, own = stats[f]
            imp = imputation_from(self.impute, rows, own, {c: float(self.fill_value) for c in numeric} if self.impute == "constant" else None)
            out[f] = FittedPrep(self, imp, dict(self.ratios), scaler_from_imputation(imp, scale_cols), scale_cols, onehots[f])
        return out


def apply_by_fold(preps: dict[int, FittedPrep], df: DataFrame, fold: str) -> DataFrame:
    """Every row prepared by the statistics of the other folds: one projection that chooses by fold.

    The indicators are those that any fold's preparation has; a category that
    only this fold's rows have, and the one dropped first, are all zeros.
    """
    names = list(dict.fromkeys(n for p in preps.values() for n in p.feature_names))
    feats = set(next(iter(preps.values())).spec.numeric) | set(next(iter(preps.values())).spec.categorical)
    chosen = []
    cols = {f: dict(zip(p.feature_names, p.numeric_branch() + p.categorical_branch(), strict=True)) for f, p in preps.items()}
    for n in names:
        by = None
        for f, own in cols.items():
            value = own.get(n, F.lit(0.0))
            by = F.when(F.col(f"`{fold}`") == f, value) if by is None else by.when(F.col(f"`{fold}`") == f, value)
        chosen.append(by.alias(n))
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in feats], *chosen)


@dataclass(frozen=True)
class FittedPrep:
    spec: PrepSpec
    imputation: Imputation
    ratios: dict[str, tuple[str, str]]
    scaling: Scaling
    scaled: list[str]
    onehot: OneHot

    # --- expressions of each branch -------------------------------------
    def _imputed(self, c: str) -> Column:
        return self.imputation.expr(c) if c in self.imputation.values else F.col(c).cast("double")

    def ratio_columns(self) -> list[Column]:
        return ratio_columns(self.ratios, source=self._imputed)

    def numeric_columns(self) -> list[Column]:
        """Imputed numerics, scaled where listed, in numeric-list order."""
        out = []
        for c in self.spec.numeric:
            x = self._imputed(c)
            out.append((self.scaling.expr(c, x) if c in self.scaled else x).alias(c))
        return out

    def scaled_ratio_columns(self) -> list[Column]:
        """Ratio columns, scaled only when the spec lists them for scaling."""
        out = []
        for name, pair in self.ratios.items():
            col = ratio_columns({name: pair}, source=self._imputed)[0]
            out.append(self.scaling.expr(name, col).alias(name) if name in self.scaled else col)
        return out

    def indicator_columns(self) -> list[Column]:
        return self.onehot.columns()

    def numeric_branch(self) -> list[Column]:
        return self.scaled_ratio_columns() + self.numeric_columns()

    def categorical_branch(self) -> list[Column]:
        return self.indicator_columns()

    @property
    def feature_names(self) -> list[str]:
        return list(self.ratios) + list(self.spec.numeric) + self.onehot.names()

    def apply(self, df: DataFrame) -> DataFrame:
        feats = set(self.spec.numeric) | set(self.spec.categorical)
        keep = [c for c in df.columns if c not in feats]
        return df.select(*keep, *self.numeric_branch(), *self.categorical_branch())


def branch_union(df: DataFrame, passthrough: list[str], branches: list[list[Column]]) -> DataFrame:
    """Merge the outputs of parallel branches side by side in one projection."""
    cols = [F.col(c) for c in passthrough]
    for b in branches:
        cols.extend(b)
    return df.select(*cols)


def vector_column(df: DataFrame, inputs: list[str], output: str = "features") -> DataFrame:
    """Assemble feature columns into one vector column (sparse when mostly zero)."""
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid="error").transform(df)
