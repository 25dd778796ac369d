"""Registered queries: one (spark, sf_dir) -> DataFrame per operator.

Each works on the whole input tables. Double outputs are rounded at the edge
(6 decimals, +0.0 to fold negative zero) so they can be compared with the
SQL twins in ``oracles``; the library operators themselves never round.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lathe.operators.impute import fit_imputer
from lathe.operators.onehot import fit_onehot
from lathe.operators.prep import branch_union
from lathe.operators.profile import column_profile, dataset_profile, signature
from lathe.operators.ratios import ratio_features
from lathe.operators.split import contiguous_folds, hash_folds, split_approx
from lathe.plans.cases import (
    CATEGORICAL,
    FOLDS,
    KEY,
    LABEL,
    NUMERIC,
    SEED,
    TEST_SIZE,
    OrderCase,
)
from lathe.sources.tables import ORDER_RATIOS

Query = Callable[[SparkSession, str], DataFrame]


def fin(df: DataFrame, digits: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append((F.round(F.col(f.name), digits) + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _long_stats(values: dict[str, float | None]) -> list[tuple]:
    return [(i, c, None if v is None else float(v)) for i, (c, v) in enumerate(values.items())]


def _stats_frame(spark: SparkSession, rows: list[tuple], value_names: list[str]) -> DataFrame:
    schema = "position long, column_name string, " + ", ".join(f"{v} double" for v in value_names)
    return spark.createDataFrame(rows, schema)


# --- sources and profiles ----------------------------------------------------


def q_features_base(spark, sf):
    # the count columns are NULL for orders without lines: compare them as doubles
    feat = OrderCase(spark, sf).features
    return fin(feat.withColumns({c: F.col(c).cast("double") for c in ("n_supp", "n_lines")}))


def q_profile_columns(spark, sf):
    return column_profile(OrderCase(spark, sf).features)


def q_profile_dataset(spark, sf):
    case = OrderCase(spark, sf)
    tr = dataset_profile(case.train).withColumn("context", F.lit("training"))
    te = dataset_profile(case.test).withColumn("context", F.lit("testing"))
    return tr.unionByName(te)


def q_schema_signature(spark, sf):
    case = OrderCase(spark, sf)
    return signature(case.prepared("train"), exclude=(KEY, LABEL))


# --- splits and folds ---------------------------------------------------------


def q_split_approx(spark, sf):
    return split_approx(OrderCase(spark, sf).features, KEY, TEST_SIZE, SEED).select(KEY, "is_test")


def q_split_exact_sizes(spark, sf):
    return OrderCase(spark, sf).flagged.groupBy("is_test").agg(F.count(F.lit(1)).alias("n_rows"))


def q_split_exact_rows(spark, sf):
    return OrderCase(spark, sf).flagged.select(KEY, "is_test")


def q_kfold_hash(spark, sf):
    return hash_folds(OrderCase(spark, sf).train.select(KEY), KEY, FOLDS, SEED)


def q_kfold_ntile(spark, sf):
    return contiguous_folds(OrderCase(spark, sf).train.select(KEY), KEY, FOLDS)


# --- imputation -----------------------------------------------------------------


def q_impute_median_stats(spark, sf):
    imp = OrderCase(spark, sf).prep.imputation
    return fin(_stats_frame(spark, _long_stats(imp.values), ["fill_value"]))


def _impute_query(strategy: str, **kw) -> Query:
    def q(spark, sf):
        case = OrderCase(spark, sf)
        imp = fit_imputer(case.train, list(NUMERIC), strategy, with_moments=False, **kw)
        return fin(imp.apply(case.test.select(KEY, *NUMERIC)))

    q.__name__ = f"q_impute_{strategy}"
    return q


# --- ratios, scaling, one-hot ----------------------------------------------------


def _ratio_query(with_bedrooms: bool) -> Query:
    def q(spark, sf):
        case = OrderCase(spark, sf)
        imputed = case.prep.imputation.apply(case.test.select(KEY, *NUMERIC))
        out = ratio_features(imputed, ORDER_RATIOS, add_bedrooms_per_room=with_bedrooms)
        names = [k for k in ORDER_RATIOS if with_bedrooms or k != "bedrooms_per_room"]
        return fin(out.select(KEY, *names))

    return q


def q_scaler_stats(spark, sf):
    sc = OrderCase(spark, sf).prep.scaling
    rows = [(i, c, sc.mean[c], sc.std[c]) for i, c in enumerate(sc.mean)]
    return fin(_stats_frame(spark, rows, ["mean", "std"]))


def q_scale(spark, sf):
    case = OrderCase(spark, sf)
    return fin(case.test.select(KEY, *case.prep.numeric_columns()))


def q_onehot_categories(spark, sf):
    oh = OrderCase(spark, sf).prep.onehot
    rows = [
        (c, v, i, (i > 0) if oh.drop_first else True)
        for c, cats in oh.categories.items()
        for i, v in enumerate(cats)
    ]
    return spark.createDataFrame(rows, "column_name string, category string, position int, kept boolean").select(
        "column_name", "category", F.col("position").cast("long").alias("position"), "kept"
    )


def q_onehot(spark, sf):
    case = OrderCase(spark, sf)
    return case.test.select(KEY, *case.prep.indicator_columns())


def q_onehot_unknown(spark, sf):
    case = OrderCase(spark, sf)
    fitted = fit_onehot(case.train.filter(F.col("o_orderpriority") != "1-URGENT"), list(CATEGORICAL))
    return case.test.select(KEY, "o_orderpriority", *fitted.columns())


def q_branch_union(spark, sf):
    case = OrderCase(spark, sf)
    p = case.prep
    return fin(branch_union(case.test, [KEY], [p.numeric_branch(), p.categorical_branch()]))


def q_onehot_join(spark, sf):
    """Indicator columns computed apart and joined back on the key (no row index)."""
    case = OrderCase(spark, sf)
    p = case.prep
    numeric = case.test.select(KEY, *p.numeric_columns())
    indicators = case.test.select(KEY, *p.indicator_columns())
    return fin(numeric.join(indicators, KEY, "left"))


# --- the full preparation ------------------------------------------------------


def q_prep_train(spark, sf):
    return fin(OrderCase(spark, sf).prepared("train"))


def q_prep_test(spark, sf):
    return fin(OrderCase(spark, sf).prepared("test"))


def q_label_reattach(spark, sf):
    case = OrderCase(spark, sf)
    features = case.prepared("test").drop(LABEL)
    labels = case.test.select(KEY, LABEL)
    return fin(features.join(labels, KEY, "left"))


def q_prep_full_counts(spark, sf):
    case = OrderCase(spark, sf)
    prepared = case.prep.apply(case.flagged)
    p = case.prep
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.avg(c).alias(f"avg_{c}") for c in p.feature_names if c not in p.onehot.names()]
    aggs += [F.sum(c).alias(f"n_{c}") for c in p.onehot.names()]
    return fin(prepared.groupBy("is_test").agg(*aggs))


QUERIES: dict[str, Query] = {
    "features_base": q_features_base,
    "profile_columns": q_profile_columns,
    "profile_dataset": q_profile_dataset,
    "schema_signature": q_schema_signature,
    "split_approx": q_split_approx,
    "split_exact_sizes": q_split_exact_sizes,
    "split_exact_rows": q_split_exact_rows,
    "kfold_hash": q_kfold_hash,
    "kfold_ntile": q_kfold_ntile,
    "impute_median_stats": q_impute_median_stats,
    "impute_median": _impute_query("median"),
    "impute_mean": _impute_query("mean"),
    "impute_mode": _impute_query("most_frequent"),
    "impute_constant": _impute_query("constant", fill_value=0.0),
    "ratio_features": _ratio_query(False),
    "ratio_features_all": _ratio_query(True),
    "scaler_stats": q_scaler_stats,
    "scale": q_scale,
    "onehot_categories": q_onehot_categories,
    "onehot": q_onehot,
    "onehot_unknown": q_onehot_unknown,
    "branch_union": q_branch_union,
    "onehot_join": q_onehot_join,
    "prep_train": q_prep_train,
    "prep_test": q_prep_test,
    "label_reattach": q_label_reattach,
    "prep_full_counts": q_prep_full_counts,
}


def _register_models() -> None:
    from lathe.plans.queries_models import MODEL_QUERIES
    from lathe.plans.queries_tables import TABLE_QUERIES

    QUERIES.update(MODEL_QUERIES)
    QUERIES.update(TABLE_QUERIES)


_register_models()
