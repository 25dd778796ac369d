"""Spark query vs its DuckDB twin on sf0.001 for a representative subset."""

import math

import duckdb
import pandas as pd
import pytest

SUBSET = [
    "features_base",
    "split_exact_rows",
    "kfold_ntile",
    "impute_median_stats",
    "impute_mode",
    "prep_test",
    "onehot_unknown",
    "regression_metrics_by_group",
    "cv_results_ranked",
    "linreg_one_feature",
    "profile_dataset",
    "onehot_sparse",
    "prepared_roundtrip",
    "score_models_tables",
    "run_inputs",
    "run_tree",
    "random_candidates",
]


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _canon(df: pd.DataFrame):
    cols = sorted(df.columns)
    rows = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return cols, sorted(rows, key=repr)


@pytest.fixture(scope="module")
def duck(sf0001):
    from lathe.sources.tables import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf0001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", SUBSET)
def test_query_matches_sql_twin(spark, sf0001, duck, name):
    import __spark_entry__ as e

    got = _canon(e.queries()[name](spark, sf0001).toPandas())
    want = _canon(duck.execute(e.oracle_sql()[name]).df())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
