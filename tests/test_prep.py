import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lathe.operators.impute import fit_imputer
from lathe.operators.onehot import fit_onehot
from lathe.operators.prep import PrepSpec, branch_union
from lathe.operators.ratios import HOUSING_RATIOS, ratio_features
from lathe.operators.scale import Scaling, fit_scaler, scaler_from_imputation

NUM = ["longitude", "latitude", "housing_median_age", "total_rooms", "total_bedrooms", "population", "households", "median_income"]
CATS = ["<1H OCEAN", "INLAND", "ISLAND", "NEAR BAY", "NEAR OCEAN"]


def housing(n=300, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        rooms = rnd.randint(100, 8000)
        hh = rnd.randint(20, 1500)
        bed = None if i % 11 == 0 else float(rnd.randint(10, 1500))
        if i % 37 == 0 and bed is not None:
            bed = float("nan")
        rows.append(
            (
                i,
                -122 + rnd.random(),
                37 + rnd.random(),
                float(rnd.randint(1, 52)),
                float(rooms),
                bed,
                float(rnd.randint(50, 5000)),
                float(hh),
                rnd.uniform(0.5, 15),
                float(rnd.randint(15000, 500000)),
                CATS[rnd.randint(0, 4)],
            )
        )
    schema = "id long, " + ", ".join(f"{c} double" for c in NUM) + ", median_house_value double, ocean_proximity string"
    return rows, schema


# fixed values from the recorded run's input example: three prepared rows
# (raw age, raw bedrooms, raw population) -> (age/pop, bedrooms/pop, z(age), z(bedrooms), z(pop))
GOLDEN = [
    (37, 331, 860, 0.04302325581395349, 0.38488372093023254, 0.6664068683707901, -0.4946456739390845, -0.496544136491719),
    (22, 267, 774, 0.028423772609819122, 0.3449612403100775, -0.523038262347748, -0.646649230446825, -0.5717917134051643),
    (36, 407, 1967, 0.018301982714794104, 0.20691408235892222, 0.5871105263228875, -0.31414145058614257, 0.47204967331274594),
]
GOLDEN_STATS = {
    "housing_median_age": (28.595994832041345, 12.610922196081942),
    "total_bedrooms": (539.2669896640828, 421.0427799874598),
    "population": (1427.4972868217058, 1142.8939445973501),
}


def test_golden_rows_ratios_and_scaling(spark):
    df = spark.createDataFrame([tuple(float(x) for x in g[:3]) for g in GOLDEN], "housing_median_age double, total_bedrooms double, population double")
    # the recorded pipeline's ratios came from shifted columns: age/pop and bedrooms/pop
    shifted = {"r1": ("housing_median_age", "population"), "r2": ("total_bedrooms", "population")}
    out = ratio_features(df, shifted).orderBy("housing_median_age").collect()
    sc = Scaling({k: v[0] for k, v in GOLDEN_STATS.items()}, {k: v[1] for k, v in GOLDEN_STATS.items()})
    z = sc.apply(df).collect()
    by_age = {r["housing_median_age"]: r for r in out}
    zs = {g[0]: r for g, r in zip(GOLDEN, z)}
    for g in GOLDEN:
        r = by_age[g[0]]
        assert r["r1"] == g[3] and r["r2"] == g[4]
        zr = zs[g[0]]
        assert zr["housing_median_age"] == pytest.approx(g[5], abs=1e-12)
        assert zr["total_bedrooms"] == pytest.approx(g[6], abs=1e-12)
        assert zr["population"] == pytest.approx(g[7], abs=1e-12)


def test_prep_matches_pandas(spark):
    rows, schema = housing()
    df = spark.createDataFrame(rows, schema)
    spec = PrepSpec(numeric=tuple(NUM), categorical=("ocean_proximity",), ratios={k: v for k, v in HOUSING_RATIOS.items() if k != "bedrooms_per_room"})
    fp = spec.fit(df)
    got = fp.apply(df).toPandas().sort_values("id").reset_index(drop=True)

    pdf = pd.DataFrame(rows, columns=["id", *NUM, "median_house_value", "ocean_proximity"]).sort_values("id").reset_index(drop=True)
    med = pdf[NUM].median()
    imp = pdf[NUM].fillna(med)
    mu, sd = imp.mean(), imp.std(ddof=0)
    for c in NUM:
        np.testing.assert_allclose(got[c].to_numpy(), ((imp[c] - mu[c]) / sd[c]).to_numpy(), rtol=1e-9, atol=1e-9)
    np.testing.assert_allclose(got["rooms_per_household"], imp["total_rooms"] / imp["households"], rtol=1e-12)
    np.testing.assert_allclose(got["population_per_household"], imp["population"] / imp["households"], rtol=1e-12)
    for cat in CATS[1:]:
        np.testing.assert_array_equal(got[f"ocean_proximity_{cat}"], (pdf["ocean_proximity"] == cat).astype(float))
    assert f"ocean_proximity_{CATS[0]}" not in got.columns
    # column order: passthrough, ratios, numerics, indicators
    assert list(got.columns) == ["id", "median_house_value", "rooms_per_household", "population_per_household", *NUM, *[f"ocean_proximity_{c}" for c in CATS[1:]]]


def test_prep_properties(spark):
    rows, schema = housing(500, seed=5)
    df = spark.createDataFrame(rows, schema)
    fp = PrepSpec(numeric=tuple(NUM), categorical=("ocean_proximity",)).fit(df)
    out = fp.apply(df)
    stats = out.agg(*[F.avg(c).alias(f"m_{c}") for c in NUM], *[F.stddev_pop(c).alias(f"s_{c}") for c in NUM],
                    *[F.count(c).alias(f"n_{c}") for c in NUM]).collect()[0]
    for c in NUM:
        assert abs(stats[f"m_{c}"]) < 1e-9
        assert stats[f"s_{c}"] == pytest.approx(1.0, abs=1e-9)
        assert stats[f"n_{c}"] == 500
    ind = [c for c in out.columns if c.startswith("ocean_proximity_")]
    sums = out.select(sum(F.col(c) for c in ind).alias("s")).distinct().collect()
    assert {r["s"] for r in sums} <= {0.0, 1.0}


def test_scaler_from_imputation_equals_direct_fit(spark):
    rows, schema = housing(400, seed=9)
    df = spark.createDataFrame(rows, schema)
    imp = fit_imputer(df, NUM, "median")
    analytic = scaler_from_imputation(imp, NUM)
    direct = fit_scaler(imp.apply(df), NUM)
    for c in NUM:
        assert analytic.mean[c] == pytest.approx(direct.mean[c], rel=1e-12)
        assert analytic.std[c] == pytest.approx(direct.std[c], rel=1e-10)


@pytest.mark.parametrize("strategy", ["median", "mean", "most_frequent", "constant"])
def test_imputer_strategies(spark, strategy):
    vals = [1.0, 2.0, None, 2.0, 10.0, float("nan"), 3.0, 3.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    imp = fit_imputer(df, ["x"], strategy, fill_value=-1.0)
    clean = [v for v in vals if v is not None and not math.isnan(v)]
    expected = {
        "median": float(np.median(clean)),
        "mean": float(np.mean(clean)),
        "most_frequent": 2.0,  # 2 and 3 both twice: smallest wins
        "constant": -1.0,
    }[strategy]
    assert imp.values["x"] == pytest.approx(expected)
    out = [r["x"] for r in imp.apply(df).collect()]
    assert None not in out and out.count(expected) >= 2


def test_unknown_and_missing_category_all_zeros(spark):
    train = spark.createDataFrame([("NEAR BAY",), ("INLAND",), ("NEAR OCEAN",)], "ocean_proximity string")
    oh = fit_onehot(train, ["ocean_proximity"])
    assert oh.categories["ocean_proximity"] == ["INLAND", "NEAR BAY", "NEAR OCEAN"]
    test = spark.createDataFrame([("ISLAND",), (None,), ("INLAND",), ("NEAR OCEAN",)], "ocean_proximity string")
    got = [tuple(r) for r in test.select(*oh.columns()).collect()]
    assert got == [(0.0, 0.0), (0.0, 0.0), (0.0, 0.0), (0.0, 1.0)]


def test_onehot_cardinality_guard(spark):
    df = spark.range(0, 50).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError):
        fit_onehot(df, ["c"], max_categories=10)


def test_ratio_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (4.0, 2.0)], "a double, b double")
    got = [r["r"] for r in ratio_features(df, {"r": ("a", "b")}).collect()]
    assert got == [None, 2.0]


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (5.0,)], "x double")
    sc = fit_scaler(df, ["x"])
    assert [r["x"] for r in sc.apply(df).collect()] == [0.0, 0.0, 0.0]


def test_branch_union_merges_all_branches(spark):
    rows, schema = housing(50)
    df = spark.createDataFrame(rows, schema)
    fp = PrepSpec(numeric=tuple(NUM), categorical=("ocean_proximity",)).fit(df)
    out = branch_union(df, ["id"], [fp.numeric_branch(), fp.categorical_branch()])
    assert out.columns == ["id", *NUM, *fp.onehot.names()]


def test_apply_is_one_projection(spark):
    rows, schema = housing(50)
    df = spark.createDataFrame(rows, schema)
    fp = PrepSpec(numeric=tuple(NUM), categorical=("ocean_proximity",), ratios=dict(HOUSING_RATIOS)).fit(df)
    plan = fp.apply(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") == 1 and "Join" not in plan and "Aggregate" not in plan


def test_sparse_onehot_matches_dense_order(spark):
    from lathe.operators.onehot import category_table, sparse_onehot

    rows = [(i, v, w) for i, (v, w) in enumerate([("b", 3), ("a", 10), (None, 3), ("c", None), ("zz", 2), ("b", 2), ("b", 2)])]
    df = spark.createDataFrame(rows, "k long, v string, w long")
    table = category_table(df.where("k <> 4"), ["v", "w"])
    numbered = {(r["column_name"], r["category"]): r["position"] for r in table.collect()}
    assert numbered == {("v", "a"): 0, ("v", "b"): 1, ("v", "c"): 2, ("w", "10"): 0, ("w", "2"): 1, ("w", "3"): 2}
    got = {r["k"]: r["ones"] for r in sparse_onehot(df, ["v", "w"], table).collect()}
    # the first category of each column, missing and unknown values have no one
    assert got == {0: [0, 3], 1: [], 2: [3], 3: [1], 4: [2], 5: [0, 2], 6: [0, 2]}
    empty = df.where("k < 0")
    assert sparse_onehot(df, ["v", "w"], category_table(empty, ["v", "w"])).where("size(ones) > 0 or n_dims > 0").count() == 0


def test_category_table_numbers_across_prefixes(spark):
    from lathe.operators.onehot import category_table

    values = [f"{a}{b}{n}" for a in "xyz" for b in "ab" for n in range(150)] + ["", "x", "xa"]
    got = category_table(spark.createDataFrame([(v,) for v in values * 2], "c string"), ["c"]).collect()
    assert [r["category"] for r in sorted(got, key=lambda r: r["position"])] == sorted(values)
    assert sorted(r["position"] for r in got) == list(range(len(values)))
