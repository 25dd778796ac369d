import math

from pyspark.sql import functions as F

from lathe.operators.split import (
    contiguous_folds,
    find_hash_cut,
    hash_folds,
    split_approx,
    split_data,
    split_exact,
)


def test_split_100_rows_exact_sizes(spark):
    df = spark.createDataFrame([(i, i + 100) for i in range(100)], "feature1 long, feature2 long")
    train, test = split_data(df, "feature1", test_size=0.2, seed=42)
    assert train.count() == 80
    assert test.count() == 20


def test_split_disjoint_complete_and_layout_independent(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "k")
    a = split_exact(df.repartition(1), "k", 0.25, 7).filter("is_test").select("k")
    b = split_exact(df.repartition(17), "k", 0.25, 7).filter("is_test").select("k")
    assert a.count() == math.ceil(0.25 * 5000)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    flagged = split_exact(df, "k", 0.25, 7)
    assert flagged.count() == 5000
    assert flagged.select("k").distinct().count() == 5000


def test_exact_cut_multi_pass_matches_global_rank(spark):
    # a tiny boundary limit forces several refinement passes
    df = spark.range(0, 20000).withColumnRenamed("id", "k")
    cut = find_hash_cut(df, "k", 0.3, 42, max_boundary_rows=3)
    got = df.filter(cut.condition("k", 42)).count()
    assert got == math.ceil(0.3 * 20000)
    ref = (
        df.withColumn("h", F.md5(F.concat_ws("#", F.col("k").cast("string"), F.lit("42"))))
        .orderBy("h", "k")
        .limit(cut.n_test)
    )
    assert df.filter(cut.condition("k", 42)).select("k").exceptAll(ref.select("k")).count() == 0


def test_split_edge_fractions(spark):
    df = spark.range(0, 10).withColumnRenamed("id", "k")
    assert split_exact(df, "k", 0.0).filter("is_test").count() == 0
    assert split_exact(df, "k", 1.0).filter("is_test").count() == 10


def test_approx_split_is_narrow_and_close(spark):
    df = spark.range(0, 20000).withColumnRenamed("id", "k")
    flagged = split_approx(df, "k", 0.2)
    n = flagged.filter("is_test").count()
    assert abs(n - 4000) < 300
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_hash_folds_balanced(spark):
    df = spark.range(0, 10000).withColumnRenamed("id", "k")
    counts = {r["fold"]: r["count"] for r in hash_folds(df, "k", 5).groupBy("fold").count().collect()}
    assert sorted(counts) == [0, 1, 2, 3, 4]
    assert all(abs(c - 2000) < 200 for c in counts.values())


def test_contiguous_folds_block_sizes(spark):
    df = spark.range(0, 23).withColumnRenamed("id", "k").repartition(3)
    out = contiguous_folds(df, "k", 5).orderBy("k").collect()
    sizes = [sum(1 for r in out if r["fold"] == f) for f in range(5)]
    assert sizes == [5, 5, 5, 4, 4]
    # contiguous: fold never decreases along the key order
    folds = [r["fold"] for r in out]
    assert folds == sorted(folds)


def test_contiguous_folds_of_few_rows_and_null_key(spark):
    few = spark.createDataFrame([(i,) for i in range(3)], "k int")
    assert [r["fold"] for r in contiguous_folds(few, "k", 5).orderBy("k").collect()] == [0, 1, 2]
    empty = spark.createDataFrame([], "k int")
    assert contiguous_folds(empty, "k", 5).count() == 0
    null = spark.createDataFrame([(None,), (1,), (2,), (3,)], "k int")
    got = {r["k"]: r["fold"] for r in contiguous_folds(null, "k", 2).collect()}
    assert got == {None: 0, 1: 0, 2: 1, 3: 1}
