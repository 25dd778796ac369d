"""Input tables and the per-order feature table used as the housing stand-in.

``order_features`` builds one row per order (unique key ``o_orderkey``):

| housing role        | column          | definition                              |
| ------------------- | --------------- | --------------------------------------- |
| longitude/latitude  | avg_disc/avg_tax| avg(l_discount), avg(l_tax)             |
| total_rooms         | sum_qty         | sum(l_quantity)                         |
| total_bedrooms      | returned_qty    | sum(l_quantity) of returned lines, NULL if none |
| population          | n_supp          | count(distinct l_suppkey)               |
| households          | n_lines         | count(*)                                |
| median_income       | c_acctbal       | customer balance                        |
| median_house_value  | o_totalprice    | label                                   |
| ocean_proximity     | o_orderpriority | 5 categories                            |

Orders without lines keep NULL line aggregates (natural missing values).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.roles import Roles

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

ORDER_ROLES = Roles(
    key="o_orderkey",
    label="o_totalprice",
    numeric=("avg_disc", "avg_tax", "sum_qty", "returned_qty", "n_supp", "n_lines", "c_acctbal"),
    categorical=("o_orderpriority",),
)

# Ratio features by name (the intended housing ratios):
# rooms/households, population/households, bedrooms/rooms.
ORDER_RATIOS = {
    "rooms_per_household": ("sum_qty", "n_lines"),
    "population_per_household": ("n_supp", "n_lines"),
    "bedrooms_per_room": ("returned_qty", "sum_qty"),
}


#: Lines that one task groups: each takes some hundred bytes there.
LINES_PER_TASK = 500_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def line_partitions(lineitem: DataFrame) -> int:
    """Tasks that the lines' groups are spread over: as many as the table's rows ask for (files tell their rows without a scan)."""
    return max(lineitem.sparkSession.sparkContext.defaultParallelism, -(-lineitem.count() // LINES_PER_TASK))


def line_aggregates(lineitem: DataFrame, tasks: int | None = None) -> DataFrame:
    """Per-order line aggregates, skew-safe.

    Two grouping levels instead of one ``count(distinct)``: level one groups by
    (order, supplier), which spreads a hot order over tasks, level two by order,
    to which an order comes with a row a supplier. Hardly two lines share order
    and supplier, so a map-side partial aggregate would hold every row of its
    input; rows are dealt to a number of tasks that grows with the table
    instead, and each aggregate holds a bounded number of groups.
    """
    tasks = tasks or line_partitions(lineitem)
    per_supp = lineitem.repartition(tasks, "l_orderkey", "l_suppkey").groupBy("l_orderkey", "l_suppkey").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("l_quantity").alias("_q"),
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))).alias("_rq"),
        F.sum("l_discount").alias("_d"),
        F.sum("l_tax").alias("_t"),
    )
    per_order = per_supp.repartition(tasks, "l_orderkey").groupBy("l_orderkey").agg(
        F.sum("_n").alias("n_lines"),
        F.count(F.lit(1)).alias("n_supp"),
        F.sum("_q").alias("sum_qty"),
        F.sum("_rq").alias("returned_qty"),
        F.sum("_d").alias("_d"),
        F.sum("_t").alias("_t"),
    )
    return per_order.select(
        "l_orderkey",
        (F.col("_d") / F.col("n_lines")).alias("avg_disc"),
        (F.col("_t") / F.col("n_lines")).alias("avg_tax"),
        "sum_qty",
        "returned_qty",
        "n_supp",
        "n_lines",
    )


def order_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders LEFT JOIN line aggregates LEFT JOIN customer; one row per order.

    The line aggregate is already hash-partitioned on the order key, and
    ``orders`` is dealt to the same number of tasks, so nothing else moves for
    the first join; ``customer`` is broadcast only when AQE measures it under the
    broadcast threshold, otherwise a sort-merge join runs with AQE skew
    splitting for hot customers.
    """
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"
    )
    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag"
    )
    tasks = line_partitions(lineitem)
    lines = line_aggregates(lineitem, tasks)
    orders = orders.repartition(tasks, "o_orderkey")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    joined = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").join(
        customer, F.col("o_custkey") == F.col("c_custkey"), "left"
    )
    return joined.select(
        "o_orderkey",
        "avg_disc",
        "avg_tax",
        "sum_qty",
        "returned_qty",
        "n_supp",
        "n_lines",
        "c_acctbal",
        "o_totalprice",
        "o_orderpriority",
    )


def part_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A learnable fixture: p_retailprice is a function of p_partkey."""
    return read_table(spark, sf_dir, "part").select(
        "p_partkey", "p_size", "p_brand", "p_retailprice"
    )
