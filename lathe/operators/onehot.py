"""One-hot encoding with sorted categories and the first one dropped.

``fit_onehot`` finds the distinct non-missing values of each categorical
column with one partially aggregated ``distinct`` over (column, value) pairs;
the lists are small by contract and a cardinality guard stops a column with
more than ``max_categories`` values before anything large reaches the driver.

``OneHot.columns`` yields 0/1 double columns named ``<col>_<category>`` for
every category except the first in sorted order. An unseen or missing value
gives all zeros, the same encoding as the dropped category.

Columns with more categories than a table should have columns take the sparse
form: ``category_table`` keeps categories and their positions as a table, and
``sparse_onehot`` joins it, giving each row the sorted positions of its ones.
Nothing of it goes through the driver but one count per column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: First characters of a category by which positions are numbered in parts.
PREFIX = 3


@dataclass(frozen=True)
class OneHot:
    categories: dict[str, list[str]]
    drop_first: bool = True

    def kept(self, c: str) -> list[str]:
        cats = self.categories[c]
        return cats[1:] if self.drop_first else cats

    def names(self) -> list[str]:
        return [f"{c}_{v}" for c in self.categories for v in self.kept(c)]

    def columns(self) -> list[Column]:
        out = []
        for c in self.categories:
            for v in self.kept(c):
                out.append(F.when(F.col(c) == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0)).alias(f"{c}_{v}"))
        return out

    def apply(self, df: DataFrame) -> DataFrame:
        """Replace the categorical columns by indicator columns at the end."""
        keep = [c for c in df.columns if c not in self.categories]
        return df.select(*keep, *self.columns())


def fit_onehot(
    df: DataFrame, cols: list[str] | tuple[str, ...], drop_first: bool = True, max_categories: int = 1000
) -> OneHot:
    cols = list(cols)
    if not cols:
        return OneHot({}, drop_first)
    parts = [
        F.when(F.col(c).isNotNull(), F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v")))
        for i, c in enumerate(cols)
    ]
    pairs = (
        df.select(F.explode(F.filter(F.array(*parts), lambda x: x.isNotNull())).alias("e"))
        .select("e.i", "e.v")
        .distinct()
    )
    cap = (max_categories + 1) * len(cols)
    rows = pairs.limit(cap).collect()
    found: dict[int, list[str]] = {i: [] for i in range(len(cols))}
    for r in rows:
        found[r["i"]].append(r["v"])
    for i, c in enumerate(cols):
        if len(found[i]) > max_categories:
            raise ValueError(f"column {c!r} has more than {max_categories} categories: raise max_categories, or use the sparse form")
    return OneHot({c: sorted(found[i]) for i, c in enumerate(cols)}, drop_first)


def fit_onehot_without(
    df: DataFrame, cols: list[str], fold: str, folds: list[int], drop_first: bool = True, max_categories: int = 1000
) -> dict[int, OneHot]:
    """{fold: the categories of all other folds' rows}, from one ``distinct`` over (column, value, fold)."""
    if not cols:
        return {f: OneHot({}, drop_first) for f in folds}
    each = F.array_compact(F.array(*[F.when(F.col(f"`{c}`").isNotNull(), F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").cast("string").alias("v"))) for i, c in enumerate(cols)]))
    met = df.select(F.col(f"`{fold}`").cast("int").alias("f"), F.explode(each).alias("e")).select("f", "e.i", "e.v")
    by_value = met.groupBy("i", "v").agg(F.collect_set("f").alias("folds"))  # at most one entry a fold
    found: dict[int, list] = {i: [] for i in range(len(cols))}
    for r in by_value.limit((max_categories + 1) * len(cols)).collect():
        found[r["i"]].append((r["v"], set(r["folds"])))
    for i, c in enumerate(cols):
        if len(found[i]) > max_categories:
            raise ValueError(f"column {c!r} has more than {max_categories} categories: raise max_categories, or use the sparse form")
    return {f: OneHot({c: sorted(v for v, seen in found[i] if seen - {f}) for i, c in enumerate(cols)}, drop_first) for f in folds}


def category_table(df: DataFrame, cols: list[str] | tuple[str, ...]) -> DataFrame:
    """(column_name, category, position): distinct values in sorted order, numbered from 0 within each column.

    Numbers are given inside parts of equal prefix; the parts' offsets are summed up first."""
    each = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("category")) for c in cols])
    pairs = df.select(F.explode(each).alias("e")).select("e.*").where("category is not null").distinct()
    pairs = pairs.withColumn("_part", F.substring("category", 1, PREFIX))
    sizes = pairs.groupBy("column_name", "_part").agg(F.count("*").alias("_n"))
    before = sizes.select("column_name", "_part", (F.sum("_n").over(Window.partitionBy("column_name").orderBy("_part")) - F.col("_n")).alias("_before"))
    own = F.row_number().over(Window.partitionBy("column_name", "_part").orderBy("category")) - 1
    return pairs.withColumn("_own", own).join(before, ["column_name", "_part"]).select("column_name", "category", (F.col("_own") + F.col("_before")).alias("position"))


def sparse_onehot(df: DataFrame, cols: list[str] | tuple[str, ...], table: DataFrame, drop_first: bool = True) -> DataFrame:
    """``df`` without ``cols``, with ``n_dims`` and ``ones``: the sorted positions, over all columns, that hold a one.

    Columns follow each other in the given order. Unknown and missing values, and
    with ``drop_first`` each column's first category, have no one."""
    skip = int(drop_first)
    widths = {r["column_name"]: max(0, r["n"] - skip) for r in table.groupBy("column_name").agg(F.count("*").alias("n")).collect()}
    out, at, ones = df, 0, []
    for i, c in enumerate(cols):
        own = table.where(F.col("column_name") == c).select(F.col("category").alias(f"_c{i}"), F.col("position").alias(f"_p{i}"))
        out = out.join(own, F.col(f"`{c}`").cast("string") == F.col(f"_c{i}"), "left")
        ones.append(F.when(F.col(f"_p{i}") >= skip, F.col(f"_p{i}") - skip + at))
        at += widths.get(c, 0)
    keep = [F.col(f"`{c}`") for c in df.columns if c not in cols]
    return out.select(*keep, F.lit(at).cast("long").alias("n_dims"), F.array_compact(F.array(*ones)).alias("ones"))
