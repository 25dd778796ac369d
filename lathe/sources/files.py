"""File sources and sinks: headered CSV, Parquet, landing tables, predictions.

* ``read_csv``: headered CSV with an explicit schema, or with types inferred
  from every row of every file (``infer_schema``: one aggregate over all
  columns); empty fields are missing, and NaN in double columns is turned
  into NULL so every operator sees one kind of missing value.
* ``load_labelled``: a table plus its roles; the label is optional.
* ``write_table``: overwrite a prepared table (label kept in the row).
* ``land_once``: write a table only if it is not there yet (mode "ignore").
* ``write_predictions``: per-model prediction tables, one folder per model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lathe.functions.exprs import to_double_nullable


def normalize_missing(df: DataFrame) -> DataFrame:
    """NaN -> NULL in every floating column (NULL is the only missing value)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(to_double_nullable(f.name).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def infer_schema(spark: SparkSession, path: str) -> T.StructType:
    """The narrowest of boolean, bigint, double and string that holds every value of a column; string without any.

    All rows decide, in one pass: how many values of each column there are and
    how many each type can read.
    """
    text = spark.read.option("header", True).option("escape", '"').option("mode", "FAILFAST").csv(path)
    kinds = [T.BooleanType(), T.LongType(), T.DoubleType()]
    aggs = []
    for i, c in enumerate(text.columns):
        v = F.col(f"`{c}`")
        reads = [v.rlike("(?i)^\\s*(true|false)\\s*$"), v.try_cast("bigint").isNotNull(), v.try_cast("double").isNotNull()]
        aggs += [F.count(v).alias(f"n{i}"), *[F.count_if(r).alias(f"k{i}_{j}") for j, r in enumerate(reads)]]
    row = text.agg(*aggs).first() if aggs else None
    fields = []
    for i, c in enumerate(text.columns):
        fits = [k for j, k in enumerate(kinds) if row[f"n{i}"] and row[f"k{i}_{j}"] == row[f"n{i}"]]
        fields.append(T.StructField(c, fits[0] if fits else T.StringType()))
    return T.StructType(fields)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read.option("header", True).option("escape", '"').option("mode", "FAILFAST").option("nanValue", "NaN")
    return normalize_missing(reader.schema(schema if schema is not None else infer_schema(spark, path)).csv(path))


def read_table_file(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    if fmt == "csv":
        return read_csv(spark, path, schema)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return normalize_missing(reader.format(fmt).load(path))


def load_labelled(
    spark: SparkSession, path: str, target_col: str | None = None, fmt: str = "parquet"
) -> tuple[DataFrame, list[str]]:
    """The table and its feature names; with no target every column is a feature."""
    df = read_table_file(spark, path, fmt)
    if target_col is not None and target_col not in df.columns:
        raise ValueError(f"target column {target_col!r} not in {path}")
    feats = [c for c in df.columns if c != target_col]
    return df, feats


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')  # a quote inside quotes is doubled
    writer.format(fmt).save(path)


def land_once(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Write ``df`` to ``path`` unless a table is already there; return the stored table."""
    write_table(df, path, fmt, mode="ignore")
    return read_table_file(df.sparkSession, path, fmt)


def write_predictions(scored: DataFrame, path: str, model_col: str = "model", fmt: str = "parquet") -> None:
    """Per-model prediction tables: one partition folder per model name."""
    writer = scored.write.mode("overwrite").partitionBy(model_col)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')  # a quote inside quotes is doubled
    writer.format(fmt).save(path)
