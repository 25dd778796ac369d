"""Small expression helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_double_nullable(c: str | Column) -> Column:
    """Cast to double and turn NaN into NULL (NaN means missing here)."""
    col = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.when(F.isnan(col), F.lit(None).cast("double")).otherwise(col)


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 or either side is NULL (never raises)."""
    return F.try_divide(num, den)


def round_doubles(df: DataFrame, digits: int = 6, overrides: dict[str, int] | None = None) -> DataFrame:
    """Round every double column; used only at the edge of checked queries."""
    overrides = overrides or {}
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name), overrides.get(f.name, digits)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
