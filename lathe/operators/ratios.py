"""Ratio features appended by column name.

``ratio_features(df, {"rooms_per_household": ("total_rooms", "households")})``
appends ``numerator / denominator``; a zero or missing denominator gives NULL
(``try_divide``) instead of an error, or raises in ``strict`` mode.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathe.functions.exprs import safe_ratio

# Fixed names of the housing ratios (intended columns, by name).
HOUSING_RATIOS = {
    "rooms_per_household": ("total_rooms", "households"),
    "population_per_household": ("population", "households"),
    "bedrooms_per_room": ("total_bedrooms", "total_rooms"),
}


def ratio_columns(
    ratios: Mapping[str, tuple[str, str]],
    source: Callable[[str], Column] | None = None,
    strict: bool = False,
) -> list[Column]:
    src = source or (lambda c: F.col(c).cast("double"))
    out = []
    for name, (num, den) in ratios.items():
        n, d = src(num), src(den)
        if strict:
            expr = F.when(d == 0, F.raise_error(F.lit(f"zero denominator in {name}"))).otherwise(n / d)
        else:
            expr = safe_ratio(n, d)
        out.append(expr.cast("double").alias(name))
    return out


def ratio_features(
    df: DataFrame,
    ratios: Mapping[str, tuple[str, str]],
    add_bedrooms_per_room: bool = True,
    strict: bool = False,
) -> DataFrame:
    """Append ratio columns at the end.

    ``add_bedrooms_per_room=False`` drops a ratio named ``bedrooms_per_room``
    (the flag of the housing pipeline); other names are always added.
    """
    chosen = {k: v for k, v in ratios.items() if add_bedrooms_per_room or k != "bedrooms_per_room"}
    missing = sorted({c for pair in chosen.values() for c in pair} - set(df.columns))
    if missing:
        raise ValueError(f"ratio inputs not in table: {missing}")
    return df.select("*", *ratio_columns(chosen, strict=strict))
