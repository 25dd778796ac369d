"""Column roles: key, label, numeric and categorical features.

Spark has no row index, so a unique key column replaces it everywhere: the
label, the split flag, the fold id and every prepared feature travel in the
same row, and nothing is ever re-aligned by position.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class Roles:
    key: str
    label: str | None
    numeric: tuple[str, ...]
    categorical: tuple[str, ...] = field(default_factory=tuple)

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric + self.categorical

    def passthrough(self, df: DataFrame) -> list[str]:
        """Columns that are neither numeric nor categorical features."""
        feats = set(self.features)
        return [c for c in df.columns if c not in feats]


def numeric_by_schema(df: DataFrame, exclude: list[str] | tuple[str, ...] = ()) -> list[str]:
    """Numeric columns by data type, in schema order (label/key excluded)."""
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def roles_from_schema(df: DataFrame, key: str, label: str | None, categorical: list[str]) -> Roles:
    """Numeric list = every column except key, label and the categorical list."""
    cats = tuple(categorical)
    skip = {key, label, *cats}
    missing = [c for c in (key, label, *cats) if c is not None and c not in df.columns]
    if missing:
        raise ValueError(f"columns not in table: {missing}")
    numeric = tuple(c for c in df.columns if c not in skip)
    return Roles(key=key, label=label, numeric=numeric, categorical=cats)
