"""Dataset profiles: row/element counts, missing flags, signature, digest.

All in one aggregation pass per table; the digest is an order-free sum of a
per-row md5, so it does not depend on partitioning or row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TWO_64 = "18446744073709551616"


def _double_text(d: Column) -> Column:
    """A text that every engine makes of a double: millionths as a whole number where that fits a long.

    From 2^43 on, values step by more than a millionth: they are told by two
    whole numbers after an exact scaling by 2^-40 as often as needed.
    """
    size = F.abs(d)
    times = F.greatest(F.floor((F.log2(size) - 53) / 40), F.lit(0))
    v = d * F.pow(F.lit(2.0), times * -40)
    high = F.floor(v / F.lit(2.0**40))
    low = F.floor((v - high * F.lit(2.0**40)) * F.lit(1024.0))
    large = F.concat_ws("e", times.cast("string"), high.cast("string"), low.cast("string"))
    odd = F.when(F.isnan(d) | (size == F.lit(float("inf"))), d.cast("string"))
    return odd.when(size < F.lit(2.0**43), F.round(d * F.lit(1e6)).cast("long").cast("string")).otherwise(large)


def _row_token(f: T.StructField) -> Column:
    """A text that ends by itself: numbers up to a semicolon, strings after their length, ``-;`` for NULL. No two rows of values have one text."""
    c = F.col(f"`{f.name}`")
    if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
        # never hash a double's own text form: engines print doubles differently
        text = F.concat(_double_text(c.cast("double")), F.lit(";"))
    elif isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)):
        text = F.concat(c.cast("string"), F.lit(";"))
    else:
        text = F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string"))
    return F.when(c.isNull(), F.lit("-;")).otherwise(text)


def row_digest_expr(df: DataFrame) -> Column:
    text = F.concat(*[_row_token(f) for f in df.schema.fields])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")


def dataset_profile(df: DataFrame) -> DataFrame:
    """One row: num_rows, num_elements, digest (order-free, mod 2^64)."""
    ncols = len(df.columns)
    return df.agg(
        F.count(F.lit(1)).alias("num_rows"),
        (F.count(F.lit(1)) * F.lit(ncols)).cast("long").alias("num_elements"),
        F.pmod(F.coalesce(F.sum(row_digest_expr(df)), F.lit(0).cast("decimal(38,0)")), F.lit(TWO_64).cast("decimal(38,0)"))
        .cast("decimal(38,0)")
        .cast("string")
        .alias("digest"),
    )


def column_profile(df: DataFrame) -> DataFrame:
    """Per column: position, name, type, rows, non-missing rows, has_missing."""
    fields = df.schema.fields
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.col(f.name)).alias(f"c{i}") for i, f in enumerate(fields)])
    stacked = row.select(
        F.col("_n"),
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("position"),
                        F.lit(f.name).alias("column_name"),
                        F.lit(f.dataType.simpleString()).alias("data_type"),
                        F.col(f"c{i}").alias("n_non_null"),
                    )
                    for i, f in enumerate(fields)
                ]
            )
        ).alias("p"),
    )
    return stacked.select(
        F.col("p.position").cast("long").alias("position"),
        "p.column_name",
        "p.data_type",
        F.col("_n").alias("n_rows"),
        F.col("p.n_non_null").alias("n_non_null"),
        (F.col("p.n_non_null") < F.col("_n")).alias("has_missing"),
    )


def signature(df: DataFrame, exclude: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Model input signature: ordered (position, name, type, required)."""
    skip = set(exclude)
    prof = column_profile(df.select(*[c for c in df.columns if c not in skip]))
    return prof.select("position", "column_name", "data_type", (~F.col("has_missing")).alias("required"))


def check_signature(expected: list[tuple[str, str]], df: DataFrame) -> None:
    """Raise when ``df`` lacks a signature column or has it with another type."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    bad = [(n, t, have.get(n)) for n, t in expected if have.get(n) != t]
    if bad:
        raise ValueError(f"input does not match the model signature: {bad}")


def signature_rules(expected: list[tuple[str, str, bool]], df: DataFrame) -> list[tuple[str, str, Column]]:
    """(column, rule, condition of a row that breaks it) of a signature's (name, type, required) entries.

    ``missing``: the table lacks the column; ``type``: a value that can't be
    read as the type; ``required``: no value.
    """
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    out = []
    for name, kind, required in expected:
        if name not in have:
            out.append((name, "missing", F.lit(True)))
            continue
        c = F.col(f"`{name}`")
        if have[name] != kind:
            out.append((name, "type", c.isNotNull() & c.cast("string").try_cast(kind).isNull()))
        if required:
            empty = c.isNull() | F.isnan(c) if have[name] in ("double", "float") else c.isNull()
            out.append((name, "required", empty))
    return out


def set_apart(expected: list[tuple[str, str, bool]], df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that keep the signature, read as its types, and the others with ``violations``: one condition per rule, no extra pass."""
    broken = F.array_compact(F.array(*[F.when(bad, F.concat(F.lit(name), F.lit(":"), F.lit(rule))) for name, rule, bad in signature_rules(expected, df)]))
    marked = df.withColumn("violations", broken)
    kinds = {name: kind for name, kind, _ in expected}
    good = marked.where(F.size("violations") == 0)
    return good.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in df.columns]), marked.where(F.size("violations") > 0)


def signature_violations(expected: list[tuple[str, str, bool]], df: DataFrame) -> DataFrame:
    """(column_name, rule, n_rows) of every rule, counted in one pass."""
    rules = signature_rules(expected, df)
    row = df.agg(F.count("*").alias("n"), *[F.count_if(bad).alias(f"v{k}") for k, (_, _, bad) in enumerate(rules)])
    each = [F.struct(F.lit(name).alias("column_name"), F.lit(rule).alias("rule"), F.col(f"v{k}").alias("n_rows")) for k, (name, rule, _) in enumerate(rules)]
    return row.select(F.explode(F.array(*each)).alias("e")).select("e.*")


def input_example(df: DataFrame, key: str, positions: tuple[int, ...] = (0, 50, 100)) -> DataFrame:
    """Rows at the given 0-based positions in key order.

    A distributed top-k (``orderBy(key).limit(max+1)``) bounds the rows, then
    a window numbers at most ``max(positions) + 1`` rows.
    """
    from pyspark.sql import Window

    top = df.orderBy(key).limit(max(positions) + 1)
    ranked = top.withColumn("_pos", F.row_number().over(Window.orderBy(key)) - 1)
    return ranked.filter(F.col("_pos").isin(*positions)).drop("_pos")
