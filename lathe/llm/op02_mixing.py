"""Mixing sources to target weights by Poisson replication.

Each source has a target repetition rate: its target weight times the size of
the mixture, over its own size (UTF-8 bytes, all rows counted). A document's
number of copies inverts the Poisson distribution with that mean at a uniform
number from the md5 of seed and id, so it is the same in every run and engine.
Rates above ``PIECE`` are a sum of several such draws. Copies are exploded, and a
hash of id and copy number, uniform by itself, is their place in the global
shuffle: its range is cut evenly, so no sample is needed to balance it.

Null sources are a source of their own. Null and empty texts count as 0 bytes
and are copied like any other row; a source of 0 bytes keeps each row once.
Sources without a target have weight 0 if ``weights`` are given, and else a share
by size to the power ``temper``. Equal ids draw equal numbers; a row without
an id draws by the md5 of its text. Empty tables give empty results; every
column of the rows is kept, but for those with the names of the four added ones
(rate, copies, copy, place), which these replace.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathe.llm.common import small_enough, unit

#: The largest mean of one draw: exp(-PIECE) is far from underflow.
PIECE = 500.0


def source_rates(documents: DataFrame, weights: dict[str, float] | None = None, size: float = 1.0, temper: float = 0.5, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(source, bytes, rate): the mean copies of a source's documents, for a mixture of ``size`` times the input."""
    docs = documents.select(F.col(f"`{source_col}`").alias("source"), F.coalesce(F.octet_length(f"`{text_col}`"), F.lit(0)).cast("long").alias("b"))
    by = docs.groupBy("source").agg(F.sum("b").alias("bytes"))
    if weights is None:
        weighted = by.withColumn("w", F.pow(F.col("bytes").cast("double"), F.lit(float(temper))))
    else:
        w = F.lit(0.0)
        for name, x in weights.items():
            w = F.when(F.col("source") == name, float(x)).otherwise(w)
        weighted = by.withColumn("w", w)
    total = weighted.agg(F.sum("w").alias("w"), F.sum("bytes").alias("b")).first()
    rate = F.lit(float(size)) * F.col("w") / F.lit(total.w or None) * F.lit(total.b) / F.col("bytes")
    return weighted.select("source", "bytes", F.when(F.col("bytes") > 0, F.coalesce(rate, F.lit(0.0))).otherwise(F.lit(1.0)).alias("rate"))


def poisson_steps(rate: Column) -> Column:
    """The distribution's values at 0, 1, 2, ... up to where it is 1 in double precision."""
    most = F.ceil(rate + 12 * F.sqrt(rate) + 24).cast("int")
    start = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("c"), F.array(F.exp(-rate)).alias("a"))

    def step(s: Column, k: Column) -> Column:
        p = s["p"] * rate / k
        return F.struct(p.alias("p"), (s["c"] + p).alias("c"), F.concat(s["a"], F.array(s["c"] + p)).alias("a"))

    return F.aggregate(F.sequence(F.lit(1), most), start, step, lambda s: s["a"])


def mixed(
    documents: DataFrame, weights: dict[str, float] | None = None, size: float = 1.0, temper: float = 0.5, seed: str = "mix", id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", partition_bytes: int = 64 << 20,
) -> DataFrame:
    """The rows times their copies, dealt to places of a global shuffle: all columns and rate, copies, copy, place."""
    rates = source_rates(documents, weights, size, temper, source_col, text_col).cache()
    total = rates.agg(F.sum(F.col("bytes") * F.col("rate"))).first()[0] or 0
    draws = F.greatest(F.ceil(F.col("rate") / PIECE), F.lit(1)).cast("int")
    steps = rates.select(F.col("source").alias("_source"), F.col("rate").alias("_rate"), draws.alias("_draws"), poisson_steps(F.col("rate") / draws).alias("_steps"))
    rates.unpersist()
    documents = documents.drop("rate", "copies", "copy", "place")
    key = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.md5(F.col(f"`{text_col}`")), F.lit(""))
    rows = documents.join(small_enough(steps, 10_000), documents[source_col].eqNullSafe(F.col("_source")))
    first = F.size(F.filter("_steps", lambda c: c <= unit(key, seed)))
    more = F.aggregate(F.sequence(F.lit(1), F.col("_draws") - 1), F.lit(0), lambda n, j: n + F.size(F.filter("_steps", lambda c: c <= unit(F.concat(key, F.lit("+"), j.cast("string")), seed))))
    copies = F.when(F.col("_draws") > 1, first + more).otherwise(first)
    rows = rows.select(*[documents[c] for c in documents.columns], F.col("_rate").alias("rate"), copies.alias("copies")).where("copies > 0")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    rows = rows.withColumn("place", unit(F.concat(key, F.lit("#"), F.col("copy").cast("string")), seed + "-place"))
    parts = int(total // partition_bytes) + 1
    parts = max(parts, int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartitionById(parts, F.floor(F.col("place") * parts).cast("int")).sortWithinPartitions("place", id_col, "copy")
