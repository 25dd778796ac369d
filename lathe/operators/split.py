"""Hold-out splits and k-fold assignment by seeded key hash.

Every row gets ``h = md5(key#seed)``. The order of ``(h, key)`` is a seeded
shuffle that does not depend on partitioning, file layout or engine.

* ``split_approx``: test iff the first 32 bits of ``h`` fall under
  ``fraction * 2**32``. One narrow filter, no shuffle, no extra pass.
* ``split_exact``: test = the ``ceil(fraction * n)`` smallest ``(h, key)``
  pairs, the exact sizes a shuffle-then-cut split gives. The cut point is
  found with a few histogram passes over hash prefixes (each returns at most
  4,096 counts to the driver); only a bounded boundary bucket is sorted.
  The split itself is again a narrow filter against that cut.
* ``hash_folds``: fold = hash digits 9..16 mod k (independent of the split).
* ``contiguous_folds``: folds as contiguous blocks in key order with the
  block sizes of an unshuffled k-fold (first ``n mod k`` folds one larger).
  A distributed row number over the key column alone gives the first key of
  each block; the folds are then a narrow comparison with those keys.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathe.functions.hashing import hash_fold, key_hash, key_hash_u32
from lathe.session import ensure_checkpoint_dir

HASH_COL = "_h"
TWO_32 = 4294967296


def approx_threshold(fraction: float) -> int:
    return int(math.floor(fraction * TWO_32))


def split_approx(df: DataFrame, key: str, fraction: float, seed: int = 42, flag: str = "is_test") -> DataFrame:
    """Add a boolean ``flag``: True for the (about) ``fraction`` test rows."""
    return df.withColumn(flag, key_hash_u32(key, seed) < F.lit(approx_threshold(fraction)))


@dataclass(frozen=True)
class HashCut:
    """The k-th smallest (hash, key) pair; rows <= it form the test part."""

    n_rows: int
    n_test: int
    hash_value: str | None
    key_value: object
    key_type: str = "bigint"

    def condition(self, key: str, seed: int) -> Column:
        if self.n_test <= 0 or self.hash_value is None:
            return F.lit(False)
        # one lexicographic comparison: the hash is computed once per row
        row = F.struct(key_hash(key, seed).alias("h"), F.col(key).alias("k"))
        cut = F.struct(F.lit(self.hash_value).alias("h"), F.lit(self.key_value).cast(self.key_type).alias("k"))
        return row <= cut


def find_hash_cut(
    df: DataFrame,
    key: str,
    fraction: float | None = None,
    seed: int = 42,
    n_test: int | None = None,
    digits_per_pass: int = 3,
    max_boundary_rows: int = 50_000,
) -> HashCut:
    """Locate the exact cut with histogram passes over hash prefixes.

    Pass 1 counts rows per 3-hex-digit prefix (this also yields ``n``). The
    prefix bucket containing the cut becomes the new search range; further
    passes refine it by 3 more digits, each dividing the range by 4,096,
    until the boundary bucket has at most ``max_boundary_rows`` rows. That
    bounded bucket is sorted to pick the exact cut row.
    """
    keyed = df.select(F.col(key), key_hash(key, seed).alias(HASH_COL))
    prefix = ""
    need: int | None = None
    n_rows = 0
    while True:
        plen = len(prefix) + digits_per_pass
        scope = keyed if not prefix else keyed.filter(F.col(HASH_COL).startswith(prefix))
        hist = sorted(
            (r[0], r[1])
            for r in scope.groupBy(F.substring(HASH_COL, 1, plen).alias("b")).count().collect()
        )
        if need is None:
            n_rows = sum(c for _, c in hist)
            need = n_test if n_test is not None else int(math.ceil(fraction * n_rows))
            need = max(0, min(need, n_rows))
            if need == 0:
                return HashCut(n_rows, 0, None, None)
        before = 0
        bucket, bucket_count = hist[-1]
        for b, c in hist:
            if before + c >= need:
                bucket, bucket_count = b, c
                break
            before += c
        need -= before
        prefix = bucket
        if bucket_count <= max_boundary_rows or plen >= 32:
            break
    row = (
        keyed.filter(F.col(HASH_COL).startswith(prefix))
        .orderBy(HASH_COL, key)
        .offset(need - 1)
        .limit(1)
        .collect()[0]
    )
    total_test = n_test if n_test is not None else int(math.ceil(fraction * n_rows))
    key_type = df.schema[key].dataType.simpleString()
    return HashCut(n_rows, min(total_test, n_rows), row[HASH_COL], row[key], key_type)


def split_exact(
    df: DataFrame, key: str, fraction: float, seed: int = 42, flag: str = "is_test", **kw
) -> DataFrame:
    """Exact-size split: ``ceil(fraction * n)`` test rows (key must be unique)."""
    cut = find_hash_cut(df, key, fraction, seed, **kw)
    return df.withColumn(flag, cut.condition(key, seed))


def split_data(
    df: DataFrame, key: str, test_size: float, seed: int = 42, exact: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(train, test) as two filters of one flagged DataFrame."""
    flagged = split_exact(df, key, test_size, seed) if exact else split_approx(df, key, test_size, seed)
    return flagged.filter(~F.col("is_test")).drop("is_test"), flagged.filter(F.col("is_test")).drop("is_test")


def hash_folds(df: DataFrame, key: str, k: int = 5, seed: int = 42, fold_col: str = "fold") -> DataFrame:
    return df.withColumn(fold_col, hash_fold(key, seed, k))


def fold_of_position(pos: Column, n: int, k: int) -> Column:
    """Block id of 0-based position ``pos`` for n rows in k contiguous folds."""
    q, r = divmod(n, k)
    big = r * (q + 1)
    if q == 0:
        return pos.cast("int")
    return F.when(pos < big, F.floor(pos / (q + 1))).otherwise(
        F.lit(r) + F.floor((pos - big) / q)
    ).cast("int")


def global_positions(df: DataFrame, order_col: str, pos_col: str = "_pos") -> tuple[DataFrame, int]:
    """0-based position of each row in ``order_col`` order, computed distributedly.

    The sorted, id-tagged table is checkpointed so the per-partition counts
    and the final positions are computed over one fixed layout, even if
    executors are lost in between.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)  # the session's shared folder; a scratch one only if unset
    tagged = (
        df.repartitionByRange(F.col(order_col))
        .sortWithinPartitions(order_col)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    counts = sorted((r["_pid"], r["count"]) for r in tagged.groupBy("_pid").count().collect())
    offsets, run = [], 0
    for pid, c in counts:
        offsets.append((pid, run))
        run += c
    off_df = spark.createDataFrame(offsets, "_pid int, _off long")
    # one row per partition: a bounded table, broadcast by construction
    pos = F.col("_off") + (F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33))
    out = tagged.join(F.broadcast(off_df), "_pid").withColumn(pos_col, pos).drop("_pid", "_mid", "_off")
    return out, run


def contiguous_folds(df: DataFrame, order_col: str, k: int = 5, fold_col: str = "fold") -> DataFrame:
    """Unshuffled k-fold: contiguous blocks in ``order_col`` order.

    Only the key column is sorted; the k - 1 block starts come to the driver and
    every row is compared with them. ``order_col`` must be unique and not null
    for exact block sizes (equal keys share a fold, a null key is in fold 0).
    """
    positioned, n = global_positions(df.select(order_col), order_col)
    block = fold_of_position(F.col("_pos"), n, k)
    starts = positioned.groupBy(block.alias("b")).agg(F.min(order_col).alias("first")).where("b > 0").collect()
    key_type = df.schema[order_col].dataType
    after = [F.when(F.col(order_col) >= F.lit(r["first"]).cast(key_type), 1).otherwise(0) for r in starts]
    return df.withColumn(fold_col, sum(after, F.lit(0)).cast("int"))
