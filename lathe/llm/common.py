"""Helpers shared by the corpus operators: shared scratch tables, checked broadcasts, text batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a slim table (keys and a few numbers) that may be broadcast, after they were counted.
BROADCAST_ROWS = 200_000
#: Bytes of one Arrow batch handed to a Python worker; a longer single text is a batch of its own.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder under the shared folder that ``spark.checkpoint.dir`` names.

    Where the setting is empty a local session gets a folder of its own; on a
    cluster that is an error, since executors could not see each other's files.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="lathe-llm-")
        sc.setCheckpointDir(base)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here, lost executors cost nothing above it."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows (counted), else as it is, for a shuffle join."""
    n = df.limit(rows + 1).count()
    return F.broadcast(df) if n <= rows else df


def arrow_batches(spark: SparkSession, max_bytes: int = BATCH_BYTES) -> None:
    """Bound the Arrow batches by bytes, so that very long texts don't pile up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(max_bytes))


def texts_of(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """The column as large strings, null as empty."""
    col = batch.column(batch.schema.get_field_index(name)).cast(pa.large_string())
    return col.fill_null("") if col.null_count else col


def blocks(texts: pa.Array, max_bytes: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``max_bytes`` of text each, or a single longer row."""
    if not len(texts):
        return
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(ends, ends[at] + max_bytes, "right")) - 1
        to = min(max(to, at + 1), len(texts))
        yield at, to
        at = to


def unit(key: Column, seed: str) -> Column:
    """A number in [0, 1) from the md5 of ``seed#key``: 52 bits, the same in every engine."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + "#"), key.cast("string"))), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def only(df: DataFrame, **cols: str) -> DataFrame:
    """The named columns under private names, whatever else the table holds: ``only(df, _id="doc_id")``."""
    return df.select(*[F.col(f"`{v}`").alias(k) for k, v in cols.items()])
