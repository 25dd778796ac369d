"""Spark session helpers.

The library never creates its own cluster settings for production use: on a
cluster the session is handed in by the caller. ``local_session`` is the
convenience used by tests, the bench and the driver contract.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder of the session, setting one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder; it is read,
    never overridden. Where nothing is configured a local session (tests) gets
    a fresh scratch folder; on a cluster that is an error, since executors
    could not read each other's files.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="lathe-ckpt-", dir=os.environ.get("LATHE_SCRATCH", "/tmp"))
    sc.setCheckpointDir(local)
    return local


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "lathe") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def materialize(df, how: str = "persist"):
    """Fix a table that several passes will read.

    ``persist``: memory and disk on the executors; lost blocks are recomputed
    from lineage. ``checkpoint``: written to the session's checkpoint folder
    (the cluster's shared ``spark.checkpoint.dir``), which cuts the lineage,
    for long jobs where recomputation after an executor loss would be costly.
    ``none``: leave the plan as it is.
    """
    from pyspark import StorageLevel

    if how == "checkpoint":
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    if how == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if how == "none":
        return df
    raise ValueError(f"unknown materialization {how!r}")


def stored(df):
    """The table written to the session's shared folder and read back: lineage ends there."""
    import uuid

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
