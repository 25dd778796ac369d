"""Model persistence: MLlib pipelines, closed-form models and forests as files.

MLlib ``PipelineModel``s use MLlib's own writer. ``LinearModel`` and the
group-mean model are small: a JSON document (and, for group means, a parquet
table of the means, which can be large for a high-cardinality grouping). A
forest is a JSON document with two parquet tables: the trees' tops and the
subtrees below them.
"""

from __future__ import annotations

import json
import os

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from lathe.operators.baseline import GroupMeanModel
from lathe.operators.forest import ForestModel, Top
from lathe.operators.linear import LinearModel


def _hadoop_write_text(spark: SparkSession, path: str, text: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def _hadoop_read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r[0] for r in spark.read.text(path).collect())


def save_model(spark: SparkSession, model, path: str) -> None:
    if isinstance(model, PipelineModel):
        model.write().overwrite().save(path)
        return
    if isinstance(model, LinearModel):
        meta = {"kind": "linear", "features": list(model.features), "coef": list(model.coef), "intercept": model.intercept}
        _hadoop_write_text(spark, os.path.join(path, "meta"), json.dumps(meta))
        return
    if isinstance(model, GroupMeanModel):
        meta = {"kind": "group_mean", "group_by": list(model.group_by), "global_mean": model.global_mean}
        _hadoop_write_text(spark, os.path.join(path, "meta"), json.dumps(meta))
        if model.means is not None:
            model.means.write.mode("overwrite").parquet(os.path.join(path, "means"))
        return
    if isinstance(model, ForestModel):
        meta = {"kind": "forest", "features": list(model.features), "params": model.params}
        tops = [(t, top.feature, top.value, top.left, top.unit, top.hash, top.depth) for t, top in enumerate(model.tops)]
        table = spark.createDataFrame(tops, "tree int, feature array<int>, value array<double>, left array<int>, unit array<long>, hash array<long>, depth array<int>")
        table.write.mode("overwrite").parquet(os.path.join(path, "tops"))
        model.subtrees.write.mode("overwrite").parquet(os.path.join(path, "subtrees"))
        _hadoop_write_text(spark, os.path.join(path, "meta"), json.dumps(meta))
        return
    raise TypeError(f"cannot save {type(model).__name__}")


def has_folder(spark: SparkSession, *names: str) -> bool:
    """Whether the joined path exists, on any Hadoop file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(*names))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def is_model(spark: SparkSession, path: str) -> bool:
    """A closed-form model's ``meta``, or the stages of an MLlib pipeline."""
    return has_folder(spark, path, "meta") or (has_folder(spark, path, "metadata") and has_folder(spark, path, "stages"))


def load_model(spark: SparkSession, path: str):
    if not has_folder(spark, path, "meta"):
        return PipelineModel.load(path)
    meta = json.loads(_hadoop_read_text(spark, os.path.join(path, "meta")))
    if meta["kind"] == "linear":
        return LinearModel(tuple(meta["features"]), tuple(meta["coef"]), meta["intercept"])
    if meta["kind"] == "forest":
        # a row per tree; its top's nodes number table size / size of a task's share
        tops = [Top(*map(list, r[1:])) for r in spark.read.parquet(os.path.join(path, "tops")).orderBy("tree").collect()]
        return ForestModel(tuple(meta["features"]), tops, spark.read.parquet(os.path.join(path, "subtrees")), meta["params"])
    means = spark.read.parquet(os.path.join(path, "means")) if meta["group_by"] else None
    return GroupMeanModel(tuple(meta["group_by"]), means, meta["global_mean"])
