"""Run tracking as tables.

Tables (parquet folders under one root):

* experiments(experiment_id, name)
* runs(run_id, experiment_id, parent_run_id, run_name, status, start_time, end_time, user_id, source_name)
* params(run_id, key, value)            values as strings
* metrics(run_id, key, value, ts, step)
* tags(run_id, key, value)
* inputs(run_id, dataset_id, context)   context: training / testing
* datasets(dataset_id, digest, name, num_rows, num_elements, schema_json, targets)

``runs`` is a log of events: a start (status RUNNING, no end) and an end; ``read``
gives the latest state of each run, so a run whose driver was lost shows as
RUNNING with what it had logged. Tables are only ever appended to. ``compact``
writes a new generation beside the files that it covers and then a pointer
that names them; a reader takes the newest pointer's folder and every file that
it doesn't cover, so rows appended meanwhile are neither lost nor read twice,
and readers of the old files are not disturbed.

Record builders are plain DataFrame operations (``cv_run_records`` turns a
cv_results table into runs/params/metrics/tags by unpivoting), so logging a
search of any size is a distributed append. Reads are ordinary joins:
``run_tree`` links child runs to parents with a self equi-join.
"""

from __future__ import annotations

import getpass
import hashlib
import json
import time
import uuid
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.operators.profile import dataset_profile

SCHEMAS = {
    "experiments": "experiment_id string, name string",
    "runs": "run_id string, experiment_id string, parent_run_id string, run_name string, status string, "
    "start_time timestamp, end_time timestamp, user_id string, source_name string",
    "params": "run_id string, key string, value string",
    "metrics": "run_id string, key string, value double, ts timestamp, step long",
    "tags": "run_id string, key string, value string",
    "inputs": "run_id string, dataset_id string, context string",
    "datasets": "dataset_id string, digest string, name string, num_rows long, num_elements long, schema_json string, targets string",
}


def run_id_expr(experiment_id: Column, run_name: Column, search_id: str | None = None) -> Column:
    """Deterministic run id: md5 of experiment id, run name and, where given, the search that made the run."""
    return F.md5(F.concat_ws("/", experiment_id, run_name, *([F.lit(search_id)] if search_id else [])))


def cv_run_records(
    cv_results: DataFrame,
    experiment_id: str,
    model_name: str,
    folds: int,
    parent_run_id: str | None = None,
    log_best_only: bool = False,
    tags: dict[str, str] | None = None,
    now_ms: int | None = None,
    search_id: str | None = None,
) -> dict[str, DataFrame]:
    """One run per candidate (or the best only), named ``<model>_<candidate>``.

    params: ``folds`` plus the candidate's parameters (from its JSON text);
    metrics: every ``mean_test*`` column and its ``std`` twin;
    tags: the given tags plus ``best_run`` on the best candidate's run.
    ``search_id`` keeps the run ids of several searches of one model apart.
    """
    now_ms = int(time.time() * 1000) if now_ms is None else now_ms
    ts = F.timestamp_millis(F.lit(now_ms))
    best_id = F.min(F.struct("rank_test_score", "candidate_id")).over(_whole()).getField("candidate_id")
    runs = (
        cv_results.withColumn("is_best", F.col("candidate_id") == best_id)
        .withColumn("run_name", F.concat_ws("_", F.lit(model_name), F.col("candidate_id").cast("string")))
        .withColumn("run_id", run_id_expr(F.lit(experiment_id), F.col("run_name"), search_id))
    )
    if log_best_only:
        runs = runs.filter("is_best")
    run_rows = runs.select(
        "run_id",
        F.lit(experiment_id).alias("experiment_id"),
        F.lit(parent_run_id).cast("string").alias("parent_run_id"),
        "run_name",
        F.lit("FINISHED").alias("status"),
        ts.alias("start_time"),
        ts.alias("end_time"),
        F.lit(None).cast("string").alias("user_id"),
        F.lit(None).cast("string").alias("source_name"),
    )
    param_map = F.from_json(F.col("params"), "map<string,string>")
    params = runs.select(
        "run_id",
        F.explode(F.map_concat(F.create_map(F.lit("folds"), F.lit(str(folds))), param_map)).alias("key", "value"),
    )
    metric_cols = [c for c in cv_results.columns if "mean_test" in c]
    pairs = []
    for c in metric_cols:
        pairs += [(c, c), (c.replace("mean", "std"), c.replace("mean", "std"))]
    metrics = runs.select(
        "run_id",
        F.explode(
            F.array(*[F.struct(F.lit(name).alias("key"), F.col(col).cast("double").alias("value")) for name, col in pairs if col in cv_results.columns])
        ).alias("m"),
    ).select("run_id", "m.key", "m.value", ts.alias("ts"), F.lit(0).cast("long").alias("step"))
    tag_items = dict(tags or {})
    tag_rows = runs.filter("is_best").select(
        "run_id",
        F.explode(F.create_map(*[F.lit(x) for kv in {**tag_items, "best_run": "true"}.items() for x in kv])).alias("key", "value"),
    )
    return {"runs": run_rows, "params": params, "metrics": metrics, "tags": tag_rows}


def _whole():
    from pyspark.sql import Window

    # the cv table has one row per candidate: a global window is bounded here
    return Window.partitionBy()


def latest_runs(events: DataFrame) -> DataFrame:
    """The last event of each run: its end, else its start."""
    rest = [c for c in events.columns if c != "run_id"]
    place = F.struct((F.col("status") != "RUNNING").alias("ended"), F.coalesce("end_time", "start_time").alias("at"))
    last = events.groupBy("run_id").agg(F.max_by(F.struct(*rest), place).alias("e"))
    return last.select("run_id", *[F.col(f"e.{c}").alias(c) for c in rest])


def run_tree(runs: DataFrame, metrics: DataFrame | None = None) -> DataFrame:
    """Child runs with their parent's name (self equi-join) and, if given, metrics."""
    parents = runs.select(F.col("run_id").alias("parent_run_id"), F.col("run_name").alias("parent_run_name"))
    tree = runs.join(parents, "parent_run_id", "left")
    if metrics is not None:
        tree = tree.join(metrics.select("run_id", "key", "value"), "run_id", "left")
    return tree


def runs_per_parent(runs: DataFrame) -> DataFrame:
    """Number of child runs and wall time spanned per parent run."""
    return (
        runs.filter(F.col("parent_run_id").isNotNull())
        .groupBy("parent_run_id")
        .agg(
            F.count(F.lit(1)).alias("n_children"),
            (F.max("end_time").cast("double") - F.min("start_time").cast("double")).alias("span_seconds"),
        )
    )


def run_durations(runs: DataFrame) -> DataFrame:
    """Wall time of every finished run in seconds."""
    return runs.withColumn("seconds", F.col("end_time").cast("double") - F.col("start_time").cast("double"))


def dataset_record(df: DataFrame, name: str, targets: str | None = None) -> DataFrame:
    """A datasets row: profile (rows, elements, digest) plus schema and targets."""
    prof = dataset_profile(df)
    schema_json = json.dumps([{"name": f.name, "type": f.dataType.simpleString(), "required": not f.nullable} for f in df.schema.fields])
    return prof.select(
        F.md5(F.concat_ws("/", F.lit(name), F.col("digest"))).alias("dataset_id"),
        "digest",
        F.lit(name).alias("name"),
        "num_rows",
        "num_elements",
        F.lit(schema_json).alias("schema_json"),
        F.lit(targets).cast("string").alias("targets"),
    )


@dataclass
class Run:
    run_id: str
    experiment_id: str
    run_name: str
    parent_run_id: str | None
    started: int = 0  # epoch milliseconds


class TrackingStore:
    """Append-only tracking tables in parquet folders under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _files(self, folder: str) -> dict[str, str]:
        """Name -> address of the data files directly in a folder, none if it is missing."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return {}
        return {st.getPath().getName(): st.getPath().toString() for st in fs.listStatus(path) if st.isFile() and not st.getPath().getName().startswith(("_", "."))}

    def _generation(self, table: str) -> tuple[int, dict]:
        """Number and content of the newest pointer; 0 without one."""
        pointers = {int(n.removeprefix("generation-").removesuffix(".json")): at for n, at in self._files(f"{self.path(table)}__generations").items() if n.endswith(".json")}
        if not pointers:
            return 0, {"folder": None, "covers": []}
        newest = max(pointers)
        return newest, json.loads("".join(r[0] for r in self.spark.read.text(pointers[newest]).collect()))

    def log(self, table: str) -> DataFrame:
        """All rows of a table: those of the newest generation and of the files that it doesn't cover."""
        _, now = self._generation(table)
        covered = set(now["covers"])
        files = [at for name, at in self._files(self.path(table)).items() if name not in covered]
        if now["folder"]:
            files += self._files(now["folder"]).values()
        if not files:
            return self.spark.createDataFrame([], SCHEMAS[table])
        return self.spark.read.schema(SCHEMAS[table]).parquet(*files)

    def read(self, table: str) -> DataFrame:
        return latest_runs(self.log(table)) if table == "runs" else self.log(table)

    def append(self, table: str, df: DataFrame) -> None:
        cols = [c.split()[0] for c in SCHEMAS[table].split(", ")]
        df.select(*cols).write.mode("append").parquet(self.path(table))

    def compact(self, table: str, files: int = 1) -> None:
        """Rewrite an append-heavy table into ``files`` files, as a new generation that covers those there are now."""
        number, _ = self._generation(table)
        covers = sorted(self._files(self.path(table)))
        folder = f"{self.path(table)}__generations/{uuid.uuid4().hex}"
        self.log(table).repartition(files).write.parquet(folder)
        # files appended since ``covers`` was listed may be in the folder too: then this attempt covers too little, and is dropped
        if sorted(self._files(self.path(table))) != covers:
            return
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(f"{self.path(table)}__generations/generation-{number + 1}.json")
        fs = target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        staged = jvm.org.apache.hadoop.fs.Path(f"{folder}.pointer")
        out = fs.create(staged)
        out.write(bytearray(json.dumps({"folder": folder, "covers": covers}).encode()))
        out.close()
        fs.rename(staged, target)  # does nothing where another compaction was first

    def append_records(self, records: dict[str, DataFrame]) -> None:
        for table, df in records.items():
            self.append(table, df)

    # experiments: look up by name, create when absent (idempotent)
    def experiment(self, name: str) -> str:
        found = self.read("experiments").filter(F.col("name") == name).select("experiment_id").limit(1).collect()
        if found:
            return found[0][0]
        eid = hashlib.md5(name.encode()).hexdigest()[:18]  # deterministic: a racing creator writes the same id
        self.append("experiments", self.spark.createDataFrame([(eid, name)], SCHEMAS["experiments"]))
        return eid

    def upsert_experiments(self, names: DataFrame) -> DataFrame:
        """Bulk form: append the names not yet present (``left_anti``), return all."""
        new = names.select("name").distinct().join(self.read("experiments"), "name", "left_anti").select(
            F.substring(F.md5(F.col("name")), 1, 18).alias("experiment_id"), "name"
        )
        self.append("experiments", new)
        return self.read("experiments")

    def _event(self, run: Run, status: str, start: int, end: int | None) -> None:
        row = [(run.run_id, run.experiment_id, run.parent_run_id, run.run_name, status, start, end, getpass.getuser(), "lathe")]
        df = self.spark.createDataFrame(
            row,
            "run_id string, experiment_id string, parent_run_id string, run_name string, status string, "
            "s long, e long, user_id string, source_name string",
        ).select(
            "run_id", "experiment_id", "parent_run_id", "run_name", "status",
            F.timestamp_millis("s").alias("start_time"), F.timestamp_millis("e").alias("end_time"),
            "user_id", "source_name",
        )
        self.append("runs", df)

    def begin_run(self, run_name: str, experiment_id: str, parent: Run | None = None) -> Run:
        """Log the start of a run; until ``end_run`` its state is RUNNING."""
        run = Run(uuid.uuid4().hex, experiment_id, run_name, parent.run_id if parent else None, int(time.time() * 1000))
        self._event(run, "RUNNING", run.started, None)
        return run

    def end_run(self, run: Run, status: str = "FINISHED") -> None:
        self._event(run, status, run.started, int(time.time() * 1000))

    @contextmanager
    def start_run(self, run_name: str, experiment_id: str, parent: Run | None = None):
        run = self.begin_run(run_name, experiment_id, parent)
        status = "FINISHED"
        try:
            yield run
        except BaseException:
            status = "FAILED"
            raise
        finally:
            self.end_run(run, status)

    def log_params(self, run: Run, params: dict) -> None:
        rows = [(run.run_id, str(k), _as_text(v)) for k, v in params.items()]
        self.append("params", self.spark.createDataFrame(rows, SCHEMAS["params"]))

    def log_metrics(self, run: Run, metrics: dict[str, float], step: int = 0) -> None:
        now = int(time.time() * 1000)
        rows = [(run.run_id, k, float(v), now, step) for k, v in metrics.items()]
        df = self.spark.createDataFrame(rows, "run_id string, key string, value double, t long, step long")
        self.append("metrics", df.select("run_id", "key", "value", F.timestamp_millis("t").alias("ts"), "step"))

    def set_tags(self, run: Run, tags: dict) -> None:
        rows = [(run.run_id, str(k), _as_text(v)) for k, v in tags.items()]
        self.append("tags", self.spark.createDataFrame(rows, SCHEMAS["tags"]))

    def log_input(self, run: Run, df: DataFrame, name: str, context: str, targets: str | None = None) -> str:
        rec = dataset_record(df, name, targets).collect()[0]
        self.append("datasets", self.spark.createDataFrame([tuple(rec)], SCHEMAS["datasets"]))
        self.append("inputs", self.spark.createDataFrame([(run.run_id, rec["dataset_id"], context)], SCHEMAS["inputs"]))
        return rec["dataset_id"]


def _as_text(v) -> str:
    if isinstance(v, (list, tuple)):
        return json.dumps(list(v))
    if v is None:
        return "None"
    return str(v)
