"""Runs, metrics and model versions on plain files.

Below one root (by default inside the shared checkpoint folder) lie ``runs`` and ``run_metrics`` (Parquet, a folder of its
own for each run, so that two jobs never share a commit folder), ``models`` (saved pipelines) and ``log``: numbered
event files (register / alias).  An event is committed by creating the next number's file, which
only one writer can do; a writer that loses the number reads the log again and tries the next one.  So versions are
distinct, no event is lost, and readers see whole events in one order.  Versions and aliases are resolved with aggregates over the events,
so the history is kept.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwatch.functions.scalar import DECISION_THRESHOLD
from panelwatch.session import scratch_path

RUN_SCHEMA = "run_id string, algorithm string, created_at long"
METRIC_SCHEMA = "run_id string, kind string, key string, value double, text string"
EVENT_SCHEMA = ("name string, event string, version int, alias string, run_id string, "
                "algorithm string, created_at long, event_seq long, validation_roc_auc string, "
                "description string")
#: tries to commit an event before giving up (each lost try means that another writer committed one)
TRIES = 1000


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` with ``text`` unless it exists; whole content or nothing, for one of several writers.

    The content is written beside it and then given the name: by a hard link on a local or mounted folder, by a rename that
    never replaces elsewhere (atomic on HDFS)."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    scheme = target.toUri().getScheme() or jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(spark.sparkContext._jsc.hadoopConfiguration()).getScheme()
    if scheme == "file":
        local = target.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        own = os.path.join(os.path.dirname(local), f".{uuid.uuid4().hex}.tmp")
        with open(own, "w", encoding="utf-8") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        try:
            os.link(own, local)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(own)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    fs = target.getFileSystem(conf)
    own = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}.tmp")
    out = fs.create(own, True)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(own, target, spark.sparkContext._gateway.new_array(
            jvm.org.apache.hadoop.fs.Options.Rename, 0))
        return True
    except Py4JJavaError as e:
        fs.delete(own, False)
        if "FileAlreadyExists" in str(e.java_exception.getClass().getName()):
            return False
        raise


class Registry:
    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or scratch_path(spark, "registry")

    def _path(self, name: str) -> str:
        return os.path.join(self.root, name)

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(self._path(name))
        except Exception as e:  # noqa: BLE001 - empty registry
            if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e) \
                    or "UNABLE_TO_INFER_SCHEMA" in str(e):
                return self.spark.createDataFrame([], schema)
            raise

    # ---------------------------------------------------------------- A8, A9
    def log_run(self, algorithm: str, metrics: DataFrame | dict[str, float],
                params: dict[str, object] | None = None, model: PipelineModel | None = None,
                run_id: str | None = None) -> str:
        """One run with params (rows of kind ``param`` with a text value)
        and metrics ``(key, value)``; A9: the fitted pipeline saved as one unit."""
        run_id = run_id or uuid.uuid4().hex
        now = int(time.time())
        self.spark.createDataFrame([(run_id, algorithm, now)], RUN_SCHEMA).coalesce(1).write.mode(
            "overwrite").parquet(self._path(f"runs/{run_id}"))
        if isinstance(metrics, dict):
            mdf = self.spark.createDataFrame(
                [(run_id, "metric", k, float(v), None) for k, v in metrics.items()], METRIC_SCHEMA)
        else:
            mdf = metrics.select(F.lit(run_id).alias("run_id"), F.lit("metric").alias("kind"),
                                 F.col("key").cast("string"), F.col("value").cast("double"),
                                 F.lit(None).cast("string").alias("text"))
        if params:
            pdf = self.spark.createDataFrame(
                [(run_id, "param", k, None, str(v)) for k, v in params.items()], METRIC_SCHEMA)
            mdf = mdf.unionByName(pdf)
        mdf.write.mode("overwrite").parquet(self._path(f"run_metrics/{run_id}"))
        if model is not None:
            model.write().overwrite().save(self._path(f"models/{run_id}"))
        return run_id

    def load_model(self, run_id: str) -> PipelineModel:
        return PipelineModel.load(self._path(f"models/{run_id}"))

    # ---------------------------------------------------------------- A10, A11
    def events(self) -> DataFrame:
        """All committed events."""
        try:
            return self.spark.read.schema(EVENT_SCHEMA).json(os.path.join(self._path("log"), "[0-9]*.json"))
        except AnalysisException as e:  # no event yet
            if "PATH_NOT_FOUND" in str(e):
                return self.spark.createDataFrame([], EVENT_SCHEMA)
            raise

    def _commit(self, made) -> dict:
        """Commit the event that ``made(events so far)`` gives, under the next free number."""
        for _ in range(TRIES):
            before = self.events()
            seq = (before.agg(F.max("event_seq")).first()[0] or 0) + 1
            event = {**made(before.where(F.col("event_seq") < seq)), "event_seq": seq, "created_at": int(time.time())}
            if put_if_absent(self.spark, os.path.join(self._path("log"), f"{seq:012d}.json"), json.dumps(event)):
                return event
        raise RuntimeError(f"no event could be committed in {TRIES} tries")

    def params(self, run_id: str) -> DataFrame:
        """``(key, text)`` of a run's params."""
        rows = self._read("run_metrics", METRIC_SCHEMA)
        return rows.where((F.col("run_id") == run_id) & (F.col("kind") == "param")).select("key", "text")

    def register(self, name: str, run_id: str, algorithm: str,
                 validation_roc_auc: float | None = None, description: str | None = None) -> int:
        """A10: new version = last version of this name + 1, tagged with the
        algorithm and the validation AUC (4 decimals) and described."""
        auc = None if validation_roc_auc is None else f"{validation_roc_auc:.4f}"

        def event(before: DataFrame) -> dict:
            last = before.where((F.col("name") == name) & (F.col("event") == "register")).agg(F.max("version")).first()[0]
            return {"name": name, "event": "register", "version": int(last or 0) + 1, "run_id": run_id, "algorithm": algorithm,
                    "validation_roc_auc": auc, "description": description}

        return self._commit(event)["version"]

    def promote(self, name: str, version: int, alias: str = "champion") -> None:
        """Move the alias to a registered ``version`` (latest alias event wins)."""
        def event(before: DataFrame) -> dict:
            if before.where((F.col("name") == name) & (F.col("event") == "register") & (F.col("version") == int(version))).isEmpty():
                raise LookupError(f"{name!r} has no version {version}")
            return {"name": name, "event": "alias", "version": int(version), "alias": alias}

        self._commit(event)

    def versions(self, name: str) -> DataFrame:
        return self.events().where((F.col("name") == name) & (F.col("event") == "register")).select(
            "name", "version", "run_id", "algorithm", "created_at", "validation_roc_auc", "description")

    def resolve(self, name: str, alias: str = "champion") -> DataFrame:
        """``(name, alias, version)`` from the latest alias event."""
        return (self.events().where((F.col("name") == name) & (F.col("event") == "alias")
                         & (F.col("alias") == alias))
                .groupBy("name", "alias").agg(F.max_by("version", "event_seq").alias("version")))

    def model_info(self, name: str, alias: str = "champion", features: Sequence[str] = (),
                   threshold: float = DECISION_THRESHOLD) -> DataFrame:
        """Alias -> version -> run, with the run's metrics as a map
        (``train_`` metrics dropped, B11; 4 decimals), the input features and the
        decision threshold."""
        cur = self.resolve(name, alias)
        ver = self.versions(name)
        mets = (self._read("run_metrics", METRIC_SCHEMA)
                .where((F.col("kind") == "metric") & ~F.col("key").startswith("train_"))
                .groupBy("run_id").agg(F.map_from_entries(F.collect_list(
                    F.struct("key", F.round("value", 4).alias("value")))).alias("metrics")))
        return (cur.join(ver, ["name", "version"]).join(mets, "run_id", "left")
                .select("name", F.col("version").cast("string").alias("version"), "run_id",
                        "algorithm", "created_at", "validation_roc_auc", "description", "metrics",
                        F.array(*[F.lit(f) for f in features]).cast("array<string>").alias("features"),
                        F.lit(float(threshold)).alias("threshold")))

    def load_champion(self, name: str, alias: str = "champion") -> tuple[PipelineModel, dict]:
        info = self.model_info(name, alias).first()
        if info is None:
            raise LookupError(f"no model with alias {alias!r} for {name!r}")
        return self.load_model(info["run_id"]), info.asDict()
