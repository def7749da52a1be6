"""Panel sources and sinks.

Panels are stored as Parquet partitioned by the period column, so a period
filter is a partition filter (only the listed folders are read).  Monthly
CSV files named ``yyyy-MM.csv`` are also readable, with the period taken
from the file name.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwatch.functions.scalar import period_from_path
from panelwatch.spec import PanelSpec


class MissingPeriodsError(FileNotFoundError):
    """A2: requested periods absent from the stored panel (sorted)."""

    def __init__(self, missing: list[str]):
        super().__init__(f"missing periods: {missing}")
        self.missing = missing


def write_panel(df: DataFrame, path: str, spec: PanelSpec) -> None:
    """A3: one folder per period; rewriting a period replaces only it.

    Rows are dealt by period first, so a period is a few files instead of one per
    task; Spark's rebalance splits a period that is too large for one."""
    (df.hint("rebalance", spec.period).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(spec.period).parquet(path))


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, from the file system (no file is opened)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(p)]


def _check_periods(have, periods: Sequence[str]) -> None:
    missing = sorted(set(periods) - set(have))
    if missing:
        raise MissingPeriodsError(missing)


def load_panel(spark: SparkSession, path: str, spec: PanelSpec,
               periods: Sequence[str] | None = None, check: bool = True) -> DataFrame:
    """A1/A2: read all or some periods; with ``check`` every requested
    period must exist (the error names the missing ones, sorted)."""
    df = spark.read.option("basePath", path).parquet(path)
    df = df.withColumn(spec.period, F.col(spec.period).cast("string"))
    if periods is not None:
        if check:
            head = f"{spec.period}="
            _check_periods([unquote(n[len(head):]) for n in _names(spark, path) if n.startswith(head)], periods)
        return df.where(F.col(spec.period).isin(list(periods)))  # PartitionFilters
    return df


def load_csv_months(spark: SparkSession, directory: str, schema: T.StructType, spec: PanelSpec,
                    periods: Sequence[str] | None = None) -> DataFrame:
    """A1 for monthly CSV files ``yyyy-MM.csv`` with a header; the period
    comes from the file name (H7), and only the files of the wanted periods
    are opened.  Columns go by the names in the header, in any order; files of
    one folder share their header."""
    root = directory.rstrip("/")
    months = sorted(n[:-4] for n in _names(spark, root) if n.endswith(".csv"))
    if periods is not None:
        _check_periods(months, periods)
        months = [m for m in months if m in set(periods)]
    files = [f"{root}/{m}.csv" for m in months]
    # read as text under the header's names, then cast by name to the schema
    raw = spark.read.option("header", True).option("enforceSchema", False).csv(files)
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields],
                      period_from_path(F.col("_metadata.file_path")).alias(spec.period))


# ------------------------------------------------------------------ drift history
# Names and order of the history document's fields.
HISTORY_RECORD = T.StructType([
    T.StructField("month", T.StringType()), T.StructField("regime", T.StringType()),
    T.StructField("n_rows", T.LongType()), T.StructField("drifted_columns_count", T.IntegerType()),
    T.StructField("drifted_columns_share", T.DoubleType()),
    T.StructField("drifted_columns", T.ArrayType(T.StringType())),
    T.StructField("prediction_drift_score", T.DoubleType()),
    T.StructField("prediction_drift_detected", T.BooleanType()),
    T.StructField("roc_auc", T.DoubleType()), T.StructField("auc_delta", T.DoubleType()),
    T.StructField("status", T.StringType()),
])
HISTORY_SCHEMA = T.StructType([
    T.StructField("model", T.StructType([T.StructField(k, T.StringType())
                                         for k in ("name", "version", "algorithm")])),
    T.StructField("reference_months", T.ArrayType(T.StringType())),
    T.StructField("reference_roc_auc", T.DoubleType()),
    T.StructField("thresholds", T.StructType([T.StructField("drift_share", T.DoubleType()),
                                              T.StructField("auc_drop", T.DoubleType())])),
    T.StructField("history", T.ArrayType(HISTORY_RECORD)),
])


def write_drift_history(doc: DataFrame, path: str) -> None:
    """A4: the one-row JSON document (see ``drift.history_document``)."""
    doc.select("drift_history").coalesce(1).write.mode("overwrite").text(path)


def read_drift_history(spark: SparkSession, path: str) -> DataFrame | None:
    """A5: history records as rows (``explode``); ``None`` if absent."""
    try:
        doc = spark.read.schema(HISTORY_SCHEMA).json(path)
    except Exception as e:  # noqa: BLE001 - absent path
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return None
        raise
    return doc.select("model", "reference_roc_auc", F.explode("history").alias("h")).select(
        F.col("model.name").alias("model_name"), F.col("model.version").alias("model_version"),
        "reference_roc_auc", "h.*")


def write_drift_detail(column_drift: DataFrame, path: str, period: str = "month") -> None:
    """Per-period drift detail as JSON, one folder per period."""
    (column_drift.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(period).json(path))


def read_request_batch(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A request file holding ``{"customers": [...]}`` or one object;
    every field is read as text so validation (B12) can report bad types."""
    text_fields = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    wrapped = T.StructType(list(text_fields.fields)
                           + [T.StructField("customers", T.ArrayType(text_fields))])
    raw = spark.read.schema(wrapped).option("multiLine", True).json(path)
    batch = raw.where(F.col("customers").isNotNull()).select(F.inline("customers"))
    single = raw.where(F.col("customers").isNull()).select(*[f.name for f in schema.fields])
    return batch.unionByName(single)


# ------------------------------------------------------------------ drift snapshots
_METRIC = "struct<id: string, config: struct<type: string, column: string>, value: string>"
_TEST = "struct<metric_config: struct<metric_id: string>, status: string>"
SNAPSHOT_SCHEMA = f"period string, metrics array<{_METRIC}>, tests array<{_TEST}>"


def read_drift_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Drift snapshots (one JSON document per line): period, metrics, tests."""
    return spark.read.schema(SNAPSHOT_SCHEMA).json(path)


def snapshot_column_drift(snapshots: DataFrame, fallback: float = 0.1) -> DataFrame:
    """B13 + C3: ``(period, column, score, drifted)`` of the snapshots.

    Only metrics whose type ends in ``ValueDrift``, with a column and a numeric
    value, count.  The verdict is that of the metric's test (anything but
    SUCCESS is drift, since methods differ in direction); without a test it is
    ``value > fallback``."""
    m = snapshots.select("period", F.explode("metrics").alias("m")).select(
        "period", F.col("m.id").alias("id"), F.col("m.config.type").alias("type"),
        F.col("m.config.column").alias("column"), F.expr("try_cast(m.value AS double)").alias("value"))
    m = m.where(F.col("type").endswith("ValueDrift") & F.col("column").isNotNull() & F.col("value").isNotNull())
    t = snapshots.select("period", F.explode("tests").alias("t")).select(
        "period", F.col("t.metric_config.metric_id").alias("id"), F.col("t.status").alias("status"))
    # a metric tested twice: the last verdict would depend on order, so any failure counts
    t = t.where(F.col("id").isNotNull()).groupBy("period", "id").agg(
        F.max(F.coalesce(F.col("status") != "SUCCESS", F.lit(True))).alias("failed"))
    return m.join(t, ["period", "id"], "left").select(
        "period", "column", F.round("value", 4).alias("score"),
        F.coalesce("failed", F.col("value") > F.lit(fallback)).alias("drifted"))
