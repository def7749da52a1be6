"""Session helpers: sensible defaults and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, app_name: str = "panelwatch",
                shuffle_partitions: int | None = None,
                driver_memory: str | None = None) -> SparkSession:
    """Return a session with AQE on, UTC time, no UI, Arrow transfer enabled.

    On a cluster ``master`` is left to spark-submit; tests pass ``local[*]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         # windows and sorts over compact shuffle data are CPU-bound: do not let
         # AQE merge a few MB of compressed rows into one or two tasks
         .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    # only takes effect when this call starts the JVM (local runs); on a
    # cluster the driver size comes from spark-submit
    mem = driver_memory or os.environ.get("PANELWATCH_DRIVER_MEMORY")
    if mem:
        b = b.config("spark.driver.memory", mem)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local master may run without it; a private folder is then made
    and deleted when the process ends.  On a cluster a machine-local folder would
    lose data with its machine, so a missing setting is an error there."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="panelwatch-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into a reliable checkpoint, whatever its size.

    This cuts the lineage (a lost executor re-reads files instead of recomputing
    upstream stages) and holds no executor memory.  The files go when the frame is no
    longer referenced (``spark.cleaner.referenceTracking.cleanCheckpoints``, set by
    :func:`get_session`)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
