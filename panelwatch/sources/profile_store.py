"""Stored profiles of a panel: the packed counts of ``panel_profile``, kept by period.

A profile row is ``(period, role, column, label, n, known, points, ...)`` with values and counts as arrays.  Profiles of different periods add up, so
monitoring a new period reads that period's rows of the panel, stores their
counts, and compares them with the stored counts of the reference; no other row of the panel is
read again.  Storing a period again replaces its profile (a repeated or retried job changes nothing).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwatch.operators import drift as D
from panelwatch.operators.panel_profile import merge_rows, panel_profile, profile_type
from panelwatch.spec import PanelSpec, RegimeSpec


def store_profiles(scored: DataFrame, spec: PanelSpec, path: str, periods: Sequence[str] | None = None,
                   cfg: D.MonitorConfig = D.MonitorConfig()) -> None:
    """Count the values of the given periods (default: all in ``scored``) and keep them below ``path``, one folder a period."""
    rows = scored if periods is None else scored.where(F.col(spec.period).isin(list(periods)))
    profile = panel_profile(rows, spec.period, list(spec.numeric) + [cfg.prediction], spec.categorical,
                            cfg.rank_score or cfg.prediction, spec.target)
    (merge_rows(profile.repartition(spec.period, "column"), spec.period).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(spec.period).parquet(path))


def read_profiles(spark: SparkSession, spec: PanelSpec, path: str, periods: Sequence[str] | None = None) -> DataFrame:
    """The stored rows of the given periods (a partition filter)."""
    cells = spark.read.schema(profile_type(spec.period, T.StringType())).parquet(path)
    return cells if periods is None else cells.where(F.col(spec.period).isin(list(periods)))


def monitor_new_periods(scored: DataFrame, spec: PanelSpec, path: str, periods: Sequence[str], reference: Sequence[str],
                        regimes: RegimeSpec, cfg: D.MonitorConfig = D.MonitorConfig()) -> DataFrame:
    """R2-R10 for new periods: store their profiles, then compare them with the stored reference."""
    store_profiles(scored, spec, path, periods, cfg)
    cells = read_profiles(scored.sparkSession, spec, path, [*reference, *periods])
    return D.monthly_from_counts(cells, spec, reference, regimes, periods, cfg)
