"""Time-ordered operators (E1-E5, K1 via ``regime_label``, K4).

Order between periods comes from the calendar index of the label, so
"previous period" is an equi-join on ``index - 1`` instead of a window over
all periods, and islands use ``index - row_number`` inside each label.
Per-entity windows (K4) are bounded by the number of periods an entity can
appear in, because ``(id, period)`` is the panel key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from panelwatch.functions.scalar import period_index
from panelwatch.spec import PanelSpec


def _label_from_index(idx, start: str, unit: str):
    if unit == "day":
        return F.date_format(F.date_add(F.to_date(F.lit(start)), idx), "yyyy-MM-dd")
    return F.date_format(F.add_months(F.to_date(F.lit(start + "-01")), idx), "yyyy-MM")


# ---------------------------------------------------------------- E1
def period_change(series: DataFrame, period: str, value: str, start: str,
                  unit: str = "month") -> DataFrame:
    """``value - value(previous calendar period)`` for a per-period table."""
    cur = series.select(period, value, period_index(period, start, unit).alias("__i"))
    prev = cur.select((F.col("__i") + 1).alias("__i"), F.col(value).alias("__prev"))
    return (cur.join(prev, "__i", "left")
            .select(period, value, (F.col(value) - F.col("__prev")).alias("diff")))


def change_summary(changes: DataFrame, periods: list[str] | None = None,
                   period: str = "period") -> DataFrame:
    """Maximum step and non-decreasing check (pandas monotonic) over the
    given periods; the first period of the range has no step."""
    c = changes if periods is None else changes.where(F.col(period).isin(periods[1:]))
    return c.agg(F.max("diff").alias("max_diff"),
                 F.bool_and(F.col("diff") >= 0).alias("non_decreasing"),
                 F.sum("diff").alias("total_change"))


# ---------------------------------------------------------------- E2
def stacked_share_base(shares: DataFrame, period: str, category: str,
                       share: str = "share") -> DataFrame:
    """Running base of stacked shares inside each period (sum of the
    shares of the earlier categories)."""
    w = W.partitionBy(period).orderBy(category).rowsBetween(W.unboundedPreceding, -1)
    return shares.withColumn("base", F.coalesce(F.sum(share).over(w), F.lit(0.0)))


# ---------------------------------------------------------------- E3
def consecutive_runs(series: DataFrame, period: str, label: str, start: str,
                     unit: str = "month") -> DataFrame:
    """Runs of consecutive periods with the same label -> (first, last,
    label, n_periods).  Gaps-and-islands: within a label, consecutive
    calendar indexes share ``index - row_number``."""
    idx = period_index(period, start, unit)
    w = W.partitionBy(label).orderBy(idx)
    isl = series.select(period, label, idx.alias("__i"),
                        (idx - F.row_number().over(w)).alias("__island"))
    return (isl.groupBy(label, "__island")
            .agg(F.min("__i").alias("__a"), F.max("__i").alias("__b"),
                 F.count(F.lit(1)).alias("n_periods"))
            .select(_label_from_index(F.col("__a"), start, unit).alias("first_period"),
                    _label_from_index(F.col("__b"), start, unit).alias("last_period"),
                    label, "n_periods"))


# ---------------------------------------------------------------- E5, R12, R13
def status_milestones(history: DataFrame, period: str = "month", status: str = "status",
                      watch: str = "VIGILAR", critical: str = "CRITICO",
                      unit: str = "month") -> DataFrame:
    """First period with a data-drift alert, first real degradation,
    and the lag between them (months or days), plus the latest record's
    status."""
    first_w = F.min(F.when(F.col(status) == watch, F.col(period)))
    first_c = F.min(F.when(F.col(status) == critical, F.col(period)))
    agg = history.agg(first_w.alias("first_watch"), first_c.alias("first_critical"),
                      F.max_by(F.col(status), F.col(period)).alias("latest_status"),
                      F.max(period).alias("latest_period"))
    if unit == "day":
        lag = F.datediff(F.to_date("first_critical"), F.to_date("first_watch"))
    else:
        lag = F.months_between(F.to_date(F.concat("first_critical", F.lit("-01"))),
                               F.to_date(F.concat("first_watch", F.lit("-01")))).cast("int")
    return agg.withColumn("lag_periods", lag.cast("int"))


# ---------------------------------------------------------------- K4
def panel_transitions(df: DataFrame, spec: PanelSpec, start: str, unit: str = "month",
                      tenure: str | None = None) -> DataFrame:
    """K4: per period, ids that are new, retained (present the period
    before), returned (seen earlier, absent the period before) and lost
    (present the period before, absent now); plus panel checks: rows whose
    target is 1 yet the id is present the next period, and (if ``tenure``
    is given) consecutive rows whose tenure does not grow by exactly 1."""
    idx = period_index(spec.period, start, unit)
    w = W.partitionBy(spec.id).orderBy("__i")  # <= number of periods per id
    cols = [spec.id, idx.alias("__i"), F.col(spec.target).alias("__t")]
    if tenure:
        cols.append(F.col(tenure).alias("__ten"))
    rows = df.select(*cols)
    rows = rows.withColumn("__prev", F.lag("__i").over(w)).withColumn("__next", F.lead("__i").over(w))
    if tenure:
        rows = rows.withColumn("__next_ten", F.lead("__ten").over(w))
    present = rows.groupBy("__i").agg(
        F.count(F.lit(1)).alias("n_ids"),
        F.count_if(F.col("__prev").isNull()).alias("n_new"),
        F.count_if(F.col("__prev") == F.col("__i") - 1).alias("n_retained"),
        F.count_if(F.col("__prev") < F.col("__i") - 1).alias("n_returned"),
        F.count_if((F.col("__t") == 1) & (F.col("__next") == F.col("__i") + 1))
        .alias("n_target_then_present"),
        *([F.count_if((F.col("__next") == F.col("__i") + 1)
                      & (F.col("__next_ten") != F.col("__ten") + 1)).alias("n_tenure_breaks")]
          if tenure else []))
    lost = (rows.where(F.col("__next").isNull() | (F.col("__next") > F.col("__i") + 1))
            .groupBy((F.col("__i") + 1).alias("__i")).agg(F.count(F.lit(1)).alias("n_lost")))
    out = present.join(lost, "__i", "left").withColumn("n_lost", F.coalesce("n_lost", F.lit(0)))
    return out.select(_label_from_index(F.col("__i"), start, unit).alias(spec.period),
                      *[c for c in out.columns if c != "__i"])
