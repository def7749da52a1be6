"""Column expressions (H1-H15) and the calendar regime label (K1).

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwatch.spec import RegimeSpec

# Decision threshold, risk bands (upper limits, strict <) and the
# drift status policy of the reference.
DECISION_THRESHOLD = 0.5
RISK_BANDS = ((0.35, "bajo"), (0.65, "medio"))
RISK_TOP = "alto"
DRIFT_SHARE_THRESHOLD = 0.30
AUC_DROP_THRESHOLD = 0.02
STATUS_OK, STATUS_WATCH, STATUS_CRITICAL = "OK", "VIGILAR", "CRITICO"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sigmoid(x: str | Column) -> Column:
    """H1: logistic function."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col(x)))


def zscore(x: str | Column, mean: float, sd: float) -> Column:
    """H2: standardise with fixed reference mean and sd."""
    return (col(x) - F.lit(float(mean))) / F.lit(float(sd))


def clip(x: str | Column, lo: float | Column | None = None,
         hi: float | Column | None = None) -> Column:
    """H3: clip to [lo, hi]; null stays null and NaN stays NaN (``np.clip``).

    ``greatest``/``least`` alone would turn null into the bound and NaN into
    the upper bound, so both are guarded.
    """
    c = col(x)
    out = c
    if lo is not None:
        out = F.greatest(out, lo if isinstance(lo, Column) else F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, hi if isinstance(hi, Column) else F.lit(float(hi)))
    return F.when(c.isNull() | F.isnan(c.cast("double")), c.cast("double")).otherwise(
        out.cast("double"))


def month_labels(spark: SparkSession, start: str, n: int, name: str = "period") -> DataFrame:
    """H5: ``n`` consecutive ``yyyy-MM`` labels from ``start``."""
    first = F.to_date(F.lit(start + "-01"))
    seq = F.sequence(first, F.add_months(first, n - 1), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(seq).alias("d")).select(
        F.date_format("d", "yyyy-MM").alias(name))


def padded_id(n: str | Column, prefix: str = "CUST-", width: int = 6) -> Column:
    """H6: zero-padded identifier such as ``CUST-000042``."""
    return F.format_string(f"{prefix}%0{width}d", col(n))


def period_from_path(path: str | Column) -> Column:
    """H7: ``yyyy-MM`` label from a file name such as ``.../2024-03.csv``."""
    return F.regexp_extract(col(path), r"(\d{4}-\d{2})\.[A-Za-z]+$", 1)


def relative_change(new: str | Column, base: str | Column) -> Column:
    """H8: ``new / base - 1``, null on a zero base."""
    return F.try_divide(col(new).cast("double"), col(base).cast("double")) - F.lit(1.0)


def signed_percent_text(x: str | Column) -> Column:
    """H8: relative change as signed percent text, ``+12.3%``."""
    return F.format_string("%+.1f%%", col(x) * F.lit(100.0))


def decision(p: str | Column, threshold: float = DECISION_THRESHOLD) -> Column:
    """Class from the unrounded probability, ``p >= threshold``."""
    return (col(p) >= F.lit(float(threshold))).cast("int")


def risk_band(p: str | Column, bands=RISK_BANDS, top: str = RISK_TOP) -> Column:
    """Band by strict upper limits."""
    expr = None
    for limit, name in bands:
        cond = col(p) < F.lit(float(limit))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(top))


def drift_status(share: str | Column, auc_delta: str | Column,
                 share_threshold: float = DRIFT_SHARE_THRESHOLD,
                 auc_drop: float = AUC_DROP_THRESHOLD) -> Column:
    """AUC drop rule first (``<=``), then the share rule (strict ``>``).
    A null delta skips the first rule."""
    d, s = col(auc_delta), col(share)
    return (F.when(d.isNotNull() & (d <= F.lit(-float(auc_drop))), F.lit(STATUS_CRITICAL))
            .when(s > F.lit(float(share_threshold)), F.lit(STATUS_WATCH))
            .otherwise(F.lit(STATUS_OK)))


def safe_ratio(a: str | Column, b: str | Column) -> Column:
    """``a / b`` with 0 on a zero denominator (``zero_division=0``)."""
    return F.coalesce(F.try_divide(col(a).cast("double"), col(b).cast("double")), F.lit(0.0))


def json_number(doc: str | Column, path: str) -> Column:
    """Numeric field of a JSON text, null when absent."""
    return F.get_json_object(col(doc), path).cast("double")


def period_index(period: str | Column, start: str, unit: str = "month") -> Column:
    """Calendar position of a period label relative to ``start`` (0-based)."""
    if unit == "day":
        return F.datediff(F.to_date(col(period)), F.to_date(F.lit(start))).cast("int")
    cur = F.to_date(F.concat(col(period), F.lit("-01")))
    base = F.to_date(F.lit(start + "-01"))
    return F.months_between(cur, base).cast("int")


def regime_label(period: str | Column, regimes: RegimeSpec) -> Column:
    """K1: regime of a period from the calendar (not from the loaded months)."""
    idx = period_index(period, regimes.start, regimes.unit)
    pairs = sorted(zip(regimes.starts, regimes.labels), reverse=True)
    expr = None
    for start, label in pairs:
        cond = idx >= F.lit(start)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(None).cast("string"))


def safe_corr(x: str | Column, y: str | Column) -> Column:
    """Pearson correlation over the rows where both sides are present; null (not
    an error under ANSI mode) when either has zero variance there or fewer
    than two such rows."""
    xc, yc = col(x).cast("double"), col(y).cast("double")
    xb, yb = F.when(yc.isNotNull(), xc), F.when(xc.isNotNull(), yc)
    return F.try_divide(F.covar_samp(xb, yb), F.stddev_samp(xb) * F.stddev_samp(yb))
