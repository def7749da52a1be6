"""Scoring, scorecards and row validation.

* ``Scorecard`` (K2): intercept + sum of beta * z-score + category terms +
  flags + optional interaction, then the logistic function.  One
  expression, built with ``functools.reduce``; category terms are a
  ``create_map`` lookup (unknown category -> null, as a dict map gives NaN).
* ``calibrate_intercept`` (K3): per-group intercept b with
  mean(sigmoid(z + b)) = target, by bisection on [-15, 15].  Each round
  evaluates a grid of candidates for all groups in one aggregate over the
  (group, z) table, so the number of Spark jobs is small and no group is
  collected.
* ``score_batch`` (M23/M24): probability (rounded 4), class from the
  unrounded probability, risk band, model version and threshold.
* ``validate_rows`` (B12): each violated rule names its field; rows are
  split into valid and quarantined by the size of the error list.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwatch.session import materialize
from panelwatch.functions.scalar import (
    DECISION_THRESHOLD, decision, risk_band, sigmoid, zscore,
)


# ---------------------------------------------------------------- K2
@dataclass(frozen=True)
class Scorecard:
    """Linear scorecard. ``numeric`` maps column -> (ref mean, ref sd, beta)."""

    intercept: float
    numeric: Mapping[str, tuple[float, float, float]] = field(default_factory=dict)
    categorical: Mapping[str, Mapping[str, float]] = field(default_factory=dict)
    flags: Mapping[str, tuple[str, float]] = field(default_factory=dict)  # col -> (value, beta)
    interaction: tuple[str, str, str, float] | None = None  # (cat col, value, numeric col, beta)

    def linear(self, with_intercept: bool = True) -> Column:
        terms: list[Column] = [F.lit(float(self.intercept) if with_intercept else 0.0)]
        for c, (mean, sd, beta) in self.numeric.items():
            terms.append(F.lit(float(beta)) * zscore(c, mean, sd))
        for c, table in self.categorical.items():
            m = F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.lit(float(v)))])
            terms.append(m[F.col(c)])
        for c, (value, beta) in self.flags.items():
            terms.append(F.when(F.col(c) == F.lit(value), F.lit(float(beta))).otherwise(F.lit(0.0)))
        if self.interaction:
            cat, value, num, beta = self.interaction
            mean, sd, _ = self.numeric[num]
            terms.append(F.lit(float(beta)) * (F.col(cat) == F.lit(value)).cast("double")
                         * zscore(num, mean, sd))
        return functools.reduce(lambda a, b: a + b, terms)

    def probability(self) -> Column:
        return sigmoid(self.linear())


def linear_score(df: DataFrame, card: Scorecard, out: str = "score",
                 z_out: str | None = None) -> DataFrame:
    """K2: add the scorecard probability (and optionally the linear term)."""
    if z_out:
        df = df.withColumn(z_out, card.linear())
    return df.withColumn(out, card.probability())


# ---------------------------------------------------------------- K3
def calibrate_intercept(df: DataFrame, group_cols: Sequence[str], z: str,
                        target_rate: float | str, lo: float = -15.0, hi: float = 15.0,
                        max_rounds: int = 60, tol: float = 1e-13,
                        z_digits: int | None = None) -> DataFrame:
    """K3: per group, the intercept b with mean(sigmoid(z + b)) = target.

    ``target_rate`` is a constant or a column holding the per-row target
    (its per-group average is used).  The mean is increasing in b, so each
    group keeps a bracket [lo, hi] that is shrunk every round; the next
    point is the Newton step when it falls inside the bracket, else the
    midpoint (plain bisection, as in the reference, is the fallback).  One
    grouped aggregate per round over the (group, distinct z) table; the
    loop stops when every group's |mean - target| < ``tol``.  ``z_digits``
    rounds z first (approximate mode); by default distinct z are exact.
    """
    if not group_cols:  # one constant group key instead of a cross join
        df, group_cols = df.withColumn("__all", F.lit(0)), ["__all"]
    group_cols = list(group_cols)
    zc = F.col(z).cast("double")
    if z_digits is not None:
        zc = F.round(zc, z_digits)
    tgt = F.lit(float(target_rate)) if not isinstance(target_rate, str) else \
        F.col(target_rate).cast("double")
    zt = (df.groupBy(*group_cols, zc.alias("__z"))
          .agg(F.count(F.lit(1)).alias("__n"), F.sum(tgt).alias("__tsum")))
    zt = materialize(zt)  # reused by every round
    state = zt.groupBy(*group_cols).agg((F.sum("__tsum") / F.sum("__n")).alias("__t")).select(
        *group_cols, "__t", F.lit(lo).alias("__lo"), F.lit(hi).alias("__hi"),
        F.lit((lo + hi) / 2).alias("__b"), F.lit(None).cast("double").alias("__err"))
    state = materialize(state)
    for _ in range(max_rounds):
        s = sigmoid(F.col("__z") + F.col("__b"))
        # one state row per group: Spark broadcasts it below its size threshold and else
        # joins by group, splitting a hot one
        j = zt.join(state, group_cols)
        ev = j.groupBy(*group_cols, "__t", "__lo", "__hi", "__b").agg(
            (F.sum(F.col("__n") * s) / F.sum("__n")).alias("__m"),
            (F.sum(F.col("__n") * s * (1 - s)) / F.sum("__n")).alias("__d"))
        below = F.col("__m") < F.col("__t")
        nlo = F.when(below, F.col("__b")).otherwise(F.col("__lo"))
        nhi = F.when(below, F.col("__hi")).otherwise(F.col("__b"))
        newton = F.col("__b") - (F.col("__m") - F.col("__t")) / F.col("__d")
        ok = (F.col("__d") > 0) & (newton >= nlo) & (newton <= nhi)
        nxt = ev.select(*group_cols, "__t", nlo.alias("__lo"), nhi.alias("__hi"),
                        F.when(ok, newton).otherwise((nlo + nhi) / 2).alias("__b"),
                        F.abs(F.col("__m") - F.col("__t")).alias("__err"))
        # one small row per group; a reliable checkpoint cuts the lineage so
        # every round plans from scratch (the plan does not grow with rounds)
        state = materialize(nxt)
        worst = state.agg(F.max(F.least("__err", F.col("__hi") - F.col("__lo")))).first()[0]
        if worst is None or worst < tol:
            break
    else:
        raise RuntimeError(f"not converged after {max_rounds} rounds: |mean - target| is {worst}")
    return state.select(*group_cols, F.col("__t").alias("target_rate"),
                        F.col("__b").alias("intercept")).drop("__all")


# ---------------------------------------------------------------- M23, M24
def probability_column(df: DataFrame, prob_vec: str = "probability",
                       out: str = "probability_1") -> DataFrame:
    """Positive-class probability from an ML probability vector."""
    return df.withColumn(out, vector_to_array(F.col(prob_vec))[1])


def score_batch(df: DataFrame, model, threshold: float = DECISION_THRESHOLD,
                model_version: str | None = None, keep: Sequence[str] = (),
                prefix: str = "churn") -> DataFrame:
    """One scoring pass; a single request is a one-row batch, so
    single and batch answers are the same by construction."""
    scored = probability_column(model.transform(df), out="__p")
    return scored.select(
        *keep,
        F.round("__p", 4).alias(f"{prefix}_probability"),
        decision("__p", threshold).alias(f"{prefix}_prediction"),
        risk_band("__p").alias("risk_band"),
        F.lit(model_version).cast("string").alias("model_version"),
        F.lit(float(threshold)).alias("threshold"))


def bands_from_probability(df: DataFrame, p: str, threshold: float = DECISION_THRESHOLD,
                           prefix: str = "churn") -> DataFrame:
    """M23 on an existing probability column (e.g. a scorecard)."""
    return df.withColumns({f"{prefix}_probability": F.round(p, 4),
                           f"{prefix}_prediction": decision(p, threshold),
                           "risk_band": risk_band(p)})


# ---------------------------------------------------------------- B12
@dataclass(frozen=True)
class FieldRule:
    """One field of a row contract."""

    name: str
    kind: str  # "int" | "double" | "string"
    ge: float | None = None
    gt: float | None = None
    le: float | None = None
    allowed: tuple[str, ...] | None = None  # closed domain
    min_len: int | None = None
    max_len: int | None = None
    required: bool = True


def _rule_errors(df: DataFrame, r: FieldRule) -> Column:
    if r.name not in df.columns:
        return F.lit(f"{r.name}: field required") if r.required else F.lit(None).cast("string")
    raw = F.col(r.name)
    missing = raw.isNull()
    checks: list[tuple[Column, str]] = [(missing, "field required")] if r.required else []
    if r.kind in ("int", "double"):
        txt = raw.cast("string")
        num = txt.try_cast("double")
        checks.append((~missing & num.isNull(), f"not a valid {'integer' if r.kind == 'int' else 'number'}"))
        if r.kind == "int":
            checks.append((num.isNotNull() & (num != F.floor(num)), "not a valid integer"))
        if r.ge is not None:
            checks.append((num < F.lit(float(r.ge)), f"must be >= {r.ge}"))
        if r.gt is not None:
            checks.append((num <= F.lit(float(r.gt)), f"must be > {r.gt}"))
        if r.le is not None:
            checks.append((num > F.lit(float(r.le)), f"must be <= {r.le}"))
    else:
        txt = raw.cast("string")
        if r.allowed is not None:
            checks.append((~missing & ~txt.isin(list(r.allowed)), "value not allowed"))
        if r.min_len is not None:
            checks.append((F.length(txt) < r.min_len, f"length must be >= {r.min_len}"))
        if r.max_len is not None:
            checks.append((F.length(txt) > r.max_len, f"length must be <= {r.max_len}"))
    expr = None
    for cond, msg in checks:
        e = F.when(F.coalesce(cond, F.lit(False)), F.lit(f"{r.name}: {msg}"))
        expr = e if expr is None else F.coalesce(expr, e)  # first failing check per field
    return expr if expr is not None else F.lit(None).cast("string")


def validate_rows(df: DataFrame, rules: Sequence[FieldRule], errors: str = "errors") -> DataFrame:
    """Add ``errors`` (array of ``field: reason``, empty when valid)."""
    arr = F.array_compact(F.array(*[_rule_errors(df, r) for r in rules]))
    return df.withColumn(errors, arr)


def split_valid(validated: DataFrame, errors: str = "errors") -> tuple[DataFrame, DataFrame]:
    """Valid rows and the quarantine (rows with at least one error)."""
    ok = F.size(errors) == 0
    return validated.where(ok).drop(errors), validated.where(~ok)


# The serving contract of the churn panel (ranges, closed domains).
CHURN_RULES = (
    FieldRule("age", "int", ge=18, le=120),
    FieldRule("gender", "string", allowed=("F", "M")),
    FieldRule("region", "string", min_len=1, max_len=60),
    FieldRule("senior_citizen", "string", allowed=("Yes", "No")),
    FieldRule("contract_type", "string", allowed=("Month-to-month", "One year", "Two year")),
    FieldRule("tenure_months", "int", ge=0, le=600),
    FieldRule("monthly_charges", "double", gt=0, le=1000),
    FieldRule("payment_method", "string", min_len=1, max_len=60),
    FieldRule("paperless_billing", "string", allowed=("Yes", "No")),
    FieldRule("monthly_usage_gb", "double", ge=0, le=10_000),
    FieldRule("support_tickets_30d", "int", ge=0, le=100),
    FieldRule("avg_session_minutes", "double", ge=0, le=1440),
    FieldRule("num_services", "int", ge=1, le=20),
    FieldRule("late_payments_3m", "int", ge=0, le=50),
)
