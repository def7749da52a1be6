"""Association between variables and the target.

Everything is a grouped aggregate over the panel; the statistics (chi-square
with Yates' correction, Cramer's V, point-biserial r) are closed-form
expressions over those aggregates, and p-values are column expressions too.  The correlation matrix multiplies blocks in numpy.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch.functions.scalar import (
    regime_label, relative_change, safe_corr, signed_percent_text,
)
from panelwatch.functions.stats import chi2_pvalue, correlation_pvalue
from panelwatch.operators.profile import period_category_rate, unpivot_categorical, unpivot_numeric
from panelwatch.session import materialize
from panelwatch.spec import PanelSpec, RegimeSpec


def _t(spec: PanelSpec):
    return F.col(spec.target).cast("double")


# ---------------------------------------------------------------- D18
def category_gap_by_regime(df: DataFrame, spec: PanelSpec, column: str, a: str, b: str,
                           regimes: RegimeSpec) -> DataFrame:
    """Per period gap ``rate(a) - rate(b)``, averaged per regime (mean of
    monthly gaps, not the pooled gap)."""
    rates = period_category_rate(df, spec, column, [a, b])
    ca, cb = rates.columns[1], rates.columns[2]
    return (rates.withColumn("gap", F.col(ca) - F.col(cb))
            .withColumn("regime", regime_label(spec.period, regimes))
            .groupBy("regime").agg(F.avg("gap").alias("mean_gap"),
                                   F.count("gap").alias("n_periods")))


# ---------------------------------------------------------------- D19, D20, D21
def period_correlations(df: DataFrame, spec: PanelSpec, columns: Sequence[str]) -> DataFrame:
    """Per period Pearson r of each variable with the target, long form."""
    wide = df.groupBy(spec.period).agg(*[safe_corr(c, _t(spec)).alias(c) for c in columns])
    return wide.unpivot([spec.period], list(columns), "column", "corr")


def correlation_regime_summary(corrs: DataFrame, spec: PanelSpec, regimes: RegimeSpec,
                               digits: int = 3) -> DataFrame:
    """Mean of the monthly correlations per regime and the change from
    the first to the last regime, rounded to ``digits``."""
    labels = list(regimes.labels)
    per = (corrs.withColumn("regime", regime_label(spec.period, regimes))
           .groupBy("column").pivot("regime", labels).agg(F.avg("corr")))
    return per.select(
        "column", *[F.round(F.col(lab), digits).alias(f"mean_{lab}") for lab in labels],
        F.round(F.col(labels[-1]) - F.col(labels[0]), digits).alias("change"))


def pooled_correlation(df: DataFrame, spec: PanelSpec, columns: Sequence[str],
                       regimes: RegimeSpec) -> DataFrame:
    """Correlation pooled over all rows of each regime (not the mean of
    monthly values)."""
    wide = (df.withColumn("regime", regime_label(spec.period, regimes))
            .groupBy("regime").agg(*[safe_corr(c, _t(spec)).alias(c) for c in columns]))
    return wide.unpivot(["regime"], list(columns), "column", "corr")


# ---------------------------------------------------------------- D22, D23
#: columns of a tile of the correlation matrix
TILE = 128
#: a variance below this part of its scale is rounding: no correlation
FLAT = 1e-13


def _tile_sums(x: np.ndarray, known: np.ndarray, a: slice, b: slice) -> np.ndarray:
    """Sums over the rows where both columns are known, for all pairs of two tiles: n, x, y, xx, yy, xy."""
    xa, xb, ka, kb = x[:, a], x[:, b], known[:, a], known[:, b]
    return np.stack([ka.T @ kb, xa.T @ kb, ka.T @ xb, (xa * xa).T @ kb, ka.T @ (xb * xb), xa.T @ xb])


def correlation_matrix(df: DataFrame, columns: Sequence[str], tile: int | None = None) -> DataFrame:
    """Pearson r for every pair ``a < b`` in column order, over the rows where both are known (null where
    one of them does not vary there).

    A task multiplies blocks of rows tile by tile (``TILE`` columns each) and sends six sums of each pair; sums of a
    pair of tiles are added in one group, which also turns them into r.  Values are centred at the columns' means first, so large
    levels lose no digits.  Work grows with the square of the columns as a matrix product, not as that many aggregates."""
    cols, size = list(columns), tile or TILE
    spark = df.sparkSession
    if len(cols) < 2:
        return spark.createDataFrame([], "col_a string, col_b string, r double")
    means = dict(unpivot_numeric(df, cols).where(~F.isnan("value")).groupBy("column").agg(F.avg("value")).collect())  # one row a column
    centre = np.array([means.get(c) or 0.0 for c in cols])
    cuts = [slice(i, min(i + size, len(cols))) for i in range(0, len(cols), size)]
    pairs = [(i, j) for i in range(len(cuts)) for j in range(i, len(cuts))]
    wide = df.select(F.array(*[F.col(c).cast("double") for c in cols]).alias("x"))

    def add(batches):
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                x = np.asarray(batch.column(0).slice(at, 4096).flatten().fill_null(np.nan)).reshape(-1, len(cols)) - centre
                known = (~np.isnan(x)).astype(np.float64)
                x = np.where(known > 0, x, 0.0)
                for p in pairs:
                    s = _tile_sums(x, known, cuts[p[0]], cuts[p[1]])
                    sums[p] = sums[p] + s if p in sums else s
        task = TaskContext.get().partitionId()
        for (i, j), s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([task], pa.int32()),
                                              pa.array([s.tobytes()], pa.binary())], names=["i", "j", "task", "s"])

    def finish(rows: pa.Table) -> pa.Table:
        parts = sorted(rows.to_pylist(), key=lambda r: r["task"])
        a, b = cuts[parts[0]["i"]], cuts[parts[0]["j"]]
        n, sx, sy, sxx, syy, sxy = np.sum([np.frombuffer(r["s"]) for r in parts], axis=0).reshape(6, a.stop - a.start, b.stop - b.start)
        vx, vy, ca, cb = n * sxx - sx * sx, n * syy - sy * sy, centre[a, None], centre[None, b]
        with np.errstate(all="ignore"):
            r = (n * sxy - sx * sy) / np.sqrt(vx * vy)
            flat = (vx <= FLAT * n * sxx) | (vy <= FLAT * n * syy) | (vx <= (n * FLAT * ca) ** 2) | (vy <= (n * FLAT * cb) ** 2)
        r = np.where(flat | ~np.isfinite(r), np.nan, np.clip(r, -1, 1))
        at = [(p, q) for p in range(a.start, a.stop) for q in range(b.start, b.stop) if p < q]
        return pa.table({"col_a": [cols[p] for p, _ in at], "col_b": [cols[q] for _, q in at],
                         "r": pa.array([None if np.isnan(v := r[p - a.start, q - b.start]) else float(v) for p, q in at], pa.float64())},
                        schema=pa.schema([("col_a", pa.string()), ("col_b", pa.string()), ("r", pa.float64())]))

    return wide.mapInArrow(add, "i int, j int, task int, s binary").groupBy("i", "j").applyInArrow(finish, "col_a string, col_b string, r double")


def strong_pairs(matrix: DataFrame, threshold: float = 0.30) -> DataFrame:
    """Pairs with ``|r| > threshold`` (strict)."""
    return matrix.where(F.abs("r") > F.lit(threshold)).orderBy(F.abs("r").desc())


# ---------------------------------------------------------------- D24-D26
def contingency(df: DataFrame, column: str, target: str) -> DataFrame:
    """Long contingency table ``(value, target, n)``."""
    return df.groupBy(F.col(column).alias("value"), F.col(target).alias("target")).agg(
        F.count(F.lit(1)).alias("n"))


def chi_square(df: DataFrame, spec: PanelSpec, columns: Sequence[str],
               yates: bool = True, with_pvalue: bool = False) -> DataFrame:
    """D25 + D26: chi-square test of independence of each categorical column
    with the binary target, with Yates' correction when dof = 1 (the
    correction never exceeds |O - E|), and Cramer's V on the same statistic.

    Cells are counted per (column, value) with both target classes as
    columns, so empty cells are present as zeros."""
    t = F.col(spec.target)
    long = unpivot_categorical(df, columns, keep=[spec.target]).where(F.col("value").isNotNull())
    cells = long.groupBy("column", "value").agg(F.count_if(t == 0).alias("o0"),
                                                F.count_if(t == 1).alias("o1"))
    cells = materialize(cells)  # one row per distinct value; read twice
    per = cells.groupBy("column").agg(  # one row per tested column
        F.sum("o0").alias("c0"), F.sum("o1").alias("c1"), F.count(F.lit(1)).alias("n_values"))
    tab = cells.join(F.broadcast(per), "column").select(
        "column", "o0", "o1", (F.col("o0") + F.col("o1")).alias("r"), "c0", "c1", "n_values")
    n = F.col("c0") + F.col("c1")
    n_cls = (F.col("c0") > 0).cast("int") + (F.col("c1") > 0).cast("int")
    dof = (F.col("n_values") - 1) * (n_cls - 1)
    tab = tab.withColumn("n", n).withColumn("dof", dof).withColumn("k", n_cls)

    def term(o: str, c: str):
        e = F.col("r") * F.col(c) / F.col("n")
        d = F.abs(F.col(o) - e)
        if yates:
            d = F.when(F.col("dof") == 1, d - F.least(F.lit(0.5), d)).otherwise(d)
        return F.when(e > 0, d * d / e).otherwise(F.lit(0.0))

    stat = tab.groupBy("column").agg(
        F.sum(term("o0", "c0") + term("o1", "c1")).alias("chi2"),
        F.first("dof").alias("dof"), F.first("n").alias("n"),
        F.first("n_values").alias("n_values"), F.first("k").alias("k"))
    out = stat.select(
        "column", "chi2", F.col("dof").cast("int").alias("dof"),
        F.sqrt(F.try_divide(F.col("chi2"), F.col("n") * (F.least("n_values", "k") - 1)))
        .alias("cramers_v"))
    if with_pvalue:
        out = (out.withColumn("p_value", chi2_pvalue(F.col("chi2"), F.col("dof").cast("double")))
               .withColumn("significant", F.col("p_value") < F.lit(0.05)))
    return out.orderBy(F.col("cramers_v").desc_nulls_last(), "column")


# ---------------------------------------------------------------- D27
def point_biserial(df: DataFrame, spec: PanelSpec, columns: Sequence[str],
                   with_pvalue: bool = False) -> DataFrame:
    """R with the target, mean per class and relative difference
    ``m1 / m0 - 1``; ordered by |r| descending."""
    t = F.col(spec.target)
    aggs = [F.count(F.lit(1)).alias("__n")]
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [safe_corr(c, _t(spec)).alias(f"{c}__r"),
                 F.avg(F.when(t == 1, x)).alias(f"{c}__m1"),
                 F.avg(F.when(t == 0, x)).alias(f"{c}__m0"),
                 F.count(x).alias(f"{c}__n")]
    wide = df.agg(*aggs)
    rows = F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}__r").alias("r"),
                 F.col(f"{c}__m1").alias("mean_positive"),
                 F.col(f"{c}__m0").alias("mean_negative"),
                 F.col(f"{c}__n").alias("n")) for c in columns]))
    out = wide.select(rows).withColumn(
        "relative_diff", relative_change("mean_positive", "mean_negative")).withColumn(
        "relative_diff_text", signed_percent_text("relative_diff"))
    if with_pvalue:
        out = out.withColumn("p_value", correlation_pvalue(F.col("r"), F.col("n")))
    return out.orderBy(F.abs("r").desc_nulls_last(), "column")
