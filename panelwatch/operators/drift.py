"""Drift monitoring: every period against a reference slice.

Per column and period (all periods in one plan, reference statistics
computed once):

* numeric columns (and the prediction): Wasserstein-1 distance between the
  period's and the reference's empirical distributions, divided by the
  reference population sd (sd 0: 0 when W1 is 0, otherwise null and
  flagged);
* categorical columns: Jensen-Shannon distance (natural log) of the value
  shares.

Both use threshold 0.1 (higher = drift).  The monthly record then counts
drifted features, adds the AUC and its delta against the reference AUC, and
applies the status policy.

**Exact W1 without copying the reference per period.**  With ``F`` the reference CDF and ``J`` its integral from some
start on, a period's own CDF is the constant ``k`` between two consecutive points ``a < b``, so

    int_a^b |F - k| = J(b) - J(a) - k (b - a) + 2 (k (c - a) - (J(c) - J(a)))

with ``c = clamp(q_k, a, b)`` and ``q_k`` the first reference value whose CDF reaches ``k``.  The points of all periods and of the
reference are range-partitioned by (column, value) once.  A task integrates over its own range for every period, from what comes
before the range: one row per (range, column, period), added up beforehand.  The sums over ranges are exact, the work is linear in
the number of points, and no task holds a whole column or period.

Nothing stores raw rows.  One scan expands each row into cells ``(role, column, value)``, one
for each column and one for the row itself (its score and label), and one aggregate counts equal cells
(:func:`panel_counts`).  Distances, row counts and AUC all come from this table, so a model in front of it
scores each row once.  The table is mergeable: kept by period (``sources/profile_store.py``), a new period adds its own counts
and no earlier row is read again.

Every analysed period has a row for every column: where a column is empty in the period or in the reference its
score is null and counts as drift.

Jensen-Shannon needs only the values present on both sides:
``JS^2 = 1/2 sum_both [p ln(2p/(p+q)) + q ln(2q/(p+q))]
+ 1/2 ln 2 (2 - sum_both p - sum_both q)``, an inner equi-join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwatch.functions.scalar import (
    AUC_DROP_THRESHOLD, DRIFT_SHARE_THRESHOLD, drift_status, regime_label,
)
from panelwatch.functions.stats import chi2_pvalue
from panelwatch.operators.metrics import ranking_from_counts
from panelwatch.operators.panel_profile import (
    CATEGORICAL, NUMERIC, ROWS, RUNS, is_profile, pack_runs, panel_profile, place, text_counts,
)
from panelwatch.session import materialize
from panelwatch.spec import PanelSpec, RegimeSpec

DRIFT_THRESHOLD = 0.1  # fallback threshold of the reference, used for both distances
P_VALUE_THRESHOLD = 0.05
LOW_MEANS_DRIFT = ("chi_square",)


def panel_counts(df: DataFrame, period: str, numeric: Sequence[str], categorical: Sequence[str],
                 rank: str | None = None, target: str | None = None) -> DataFrame:
    """``(period, role, column, num, text, label, n)``: how often each value occurs in each period, from one
    pass over the rows.  ``num`` holds numeric values (null where missing or NaN), ``text`` categorical ones; the
    cells of role ``rows`` hold the ranking score and the target."""
    null = F.lit(None)

    def cell(number: int, num=None, text=None, label=None):
        num = null.cast("double") if num is None else F.when(~F.isnan(F.col(num).cast("double")), F.col(num).cast("double"))
        return F.struct(F.lit(number).alias("__cell"), num.alias("num"),
                        (null if text is None else F.col(text)).cast("string").alias("text"),
                        (null if label is None else F.col(label)).cast("int").alias("label"))

    kinds = [(NUMERIC, c, {"num": c}) for c in numeric] + [(CATEGORICAL, c, {"text": c}) for c in categorical]
    kinds.append((ROWS, "", {"num": rank, "label": target}))
    cells = [cell(i, **use) for i, (_, _, use) in enumerate(kinds)]
    # keys travel with the number of their cell, and get its names when they are counted
    counted = df.select(period, F.inline(F.array(*cells))).groupBy(period, "__cell", "num", "text", "label").agg(F.count(F.lit(1)).alias("n"))
    role, column = (F.array(*[F.lit(k[i]) for k in kinds])[F.col("__cell")] for i in (0, 1))
    return counted.select(period, role.alias("role"), column.alias("column"), "num", "text", "label", "n")


def _sides(period: str, reference: Sequence[str], periods: Sequence[str] | None):
    """Conditions for the reference and for the analysed periods (default: all others)."""
    is_ref = F.col(period).isin(list(reference))
    return is_ref, (~is_ref if periods is None else F.col(period).isin(list(periods)))


def _counted(long: DataFrame, period: str, reference, periods, numeric: bool) -> DataFrame:
    """Counts per (period, column, value) of a long table."""
    is_ref, analysed = _sides(period, reference, periods)
    v = F.col("value")
    known = v.isNotNull() & ~F.isnan(v) if numeric else v.isNotNull()
    return materialize(long.where(known & (is_ref | analysed)).groupBy(period, "column", "value").agg(F.count(F.lit(1)).alias("n")))


def cell_sizes(cells: DataFrame, period: str) -> DataFrame:
    """``(period, role, column, n, values, known)`` of ``panel_counts`` cells: rows, cells with a value and rows with a value
    (of a profile, ``values`` adds up the points of its rows).

    One pass over the cells gives everything that needs only sums of them: the grid of columns, row counts, totals of
    shares and the number of points to place.  One row per (period, column)."""
    if is_profile(cells):
        return materialize(cells.groupBy(period, "role", "column").agg(
            F.sum("n").alias("n"), F.sum("points").alias("values"), F.sum("known").alias("known")))
    has = F.when(F.col("role") == NUMERIC, F.col("num").isNotNull()).otherwise(F.col("text").isNotNull())
    return materialize(cells.groupBy(period, "role", "column").agg(
        F.sum("n").alias("n"), F.count_if(has).alias("values"), F.sum(F.when(has, F.col("n")).otherwise(0)).alias("known")))


def wasserstein_by_period(long: DataFrame, period: str, reference: Sequence[str],
                          periods: Sequence[str] | None = None) -> DataFrame:
    """R4 on a long numeric table ``(period, column, value)``."""
    return wasserstein_from_counts(_counted(long, period, reference, periods, True), period, reference, periods)


#: points that a task of the W1 scan holds about
RANGE_POINTS = 1 << 20


def _area_terms(a, b, k, start, base, u, f):
    """Integral of ``|F - k|`` over each ``[a, b]``; ``F`` is ``base`` from ``start`` on and ``f`` from each ``u`` on."""
    u, f = np.concatenate([[start], u]), np.concatenate([[base], f])
    j = np.concatenate([[0.0], np.cumsum(f[:-1] * np.diff(u))])

    def area(x):
        at = np.searchsorted(u, x, side="right") - 1
        return j[at] + f[at] * (x - u[at])

    q = np.searchsorted(f, k, side="left")  # the first reference value whose CDF reaches k
    c = np.clip(np.where(q < len(u), u[np.minimum(q, len(u) - 1)], b), a, b)
    ja = area(a)
    return (area(b) - ja) - k * (b - a) + 2 * (k * (c - a) - (area(c) - ja))


def _pack(batches):
    """The points of a task (one range of ``(column, value)``) as one row for each column."""
    held = pa.Table.from_batches([x for x in batches if x.num_rows] or [_none(pa.null())]).combine_chunks()
    if held.num_rows:
        yield from pack_runs(TaskContext.get().partitionId(), *(held.column(c).to_numpy() for c in ("__column", "__time", "value", "n")))


def _run_totals(packed: DataFrame, is_ref: np.ndarray, is_cur: np.ndarray):
    """What comes before each run of each column: ``{column: (n_ref, mean_ref, periods, n, {run: (start, end, ref before, n before)})}``,
    with the numbers of columns and periods.

    Made from one row per (run, column), with sums for each period in it, which is all that the driver reads."""
    by: dict = {}
    for r in packed.select("run", "column", "times", "n", "sums", "low", "high").collect():
        by.setdefault(r["column"], []).append(
            (r["run"], np.array(r["times"]), np.array(r["n"]), np.array(r["sums"]), np.array(r["low"]), np.array(r["high"])))
    out = {}
    for column, rows in by.items():
        rows.sort(key=lambda r: r[0])
        n_ref = sum(int(n[is_ref[t]].sum()) for _, t, n, *_ in rows)
        periods = np.unique(np.concatenate([t[is_cur[t] & (n > 0)] for _, t, n, *_ in rows]))
        if not n_ref or not len(periods):
            continue
        low = min(x.min() for _, t, _, _, lo, _ in rows if len(x := lo[is_ref[t]]))
        high = max(x.max() for _, t, _, _, _, hi in rows if len(x := hi[is_ref[t]]))
        mean = low if low == high else math.fsum(x for _, t, _, sums, _, _ in rows for x in sums[is_ref[t]]) / n_ref
        number = np.full(len(is_ref), -1)
        number[periods] = np.arange(len(periods))
        own, refs = np.zeros((len(rows) + 1, len(periods)), np.int64), np.zeros(len(rows) + 1, np.int64)
        for i, (_, t, n, *_) in enumerate(rows):
            mine = is_cur[t] & (n > 0)
            own[i + 1, number[t[mine]]] = n[mine]
            refs[i + 1] = n[is_ref[t]].sum()
        start, end = np.array([lo.min() for *_, lo, _ in rows]), np.array([hi.max() for *_, hi in rows])
        own, refs = own.cumsum(axis=0), refs.cumsum()
        end[:-1] = start[1:]  # a run ends where the next one begins
        out[column] = (n_ref, mean, periods, own[-1], {r[0]: (start[i], end[i], int(refs[i]), own[i]) for i, r in enumerate(rows)})
    return out


def wasserstein_from_counts(counts: DataFrame, period: str, reference: Sequence[str],
                            periods: Sequence[str] | None = None, sizes: DataFrame | None = None) -> DataFrame:
    """``(period, column, w1, sd_ref, score)`` from counts ``(period, column, value, n)``, for the given
    periods (default: all that are not in the reference).  ``sizes`` holds the number of counts per (period, column) as
    ``values``, where it is known already.

    Points travel with the numbers of their column and period, and a range of them is kept as one row for each column."""
    spark = counts.sparkSession
    is_ref, analysed = _sides(period, reference, periods)
    points = counts.where(is_ref | analysed)
    if sizes is None:
        sizes = points.groupBy(period, "column").agg(F.count(F.lit(1)).alias("values"))
    layout = _layout(sizes.withColumn("role", F.lit(NUMERIC)), period, reference, periods)
    # neighbouring ranges are merged by measured size, unless a range would hold too many points
    ranges = -(-sum(layout.points.values()) // RANGE_POINTS)
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = points.join(layout.codes, [period, "column"]).select("__column", "__time", F.col("value").cast("double").alias("value"), F.col("n").cast("long").alias("n"))
    placed = placed.repartitionByRange(*([ranges] if ranges > usual else []), "__column", "value")
    return _wasserstein(materialize(placed.mapInArrow(_pack, RUNS)), layout, period)


@dataclass(frozen=True)
class _Layout:
    """Numbers of the columns and periods to place, the numbers of points, and which periods are in the reference or analysed."""

    codes: DataFrame  # (period, role, column, __column, __time): one row per (period, column)
    columns: int  # numeric columns; the scores of the rows have the next number
    times: list
    of_ref: np.ndarray
    of_cur: np.ndarray
    points: dict


def _layout(sizes: DataFrame, period: str, reference: Sequence[str], periods: Sequence[str] | None) -> _Layout:
    """Made from the sizes ``(period, role, column, values)``, one row per (period, column)."""
    is_ref, analysed = _sides(period, reference, periods)
    sides = sizes.where((is_ref | analysed) & F.col("column").isNotNull()).select(
        period, "role", "column", "values", F.coalesce(is_ref, F.lit(False)).alias("ref"), F.coalesce(analysed, F.lit(False)).alias("cur")).collect()
    columns, times = sorted({r["column"] for r in sides if r["role"] == NUMERIC}), sorted({r[period] for r in sides})
    in_ref, in_cur = ({r[period] for r in sides if r[x]} for x in ("ref", "cur"))
    of_ref, of_cur = (np.array([t in x for t in times], bool) for x in (in_ref, in_cur))
    column_of, time_of = {(NUMERIC, c): i for i, c in enumerate(columns)} | {(ROWS, ""): len(columns)}, {t: i for i, t in enumerate(times)}
    kind = T.StructType([T.StructField(period, sizes.schema[period].dataType), T.StructField("role", T.StringType()), T.StructField("column", T.StringType()),
                         T.StructField("__column", T.IntegerType()), T.StructField("__time", T.IntegerType())])
    points: dict = {}
    for r in sides:
        c = column_of[r["role"], r["column"]]
        points[c] = points.get(c, 0) + r["values"]
    codes = F.broadcast(sizes.sparkSession.createDataFrame(
        [(r[period], r["role"], r["column"], column_of[r["role"], r["column"]], time_of[r[period]]) for r in sides], kind))
    return _Layout(codes, len(columns), times, of_ref, of_cur, points)


def _placed(profile: DataFrame, sizes: DataFrame, period: str, reference: Sequence[str], periods: Sequence[str] | None,
            roles: Sequence[str] = (NUMERIC,)) -> tuple[DataFrame, _Layout]:
    """Runs of the values of a profile, and of its rows' scores where ``roles`` has them (times of label y: twice the time, plus y)."""
    layout = _layout(sizes.where(F.col("role").isin(list(roles)) & (F.col("values") > 0)), period, reference, periods)
    label = F.col("label")
    rows = profile.where((F.col("role") == NUMERIC) | label.isin(0, 1)).join(layout.codes, [period, "role", "column"]).select(
        "__column", F.when(F.col("role") == ROWS, 2 * F.col("__time") + label).otherwise(F.col("__time")).alias("__time"), "marks", "values", "counts")
    return materialize(place(rows, layout.points, RANGE_POINTS)), layout


def _wasserstein(packed: DataFrame, layout: _Layout, period: str) -> DataFrame:
    """R4 from the runs of all columns."""
    spark = packed.sparkSession
    codes, of_ref, of_cur = layout.codes, layout.of_ref, layout.of_cur
    packed = packed.where(F.col("column") < layout.columns)
    known = _run_totals(packed, of_ref, of_cur)
    shared = spark.sparkContext.broadcast(known)

    def run(batches):
        for r in (batch.slice(i, 1).to_pylist()[0] for batch in batches for i in range(batch.num_rows)):
            if r["column"] not in shared.value:
                continue
            n_ref, mean, seen, total, runs = shared.value[r["column"]]
            start, end, ref_before, before = runs[r["run"]]
            value, n = np.frombuffer(r["values"], np.float64), np.frombuffer(r["counts"], np.int64)
            owner = np.repeat(np.array(r["times"]), np.diff(r["stops"], prepend=0))
            at = np.flatnonzero(of_ref[owner])
            at = at[np.argsort(value[at], kind="stable")]
            u, f = value[at], (ref_before + np.cumsum(n[at])) / n_ref
            spread = float((n[at] * (u - mean) ** 2).sum())
            number = np.full(len(of_ref), -1)
            number[seen] = np.arange(len(seen))
            c = np.flatnonzero(number[owner] >= 0)  # by period and value
            s, v, w = number[owner[c]], value[c], n[c]
            first, last = (np.searchsorted(s, np.arange(len(seen)), side=x) for x in ("left", "right"))
            upto = np.cumsum(w)
            upto = upto - np.concatenate([[0], upto])[first][s] + before[s]
            # of each period: from the run's start to its first point, between its points, and on to the run's end
            level = np.insert(upto, first, before) / np.insert(total[s], first, total)
            terms = _area_terms(np.insert(v, first, start), np.insert(v, last, end), level, start, ref_before / n_ref, u, f)
            w1 = np.bincount(np.insert(s, first, np.arange(len(seen))), terms, len(seen))
            yield pa.RecordBatch.from_arrays([pa.array([r["column"]] * (len(seen) + 1), pa.int32()), pa.array([*seen, None], pa.int32()),
                                              pa.array([*w1, None], pa.float64()), pa.array([None] * len(seen) + [spread], pa.float64())],
                                             names=["__column", "__time", "w1", "spread"])

    parts = packed.mapInArrow(run, "__column int, __time int, w1 double, spread double")
    sums = materialize(parts.groupBy("__column", "__time").agg(F.sum("w1").alias("w1"), F.sum("spread").alias("spread")))  # one row per (period, column)
    shared.unpersist()
    size = F.create_map(*[x for c, k in known.items() for x in (F.lit(c), F.lit(k[0]))]) if known else F.lit(None).cast("map<int, bigint>")
    sd = sums.where(F.col("spread").isNotNull()).select("__column", F.sqrt(F.col("spread") / size[F.col("__column")]).alias("sd_ref"))
    w1 = sums.where(F.col("w1").isNotNull()).select("__column", "__time", "w1").join(F.broadcast(sd), "__column").join(codes, ["__column", "__time"])  # one row per column
    score = (F.when(F.col("sd_ref") > 0, F.col("w1") / F.col("sd_ref"))
             .when(F.abs(F.col("w1")) < F.lit(1e-12), F.lit(0.0)))
    return w1.select(period, "column", F.greatest(F.col("w1"), F.lit(0.0)).alias("w1"),
                     "sd_ref", score.alias("score"))


def _auc(packed: DataFrame, layout: _Layout) -> tuple[dict, float | None]:
    """M15 of each analysed period and of the reference, from the runs of the rows' scores (ties count half; None without both classes).

    A run adds ``positives * (negatives below + half of the ties)``, with the negatives of earlier runs
    from one row per run, which is all that the driver reads."""
    packed = packed.where(F.col("column") == layout.columns)
    slices = {int(t): [int(t)] for t in np.flatnonzero(layout.of_cur)} | {-1: np.flatnonzero(layout.of_ref).tolist()}
    neg, pos, below = dict.fromkeys(slices, 0), dict.fromkeys(slices, 0), {}
    for r in sorted(packed.select("run", "times", "n").collect(), key=lambda r: r["run"]):
        n = dict(zip(r["times"], r["n"]))
        below[r["run"]] = dict(neg)
        for k, of in slices.items():
            neg[k] += sum(n.get(2 * t, 0) for t in of)
            pos[k] += sum(n.get(2 * t + 1, 0) for t in of)
    shared = packed.sparkSession.sparkContext.broadcast(below)

    def run(batches):
        for r in (batch.slice(i, 1).to_pylist()[0] for batch in batches for i in range(batch.num_rows)):
            value, n = np.frombuffer(r["values"], np.float64), np.frombuffer(r["counts"], np.int64)
            parts = {t: (value[a:b], n[a:b]) for t, a, b in zip(r["times"], [0, *r["stops"]], r["stops"])}
            out = []
            for k, of in slices.items():
                (u, w), (v, p) = ([np.concatenate(x) for x in zip((value[:0], n[:0]), *(parts[2 * t + y] for t in of if 2 * t + y in parts))] for y in (0, 1))
                order = np.argsort(u, kind="stable")
                upto = np.concatenate([[0], np.cumsum(w[order])]) + shared.value[r["run"]][k]
                lower, through = (upto[np.searchsorted(u[order], v, side=x)] for x in ("left", "right"))
                out.append(float((p * (lower + through)).sum()) / 2)
            yield pa.RecordBatch.from_arrays([pa.array(list(slices), pa.int32()), pa.array(out, pa.float64())], names=["slice", "area"])

    area = {r["slice"]: r["area"] for r in packed.mapInArrow(run, "slice int, area double").groupBy("slice").agg(F.sum("area").alias("area")).collect()}
    shared.unpersist()
    auc = {k: area[k] / (pos[k] * neg[k]) if pos[k] and neg[k] else None for k in slices}
    return {layout.times[k]: v for k, v in auc.items() if k >= 0}, auc[-1]


def _none(kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([], kind)], names=["none"])


def jensen_shannon_by_period(long: DataFrame, period: str, reference: Sequence[str],
                             periods: Sequence[str] | None = None) -> DataFrame:
    """R5 on a long table ``(period, column, value)``."""
    return jensen_shannon_from_counts(_counted(long, period, reference, periods, False), period, reference, periods)


def jensen_shannon_from_counts(counts: DataFrame, period: str, reference: Sequence[str],
                               periods: Sequence[str] | None = None, totals: DataFrame | None = None) -> DataFrame:
    """``(period, column, score)`` Jensen-Shannon distance (natural log)
    between the value shares of each period and of the reference; null where the reference has no value.
    ``totals`` holds the sums of ``n`` per (period, column), where they are known already."""
    is_ref, analysed = _sides(period, reference, periods)
    if totals is None:
        totals = counts.groupBy(period, "column").agg(F.sum("n").alias("n"))
    counts = counts.withColumnRenamed("n", "nc")
    ref = counts.where(is_ref).groupBy("column", "value").agg(F.sum("nc").alias("nr"))
    # totals have one row per column, or per (period, column): broadcasts of proven size
    ref_total = totals.where(is_ref).groupBy("column").agg(F.sum("n").alias("tot_r"))
    cur = counts.where(analysed)
    tot = totals.where(analysed).select(period, "column", F.col("n").alias("tot_c"))
    both = (cur.join(ref, ["column", "value"]).join(F.broadcast(ref_total), "column")
            .join(F.broadcast(tot), [period, "column"]))
    p = F.col("nr") / F.col("tot_r")
    qq = F.col("nc") / F.col("tot_c")
    m = (p + qq) / 2
    agg = both.groupBy(period, "column").agg(
        F.sum(p * F.log(p / m) + qq * F.log(qq / m)).alias("kl"),
        F.sum(p).alias("sp"), F.sum(qq).alias("sq"))
    out = (tot.select(period, "column").join(F.broadcast(ref_total.select("column")), "column")
           .join(agg, [period, "column"], "left"))
    js2 = (F.lit(0.5) * F.coalesce("kl", F.lit(0.0))
           + F.lit(0.5 * math.log(2.0)) * (F.lit(2.0) - F.coalesce("sp", F.lit(0.0))
                                           - F.coalesce("sq", F.lit(0.0))))
    return out.select(period, "column", F.sqrt(F.greatest(js2, F.lit(0.0))).alias("score"))


def chi_square_by_period(long: DataFrame, period: str, reference: Sequence[str],
                         periods: Sequence[str] | None = None) -> DataFrame:
    """R6 on a long table ``(period, column, value)``."""
    return chi_square_from_counts(_counted(long, period, reference, periods, False), period, reference, periods)


def chi_square_from_counts(counts: DataFrame, period: str, reference: Sequence[str],
                           periods: Sequence[str] | None = None) -> DataFrame:
    """``(period, column, statistic, dof, score)``: p-value (``score``) of the
    chi-square test that a period's values have the reference's shares (table of two
    rows, values of either side; null with fewer than two values)."""
    is_ref, analysed = _sides(period, reference, periods)
    counts = counts.withColumnRenamed("n", "nc")
    ref = counts.where(is_ref).groupBy("column", "value").agg(F.sum("nc").alias("nr"))
    ref_total = ref.groupBy("column").agg(F.sum("nr").alias("tot_r"), F.count(F.lit(1)).alias("kinds"))
    cur = counts.where(analysed)
    tot = cur.groupBy(period, "column").agg(F.sum("nc").alias("tot_c"))
    # values on either side: those of the period with the reference's count, and what the
    # reference has beyond them, which enters through its total only
    both = (cur.join(ref, ["column", "value"], "left").join(F.broadcast(ref_total), "column")
            .join(F.broadcast(tot), [period, "column"]).na.fill(0, ["nr"]))
    n, r = F.col("tot_r") + F.col("tot_c"), F.col("nr") + F.col("nc")
    er, ec = r * F.col("tot_r") / n, r * F.col("tot_c") / n
    stat = both.groupBy(period, "column").agg(
        F.sum((F.col("nr") - er) ** 2 / er + (F.col("nc") - ec) ** 2 / ec).alias("seen"),
        F.sum("nr").alias("nr"), F.count(F.lit(1)).alias("own"), F.count_if(F.col("nr") > 0).alias("shared"),
        F.first("tot_r").alias("tot_r"), F.first("tot_c").alias("tot_c"), F.first("kinds").alias("kinds"))
    # a value only in the reference with count m adds (m - m a)^2 / (m a) + m b, where a and b are the
    # sides' shares of all rows: m b / a * b + m b = m b / a
    rest = (F.col("tot_r") - F.col("nr")) * F.col("tot_c") / F.col("tot_r")
    dof = F.col("own") + F.col("kinds") - F.col("shared") - 1
    out = stat.select(period, "column", (F.col("seen") + rest).alias("statistic"), dof.cast("int").alias("dof"))
    return out.withColumn("score", F.when(F.col("dof") > 0, chi2_pvalue(F.col("statistic"), F.col("dof").cast("double"))))


def column_drift(df: DataFrame, period: str, numeric: Sequence[str],
                 categorical: Sequence[str], reference: Sequence[str],
                 periods: Sequence[str] | None = None, threshold: float = DRIFT_THRESHOLD,
                 categorical_method: str = "jensenshannon") -> DataFrame:
    """R3/R6 from rows: one scan, then :func:`drift_from_counts`."""
    is_ref, analysed = _sides(period, reference, periods)
    counts = materialize(panel_profile(df.where(is_ref | analysed), period, numeric, categorical))
    roles = [r for r, c in ((NUMERIC, numeric), (CATEGORICAL, categorical)) if c]
    return drift_from_counts(counts, period, reference, periods, threshold, categorical_method, roles)


def drift_from_counts(counts: DataFrame, period: str, reference: Sequence[str], periods: Sequence[str] | None = None,
                      threshold: float = DRIFT_THRESHOLD, categorical_method: str = "jensenshannon",
                      roles: Sequence[str] = (NUMERIC, CATEGORICAL), sizes: DataFrame | None = None,
                      placed: tuple[DataFrame, _Layout] | None = None) -> DataFrame:
    """``(period, column, method, score, threshold, direction, drifted)`` for
    every column and analysed period (default: all that are not in the reference).

    ``direction`` tells which scores mean drift: ``higher`` than the threshold for
    distances, ``lower`` for p-values (``categorical_method="chi_square"``, threshold
    0.05).  A score that cannot be computed (an empty column on either side) is null and counts as drift.
    ``counts`` are ``panel_counts`` cells or a profile.  ``sizes`` is :func:`cell_sizes` of the counts, and ``placed`` the runs of a
    profile, where they are known already."""
    is_ref, analysed = _sides(period, reference, periods)
    sizes = cell_sizes(counts, period) if sizes is None else sizes
    filled = sizes.where(F.col("values") > 0)
    scores = []
    packed = is_profile(counts)
    if NUMERIC in roles and packed:
        runs, layout = placed or _placed(counts, sizes, period, reference, periods)
        scores.append(_wasserstein(runs, layout, period).select(period, "column", F.lit(NUMERIC).alias("role"), "score"))
    elif NUMERIC in roles:
        values = counts.where((F.col("role") == NUMERIC) & F.col("num").isNotNull()).select(period, "column", F.col("num").alias("value"), "n")
        scores.append(wasserstein_from_counts(values, period, reference, periods, filled.where(F.col("role") == NUMERIC)).select(
            period, "column", F.lit(NUMERIC).alias("role"), "score"))
    if CATEGORICAL in roles:
        if packed:
            values = materialize(text_counts(counts.where(is_ref | analysed), period))
        else:
            values = counts.where((F.col("role") == CATEGORICAL) & F.col("text").isNotNull()).select(period, "column", F.col("text").alias("value"), "n")
        totals = filled.where(F.col("role") == CATEGORICAL).select(period, "column", F.col("known").alias("n"))
        by = {"jensenshannon": lambda: jensen_shannon_from_counts(values, period, reference, periods, totals),
              "chi_square": lambda: chi_square_from_counts(values, period, reference, periods)}[categorical_method]
        scores.append(by().select(period, "column", F.lit(CATEGORICAL).alias("role"), "score"))
    found = scores[0]
    for more in scores[1:]:
        found = found.unionByName(more)
    grid = sizes.where(analysed & F.col("role").isin(list(roles))).select(period, "column", "role")
    out = grid.join(found, [period, "column", "role"], "left").withColumn(
        "method", F.when(F.col("role") == NUMERIC, F.lit("wasserstein")).otherwise(F.lit(categorical_method)))
    low = F.col("method").isin(*LOW_MEANS_DRIFT)
    limit = F.when(low, F.lit(P_VALUE_THRESHOLD)).otherwise(F.lit(float(threshold)))
    return out.select(period, "column", "method", "score", limit.alias("threshold"),
                      F.when(low, F.lit("lower")).otherwise(F.lit("higher")).alias("direction"),
                      F.coalesce(F.when(low, F.col("score") < limit).otherwise(F.col("score") > limit), F.lit(True))
                      .alias("drifted"))


@dataclass(frozen=True)
class MonitorConfig:
    prediction: str = "prediction"
    rank_score: str | None = None  # strictly increasing transform of prediction, for AUC
    share_threshold: float = DRIFT_SHARE_THRESHOLD
    auc_drop: float = AUC_DROP_THRESHOLD
    drift_threshold: float = DRIFT_THRESHOLD
    digits: int = 4


def monthly_drift(df: DataFrame, spec: PanelSpec, reference: Sequence[str],
                  regimes: RegimeSpec, periods: Sequence[str] | None = None,
                  cfg: MonitorConfig = MonitorConfig()) -> DataFrame:
    """One record per analysed period, from one pass over the rows.

    ``df`` is the scored panel (R1: scored once, so reference and periods
    are comparable).  Periods default to those not in the reference (B4)."""
    per = spec.period
    is_ref, analysed = _sides(per, reference, periods)
    counts = panel_profile(df.where(is_ref | analysed), per, list(spec.numeric) + [cfg.prediction], spec.categorical,
                           cfg.rank_score or cfg.prediction, spec.target)
    return monthly_from_counts(materialize(counts), spec, reference, regimes, periods, cfg)


def monthly_from_counts(cells: DataFrame, spec: PanelSpec, reference: Sequence[str],
                        regimes: RegimeSpec, periods: Sequence[str] | None = None,
                        cfg: MonitorConfig = MonitorConfig()) -> DataFrame:
    """R3-R10 from ``panel_counts`` cells or from a profile (just made, or read from a profile store).
    Shares, AUC and delta are rounded only in the output; the status uses
    the unrounded values (T5, T8)."""
    per = spec.period
    is_ref, analysed = _sides(per, reference, periods)
    feats = list(spec.numeric) + list(spec.categorical)
    roles = [NUMERIC] + ([CATEGORICAL] if spec.categorical else [])
    sizes = cell_sizes(cells, per)
    placed = _placed(cells, sizes, per, reference, periods, (NUMERIC, ROWS)) if is_profile(cells) else None
    drift = materialize(drift_from_counts(cells, per, reference, periods, cfg.drift_threshold, roles=roles, sizes=sizes, placed=placed))  # periods x columns rows, read by two branches
    counts = sizes.where(analysed & (F.col("role") == ROWS)).select(per, F.col("n").alias("n_rows"))  # rows per analysed period
    order = F.create_map(*[x for i, c in enumerate(feats) for x in (F.lit(c), F.lit(i))])
    fd = drift.where(F.col("column") != cfg.prediction)
    feat_agg = fd.groupBy(per).agg(
        F.count_if("drifted").alias("drifted_columns_count"),
        F.array_sort(F.collect_list(F.when(F.col("drifted"), F.struct(
            order[F.col("column")].alias("o"), F.col("column").alias("c"))))).alias("__dl"))
    pred = drift.where(F.col("column") == cfg.prediction).select(
        per, F.col("score").alias("prediction_drift_score"),
        F.col("drifted").alias("prediction_drift_detected"))
    if placed:
        found, ref_auc = _auc(*placed)
        kind = T.StructType([T.StructField(per, cells.schema[per].dataType), T.StructField("__auc", T.DoubleType())])
        auc = F.broadcast(cells.sparkSession.createDataFrame(list(found.items()), kind))  # one row per month
    else:
        auc, ref_auc = _auc_of_cells(cells, per, is_ref, analysed)
    rec = (counts.join(feat_agg, per, "left").join(pred, per, "left").join(auc, per, "left"))
    share = F.col("drifted_columns_count") / F.lit(float(len(feats)))
    ra = F.lit(ref_auc).cast("double")
    delta = F.col("__auc") - ra
    d = cfg.digits
    return rec.select(
        F.col(per).alias("month"),
        regime_label(per, regimes).alias("regime"),
        "n_rows",
        F.coalesce("drifted_columns_count", F.lit(0)).cast("int").alias("drifted_columns_count"),
        F.round(F.coalesce(share, F.lit(0.0)), d).alias("drifted_columns_share"),
        F.transform(F.coalesce("__dl", F.array()), lambda s: s["c"]).alias("drifted_columns"),
        F.round("prediction_drift_score", d).alias("prediction_drift_score"),
        F.coalesce("prediction_drift_detected", F.lit(False)).alias("prediction_drift_detected"),
        F.round("__auc", d).alias("roc_auc"),
        F.round(delta, d).alias("auc_delta"),
        drift_status(F.coalesce(share, F.lit(0.0)), delta, cfg.share_threshold, cfg.auc_drop)
        .alias("status"),
        F.round(ra, d).alias("reference_roc_auc"))


def _auc_of_cells(cells: DataFrame, per: str, is_ref, analysed):
    """M15 of each analysed period ``(period, __auc)`` and of the reference, from ``panel_counts`` cells."""
    # months and the reference slice ranked in one grouped pass; a month may be in both
    ref_key = "__reference__"
    ranked = cells.where((F.col("role") == ROWS) & F.col("num").isNotNull() & F.col("label").isNotNull())
    slices = F.array_compact(F.array(F.when(analysed, F.col(per)), F.when(is_ref, F.lit(ref_key))))
    sliced = ranked.select(F.explode(slices).alias("__slice"), "num", "label", "n")
    aucs = ranking_from_counts(sliced, ["__slice"], "num", "label", "n")
    aucs = materialize(aucs.select("__slice", "roc_auc"))  # one row per month
    auc = aucs.where(F.col("__slice") != ref_key).select(F.col("__slice").alias(per),
                                                           F.col("roc_auc").alias("__auc"))
    ref_auc = aucs.where(F.col("__slice") == ref_key).first()
    ref_auc = ref_auc["roc_auc"] if ref_auc else None
    return auc, ref_auc


def history_document(records: DataFrame, model: dict, reference: Sequence[str],
                     cfg: MonitorConfig = MonitorConfig()) -> DataFrame:
    """One-row DataFrame holding the nested history document as JSON
    (header with model, reference months and thresholds; records sorted by
    month)."""
    rec = records.drop("reference_roc_auc")
    ref_auc = F.first("reference_roc_auc")
    doc = records.agg(
        F.struct(
            F.struct(*[F.lit(str(v)).alias(k) for k, v in model.items()]).alias("model"),
            F.array(*[F.lit(m) for m in reference]).alias("reference_months"),
            ref_auc.alias("reference_roc_auc"),
            F.struct(F.lit(cfg.share_threshold).alias("drift_share"),
                     F.lit(cfg.auc_drop).alias("auc_drop")).alias("thresholds"),
            F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in rec.columns])))
            .alias("history")).alias("doc"))
    return doc.select(F.to_json("doc").alias("drift_history"))


# Status label shown for each monitoring status (unknown -> the
# status text itself).
STATUS_LABELS = {"OK": "Estable", "VIGILAR": "Vigilar", "CRITICO": "Requiere reentrenamiento"}


def latest_headline(records: DataFrame, labels: dict | None = None, model: dict | None = None) -> DataFrame:
    """Latest month's status with its label (lookup with the
    status itself as default), AUC and delta, and the model's version and algorithm."""
    model = model or {}
    labels = labels or STATUS_LABELS
    last = records.agg(F.max_by(F.struct(*records.columns), "month").alias("r")).select("r.*")
    lab = F.create_map(*[x for k, v in labels.items() for x in (F.lit(k), F.lit(v))])
    return last.select("month", "status",
                       F.coalesce(lab[F.col("status")], F.col("status")).alias("status_label"),
                       "roc_auc", "auc_delta",
                       *[F.lit(model.get(k)).cast("string").alias(f"model_{k}") for k in ("version", "algorithm")])


def month_detail(records: DataFrame, month: str, n_features: int) -> DataFrame:
    """One month: drifted count of n, the list as text, prediction flag, AUC."""
    return records.where(F.col("month") == month).select(
        "month", F.format_string(f"%d/{n_features}", "drifted_columns_count").alias("drifted"),
        F.array_join("drifted_columns", ", ").alias("drifted_list"),
        "prediction_drift_detected", "roc_auc")
