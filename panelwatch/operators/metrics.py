"""Evaluation metrics (M14-M19), exact and grouped.

Rows are first reduced to one row per (group, distinct score) with the
positive and negative counts (map-side partial aggregation).  Ranks come
from :func:`ordered_scan`, which cuts a large group (a month, a split) over
many tasks:

* ROC AUC (ties count half) = sum(pos * (neg_below + neg / 2)) / (P * N)
* average precision = sum over thresholds of (pos / P) * precision, with
  precision = tp / (tp + fp) counted at scores >= the threshold (not the
  trapezoid; this is the step-wise definition).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch.functions.scalar import safe_ratio
from panelwatch.operators.scan import Scan, ordered_scan
from panelwatch.session import materialize


_ALL = "__all"


def _keyed(df: DataFrame, group_cols: Sequence[str]):
    """Ungrouped calls use one constant group key, so every metric is a
    plain grouped aggregate / equi-join (no cross joins)."""
    if group_cols:
        return df, list(group_cols), []
    return df.withColumn(_ALL, F.lit(0)), [_ALL], [_ALL]


def score_table(df: DataFrame, group_cols: Sequence[str], score: str, label: str) -> DataFrame:
    """``(group..., score, pos, neg)`` with one row per distinct score."""
    y = F.col(label)
    return (df.where(F.col(score).isNotNull() & y.isNotNull())
            .groupBy(*group_cols, F.col(score).cast("double").alias("score"))
            .agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")))


def _rank_table(st: DataFrame, group_cols) -> DataFrame:
    return ordered_scan(st, list(group_cols), ["score"],
                        [Scan("pos_le", "sum", "pos"), Scan("neg_le", "sum", "neg")],
                        totals={"P": "pos", "N": "neg"})


def _ranked(df, group_cols, score, label):
    return _rank_table(score_table(df, group_cols, score, label), group_cols)


def _ranking(r: DataFrame, group_cols) -> DataFrame:
    """AUC and AP from a ranked score table."""
    neg_below = F.col("neg_le") - F.col("neg")
    tp = F.col("P") - F.col("pos_le") + F.col("pos")  # positives scored >= this score
    fp = F.col("N") - F.col("neg_le") + F.col("neg")
    agg = r.groupBy(*group_cols).agg(
        F.sum(F.col("pos") * (neg_below + 0.5 * F.col("neg"))).alias("__num"),
        F.sum(F.when(F.col("pos") > 0, F.col("pos") * tp / (tp + fp))).alias("__ap"),
        F.first("P").alias("n_pos"), F.first("N").alias("n_neg"))
    both = (F.col("n_pos") > 0) & (F.col("n_neg") > 0)
    return agg.select(
        *group_cols, "n_pos", "n_neg",
        F.when(both, F.col("__num") / (F.col("n_pos") * F.col("n_neg"))).alias("roc_auc"),
        F.when(F.col("n_pos") > 0, F.col("__ap") / F.col("n_pos")).alias("pr_auc"))


def ranking_metrics(df: DataFrame, group_cols: Sequence[str], score: str, label: str) -> DataFrame:
    """M15 + M16 per group: ``n_pos, n_neg, roc_auc, pr_auc``.  AUC is null
    unless both classes are present (B14); AP is null without positives."""
    df, group_cols, __drop = _keyed(df, group_cols)
    return _ranking(_ranked(df, group_cols, score, label), group_cols).drop(*__drop)


def ranking_from_counts(counts: DataFrame, group_cols: Sequence[str], score: str, label: str, n: str) -> DataFrame:
    """M15 + M16 from counted rows: ``n`` rows of each (group, score, label)."""
    y, c = F.col(label), F.col(n)
    st = counts.groupBy(*group_cols, F.col(score).cast("double").alias("score")).agg(
        F.sum(F.when(y == 1, c).otherwise(0)).alias("pos"), F.sum(F.when(y == 0, c).otherwise(0)).alias("neg"))
    return _ranking(_rank_table(st, group_cols), list(group_cols))


def _thresholded(st: DataFrame, group_cols, threshold: float) -> DataFrame:
    """Threshold metrics from counts per distinct probability ``__p``."""
    p, pos, neg = F.col("__p"), F.col("pos"), F.col("neg")
    hit = p >= F.lit(threshold)
    agg = st.groupBy(*group_cols).agg(
        F.sum(pos + neg).alias("n"), F.sum(F.when(hit, pos).otherwise(0)).cast("double").alias("tp"),
        F.sum(F.when(hit, neg).otherwise(0)).cast("double").alias("fp"),
        F.sum(F.when(~hit, pos).otherwise(0)).cast("double").alias("fn"),
        F.try_divide(F.sum(pos * (p - 1) * (p - 1) + neg * p * p), F.sum(pos + neg).cast("double")).alias("brier"),
        F.try_divide(F.sum(F.when(hit, pos + neg).otherwise(0)).cast("double"), F.sum(pos + neg).cast("double"))
        .alias("positive_rate"))
    prec = safe_ratio("tp", F.col("tp") + F.col("fp"))
    rec = safe_ratio("tp", F.col("tp") + F.col("fn"))
    return agg.select(*group_cols, "n", prec.alias("precision"), rec.alias("recall"),
                      safe_ratio(2 * prec * rec, prec + rec).alias("f1"), "brier", "positive_rate")


def _probability_table(df, group_cols, rank: str, score: str, label: str) -> DataFrame:
    p, y = F.col(score).cast("double"), F.col(label)
    return (df.where(p.isNotNull() & y.isNotNull())
            .groupBy(*group_cols, F.col(rank).cast("double").alias("score"), p.alias("__p"))
            .agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")))


def threshold_metrics(df: DataFrame, group_cols: Sequence[str], score: str, label: str,
                      threshold: float = 0.5) -> DataFrame:
    """M14 (threshold part): precision, recall, F1 (0 on zero division),
    Brier score and positive rate at ``score >= threshold``."""
    df, group_cols, __drop = _keyed(df, group_cols)
    return _thresholded(_probability_table(df, group_cols, score, score, label), group_cols, threshold).drop(*__drop)


def evaluate(df: DataFrame, group_cols: Sequence[str], score: str, label: str,
             threshold: float = 0.5, rank_score: str | None = None) -> DataFrame:
    """The seven metrics per group (split, model, month ...) in one table,
    from one pass over the rows (counts per distinct score).

    ``rank_score`` (optional) is any strictly increasing transform of
    ``score`` (e.g. the linear predictor of a logistic score); ranking
    metrics only depend on order, and the untransformed value keeps ties
    that the logistic function would merge in floating point."""
    df, group_cols, __drop = _keyed(df, group_cols)
    st = materialize(_probability_table(df, group_cols, rank_score or score, score, label))
    by_rank = st.where(F.col("score").isNotNull()).groupBy(*group_cols, "score").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    rk = _ranking(_rank_table(by_rank, group_cols), group_cols)
    th = _thresholded(st, group_cols, threshold)
    # stack the two one-row-per-group tables and collapse them per group: a
    # grouped aggregate instead of a join (no join on a constant key)
    metrics = ["n", "roc_auc", "pr_auc", "precision", "recall", "f1", "brier", "positive_rate"]
    both = th.unionByName(rk.select(*group_cols, "roc_auc", "pr_auc"), allowMissingColumns=True)
    out = both.groupBy(*group_cols).agg(*[F.first(c, ignorenulls=True).alias(c) for c in metrics])
    return out.select(*group_cols, *metrics).drop(*__drop)


def roc_points(df: DataFrame, group_cols: Sequence[str], score: str, label: str,
               threshold_of=None) -> DataFrame:
    """``(threshold, fpr, tpr)`` at every distinct score (all points
    kept), plus the (0, 0) start with a null threshold.  ``threshold_of``
    maps the ranked score to the reported threshold (e.g. a sigmoid when
    ranking on a linear predictor)."""
    df, group_cols, __drop = _keyed(df, group_cols)
    r = _ranked(df, group_cols, score, label)
    tp = F.col("P") - F.col("pos_le") + F.col("pos")
    fp = F.col("N") - F.col("neg_le") + F.col("neg")
    thr = threshold_of(F.col("score")) if threshold_of else F.col("score")
    pts = r.select(*group_cols, thr.alias("threshold"),
                   F.try_divide(fp.cast("double"), F.col("N").cast("double")).alias("fpr"),
                   F.try_divide(tp.cast("double"), F.col("P").cast("double")).alias("tpr"))
    start = r.select(*group_cols).distinct().select(*group_cols, F.lit(None).cast("double").alias("threshold"),
                         F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return pts.unionByName(start).drop(*__drop)


def pr_points(df: DataFrame, group_cols: Sequence[str], score: str, label: str,
              threshold_of=None) -> DataFrame:
    """``(threshold, recall, precision)`` at every distinct score plus
    the (recall 0, precision 1) end point, and the base rate per group."""
    df, group_cols, __drop = _keyed(df, group_cols)
    r = _ranked(df, group_cols, score, label)
    tp = F.col("P") - F.col("pos_le") + F.col("pos")
    fp = F.col("N") - F.col("neg_le") + F.col("neg")
    base = (F.col("P") / (F.col("P") + F.col("N"))).alias("base_rate")
    thr = threshold_of(F.col("score")) if threshold_of else F.col("score")
    pts = r.select(*group_cols, thr.alias("threshold"),
                   F.try_divide(tp.cast("double"), F.col("P").cast("double")).alias("recall"),
                   (tp / (tp + fp)).alias("precision"), base)
    end = r.select(*group_cols, base).distinct().select(
        *group_cols, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("recall"),
        F.lit(1.0).alias("precision"), "base_rate")
    return pts.unionByName(end).drop(*__drop)


def confusion_counts(df: DataFrame, group_cols: Sequence[str], score: str, label: str,
                     threshold: float = 0.5) -> DataFrame:
    """2x2 counts at the threshold, row = actual; missing cells are 0."""
    df, group_cols, __drop = _keyed(df, group_cols)
    p = F.col(score).cast("double")
    y = F.col(label)
    pred = p >= F.lit(threshold)
    g = df.where(p.isNotNull() & y.isNotNull())
    g = g.groupBy(*group_cols)
    wide = g.agg(F.count_if((y == 0) & ~pred).alias("c00"), F.count_if((y == 0) & pred).alias("c01"),
                 F.count_if((y == 1) & ~pred).alias("c10"), F.count_if((y == 1) & pred).alias("c11"))
    cells = F.inline(F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(f"c{a}{b}").alias("n"))
        for a in (0, 1) for b in (0, 1)]))
    return wide.select(*group_cols, cells).drop(*__drop)
