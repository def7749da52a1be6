"""Opt-in binned mode: distributions in a fixed number of bins, with bounds for what the bins hide.

Bin edges are quantiles of the reference, learnt once.  Any period is then one pass over its rows with a map-side aggregate
whose result has at most ``bins`` rows for each (period, column), however many rows or distinct values there are: the
count, the least and the greatest value of each bin, and the counts by label.  Tables over the same edges add up, so
they can be stored by period and merged.

From such a table come bounds that always hold the exact result:

* a quantile's rank lies in one bin, so its value lies between that bin's least and greatest value; the error in rank is at
  most the bin's count;
* with every value moved to the middle of its bin's range, W1 changes by at most half the mean range on either side;
* a positive and a negative in different bins are ordered as the bins are; inside a bin of more than one value their order
  is open, so AUC lies between all such pairs lost and all won.

Exact results stay the default everywhere; nulls and NaN are left out as there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from panelwatch.operators.drift import wasserstein_from_counts
from panelwatch.operators.profile import unpivot_numeric
from panelwatch.operators.quantiles import quantiles_from_counts, value_counts

TABLE = ("column", "bin", "n", "lo", "hi", "pos", "neg")


def reference_edges(reference: DataFrame, columns: Sequence[str], bins: int = 64) -> dict[str, list[float]]:
    """Inner edges of each column's bins: exact quantiles of the reference rows, each once."""
    probs = [k / bins for k in range(1, bins)]
    if not probs:
        return {c: [] for c in columns}
    counts = value_counts(unpivot_numeric(reference, columns), ["column"], "value")
    rows = quantiles_from_counts(counts, ["column"], probs, [f"q{k}" for k in range(1, bins)]).collect()  # one row a column
    found = {r["column"]: sorted({r[f"q{k}"] for k in range(1, bins)}) for r in rows}
    return {c: found.get(c, []) for c in columns}


def binned_counts(df: DataFrame, period: str, edges: dict[str, list[float]], target: str | None = None) -> DataFrame:
    """``(period, column, bin, n, lo, hi, pos, neg)`` from one pass over the rows."""
    cols = list(edges)
    known = df.select(period, *([target] if target else []), *[F.col(c).cast("double").alias(c) for c in cols])
    known = known.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in cols})
    placed = known.withColumns({f"__bin_{c}": F.lit(0.0) for c in cols if not edges[c]})
    for c in cols:
        if edges[c]:
            splits = [-float("inf"), *edges[c], float("inf")]
            placed = Bucketizer(splits=splits, inputCol=c, outputCol=f"__bin_{c}", handleInvalid="keep").transform(placed)
    cells = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"__bin_{c}").cast("int").alias("bin"), F.col(c).alias("value")) for c in cols]))
    y = F.col(target) if target else F.lit(None).cast("int")
    long = placed.select(period, y.alias("__y"), cells).where(F.col("value").isNotNull())
    return long.groupBy(period, "column", "bin").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"),
        F.count_if(F.col("__y") == 1).alias("pos"), F.count_if(F.col("__y") == 0).alias("neg"))


def merged(binned: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Tables over the same edges added up by ``group_cols``, column and bin."""
    return binned.groupBy(*group_cols, "column", "bin").agg(
        F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def quantile_bounds(binned: DataFrame, group_cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """``(group, column, prob, n, lower, upper, rank_error)``: bounds of the value at rank ``floor(prob * (n - 1))`` (from 0)."""
    key = [*group_cols, "column"]
    rows = merged(binned, group_cols)
    order = W.partitionBy(*key).orderBy("bin").rowsBetween(W.unboundedPreceding, W.currentRow)  # at most one row a bin
    rows = rows.withColumn("__cum", F.sum("n").over(order)).withColumn("__all", F.sum("n").over(W.partitionBy(*key)))
    rows = rows.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
    rank = F.floor(F.col("prob") * (F.col("__all") - 1))
    inside = (rank < F.col("__cum")) & (rank >= F.col("__cum") - F.col("n"))
    return rows.where(inside).select(*key, "prob", F.col("__all").alias("n"), F.col("lo").alias("lower"), F.col("hi").alias("upper"),
                                     F.when(F.col("lo") == F.col("hi"), F.lit(0.0)).otherwise(F.col("n") / F.col("__all")).alias("rank_error"))


def wasserstein_bounds(binned: DataFrame, period: str, reference: Sequence[str], periods: Sequence[str] | None = None) -> DataFrame:
    """``(period, column, lower, upper)`` of the exact W1 between each period and the reference."""
    is_ref = F.col(period).isin(list(reference))
    middle = binned.select(period, "column", ((F.col("lo") + F.col("hi")) / 2).alias("value"), "n")
    near = wasserstein_from_counts(middle, period, reference, periods).select(period, "column", "w1")
    half = F.sum(F.col("n") * (F.col("hi") - F.col("lo"))) / (2 * F.sum("n"))
    ref = merged(binned.where(is_ref).withColumn("__all", F.lit(0)), ["__all"]).groupBy("column").agg(half.alias("__ref"))
    own = binned.groupBy(period, "column").agg(half.alias("__own"))
    out = near.join(own, [period, "column"]).join(F.broadcast(ref), "column")  # one row a column
    slack = (F.col("__ref") + F.col("__own")) * (1 + 1e-9) + 1e-12 * F.abs("w1")
    return out.select(period, "column", F.greatest(F.col("w1") - slack, F.lit(0.0)).alias("lower"), (F.col("w1") + slack).alias("upper"))


def auc_bounds(binned: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """``(group, column, lower, upper)`` of the exact ROC AUC with the column as score (null without both classes)."""
    key = [*group_cols, "column"]
    rows = merged(binned, group_cols)
    before = W.partitionBy(*key).orderBy("bin").rowsBetween(W.unboundedPreceding, -1)  # at most one row a bin
    rows = rows.withColumn("__below", F.coalesce(F.sum("neg").over(before), F.lit(0)))
    tie = F.col("lo") == F.col("hi")
    g = rows.groupBy(*key).agg(
        F.sum(F.col("pos") * (F.col("__below") + F.when(tie, F.col("neg") / 2).otherwise(0.0))).alias("low"),
        F.sum(F.col("pos") * (F.col("__below") + F.when(tie, F.col("neg") / 2).otherwise(F.col("neg").cast("double")))).alias("high"),
        F.sum("pos").alias("p"), F.sum("neg").alias("q"))
    pairs = F.when((F.col("p") > 0) & (F.col("q") > 0), F.col("p") * F.col("q"))
    return g.select(*key, (F.col("low") / pairs).alias("lower"), (F.col("high") / pairs).alias("upper"))
