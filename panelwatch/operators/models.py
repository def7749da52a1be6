"""Temporal split, classifiers, training runs and champion choice (M9-M13,
M20-M22).

Logistic regression takes Newton steps (``logistic.py``); boosted trees are fitted from histograms
(``boosting.py``).  Gradients and split statistics are computed on the
executors; only coefficients and merged histograms come back to the driver.
All candidates share one fitted preparation, boosted candidates share their aggregates,
and one pass over the scored rows evaluates every candidate on every split.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwatch.operators.boosting import BoostedTrees, fit_together
from panelwatch.operators.features import build_pipeline, feature_names
from panelwatch.operators.logistic import NewtonLogistic
from panelwatch.operators.metrics import evaluate
from panelwatch.operators.scoring import probability_column
from panelwatch.spec import PanelSpec

WEIGHT = "__weight"


def temporal_split(df: DataFrame, spec: PanelSpec) -> tuple[DataFrame, DataFrame]:
    """M9: train and validation rows by period lists (partition filters)."""
    return (df.where(F.col(spec.period).isin(list(spec.train_periods))),
            df.where(F.col(spec.period).isin(list(spec.validation_periods))))


def with_balanced_weights(df: DataFrame, spec: PanelSpec) -> tuple[DataFrame, float]:
    """Weight n / (2 n_class); returns the frame and the weight sum."""
    r = df.agg(F.count_if(F.col(spec.target) == 1).alias("p"),
               F.count_if(F.col(spec.target) == 0).alias("n")).first()
    pos, neg = r["p"], r["n"]
    total = pos + neg
    wp = total / (2.0 * pos) if pos else 0.0
    wn = total / (2.0 * neg) if neg else 0.0
    w = F.when(F.col(spec.target) == 1, F.lit(wp)).otherwise(F.lit(wn))
    return df.withColumn(WEIGHT, w), wp * pos + wn * neg


@dataclass(frozen=True)
class Candidate:
    name: str
    kind: str  # "logistic" | "gbt"
    max_iter: int = 2000
    depth: int = 5
    step: float = 0.05
    subsample: float = 0.85
    col_sample: float = 0.85
    c: float = 1.0


# The three candidates of the reference (logistic C=1 with
# balanced weights and 2000 iterations; boosted trees of depth 5 and 6 with
# learning rate 0.05 and 0.85 row/column sampling).  Tree count is a
# parameter (400 in the reference).
def default_candidates(n_trees: int = 400) -> list[Candidate]:
    return [Candidate("logistic_regression", "logistic"),
            Candidate("boosted_trees_d5", "gbt", max_iter=n_trees, depth=5),
            Candidate("boosted_trees_d6", "gbt", max_iter=n_trees, depth=6)]


def make_estimator(cand: Candidate, spec: PanelSpec):
    """The unfitted stage of a candidate."""
    if cand.kind == "logistic":
        return NewtonLogistic(featuresCol="features", labelCol=spec.target, weightCol=WEIGHT, maxIter=cand.max_iter, c=cand.c)
    return BoostedTrees(featuresCol="features", labelCol=spec.target, weightCol=WEIGHT,
                        maxIter=cand.max_iter, maxDepth=cand.depth, stepSize=cand.step,
                        subsamplingRate=cand.subsample, colSample=cand.col_sample, seed=42)


def fit_candidates(train: DataFrame, spec: PanelSpec, candidates: Sequence[Candidate]) -> dict[str, PipelineModel]:
    """One preparation, then every candidate on its features; each model is a whole pipeline (M8)."""
    weighted, _ = with_balanced_weights(train, spec)
    prepared = build_pipeline(spec).fit(weighted)
    # every fit iterates over these rows: kept by the executors while fitting
    rows = prepared.transform(weighted).select("features", spec.target, WEIGHT).persist(StorageLevel.MEMORY_AND_DISK)
    estimators = {c.name: make_estimator(c, spec) for c in candidates}
    boosted = {k: e for k, e in estimators.items() if isinstance(e, BoostedTrees)}
    try:
        fitted = dict(zip(boosted, fit_together(rows, list(boosted.values())))) if boosted else {}
        fitted |= {k: e.fit(rows) for k, e in estimators.items() if k not in boosted}
    finally:
        rows.unpersist()
    return {k: PipelineModel(prepared.stages + [fitted[k]]) for k in estimators}


def evaluate_candidates(train: DataFrame, valid: DataFrame, spec: PanelSpec, models: dict[str, PipelineModel]) -> DataFrame:
    """Metrics of every (model, split), from one pass over the rows of both splits."""
    both = (train.withColumn("split", F.lit("train"))
            .unionByName(valid.withColumn("split", F.lit("validation"))))
    names = list(models)
    scored = PipelineModel(models[names[0]].stages[:-1]).transform(both)
    for i, name in enumerate(names):
        scored = probability_column(models[name].stages[-1].transform(scored), out=f"__p{i}").drop(
            "rawPrediction", "probability", "prediction")
    rows = scored.select("split", spec.target, F.inline(F.array(*[
        F.struct(F.lit(name).alias("model"), F.col(f"__p{i}").alias("p")) for i, name in enumerate(names)])))
    return evaluate(rows, ["split", "model"], "p", spec.target)


def metrics_long(metrics: DataFrame) -> DataFrame:
    """A8 shape: ``(model, key, value)`` with ``train_``/``validation_``
    prefixes and the overfit gap ``train_roc_auc - validation_roc_auc``."""
    keys = ["roc_auc", "pr_auc", "precision", "recall", "f1", "brier", "positive_rate"]
    wide = metrics.groupBy("model").pivot("split", ["train", "validation"]).agg(
        *[F.first(k).alias(k) for k in keys])
    cols = [F.struct(F.lit(f"{s}_{k}").alias("key"), F.col(f"{s}_{k}").alias("value"))
            for s in ("train", "validation") for k in keys]
    cols.append(F.struct(F.lit("overfit_gap").alias("key"),
                         (F.col("train_roc_auc") - F.col("validation_roc_auc")).alias("value")))
    return wide.select("model", F.inline(F.array(*cols)))


def choose_champion(metrics: DataFrame, digits: int = 4) -> DataFrame:
    """Highest validation AUC wins (before rounding); ties broken by model name."""
    best = (metrics.where(F.col("split") == "validation")
            .orderBy(F.col("roc_auc").desc_nulls_last(), "model").limit(1))
    return best.select("model", *[F.round(c, digits).alias(c) for c in ("roc_auc", "pr_auc", "f1")])


def top_features(model: PipelineModel, spec: PanelSpec, k: int = 15) -> DataFrame:
    """Signed coefficients (logistic) or importances (trees) with
    names, top ``k`` by absolute weight."""
    est = model.stages[-1]
    names = feature_names(model, spec)
    if hasattr(est, "coefficients"):
        w = est.coefficients.toArray().tolist()
    else:
        w = est.featureImportances.toArray().tolist()
    spark = SparkSession.getActiveSession()
    rows = list(zip(names, [float(x) for x in w]))
    df = spark.createDataFrame(rows, "feature string, weight double")
    return df.orderBy(F.abs("weight").desc(), "feature").limit(k)
