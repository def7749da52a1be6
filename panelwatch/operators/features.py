"""Leak-free feature preparation as ``pyspark.ml`` stages (M1-M8).

Numeric branch (``NumericPrep``): median imputation -> winsorising at the
p1/p99 of the *imputed* training data -> standardising with the mean and
population sd of the *clipped* data (sd 0 -> 1).  All statistics are exact
(linear-interpolated quantiles computed with the distributed rank scan) and
learned in ``fit`` on the training rows only; ``transform`` is one
projection of built-in expressions.

Categorical branch: ``ModeImputer`` (most frequent value, ties -> smallest)
-> ``StringIndexer(handleInvalid='keep', alphabetAsc)`` ->
``OneHotEncoder(dropLast=True)``, so known levels keep all columns and an
unseen or null level becomes the all-zero vector.
"""

from __future__ import annotations

import json
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.param.shared import HasInputCols, HasOutputCols, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch.functions.scalar import clip
from panelwatch.operators.profile import unpivot_categorical, unpivot_numeric
from panelwatch.operators.quantiles import quantiles_from_counts
from panelwatch.session import materialize
from panelwatch.spec import PanelSpec


class _HasStats(Params):
    stats = Param(Params._dummy(), "stats", "learned statistics as JSON",
                  typeConverter=TypeConverters.toString)

    def getStats(self) -> dict:
        return json.loads(self.getOrDefault(self.stats))


# ---------------------------------------------------------------- M1-M3
class NumericPrep(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable,
                  DefaultParamsWritable):
    lower = Param(Params._dummy(), "lower", "lower winsor quantile", TypeConverters.toFloat)
    upper = Param(Params._dummy(), "upper", "upper winsor quantile", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, lower=0.01, upper=0.99):
        super().__init__()
        self._setDefault(lower=0.01, upper=0.99)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "NumericPrepModel":
        cols = list(self.getInputCols())
        lo, hi = self.getOrDefault(self.lower), self.getOrDefault(self.upper)
        # one pass over the rows: everything is learned from the value counts
        v = F.col("value")
        counts = materialize(unpivot_numeric(df, cols).groupBy(
            "column", F.when(~F.isnan(v), v).alias("__v")).agg(F.count(F.lit(1)).alias("__c")))
        med = {r["column"]: r["median"] for r in quantiles_from_counts(
            counts.where("__v IS NOT NULL"), ["column"], [0.5], ["median"]).collect()}
        fill = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(med.get(c)).cast("double"))])
        imputed = materialize(counts.groupBy(
            "column", F.coalesce("__v", fill[F.col("column")]).alias("__v")).agg(F.sum("__c").alias("__c"))
            .where("__v IS NOT NULL"))
        limits = quantiles_from_counts(imputed, ["column"], [lo, hi], ["lo", "hi"])
        qs = {r["column"]: (r["lo"], r["hi"]) for r in limits.collect()}
        qs = {c: qs.get(c, (None, None)) for c in cols}
        x = F.least(F.greatest("__v", F.create_map(*[y for c in cols for y in (F.lit(c), F.lit(qs[c][0]).cast("double"))])[F.col("column")]),
                    F.create_map(*[y for c in cols for y in (F.lit(c), F.lit(qs[c][1]).cast("double"))])[F.col("column")])
        clipped = imputed.withColumn("__x", x)
        mean = clipped.groupBy("column").agg((F.sum(F.col("__c") * F.col("__x")) / F.sum("__c")).alias("mean"))
        dev = clipped.join(F.broadcast(mean), "column")  # one row per column
        mom = {r["column"]: (r["mean"], r["sd"]) for r in dev.groupBy("column").agg(
            F.first("mean").alias("mean"), F.sqrt(F.sum(F.col("__c") * (F.col("__x") - F.col("mean")) ** 2)
                                                 / F.sum("__c")).alias("sd")).collect()}
        mom = {c: mom.get(c, (None, None)) for c in cols}
        stats = {c: {"median": med.get(c), "lo": qs[c][0], "hi": qs[c][1], "mean": mom[c][0],
                     "sd": mom[c][1] if mom[c][1] else 1.0} for c in cols}
        m = NumericPrepModel(inputCols=cols, outputCols=list(self.getOutputCols()),
                             stats=json.dumps(stats))
        return m


class NumericPrepModel(Model, HasInputCols, HasOutputCols, _HasStats, DefaultParamsReadable,
                       DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, stats=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        st = self.getStats()
        out = {}
        for c, o in zip(self.getInputCols(), self.getOutputCols()):
            s = st[c]
            x = F.col(c).cast("double")
            x = F.when(x.isNull() | F.isnan(x), F.lit(s["median"])).otherwise(x)
            x = clip(x, s["lo"], s["hi"])
            out[o] = (x - F.lit(s["mean"])) / F.lit(s["sd"])
        return df.withColumns(out)


# ---------------------------------------------------------------- M4
class ModeImputer(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable,
                  DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "ModeImputerModel":
        cols = list(self.getInputCols())
        counts = (unpivot_categorical(df, cols).where(F.col("value").isNotNull())
                  .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
        # most frequent, ties -> smallest value: min by (-count, value)
        modes = counts.groupBy("column").agg(
            F.min_by("value", F.struct((-F.col("n")).alias("k"), F.col("value"))).alias("mode"))
        stats = {r["column"]: r["mode"] for r in modes.collect()}
        return ModeImputerModel(inputCols=cols, outputCols=list(self.getOutputCols()),
                                stats=json.dumps(stats))


class ModeImputerModel(Model, HasInputCols, HasOutputCols, _HasStats, DefaultParamsReadable,
                       DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, stats=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        st = self.getStats()
        return df.withColumns({o: F.coalesce(F.col(c).cast("string"), F.lit(st.get(c)))
                               for c, o in zip(self.getInputCols(), self.getOutputCols())})


# ---------------------------------------------------------------- M5-M8
def preprocessing_stages(spec: PanelSpec, features_col: str = "features") -> list:
    """M6: numeric branch, then categorical branch, assembled; other columns
    (id, period, target) are not inputs, so they cannot leak."""
    nums, cats = list(spec.numeric), list(spec.categorical)
    stages = [NumericPrep(inputCols=nums, outputCols=[f"{c}__num" for c in nums])]
    assembled = [f"{c}__num" for c in nums]
    if cats:
        stages += [
            ModeImputer(inputCols=cats, outputCols=[f"{c}__imp" for c in cats]),
            StringIndexer(inputCols=[f"{c}__imp" for c in cats],
                          outputCols=[f"{c}__idx" for c in cats],
                          handleInvalid="keep", stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=[f"{c}__idx" for c in cats],
                          outputCols=[f"{c}__ohe" for c in cats], dropLast=True),
        ]
        assembled += [f"{c}__ohe" for c in cats]
    stages.append(VectorAssembler(inputCols=assembled, outputCol=features_col,
                                  handleInvalid="keep"))
    return stages


def build_pipeline(spec: PanelSpec, estimator=None) -> Pipeline:
    """M8: preprocessing and estimator as one fitted, savable object."""
    stages = preprocessing_stages(spec)
    if estimator is not None:
        stages.append(estimator)
    return Pipeline(stages=stages)


def feature_names(model: PipelineModel, spec: PanelSpec) -> list[str]:
    """M7: output feature names after one-hot expansion (``col_level``)."""
    names = list(spec.numeric)
    for st in model.stages:
        if st.__class__.__name__ == "StringIndexerModel":
            for c, labels in zip(spec.categorical, st.labelsArray):
                names += [f"{c}_{lab}" for lab in labels]
    return names


def split_features_target(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """B1: keep the declared features and the target (drops id and period)."""
    return df.select(*spec.features, spec.target)
