"""Logistic regression by Newton steps.

Each step is one pass over the rows: a task adds its rows' ``X'WX``, ``X'W(y - p)`` and loss block by block, the
partial sums (their size depends on the number of features only) are added in Spark, and the driver solves the small system.  A step that does not lower the
penalised loss is halved.  The objective is ``sum w * logloss + |b|^2 / (2 C)`` without penalty on the constant, which is
convex, so every layout of the rows leads to the same coefficients up to rounding.

Rows with a null label are left out; with one class only the constant is +-30 and the weights are 0.  Features must not be null.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasWeightCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HALVINGS = 30


def _sums(rows: DataFrame, beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, gradient of the log likelihood and ``X'WX`` at ``beta`` (constant last), over all rows."""
    k = len(beta)
    upper = np.triu_indices(k)

    def run(batches):
        total = np.zeros(1 + k + len(upper[0]))
        for batch in batches:
            n = batch.num_rows
            x = np.column_stack([np.asarray(batch.column(0).flatten()).reshape(n, k - 1), np.ones(n)])
            y, w = np.asarray(batch.column(1)), np.asarray(batch.column(2))
            z = x @ beta
            p = 1 / (1 + np.exp(-z))
            total[0] += (w * (np.logaddexp(0, z) - y * z)).sum()
            total[1:1 + k] += x.T @ (w * (y - p))
            total[1 + k:] += ((x * (w * p * (1 - p))[:, None]).T @ x)[upper]
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["s"])

    parts = rows.mapInArrow(run, "s array<double>").select(F.posexplode("s").alias("i", "v"))
    got = parts.groupBy("i").agg(F.sum("v").alias("v")).collect()  # one row for each sum
    s = np.zeros(1 + k + len(upper[0]))
    for r in got:
        s[r["i"]] = r["v"]
    h = np.zeros((k, k))
    h[upper] = s[1 + k:]
    return s[0], s[1:1 + k], h + np.triu(h, 1).T


class NewtonLogistic(Estimator, HasFeaturesCol, HasLabelCol, HasWeightCol, DefaultParamsReadable, DefaultParamsWritable):
    """M10 as a pipeline stage."""

    c = Param(Params._dummy(), "c", "inverse strength of the penalty", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "most Newton steps", TypeConverters.toInt)
    tol = Param(Params._dummy(), "tol", "a step that changes no weight by more ends the fit", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", weightCol=None, c=1.0, maxIter=2000, tol=1e-10):
        super().__init__()
        self._setDefault(c=1.0, maxIter=2000, tol=1e-10)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> "NewtonLogisticModel":
        label = self.getLabelCol()
        weight = F.col(self.getWeightCol()).cast("double") if self.isDefined(self.weightCol) else F.lit(1.0)
        rows = df.where(F.col(label).isNotNull()).select(vector_to_array(self.getFeaturesCol()).alias("x"), F.col(label).cast("double").alias("y"),
                                                         weight.alias("w"))
        t = rows.agg(F.max(F.size("x")).alias("k"), F.sum("y").alias("pos"), F.count(F.lit(1)).alias("n")).first()
        k = (t["k"] or 0) + 1
        beta, steps = np.zeros(k), 0
        if not t["n"] or t["pos"] in (0, t["n"]):
            beta[-1] = 0.0 if not t["n"] else 30.0 if t["pos"] else -30.0
        else:
            beta, steps = self._newton(rows, beta)
        return NewtonLogisticModel(featuresCol=self.getFeaturesCol(), fitted=json.dumps(
            {"coefficients": beta[:-1].tolist(), "intercept": float(beta[-1]), "steps": steps, "c": self.getOrDefault(self.c),
             "maxIter": self.getOrDefault(self.maxIter), "tol": self.getOrDefault(self.tol)}))

    def _newton(self, rows: DataFrame, beta: np.ndarray) -> tuple[np.ndarray, int]:
        penalty = np.full(len(beta), 1 / self.getOrDefault(self.c))
        penalty[-1] = 0.0
        loss, grad, h = _sums(rows, beta)
        loss += (penalty * beta * beta).sum() / 2
        for step_no in range(1, self.getOrDefault(self.maxIter) + 1):
            step = np.linalg.lstsq(h + np.diag(penalty), grad - penalty * beta, rcond=None)[0]
            if np.abs(step).max() <= self.getOrDefault(self.tol):
                return beta + step, step_no
            for _ in range(HALVINGS):
                new = beta + step
                new_loss, new_grad, new_h = _sums(rows, new)
                new_loss += (penalty * new * new).sum() / 2
                if new_loss <= loss + 1e-12 * abs(loss):
                    break
                step = step / 2
            beta, loss, grad, h = new, new_loss, new_grad, new_h
        return beta, self.getOrDefault(self.maxIter)


class NewtonLogisticModel(Model, HasFeaturesCol, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted weights; ``transform`` is one projection (``rawPrediction``, ``probability``, ``prediction``)."""

    fitted = Param(Params._dummy(), "fitted", "weights, constant and settings as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", fitted=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _values(self) -> dict:
        return json.loads(self.getOrDefault(self.fitted))

    @property
    def coefficients(self) -> DenseVector:
        return DenseVector(self._values()["coefficients"])

    @property
    def intercept(self) -> float:
        return self._values()["intercept"]

    def description(self) -> dict:
        """The settings and the number of steps, for the run log."""
        return {k: v for k, v in self._values().items() if k not in ("coefficients", "intercept")}

    def _transform(self, df: DataFrame) -> DataFrame:
        v = self._values()
        weights = F.array(*[F.lit(float(x)) for x in v["coefficients"]]).cast("array<double>")
        z = F.aggregate(F.zip_with(vector_to_array(self.getFeaturesCol()), weights, lambda a, b: a * b), F.lit(float(v["intercept"])), lambda s, x: s + x)
        p = F.lit(1.0) / (1 + F.exp(-F.col("__z")))
        return df.withColumn("__z", z).withColumns({
            "rawPrediction": array_to_vector(F.array(-F.col("__z"), F.col("__z"))), "probability": array_to_vector(F.array(1 - p, p)),
            "prediction": (F.col("__z") > 0).cast("double")}).drop("__z")
