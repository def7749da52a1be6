"""Newton logistic fit against a plain one; a registry that several writers use at once."""

import math
import os
import random
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors

from panelwatch.operators.logistic import NewtonLogistic
from panelwatch.sources.registry import Registry, put_if_absent


def rows(n=200, seed=0, scale=1.0):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        x = (rng.gauss(0, 1), rng.gauss(2, 3), float(rng.random() < .3))
        z = scale * (1.2 * x[0] - .4 * x[1] + .8 * x[2] + .3)
        out.append((Vectors.dense(x), int(rng.random() < 1 / (1 + math.exp(-z))), rng.choice([.5, 1.0, 2.0])))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, ["features", "y", "w"])


def fit(df, **kw):
    return NewtonLogistic(labelCol="y", weightCol="w", **kw).fit(df)


def test_fit_is_stationary_and_layout_free(spark):
    data = rows()
    model = fit(frame(spark, data), c=0.7)
    x = np.array([list(r[0].toArray()) + [1.0] for r in data])
    y, w = np.array([r[1] for r in data]), np.array([r[2] for r in data])
    beta = np.array([*model.coefficients, model.intercept])
    grad = x.T @ (w * (y - 1 / (1 + np.exp(-x @ beta)))) - np.array([*beta[:-1], 0]) / 0.7
    assert np.abs(grad).max() < 1e-8
    assert model.description()["steps"] <= 8 and model.description()["c"] == 0.7
    again = fit(frame(spark, data).repartition(7), c=0.7)
    assert list(again.coefficients) == pytest.approx(list(model.coefficients), abs=1e-11)


def test_separable_rows_need_halved_steps_and_stay_finite(spark):
    data = [(Vectors.dense(float(k)), int(k >= 10), 1.0) for k in range(20)] + [(Vectors.dense(1e3), 1, 1.0)]
    model = fit(frame(spark, data), c=1e4)
    p = [r["probability"][1] for r in model.transform(frame(spark, data)).collect()]
    assert all((q > .5) == bool(r[1]) for q, r in zip(p, data)) and 0 < model.coefficients[0] < 1e3


def test_saved_fit_and_degenerate_rows(spark, tmp_path):
    df = frame(spark, rows(60, 1))
    whole = PipelineModel([fit(df)])
    whole.write().overwrite().save(str(tmp_path / "m"))
    out = PipelineModel.load(str(tmp_path / "m")).transform(df).collect()
    want = whole.transform(df).collect()
    assert [r.probability for r in out] == [r.probability for r in want]
    assert all(r.prediction == float(r.probability[1] > .5) for r in out)
    ones = fit(frame(spark, [(Vectors.dense(1.0), 1, 1.0)] * 3))
    assert ones.intercept == 30.0 and list(ones.coefficients) == [0.0]
    nulls = df.unionByName(frame(spark, rows(5, 2)).selectExpr("features", "cast(null as bigint) y", "w"))
    assert list(fit(nulls).coefficients) == pytest.approx(list(whole.stages[0].coefficients), abs=1e-11)


def test_a_name_is_given_once(spark, tmp_path):
    path = str(tmp_path / "log" / "000000000001.json")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda k: put_if_absent(spark, path, f"writer {k}"), range(24)))
    assert sum(won) == 1 and open(path).read() == f"writer {won.index(True)}"
    assert os.listdir(tmp_path / "log") == ["000000000001.json"]


def test_two_writers_get_distinct_versions(spark, tmp_path):
    root = str(tmp_path / "registry")

    def writer(who):
        reg = Registry(spark, root)
        out = []
        for k in range(4):
            run = reg.log_run(f"algo-{who}", {"validation_roc_auc": k / 10}, params={"k": k})
            out.append(reg.register("shared", run, f"algo-{who}", k / 10))
            reg.promote("shared", out[-1])
        return out

    with ThreadPoolExecutor(3) as pool:
        got = list(pool.map(writer, "abc"))
    reg = Registry(spark, root)
    assert sorted(v for part in got for v in part) == list(range(1, 13)) and all(part == sorted(part) for part in got)
    events = reg.events().collect()
    assert sorted(e.event_seq for e in events) == list(range(1, 25))
    last = max((e for e in events if e.event == "alias"), key=lambda e: e.event_seq)
    assert reg.resolve("shared").first().version == last.version
    info = reg.model_info("shared").first()
    assert info.version == str(last.version) and "validation_roc_auc" in info.metrics
    assert reg.versions("shared").count() == 12 and reg.params(info.run_id).count() == 1
    with pytest.raises(LookupError):
        reg.promote("shared", 99)
