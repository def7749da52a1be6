"""Scorecard, calibration, validation, feature pipeline units (FIXTURES F5)."""

import math

import numpy as np
import pytest

from panelwatch.operators import features as FE
from panelwatch.operators import scoring as S
from panelwatch.spec import PanelSpec


def test_calibrate_intercept_matches_bisection(spark):
    rng = np.random.default_rng(5)
    z = rng.normal(0, 1.5, 500)
    rows = [("a", float(v)) for v in z] + [("b", float(v) + 2) for v in z[:200]]
    df = spark.createDataFrame(rows, "g string, z double")
    out = {r.g: r.intercept for r in S.calibrate_intercept(df, ["g"], "z", 0.2).collect()}

    def bisect(zs):
        lo, hi = -15.0, 15.0
        for _ in range(60):
            mid = (lo + hi) / 2
            if np.mean(1 / (1 + np.exp(-(zs + mid)))) < 0.2:
                lo = mid
            else:
                hi = mid
        return (lo + hi) / 2

    assert out["a"] == pytest.approx(bisect(z), abs=1e-9)
    assert out["b"] == pytest.approx(bisect(z[:200] + 2), abs=1e-9)


def test_scorecard_expression(spark):
    card = S.Scorecard(intercept=-1.0, numeric={"x": (10.0, 2.0, 0.5)},
                       categorical={"c": {"a": 0.3}}, flags={"f": ("Yes", 0.2)})
    df = spark.createDataFrame([(12.0, "a", "Yes"), (10.0, "zz", "No")], "x double, c string, f string")
    r = S.linear_score(df, card, "p", z_out="z").collect()
    assert r[0].z == pytest.approx(-1.0 + 0.5 + 0.3 + 0.2)
    assert r[0].p == pytest.approx(1 / (1 + math.exp(-0.0)))
    assert r[1].z is None  # unknown category maps to null, like a dict map gives NaN


def test_row_validation_names_fields(spark):
    rows = [("42", "F", "Centro", "No", "Month-to-month", "3", "94.5", "Electronic check", "Yes",
             "8.2", "3", "18.4", "2", "2"),
            ("cuarenta y dos", "F", "Antartida", "No", "Contrato vitalicio", "-1", "-10",
             "Electronic check", "Yes", "8.2", "-3", "18.4", "0", "2")]
    cols = [r.name for r in S.CHURN_RULES]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    v = S.validate_rows(df, S.CHURN_RULES).collect()
    assert v[0].errors == []
    bad = {e.split(":")[0] for e in v[1].errors}
    assert bad == {"age", "contract_type", "tenure_months", "monthly_charges",
                   "support_tickets_30d", "num_services"}  # open-domain region passes
    missing = S.validate_rows(df.drop("age"), S.CHURN_RULES).first()
    assert "age: field required" in missing.errors


def test_numeric_prep_learns_on_train_only(spark):
    spec = PanelSpec(period="p", id="i", target="y", numeric=("a",), categorical=())
    train = spark.createDataFrame([(float(v),) for v in range(100)], "a double")
    model = FE.NumericPrep(inputCols=["a"], outputCols=["a_out"], lower=0.0, upper=1.0).fit(train)
    st = model.getStats()["a"]
    assert (st["lo"], st["hi"]) == (0.0, 99.0)
    new = spark.createDataFrame([(5000.0,), (None,)], "a double")
    out = [r.a_out for r in model.transform(new).collect()]
    # 5000 is clipped to 99 (learned bound), null is imputed with the median 49.5
    assert out[0] == pytest.approx((99 - st["mean"]) / st["sd"])
    assert out[1] == pytest.approx((49.5 - st["mean"]) / st["sd"])
    assert spec.numeric == ("a",)


def test_winsor_bounds_resist_outlier(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1000, 2))
    x[0, 0] = 1000.0
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double")
    st = FE.NumericPrep(inputCols=["a", "b"], outputCols=["a2", "b2"]).fit(df).getStats()
    assert st["a"]["hi"] == pytest.approx(float(np.quantile(x[:, 0], 0.99)))
    assert st["a"]["hi"] < 10


def test_mode_imputer_tie_smallest_and_onehot_unseen(spark):
    spec = PanelSpec(period="p", id="i", target="y", numeric=("a",), categorical=("c",))
    train = spark.createDataFrame([(1.0, "b", 0), (2.0, "a", 1), (3.0, "b", 0), (4.0, "a", 1)],
                                  "a double, c string, y int")
    model = FE.build_pipeline(spec).fit(train)
    imp = [st for st in model.stages if isinstance(st, FE.ModeImputerModel)][0]
    assert imp.getStats()["c"] == "a"  # tie between a and b -> smallest
    test = spark.createDataFrame([(1.0, "zz", 0), (1.0, None, 0)], "a double, c string, y int")
    vecs = [r.features.toArray().tolist() for r in model.transform(test).collect()]
    assert vecs[0][1:] == [0.0, 0.0]  # unseen level -> all zeros
    assert vecs[1][1:] == [1.0, 0.0]  # null -> imputed mode 'a'
    assert FE.feature_names(model, spec) == ["a", "c_a", "c_b"]
