"""End to end on a seeded panel: a change of the inputs alone moves the drift
share and not the AUC; a change of the relation lowers the AUC."""

import numpy as np
import pytest

from panelwatch.operators import drift as D
from panelwatch.operators.models import Candidate
from panelwatch.operators.scoring import score_batch
from panelwatch.plans import training as TR
from panelwatch.spec import PanelSpec, RegimeSpec

SPEC = PanelSpec(period="month", id="cust", target="churn", numeric=("tickets", "tenure", "charge"),
                 categorical=("contract",), train_periods=("2024-01", "2024-02"), validation_periods=("2024-03",))
REGIMES = RegimeSpec(start="2024-01")
KINDS = np.array(["monthly", "one_year", "two_year"])


def month(rng, label, n=4000, shift=0.0, flip=False):
    tickets = rng.poisson(1.5 + shift, n).astype(float)
    tenure = np.maximum(rng.normal(30 - 8 * shift, 15, n), 0)
    charge = rng.normal(60 + 15 * shift, 15, n)
    kind = rng.integers(0, 3, n)
    z = 0.7 * (tickets - 1.5) - 0.05 * (tenure - 30) + 0.02 * (charge - 60) - 0.8 * (kind - 1)
    if flip:
        z = -0.2 * (tickets - 1.5) + 0.03 * (tenure - 30) + 0.3 * (kind - 1)
    y = (rng.random(n) < 1 / (1 + np.exp(-z + 0.5))).astype(int)
    return [(label, f"CUST-{i:06d}", float(tickets[i]), float(tenure[i]), float(charge[i]), str(KINDS[kind[i]]), int(y[i])) for i in range(n)]


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(42)
    rows = [r for m in ("2024-01", "2024-02", "2024-03") for r in month(rng, m)]
    rows += month(rng, "2024-04") + month(rng, "2024-05", shift=1.0) + month(rng, "2024-06", flip=True)
    panel = spark.createDataFrame(rows, "month string, cust string, tickets double, tenure double, charge double, contract string, churn int")
    models, _ = TR.train_candidates(panel, SPEC, [Candidate("logistic_regression", "logistic")])
    return panel, models["logistic_regression"]


def test_data_drift_and_concept_drift_are_told_apart(fitted):
    panel, model = fitted
    rec = {r.month: r for r in TR.monitor_panel(panel, SPEC, model, REGIMES).collect()}
    assert rec["2024-04"].status == "OK" and rec["2024-04"].drifted_columns_count == 0
    assert rec["2024-05"].drifted_columns_share > 0.3 and abs(rec["2024-05"].auc_delta) < 0.02
    assert rec["2024-05"].status == "VIGILAR"
    assert rec["2024-06"].auc_delta < -0.03 and rec["2024-06"].status == "CRITICO"
    assert rec["2024-06"].drifted_columns_count == 0


def test_risky_customer_scores_above_loyal(spark, fitted):
    _, model = fitted
    rows = [("2024-07", "risky", 6.0, 1.0, 95.0, "monthly", 0), ("2024-07", "loyal", 0.0, 60.0, 30.0, "two_year", 0)]
    df = spark.createDataFrame(rows, "month string, cust string, tickets double, tenure double, charge double, contract string, churn int")
    got = {r.cust: r for r in score_batch(df, model, keep=["cust"]).collect()}
    assert got["risky"].churn_probability > 0.5 > got["loyal"].churn_probability


def test_latest_headline_names_the_model(fitted):
    panel, model = fitted
    rec = TR.monitor_panel(panel, SPEC, model, REGIMES)
    top = D.latest_headline(rec, model={"version": "3", "algorithm": "logistic_regression"}).first()
    assert (top.month, top.status, top.model_version, top.model_algorithm) == ("2024-06", "CRITICO", "3", "logistic_regression")
