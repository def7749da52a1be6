"""Results do not depend on how many ranges the ordered scans cut a group into."""

import pytest

from conftest import as_many_ranges

from panelwatch.operators import drift as D
from panelwatch.operators import metrics as M
from panelwatch.operators.quantiles import exact_quantiles
from panelwatch.plans import catalog as C

SF = "/root/testdata/sf0.001"


def _rows(df, key):
    return {tuple(r[k] for k in key): r for r in df.collect()}


def _with(spark, ranges, made):
    with as_many_ranges(spark, ranges):
        return made()


def test_monthly_drift(spark):
    scored = C._scored_li(spark, SF)
    ra, rb = (_with(spark, n, lambda: _rows(D.monthly_drift(
        scored, C.LINEITEM_SPEC, C._LI_REF, C.LINEITEM_REGIMES, cfg=C._MCFG), ["month"])) for n in (1, 23))
    assert ra.keys() == rb.keys() and len(ra) > 10
    for k in ra:
        for c in ("drifted_columns_count", "status", "prediction_drift_detected", "n_rows"):
            assert ra[k][c] == rb[k][c]
        for c in ("drifted_columns_share", "prediction_drift_score", "roc_auc", "auc_delta"):
            assert ra[k][c] == pytest.approx(rb[k][c], abs=1e-9)


def test_quantiles_and_auc(spark):
    scored = C._scored_li(spark, SF)
    qa, qb = (_with(spark, n, lambda: _rows(exact_quantiles(
        scored, ["ship_month"], "l_extendedprice", [0.01, 0.5, 0.99]), ["ship_month"])) for n in (1, 23))
    for k in qa:
        for c in ("q010", "q500", "q990"):
            assert qa[k][c] == pytest.approx(qb[k][c], abs=1e-9)
    ea, eb = (_with(spark, n, lambda: _rows(M.ranking_metrics(
        scored, ["ship_month"], "z", "returned"), ["ship_month"])) for n in (1, 23))
    for k in ea:
        assert ea[k].roc_auc == pytest.approx(eb[k].roc_auc, abs=1e-12)
        assert ea[k].pr_auc == pytest.approx(eb[k].pr_auc, abs=1e-12)
