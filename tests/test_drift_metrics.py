"""Hand-computed values for drift distances and rank metrics (FIXTURES F5)."""

import math

import numpy as np
import pytest

from panelwatch.operators.drift import jensen_shannon_by_period, wasserstein_by_period
from panelwatch.operators.metrics import evaluate, ranking_metrics


def _w1_brute(a, b):
    pts = sorted(set(a) | set(b))
    fa = lambda x: sum(v <= x for v in a) / len(a)
    fb = lambda x: sum(v <= x for v in b) / len(b)
    return sum(abs(fa(x) - fb(x)) * (y - x) for x, y in zip(pts, pts[1:]))


def test_w1_fixture(spark, ranges):
    rows = [("ref", "x", v) for v in (0.0, 1.0, 3.0)] + [("m1", "x", v) for v in (0.0, 2.0, 2.0, 4.0)]
    df = spark.createDataFrame(rows, "period string, column string, value double")
    r = wasserstein_by_period(df, "period", ["ref"], ["m1"]).collect()
    assert len(r) == 1
    assert r[0].w1 == pytest.approx(0.833333, abs=1e-6)
    assert r[0].sd_ref == pytest.approx(1.247219, abs=1e-6)
    assert r[0].score == pytest.approx(0.668153, abs=1e-6)


def test_w1_random_against_brute_force(spark, ranges):
    rng = np.random.default_rng(11)
    ref = np.round(rng.normal(0, 1, 60), 1)
    months = {f"m{i}": np.round(rng.normal(i * 0.3, 1 + 0.2 * i, 40 + 5 * i), 1) for i in range(4)}
    rows = [("ref", "x", float(v)) for v in ref]
    rows += [(m, "x", float(v)) for m, arr in months.items() for v in arr]
    rows += [("ref", "y", float(v)) for v in ref * 2] + [("m2", "y", 5.0)]
    df = spark.createDataFrame(rows, "period string, column string, value double")
    got = {(r.period, r.column): r.w1 for r in
           wasserstein_by_period(df, "period", ["ref"]).collect()}
    for m, arr in months.items():
        assert got[(m, "x")] == pytest.approx(_w1_brute(list(ref), list(arr)), abs=1e-9)
    assert got[("m2", "y")] == pytest.approx(_w1_brute(list(ref * 2), [5.0]), abs=1e-9)


def test_w1_places_its_points_once(spark, monkeypatch):
    from panelwatch.operators import drift, scan

    rng = np.random.default_rng(5)
    months = {m: np.round(rng.normal(k, 1, 50), 1) for k, m in enumerate(("ref", "m1", "m2"))}
    rows = [(m, "x", float(v)) for m, arr in months.items() for v in arr]
    # few points of a column in many runs, a constant reference, a column without reference, a period beyond it
    rows += [("ref", "c", 0.1)] * 3 + [("m1", "c", 0.1)] * 7 + [("m2", "c", 0.3), ("m1", "no_ref", 1.0), ("m2", "far", 9.0), ("ref", "far", 1.0)]
    counts = drift._counted(spark.createDataFrame(rows, "period string, column string, value double"), "period", ["ref"], None, True)
    kept, calls = drift.materialize, []
    for module in (drift, scan):
        monkeypatch.setattr(module, "materialize", lambda df: (calls.append(1), kept(df))[1])
    monkeypatch.setattr(drift, "RANGE_POINTS", 9)
    got = {(r.period, r.column): r for r in drift.wasserstein_from_counts(counts, "period", ["ref"]).collect()}
    assert len(calls) == 2  # the points and one row per (period, column)
    assert set(got) == {("m1", "x"), ("m2", "x"), ("m1", "c"), ("m2", "c"), ("m2", "far")}
    for m in ("m1", "m2"):
        assert got[(m, "x")].w1 == pytest.approx(_w1_brute(list(months["ref"]), list(months[m])), abs=1e-9)
    assert got[("m1", "x")].sd_ref == pytest.approx(months["ref"].std(), abs=1e-9)
    assert (got[("m1", "c")].w1, got[("m1", "c")].score) == (0.0, 0.0)
    assert got[("m2", "c")].w1 == pytest.approx(0.2) and got[("m2", "c")].score is None
    assert got[("m2", "far")].w1 == pytest.approx(8.0)
    both = {r.period: r.w1 for r in drift.wasserstein_from_counts(counts.where("column = 'x'"), "period", ["ref"], ["ref", "m1"]).collect()}
    assert both["ref"] == pytest.approx(0, abs=1e-12) and both["m1"] == pytest.approx(got[("m1", "x")].w1)


def test_js_fixture(spark):
    rows = [("ref", "c", "a")] * 5 + [("ref", "c", "b")] * 5 + [("m", "c", "a")] * 9 + [("m", "c", "b")]
    df = spark.createDataFrame(rows, "period string, column string, value string")
    r = jensen_shannon_by_period(df, "period", ["ref"], ["m"]).collect()
    assert r[0].score == pytest.approx(0.318982, abs=1e-6)


def test_js_disjoint_support(spark):
    rows = [("ref", "c", "a"), ("m", "c", "z")]
    df = spark.createDataFrame(rows, "period string, column string, value string")
    r = jensen_shannon_by_period(df, "period", ["ref"], ["m"]).collect()
    assert r[0].score == pytest.approx(math.sqrt(math.log(2)), abs=1e-12)


def test_auc_ap_fixture(spark, ranges):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1)], "p double, y int")
    r = ranking_metrics(df, [], "p", "y").first()
    assert r.roc_auc == pytest.approx(0.75)
    assert r.pr_auc == pytest.approx(0.833333, abs=1e-6)


def test_auc_ties_and_one_class(spark):
    rows = [("a", 0.5, 1), ("a", 0.5, 0), ("a", 0.2, 0), ("b", 0.3, 1)]
    df = spark.createDataFrame(rows, "g string, p double, y int")
    got = {r.g: r for r in evaluate(df, ["g"], "p", "y").collect()}
    assert got["a"].roc_auc == pytest.approx(0.75)  # tie counts half
    assert got["b"].roc_auc is None  # one class: undefined (B14)
    assert got["a"].precision == pytest.approx(0.5) and got["a"].recall == pytest.approx(1.0)


def test_chi_square_drift_against_table(spark):
    from panelwatch.operators.drift import chi_square_by_period, column_drift

    ref, cur = {"a": 30, "b": 50, "c": 20}, {"a": 10, "b": 10, "d": 5}
    rows = [("ref", "k", v) for v, n in ref.items() for _ in range(n)] + [("m", "k", v) for v, n in cur.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "period string, column string, value string")
    r = chi_square_by_period(df, "period", ["ref"]).first()
    table = np.array([[ref.get(v, 0), cur.get(v, 0)] for v in "abcd"], float)
    want = table.sum(1, keepdims=True) * table.sum(0, keepdims=True) / table.sum()
    assert r.statistic == pytest.approx(((table - want) ** 2 / want).sum()) and r.dof == 3
    assert r.score == pytest.approx(math.erfc(math.sqrt(r.statistic / 2)) + math.sqrt(2 * r.statistic / math.pi) * math.exp(-r.statistic / 2))
    wide = df.select("period", df["value"].alias("k"))
    d = column_drift(wide, "period", [], ["k"], ["ref"], categorical_method="chi_square").first()
    assert (d.direction, d.threshold, d.drifted) == ("lower", 0.05, True)


def test_w1_keeps_a_range_as_one_row_a_column(spark, monkeypatch):
    from panelwatch.operators import drift

    rng = np.random.default_rng(6)
    months = {m: np.round(rng.normal(k, 1, 300), 3) for k, m in enumerate(("ref", "r2", "m1", "m2", "m3"))}
    rows = [(m, c, float(v)) for c in ("x", "y") for m, arr in months.items() for v in arr] + [("m1", None, 1.0)]
    counts = drift._counted(spark.createDataFrame(rows, "period string, column string, value double"), "period", ["ref", "r2"], None, True)
    kept, frames = drift.materialize, []
    monkeypatch.setattr(drift, "materialize", lambda df: frames.append(kept(df)) or frames[-1])
    monkeypatch.setattr(drift, "RANGE_POINTS", 50)
    got = {(r.period, r.column): r for r in drift.wasserstein_from_counts(counts, "period", ["ref", "r2"]).collect()}
    packed = frames[0]  # no row, and no text, of a single point
    assert packed.count() <= packed.rdd.getNumPartitions() + 1 < counts.count() / 10
    assert not {"string"} & {t for _, t in packed.dtypes}
    ref = [*months["ref"], *months["r2"]]
    assert set(got) == {(m, c) for m in ("m1", "m2", "m3") for c in "xy"}
    for (m, _), r in got.items():
        assert r.w1 == pytest.approx(_w1_brute(ref, list(months[m])), abs=1e-9)
        assert r.sd_ref == pytest.approx(np.std(ref), abs=1e-9)
