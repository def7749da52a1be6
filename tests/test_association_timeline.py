"""Chi-square / Cramer's V fixture, p-values, timeline operators."""

import math

import pytest
from pyspark.sql import functions as F

from panelwatch.functions.stats import chi2_pvalue, correlation_pvalue, t_pvalue
from panelwatch.operators import association as A
from panelwatch.operators import timeline as TL
from panelwatch.spec import PanelSpec, RegimeSpec


def _table(spark):
    # 2x2 table ((30, 10), (20, 25)): rows = category, columns = target 0/1
    rows = [("a", 0)] * 30 + [("a", 1)] * 10 + [("b", 0)] * 20 + [("b", 1)] * 25
    return spark.createDataFrame(rows, "c string, y int")


def test_chi_square_yates_and_cramers_v(spark):
    spec = PanelSpec(period="p", id="i", target="y", numeric=(), categorical=("c",))
    r = A.chi_square(_table(spark), spec, ["c"], with_pvalue=True).first()
    assert r.dof == 1
    assert r.chi2 == pytest.approx(6.949931, abs=1e-6)
    assert r.p_value == pytest.approx(0.008382, abs=1e-6)
    assert r.significant
    u = A.chi_square(_table(spark), spec, ["c"], yates=False).first()
    assert u.chi2 == pytest.approx(8.162698, abs=1e-6)
    assert r.cramers_v == pytest.approx(math.sqrt(6.949931 / 85), abs=1e-6)


def _even_chi2(x, dof):
    """Closed form for an even number of degrees of freedom."""
    total = term = 1.0
    for k in range(1, dof // 2):
        term *= x / 2 / k
        total += term
    return math.exp(-x / 2) * total


def test_special_functions(spark):
    chi = [(x, d) for d in (2, 4, 10, 60, 400) for x in (.01, .9, 3.0, 12.0, 55.0, 380.0, 420.0, 1300.0)]
    rows = spark.createDataFrame([(float(x), float(d)) for x, d in chi], "x double, d double").select(chi2_pvalue(F.col("x"), F.col("d")).alias("p")).collect()
    for (x, d), r in zip(chi, rows):
        assert r.p == pytest.approx(_even_chi2(x, d), rel=1e-9, abs=1e-15), (x, d)
    one = [.001, .5, 3.841459, 30.0]
    rows = spark.createDataFrame([(x,) for x in one], "x double").select(chi2_pvalue(F.col("x"), F.lit(1)).alias("p")).collect()
    assert [r.p for r in rows] == pytest.approx([math.erfc(math.sqrt(x / 2)) for x in one], rel=1e-9)
    ts = [.001, .3, 1.0, 2.228139, 12.0, -7.0, 4000.0]
    rows = spark.createDataFrame([(t,) for t in ts], "t double").select(
        t_pvalue(F.col("t"), F.lit(1)).alias("a"), t_pvalue(F.col("t"), F.lit(2)).alias("b"), t_pvalue(F.col("t"), F.lit(10)).alias("c"),
        t_pvalue(F.col("t"), F.lit(10_000_000)).alias("d")).collect()
    assert [r.a for r in rows] == pytest.approx([2 / math.pi * math.atan2(1, abs(t)) for t in ts], rel=1e-9)
    # two degrees of freedom: 1 - t / sqrt(2 + t^2), written without cancellation
    assert [r.b for r in rows] == pytest.approx([2 / (2 + t * t) / (1 + abs(t) / math.sqrt(2 + t * t)) for t in ts], rel=1e-9)
    assert rows[3].c == pytest.approx(.05, abs=1e-6)
    assert [r.d for r in rows[:4]] == pytest.approx([math.erfc(abs(t) / math.sqrt(2)) for t in ts[:4]], rel=1e-5)


def test_special_functions_without_an_answer(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(None, 1.0), (nan, 1.0), (3.0, None), (3.0, 0.0), (-1.0, 2.0), (0.0, 2.0), (inf, 2.0)]
    got = spark.createDataFrame(rows, "x double, d double").select(
        chi2_pvalue(F.col("x"), F.col("d")).alias("c"), t_pvalue(F.col("x"), F.col("d")).alias("t"),
        correlation_pvalue(F.lit(0.5), F.col("d")).alias("r")).collect()
    assert [r.c for r in got] == [None, None, None, None, None, 1.0, 0.0]
    assert [r.t is None for r in got] == [True, True, True, True, False, False, False] and got[5].t == 1.0 and got[6].t == 0.0
    assert all(r.r is None for r in got)


def test_point_biserial_order_and_relative_diff(spark):
    rows = [(float(i), float(i % 3), i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "x double, z double, y int")
    spec = PanelSpec(period="p", id="i", target="y", numeric=("x", "z"), categorical=())
    out = A.point_biserial(df, spec, ["x", "z"], with_pvalue=True).collect()
    assert abs(out[0].r) >= abs(out[1].r)
    x = [r for r in out if r.column == "x"][0]
    assert x.relative_diff == pytest.approx(x.mean_positive / x.mean_negative - 1)
    assert 0 <= x.p_value <= 1


def test_consecutive_runs_and_change(spark):
    rows = [("2024-01", "OK"), ("2024-02", "OK"), ("2024-03", "VIGILAR"), ("2024-04", "OK"),
            ("2024-05", "CRITICO"), ("2024-06", "CRITICO")]
    df = spark.createDataFrame(rows, "month string, status string")
    runs = sorted((r.first_period, r.last_period, r.status, r.n_periods)
                  for r in TL.consecutive_runs(df, "month", "status", "2024-01").collect())
    assert runs == [("2024-01", "2024-02", "OK", 2), ("2024-03", "2024-03", "VIGILAR", 1),
                    ("2024-04", "2024-04", "OK", 1), ("2024-05", "2024-06", "CRITICO", 2)]
    ms = TL.status_milestones(df).first()
    assert (ms.first_watch, ms.first_critical, ms.lag_periods) == ("2024-03", "2024-05", 2)
    assert ms.latest_status == "CRITICO"
    series = spark.createDataFrame([("2024-08", 1.0), ("2024-09", 1.5), ("2024-10", 1.4),
                                    ("2024-12", 2.0)], "m string, v double")
    ch = {r.m: r.diff for r in TL.period_change(series, "m", "v", "2024-01").collect()}
    assert ch["2024-09"] == pytest.approx(0.5) and ch["2024-12"] is None  # no 2024-11
    s = TL.change_summary(TL.period_change(series, "m", "v", "2024-01"),
                          ["2024-08", "2024-09", "2024-10"], "m").first()
    assert s.non_decreasing is False and s.max_diff == pytest.approx(0.5)


def test_panel_transitions(spark):
    rows = [("c1", "2024-01", 0, 3), ("c1", "2024-02", 0, 4), ("c1", "2024-03", 1, 6),
            ("c2", "2024-01", 1, 1), ("c2", "2024-03", 0, 3), ("c3", "2024-02", 0, 0)]
    df = spark.createDataFrame(rows, "id string, m string, y int, tenure int")
    spec = PanelSpec(period="m", id="id", target="y", numeric=(), categorical=())
    got = {r.m: r for r in TL.panel_transitions(df, spec, "2024-01", tenure="tenure").collect()}
    assert (got["2024-01"].n_new, got["2024-01"].n_ids) == (2, 2)
    assert (got["2024-02"].n_retained, got["2024-02"].n_new, got["2024-02"].n_lost) == (1, 1, 1)
    assert (got["2024-03"].n_returned, got["2024-03"].n_retained, got["2024-03"].n_lost) == (1, 1, 1)
    assert got["2024-02"].n_tenure_breaks == 1  # c1: 4 -> 6
    assert got["2024-01"].n_target_then_present == 0  # c2 churned and is absent in 2024-02


def test_regime_label_calendar(spark):
    from panelwatch.functions.scalar import regime_label
    df = spark.createDataFrame([("2024-08",), ("2024-09",), ("2024-12",), ("2025-01",)], "m string")
    got = [r.r for r in df.select(regime_label("m", RegimeSpec()).alias("r")).collect()]
    assert got == ["baseline", "data_drift", "data_drift", "concept_drift"]


def test_correlation_matrix_pairs(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, float((i * 7) % 5)) for i in range(30)],
                               "a double, b double, c double")
    m = {(r.col_a, r.col_b): r.r for r in A.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert set(m) == {("a", "b"), ("a", "c"), ("b", "c")}
    assert m[("a", "b")] == pytest.approx(1.0)
    strong = A.strong_pairs(A.correlation_matrix(df, ["a", "b", "c"])).collect()
    assert ("a", "b") in {(r.col_a, r.col_b) for r in strong}
    const = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert A.correlation_matrix(const, ["a", "b"]).first().r is None  # zero variance -> null
