"""Edge cases (FIXTURES F5): nulls, NaN, constant column, one-class month,
empty month, unseen category."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwatch.functions.scalar import clip
from panelwatch.operators import drift as D
from panelwatch.operators import profile as P
from panelwatch.operators.quantiles import exact_quantiles
from panelwatch.spec import PanelSpec, RegimeSpec


def test_histogram_constant_column_widened(spark):
    df = spark.createDataFrame([(5.0,)] * 4, "x double")
    h = sorted(P.equal_width_histogram(df, "x", 40).collect(), key=lambda r: r.bin)
    assert len(h) == 40 and sum(r.n for r in h) == 4
    assert h[0].bin_lo == pytest.approx(4.5) and h[-1].bin_hi == pytest.approx(5.5)
    counts, edges = np.histogram([5.0] * 4, bins=40)
    assert [r.n for r in h] == counts.tolist()


def test_histogram_matches_numpy_last_bin_closed(spark):
    vals = [0.0, 0.5, 1.0, 2.5, 4.0, 4.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    h = sorted(P.equal_width_histogram(df, "x", 4).collect(), key=lambda r: r.bin)
    counts, _ = np.histogram(vals, bins=4)
    assert [r.n for r in h] == counts.tolist()


def test_quantiles_ignore_nan_and_null(spark):
    rows = [(1.0,), (float("nan"),), (None,), (3.0,), (2.0,)]
    df = spark.createDataFrame(rows, "x double")
    r = exact_quantiles(df, [], "x", [0.5, 0.99], ["m", "p99"]).first()
    assert r.m == pytest.approx(float(np.nanquantile([1, np.nan, 3, 2], 0.5)))
    assert r.p99 == pytest.approx(float(np.nanquantile([1, np.nan, 3, 2], 0.99)))


def test_clip_keeps_null_and_nan(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (-3.0,), (9.0,)], "x double")
    got = [r.c for r in df.select(clip("x", 0.0, 5.0).alias("c")).collect()]
    assert got[0] is None and math.isnan(got[1]) and got[2:] == [0.0, 5.0]


def test_null_counts_and_one_class_month(spark):
    spec = PanelSpec(period="m", id="i", target="y", numeric=("x",), categorical=("c",))
    rows = [("a", "2024-01", None, "u", 0), ("b", "2024-01", 1.0, None, 0),
            ("a", "2024-02", 2.0, "u", 1), ("b", "2024-02", 3.0, "v", 0)]
    df = spark.createDataFrame(rows, "i string, m string, x double, c string, y int")
    nulls = {r.column: r.n_null for r in P.null_counts(df).collect()}
    assert nulls == {"i": 0, "m": 0, "x": 1, "c": 1, "y": 0}
    s = {r.m: r for r in P.period_summary(df, spec, "x", RegimeSpec()).collect()}
    assert s["2024-01"].target_rate == 0.0
    assert s["2024-01"].variable_target_corr is None  # one class: no correlation, no error


def test_drift_with_empty_and_unseen(spark):
    spec = PanelSpec(period="m", id="i", target="y", numeric=("x",), categorical=("c",),
                     train_periods=("2024-01",))
    rows = [("a", "2024-01", 1.0, "u", 0, 0.2), ("b", "2024-01", 2.0, "v", 1, 0.7),
            ("c", "2024-02", 2.0, "new", 0, 0.3), ("d", "2024-02", 9.0, "u", 0, 0.1)]
    df = spark.createDataFrame(rows, "i string, m string, x double, c string, y int, p double")
    rec = D.monthly_drift(df, spec, ["2024-01"], RegimeSpec(),
                          cfg=D.MonitorConfig(prediction="p")).collect()
    assert len(rec) == 1
    r = rec[0]
    assert r.month == "2024-02" and r.roc_auc is None and r.auc_delta is None  # one class
    assert r.status in ("OK", "VIGILAR")  # null delta skips the AUC rule
    assert "c" in r.drifted_columns  # unseen category moves the shares
    none = D.monthly_drift(df, spec, ["2024-01"], RegimeSpec(), periods=["2024-05"],
                           cfg=D.MonitorConfig(prediction="p")).collect()
    assert none == []  # an empty month gives no record


def test_status_policy_table(spark):
    from panelwatch.functions.scalar import drift_status
    cases = [(0.10, -0.03, "CRITICO"), (0.50, -0.02, "CRITICO"), (0.50, -0.019, "VIGILAR"),
             (0.30, 0.0, "OK"), (0.31, None, "VIGILAR"), (0.0, None, "OK")]
    df = spark.createDataFrame(cases, "share double, delta double, want string")
    got = df.select(drift_status("share", "delta").alias("s"), "want").collect()
    assert all(r.s == r.want for r in got)


def test_champion_is_chosen_before_rounding(spark):
    from panelwatch.operators.models import choose_champion

    m = spark.createDataFrame([("a", "validation", 0.86411, 0.5, 0.5), ("b", "validation", 0.86414, 0.5, 0.5),
                               ("b", "train", 0.1, 0.1, 0.1)], "model string, split string, roc_auc double, pr_auc double, f1 double")
    best = choose_champion(m).first()
    assert best.model == "b" and best.roc_auc == 0.8641


def test_one_class_and_empty_month_give_nulls(spark):
    from panelwatch.operators import association as A
    from panelwatch.operators import profile as P
    from panelwatch.spec import PanelSpec

    spec = PanelSpec(period="m", id="i", target="t", numeric=("x",), categorical=("c",))
    df = spark.createDataFrame([("a", 1, 0, 0.0, "u"), ("b", 2, 0, 0.0, "v")], "m string, i int, t int, x double, c string")
    assert P.dataset_overview(df, spec).first().imbalance_ratio is None
    assert P.class_balance(df, spec).first().weight_positive is None
    assert {r.m: r.share_u for r in P.period_category_share(df, spec, "c", ["u"]).collect()} == {"a": 1.0, "b": None}
    ones = df.unionByName(df.withColumn("t", df.t + 1))
    assert A.point_biserial(ones, spec, ["x"]).first().relative_diff is None


def test_correlation_with_nulls_uses_complete_rows(spark):
    from panelwatch.functions.scalar import safe_corr

    rows = [(1.0, 2.0), (2.0, 3.0), (3.0, 5.5), (None, 99.0), (50.0, None), (4.0, 5.0)]
    got = spark.createDataFrame(rows, "x double, y double").agg(safe_corr("x", "y").alias("r")).first().r
    full = [r for r in rows if None not in r]
    import numpy as np

    assert abs(got - np.corrcoef(*zip(*full))[0, 1]) < 1e-12


def test_small_helpers(spark, tmp_path):
    from panelwatch.functions import scalar as H
    from panelwatch.operators import profile as P
    from panelwatch.sources import panel_io as IO

    assert [r.period for r in H.month_labels(spark, "2024-11", 3).collect()] == ["2024-11", "2024-12", "2025-01"]
    df = spark.createDataFrame([("2024-01", "x", 0.25), ("2024-02", "x", 0.5)], "month string, column string, score double")
    assert df.select(H.padded_id(F.lit(42)).alias("i")).first().i == "CUST-000042"
    assert {(r.column, r.type) for r in P.schema_listing(df).collect()} == {("month", "string"), ("column", "string"), ("score", "double")}
    path = str(tmp_path / "detail")
    IO.write_drift_detail(df, path)
    IO.write_drift_detail(df.where("month = '2024-02'").withColumn("score", F.lit(0.75)), path)  # replaces one month
    assert {(r.month, r.score) for r in spark.read.json(path).collect()} == {("2024-01", 0.25), ("2024-02", 0.75)}
