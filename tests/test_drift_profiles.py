"""Drift from counts: one scan, one scoring, empty columns, and profiles stored by period."""

import math

import pytest
from pyspark.sql import functions as F

from panelwatch.operators import drift as D
from panelwatch.operators.scoring import Scorecard, linear_score
from panelwatch.plans import training as TR
from panelwatch.sources import panel_io, profile_store
from panelwatch.sources.tables import LINEITEM_REGIMES, LINEITEM_SPEC, lineitem_panel
from panelwatch.spec import PanelSpec, RegimeSpec

SF = "/root/testdata/sf0.001"
SPEC = PanelSpec(period="m", id="i", target="y", numeric=("x", "z"), categorical=("c",), train_periods=("2024-01",), validation_periods=())
CFG = D.MonitorConfig()


class PassThrough:
    """A model that Spark cannot prune or look into, counting the rows it scores."""

    def __init__(self, spark):
        self.rows = spark.sparkContext.accumulator(0)

    def transform(self, df):
        rows = self.rows

        @F.udf("array<double>")
        def score(x):
            rows.add(1)
            return [1 - (x or 0.0), x or 0.0]

        from pyspark.ml.functions import array_to_vector
        return df.withColumn("probability", array_to_vector(score("l_discount")))


def scans(plan: str) -> int:
    return plan.count("FileScan parquet")


def test_monitoring_scans_and_scores_once(spark, monkeypatch):
    seen = []
    keep = D.materialize
    monkeypatch.setattr(D, "materialize", lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString()) or keep(df))
    model = PassThrough(spark)
    panel = lineitem_panel(spark, SF)
    TR.monitor_panel(panel, LINEITEM_SPEC, model, LINEITEM_REGIMES).collect()
    assert model.rows.value == panel.count()
    assert [scans(p) for p in seen] == [1] + [0] * (len(seen) - 1)
    assert "BatchEvalPython" in seen[0] and not any("BatchEvalPython" in p for p in seen[1:])


def panel(spark, rows):
    return spark.createDataFrame(rows, "m string, x double, z double, c string, prediction double, y int")


def months(rng_rows=20):
    nan = float("nan")
    rows = []
    for k in range(rng_rows):
        y = k % 2
        rows += [("2024-01", float(k), None, "a" if k % 3 else "b", k / 20, y), ("2024-02", None if k % 2 else nan, 1.0, None, k / 20, y),
                 ("2024-03", float(k), 2.0, "a" if k % 3 else "b", k / 20, 1 - y)]
    return rows


def test_empty_columns_keep_their_rows(spark):
    df = panel(spark, months())
    got = {(r.m, r.column): r for r in D.column_drift(df, "m", ["x", "z"], ["c"], ["2024-01"]).collect()}
    assert sorted(got) == [(m, c) for m in ("2024-02", "2024-03") for c in ("c", "x", "z")]
    empty = [("2024-02", "x"), ("2024-02", "c"), ("2024-02", "z"), ("2024-03", "z")]
    assert all(got[k].score is None and got[k].drifted for k in empty)
    assert all(got[k].score == pytest.approx(0) and not got[k].drifted for k in set(got) - set(empty))
    low = {(r.m, r.column): r for r in D.column_drift(df, "m", [], ["c"], ["2024-01"], categorical_method="chi_square").collect()}
    assert low[("2024-02", "c")].score is None and low[("2024-02", "c")].drifted
    assert low[("2024-03", "c")].score == pytest.approx(1) and not low[("2024-03", "c")].drifted


def test_empty_month_is_reported(spark):
    rec = {r.month: r for r in D.monthly_drift(panel(spark, months()), SPEC, ["2024-01"], RegimeSpec()).collect()}
    assert rec["2024-02"].drifted_columns == ["x", "z", "c"] and rec["2024-02"].drifted_columns_share == 1 and rec["2024-02"].status == "VIGILAR"
    assert rec["2024-02"].n_rows == 20 and rec["2024-02"].auc_delta == 0
    assert rec["2024-03"].drifted_columns == ["z"] and rec["2024-03"].status == "CRITICO"
    only_ref_empty = D.jensen_shannon_by_period(spark.createDataFrame([("r", "c", None), ("s", "c", "v")], "m string, column string, value string"), "m", ["r"])
    assert only_ref_empty.count() == 0


def test_profiles_give_the_records_of_the_rows(spark, tmp_path):
    df, path = panel(spark, months()), str(tmp_path / "profiles")
    profile_store.store_profiles(df, SPEC, path, ["2024-01"])
    out = []
    for m in ("2024-02", "2024-03", "2024-02"):  # a repeated month replaces its profile
        out.append(profile_store.monitor_new_periods(df, SPEC, path, [m], ["2024-01"], RegimeSpec()).collect())
    want = {r.month: r for r in D.monthly_drift(df, SPEC, ["2024-01"], RegimeSpec()).collect()}
    assert [r for (r,) in out] == [want["2024-02"], want["2024-03"], want["2024-02"]]
    cells = profile_store.read_profiles(spark, SPEC, path)
    assert cells.where("role = 'rows'").agg(F.sum("n")).first()[0] == df.count()
    assert {r.m for r in cells.select("m").distinct().collect()} == {"2024-01", "2024-02", "2024-03"}


def test_a_new_month_reads_its_own_partition(spark, tmp_path):
    panel_path, path = str(tmp_path / "panel"), str(tmp_path / "profiles")
    panel_io.write_panel(lineitem_panel(spark, SF), panel_path, LINEITEM_SPEC)
    card = Scorecard(intercept=0.1, numeric={"l_discount": (.05, .03, .2)})
    scored = linear_score(spark.read.parquet(panel_path), card, "prediction").withColumn("ship_month", F.col("ship_month").cast("string"))
    cells = D.panel_counts(scored.where(F.col("ship_month").isin(["1998-01"])), "ship_month", ["l_discount", "prediction"], [], "prediction", "returned")
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert scans(plan) == 1 and "PartitionFilters: [isnotnull(ship_month" in plan and "1998-01" in plan.split("PartitionFilters")[1][:200]
    spec = LINEITEM_SPEC.with_(numeric=("l_discount",), categorical=())
    profile_store.store_profiles(scored, spec, path, list(spec.train_periods))
    read = profile_store.read_profiles(spark, spec, path, ["1995-01"])
    assert "PartitionFilters: [isnotnull(ship_month" in read._jdf.queryExecution().executedPlan().toString()
    got = profile_store.monitor_new_periods(scored, spec, path, ["1998-01"], spec.train_periods, LINEITEM_REGIMES).first()
    want = D.monthly_drift(scored, spec, spec.train_periods, LINEITEM_REGIMES, ["1998-01"]).first()
    assert got == want and math.isfinite(got.roc_auc)


def test_months_need_no_extra_passes_over_the_cells(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    df = panel(spark, months())
    monkeypatch.setattr(DataFrame, "count", lambda self: pytest.fail("the points are counted in a pass of their own"))
    cells = D.materialize(D.panel_counts(df, "m", ["x", "z", "prediction"], ["c"], "prediction", "y"))
    # one month is in the reference as well
    out = D.monthly_from_counts(cells, SPEC, ["2024-01"], RegimeSpec(), ["2024-01", "2024-03"])
    rec = {r.month: r for r in out.collect()}
    assert rec["2024-01"].roc_auc == rec["2024-01"].reference_roc_auc == rec["2024-03"].reference_roc_auc and rec["2024-01"].auc_delta == 0
    assert rec["2024-01"].n_rows == rec["2024-03"].n_rows == 20 and rec["2024-01"].drifted_columns == ["z"]


def test_sizes_of_cells(spark):
    cells = D.panel_counts(panel(spark, months()), "m", ["x", "z"], ["c"], "prediction", "y")
    got = {(r.m, r.role, r.column): (r.n, r["values"], r.known) for r in D.cell_sizes(cells, "m").collect()}
    assert got[("2024-01", "numeric", "x")] == (20, 20, 20) and got[("2024-02", "numeric", "x")] == (20, 0, 0)
    assert got[("2024-03", "numeric", "z")] == (20, 1, 20) and got[("2024-02", "categorical", "c")] == (20, 0, 0)
    assert got[("2024-01", "categorical", "c")] == (20, 2, 20) and got[("2024-02", "rows", "")][0] == 20
