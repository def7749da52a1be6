"""Packed profiles: the counts of the cells in few rows, whatever the chunks and ranges."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwatch.operators import drift as D
from panelwatch.operators import panel_profile as PP
from panelwatch.sources import profile_store
from panelwatch.spec import PanelSpec, RegimeSpec

SPEC = PanelSpec(period="m", id="i", target="y", numeric=("x", "z"), categorical=("c",), train_periods=("2024-01", "2024-02"), validation_periods=())
REF = ["2024-01", "2024-02"]
CFG = D.MonitorConfig()


def rows(n=1500, seed=3):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        k = int(rng.integers(0, 5))
        x = [None, float("nan"), -0.0, 0.0, float(np.round(rng.normal(k, 2), 2))][min(int(rng.integers(0, 20)), 4)]
        z = None if k == 3 else float(rng.integers(0, 4))
        c = [None, "", "a", "b", f"t{i}"][int(rng.integers(0, 5))]
        p = None if i % 97 == 0 else float(np.round(rng.random(), 2))
        out.append((None if i % 211 == 0 else f"2024-0{k + 1}", x, z, c, p, None if i % 89 == 0 else [0, 1, 0, 1, 2][int(rng.integers(0, 5 if k == 2 else 4))]))
    return out


def panel(spark, n=800):
    return spark.createDataFrame(rows(n), "m string, x double, z double, c string, prediction double, y int").repartition(6)


def profiled(df):
    return PP.panel_profile(df, "m", ["x", "z", "prediction"], ["c"], "prediction", "y")


def unpacked(profile):
    got = {}
    for r in profile.collect():
        key = (r.m, r.role, r.column, r.label)
        pairs = [*zip(r.texts, r.text_counts)] if r.role == "categorical" else [*zip(np.frombuffer(r["values"]), np.frombuffer(r.counts, np.int64))]
        assert len(pairs) == r.points == len({v for v, _ in pairs}) and sum(n for _, n in pairs) == r.known
        for v, n in [*pairs, (None, r.n - r.known)]:
            if n:
                got[(*key, v)] = got.get((*key, v), 0) + int(n)
    return got


def test_profile_counts_what_the_cells_count(spark):
    df = panel(spark)
    cells = D.panel_counts(df, "m", ["x", "z", "prediction"], ["c"], "prediction", "y").collect()
    want = {(r.m, r.role, r.column, r.label, r.text if r.role == "categorical" else r.num): r.n for r in cells}
    assert unpacked(profiled(df)) == want
    merged = PP.merge_rows(profiled(df).repartition(3, "m", "column"), "m")
    assert unpacked(merged) == want
    keys = merged.groupBy("m", "role", "column", "label").count().agg(F.max("count")).first()[0]
    assert keys == 1


@pytest.mark.parametrize("points", [1 << 20, 200])
def test_records_of_a_profile_are_those_of_the_cells(spark, monkeypatch, points):
    monkeypatch.setattr(D, "RANGE_POINTS", points)
    monkeypatch.setattr(PP, "MARK_STEP", 3)
    df = panel(spark)
    cells = D.materialize(D.panel_counts(df, "m", ["x", "z", "prediction"], ["c"], "prediction", "y"))
    for periods in (None, ["2024-02", "2024-05"]):  # a month may be in the reference as well
        want = {r.month: r for r in D.monthly_from_counts(cells, SPEC, REF, RegimeSpec(), periods).collect()}
        got = {r.month: r for r in D.monthly_from_counts(D.materialize(profiled(df)), SPEC, REF, RegimeSpec(), periods).collect()}
        assert got == want and len(got) == (3 if periods is None else 2)
    want = {(r.m, r.column): r for r in D.drift_from_counts(cells, "m", REF).collect()}
    got = {(r.m, r.column): r for r in D.drift_from_counts(profiled(df), "m", REF).collect()}
    assert got.keys() == want.keys()
    for k, r in got.items():
        assert r.score == (None if want[k].score is None else pytest.approx(want[k].score, abs=1e-12)) and r.drifted == want[k].drifted


def test_monitoring_keeps_no_row_of_a_single_value(spark, monkeypatch):
    df, kept, frames = panel(spark), D.materialize, []
    monkeypatch.setattr(D, "materialize", lambda d: frames.append(kept(d)) or frames[-1])
    D.monthly_drift(df, SPEC, REF, RegimeSpec()).collect()
    cells = D.panel_counts(df, "m", ["x", "z", "prediction"], ["c"], "prediction", "y").count()
    assert sum(f.count() for f in frames) < cells / 3


def test_stored_profiles_have_a_row_a_key(spark, tmp_path):
    df, path = panel(spark), str(tmp_path / "profiles")
    profile_store.store_profiles(df, SPEC, path, cfg=CFG)
    stored = profile_store.read_profiles(spark, SPEC, path)
    assert stored.count() <= 6 * (3 + 1 + 4)  # months and columns, and labels
    assert unpacked(stored) == unpacked(profiled(df))


def test_empty_and_missing_sides(spark):
    df = panel(spark)
    assert D.monthly_drift(df.where("false"), SPEC, REF, RegimeSpec()).count() == 0
    only = D.monthly_drift(df.where(F.col("m") == "2024-05"), SPEC, REF, RegimeSpec()).first()
    assert only.reference_roc_auc is None and only.auc_delta is None and only.drifted_columns == ["x", "z", "c"]
