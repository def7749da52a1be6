"""Binned mode: bounds always hold the exact result, tables add up."""

import random

import pytest
from pyspark.sql import functions as F

from panelwatch.operators import binned as B
from panelwatch.operators.drift import wasserstein_by_period
from panelwatch.operators.metrics import ranking_metrics
from panelwatch.operators.profile import unpivot_numeric


def panel(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        m = rng.choice(["r1", "r2", "m1", "m2", "m3"])
        y = int(rng.random() < .4)
        x = None if rng.random() < .1 else float("nan") if rng.random() < .05 else rng.gauss(y, 2) + (3 if m == "m2" else 0)
        rows.append((m, x, float(rng.randrange(5)), y))
    rows += [("m4", None, 1.0, 0), ("m4", None, 2.0, 0), ("m5", 1e9, -1e9, 1)]
    return spark.createDataFrame(rows, "m string, x double, d double, y int")


REF = ["r1", "r2"]


@pytest.mark.parametrize("bins", [1, 2, 7, 64])
def test_bounds_hold(spark, bins):
    df = panel(spark)
    edges = B.reference_edges(df.where(F.col("m").isin(REF)), ["x", "d"], bins)
    table = B.binned_counts(df, "m", edges, "y").cache()
    assert table.groupBy("m", "column").count().agg(F.max("count")).first()[0] <= bins + 1
    exact = {(r.m, r.column): r.w1 for r in wasserstein_by_period(unpivot_numeric(df, ["x", "d"], keep=["m"]), "m", REF).collect()}
    bounds = {(r.m, r.column): r for r in B.wasserstein_bounds(table, "m", REF).collect()}
    assert set(bounds) == set(exact) and ("m4", "x") not in bounds
    assert all(bounds[k].lower <= v <= bounds[k].upper for k, v in exact.items())
    auc = {r.m: r.roc_auc for r in ranking_metrics(df.where("NOT isnan(x)"), ["m"], "x", "y").collect()}
    for r in B.auc_bounds(table.where("column = 'x'"), ["m"]).collect():
        assert (auc[r.m] is None and r.lower is None) or r.lower - 1e-12 <= auc[r.m] <= r.upper + 1e-12
    values = sorted(r.x for r in df.where("x IS NOT NULL AND NOT isnan(x)").collect())
    for r in B.quantile_bounds(table.where("column = 'x'"), [], [0.0, .1, .5, .9, 1.0]).collect():
        at = int(r.prob * (len(values) - 1))
        assert r.n == len(values) and r.lower <= values[at] <= r.upper
        assert values.index(r.lower) >= at - r.rank_error * r.n and values.index(r.upper) <= at + r.rank_error * r.n
    table.unpersist()


def test_more_bins_are_narrower_and_few_values_are_exact(spark):
    df = panel(spark)
    width = []
    for bins in (2, 8, 64):
        edges = B.reference_edges(df.where(F.col("m").isin(REF)), ["x", "d"], bins)
        bounds = B.wasserstein_bounds(B.binned_counts(df, "m", edges), "m", REF).where("m = 'm2' AND column = 'x'").first()
        width.append(bounds.upper - bounds.lower)
    assert width[0] > width[1] > width[2]
    exact = B.quantile_bounds(B.binned_counts(df, "m", {"d": [1.0, 2.0, 3.0, 4.0]}), [], [.5]).first()
    assert exact.lower == exact.upper and exact.rank_error == 0


def test_tables_add_up(spark):
    df = panel(spark)
    edges = B.reference_edges(df.where(F.col("m").isin(REF)), ["x"], 8)
    parts = [B.binned_counts(df.where(cond), "m", edges, "y") for cond in ("m < 'm3'", "m >= 'm3'")]
    both = B.merged(parts[0].unionByName(parts[1]), ["m"])
    whole = B.merged(B.binned_counts(df, "m", edges, "y"), ["m"])
    assert sorted(map(tuple, both.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)


def test_empty_input(spark):
    none = panel(spark).where("false")
    edges = B.reference_edges(none, ["x"], 8)
    assert edges == {"x": []}
    table = B.binned_counts(none, "m", edges, "y")
    assert table.count() == 0 and B.quantile_bounds(table, [], [.5]).count() == 0 and B.auc_bounds(table, ["m"]).count() == 0


def test_rank_query_moves_no_column_into_one_task(spark, tmp_path):
    """The counted values meet the bounds where they are, also where nothing is small enough to be broadcast by size."""
    import datetime as dt

    from panelwatch.plans import catalog

    draw = random.Random(4)
    rows = [(k, 1, dt.datetime(1995, 1 + k % 9, 3), float(draw.randint(1, 50)), draw.random() * 1000, draw.randint(0, 10) / 100, draw.randint(0, 8) / 100,
             "O", draw.choice("RNA")) for k in range(300)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_shipdate timestamp, l_quantity double, l_extendedprice double, l_discount double, "
                                "l_tax double, l_linestatus string, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    new = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for k, v in new.items():
        spark.conf.set(k, v)
    try:
        out = catalog.QUERIES["binned_quantile_bounds_lineitem"](spark, str(tmp_path))
        got = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in new:
            spark.conf.unset(k)
    assert "SortMergeJoin [column#" not in plan and plan.count("BroadcastHashJoin [column#") >= 2
    prices = sorted(r[4] for r in rows)
    want = {p: prices[int(p * 299)] for p in catalog._BOUND_PROBS}
    assert {r.prob: r.value for r in got if r.column == "l_extendedprice"} == pytest.approx({p: v for p, v in want.items()}, abs=1e-6)
    assert len(got) == 28 and all(r.holds and r.within_rank_error for r in got)
