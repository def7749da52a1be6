"""Distributed scan and exact quantiles against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from panelwatch.operators.quantiles import exact_quantiles
from panelwatch.operators.scan import Scan, ordered_scan


def test_scan_matches_window(spark, ranges):
    rng = np.random.default_rng(3)
    rows = [(int(g), float(v), float(w)) for g, v, w in
            zip(rng.integers(0, 3, 400), rng.permutation(400), rng.normal(size=400))]
    df = spark.createDataFrame(rows, "g int, v double, w double")
    out = ordered_scan(df, ["g"], ["v"], [Scan("cs", "sum", "w"),
                                          Scan("cx", "sum", "w", inclusive=False),
                                          Scan("mn", "min", "w"),
                                          Scan("mx", "max", "w", inclusive=False)],
                       totals={"tot": "w"})
    w = W.partitionBy("g").orderBy("v")
    ref = df.select("g", "v",
                    F.sum("w").over(w.rowsBetween(W.unboundedPreceding, 0)).alias("cs"),
                    F.coalesce(F.sum("w").over(w.rowsBetween(W.unboundedPreceding, -1)),
                               F.lit(0.0)).alias("cx"),
                    F.min("w").over(w.rowsBetween(W.unboundedPreceding, 0)).alias("mn"),
                    F.max("w").over(w.rowsBetween(W.unboundedPreceding, -1)).alias("mx"),
                    F.sum("w").over(W.partitionBy("g")).alias("tot"))
    a = {(r.g, r.v): r for r in out.collect()}
    b = {(r.g, r.v): r for r in ref.collect()}
    assert a.keys() == b.keys()
    for k in a:
        for c in ("cs", "cx", "mn", "tot"):
            assert a[k][c] == pytest.approx(b[k][c], abs=1e-9)
        assert (a[k].mx is None) == (b[k].mx is None)
        if a[k].mx is not None:
            assert a[k].mx == pytest.approx(b[k].mx)


def test_scan_null_group_key(spark, ranges):
    df = spark.createDataFrame([(g, float(i), 1) for g in (None, 1) for i in range(40)], "g int, v double, c int")
    out = ordered_scan(df, ["g"], ["v"], [Scan("n", "sum", "c")], totals={"tot": "c"}).collect()
    assert len(out) == 80 and all(r.n == r.v + 1 and r.tot == 40 for r in out)


def test_scan_without_groups_or_rows(spark, ranges):
    df = spark.createDataFrame([(float(i), 1) for i in range(30)], "v double, c int")
    out = ordered_scan(df, [], ["v"], [Scan("n", "sum", "c")], totals={"tot": "c"})
    assert all(r.n == r.v + 1 and r.tot == 30 for r in out.collect())
    assert ordered_scan(df.limit(0), [], ["v"], [Scan("n", "sum", "c")]).count() == 0


def test_scan_descending(spark):
    df = spark.createDataFrame([(1, float(i), 1) for i in range(50)], "g int, v double, c int")
    out = ordered_scan(df, ["g"], ["v"], [Scan("ge", "sum", "c")], ascending=False, ranges=6)
    got = {r.v: r.ge for r in out.collect()}
    assert all(got[float(i)] == 50 - i for i in range(50))


def test_exact_quantiles(spark, ranges):
    rng = np.random.default_rng(7)
    vals = {0: rng.normal(size=301), 1: rng.integers(0, 5, 200).astype(float),
            2: np.array([1.0, 2.0, 10.0, 20.0])}
    rows = [(g, float(v)) for g, arr in vals.items() for v in arr] + [(3, None)]
    df = spark.createDataFrame(rows, "g int, v double")
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    out = {r.g: r for r in exact_quantiles(df, ["g"], "v", probs).collect()}
    for g, arr in vals.items():
        for p, name in zip(probs, ["q010", "q250", "q500", "q750", "q990"]):
            assert out[g][name] == pytest.approx(float(np.quantile(arr, p)), abs=1e-12)
    assert out[2]["q500"] == 6.0
    assert out[3]["q500"] is None


def test_many_positions_are_one_test(spark):
    from panelwatch.operators.quantiles import quantiles_from_counts, value_counts

    vals = np.random.default_rng(9).integers(0, 40, 500).astype(float)
    df = spark.createDataFrame([("a", float(v)) for v in vals], "g string, v double")
    probs = [k / 64 for k in range(65)]
    out = quantiles_from_counts(value_counts(df, ["g"], "v"), ["g"], probs, [f"q{i}" for i in range(65)])
    filters = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in x and "FLOOR" in x]
    assert len(filters) == 1 and filters[0].count("FLOOR") <= 2  # not one or two for each position
    got = out.first()
    assert [got[f"q{i}"] for i in range(65)] == pytest.approx([float(np.quantile(vals, p)) for p in probs], abs=1e-12)
