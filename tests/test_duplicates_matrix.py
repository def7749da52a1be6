"""Duplicate rows by digest, and the correlation matrix by tiles."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwatch.operators import association as A
from panelwatch.operators import profile as P


def table(spark):
    nan = float("nan")
    rows = [(1, "a", 0.0), (1, "a", -0.0), (None, "a", 1.0), (None, "a", 1.0), (1, None, 1.0), (1, None, 1.0), (1, None, 1.0), (2, "b", nan), (2, "b", nan),
            (None, "1", 5.0), (1, None, 5.0)]
    return spark.createDataFrame(rows, "i int, s string, x double")


def test_duplicate_rows_with_nulls_and_odd_numbers(spark):
    # 0.0 = -0.0, NaN = NaN and null = null: 1 + 1 + 2 + 1 rows beyond the first
    assert P.duplicate_rows(table(spark)).first().n == 5
    assert P.duplicate_rows(table(spark).where("false")).first().n == 0


def test_clashing_digests_change_no_count(spark):
    clash = lambda columns: [F.lit(1).cast("long"), F.lit(2).cast("long")]
    assert P.duplicate_rows(table(spark), clash).first().n == 5


def test_only_digests_are_shuffled(spark, monkeypatch):
    seen = []
    keep = P.materialize
    monkeypatch.setattr(P, "materialize", lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString()) or keep(df))
    wide = spark.range(50).select("id", *[(F.col("id") * k).alias(f"c{k}") for k in range(30)])
    assert P.duplicate_rows(wide).first().n == 0
    exchange = [x for x in seen[0].splitlines() if "hashpartitioning" in x]
    assert exchange and all("__digest0" in x and "c17" not in x for x in exchange)


def test_matrix_equals_numpy_on_known_pairs(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (400, 7)) * [1, 5, .01, 100, 1, 1, 1] + [0, 1e6, 0, -50, 3, 0, 0]
    x[:, 4] = 3.1
    x[:, 5] += x[:, 0]
    hole = rng.random(x.shape) < .2
    hole[:, 0] = False
    rows = [tuple(None if h else float(v) for v, h in zip(r, hs)) for r, hs in zip(x, hole)]
    rows.append((float("nan"), *[1.0] * 6))
    cols = [f"c{k}" for k in range(7)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(5)
    for tile in (2, 3, 128):
        got = {(r.col_a, r.col_b): r.r for r in A.correlation_matrix(df, cols, tile).collect()}
        assert sorted(got) == [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
        full = np.array([[np.nan if v is None else v for v in r] for r in rows])
        for (a, b), r in got.items():
            i, j = int(a[1]), int(b[1])
            both = ~np.isnan(full[:, i]) & ~np.isnan(full[:, j])
            if 4 in (i, j):
                # the last row is 1.0 where the others are 3.1; without it the column is constant
                both[-1] = False
                assert r is None or np.isfinite(r)
            else:
                assert r == pytest.approx(np.corrcoef(full[both, i], full[both, j])[0, 1], abs=1e-10)
    steady = df.where("c4 = 3.1")
    assert all(r.r is None for r in A.correlation_matrix(steady, ["c0", "c4", "c5"]).collect() if "c4" in (r.col_a, r.col_b))


def test_matrix_of_many_columns(spark):
    rng = random.Random(2)
    x = [[rng.gauss(0, 1) for _ in range(500)] for _ in range(60)]
    df = spark.createDataFrame([(r,) for r in x], "v array<double>").select(*[F.col("v")[k].alias(f"c{k}") for k in range(500)])
    got = A.correlation_matrix(df, df.columns)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "corr(" not in plan
    rows = got.collect()
    want = np.corrcoef(np.array(x).T)
    assert len(rows) == 500 * 499 // 2
    assert max(abs(r.r - want[int(r.col_a[1:]), int(r.col_b[1:])]) for r in rows) < 1e-10


def test_matrix_edge_cases(spark):
    df = spark.createDataFrame([(1.0, None), (None, 2.0)], "a double, b double")
    assert [tuple(r) for r in A.correlation_matrix(df, ["a", "b"]).collect()] == [("a", "b", None)]
    assert A.correlation_matrix(df, ["a"]).count() == 0
    assert A.correlation_matrix(df.where("false"), ["a", "b"]).count() <= 1
