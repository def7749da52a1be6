"""Exact quantiles with linear interpolation (numpy default, DuckDB
``quantile_cont``), computed without gathering a group into one task.

Values are first counted per distinct value (map-side partial aggregation),
then ranked with :func:`ordered_scan`; only the rows that hold the two ranks
around each requested position survive to the final tiny aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch.operators.scan import Scan, ordered_scan


def _clean(col: str, dtype) -> F.Column:
    c = F.col(col)
    ok = c.isNotNull()
    if dtype.typeName() in ("double", "float"):
        ok = ok & ~F.isnan(c)
    return ok


def value_counts(df: DataFrame, group_cols: Sequence[str], value_col: str) -> DataFrame:
    """``(group..., __v, __c)``: count per distinct non-null, non-NaN value,
    one pass over the rows with map-side partial aggregation."""
    dtype = df.schema[value_col].dataType
    return (df.where(_clean(value_col, dtype))
            .groupBy(*group_cols, F.col(value_col).cast("double").alias("__v"))
            .agg(F.count(F.lit(1)).alias("__c")))


def quantiles_from_counts(counts: DataFrame, group_cols: Sequence[str], probs: Sequence[float],
                          names: Sequence[str] | None = None) -> DataFrame:
    """Exact quantiles from a ``value_counts`` table (one row per group)."""
    group_cols = list(group_cols)
    names = list(names or [f"q{int(round(p * 1000)):03d}" for p in probs])
    ranked = ordered_scan(counts, group_cols, ["__v"], [Scan("__cum", "sum", "__c")],
                          totals={"__n": "__c"})
    lo_rank = F.col("__cum") - F.col("__c")  # first 0-based rank held by this value
    hi_rank = F.col("__cum") - 1

    def held(p):
        pos = p * (F.col("__n") - 1)
        lo, hi = F.floor(pos), F.ceil(pos)
        return pos, lo, (lo_rank <= lo) & (lo <= hi_rank), (lo_rank <= hi) & (hi <= hi_rank)

    def wanted(p):
        _, _, has_lo, has_hi = held(p)
        return has_lo | has_hi

    picks = [(i, *held(F.lit(float(p)))) for i, p in enumerate(probs)]
    # one test for all positions: written out for each, many positions make a method too long to be compiled
    small = ranked.where(F.exists(F.array(*[F.lit(float(p)) for p in probs]), wanted))
    aggs = []
    for i, pos, lo, has_lo, has_hi in picks:
        aggs += [F.max(F.when(has_lo, F.col("__v"))).alias(f"__lo{i}"),
                 F.max(F.when(has_hi, F.col("__v"))).alias(f"__hi{i}"),
                 F.max(pos - lo).alias(f"__fr{i}")]
    g = small.groupBy(*group_cols) if group_cols else small
    res = g.agg(*aggs)
    out = [F.col(f"__lo{i}") + F.col(f"__fr{i}") * (F.col(f"__hi{i}") - F.col(f"__lo{i}"))
           for i in range(len(probs))]
    return res.select(*group_cols, *[o.alias(n) for o, n in zip(out, names)])


def exact_quantiles(df: DataFrame, group_cols: Sequence[str], value_col: str,
                    probs: Sequence[float], names: Sequence[str] | None = None) -> DataFrame:
    """One row per group with one double column per probability.

    Nulls and NaN are ignored (``np.nanquantile``).  A group with no values
    gives nulls.
    """
    group_cols = list(group_cols)
    res = quantiles_from_counts(value_counts(df, group_cols, value_col), group_cols, probs, names)
    if group_cols:
        # groups whose values are all null still get a row (of nulls)
        keys = df.select(*group_cols).distinct()
        same = F.lit(True)
        for g in group_cols:
            same = same & keys[g].eqNullSafe(res[g])
        res = keys.join(res, same, "left").select(*[keys[g] for g in group_cols],
                                                  *[c for c in res.columns if c not in group_cols])
    return res


def exact_median(df: DataFrame, group_cols: Sequence[str], value_col: str,
                 name: str = "median") -> DataFrame:
    return exact_quantiles(df, group_cols, value_col, [0.5], [name])
