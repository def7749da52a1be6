"""Distributed ordered scans (running sum / min / max inside a group).

Exact rank metrics, exact quantiles and the Wasserstein distance all need a
running aggregate in value order inside a group (a month, a column).  A plain
``Window.partitionBy(group).orderBy(value)`` sends a whole group to one task,
and one month may hold a third of all rows.  Here, at every size, the rows are
range-partitioned on (group, value): a group of any size is cut into runs that
lie in consecutive partitions.  Each run is scanned by an ordinary
window, and the totals of a group's earlier runs are carried in from a table with one
row per (group, run).  The result is exact; the range bounds only decide where to cut.

A task holds about one partition's share of all rows, however the groups are
sized; a group has at most as many runs as there are partitions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from panelwatch.session import materialize

_RUN = "__scanrun"


@dataclass(frozen=True)
class Scan:
    """One running aggregate: ``out = func(col)`` over rows up to this one."""

    out: str
    func: str  # "sum" | "min" | "max"
    col: str | Column
    inclusive: bool = True


_AGG = {"sum": F.sum, "min": F.min, "max": F.max}


def _combine(func: str, local: Column, carry: Column) -> Column:
    if func == "sum":
        return F.coalesce(local, F.lit(0)) + F.coalesce(carry, F.lit(0))
    # least/greatest skip nulls, which is what an empty prefix means
    return F.least(local, carry) if func == "min" else F.greatest(local, carry)


def ordered_scan(df: DataFrame, group_cols: list[str], order_cols: list[str],
                 scans: list[Scan], *, ascending: bool = True,
                 totals: dict[str, str] | None = None, ranges: int | None = None) -> DataFrame:
    """Add running aggregates in ``order_cols`` order inside ``group_cols``.

    ``(group_cols, order_cols)`` must be unique per row (aggregate first).
    ``totals`` maps an output name to a column whose per-group sum is attached as
    well.  Null group keys form a group like any other.  ``ranges`` is the
    number of range partitions (default: the session's shuffle partitions, neighbouring ones merged by their measured
    sizes, so a small table is one or a few runs).

    The partitioned rows are read twice (local scan, run totals), so they are
    materialized once."""
    cols = {}
    for s in scans:
        cols[f"__scansv_{s.out}"] = F.col(s.col) if isinstance(s.col, str) else s.col
    for name, c in (totals or {}).items():
        cols[f"__scanst_{name}"] = F.col(c) if isinstance(c, str) else c
    order = [F.col(c).asc() if ascending else F.col(c).desc() for c in order_cols]
    by = [*[F.col(g) for g in group_cols], *order]
    placed = df.withColumns(cols).repartitionByRange(*([ranges] if ranges else []), *by)
    placed = materialize(placed.withColumn(_RUN, F.spark_partition_id()))

    part = W.partitionBy(*group_cols, _RUN).orderBy(*order)
    local = placed
    for s in scans:
        frame = part.rowsBetween(W.unboundedPreceding, 0 if s.inclusive else -1)
        local = local.withColumn(f"__scansl_{s.out}", _AGG[s.func](f"__scansv_{s.out}").over(frame))

    # totals of each run, then of all earlier runs of the same group
    aggs = [_AGG[s.func](f"__scansv_{s.out}").alias(f"__scansp_{s.out}") for s in scans]
    aggs += [F.sum(f"__scanst_{t}").alias(f"__scanspt_{t}") for t in (totals or {})]
    partial = placed.groupBy(*group_cols, _RUN).agg(*aggs)
    group = W.partitionBy(*group_cols) if group_cols else W.partitionBy()  # at most ``n`` rows
    before = group.orderBy(_RUN).rowsBetween(W.unboundedPreceding, -1)
    carry = partial.select(
        *[F.col(g).alias(f"__scang_{g}") for g in group_cols], F.col(_RUN).alias("__scangrun"),
        *[_AGG[s.func](f"__scansp_{s.out}").over(before).alias(f"__scansc_{s.out}") for s in scans],
        *[F.sum(f"__scanspt_{t}").over(group).alias(t) for t in (totals or {})])
    same = F.col(_RUN) == F.col("__scangrun")
    for g in group_cols:
        same = same & F.col(g).eqNullSafe(F.col(f"__scang_{g}"))
    out = local.join(carry, same, "left")
    for s in scans:
        out = out.withColumn(s.out, _combine(s.func, F.col(f"__scansl_{s.out}"),
                                             F.col(f"__scansc_{s.out}")))
    return out.drop(*[c for c in out.columns if c.startswith("__scan")])
