"""Profiling aggregates.

All are grouped aggregates with map-side partial aggregation; quantiles are
exact (linear interpolation) and distributed (see ``quantiles.py``).  Outputs
are small tables; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from panelwatch.functions.scalar import regime_label, safe_corr
from panelwatch.operators.quantiles import quantiles_from_counts, value_counts
from panelwatch.session import materialize
from panelwatch.spec import PanelSpec, RegimeSpec


def _t(spec: PanelSpec) -> Column:
    return F.col(spec.target).cast("double")


def unpivot_numeric(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (),
                    name: str = "column", value: str = "value") -> DataFrame:
    """Wide -> long ``(keep..., column, value double)``; nulls are kept."""
    return df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        list(keep), list(columns), name, value)


def unpivot_categorical(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (),
                        name: str = "column", value: str = "value") -> DataFrame:
    return df.select(*keep, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        list(keep), list(columns), name, value)


# ---------------------------------------------------------------- D1, D28
def period_counts(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows and target rate per period."""
    return df.groupBy(spec.period).agg(F.count(F.lit(1)).alias("n_rows"),
                                       F.avg(_t(spec)).alias("target_rate"))


def period_summary(df: DataFrame, spec: PanelSpec, variable: str,
                   regimes: RegimeSpec) -> DataFrame:
    """Per period rows, target rate, mean of ``variable``, its correlation
    with the target, and the calendar regime."""
    return (df.groupBy(spec.period)
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.avg(_t(spec)).alias("target_rate"),
                 F.avg(F.col(variable).cast("double")).alias("variable_mean"),
                 safe_corr(variable, _t(spec)).alias("variable_target_corr"))
            .withColumn("regime", regime_label(spec.period, regimes)))


# ---------------------------------------------------------------- D2, D31, D32
def dataset_overview(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Shape and class balance, imbalance ratio ``(1-r)/r``."""
    t = _t(spec)
    return (df.agg(F.count(F.lit(1)).alias("n_rows"),
                   F.count_distinct(spec.period).alias("n_periods"),
                   F.count_distinct(spec.id).alias("n_ids"),
                   F.sum(t).cast("bigint").alias("n_positive"),
                   F.avg(t).alias("target_rate"))
            .withColumn("n_columns", F.lit(len(df.columns)))
            .withColumn("n_negative", F.col("n_rows") - F.col("n_positive"))
            .withColumn("imbalance_ratio",
                        F.try_divide(F.lit(1.0) - F.col("target_rate"), F.col("target_rate"))))


def class_balance(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """D31 + D32: ``neg / max(pos, 1)`` and balanced weights ``n / (2 n_class)``."""
    t = F.col(spec.target)
    agg = df.agg(F.count_if(t == 1).alias("n_positive"), F.count_if(t == 0).alias("n_negative"))
    n = F.col("n_positive") + F.col("n_negative")
    return agg.select(
        "n_positive", "n_negative",
        (F.col("n_negative") / F.greatest(F.col("n_positive"), F.lit(1))).alias("neg_pos_ratio"),
        F.try_divide(n, F.lit(2.0) * F.col("n_positive")).alias("weight_positive"),
        F.try_divide(n, F.lit(2.0) * F.col("n_negative")).alias("weight_negative"))


# ---------------------------------------------------------------- D3-D6
def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """D3: null count per column, one pass, then unpivot the 1-row result."""
    columns = list(columns or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([], columns, "column", "n_null")


def row_digest(columns: Sequence[str]) -> list[Column]:
    """128 bits of a row's content as two longs (a null differs from every value and keeps its place)."""
    cells = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(F.lit(seed), *cells) for seed in (1, 2)]


def duplicate_rows(df: DataFrame, digest=row_digest) -> DataFrame:
    """One row ``n``, the fully duplicated rows beyond the first (nulls equal).

    Only digests are shuffled, pre-counted by task; whole rows move and are compared only where a digest occurs twice, so
    a clash of digests changes no count."""
    keyed = df.select(*df.columns, *[d.alias(f"__digest{i}") for i, d in enumerate(digest(df.columns))])
    keys = [c for c in keyed.columns if c.startswith("__digest")]
    twice = materialize(keyed.groupBy(*keys).count().where("count > 1").select(*keys))
    rows = keyed.join(twice, keys, "left_semi").groupBy(*df.columns).count()
    return rows.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint").alias("n"))


def duplicate_summary(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """D4-D6 as ``(check, n)`` rows: fully duplicated rows beyond the first
    (nulls equal), duplicated ``(id, period)`` keys beyond the first, and ids
    present in more than one row.  Partial aggregation collapses hot
    duplicates map-side, so a key holding many rows does not skew a task."""
    extra = F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint")
    by_key = materialize(df.groupBy(spec.id, spec.period).count())  # ids follow from the keys
    keys = by_key.agg(extra.alias("n"))
    ids = by_key.groupBy(spec.id).agg(F.sum("count").alias("count")).agg(
        F.count_if(F.col("count") > 1).alias("n"))
    return (duplicate_rows(df).select(F.lit("duplicate_rows").alias("check"), "n")
            .unionByName(keys.select(F.lit("duplicate_keys").alias("check"), "n"))
            .unionByName(ids.select(F.lit("repeated_ids").alias("check"), "n")))


# ---------------------------------------------------------------- D7, D8, D9
def _count_moments(counts: DataFrame, group_cols: list[str]) -> DataFrame:
    """count, mean, sample sd, min, max per group from a value-count table
    (two steps on the small table: mean first, then squared deviations)."""
    m = counts.groupBy(*group_cols).agg(
        F.sum("__c").alias("count"),
        (F.sum(F.col("__c") * F.col("__v")) / F.sum("__c")).alias("mean"),
        F.min("__v").alias("min"), F.max("__v").alias("max"))
    dev = counts.join(m.select(*group_cols, F.col("mean").alias("__mean")), group_cols)
    ss = dev.groupBy(*group_cols).agg(
        F.sum(F.col("__c") * (F.col("__v") - F.col("__mean")) ** 2).alias("__ss"))
    return m.join(ss, group_cols).withColumn(
        "std", F.sqrt(F.try_divide(F.col("__ss"), (F.col("count") - 1).cast("double")))
    ).drop("__ss")


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, std (n-1), min, p25, p50, p75, max per numeric column.

    Moments come from Spark's own aggregates over the rows (``avg``,
    ``stddev_samp``), so means agree with other engines to the last digit (sums over
    value counts differ in it, which shows where a mean lies on a rounding edge);
    exact quantiles come from per-column value counts."""
    long = unpivot_numeric(df, columns)
    moments = long.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"))
    counts = value_counts(long, ["column"], "value")
    q = quantiles_from_counts(counts, ["column"], [0.25, 0.5, 0.75], ["p25", "p50", "p75"])
    return moments.join(q, "column").select("column", "count", "mean", "std", "min",
                                            "p25", "p50", "p75", "max")


def category_domain(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The domain of each categorical column as rows ``(column, value,
    cardinality)``; a domain is never gathered into one row."""
    long = materialize(unpivot_categorical(df, columns).where(F.col("value").isNotNull()).distinct())
    size = long.groupBy("column").agg(F.count(F.lit(1)).alias("cardinality"))  # one row per column
    return long.join(F.broadcast(size), "column").select("column", "value", "cardinality")


def category_frequency(df: DataFrame, column: str) -> DataFrame:
    """Relative frequency per value, ascending.  The per-value table is
    computed once (one pass over the rows); the total is summed from it, not
    from a second pass over the rows."""
    counts = materialize(df.groupBy(F.col(column).alias("value"))
                         .agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.withColumn("share", F.col("n") / F.lit(float(max(total, 1)))).orderBy(
        "share", "value")


# ---------------------------------------------------------------- D10, D11
def outlier_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """p50, p99, max, max/p99 (denominator floor 1e-9) and the share of
    rows strictly above ``Q3 + 1.5 IQR`` (upper side only).  One pass over
    the rows; everything else runs on the per-column value counts."""
    counts = materialize(value_counts(unpivot_numeric(df, columns), ["column"], "value"))
    q = quantiles_from_counts(counts, ["column"], [0.25, 0.5, 0.75, 0.99],
                              ["q1", "p50", "q3", "p99"])
    fence = q.select("column", "p50", "p99",
                     (F.col("q3") + F.lit(1.5) * (F.col("q3") - F.col("q1"))).alias("upper_fence"))
    # limits table has one row per column: a proven-small broadcast
    joined = counts.join(F.broadcast(fence), "column")
    above = F.when(F.col("__v") > F.col("upper_fence"), F.col("__c")).otherwise(F.lit(0))
    return joined.groupBy("column").agg(
        F.first("p50").alias("p50"), F.first("p99").alias("p99"), F.max("__v").alias("max"),
        (F.max("__v") / F.greatest(F.first("p99"), F.lit(1e-9))).alias("max_over_p99"),
        (F.sum(above) / F.sum("__c") * 100).alias("pct_above_fence"))


def box_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Q1, median, Q3, whiskers at the furthest data inside 1.5 IQR, and
    the count of points outside on both sides (one pass over the rows)."""
    counts = materialize(value_counts(unpivot_numeric(df, columns), ["column"], "value"))
    q = quantiles_from_counts(counts, ["column"], [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    lim = q.select("column", "q1", "median", "q3",
                   (F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("lo_f"),
                   (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("hi_f"))
    v = F.col("__v")
    inside = (v >= F.col("lo_f")) & (v <= F.col("hi_f"))
    return counts.join(F.broadcast(lim), "column").groupBy("column").agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(inside, v)).alias("lower_whisker"),
        F.max(F.when(inside, v)).alias("upper_whisker"),
        F.sum(F.when(~inside, F.col("__c")).otherwise(F.lit(0))).alias("n_outliers"))


# ---------------------------------------------------------------- D12, D13
def equal_width_histogram(df: DataFrame, column: str, bins: int = 40) -> DataFrame:
    """``bins`` equal-width bins over [min, max], last bin closed; a
    constant column is widened to +/-0.5 (numpy rule).  Empty bins included.

    The range is a learned parameter (one tiny aggregate); binning and
    counting then run as one grouped aggregate."""
    v = F.col(column).cast("double")
    r = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi")).first()
    lo, hi = r["lo"], r["hi"]
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin int, bin_lo double, bin_hi double, n bigint")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    b = F.least(F.floor((v - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = df.where(v.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (grid.join(counts, "bin", "left")
            .select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
                    (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_hi"),
                    F.coalesce("n", F.lit(0)).alias("n")))


def density_histogram(df: DataFrame, column: str, group: str, lo: float, hi: float,
                      bins: int) -> DataFrame:
    """Fixed-edge density histogram per group; values outside [lo, hi]
    are dropped and each group's area is 1."""
    v = F.col(column).cast("double")
    width = (hi - lo) / bins
    inside = df.where((v >= lo) & (v <= hi))
    b = F.least(F.floor((v - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = inside.groupBy(group, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    n_in = F.sum("n").over(W.partitionBy(group))  # per-group table of <= bins rows
    return counts.select(group, "bin",
                         (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
                         (F.col("n") / (n_in * F.lit(width))).alias("density"))


# ---------------------------------------------------------------- D14-D17
def category_target_rate(df: DataFrame, spec: PanelSpec, column: str) -> DataFrame:
    """Target rate per value and whether it is above the global rate.
    The global rate is summed from the per-value table (one pass over rows)."""
    per = materialize(df.groupBy(F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(_t(spec)).alias("__pos")))
    tot = per.agg(F.sum("__pos").alias("p"), F.sum("n").alias("n")).first()
    glob = (tot["p"] / tot["n"]) if tot["n"] else None
    g = F.lit(glob).cast("double")
    return (per.select("value", "n", (F.col("__pos") / F.col("n")).alias("target_rate"))
            .withColumn("global_rate", g)
            .withColumn("above_global", F.col("target_rate") > g)
            .orderBy("target_rate", "value"))


def period_moments(df: DataFrame, spec: PanelSpec, column: str) -> DataFrame:
    """Per period mean, exact median, std (n-1) and the mean +/- std
    band, all from one pass (per-period value counts)."""
    counts = materialize(value_counts(df, [spec.period], column))
    m = _count_moments(counts, [spec.period])
    med = quantiles_from_counts(counts, [spec.period], [0.5], ["median"])
    return m.join(med, spec.period).select(
        spec.period, "mean", "median", "std",
        (F.col("mean") - F.col("std")).alias("band_lo"),
        (F.col("mean") + F.col("std")).alias("band_hi"))


def _safe(v: str) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in str(v))


def period_category_share(df: DataFrame, spec: PanelSpec, column: str,
                          values: Sequence[str]) -> DataFrame:
    """Per period share of each value (fixed column order, missing = 0,
    row-normalised).  Values are passed, so the pivot runs no extra job."""
    piv = df.groupBy(spec.period).pivot(column, list(values)).count().na.fill(0)
    total = sum((F.col(f"`{v}`") for v in values), F.lit(0))
    return piv.select(spec.period, *[F.try_divide(F.col(f"`{v}`").cast("double"), total.cast("double"))
                                     .alias(f"share_{_safe(v)}") for v in values])


def period_category_rate(df: DataFrame, spec: PanelSpec, column: str,
                         values: Sequence[str]) -> DataFrame:
    """Per period target rate of each value (missing = null)."""
    piv = df.groupBy(spec.period).pivot(column, list(values)).agg(F.avg(_t(spec)))
    return piv.select(spec.period, *[F.col(f"`{v}`").alias(f"rate_{_safe(v)}") for v in values])


# ---------------------------------------------------------------- D29, D30, D33, D34, D37
def regime_means(df: DataFrame, spec: PanelSpec, column: str, regimes: RegimeSpec) -> DataFrame:
    """Mean of a variable per regime, ordered by first period seen."""
    return (df.withColumn("regime", regime_label(spec.period, regimes))
            .groupBy("regime").agg(F.avg(F.col(column).cast("double")).alias("mean"),
                                   F.min(spec.period).alias("first_period"))
            .orderBy("first_period"))


def rate_dispersion(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Min, max and std (n-1) of the per-period target rates."""
    return period_counts(df, spec).agg(
        F.min("target_rate").alias("min_rate"), F.max("target_rate").alias("max_rate"),
        F.stddev_samp("target_rate").alias("std_rate"), F.count(F.lit(1)).alias("n_periods"))


def distinct_periods(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Sorted distinct periods with their calendar ordinal."""
    p = df.select(spec.period).distinct()
    return p.orderBy(spec.period)


def category_share_by_regime(df: DataFrame, spec: PanelSpec, column: str, value: str,
                             regimes: RegimeSpec) -> DataFrame:
    """Share of rows with ``column == value`` per regime."""
    return (df.withColumn("regime", regime_label(spec.period, regimes))
            .groupBy("regime").agg(
                F.avg((F.col(column) == F.lit(value)).cast("double")).alias("share"),
                F.count(F.lit(1)).alias("n_rows")))


def split_summary(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows and target rate of the train and validation periods."""
    split = (F.when(F.col(spec.period).isin(list(spec.train_periods)), F.lit("train"))
             .when(F.col(spec.period).isin(list(spec.validation_periods)), F.lit("validation")))
    keep = list(spec.train_periods) + list(spec.validation_periods)
    return (df.where(F.col(spec.period).isin(keep))
            .groupBy(split.alias("split"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.avg(_t(spec)).alias("target_rate")))


def schema_listing(df: DataFrame) -> DataFrame:
    """Column names and types (metadata only, no job)."""
    return df.sparkSession.createDataFrame(df.dtypes, "column string, type string")


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Multiset comparison of two tables with the same columns, as
    ``(side, n)``: rows only in ``a`` and rows only in ``b`` (duplicates
    counted, nulls equal).  Both zero means the tables are equal."""
    cols = a.columns
    # one signed count per distinct row: what is left over on either side
    both = (a.select(*cols, F.lit(1).alias("__s")).unionByName(b.select(*cols, F.lit(-1).alias("__s")))
            .groupBy(*cols).agg(F.sum("__s").alias("__s")))
    over = both.agg(F.sum(F.greatest("__s", F.lit(0))).alias("l"), F.sum(F.greatest(-F.col("__s"), F.lit(0))).alias("r"))
    return over.select(F.inline(F.array(*[
        F.struct(F.lit(side).alias("side"), F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias("n"))
        for side, c in (("only_left", "l"), ("only_right", "r"))])))
