"""Registered queries over the driver tables, each with a DuckDB oracle.

Every query reads whole tables through a panel builder in
``sources/tables.py`` and runs one library operator.  Double outputs are
rounded to 6 decimals on both sides (presentation only) so that the
order-insensitive value hash of the two engines can be compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwatch.functions.scalar import regime_label
from panelwatch.operators import profile as P
from panelwatch.sources.tables import (
    EVENTS_REGIMES, EVENTS_SPEC, LINEITEM_REGIMES, LINEITEM_SPEC, ORDERS_REGIMES,
    ORDERS_SPEC, events_panel, lineitem_panel, orders_panel, read_table,
)

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def finish(df: DataFrame) -> DataFrame:
    """Round double columns to 6 decimals and fold -0.0 into 0.0."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append((F.round(F.col(f"`{f.name}`"), 6) + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def register(name: str, sql: str | None = None, doubles: tuple[str, ...] = ()):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = lambda spark, sf_dir: finish(fn(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = oracle(sql, doubles)
        return fn
    return deco


def oracle(inner: str, doubles: tuple[str, ...]) -> str:
    if not doubles:
        return inner
    rep = ", ".join(f'round("{c}", 6) + 0.0 AS "{c}"' for c in doubles)
    return f"SELECT * REPLACE ({rep}) FROM ({inner}) AS q"


# ------------------------------------------------------------------ SQL panels
LI = ("li AS (SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m') AS ship_month, "
      "l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus, l_returnflag, "
      "CAST(l_returnflag = 'R' AS INTEGER) AS returned FROM lineitem)")
OP = ("op AS (SELECT p.o_custkey, p.order_month, p.order_count, p.total_spent, c.c_acctbal, "
      "p.top_priority, c.c_mktsegment, p.fulfilled FROM (SELECT o_custkey, "
      "strftime(o_orderdate, '%Y-%m') AS order_month, CAST(count(*) AS INTEGER) AS order_count, "
      "sum(o_totalprice) AS total_spent, min(o_orderpriority) AS top_priority, "
      "max(CAST(o_orderstatus = 'F' AS INTEGER)) AS fulfilled FROM orders GROUP BY ALL) p "
      "LEFT JOIN customer c ON p.o_custkey = c.c_custkey)")
EV = ("ev AS (SELECT event_id, user_id, strftime(ts, '%Y-%m-%d') AS event_day, value, "
      "CAST(json_extract_string(props, '$.k') AS DOUBLE) AS prop_k, event_type, "
      "CAST(event_type = 'error' AS INTEGER) AS is_error FROM events)")
_LI_COLS = ("l_orderkey", "l_linenumber", "ship_month", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_linestatus", "l_returnflag", "returned")
LI_NUM = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
LI_LONG = ('li_long AS (UNPIVOT (SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM li) '
           'ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME "column" VALUE value)')


def regime_sql(col: str, regimes) -> str:
    if regimes.unit == "day":
        idx = f"date_diff('day', DATE '{regimes.start}', CAST({col} AS DATE))"
    else:
        y, m = regimes.start.split("-")
        idx = (f"(CAST(substr({col}, 1, 4) AS INTEGER) * 12 + CAST(substr({col}, 6, 2) AS INTEGER)"
               f" - {int(y) * 12 + int(m)})")
    whens = " ".join(f"WHEN {idx} >= {s} THEN '{lab}'"
                     for s, lab in sorted(zip(regimes.starts, regimes.labels), reverse=True))
    return f"(CASE {whens} END)"


LI_REG = regime_sql("ship_month", LINEITEM_REGIMES)


# ------------------------------------------------------------------ D28 / D1
@register("month_summary_lineitem",
          f"WITH {LI} SELECT ship_month, count(*) AS n_rows, avg(returned::DOUBLE) AS target_rate, "
          f"avg(l_discount) AS variable_mean, CASE WHEN isnan(corr(l_discount, returned::DOUBLE)) THEN NULL ELSE corr(l_discount, returned::DOUBLE) END AS "
          f"variable_target_corr, {LI_REG} AS regime FROM li GROUP BY ship_month",
          ("target_rate", "variable_mean", "variable_target_corr"))
def month_summary_lineitem(spark, sf):
    return P.period_summary(lineitem_panel(spark, sf), LINEITEM_SPEC, "l_discount",
                            LINEITEM_REGIMES)


@register("month_summary_orders",
          f"WITH {OP} SELECT order_month, count(*) AS n_rows, avg(fulfilled::DOUBLE) AS target_rate,"
          f" avg(total_spent) AS variable_mean, CASE WHEN isnan(corr(total_spent, fulfilled::DOUBLE)) THEN NULL ELSE corr(total_spent, fulfilled::DOUBLE) END AS "
          f"variable_target_corr, {regime_sql('order_month', ORDERS_REGIMES)} AS regime "
          f"FROM op GROUP BY order_month",
          ("target_rate", "variable_mean", "variable_target_corr"))
def month_summary_orders(spark, sf):
    return P.period_summary(orders_panel(spark, sf, with_customer=False), ORDERS_SPEC, "total_spent", ORDERS_REGIMES)


@register("day_summary_events",
          f"WITH {EV} SELECT event_day, count(*) AS n_rows, avg(is_error::DOUBLE) AS target_rate, "
          f"avg(prop_k) AS variable_mean, CASE WHEN isnan(corr(prop_k, is_error::DOUBLE)) THEN NULL ELSE corr(prop_k, is_error::DOUBLE) END AS variable_target_corr, "
          f"{regime_sql('event_day', EVENTS_REGIMES)} AS regime FROM ev GROUP BY event_day",
          ("target_rate", "variable_mean", "variable_target_corr"))
def day_summary_events(spark, sf):
    return P.period_summary(events_panel(spark, sf), EVENTS_SPEC, "prop_k", EVENTS_REGIMES)


# ------------------------------------------------------------------ D2, D31, D32
@register("dataset_overview_lineitem",
          f"WITH {LI} SELECT count(*) AS n_rows, count(DISTINCT ship_month) AS n_periods, "
          f"count(DISTINCT l_orderkey) AS n_ids, CAST(sum(returned) AS BIGINT) AS n_positive, "
          f"avg(returned::DOUBLE) AS target_rate, 10 AS n_columns, "
          f"count(*) - CAST(sum(returned) AS BIGINT) AS n_negative, "
          f"(1.0 - avg(returned::DOUBLE)) / avg(returned::DOUBLE) AS imbalance_ratio FROM li",
          ("target_rate", "imbalance_ratio"))
def dataset_overview_lineitem(spark, sf):
    return P.dataset_overview(lineitem_panel(spark, sf), LINEITEM_SPEC)


@register("class_balance_orders",
          f"WITH {OP} SELECT CAST(count_if(fulfilled = 1) AS BIGINT) AS n_positive, "
          f"CAST(count_if(fulfilled = 0) AS BIGINT) AS n_negative, count_if(fulfilled = 0) / greatest(count_if(fulfilled = 1), 1) AS "
          f"neg_pos_ratio, count(*) / (2.0 * count_if(fulfilled = 1)) AS weight_positive, "
          f"count(*) / (2.0 * count_if(fulfilled = 0)) AS weight_negative FROM op",
          ("neg_pos_ratio", "weight_positive", "weight_negative"))
def class_balance_orders(spark, sf):
    return P.class_balance(orders_panel(spark, sf, with_customer=False), ORDERS_SPEC)


# ------------------------------------------------------------------ D3-D6


@register("null_counts_lineitem",
          f"WITH {LI} " + " UNION ALL ".join(
              f"SELECT '{c}' AS \"column\", CAST(count_if({c} IS NULL) AS BIGINT) AS n_null FROM li"
              for c in _LI_COLS))
def null_counts_lineitem(spark, sf):
    return P.null_counts(lineitem_panel(spark, sf))


@register("duplicate_summary_lineitem",
          f"WITH {LI}, full_dup AS (SELECT count(*) AS c FROM li GROUP BY " + ", ".join(_LI_COLS) + f"), "
          f"key_dup AS (SELECT count(*) AS c FROM li GROUP BY l_orderkey, ship_month), "
          f"id_dup AS (SELECT count(*) AS c FROM li GROUP BY l_orderkey) "
          f"SELECT 'duplicate_rows' AS \"check\", CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS n "
          f"FROM full_dup UNION ALL SELECT 'duplicate_keys', CAST(coalesce(sum(c - 1), 0) AS BIGINT)"
          f" FROM key_dup UNION ALL SELECT 'repeated_ids', CAST(count_if(c > 1) AS BIGINT) FROM id_dup")
def duplicate_summary_lineitem(spark, sf):
    return P.duplicate_summary(lineitem_panel(spark, sf), LINEITEM_SPEC)


# ------------------------------------------------------------------ D7, D8, D9
@register("numeric_summary_lineitem",
          f"WITH {LI}, {LI_LONG} SELECT \"column\", count(value) AS count, avg(value) AS mean, "
          f"stddev_samp(value) AS std, min(value) AS min, quantile_cont(value, 0.25) AS p25, "
          f"quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75, "
          f"max(value) AS max FROM li_long GROUP BY \"column\"",
          ("mean", "std", "min", "p25", "p50", "p75", "max"))
def numeric_summary_lineitem(spark, sf):
    return P.numeric_summary(lineitem_panel(spark, sf), LINEITEM_SPEC.numeric)


@register("numeric_summary_orders",
          f"WITH {OP}, op_long AS (UNPIVOT (SELECT CAST(order_count AS DOUBLE) AS order_count, "
          f"total_spent, c_acctbal FROM op) ON order_count, total_spent, c_acctbal "
          f"INTO NAME \"column\" VALUE value) SELECT \"column\", count(value) AS count, "
          f"avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, "
          f"quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50, "
          f"quantile_cont(value, 0.75) AS p75, max(value) AS max FROM op_long GROUP BY \"column\"",
          ("mean", "std", "min", "p25", "p50", "p75", "max"))
def numeric_summary_orders(spark, sf):
    return P.numeric_summary(orders_panel(spark, sf), ORDERS_SPEC.numeric)


@register("category_domain_orders",
          f"WITH {OP}, v AS (SELECT DISTINCT 'top_priority' AS \"column\", top_priority AS value "
          f"FROM op UNION SELECT DISTINCT 'c_mktsegment', c_mktsegment FROM op) "
          f"SELECT \"column\", value, count(*) OVER (PARTITION BY \"column\") AS cardinality "
          f"FROM v WHERE value IS NOT NULL")
def category_domain_orders(spark, sf):
    return P.category_domain(orders_panel(spark, sf), ORDERS_SPEC.categorical)


@register("category_domain_customers",
          "SELECT 'c_name' AS \"column\", c_name AS value, (SELECT count(DISTINCT c_name) FROM customer)"
          " AS cardinality FROM customer WHERE c_name IS NOT NULL GROUP BY c_name")
def category_domain_customers(spark, sf):
    """D8 on a column with as many values as rows."""
    return P.category_domain(read_table(spark, sf, "customer"), ["c_name"])


@register("category_frequency_lineitem",
          f"WITH {LI} SELECT l_returnflag AS value, count(*) AS n, count(*) / "
          f"(SELECT count(*) FROM li)::DOUBLE AS share FROM li GROUP BY l_returnflag",
          ("share",))
def category_frequency_lineitem(spark, sf):
    return P.category_frequency(lineitem_panel(spark, sf), "l_returnflag")


# ------------------------------------------------------------------ D10, D11
@register("outlier_profile_lineitem",
          f"WITH {LI}, {LI_LONG}, q AS (SELECT \"column\", quantile_cont(value, 0.25) AS q1, "
          f"quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS q3, "
          f"quantile_cont(value, 0.99) AS p99 FROM li_long GROUP BY 1) "
          f"SELECT l.\"column\", any_value(q.p50) AS p50, any_value(q.p99) AS p99, "
          f"max(value) AS max, max(value) / greatest(any_value(q.p99), 1e-9) AS max_over_p99, "
          f"avg(CAST(value > q.q3 + 1.5 * (q.q3 - q.q1) AS DOUBLE)) * 100 AS pct_above_fence "
          f"FROM li_long l JOIN q USING (\"column\") GROUP BY l.\"column\"",
          ("p50", "p99", "max", "max_over_p99", "pct_above_fence"))
def outlier_profile_lineitem(spark, sf):
    return P.outlier_profile(lineitem_panel(spark, sf), LINEITEM_SPEC.numeric)


@register("box_stats_lineitem",
          f"WITH {LI}, {LI_LONG}, q AS (SELECT \"column\", quantile_cont(value, 0.25) AS q1, "
          f"quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM li_long "
          f"GROUP BY 1), j AS (SELECT l.\"column\", value, q1, median, q3, "
          f"value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1) AS inside "
          f"FROM li_long l JOIN q USING (\"column\")) SELECT \"column\", any_value(q1) AS q1, "
          f"any_value(median) AS median, any_value(q3) AS q3, "
          f"min(CASE WHEN inside THEN value END) AS lower_whisker, "
          f"max(CASE WHEN inside THEN value END) AS upper_whisker, "
          f"CAST(count_if(NOT inside) AS BIGINT) AS n_outliers FROM j GROUP BY \"column\"",
          ("q1", "median", "q3", "lower_whisker", "upper_whisker"))
def box_stats_lineitem(spark, sf):
    return P.box_stats(lineitem_panel(spark, sf), LINEITEM_SPEC.numeric)


# ------------------------------------------------------------------ D12, D13
@register("histogram_extendedprice_lineitem",
          f"WITH {LI}, r AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM li),"
          f" b AS (SELECT CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / 40)), 39) AS "
          f"INTEGER) AS bin FROM li, r WHERE l_extendedprice IS NOT NULL), "
          f"g AS (SELECT CAST(range AS INTEGER) AS bin FROM range(40)) "
          f"SELECT g.bin, any_value(lo) + g.bin * ((any_value(hi) - any_value(lo)) / 40) AS bin_lo, "
          f"any_value(lo) + (g.bin + 1) * ((any_value(hi) - any_value(lo)) / 40) AS bin_hi, "
          f"count(b.bin) AS n FROM g CROSS JOIN r LEFT JOIN b ON g.bin = b.bin GROUP BY g.bin",
          ("bin_lo", "bin_hi"))
def histogram_extendedprice_lineitem(spark, sf):
    return P.equal_width_histogram(lineitem_panel(spark, sf), "l_extendedprice", 40)


@register("density_quantity_by_regime_lineitem",
          f"WITH {LI}, c AS (SELECT {LI_REG} AS regime, CAST(least(floor((l_quantity - 0) / "
          f"(60.0 / 54)), 53) AS INTEGER) AS bin, count(*) AS n FROM li WHERE l_quantity >= 0 "
          f"AND l_quantity <= 60 GROUP BY ALL) SELECT regime, bin, 0 + bin * (60.0 / 54) AS bin_lo,"
          f" n / (sum(n) OVER (PARTITION BY regime) * (60.0 / 54)) AS density FROM c",
          ("bin_lo", "density"))
def density_quantity_by_regime_lineitem(spark, sf):
    df = lineitem_panel(spark, sf).withColumn("regime", regime_label("ship_month",
                                                                      LINEITEM_REGIMES))
    return P.density_histogram(df, "l_quantity", "regime", 0.0, 60.0, 54)


# ------------------------------------------------------------------ D14-D17
@register("category_target_rate_orders",
          f"WITH {OP} SELECT c_mktsegment AS value, count(*) AS n, avg(fulfilled::DOUBLE) AS "
          f"target_rate, (SELECT avg(fulfilled::DOUBLE) FROM op) AS global_rate, "
          f"avg(fulfilled::DOUBLE) > (SELECT avg(fulfilled::DOUBLE) FROM op) AS above_global "
          f"FROM op GROUP BY c_mktsegment", ("target_rate", "global_rate"))
def category_target_rate_orders(spark, sf):
    return P.category_target_rate(orders_panel(spark, sf), ORDERS_SPEC, "c_mktsegment")


@register("month_moments_extendedprice_lineitem",
          f"WITH {LI} SELECT ship_month, avg(l_extendedprice) AS mean, "
          f"quantile_cont(l_extendedprice, 0.5) AS median, stddev_samp(l_extendedprice) AS std, "
          f"avg(l_extendedprice) - stddev_samp(l_extendedprice) AS band_lo, "
          f"avg(l_extendedprice) + stddev_samp(l_extendedprice) AS band_hi FROM li "
          f"GROUP BY ship_month", ("mean", "median", "std", "band_lo", "band_hi"))
def month_moments_extendedprice_lineitem(spark, sf):
    return P.period_moments(lineitem_panel(spark, sf), LINEITEM_SPEC, "l_extendedprice")


@register("month_returnflag_share_lineitem",
          f"WITH {LI}, c AS (SELECT ship_month, count_if(l_returnflag = 'A') AS a, "
          f"count_if(l_returnflag = 'N') AS n, count_if(l_returnflag = 'R') AS r FROM li "
          f"GROUP BY ship_month) SELECT ship_month, a / (a + n + r) AS share_A, "
          f"n / (a + n + r) AS share_N, r / (a + n + r) AS share_R FROM c",
          ("share_A", "share_N", "share_R"))
def month_returnflag_share_lineitem(spark, sf):
    return P.period_category_share(lineitem_panel(spark, sf), LINEITEM_SPEC, "l_returnflag",
                                   ["A", "N", "R"])


@register("month_priority_rate_orders",
          f"WITH {OP} SELECT order_month, " + ", ".join(
              f"avg(CASE WHEN top_priority = '{v}' THEN fulfilled::DOUBLE END) AS "
              f"rate_{v.replace('-', '_').replace(' ', '_')}"
              for v in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"))
          + " FROM op GROUP BY order_month",
          tuple(f"rate_{v.replace('-', '_').replace(' ', '_')}"
                for v in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")))
def month_priority_rate_orders(spark, sf):
    return P.period_category_rate(orders_panel(spark, sf, with_customer=False), ORDERS_SPEC, "top_priority",
                                  ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"])


# ------------------------------------------------------------------ D29, D30, D33, D34, D37
@register("regime_means_quantity_lineitem",
          f"WITH {LI} SELECT {LI_REG} AS regime, avg(l_quantity) AS mean, min(ship_month) AS "
          f"first_period FROM li GROUP BY 1", ("mean",))
def regime_means_quantity_lineitem(spark, sf):
    return P.regime_means(lineitem_panel(spark, sf), LINEITEM_SPEC, "l_quantity",
                          LINEITEM_REGIMES)


@register("rate_dispersion_lineitem",
          f"WITH {LI}, m AS (SELECT ship_month, avg(returned::DOUBLE) AS r FROM li GROUP BY 1) "
          f"SELECT min(r) AS min_rate, max(r) AS max_rate, stddev_samp(r) AS std_rate, "
          f"count(*) AS n_periods FROM m", ("min_rate", "max_rate", "std_rate"))
def rate_dispersion_lineitem(spark, sf):
    return P.rate_dispersion(lineitem_panel(spark, sf), LINEITEM_SPEC)


@register("distinct_months_orders",
          f"WITH {OP} SELECT DISTINCT order_month FROM op")
def distinct_months_orders(spark, sf):
    return P.distinct_periods(orders_panel(spark, sf, with_customer=False), ORDERS_SPEC)


@register("linestatus_share_by_regime_lineitem",
          f"WITH {LI} SELECT {LI_REG} AS regime, avg(CAST(l_linestatus = 'O' AS DOUBLE)) AS share, "
          f"count(*) AS n_rows FROM li GROUP BY 1", ("share",))
def linestatus_share_by_regime_lineitem(spark, sf):
    return P.category_share_by_regime(lineitem_panel(spark, sf), LINEITEM_SPEC, "l_linestatus",
                                      "O", LINEITEM_REGIMES)


@register("split_summary_lineitem",
          f"WITH {LI} SELECT CASE WHEN ship_month IN ("
          + ", ".join(f"'{m}'" for m in LINEITEM_SPEC.train_periods)
          + ") THEN 'train' ELSE 'validation' END AS split, count(*) AS n_rows, "
          f"avg(returned::DOUBLE) AS target_rate FROM li WHERE ship_month IN ("
          + ", ".join(f"'{m}'" for m in LINEITEM_SPEC.train_periods
                      + LINEITEM_SPEC.validation_periods) + ") GROUP BY 1",
          ("target_rate",))
def split_summary_lineitem(spark, sf):
    return P.split_summary(lineitem_panel(spark, sf), LINEITEM_SPEC)


# ================================================================== association
from panelwatch.operators import association as A  # noqa: E402
from panelwatch.operators import timeline as TL  # noqa: E402

OP_REG = regime_sql("order_month", ORDERS_REGIMES)


def corr_sql(x: str, y: str) -> str:
    return f"CASE WHEN isnan(corr({x}, {y})) THEN NULL ELSE corr({x}, {y}) END"


@register("priority_gap_by_regime_orders",
          f"WITH {OP}, r AS (SELECT order_month, avg(CASE WHEN top_priority = '1-URGENT' THEN "
          f"fulfilled::DOUBLE END) AS ra, avg(CASE WHEN top_priority = '5-LOW' THEN "
          f"fulfilled::DOUBLE END) AS rb FROM op GROUP BY 1) SELECT {OP_REG} AS regime, "
          f"avg(ra - rb) AS mean_gap, count(ra - rb) AS n_periods FROM r GROUP BY 1",
          ("mean_gap",))
def priority_gap_by_regime_orders(spark, sf):
    return A.category_gap_by_regime(orders_panel(spark, sf, with_customer=False), ORDERS_SPEC, "top_priority",
                                    "1-URGENT", "5-LOW", ORDERS_REGIMES)


_LI_CORR = ("WITH {LI}, mc AS (" + " UNION ALL ".join(
    f"SELECT ship_month, '{c}' AS \"column\", {corr_sql(c, 'returned::DOUBLE')} AS corr "
    f"FROM li GROUP BY ship_month" for c in LI_NUM) + ")")


@register("month_correlations_lineitem",
          _LI_CORR.format(LI=LI) + " SELECT * FROM mc", ("corr",))
def month_correlations_lineitem(spark, sf):
    return A.period_correlations(lineitem_panel(spark, sf), LINEITEM_SPEC, LI_NUM)


@register("correlation_regime_summary_lineitem",
          _LI_CORR.format(LI=LI) + f", mr AS (SELECT \"column\", {LI_REG} AS regime, corr FROM mc)"
          " SELECT \"column\", round(avg(CASE WHEN regime = 'baseline' THEN corr END), 3) AS "
          "mean_baseline, round(avg(CASE WHEN regime = 'data_drift' THEN corr END), 3) AS "
          "mean_data_drift, round(avg(CASE WHEN regime = 'concept_drift' THEN corr END), 3) AS "
          "mean_concept_drift, round(avg(CASE WHEN regime = 'concept_drift' THEN corr END) - "
          "avg(CASE WHEN regime = 'baseline' THEN corr END), 3) AS change FROM mr GROUP BY 1",
          ("mean_baseline", "mean_data_drift", "mean_concept_drift", "change"))
def correlation_regime_summary_lineitem(spark, sf):
    corrs = A.period_correlations(lineitem_panel(spark, sf), LINEITEM_SPEC, LI_NUM)
    return A.correlation_regime_summary(corrs, LINEITEM_SPEC, LINEITEM_REGIMES)


@register("pooled_correlation_by_regime_lineitem",
          f"WITH {LI} " + " UNION ALL ".join(
              f"SELECT {LI_REG} AS regime, '{c}' AS \"column\", "
              f"{corr_sql(c, 'returned::DOUBLE')} AS corr FROM li GROUP BY 1" for c in LI_NUM),
          ("corr",))
def pooled_correlation_by_regime_lineitem(spark, sf):
    return A.pooled_correlation(lineitem_panel(spark, sf), LINEITEM_SPEC, LI_NUM,
                                LINEITEM_REGIMES)


_NULL_SQL = "n AS (SELECT * REPLACE (nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0.02) AS l_tax) FROM li)"


def _lineitem_with_nulls(spark, sf):
    null = lambda c, v: F.when(F.col(c) != v, F.col(c))
    return lineitem_panel(spark, sf).withColumns({"l_discount": null("l_discount", 0), "l_tax": null("l_tax", 0.02)})


@register("correlations_with_nulls_lineitem",
          f"WITH {LI}, {_NULL_SQL} " + " UNION ALL ".join(
              f"SELECT '{a}' AS col_a, '{b}' AS col_b, {corr_sql(a + '::DOUBLE', b + '::DOUBLE')} AS r FROM n"
              for a, b in (("l_discount", "l_tax"), ("l_discount", "returned"), ("l_tax", "returned"))), ("r",))
def correlations_with_nulls_lineitem(spark, sf):
    """D22 on columns with nulls: each pair uses the rows where both are present."""
    return A.correlation_matrix(_lineitem_with_nulls(spark, sf), ("l_discount", "l_tax", "returned"))


_MAT_COLS = LI_NUM + ("returned",)
_PAIRS = [(a, b) for i, a in enumerate(_MAT_COLS) for b in _MAT_COLS[i + 1:]]
_MAT_SQL = f"WITH {LI}, m AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {corr_sql(a + '::DOUBLE', b + '::DOUBLE')} AS r "
    f"FROM li" for a, b in _PAIRS) + ")"


@register("correlation_matrix_lineitem", _MAT_SQL + " SELECT * FROM m", ("r",))
def correlation_matrix_lineitem(spark, sf):
    return A.correlation_matrix(lineitem_panel(spark, sf), _MAT_COLS)


_OP_MAT = ORDERS_SPEC.numeric + ("fulfilled",)
_OP_PAIRS = [(a, b) for i, a in enumerate(_OP_MAT) for b in _OP_MAT[i + 1:]]


@register("strong_correlation_pairs_orders",
          f"WITH {OP}, m AS (" + " UNION ALL ".join(
              f"SELECT '{a}' AS col_a, '{b}' AS col_b, "
              f"{corr_sql(a + '::DOUBLE', b + '::DOUBLE')} AS r FROM op" for a, b in _OP_PAIRS)
          + ") SELECT * FROM m WHERE abs(r) > 0.30", ("r",))
def strong_correlation_pairs_orders(spark, sf):
    return A.strong_pairs(A.correlation_matrix(orders_panel(spark, sf), _OP_MAT), 0.30)


@register("contingency_linestatus_lineitem",
          f"WITH {LI} SELECT l_linestatus AS value, returned AS target, count(*) AS n FROM li "
          f"GROUP BY 1, 2")
def contingency_linestatus_lineitem(spark, sf):
    return A.contingency(lineitem_panel(spark, sf), "l_linestatus", "returned")


def chi_sql(panel_cte: str, src: str, target: str, columns) -> str:
    long = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, "
                              f"{target} AS t FROM {src}" for c in columns)
    dev0 = "abs(o0 - e0)"
    dev1 = "abs(o1 - e1)"
    corr0 = f"({dev0} - CASE WHEN dof = 1 THEN least(0.5, {dev0}) ELSE 0 END)"
    corr1 = f"({dev1} - CASE WHEN dof = 1 THEN least(0.5, {dev1}) ELSE 0 END)"
    return (
        f"WITH {panel_cte}, lg AS ({long}), cells AS (SELECT \"column\", value, "
        f"count_if(t = 0) AS o0, count_if(t = 1) AS o1 FROM lg WHERE value IS NOT NULL "
        f"GROUP BY 1, 2), tab AS (SELECT *, o0 + o1 AS r, sum(o0) OVER w AS c0, "
        f"sum(o1) OVER w AS c1, count(*) OVER w AS nv FROM cells WINDOW w AS "
        f"(PARTITION BY \"column\")), tab2 AS (SELECT *, c0 + c1 AS n, "
        f"CAST(c0 > 0 AS INTEGER) + CAST(c1 > 0 AS INTEGER) AS k FROM tab), "
        f"tab3 AS (SELECT *, (nv - 1) * (k - 1) AS dof, r * c0 / n AS e0, r * c1 / n AS e1 "
        f"FROM tab2), st AS (SELECT \"column\", sum(CASE WHEN e0 > 0 THEN {corr0} * {corr0} / e0 "
        f"ELSE 0 END + CASE WHEN e1 > 0 THEN {corr1} * {corr1} / e1 ELSE 0 END) AS chi2, "
        f"any_value(dof) AS dof, any_value(n) AS n, any_value(nv) AS nv, any_value(k) AS k "
        f"FROM tab3 GROUP BY 1) SELECT \"column\", chi2, CAST(dof AS INTEGER) AS dof, "
        f"sqrt(chi2 / nullif(n * (least(nv, k) - 1), 0)) AS cramers_v FROM st")


@register("chi_square_orders", chi_sql(OP, "op", "fulfilled", ORDERS_SPEC.categorical),
          ("chi2", "cramers_v"))
def chi_square_orders(spark, sf):
    return A.chi_square(orders_panel(spark, sf), ORDERS_SPEC, ORDERS_SPEC.categorical)


@register("chi_square_lineitem", chi_sql(LI, "li", "returned", ("l_linestatus",)),
          ("chi2", "cramers_v"))
def chi_square_lineitem(spark, sf):
    return A.chi_square(lineitem_panel(spark, sf), LINEITEM_SPEC, ("l_linestatus",))


def tail_sql(inner: str, keys: str, density: str, width: str, steps: int = 20_000) -> str:
    """Oracle for tail probabilities: Simpson's rule over a density of ``x``, from column ``x0`` of
    ``inner`` over ``width`` (a different way than the library's series and fractions)."""
    return (f"SELECT {keys}, sum(w * {density}) * any_value(h) / 3 AS p FROM (SELECT *, x0 + i * h AS x, CASE WHEN i IN (0, {steps}) THEN 1 "
            f"WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w FROM (SELECT *, ({width}) / {steps} AS h FROM ({inner}) AS t0) AS t1, "
            f"range(0, {steps + 1}) AS r(i)) AS t2 GROUP BY ALL")


CHI2_DENSITY = "exp((dof / 2.0 - 1) * ln(x) - x / 2 - dof / 2.0 * ln(2) - lgamma(dof / 2.0))"
CHI2_WIDTH = "80 + 20 * sqrt(2.0 * dof)"
T_DENSITY = "exp(lgamma((df + 1) / 2.0) - lgamma(df / 2.0) - 0.5 * ln(pi() * df) - (df + 1) / 2.0 * ln(1 + x * x / df))"


@register("chi_square_pvalues_orders",
          f"WITH base AS ({chi_sql(OP, 'op', 'fulfilled', ORDERS_SPEC.categorical)}), "
          "tail AS (" + tail_sql('SELECT "column", dof, chi2 AS x0 FROM base WHERE dof > 0', '"column"', CHI2_DENSITY, CHI2_WIDTH) + ") "
          'SELECT base.*, p AS p_value, p < 0.05 AS significant FROM base LEFT JOIN tail USING ("column")',
          ("chi2", "cramers_v", "p_value"))
def chi_square_pvalues_orders(spark, sf):
    return A.chi_square(orders_panel(spark, sf), ORDERS_SPEC, ORDERS_SPEC.categorical,
                        with_pvalue=True)


@register("point_biserial_lineitem",
          f"WITH {LI} " + " UNION ALL ".join(
              f"SELECT '{c}' AS \"column\", {corr_sql(c, 'returned::DOUBLE')} AS r, "
              f"avg(CASE WHEN returned = 1 THEN {c} END) AS mean_positive, "
              f"avg(CASE WHEN returned = 0 THEN {c} END) AS mean_negative, count({c}) AS n, "
              f"avg(CASE WHEN returned = 1 THEN {c} END) / avg(CASE WHEN returned = 0 THEN {c} END)"
              f" - 1.0 AS relative_diff FROM li" for c in LI_NUM),
          ("r", "mean_positive", "mean_negative", "relative_diff"))
def point_biserial_lineitem(spark, sf):
    return A.point_biserial(lineitem_panel(spark, sf), LINEITEM_SPEC, LI_NUM).drop("relative_diff_text")


@register("point_biserial_pvalues_orders",
          f"WITH {OP}, base AS (" + " UNION ALL ".join(
              f"SELECT '{c}' AS \"column\", {corr_sql(c, 'fulfilled::DOUBLE')} AS r, "
              f"avg(CASE WHEN fulfilled = 1 THEN {c} END) AS mean_positive, "
              f"avg(CASE WHEN fulfilled = 0 THEN {c} END) AS mean_negative, count({c}) AS n, "
              f"avg(CASE WHEN fulfilled = 1 THEN {c} END) / avg(CASE WHEN fulfilled = 0 THEN {c} END)"
              f" - 1.0 AS relative_diff FROM op" for c in ORDERS_SPEC.numeric) + "), tail AS ("
          + tail_sql('SELECT "column", n - 2 AS df, abs(r) * sqrt((n - 2) / (1 - r * r)) AS x0 FROM base', '"column"', T_DENSITY, "14.0")
          + ") SELECT \"column\", r, mean_positive, mean_negative, n, relative_diff, 2 * p AS p_value, "
          "CASE WHEN relative_diff IS NOT NULL THEN printf('%+.1f%%', 100 * relative_diff) END AS relative_diff_text "
          "FROM base JOIN tail USING (\"column\")",
          ("r", "mean_positive", "mean_negative", "relative_diff", "p_value"))
def point_biserial_pvalues_orders(spark, sf):
    return A.point_biserial(orders_panel(spark, sf), ORDERS_SPEC, ORDERS_SPEC.numeric,
                            with_pvalue=True)


# ================================================================== timeline
def _month_idx_sql(col: str, start: str) -> str:
    y, m = start.split("-")
    return (f"(CAST(substr({col}, 1, 4) AS INTEGER) * 12 + CAST(substr({col}, 6, 2) AS INTEGER)"
            f" - {int(y) * 12 + int(m)})")


_LI_IDX = _month_idx_sql("ship_month", "1995-01")
_MQ = (f"mq AS (SELECT ship_month, avg(l_quantity) AS mean_quantity, {_LI_IDX} AS i FROM li "
       f"GROUP BY ship_month)")


def _li_month_means(spark, sf):
    df = lineitem_panel(spark, sf)
    return df.groupBy("ship_month").agg(F.avg("l_quantity").alias("mean_quantity"))


@register("month_change_quantity_lineitem",
          f"WITH {LI}, {_MQ} SELECT a.ship_month, a.mean_quantity, "
          f"a.mean_quantity - b.mean_quantity AS diff FROM mq a LEFT JOIN mq b ON b.i = a.i - 1",
          ("mean_quantity", "diff"))
def month_change_quantity_lineitem(spark, sf):
    return TL.period_change(_li_month_means(spark, sf), "ship_month", "mean_quantity", "1995-01")


_RAMP = ("1995-09", "1995-10", "1995-11", "1995-12")


@register("ramp_change_summary_lineitem",
          f"WITH {LI}, {_MQ}, d AS (SELECT a.ship_month, a.mean_quantity - b.mean_quantity AS diff "
          f"FROM mq a LEFT JOIN mq b ON b.i = a.i - 1) SELECT max(diff) AS max_diff, "
          f"bool_and(diff >= 0) AS non_decreasing, sum(diff) AS total_change FROM d WHERE "
          f"ship_month IN ({', '.join(repr(m) for m in _RAMP[1:])})",
          ("max_diff", "total_change"))
def ramp_change_summary_lineitem(spark, sf):
    ch = TL.period_change(_li_month_means(spark, sf), "ship_month", "mean_quantity", "1995-01")
    return TL.change_summary(ch, list(_RAMP), "ship_month")


@register("stacked_returnflag_share_lineitem",
          f"WITH {LI}, c AS (SELECT ship_month, l_returnflag AS category, count(*) AS n FROM li "
          f"GROUP BY 1, 2), s AS (SELECT ship_month, category, n / sum(n) OVER (PARTITION BY "
          f"ship_month) AS share FROM c) SELECT ship_month, category, share, coalesce(sum(share) "
          f"OVER (PARTITION BY ship_month ORDER BY category ROWS BETWEEN UNBOUNDED PRECEDING AND "
          f"1 PRECEDING), 0.0) AS base FROM s", ("share", "base"))
def stacked_returnflag_share_lineitem(spark, sf):
    wide = P.period_category_share(lineitem_panel(spark, sf), LINEITEM_SPEC, "l_returnflag",
                                   ["A", "N", "R"])
    long = wide.unpivot(["ship_month"], ["share_A", "share_N", "share_R"], "category", "share")
    long = long.withColumn("category", F.regexp_replace("category", "^share_", ""))
    return TL.stacked_share_base(long, "ship_month", "category")


@register("regime_runs_lineitem",
          f"WITH {LI}, m AS (SELECT DISTINCT ship_month, {LI_REG} AS regime, {_LI_IDX} AS i "
          f"FROM li), isl AS (SELECT *, i - row_number() OVER (PARTITION BY regime ORDER BY i) AS g"
          f" FROM m) SELECT strftime(DATE '1995-01-01' + to_months(CAST(min(i) AS INTEGER)), "
          f"'%Y-%m') AS first_period, strftime(DATE '1995-01-01' + to_months(CAST(max(i) AS "
          f"INTEGER)), '%Y-%m') AS last_period, regime, count(*) AS n_periods FROM isl "
          f"GROUP BY regime, g")
def regime_runs_lineitem(spark, sf):
    months = lineitem_panel(spark, sf).select("ship_month").distinct().withColumn(
        "regime", regime_label("ship_month", LINEITEM_REGIMES))
    return TL.consecutive_runs(months, "ship_month", "regime", "1995-01")


_OP_IDX = _month_idx_sql("order_month", "1995-01")


@register("panel_transitions_orders",
          f"WITH {OP}, r AS (SELECT o_custkey, {_OP_IDX} AS i, fulfilled AS t FROM op), "
          f"r2 AS (SELECT *, lag(i) OVER w AS prev, lead(i) OVER w AS nxt FROM r WINDOW w AS "
          f"(PARTITION BY o_custkey ORDER BY i)), pr AS (SELECT i, count(*) AS n_ids, "
          f"count_if(prev IS NULL) AS n_new, count_if(coalesce(prev = i - 1, false)) AS n_retained, "
          f"count_if(coalesce(prev < i - 1, false)) AS n_returned, count_if(coalesce(t = 1 AND nxt = i + 1, false)) AS "
          f"n_target_then_present FROM r2 GROUP BY i), lo AS (SELECT i + 1 AS i, count(*) AS "
          f"n_lost FROM r2 WHERE nxt IS NULL OR nxt > i + 1 GROUP BY 1) "
          f"SELECT strftime(DATE '1995-01-01' + to_months(CAST(pr.i AS INTEGER)), '%Y-%m') AS "
          f"order_month, n_ids, CAST(n_new AS BIGINT) AS n_new, CAST(n_retained AS BIGINT) AS "
          f"n_retained, CAST(n_returned AS BIGINT) AS n_returned, CAST(n_target_then_present AS "
          f"BIGINT) AS n_target_then_present, coalesce(n_lost, 0) AS n_lost "
          f"FROM pr LEFT JOIN lo USING (i)")
def panel_transitions_orders(spark, sf):
    return TL.panel_transitions(orders_panel(spark, sf, with_customer=False), ORDERS_SPEC, "1995-01")


# ================================================================== metrics, scoring
from panelwatch.operators import metrics as M  # noqa: E402
from panelwatch.operators import scoring as S  # noqa: E402

# A fixed scorecard for the lineitem panel: numeric terms are z-scores with
# stated reference mean / sd and weight, plus a line-status term.
LINEITEM_CARD = S.Scorecard(
    intercept=-0.7,
    numeric={"l_discount": (0.05, 0.03, 0.4), "l_quantity": (25.5, 14.4, -0.3),
             "l_tax": (0.04, 0.025, 0.2)},
    categorical={"l_linestatus": {"O": 0.2, "F": -0.1}},
)


def card_sql(card: S.Scorecard, with_intercept: bool = True) -> str:
    """The same expression tree as ``Scorecard.linear`` (same float ops)."""
    z = f"CAST({float(card.intercept) if with_intercept else 0.0!r} AS DOUBLE)"
    for c, (mean, sd, beta) in card.numeric.items():
        z = f"({z} + CAST({float(beta)!r} AS DOUBLE) * (({c} - CAST({float(mean)!r} AS DOUBLE)) / CAST({float(sd)!r} AS DOUBLE)))"
    for c, table in card.categorical.items():
        whens = " ".join(f"WHEN '{k}' THEN CAST({float(v)!r} AS DOUBLE)" for k, v in table.items())
        z = f"({z} + (CASE {c} {whens} END))"
    return z


def prob_sql(card: S.Scorecard) -> str:
    return f"(CAST(1.0 AS DOUBLE) / (CAST(1.0 AS DOUBLE) + exp(-{card_sql(card)})))"


def _scored_li(spark, sf):
    return S.linear_score(lineitem_panel(spark, sf), LINEITEM_CARD, "score", z_out="z")


def _sigmoid_of(c):
    from panelwatch.functions.scalar import sigmoid
    return sigmoid(c)


_SC = (f"sc AS (SELECT ship_month, returned AS y, {card_sql(LINEITEM_CARD)} AS z, "
       f"{prob_sql(LINEITEM_CARD)} AS p FROM li)")


def _rank_sql(group: str | None) -> str:
    g = f"{group}, " if group else ""
    part = f"PARTITION BY {group}" if group else ""
    return (
        f"st AS (SELECT {g}z, count_if(y = 1) AS pos, count_if(y = 0) AS neg FROM sc "
        f"GROUP BY {g}z), rr AS (SELECT *, sum(pos) OVER w AS pos_le, sum(neg) OVER w AS neg_le, "
        f"sum(pos) OVER ({part}) AS PP, sum(neg) OVER ({part}) AS NN FROM st WINDOW w AS "
        f"({part} ORDER BY z ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))")


def _eval_sql(group: str | None) -> str:
    g = f"{group}, " if group else ""
    gb = f"GROUP BY {group}" if group else ""
    join = f"USING ({group})" if group else "ON true"
    tp = "(PP - pos_le + pos)"
    fp = "(NN - neg_le + neg)"
    return (
        f"WITH {LI}, {_SC}, {_rank_sql(group)}, rk AS (SELECT {g}"
        f"CASE WHEN any_value(PP) > 0 AND any_value(NN) > 0 THEN "
        f"sum(pos * ((neg_le - neg) + 0.5 * neg)) / (any_value(PP) * any_value(NN)) END AS roc_auc,"
        f" CASE WHEN any_value(PP) > 0 THEN sum(CASE WHEN pos > 0 THEN pos * {tp} / ({tp} + {fp}) "
        f"END) / any_value(PP) END AS pr_auc FROM rr {gb}), "
        f"th0 AS (SELECT {g}y::DOUBLE AS y, p, CAST(p >= 0.5 AS DOUBLE) AS pred FROM sc), "
        f"th1 AS (SELECT {g}count(*) AS n, sum(pred * y) AS tp, sum(pred * (1 - y)) AS fp, "
        f"sum((1 - pred) * y) AS fn, avg((p - y) * (p - y)) AS brier, avg(pred) AS positive_rate "
        f"FROM th0 {gb}), th AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0.0) AS prec, "
        f"coalesce(tp / nullif(tp + fn, 0), 0.0) AS rec FROM th1) "
        f"SELECT {g}n, roc_auc, pr_auc, prec AS precision, rec AS recall, "
        f"coalesce(2 * prec * rec / nullif(prec + rec, 0), 0.0) AS f1, brier, positive_rate "
        f"FROM th JOIN rk {join}")


_EV_D = ("roc_auc", "pr_auc", "precision", "recall", "f1", "brier", "positive_rate")


@register("evaluation_by_month_lineitem", _eval_sql("ship_month"), _EV_D)
def evaluation_by_month_lineitem(spark, sf):
    return M.evaluate(_scored_li(spark, sf), ["ship_month"], "score", "returned",
                      rank_score="z")


@register("evaluation_overall_lineitem", _eval_sql(None), _EV_D)
def evaluation_overall_lineitem(spark, sf):
    return M.evaluate(_scored_li(spark, sf), [], "score", "returned", rank_score="z")


@register("roc_curve_lineitem",
          f"WITH {LI}, {_SC}, {_rank_sql(None)} SELECT 1.0 / (1.0 + exp(-z)) AS threshold, "
          f"(NN - neg_le + neg)::DOUBLE / NN AS fpr, (PP - pos_le + pos)::DOUBLE / PP AS tpr FROM rr"
          f" UNION ALL SELECT NULL::DOUBLE, 0.0, 0.0",
          ("threshold", "fpr", "tpr"))
def roc_curve_lineitem(spark, sf):
    return M.roc_points(_scored_li(spark, sf), [], "z", "returned", threshold_of=_sigmoid_of)


@register("pr_curve_lineitem",
          f"WITH {LI}, {_SC}, {_rank_sql(None)} SELECT 1.0 / (1.0 + exp(-z)) AS threshold, "
          f"(PP - pos_le + pos)::DOUBLE / PP AS recall, (PP - pos_le + pos) / "
          f"((PP - pos_le + pos) + (NN - neg_le + neg)) AS precision, PP / (PP + NN) AS base_rate "
          f"FROM rr UNION ALL SELECT NULL::DOUBLE, 0.0, 1.0, (SELECT avg(y::DOUBLE) FROM sc)",
          ("threshold", "recall", "precision", "base_rate"))
def pr_curve_lineitem(spark, sf):
    return M.pr_points(_scored_li(spark, sf), [], "z", "returned", threshold_of=_sigmoid_of)


@register("confusion_by_regime_lineitem",
          f"WITH {LI}, b AS (SELECT {LI_REG} AS regime, returned AS actual, "
          f"CAST({prob_sql(LINEITEM_CARD)} >= 0.5 AS INTEGER) AS predicted FROM li), "
          f"k AS (SELECT DISTINCT regime FROM b), cells AS (SELECT regime, a.actual, p.predicted "
          f"FROM k, (VALUES (0), (1)) a(actual), (VALUES (0), (1)) p(predicted)) "
          f"SELECT c.regime, c.actual, c.predicted, count(b.actual) AS n FROM cells c LEFT JOIN b "
          f"ON b.regime = c.regime AND b.actual = c.actual AND b.predicted = c.predicted "
          f"GROUP BY ALL")
def confusion_by_regime_lineitem(spark, sf):
    df = _scored_li(spark, sf).withColumn("regime", regime_label("ship_month", LINEITEM_REGIMES))
    return M.confusion_counts(df, ["regime"], "score", "returned")


@register("scorecard_risk_bands_lineitem",
          f"WITH {LI}, s AS (SELECT ship_month, {prob_sql(LINEITEM_CARD)} AS p FROM li) "
          f"SELECT ship_month, CASE WHEN p < 0.35 THEN 'bajo' WHEN p < 0.65 THEN 'medio' ELSE "
          f"'alto' END AS risk_band, count(*) AS n, avg(round(p, 4)) AS mean_probability, "
          f"CAST(sum(CAST(p >= 0.5 AS INTEGER)) AS BIGINT) AS n_positive_class FROM s GROUP BY 1, 2",
          ("mean_probability",))
def scorecard_risk_bands_lineitem(spark, sf):
    b = S.bands_from_probability(_scored_li(spark, sf), "score", prefix="return")
    return b.groupBy("ship_month", "risk_band").agg(
        F.count(F.lit(1)).alias("n"), F.avg("return_probability").alias("mean_probability"),
        F.sum("return_prediction").cast("bigint").alias("n_positive_class"))


@register("calibrated_intercept_by_month_lineitem",
          f"WITH {LI} SELECT ship_month, avg(returned::DOUBLE) AS target_rate, "
          f"round(avg(returned::DOUBLE), 5) AS achieved_rate FROM li GROUP BY 1", ("target_rate", "achieved_rate"))
def calibrated_intercept_by_month_lineitem(spark, sf):
    z = S.linear_score(lineitem_panel(spark, sf), LINEITEM_CARD, "score", z_out="z0")
    z = z.withColumn("z0", S.Scorecard(0.0, LINEITEM_CARD.numeric,
                                       LINEITEM_CARD.categorical).linear(with_intercept=False))
    found = S.calibrate_intercept(z, ["ship_month"], "z0", "returned")
    # the rate that the found intercept gives on all rows of its month
    shifted = sigmoid(F.col("z0") + F.col("intercept"))
    return z.join(found, "ship_month").groupBy("ship_month").agg(
        F.first("target_rate").alias("target_rate"), F.round(F.avg(shifted), 5).alias("achieved_rate"))


# Contract for lineitem rows (ranges and closed domains).
LINEITEM_RULES = (
    S.FieldRule("l_quantity", "int", ge=1, le=50),
    S.FieldRule("l_extendedprice", "double", gt=0, le=1_000_000),
    S.FieldRule("l_discount", "double", ge=0, le=0.10),
    S.FieldRule("l_tax", "double", ge=0, le=0.08),
    S.FieldRule("l_linestatus", "string", allowed=("O", "F")),
    S.FieldRule("l_returnflag", "string", allowed=("A", "N", "R")),
    S.FieldRule("ship_month", "string", min_len=7, max_len=7),
)


def _rules_sql(rules) -> str:
    parts = []
    for r in rules:
        c = r.name
        checks = [(f"{c} IS NULL", "field required")]
        if r.kind in ("int", "double"):
            num = f"TRY_CAST({c} AS DOUBLE)"
            if r.kind == "int":
                checks.append((f"{num} <> floor({num})", "not a valid integer"))
            if r.ge is not None:
                checks.append((f"{num} < {float(r.ge)!r}", f"must be >= {r.ge}"))
            if r.gt is not None:
                checks.append((f"{num} <= {float(r.gt)!r}", f"must be > {r.gt}"))
            if r.le is not None:
                checks.append((f"{num} > {float(r.le)!r}", f"must be <= {r.le}"))
        else:
            if r.allowed is not None:
                vals = ", ".join(f"'{v}'" for v in r.allowed)
                checks.append((f"{c} IS NOT NULL AND {c} NOT IN ({vals})", "value not allowed"))
            if r.min_len is not None:
                checks.append((f"length({c}) < {r.min_len}", f"length must be >= {r.min_len}"))
            if r.max_len is not None:
                checks.append((f"length({c}) > {r.max_len}", f"length must be <= {r.max_len}"))
        whens = " ".join(f"WHEN coalesce({cond}, false) THEN '{c}: {msg}'" for cond, msg in checks)
        parts.append(f"CASE {whens} END")
    return "list_filter([" + ", ".join(parts) + "], lambda x: x IS NOT NULL)"


@register("row_validation_lineitem",
          f"WITH {LI}, v AS (SELECT {_rules_sql(LINEITEM_RULES)} AS errors FROM li), "
          f"e AS (SELECT unnest(CASE WHEN len(errors) = 0 THEN [NULL::VARCHAR] ELSE errors END) AS "
          f"error FROM v) SELECT coalesce(error, '(valid)') AS error, count(*) AS n FROM e "
          f"GROUP BY 1")
def row_validation_lineitem(spark, sf):
    v = S.validate_rows(lineitem_panel(spark, sf), LINEITEM_RULES)
    return (v.select(F.explode_outer("errors").alias("error"))
            .groupBy(F.coalesce("error", F.lit("(valid)")).alias("error"))
            .agg(F.count(F.lit(1)).alias("n")))


# tighter ranges, so that rows break them
STRICT_RULES = (
    S.FieldRule("l_quantity", "int", ge=5, le=40),
    S.FieldRule("l_discount", "double", ge=0.01, le=0.05),
    S.FieldRule("l_linestatus", "string", allowed=("F",)),
    S.FieldRule("l_returnflag", "string", min_len=1, max_len=1),
)


@register("row_validation_failures_lineitem",
          f"WITH {LI}, v AS (SELECT {_rules_sql(STRICT_RULES)} AS errors FROM li), "
          f"e AS (SELECT unnest(CASE WHEN len(errors) = 0 THEN [NULL::VARCHAR] ELSE errors END) AS "
          f"error FROM v) SELECT coalesce(error, '(valid)') AS error, count(*) AS n FROM e "
          f"GROUP BY 1")
def row_validation_failures_lineitem(spark, sf):
    """B12 with rules that many rows break."""
    v = S.validate_rows(lineitem_panel(spark, sf), STRICT_RULES)
    return (v.select(F.explode_outer("errors").alias("error"))
            .groupBy(F.coalesce("error", F.lit("(valid)")).alias("error"))
            .agg(F.count(F.lit(1)).alias("n")))


# ================================================================== drift monitoring
from panelwatch.operators import drift as D  # noqa: E402

_LI_REF = LINEITEM_SPEC.train_periods
_LI_REF_SQL = ", ".join(f"'{m}'" for m in _LI_REF)
_LI_FEATS = LINEITEM_SPEC.numeric + LINEITEM_SPEC.categorical
_MCFG = D.MonitorConfig(prediction="score", rank_score="z")


def drift_sql(panel_cte: str, src: str, period: str, reference, numeric, categorical,
              extra_cols: str) -> str:
    """DuckDB oracle for column drift: W1 on per-period breakpoints that
    include every reference value (plain construction), JS on the full
    value grid; ``extra_cols`` adds derived columns (prediction, z)."""
    ref_sql = ", ".join(f"'{m}'" for m in reference)
    keep = ", ".join(numeric)
    cat_parts = []
    for c in categorical:
        cat_parts.append(f"SELECT {period}, '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM sc "
                         f"WHERE {c} IS NOT NULL")
    js = ""
    if categorical:
        js = (
            f", cat AS ({' UNION ALL '.join(cat_parts)}), "
            f"refc AS (SELECT \"column\", value, count(*) AS n FROM cat WHERE {period} IN ({ref_sql}) "
            f"GROUP BY 1, 2), refp AS (SELECT \"column\", value, n / sum(n) OVER (PARTITION BY "
            f"\"column\") AS p FROM refc), curc AS (SELECT {period}, \"column\", value, count(*) AS n "
            f"FROM cat WHERE {period} NOT IN ({ref_sql}) GROUP BY 1, 2, 3), curp AS (SELECT {period}, "
            f"\"column\", value, n / sum(n) OVER (PARTITION BY {period}, \"column\") AS q FROM curc), "
            f"cm AS (SELECT DISTINCT {period}, \"column\" FROM curc), vv AS (SELECT DISTINCT "
            f"\"column\", value FROM cat), grid AS (SELECT cm.{period}, cm.\"column\", vv.value FROM "
            f"cm JOIN vv USING (\"column\")), g2 AS (SELECT g.{period}, g.\"column\", "
            f"coalesce(r.p, 0) AS p, coalesce(c.q, 0) AS q FROM grid g LEFT JOIN refp r ON "
            f"r.\"column\" = g.\"column\" AND r.value = g.value LEFT JOIN curp c ON c.{period} = "
            f"g.{period} AND c.\"column\" = g.\"column\" AND c.value = g.value), "
            f"jd AS (SELECT {period}, \"column\", 'jensenshannon' AS method, sqrt(greatest(0.5 * "
            f"sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END) + 0.5 * sum(CASE WHEN "
            f"q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END), 0)) AS score FROM g2 GROUP BY 1, 2)")
    union = "SELECT * FROM wd" + (" UNION ALL SELECT * FROM jd" if categorical else "")
    return (
        f"WITH {panel_cte}, sc AS (SELECT *, {extra_cols} FROM {src}), "
        f"num AS (UNPIVOT (SELECT {period}, {keep} FROM sc) ON {keep} "
        f"INTO NAME \"column\" VALUE value), "
        f"numc AS (SELECT * FROM num WHERE value IS NOT NULL AND NOT isnan(value)), "
        f"refn AS (SELECT \"column\", value, count(*) AS n FROM numc WHERE {period} IN "
        f"({ref_sql}) GROUP BY 1, 2), "
        f"refsd AS (SELECT \"column\", stddev_pop(value) AS sd FROM numc WHERE {period} IN "
        f"({ref_sql}) GROUP BY 1), "
        f"curn AS (SELECT {period}, \"column\", value, count(*) AS n FROM numc WHERE {period} "
        f"NOT IN ({ref_sql}) GROUP BY 1, 2, 3), "
        f"pairs AS (SELECT DISTINCT {period}, \"column\" FROM curn), "
        f"pts AS (SELECT p.{period}, p.\"column\", r.value, r.n AS nr, 0 AS nc FROM pairs p "
        f"JOIN refn r USING (\"column\") UNION ALL SELECT {period}, \"column\", value, 0, n FROM "
        f"curn), agg AS (SELECT {period}, \"column\", value, sum(nr) AS nr, sum(nc) AS nc FROM pts "
        f"GROUP BY 1, 2, 3), cdf AS (SELECT *, sum(nr) OVER w / sum(nr) OVER pp AS fr, "
        f"sum(nc) OVER w / sum(nc) OVER pp AS fc, lead(value) OVER w2 AS nv FROM agg WINDOW w AS "
        f"(PARTITION BY {period}, \"column\" ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND "
        f"CURRENT ROW), pp AS (PARTITION BY {period}, \"column\"), w2 AS (PARTITION BY "
        f"{period}, \"column\" ORDER BY value)), "
        f"w1 AS (SELECT {period}, \"column\", sum(coalesce(abs(fr - fc) * (nv - value), 0)) AS w1 "
        f"FROM cdf GROUP BY 1, 2), "
        f"wd AS (SELECT {period}, \"column\", 'wasserstein' AS method, CASE WHEN sd > 0 THEN "
        f"w1 / sd WHEN abs(w1) < 1e-12 THEN 0.0 END AS score FROM w1 JOIN refsd USING (\"column\"))"
        f"{js}, cd AS (SELECT {period}, \"column\", method, score, CAST(0.1 AS DOUBLE) AS "
        f"threshold, 'higher' AS direction, coalesce(score > 0.1, true) AS drifted FROM ({union}))")


def _drift_sql() -> str:
    return drift_sql(LI, "li", "ship_month", _LI_REF, LI_NUM + ("prediction",), ("l_linestatus",),
                     f"{prob_sql(LINEITEM_CARD)} AS prediction, {card_sql(LINEITEM_CARD)} AS z")


@register("column_drift_lineitem", _drift_sql() + " SELECT * FROM cd", ("score", "threshold"))
def column_drift_lineitem(spark, sf):
    df = _scored_li(spark, sf)
    d = D.column_drift(df, "ship_month", list(LI_NUM) + ["score"], ["l_linestatus"], _LI_REF)
    return d.where(~F.col("ship_month").isin(list(_LI_REF))).withColumn("column", F.when(F.col("column") == "score",
                                                        F.lit("prediction"))
                                       .otherwise(F.col("column")))


def monthly_sql(drift_cte: str, period: str, target: str, feats, reference, regime: str,
                month_alias: str = "month") -> str:
    """Oracle for ``drift.monthly_drift`` on top of a ``drift_sql`` CTE chain
    (needs columns ``z`` and ``prediction`` in ``sc``)."""
    ref_sql = ", ".join(f"'{m}'" for m in reference)
    order = " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(feats))
    return (
        drift_cte
        + f", fa AS (SELECT {period}, CAST(count_if(drifted) AS INTEGER) AS dc, "
        f"string_agg(CASE WHEN drifted THEN \"column\" END, ', ' ORDER BY CASE \"column\" {order} "
        f"END) AS dl FROM cd WHERE \"column\" <> 'prediction' GROUP BY 1), "
        f"pd AS (SELECT {period}, score AS pscore, drifted AS pdet FROM cd WHERE \"column\" = "
        f"'prediction'), "
        f"st AS (SELECT {period}, z, count_if({target} = 1) AS pos, count_if({target} = 0) AS neg"
        f" FROM sc GROUP BY 1, 2), "
        f"rr AS (SELECT *, sum(neg) OVER w AS neg_le, sum(pos) OVER pm AS pp, sum(neg) OVER pm AS nn"
        f" FROM st WINDOW w AS (PARTITION BY {period} ORDER BY z ROWS BETWEEN UNBOUNDED PRECEDING"
        f" AND CURRENT ROW), pm AS (PARTITION BY {period})), "
        f"auc AS (SELECT {period}, CASE WHEN any_value(pp) > 0 AND any_value(nn) > 0 THEN "
        f"sum(pos * ((neg_le - neg) + 0.5 * neg)) / (any_value(pp) * any_value(nn)) END AS auc "
        f"FROM rr GROUP BY 1), "
        f"rst AS (SELECT z, count_if({target} = 1) AS pos, count_if({target} = 0) AS neg FROM sc "
        f"WHERE {period} IN ({ref_sql}) GROUP BY 1), "
        f"rrr AS (SELECT *, sum(neg) OVER (ORDER BY z ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT "
        f"ROW) AS neg_le, sum(pos) OVER () AS pp, sum(neg) OVER () AS nn FROM rst), "
        f"rauc AS (SELECT sum(pos * ((neg_le - neg) + 0.5 * neg)) / (any_value(pp) * any_value(nn))"
        f" AS ra FROM rrr), "
        f"cnt AS (SELECT {period}, count(*) AS n_rows FROM sc WHERE {period} NOT IN "
        f"({ref_sql}) GROUP BY 1), "
        f"rec AS (SELECT c.{period}, c.n_rows, coalesce(fa.dc, 0) AS dc, fa.dl, pd.pscore, "
        f"pd.pdet, auc.auc, rauc.ra, coalesce(fa.dc, 0) / {float(len(feats))!r} AS share, "
        f"auc.auc - rauc.ra AS delta FROM cnt c LEFT JOIN fa USING ({period}) LEFT JOIN pd "
        f"USING ({period}) LEFT JOIN auc USING ({period}) CROSS JOIN rauc) "
        f"SELECT {period} AS {month_alias}, {regime} AS regime, n_rows, dc AS drifted_columns_count, "
        f"round(share, 4) AS drifted_columns_share, coalesce(dl, '') AS drifted_columns, "
        f"round(pscore, 4) AS prediction_drift_score, coalesce(pdet, false) AS "
        f"prediction_drift_detected, round(auc, 4) AS roc_auc, round(delta, 4) AS auc_delta, "
        f"CASE WHEN delta IS NOT NULL AND delta <= -0.02 THEN 'CRITICO' WHEN share > 0.3 THEN "
        f"'VIGILAR' ELSE 'OK' END AS status, round(ra, 4) AS reference_roc_auc FROM rec")


def _monthly_sql() -> str:
    return monthly_sql(_drift_sql(), "ship_month", "returned", _LI_FEATS, _LI_REF, LI_REG)


def monthly_drift_lineitem(spark, sf):
    """Library result (array of drifted columns kept as an array)."""
    return D.monthly_drift(_scored_li(spark, sf), LINEITEM_SPEC, _LI_REF, LINEITEM_REGIMES,
                           cfg=_MCFG)


@register("monthly_drift_status_lineitem", _monthly_sql(),
          ("drifted_columns_share", "prediction_drift_score", "roc_auc", "auc_delta",
           "reference_roc_auc"))
def monthly_drift_status_lineitem(spark, sf):
    rec = monthly_drift_lineitem(spark, sf)
    return rec.withColumn("drifted_columns", F.array_join("drifted_columns", ", "))


@register("drift_history_document_lineitem")
def drift_history_document_lineitem(spark, sf):
    model = {"name": "lineitem-scorecard", "version": "1", "algorithm": "scorecard"}
    return D.history_document(monthly_drift_lineitem(spark, sf), model, _LI_REF, _MCFG)


@register("status_milestones_lineitem",
          _monthly_sql().replace("SELECT ship_month AS month,", "SELECT ship_month AS month,", 1)
          and (f"WITH h AS ({_monthly_sql()}) SELECT min(CASE WHEN status = 'VIGILAR' THEN month END)"
               f" AS first_watch, min(CASE WHEN status = 'CRITICO' THEN month END) AS "
               f"first_critical, arg_max(status, month) AS latest_status, max(month) AS "
               f"latest_period, CAST(datediff('month', CAST(min(CASE WHEN status = 'VIGILAR' THEN "
               f"month END) || '-01' AS DATE), CAST(min(CASE WHEN status = 'CRITICO' THEN month END)"
               f" || '-01' AS DATE)) AS INTEGER) AS lag_periods FROM h"))
def status_milestones_lineitem(spark, sf):
    return TL.status_milestones(monthly_drift_lineitem(spark, sf))


@register("status_runs_lineitem",
          f"WITH h AS ({_monthly_sql()}), m AS (SELECT month, status, {_month_idx_sql('month', '1995-01')}"
          f" AS i FROM h), isl AS (SELECT *, i - row_number() OVER (PARTITION BY status ORDER BY i) "
          f"AS g FROM m) SELECT strftime(DATE '1995-01-01' + to_months(CAST(min(i) AS INTEGER)), "
          f"'%Y-%m') AS first_period, strftime(DATE '1995-01-01' + to_months(CAST(max(i) AS "
          f"INTEGER)), '%Y-%m') AS last_period, status, count(*) AS n_periods FROM isl "
          f"GROUP BY status, g")
def status_runs_lineitem(spark, sf):
    rec = monthly_drift_lineitem(spark, sf)
    return TL.consecutive_runs(rec.select("month", "status"), "month", "status", "1995-01")


@register("latest_headline_lineitem",
          f"WITH h AS ({_monthly_sql()}) SELECT max(month) AS month, arg_max(status, month) AS "
          f"status, CASE arg_max(status, month) WHEN 'OK' THEN 'Estable' WHEN 'VIGILAR' THEN "
          f"'Vigilar' WHEN 'CRITICO' THEN 'Requiere reentrenamiento' ELSE arg_max(status, month) "
          f"END AS status_label, arg_max(roc_auc, month) AS roc_auc, arg_max(auc_delta, month) AS "
          f"auc_delta, '1' AS model_version, 'scorecard' AS model_algorithm FROM h", ("roc_auc", "auc_delta"))
def latest_headline_lineitem(spark, sf):
    return D.latest_headline(monthly_drift_lineitem(spark, sf), model={"version": "1", "algorithm": "scorecard"})


_DETAIL_MONTH = "1998-12"


@register("month_detail_lineitem",
          f"WITH h AS ({_monthly_sql()}) SELECT month, CAST(drifted_columns_count AS VARCHAR) || "
          f"'/{len(_LI_FEATS)}' AS drifted, drifted_columns AS drifted_list, "
          f"prediction_drift_detected, roc_auc FROM h WHERE month = '{_DETAIL_MONTH}'",
          ("roc_auc",))
def month_detail_lineitem(spark, sf):
    """One month's detail (count of n, list as text, flag, AUC)."""
    return D.month_detail(monthly_drift_lineitem(spark, sf), _DETAIL_MONTH, len(_LI_FEATS))


# ================================================================== models, registry, stream, io
import uuid as _uuid  # noqa: E402

from panelwatch.functions.scalar import sigmoid  # noqa: E402
from panelwatch.operators import features as FE  # noqa: E402
from panelwatch.operators import models as MD  # noqa: E402
from panelwatch.plans import training as TR  # noqa: E402
from panelwatch.session import scratch_path  # noqa: E402
from panelwatch.sources import panel_io as IO  # noqa: E402
from panelwatch.sources.registry import Registry  # noqa: E402
from panelwatch.streaming.score_stream import read_scored, score_stream  # noqa: E402

# The levels of the categorical columns (one-hot columns in sorted order).
_LEVELS = {"l_linestatus": ("F", "O"), "top_priority": ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"),
           "c_mktsegment": ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")}


def logistic_sql(panel_cte: str, src: str, spec, steps: int = 7) -> str:
    """Oracle for the prepared and fitted logistic model: CTEs ending in ``xs`` (all rows, feature list ``x``, the
    constant last) and ``fitted`` (one row, weights ``b``).  Newton steps are unrolled, each with a Gauss-Jordan elimination
    on a list of lists."""
    names = list(spec.numeric) + [f"{c}_{v}" for c in spec.categorical for v in _LEVELS[c]]
    k = len(names) + 1
    train = ", ".join(f"'{m}'" for m in spec.train_periods)
    ctes = [panel_cte, f"tr AS MATERIALIZED (SELECT * FROM {src} WHERE {spec.period} IN ({train}))"]
    for c in spec.numeric:
        ctes.append(f"prep_{c} AS MATERIALIZED (SELECT any_value(m) AS m, any_value(lo) AS lo, any_value(hi) AS hi, avg(least(greatest(v, lo), hi)) AS mean, "
                    f"stddev_pop(least(greatest(v, lo), hi)) AS sd FROM (SELECT *, quantile_cont(v, 0.01) OVER () AS lo, quantile_cont(v, 0.99) OVER () AS hi "
                    f"FROM (SELECT coalesce({c}::DOUBLE, m) AS v, m FROM tr, (SELECT median({c}::DOUBLE) AS m FROM tr))))")
    parts = [f"(least(greatest(coalesce({c}::DOUBLE, prep_{c}.m), prep_{c}.lo), prep_{c}.hi) - prep_{c}.mean) / prep_{c}.sd" for c in spec.numeric]
    parts += [f"CAST({c} = '{v}' AS DOUBLE)" for c in spec.categorical for v in _LEVELS[c]] + ["1.0::DOUBLE"]
    ctes.append(f"xs AS MATERIALIZED (SELECT {src}.*, [{', '.join(parts)}] AS x FROM {src}, " + ", ".join(f"prep_{c}" for c in spec.numeric) + ")")
    ctes.append(f"xt AS MATERIALIZED (SELECT x, {spec.target}::DOUBLE AS y, count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY {spec.target})) AS w "
                f"FROM xs WHERE {spec.period} IN ({train}))")
    ctes.append(f"b0 AS MATERIALIZED (SELECT [{', '.join(['0.0::DOUBLE'] * k)}] AS b)")
    at = range(1, k + 1)
    for s in range(1, steps + 1):
        rows = ", ".join("[" + ", ".join([f"sum(w * p * (1 - p) * x[{r}] * x[{c}])" + (" + 1.0" if r == c < k else "") for c in at]
                                         + [f"sum(w * (y - p) * x[{r}])" + (f" - any_value(b)[{r}]" if r < k else "")]) + "]" for r in at)
        ctes.append(f"p{s} AS MATERIALIZED (SELECT x, y, w, b, 1 / (1 + exp(-list_dot_product(x, b))) AS p FROM xt, b{s - 1})")
        ctes.append(f"m{s}_0 AS MATERIALIZED (SELECT [{rows}] AS m FROM p{s})")
        for i in at:
            ctes.append(f"m{s}_{i} AS MATERIALIZED (SELECT list_transform(range(1, {k + 1}), lambda r: CASE WHEN r = {i} THEN list_transform(m[{i}], lambda v: v / m[{i}][{i}]) "
                        f"ELSE list_transform(range(1, {k + 2}), lambda c: m[r][c] - m[r][{i}] * m[{i}][c] / m[{i}][{i}]) END) AS m FROM m{s}_{i - 1})")
        ctes.append(f"b{s} AS MATERIALIZED (SELECT list_transform(range(1, {k + 1}), lambda r: b[r] + m[r][{k + 1}]) AS b FROM b{s - 1}, m{s}_{k})")
    ctes.append(f"fitted AS MATERIALIZED (SELECT b, [{', '.join(repr(n) for n in names)}] AS names FROM b{steps})")
    return ", ".join(ctes)


@register("model_comparison_lineitem")
def model_comparison_lineitem(spark, sf):
    """Logistic and two boosted-tree candidates on the
    temporal split; metrics per model and split, plus the champion flag."""
    _, metrics = TR.train_candidates(lineitem_panel(spark, sf), LINEITEM_SPEC)
    best = MD.choose_champion(metrics).select(F.col("model").alias("__best"))
    return (MD.metrics_long(metrics).join(best, F.col("model") == F.col("__best"), "left")
            .withColumn("is_champion", F.col("__best").isNotNull()).drop("__best"))


@register("top_features_lineitem",
          f"WITH {logistic_sql(LI, 'li', LINEITEM_SPEC)} SELECT names[i] AS feature, b[i] AS weight FROM fitted, range(1, 7) AS r(i)", ("weight",))
def top_features_lineitem(spark, sf):
    """Signed logistic coefficients with names, top 15 by |w|."""
    models, _ = TR.train_candidates(lineitem_panel(spark, sf), LINEITEM_SPEC,
                                    [MD.Candidate("logistic_regression", "logistic")])
    return MD.top_features(models["logistic_regression"], LINEITEM_SPEC, 15)


@register("batch_scoring_lineitem",
          f"WITH {logistic_sql(LI, 'li', LINEITEM_SPEC)}, sc AS (SELECT ship_month, 1 / (1 + exp(-list_dot_product(x, b))) AS p FROM xs, fitted) "
          "SELECT ship_month, CASE WHEN p < 0.35 THEN 'bajo' WHEN p < 0.65 THEN 'medio' ELSE 'alto' END AS risk_band, '1' AS model_version, "
          "CAST(0.5 AS DOUBLE) AS threshold, count(*) AS n, CAST(sum(CAST(p >= 0.5 AS INTEGER)) AS BIGINT) AS n_positive_class, "
          "avg(round(p, 4)) AS mean_probability FROM sc GROUP BY 1, 2", ("mean_probability",))
def batch_scoring_lineitem(spark, sf):
    """Score every lineitem row with the fitted logistic pipeline;
    probability (4 decimals), class from the unrounded probability, band."""
    panel = lineitem_panel(spark, sf)
    models, _ = TR.train_candidates(panel, LINEITEM_SPEC,
                                    [MD.Candidate("logistic_regression", "logistic")])
    scored = S.score_batch(panel, models["logistic_regression"], model_version="1",
                           keep=["ship_month"], prefix="return")
    return scored.groupBy("ship_month", "risk_band", "model_version", "threshold").agg(
        F.count(F.lit(1)).alias("n"), F.sum("return_prediction").alias("n_positive_class"),
        F.avg("return_probability").alias("mean_probability"))


def _orders_monitor_sql() -> str:
    fitted = f"{logistic_sql(OP, 'op', ORDERS_SPEC)}, scored AS MATERIALIZED (SELECT xs.*, 1 / (1 + exp(-list_dot_product(x, b))) AS prediction FROM xs, fitted)"
    feats = ORDERS_SPEC.numeric + ORDERS_SPEC.categorical
    drift = drift_sql(fitted, "scored", "order_month", ORDERS_SPEC.train_periods, ORDERS_SPEC.numeric + ("prediction",), ORDERS_SPEC.categorical,
                      "prediction AS z")
    return monthly_sql(drift, "order_month", "fulfilled", feats, ORDERS_SPEC.train_periods, regime_sql("order_month", ORDERS_REGIMES))


@register("monitor_panel_orders", _orders_monitor_sql(),
          ("drifted_columns_share", "prediction_drift_score", "roc_auc", "auc_delta", "reference_roc_auc"))
def monitor_panel_orders(spark, sf):
    """K6: train on the orders panel's train months, score all rows once and
    compare every later month with the reference."""
    panel = orders_panel(spark, sf)
    models, _ = TR.train_candidates(panel, ORDERS_SPEC,
                                    [MD.Candidate("logistic_regression", "logistic")])
    rec = TR.monitor_panel(panel, ORDERS_SPEC, models["logistic_regression"], ORDERS_REGIMES)
    return rec.withColumn("drifted_columns", F.array_join("drifted_columns", ", "))


@register("registry_champion_orders")
def registry_champion_orders(spark, sf):
    """Log runs, register the best model as a new version,
    move the champion alias, and describe the served model."""
    reg = Registry(spark, scratch_path(spark, f"registry-{_uuid.uuid4().hex}"))
    TR.train_and_register(orders_panel(spark, sf), ORDERS_SPEC, reg, "orders-model")
    info = reg.model_info("orders-model", features=ORDERS_SPEC.features)
    return info.select("name", "version", "algorithm",
                       F.map_keys("metrics").alias("metric_keys"),
                       "validation_roc_auc", "description", "features", "threshold")


@register("stream_scoring_lineitem",
          f"WITH {LI}, s AS (SELECT ship_month, {prob_sql(LINEITEM_CARD)} AS p FROM li) "
          f"SELECT ship_month, CASE WHEN p < 0.35 THEN 'bajo' WHEN p < 0.65 THEN 'medio' ELSE "
          f"'alto' END AS risk_band, count(*) AS n, avg(round(p, 4)) AS mean_probability, "
          f"CAST(sum(CAST(p >= 0.5 AS INTEGER)) AS BIGINT) AS n_positive_class FROM s GROUP BY 1, 2",
          ("mean_probability",))
def stream_scoring_lineitem(spark, sf):
    """K5: the lineitem file is read as a stream, validated, scored with the
    scorecard and written per micro-batch; the stream's output must equal
    the batch answer of ``scorecard_risk_bands_lineitem``."""
    schema = spark.read.parquet(f"{sf}/lineitem.parquet").schema
    out = scratch_path(spark, f"stream-{_uuid.uuid4().hex}")
    rules = LINEITEM_RULES[:-1]  # ship_month is derived after validation

    def scorer(df):
        df = df.withColumn("ship_month", F.date_format("l_shipdate", "yyyy-MM"))
        df = S.linear_score(df, LINEITEM_CARD, "score")
        return S.bands_from_probability(df, "score", prefix="return").select(
            "ship_month", "return_probability", "return_prediction", "risk_band")

    score_stream(spark, sf, schema, rules, scorer, out, glob="lineitem.parquet")
    return read_scored(spark, out).groupBy("ship_month", "risk_band").agg(
        F.count(F.lit(1)).alias("n"), F.avg("return_probability").alias("mean_probability"),
        F.sum("return_prediction").cast("bigint").alias("n_positive_class"))


_IO_MONTHS = ("1996-01", "1996-02", "1996-03", "1998-12")


@register("panel_roundtrip_orders",
          f"WITH {OP} SELECT order_month, count(*) AS n_rows, avg(fulfilled::DOUBLE) AS target_rate"
          f" FROM op WHERE order_month IN ({', '.join(repr(m) for m in _IO_MONTHS)}) GROUP BY 1",
          ("target_rate",))
def panel_roundtrip_orders(spark, sf):
    """A1-A3: write the panel partitioned by month, read back four months
    (partition pruning, missing-month check) and count them."""
    path = scratch_path(spark, f"panel-{_uuid.uuid4().hex}")
    IO.write_panel(orders_panel(spark, sf), path, ORDERS_SPEC)
    back = IO.load_panel(spark, path, ORDERS_SPEC, list(_IO_MONTHS))
    return P.period_counts(back, ORDERS_SPEC)


@register("column_drift_events",
          drift_sql(EV, "ev", "event_day", EVENTS_SPEC.train_periods, EVENTS_SPEC.numeric, (),
                    "1 AS one") + " SELECT * FROM cd", ("score", "threshold"))
def column_drift_events(spark, sf):
    """R4 on the daily events panel: each later day against the first week."""
    ev = events_panel(spark, sf)
    return D.column_drift(ev, "event_day", EVENTS_SPEC.numeric, [], EVENTS_SPEC.train_periods)


@register("column_drift_orders",
          drift_sql(OP, "op", "order_month", ORDERS_SPEC.train_periods,
                    ORDERS_SPEC.numeric, ORDERS_SPEC.categorical, "1 AS one")
          + " SELECT * FROM cd", ("score", "threshold"))
def column_drift_orders(spark, sf):
    """R4 + R5 on the orders panel: W1/sd for count, spend and balance, JS for
    priority and market segment, every month against the train months."""
    return D.column_drift(orders_panel(spark, sf), "order_month", ORDERS_SPEC.numeric,
                          ORDERS_SPEC.categorical, ORDERS_SPEC.train_periods)


def chi_drift_sql(panel_cte: str, src: str, period: str, reference, categorical) -> str:
    """Oracle for R6: each period's counts and the reference's as a table of two rows over all values of either."""
    ref_sql = ", ".join(f"'{m}'" for m in reference)
    cat = " UNION ALL ".join(f"SELECT {period}, '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM {src} WHERE {c} IS NOT NULL" for c in categorical)
    return (
        f"WITH {panel_cte}, cat AS ({cat}), "
        f"refc AS (SELECT \"column\", value, count(*) AS n FROM cat WHERE {period} IN ({ref_sql}) GROUP BY 1, 2), "
        f"curc AS (SELECT {period}, \"column\", value, count(*) AS n FROM cat WHERE {period} NOT IN ({ref_sql}) GROUP BY 1, 2, 3), "
        f"grid AS (SELECT * FROM (SELECT DISTINCT {period}, \"column\" FROM curc) JOIN (SELECT DISTINCT \"column\", value FROM cat) USING (\"column\")), "
        f"o AS (SELECT g.{period}, g.\"column\", coalesce(r.n, 0) AS nr, coalesce(c.n, 0) AS nc FROM grid g LEFT JOIN refc r ON r.\"column\" = g.\"column\" "
        f"AND r.value = g.value LEFT JOIN curc c ON c.{period} = g.{period} AND c.\"column\" = g.\"column\" AND c.value = g.value "
        f"WHERE r.n IS NOT NULL OR c.n IS NOT NULL), "
        f"e AS (SELECT *, (nr + nc) * sum(nr) OVER k / sum(nr + nc) OVER k AS er, (nr + nc) * sum(nc) OVER k / sum(nr + nc) OVER k AS ec "
        f"FROM o WINDOW k AS (PARTITION BY {period}, \"column\")), "
        f"st AS (SELECT {period}, \"column\", sum((nr - er) ** 2 / er + (nc - ec) ** 2 / ec) AS x0, count(*) - 1 AS dof FROM e GROUP BY 1, 2), "
        "tail AS (" + tail_sql("SELECT * FROM st WHERE dof > 0", f'{period}, "column"', CHI2_DENSITY, CHI2_WIDTH, 4_000) + ") "
        f"SELECT {period}, \"column\", 'chi_square' AS method, p AS score, CAST(0.05 AS DOUBLE) AS threshold, 'lower' AS direction, "
        f"coalesce(p < 0.05, true) AS drifted FROM st LEFT JOIN tail USING ({period}, \"column\")")


@register("column_drift_chi_square_orders",
          chi_drift_sql(OP, "op", "order_month", ORDERS_SPEC.train_periods, ORDERS_SPEC.categorical), ("score", "threshold"))
def column_drift_chi_square_orders(spark, sf):
    """Categorical drift by p-values, where a low value means drift."""
    return D.column_drift(orders_panel(spark, sf), "order_month", [], ORDERS_SPEC.categorical,
                          ORDERS_SPEC.train_periods, categorical_method="chi_square")


@register("panel_roundtrip_equality_lineitem",
          f"WITH {LI} SELECT 'only_left' AS side, (SELECT count(*) FROM (SELECT * FROM li "
          f"EXCEPT ALL SELECT * FROM li)) AS n UNION ALL SELECT 'only_right', (SELECT count(*) "
          f"FROM (SELECT * FROM li EXCEPT ALL SELECT * FROM li))")
def panel_roundtrip_equality_lineitem(spark, sf):
    """A3 + A1 + G4: the panel written partitioned by month and read back
    holds exactly the same multiset of rows."""
    panel = lineitem_panel(spark, sf)
    path = scratch_path(spark, f"panel-{_uuid.uuid4().hex}")
    IO.write_panel(panel, path, LINEITEM_SPEC)
    back = IO.load_panel(spark, path, LINEITEM_SPEC)
    return P.same_rows(panel, back.select(*panel.columns))


@register("same_rows_difference_lineitem",
          f"WITH {LI}, o AS (SELECT * FROM li WHERE l_tax > 0 UNION ALL SELECT * FROM li WHERE l_quantity = 1) "
          f"SELECT 'only_left' AS side, (SELECT count(*) FROM (SELECT * FROM li EXCEPT ALL SELECT * FROM o)) AS n "
          f"UNION ALL SELECT 'only_right', (SELECT count(*) FROM (SELECT * FROM o EXCEPT ALL SELECT * FROM li))")
def same_rows_difference_lineitem(spark, sf):
    """G4 on tables that differ: rows missing on one side and repeated on the other."""
    panel = lineitem_panel(spark, sf)
    other = panel.where("l_tax > 0").unionByName(panel.where("l_quantity = 1"))
    return P.same_rows(panel, other)


_PREP_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", any_value(m) AS median, any_value(lo) AS lower, any_value(hi) AS upper, "
    f"avg(least(greatest(x, lo), hi)) AS mean, stddev_pop(least(greatest(x, lo), hi)) AS sd FROM "
    f"(SELECT *, quantile_cont(x, 0.01) OVER () AS lo, quantile_cont(x, 0.99) OVER () AS hi FROM "
    f"(SELECT coalesce({c}::DOUBLE, m) AS x, m FROM t, (SELECT median({c}::DOUBLE) AS m FROM t)))" for c in LI_NUM)


@register("learned_numeric_preparation_lineitem",
          f"WITH {LI}, {_NULL_SQL}, t AS (SELECT * FROM n WHERE ship_month IN ({_LI_REF_SQL})) {_PREP_SQL}",
          ("median", "lower", "upper", "mean", "sd"))
def learned_numeric_preparation_lineitem(spark, sf):
    """M1-M3: what the numeric preparation learns on the train months, nulls included."""
    train = _lineitem_with_nulls(spark, sf).where(F.col("ship_month").isin(list(_LI_REF)))
    fit = FE.NumericPrep(inputCols=list(LI_NUM), outputCols=[f"{c}_p" for c in LI_NUM]).fit(train)
    rows = [(c, v["median"], v["lo"], v["hi"], v["mean"], v["sd"]) for c, v in fit.getStats().items()]
    return spark.createDataFrame(rows, '`column` string, median double, lower double, upper double, mean double, sd double')


_MODE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", (SELECT {c} FROM t WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {c} LIMIT 1) AS mode"
    for c in ORDERS_SPEC.categorical)


@register("learned_modes_orders",
          f"WITH {OP}, t AS (SELECT * FROM op WHERE order_month IN ({', '.join(repr(m) for m in ORDERS_SPEC.train_periods)})) {_MODE_SQL}")
def learned_modes_orders(spark, sf):
    """M4: the most frequent value of each categorical column on the train months."""
    train = orders_panel(spark, sf).where(F.col("order_month").isin(list(ORDERS_SPEC.train_periods)))
    cols = list(ORDERS_SPEC.categorical)
    fit = FE.ModeImputer(inputCols=cols, outputCols=[f"{c}_m" for c in cols]).fit(train)
    return spark.createDataFrame(list(fit.getStats().items()), "`column` string, mode string")


@register("drift_history_roundtrip_lineitem",
          f"WITH h AS ({_monthly_sql()}) SELECT month, regime, n_rows, drifted_columns_count, drifted_columns_share, "
          f"drifted_columns, prediction_drift_score, prediction_drift_detected, roc_auc, auc_delta, status FROM h",
          ("roc_auc", "auc_delta", "drifted_columns_share", "prediction_drift_score"))
def drift_history_roundtrip_lineitem(spark, sf):
    """A4 + A5: the history document written as JSON and read back with a
    fixed schema gives the monthly records again."""
    model = {"name": "lineitem-scorecard", "version": "1", "algorithm": "scorecard"}
    doc = D.history_document(monthly_drift_lineitem(spark, sf), model, _LI_REF, _MCFG)
    path = scratch_path(spark, f"history-{_uuid.uuid4().hex}")
    IO.write_drift_history(doc, path)
    back = IO.read_drift_history(spark, path)
    return back.drop("model_name", "model_version", "reference_roc_auc").withColumn(
        "drifted_columns", F.array_join("drifted_columns", ", "))


@register("drift_snapshot_extraction_orders",
          f"WITH {OP}, m AS (SELECT order_month AS period, avg(order_count) - 1 AS a, avg(total_spent) / 1e6 AS b, "
          f"count(*) % 2 = 0 AS even FROM op GROUP BY 1) "
          f"SELECT period, 'order_count' AS \"column\", round(a, 4) AS score, a > 0.1 AS drifted FROM m UNION ALL "
          f"SELECT period, 'total_spent', round(b, 4), CASE WHEN even THEN true ELSE b > 0.1 END FROM m", ("score",))
def drift_snapshot_extraction_orders(spark, sf):
    """B13 + C3: snapshots written as JSON (one per month, some metrics untested, of another
    kind or without a number) and their verdicts extracted."""
    m = orders_panel(spark, sf, with_customer=False).groupBy("order_month").agg(
        (F.avg("order_count") - 1).alias("a"), (F.avg("total_spent") / 1e6).alias("b"), F.count(F.lit(1)).alias("n"))

    def metric(name, kind, column, value):
        return F.struct(F.lit(name).alias("id"), F.struct(F.lit(kind).alias("type"), F.lit(column).alias("column"))
                        .alias("config"), value.alias("value"))

    def test(name, status):
        return F.struct(F.struct(F.lit(name).alias("metric_id")).alias("metric_config"), status.alias("status"))

    docs = m.select(F.col("order_month").alias("period"), F.array(
        metric("m1", "x:ValueDrift", "order_count", F.col("a").cast("string")),
        metric("m2", "x:ValueDrift", "total_spent", F.col("b").cast("string")),
        metric("m3", "x:DriftedColumnsCount", "total_spent", F.lit("3")),
        metric("m4", "x:ValueDrift", "c_acctbal", F.lit("n/a"))).alias("metrics"),
        F.when(F.col("n") % 2 == 0, F.array(test("m2", F.lit("FAIL")), test("m9", F.lit("FAIL")))).otherwise(
            F.array(test("m9", F.lit("SUCCESS")))).alias("tests"))
    path = scratch_path(spark, f"snapshots-{_uuid.uuid4().hex}")
    docs.write.json(path)
    return IO.snapshot_column_drift(IO.read_drift_snapshots(spark, path))


# A fixed scorecard for the events panel (value and the JSON field k).
EVENTS_CARD = S.Scorecard(intercept=-1.4, numeric={"value": (10.0, 6.0, 0.3),
                                                   "prop_k": (50.0, 29.0, -0.2)})
_EV_REG = regime_sql("event_day", EVENTS_REGIMES)


@register("daily_drift_status_events",
          monthly_sql(drift_sql(EV, "ev", "event_day", EVENTS_SPEC.train_periods,
                                EVENTS_SPEC.numeric + ("prediction",), (),
                                f"{prob_sql(EVENTS_CARD)} AS prediction, "
                                f"{card_sql(EVENTS_CARD)} AS z"),
                      "event_day", "is_error", EVENTS_SPEC.numeric, EVENTS_SPEC.train_periods,
                      _EV_REG),
          ("drifted_columns_share", "prediction_drift_score", "roc_auc", "auc_delta",
           "reference_roc_auc"))
def daily_drift_status_events(spark, sf):
    """R3-R10 on the daily events panel: every day after the first week
    against that week, with a stated scorecard as the model."""
    ev = S.linear_score(events_panel(spark, sf), EVENTS_CARD, "score", z_out="z")
    rec = D.monthly_drift(ev, EVENTS_SPEC, EVENTS_SPEC.train_periods, EVENTS_REGIMES, cfg=_MCFG)
    return rec.withColumn("drifted_columns", F.array_join("drifted_columns", ", "))


# ================================================================== stored profiles, empty columns
from panelwatch.sources import profile_store as PS  # noqa: E402

_LAST_MONTHS = ("1998-10", "1998-11")


@register("column_drift_from_profiles_lineitem", _drift_sql() + " SELECT * FROM cd", ("score", "threshold"))
def column_drift_from_profiles_lineitem(spark, sf):
    """The profiles of the reference months are stored first, all others later; the stored counts
    give the same drift as the rows."""
    scored = _scored_li(spark, sf).withColumnRenamed("score", "prediction")
    cfg = D.MonitorConfig(rank_score="z")
    path = scratch_path(spark, f"profiles-{_uuid.uuid4().hex}")
    PS.store_profiles(scored, LINEITEM_SPEC, path, _LI_REF, cfg)
    PS.store_profiles(scored.where(~F.col("ship_month").isin(list(_LI_REF))), LINEITEM_SPEC, path, cfg=cfg)
    return D.drift_from_counts(PS.read_profiles(spark, LINEITEM_SPEC, path), "ship_month", _LI_REF)


@register("monitor_new_months_lineitem",
          f"SELECT * FROM ({_monthly_sql()}) AS m WHERE month IN ('1998-10', '1998-11')",
          ("drifted_columns_share", "prediction_drift_score", "roc_auc", "auc_delta", "reference_roc_auc"))
def monitor_new_months_lineitem(spark, sf):
    """R2-R10 for two new months against stored profiles of the reference months: one month after the
    other is counted from its own rows only."""
    scored = _scored_li(spark, sf).withColumnRenamed("score", "prediction")
    cfg = D.MonitorConfig(rank_score="z")
    path = scratch_path(spark, f"profiles-{_uuid.uuid4().hex}")
    PS.store_profiles(scored, LINEITEM_SPEC, path, _LI_REF, cfg)
    first = PS.monitor_new_periods(scored, LINEITEM_SPEC, path, _LAST_MONTHS[:1], _LI_REF, LINEITEM_REGIMES, cfg)
    second = PS.monitor_new_periods(scored, LINEITEM_SPEC, path, _LAST_MONTHS[1:], _LI_REF, LINEITEM_REGIMES, cfg)
    return first.unionByName(second).withColumn("drifted_columns", F.array_join("drifted_columns", ", "))


# Fixed values of this example: columns that are empty in a month, or in the reference.
_GAPS = {"l_discount": ("1998-03",), "l_linestatus": ("1998-04",), "l_tax": _LI_REF}
_GAP_SQL = ", ".join("CASE WHEN ship_month IN ({}) THEN NULL ELSE {} END AS {}".format(", ".join(f"'{m}'" for m in ms), c, c)
                     for c, ms in _GAPS.items())


@register("column_drift_gaps_lineitem",
          drift_sql(f"{LI}, lg AS (SELECT * REPLACE ({_GAP_SQL}) FROM li)", "lg", "ship_month", _LI_REF, LI_NUM, ("l_linestatus",), "1 AS one")
          + ", every AS (SELECT DISTINCT ship_month FROM li WHERE ship_month NOT IN ("
          + ", ".join(f"'{m}'" for m in _LI_REF) + ")), cols(\"column\", method) AS (VALUES "
          + ", ".join(f"('{c}', '{'jensenshannon' if c == 'l_linestatus' else 'wasserstein'}')" for c in (*LI_NUM, "l_linestatus"))
          + ") SELECT ship_month, \"column\", method, score, CAST(0.1 AS DOUBLE) AS threshold, 'higher' AS direction, "
          "coalesce(drifted, true) AS drifted FROM (SELECT * FROM every CROSS JOIN cols) AS g LEFT JOIN cd USING (ship_month, \"column\", method)",
          ("score", "threshold"))
def column_drift_gaps_lineitem(spark, sf):
    """R3-R5 with empty columns: a month without any discount, a month without line status and a reference without
    tax keep their rows, with a null score that counts as drift."""
    li = lineitem_panel(spark, sf)
    for c, months in _GAPS.items():
        li = li.withColumn(c, F.when(~F.col("ship_month").isin(list(months)), F.col(c)))
    return D.column_drift(li, "ship_month", LI_NUM, ["l_linestatus"], _LI_REF)


# ================================================================== opt-in binned mode
from panelwatch.operators import binned as BN  # noqa: E402
from panelwatch.operators.quantiles import value_counts  # noqa: E402
from panelwatch.operators.scan import Scan, ordered_scan  # noqa: E402
from panelwatch.session import materialize  # noqa: E402

_BOUND_PROBS = (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)


def _binned_li(spark, sf):
    scored = _scored_li(spark, sf).withColumnRenamed("score", "prediction")
    edges = BN.reference_edges(scored.where(F.col("ship_month").isin(list(_LI_REF))), [*LI_NUM, "z"], 32)
    return scored, BN.binned_counts(scored, "ship_month", edges, "returned")


def _holds(lower: str, value: str, upper: str):
    return ((F.col(value) >= F.col(lower) - 1e-9) & (F.col(value) <= F.col(upper) + 1e-9)).alias("holds")


@register("binned_drift_bounds_lineitem",
          drift_sql(LI, "li", "ship_month", _LI_REF, LI_NUM, (), "1 AS one")
          + ' SELECT ship_month, "column", w1, true AS holds FROM w1', ("w1",))
def binned_drift_bounds_lineitem(spark, sf):
    """R4 in binned mode: the exact W1 of every month and column lies between the bounds from 32 bins."""
    scored, table = _binned_li(spark, sf)
    bounds = BN.wasserstein_bounds(materialize(table.where("column <> 'z'")), "ship_month", _LI_REF)
    exact = D.wasserstein_by_period(P.unpivot_numeric(scored, LI_NUM, keep=["ship_month"]), "ship_month", _LI_REF)
    return exact.join(bounds, ["ship_month", "column"]).select("ship_month", "column", "w1", _holds("lower", "w1", "upper"))


@register("binned_auc_bounds_lineitem",
          f"SELECT ship_month, roc_auc, CASE WHEN roc_auc IS NOT NULL THEN true END AS holds FROM ({_eval_sql('ship_month')}) AS e", ("roc_auc",))
def binned_auc_bounds_lineitem(spark, sf):
    """M15 in binned mode: every month's exact AUC lies between the bounds from 32 score bins."""
    scored, table = _binned_li(spark, sf)
    bounds = BN.auc_bounds(table.where("column = 'z'"), ["ship_month"]).drop("column")
    exact = M.ranking_metrics(scored, ["ship_month"], "z", "returned")
    return exact.join(bounds, "ship_month").select("ship_month", "roc_auc", _holds("lower", "roc_auc", "upper"))


@register("binned_quantile_bounds_lineitem",
          f"WITH {LI}, {LI_LONG}, v AS (SELECT \"column\", value, row_number() OVER (PARTITION BY \"column\" ORDER BY value) - 1 AS r, "
          f"count(*) OVER (PARTITION BY \"column\") AS n FROM li_long WHERE value IS NOT NULL) "
          f"SELECT \"column\", p AS prob, n, value, true AS holds, true AS within_rank_error FROM v, "
          f"(VALUES {', '.join(f'({p!r}::DOUBLE)' for p in _BOUND_PROBS)}) AS q(p) WHERE r = floor(p * (n - 1))", ("prob", "value"))
def binned_quantile_bounds_lineitem(spark, sf):
    """D7/M2 in binned mode: monthly tables merged over all months; the exact value at each rank lies between the bounds,
    and both bounds' ranks lie within the stated error of it."""
    scored, table = _binned_li(spark, sf)
    bounds = materialize(BN.quantile_bounds(table.where("column <> 'z'"), [], _BOUND_PROBS))
    counts = materialize(value_counts(P.unpivot_numeric(scored, LI_NUM), ["column"], "value"))
    rank = F.floor(F.col("prob") * (F.col("n") - 1))
    # one row per (column, prob) on the small side: counted rows stay where they are, no column in one task
    at = counts.join(F.broadcast(bounds), "column").groupBy("column", "prob", "n", "lower", "upper", "rank_error").agg(
        F.sum(F.when(F.col("__v") < F.col("lower"), F.col("__c")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("__v") <= F.col("upper"), F.col("__c")).otherwise(0)).alias("upto"))
    near = (rank - F.col("below") <= F.col("rank_error") * F.col("n")) | (F.col("rank_error") == 0)
    near = near & ((F.col("upto") - 1 - rank <= F.col("rank_error") * F.col("n")) | (F.col("rank_error") == 0))
    scan = ordered_scan(counts, ["column"], ["__v"], [Scan("cum", "sum", "__c")])
    value = scan.join(F.broadcast(at), "column").where((rank < F.col("cum")) & (rank >= F.col("cum") - F.col("__c")))
    return value.select("column", "prob", "n", F.col("__v").alias("value"), _holds("lower", "__v", "upper"), near.alias("within_rank_error"))
