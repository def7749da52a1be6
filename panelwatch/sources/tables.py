"""Panels built from the driver's star-schema tables.

Each builder only maps columns to panel roles (period, id, target, features);
no operator work happens here.  Column pruning and predicate pushdown reach
the Parquet scan because everything stays declarative.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwatch.functions.scalar import json_number
from panelwatch.spec import PanelSpec, RegimeSpec


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# lineitem: one row per order line, monthly by ship date, target = returned.
LINEITEM_SPEC = PanelSpec(
    period="ship_month",
    id="l_orderkey",
    target="returned",
    numeric=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    categorical=("l_linestatus",),
    train_periods=tuple(f"1995-{m:02d}" for m in range(1, 7)),
    validation_periods=("1995-07", "1995-08"),
)
LINEITEM_REGIMES = RegimeSpec(start="1995-01")


def lineitem_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.date_format("l_shipdate", "yyyy-MM").alias("ship_month"),
        "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_linestatus", "l_returnflag",
        (F.col("l_returnflag") == F.lit("R")).cast("int").alias("returned"),
    )


# orders + customer: one row per customer and order month.
ORDERS_SPEC = PanelSpec(
    period="order_month",
    id="o_custkey",
    target="fulfilled",
    numeric=("order_count", "total_spent", "c_acctbal"),
    categorical=("top_priority", "c_mktsegment"),
    train_periods=tuple(f"1995-{m:02d}" for m in range(1, 7)),
    validation_periods=("1995-07", "1995-08"),
)
ORDERS_REGIMES = RegimeSpec(start="1995-01")


def orders_panel(spark: SparkSession, sf_dir: str, with_customer: bool = True) -> DataFrame:
    """Orders are aggregated per (customer, month) before the customer join,
    so the join sees the smaller side; AQE picks broadcast or sort-merge by
    the measured size of each side.  ``with_customer=False`` skips the join
    for work that uses no customer column (Spark cannot drop a left join by
    itself, as it does not know the customer key is unique)."""
    o = read_table(spark, sf_dir, "orders")
    per = (o.groupBy("o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("order_month"))
           .agg(F.count(F.lit(1)).cast("int").alias("order_count"),
                F.sum("o_totalprice").alias("total_spent"),
                F.min("o_orderpriority").alias("top_priority"),
                F.max((F.col("o_orderstatus") == F.lit("F")).cast("int")).alias("fulfilled")))
    if not with_customer:
        return per.select("o_custkey", "order_month", "order_count", "total_spent",
                          "top_priority", "fulfilled")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return (per.join(c, per["o_custkey"] == c["c_custkey"], "left")
            .select("o_custkey", "order_month", "order_count", "total_spent", "c_acctbal",
                    "top_priority", "c_mktsegment", "fulfilled"))


# events: one row per event, daily, target = error event.
EVENTS_SPEC = PanelSpec(
    period="event_day",
    id="user_id",
    target="is_error",
    numeric=("value", "prop_k"),
    categorical=(),
    train_periods=tuple(f"2024-01-{d:02d}" for d in range(1, 8)),
    validation_periods=("2024-01-08", "2024-01-09"),
)
EVENTS_REGIMES = RegimeSpec(start="2024-01-01", starts=(0, 10, 20), unit="day")


def events_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return e.select(
        "event_id", "user_id",
        F.date_format("ts", "yyyy-MM-dd").alias("event_day"),
        "value", json_number("props", "$.k").alias("prop_k"),
        "event_type",
        (F.col("event_type") == F.lit("error")).cast("int").alias("is_error"),
    )
