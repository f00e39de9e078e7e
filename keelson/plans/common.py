"""Inputs shared by the registered queries.

The example entity is a customer: raw facts are its orders, features describe its history and account, and the label is
the value of its latest order. Other queries use events by user and line items by order.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.functions.scalar import clean_text, null_outside
from keelson.spec import CleaningRules, FeatureSpec

Query = Callable[[SparkSession, str], DataFrame]

TTL = timedelta(days=2)
LEAKAGE = ("latest_value",)
DERIVED = {
    "balance_squared": "pow(balance, 2)",
    "balance_per_order": "try_divide(balance, order_count)",
    "value_ratio": "try_divide(smallest_order, largest_order)",
}
V1 = FeatureSpec(
    version="v1", name="customer_features_v1", entity_key="c_custkey", event_time="event_time",
    numeric=("balance", "order_count", "smallest_order", "largest_order"), categorical=("segment", "priority"),
    features=("balance", "order_count", "smallest_order", "largest_order", "segment", "priority"), leakage=LEAKAGE)
V2 = FeatureSpec(
    version="v2", name="customer_features_v2", entity_key="c_custkey", event_time="event_time",
    numeric=(*V1.numeric, *DERIVED), categorical=V1.categorical, features=(*V1.features, *DERIVED), leakage=LEAKAGE,
    derived=DERIVED, parent="v1")

EVENT_RULES = CleaningRules(
    entity_key="user_id", event_time="event_time", source_time="ts", components=("value",), label="amount",
    sentinels=(6.55,), numeric=("value",), categorical=("event_type",), no_answer=("Error",),
    ranges={"value": (1.0, 100.0)})

LINE_RULES = CleaningRules(
    entity_key="l_orderkey", event_time="event_time", source_time="l_shipdate",
    components=("l_quantity", "l_extendedprice", "l_tax"), label="line_total", sentinels=(1.0,),
    numeric=("l_quantity", "l_extendedprice", "l_tax", "l_discount"), categorical=("l_returnflag",), no_answer=("n",),
    ranges={"l_quantity": (1.0, 45.0), "l_extendedprice": (1000.0, 100000.0), "l_tax": (0.0, 0.07),
            "l_discount": (0.0, 0.09)})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(c: Column | str) -> Column:
    """Six decimals: averages are summed in another order by every engine."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def rounded(df: DataFrame, columns, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer with orders. Rules make some balances and segments missing."""
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).cast("double").alias("order_count"), F.min("o_totalprice").alias("smallest_order"),
        F.max("o_totalprice").alias("largest_order"),
        F.max_by(F.struct("o_orderdate", "o_orderpriority", "o_totalprice"), F.struct("o_orderdate", "o_orderkey")).alias("last"))
    accounts = table(spark, sf_dir, "customer").select(
        "c_custkey", null_outside(F.col("c_acctbal"), 0.0, 9000.0).alias("balance"),
        clean_text(F.col("c_mktsegment"), ["household"]).alias("segment"))
    return accounts.join(orders, F.col("c_custkey") == F.col("o_custkey")).select(
        "c_custkey", F.col("last.o_orderdate").alias("event_time"), "balance", "order_count", "smallest_order",
        "largest_order", "segment", F.col("last.o_orderpriority").alias("priority"),
        F.col("last.o_totalprice").alias("latest_value"))


CUSTOMERS_SQL = """
customers AS (
  SELECT c_custkey, event_time, CASE WHEN c_acctbal BETWEEN 0 AND 9000 THEN c_acctbal END AS balance, order_count,
         smallest_order, largest_order, CASE WHEN lower(c_mktsegment) <> 'household' THEN c_mktsegment END AS segment,
         priority, latest_value
  FROM customer JOIN (
    SELECT o_custkey, count(*)::DOUBLE AS order_count, min(o_totalprice) AS smallest_order,
           max(o_totalprice) AS largest_order FROM orders GROUP BY o_custkey) a ON c_custkey = a.o_custkey
  JOIN (
    SELECT o_custkey, o_orderdate AS event_time, o_orderpriority AS priority, o_totalprice AS latest_value,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) l
    ON c_custkey = l.o_custkey AND rn = 1)"""

FEATURES_SQL = CUSTOMERS_SQL + """,
features AS (
  SELECT *, balance * balance AS balance_squared, balance / order_count AS balance_per_order,
         CASE WHEN largest_order <> 0 THEN smallest_order / largest_order END AS value_ratio FROM customers)"""

# exactly ceil(20 %) of the keys with the smallest hashes are test keys
SPLIT_SQL = """
split_of AS (
  SELECT c_custkey, CASE WHEN row_number() OVER (ORDER BY md5('42:' || c_custkey)) <= ceil(count(*) OVER () * 0.2)
                         THEN 'test' ELSE 'train' END AS split
  FROM (SELECT DISTINCT c_custkey FROM customers))"""

EVENTS_CLEAN_SQL = """
marked AS (SELECT *, value IN (6.55) AS is_sentinel, CASE WHEN value NOT IN (6.55) THEN value END AS v0 FROM events),
ruled AS (SELECT *, v0 NOT BETWEEN 1 AND 100 AS is_out, CASE WHEN v0 BETWEEN 1 AND 100 THEN v0 END AS v,
                 CASE WHEN lower(event_type) <> 'error' THEN event_type END AS kind FROM marked),
latest AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM ruled),
dedup AS (SELECT * FROM latest WHERE rn = 1)"""
