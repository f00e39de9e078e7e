"""Queries: cleaning rules, labels, keys."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions import scalar as S
from keelson.operators import clean as C
from keelson.operators.keys import keep_latest, key_counts
from keelson.operators.ranks import with_file_ordinal, with_ordinal
from keelson.plans.common import EVENT_RULES, EVENTS_CLEAN_SQL, LINE_RULES, r6, table
from keelson.session import shared_path
from keelson.spec import CleaningRules


def clean_text_customer(spark, d):
    padded = table(spark, d, "customer").withColumn("c_mktsegment", F.concat(F.lit("\t "), "c_mktsegment", F.lit(" \n")))
    cleaned = C.normalize_text(padded, ["c_mktsegment", "absent"], ["Household", ""])
    return cleaned.select("c_custkey", "c_mktsegment")


CLEAN_TEXT_SQL = """SELECT c_custkey, CASE WHEN lower(c_mktsegment) <> 'household' THEN c_mktsegment END AS c_mktsegment FROM customer"""


def null_tokens_orders(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", S.drop_tokens(F.col("o_orderpriority"), ["4-NOT SPECIFIED", "NA", ""]).alias("priority"),
        S.drop_tokens(F.col("o_orderstatus"), ["P"]).alias("status"))


NULL_TOKENS_SQL = """SELECT o_orderkey, CASE WHEN o_orderpriority NOT IN ('4-NOT SPECIFIED', 'NA', '') THEN o_orderpriority END AS priority,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status FROM orders"""


def coerce_numeric_props(spark, d):
    text = table(spark, d, "events").select(
        "event_id", F.regexp_extract("props", r': ?"?([^"}]*)', 1).alias("k"), F.col("props").alias("whole"),
        F.concat(F.lit(" "), F.col("value").cast("string"), F.lit("\t")).alias("padded"),
        F.concat(F.col("user_id").cast("string"), F.lit("d")).alias("suffixed"))
    return C.coerce_numbers(text, ["k", "whole", "padded", "suffixed", "absent"])


COERCE_SQL = """SELECT event_id, CAST(regexp_extract(props, ': ?"?([^"}]*)', 1) AS DOUBLE) AS k, CAST(NULL AS DOUBLE) AS whole,
       value AS padded, CAST(NULL AS DOUBLE) AS suffixed FROM events"""


def sentinel_counts_lineitem(spark, d):
    columns = ["l_quantity", "l_extendedprice", "l_discount"]
    _, report = C.replace_sentinels(table(spark, d, "lineitem"), columns, [1.0, 0.05])
    return report.select("column_name", F.array_join(F.transform("sentinel_values", lambda x: x.cast("string")), ",").alias("sentinel_values"),
                         "sentinel_replacement_count")


SENTINEL_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '1.0,0.05' AS sentinel_values, count(*) FILTER ({c} IN (1.0, 0.05)) AS sentinel_replacement_count FROM lineitem"
    for c in ("l_quantity", "l_extendedprice", "l_discount"))


def range_violations(spark, d):
    _, lines = C.apply_ranges(table(spark, d, "lineitem"), {"l_quantity": (2.0, 45.0), "l_tax": (0.01, 0.07), "absent": (0.0, 1.0)})
    _, accounts = C.apply_ranges(table(spark, d, "customer"), {"c_acctbal": (0.0, 9000.0)})
    return lines.unionByName(accounts)


RANGE_SQL = """SELECT 'l_quantity' AS column_name, 2.0::DOUBLE AS minimum, 45.0::DOUBLE AS maximum, count(*) FILTER (l_quantity NOT BETWEEN 2 AND 45) AS invalid_value_count FROM lineitem
UNION ALL SELECT 'l_tax', 0.01, 0.07, count(*) FILTER (l_tax NOT BETWEEN 0.01 AND 0.07) FROM lineitem
UNION ALL SELECT 'c_acctbal', 0.0, 9000.0, count(*) FILTER (c_acctbal NOT BETWEEN 0 AND 9000) FROM customer"""


def event_time_fallback(spark, d):
    """Orders with status P have no readable date: they get the start time plus their row position in seconds."""
    raw = table(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", F.lit("unknown")).otherwise(
            F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("source_time"))
    placed = with_ordinal(raw, ["o_orderkey"], "position")
    rules = CleaningRules(entity_key="o_orderkey", event_time="event_time", source_time="source_time")
    when = C.event_time(placed, rules, "position")
    return placed.select("o_orderkey", "position", when.cast("timestamp_ntz").alias("event_time"))


EVENT_TIME_SQL = """WITH p AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS position FROM orders)
SELECT o_orderkey, position, CASE WHEN o_orderstatus = 'P' THEN TIMESTAMP '2024-01-01' + to_seconds(position) ELSE o_orderdate END AS event_time FROM p"""


def file_positions(spark, d):
    placed = with_file_ordinal(table(spark, d, "part"), "position")
    return placed.select("p_partkey", "position")


FILE_POSITIONS_SQL = "SELECT p_partkey, row_number() OVER () - 1 AS position FROM part"


def label_construction(spark, d):
    """Latest line of every order with its label: the sum of three cleaned components."""
    result = C.clean(_lines(spark, d), LINE_RULES, "ordinal").shared()
    return result.labels.withColumn("line_total", r6("line_total"))


def _lines(spark, d):
    # order and line number do not identify a row in the test tables: all columns decide
    lines = table(spark, d, "lineitem")
    return lines.withColumn("ordinal", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                                                "l_discount", "l_tax"))


LINES_SQL = """
s AS (SELECT *, CASE WHEN l_quantity <> 1 THEN l_quantity END AS q0, CASE WHEN l_extendedprice <> 1 THEN l_extendedprice END AS e0,
             CASE WHEN l_tax <> 1 THEN l_tax END AS t0 FROM lineitem),
r AS (SELECT *, CASE WHEN q0 BETWEEN 1 AND 45 THEN q0 END AS q, CASE WHEN e0 BETWEEN 1000 AND 100000 THEN e0 END AS e,
             CASE WHEN t0 BETWEEN 0 AND 0.07 THEN t0 END AS t FROM s),
l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC,
             l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC) AS rn FROM r)"""
LABEL_SQL = f"""WITH {LINES_SQL}
SELECT l_orderkey, l_shipdate AS event_time, round(q + e + t, 6) AS line_total FROM l
WHERE rn = 1 AND q IS NOT NULL AND e IS NOT NULL AND t IS NOT NULL"""


def cleaning_summary(spark, d):
    one = C.clean(table(spark, d, "events"), EVENT_RULES, "event_id").write(shared_path(spark, "cleaned")).summary()
    return one.select("*", (F.col("initial_rows") - F.col("missing_key_rows_removed") - F.col("duplicate_key_rows_removed")
                            - F.col("bad_label_rows_removed") == F.col("final_rows")).alias("reconciles")).withColumns(
        {c: r6(c) for c in ("label_mean", "label_median")})


CLEANING_SUMMARY_SQL = f"""WITH {EVENTS_CLEAN_SQL}
SELECT (SELECT count(*) FROM events) AS initial_rows, (SELECT count(*) FROM events WHERE user_id IS NULL) AS missing_key_rows_removed,
  (SELECT count(*) - count(DISTINCT user_id) FROM events) AS duplicate_key_rows_removed,
  count(*) FILTER (v IS NULL) AS bad_label_rows_removed, count(v) AS final_rows, 7 AS final_columns,
  (SELECT count(*) FILTER (is_sentinel) FROM marked) AS sentinels_replaced, min(v) AS label_min, max(v) AS label_max,
  round(avg(v), 6) AS label_mean, count(*) FILTER (v IS NOT NULL AND kind IS NULL) AS missing_predictor_cells,
  round(median(v), 6) AS label_median, true AS reconciles FROM dedup"""


def cleaning_counts(spark, d):
    """Sentinel and range counts of the whole cleaning job, over all raw rows."""
    result = C.clean(_lines(spark, d), LINE_RULES, "ordinal").write(shared_path(spark, "cleaned"))
    a = result.sentinel_report().select(F.lit("sentinel").alias("rule"), "column_name", F.col("sentinel_replacement_count").alias("n"))
    b = result.range_report().select(F.lit("range").alias("rule"), "column_name", F.col("invalid_value_count").alias("n"))
    return a.unionByName(b)


CLEANING_COUNTS_SQL = f"""WITH {LINES_SQL}
SELECT 'sentinel' AS rule, 'l_quantity' AS column_name, count(*) FILTER (l_quantity = 1) AS n FROM lineitem
UNION ALL SELECT 'sentinel', 'l_extendedprice', count(*) FILTER (l_extendedprice = 1) FROM lineitem
UNION ALL SELECT 'sentinel', 'l_tax', count(*) FILTER (l_tax = 1) FROM lineitem
UNION ALL SELECT 'range', 'l_quantity', count(*) FILTER (q0 NOT BETWEEN 1 AND 45) FROM r
UNION ALL SELECT 'range', 'l_extendedprice', count(*) FILTER (e0 NOT BETWEEN 1000 AND 100000) FROM r
UNION ALL SELECT 'range', 'l_tax', count(*) FILTER (t0 NOT BETWEEN 0 AND 0.07) FROM r
UNION ALL SELECT 'range', 'l_discount', count(*) FILTER (l_discount NOT BETWEEN 0 AND 0.09) FROM r"""


def cleaned_events(spark, d):
    return C.clean(table(spark, d, "events"), EVENT_RULES, "event_id").data


CLEANED_EVENTS_SQL = f"""WITH {EVENTS_CLEAN_SQL}
SELECT user_id, ts, kind AS event_type, v AS value, props, ts AS event_time, v AS amount FROM dedup WHERE v IS NOT NULL"""


def predictors_events(spark, d):
    """The cleaned table without the label and its components."""
    return C.clean(table(spark, d, "events"), EVENT_RULES, "event_id").predictors


PREDICTORS_SQL = f"""WITH {EVENTS_CLEAN_SQL}
SELECT user_id, ts, kind AS event_type, props, ts AS event_time FROM dedup WHERE v IS NOT NULL"""


def latest_event_per_user(spark, d):
    return keep_latest(table(spark, d, "events"), "user_id", "ts", "event_id")


LATEST_EVENT_SQL = """SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"""


def latest_order_per_customer(spark, d):
    return keep_latest(table(spark, d, "orders"), "o_custkey", "o_orderdate", "o_orderkey").drop("o_orderpriority")


LATEST_ORDER_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1"""


def key_counts_orders(spark, d):
    return key_counts(table(spark, d, "orders"), "o_custkey")


KEY_COUNTS_SQL = """WITH k AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)
SELECT sum(n)::BIGINT AS row_count, coalesce(sum(n) FILTER (o_custkey IS NULL), 0)::BIGINT AS missing_keys, count(o_custkey) AS distinct_keys,
  sum(n - 1) FILTER (o_custkey IS NOT NULL)::BIGINT AS superseded_rows, coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS duplicated_key_rows FROM k"""


def parsed_times(spark, d):
    """Times read from text in two formats; unreadable text is missing."""
    text = table(spark, d, "orders").select("o_orderkey", F.when(
        F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "dd/MM/yyyy")).when(
        F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("n.a.").alias("t"))
    return text.select("o_orderkey", S.to_time(F.col("t"), T.StringType(), ["dd/MM/yyyy"]).cast("timestamp_ntz").alias("parsed"))


PARSED_TIMES_SQL = """SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'O') THEN date_trunc('day', o_orderdate)::TIMESTAMP END AS parsed FROM orders"""

QUERIES = {
    "clean_text_customer": (clean_text_customer, CLEAN_TEXT_SQL),
    "null_tokens_orders": (null_tokens_orders, NULL_TOKENS_SQL),
    "coerce_numeric_props": (coerce_numeric_props, COERCE_SQL),
    "sentinel_counts_lineitem": (sentinel_counts_lineitem, SENTINEL_SQL),
    "range_violations": (range_violations, RANGE_SQL),
    "parsed_times": (parsed_times, PARSED_TIMES_SQL),
    "event_time_fallback": (event_time_fallback, EVENT_TIME_SQL),
    "file_positions": (file_positions, FILE_POSITIONS_SQL),
    "label_construction": (label_construction, LABEL_SQL),
    "cleaning_summary": (cleaning_summary, CLEANING_SUMMARY_SQL),
    "cleaning_counts": (cleaning_counts, CLEANING_COUNTS_SQL),
    "cleaned_events": (cleaned_events, CLEANED_EVENTS_SQL),
    "predictors_events": (predictors_events, PREDICTORS_SQL),
    "latest_event_per_user": (latest_event_per_user, LATEST_EVENT_SQL),
    "latest_order_per_customer": (latest_order_per_customer, LATEST_ORDER_SQL),
    "key_counts_orders": (key_counts_orders, KEY_COUNTS_SQL),
}
