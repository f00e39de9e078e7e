"""Queries: profiles, summaries, histograms, fingerprints."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.functions.digest import fingerprint
from keelson.operators import profile as P
from keelson.plans.common import CUSTOMERS_SQL, FEATURES_SQL, SPLIT_SQL, DERIVED, V1, V2, customers, rounded, table
from keelson.operators.features import derive
from keelson.operators.split import split_entities


def overview_events(spark, d):
    return P.overview(table(spark, d, "events"), "user_id")


OVERVIEW_SQL = """WITH k AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id),
m AS (SELECT sum((event_id IS NULL)::INT + (ts IS NULL)::INT + (user_id IS NULL)::INT + (event_type IS NULL)::INT + (value IS NULL)::INT + (props IS NULL)::INT) AS cells, count(*) AS n FROM events)
SELECT m.n AS row_count, 6::BIGINT AS column_count, m.n - (SELECT count(*) FROM (SELECT DISTINCT * FROM events)) AS duplicate_rows,
  m.cells::BIGINT AS missing_cells, round(m.cells * 100.0 / (m.n * 6), 2)::DOUBLE AS missing_cell_percentage,
  (SELECT count(*) FROM events WHERE user_id IS NULL) AS missing_keys, (SELECT count(DISTINCT user_id) FROM events) AS distinct_keys,
  (SELECT coalesce(sum(n) FILTER (n > 1 AND user_id IS NOT NULL), 0)::BIGINT FROM k) AS duplicated_key_rows FROM m"""


def _ruled_orders(spark, d):
    orders = table(spark, d, "orders")
    return orders.withColumn("o_totalprice", F.when(F.col("o_totalprice").between(5000.0, 400000.0), F.col("o_totalprice"))) \
        .withColumn("o_orderpriority", F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")))


_RULED_SQL = """r AS (SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_totalprice BETWEEN 5000 AND 400000 THEN o_totalprice END AS o_totalprice,
  o_orderdate, CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS o_orderpriority FROM orders)"""
_ORDER_COLUMNS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
                  ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]
_PROFILE_SQL = " UNION ALL ".join(
    f"""SELECT {i}::INT AS column_position, '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null_count,
    count(*) - count({c}) AS missing_count, count(DISTINCT {c}) AS unique_count,
    round_even((count(*) - count({c})) * 100.0::DOUBLE / count(*), 2) AS missing_percentage FROM r"""
    for i, (c, t) in enumerate(_ORDER_COLUMNS))


def column_profile_orders(spark, d):
    return P.column_profile(_ruled_orders(spark, d))


COLUMN_PROFILE_SQL = f"WITH {_RULED_SQL} {_PROFILE_SQL}"


def most_missing_columns(spark, d):
    return P.missing_report(P.column_profile(_ruled_orders(spark, d)), top=3)


MOST_MISSING_SQL = f"""WITH {_RULED_SQL}, p AS ({_PROFILE_SQL})
SELECT column_position, column_name, missing_count, missing_percentage FROM p ORDER BY missing_percentage DESC, column_position LIMIT 3"""


def schema_report_orders(spark, d):
    return P.schema_report(_ruled_orders(spark, d))


SCHEMA_REPORT_SQL = f"""WITH {_RULED_SQL}, p AS ({_PROFILE_SQL})
SELECT column_position, column_name, data_type, missing_count > 0 AS has_missing, unique_count AS unique_non_null_values FROM p"""


def numeric_summary_lineitem(spark, d):
    return rounded(P.numeric_summary(table(spark, d, "lineitem")), ("mean", "std", "p25", "p50", "p75"))


NUMERIC_SUMMARY_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}::DOUBLE), 6) AS mean, round(stddev_samp({c}::DOUBLE), 6) AS std, min({c})::DOUBLE AS min,
    round(quantile_cont({c}::DOUBLE, 0.25), 6) AS p25, round(quantile_cont({c}::DOUBLE, 0.5), 6) AS p50,
    round(quantile_cont({c}::DOUBLE, 0.75), 6) AS p75, max({c})::DOUBLE AS max FROM lineitem"""
    for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"))


def categorical_summary_orders(spark, d):
    return P.categorical_summary(_ruled_orders(spark, d))


CATEGORICAL_SQL = f"WITH {_RULED_SQL} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, (SELECT count(DISTINCT {c}) FROM r) AS unique_count, (SELECT count(*) - count({c}) FROM r) AS missing_count,
    v AS most_frequent_value, n AS most_frequent_count FROM (SELECT {c} AS v, count(*) AS n FROM r GROUP BY {c} ORDER BY n DESC, (v IS NULL), v LIMIT 1)"""
    for c in ("o_orderstatus", "o_orderpriority"))


def categorical_summary_documents(spark, d):
    return P.categorical_summary(table(spark, d, "documents"), ["lang", "source", "text"]).select(
        "column_name", "unique_count", "missing_count", F.md5(F.col("most_frequent_value").cast("binary")).alias("most_frequent_md5"),
        "most_frequent_count")


CATEGORICAL_DOCUMENTS_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, (SELECT count(DISTINCT {c}) FROM documents) AS unique_count, (SELECT count(*) - count({c}) FROM documents) AS missing_count,
    md5(v) AS most_frequent_md5, n AS most_frequent_count FROM (SELECT {c} AS v, count(*) AS n FROM documents GROUP BY {c} ORDER BY n DESC, (v IS NULL), v LIMIT 1)"""
    for c in ("lang", "source", "text"))


def histogram_value(spark, d):
    return rounded(P.histogram(table(spark, d, "events"), "value", 40), ("bin_low", "bin_high", "density"))


HISTOGRAM_SQL = """WITH b AS (SELECT min(value) AS lo, max(value) AS hi, count(value) AS total FROM events),
c AS (SELECT least(floor((value - lo) / (hi - lo) * 40)::INT + 1, 40) AS bin, count(*) AS n FROM events, b GROUP BY 1)
SELECT g.bin::INT AS bin, round(lo + (hi - lo) / 40 * (g.bin - 1), 6) AS bin_low, round(lo + (hi - lo) / 40 * g.bin, 6) AS bin_high,
  coalesce(n, 0) AS n, round(coalesce(n, 0)::DOUBLE / (total * ((hi - lo) / 40)), 6) AS density
FROM (SELECT unnest(range(1, 41)) AS bin) g CROSS JOIN b LEFT JOIN c ON c.bin = g.bin"""


def histogram_price_by_flag(spark, d):
    return rounded(P.histogram(table(spark, d, "lineitem"), "l_extendedprice", 50, "l_returnflag"), ("bin_low", "bin_high", "density"))


HISTOGRAM_SERIES_SQL = """WITH b AS (SELECT l_returnflag AS series, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, count(*) AS total FROM lineitem GROUP BY 1),
c AS (SELECT series, least(floor((l_extendedprice - lo) / (hi - lo) * 50)::INT + 1, 50) AS bin, count(*) AS n FROM lineitem JOIN b ON l_returnflag = series GROUP BY 1, 2)
SELECT b.series, g.bin::INT AS bin, round(lo + (hi - lo) / 50 * (g.bin - 1), 6) AS bin_low, round(lo + (hi - lo) / 50 * g.bin, 6) AS bin_high,
  coalesce(n, 0) AS n, round(coalesce(n, 0)::DOUBLE / (total * ((hi - lo) / 50)), 6) AS density
FROM (SELECT unnest(range(1, 51)) AS bin) g CROSS JOIN b LEFT JOIN c ON c.bin = g.bin AND c.series = b.series"""


def shared_range_prices(spark, d):
    lines = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return P.shared_range(lines.withColumn("guess", F.col("p_retailprice") * F.col("l_quantity")), "l_extendedprice", "guess")


SHARED_RANGE_SQL = """SELECT least(min(l_extendedprice), min(p_retailprice * l_quantity)) AS low, greatest(max(l_extendedprice), max(p_retailprice * l_quantity)) AS high
FROM lineitem JOIN part ON l_partkey = p_partkey"""


def time_range_tables(spark, d):
    return P.time_range([(table(spark, d, "events"), "ts"), (table(spark, d, "orders"), "o_orderdate"),
                         (table(spark, d, "lineitem"), "l_shipdate")])


TIME_RANGE_SQL = """SELECT min(t) - INTERVAL 1 SECOND AS start_time, max(t) + INTERVAL 1 SECOND AS end_time FROM (
  SELECT ts AS t FROM events UNION ALL SELECT o_orderdate FROM orders UNION ALL SELECT l_shipdate FROM lineitem)"""


def group_counts_events(spark, d):
    return P.group_counts(table(spark, d, "events"), ["event_type"], "user_id")


GROUP_COUNTS_SQL = "SELECT event_type, count(*) AS row_count, count(DISTINCT user_id) AS key_count FROM events GROUP BY event_type"


def target_stats_by_split(spark, d):
    base = customers(spark, d)
    split, _ = split_entities(base, "c_custkey", 0.2, 42)
    return rounded(P.target_statistics(split.assign(base), "latest_value", "split"), ("mean", "median", "std"))


TARGET_STATS_SQL = f"""WITH {CUSTOMERS_SQL}, {SPLIT_SQL}
SELECT coalesce(split, 'all') AS population, count(latest_value) AS count, round(avg(latest_value), 6) AS mean, round(median(latest_value), 6) AS median,
  round(stddev_samp(latest_value), 6) AS std, min(latest_value) AS min, max(latest_value) AS max
FROM customers JOIN split_of USING (c_custkey) GROUP BY GROUPING SETS ((split), ())"""


def feature_missingness(spark, d):
    """Missing cells per feature, for both versions."""
    base = customers(spark, d)
    return P.feature_missingness(base, V1).unionByName(P.feature_missingness(derive(base, DERIVED), V2))


def _missing_sql(version, features, numeric):
    return " UNION ALL ".join(
        f"""SELECT '{version}' AS feature_version, '{f}' AS feature, '{"numerical" if f in numeric else "categorical"}' AS feature_type,
        count(*) - count({f}) AS missing_count, round_even((count(*) - count({f})) * 100.0::DOUBLE / count(*), 2) AS missing_percentage,
        count(DISTINCT {f}) AS unique_non_null_values FROM features""" for f in features)


FEATURE_MISSINGNESS_SQL = f"WITH {FEATURES_SQL} {_missing_sql('v1', V1.features, V1.numeric)} UNION ALL {_missing_sql('v2', V2.features, V2.numeric)}"


def derived_feature_summary(spark, d):
    names = list(DERIVED)
    # squares reach 10**8, so the sixth decimal of their mean depends on the order of summation
    return rounded(P.derived_summary(derive(customers(spark, d), DERIVED), names), ("minimum", "maximum", "mean", "median"), 3)


DERIVED_SUMMARY_SQL = f"WITH {FEATURES_SQL} " + " UNION ALL ".join(
    f"""SELECT '{f}' AS feature, count({f}) AS non_null_count, count(*) - count({f}) AS missing_count,
    round_even((count(*) - count({f})) * 100.0::DOUBLE / count(*), 2) AS missing_percentage, round(min({f}), 3) AS minimum,
    round(max({f}), 3) AS maximum, round(avg({f}), 3) AS mean, round(median({f}), 3) AS median FROM features""" for f in DERIVED)


def data_fingerprint(spark, d):
    """Portable fingerprint per market segment. Decimals, because engines print doubles differently."""
    rows = table(spark, d, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(18,2)"))
    return fingerprint(rows, ["c_custkey", "c_name", "c_nationkey", "c_acctbal"], ["c_mktsegment"], portable=True)


def _field(text):
    return f"coalesce('V' || length({text}) || ':' || {text}, 'N')"


_SUMS = " || ',' || ".join(
    f"sum((('0x' || substr(h, {1 + 8 * i}, 8))::BIGINT) {op})::VARCHAR" for i in range(8) for op in (">> 16", "& 65535"))
FINGERPRINT_SQL = f"""WITH t AS (SELECT c_mktsegment, sha256({_field("c_custkey::VARCHAR")} || {_field("c_name")} || {_field("c_nationkey::VARCHAR")}
  || {_field("c_acctbal::DECIMAL(18,2)::VARCHAR")}) AS h FROM customer)
SELECT c_mktsegment, count(*) AS row_count, sha256(count(*)::VARCHAR || ',' || {_SUMS}) AS data_fingerprint FROM t GROUP BY c_mktsegment"""

QUERIES = {
    "overview_events": (overview_events, OVERVIEW_SQL),
    "column_profile_orders": (column_profile_orders, COLUMN_PROFILE_SQL),
    "most_missing_columns": (most_missing_columns, MOST_MISSING_SQL),
    "schema_report_orders": (schema_report_orders, SCHEMA_REPORT_SQL),
    "numeric_summary_lineitem": (numeric_summary_lineitem, NUMERIC_SUMMARY_SQL),
    "categorical_summary_orders": (categorical_summary_orders, CATEGORICAL_SQL),
    "categorical_summary_documents": (categorical_summary_documents, CATEGORICAL_DOCUMENTS_SQL),
    "histogram_value": (histogram_value, HISTOGRAM_SQL),
    "histogram_price_by_flag": (histogram_price_by_flag, HISTOGRAM_SERIES_SQL),
    "shared_range_prices": (shared_range_prices, SHARED_RANGE_SQL),
    "time_range_tables": (time_range_tables, TIME_RANGE_SQL),
    "group_counts_events": (group_counts_events, GROUP_COUNTS_SQL),
    "target_stats_by_split": (target_stats_by_split, TARGET_STATS_SQL),
    "feature_missingness": (feature_missingness, FEATURE_MISSINGNESS_SQL),
    "derived_feature_summary": (derived_feature_summary, DERIVED_SUMMARY_SQL),
    "data_fingerprint": (data_fingerprint, FINGERPRINT_SQL),
}
