"""Queries: feature versions, manifests, retrieval and serving."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions.scalar import all_present
from keelson.operators import features as B
from keelson.operators import retrieve as R
from keelson.operators.asof import AsOfSide, as_of_join, retrieval_counts
from keelson.operators.compare import row_differences
from keelson.plans.common import DERIVED, FEATURES_SQL, TTL, V1, V2, customers, rounded, table
from keelson.session import materialized, shared_path
from keelson.sources.tables import first_rows, write_bucketed
from keelson.spec import FeatureService, FeatureSource, FeatureView


def features_v1(spark, d):
    return B.build(customers(spark, d), V1).data


FEATURES_V1_SQL = f"WITH {FEATURES_SQL} SELECT {', '.join(V1.columns)} FROM features"


def features_v2(spark, d):
    return rounded(B.build(customers(spark, d), V2).data, DERIVED)


FEATURES_V2_SQL = f"WITH {FEATURES_SQL} SELECT {', '.join(V1.columns)}, {', '.join(f'round({f}, 6) AS {f}' for f in DERIVED)} FROM features"


def feature_integrity(spark, d):
    return B.integrity(table(spark, d, "orders"), "o_custkey", "o_orderdate", "o_totalprice")


INTEGRITY_SQL = """SELECT count(*) AS row_count, count(*) FILTER (o_custkey IS NULL) AS missing_keys, count(o_custkey) - count(DISTINCT o_custkey) AS duplicate_keys,
  count(*) FILTER (o_orderdate IS NULL) AS missing_times, count(*) FILTER (o_totalprice IS NULL) AS missing_targets FROM orders"""


def feature_manifest(spark, d):
    """Manifest of version 2 with its lineage; fingerprints, which only this library computes, are shown as checks."""
    base = materialized(customers(spark, d))
    parent = B.build(base, V1).manifest()
    one = B.build(base, V2).manifest(parent, True)
    texts = ("features", "numerical_features", "categorical_features", "excluded_columns", "transformations")
    return one.select(
        "feature_version", "feature_view_name", "entity_key", "timestamp_column", "feature_count", "row_count", "entity_count",
        "duplicate_entity_count", "missing_feature_values", "parent_version", "same_population",
        *[F.array_join(c, "; ").alias(c) for c in texts],
        ((F.length("data_fingerprint") == 64) & (F.length("schema_fingerprint") == 64)).alias("has_fingerprints"),
        (F.col("data_fingerprint") != F.col("parent_fingerprint")).alias("differs_from_parent"))


def _listed(values):
    return "'" + "; ".join(values) + "'"


MANIFEST_SQL = f"""WITH {FEATURES_SQL}
SELECT 'v2' AS feature_version, 'customer_features_v2' AS feature_view_name, 'c_custkey' AS entity_key, 'event_time' AS timestamp_column,
  {len(V2.features)} AS feature_count, count(*) AS row_count, count(DISTINCT c_custkey) AS entity_count, count(*) - count(DISTINCT c_custkey) AS duplicate_entity_count,
  ({' + '.join(f'count(*) - count({f})' for f in V2.features)}) AS missing_feature_values, 'v1' AS parent_version, true AS same_population,
  {_listed(V2.features)} AS features, {_listed(V2.numeric)} AS numerical_features, {_listed(V2.categorical)} AS categorical_features,
  {_listed(V2.leakage)} AS excluded_columns, {_listed(f'{k} = {v}' for k, v in DERIVED.items())} AS transformations,
  true AS has_fingerprints, true AS differs_from_parent FROM features"""


def version_compare(spark, d):
    base = materialized(customers(spark, d))
    old, new = (B.build(base, s).manifest() for s in (V1, V2))
    one = B.compare_versions(old, new)
    return one.select("old_version", "new_version", "old_rows", "new_rows",
                      *[F.array_join(c, ",").alias(c) for c in ("old_features", "new_features", "added_features", "removed_features")],
                      (F.col("old_fingerprint") == F.col("new_fingerprint")).alias("same_content"))


VERSION_COMPARE_SQL = f"""WITH {FEATURES_SQL}
SELECT 'v1' AS old_version, 'v2' AS new_version, (SELECT count(*) FROM customers) AS old_rows, count(*) AS new_rows,
  '{",".join(V1.features)}' AS old_features, '{",".join(V2.features)}' AS new_features, '{",".join(DERIVED)}' AS added_features,
  '' AS removed_features, false AS same_content FROM features"""


def alignment_diff(spark, d):
    """Rows whose multiplicity differs between orders and a table in which some priorities became missing."""
    orders = table(spark, d, "orders").select("o_custkey", "o_orderpriority")
    other = orders.withColumn("o_orderpriority", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")))
    return row_differences(orders, other, ["o_custkey", "o_orderpriority"])


ALIGNMENT_SQL = """WITH a AS (SELECT o_custkey, o_orderpriority FROM orders),
b AS (SELECT o_custkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS o_orderpriority FROM orders),
d AS (SELECT o_custkey, o_orderpriority, 1 AS x, 0 AS y FROM a UNION ALL SELECT o_custkey, o_orderpriority, 0, 1 FROM b)
SELECT o_custkey, o_orderpriority, sum(x)::BIGINT AS a_rows, sum(y)::BIGINT AS b_rows FROM d GROUP BY 1, 2 HAVING sum(x) <> sum(y)"""


def training_dataset(spark, d):
    rows = B.derive(customers(spark, d), V2.derived)
    return rounded(B.training_dataset(rows, V2, "latest_value"), DERIVED)


TRAINING_SQL = f"""WITH {FEATURES_SQL} SELECT {', '.join(V1.columns)}, latest_value, {', '.join(f'round({f}, 6) AS {f}' for f in DERIVED)} FROM features"""


def complete_rows(spark, d):
    return customers(spark, d).where(all_present(["balance", "segment"])).select("c_custkey", "balance", "segment")


COMPLETE_SQL = f"WITH {FEATURES_SQL} SELECT c_custkey, balance, segment FROM features WHERE balance IS NOT NULL AND segment IS NOT NULL"


def sample_keys(spark, d):
    return R.sample_keys(customers(spark, d), "c_custkey", ["balance", "segment"], 5)


SAMPLE_KEYS_SQL = f"WITH {FEATURES_SQL} SELECT c_custkey FROM features WHERE balance IS NOT NULL AND segment IS NOT NULL ORDER BY c_custkey LIMIT 5"


def _events(spark, d, kind):
    e = table(spark, d, "events").where(F.col("event_type") == kind)
    return e.select("user_id", "ts", "event_id", F.col("value").alias(f"{kind}_value"), F.col("props").alias(f"{kind}_props"))


def _labels(spark, d):
    return table(spark, d, "events").where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts", "value")


def _click_side(spark, d, ttl=None):
    return AsOfSide(_events(spark, d, "click"), "user_id", "ts", ("click_value", "click_props"), ttl, "event_id", time_as="click_time")


def pit_join(spark, d):
    """Every purchase with the newest click of its user at that time."""
    return as_of_join(_labels(spark, d), "user_id", "ts", [_click_side(spark, d)])


_PC = """p AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase'),
c AS (SELECT user_id, ts, value AS click_value, props AS click_props FROM events WHERE event_type = 'click')"""
PIT_SQL = f"""WITH {_PC} SELECT p.*, c.ts AS click_time, click_value, click_props FROM p ASOF LEFT JOIN c ON p.user_id = c.user_id AND p.ts >= c.ts"""


def pit_join_ttl(spark, d):
    return as_of_join(_labels(spark, d), "user_id", "ts", [_click_side(spark, d, TTL)])


PIT_TTL_SQL = f"""WITH {_PC} SELECT p.*, CASE WHEN c.ts >= p.ts - INTERVAL 2 DAY THEN c.ts END AS click_time,
  CASE WHEN c.ts >= p.ts - INTERVAL 2 DAY THEN click_value END AS click_value,
  CASE WHEN c.ts >= p.ts - INTERVAL 2 DAY THEN click_props END AS click_props
FROM p ASOF LEFT JOIN c ON p.user_id = c.user_id AND p.ts >= c.ts"""


def pit_small_groups(spark, d):
    """The same join with a limit of 20 rows per group, so that every user is cut into time slices."""
    return as_of_join(_labels(spark, d), "user_id", "ts", [_click_side(spark, d, TTL)], max_group_rows=20)


def _service(spark, d):
    fields = T.StructType([T.StructField("amount", T.DoubleType()), T.StructField("detail", T.StringType())])

    def view(kind, ttl):
        rows = table(spark, d, "events").where(F.col("event_type") == kind).select(
            "user_id", "ts", "event_id", F.col("value").alias("amount"), F.col("props").alias("detail"))
        return FeatureView(f"{kind}s", "user_id", FeatureSource(rows, "ts", "event_id"), fields, ttl, tags={"kind": kind})

    return FeatureService("activity", [view("click", TTL), view("view", None), view("signup", TTL)])


def pit_multi_view(spark, d):
    return R.retrieve_history(_labels(spark, d), _service(spark, d), "ts")


PIT_MULTI_SQL = """WITH p AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase'),
a AS (SELECT p.*, CASE WHEN c.ts >= p.ts - INTERVAL 2 DAY THEN c.value END AS clicks__amount, CASE WHEN c.ts >= p.ts - INTERVAL 2 DAY THEN c.props END AS clicks__detail
  FROM p ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c ON p.user_id = c.user_id AND p.ts >= c.ts),
b AS (SELECT a.*, c.value AS views__amount, c.props AS views__detail
  FROM a ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') c ON a.user_id = c.user_id AND a.ts >= c.ts)
SELECT b.*, CASE WHEN c.ts >= b.ts - INTERVAL 2 DAY THEN c.value END AS signups__amount, CASE WHEN c.ts >= b.ts - INTERVAL 2 DAY THEN c.props END AS signups__detail
  FROM b ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') c ON b.user_id = c.user_id AND b.ts >= c.ts"""


def pit_lineitem(spark, d):
    """Every line item with the newest earlier shipping day of its supplier: one feature row per day, so no ordinal is needed."""
    lines = table(spark, d, "lineitem")
    ships = lines.groupBy("l_suppkey", "l_shipdate").agg(F.max("l_extendedprice").alias("top_price"), F.count(F.lit(1)).alias("shipments"))
    labels = lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.col("l_shipdate").alias("at")) \
        .withColumn("at", F.col("at") - F.expr("INTERVAL 1 DAY"))
    return as_of_join(labels, "l_suppkey", "at", [AsOfSide(ships, "l_suppkey", "l_shipdate", ("top_price", "shipments"), None)])


PIT_LINES_SQL = """WITH s AS (SELECT l_suppkey, l_shipdate, max(l_extendedprice) AS top_price, count(*) AS shipments FROM lineitem GROUP BY 1, 2),
p AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate - INTERVAL 1 DAY AS at FROM lineitem)
SELECT p.*, top_price, shipments FROM p ASOF LEFT JOIN s ON p.l_suppkey = s.l_suppkey AND p.at >= s.l_shipdate"""


def history_counts(spark, d):
    labels = _labels(spark, d)
    return retrieval_counts(as_of_join(labels, "user_id", "ts", [_click_side(spark, d, TTL)]), labels, "user_id")


HISTORY_COUNTS_SQL = """SELECT count(*) AS result_rows, count(*) AS label_rows, count(DISTINCT user_id) AS result_keys, count(DISTINCT user_id) AS label_keys,
  true AS reconciled FROM events WHERE event_type = 'purchase'"""


def materialize_latest(spark, d):
    """Latest values per user between two days, both included."""
    e = table(spark, d, "events")
    return R.materialize(e, "user_id", "ts", ["event_type", "value", "props"], F.lit("2024-01-05").cast("timestamp_ntz"),
                         F.lit("2024-01-25").cast("timestamp_ntz"), "event_id")


MATERIALIZE_SQL = """SELECT user_id, ts, event_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
  WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25') WHERE rn = 1"""


def snapshot_update(spark, d):
    """A snapshot of the first half of the month, updated with the rest."""
    e = table(spark, d, "events")
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    first = R.materialize(e, "user_id", "ts", ["event_type", "value"], end=cut, ordinal="event_id")
    return R.update_snapshot(first, e.where(F.col("ts") > cut), "user_id", "ts", "event_id")


SNAPSHOT_SQL = """SELECT user_id, ts, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"""


def _requests(spark, d):
    """All customer keys as requested users; most of them are unknown to the snapshot."""
    return table(spark, d, "customer").select((F.col("c_custkey") * 7 + 3).alias("request_position"), F.col("c_custkey").alias("user_id"))


def _snapshot(spark, d):
    return R.materialize(table(spark, d, "events"), "user_id", "ts", ["event_type", "value"], ordinal="event_id")


def online_lookup(spark, d):
    return R.lookup(_snapshot(spark, d), _requests(spark, d), "user_id", ["event_type", "value"])


LOOKUP_SQL = f"""SELECT c_custkey * 7 + 3 AS request_position, c_custkey AS user_id, s.event_type, s.value
FROM customer LEFT JOIN ({SNAPSHOT_SQL}) s ON c_custkey = s.user_id"""


def colocated_lookup(spark, d):
    """The same lookup in a snapshot stored in buckets by key."""
    name = f"keelson_snapshot_{uuid4().hex}"
    write_bucketed(_snapshot(spark, d), name, "user_id", 8, path=shared_path(spark, "snapshot"))
    return R.lookup_colocated(name, _requests(spark, d), "user_id", ["event_type", "value"])


def lookup_check(spark, d):
    wanted = _requests(spark, d)
    return R.check_response(R.lookup(_snapshot(spark, d), wanted, "user_id", ["event_type", "value"]), wanted, "user_id",
                            ["event_type", "value"])


LOOKUP_CHECK_SQL = "SELECT count(*) AS requested, count(*) AS answered, 0::BIGINT AS wrong_keys, true AS complete FROM customer"


def ordered_sample(spark, d):
    """First 25 retrieved rows in key and time order."""
    rows = as_of_join(_labels(spark, d), "user_id", "ts", [_click_side(spark, d, TTL)])
    return first_rows(rows.select("event_id", "user_id", "ts", "click_value"), ["user_id", "ts", "event_id"], 25)


ORDERED_SAMPLE_SQL = f"SELECT event_id, user_id, ts, click_value FROM ({PIT_TTL_SQL}) ORDER BY user_id, ts, event_id LIMIT 25"


def flagship(spark, d):
    """Clean purchases, their newest click within the TTL, and what it tells, per day."""
    labels = _labels(spark, d)
    joined = as_of_join(labels, "user_id", "ts", [_click_side(spark, d, TTL)])
    derived = B.derive(joined, {"value_ratio": "try_divide(value, click_value)", "value_squared": "pow(value, 2)"})
    return derived.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(
        F.count(F.lit(1)).alias("purchases"), F.count("click_time").alias("matched"),
        F.round(F.avg("value_ratio"), 6).alias("mean_ratio"), F.round(F.avg("value_squared"), 6).alias("mean_square"))


FLAGSHIP_SQL = f"""SELECT date_trunc('day', ts)::TIMESTAMP AS day, count(*) AS purchases, count(click_time) AS matched,
  round(avg(CASE WHEN click_value <> 0 THEN value / click_value END), 6) AS mean_ratio, round(avg(value * value), 6) AS mean_square
FROM ({PIT_TTL_SQL}) GROUP BY 1"""

QUERIES = {
    "flagship": (flagship, FLAGSHIP_SQL),
    "features_v1": (features_v1, FEATURES_V1_SQL),
    "features_v2": (features_v2, FEATURES_V2_SQL),
    "feature_integrity": (feature_integrity, INTEGRITY_SQL),
    "feature_manifest": (feature_manifest, MANIFEST_SQL),
    "version_compare": (version_compare, VERSION_COMPARE_SQL),
    "alignment_diff": (alignment_diff, ALIGNMENT_SQL),
    "training_dataset": (training_dataset, TRAINING_SQL),
    "complete_rows": (complete_rows, COMPLETE_SQL),
    "sample_keys": (sample_keys, SAMPLE_KEYS_SQL),
    "pit_join": (pit_join, PIT_SQL),
    "pit_join_ttl": (pit_join_ttl, PIT_TTL_SQL),
    "pit_small_groups": (pit_small_groups, PIT_TTL_SQL),
    "pit_multi_view": (pit_multi_view, PIT_MULTI_SQL),
    "pit_lineitem": (pit_lineitem, PIT_LINES_SQL),
    "history_counts": (history_counts, HISTORY_COUNTS_SQL),
    "materialize_latest": (materialize_latest, MATERIALIZE_SQL),
    "snapshot_update": (snapshot_update, SNAPSHOT_SQL),
    "online_lookup": (online_lookup, LOOKUP_SQL),
    "colocated_lookup": (colocated_lookup, LOOKUP_SQL),
    "lookup_check": (lookup_check, LOOKUP_CHECK_SQL),
    "ordered_sample": (ordered_sample, ORDERED_SAMPLE_SQL),
}
