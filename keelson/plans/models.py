"""Queries: splits, samples, preprocessing, regression, rankings, grids, quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.operators import features as B
from keelson.operators import metrics as M
from keelson.operators import model as L
from keelson.operators import quality as Q
from keelson.operators import runs as X
from keelson.operators.asof import retrieval_counts
from keelson.operators.clean import clean
from keelson.operators.compare import coverage, grid_gaps, validated_left_join
from keelson.operators.profile import group_counts
from keelson.operators.split import apply_split, exact_sample, sample_split, split_entities, split_frames, split_summary
from keelson.plans import features as PF
from keelson.plans.common import (CUSTOMERS_SQL, DERIVED, EVENT_RULES, EVENTS_CLEAN_SQL, FEATURES_SQL, LEAKAGE, SPLIT_SQL, V1, V2, customers, r6,
                                  rounded, table)
from keelson.presets import HP1, HP2, RUNS
from keelson.session import materialized, released_shuffles, shared_path
from keelson.spec import ForestSettings

PREDICTORS = ("by_part", "constant", "linear", "per_unit")


def entity_split(spark, d):
    return split_entities(table(spark, d, "orders"), "o_custkey", 0.2, 42)[1]


ENTITY_SPLIT_SQL = """WITH k AS (SELECT DISTINCT o_custkey FROM orders)
SELECT o_custkey, CASE WHEN row_number() OVER (ORDER BY md5('42:' || o_custkey)) <= ceil(count(*) OVER () * 0.2) THEN 'test' ELSE 'train' END AS split FROM k"""


def split_in_key_order(spark, d):
    return split_entities(table(spark, d, "orders"), "o_custkey", 0.25, shuffle=False)[1]


KEY_ORDER_SPLIT_SQL = """WITH k AS (SELECT DISTINCT o_custkey FROM orders)
SELECT o_custkey, CASE WHEN row_number() OVER (ORDER BY o_custkey DESC) <= ceil(count(*) OVER () * 0.25) THEN 'test' ELSE 'train' END AS split FROM k"""


def split_report(spark, d):
    split, membership = split_entities(table(spark, d, "customer"), "c_custkey", 0.2, 42)
    return split_summary(split, membership).drop("split_fingerprint")


SPLIT_REPORT_SQL = """SELECT 42 AS seed, 0.2::DOUBLE AS fraction_requested, true AS shuffle, count(DISTINCT c_custkey) AS total_entities,
  count(DISTINCT c_custkey) - ceil(count(DISTINCT c_custkey) * 0.2)::BIGINT AS train_entities, ceil(count(DISTINCT c_custkey) * 0.2)::BIGINT AS test_entities,
  round(ceil(count(DISTINCT c_custkey) * 0.2) / count(DISTINCT c_custkey), 6) AS actual_test_fraction FROM customer"""


def split_coverage(spark, d):
    """Coverage of all customers by a split that was drawn from customers with orders only."""
    _, membership = split_entities(customers(spark, d), "c_custkey", 0.2, 42)
    return coverage(table(spark, d, "customer"), membership, "c_custkey")


COVERAGE_SQL = """SELECT 0::BIGINT AS overlapping_keys, 0::BIGINT AS duplicate_keys, count(*) FILTER (c_custkey NOT IN (SELECT o_custkey FROM orders)) AS uncovered_keys,
  0::BIGINT AS unknown_keys, 0::BIGINT AS bad_values FROM customer"""


def apply_split_counts(spark, d):
    base = customers(spark, d)
    _, membership = split_entities(base, "c_custkey", 0.2, 42)
    return group_counts(apply_split(base, membership, "c_custkey"), ["split"], "c_custkey")


APPLY_SPLIT_SQL = f"""WITH {CUSTOMERS_SQL}, {SPLIT_SQL}
SELECT split, count(*) AS row_count, count(DISTINCT c_custkey) AS key_count FROM customers JOIN split_of USING (c_custkey) GROUP BY split"""


def test_partition(spark, d):
    """Rows of the test side of a split."""
    base = customers(spark, d)
    split, _ = split_entities(base, "c_custkey", 0.2, 42)
    return split_frames(split.assign(base))[1].select("c_custkey", "event_time", "latest_value")


TEST_PARTITION_SQL = f"""WITH {CUSTOMERS_SQL}, {SPLIT_SQL}
SELECT c_custkey, event_time, latest_value FROM customers JOIN split_of USING (c_custkey) WHERE split = 'test'"""


def validated_join(spark, d):
    left = customers(spark, d).select("c_custkey", "latest_value")
    right = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return validated_left_join(left, right, "c_custkey")


VALIDATED_JOIN_SQL = f"WITH {CUSTOMERS_SQL} SELECT c_custkey, latest_value, c_nationkey FROM customers JOIN customer USING (c_custkey)"


def exact_sample_orders(spark, d):
    """Exactly 1,000 orders, the same under any partitioning."""
    return exact_sample(table(spark, d, "orders"), "o_orderkey", 1_000, 7).select("o_orderkey", "o_totalprice")


EXACT_SAMPLE_SQL = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5('7:' || o_orderkey) LIMIT 1000"


def sample_by_split(spark, d):
    base = customers(spark, d)
    split, _ = split_entities(base, "c_custkey", 0.2, 42)
    return sample_split(split.assign(base), "c_custkey", 500, 100, 42).select("c_custkey", "split")


SAMPLE_BY_SPLIT_SQL = f"""WITH {CUSTOMERS_SQL}, {SPLIT_SQL}
SELECT c_custkey, split FROM (SELECT *, row_number() OVER (PARTITION BY split ORDER BY md5('42:' || c_custkey)) AS rn FROM split_of)
WHERE rn <= CASE WHEN split = 'train' THEN 500 ELSE 100 END"""


def _split_rows(spark, d, spec):
    base = customers(spark, d)
    split, _ = split_entities(base, "c_custkey", 0.2, 42)
    rows = B.derive(split.assign(base), spec.derived)
    return materialized(B.model_inputs(rows, spec, ("c_custkey", "split", "latest_value")))


def impute_median_mode(spark, d):
    """Missing cells of all rows filled with statistics of training rows."""
    rows = _split_rows(spark, d, V2)
    learned = L.fit_preprocessing(rows.where(F.col("split") == "train"), V2)
    return rounded(learned.impute(rows).select("c_custkey", "split", "balance", "segment", "priority", *DERIVED), DERIVED)


IMPUTE_SQL = f"""WITH {FEATURES_SQL}, {SPLIT_SQL},
f AS (SELECT features.*, split FROM features JOIN split_of USING (c_custkey)), t AS (SELECT * FROM f WHERE split = 'train'),
m AS (SELECT median(balance) AS balance, median(balance_squared) AS bs, median(balance_per_order) AS bo, median(value_ratio) AS vr FROM t),
s AS (SELECT segment FROM t WHERE segment IS NOT NULL GROUP BY segment ORDER BY count(*) DESC, segment LIMIT 1)
SELECT c_custkey, split, coalesce(f.balance, m.balance) AS balance, coalesce(f.segment, s.segment) AS segment, priority,
  round(coalesce(balance_squared, bs), 6) AS balance_squared, round(coalesce(balance_per_order, bo), 6) AS balance_per_order,
  round(coalesce(value_ratio, vr), 6) AS value_ratio FROM f, m, s"""


def one_hot_wide(spark, d):
    rows = _split_rows(spark, d, V1)
    learned = L.fit_preprocessing(rows.where(F.col("split") == "train"), V1)
    wide = learned.one_hot(rows, ["c_custkey"])
    names = {c: "".join(ch if ch.isalnum() else "_" for ch in c).lower() for c in wide.columns}
    return wide.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])


_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY")
_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def _flag(column, value):
    name = "".join(ch if ch.isalnum() else "_" for ch in value).lower()
    return f"CASE WHEN {column} = '{value}' THEN 1.0::DOUBLE ELSE 0.0 END AS categorical__{column}_{name}"


ONE_HOT_SQL = f"""WITH {CUSTOMERS_SQL}, {SPLIT_SQL},
f AS (SELECT customers.*, split FROM customers JOIN split_of USING (c_custkey)), t AS (SELECT * FROM f WHERE split = 'train'),
m AS (SELECT median(balance) AS balance FROM t),
s AS (SELECT segment FROM t WHERE segment IS NOT NULL GROUP BY segment ORDER BY count(*) DESC, segment LIMIT 1),
g AS (SELECT c_custkey, coalesce(f.balance, m.balance) AS balance, order_count, smallest_order, largest_order, coalesce(f.segment, s.segment) AS segment, priority FROM f, m, s)
SELECT c_custkey, balance AS numerical__balance, order_count AS numerical__order_count, smallest_order AS numerical__smallest_order,
  largest_order AS numerical__largest_order, {', '.join(_flag('segment', v) for v in _SEGMENTS)}, {', '.join(_flag('priority', v) for v in _PRIORITIES)} FROM g"""


def _scores(spark, d):
    """Four simple predictors of a line's price, in long form."""
    lines = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    split = F.when(F.pmod(F.col("l_orderkey"), F.lit(5)) == 0, "test").otherwise("train")
    predictors = F.array(
        F.struct(F.lit("by_part").alias("model"), (F.col("l_quantity") * F.col("p_retailprice")).alias("predicted")),
        F.struct(F.lit("constant").alias("model"), F.lit(52500.0).alias("predicted")),
        F.struct(F.lit("linear").alias("model"), (F.lit(2100.0) * F.col("l_quantity") + F.lit(250.0)).alias("predicted")),
        F.struct(F.lit("per_unit").alias("model"), (F.lit(1500.0) * F.col("l_quantity")).alias("predicted")))
    return lines.select("l_returnflag", "l_extendedprice", split.alias("split"), F.explode(predictors).alias("p")).select(
        "l_returnflag", "split", "l_extendedprice", "p.*")


_SCORES_SQL = """s AS (SELECT l_returnflag, CASE WHEN l_orderkey % 5 = 0 THEN 'test' ELSE 'train' END AS split, l_extendedprice AS y,
  unnest([{'model': 'by_part', 'p': l_quantity * p_retailprice}, {'model': 'constant', 'p': 52500.0::DOUBLE},
          {'model': 'linear', 'p': 2100.0 * l_quantity + 250.0}, {'model': 'per_unit', 'p': 1500.0 * l_quantity}]) AS m
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
_METRIC_SQL = """count(*) AS n, sqrt(avg((y - m.p) * (y - m.p))) AS rmse, avg(abs(y - m.p)) AS mae, 1 - avg((y - m.p) * (y - m.p)) / var_pop(y) AS r2"""


def regression_metrics(spark, d):
    return rounded(M.regression_metrics(_scores(spark, d), "l_extendedprice", "predicted", ["model", "split"]), M.METRICS)


REGRESSION_SQL = f"""WITH {_SCORES_SQL}, g AS (SELECT m.model AS model, split, {_METRIC_SQL} FROM s GROUP BY 1, 2)
SELECT model, split, n, round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(r2, 6) AS r2 FROM g"""


def generalisation_gaps(spark, d):
    per = M.split_metrics(M.regression_metrics(_scores(spark, d), "l_extendedprice", "predicted", ["model", "split"]), ["model"])
    return rounded(per, [c for c in per.columns if c != "model"])


GAPS_SQL = f"""WITH {_SCORES_SQL}, g AS (SELECT m.model AS model, split, {_METRIC_SQL} FROM s GROUP BY 1, 2),
a AS (SELECT * FROM g WHERE split = 'train'), b AS (SELECT * FROM g WHERE split = 'test')
SELECT a.model, round(a.rmse, 6) AS train_rmse, round(a.mae, 6) AS train_mae, round(a.r2, 6) AS train_r2, round(b.rmse, 6) AS test_rmse, round(b.mae, 6) AS test_mae,
  round(b.r2, 6) AS test_r2, round(b.rmse - a.rmse, 6) AS rmse_gap, round(a.r2 - b.r2, 6) AS r2_gap FROM a JOIN b ON a.model = b.model"""


def residuals_by_part(spark, d):
    lines = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return M.residuals(lines.withColumn("guess", F.col("l_quantity") * F.col("p_retailprice")), "l_orderkey", "l_extendedprice", "guess") \
        .withColumns({"predicted": r6("predicted"), "residual": r6("residual")})


RESIDUALS_SQL = """SELECT l_orderkey, l_extendedprice AS actual, round(l_quantity * p_retailprice, 6) AS predicted, round(l_extendedprice - l_quantity * p_retailprice, 6) AS residual
FROM lineitem JOIN part ON l_partkey = p_partkey"""


def leaderboard(spark, d):
    """Predictors ranked inside each return flag."""
    measured = M.regression_metrics(_scores(spark, d), "l_extendedprice", "predicted", ["l_returnflag", "model"])
    return rounded(M.leaderboard(measured, "model", ["l_returnflag"]), M.METRICS)


LEADERBOARD_SQL = f"""WITH {_SCORES_SQL}, g AS (SELECT l_returnflag, m.model AS model, {_METRIC_SQL} FROM s GROUP BY 1, 2)
SELECT l_returnflag, model, n, round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(r2, 6) AS r2,
  row_number() OVER (PARTITION BY l_returnflag ORDER BY rmse, mae, r2 DESC, model)::INT AS rank FROM g"""


def best_model(spark, d):
    measured = M.regression_metrics(_scores(spark, d), "l_extendedprice", "predicted", ["l_returnflag", "model"])
    return rounded(M.best_model(measured, "model", ["l_returnflag"]), M.METRICS)


BEST_MODEL_SQL = f"SELECT l_returnflag, model, n, rmse, mae, r2 FROM ({LEADERBOARD_SQL}) WHERE rank = 1"


def _fit(spark, d, spec, settings):
    prepared = L.prepare(_split_rows(spark, d, spec), spec, "c_custkey", "latest_value")
    return L.fit(prepared, settings)


def forest_predictions(spark, d):
    return _fit(spark, d, V1, HP1).predictions()


def forest_metrics(spark, d):
    return _fit(spark, d, V2, HP1).metrics()


def feature_importance(spark, d):
    return _fit(spark, d, V2, HP2).importance()


def experiment_comparison(spark, d):
    """The standard grid, two feature versions by two settings, on one split, ranked."""
    base = materialized(customers(spark, d))
    split, _ = split_entities(base, "c_custkey", 0.2, 42)
    data = {s.version: (B.derive(base, s.derived), s) for s in (V1, V2)}
    registry = shared_path(spark, "runs")
    compared = X.comparison(X.run_grid(data, split, "latest_value", RUNS, {"hp1": HP1, "hp2": HP2}, "example", registry))
    return compared.drop("training_seconds", "prediction_seconds")


def stored_model_scores(spark, d):
    """Scores of all customers by a model that was saved and loaded, compared with those of the fitted one."""
    result = _fit(spark, d, V1, HP2)
    path = shared_path(spark, "model")
    with released_shuffles(spark):  # rows meet one forest after the other, never two at once
        fitted = materialized(result.scored)
        L.save_model(result.model, path)
        stored = materialized(L.score(path, customers(spark, d), "c_custkey").withColumnRenamed("prediction", "stored"))
    both = stored.join(fitted, "c_custkey", "full")
    return both.agg(F.count(F.lit(1)).alias("scored_rows"),
                    F.count_if(~F.col("stored").eqNullSafe(F.col("prediction"))).alias("different_rows"))


STORED_MODEL_SQL = f"WITH {CUSTOMERS_SQL} SELECT count(*) AS scored_rows, 0::BIGINT AS different_rows FROM customers"


def forest_bounds(spark, d):
    """Predicted rows per split. A forest averages training labels, so it cannot leave their range."""
    scored = _fit(spark, d, V1, HP1).scored
    low, high = scored.where(F.col("split") == "train").agg(F.min("latest_value"), F.max("latest_value")).first()
    return scored.groupBy("split").agg(
        F.count("prediction").alias("predicted_rows"),
        F.count_if(~F.col("prediction").between(low - 1e-6, high + 1e-6)).alias("rows_out_of_range"))


FOREST_BOUNDS_SQL = f"""WITH {CUSTOMERS_SQL}, {SPLIT_SQL}
SELECT split, count(*) AS predicted_rows, 0::BIGINT AS rows_out_of_range FROM split_of GROUP BY split"""


def importance_total(spark, d):
    """Number of encoded features of version 2, and their importances' sum."""
    return _fit(spark, d, V2, HP2).importance().agg(
        F.count(F.lit(1)).alias("encoded_features"), r6(F.sum("importance")).alias("total"), F.max("rank").alias("last_rank"))


IMPORTANCE_SQL = f"""WITH {CUSTOMERS_SQL}, {SPLIT_SQL}, t AS (SELECT customers.* FROM customers JOIN split_of USING (c_custkey) WHERE split = 'train'),
n AS (SELECT {len(V2.numeric)} + count(DISTINCT segment) + count(DISTINCT priority) AS k FROM t)
SELECT k AS encoded_features, 1.0::DOUBLE AS total, k::INT AS last_rank FROM n"""


def importance_check(spark, d):
    """Importances and their order against MLlib's own computation over the stored form of the same forest."""
    result = _fit(spark, d, V1, HP1)
    theirs = spark.createDataFrame([(i, float(v)) for i, v in enumerate(result.model.forest.featureImportances.toArray())], "position int, theirs double")
    ours = materialized(result.importance().join(result.preprocessing.named_features(), "feature").join(theirs, "position"))
    after = ours.select((F.col("rank") - 1).alias("rank"), F.col("theirs").alias("next"))
    return ours.join(after, "rank", "left").agg(
        F.count(F.lit(1)).alias("encoded_features"), F.count_if(F.abs(F.col("importance") - F.col("theirs")) > 1e-9).alias("different"),
        F.count_if(F.col("next") > F.col("theirs") + 1e-9).alias("out_of_order"))


IMPORTANCE_CHECK_SQL = f"""WITH {CUSTOMERS_SQL}, {SPLIT_SQL}, t AS (SELECT customers.* FROM customers JOIN split_of USING (c_custkey) WHERE split = 'train')
SELECT {len(V1.numeric)} + count(DISTINCT segment) + count(DISTINCT priority) AS encoded_features, 0::BIGINT AS different, 0::BIGINT AS out_of_order FROM t"""


ONE_TREE = ForestSettings("one", trees=1, depth=2, min_leaf=20, feature_subset="all", bootstrap=False, max_bins=32)


def tree_splits(spark, d):
    """Nodes of one tree of two levels over all training rows: its sizes, means and splits can be counted in SQL."""
    result = _fit(spark, d, V1, ONE_TREE)
    names = result.preprocessing.named_features().withColumnRenamed("feature", "name")
    found = result.nodes.join(F.broadcast(names), F.col("feature") == F.col("position"), "left")
    return found.select("node", F.col("n").cast("bigint").alias("n"), F.round("prediction", 2).alias("prediction"), F.col("name").alias("feature"))


# every threshold of every feature: rows on its right side, their sum; the best one of each node, ties to the first feature
_TREE_LEVEL = """
{name}_tests AS (SELECT node, x.feature, x.place, e.threshold, count(*) FILTER (x.value > e.threshold) AS n_right, count(*) AS n,
                        sum(y) FILTER (x.value > e.threshold) AS s_right, sum(y) AS s
                 FROM {rows} r JOIN cells x USING (c_custkey) JOIN edges e ON e.feature = x.feature GROUP BY ALL),
{name}_best AS (SELECT node, feature, threshold FROM {name}_tests WHERE n_right >= 20 AND n - n_right >= 20
                QUALIFY row_number() OVER (PARTITION BY node ORDER BY round((s_right - n_right * s / n) ** 2 * n / (n_right::DOUBLE * (n - n_right)), 3) DESC, place, threshold) = 1),
{name} AS (SELECT r.c_custkey, r.y, r.node, 2 * r.node + (x.value > b.threshold)::INT AS child, b.feature
           FROM {rows} r JOIN {name}_best b USING (node) JOIN cells x ON x.c_custkey = r.c_custkey AND x.feature = b.feature)"""
_MEDIANS = ", ".join(f"coalesce({c}, median({c}) OVER ())::DOUBLE AS {c}" for c in V1.numeric)
TREE_SPLITS_SQL = f"""WITH {CUSTOMERS_SQL}, {SPLIT_SQL}, t AS (SELECT customers.* FROM customers JOIN split_of USING (c_custkey) WHERE split = 'train'),
filled AS (SELECT c_custkey, latest_value::DOUBLE AS y, {_MEDIANS}, {', '.join(f"coalesce({c}, mode({c}) OVER ()) AS {c}" for c in V1.categorical)} FROM t),
cells AS ({' UNION ALL '.join([f"SELECT c_custkey, 'numerical__{c}' AS feature, '{i}' AS place, {c} AS value FROM filled" for i, c in enumerate(V1.numeric)]
                              + [f"SELECT c_custkey, 'categorical__{c}_' || v.v AS feature, '{len(V1.numeric) + i}' || v.v AS place, (filled.{c} = v.v)::INT::DOUBLE AS value FROM filled, (SELECT DISTINCT {c} AS v FROM filled) v" for i, c in enumerate(V1.categorical)])}),
edges AS (SELECT feature, unnest(list_distinct(CASE WHEN feature LIKE 'categorical%' THEN [0.5] ELSE quantile_disc(value, {[i / 32 for i in range(1, 32)]}) END)) AS threshold FROM cells GROUP BY feature),
root AS (SELECT c_custkey, y, 1 AS node FROM filled), {_TREE_LEVEL.format(name='one', rows='root')},
second AS (SELECT c_custkey, y, child AS node FROM one), {_TREE_LEVEL.format(name='two', rows='second')},
placed AS (SELECT y, node, feature FROM root JOIN (SELECT feature FROM one_best) ON true UNION ALL SELECT y, node, feature FROM second LEFT JOIN two_best USING (node)
           UNION ALL SELECT y, child, NULL FROM two)
SELECT node::BIGINT AS node, count(*) AS n, round(avg(y), 2) AS prediction, any_value(feature) AS feature FROM placed GROUP BY node"""


def grid_gaps_users_days(spark, d):
    """Runs of days without any event of a user, and days with several: a grid of all customers and all days of activity."""
    facts = table(spark, d, "events").select("user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"))
    return grid_gaps(facts, table(spark, d, "customer").select("c_custkey"), facts.select("day"), ["user_id", "day"])


GRID_GAPS_SQL = """WITH f AS (SELECT user_id, date_trunc('day', ts)::TIMESTAMP AS day, count(*) AS n FROM events GROUP BY 1, 2),
days AS (SELECT day, row_number() OVER (ORDER BY day) AS i FROM (SELECT DISTINCT day FROM f)), users AS (SELECT DISTINCT c_custkey AS user_id FROM customer),
marks AS (SELECT user_id, i FROM f JOIN days USING (day) JOIN users USING (user_id)
          UNION ALL SELECT user_id, 0 FROM users UNION ALL SELECT user_id, (SELECT count(*) + 1 FROM days) FROM users),
runs AS (SELECT user_id, lag(i) OVER (PARTITION BY user_id ORDER BY i) + 1 AS a, i - 1 AS b FROM marks)
SELECT user_id, 'missing' AS status, x.day AS first_day, y.day AS last_day, b - a + 1 AS n FROM runs JOIN days x ON x.i = a JOIN days y ON y.i = b WHERE b >= a
UNION ALL SELECT user_id, 'duplicate', day, day, n FROM f JOIN users USING (user_id) WHERE n > 1
UNION ALL SELECT user_id, 'unexpected', day, day, n FROM f ANTI JOIN users USING (user_id)"""


def _all_checks(spark, d):
    orders, lines = table(spark, d, "orders"), table(spark, d, "lineitem")
    base = materialized(customers(spark, d))
    old, new = (B.build(base, s).manifest() for s in (V1, V2))
    split, membership = split_entities(base, "c_custkey", 0.2, 42)
    cleaned = clean(table(spark, d, "events"), EVENT_RULES, "event_id").summary(median=False)
    labels = PF._labels(spark, d)
    history = retrieval_counts(PF.pit_join_ttl(spark, d), labels, "user_id")
    measured = M.split_metrics(M.regression_metrics(_scores(spark, d), "l_extendedprice", "predicted", ["model", "split"]), ["model"])
    runs = materialized(measured.select(F.col("model").alias("run_name"), F.lit("v1").alias("feature_version"),
                                        F.col("model").alias("settings"), *[c for c in measured.columns if c != "model"]))
    best = M.require_best(runs, "run_name")
    versions, settings = (spark.createDataFrame([(v,) for v in values], "v string") for values in (("v1",), PREDICTORS))
    # the same rules on tables and declarations that break some of them
    faulty = Q.union_all([
        Q.accounting(cleaned.withColumn("final_rows", F.col("final_rows") + 1), "cleaning: rows reconcile", "initial_rows",
                     ["missing_key_rows_removed", "duplicate_key_rows_removed", "bad_label_rows_removed"], "final_rows"),
        Q.version_checks(old, new, [*DERIVED, "absent"], ("balance",)),
        Q.history_checks(retrieval_counts(labels.where("user_id % 7 <> 0"), labels, "user_id"), PF.lookup_check(spark, d)),
        Q.split_checks(table(spark, d, "customer"), membership, "c_custkey", split.test_entities + 1),
        Q.run_checks(runs, spark.createDataFrame([("v1",), ("v2",)], "v string"), settings, "constant", best["test_rmse"]),
    ]).withColumn("check_name", F.concat(F.lit("faulty "), "check_name"))
    return Q.union_all([
        faulty,
        Q.check_table(orders, "orders", [
            Q.NotNull("o_custkey"), Q.InRange("o_totalprice", 1000.0, 450000.0), Q.OneOf("o_orderstatus", ("F", "O")),
            Q.Holds("date known", "o_orderdate is not null"), Q.UniqueKey(("o_orderkey",)), Q.UniqueKey(("o_custkey",))]),
        Q.check_table(lines, "lineitem", [Q.InRange("l_discount", 0.0, 0.1), Q.InRange("l_quantity", 1.0, 40.0)]),
        Q.tables_match(base, base.where(F.col("balance").isNotNull()), ["c_custkey", "event_time"], "customers: complete balances"),
        Q.accounting(cleaned, "cleaning: rows reconcile", "initial_rows",
                     ["missing_key_rows_removed", "duplicate_key_rows_removed", "bad_label_rows_removed"], "final_rows"),
        Q.version_checks(old, new, list(DERIVED), LEAKAGE),
        Q.history_checks(history, PF.lookup_check(spark, d)),
        Q.split_checks(base, membership, "c_custkey", split.test_entities),
        Q.run_checks(runs, versions, settings, best["run_name"], best["test_rmse"]),
    ])


def quality_checks(spark, d):
    return _all_checks(spark, d).drop("detail")


_BEST = f"(SELECT model FROM ({GAPS_SQL}) ORDER BY test_rmse, test_mae, test_r2 DESC, model LIMIT 1)"
_UNCOVERED = "(SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM split_of))"
_TEST_SIZE = "(SELECT count(*) FROM split_of WHERE split = 'test')"


def _listed(names):
    return f"[{', '.join(repr(n) for n in names)}]"


_ADDED = f"(SELECT list_sort(list(f)) FROM (SELECT unnest({_listed(V2.features)}) AS f EXCEPT SELECT unnest({_listed(V1.features)})))"
_CHECKS = [
    ("orders: o_custkey not null", "table", "(SELECT count(*) FROM orders WHERE o_custkey IS NULL) = 0"),
    ("orders: o_totalprice in range", "table", "(SELECT count(*) FROM orders WHERE o_totalprice NOT BETWEEN 1000 AND 450000) = 0"),
    ("orders: o_orderstatus allowed values", "table", "(SELECT count(*) FROM orders WHERE o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'O')) = 0"),
    ("orders: date known", "table", "(SELECT count(*) FROM orders WHERE o_orderdate IS NULL) = 0"),
    ("orders: unique o_orderkey", "table", "(SELECT count(*) - count(DISTINCT o_orderkey) FROM orders) = 0"),
    ("orders: unique o_custkey", "table", "(SELECT count(*) - count(DISTINCT o_custkey) FROM orders) = 0"),
    ("lineitem: l_discount in range", "table", "(SELECT count(*) FROM lineitem WHERE l_discount NOT BETWEEN 0 AND 0.1) = 0"),
    ("lineitem: l_quantity in range", "table", "(SELECT count(*) FROM lineitem WHERE l_quantity NOT BETWEEN 1 AND 40) = 0"),
    ("customers: complete balances", "match", "(SELECT count(*) FROM customers WHERE balance IS NULL) = 0"),
    ("cleaning: rows reconcile", "accounting", "(SELECT count(DISTINCT user_id) FROM events) = (SELECT count(*) FROM dedup)"),
    ("versions: equal row counts", "versions", "(SELECT count(*) FROM customers) = (SELECT count(c_custkey) FROM customers)"),
    ("versions: no leakage", "versions", f"NOT list_has_any({_listed([*V1.features, *V2.features])}, {_listed(LEAKAGE)})"),
    ("versions: expected added features", "versions",
     f"{_ADDED} = list_sort({_listed(DERIVED)})"),
    ("history: rows equal labels", "retrieval", "(SELECT count(*) FROM events WHERE event_type = 'purchase') > 0"),
    ("online: response complete", "retrieval", "(SELECT count(*) FROM customers) > 0"),
    ("split: no overlapping keys", "split", "(SELECT count(*) - count(DISTINCT c_custkey) FROM split_of) = 0"),
    ("split: no duplicate keys", "split", "(SELECT count(*) - count(DISTINCT c_custkey) FROM split_of) = 0"),
    ("split: no uncovered keys", "split", "(SELECT count(*) FROM customers ANTI JOIN split_of USING (c_custkey)) = 0"),
    ("split: no unknown keys", "split", "(SELECT count(*) FROM split_of ANTI JOIN customers USING (c_custkey)) = 0"),
    ("split: no bad values", "split", "(SELECT count(*) FROM split_of WHERE split NOT IN ('train', 'test')) = 0"),
    ("split: test size", "split", f"{_TEST_SIZE} = (SELECT ceil(count(*) * 0.2) FROM customers)"),
    ("runs: grid complete", "runs", f"(SELECT count(DISTINCT model) FROM ({GAPS_SQL})) = {len(PREDICTORS)}"),
    ("runs: metrics present", "runs", f"(SELECT count(*) FROM ({GAPS_SQL}) WHERE train_rmse IS NULL OR test_rmse IS NULL OR test_r2 IS NULL) = 0"),
    ("runs: best run", "runs", f"{_BEST} IS NOT NULL"),
    ("faulty cleaning: rows reconcile", "accounting", "(SELECT count(DISTINCT user_id) FROM events) = (SELECT count(*) + 1 FROM dedup)"),
    ("faulty versions: equal row counts", "versions", "(SELECT count(*) FROM customers) = (SELECT count(c_custkey) FROM customers)"),
    ("faulty versions: no leakage", "versions", f"NOT list_has_any({_listed([*V1.features, *V2.features])}, ['balance'])"),
    ("faulty versions: expected added features", "versions",
     f"{_ADDED} = list_sort({_listed([*DERIVED, 'absent'])})"),
    ("faulty history: rows equal labels", "retrieval", "(SELECT count(*) FROM events WHERE event_type = 'purchase' AND user_id % 7 <> 0) = (SELECT count(*) FROM events WHERE event_type = 'purchase')"),
    ("faulty online: response complete", "retrieval", "(SELECT count(*) FROM customers) > 0"),
    ("faulty split: no overlapping keys", "split", "(SELECT count(*) - count(DISTINCT c_custkey) FROM split_of) = 0"),
    ("faulty split: no duplicate keys", "split", "(SELECT count(*) - count(DISTINCT c_custkey) FROM split_of) = 0"),
    ("faulty split: no uncovered keys", "split", f"{_UNCOVERED} = 0"),
    ("faulty split: no unknown keys", "split", "(SELECT count(*) FROM split_of ANTI JOIN customer USING (c_custkey)) = 0"),
    ("faulty split: no bad values", "split", "(SELECT count(*) FROM split_of WHERE split NOT IN ('train', 'test')) = 0"),
    ("faulty split: test size", "split", f"{_TEST_SIZE} = {_TEST_SIZE} + 1"),
    ("faulty runs: grid complete", "runs", f"(SELECT count(DISTINCT model) FROM ({GAPS_SQL})) = {2 * len(PREDICTORS)}"),
    ("faulty runs: metrics present", "runs", f"(SELECT count(*) FROM ({GAPS_SQL}) WHERE train_rmse IS NULL OR test_rmse IS NULL OR test_r2 IS NULL) = 0"),
    ("faulty runs: best run", "runs", f"{_BEST} = 'constant'"),
]


def quality_roll_up(spark, d):
    return Q.roll_up(_all_checks(spark, d))


def _quality_sql():
    rows = " UNION ALL ".join(
        f"SELECT '{n}' AS check_name, '{c}' AS category, CASE WHEN {ok} THEN 'passed' ELSE 'failed' END AS status" for n, c, ok in _CHECKS)
    return f"WITH {CUSTOMERS_SQL}, {SPLIT_SQL}, {EVENTS_CLEAN_SQL} {rows}"


QUERIES = {
    "entity_split": (entity_split, ENTITY_SPLIT_SQL),
    "split_in_key_order": (split_in_key_order, KEY_ORDER_SPLIT_SQL),
    "split_report": (split_report, SPLIT_REPORT_SQL),
    "split_coverage": (split_coverage, COVERAGE_SQL),
    "apply_split_counts": (apply_split_counts, APPLY_SPLIT_SQL),
    "test_partition": (test_partition, TEST_PARTITION_SQL),
    "validated_join": (validated_join, VALIDATED_JOIN_SQL),
    "exact_sample_orders": (exact_sample_orders, EXACT_SAMPLE_SQL),
    "sample_by_split": (sample_by_split, SAMPLE_BY_SPLIT_SQL),
    "impute_median_mode": (impute_median_mode, IMPUTE_SQL),
    "one_hot_wide": (one_hot_wide, ONE_HOT_SQL),
    "regression_metrics": (regression_metrics, REGRESSION_SQL),
    "generalisation_gaps": (generalisation_gaps, GAPS_SQL),
    "residuals_by_part": (residuals_by_part, RESIDUALS_SQL),
    "leaderboard": (leaderboard, LEADERBOARD_SQL),
    "best_model": (best_model, BEST_MODEL_SQL),
    "forest_predictions": (forest_predictions, None),
    "forest_metrics": (forest_metrics, None),
    "feature_importance": (feature_importance, None),
    "experiment_comparison": (experiment_comparison, None),
    "stored_model_scores": (stored_model_scores, STORED_MODEL_SQL),
    "forest_bounds": (forest_bounds, FOREST_BOUNDS_SQL),
    "importance_total": (importance_total, IMPORTANCE_SQL),
    "importance_check": (importance_check, IMPORTANCE_CHECK_SQL),
    "tree_splits": (tree_splits, TREE_SPLITS_SQL),
    "grid_gaps_users_days": (grid_gaps_users_days, GRID_GAPS_SQL),
    "quality_checks": (quality_checks, _quality_sql()),
    "quality_roll_up": (quality_roll_up, f"SELECT count(*) AS checks, count(*) FILTER (status = 'passed') AS passed, count(*) FILTER (status = 'failed') AS failed FROM ({_quality_sql()})"),
}
