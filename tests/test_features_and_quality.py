from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from keelson.operators import features as B
from keelson.operators import quality as Q
from keelson.operators.compare import require_alignment
from keelson.operators.metrics import best_model, leaderboard, regression_metrics, require_best, with_gaps
from keelson.presets import COMPONENTS, DERIVED, LABEL, RUNS, strength_features
from keelson.spec import ContractError, FeatureSpec, RunSpec
from keelson.operators.runs import require_grid

V1, V2 = strength_features("record_id", "v1"), strength_features("record_id", "v2")
SCHEMA = ("record_id long, event_timestamp timestamp, age double, weight double, height double, gender string, region string, "
          "deadlift double, candj double, snatch double, backsq double, total_lift double")


@pytest.fixture(scope="module")
def processed(spark):
    return spark.createDataFrame([
        (71, datetime(2023, 4, 9), 52.0, 140.0, 63.0, "Female", "Coast", 200.0, 110.0, 90.0, 170.0, 570.0),
        (72, datetime(2023, 8, 2), 17.0, None, 69.0, "Male", None, 330.0, 190.0, 150.0, 300.0, 970.0)], SCHEMA)


def test_columns_in_spec_order(processed):
    assert B.build(processed, V1).data.columns == ["record_id", "event_timestamp", "age", "weight", "height", "gender", "region"]
    assert B.build(processed, V2).data.columns[-3:] == list(DERIVED)


def test_derived_values_and_missing(processed):
    got = {r["record_id"]: r for r in B.build(processed, V2).data.collect()}
    assert got[71]["bmi"] == pytest.approx(703 * 140 / 63 ** 2) and got[71]["age_squared"] == 2704.0
    assert got[71]["weight_height_ratio"] == pytest.approx(140 / 63)
    assert (got[72]["bmi"], got[72]["age_squared"], got[72]["weight_height_ratio"]) == (None, 289.0, None)
    zero = B.derive(processed.withColumn("height", F.lit(0.0)), DERIVED).first()
    assert zero["bmi"] is None and zero["weight_height_ratio"] is None


def test_spec_contract():
    with pytest.raises(ContractError, match="leakage"):
        replace(V1, numeric=(*V1.numeric, LABEL), features=(*V1.features, LABEL))
    with pytest.raises(ContractError, match="duplicate"):
        replace(V1, features=(*V1.features, "age"))
    with pytest.raises(ContractError, match="both"):
        replace(V1, categorical=(*V1.categorical, "age"))
    with pytest.raises(ContractError, match="untyped"):
        replace(V1, features=(*V1.features, "extra"))
    with pytest.raises(ContractError, match="no features"):
        FeatureSpec("v", "n", "k", "t", (), ())
    with pytest.raises(ContractError, match="unknown"):
        FeatureSpec.from_mapping("v9", {"feature_versions": {}})


def test_spec_from_mapping():
    m = {"feature_versions": {"v2": {
        "name": "strength_features_v2", "parent_version": "v1", "entity_key": "record_id", "timestamp_column": "event_timestamp",
        "features": list(V2.features), "numerical_features": list(V2.numeric), "categorical_features": list(V2.categorical),
        "target_leakage_columns": [LABEL, *COMPONENTS]}}}
    assert FeatureSpec.from_mapping("v2", m, DERIVED) == V2


def test_broken_inputs_are_refused(processed):
    with pytest.raises(ContractError, match="region"):
        B.build(processed.drop("region"), V1)
    with pytest.raises(ContractError, match="duplicate_keys"):
        B.build(processed.union(processed.limit(1)), V1)
    with pytest.raises(ContractError, match="missing_times"):
        B.build(processed.withColumn("event_timestamp", F.lit(None).cast("timestamp")), V1)
    with pytest.raises(ContractError, match="missing_keys"):
        B.build(processed.withColumn("record_id", F.lit(None).cast("long")), V1)


def test_manifest_lineage_and_comparison(processed):
    a, b = B.build(processed, V1), B.build(processed, V2)
    ma = a.manifest()
    r = ma.first()
    assert (r["row_count"], r["entity_count"], r["duplicate_entity_count"], r["missing_feature_values"], r["feature_count"]) == (2, 2, 0, 2, 5)
    assert len(r["data_fingerprint"]) == len(r["schema_fingerprint"]) == 64 and r["excluded_columns"] == [LABEL, *COMPONENTS]
    assert B.build(processed.repartition(3), V1).manifest().first() == r
    mb = b.manifest(ma, True).first()
    assert (mb["parent_version"], mb["parent_fingerprint"], mb["same_population"]) == ("v1", r["data_fingerprint"], True)
    assert mb["transformations"][1] == "age_squared = pow(age, 2)"
    c = B.compare_versions(ma, b.manifest()).first()
    assert c["added_features"] == list(DERIVED) and c["removed_features"] == [] and c["old_rows"] == c["new_rows"] == 2


def test_reports(processed):
    got = {r["feature"]: r.asDict() for r in B.build(processed, V2).missingness().collect()}
    assert got["bmi"]["missing_count"] == 1 and got["bmi"]["missing_percentage"] == 50.0 and got["gender"]["feature_type"] == "categorical"
    schema = {r["column_name"]: r["has_missing"] for r in B.build(processed, V1).schema().collect()}
    assert schema["weight"] and not schema["age"]


def test_training_dataset(processed):
    clean = processed.drop(*COMPONENTS)
    got = B.training_dataset(clean, V1, LABEL)
    assert got.columns == ["record_id", "event_timestamp", LABEL, *V1.features]
    with pytest.raises(ContractError, match="leakage"):
        B.training_dataset(processed, V1, LABEL)
    with pytest.raises(ContractError, match="missing_targets"):
        B.training_dataset(clean.withColumn(LABEL, F.lit("x")), V1, LABEL)
    require_alignment(got, B.training_dataset(B.derive(clean, DERIVED), V2, LABEL), ["record_id", "event_timestamp", LABEL])


def test_metrics_and_ranking(spark):
    df = spark.createDataFrame([("a", 1.0, 1.5), ("a", 3.0, 2.5), ("b", 2.0, 2.0), ("b", 2.0, 2.0), ("c", 2.0, 1.0), ("c", 2.0, 1.0), ("d", 1.0, 1.0)],
                               "m string, y double, p double")
    got = {r["m"]: r.asDict() for r in regression_metrics(df, "y", "p", ["m"]).collect()}
    assert got["a"] == {"m": "a", "n": 2, "rmse": 0.5, "mae": 0.5, "r2": 0.75}
    assert got["b"]["r2"] == 1.0 and got["c"]["r2"] == 0.0 and got["d"]["r2"] is None
    runs = spark.createDataFrame([("oak", 7.25, 6.0, 0.8), ("elm", 7.25, 5.5, 0.4), ("fir", 8.0, 0.5, 0.95)],
                                 "run_name string, test_rmse double, test_mae double, test_r2 double")
    assert require_best(runs, "run_name")["run_name"] == "elm"
    assert [r["run_name"] for r in leaderboard(runs, "run_name", prefix="test_").orderBy("rank").collect()] == ["elm", "oak", "fir"]
    four = spark.createDataFrame([(f"r{i}", float(x), 1.0, 0.1) for i, x in enumerate((9, 6, 11, 3))], runs.schema)
    assert best_model(four, "run_name", prefix="test_").first()["run_name"] == "r3"
    with pytest.raises(ContractError, match="test_mae"):
        best_model(runs.drop("test_mae"), "run_name", prefix="test_")
    with pytest.raises(ContractError, match="no runs"):
        require_best(runs.limit(0), "run_name")


def test_run_grid_rules():
    require_grid(RUNS, ["v1", "v2"], ["hp1", "hp2"])
    with pytest.raises(ContractError, match="incomplete"):
        require_grid(RUNS[1:], ["v1", "v2"], ["hp1", "hp2"])
    with pytest.raises(ContractError, match="duplicate"):
        require_grid([*RUNS, RunSpec("other", "v1", "hp1")], ["v1", "v2"], ["hp1", "hp2"])
    with pytest.raises(ContractError, match="unique"):
        require_grid([RunSpec("x", "v1", "hp1"), RunSpec("x", "v2", "hp1")], ["v1", "v2"], ["hp1"])


def statuses(df):
    return {r["check_name"]: r["status"] for r in df.collect()}


def test_table_checks(spark):
    df = spark.createDataFrame([(1, 5.0, "a"), (1, None, "z"), (2, 50.0, None)], "k long, x double, s string")
    got = Q.check_table(df, "t", [Q.NotNull("k"), Q.NotNull("x"), Q.InRange("x", 0, 10), Q.OneOf("s", ("a", "z")), Q.RowCount(3),
                                  Q.UniqueKey(("k",)), Q.UniqueKey(("k", "x")), Q.Holds("positive", "x > 0")])
    assert statuses(got) == {
        "t: k not null": "passed", "t: x not null": "failed", "t: x in range": "failed", "t: s allowed values": "failed", "t: row count": "passed",
        "t: unique k": "failed", "t: unique k, x": "passed", "t: positive": "failed"}
    assert Q.roll_up(got).first().asDict() == {"checks": 8, "passed": 3, "failed": 5}


def test_report_checks(spark, processed):
    a, b = B.build(processed, V1).manifest(), B.build(processed, V2).manifest()
    assert set(statuses(Q.version_checks(a, b, list(DERIVED), [LABEL], 2)).values()) == {"passed"}
    bad = statuses(Q.version_checks(a, b, ["bmi"], ["age"], 81))
    assert bad == {"versions: equal row counts": "passed", "versions: no leakage": "failed",
                   "versions: expected added features": "failed", "versions: expected population": "failed"}
    one = spark.createDataFrame([(10, 3, 2, 5)], "total long, a long, b long, final long")
    assert statuses(Q.accounting(one, "rows", "total", ["a", "b"], "final")) == {"rows": "passed"}
    runs = spark.createDataFrame([(r.run_name, r.feature_version, r.settings, 1.0, 1.0, 0.5, float(i), 1.0, 0.5) for i, r in enumerate(RUNS)],
                                 "run_name string, feature_version string, settings string, train_rmse double, train_mae double, "
                                 "train_r2 double, test_rmse double, test_mae double, test_r2 double")
    grid = (runs.select("feature_version"), runs.select("settings"))
    assert set(statuses(Q.run_checks(runs, *grid, "v1_hp1", 0.0)).values()) == {"passed"}
    broken = statuses(Q.run_checks(runs.where("run_name <> 'v2_hp2'").withColumn("test_mae", F.lit(None).cast("double")), *grid, "v2_hp1", 1.0))
    assert broken == {"runs: grid complete": "failed", "runs: metrics present": "failed", "runs: best run": "failed"}
    assert with_gaps(runs).first()["rmse_gap"] == -1.0
