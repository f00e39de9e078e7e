from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from keelson.operators import clean as C
from keelson.operators.keys import keep_latest, key_counts
from keelson.presets import COMPONENTS, LABEL, strength_rules
from keelson.spec import CleaningRules, ContractError

RULES = strength_rules("record_id")


def run(df):
    return C.clean(df, RULES, "pos")


def rows(result):
    return {r["record_id"]: r for r in result.data.collect()}


def test_label_is_the_sum_of_components(raw):
    assert rows(run(raw()))[11][LABEL] == 605.0


def test_value_out_of_range_removes_the_row_and_is_counted(raw):
    result = run(raw())
    assert sorted(rows(result)) == [11, 12]
    report = {r["column_name"]: r for r in result.range_report().collect()}
    assert report["snatch"]["invalid_value_count"] == 1 and report["age"]["invalid_value_count"] == 0
    assert (report["snatch"]["minimum"], report["snatch"]["maximum"]) == (1.0, 496.0)


def test_sentinels_in_all_components(raw):
    result = run(raw({(0, c): 1.0 for c in COMPONENTS}))
    assert sorted(rows(result)) == [12]
    assert {r["column_name"]: r["sentinel_replacement_count"] for r in result.sentinel_report().collect()} == dict.fromkeys(COMPONENTS, 1)
    assert result.sentinel_report().first()["sentinel_values"] == [1.0]
    s = result.summary().first()
    assert s["sentinels_replaced"] == 4


def test_single_sentinel_removes_only_its_row(raw):
    result = run(raw({(1, "candj"): 1.0}))
    assert sorted(rows(result)) == [11]
    # a sentinel is removed before the range rule, so it is not counted twice
    assert {r["column_name"]: r["invalid_value_count"] for r in result.range_report().collect()}["candj"] == 0


def test_no_answer_becomes_missing_and_case_is_kept(raw):
    got = rows(run(raw()))
    assert got[12]["howlong"] is None and got[12]["background"] is None
    assert got[11]["gender"] == "Female"


def test_missing_predictor_is_preserved(raw):
    got = rows(run(raw({(0, "weight"): None})))
    assert 11 in got and got[11]["weight"] is None


def test_nan_predictor_is_missing(raw):
    result = run(raw({(0, "weight"): float("nan")}))
    assert rows(result)[11]["weight"] is None
    assert {r["column_name"]: r["invalid_value_count"] for r in result.range_report().collect()}["weight"] == 0


def test_labels_and_predictors(raw):
    result = run(raw())
    assert result.labels.columns == ["record_id", "event_timestamp", LABEL]
    assert not set(result.predictors.columns) & {LABEL, *COMPONENTS}
    assert {(r[0], r[2]) for r in result.labels.collect()} == {(k, r[LABEL]) for k, r in rows(result).items()}


def test_event_time_is_complete_utc(raw):
    result = run(raw({(1, "retrieved_datetime"): "unreadable"}))
    times = {r["record_id"]: r["t"] for r in result.data.select("record_id", F.col("event_timestamp").cast("string").alias("t")).collect()}
    assert times == {11: "2023-05-04 08:30:00", 12: "2024-01-01 00:00:01"}


def test_fallback_time_without_source_column(raw):
    result = C.clean(raw().drop("retrieved_datetime"), RULES, "pos")
    times = [r[0] for r in result.data.orderBy("record_id").select(F.col("event_timestamp").cast("string")).collect()]
    assert times == ["2024-01-01 00:00:00", "2024-01-01 00:00:01"]


def test_latest_row_wins_before_the_label_filter(raw, raw_rows, raw_schema, spark):
    old = list(raw_rows[0])
    old[0], old[1], old[2], old[12:16] = 77.0, "2022-03-01T00:00:00Z", 33.0, [120.0, 90.0, 60.0, 110.0]
    new = list(old)
    new[1], new[2], new[12:16], new[16] = "2022-09-15T00:00:00Z", 34.0, [130.0, 95.0, 70.0, 125.0], 1
    result = run(spark.createDataFrame([tuple(old), tuple(new)], raw_schema))
    row = result.data.collect()
    assert len(row) == 1 and row[0]["age"] == 34.0 and row[0][LABEL] == 420.0
    assert result.summary().first()["duplicate_key_rows_removed"] == 1
    bad = list(new)
    bad[12] = 5000.0
    assert run(spark.createDataFrame([tuple(old), tuple(bad)], raw_schema)).data.count() == 0


def test_equal_times_keep_the_later_row(raw, raw_rows):
    twin = list(raw_rows[0])
    twin[2], twin[16] = 44.0, 9
    assert rows(run(raw(rows=[raw_rows[0], tuple(twin)])))[11]["age"] == 44.0
    assert rows(run(raw(rows=[tuple(twin), raw_rows[0]])))[11]["age"] == 44.0


def test_missing_key_is_dropped_and_counted(raw):
    s = run(raw({(0, "record_id"): None})).summary().first()
    assert s["missing_key_rows_removed"] == 1 and s["final_rows"] == 1


def test_key_is_truncated_to_integer(raw):
    assert 11 in rows(run(raw({(0, "record_id"): 11.7})))


def test_large_keys_stay_apart(raw, raw_rows, raw_schema, spark):
    for kind, keys in (("long", (2**53, 2**53 + 1)), ("string", (" 9007199254740992", "+9007199254740993"))):
        data = [(k, *raw_rows[0][1:]) for k in keys]
        result = run(spark.createDataFrame(data, raw_schema.replace("record_id double", f"record_id {kind}")))
        assert sorted(rows(result)) == [2**53, 2**53 + 1]


def test_shared_results_are_the_same(raw):
    result, shared = run(raw({(1, "snatch"): 1.0})), run(raw({(1, "snatch"): 1.0})).shared()
    assert rows(result) == rows(shared) and result.summary().first() == shared.summary().first()
    assert result.range_report().collect() == shared.range_report().collect()


def test_accounting(raw):
    s = run(raw({(0, "record_id"): None})).summary().first()
    assert s["initial_rows"] - s["missing_key_rows_removed"] - s["duplicate_key_rows_removed"] - s["bad_label_rows_removed"] == s["final_rows"]
    s = run(raw()).summary().first()
    assert (s["label_min"], s["label_max"], s["label_mean"], s["label_median"]) == (605.0, 1320.0, 962.5, 962.5)
    assert s["missing_predictor_cells"] == 2 and s["final_columns"] == 18


def test_no_sentinel_remains(raw):
    result = run(raw({(1, "snatch"): 1.0, (0, "candj"): 1.0}))
    assert result.data.where(" or ".join(f"{c} = 1" for c in COMPONENTS)).count() == 0


def test_repeat_and_repartition_give_the_same(raw):
    a, b = run(raw()), run(raw().repartition(7))
    assert rows(a) == rows(b) and a.summary().first() == b.summary().first()


def test_single_rule_operators(raw):
    df, sentinel = C.replace_sentinels(raw({(0, "snatch"): 1.0}), ["snatch", "candj"], [1.0, 260.0])
    assert {r["column_name"]: r["sentinel_replacement_count"] for r in sentinel.collect()} == {"snatch": 1, "candj": 1}
    df, ranged = C.apply_ranges(df, {"age": (20, 30), "absent": (0, 1)})
    assert [tuple(r) for r in ranged.collect()] == [("age", 20.0, 30.0, 2)]
    assert df.where("age is not null").count() == 1
    with pytest.raises(ContractError):
        C.replace_sentinels(raw(), ["absent"], [1.0])


def test_rules_from_mapping():
    rules = CleaningRules.from_mapping({
        "identifier_column": "k", "event_timestamp_column": "t", "source_timestamp_column": "s", "target_components": ["a"],
        "target_sentinel_values": [1], "numeric_columns": ["k", "a"], "categorical_columns": ["c"],
        "invalid_response_values": ["NA"], "plausible_ranges": {"a": {"min": 1, "max": 5}}}, label="y")
    assert rules == CleaningRules("k", "t", "s", ("a",), "y", (1,), ("k", "a"), ("c",), ("NA",), {"a": (1.0, 5.0)})


def test_missing_columns_are_named(raw):
    with pytest.raises(ContractError, match="backsq"):
        C.clean(raw().drop("backsq"), RULES, "pos")


def test_custom_label_name(raw):
    assert "y" in C.clean(raw(), replace(RULES, label="y"), "pos").data.columns


def test_keep_latest_and_key_counts(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1), 1, "a"), (1, datetime(2024, 1, 1), 2, "b"), (2, datetime(2024, 1, 3), 1, "c"),
                                (None, datetime(2024, 1, 3), 1, "d"), (None, datetime(2024, 1, 4), 1, "e")], "k long, t timestamp, o long, v string")
    assert {(r["k"], r["v"]) for r in keep_latest(df, "k", "t", "o").collect()} == {(1, "b"), (2, "c"), (None, "e")}
    assert key_counts(df, "k").first().asDict() == {
        "row_count": 5, "missing_keys": 2, "distinct_keys": 2, "superseded_rows": 1, "duplicated_key_rows": 2}


def test_counts_taken_while_writing_are_those_of_the_reports(spark, raw, tmp_path):
    for i, edits in enumerate(({}, {(0, c): 1.0 for c in COMPONENTS}, {(0, "record_id"): None, (1, "candj"): 1.0}, {(k, "record_id"): None for k in range(3)})):
        result = run(raw(edits))
        jobs = spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup(f"write-{i}", "")
        written = result.write(str(tmp_path / f"cleaned-{i}"))
        written.summary(median=False).collect(), written.sentinel_report().collect(), written.range_report().collect()
        scans = len(jobs.getJobIdsForGroup(f"write-{i}"))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert scans <= 5  # the write, and the local report tables
        for ours, theirs in ((written.summary(), result.summary()), (written.sentinel_report(), result.sentinel_report()), (written.range_report(), result.range_report())):
            assert ours.columns == theirs.columns and sorted(map(tuple, ours.collect()), key=repr) == sorted(map(tuple, theirs.collect()), key=repr)
        assert sorted(map(tuple, written.data.collect())) == sorted(map(tuple, result.data.collect()))
