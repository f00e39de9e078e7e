from datetime import datetime

import pytest

from keelson.functions.digest import fingerprint
from keelson.operators import clean, compare, features, metrics, profile, quality, ranks, retrieve, split
from keelson.operators.asof import AsOfSide, as_of_join
from keelson.presets import strength_rules
from keelson.spec import ContractError


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "k long, t timestamp, x double, s string, split string")


def test_profiles_of_an_empty_table(empty):
    one = profile.overview(empty, "k").first().asDict()
    assert one["row_count"] == 0 and one["missing_cell_percentage"] is None and one["distinct_keys"] == 0
    got = profile.numeric_summary(empty).where("column_name = 'x'").first()
    assert got["count"] == 0 and got["p50"] is None
    assert profile.column_profile(empty).count() == 0 and profile.categorical_summary(empty).count() == 0
    assert profile.histogram(empty, "x", 4, "s").count() == 0
    assert profile.target_statistics(empty, "x", "split").count() == 0
    assert ranks.column_quantiles(empty, ["x"], [0.5]) == {"x": [None]}


def test_empty_cleaning(raw):
    result = clean.clean(raw().limit(0), strength_rules("record_id"), "pos")
    s = result.summary().first()
    assert s["initial_rows"] == 0 and s["final_rows"] == 0 and s["label_median"] is None and result.labels.count() == 0
    assert [r["sentinel_replacement_count"] for r in result.sentinel_report().collect()] == [0] * 4


def test_empty_joins_and_checks(spark, empty):
    labels = spark.createDataFrame([(1, datetime(2024, 1, 1))], "k long, t timestamp")
    got = as_of_join(labels, "k", "t", [AsOfSide(empty, "k", "t", ("x", "s"))])
    assert [tuple(r)[2:] for r in got.collect()] == [(None, None)]
    assert as_of_join(empty.select("k", "t"), "k", "t", [AsOfSide(empty, "k", "t", ("x",))]).count() == 0
    assert retrieve.materialize(empty, "k", "t", ["x"]).count() == 0
    assert compare.same_rows(empty, empty, ["k", "x"]) and not compare.same_rows(empty, labels.selectExpr("k", "1.0D as x"), ["k", "x"])
    assert fingerprint(empty).first()["row_count"] == 0
    assert features.integrity(empty, "k", "t").first()["row_count"] == 0
    assert metrics.regression_metrics(empty, "x", "x", ["split"]).count() == 0
    assert {r["status"] for r in quality.check_table(empty, "e", [quality.NotNull("k"), quality.UniqueKey(("k",))]).collect()} == {"passed"}
    with pytest.raises(ContractError):
        split.split_entities(empty, "k", 0.2)
    assert split.exact_sample(empty, "k", 5).count() == 0


def test_extreme_values_in_quantiles(spark):
    values = [-1e300, -5.0, 0.0, 1e-300, 7.0, 1e300] * 50
    df = spark.createDataFrame([("a", v) for v in values], "series string, value double")
    got = ranks.exact_quantiles(df, [0.0, 0.4, 1.0]).first()["quantiles"]
    assert got[0] == -1e300 and got[2] == 1e300 and got[1] == pytest.approx(0.0, abs=1e-250)


def test_names_with_odd_characters(spark):
    df = spark.createDataFrame([(1, None, "q"), (2, 3.0, None)], "`a key` long, `x.y` double, `s p` string")
    renamed = df.withColumnsRenamed({"x.y": "x y"})
    assert fingerprint(renamed).first()["row_count"] == 2
    assert profile.overview(renamed, "a key").first()["missing_cells"] == 2
    assert {r["column_name"]: r["missing_count"] for r in profile.column_profile(renamed).collect()} == {"a key": 0, "x y": 1, "s p": 1}
