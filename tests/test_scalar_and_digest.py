from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions import scalar as S
from keelson.functions.digest import fingerprint, schema_fingerprint


def one(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_text_is_stripped_of_all_white_space_and_tokens_ignore_case(spark):
    df = spark.createDataFrame([("\t Male \n",), ("DECLINE to answer ",), ("",), (None,), (" None of them",)], "t string")
    assert one(df, S.clean_text(F.col("t"), ["Decline to answer", "", "none"])) == ["Male", None, None, None, "None of them"]


def test_numbers_from_text(spark):
    texts = [" 12 ", "1e3", "-.5", "1d", "0x1", "abc", "", None, "inf", "nan", "+7.", "1_000"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert one(df, S.to_number(F.col("t"), T.StringType())) == [
        12.0, 1000.0, -0.5, None, None, None, None, None, float("inf"), None, 7.0, None]


def test_nan_is_missing_for_rules(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (9.0,)], "x double")
    x = S.canon(F.col("x"))
    assert one(df, S.null_outside(x, 1, 5)) == [1.0, None, None, None]
    assert one(df, S.is_violation(x, 1, 5)) == [False, False, False, True]


def test_ratio_and_finite(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (0.0, 0.0), (None, 1.0)], "a double, b double")
    assert one(df, S.safe_ratio(F.col("a"), F.col("b"))) == [0.5, None, None, None]
    inf = spark.createDataFrame([(float("inf"),), (float("-inf"),), (float("nan"),), (3.0,)], "x double")
    assert one(inf, S.finite(F.col("x"))) == [None, None, None, 3.0]


def test_times_from_text(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00Z",), ("03/02/2024",), ("soon",), (None,)], "t string")
    got = one(df, S.to_time(F.col("t"), T.StringType(), ["dd/MM/yyyy"]).cast("string"))
    assert got == ["2024-01-01 10:00:00", "2024-02-03 00:00:00", None, None]


def test_report_rounding_is_half_even(spark):
    df = spark.createDataFrame([(2.5,), (3.5,)], "x double")
    assert one(df, S.report_round(F.col("x"), 0)) == [2.0, 4.0]


@pytest.mark.parametrize("portable", [False, True])
def test_fingerprint_ignores_layout_and_notices_every_change(spark, portable):
    def mark(df):
        return fingerprint(df, portable=portable).first()

    rows = [(i, float(i % 7) if i % 5 else None, f"v{i % 3}", datetime(2024, 1, 1, 0, 0, i % 60)) for i in range(10_000)]
    schema = "k long, x double, s string, t timestamp"
    base = spark.createDataFrame(rows, schema)
    want = mark(base)
    for n in (1, 4, 17):
        assert mark(base.orderBy(F.rand(n)).repartition(n)) == want
    edited = list(rows)
    edited[77] = (77, edited[77][1], "other", edited[77][3])
    assert mark(spark.createDataFrame(edited, schema)) != want
    assert mark(spark.createDataFrame(rows + rows[:1], schema)) != want
    assert len(want["data_fingerprint"]) == 64


@pytest.mark.parametrize("portable", [False, True])
def test_fingerprint_has_one_form_per_value_and_no_ambiguity(spark, portable):
    def mark(df):
        return fingerprint(df, portable=portable).first()

    a = spark.createDataFrame([(0.0, "a", "bc"), (None, "N", None)], "x double, p string, q string")
    b = spark.createDataFrame([(-0.0, "a", "bc"), (float("nan"), "N", None)], "x double, p string, q string")
    c = spark.createDataFrame([(0.0, "ab", "c"), (None, "N", None)], "x double, p string, q string")
    d = spark.createDataFrame([(0.0, "a", "bc"), (None, None, "N")], "x double, p string, q string")
    assert mark(a) == mark(b)
    assert mark(a) != mark(c)
    assert mark(a) != mark(d)


def test_schema_fingerprint_sees_names_types_and_order(spark):
    def mark(ddl):
        return schema_fingerprint(spark.createDataFrame([], ddl).schema)

    assert mark("a int, b string") == mark("a int, b string")
    assert len({mark("a int, b string"), mark("b string, a int"), mark("a long, b string"), mark("a int, c string")}) == 4
