import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from keelson.operators import profile as P
from keelson.operators import ranks as R

NAN = float("nan")


@pytest.fixture(scope="module")
def mixed(spark):
    rows = [(1, 1.0, "a", None), (1, 1.0, "a", None), (2, NAN, "b", "x"), (None, None, None, "x"), (3, -0.0, "a", ""), (3, 0.0, "c", "y")]
    return spark.createDataFrame(rows, "k long, x double, s string, u string")


def test_overview(mixed):
    r = P.overview(mixed, "k").first().asDict()
    assert r == {"row_count": 6, "column_count": 4, "duplicate_rows": 1, "missing_cells": 6, "missing_cell_percentage": 25.0,
                 "missing_keys": 1, "distinct_keys": 3, "duplicated_key_rows": 4}


def test_overview_treats_equal_nulls_as_equal(spark):
    df = spark.createDataFrame([(None, None), (None, None), (1, None)], "k long, x double")
    assert P.overview(df, "k").first()["duplicate_rows"] == 1


def test_column_profile(mixed):
    got = {r["column_name"]: r.asDict() for r in P.column_profile(mixed).collect()}
    assert (got["x"]["non_null_count"], got["x"]["missing_count"], got["x"]["unique_count"]) == (4, 2, 2)
    assert got["x"]["missing_percentage"] == 33.33 and got["x"]["data_type"] == "double"
    assert got["u"]["unique_count"] == 3 and got["s"]["column_position"] == 2
    approx = {r["column_name"]: r.asDict() for r in P.column_profile(mixed, approx=True).collect()}
    assert {k: v["missing_count"] for k, v in approx.items()} == {k: v["missing_count"] for k, v in got.items()}


def test_missing_report_is_ordered(mixed):
    got = [r["column_name"] for r in P.missing_report(P.column_profile(mixed), 2).collect()]
    assert got == ["x", "u"]


def test_long_texts_are_still_told_apart(spark):
    df = spark.createDataFrame([("a" * 500,), ("a" * 499 + "b",), ("a" * 500,)], "t string")
    assert P.column_profile(df).first()["unique_count"] == 2
    top = P.categorical_summary(df).first()
    assert top["most_frequent_value"] == "a" * 500 and top["most_frequent_count"] == 2


def test_ties_of_long_texts_go_to_the_smaller_text(spark):
    stem = "é" * 64
    texts = [stem + "b" * 400, stem + "a" * 300 + "z", stem + "a" * 300 + "y", stem + "c", "#short", "z" * 80]
    rows = [(t, t[:65], stem if i % 2 else t) for i, t in enumerate(texts) for _ in range(1 if t[0] in "#z" else 2)]
    df = spark.createDataFrame(rows, "long string, cut string, mixed string").repartition(3)
    got = {r["column_name"]: (r["unique_count"], r["most_frequent_value"], r["most_frequent_count"]) for r in P.categorical_summary(df).collect()}
    for c in df.columns:
        counts = df.groupBy(c).count().orderBy(F.desc("count"), c).collect()
        assert got[c] == (len(counts), counts[0][c], counts[0]["count"])


def test_numeric_summary_agrees_with_pandas(spark):
    rnd = random.Random(3)
    pdf = pd.DataFrame({"a": [rnd.gauss(0, 5) for _ in range(501)], "b": [float(rnd.randint(0, 3)) for _ in range(501)], "c": [7.0] * 501})
    got = P.numeric_summary(spark.createDataFrame(pdf)).toPandas().set_index("column_name").sort_index()
    want = pdf.describe().transpose().sort_index()
    assert np.allclose(got.to_numpy(dtype=float), want.to_numpy(dtype=float))
    assert P.numeric_summary(spark.createDataFrame([("x",)], "s string")).count() == 0


def test_categorical_summary_lets_missing_win(spark):
    df = spark.createDataFrame([("a", "q"), (None, "p"), (None, "q"), (None, "p")], "s string, t string")
    got = {r["column_name"]: tuple(r)[1:] for r in P.categorical_summary(df).collect()}
    assert got == {"s": (1, 3, None, 3), "t": (2, 0, "p", 2)}


@pytest.mark.parametrize("accuracy", [50, 10_000])
def test_bracketed_quantiles_are_exact(spark, accuracy, monkeypatch):
    monkeypatch.setattr(R, "ACCURACY", accuracy)  # a coarse sketch needs wide brackets, results stay exact
    rnd = random.Random(accuracy)
    # one value fills a third, tails are heavy, one series is constant
    data = [("hot", 5.0 if rnd.random() < 0.33 else rnd.lognormvariate(0, 4)) for _ in range(4000)]
    data += [("const", 2.0)] * 50 + [("two", 1.0), ("two", 2.0)] + [("none", None)]
    df = spark.createDataFrame(data, "series string, value double").repartition(6)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {r["series"]: r["quantiles"] for r in R.exact_quantiles(df, probs).collect()}
    for name in ("hot", "const", "two"):
        values = [v for s, v in data if s == name]
        assert np.allclose(got[name], np.quantile(values, probs), rtol=1e-12)
    assert got["none"] is None


def test_ranks_of_integers_do_not_lose_digits(spark, monkeypatch):
    monkeypatch.setattr(R, "ACCURACY", 100)
    base = 2 ** 60
    values = [base + i * i for i in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "value long").repartition(5)
    assert [R.value_at_rank(df, "value", r, 3000) for r in (0, 1234, 2999)] == [values[0], values[1234], values[2999]]


def test_quantiles_with_infinities_end(spark):
    inf = float("inf")
    values = [-inf, inf, inf] + [float(i) for i in range(2000)] + [float("nan")] * 5
    df = spark.createDataFrame([(v, -v) for v in values], "x double, y double").repartition(3)
    known = sorted(v for v in values if v == v)
    got = R.column_quantiles(df, ["x", "y"], [0.0, 0.5, 1.0])
    assert got["x"] == [-inf, known[1001], inf] and got["y"] == [-inf, -known[1001], inf]
    series = R.exact_quantiles(df.selectExpr("1 AS series", "x AS value"), [0.0, 0.5, 1.0]).first()["quantiles"]
    assert series == got["x"]


def test_quantiles_and_histograms_of_many_series(spark):
    df = spark.range(36_000).selectExpr("id % 12000 AS series", "double(id div 12000) AS value")
    got = R.exact_quantiles(df, [0.5]).agg(F.count(F.lit(1)), F.min(F.col("quantiles")[0]), F.max(F.col("quantiles")[0])).first()
    assert tuple(got) == (12_000, 1.0, 1.0)
    assert tuple(P.histogram(df, "value", 2, "series").agg(F.count(F.lit(1)), F.sum("n")).first()) == (24_000, 36_000)


def test_density_counts_rows_in_the_given_range_only(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 3, 50, 90)], "v double")
    got = P.histogram(df, "v", 2, low=0.0, high=4.0).collect()
    assert [r["n"] for r in got] == [2, 2] and sum(r["density"] * 2 for r in got) == pytest.approx(1)


@pytest.mark.parametrize("n", [1, 4, 17])
def test_row_position_does_not_depend_on_layout(spark, n):
    keys = list(range(5000))
    random.Random(n).shuffle(keys)
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(n)
    got = R.with_ordinal(df, ["k"]).collect()
    assert all(r["k"] == r["row_position"] for r in got) and len(got) == 5000


def test_file_position(spark, tmp_path):
    spark.range(1000).repartitionByRange(5, "id").sortWithinPartitions("id").write.parquet(str(tmp_path / "t"))
    got = R.with_file_ordinal(spark.read.parquet(str(tmp_path / "t"))).collect()
    assert all(r["id"] == r["row_position"] for r in got) and len(got) == 1000


def test_hash_threshold_selects_exactly(spark):
    df = spark.range(3000).select(F.md5(F.col("id").cast("string")).alias("h"))
    ordered = sorted(r[0] for r in df.collect())
    for k in (1, 17, 2999, 3000):
        assert R.hash_threshold(df, "h", k, bucket_rows=5) == (ordered[k - 1], 3000)
        assert R.hash_threshold(df, "h", lambda n: n - 3000 + k) == (ordered[k - 1], 3000)
    assert R.hash_threshold(df, "h", 5000) == (ordered[-1], 3000)
    assert R.hash_threshold(df, "h", 0) == (None, 3000)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(i), "a") for i in range(11)] + [(4.0, "b"), (4.0, "b"), (None, "a"), (NAN, "a")], "x double, s string")
    got = P.histogram(df, "x", 5, "s").orderBy("series", "bin").collect()
    assert [r["n"] for r in got if r["series"] == "a"] == [2, 2, 2, 2, 3]
    assert [(r["bin"], r["n"]) for r in got if r["series"] == "b"] == [(1, 2)]
    assert abs(sum(r["density"] * 2.0 for r in got if r["series"] == "a") - 1) < 1e-12


def test_derived_summary_of_all_missing(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0)], "a double, b double")
    got = {r["feature"]: r.asDict() for r in P.derived_summary(df, ["a", "b"]).collect()}
    assert got["a"]["median"] is None and got["a"]["missing_percentage"] == 100.0 and got["b"]["median"] == 2.0


def test_target_statistics(spark):
    df = spark.createDataFrame([(1.0, "train"), (2.0, "train"), (6.0, "test")], "y double, split string")
    got = {r["population"]: r.asDict() for r in P.target_statistics(df, "y", "split").collect()}
    assert got["all"]["count"] == 3 and got["all"]["median"] == 2.0 and got["train"]["mean"] == 1.5 and got["test"]["std"] is None
    assert P.target_statistics(df, "y").first()["max"] == 6.0
