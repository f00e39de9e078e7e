from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from keelson.operators import compare as C
from keelson.operators import split as S
from keelson.spec import ContractError


def frame(spark, n=20):
    rows = [(i, datetime(2024, 1, 1) + timedelta(hours=i - 1), 500.0 + 20 * i) for i in range(1, n + 1)]
    return spark.createDataFrame(rows, "k long, t timestamp, y double")


def test_split_has_exact_size_and_covers(spark):
    df = frame(spark)
    split, members = S.split_entities(df, "k", 0.2, 42)
    counts = {r["split"]: r["count"] for r in members.groupBy("split").count().collect()}
    assert counts == {"train": 16, "test": 4} and (split.entities, split.test_entities) == (20, 4)
    assert all(v == 0 for v in C.coverage(df, members, "k").first())
    S.require_split(df, members, "k")


@pytest.mark.parametrize("n", [1, 4, 17])
def test_split_does_not_depend_on_layout(spark, n):
    df = spark.range(10_000).withColumnRenamed("id", "k")
    base, members = S.split_entities(df, "k", 0.2003, 7)
    other, again = S.split_entities(df.orderBy(F.rand(n)).repartition(n), "k", 0.2003, 7)
    assert base == other and base.test_entities == 2003
    assert members.exceptAll(again).isEmpty() and members.where("split = 'test'").count() == 2003


def test_split_repeats_and_seed_matters(spark):
    df = frame(spark, 200)
    a, m = S.split_entities(df, "k", 0.2, 42)
    b, n = S.split_entities(df, "k", 0.2, 42)
    c, _ = S.split_entities(df, "k", 0.2, 43)
    assert S.split_summary(a, m).first() == S.split_summary(b, n).first()
    assert a.threshold != c.threshold
    s = S.split_summary(a, m).first()
    assert (s["train_entities"], s["test_entities"], s["actual_test_fraction"]) == (160, 40, 0.2)


def test_split_without_shuffle_takes_the_last_keys(spark):
    _, members = S.split_entities(frame(spark), "k", 0.25, shuffle=False)
    assert sorted(r["k"] for r in members.where("split = 'test'").collect()) == [16, 17, 18, 19, 20]


def test_rows_of_a_hot_key_stay_on_one_side(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"))
    split, members = S.split_entities(df, "k", 0.5)
    assert members.count() == members.select("k").distinct().count() == split.entities
    assert split.assign(df).groupBy("k").agg(F.count_distinct("split").alias("n")).where("n > 1").isEmpty()


def test_bad_fractions(spark):
    for f in (0.0, 1.0, -1):
        with pytest.raises(ContractError):
            S.split_entities(frame(spark), "k", f)


def test_apply_split(spark):
    df = frame(spark)
    _, members = S.split_entities(df, "k", 0.2)
    both = S.apply_split(df, members, "k")
    assert both.count() == 20 and both.where("split is null").isEmpty()
    train, test = S.split_frames(both)
    assert (train.count(), test.count()) == (16, 4)
    with pytest.raises(ContractError, match="duplicate"):
        S.apply_split(df, members.union(members.limit(1)), "k")
    with pytest.raises(ContractError, match="partner"):
        S.apply_split(df, members.where("k > 1"), "k")
    with pytest.raises(ContractError, match="unexpected value"):
        S.apply_split(df, members.withColumn("split", F.lit("dev")), "k")
    with pytest.raises(ContractError, match="no rows"):
        S.split_frames(both.where("split = 'train'"))


def test_exact_samples(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    a = {r["k"] for r in S.exact_sample(df, "k", 777, 1).collect()}
    b = {r["k"] for r in S.exact_sample(df.repartition(9), "k", 777, 1).collect()}
    assert len(a) == 777 and a == b
    assert S.exact_sample(df, "k", 9999).count() == 5000 and S.exact_sample(df, "k", 0).count() == 0
    split, _ = S.split_entities(df, "k", 0.2)
    got = S.sample_split(split.assign(df), "k", 100, 5000).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in got} == {"train": 100, "test": 1000}


def test_coverage_counts_every_violation(spark):
    pop = spark.createDataFrame([(1,), (2,), (3,), (4,)], "k long")
    bad = spark.createDataFrame([(1, "train"), (1, "test"), (2, "train"), (2, "train"), (3, "dev"), (9, "test")], "k long, split string")
    assert C.coverage(pop, bad, "k").first().asDict() == {
        "overlapping_keys": 1, "duplicate_keys": 2, "uncovered_keys": 1, "unknown_keys": 1, "bad_values": 1}


def test_alignment(spark):
    df = frame(spark)
    assert C.same_rows(df, df.repartition(5), ["k", "t", "y"])
    C.require_alignment(df, df.orderBy(F.desc("k")), ["k", "t", "y"])
    changed = df.withColumn("y", F.when(F.col("k") == 3, F.col("y") + 1).otherwise(F.col("y")))
    with pytest.raises(ContractError):
        C.require_alignment(df, changed, ["k", "t", "y"])
    assert C.row_differences(df, changed, ["k", "y"]).count() == 2


def test_row_differences_count_copies_and_nulls(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k long, s string")
    b = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "k long, s string")
    assert sorted(tuple(r) for r in C.row_differences(a, b, ["k", "s"]).collect()) == [(1, None, 2, 1), (3, "y", 0, 1)]


def test_grid_gaps(spark):
    users = spark.createDataFrame([(u,) for u in range(7)], "u long")
    days = spark.createDataFrame([(f"d{i}",) for i in range(7)], "d string")
    cells = [(u, f"d{i}") for u in range(5) for i in range(7) if (u, i) not in {(0, 0), (3, 5), (3, 6), (4, 3)}]
    facts = spark.createDataFrame([*cells, (2, "d2"), (2, "zz"), (77, "d1"), (6, "d3")], "u long, d string")
    got = sorted(tuple(r) for r in C.grid_gaps(facts, users, days, ["u", "d"]).collect())
    assert got == sorted([
        (0, "missing", "d0", "d0", 1), (3, "missing", "d5", "d6", 2), (4, "missing", "d3", "d3", 1), (5, "missing", "d0", "d6", 7),
        (6, "missing", "d0", "d2", 3), (6, "missing", "d4", "d6", 3), (2, "duplicate", "d2", "d2", 2), (2, "unexpected", "zz", "zz", 1),
        (77, "unexpected", "d1", "d1", 1)])
    assert C.grid_gaps(facts.limit(0), users, days.limit(0), ["u", "d"]).count() == 0
