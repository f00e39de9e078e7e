import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.operators import retrieve as R
from keelson.operators.asof import AsOfSide, as_of_join, retrieval_counts, time_span, within_span
from keelson.spec import ContractError, FeatureService, FeatureSource, FeatureView
from keelson.streaming import snapshot as SN

BASE = datetime(2024, 1, 1)


def at(s):
    return BASE + timedelta(seconds=s)


def brute(features, key, time, ttl):
    past = [r for r in features if key is not None and time is not None and r[0] == key and r[1] <= time]
    best = max(past, key=lambda r: (r[1], r[2]), default=None)
    return None if best is None or (ttl and best[1] < time - ttl) else best[3]


@pytest.fixture(scope="module")
def random_tables(spark):
    rnd = random.Random(5)

    def when():
        return at(rnd.choice([5, 5, rnd.randint(0, 100), rnd.randint(0, 100_000)]))

    def key():
        return rnd.choice([1, 1, 1, 2, 3, 4, None])

    labels = [(i, key(), rnd.choice([when(), when(), when(), None])) for i in range(500)]
    a = [(key(), when(), i, rnd.choice(["a", "b", None])) for i in range(300)]
    b = [(key(), when(), i, rnd.random()) for i in range(200)]
    return labels, a, b


@pytest.mark.parametrize("limit", [5_000_000, 40, 1])
def test_against_brute_force_for_any_group_limit(spark, random_tables, limit):
    labels, a, b = random_tables
    ttl = timedelta(seconds=5000)
    l = spark.createDataFrame(labels, "id long, k long, t timestamp").repartition(5)
    fa = spark.createDataFrame(a, "k long, ft timestamp, o long, va string").repartition(5)
    fb = spark.createDataFrame(b, "k long, ft timestamp, o long, vb double").repartition(3)
    got = as_of_join(l, "k", "t", [AsOfSide(fa, "k", "ft", ("va",), ttl, "o"), AsOfSide(fb, "k", "ft", ("vb",), None, "o")], limit)
    assert got.columns == ["id", "k", "t", "va", "vb"]
    assert sorted(tuple(r) for r in got.select("id", "va", "vb").collect()) == sorted(
        (i, brute(a, k, t, ttl), brute(b, k, t, None)) for i, k, t in labels)


def test_rules_of_a_match(spark):
    day = 86_400
    labels = [(1, 1, at(10)), (2, 2, at(10)), (3, 3, at(10)), (4, 4, at(10)), (5, 5, at(10 * day)), (6, 6, at(10 * day)), (7, 7, at(10)), (8, 8, at(10)), (9, 4, at(3))]
    features = [(2, at(10), 1, "equal"), (3, at(11), 1, "future"), (4, at(1), 1, "old"), (4, at(5), 1, "newer"), (5, at(8 * day - 1), 1, "stale"),
                (6, at(8 * day), 1, "edge"), (7, at(4), 2, "late row"), (7, at(4), 1, "early row"), (8, at(1), 1, "x"), (8, at(2), 1, None)]
    l = spark.createDataFrame(labels, "id long, k long, t timestamp_ntz")
    f = spark.createDataFrame(features, "k long, ft timestamp_ntz, o long, v string")
    got = as_of_join(l, "k", "t", [AsOfSide(f, "k", "ft", ("v",), timedelta(days=2), "o", time_as="ft")])
    assert {r["id"]: r["v"] for r in got.collect()} == {
        1: None, 2: "equal", 3: None, 4: "newer", 5: None, 6: "edge", 7: "late row", 8: None, 9: "old"}
    assert {r["id"]: r["ft"] for r in got.collect()}[8] == at(2)


def test_hot_key_is_cut_into_many_groups(spark):
    n = 4000
    l = spark.range(n).select(F.lit(1).cast("long").alias("k"), F.timestamp_seconds("id").alias("t"), "id")
    f = spark.range(0, n, 3).select(F.lit(1).cast("long").alias("k"), F.timestamp_seconds("id").alias("ft"), F.col("id").alias("v"))
    got = as_of_join(l, "k", "t", [AsOfSide(f, "k", "ft", ("v",))], max_group_rows=100)
    assert got.where("v is null or v <> id - id % 3").count() == 0 and got.count() == n
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_output_names_must_not_repeat(spark):
    l = spark.createDataFrame([(1, at(1), 2.0)], "k long, t timestamp, v double")
    f = spark.createDataFrame([(1, at(1), 2.0)], "k long, ft timestamp, v double")
    with pytest.raises(ContractError):
        as_of_join(l, "k", "t", [AsOfSide(f, "k", "ft", ("v",))])
    with pytest.raises(ContractError):
        as_of_join(l, "k", "t", [AsOfSide(f.withColumn("ft", F.col("ft").cast("timestamp_ntz")), "k", "ft", ("v",), rename=("w",))])


def service(spark, tmp=None):
    a = spark.createDataFrame([(1, at(1), 1.5, "p"), (2, at(1), 2.5, None)], "k long, ft timestamp, x double, s string")
    b = spark.createDataFrame([(1, at(2), 10.0)], "k long, ft timestamp, x double")
    both = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("s", T.StringType())])
    one = T.StructType([T.StructField("x", T.DoubleType())])
    return FeatureService("svc", [FeatureView("a", "k", FeatureSource(a, "ft"), both, tags={"feature_version": "v1"}),
                                  FeatureView("b", "k", FeatureSource(b, "ft"), one)])


def test_service_with_clashing_names(spark):
    labels = spark.createDataFrame([(1, at(3), 5.0), (2, at(3), 6.0), (9, at(3), 7.0)], "k long, t timestamp, y double")
    got = R.retrieve_history(labels, service(spark), "t")
    assert got.columns == ["k", "t", "y", "a__x", "s", "b__x"]
    assert sorted(tuple(r)[2:] for r in got.collect()) == [(5.0, 1.5, "p", 10.0), (6.0, 2.5, None, None), (7.0, None, None, None)]
    assert retrieval_counts(got, labels, "k").first()["reconciled"] is True


def test_view_types_are_checked(spark):
    s = service(spark)
    wrong = FeatureView("w", "k", s.views[0].source, T.StructType([T.StructField("x", T.StringType())]))
    with pytest.raises(ContractError):
        R.retrieve_history(spark.createDataFrame([(1, at(3))], "k long, t timestamp"), FeatureService("w", [wrong]), "t")
    assert s.views[0].ttl == timedelta(days=3650)


def test_materialize_and_lookup(spark):
    rows = [(1, at(1), 1, "a"), (1, at(5), 2, "b"), (1, at(5), 3, "c"), (2, at(9), 4, "late"), (3, at(2), 5, None)]
    source = spark.createDataFrame(rows, "k long, ft timestamp, o long, v string")
    snap = R.materialize(source, "k", "ft", ["v"], at(1), at(5), "o")
    assert {(r["k"], r["v"]) for r in snap.collect()} == {(1, "c"), (3, None)}
    updated = R.update_snapshot(snap, source, "k", "ft", "o")
    assert {(r["k"], r["v"]) for r in updated.collect()} == {(1, "c"), (2, "late"), (3, None)}
    got = R.lookup_list(updated, [2, 99, 1, 2], "k", ["v"]).collect()
    assert [(r["request_position"], r["k"], r["v"]) for r in got] == [(0, 2, "late"), (1, 99, None), (2, 1, "c"), (3, 2, "late")]
    wanted = R.requests(spark, [2, 99, 1, 2], "k")
    response = R.lookup(updated, wanted, "k", ["v"])
    assert R.check_response(response, wanted, "k", ["v"]).first().asDict() == {"requested": 4, "answered": 4, "wrong_keys": 0, "complete": True}
    assert R.check_response(response.where("k <> 99"), wanted, "k", ["v"]).first()["complete"] is False
    assert R.response_lists(R.lookup_list(updated, [2, 99, 1], "k", ["v"])).first().asDict() == {"k": [2, 99, 1], "v": ["late", None, "c"]}


def test_short_request_list_reaches_the_scan(spark, tmp_path):
    spark.range(1000).selectExpr("id as k", "id * 2 as v").write.parquet(str(tmp_path / "s"))
    plan = R.lookup_list(spark.read.parquet(str(tmp_path / "s")), [5, 7], "k", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "In(k, [5,7])" in plan


def test_sample_keys(spark):
    df = spark.createDataFrame([(3, 1.0), (1, None), (2, 2.0), (2, 3.0), (5, 1.0)], "k long, x double")
    assert R.require_sample(df, "k", ["x"], 2) == [2, 3]
    with pytest.raises(ContractError):
        R.require_sample(df, "k", ["x"], 4)


def test_materialize_service(spark):
    snaps = R.materialize_service(spark, service(spark))
    assert {n: s.count() for n, s in snaps.items()} == {"a": 2, "b": 1}


def test_streamed_snapshot_survives_a_replay(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    schema = "k long, ft timestamp, o long, v string"
    spark.createDataFrame([(1, at(1), 1, "a"), (2, at(1), 2, "b")], schema).write.parquet(src)
    stream = spark.readStream.schema(schema).parquet(src)
    SN.feed_snapshot(stream, out, ck, "k", "ft", ["v"], "o").awaitTermination()
    spark.createDataFrame([(1, at(5), 3, "c")], schema).write.mode("append").parquet(src)
    SN.feed_snapshot(stream, out, ck, "k", "ft", ["v"], "o").awaitTermination()
    SN.feed_snapshot(stream, out, str(tmp_path / "ck2"), "k", "ft", ["v"], "o").awaitTermination()  # everything once more
    got = SN.read_snapshot(spark, out, "k", "ft", ["v"], "o")
    assert {(r["k"], r["v"]) for r in got.collect()} == {(1, "c"), (2, "b")}
    SN.compact(spark, out, str(tmp_path / "base"), "k", "ft", ["v"], "o")
    assert spark.read.parquet(str(tmp_path / "base")).count() == 2


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_feature_scans_are_limited_to_times_that_can_match(spark, tmp_path, kind):
    path = str(tmp_path / "features")
    hours = spark.range(40_000).select((F.col("id") % 50).alias("k"), F.timestamp_seconds(1_600_000_000 + F.col("id") * 3600).cast(kind).alias("fts"),
                                       F.col("id").cast("string").alias("v"))
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")  # INT96 times have no statistics
    try:
        hours.repartitionByRange(20, "fts").write.parquet(path)
    finally:
        spark.conf.unset("spark.sql.parquet.outputTimestampType")
    features = spark.read.parquet(path)
    labels = hours.where("v BETWEEN '20000' AND '20100' AND length(v) = 5").select("k", F.col("fts").alias("t"), F.col("v").alias("y"))
    side = AsOfSide(features, "k", "fts", ("v",), timedelta(days=5))
    got = as_of_join(labels, "k", "t", [side])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, as_of_join(labels, "k", "t", [side], prune=False).collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(fts," in plan and "LessThanOrEqual(fts," in plan
    pruned = within_span(side, time_span(labels, "t")).df._jdf.queryExecution()
    assert pruned.toRdd().count() == 101 + 120
    scanned = pruned.executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()
    # of 40,000 rows; the Parquet reader compares statistics of times with a zone only
    assert scanned <= 5_000 or kind == "timestamp_ntz"
    # no label, no feature row; labels without a time do not count
    assert as_of_join(labels.withColumn("t", F.lit(None).cast(kind)), "k", "t", [side]).where("v IS NOT NULL").isEmpty()
    assert time_span(labels.where("false"), "t") is None


def test_a_snapshot_is_folded_while_a_reader_goes_on(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    schema = "k long, ft timestamp, o long, v string"

    def feed(rows, checkpoint=ck):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        SN.feed_snapshot(spark.readStream.schema(schema).parquet(src), out, checkpoint, "k", "ft", ["v"], "o").awaitTermination()

    def read():
        return SN.read_snapshot(spark, out, "k", "ft", ["v"], "o")

    def publish():
        return SN.publish(spark, out, "k", "ft", ["v"], "o")

    def values(df):
        return {(r["k"], r["v"]) for r in df.collect()}

    feed([(1, at(1), 1, "a"), (2, at(1), 2, "b")])
    feed([(1, at(5), 3, "c")])
    early = read()
    assert publish().through == 1 and publish() is None
    assert values(early) == values(read()) == {(1, "c"), (2, "b")}  # the early reader still finds its batches
    feed([(2, at(7), 4, "d"), (3, at(1), 5, "e")])
    between, want = read(), {(1, "c"), (2, "d"), (3, "e")}
    second = publish()
    assert (second.version, second.through) == (2, 2) and values(between) == values(read()) == want
    assert SN.batches(spark, out) == [2] and len(SN.pointers(spark, out)) == 2
    # a replayed batch of any age changes nothing, an incomplete one is neither read nor folded
    batch = spark.createDataFrame([(1, at(5), 3, "c")], schema)
    R.materialize(batch, "k", "ft", ["v"], ordinal="o").write.parquet(f"{out}/batch=1")
    spark.createDataFrame([(9, at(9), 9, "z")], schema).write.parquet(f"{out}/batch=3")
    (tmp_path / "out" / "batch=3" / "_SUCCESS").unlink()
    spark.createDataFrame([(8, at(9), 9, "y")], schema).write.parquet(f"{out}/batch=4")
    assert values(read()) == want | {(8, "y")} and publish() is None
    (tmp_path / "out" / "batch=3" / "_SUCCESS").touch()
    assert publish().through == 4 and values(read()) == want | {(8, "y"), (9, "z")}
    assert [p.version for p in SN.pointers(spark, out)] == [2, 3]
    # two publishers of one publication: the second fails, what it wrote is not read
    with pytest.raises(ContractError, match="exists already"):
        SN._write_pointer(spark, out, SN.Pointer(3, "_bases/other", 9))
    assert values(read()) == want | {(8, "y"), (9, "z")}


def test_lookup_in_buckets_leaves_the_snapshot_where_it_is(spark, tmp_path):
    from keelson.sources.tables import write_bucketed

    snapshot = spark.range(1000).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    write_bucketed(snapshot, "bucketed_snapshot", "k", 8, path=str(tmp_path / "snapshot"))
    wanted = spark.createDataFrame([(i, k) for i, k in enumerate([5, 999, 5, 4000, None])], "request_position long, k long")
    got = R.lookup_colocated("bucketed_snapshot", wanted, "k", ["v"])
    assert sorted(map(tuple, got.collect())) == [(0, 5, "v5"), (1, 999, "v999"), (2, 5, "v5"), (3, 4000, None), (4, None, None)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = R.lookup_colocated("bucketed_snapshot", wanted, "k", ["v"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 1 and "Bucketed: true" in plan
    assert plan.index("Exchange") < plan.index("Bucketed: true")  # the requests' side
    spark.sql("DROP TABLE bucketed_snapshot")
