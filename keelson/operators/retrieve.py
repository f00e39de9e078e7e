"""Feature retrieval: history for training, latest values for serving."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions.scalar import all_present
from keelson.operators.asof import MAX_GROUP_ROWS, AsOfSide, as_of_join
from keelson.operators.keys import content_ordinal, latest_aggregate
from keelson.session import BROADCAST_ROWS
from keelson.spec import ContractError, FeatureService, FeatureView, require_columns

PUSHED_KEYS = 1_000  # request lists up to this length become a pushed-down IN filter


def retrieve_history(labels: DataFrame, service: FeatureService, time: str,
                     max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Label rows with the features of every view of the service as they were known at label time.

    All views share one shuffle. Feature names used by several views get the view name in front.
    """
    spark, sides = labels.sparkSession, []
    for view, names in zip(service.views, service.output_names()):
        source = view.source.frame(spark)
        check_view(source, view)
        sides.append(AsOfSide(source, view.entity_key, view.source.event_time, tuple(view.features), view.ttl,
                              view.source.ordinal, tuple(names)))
    return as_of_join(labels, service.entity_key, time, sides, max_group_rows)


def check_view(source: DataFrame, view: FeatureView) -> None:
    """The source must hold the declared fields with the declared types. Reads the schema only."""
    require_columns(source, [view.entity_key, view.source.event_time, *view.features], f"source of {view.name}")
    wrong = [f.name for f in view.schema.fields if source.schema[f.name].dataType != f.dataType]
    if wrong:
        raise ContractError(f"{view.name}: types differ for {wrong}")


def materialize(source: DataFrame, key: str, time: str, features: Sequence[str], start: datetime | Column | None = None,
                end: datetime | Column | None = None, ordinal: str | None = None) -> DataFrame:
    """Snapshot (key, time, features..., and the ordinal if given): latest row per key in the closed time range.

    The range is an ordinary filter, so it reaches the scan.
    """
    require_columns(source, [key, time, *features], "feature source")
    rows = source.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    if start is not None:
        rows = rows.where(F.col(time) >= _bound(source, time, start))
    if end is not None:
        rows = rows.where(F.col(time) <= _bound(source, time, end))
    payload = [time, *([ordinal] if ordinal else []), *features]
    tie = F.col(ordinal) if ordinal else content_ordinal(list(features))
    latest = rows.groupBy(key).agg(latest_aggregate(payload, time, tie).alias("_latest"))
    return latest.select(key, *[F.col("_latest").getField(c).alias(c) for c in payload])


def _bound(df: DataFrame, time: str, value) -> Column:
    if isinstance(value, datetime) and isinstance(df.schema[time].dataType, T.TimestampNTZType):
        value = value.replace(tzinfo=None)
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return value if isinstance(value, Column) else F.lit(value)


def update_snapshot(snapshot: DataFrame, new_rows: DataFrame, key: str, time: str, ordinal: str | None = None) -> DataFrame:
    """Snapshot after further rows. Taking a maximum, it may see the same rows twice without harm."""
    features = [c for c in snapshot.columns if c not in (key, time, ordinal)]
    both = snapshot.unionByName(new_rows.select(*snapshot.columns))
    return materialize(both, key, time, features, ordinal=ordinal)


def materialize_service(spark, service: FeatureService, start=None, end=None) -> dict[str, DataFrame]:
    """One snapshot per online view of a service."""
    return {v.name: materialize(v.source.frame(spark), v.entity_key, v.source.event_time, v.features, start, end,
                                v.source.ordinal)
            for v in service.views if v.online}


def requests(spark, ids: Sequence, key: str, dtype: T.DataType | None = None) -> DataFrame:
    """(request_position, key) for a caller's list of keys; repeats and unknown keys are allowed."""
    schema = T.StructType([T.StructField("request_position", T.LongType()), T.StructField(key, dtype or T.LongType())])
    return spark.createDataFrame([(i, k) for i, k in enumerate(ids)], schema)


def lookup(snapshot: DataFrame, wanted: DataFrame, key: str, features: Sequence[str], ids: Sequence | None = None) -> DataFrame:
    """(request columns..., features...): latest features per request, NULL for an unknown key.

    ``wanted`` is any frame with the key. If it came from a short list, ``ids`` pushes the keys into the snapshot scan,
    which reads only matching files or buckets. The engine picks the join.
    """
    require_columns(snapshot, [key, *features], "snapshot")
    hits = snapshot.select(F.col(key).alias("_key"), *features)
    if ids is not None and len(ids) <= PUSHED_KEYS:
        hits = hits.where(F.col("_key").isin(sorted({i for i in ids if i is not None})))
    elif ids is not None and len(ids) <= BROADCAST_ROWS:
        hits = hits.join(F.broadcast(wanted.select(F.col(key).alias("_want")).distinct()), F.col("_key") == F.col("_want"),
                         "left_semi")
    joined = wanted.join(hits, F.col(key) == F.col("_key"), "left")
    return joined.select(*wanted.columns, *features)


def lookup_colocated(table: str, wanted: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """Lookup in a snapshot saved by ``write_bucketed`` under ``key``: only requests are shuffled, to the table's buckets.

    For request tables of any size. The snapshot's side keeps the layout it was written in, so it is neither shuffled nor
    sent anywhere; buckets without requests are read, but rows leave them only for a request.
    """
    snapshot = wanted.sparkSession.table(table)
    require_columns(snapshot, [key, *features], table)
    hits = snapshot.select(F.col(key).alias("_key"), *features)
    joined = wanted.join(hits.hint("merge"), F.col(key) == F.col("_key"), "left")
    return joined.select(*wanted.columns, *features)


def lookup_list(snapshot: DataFrame, ids: Sequence, key: str, features: Sequence[str]) -> DataFrame:
    """Lookup of a caller's key list, in request order."""
    wanted = requests(snapshot.sparkSession, ids, key, snapshot.schema[key].dataType)
    return lookup(snapshot, wanted, key, features, ids).orderBy("request_position")


def response_lists(response: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """One row with a list per column, in request order, for a response of at most ``limit`` rows."""
    names = [c for c in response.columns if c != "request_position"]
    n = response.limit(limit + 1).count()
    if n > limit:
        raise ContractError(f"response has more than {limit} rows")
    packed = response.agg(F.array_sort(F.collect_list(F.struct("request_position", F.struct(*names).alias("r")))).alias("_all"))
    return packed.select(*[F.col("_all.r").getField(c).alias(c) for c in names])


def check_response(response: DataFrame, wanted: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """One row (requested, answered, wrong_keys, complete): every request answered once, with its own key."""
    require_columns(response, ["request_position", key, *features], "response")
    asked = wanted.select("request_position", F.col(key).alias("_k"), F.lit(1).alias("_a"), F.lit(0).alias("_b"))
    got = response.select("request_position", F.col(key).alias("_k"), F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    per = asked.unionByName(got).groupBy("request_position", "_k").agg(F.sum("_a").alias("a"), F.sum("_b").alias("b"))
    one = per.agg(F.coalesce(F.sum("a"), F.lit(0)).alias("requested"), F.coalesce(F.sum("b"), F.lit(0)).alias("answered"),
                  F.count_if(F.col("a") != F.col("b")).alias("wrong_keys"))
    return one.select("*", (F.col("wrong_keys") == 0).alias("complete"))


def sample_keys(df: DataFrame, key: str, features: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` distinct keys having a row with all features present."""
    return df.where(all_present(features)).select(key).distinct().orderBy(key).limit(n)


def require_sample(df: DataFrame, key: str, features: Sequence[str], n: int = 5) -> list:
    """:func:`sample_keys` as a list; fails if there are fewer."""
    found = [r[0] for r in sample_keys(df, key, features, n).collect()]
    if len(found) < n:
        raise ContractError(f"only {len(found)} of {n} complete keys")
    return found


