"""Point-in-time join: for each label row, the newest feature row that is not younger than it and not too old.

Labels and feature rows of all views are united and one window per key carries the newest feature row of each view
forward, so there is one shuffle for any number of views and no row is multiplied. Spark has no public as-of join on
DataFrames, and an inequality join would emit all (label, earlier feature) pairs of a key.

A key may hold a third of all rows, so its window must not end in one task. Keys with more than ``max_group_rows`` rows
are cut along time into slices, recursively while a slice is still too large; a slice starts with the newest feature
row of the earlier slices (its *carry*). Rows that all share one instant cannot be cut along time: there the features
collapse to the newest one and the labels are spread over several copies of it. Either way results stay complete, and what describes the
slices stays a table. Labels without a key or a time match nothing; they are appended without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions.scalar import micros
from keelson.session import stored
from keelson.spec import ContractError, require_columns

MAX_GROUP_ROWS = 1_000_000
SPREAD = 1 << 20


@dataclass(frozen=True)
class AsOfSide:
    """Feature rows of one view. ``rename`` maps a feature to its output name."""

    df: DataFrame
    key: str
    time: str
    features: tuple[str, ...]
    ttl: timedelta | None = None
    ordinal: str | None = None
    rename: tuple[str, ...] | None = None
    time_as: str | None = None

    @property
    def outputs(self) -> tuple[str, ...]:
        return self.rename or self.features


def as_of_join(labels: DataFrame, key: str, time: str, sides: Sequence[AsOfSide],
               max_group_rows: int = MAX_GROUP_ROWS, prune: bool = True) -> DataFrame:
    """All label rows and columns, plus each side's features (NULL without a match).

    A match has feature time <= label time and, with a TTL, >= label time - TTL. Of feature rows with equal time the
    larger ordinal wins. NULLs inside the matched row are kept. ``prune`` reads the labels' time range first and limits
    each side to the times that can match, so that its scan skips files and row groups.
    """
    require_columns(labels, [key, time], "labels")
    clash = [n for s in sides for n in [*s.outputs, *([s.time_as] if s.time_as else [])]]
    taken = sorted({n for n in clash if n in labels.columns or clash.count(n) > 1})
    if taken:
        raise ContractError(f"output columns would repeat: {taken}")

    known = F.col(key).isNotNull() & F.col(time).isNotNull()
    apart, labels = labels.where(~known), labels.where(known)
    if prune:
        span = time_span(labels, time)
        sides = [within_span(s, span) for s in sides]
    rows = _unite(labels, key, time, sides)
    heavy = _find_heavy(rows, max_group_rows)
    if heavy is not None:
        rows = _slice_and_carry(_unite(labels, key, time, sides, spread=True), heavy, len(sides))
    newest = Window.partitionBy("_k", "_slice", "_slot").orderBy(
        F.asc_nulls_first("_t"), "_kind", "_ord").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    matched = rows.select(
        "_kind", "_label", *[F.last(f"_v{i}", ignorenulls=True).over(newest).alias(f"_v{i}") for i in range(len(sides))])
    out = [F.col("_label").getField(c).alias(c) for c in labels.columns]
    for i, side in enumerate(sides):
        view = F.col(f"_v{i}")
        fresh = view.isNotNull() if side.ttl is None else \
            view.getField("_ft") >= F.col("_label").getField(time) - F.lit(side.ttl)
        if side.time_as:
            out.append(F.when(fresh, view.getField("_ft")).alias(side.time_as))
        out += [F.when(fresh, view.getField(f"f{j}")).alias(n) for j, n in enumerate(side.outputs)]
    found = matched.where(F.col("_kind") == 1).select(*out)
    types = {f.name: f.dataType for f in found.schema.fields}
    return found.unionByName(apart.select(*labels.columns, *[F.lit(None).cast(types[c]).alias(c) for c in found.columns if c not in labels.columns]))


def time_span(labels: DataFrame, time: str) -> tuple[Column, Column] | None:
    """The smallest and the largest time as literals, from one aggregate over the time column; None without a time.

    Times with a zone are carried as microseconds, so the literals do not depend on any zone.
    """
    zoned = isinstance(labels.schema[time].dataType, T.TimestampType)
    ends = [F.unix_micros(f(time)) if zoned else f(time).cast("string") for f in (F.min, F.max)]
    found = labels.agg(*[e.alias(f"_{i}") for i, e in enumerate(ends)]).first()
    if found[0] is None:
        return None
    return tuple(F.timestamp_micros(F.lit(v)) if zoned else F.lit(v).cast(labels.schema[time].dataType) for v in found)


def within_span(side: AsOfSide, span: tuple[Column, Column] | None) -> AsOfSide:
    """The side without the rows that are younger than every label, or expired at every label."""
    if span is None:
        return replace(side, df=side.df.where(F.lit(False)))
    fits = F.col(side.time) <= span[1]
    if side.ttl is not None:
        fits &= F.col(side.time) >= span[0] - F.lit(side.ttl)
    return replace(side, df=side.df.where(fits))


def _unite(labels: DataFrame, key: str, time: str, sides: Sequence[AsOfSide], spread: bool = False) -> DataFrame:
    """Rows (_k, _t, _u, _kind, _ord, _slice, _slot, _label, _v0, ...); _kind 0 is a feature row, 1 a label row.

    With ``spread`` labels carry a number in ``_slot`` to spread them by: it depends on content and map partition only, so
    a retried task repeats it.
    """
    key_type, time_type = labels.schema[key].dataType, labels.schema[time].dataType
    label_type = T.StructType(labels.schema.fields)
    view_types = []
    for s in sides:
        require_columns(s.df, [s.key, s.time, *s.features], "feature side")
        if s.df.schema[s.time].dataType != time_type:
            raise ContractError(f"time types differ: {time_type.simpleString()} and "
                                f"{s.df.schema[s.time].dataType.simpleString()}")
        fields = [T.StructField("_ft", time_type)]
        fields += [T.StructField(f"f{j}", s.df.schema[f].dataType) for j, f in enumerate(s.features)]
        view_types.append(T.StructType(fields))

    def empty(dtype):
        return F.lit(None).cast(dtype)

    mixed = F.xxhash64(*labels.columns) + F.spark_partition_id()
    slot = F.pmod(mixed, F.lit(SPREAD)).cast("int") if spread else F.lit(0)
    label_rows = labels.select(
        F.col(key).cast(key_type).alias("_k"), F.col(time).alias("_t"), micros(F.col(time), time_type).alias("_u"),
        F.lit(1).alias("_kind"), F.lit(0).cast("bigint").alias("_ord"), F.lit(0).cast("bigint").alias("_slice"),
        slot.alias("_slot"),
        F.struct(*labels.columns).cast(label_type).alias("_label"),
        *[empty(t).alias(f"_v{i}") for i, t in enumerate(view_types)])
    rows = label_rows
    for i, (s, dtype) in enumerate(zip(sides, view_types)):
        ordinal = F.col(s.ordinal).cast("bigint") if s.ordinal else F.xxhash64(*[F.col(f) for f in s.features])
        view = F.struct(F.col(s.time).alias("_ft"), *[F.col(f).alias(f"f{j}") for j, f in enumerate(s.features)])
        feature_rows = s.df.where(F.col(s.key).isNotNull() & F.col(s.time).isNotNull()).select(
            F.col(s.key).cast(key_type).alias("_k"), F.col(s.time).alias("_t"),
            micros(F.col(s.time), time_type).alias("_u"), F.lit(0).alias("_kind"), ordinal.alias("_ord"),
            F.lit(0).cast("bigint").alias("_slice"), F.lit(0).alias("_slot"), empty(label_type).alias("_label"),
            *[view.cast(dtype).alias(f"_v{i}") if i == j else empty(t).alias(f"_v{j}")
              for j, t in enumerate(view_types)])
        rows = rows.unionByName(feature_rows)
    return rows


@dataclass
class _Heavy:
    levels: list[DataFrame]  # (_hk, _parent, _low, _width): how an over-full slice is cut
    instants: DataFrame      # (_ik, _islice, _copies): over-full slices of one instant
    keys: DataFrame          # (_hot): the keys that have such slices


def _find_heavy(rows: DataFrame, limit: int) -> _Heavy | None:
    """Cut over-full groups until each holds at most ``limit`` rows or one instant; None if there are none.

    Counting combines map-side; the usual case, no over-full key, is settled by reading the key columns alone. The cuts
    are tables in the shared folder, at most rows / limit lines each, and every level shortens the slices it cuts.
    """
    if rows.groupBy("_k").count().where(F.col("count") > limit).isEmpty():
        return None
    narrow = rows.select("_k", "_u", "_slice")
    levels: list[DataFrame] = []
    keys = None
    while True:
        full = stored(narrow.groupBy("_k", "_slice").agg(
            F.count(F.lit(1)).alias("n"), F.min("_u").alias("lo"), F.max("_u").alias("hi")).where(F.col("n") > limit), "slices")
        keys = full.select("_k") if keys is None else keys.unionByName(full.select("_k"))
        wide = full.where("lo < hi")
        if wide.isEmpty():
            break
        width = F.floor((F.col("hi") - F.col("lo")) / (4 * (F.floor(F.col("n") / limit) + 1))) + 1
        levels.append(wide.select(F.col("_k").alias("_hk"), F.col("_slice").alias("_parent"), F.col("lo").alias("_low"), width.alias("_width")))
        narrow = _assign(narrow, levels[-1:])
    instants = full.select(F.col("_k").alias("_ik"), F.col("_slice").alias("_islice"), (F.floor(F.col("n") / limit) + 1).cast("int").alias("_copies"))
    return _Heavy(levels, instants, keys.select(F.col("_k").alias("_hot")).distinct())


def _assign(rows: DataFrame, levels: Sequence[DataFrame]) -> DataFrame:
    """Set ``_slice`` to the start of the row's time slice; slices of a key are ordered by it."""
    columns = rows.columns
    for cut in levels:
        start = F.col("_low") + F.floor((F.col("_u") - F.col("_low")) / F.col("_width")).cast("bigint") * F.col("_width")
        joined = rows.join(cut, (F.col("_k") == F.col("_hk")) & (F.col("_slice") == F.col("_parent")), "left")
        rows = joined.select(*[F.coalesce(start, F.col("_slice")).alias(c) if c == "_slice" else F.col(c) for c in columns])
    return rows


def _slice_and_carry(rows: DataFrame, heavy: _Heavy, n_views: int) -> DataFrame:
    columns = rows.columns
    views = [f"_v{i}" for i in range(n_views)]
    sliced = _assign(rows, heavy.levels)
    joined = sliced.join(heavy.instants, (F.col("_k") == F.col("_ik")) & (F.col("_slice") == F.col("_islice")), "left")
    spread = F.when(F.col("_copies").isNotNull(), F.pmod(F.col("_slot"), F.col("_copies"))).otherwise(F.lit(0))
    sliced = joined.select(*[spread.alias(c) if c == "_slot" else F.col(c) for c in columns], "_copies")
    # only keys that were cut need carries
    of_cut = sliced.join(heavy.keys, F.col("_k") == F.col("_hot"), "left_semi")
    order = F.struct("_t", "_ord")
    summary = of_cut.groupBy("_k", "_slice").agg(
        F.max("_copies").alias("_copies"), F.max("_kind").alias("_has_label"),
        *[F.max_by(v, F.when(F.col(v).isNotNull(), order)).alias(v) for v in views])
    before = Window.partitionBy("_k").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("_k").orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # one row per slice; at one instant the carry includes the instant itself
    carried = summary.select(
        "_k", "_slice", "_copies", "_has_label",
        *[F.when(F.col("_copies").isNull(), F.last(v, ignorenulls=True).over(before))
           .otherwise(F.last(v, ignorenulls=True).over(upto)).alias(v) for v in views]).where(F.col("_has_label") == 1)
    slots = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_copies"), F.lit(1)) - 1))
    carried = carried.withColumn("_slot", slots)
    types = {f.name: f.dataType for f in rows.schema.fields}
    fixed = {"_kind": F.lit(0), "_ord": F.lit(0).cast("bigint")}
    carry_rows = carried.select(*[
        F.col(c) if c in ("_k", "_slice", "_slot", *views) else fixed.get(c, F.lit(None).cast(types[c])).alias(c)
        for c in columns])
    kept = sliced.where((F.col("_kind") == 1) | F.col("_copies").isNull()).select(*columns)
    return kept.unionByName(carry_rows)


def retrieval_counts(result: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """One row: rows and distinct keys of the retrieved table and of the labels, and whether they agree."""
    def side(df: DataFrame, name: str) -> DataFrame:
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        return per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count(key).alias("keys")).select(
            F.lit(name).alias("side"), "rows", "keys")

    def pick(name: str, c: str) -> Column:
        return F.max(F.when(F.col("side") == name, F.col(c)))

    both = side(result, "result").unionByName(side(labels, "labels")).agg(
        pick("result", "rows").alias("result_rows"), pick("labels", "rows").alias("label_rows"),
        pick("result", "keys").alias("result_keys"), pick("labels", "keys").alias("label_keys"))
    return both.select("*", ((F.col("result_rows") == F.col("label_rows")) &
                             (F.col("result_keys") == F.col("label_keys"))).alias("reconciled"))
