"""Latest row per key and duplicate accounting.

All of it is aggregation by key with map-side combine: a key holding a third of the rows leaves each task as one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_aggregate(columns: Sequence[str], time: str, ordinal: str | Column | None) -> Column:
    """Struct of ``columns`` of the latest row; equal times are decided by the larger ordinal."""
    payload = F.struct(*[F.col(c) for c in columns])
    tie = F.col(ordinal) if isinstance(ordinal, str) else ordinal
    order = [F.col(time)] if tie is None else [F.col(time), tie]
    return F.max_by(payload, F.struct(*order))


def content_ordinal(columns: Sequence[str]) -> Column:
    """Tie-break for tables without an ordinal: reproducible, though arbitrary."""
    return F.xxhash64(*[F.col(c) for c in columns])


def keep_latest(df: DataFrame, key: str | Sequence[str], time: str, ordinal: str | None = None) -> DataFrame:
    """One row per key: the one with the greatest time, then the greatest ordinal."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    tie = ordinal if ordinal is not None else content_ordinal(rest)
    latest = df.groupBy(*keys).agg(latest_aggregate(rest, time, tie).alias("_latest"))
    return latest.select(*[F.col(c) if c in keys else F.col("_latest").getField(c).alias(c) for c in df.columns])


def key_counts(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """One row: rows, missing keys, distinct keys, superseded rows, rows in duplicated-key groups."""
    keys = [key] if isinstance(key, str) else list(key)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    n = F.col("_n")
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(~known, n)), F.lit(0)).alias("missing_keys"),
        F.count_if(known).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(known, n - 1)), F.lit(0)).alias("superseded_rows"),
        F.coalesce(F.sum(F.when(known & (n > 1), n)), F.lit(0)).alias("duplicated_key_rows"),
    )
