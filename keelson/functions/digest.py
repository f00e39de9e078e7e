"""Fingerprints of tables that do not depend on row order or partitioning.

Each row gets a hash, and the table fingerprint is the SHA-256 of *sums* of the hash words: a plain aggregate in which
every task reduces its rows to a few bigints. No row list is ever collected or sorted, however many copies of a row
exist. Sums, unlike XOR, also notice a row that occurs twice.

The row hash is two seeded xxHash values (128 bits) of the typed columns, or, with ``portable=True``, the SHA-256 of a
text form that other engines can rebuild, at several times the cost.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions.scalar import is_fractional

_DIGEST_WORDS = 8  # words of 32 bits; halves of 16 bits are summed, so 2**47 rows fit a bigint


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def canonical_sql(name: str, dtype: T.DataType) -> str:
    """SQL text of a column with one form per value: NaN as NULL, -0.0 as 0.0, times as microseconds."""
    c = quoted(name)
    if is_fractional(dtype):
        return f"string(CASE WHEN NOT isnan({c}) THEN {c} + 0.0D END)"
    if isinstance(dtype, T.TimestampNTZType):
        return f"string(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {c}))"
    if isinstance(dtype, T.TimestampType):
        return f"string(unix_micros({c}))"
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return f"to_json({c}, map('ignoreNullFields', 'false'))"
    return f"string({c})"


def canonical_text(name: str, dtype: T.DataType) -> Column:
    return F.expr(canonical_sql(name, dtype))


def row_digest(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Hex SHA-256 of the row over ``columns`` in the given order; every field is NULL or carries its length."""
    texts = [canonical_sql(n, df.schema[n].dataType) for n in (columns or df.columns)]
    fields = [f"coalesce(concat('V', length({t}), ':', {t}), 'N')" for t in texts]
    return F.expr(f"sha2(concat({', '.join(fields)}), 256)")


def row_hashes(df: DataFrame, columns: Sequence[str] | None = None) -> list[Column]:
    """Two bigint hashes of the row. A mask of the NULL fields is hashed too, since xxhash64 skips NULLs."""
    fields, empty = [], []
    for n in columns or df.columns:
        dtype, c = df.schema[n].dataType, quoted(n)
        if is_fractional(dtype):
            c = f"CASE WHEN NOT isnan({c}) THEN {c} END"
        elif isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
            c = canonical_sql(n, dtype)
        fields.append(c)
        empty.append(f"if({c} IS NULL, '1', '0')")
    body = ", ".join([f"concat({', '.join(empty)})", *fields])
    return [F.expr(f"xxhash64({seed}, {body})").alias(f"_x{seed}") for seed in (1, 2)]


def _sums(portable: bool) -> dict[str, str]:
    """Name and SQL of the summed 16-bit pieces. SQL text, because each Column call costs several calls into the JVM."""
    if not portable:
        return {f"_p{x}{i}": f"sum(shiftrightunsigned(_x{x}, {16 * i}) & 65535)" for x in (1, 2) for i in range(4)}
    out = {}
    for i in range(_DIGEST_WORDS):
        word = f"bigint(conv(substring(_digest, {1 + 8 * i}, 8), 16, 10))"
        out[f"_h{i}"], out[f"_l{i}"] = f"sum(shiftright({word}, 16))", f"sum({word} & 65535)"
    return out


def hashed_rows(df: DataFrame, columns: Sequence[str], portable: bool = False) -> list[Column]:
    """The columns that :func:`fingerprint_aggregates` needs."""
    return [row_digest(df, columns).alias("_digest")] if portable else row_hashes(df, columns)


def fingerprint_aggregates(portable: bool = False) -> list[Column]:
    return [F.expr(sql).alias(name) for name, sql in _sums(portable).items()]


def combine_sums(portable: bool = False) -> Column:
    """Fingerprint from ``row_count`` and the sums."""
    parts = ", ".join(f"coalesce({name}, 0)" for name in _sums(portable))
    return F.expr(f"sha2(concat_ws(',', row_count, {parts}), 256)")


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = (),
                portable: bool = False) -> DataFrame:
    """Frame (by..., row_count, data_fingerprint): equal tables give equal values, one edited cell changes it."""
    names = list(columns or [c for c in df.columns if c not in by])
    totals = df.select(*by, *hashed_rows(df, names, portable)).groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"), *fingerprint_aggregates(portable))
    return totals.select(*by, "row_count", combine_sums(portable).alias("data_fingerprint"))


def schema_fingerprint(schema: T.StructType) -> str:
    """SHA-256 over (column, type) pairs in order. Reads the schema only."""
    pairs = [[f.name, f.dataType.simpleString()] for f in schema.fields]
    return hashlib.sha256(json.dumps(pairs).encode()).hexdigest()
