"""Column expressions shared by all operators.

Everything here is a plain Spark expression, so it stays inside whole-stage code generation. Two rules hold throughout:

* *Missing is NULL.* Spark keeps NaN apart from NULL (NaN equals NaN, sorts above every number and is counted), so each
  numeric boundary goes through :func:`canon`.
* *ANSI mode stays on.* Unclean input is converted with ``try_*`` functions only.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# White space as trimmed by Python's str.strip, and the number texts that count as numeric.
EDGE_SPACE = r"^[\s\p{Z}\x0B\x1C-\x1F\x85]+|[\s\p{Z}\x0B\x1C-\x1F\x85]+$"
NUMBER_TEXT = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$"


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def is_fractional(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DoubleType, T.FloatType))


def canon(c: Column, dtype: T.DataType | None = None) -> Column:
    """NaN becomes NULL; other types pass through when their type is given."""
    if dtype is not None and not is_fractional(dtype):
        return c
    return F.when(~F.isnan(c), c)


def finite(c: Column) -> Column:
    """NaN and both infinities become NULL."""
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)


def strip(c: Column) -> Column:
    """Trim all Unicode white space; ``trim`` would remove the space character only."""
    return F.regexp_replace(c.cast("string"), EDGE_SPACE, "")


def clean_text(c: Column, tokens: Iterable[str] = ()) -> Column:
    """Strip, and map "no answer" tokens (compared case-insensitively) to NULL. The case of values is kept."""
    stripped = strip(c)
    lowered = sorted({t.lower() for t in tokens})
    return F.when(~F.lower(stripped).isin(lowered), stripped) if lowered else stripped


def drop_tokens(c: Column, tokens: Iterable[str]) -> Column:
    """NULL where the text equals one of ``tokens`` exactly."""
    wanted = sorted(set(tokens))
    return F.when(~c.isin(wanted), c) if wanted else c


def to_number(c: Column, dtype: T.DataType) -> Column:
    """Double, or NULL if unparsable. Text is checked by pattern first, because casts accept suffixes such as ``1d``."""
    if isinstance(dtype, T.StringType):
        text = strip(c)
        return F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))
    if isinstance(dtype, T.BooleanType) or is_numeric(dtype):
        return canon(c.cast("double"))
    raise TypeError(f"cannot read {dtype.simpleString()} as a number")


def to_time(c: Column, dtype: T.DataType, formats: Sequence[str] = ()) -> Column:
    """Timestamp, or NULL if unparsable. Text is tried as ISO first, then with each given format."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return c
    if isinstance(dtype, T.DateType):
        return c.cast("timestamp")
    return F.coalesce(F.try_to_timestamp(c), *(F.try_to_timestamp(c, F.lit(f)) for f in formats))


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b with a zero divisor or a non-finite result as NULL."""
    return finite(F.try_divide(a.cast("double"), b.cast("double")))


def null_if_in(c: Column, values: Iterable[float]) -> Column:
    wanted = list(values)
    return F.when(~c.isin(wanted), c) if wanted else c


def null_outside(c: Column, low: float, high: float) -> Column:
    """Keep values inside the closed range; a missing value stays missing and is no violation."""
    return F.when(c.between(low, high), c)


def is_violation(c: Column, low: float, high: float) -> Column:
    return c.isNotNull() & ~c.between(low, high)


def row_sum(columns: Sequence[str]) -> Column:
    """Sum across columns; NULL if one of them is NULL."""
    return reduce(lambda a, b: a + b, [F.col(c) for c in columns])


def all_present(columns: Sequence[str]) -> Column:
    return F.expr(" AND ".join(["true", *[f"`{c}` IS NOT NULL" for c in columns]]))


def null_cells(columns: Sequence[str]) -> Column:
    """Number of NULL cells of the row among ``columns``."""
    return F.expr(" + ".join(["0L", *[f"int(`{c}` IS NULL)" for c in columns]]))


def report_round(c: Column, digits: int) -> Column:
    """Half-even rounding for report views."""
    return F.bround(c, digits)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return report_round(F.try_divide(part * F.lit(100.0), whole), digits)


def micros(c: Column, dtype: T.DataType) -> Column:
    """Microseconds since 1970 as bigint, independent of the session time zone."""
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), c)
    return F.unix_micros(c)


def stable_hash(key: Column, seed: int) -> Column:
    """Hex MD5 of ``seed:key``. The same for every engine and partitioning, so it can order keys reproducibly."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))
