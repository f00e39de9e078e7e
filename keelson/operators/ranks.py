"""Exact order statistics, quantiles and row positions without sorting a table in one task.

Quantiles take two passes at any size. The first aggregates a sketch of bounded size for each series and brackets the
wanted ranks by values of the sketch, further out than its error can reach. The second counts the rows below a bracket and
the rows of each value inside it, combined before the shuffle, so that a hot value is one row for each task; a running sum
over the few values inside gives the exact ranks. Only values are compared, so infinities are values like others.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.functions.scalar import canon
from keelson.session import bounded_collect, stored

ACCURACY = 10_000
MARGINS = (0.0, 4e-4, 2e-3, 1e-2, 0.1)


def to_long(df: DataFrame, columns: Sequence[str], series: str = "series", value: str = "value",
            keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., series, value) with one row per numeric cell; NaN as NULL, values as double."""
    doubles = [canon(F.col(c).cast("double")).alias(c) for c in columns]
    return df.select(*keep, *doubles).unpivot(list(keep), list(columns), series, value)


def _grid(probs: Sequence[float]) -> list[float]:
    return sorted({min(1.0, max(0.0, p + s * m)) for p in probs for m in MARGINS for s in (-1, 1)})


def _brackets(n: Column, sketch: Column, probs: Sequence[float], grid: Sequence[float]) -> Column:
    """Array of (low, high, first, last, part) for each probability: the rank p * (n - 1) lies between the ranks ``first``
    and ``last``, ``part`` of the way, and values of these ranks lie in [low, high]; null bounds are open."""
    out = []
    slack = n * (2.0 / ACCURACY) + 2
    for p in probs:
        place = F.lit(float(p)) * (n - 1)
        first, last = F.floor(place), F.ceil(place)
        low = high = F.lit(None)
        for i, q in enumerate(grid):  # the innermost grid values that are surely outside
            low = F.when(F.lit(q) * n <= first - slack, F.get(sketch, F.lit(i))).otherwise(low)
        for i, q in reversed(list(enumerate(grid))):
            high = F.when(F.lit(q) * n >= last + slack, F.get(sketch, F.lit(i))).otherwise(high)
        out.append(F.struct(low.cast("double").alias("low"), high.cast("double").alias("high"), first.cast("long").alias("first"),
                            last.cast("long").alias("last"), (place - first).alias("part")))
    return F.array(*out)


def _cells(x: Column, lows: Sequence[Column], highs: Sequence[Column], number: int) -> list[Column]:
    """For each bracket a struct (quantile number, cell) of a row inside it or below it, else null; below, the cell is null."""
    out = []
    for i, (low, high) in enumerate(zip(lows, highs)):
        below, above = F.coalesce(x < low, F.lit(False)), F.coalesce(x > high, F.lit(False))
        out.append(F.when(x.isNotNull() & ~above, F.struct(F.lit(number + i).alias("i"), F.when(~below, x).alias("cell"))))
    return out


def _counted(data: DataFrame, keys: Sequence[Column], cells: Sequence[Column], names: Sequence[str]) -> DataFrame:
    """(keys..., i, cell, n, end): rows of each cell and, by running sum, up to it."""
    long = data.select(*keys, F.explode(F.array(*cells)).alias("c")).where(F.col("c").isNotNull()).select(*names, "c.*")
    upto = Window.partitionBy(*names, "i").orderBy(F.asc_nulls_first("cell")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = long.groupBy(*names, "i", "cell").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("end", F.sum("n").over(upto)).where(F.col("cell").isNotNull())


def _resolve(placed: DataFrame, keys: Sequence[str], bracket: Column) -> DataFrame:
    """(keys..., i, quantile) by the ranks of each quantile's bracket."""
    ranked = placed.withColumn("b", bracket)

    def at(rank: str) -> Column:
        wanted = F.col("b")[rank]
        return F.max(F.when((F.col("end") - F.col("n") <= wanted) & (wanted < F.col("end")), F.col("cell")))

    found = ranked.groupBy(*keys, "i").agg(at("first").alias("a"), at("last").alias("z"), F.first(F.col("b")["part"]).alias("part"))
    missed = F.raise_error(F.lit("a wanted rank lies outside its bracket"))
    between = F.when(F.col("a") == F.col("z"), F.col("a")).otherwise(F.col("a") + (F.col("z") - F.col("a")) * F.col("part"))
    return found.select(*keys, "i", F.when(F.col("a").isNull() | F.col("z").isNull(), missed.cast("double")).otherwise(between).alias("quantile"))


def exact_quantiles(df: DataFrame, probs: Sequence[float], series: Sequence[str] = ("series",), value: str = "value") -> DataFrame:
    """Frame (series..., quantiles array<double>) with linear interpolation, one row per series; NULL without values."""
    series, grid = list(series), _grid(probs)
    names = [f"_s{i}" for i in range(len(series))]
    data = df.select(*[F.col(s).alias(n) for s, n in zip(series, names)], canon(F.col(value).cast("double")).alias("_x"))
    sketches = data.groupBy(*names).agg(F.count("_x").alias("_n"), F.percentile_approx("_x", grid, ACCURACY).alias("_q"))
    bounds = stored(sketches.select(*names, "_n", _brackets(F.col("_n"), F.col("_q"), probs, grid).alias("_b")), "brackets")
    same = F.lit(True)
    for n in names:
        same = same & data[n].eqNullSafe(bounds[n])
    near = data.where(F.col("_x").isNotNull()).join(bounds, same, "inner")
    b = bounds["_b"]
    cells = _cells(data["_x"], [b[i]["low"] for i in range(len(probs))], [b[i]["high"] for i in range(len(probs))], 0)
    placed = _counted(near, [data[n] for n in names], cells, names)
    again = bounds.select(*[F.col(n).alias(f"_k{n}") for n in names], "_b")
    same = F.lit(True)
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"_k{n}"))
    found = _resolve(placed.join(again, same, "inner"), names, F.get("_b", F.col("i")))
    lists = found.groupBy(*names).agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "quantile"))), lambda q: q["quantile"]).alias("_quantiles"))
    same = F.lit(True)
    for n in names:
        same = same & bounds[n].eqNullSafe(lists[n])
    return bounds.join(lists, same, "left").select(*[bounds[n].alias(s) for n, s in zip(names, series)], F.col("_quantiles").alias("quantiles"))


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, list]:
    """Quantiles per numeric column as a driver-side dictionary (catalog-sized); None for a column without values.

    All columns share the two passes; only cells inside or below brackets leave their row.
    """
    if not columns:
        return {}
    grid = _grid(probs)
    data = df.select(*[canon(F.col(c).cast("double")).alias(f"_{i}") for i, c in enumerate(columns)])
    row = data.agg(*[F.struct(F.count(c).alias("n"), F.percentile_approx(c, grid, ACCURACY).alias("q")).alias(c) for c in data.columns]).first()
    sketches = data.sparkSession.createDataFrame([tuple(row[c]) for c in data.columns], "n long, q array<double>")
    # one row for each column, in order: the brackets are evaluated on the driver's side of a local table
    found = sketches.select(_brackets(F.col("n"), F.col("q"), probs, grid).alias("b")).collect()
    brackets, cells = [b for r in found for b in r["b"]], []
    for i, c in enumerate(data.columns):
        lows, highs = ([F.lit(b[side]).cast("double") for b in found[i]["b"]] for side in ("low", "high"))
        cells += _cells(F.col(c), lows, highs, i * len(probs))
    ranks = F.array(*[F.struct(F.lit(b["first"]).cast("long").alias("first"), F.lit(b["last"]).cast("long").alias("last"),
                               F.lit(b["part"]).cast("double").alias("part")) for b in brackets])
    found = _resolve(_counted(data, [], cells, []), [], F.get(ranks, F.col("i")))
    values = {r["i"]: r["quantile"] for r in bounded_collect(found, len(columns) * len(probs), "quantiles")}
    return {c: [values.get(i * len(probs) + j) for j in range(len(probs))] for i, c in enumerate(columns)}


def value_at_rank(df: DataFrame, column: str, rank: int, n: int) -> int:
    """The value of 0-based ``rank`` among the ``n`` non-null values of an integer column, bracketed by a sketch."""
    margin = 4 / ACCURACY + 2 / n
    low, high = df.agg(F.percentile_approx(column, [max(0.0, rank / n - margin), min(1.0, rank / n + margin)], ACCURACY)).first()[0]
    low = None if rank / n <= margin else low
    below = df.where(F.col(column) < low).count() if low is not None else 0
    inside = df.where(F.col(column).isNotNull() & (F.col(column) >= low if low is not None else F.lit(True)))
    inside = inside.where(F.col(column) <= high) if rank / n + margin < 1 else inside
    return inside.select(column).orderBy(column).limit(rank - below + 1).agg(F.max(column)).first()[0]


def hash_threshold(df: DataFrame, hash_column: str, count: int | Callable[[int], int],
                   bucket_rows: int = 100_000) -> tuple[str | None, int]:
    """(hash that is ``count``-th in ascending order, number of rows): ``count`` rows have a hash not above it.

    ``count`` may be a function of the number of rows. Buckets by hash prefix are counted (at most 65,536 rows per pass
    reach the driver) until the bucket holding the position is small; only that bucket is sorted.
    """
    prefix, left, total, h = "", 0, None, F.col(hash_column)
    while True:
        inside = df.where(h.startswith(prefix)) if prefix else df
        step = len(prefix) + 4
        sizes = sorted(tuple(r) for r in inside.groupBy(F.substring(h, 1, step)).count().collect())
        if total is None:
            total = sum(n for _, n in sizes)
            left = min(total, count(total) if callable(count) else count)
            if left <= 0:
                return None, total
        for name, size in sizes:
            if left <= size:
                prefix = name
                break
            left -= size
        if size <= bucket_rows or step >= 32:
            ordered = df.where(h.startswith(prefix)).select(h.alias("_h")).orderBy("_h").limit(left)
            return ordered.agg(F.max("_h")).first()[0], total


def with_ordinal(df: DataFrame, order_by: Sequence[str | Column], name: str = "row_position") -> DataFrame:
    """Dense 0-based position in the given order, which must be total.

    Rows are range-partitioned and sorted, and written with their place in that layout, so the partition sizes counted
    afterwards belong to exactly the rows they are applied to, even if executors are lost in between.
    """
    laid_out = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    marked = stored(laid_out.withColumn("_row", F.monotonically_increasing_id()), "ordinal")
    return _numbered(marked, F.shiftright("_row", 33), F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)), df.columns, name)


def with_file_ordinal(table: DataFrame, name: str = "row_position") -> DataFrame:
    """Dense 0-based position of the rows of a Parquet scan: files in name order, rows in file order.

    Uses the row index that the Parquet reader itself knows, so it does not depend on how files are split into tasks.
    """
    meta = F.col("_metadata")
    marked = table.select("*", meta.getField("file_path").alias("_file"), meta.getField("row_index").alias("_row"))
    return _numbered(marked, F.col("_file"), F.col("_row"), table.columns, name)


def _numbered(marked: DataFrame, part: Column, inside: Column, columns: list[str], name: str) -> DataFrame:
    """Adds the sizes of the earlier parts to the position inside a part; one row per part is all the window sees."""
    earlier = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = marked.groupBy(part.alias("_part")).count().select(
        "_part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_offset"))
    return marked.withColumn("_of", part).join(offsets, F.col("_of") == F.col("_part"), "inner").select(
        *columns, (F.col("_offset") + inside).alias(name))
