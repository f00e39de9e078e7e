"""Profiles of a table: overview, per-column completeness, numeric and categorical summaries, histograms.

Distinct counts and most frequent values come from one (column, value) frequency aggregate. It combines map-side, so a
value filling a third of a column costs one row per task, and no ``count(distinct)`` per column is expanded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions import scalar as S
from keelson.functions.digest import canonical_text, row_digest
from keelson.operators.ranks import column_quantiles, exact_quantiles, to_long
from keelson.session import bounded_collect, release, stored
from keelson.spec import FeatureSpec

LONG_TEXT = 64


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if S.is_numeric(f.dataType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _canon(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema.fields if S.is_fractional(f.dataType)]
    return df.withColumns({c: S.canon(F.col(c)) for c in floats}) if floats else df


def overview(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, columns, duplicate rows, missing cells and their share, missing / distinct / duplicated keys.

    A row is compared by its SHA-256, so wide rows are not shuffled whole. Rows are reduced to (key, digest) counts,
    those to key counts, those to one row: two shuffles, both after map-side combine.
    """
    n_columns = len(df.columns)
    clean = _canon(df)
    marked = clean.select(F.col(key).alias("_k"), F.unhex(row_digest(clean)).alias("_d"),
                          S.null_cells(clean.columns).alias("_m"))
    n, rows, distinct = F.col("_n"), F.col("_rows"), F.col("_distinct")
    by_row = marked.groupBy("_k", "_d").agg(F.count(F.lit(1)).alias("_n"), F.sum("_m").alias("_m"))
    by_key = by_row.groupBy("_k").agg(F.sum(n).alias("_rows"), F.count(F.lit(1)).alias("_distinct"),
                                      F.sum("_m").alias("_m"))
    known = F.col("_k").isNotNull()
    total = F.coalesce(F.sum(rows), F.lit(0))
    missing = F.coalesce(F.sum("_m"), F.lit(0))
    return by_key.agg(
        total.alias("row_count"),
        F.lit(n_columns).cast("bigint").alias("column_count"),
        (total - F.coalesce(F.sum(distinct), F.lit(0))).alias("duplicate_rows"),
        missing.alias("missing_cells"),
        S.percent(missing, total * n_columns).alias("missing_cell_percentage"),
        F.coalesce(F.sum(F.when(~known, rows)), F.lit(0)).alias("missing_keys"),
        F.count_if(known).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(known & (rows > 1), rows)), F.lit(0)).alias("duplicated_key_rows"),
    )


def value_counts(df: DataFrame, columns: Sequence[str], keep_text: bool = True) -> DataFrame:
    """(column_name, value, n) with NULL as a value of its own. Texts are replaced by their hash if not kept."""
    texts = []
    for c in columns:
        text = canonical_text(c, df.schema[c].dataType)
        if not keep_text and isinstance(df.schema[c].dataType, (T.StringType, T.ArrayType, T.StructType, T.MapType)):
            text = F.when(F.length(text) > LONG_TEXT, F.sha2(text, 256)).otherwise(text)
        texts.append(text.alias(c))
    long = df.select(*texts).unpivot([], list(columns), "column_name", "value")
    return long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def _lookup(names: Sequence[str], values: Sequence, dtype: str) -> Column:
    """Value by column name, as a map literal of catalog size."""
    pairs = [x for n, v in zip(names, values) for x in (F.lit(n), F.lit(v).cast(dtype))]
    return F.try_element_at(F.create_map(*pairs), F.col("column_name"))


def column_profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """(column_position, column_name, data_type, non_null_count, missing_count, unique_count, missing_percentage).

    ``approx`` estimates distinct counts (HyperLogLog++, relative error 5 %) in one pass without a shuffle of values.
    Present it by missing_percentage descending, then column_position.
    """
    names = df.columns
    types = [f.dataType.simpleString() for f in df.schema.fields]
    if approx:
        clean = _canon(df)
        wide = clean.agg(*[F.struct(F.count(c).alias("non_null_count"), F.count_if(F.col(c).isNull()).alias("missing_count"),
                                    F.approx_count_distinct(c).alias("unique_count")).alias(c) for c in names])
        stats = wide.unpivot([], names, "column_name", "s").select("column_name", "s.*")
    else:
        freq, known = value_counts(df, names, keep_text=False), F.col("value").isNotNull()
        stats = freq.groupBy("column_name").agg(
            F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("non_null_count"),
            F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("missing_count"),
            F.count_if(known).alias("unique_count"))
    return stats.select(
        _lookup(names, list(range(len(names))), "int").alias("column_position"), "column_name",
        _lookup(names, types, "string").alias("data_type"), "non_null_count", "missing_count", "unique_count",
        S.percent(F.col("missing_count"), F.col("missing_count") + F.col("non_null_count")).alias("missing_percentage"))


def missing_report(profile: DataFrame, top: int | None = None) -> DataFrame:
    """Missing-value view of :func:`column_profile`; ``top`` keeps the columns with most missing values."""
    view = profile.select("column_position", "column_name", "missing_count", "missing_percentage")
    ordered = view.orderBy(F.desc("missing_percentage"), F.asc("column_position"))
    return ordered.limit(top) if top else ordered


def numeric_summary(df: DataFrame, approx: bool = False) -> DataFrame:
    """(column_name, count, mean, std, min, p25, p50, p75, max) per numeric column, unrounded; empty without any.

    Quartiles interpolate linearly and are exact; ``approx`` uses ``percentile_approx`` (rank error 1/10,000) instead.
    """
    names = numeric_columns(df)
    schema = "column_name string, count bigint, mean double, std double, min double, p25 double, p50 double, p75 double, max double"
    if not names:
        return df.sparkSession.createDataFrame([], schema)
    probs = [0.25, 0.5, 0.75]
    wide = df.select(*[S.canon(F.col(c).cast("double")).alias(c) for c in names])
    measures = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    if approx:
        measures["quartiles"] = lambda c: F.percentile_approx(c, probs, 10_000)
    # one aggregate without grouping: a row per task is shuffled
    row = wide.agg(*[F.struct(*[f(c).alias(m) for m, f in measures.items()]).alias(c) for c in names]).first()
    stats = [row[i] for i in range(len(names))]
    quartiles = {n: s["quartiles"] or [None] * 3 for n, s in zip(names, stats)} if approx else column_quantiles(
        wide, names, probs)
    rows = [(n, s["count"], s["mean"], s["std"], s["min"], *quartiles[n], s["max"]) for n, s in zip(names, stats)]
    return df.sparkSession.createDataFrame(rows, schema)


def categorical_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, unique_count, missing_count, most_frequent_value, most_frequent_count).

    A missing value competes for most frequent; equal counts are decided by the smaller value, missing last.
    Present it by unique_count descending.

    Long texts are counted by digest and beginning, so whole texts are not shuffled. Only where a long text wins are the
    rows with its beginning read again, and the smallest text among equals is found by a minimum in each task.
    """
    names = list(columns if columns is not None else text_columns(df))
    schema = "column_name string, unique_count bigint, missing_count bigint, most_frequent_value string, most_frequent_count bigint"
    if not names:
        return df.sparkSession.createDataFrame([], schema)
    value, start = F.col("value"), F.substring("value", 1, LONG_TEXT)
    is_long = F.length(value) > LONG_TEXT
    # a short text sorts before long ones with the same beginning
    key = F.when(is_long, F.concat(F.lit("#"), F.sha2(value, 256))).otherwise(F.concat(F.lit("!"), value))
    long = df.select(*[canonical_text(c, df.schema[c].dataType).alias(c) for c in names]).unpivot([], names, "column_name", "value")
    freq = stored(long.select("column_name", key.alias("key"), start.alias("start")).groupBy("column_name", "key").agg(
        F.count(F.lit(1)).alias("n"), F.min("start").alias("start")), "frequencies")
    known = F.col("key").isNotNull()
    top = bounded_collect(freq.groupBy("column_name").agg(
        F.count_if(known).alias("unique"), F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("missing"),
        F.min_by(F.struct("key", "start", "n"), F.struct((-F.col("n")).alias("a"), F.col("key").isNull().alias("b"), F.col("start").alias("c"),
                                                         F.col("key").alias("d"))).alias("best")), len(names), "columns")
    won = {r["column_name"]: r["best"]["start"] for r in top}
    for r in top:
        c, best = r["column_name"], r["best"]
        if best["key"] is not None and best["key"].startswith("#"):
            equals = freq.where((F.col("column_name") == c) & (F.col("n") == best["n"]) & (F.col("start") == best["start"]) & F.col("key").startswith("#"))
            rows = long.where((F.col("column_name") == c) & is_long & (start == best["start"])).withColumn("key", key)
            won[c] = rows.join(equals.select("key"), "key", "left_semi").agg(F.min("value")).first()[0]
    release(freq)
    return df.sparkSession.createDataFrame([(r["column_name"], r["unique"], r["missing"], won[r["column_name"]], r["best"]["n"]) for r in top], schema)


def feature_missingness(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """(feature_version, feature, feature_type, missing_count, missing_percentage, unique_non_null_values)."""
    profile = column_profile(df.select(*spec.features))
    return profile.select(
        F.lit(spec.version).alias("feature_version"), F.col("column_name").alias("feature"),
        _lookup(spec.features, [spec.kind(f) for f in spec.features], "string").alias("feature_type"),
        "missing_count", "missing_percentage", F.col("unique_count").alias("unique_non_null_values"))


def schema_report(df: DataFrame) -> DataFrame:
    """(column_position, column_name, data_type, has_missing, unique_non_null_values)."""
    return column_profile(df).select("column_position", "column_name", "data_type",
                                     (F.col("missing_count") > 0).alias("has_missing"),
                                     F.col("unique_count").alias("unique_non_null_values"))


def derived_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, non_null_count, missing_count, missing_percentage, minimum, maximum, mean, median), unrounded."""
    long = to_long(df, columns, "column_name")
    medians = column_quantiles(df, columns, [0.5])
    stats = long.groupBy("column_name").agg(
        F.count("value").alias("non_null_count"), F.count_if(F.col("value").isNull()).alias("missing_count"),
        F.min("value").alias("minimum"), F.max("value").alias("maximum"), F.avg("value").alias("mean"))
    return stats.select(
        F.col("column_name").alias("feature"), "non_null_count", "missing_count",
        S.percent(F.col("missing_count"), F.col("missing_count") + F.col("non_null_count")).alias("missing_percentage"),
        "minimum", "maximum", "mean", _lookup(list(columns), [medians[c][0] for c in columns], "double").alias("median"))


def target_statistics(df: DataFrame, target: str, split: str | None = None) -> DataFrame:
    """(population, count, mean, median, std, min, max) for all rows and, with ``split``, for each split."""
    value = S.canon(F.col(target).cast("double")).alias("value")
    if split is None:
        long = df.select(F.lit("all").alias("population"), value)
        stats = long.groupBy("population")
    else:
        # the total repeats the per-split rows inside one aggregate: no second scan
        both = F.array(F.lit("all"), F.col(split))
        long = df.select(F.explode(both).alias("population"), value)
        stats = long.groupBy("population")
    measured = stats.agg(F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
                         F.min("value").alias("min"), F.max("value").alias("max"))
    quantiles = exact_quantiles(long, [0.5], ("population",)).select(
        F.col("population").alias("_p"), F.col("quantiles").getItem(0).alias("median"))
    joined = measured.join(quantiles, F.col("population").eqNullSafe(F.col("_p")), "left")
    return joined.select("population", "count", "mean", "median", "std", "min", "max")


def histogram(df: DataFrame, column: str, bins: int, series: str | None = None, low: float | None = None,
              high: float | None = None) -> DataFrame:
    """(series?, bin, bin_low, bin_high, n, density) with equal-width bins over [min, max] of each series.

    The maximum belongs to the last bin; bins are 1-based and empty ones are listed. A constant series has one bin. Infinite
    values, and those outside a given range, take no part, in the density neither.
    """
    value = S.canon(F.col(column).cast("double"))
    data = df.select(*([F.col(series).alias("series")] if series else [F.lit("all").alias("series")]), value.alias("v"))
    data = data.where(F.col("v").isNotNull() & (F.abs("v") < float("inf")))
    lo = F.min("v") if low is None else F.lit(float(low))
    hi = F.max("v") if high is None else F.lit(float(high))
    if low is not None:
        data = data.where(F.col("v") >= low)
    if high is not None:
        data = data.where(F.col("v") <= high)
    edges = data.groupBy("series").agg(lo.alias("lo"), hi.alias("hi"), F.count(F.lit(1)).alias("total"))
    grid = stored(edges.withColumn("k", F.when(F.col("lo") == F.col("hi"), F.lit(1)).otherwise(F.lit(bins))), "edges")
    if series:
        named = grid.select(F.col("series").alias("_s"), "lo", "hi", "k")
        near = data.join(named, F.col("series").eqNullSafe(F.col("_s")), "inner")
    else:
        one = grid.first() or {"lo": 0.0, "hi": 0.0, "k": 1}  # a single row
        near = data.withColumns({"lo": F.lit(one["lo"]), "hi": F.lit(one["hi"]), "k": F.lit(one["k"])})
    cell = F.when(F.col("lo") == F.col("hi"), F.lit(1)).otherwise(
        F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.col("k")).cast("int") + 1, F.col("k")))
    counted = near.groupBy("series", cell.alias("bin")).agg(F.count(F.lit(1)).alias("n")).select(
        F.col("series").alias("_s"), F.col("bin").alias("_b"), "n")
    every = grid.select("*", F.explode(F.sequence(F.lit(1), F.col("k"))).alias("bin"))
    same = F.col("bin") == F.col("_b")
    full = every.join(counted, (F.col("series").eqNullSafe(F.col("_s")) & same) if series else same, "left")
    width = (F.col("hi") - F.col("lo")) / F.col("k")
    out = full.select(
        "series", "bin", (F.col("lo") + width * (F.col("bin") - 1)).alias("bin_low"),
        (F.col("lo") + width * F.col("bin")).alias("bin_high"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
        F.try_divide(F.coalesce("n", F.lit(0)).cast("double"), F.col("total") * width).alias("density"))
    return out if series else out.drop("series")


def shared_range(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row (low, high) covering both columns."""
    return df.agg(F.least(F.min(actual), F.min(predicted)).alias("low"),
                  F.greatest(F.max(actual), F.max(predicted)).alias("high"))


def time_range(frames: Sequence[tuple[DataFrame, str]], margin_seconds: int = 1) -> DataFrame:
    """One row (start_time, end_time) over the time columns of several tables, widened on both ends."""
    parts = [df.agg(F.min(t).alias("lo"), F.max(t).alias("hi")) for df, t in frames]
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p)
    margin = F.make_dt_interval(secs=F.lit(margin_seconds))
    return merged.agg((F.min("lo") - margin).alias("start_time"), (F.max("hi") + margin).alias("end_time"))


def group_counts(df: DataFrame, by: Sequence[str], key: str) -> DataFrame:
    """(by..., row_count, key_count): rows and distinct keys per version or partition, duplicates combined map-side."""
    return df.groupBy(*by, key).agg(F.count(F.lit(1)).alias("_n")).groupBy(*by).agg(
        F.sum("_n").alias("row_count"), F.count(key).alias("key_count"))
