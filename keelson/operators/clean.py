"""Rule-driven cleaning with a count for every rule, and label construction.

The order of the rules is part of the result: text, numbers, sentinels, ranges, event time, key, latest row per key,
rows without a complete label. Rule counts cover all raw rows. They travel *through* the per-key aggregation as partial
sums, so data, labels and all counts come from one pass and one shuffle by key.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions import scalar as S
from keelson.operators.keys import content_ordinal, latest_aggregate
from keelson.operators.ranks import exact_quantiles
from keelson.session import stored
from keelson.spec import CleaningRules, require_columns


def normalize_text(df: DataFrame, columns, tokens) -> DataFrame:
    """Strip category columns and map "no answer" texts to NULL; absent columns are skipped."""
    return df.withColumns({c: S.clean_text(F.col(c), tokens) for c in columns if c in df.columns})


def coerce_numbers(df: DataFrame, columns) -> DataFrame:
    """Columns as double, unparsable values as NULL; absent columns are skipped."""
    return df.withColumns({c: S.to_number(F.col(c), df.schema[c].dataType) for c in columns if c in df.columns})


def replace_sentinels(df: DataFrame, columns, sentinels) -> tuple[DataFrame, DataFrame]:
    """(frame with sentinels as NULL, report (column_name, sentinel_values, sentinel_replacement_count))."""
    require_columns(df, columns, "sentinel rule input")
    hits = df.agg(*[F.count_if(F.col(c).isin(list(sentinels))).alias(c) for c in columns])
    report = hits.unpivot([], list(columns), "column_name", "sentinel_replacement_count").select(
        "column_name", _sentinel_array(sentinels).alias("sentinel_values"), "sentinel_replacement_count")
    return df.withColumns({c: S.null_if_in(F.col(c), sentinels) for c in columns}), report


def apply_ranges(df: DataFrame, ranges) -> tuple[DataFrame, DataFrame]:
    """(frame with implausible values as NULL, report (column_name, minimum, maximum, invalid_value_count))."""
    present = {c: r for c, r in ranges.items() if c in df.columns}
    hits = df.agg(*[F.count_if(S.is_violation(F.col(c), *r)).alias(c) for c, r in present.items()])
    long = hits.unpivot([], list(present), "column_name", "invalid_value_count")
    return (df.withColumns({c: S.null_outside(F.col(c), *r) for c, r in present.items()}),
            _with_bounds(long, present, "invalid_value_count"))


def _sentinel_array(sentinels) -> Column:
    return F.array(*[F.lit(float(s)) for s in sentinels]).cast("array<double>")


def _with_bounds(long: DataFrame, ranges, count: str) -> DataFrame:
    def pick(i):
        expr = F.lit(None).cast("double")
        for c, r in ranges.items():
            expr = F.when(F.col("column_name") == c, F.lit(float(r[i]))).otherwise(expr)
        return expr

    return long.select("column_name", pick(0).alias("minimum"), pick(1).alias("maximum"), count)


def event_time(df: DataFrame, rules: CleaningRules, ordinal: str | None) -> Column:
    """Parsed source time, else fallback start + row position in seconds (if the ordinal is a number)."""
    source = rules.source_time
    parsed = None
    if source and source in df.columns:
        parsed = S.to_time(F.col(source), df.schema[source].dataType, rules.time_formats)
    if ordinal is None or not S.is_numeric(df.schema[ordinal].dataType):
        if parsed is None:
            raise ValueError("without a source time a numeric ordinal is needed for the fallback time")
        return parsed
    ntz = parsed is not None and isinstance(df.schema[source].dataType, T.TimestampNTZType)
    start = F.lit(rules.fallback_start.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz") if ntz \
        else F.timestamp_micros(F.lit(int(rules.fallback_start.timestamp()) * 1_000_000))
    fallback = F.timestamp_add("SECOND", F.col(ordinal).cast("bigint"), start)
    return fallback if parsed is None else F.coalesce(parsed, fallback)


def integer_key(df: DataFrame, column: str) -> Column:
    """The key as bigint: integers and integer texts exactly, other numbers and number texts truncated towards zero."""
    dtype, key = df.schema[column].dataType, F.col(column)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return key.cast("bigint")
    number = S.to_number(key, dtype).try_cast("bigint")
    if isinstance(dtype, T.StringType):
        return F.when(key.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(F.regexp_replace(key, r"\s", "")).try_cast("bigint")).otherwise(number)
    return number


@dataclass
class CleanResult:
    """Lazy results of one cleaning plan. ``per_key`` feeds all others: use ``shared()`` when several are wanted."""

    rules: CleaningRules
    columns: list[str]
    per_key: DataFrame
    data: DataFrame
    labels: DataFrame

    def shared(self) -> CleanResult:
        """The same results from a stored per-key aggregate, so that the raw table is read and shuffled once."""
        return _results(self.rules, self.columns, stored(self.per_key, "per-key"))

    @property
    def predictors(self) -> DataFrame:
        return self.data.drop(*self.rules.components, self.rules.label)

    def sentinel_report(self) -> DataFrame:
        """(column_name, sentinel_values, sentinel_replacement_count) over all raw rows."""
        comps = list(self.rules.components)
        sums = self.per_key.agg(*[F.coalesce(F.sum(f"_s_{c}"), F.lit(0)).alias(c) for c in comps])
        long = sums.unpivot([], comps, "column_name", "sentinel_replacement_count")
        return long.select("column_name", _sentinel_array(self.rules.sentinels).alias("sentinel_values"),
                           "sentinel_replacement_count")

    def range_report(self) -> DataFrame:
        """(column_name, minimum, maximum, invalid_value_count) over all raw rows."""
        ranged = {c: r for c, r in self.rules.ranges.items() if f"_r_{c}" in self.per_key.columns}
        sums = self.per_key.agg(*[F.coalesce(F.sum(f"_r_{c}"), F.lit(0)).alias(c) for c in ranged])
        long = sums.unpivot([], list(ranged), "column_name", "invalid_value_count")
        return _with_bounds(long, ranged, "invalid_value_count")

    def _accounts(self) -> list[Column]:
        """Row accounting as aggregates over ``per_key``."""
        r = self.rules
        known = F.col(r.entity_key).isNotNull()
        good = known & F.col("_complete")
        label = F.when(good, F.col("_label"))
        hidden = set(r.components)
        predictors = [c for c in self.columns if c not in hidden and c != r.entity_key]
        cells = F.lit(0).cast("bigint")
        for c in predictors:
            cells = cells + F.col("_latest").getField(c).isNull().cast("bigint")

        def total(c):
            return F.coalesce(F.sum(c), F.lit(0))

        sentinel_hits = F.lit(0).cast("bigint")
        for c in r.components:
            sentinel_hits = sentinel_hits + F.col(f"_s_{c}")
        return [
            total(F.col("_n")).alias("initial_rows"),
            total(F.when(~known, F.col("_n"))).alias("missing_key_rows_removed"),
            total(F.when(known, F.col("_n") - 1)).alias("duplicate_key_rows_removed"),
            F.count_if(known & ~F.col("_complete")).alias("bad_label_rows_removed"),
            F.count_if(good).alias("final_rows"),
            F.lit(len(self.data.columns)).alias("final_columns"),
            total(sentinel_hits).alias("sentinels_replaced"),
            F.min(label).alias("label_min"),
            F.max(label).alias("label_max"),
            F.avg(label).alias("label_mean"),
            total(F.when(good, cells)).alias("missing_predictor_cells"),
        ]

    def write(self, path: str) -> Written:
        """Writes the cleaned table and counts on the way: rows are accounted for by the tasks that write them.

        The metrics belong to the stage that writes, whose tasks count once however often others are repeated.
        """
        hits = [c for c in self.per_key.columns if c.startswith(("_s_", "_r_"))]
        totals = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in hits]
        seen = Observation(f"cleaning {path}")
        _results(self.rules, self.columns, self.per_key.observe(seen, *self._accounts(), *totals)).data.write.mode("overwrite").parquet(path)
        spark = self.per_key.sparkSession
        return Written(self.rules, spark.read.schema(self.data.schema).parquet(path), seen.get)

    def summary(self, median: bool = True) -> DataFrame:
        """One row: initial rows, rows dropped by each reason, final rows, label statistics, missing predictor cells."""
        one = self.per_key.agg(*self._accounts())
        if not median:
            return one
        return one.withColumn("label_median", F.lit(_median(self.labels, self.rules.label)).cast("double"))


@dataclass
class Written:
    """A cleaned table and what was counted while it was written; reports read no further rows of the raw table."""

    rules: CleaningRules
    data: DataFrame
    counts: dict[str, Any]

    def summary(self, median: bool = True) -> DataFrame:
        """The row of ``CleanResult.summary``; only the median reads the cleaned labels."""
        kinds = {"label_min": "double", "label_max": "double", "label_mean": "double", "final_columns": "int"}
        names = [n for n in self.counts if not n.startswith(("_s_", "_r_"))]
        row, schema = tuple(self.counts[n] for n in names), ", ".join(f"{n} {kinds.get(n, 'bigint')}" for n in names)
        one = self.data.sparkSession.createDataFrame([row], schema)
        return one.withColumn("label_median", F.lit(_median(self.data, self.rules.label)).cast("double")) if median else one

    def sentinel_report(self) -> DataFrame:
        rows = [(c, self.counts[f"_s_{c}"]) for c in self.rules.components]
        long = self.data.sparkSession.createDataFrame(rows, "column_name string, sentinel_replacement_count bigint")
        return long.select("column_name", _sentinel_array(self.rules.sentinels).alias("sentinel_values"), "sentinel_replacement_count")

    def range_report(self) -> DataFrame:
        ranged = {c: r for c, r in self.rules.ranges.items() if f"_r_{c}" in self.counts}
        long = self.data.sparkSession.createDataFrame([(c, self.counts[f"_r_{c}"]) for c in ranged], "column_name string, invalid_value_count bigint")
        return _with_bounds(long, ranged, "invalid_value_count")


def _median(labels: DataFrame, label: str) -> float | None:
    values = labels.select(F.lit("label").alias("series"), F.col(label).alias("value"))
    middle = exact_quantiles(values, [0.5]).collect()
    return middle[0]["quantiles"][0] if middle and middle[0]["quantiles"] else None


def clean(df: DataFrame, rules: CleaningRules, ordinal: str | None = None) -> CleanResult:
    """The whole cleaning job.

    ``ordinal`` is the row position, used for fallback times and to keep the later of two rows with equal key and time.
    Without it, ties are decided by row content.
    """
    require_columns(df, [rules.entity_key, *rules.components], "raw table")
    numeric = [c for c in rules.numeric if c != rules.entity_key]
    step = coerce_numbers(normalize_text(df, rules.categorical, rules.no_answer), numeric)
    floats = [f.name for f in step.schema.fields if S.is_fractional(f.dataType) and f.name not in rules.numeric]
    step = step.withColumns({c: S.canon(F.col(c)) for c in floats})

    hits: dict[str, Column] = {}
    cleaned: dict[str, Column] = {}
    for c in dict.fromkeys([*rules.components, *rules.ranges]):
        if c not in step.columns:
            continue
        value = F.col(c)
        if c in rules.components:
            hits[f"_s_{c}"] = F.coalesce(value.isin(list(rules.sentinels)), F.lit(False)).cast("bigint") \
                if rules.sentinels else F.lit(0).cast("bigint")
            value = S.null_if_in(value, rules.sentinels)
        if c in rules.ranges:
            low, high = rules.ranges[c]
            hits[f"_r_{c}"] = F.coalesce(S.is_violation(value, low, high), F.lit(False)).cast("bigint")
            value = S.null_outside(value, low, high)
        cleaned[c] = value

    when = event_time(step, rules, ordinal)
    key = integer_key(step, rules.entity_key)
    columns = [c for c in dict.fromkeys([*df.columns, rules.event_time]) if c != ordinal]
    flat = step.withColumns({**cleaned, **hits, rules.event_time: when, rules.entity_key: key})
    tie = F.col(ordinal) if ordinal else content_ordinal([c for c in columns if c != rules.entity_key])
    payload = [c for c in columns if c != rules.entity_key]
    per_key = flat.groupBy(rules.entity_key).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(h).alias(h) for h in hits],
        latest_aggregate(payload, rules.event_time, tie).alias("_latest"))
    complete = F.lit(True)
    label = None
    for c in rules.components:
        part = F.col("_latest").getField(c)
        complete = complete & part.isNotNull()
        label = part if label is None else label + part
    return _results(rules, columns, per_key.withColumns({"_complete": complete, "_label": F.lit(None) if label is None else label}))


def _results(rules: CleaningRules, columns: list[str], per_key: DataFrame) -> CleanResult:
    kept = per_key.where(F.col(rules.entity_key).isNotNull() & F.col("_complete"))
    outputs = [F.col(c) if c == rules.entity_key else F.col("_latest").getField(c).alias(c) for c in columns]
    data = kept.select(*outputs, F.col("_label").alias(rules.label))
    labels = data.select(rules.entity_key, rules.event_time, rules.label)
    return CleanResult(rules, columns, per_key, data, labels)
