"""Versioned feature tables: build, derived features, manifest, lineage and comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions import scalar as S
from keelson.functions.digest import combine_sums, fingerprint_aggregates, hashed_rows, schema_fingerprint
from keelson.operators import profile
from keelson.operators.keys import key_counts
from keelson.operators.split import apply_split
from keelson.spec import ContractError, FeatureSpec, forbid_columns, require_columns


def derive(df: DataFrame, expressions: Mapping[str, str]) -> DataFrame:
    """Add features given as SQL expressions; a non-finite result is missing."""
    return df.withColumns({name: S.finite(F.expr(e).cast("double")) for name, e in expressions.items()})


def integrity(df: DataFrame, key: str, time: str, target: str | None = None) -> DataFrame:
    """One row (row_count, missing_keys, duplicate_keys, missing_times, missing_targets), one aggregate by key."""
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col(time).isNull()).alias("_t"),
        (F.count_if(F.col(target).isNull()) if target else F.lit(0).cast("bigint")).alias("_y"))
    known = F.col(key).isNotNull()

    def total(c):
        return F.coalesce(F.sum(c), F.lit(0))

    return per_key.agg(
        total("_n").alias("row_count"), total(F.when(~known, F.col("_n"))).alias("missing_keys"),
        total(F.when(known, F.col("_n") - 1)).alias("duplicate_keys"),
        total("_t").alias("missing_times"), total("_y").alias("missing_targets"))


def require_integrity(df: DataFrame, key: str, time: str, target: str | None = None, what: str = "table") -> None:
    state = integrity(df, key, time, target).first().asDict()
    broken = {k: v for k, v in state.items() if k != "row_count" and v}
    if broken:
        raise ContractError(f"{what} breaks its key contract: {broken}")


def feature_table(processed: DataFrame, spec: FeatureSpec) -> DataFrame:
    """(key, time, features...) in the order of the spec; missing predictors stay missing."""
    inputs = [c for c in spec.features if c not in spec.derived]
    require_columns(processed, [spec.entity_key, spec.event_time, *inputs], f"input of {spec.version}")
    return derive(processed, spec.derived).select(*spec.columns)


@dataclass
class FeatureBuild:
    spec: FeatureSpec
    data: DataFrame

    def missingness(self) -> DataFrame:
        return profile.feature_missingness(self.data, self.spec)

    def schema(self) -> DataFrame:
        return profile.schema_report(self.data)

    def manifest(self, parent: DataFrame | None = None, same_population: bool | None = None) -> DataFrame:
        return manifest(self.data, self.spec, parent, same_population)


def build(processed: DataFrame, spec: FeatureSpec, check: bool = True) -> FeatureBuild:
    """Build one feature version; with ``check`` its key contract is verified by one aggregate job."""
    data = feature_table(processed, spec)
    forbid_columns(data.columns, spec.leakage, spec.version)
    if check:
        require_integrity(data, spec.entity_key, spec.event_time, what=f"feature table {spec.version}")
    return FeatureBuild(spec, data)


def _texts(names: Sequence[str]) -> Column:
    return F.lit(list(names)) if names else F.array().cast("array<string>")


def manifest(data: DataFrame, spec: FeatureSpec, parent: DataFrame | None = None,
             same_population: bool | None = None) -> DataFrame:
    """One nested row describing a feature version, with the lineage to ``parent``'s manifest if given."""
    marked = data.select(*hashed_rows(data, data.columns), S.null_cells(spec.features).alias("_m"))
    # two aggregates: the fingerprint needs no shuffle, so its sums are kept out of the shuffle by key
    sums = marked.agg(F.coalesce(F.sum("_m"), F.lit(0)).alias("missing_feature_values"),
                      *fingerprint_aggregates())
    keys = key_counts(data, spec.entity_key).select(
        "row_count", F.col("distinct_keys").alias("entity_count"), F.col("superseded_rows").alias("duplicate_entity_count"))
    totals = one_row(keys, sums)
    out = totals.select(
        F.lit(spec.version).alias("feature_version"), F.lit(spec.name).alias("feature_view_name"),
        F.lit(spec.description).alias("description"), F.lit(spec.entity_key).alias("entity_key"),
        F.lit(spec.event_time).alias("timestamp_column"), _texts(spec.features).alias("features"),
        _texts(spec.numeric).alias("numerical_features"), _texts(spec.categorical).alias("categorical_features"),
        F.lit(len(spec.features)).alias("feature_count"), "row_count", "entity_count", "duplicate_entity_count",
        "missing_feature_values", F.lit(schema_fingerprint(data.schema)).alias("schema_fingerprint"),
        combine_sums().alias("data_fingerprint"), _texts(spec.leakage).alias("excluded_columns"))
    if parent is None:
        return out
    p = parent.select("feature_version", "data_fingerprint").first()
    rules = [f"{k} = {v}" for k, v in spec.derived.items()]
    return out.withColumns({
        "parent_version": F.lit(p["feature_version"]), "parent_fingerprint": F.lit(p["data_fingerprint"]),
        "transformations": _texts(rules), "same_population": F.lit(same_population).cast("boolean")})


def compare_versions(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row: versions, feature lists, added and removed features, row counts and fingerprints of two manifests."""
    def side(m: DataFrame, name: str) -> DataFrame:
        return m.select(F.lit(name).alias("_s"), "feature_version", "features", "row_count", "data_fingerprint")

    def pick(name: str, c: str) -> Column:
        return F.max(F.when(F.col("_s") == name, F.col(c)))

    fields = {"version": "feature_version", "features": "features", "rows": "row_count", "fingerprint": "data_fingerprint"}
    one = side(old, "old").unionByName(side(new, "new")).agg(
        *[pick(s, c).alias(f"{s}_{n}") for s in ("old", "new") for n, c in fields.items()])
    return one.select("*", F.array_except("new_features", "old_features").alias("added_features"),
                      F.array_except("old_features", "new_features").alias("removed_features"))


def one_row(*frames: DataFrame) -> DataFrame:
    """One row with the columns of several one-row frames, whose columns differ."""
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged.agg(*[F.max(c).alias(c) for c in merged.columns])


def training_dataset(df: DataFrame, spec: FeatureSpec, target: str, check: bool = True,
                     time_formats: Sequence[str] = ()) -> DataFrame:
    """(key, time, target, features...) with canonical types; fails on leakage or a broken key contract."""
    require_columns(df, [spec.entity_key, spec.event_time, target, *spec.features], "training input")
    forbid_columns(df.columns, set(spec.leakage) - {target}, "training input")
    types = {f.name: f.dataType for f in df.schema.fields}
    out = df.select(
        F.col(spec.entity_key).try_cast("bigint").alias(spec.entity_key),
        S.to_time(F.col(spec.event_time), types[spec.event_time], time_formats).alias(spec.event_time),
        S.to_number(F.col(target), types[target]).alias(target), *spec.features)
    if check:
        require_integrity(out, spec.entity_key, spec.event_time, target, "training dataset")
    return out


def model_inputs(df: DataFrame, spec: FeatureSpec, keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., numeric features as double, categories as string); NULL is the only missing marker."""
    require_columns(df, [*keep, *spec.features], "model input")
    types = {f.name: f.dataType for f in df.schema.fields}
    cells = [S.to_number(F.col(f), types[f]).alias(f) if f in spec.numeric else F.col(f).cast("string").alias(f)
             for f in spec.features]
    return df.select(*keep, *cells)


def model_split(df: DataFrame, membership: DataFrame, spec: FeatureSpec, target: str, check: bool = True) -> DataFrame:
    """(key, split, target, features...): keys, labels and features stay in one row, so nothing has to be aligned."""
    assigned = apply_split(df, membership, spec.entity_key, check)
    return model_inputs(assigned, spec, (spec.entity_key, "split", target))


def schema_of(spec: FeatureSpec) -> T.StructType:
    """Declared types of a version's features: double and string."""
    return T.StructType([T.StructField(f, T.DoubleType() if f in spec.numeric else T.StringType()) for f in spec.features])
