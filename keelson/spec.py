"""Declarations and their checks. Nothing here starts a Spark job: checks read schemas and lists only."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import types as T


class ContractError(ValueError):
    """Data or a declaration breaks a rule it must hold."""


def require_columns(df: DataFrame, names: Iterable[str], what: str = "table") -> None:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ContractError(f"{what} is missing columns: {missing}")


def forbid_columns(columns: Iterable[str], forbidden: Iterable[str], what: str = "table") -> None:
    leaked = sorted(set(columns) & set(forbidden))
    if leaked:
        raise ContractError(f"{what} contains leakage columns: {leaked}")


@dataclass(frozen=True)
class CleaningRules:
    """What the cleaning job needs to know about a raw table."""

    entity_key: str
    event_time: str = "event_timestamp"
    source_time: str | None = None
    components: tuple[str, ...] = ()
    label: str = "label"
    sentinels: tuple[float, ...] = ()
    numeric: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    no_answer: tuple[str, ...] = ()
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    time_formats: tuple[str, ...] = ()
    fallback_start: datetime = datetime(2024, 1, 1, tzinfo=timezone.utc)

    @classmethod
    def from_mapping(cls, m: Mapping[str, Any], label: str = "label") -> CleaningRules:
        """Read the ``preprocessing`` block of a pipeline configuration."""
        ranges = {c: (float(r["min"]), float(r["max"])) for c, r in m.get("plausible_ranges", {}).items()}
        return cls(
            entity_key=m["identifier_column"],
            event_time=m["event_timestamp_column"],
            source_time=m.get("source_timestamp_column"),
            components=tuple(m["target_components"]),
            label=label,
            sentinels=tuple(m.get("target_sentinel_values", ())),
            numeric=tuple(m.get("numeric_columns", ())),
            categorical=tuple(m.get("categorical_columns", ())),
            no_answer=tuple(m.get("invalid_response_values", ())),
            ranges=ranges,
        )


@dataclass(frozen=True)
class FeatureSpec:
    """One version of a feature table. ``derived`` maps a feature to the SQL expression that computes it."""

    version: str
    name: str
    entity_key: str
    event_time: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    features: tuple[str, ...] = ()
    leakage: tuple[str, ...] = ()
    derived: Mapping[str, str] = field(default_factory=dict)
    parent: str | None = None
    description: str = ""

    def __post_init__(self) -> None:
        if not self.features:
            object.__setattr__(self, "features", (*self.numeric, *self.categorical))
        features, kinds = list(self.features), [*self.numeric, *self.categorical]
        if not features:
            raise ContractError(f"{self.version}: no features")
        if len(set(features)) != len(features):
            raise ContractError(f"{self.version}: duplicate features")
        both = sorted(set(self.numeric) & set(self.categorical))
        if both:
            raise ContractError(f"{self.version}: both numeric and categorical: {both}")
        if set(kinds) != set(features):
            raise ContractError(f"{self.version}: untyped or unknown: {sorted(set(kinds) ^ set(features))}")
        unknown = sorted(set(self.derived) - set(features))
        if unknown:
            raise ContractError(f"{self.version}: derived but not a feature: {unknown}")
        forbid_columns(features, self.leakage, f"feature version {self.version}")

    @classmethod
    def from_mapping(cls, version: str, config: Mapping[str, Any], derived: Mapping[str, str] | None = None) -> FeatureSpec:
        """Read one entry of a ``feature_versions`` configuration."""
        versions = config.get("feature_versions", config)
        if version not in versions:
            raise ContractError(f"unknown feature version: {version}")
        m = versions[version]
        return cls(
            version=version, name=m["name"], entity_key=m["entity_key"], event_time=m["timestamp_column"],
            numeric=tuple(m["numerical_features"]), categorical=tuple(m["categorical_features"]),
            features=tuple(m["features"]), leakage=tuple(m.get("target_leakage_columns", ())),
            derived=dict(derived or {}), parent=m.get("parent_version"), description=m.get("description", "").strip(),
        )

    @property
    def columns(self) -> list[str]:
        return [self.entity_key, self.event_time, *self.features]

    def kind(self, feature: str) -> str:
        return "numerical" if feature in self.numeric else "categorical"


@dataclass(frozen=True)
class FeatureSource:
    """A table name, the path of a Parquet folder or a frame, with the column that says when a row became true."""

    data: Any
    event_time: str
    ordinal: str | None = None

    def frame(self, spark) -> DataFrame:
        if isinstance(self.data, DataFrame):
            return self.data
        return spark.read.parquet(self.data) if "/" in self.data else spark.table(self.data)


@dataclass(frozen=True)
class FeatureView:
    """Typed features of one source, with a time-to-live."""

    name: str
    entity_key: str
    source: FeatureSource
    schema: T.StructType
    ttl: timedelta | None = timedelta(days=3650)
    online: bool = True
    tags: Mapping[str, str] = field(default_factory=dict)

    @property
    def features(self) -> list[str]:
        return self.schema.fieldNames()


@dataclass(frozen=True)
class FeatureService:
    """A named bundle of views, retrieved together."""

    name: str
    views: Sequence[FeatureView]
    tags: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        keys = {v.entity_key for v in self.views}
        if len(keys) != 1:
            raise ContractError(f"{self.name}: views must share one entity key, got {sorted(keys)}")

    @property
    def entity_key(self) -> str:
        return self.views[0].entity_key

    def output_names(self) -> list[list[str]]:
        """Feature names per view; names occurring in several views get the view name in front."""
        seen: dict[str, int] = {}
        for v in self.views:
            for f in v.features:
                seen[f] = seen.get(f, 0) + 1
        return [[f"{v.name}__{f}" if seen[f] > 1 else f for f in v.features] for v in self.views]


@dataclass(frozen=True)
class ForestSettings:
    """Named settings of a random forest. ``max_bins`` is the number of split candidates per numeric column."""

    name: str
    trees: int
    depth: int
    min_leaf: int
    feature_subset: str = "sqrt"
    bootstrap: bool = True
    seed: int = 42
    max_bins: int = 256
    description: str = ""

    @classmethod
    def from_mapping(cls, name: str, m: Mapping[str, Any], seed: int = 42, algorithm: str = "RandomForestRegressor") -> ForestSettings:
        if algorithm != "RandomForestRegressor":
            raise ContractError(f"unsupported algorithm: {algorithm}")
        known = {"n_estimators", "max_depth", "min_samples_leaf", "max_features", "bootstrap", "description", "random_state", "n_jobs"}
        # settings that mean what MLlib's forests do anyway; another value cannot be honoured
        fixed = {"criterion": ("squared_error",), "min_samples_split": (2,), "max_leaf_nodes": (None,), "max_samples": (None,)}
        for option, value in m.items():
            if option not in known and value not in fixed.get(option, ()):
                raise ContractError(f"unsupported forest setting: {option}={value!r}")
        subset = m.get("max_features", "sqrt")
        return cls(
            name=name, trees=int(m["n_estimators"]), depth=int(m["max_depth"]), min_leaf=int(m["min_samples_leaf"]),
            feature_subset=subset if isinstance(subset, str) else ("all" if float(subset) == 1.0 else str(float(subset))),
            bootstrap=bool(m.get("bootstrap", True)), seed=seed, description=m.get("description", ""),
        )


@dataclass(frozen=True)
class RunSpec:
    """One cell of the experiment grid."""

    run_name: str
    feature_version: str
    settings: str
