"""Leakage-free preprocessing and distributed forest regression.

Imputation values and categories come from training rows only. Categories are a table, numbered by range partitioning, and
rows get their numbers by joining it: no list of categories reaches the driver or a plan, whatever their number. A saved
model holds the table, the statistics and the forest, and scores raw feature rows by itself.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass, fields
from functools import cached_property

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.operators.forest import Forest, Layout, estimator, grow, predict_by, read_mllib, tree_sizes, write_mllib
from keelson.operators.metrics import METRICS, regression_metrics, residuals
from keelson.operators.profile import value_counts
from keelson.operators.ranks import column_quantiles, with_ordinal
from keelson.session import BROADCAST_ROWS, bounded_collect, release, shared_path, stored
from keelson.spec import ContractError, FeatureSpec, ForestSettings

#: columns of the wide one-hot form, and names in a run record
WIDE_COLUMNS = 100_000
NAMES_IN_RECORD = 10_000
#: encodings up to this length are dense vectors within a plan, longer ones sparse vectors in a table
DENSE_FEATURES = 256
MARK = "_forest_"


@dataclass(frozen=True)
class Preprocessing:
    """Learned from training rows: exact medians, most frequent categories, and a table of all categories.

    ``dictionary`` holds (column_name, value, n, place): ``place`` numbers a column's values in order, from 0. ``sizes`` are
    the numbers of categories.
    """

    spec: FeatureSpec
    medians: dict[str, float]
    modes: dict[str, str]
    dictionary: DataFrame | None = None
    sizes: dict[str, int] | None = None

    @cached_property
    def categories(self) -> dict[str, list[str]]:
        """Lists of categories, for forms that are as wide as these lists; at most ``WIDE_COLUMNS`` together."""
        lists: dict[str, list[str]] = {}
        if self.dictionary is not None:
            for r in bounded_collect(self.dictionary.select("column_name", "value"), WIDE_COLUMNS, "categories of a wide form"):
                lists.setdefault(r["column_name"], []).append(r["value"])
        return {c: sorted(vs) for c, vs in lists.items()}

    @property
    def numeric(self) -> list[str]:
        return [c for c in self.spec.numeric if self.medians.get(c) is not None]

    @property
    def categorical(self) -> list[str]:
        return [c for c in self.spec.categorical if self.modes.get(c) is not None]

    @property
    def width(self) -> int:
        """Encoded features."""
        return len(self.numeric) + sum(self.sizes[c] for c in self.categorical)

    @property
    def output_names(self) -> list[str]:
        return [*[f"numerical__{c}" for c in self.numeric],
                *[f"categorical__{c}_{v}" for c in self.categorical for v in self.categories[c]]]

    def named_features(self) -> DataFrame:
        """(position, feature) of every encoded feature, as a table."""
        spark = SparkSession.active()
        rows = [(i, f"numerical__{c}") for i, c in enumerate(self.numeric)]
        named = spark.createDataFrame(rows, "position int, feature string")
        first = len(rows)
        for c in self.categorical:
            of_column = self.dictionary.where(F.col("column_name") == c)
            named = named.unionByName(of_column.select((F.col("place") + first).cast("int").alias("position"),
                                                       F.concat(F.lit(f"categorical__{c}_"), "value").alias("feature")))
            first += self.sizes[c]
        return named

    def impute(self, df: DataFrame) -> DataFrame:
        """Missing predictors replaced by the training medians and modes."""
        fills = {**{c: self.medians[c] for c in self.numeric}, **{c: self.modes[c] for c in self.categorical}}
        return df.na.fill(fills)

    def one_hot(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """(keep..., one double column per output name): the wide, inspectable form of the encoding."""
        filled = self.impute(df)
        wide = [F.col(c).alias(f"numerical__{c}") for c in self.numeric]
        wide += [F.when(F.col(c) == v, 1.0).otherwise(0.0).alias(f"categorical__{c}_{v}")
                 for c in self.categorical for v in self.categories[c]]
        return filled.select(*keep, *wide)

    def number_names(self) -> tuple[list[str], dict[str, int]]:
        """Names of the encoded number columns, and of the category columns with the size of each dictionary."""
        return ([f"{MARK}n{i}" for i in range(len(self.numeric))],
                {f"{MARK}c{i}": self.sizes[c] for i, c in enumerate(self.categorical)})

    def numbered(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """(keep..., imputed numbers, category places); a category outside the dictionary gets the dictionary's size.

        A dictionary is broadcast when its counted size is small. Otherwise rows are joined by value, where adaptive
        execution splits a value with many rows.
        """
        numbers, places = self.number_names()
        cells = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(self.medians[c])).alias(n) for c, n in zip(self.numeric, numbers)]
        texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(self.modes[c])).alias(f"{n}_text") for c, n in zip(self.categorical, places)]
        out = df.select(*keep, *cells, *texts)
        for c, n in zip(self.categorical, places):
            side = self.dictionary.where(F.col("column_name") == c).select(F.col("value").alias(f"{n}_value"), F.col("place").cast("int").alias(n))
            side = F.broadcast(side) if self.sizes[c] <= BROADCAST_ROWS else side
            out = out.join(side, F.col(f"{n}_text") == F.col(f"{n}_value"), "left").na.fill({n: self.sizes[c]}).drop(f"{n}_text", f"{n}_value")
        return out

    def vectors(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """``numbered`` with ``_features``: numbers, then one-hot categories; an unseen category encodes to zeros."""
        numbers, places = self.number_names()
        rows = self.numbered(df, keep)
        if self.width <= DENSE_FEATURES:
            hot = [_indicator(n, size) for n, size in places.items()]
            return rows.withColumn("_features", array_to_vector(F.concat(F.array(*map(F.col, numbers)).cast("array<double>"), *hot)))
        # a table column of a vector's fields is read back as vectors
        first, at, on = len(numbers), [F.array(*[F.lit(i) for i in range(len(numbers))]).cast("array<int>")], [F.array(*map(F.col, numbers)).cast("array<double>")]
        for n, size in places.items():
            known = F.col(n) < size
            at.append(F.when(known, F.array(F.col(n) + first)).otherwise(F.array().cast("array<int>")))
            on.append(F.when(known, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>")))
            first += size
        sparse = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(self.width).alias("size"), F.concat(*at).alias("indices"), F.concat(*on).alias("values"))
        path = shared_path(df.sparkSession, "vectors")
        rows.withColumn("_features", sparse).write.parquet(path)
        return df.sparkSession.read.schema(T.StructType([*rows.schema.fields, T.StructField("_features", VectorUDT())])).parquet(path)


def _indicator(place: str, size: int) -> Column:
    """Array of ``size`` zeros with a one at the place, if it is inside."""
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.when(i == F.col(place), 1.0).otherwise(0.0))


def fit_preprocessing(train: DataFrame, spec: FeatureSpec) -> Preprocessing:
    """Exact medians (midpoint of the two middle values); most frequent category, ties to the smallest."""
    medians = {c: q[0] for c, q in column_quantiles(train, spec.numeric, [0.5]).items()} if spec.numeric else {}
    if not spec.categorical:
        return Preprocessing(spec, medians, {}, None, {})
    counted = value_counts(train, spec.categorical).where(F.col("value").isNotNull())
    ordered = with_ordinal(counted, ["column_name", "value"], "position")
    found = {r["column_name"]: r for r in bounded_collect(ordered.groupBy("column_name").agg(
        F.min_by("value", F.struct(-F.col("n"), "value")).alias("mode"), F.count(F.lit(1)).alias("size"), F.min("position").alias("first")),
        len(spec.categorical), "categorical columns")}
    first = F.coalesce(*[F.when(F.col("column_name") == c, r["first"]) for c, r in found.items()], F.lit(0))
    return Preprocessing(spec, medians, {c: r["mode"] for c, r in found.items()},
                         ordered.select("column_name", "value", "n", (F.col("position") - first).alias("place")), {c: r["size"] for c, r in found.items()})


@dataclass(frozen=True)
class ForestModel:
    """Preprocessing and forest: scores any table with the source features. The forest is in MLlib's stored form at ``path``,
    or, without a path, put there by ``write``."""

    preprocessing: Preprocessing
    path: str | None = None
    write: Callable[[str], None] | None = None

    @cached_property
    def stored_forest(self) -> str:
        """Path of MLlib's stored form, made when first asked for."""
        if self.path:
            return self.path
        path = shared_path(SparkSession.active(), "forest")
        self.write(path)
        return path

    @cached_property
    def forest(self) -> RandomForestRegressionModel:
        """MLlib's model, which the driver holds whole."""
        return RandomForestRegressionModel.load(self.stored_forest)

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``_features`` and ``prediction``, by MLlib's model."""
        return self.forest.transform(self.preprocessing.vectors(df, df.columns)).select(*df.columns, "_features", "prediction")

    def score(self, df: DataFrame, key: str) -> DataFrame:
        """(key, prediction), by tasks that read the stored forest: it may be larger than the driver's memory."""
        p = self.preprocessing
        numbers, places = p.number_names()
        scoring, layout = read_mllib(self.stored_forest, Layout(tuple(np.empty(0) for _ in numbers), tuple(places.values())))
        return predict_by(scoring, tree_sizes(scoring), p.numbered(df, [key]), [*numbers, *places], layout, [key])

    def save(self, path: str) -> None:
        """Replaces what is at ``path``."""
        p = self.preprocessing
        spark = SparkSession.active()
        forest = f"{path}/forest"
        if not self.path:
            self.write(forest)
        elif self.path != forest:
            for part in ("data", "treesMetadata"):
                spark.read.parquet(f"{self.path}/{part}").write.mode("overwrite").parquet(f"{forest}/{part}")
            spark.read.text(f"{self.path}/metadata").coalesce(1).write.mode("overwrite").text(f"{forest}/metadata")
        if p.dictionary is not None:
            p.dictionary.write.mode("overwrite").parquet(f"{path}/dictionary")
        learned = {"spec": {f.name: getattr(p.spec, f.name) for f in fields(p.spec)}, "medians": p.medians, "modes": p.modes, "sizes": p.sizes}
        spark.createDataFrame([(json.dumps(learned),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/statistics")

    @classmethod
    def load(cls, path: str) -> ForestModel:
        spark = SparkSession.active()
        learned = json.loads(spark.read.text(f"{path}/statistics").first()[0])
        spec = FeatureSpec(**{k: tuple(v) if isinstance(v, list) else v for k, v in learned["spec"].items()})
        dictionary = spark.read.parquet(f"{path}/dictionary") if learned["sizes"] else None
        return cls(Preprocessing(spec, learned["medians"], learned["modes"], dictionary, learned["sizes"]), f"{path}/forest")


@dataclass
class FitResult:
    spec: FeatureSpec
    settings: ForestSettings
    preprocessing: Preprocessing
    forest: Forest
    scored: DataFrame
    key: str
    target: str
    training_seconds: float
    prediction_seconds: float = 0.0

    @property
    def nodes(self) -> DataFrame:
        """A row for each node, unpacked when it is read."""
        return self.forest.nodes

    @cached_property
    def model(self) -> ForestModel:
        """The fitted model in the form that is saved; that is written where it is saved, or when first asked for."""
        return ForestModel(self.preprocessing, write=lambda path: write_mllib(self.forest.mllib(), self.preprocessing.width, self.settings, self.target, path))

    def metrics(self) -> DataFrame:
        """(split, n, rmse, mae, r2)."""
        return regression_metrics(self.scored, self.target, "prediction", ["split"])

    def metric_values(self) -> dict[str, float]:
        """Six metrics and two durations; computing them scores all rows."""
        start = time.perf_counter()
        rows = self.metrics().collect()
        self.prediction_seconds = time.perf_counter() - start
        out = {f"{r['split']}_{m}": r[m] for r in rows for m in METRICS}
        return {**out, "training_seconds": self.training_seconds, "prediction_seconds": self.prediction_seconds}

    def predictions(self) -> DataFrame:
        """(key, actual, predicted, residual) of the test rows."""
        return residuals(self.scored.where(F.col("split") == "test"), self.key, self.target, "prediction")

    def importance(self) -> DataFrame:
        """(feature, importance, rank) of every encoded feature in descending order, ties by name.

        A tree's share of a feature is the part of its decrease of squares that splits on the feature make; the
        importance is the mean share over trees with a split. Ranks are positions in a range-partitioned order.
        """
        gains = stored(self.forest.gains().groupBy("tree", "feature").agg(F.sum("gain").alias("gain")), "gains")
        totals = gains.groupBy(F.col("tree").alias("of_tree")).agg(F.sum("gain").alias("of_all"))
        shares = gains.join(F.broadcast(totals), F.col("tree") == F.col("of_tree")).groupBy("feature").agg(F.sum(F.col("gain") / F.col("of_all")).alias("share"))
        trees = totals.count()
        named = self.preprocessing.named_features().join(shares.withColumnRenamed("feature", "position"), "position", "left")
        weighed = named.select("feature", (F.coalesce("share", F.lit(0.0)) / max(trees, 1)).alias("importance"))
        return with_ordinal(weighed, [F.desc("importance"), F.col("feature")], "rank").select("feature", "importance", (F.col("rank") + 1).cast("int").alias("rank"))

    def metadata(self) -> dict[str, object]:
        """Description of the fitted model for its run record; names of encoded features if they are not too many."""
        p, s = self.preprocessing, self.settings
        return {
            "algorithm": "RandomForestRegressor", "feature_version": self.spec.version, "feature_view_name": self.spec.name,
            "source_features": list(self.spec.features), "numerical_features": list(self.spec.numeric),
            "categorical_features": list(self.spec.categorical), "source_feature_count": len(self.spec.features),
            "transformed_feature_count": p.width, "transformed_feature_names": p.output_names if p.width <= NAMES_IN_RECORD else [],
            "settings": s.name, "settings_description": s.description, "trees": s.trees, "depth": s.depth,
            "min_leaf": s.min_leaf, "feature_subset": s.feature_subset, "bootstrap": s.bootstrap, "seed": s.seed,
        }


def forest(settings: ForestSettings, target: str) -> RandomForestRegressor:
    """MLlib's own estimator with the same settings, for comparison; ``fit`` grows trees by ``operators.forest``."""
    return estimator(settings, target)


@dataclass
class Prepared:
    """One feature version ready for several fits: encoded once, in the shared folder."""

    preprocessing: Preprocessing
    rows: DataFrame
    key: str
    target: str

    def close(self) -> None:
        release(self.rows)


def prepare(df: DataFrame, spec: FeatureSpec, key: str, target: str, partitions: int | None = None) -> Prepared:
    """``df`` holds (key, split, target, features...). Fits do not depend on the number of partitions or their rows."""
    learned = fit_preprocessing(df.where(F.col("split") == "train"), spec)
    typed = df.withColumn(target, F.col(target).cast("double"))
    rows = learned.vectors(typed.repartition(partitions) if partitions else typed, [key, "split", target])
    return Prepared(learned, stored(rows, "encoded"), key, target)


def fit(prepared: Prepared, settings: ForestSettings) -> FitResult:
    """Fit on the train rows; ``scored`` holds all rows with their predictions."""
    if settings.depth > 30:
        raise ContractError("tree depth is limited to 30")
    start = time.perf_counter()
    p = prepared.preprocessing
    train = prepared.rows.where((F.col("split") == "train") & F.col(prepared.target).isNotNull())
    numbers, places = p.number_names()
    grown = grow(train, prepared.key, prepared.target, numbers, places, settings)
    seconds = time.perf_counter() - start
    scored = predict_by(grown.scoring(), tree_sizes(grown.pieces), prepared.rows, [*numbers, *places], grown.layout, [prepared.key, "split", prepared.target])
    return FitResult(p.spec, settings, p, grown, scored, prepared.key, prepared.target, seconds)


def save_model(model: ForestModel, path: str) -> None:
    model.save(path)


def score(path: str, features: DataFrame, key: str) -> DataFrame:
    """(key, prediction) for any table with the source features, by a stored model."""
    return ForestModel.load(path).score(features, key)
