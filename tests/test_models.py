from datetime import datetime, timedelta

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from keelson.operators import features as B
from keelson.operators import model as L
from keelson.operators import runs as X
from keelson.operators.split import split_entities
from keelson.plans import models as Q
from keelson.presets import DERIVED, HP1, HP2, RUNS, strength_features
from keelson.spec import ContractError, ForestSettings, RunSpec

V1, V2 = strength_features("k", "v1"), strength_features("k", "v2")
SETTINGS = ForestSettings("t", trees=20, depth=6, min_leaf=1)


@pytest.fixture(scope="module")
def data(spark):
    """Forty keys, a saturating target, one missing cell in each kind of column, one region only among the test rows."""
    rows = []
    for i in range(40):
        region = "Atoll" if i == 37 else ("North", "South", "Delta")[i * i % 3 if i % 4 else 2]
        age, weight, height = 18.0 + (7 * i) % 23, 110.0 + 90 * ((i * 13) % 40) / 40, 58.0 + (i * 5) % 17
        y = 250.0 + 400 * weight / (weight + 90) - 1.5 * age + (30 if region == "Delta" else 0)
        rows.append((1000 + i, datetime(2022, 9, 1) + timedelta(days=i), y, None if i == 9 else age, weight, height,
                     ("Female", "Male", "Male", "Female", "Male")[i % 5], None if i == 14 else region))
    return spark.createDataFrame(rows, "k long, event_timestamp timestamp, y double, age double, weight double, height double, gender string, region string").cache()


@pytest.fixture(scope="module")
def members(spark):
    return spark.createDataFrame([(1000 + i, "test" if i % 5 == 2 else "train") for i in range(40)], "k long, split string")


@pytest.fixture(scope="module")
def fitted(data, members):
    rows = B.model_split(data, members, V1, "y")
    return L.fit(L.prepare(rows, V1, "k", "y", partitions=4), SETTINGS)


def test_membership_and_inputs(data, members):
    rows = B.model_split(data, members, V1, "y")
    assert rows.columns == ["k", "split", "y", *V1.features]
    assert {r["split"]: r["count"] for r in rows.groupBy("split").count().collect()} == {"train": 32, "test": 8}


def test_statistics_come_from_training_rows_only(data, members, fitted):
    train = data.join(members, "k").where("split = 'train'").toPandas()
    for c in V1.numeric:
        assert fitted.preprocessing.medians[c] == train[c].median()
    assert fitted.preprocessing.modes == {c: train[c].mode()[0] for c in ("gender", "region")}
    assert fitted.preprocessing.categories == {"gender": ["Female", "Male"], "region": ["Delta", "North", "South"]}
    assert fitted.preprocessing.output_names == [
        "numerical__age", "numerical__weight", "numerical__height", "categorical__gender_Female", "categorical__gender_Male",
        "categorical__region_Delta", "categorical__region_North", "categorical__region_South"]


def test_unseen_category_encodes_to_zeros_and_is_scored(data, fitted):
    assert fitted.predictions().count() == 8
    got = fitted.model.transform(data.where("k = 1037")).first()
    assert list(got["_features"].toArray())[3:] == [0.0, 1.0, 0.0, 0.0, 0.0]
    wide = fitted.preprocessing.one_hot(data, ["k"]).where("k in (1009, 1014)").orderBy("k").collect()
    assert wide[0]["numerical__age"] == fitted.preprocessing.medians["age"]
    assert wide[1]["categorical__region_" + fitted.preprocessing.modes["region"]] == 1.0
    # the pipeline and the wide form agree
    vectors = {r["k"]: [float(v) for v in r["_features"].toArray()] for r in fitted.model.transform(data).select("k", "_features").collect()}
    for r in fitted.preprocessing.one_hot(data, ["k"]).collect():
        assert vectors[r["k"]] == list(r)[1:]


def test_metrics(fitted):
    values = fitted.metric_values()
    assert set(values) == {f"{s}_{m}" for s in ("train", "test") for m in ("rmse", "mae", "r2")} | {"training_seconds", "prediction_seconds"}
    assert values["test_rmse"] >= values["test_mae"] >= 0 and values["train_r2"] > 0.5
    test = fitted.scored.where("split = 'test'")
    for m in ("rmse", "mae", "r2"):
        assert values[f"test_{m}"] == pytest.approx(RegressionEvaluator(labelCol="y", predictionCol="prediction", metricName=m).evaluate(test))


def test_importance_and_residuals(fitted):
    imp = fitted.importance().orderBy("rank").collect()
    assert [r["rank"] for r in imp] == list(range(1, 9)) and sum(r["importance"] for r in imp) == pytest.approx(1.0)
    assert [r["importance"] for r in imp] == sorted((r["importance"] for r in imp), reverse=True)
    assert fitted.predictions().where("abs(residual - (actual - predicted)) > 1e-9").isEmpty()


@pytest.mark.parametrize("n", [1, 7])
def test_fit_repeats_under_any_input_layout(data, members, fitted, n):
    again = L.fit(L.prepare(B.model_split(data.repartition(n), members, V1, "y"), V1, "k", "y", partitions=4), SETTINGS)
    assert sorted(map(tuple, again.predictions().collect())) == sorted(map(tuple, fitted.predictions().collect()))


def test_saved_model_scores_raw_rows(data, fitted, tmp_path):
    L.save_model(fitted.model, str(tmp_path / "m"))
    got = {r["k"]: r["prediction"] for r in L.score(str(tmp_path / "m"), data, "k").collect()}
    want = {r["k"]: r["prediction"] for r in fitted.scored.collect()}
    assert got == want


def test_scores_and_stored_models_bring_no_trees_to_the_driver(data, fitted, tmp_path, monkeypatch):
    monkeypatch.setattr(type(data), "toPandas", lambda *_: 1 / 0)
    monkeypatch.setattr(L.RandomForestRegressionModel, "load", lambda *_: 1 / 0)
    prepared = L.prepare(data.withColumn("split", F.lit("train")), V1, "k", "y")
    again = L.fit(prepared, fitted.settings)
    L.save_model(again.model, str(tmp_path / "m"))
    assert L.score(str(tmp_path / "m"), data, "k").exceptAll(again.scored.select("k", "prediction")).isEmpty()


def test_literals_with_quotes(spark, members, data):
    odd = data.withColumn("region", F.when(F.col("k") % 2 == 0, F.lit("it's \\ odd")).otherwise(F.lit(None)))
    result = L.fit(L.prepare(B.model_split(odd, members, V1, "y"), V1, "k", "y", partitions=2), ForestSettings("s", 2, 2, 1))
    assert result.preprocessing.modes["region"] == "it's \\ odd" and result.predictions().count() == 8
    assert "categorical__region_it's \\ odd" in result.preprocessing.output_names


def test_settings():
    got = ForestSettings.from_mapping("hp2", {"n_estimators": 300, "max_depth": 20, "min_samples_leaf": 2, "max_features": 1.0,
                                              "bootstrap": True, "min_samples_split": 2, "criterion": "squared_error"})
    assert got == HP2 and HP1.feature_subset == "sqrt"
    with pytest.raises(ContractError, match="unsupported"):
        ForestSettings.from_mapping("x", {}, algorithm="Other")
    for option, value in (("criterion", "absolute_error"), ("min_samples_split", 9), ("max_leaf_nodes", 50)):
        with pytest.raises(ContractError, match=option):
            ForestSettings.from_mapping("x", {"n_estimators": 5, "max_depth": 3, "min_samples_leaf": 1, option: value})
    f = L.forest(HP2, "y")
    assert (f.getNumTrees(), f.getMaxDepth(), f.getMinInstancesPerNode(), f.getFeatureSubsetStrategy()) == (300, 20, 2, "all")


def test_registered_forests_have_the_declared_settings(spark, sf, monkeypatch):
    fitted, grids = {}, []
    monkeypatch.setattr(Q, "_fit", lambda spark, d, spec, settings: fitted.setdefault(settings, []).append(spec.version) or 1 / 0)
    for query in (Q.forest_predictions, Q.forest_metrics, Q.feature_importance, Q.stored_model_scores, Q.forest_bounds, Q.importance_total):
        with pytest.raises(ZeroDivisionError):
            query(spark, sf)
    assert fitted.keys() == {HP1, HP2} and sum(map(len, fitted.values())) == 6
    monkeypatch.setattr(X, "run_grid", lambda data, split, target, runs, settings, *rest: grids.append((runs, settings)) or 1 / 0)
    with pytest.raises(ZeroDivisionError):
        Q.experiment_comparison(spark, sf)
    assert grids == [(RUNS, {"hp1": HP1, "hp2": HP2})]


def test_more_categories_than_a_small_limit(spark):
    rows = spark.range(11_000).selectExpr("id AS k", "double(id % 7) AS age", "1D AS weight", "2D AS height", "concat('g', id) AS gender", "'r' AS region")
    learned = L.fit_preprocessing(rows, V1)
    assert len(learned.categories["gender"]) == 11_000 and learned.modes["gender"] == "g0"


def test_imputing_brings_no_categories_to_the_driver(spark, monkeypatch):
    rows = spark.range(2_000).selectExpr("id AS k", "double(id % 7) AS age", "1D AS weight", "2D AS height", "concat('g', if(id > 1990, 7, id)) AS gender",
                                         "if(id % 3 = 0, NULL, concat('r', id % 3)) AS region")
    monkeypatch.setattr(type(rows), "toLocalIterator", lambda *_, **__: 1 / 0)
    learned = L.fit_preprocessing(rows, V1)
    assert learned.modes == {"gender": "g7", "region": "r1"} and learned.categorical == ["gender", "region"]
    assert learned.impute(rows).where("region IS NULL").isEmpty()
    assert learned.dictionary.where("column_name = 'gender'").count() == 1991


def test_grid_registry_and_comparison(spark, data, tmp_path):
    split, _ = split_entities(data, "k", 0.2)
    sets = {"a": ForestSettings("a", 3, 3, 1), "b": ForestSettings("b", 3, 2, 1, "all")}
    grid = [RunSpec(f"{v}_{h}", v, h) for v in ("v1", "v2") for h in sets]
    datasets = {"v1": (data, V1), "v2": (B.derive(data, DERIVED), V2)}
    registry = str(tmp_path / "runs")
    found = X.run_grid(datasets, split, "y", grid, sets, "g1", registry, str(tmp_path / "art"), {"split_fingerprint": "abc"})
    assert found.count() == 4 and found.first()["tags"]["split_fingerprint"] == "abc"
    table = X.comparison(found).orderBy("rank").collect()
    assert [r["rank"] for r in table] == [1, 2, 3, 4]
    assert [r["test_rmse"] for r in table] == sorted(r["test_rmse"] for r in table)
    assert spark.read.parquet(str(tmp_path / "art/v1_a/predictions")).count() == 8
    assert X.runs_of_group(spark.read.parquet(registry), "other").count() == 0
    with pytest.raises(ContractError):
        X.run_grid(datasets, split, "y", grid[1:], sets, "g2", registry)
