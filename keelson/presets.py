"""Defaults whose exact value decides results.

They describe strength records (weights in pounds, heights in inches) and the standard experiment grid.
"""

from __future__ import annotations

from datetime import timedelta

from keelson.spec import CleaningRules, FeatureSpec, ForestSettings, RunSpec

NO_ANSWER = ("Decline to answer|", "Decline to answer", "", "NA", "N/A", "null", "None")

# Texts read as missing when a CSV is loaded.
CSV_NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
                   "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

COMPONENTS = ("deadlift", "candj", "snatch", "backsq")
LABEL = "total_lift"

RANGES = {
    "age": (14.0, 100.0),
    "weight": (50.0, 700.0),
    "height": (36.0, 96.0),
    "deadlift": (1.0, 1105.0),
    "candj": (1.0, 395.0),
    "snatch": (1.0, 496.0),
    "backsq": (1.0, 1069.0),
}

DERIVED = {
    "bmi": "try_divide(703 * weight, pow(height, 2))",
    "age_squared": "pow(age, 2)",
    "weight_height_ratio": "try_divide(weight, height)",
}

FEATURE_TTL = timedelta(days=3650)
TEST_FRACTION = 0.20
SEED = 42

HP1 = ForestSettings("hp1", trees=100, depth=12, min_leaf=5, feature_subset="sqrt", seed=SEED)
HP2 = ForestSettings("hp2", trees=300, depth=20, min_leaf=2, feature_subset="all", seed=SEED)

RUNS = tuple(RunSpec(f"{v}_{h}", v, h) for v in ("v1", "v2") for h in ("hp1", "hp2"))


def strength_rules(entity_key: str, source_time: str | None = "retrieved_datetime") -> CleaningRules:
    return CleaningRules(
        entity_key=entity_key, source_time=source_time, components=COMPONENTS, label=LABEL, sentinels=(1.0,),
        numeric=(entity_key, "age", "weight", "height", *COMPONENTS),
        categorical=("gender", "region", "howlong", "eat", "background", "experience", "schedule"),
        no_answer=NO_ANSWER, ranges=RANGES,
    )


def strength_features(entity_key: str, version: str) -> FeatureSpec:
    extra = tuple(DERIVED) if version == "v2" else ()
    return FeatureSpec(
        version=version, name=f"strength_features_{version}", entity_key=entity_key, event_time="event_timestamp",
        numeric=("age", "weight", "height", *extra), categorical=("gender", "region"),
        features=("age", "weight", "height", "gender", "region", *extra), leakage=(LABEL, *COMPONENTS),
        derived=DERIVED if version == "v2" else {}, parent="v1" if version == "v2" else None,
    )
