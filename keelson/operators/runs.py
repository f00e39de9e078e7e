"""Experiment grid: check, run, record, compare."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.operators import metrics as M
from keelson.operators.features import model_inputs
from keelson.operators.model import FitResult, fit, prepare, save_model
from keelson.operators.split import EntitySplit
from keelson.session import bounded_collect, release
from keelson.spec import ContractError, FeatureSpec, ForestSettings, RunSpec

RUN_SCHEMA = ("run_name string, run_group string, feature_version string, settings string, started_at timestamp, "
              "artifact string, params map<string,string>, metrics map<string,double>, tags map<string,string>")


def require_grid(runs: Sequence[RunSpec], versions: Sequence[str], settings: Sequence[str]) -> None:
    """Exactly one run per (version, settings) pair, with unique names. A list check; the table form is ``grid_gaps``."""
    pairs = [(r.feature_version, r.settings) for r in runs]
    if len(set(pairs)) != len(pairs):
        raise ContractError("the experiment grid has duplicate combinations")
    wanted = {(v, s) for v in versions for s in settings}
    if set(pairs) != wanted:
        raise ContractError(f"the experiment grid is incomplete: missing {sorted(wanted - set(pairs))}, "
                            f"unexpected {sorted(set(pairs) - wanted)}")
    if len({r.run_name for r in runs}) != len(runs):
        raise ContractError("run names must be unique")


def run_record(spark: SparkSession, run: RunSpec, group: str, result: FitResult, artifact: str = "",
               tags: Mapping[str, str] | None = None) -> DataFrame:
    """One row of the run registry."""
    meta = result.metadata()
    params = {k: ", ".join(v) if isinstance(v, list) else str(v) for k, v in meta.items()}
    values = {k: float(v) for k, v in result.metric_values().items() if v is not None}
    row = (run.run_name, group, run.feature_version, run.settings, datetime.now(timezone.utc), artifact, params, values,
           {**(tags or {}), "run_group": group})
    return spark.createDataFrame([row], RUN_SCHEMA)


def run_grid(datasets: Mapping[str, tuple[DataFrame, FeatureSpec]], split: EntitySplit, target: str,
             runs: Sequence[RunSpec], settings: Mapping[str, ForestSettings], group: str, registry: str | None = None,
             artifacts: str | None = None, tags: Mapping[str, str] | None = None) -> DataFrame:
    """Fit every run of the grid on the same split, record it in the registry table, return the group's records.

    Each version is encoded and stored once for all its runs; each fit is a distributed job. A run's artifacts are written
    before its record, and both replace those of an earlier attempt: a group that was stopped midway can be run again.
    """
    require_grid(runs, sorted(datasets), sorted(settings))
    spark = next(iter(datasets.values()))[0].sparkSession
    records: list[DataFrame] = []
    for version in dict.fromkeys(r.feature_version for r in runs):
        df, spec = datasets[version]
        rows = model_inputs(split.assign(df), spec, (split.key, "split", target))
        prepared = prepare(rows, spec, split.key, target)
        try:
            for run in (r for r in runs if r.feature_version == version):
                result = fit(prepared, settings[run.settings])
                path = f"{artifacts}/{run.run_name}" if artifacts else ""
                if path:
                    save_model(result.model, f"{path}/model")
                    result.predictions().write.mode("overwrite").parquet(f"{path}/predictions")
                    result.importance().write.mode("overwrite").parquet(f"{path}/importance")
                records.append(run_record(spark, run, group, result, path, tags))
                release(result.nodes, result.scored)
                if registry:
                    write_record(records[-1], registry)
        finally:
            prepared.close()
    if not registry:
        return reduce(DataFrame.unionByName, records)
    found = runs_of_group(read_registry(spark, registry), group)
    names = sorted(r["run_name"] for r in bounded_collect(found.select("run_name"), len(runs) + 100, "runs of a group"))
    if names != sorted(r.run_name for r in runs):
        raise ContractError(f"group {group} holds the runs {names}, expected {len(runs)}")
    return found


def write_record(record: DataFrame, registry: str) -> None:
    """Puts a record into its folder, one for each group and run, instead of what an earlier attempt left there."""
    writer = record.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("run_group", "run_name").parquet(registry)


def read_registry(spark: SparkSession, registry: str) -> DataFrame:
    """All records; names that look like numbers stay texts."""
    rows = spark.read.schema(RUN_SCHEMA).parquet(registry)
    return rows.select(*[c.split()[0] for c in RUN_SCHEMA.split(", ")])


def runs_of_group(runs: DataFrame, group: str) -> DataFrame:
    return runs.where(F.col("tags")["run_group"] == group)


def comparison(runs: DataFrame) -> DataFrame:
    """Ranked comparison of run records: metrics as columns, gaps, rank by test RMSE, MAE, R2."""
    names = [f"{s}_{m}" for s in ("train", "test") for m in M.METRICS] + ["training_seconds", "prediction_seconds"]
    flat = runs.select("run_name", "feature_version", "settings", *[F.col("metrics")[n].alias(n) for n in names])
    return M.leaderboard(M.with_gaps(flat), "run_name", prefix="test_")
