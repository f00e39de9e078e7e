"""Regression metrics, generalisation gaps, rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.spec import ContractError

METRICS = ("rmse", "mae", "r2")


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., n, rmse, mae, r2), all groups in one aggregate. A constant label gives r2 1 if hit exactly, else 0."""
    y, e = F.col(actual).cast("double"), F.col(actual).cast("double") - F.col(predicted).cast("double")
    sums = df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(e * e).alias("_mse"), F.avg(F.abs(e)).alias("mae"), F.var_pop(y).alias("_var"))
    r2 = F.when(F.col("n") < 2, F.lit(None)).when(
        F.col("_var") > 0, 1 - F.col("_mse") / F.col("_var")).otherwise(F.when(F.col("_mse") == 0, 1.0).otherwise(0.0))
    return sums.select(*by, "n", F.sqrt("_mse").alias("rmse"), "mae", r2.cast("double").alias("r2"))


def residuals(df: DataFrame, key: str, actual: str, predicted: str) -> DataFrame:
    """(key, actual, predicted, residual)."""
    return df.select(key, F.col(actual).alias("actual"), F.col(predicted).alias("predicted"),
                     (F.col(actual) - F.col(predicted)).alias("residual"))


def split_metrics(metrics: DataFrame, by: Sequence[str], split: str = "split") -> DataFrame:
    """(by..., train_rmse, ..., test_r2, rmse_gap, r2_gap) from one metrics row per split."""
    cells = [F.max(F.when(F.col(split) == s, F.col(m))).alias(f"{s}_{m}") for s in ("train", "test") for m in METRICS]
    return with_gaps(metrics.groupBy(*by).agg(*cells))


def with_gaps(df: DataFrame) -> DataFrame:
    """Generalisation gaps: test minus train RMSE, train minus test R2."""
    return df.withColumns({"rmse_gap": F.col("test_rmse") - F.col("train_rmse"), "r2_gap": F.col("train_r2") - F.col("test_r2")})


def leaderboard(metrics: DataFrame, model: str, segment: Sequence[str] = (), prefix: str = "") -> DataFrame:
    """Metrics rows with ``rank`` per segment: RMSE, then MAE, then R2 (larger first), then model name.

    One row per model and segment is ranked, so windows are as small as the list of models.
    """
    window = Window.partitionBy(*(segment or [F.lit(0)])).orderBy(
        F.asc(f"{prefix}rmse"), F.asc(f"{prefix}mae"), F.desc(f"{prefix}r2"), F.asc(model))
    return metrics.withColumn("rank", F.row_number().over(window))


def best_model(metrics: DataFrame, model: str, segment: Sequence[str] = (), prefix: str = "") -> DataFrame:
    """Rank 1 of each segment, found without a sort."""
    needed = [f"{prefix}{m}" for m in METRICS]
    missing = sorted(set(needed) - set(metrics.columns))
    if missing:
        raise ContractError(f"metrics are missing: {missing}")
    order = F.struct(F.col(needed[0]), F.col(needed[1]), (-F.col(needed[2])).alias("_r2"), F.col(model))
    rest = [c for c in metrics.columns if c not in segment]
    best = metrics.groupBy(*segment).agg(F.min_by(F.struct(*rest), order).alias("_best"))
    return best.where(F.col("_best").isNotNull()).select(*segment, "_best.*")


def require_best(metrics: DataFrame, model: str, prefix: str = "test_"):
    """The best run as one row; fails without runs."""
    found = best_model(metrics, model, prefix=prefix).collect()
    if not found:
        raise ContractError("there are no runs to choose from")
    return found[0]


def rank_within(df: DataFrame, group: str, value: str, tie: str, name: str = "rank") -> DataFrame:
    """1-based descending rank inside a small group, such as the features of one run."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(group).orderBy(F.desc(value), F.asc(tie))))
