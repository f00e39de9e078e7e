"""Declared data-quality rules, evaluated as (check_name, category, status, detail) rows.

All row rules of a table share one aggregate; uniqueness takes one aggregate by key. Checks on reports (manifests, runs,
splits) are conditions over one-row frames.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.operators.compare import coverage, grid_gaps, row_differences
from keelson.operators.features import compare_versions, one_row
from keelson.operators.keys import key_counts
from keelson.operators.metrics import best_model

PASSED, FAILED = "passed", "failed"


@dataclass(frozen=True)
class NotNull:
    column: str

    def violation(self) -> Column:
        return F.col(self.column).isNull()

    def label(self) -> str:
        return f"{self.column} not null"


@dataclass(frozen=True)
class InRange:
    column: str
    low: float
    high: float

    def violation(self) -> Column:
        return F.col(self.column).isNotNull() & ~F.col(self.column).between(self.low, self.high)

    def label(self) -> str:
        return f"{self.column} in range"


@dataclass(frozen=True)
class OneOf:
    column: str
    values: tuple

    def violation(self) -> Column:
        return F.col(self.column).isNull() | ~F.col(self.column).isin(list(self.values))

    def label(self) -> str:
        return f"{self.column} allowed values"


@dataclass(frozen=True)
class Holds:
    """Any row condition; a NULL result is a violation."""

    name: str
    condition: str

    def violation(self) -> Column:
        return ~F.coalesce(F.expr(self.condition), F.lit(False))

    def label(self) -> str:
        return self.name


@dataclass(frozen=True)
class RowCount:
    expected: int


@dataclass(frozen=True)
class UniqueKey:
    columns: tuple[str, ...]


def conditions(one: DataFrame, category: str, checks: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    """Check rows from a one-row frame: (name, condition, detail) each; a NULL condition fails."""
    rows = F.array(*[F.struct(F.lit(name).alias("check_name"), F.lit(category).alias("category"),
                              F.when(F.coalesce(ok, F.lit(False)), PASSED).otherwise(FAILED).alias("status"),
                              detail.cast("string").alias("detail")) for name, ok, detail in checks])
    return one.select(F.explode(rows).alias("c")).select("c.*")


def check_table(df: DataFrame, table: str, rules: Sequence) -> DataFrame:
    """Evaluate rules on one table; ``detail`` is the number of violations, or the number of rows."""
    row_rules = [r for r in rules if hasattr(r, "violation")]
    counts = [r for r in rules if isinstance(r, RowCount)]
    uniques = [r for r in rules if isinstance(r, UniqueKey)]
    parts = []
    if row_rules or counts:
        one = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(r.violation()).alias(f"v{i}") for i, r in enumerate(row_rules)])
        checks = [(f"{table}: {r.label()}", F.col(f"v{i}") == 0, F.col(f"v{i}")) for i, r in enumerate(row_rules)]
        checks += [(f"{table}: row count", F.col("n") == r.expected, F.col("n")) for r in counts]
        parts.append(conditions(one, "table", checks))
    for r in uniques:
        name = f"{table}: unique {', '.join(r.columns)}"
        parts.append(conditions(key_counts(df, r.columns), "table",
                                [(name, F.col("superseded_rows") == 0, F.col("superseded_rows"))]))
    return union_all(parts)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def tables_match(a: DataFrame, b: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Multiset equality of two tables over some columns; ``detail`` is the number of differing rows."""
    one = row_differences(a, b, columns).agg(F.count(F.lit(1)).alias("n"))
    return conditions(one, "match", [(name, F.col("n") == 0, F.col("n"))])


def accounting(one: DataFrame, name: str, total: str, removed: Sequence[str], final: str) -> DataFrame:
    """total - all removed = final, on a cleaning summary."""
    rest = reduce(lambda x, c: x - F.col(c), removed, F.col(total))
    return conditions(one, "accounting", [(name, rest == F.col(final), rest - F.col(final))])


def version_checks(old: DataFrame, new: DataFrame, added: Sequence[str], leakage: Sequence[str],
                   expected_rows: int | None = None) -> DataFrame:
    """Row counts equal (and as expected), no leakage column in either version, exactly the expected added features."""
    one = compare_versions(old, new)
    banned = F.array(*[F.lit(c) for c in leakage]).cast("array<string>")
    wanted = F.array(*[F.lit(c) for c in added]).cast("array<string>")
    leaks = F.array_union(F.array_intersect("old_features", banned), F.array_intersect("new_features", banned))
    checks = [
        ("versions: equal row counts", F.col("old_rows") == F.col("new_rows"), F.col("new_rows") - F.col("old_rows")),
        ("versions: no leakage", F.size(leaks) == 0, F.array_join(leaks, ",")),
        ("versions: expected added features", F.array_sort("added_features") == F.array_sort(wanted),
         F.array_join("added_features", ",")),
    ]
    if expected_rows is not None:
        checks.append(("versions: expected population", F.col("new_rows") == expected_rows, F.col("new_rows")))
    return conditions(one, "versions", checks)


def history_checks(counts: DataFrame, response: DataFrame) -> DataFrame:
    """Retrieval rows equal label rows (:func:`retrieval_counts`), and the online response is complete."""
    one = one_row(counts, response)
    return conditions(one, "retrieval", [
        ("history: rows equal labels", F.col("reconciled"), F.col("result_rows")),
        ("online: response complete", F.col("complete"), F.col("wrong_keys"))])


def split_checks(population: DataFrame, membership: DataFrame, key: str, test_entities: int) -> DataFrame:
    """No overlap, full coverage, no duplicates, allowed values and the exact size of the test side."""
    sizes = membership.agg(F.count_if(F.col("split") == "test").alias("test_rows"))
    one = one_row(coverage(population, membership, key), sizes)
    checks = [(f"split: no {c.replace('_', ' ')}", F.col(c) == 0, F.col(c))
              for c in ("overlapping_keys", "duplicate_keys", "uncovered_keys", "unknown_keys", "bad_values")]
    checks.append(("split: test size", F.col("test_rows") == test_entities, F.col("test_rows")))
    return conditions(one, "split", checks)


def run_checks(comparison: DataFrame, versions: DataFrame, settings: DataFrame, best_name: str, best_rmse: float,
               metrics: Sequence[str] = ("train_rmse", "train_mae", "train_r2", "test_rmse", "test_mae", "test_r2")) -> DataFrame:
    """The full grid once, all metrics present, and the stored best run equal to the recomputed one."""
    gaps = grid_gaps(comparison, versions, settings, ("feature_version", "settings")).agg(F.count(F.lit(1)).alias("gaps"))
    holes = comparison.agg(F.coalesce(F.sum(reduce(lambda a, b: a + b, [F.col(m).isNull().cast("int") for m in metrics])),
                                      F.lit(0)).alias("holes"))
    best = best_model(comparison, "run_name", prefix="test_").select(
        F.col("run_name").alias("best_run"), F.col("test_rmse").alias("best_rmse"))
    one = one_row(gaps, holes, best)
    return conditions(one, "runs", [
        ("runs: grid complete", F.col("gaps") == 0, F.col("gaps")),
        ("runs: metrics present", F.col("holes") == 0, F.col("holes")),
        ("runs: best run", (F.col("best_run") == best_name) & (F.abs(F.col("best_rmse") - best_rmse) < 1e-8),
         F.col("best_run"))])


def roll_up(checks: DataFrame) -> DataFrame:
    """One row (checks, passed, failed)."""
    return checks.agg(F.count(F.lit(1)).alias("checks"), F.count_if(F.col("status") == PASSED).alias("passed"),
                      F.count_if(F.col("status") == FAILED).alias("failed"))
