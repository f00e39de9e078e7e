"""Joins that check something: validated 1:1 joins, multiset comparison, key coverage, grid completeness."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.functions.digest import fingerprint
from keelson.operators.ranks import with_ordinal
from keelson.spec import ContractError, require_columns


def validated_left_join(left: DataFrame, right: DataFrame, key: str, check: bool = True) -> DataFrame:
    """Left join of two tables with unique keys in which every left row finds its partner.

    The checks run as one job on the key columns alone; ``check=False`` leaves them out for inputs already checked.
    """
    require_columns(left, [key], "left table")
    require_columns(right, [key], "right table")
    if check:
        state = join_state(left, right, key).first()
        if state["left_duplicate_keys"] or state["right_duplicate_keys"]:
            raise ContractError(f"duplicate keys: left {state['left_duplicate_keys']}, right {state['right_duplicate_keys']}")
        if state["unmatched_rows"]:
            raise ContractError(f"{state['unmatched_rows']} rows have no partner")
    return left.join(right, key, "left")


def join_state(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row (left_duplicate_keys, right_duplicate_keys, unmatched_rows), from one aggregate by key over both sides."""
    sides = left.select(F.col(key).alias("_k"), F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(F.col(key).alias("_k"), F.lit(0).alias("_l"), F.lit(1).alias("_r")))
    per_key = sides.groupBy("_k").agg(F.sum("_l").alias("l"), F.sum("_r").alias("r"))
    no_partner = (F.col("r") == 0) | F.col("_k").isNull()
    return per_key.agg(
        F.count_if(F.col("l") > 1).alias("left_duplicate_keys"), F.count_if(F.col("r") > 1).alias("right_duplicate_keys"),
        F.coalesce(F.sum(F.when(no_partner, F.col("l"))), F.lit(0)).alias("unmatched_rows"))


def row_differences(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(columns..., a_rows, b_rows) for every row whose multiplicity differs; NULLs are equal to each other.

    One aggregate covers both directions, and copies of a row combine before the shuffle.
    """
    sides = a.select(*columns, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(*columns, F.lit(0).alias("_a"), F.lit(1).alias("_b")))
    counts = sides.groupBy(*columns).agg(F.sum("_a").alias("a_rows"), F.sum("_b").alias("b_rows"))
    return counts.where(F.col("a_rows") != F.col("b_rows"))


def same_rows(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> bool:
    """Multiset equality by row count and fingerprint: no row is shuffled."""
    both = fingerprint(a.select(F.lit("a").alias("_side"), *columns).unionByName(
        b.select(F.lit("b").alias("_side"), *columns)), list(columns), ["_side"]).collect()
    prints = {r["_side"]: (r["row_count"], r["data_fingerprint"]) for r in both}
    return prints.get("a") == prints.get("b")


def require_alignment(a: DataFrame, b: DataFrame, columns: Sequence[str], what: str = "tables") -> None:
    require_columns(a, columns, what)
    require_columns(b, columns, what)
    if not same_rows(a, b, columns):
        raise ContractError(f"{what} do not hold identical rows over {list(columns)}")


def coverage(population: DataFrame, membership: DataFrame, key: str, split: str = "split",
             allowed: Sequence[str] = ("train", "test")) -> DataFrame:
    """One row of violation counts of a split: overlap, duplicates, uncovered and unknown keys, values not allowed."""
    base = population.select(F.col(key).alias("_k"), F.lit(1).alias("_p"), F.lit(None).cast("string").alias("_s"))
    members = membership.select(F.col(key).alias("_k"), F.lit(0).alias("_p"), F.col(split).alias("_s"))
    bad = F.col("_s").isNull() | ~F.col("_s").isin(list(allowed))
    in_split = [F.max((F.coalesce(F.col("_s"), F.lit("")) == s).cast("int")).alias(f"_in{i}") for i, s in enumerate(allowed)]
    per_key = base.unionByName(members).groupBy("_k").agg(
        F.max("_p").alias("p"), F.count_if(F.col("_p") == 0).alias("m"), *in_split,
        F.count_if((F.col("_p") == 0) & bad).alias("bad"))
    hits = reduce(lambda x, y: x + y, [F.col(f"_in{i}") for i in range(len(allowed))])
    return per_key.agg(
        F.count_if(hits > 1).alias("overlapping_keys"), F.count_if(F.col("m") > 1).alias("duplicate_keys"),
        F.count_if((F.col("p") == 1) & (F.col("m") == 0)).alias("uncovered_keys"),
        F.count_if((F.col("p") == 0) & (F.col("m") > 0)).alias("unknown_keys"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("bad_values"))


def grid_gaps(facts: DataFrame, first: DataFrame, second: DataFrame, names: Sequence[str]) -> DataFrame:
    """(first, status, first_<second>, last_<second>, n) for what differs from a full grid of two key dimensions.

    ``first`` and ``second`` are one-column frames with the keys of each dimension. Missing cells come as runs: one row for
    each unbroken stretch of second keys that a first key lacks, n being its length. Cells with several rows
    (``duplicate``) and cells outside the grid (``unexpected``) come one by one, n being their rows. So the result grows
    with the facts and the first keys, never with the grid; the second dimension's keys are numbered by range partitioning.
    """
    a, b = names
    one = first.select(F.col(first.columns[0]).alias("_a")).where(F.col("_a").isNotNull()).distinct()
    keys = second.select(F.col(second.columns[0]).alias("_b")).where(F.col("_b").isNotNull()).distinct()
    two = with_ordinal(keys, ["_b"], "_p").select("_b", (F.col("_p") + 1).cast("int").alias("_i"))
    cells = facts.select(F.col(a).alias("_a"), F.col(b).alias("_b")).groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("n"))
    placed = cells.join(two, "_b", "left").join(one.withColumn("_in", F.lit(True)), "_a", "left")
    inside = F.col("_i").isNotNull() & F.col("_in").isNotNull()
    status = F.when(~inside, F.lit("unexpected")).when(F.col("n") > 1, F.lit("duplicate"))
    single = placed.select("_a", status.alias("status"), F.col("_b").alias("_from"), F.col("_b").alias("_to"), "n").where(F.col("status").isNotNull())

    size = two.count()
    ends = one.select("_a", F.explode(F.array(F.lit(0), F.lit(size + 1))).alias("_i"))
    marks = placed.where(inside).select("_a", "_i").unionByName(ends)
    run = marks.select("_a", (F.lag("_i").over(Window.partitionBy("_a").orderBy("_i")) + 1).alias("_start"), (F.col("_i") - 1).alias("_end")).where(
        F.col("_end") >= F.col("_start"))
    named = run.join(two.select(F.col("_i").alias("_start"), F.col("_b").alias("_from")), "_start").join(
        two.select(F.col("_i").alias("_end"), F.col("_b").alias("_to")), "_end")
    gaps = named.select("_a", F.lit("missing").alias("status"), "_from", "_to", (F.col("_end") - F.col("_start") + 1).cast("bigint").alias("n"))
    return gaps.unionByName(single).select(F.col("_a").alias(a), "status", F.col("_from").alias(f"first_{b}"), F.col("_to").alias(f"last_{b}"), "n")
