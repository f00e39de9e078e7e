"""How filters interact: contingency tensors of their verdicts, contracted for every order of application.

Each document gets a pattern, one bit for each filter that it fails. Per part a tensor of shape 2 x 2 x 2 x 2 x 2 counts
the documents of each pattern (index 0 of an axis: passes that filter, 1: fails it), two more count those labelled good
and toxic. What a filter does at any place in any order is a contraction of such a tensor: an axis is selected by
``PASS`` (the filter was applied before and let the document through), ``FAIL`` or ``EITHER``. So documents are read once
whatever the number of orders, and only patterns with their counts, 32 for each part and label, leave the first aggregation.

Equality of texts is equality of SHA-256. A text's rows leave each task as one row per part, so a text that is a third of
all rows is not one task's work; the smallest id of each text is found over these rows.

Defined cases: a null text is empty, a null part the empty string. A row without ``doc_id`` is no copy of another row and
makes none of another; it has no labels. Rows that share an id are documents of their own and no copies of each other. A
document is good (toxic) if any of its label rows says 1. No rows give no parts, and an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTERS = "ABCDE"
PASS, FAIL, EITHER = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])
SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")


def text_failures(text: Column) -> dict[str, Column]:
    """The conditions that depend on the text alone; words are maximal runs of other than ASCII white space."""
    words = F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {"A": n < 100, "B": 100 * distinct < 80 * n, "C": 100 * capitals > 10 * F.length(text), "D": text.rlike("[#$%&*|]")}


def pattern_counts(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """``part, pattern, n, good, toxic``: documents of each pattern; bit i of the pattern is failing ``FILTERS[i]``."""
    text = F.coalesce("text", F.lit(""))
    own = sum((F.when(failed, 1 << FILTERS.index(name)).otherwise(0) for name, failed in text_failures(text).items()), F.lit(0))
    # equal rows of one id are counted here, so that further on (id, text, part) is unique
    rows = (docs.select("doc_id", F.coalesce(part, F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), own.alias("own"))
            .groupBy("doc_id", "part", "digest", "own").agg(F.count(F.lit(1)).alias("n")))
    marks = (labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("labelled"))
             .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
                  F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")).where("good OR toxic"))
    marked = rows.join(marks, rows["doc_id"] == marks["labelled"], "left").select(
        "doc_id", "part", "digest", "own", "n", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    # per text, part and label: all rows, the smallest id, and the rows of that id or of none
    groups = marked.groupBy("digest", "part", "own", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("first"), F.min_by(F.when(F.col("doc_id").isNotNull(), F.col("n")), "doc_id").alias("n_first"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_unnamed"))
    firsts = groups.groupBy(F.col("digest").alias("text_digest")).agg(F.min("first").alias("least"))
    several = groups.join(firsts, F.col("digest") == F.col("text_digest"))
    originals = F.col("n_unnamed") + F.when(F.col("first") == F.col("least"), F.col("n_first")).otherwise(0)
    both = F.array(F.struct(F.col("own").alias("pattern"), originals.alias("n")),
                   F.struct((F.col("own") + (1 << FILTERS.index("E"))).alias("pattern"), (F.col("n") - originals).alias("n")))
    counted = several.select("part", "good", "toxic", F.inline(both))
    return counted.where("n > 0").groupBy("part", "pattern").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))


def contract(tensor: np.ndarray, chosen: dict[int, np.ndarray]) -> int:
    """Documents whose verdicts fit the selector of each axis; axes without one take either verdict."""
    operands = [x for axis in range(tensor.ndim) for x in (chosen.get(axis, EITHER), [axis])]
    return int(np.einsum(tensor, list(range(tensor.ndim)), *operands, []))


def audit_part(n: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> Iterator[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for every order and step.

    The tensors have one axis for each filter. What a step removes depends on the set of filters before it only, so each
    (set, filter) is contracted once.
    """
    axes = range(n.ndim)
    totals = [contract(n, {f: FAIL}) for f in axes]
    uniques = [contract(n, {g: FAIL if g == f else PASS for g in axes}) for f in axes]
    seen: dict[tuple[frozenset[int], int], tuple[int, int, int, int]] = {}

    def step(before: frozenset[int], f: int) -> tuple[int, int, int, int]:
        if (before, f) not in seen:
            passed = dict.fromkeys(before, PASS)
            seen[before, f] = (contract(n, {**passed, f: PASS}), *(contract(t, {**passed, f: FAIL}) for t in (n, good, toxic)))
        return seen[before, f]

    orders = list(permutations(axes))
    shapley = [sum(step(frozenset(o[:o.index(f)]), f)[1] for o in orders) for f in axes]
    for order in orders:
        for k, f in enumerate(order):
            kept, removed, good_lost, toxic_lost = step(frozenset(order[:k]), f)
            yield ("".join(FILTERS[g] for g in order), k + 1, kept, removed, totals[f] - removed, uniques[f], good_lost, toxic_lost, shapley[f])


def audit_filters(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """Every order and step for every part; a part's counts, at most 32 rows, are one group."""
    def audit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        tensors = []
        for measure in ("n", "good", "toxic"):
            flat = np.zeros(1 << len(FILTERS), np.int64)
            flat[rows["pattern"].to_numpy()] = rows[measure].to_numpy()
            # bit i is axis i: the flat index has its highest bit in the first axis
            tensors.append(flat.reshape((2,) * len(FILTERS)).transpose(range(len(FILTERS) - 1, -1, -1)))
        return pd.DataFrame([(key[0], *row) for row in audit_part(*tensors)], columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return pattern_counts(docs, labels, part).groupBy("part").applyInPandas(audit, SCHEMA)
