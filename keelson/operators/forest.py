"""Random forest regression whose large nodes are split by distributed sums and whose small nodes are finished in one task.

A node that holds more than ``SUBTREE_ROWS`` weighted rows is split from sums of (rows, target) per node, column and bin,
which tasks combine before the shuffle: one pass over the rows for each group of nodes of a level. A node with fewer rows
is a bounded group: its rows are shuffled once, and the whole subtree below it grows in that group, however deep it is.
So the number of jobs follows the size of the data, not the depth, and no job's state follows the number of nodes.

Columns are numbers, binned at quantiles, or categories, numbered by a dictionary. A category column offers the splits
"this category or another", those of a one-hot encoding, without being expanded.

Targets are integers on a grid over their range, so sums are exact whatever the order of adding, and bootstrap weights
(Poisson) depend on key, tree and seed: equal rows, bins and settings give equal trees in any layout. Bins come from a
sketch of all rows, exact up to ``SKETCH`` rows and off by a rank in ``SKETCH`` beyond. The result is a table of nodes and,
by MLlib's own stored form, an MLlib model.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.session import bounded_collect, release, released_shuffles, shared_path, stored
from keelson.spec import ForestSettings

#: sums of so many weighted targets are exact in double precision
SUBTREE_ROWS = 1 << 19
#: (node, bin) sums that one pass over the rows may gather in a task
PASS_SUMS = 1 << 22
SKETCH = 10_000
#: a column's splits come from a table of bins with up to this many cells for each row, of which so many are looked at together
DENSE, CELLS = 3, 1 << 15
#: rows that a task puts together before it looks at each tree, and rows of a node that travel as one
ROWS_AT_ONCE, DEALT_ROWS = 1 << 17, 1 << 16
#: nodes of the trees, and bytes of rows, that one task scores at once
NODES_SENT, ROWS_SENT = 1 << 22, 1 << 26
#: bytes of bagged rows that one shuffle to subtrees may carry, more trees take further rounds; and those of one of its tasks
ROUND_BYTES, TASK_BYTES = 1 << 32, 1 << 26
LEAF, LINK, NEVER = -1, -2, 1 << 40
NODE_SCHEMA = "tree int, node long, n double, prediction double, squares double, gain double, feature int, threshold double"
PIECE_SCHEMA = "tree int, root long, size int, split_column binary, split_bin binary, n binary, total binary, squares binary"
PIECE_FIELDS = [f.split()[0] for f in PIECE_SCHEMA.split(", ")]
SCORING_SCHEMA = "tree int, root long, size int, split_column binary, split_bin binary, value binary"
SCORING_SCHEMA_FIELDS = [f.split()[0] for f in SCORING_SCHEMA.split(", ")]
#: a tree's rows, as MLlib stores them, on their way to one task; and how many of them leave one at once
STORED_SCHEMA = "tree int, size int, id binary, left binary, apart binary, split_column binary, split_bin binary, value binary"
SENT_NODES = 10_000
SUMS_SCHEMA = "tree int, node long, cell binary, n binary, total binary"
SPLIT_SCHEMA = "tree int, node long, split_column int, split_bin int, n long, total long, n_right long, total_right long"
DEALT_SCHEMA = "tree int, node long, weight binary, target binary, x binary"
MODEL_SCHEMA = ("treeID int, nodeData struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,gain:double,"
                "leftChild:int,rightChild:int,split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>")


@dataclass(frozen=True)
class Layout:
    """Bins of each column, numbers first. A number's bins end at ``edges``; a category's bins are its numbers, the last
    one for values outside the dictionary. ``first`` is the position of a column's first feature in the one-hot encoding."""

    edges: tuple[np.ndarray, ...]
    categories: tuple[int, ...]

    @property
    def bins(self) -> np.ndarray:
        return np.array([*[len(e) + 1 for e in self.edges], *[n + 1 for n in self.categories]], np.int64)

    @property
    def is_category(self) -> np.ndarray:
        return np.arange(len(self.bins)) >= len(self.edges)

    @property
    def first(self) -> np.ndarray:
        return np.cumsum([0, *[1] * len(self.edges), *self.categories])[:-1]

    @property
    def features(self) -> int:
        return len(self.edges) + sum(self.categories)


def subset_size(strategy: str, features: int) -> int:
    """Features that a node may split on."""
    if strategy in ("all", "sqrt", "log2", "onethird"):
        return max(1, {"all": features, "sqrt": math.ceil(math.sqrt(features)), "log2": math.ceil(math.log2(max(features, 2))),
                       "onethird": math.ceil(features / 3)}[strategy])
    return max(1, min(features, math.ceil(float(strategy) * features) if float(strategy) <= 1 else int(float(strategy))))


def allowed_features(tree: int, nodes: np.ndarray, features: int, settings: ForestSettings) -> np.ndarray | None:
    """Sorted keys (position of the node * features + feature) of a random subset for each node; None for all features."""
    k = subset_size(settings.feature_subset, features)
    if k >= features:
        return None
    drawn = [np.random.default_rng([settings.seed, tree, int(node)]).choice(features, k, replace=False) for node in nodes]
    return np.sort((np.arange(len(nodes))[:, None] * features + np.array(drawn).reshape(len(nodes), k)).ravel())


def best_splits(column: int, node: np.ndarray, slot: np.ndarray, n: np.ndarray, total: np.ndarray, node_n: np.ndarray, node_total: np.ndarray,
                allowed: np.ndarray | None, layout: Layout, min_leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """(gain, bin) of the best split of every node on one column; gain 0 without one.

    ``node, slot, n, total`` are the non-empty bins of the column, ordered by node and bin, every node among them.
    """
    starts = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
    lengths = np.diff(np.append(starts, len(node)))
    if layout.is_category[column]:
        side_n, side_total = n, total
    else:
        sums = np.cumsum(n), np.cumsum(total)
        side_n, side_total = (s - np.repeat((s - own)[starts], lengths) for s, own in zip(sums, (n, total)))
    rest = node_n[node] - side_n
    fits = (side_n >= min_leaf) & (rest >= min_leaf)
    if layout.is_category[column]:
        fits &= slot < layout.bins[column] - 1
    if allowed is not None:
        feature = node * layout.features + layout.first[column] + (slot if layout.is_category[column] else 0)
        fits &= allowed[np.minimum(np.searchsorted(allowed, feature), len(allowed) - 1)] == feature
    away = side_total - side_n * (node_total / node_n)[node]
    gain = np.where(fits, away * away * node_n[node] / np.maximum(side_n * rest, 1), 0.0)
    most = np.maximum.reduceat(gain, starts)
    at = np.flatnonzero(gain == np.repeat(most, lengths))
    return most, slot[at[np.append(True, node[at[1:]] != node[at[:-1]])]]


class Level:
    """Nodes of a level that may be divided, and their rows in the order of the nodes."""

    def __init__(self, sizes: np.ndarray, weight: np.ndarray, weighted: np.ndarray, n: np.ndarray, total: np.ndarray, allowed: np.ndarray | None,
                 layout: Layout, min_leaf: int) -> None:
        self.node, self.weight, self.weighted = np.repeat(np.arange(len(sizes)), sizes), weight, weighted
        self.n, self.total, self.mean = n, total, total / n
        self.layout, self.min_leaf = layout, min_leaf
        self.allowed = None if allowed is None else np.divmod(allowed, layout.features)

    def best(self, column: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(gain, bin) as ``best_splits`` gives them: by tables of bins where nodes have many rows, else by sorting."""
        bins, k = int(self.layout.bins[column]), len(self.n)
        free, some = None, None
        if self.allowed is not None:
            first = int(self.layout.first[column])
            own = (self.allowed[1] >= first) & (self.allowed[1] < first + (bins - 1 if self.layout.is_category[column] else 1))
            at, feature = self.allowed[0][own], self.allowed[1][own] - first
            some = np.zeros(k, bool)
            some[at] = True
            if not some.any():
                return np.zeros(k), np.zeros(k, np.int64)
            free = at, feature
            if not some.all():
                rows, place = some[self.node], np.cumsum(some) - 1
                part = Level.__new__(Level)
                part.node, part.weight, part.weighted = place[self.node[rows]], self.weight[rows], self.weighted[rows]
                part.n, part.total, part.mean, part.layout, part.min_leaf = self.n[some], self.total[some], self.mean[some], self.layout, self.min_leaf
                most, slot = np.zeros(k), np.zeros(k, np.int64)
                most[some], slot[some] = part._best(column, x[rows], (place[at], feature))
                return most, slot
        return self._best(column, x, free)

    def _best(self, column: int, x: np.ndarray, free: tuple[np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
        category, bins = bool(self.layout.is_category[column]), int(self.layout.bins[column])
        return (self._by_table if len(self.n) * bins <= DENSE * len(x) else self._by_sorting)(category, bins, x, free)

    def _by_table(self, category: bool, bins: int, x: np.ndarray, free: tuple[np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
        k = len(self.n)
        most, slot, step = np.zeros(k), np.zeros(k, np.int64), max(1, CELLS // bins)
        cuts = np.searchsorted(self.node, np.arange(0, k + step, step))
        if category and free:
            table = np.zeros((k, bins), bool)
            table[free] = True
        for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            low, high = i * step, min(k, (i + 1) * step)
            key = (self.node[a:b] - low) * bins
            key += x[a:b]
            side_n, gain = (np.bincount(key, v[a:b], (high - low) * bins).reshape(-1, bins) for v in (self.weight, self.weighted))
            if not category:
                np.cumsum(side_n, axis=1, out=side_n)
                np.cumsum(gain, axis=1, out=gain)
            n = self.n[low:high, None]
            rest = n - side_n
            fits = (side_n >= self.min_leaf) & (rest >= self.min_leaf)
            if category:
                fits[:, -1] = False
                if free:
                    fits &= table[low:high]
            rest *= side_n
            np.maximum(rest, 1, out=rest)
            side_n *= self.mean[low:high, None]
            gain -= side_n
            gain *= gain
            gain *= n
            gain /= rest
            gain *= fits
            best = np.argmax(gain, axis=1)
            slot[low:high], most[low:high] = best, gain[np.arange(high - low), best]
        return most, slot

    def _by_sorting(self, category: bool, bins: int, x: np.ndarray, free: tuple[np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
        of_bin, of_row = bins.bit_length(), len(x).bit_length()
        key = self.node << of_bin
        key |= x
        if len(self.n).bit_length() + of_bin + of_row < 63:
            key <<= of_row
            key |= np.arange(len(x))
            key.sort()
            order = key & ((1 << of_row) - 1)
            key >>= of_row
        else:
            order = np.argsort(key, kind="stable")
            key = key[order]
        ends = np.append(np.flatnonzero(key[1:] != key[:-1]), len(key) - 1)
        key = key[ends]
        node, slot = key >> of_bin, key & ((1 << of_bin) - 1)
        starts = np.append(0, np.flatnonzero(node[1:] != node[:-1]) + 1)
        side_n, gain = (np.cumsum(v[order])[ends] for v in (self.weight, self.weighted))
        if category:
            side_n, gain = (np.diff(v, prepend=0.0) for v in (side_n, gain))
        else:
            side_n -= (np.cumsum(self.n) - self.n)[node]
            gain -= (np.cumsum(self.total) - self.total)[node]
        n = self.n[node]
        rest = n - side_n
        fits = (side_n >= self.min_leaf) & (rest >= self.min_leaf)
        if category:
            fits &= slot < bins - 1
            if free:
                fits &= np.isin(key, free[0] << of_bin | free[1])
        rest *= side_n
        np.maximum(rest, 1, out=rest)
        side_n *= self.mean[node]
        gain -= side_n
        gain *= gain
        gain *= n
        gain /= rest
        gain *= fits
        most = np.maximum.reduceat(gain, starts)
        at = np.flatnonzero(gain == most[node])
        own = node[at]
        return most, slot[at[np.append(True, own[1:] != own[:-1])]]


def choose(tree: int, ids: np.ndarray, node_n: np.ndarray, node_total: np.ndarray, sums: Iterator[tuple], layout: Layout,
           settings: ForestSettings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(column, bin, gain) of each node's best split over all columns; column -1 without one. Ties go to the first."""
    allowed = allowed_features(tree, ids, layout.features, settings)
    column, slot, gain = np.full(len(ids), -1), np.full(len(ids), -1), np.zeros(len(ids))
    for j, node, bins, n, total in sums:
        found, at = best_splits(j, node, bins, n, total, node_n, node_total, allowed, layout, settings.min_leaf)
        better = found > np.maximum(gain, node_n)  # a decrease of less than a grid step is rounding
        column[better], slot[better], gain[better] = j, at[better], found[better]
    return column, slot, gain


def grow_subtree(tree: int, root: int, x: np.ndarray, weight: np.ndarray, target: np.ndarray, layout: Layout, settings: ForestSettings) -> Piece:
    """The subtree below ``root``; ``x`` has a row for each column. Rows are kept in the order of their nodes, and those of a
    node that cannot be divided (too few, or of one target) are dropped before any column is looked at."""
    weighted, ids, sizes, out = weight * target, np.array([root], np.int64), np.array([len(weight)]), []
    columns, x = list(range(len(x))), list(x)
    if subset_size(settings.feature_subset, layout.features) >= layout.features:
        # ties go to the first column, so one with the bins of an earlier one in all rows is never chosen
        columns = [j for j in columns if not any(layout.is_category[i] == layout.is_category[j] and np.array_equal(x[i], x[j]) for i in range(j))]
        x = [x[j] for j in columns]
    while len(ids):
        starts = np.cumsum(sizes) - sizes
        n, total, squares = (np.add.reduceat(v, starts) for v in (weight, weighted, weighted * target))
        column, slot = np.full(len(ids), -1), np.zeros(len(ids), np.int64)
        may = np.zeros(len(ids), bool)
        if int(ids[0]).bit_length() <= settings.depth:
            may = (n >= 2 * settings.min_leaf) & (np.minimum.reduceat(target, starts) < np.maximum.reduceat(target, starts))
        if may.any():
            if not may.all():
                rows = np.flatnonzero(np.repeat(may, sizes))
                x, weight, weighted, target, sizes = [v[rows] for v in x], weight[rows], weighted[rows], target[rows], sizes[may]
            level = Level(sizes, weight, weighted, n[may], total[may], allowed_features(tree, ids[may], layout.features, settings), layout, settings.min_leaf)
            chosen, chosen_slot, most = np.full(len(sizes), -1), np.zeros(len(sizes), np.int64), level.n.copy()  # a decrease of less than a grid step is rounding
            for j, values in zip(columns, x):
                found, at = level.best(j, values)
                better = found > most
                chosen[better], chosen_slot[better], most[better] = j, at[better], found[better]
            column[may], slot[may] = chosen, chosen_slot
            inner, right = chosen >= 0, np.zeros(len(weight), bool)
            of_node = chosen[level.node]
            for j, values in zip(columns, x):
                rows = np.flatnonzero(of_node == j)
                value, limit = values[rows], chosen_slot[level.node[rows]]
                right[rows] = value == limit if layout.is_category[j] else value > limit
            rows = np.flatnonzero(of_node >= 0)
            child = 2 * (np.cumsum(inner) - 1)[level.node[rows]] + right[rows]
            of_row = len(rows).bit_length()
            rows = rows[np.sort(child << of_row | np.arange(len(rows))) & ((1 << of_row) - 1)]
            x, weight, weighted, target = [v[rows] for v in x], weight[rows], weighted[rows], target[rows]
            sizes = np.bincount(child, minlength=2 * int(inner.sum()))
        inner = column >= 0
        out.append((column, slot[inner], n[~inner], total[~inner], squares[~inner]))
        ids = (2 * ids[inner][:, None] + np.array([0, 1])).ravel()
    return Piece(tree, root, *(np.concatenate(c) for c in zip(*out)))


def narrow(values: np.ndarray) -> np.ndarray:
    """Non-negative integers in the fewest bytes."""
    top = int(values.max(initial=0))
    return values.astype(next(k for k in ("<u1", "<u2", "<u4", "<u8") if top <= np.iinfo(k).max))


def widened(data: bytes, count: int) -> np.ndarray:
    """``count`` integers that ``narrow`` has packed."""
    return np.frombuffer(data, f"<u{len(data) // count}").astype(np.int64) if count else np.empty(0, np.int64)


def children(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of the divided nodes, places of their first children) among nodes listed level by level."""
    inner = np.flatnonzero(column >= 0)
    return inner, 1 + 2 * np.arange(len(inner))


def levels(column: np.ndarray) -> list[tuple[int, int]]:
    """(first divided node, one past the last) of each level, counted among the divided ones."""
    divided, start, end, out = np.append(0, np.cumsum(column >= 0)), 0, 1, []
    while start < end:
        out.append((int(divided[start]), int(divided[end])))
        start, end = end, 1 + 2 * int(divided[end])
    return out


def node_ids(root: int, column: np.ndarray) -> np.ndarray:
    """Numbers of the nodes in the tree: 1 for its root, 2i and 2i + 1 for children."""
    out, (inner, child) = np.full(len(column), root, np.int64), children(column)
    for a, b in levels(column):
        for side in (0, 1):
            out[child[a:b] + side] = 2 * out[inner[a:b]] + side
    return out


@dataclass(frozen=True)
class Piece:
    """Part of a tree from ``root`` down, its nodes level by level: so a divided node's children follow from its place.

    ``column`` of every node: the one it is divided by, ``LEAF``, or ``LINK`` where another piece goes on. ``slot`` (bin) is
    there for divided nodes, ``n, total, squares`` for the others; those of divided nodes and gains are sums of what is below.
    """

    tree: int
    root: int
    column: np.ndarray
    slot: np.ndarray
    n: np.ndarray
    total: np.ndarray
    squares: np.ndarray

    def packed(self) -> tuple:
        """A row of ``PIECE_SCHEMA``."""
        return (self.tree, self.root, len(self.column), narrow(self.column + 2).tobytes(), narrow(self.slot).tobytes(), narrow(self.n.astype(np.int64)).tobytes(),
                self.total.astype("<f8").tobytes(), self.squares.astype("<f8").tobytes())

    @classmethod
    def of(cls, tree: int, root: int, size: int, column: bytes, slot: bytes, n: bytes, total: bytes, squares: bytes) -> Piece:
        columns = widened(column, size) - 2
        inner = int((columns >= 0).sum())
        return cls(tree, root, columns, widened(slot, inner), widened(n, size - inner).astype(float), np.frombuffer(total), np.frombuffer(squares))

    def ids(self) -> np.ndarray:
        return node_ids(self.root, self.column)

    def sums(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``n, total, squares`` of all nodes."""
        inner, child = children(self.column)
        out = []
        for leaves in (self.n, self.total, self.squares):
            whole = np.empty(len(self.column))
            whole[self.column < 0] = leaves
            for a, b in reversed(levels(self.column)):
                whole[inner[a:b]] = whole[child[a:b]] + whole[child[a:b] + 1]
            out.append(whole)
        return tuple(out)

    def gains(self, n: np.ndarray, total: np.ndarray, layout: Layout) -> np.ndarray:
        """Decrease of the sum of squares by each divided node's split."""
        inner, child = children(self.column)
        side = child + layout.is_category[self.column[inner]]
        away = total[side] - n[side] * (total[inner] / n[inner])
        return away * away * n[inner] / np.maximum(n[side] * (n[inner] - n[side]), 1)

    def features(self, layout: Layout) -> tuple[np.ndarray, np.ndarray]:
        """(position in the one-hot encoding, threshold) of each divided node's split."""
        column = self.column[self.column >= 0]
        threshold = np.full(len(column), 0.5)
        for j, edges in enumerate(layout.edges):
            threshold[column == j] = edges[self.slot[column == j]]
        return layout.first[column] + np.where(layout.is_category[column], self.slot, 0), threshold


def pieces_of(batch: pa.RecordBatch | pa.Table) -> Iterator[Piece]:
    for row in zip(*(batch.column(c).to_pylist() for c in PIECE_FIELDS), strict=True):
        yield Piece.of(*row)


def rows_batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def node_tests(column: np.ndarray, slot: np.ndarray, is_category: np.ndarray) -> np.ndarray:
    """A number for each node: the least bin that passes, the column, and whether greater ones pass too. Nothing passes a
    node that is not divided. ``slot`` of divided nodes only."""
    inner = column >= 0
    out, at = np.full(len(column), NEVER << 16), column[inner]
    number = ~is_category[at]
    out[inner] = (slot + number) << 16 | at << 1 | number
    return out


class Descent:
    """Nodes of a tree, or of several, as arrays: their tests, and the place of the first child. One without children is its
    own child."""

    def __init__(self, test: np.ndarray, child: np.ndarray) -> None:
        self.test, self.child = test, child

    def leaves(self, x: np.ndarray, root: int) -> np.ndarray:
        """The undivided node that each row of ``x`` (bins, a column for each column) comes to from ``root``."""
        at, out, rows = np.full(len(x), root), np.full(len(x), root), np.arange(len(x))
        flat, start = x.ravel(), np.arange(len(x)) * x.shape[1]
        while len(at):
            for _ in range(4):
                test = self.test.take(at)
                beyond = flat.take(start + (test >> 1 & 0x7FFF)) - (test >> 16)
                # negative differences are the greatest of all without a sign
                at = self.child.take(at) + (beyond.view(np.uint64) <= ((test & 1) << 41).view(np.uint64))
            out[rows] = at
            going = np.flatnonzero(self.child.take(at) != at)
            at, rows, start = at[going], rows[going], start[going]
        return out


def bag(key: np.ndarray, tree: int, settings: ForestSettings) -> np.ndarray:
    """Bootstrap weights: Poisson of mean 1 by inverting its distribution at a hash of key, tree and seed."""
    if not settings.bootstrap:
        return np.ones(len(key), np.uint8)
    with np.errstate(over="ignore"):
        h = key.view(np.uint64) ^ (np.uint64(settings.seed * 1_000_003 + tree + 1) * np.uint64(0x9E3779B97F4A7C15))
        for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
            h = (h ^ (h >> np.uint64(29))) * np.uint64(factor)
        h ^= h >> np.uint64(32)
    steps = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(20)])
    return np.searchsorted(steps, (h >> np.uint64(11)) * 2.0**-53, side="right").astype(np.uint8)


@dataclass(frozen=True)
class Training:
    """Binned rows: ``key_hash, target`` (integer on the grid) and ``x0..``, in the shared folder; ``n`` of them."""

    rows: DataFrame
    layout: Layout
    low: float
    step: float
    n: int


def bin_rows(rows: DataFrame, key: str, target: str, numeric: list[str], categorical: dict[str, int], settings: ForestSettings) -> Training:
    """``categorical`` maps a column of category numbers to the size of its dictionary."""
    probs = [i / settings.max_bins for i in range(1, settings.max_bins)]
    sketches = [F.percentile_approx(c, probs, SKETCH).alias(f"q{i}") for i, c in enumerate(numeric)]
    low, high, n, *found = rows.agg(F.min(target), F.max(target), F.count(F.lit(1)), *sketches).first()
    edges = tuple(np.unique(np.array(q or [], float)) for q in found)
    bits = min(34, 60 - int(8 * max(n, 1)).bit_length())
    low, step = (float(low), (float(high) - float(low)) / 2**bits or 1.0) if n else (0.0, 1.0)
    names = [*numeric, *categorical]
    x = [f"x{i}" for i in range(len(names))]

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [np.searchsorted(edges[i], batch.column(2 + i).to_numpy(zero_copy_only=False), side="left") if i < len(edges)
                       else batch.column(2 + i).to_numpy(zero_copy_only=False) for i in range(len(names))]
            y = np.rint((batch.column(1).to_numpy(zero_copy_only=False) - low) / step).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(y), *[pa.array(c.astype(np.int32)) for c in columns]], names=["key_hash", "target", *x])

    chosen = rows.select(F.xxhash64(key).alias("key_hash"), F.col(target).cast("double").alias("target"), *names)
    schema = ", ".join(["key_hash long", "target long", *[f"{c} int" for c in x]])
    return Training(stored(chosen.mapInArrow(binned, schema), "binned"), Layout(edges, tuple(categorical.values())), low, step, n)


class Grown:
    """Splits of the large nodes, by tree; bounded by the number of rows over ``SUBTREE_ROWS``, and by 2**depth."""

    def __init__(self) -> None:
        self.splits: dict[int, dict[int, tuple[int, int]]] = {}

    def descents(self, wanted: dict[int, np.ndarray], layout: Layout) -> dict[int, tuple[Descent, np.ndarray]]:
        """For each tree the way to its undivided nodes, and the place of each of them in ``wanted``, -1 for others."""
        out = {}
        for tree, ids in wanted.items():
            made = self.splits.get(tree, {})
            nodes = np.unique(np.array([1, *made, *(2 * i for i in made), *(2 * i + 1 for i in made)], np.int64))
            column, slot = np.array([made.get(i, (-1, 0)) for i in nodes.tolist()], np.int64).T
            child = np.where(column >= 0, np.searchsorted(nodes, 2 * nodes), np.arange(len(nodes)))
            at = np.minimum(np.searchsorted(ids, nodes), len(ids) - 1)
            out[tree] = Descent(node_tests(column, slot[column >= 0], layout.is_category), child), np.where(ids[at] == nodes, at, -1)
        return out


def narrow_kind(layout: Layout) -> str:
    top = int(layout.bins.max(initial=1)) - 1
    return next(k for k in ("<u1", "<u2", "<u4") if top <= np.iinfo(k).max)


def _matrices(batches: Iterator[pa.RecordBatch], layout: Layout) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(key hashes, targets, bins with a row for each row) of about ``ROWS_AT_ONCE`` rows at a time."""
    kind, held = narrow_kind(layout), []

    def joined() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return tuple(np.concatenate(c) for c in zip(*held))

    for batch in batches:
        x = np.empty((batch.num_rows, len(layout.bins)), kind)
        for j in range(len(layout.bins)):
            x[:, j] = batch.column(2 + j).to_numpy()
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy(), x))
        if sum(len(h[0]) for h in held) >= ROWS_AT_ONCE:
            yield joined()
            held = []
    if held:
        yield joined()


def _bagged(key: np.ndarray, x: np.ndarray, tree: int, way: tuple[Descent, np.ndarray], settings: ForestSettings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, their weights, place of their node) of the rows that a tree has drawn and that are in a wanted node, by node."""
    weight = bag(key, tree, settings)
    rows = np.flatnonzero(weight)
    descent, place = way
    if len(descent.child) > 1:
        at = place[descent.leaves(x[rows], 0)]
        keep = np.flatnonzero(at >= 0)
        rows, at = rows[keep], at[keep]
        order = np.argsort(at.astype(np.uint16) if len(place) < 1 << 16 else at, kind="stable")
        return rows[order], weight[rows[order]], at[order]
    return (rows, weight[rows], np.zeros(len(rows), np.int64)) if place[0] >= 0 else (rows[:0], weight[:0], rows[:0])


def level_sums(data: Training, grown: Grown, nodes: list[tuple[int, int]], settings: ForestSettings) -> DataFrame:
    """``tree, node, cell, n, total`` of the given nodes: a packed row for each node and task. Cells number the bins of all columns."""
    wanted: dict[int, list[int]] = {}
    for tree, node in sorted(nodes):
        wanted.setdefault(tree, []).append(node)
    ids = {t: np.array(i, np.int64) for t, i in wanted.items()}
    layout = data.layout
    ways, cells = grown.descents(ids, layout), int(layout.bins.sum())
    first = np.cumsum(layout.bins) - layout.bins
    dense = cells * len(nodes) <= PASS_SUMS

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {t: (np.zeros(len(i) * cells, np.int64), np.zeros(len(i) * cells, np.int64)) for t, i in ids.items()} if dense else {}
        for key, target, x in _matrices(batches, layout):
            for tree in ids:
                rows, weight, at = _bagged(key, x, tree, ways[tree], settings)
                weighted = weight * target[rows]
                if dense:
                    for j in range(len(layout.bins)):
                        place = at * int(layout.bins[j]) + x[rows, j]
                        for into, values in zip(held[tree], (weight, weighted)):
                            # sums of a block of rows are exact in double precision
                            into.reshape(-1, cells)[:, first[j]:first[j] + layout.bins[j]] += np.bincount(place, values, len(ids[tree]) * int(layout.bins[j])).astype(np.int64).reshape(len(ids[tree]), -1)
                    continue
                parts = [held[tree]] if tree in held else []
                parts += [(at * cells + first[j] + x[rows, j], weight.astype(np.int64), weighted) for j in range(len(layout.bins))]
                held[tree] = summed(*(np.concatenate(c) for c in zip(*parts)))
        for tree, found in held.items():
            place, n, total = (np.arange(len(found[0])), *found) if dense else found
            some = np.flatnonzero(n)
            node, cell = np.divmod(place[some], cells)
            starts = np.flatnonzero(np.append(True, node[1:] != node[:-1])) if len(node) else []
            yield rows_batch([(tree, int(ids[tree][node[a]]), *(v[a:b].tobytes() for v in (cell, n[some], total[some])))
                              for a, b in zip(starts, [*starts[1:], len(node)])], SUMS_SCHEMA)

    return data.rows.mapInArrow(sums, SUMS_SCHEMA)


def summed(cell: np.ndarray, n: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One row for each cell, in order."""
    order = np.argsort(cell, kind="stable")
    cell = cell[order]
    starts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if len(cell) else np.empty(0, np.int64)
    return cell[starts], *(np.add.reduceat(v[order], starts) if len(cell) else v for v in (n, total))


def split_large(data: Training, grown: Grown, nodes: list[tuple[int, int]], settings: ForestSettings) -> list[tuple]:
    """(tree, node, column, bin, n, total, and n and total of the rows to the right) of the given nodes; column -1 without a split."""
    layout = data.layout
    first = np.cumsum(layout.bins) - layout.bins

    def decide(key: tuple, parts: pa.Table) -> pa.Table:
        tree, node = key[0].as_py(), key[1].as_py()
        cell, n, total = summed(*(np.frombuffer(b"".join(parts.column(c).to_pylist()), np.int64) for c in ("cell", "n", "total")))
        cuts = np.append(np.searchsorted(cell, first), len(cell))
        own_n, own_total = (int(v[:cuts[1]].sum()) for v in (n, total))

        def sums() -> Iterator[tuple]:
            for j, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                yield j, np.zeros(b - a, np.int64), cell[a:b] - first[j], n[a:b].astype(float), total[a:b].astype(float)

        column, slot = -1, -1
        if node.bit_length() <= settings.depth:
            column, slot, _ = (v[0].item() for v in choose(tree, np.array([node]), np.array([own_n], float), np.array([own_total], float), sums(), layout, settings))
        right = [0, 0]
        if column >= 0:
            a, b = cuts[column], cuts[column + 1]
            bins = cell[a:b] - first[column]
            there = bins == slot if layout.is_category[column] else bins > slot
            right = [int(v[a:b][there].sum()) for v in (n, total)]
        return pa.Table.from_batches([rows_batch([(tree, node, column, slot, own_n, own_total, *right)], SPLIT_SCHEMA)])

    found = level_sums(data, grown, nodes, settings).groupBy("tree", "node").applyInArrow(decide, SPLIT_SCHEMA)
    return [tuple(r) for r in bounded_collect(found, len(nodes), "nodes of a pass")]


def grow_large(data: Training, settings: ForestSettings, subtree_rows: int) -> tuple[Grown, list[Piece], dict[int, set[int]]]:
    """(splits, tops of trees, small nodes of each tree) once no undivided node holds more than ``subtree_rows``."""
    grown, sums = Grown(), {}
    small: dict[int, set[int]] = {t: {1} if data.n <= subtree_rows else set() for t in range(settings.trees)}
    level = [] if data.n <= subtree_rows else [(t, 1) for t in range(settings.trees)]
    size = max(1, PASS_SUMS // max(1, int(data.layout.bins.sum())))
    while level:
        below = []
        for i in range(0, len(level), size):
            for tree, node, column, slot, n, total, right_n, right_total in split_large(data, grown, level[i:i + size], settings):
                sums[tree, node] = n, total
                if column >= 0:
                    grown.splits.setdefault(tree, {})[node] = (column, slot)
                    for child, rows, own in ((2 * node, n - right_n, total - right_total), (2 * node + 1, right_n, right_total)):
                        sums[tree, child] = rows, own
                        (below.append((tree, child)) if rows > subtree_rows else small[tree].add(child))
        level = sorted(below)
    tops = []
    for tree in range(settings.trees if sums else 0):
        made, ids = grown.splits.get(tree, {}), [1] if (tree, 1) in sums else []
        for node in ids:  # level by level
            ids += [2 * node, 2 * node + 1] if node in made else []
        if not ids:
            continue
        undivided = [i for i in ids if i not in made]
        column = [made[i][0] if i in made else LINK if i in small[tree] else LEAF for i in ids]
        tops.append(Piece(tree, 1, np.array(column), np.array([made[i][1] for i in ids if i in made], np.int64),
                          *(np.array([sums[tree, i][k] for i in undivided], float) for k in (0, 1)), np.full(len(undivided), np.nan)))
    return grown, tops, small


def grow_small(data: Training, grown: Grown, small: dict[int, set[int]], settings: ForestSettings) -> DataFrame:
    """Pieces below the given nodes: bagged rows travel once, packed, to their node's group."""
    layout = data.layout
    wanted = {t: np.array(sorted(ids), np.int64) for t, ids in small.items() if ids}
    ways, kind = grown.descents(wanted, layout), narrow_kind(layout)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, target, x in _matrices(batches, layout):
            for tree, ids in wanted.items():
                rows, weight, at = _bagged(key, x, tree, ways[tree], settings)
                starts = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else []
                cuts = [(a, b) for start, end in zip(starts, [*starts[1:], len(at)]) for a in range(start, end, DEALT_ROWS) for b in [min(end, a + DEALT_ROWS)]]
                target_, x_ = target[rows], x[rows]
                yield rows_batch([(tree, int(ids[at[a]]), weight[a:b].tobytes(), target_[a:b].tobytes(), x_[a:b].tobytes()) for a, b in cuts], DEALT_SCHEMA)

    def grow(key: tuple, rows: pa.Table) -> pa.Table:
        weight, target = (np.frombuffer(b"".join(rows.column(c).to_pylist()), t).astype(float) for c, t in (("weight", "u1"), ("target", "<i8")))
        x = np.ascontiguousarray(np.frombuffer(b"".join(rows.column("x").to_pylist()), kind).reshape(len(weight), -1).T)
        piece = grow_subtree(key[0].as_py(), key[1].as_py(), x, weight, target, layout, settings)
        return pa.Table.from_batches([rows_batch([piece.packed()], PIECE_SCHEMA)])

    groups = sum(map(len, wanted.values()))
    dealt = data.rows.mapInArrow(deal, DEALT_SCHEMA)
    sent = data.n * len(wanted) * row_bytes(layout)
    parts = max(1, min(groups, max(4 * dealt.sparkSession.sparkContext.defaultParallelism, sent // TASK_BYTES), 20_000))
    return dealt.repartition(parts, "tree", "node").groupBy("tree", "node").applyInArrow(grow, PIECE_SCHEMA)


def row_bytes(layout: Layout) -> int:
    """Bytes of a bagged row."""
    return 9 + len(layout.bins) * np.dtype(narrow_kind(layout)).itemsize


@dataclass(frozen=True)
class Grid:
    """Columns of a forest, and its targets' grid, from ``low`` by ``step``."""

    layout: Layout
    low: float
    step: float

    def values(self, total: np.ndarray, n: np.ndarray) -> np.ndarray:
        return self.low + total / n * self.step

    def nodes(self, piece: Piece) -> list[np.ndarray]:
        """``node, n, prediction, squares, gain, feature, threshold`` of a piece's nodes, without links."""
        (n, total, squares), inner, there = piece.sums(), piece.column >= 0, piece.column != LINK
        feature, threshold, gain = np.full(len(n), -1), np.full(len(n), 0.5), np.zeros(len(n))
        feature[inner], threshold[inner] = piece.features(self.layout)
        gain[inner] = self.gains(piece, n, total)
        squares = squares * self.step * self.step + 2 * self.low * self.step * total + self.low * self.low * n
        return [v[there] for v in (piece.ids(), n, self.values(total, n), squares, gain, feature, threshold)]

    def gains(self, piece: Piece, n: np.ndarray, total: np.ndarray) -> np.ndarray:
        return piece.gains(n, total, self.layout) * self.step * self.step


@dataclass(frozen=True)
class Forest:
    """A grown forest: ``pieces`` (``PIECE_SCHEMA``, in the shared folder) over a grid."""

    pieces: DataFrame
    grid: Grid

    @property
    def layout(self) -> Layout:
        return self.grid.layout

    @property
    def nodes(self) -> DataFrame:
        """A row for each node; columns as in ``grow_forest``."""
        grid = self.grid

        def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in pieces_of(batch):
                    node, n, prediction, squares, gain, feature, threshold = grid.nodes(piece)
                    tree = np.full(len(n), piece.tree, np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (tree, node, n, prediction, squares, gain, feature.astype(np.int32), threshold)],
                                                     names=[f.split()[0] for f in NODE_SCHEMA.split(", ")])

        return self.pieces.mapInArrow(unpack, NODE_SCHEMA)

    def gains(self) -> DataFrame:
        """``tree, feature, gain``: what the splits on a feature take off the sum of squares, for each piece of a tree."""
        grid = self.grid

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in pieces_of(batch):
                    n, total, _ = piece.sums()
                    feature, place = np.unique(piece.features(grid.layout)[0], return_inverse=True)
                    gain = np.bincount(place, grid.gains(piece, n, total), len(feature))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(feature), piece.tree, np.int32)), pa.array(feature.astype(np.int32)), pa.array(gain)],
                                                     names=["tree", "feature", "gain"])

        return self.pieces.mapInArrow(add, "tree int, feature int, gain double")

    def mllib(self) -> DataFrame:
        """``MODEL_SCHEMA``; a tree is put together in one task."""
        grid = self.grid

        def build(key: tuple, rows: pa.Table) -> pa.Table:
            return mllib_rows(key[0].as_py(), *(np.concatenate(c) for c in zip(*map(grid.nodes, pieces_of(rows)))))

        return self.pieces.groupBy("tree").applyInArrow(build, MODEL_SCHEMA)

    def scoring(self) -> DataFrame:
        """``SCORING_SCHEMA``: what scoring needs of the pieces."""
        grid = self.grid

        def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [(p.tree, p.root, len(p.column), narrow(p.column + 2).tobytes(), narrow(p.slot).tobytes(), grid.values(p.total, p.n).tobytes()) for p in pieces_of(batch)]
                yield rows_batch(rows, SCORING_SCHEMA)

        return self.pieces.mapInArrow(strip, SCORING_SCHEMA)


def grow(rows: DataFrame, key: str, target: str, numeric: list[str], categorical: dict[str, int], settings: ForestSettings,
         subtree_rows: int = SUBTREE_ROWS) -> Forest:
    data = bin_rows(rows, key, target, numeric, categorical, settings)
    with released_shuffles(rows.sparkSession):
        grown, tops, small = grow_large(data, settings, subtree_rows)
        at_once = max(1, ROUND_BYTES // max(1, data.n * row_bytes(data.layout)))
        trees = sorted(small)
        tables = [stored(grow_small(data, grown, {t: small[t] for t in trees[i:i + at_once]}, settings), "pieces") for i in range(0, len(trees), at_once)]
    if tops:
        tables.append(stored(rows.sparkSession.createDataFrame([p.packed() for p in tops], PIECE_SCHEMA), "pieces"))
    release(data.rows)
    return Forest(reduce(DataFrame.unionByName, tables), Grid(data.layout, data.low, data.step))


def grow_forest(rows: DataFrame, key: str, target: str, numeric: list[str], categorical: dict[str, int], settings: ForestSettings,
                subtree_rows: int = SUBTREE_ROWS) -> tuple[DataFrame, Layout]:
    """(table of nodes, layout). Node columns: ``tree, node`` (root 1, children 2i and 2i + 1), weighted rows ``n``, mean
    ``prediction``, ``gain`` (decrease of the sum of squares), ``feature`` (position in the one-hot encoding, -1 for a leaf)
    and ``threshold``: rows above it go right, for a category (1 against 0) the threshold is 0.5.
    """
    forest = grow(rows, key, target, numeric, categorical, settings, subtree_rows)
    return forest.nodes, forest.layout


class Trees:
    """Some trees for scoring, from rows of ``SCORING_SCHEMA``: pieces one after another, joined where one goes on in another."""

    def __init__(self, pieces: pa.Table, layout: Layout) -> None:
        total, size = sum(pieces.column("size").to_pylist()), 0
        test, child, self.value = np.empty(total, np.int64), np.arange(total, dtype=np.int32 if total < 1 << 31 else np.int64), np.zeros(total)
        starts, links = {}, []
        for tree, root, n, column, slot, value in zip(*(pieces.column(c).to_pylist() for c in SCORING_SCHEMA_FIELDS), strict=True):
            column = widened(column, n) - 2
            inner, first = children(column)
            test[size:size + n] = node_tests(column, widened(slot, len(inner)), layout.is_category)
            child[size + inner], self.value[size + np.flatnonzero(column < 0)] = size + first, np.frombuffer(value)
            at = np.flatnonzero(column == LINK)
            if len(at):
                links += [(tree, i, size + k) for i, k in zip(node_ids(root, column)[at].tolist(), at.tolist())]
            starts[tree, root] = size
            size += n
        for tree, node, at in links:
            child[at] = starts[tree, node]
        self.descent = Descent(test, child)
        self.roots = [at for (_, node), at in sorted(starts.items()) if node == 1]

    def total(self, x: np.ndarray) -> np.ndarray:
        """Sum of the trees' predictions for each row of ``x`` (bins, a column for each column)."""
        out = np.zeros(len(x))
        for root in self.roots:
            out += self.value[self.descent.leaves(x, root)]
        return out


def scoring_of(nodes: DataFrame, layout: Layout) -> DataFrame:
    """``SCORING_SCHEMA``, a row for each tree, from a table of nodes (``tree, node, feature, threshold, prediction``)."""
    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("node")
        feature, threshold, value = (rows.column(c).to_numpy() for c in ("feature", "threshold", "prediction"))
        column, slot = node_splits(feature, threshold, layout)
        row = key[0].as_py(), 1, len(column), narrow(column + 2).tobytes(), narrow(slot).tobytes(), np.ascontiguousarray(value[column < 0]).tobytes()
        return pa.Table.from_batches([rows_batch([row], SCORING_SCHEMA)])

    return nodes.select("tree", "node", "feature", "threshold", "prediction").groupBy("tree").applyInArrow(pack, SCORING_SCHEMA)


def node_splits(feature: np.ndarray, threshold: np.ndarray, layout: Layout) -> tuple[np.ndarray, np.ndarray]:
    """Column of each node, ``LEAF`` where ``feature`` is -1, and bin of each divided one."""
    inner = feature >= 0
    column = np.where(inner, np.searchsorted(layout.first, feature, side="right") - 1, LEAF)
    slot = feature - layout.first[column]
    for j, edges in enumerate(layout.edges):
        here = column == j
        slot[here] = np.searchsorted(edges, threshold[here])
    return column, slot[inner]


def predict(nodes: DataFrame, rows: DataFrame, columns: list[str], layout: Layout, keep: list[str]) -> DataFrame:
    """``predict_by`` a table of nodes."""
    scoring = stored(scoring_of(nodes, layout), "scoring")
    return predict_by(scoring, tree_sizes(scoring), rows, columns, layout, keep)


def tree_sizes(pieces: DataFrame) -> list[tuple[int, int]]:
    return sorted((r["tree"], r["size"]) for r in pieces.groupBy("tree").agg(F.sum("size").alias("size")).collect())


def predict_by(scoring: DataFrame, sizes: list[tuple[int, int]], rows: DataFrame, columns: list[str], layout: Layout, keep: list[str]) -> DataFrame:
    """(keep..., prediction): the mean of all trees for rows with the encoded ``columns``.

    Trees (``SCORING_SCHEMA``) meet rows in tasks, never on the driver: a group holds trees of at most ``NODES_SENT`` nodes, or
    one tree, and up to about ``ROWS_SENT`` bytes of rows as bins. Rows are sent to every group, and trees to every part of
    the rows. Groups of trees add up in their order, so equal forests give equal predictions.
    """
    spark = rows.sparkSession
    if not sizes:
        return rows.select(*keep, F.lit(0.0).alias("prediction"))
    dealt, held, group = [], 0, 0
    for tree, size in sizes:
        if held and held + size > NODES_SENT:
            held, group = 0, group + 1
        dealt.append((tree, group))
        held += size
    width, kind = len(columns), narrow_kind(layout)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.empty((batch.num_rows, width), kind)
                for j in range(width):
                    v = batch.column(len(keep) + j).to_numpy(zero_copy_only=False)
                    # what is no number passes no test
                    x[:, j] = np.where(np.isnan(v), 0, np.searchsorted(layout.edges[j], v, side="left")) if j < len(layout.edges) else v
                kept = [pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), c) for c in batch.columns[:len(keep)]]
                yield pa.RecordBatch.from_arrays([*kept, pa.array([batch.num_rows]), pa.array([x.tobytes()], pa.binary())], names=[*keep, "_rows", "_x"])

    chosen = rows.select(*keep, *columns)
    lists = [f"`{f.name}` array<{f.dataType.simpleString()}>" for f in chosen.schema.fields[:len(keep)]]
    blocks = stored(chosen.mapInArrow(pack, ", ".join([*lists, "_rows long", "_x binary"])).withColumn("_block", F.monotonically_increasing_id()), "blocks")
    n, sent = blocks.agg(F.count(F.lit(1)), F.coalesce(F.sum("_rows"), F.lit(0)) * width * np.dtype(kind).itemsize).first()
    parts = max(1, -(-sent // ROWS_SENT), min(n, -(-spark.sparkContext.defaultParallelism // (group + 1))))
    tasks = min(4 * parts * (group + 1), 4_000)

    def add(key: tuple, trees: pa.Table, rows: pa.Table) -> pa.Table:
        sums = []
        if trees.num_rows and rows.num_rows:
            grown = Trees(trees, layout)
            sums = [(block, key[0].as_py(), grown.total(np.frombuffer(x, kind).reshape(-1, width)).tobytes())
                    for block, x in zip(rows.column("_block").to_pylist(), rows.column("_x").to_pylist(), strict=True)]
        return pa.Table.from_batches([rows_batch(sums, "_block long, _group int, _sums binary")])

    def total(key: tuple, sums: pa.Table) -> pa.Table:
        whole = 0.0
        for part in sums.sort_by("_group").column("_sums"):
            whole = whole + np.frombuffer(part.as_buffer())
        return pa.Table.from_batches([rows_batch([(key[0].as_py(), whole.tobytes())], "_of long, _sums binary")])

    groups = F.broadcast(spark.createDataFrame(dealt, "tree int, _group int"))
    pieces = scoring.join(groups, "tree").withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    wanted = blocks.select("_block", "_x", F.explode(F.sequence(F.lit(0), F.lit(group))).alias("_group"),
                           F.pmod(F.xxhash64("_block"), F.lit(parts)).cast("int").alias("_part"))
    pieces, wanted = (side.repartition(tasks, "_group", "_part").groupBy("_group", "_part") for side in (pieces, wanted))
    sums = pieces.cogroup(wanted).applyInArrow(add, "_block long, _group int, _sums binary").groupBy("_block").applyInArrow(total, "_of long, _sums binary")
    whole = blocks.drop("_x").join(sums, F.col("_block") == F.col("_of")).select(*keep, "_sums")
    schema = [*[f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:len(keep)]], "prediction double"]

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                mean = np.frombuffer(batch.column(len(keep))[i].as_buffer()) / len(sizes)
                yield pa.RecordBatch.from_arrays([*[c.slice(i, 1).flatten() for c in batch.columns[:len(keep)]], pa.array(mean)], names=[*keep, "prediction"])

    return whole.mapInArrow(unpack, ", ".join(schema))


def mllib_rows(tree: int, node: np.ndarray, n: np.ndarray, mean: np.ndarray, squares: np.ndarray, gain: np.ndarray, feature: np.ndarray, threshold: np.ndarray) -> pa.Table:
    """A tree as rows of ``MODEL_SCHEMA``, a few in each batch."""
    if (node[1:] < node[:-1]).any():
        order = np.argsort(node)
        node, n, mean, squares, gain, feature, threshold = (c[order] for c in (node, n, mean, squares, gain, feature, threshold))
    inner, size = feature >= 0, len(node)
    left = np.where(inner, np.searchsorted(node, 2 * node), -1).astype(np.int32)
    variance = np.nan_to_num(squares / n - mean * mean)
    variance[variance < 1e-13 * mean * mean] = 0.0  # what rounding leaves
    stats = np.stack([n, n * mean, np.nan_to_num(squares)], axis=1).ravel()
    split = pa.StructArray.from_arrays(
        [pa.array(feature.astype(np.int32)), pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(inner)).astype(np.int32)), pa.array(threshold[inner])),
         pa.array(np.full(size, -1, np.int32))], names=["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
    data = pa.StructArray.from_arrays(
        [pa.array(np.arange(size, dtype=np.int32)), pa.array(mean), pa.array(variance), pa.ListArray.from_arrays(pa.array(np.arange(0, 3 * size + 1, 3, dtype=np.int32)), pa.array(stats)),
         pa.array(n.astype(np.int64)), pa.array(np.where(inner, gain / n, -1.0)), pa.array(left), pa.array(np.where(inner, left + 1, -1).astype(np.int32)), split],
        names="id prediction impurity impurityStats rawCount gain leftChild rightChild split".split())
    whole = pa.table({"treeID": pa.array(np.full(size, tree, np.int32)), "nodeData": data})
    return pa.Table.from_batches(whole.to_batches(max_chunksize=SENT_NODES), whole.schema)


def write_mllib(rows: DataFrame, features: int, settings: ForestSettings, target: str, path: str) -> None:
    """Puts ``rows`` of ``MODEL_SCHEMA`` at ``path`` in the tables MLlib stores models in, written by tasks.

    An empty forest with these settings gives the metadata; its node table is replaced.
    """
    spark = rows.sparkSession
    one = spark.createDataFrame([(Vectors.dense(0.0), 0.0)], ["_features", target])
    estimator(settings, target).setMaxDepth(0).fit(one).write().overwrite().save(path)
    with released_shuffles(spark):
        rows.write.mode("overwrite").options(**{"compression": "zstd", "parquet.writer.version": "v2"}).parquet(f"{path}/data")
    meta = json.loads(spark.read.text(f"{path}/metadata").first()[0])
    meta["numFeatures"], meta["paramMap"]["maxDepth"] = features, settings.depth
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def as_mllib(nodes: DataFrame, features: int, settings: ForestSettings, target: str) -> RandomForestRegressionModel:
    """The forest of a table of nodes as an MLlib model, which the driver holds whole."""
    def build(key: tuple, rows: pa.Table) -> pa.Table:
        return mllib_rows(key[0].as_py(), *(rows.column(c).to_numpy() for c in "node n prediction squares gain feature threshold".split()))

    path = shared_path(nodes.sparkSession, "forest")
    write_mllib(nodes.groupBy("tree").applyInArrow(build, MODEL_SCHEMA), features, settings, target, path)
    return RandomForestRegressionModel.load(path)


def read_mllib(path: str, layout: Layout) -> tuple[DataFrame, Layout]:
    """(``SCORING_SCHEMA``, layout) of a forest in MLlib's stored form. Of the given layout the columns count: the edges of
    bins are the forest's own thresholds."""
    spark, split = SparkSession.active(), "nodeData.split"
    rows = spark.read.schema(MODEL_SCHEMA).parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), "nodeData.id", F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"),
        F.col(f"{split}.featureIndex").alias("feature"), F.get(f"{split}.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"), "nodeData.prediction")
    numbers, names = len(layout.edges), rows.columns
    tests = rows.where((F.col("left") >= 0) & (F.col("feature") < numbers)).select("feature", "threshold").distinct()
    tests = sorted(tuple(r) for r in bounded_collect(tests, NODES_SENT, "thresholds"))
    layout = Layout(tuple(np.array([t for f, t in tests if f == j]) for j in range(numbers)), layout.categories)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tree, place, left, right, feature, threshold, value = (batch.column(c).to_numpy(zero_copy_only=False) for c in names)
            starts = np.flatnonzero(np.append(True, tree[1:] != tree[:-1])) if len(tree) else []
            out = []
            for a, b in zip(starts, [*starts[1:], len(tree)]):
                inner = left[a:b] >= 0
                column, slot = node_splits(np.where(inner, feature[a:b], -1), threshold[a:b], layout)
                # ids and children of a forest that is stored level by level follow each other
                steps = [np.diff(v, prepend=0).astype("<i4").tobytes() for v in (place[a:b], left[a:b][inner])]
                apart = (right[a:b][inner] - left[a:b][inner]).astype("<i4").tobytes()
                out.append((int(tree[a]), int(b - a), *steps, apart, narrow(column + 2).tobytes(), narrow(slot).tobytes(), value[a:b][~inner].astype("<f8").tobytes()))
            yield rows_batch(out, STORED_SCHEMA)

    def whole(key: tuple, parts: pa.Table) -> pa.Table:
        size = sum(parts.column("size").to_pylist())
        column, slot, value, left, right = np.full(size, LEAF), np.zeros(size, np.int64), np.zeros(size), np.full(size, -1), np.full(size, -1)
        for n, ids, lefts, apart, columns, slots, values in zip(*(parts.column(f.split()[0]).to_pylist() for f in STORED_SCHEMA.split(", ")[1:]), strict=True):
            ids, lefts, apart = np.cumsum(np.frombuffer(ids, "<i4"), dtype=np.int64), np.cumsum(np.frombuffer(lefts, "<i4"), dtype=np.int64), np.frombuffer(apart, "<i4")
            column[ids] = widened(columns, n) - 2
            inner = ids[column[ids] >= 0]
            left[inner], right[inner], slot[inner], value[ids[column[ids] < 0]] = lefts, lefts + apart, widened(slots, len(inner)), np.frombuffer(values)
        level, order = np.zeros(1, np.int64), []
        while len(level):
            order.append(level)
            level = level[left[level] >= 0]
            level = np.stack([left[level], right[level]], axis=1).ravel()
        order = np.concatenate(order)
        column, slot, value = column[order], slot[order], value[order]
        row = key[0].as_py(), 1, size, narrow(column + 2).tobytes(), narrow(slot[column >= 0]).tobytes(), value[column < 0].tobytes()
        return pa.Table.from_batches([rows_batch([row], SCORING_SCHEMA)])

    with released_shuffles(spark):
        return stored(rows.mapInArrow(pack, STORED_SCHEMA).groupBy("tree").applyInArrow(whole, SCORING_SCHEMA), "scoring"), layout


def estimator(settings: ForestSettings, target: str) -> RandomForestRegressor:
    """MLlib's estimator with the same settings."""
    return RandomForestRegressor(
        featuresCol="_features", labelCol=target, predictionCol="prediction", numTrees=settings.trees,
        maxDepth=settings.depth, minInstancesPerNode=settings.min_leaf, featureSubsetStrategy=settings.feature_subset,
        bootstrap=settings.bootstrap, seed=settings.seed, maxBins=settings.max_bins, impurity="variance")
