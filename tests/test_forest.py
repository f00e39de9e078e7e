"""The forest against plain recursion, in both ways of growing, and its MLlib form; many categories; repeated grids."""

import os
import random
import subprocess
import sys
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.operators import forest as G
from keelson.operators import model as L
from keelson.operators import runs as X
from keelson.operators.split import split_entities
from keelson.presets import strength_features
from keelson.spec import ContractError, ForestSettings, RunSpec

ONE = ForestSettings("one", trees=1, depth=4, min_leaf=3, feature_subset="all", bootstrap=False)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = []
    for i in range(400):
        a, b, c, d = rng.randrange(40) / 4, rng.gauss(0, 1), rng.randrange(6), rng.randrange(3)
        data.append((i, float(3 * a + (10 if c in (1, 4) else 0) + 5 * (d == 2) * (b > 0) + rng.gauss(0, 1)), a, b, c, d))
    return data


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, y double, a double, b double, c int, d int")


def nodes_of(frame, settings, **more):
    nodes, _ = G.grow_forest(frame, "k", "y", ["a", "b"], {"c": 6, "d": 3}, settings, **more)
    return sorted((r["tree"], r["node"], r["n"], round(r["prediction"], 6), r["feature"], round(r["threshold"], 9)) for r in nodes.collect())


def tree_by_hand(rows, edges, settings, node=1):
    """(node, rows, mean, feature, threshold) by trying every split of every node."""
    y = np.array([r[1] for r in rows])
    tests = [(0, e, lambda r, e=e: r[2] > e) for e in edges[0]] + [(1, e, lambda r, e=e: r[3] > e) for e in edges[1]]
    tests += [(2 + v, 0.5, lambda r, v=v: r[4] == v) for v in range(6)] + [(8 + v, 0.5, lambda r, v=v: r[5] == v) for v in range(3)]
    best = (1e-9, -1, 0.5, None)
    if node.bit_length() <= settings.depth:
        for f, t, right in tests:
            side = np.array([bool(right(r)) for r in rows])
            if min(side.sum(), (~side).sum()) >= settings.min_leaf:
                gain = ((y - y.mean()) ** 2).sum() - sum(((y[s] - y[s].mean()) ** 2).sum() for s in (side, ~side))
                best = max(best, (gain, f, t, right), key=lambda x: (round(x[0], 9),)) if gain > best[0] + 1e-9 else best
    own = [(0, node, len(rows), round(y.mean(), 6), best[1], round(best[2], 9))]
    if best[1] < 0:
        return own
    parts = [r for r in rows if not best[3](r)], [r for r in rows if best[3](r)]
    return own + [x for i, part in enumerate(parts) for x in tree_by_hand(part, edges, settings, 2 * node + i)]


def test_a_tree_is_the_one_of_plain_recursion(frame, rows):
    data = G.bin_rows(frame, "k", "y", ["a", "b"], {"c": 6, "d": 3}, ONE)
    assert nodes_of(frame, ONE) == sorted(tree_by_hand(rows, data.layout.edges, ONE))


@pytest.mark.parametrize("settings", [ForestSettings("many", 4, 9, 2), ForestSettings("deep", 2, 20, 1, "all")])
def test_large_nodes_split_as_small_ones_do(frame, settings, monkeypatch):
    monkeypatch.setattr(G, "PASS_SUMS", 3000)  # few nodes in a pass
    monkeypatch.setattr(G, "ROUND_BYTES", 20_000)  # few trees in a round
    whole = nodes_of(frame, settings)
    assert nodes_of(frame.repartition(3), settings, subtree_rows=90) == whole
    assert {t for t, *_ in whole} == set(range(settings.trees))


def test_mllib_form_predicts_what_the_nodes_say(spark, frame, rows, monkeypatch):
    settings = ForestSettings("m", 4, 8, 2)
    nodes, layout = G.grow_forest(frame, "k", "y", ["a", "b"], {"c": 6, "d": 3}, settings)
    model = G.as_mllib(nodes, layout.features, settings, "y")
    assert (model.getNumTrees, model.numFeatures, model.getMaxDepth()) == (4, 11, 8)
    table = {(r["tree"], r["node"]): r for r in nodes.collect()}
    from pyspark.ml.linalg import Vectors

    unseen = [(*r[:4], 6, 3) for r in rows[:5]]
    vectors = [[r[2], r[3], *[float(r[4] == v) for v in range(6)], *[float(r[5] == v) for v in range(3)]] for r in [*rows, *unseen]]
    got = [r["prediction"] for r in model.transform(spark.createDataFrame([(Vectors.dense(v),) for v in vectors], ["_features"])).collect()]
    for vector, prediction in zip(vectors, got):
        leaves = []
        for tree in range(4):
            node = 1
            while (r := table[tree, node])["feature"] >= 0:
                node = 2 * node + (vector[r["feature"]] > r["threshold"])
            leaves.append(r["prediction"])
        assert prediction == pytest.approx(np.mean(leaves))
    encoded = spark.createDataFrame([(i, r[2], r[3], r[4], r[5]) for i, r in enumerate([*rows, *unseen])], "i long, a double, b double, c int, d int")
    for sent in (1, 10**6):  # a tree at a time, all at once
        monkeypatch.setattr(G, "NODES_SENT", sent)
        again = G.predict(nodes, encoded, ["a", "b", "c", "d"], layout, ["i"]).orderBy("i").collect()
        assert [r["prediction"] for r in again] == pytest.approx(got)
    shares = {}
    for tree in range(4):
        gains = {n: r for n, r in table.items() if n[0] == tree and r["feature"] >= 0}
        for r in gains.values():
            shares[r["feature"]] = shares.get(r["feature"], 0) + r["gain"] / sum(g["gain"] for g in gains.values()) / 4
    assert {i: v for i, v in enumerate(model.featureImportances.toArray()) if v} == pytest.approx(shares)


def test_bootstrap_weights_are_poisson_and_repeat():
    keys = np.random.default_rng(1).integers(-2**63, 2**63 - 1, 200_000)
    w = G.bag(keys, 3, ForestSettings("w", 9, 3, 1))
    assert abs(w.mean() - 1) < 0.01 and abs(w.var() - 1) < 0.02 and abs((w == 0).mean() - np.exp(-1)) < 0.005
    assert (w == G.bag(keys, 3, ForestSettings("w", 5, 9, 2))).all() and (w != G.bag(keys, 4, ForestSettings("w", 9, 3, 1))).mean() > 0.5


def test_edge_tables(spark, frame):
    assert nodes_of(frame.withColumn("y", F.lit(4.0)), replace(ONE, trees=2)) == [(t, 1, 400.0, 4.0, -1, 0.5) for t in range(2)]
    assert nodes_of(frame.limit(1), ONE)[0][2:5] == (1.0, round(frame.limit(1).first()["y"], 6), -1)
    assert nodes_of(frame.where("k < 0"), ONE) == []


def test_importance_follows_mllib(spark):
    """The table of importances and MLlib's vector of the same forest."""
    base = spark.range(300).selectExpr("id AS k", "IF(id % 5 = 0, 'test', 'train') AS split", "double(id % 17 + 4 * (id % 3)) AS y", "double(id % 17) AS age",
                                       "double(id % 4) AS weight", "1D AS height", "concat('g', id % 3) AS gender", "'r' AS region")
    spec = strength_features("k", "v1")
    result = L.fit(L.prepare(base, spec, "k", "y"), ForestSettings("i", 6, 5, 2))
    names = [r["feature"] for r in result.preprocessing.named_features().orderBy("position").collect()]
    assert names == result.preprocessing.output_names and result.preprocessing.width == len(names)
    vector = dict(zip(names, result.model.forest.featureImportances.toArray()))
    assert {r["feature"]: r["importance"] for r in result.importance().collect()} == pytest.approx(vector)


MANY = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from keelson.operators import model as L
from keelson.presets import strength_features
spark = (SparkSession.builder.master("local[4]").config("spark.driver.memory", "1g").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "8").getOrCreate())
spark.sparkContext.setCheckpointDir({folder!r})
n = {n}
rows = spark.range(2 * n).selectExpr("id AS k", "double(id % 7) AS age", "1D AS weight", "2D AS height", "concat('g', lpad(id %% %d, 7, '0')) AS gender" % n, "'r' AS region")
learned = L.fit_preprocessing(rows, strength_features("k", "v1"))
encoded = learned.vectors(rows, ["k", "gender"])
from pyspark.ml.stat import Summarizer
assert learned.width == n + 4, learned.width
bad = encoded.where("_forest_c0 <> int(substring(gender, 2))").count()
first = encoded.where("k = 5").first()["_features"]
print("RESULT", encoded.count(), bad, first.size, list(map(int, first.indices)), list(map(float, first.values)))
"""


def test_a_million_categories_encode_with_a_small_driver(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "many.py"
    script.write_text(MANY.replace("{root!r}", repr(root)).replace("{folder!r}", repr(str(tmp_path / "shared"))).replace("{n}", "1_000_000"))
    env = {k: v for k, v in os.environ.items() if not k.startswith(("SPARK_", "PYSPARK_"))}
    done = subprocess.run([sys.executable, str(script)], capture_output=True, text=True, timeout=400, env=env)
    lines = [x for x in done.stdout.splitlines() if x.startswith("RESULT")]
    assert lines == ["RESULT 2000000 0 1000004 [0, 1, 2, 8, 1000003] [5.0, 1.0, 2.0, 1.0, 1.0]"], done.stderr[-2000:]


def test_a_grid_stopped_midway_can_be_run_again(spark, tmp_path, monkeypatch):
    data = spark.range(60).selectExpr("id AS k", "double(id % 11) AS y", "double(id % 7) AS age", "double(id % 5) AS weight", "2D AS height", "concat('g', id % 3) AS gender", "'r' AS region")
    spec, sets = strength_features("k", "v1"), {"1": ForestSettings("1", 2, 3, 1), "2": ForestSettings("2", 3, 2, 1, "all")}
    split, _ = split_entities(data, "k", 0.2)
    grid = [RunSpec(f"0{h}", "v1", h) for h in sets]
    fit, calls = X.fit, []
    monkeypatch.setattr(X, "fit", lambda *a: fit(*a) if not calls.append(1) and len(calls) != 2 else 1 / 0)
    run = lambda: X.run_grid({"v1": (data, spec)}, split, "y", grid, sets, "7", str(tmp_path / "runs"), str(tmp_path / "art"))
    with pytest.raises(ZeroDivisionError):
        run()
    assert [r["run_name"] for r in X.read_registry(spark, str(tmp_path / "runs")).collect()] == ["01"]
    for _ in range(2):  # and once more: still one record for each run
        assert sorted((r["run_group"], r["run_name"], r["settings"]) for r in run().collect()) == [("7", "01", "1"), ("7", "02", "2")]
    with pytest.raises(ContractError, match="holds the runs"):
        X.run_grid({"v1": (data, spec)}, split, "y", [RunSpec("other", "v1", "1")], {"1": sets["1"]}, "7", str(tmp_path / "runs"))


def test_a_pass_over_the_rows_sends_one_packed_row_for_each_node_and_task(frame):
    settings = ForestSettings("many", 4, 9, 2)
    data = G.bin_rows(frame.repartition(3), "k", "y", ["a", "b"], {"c": 6, "d": 3}, settings)
    sums = G.level_sums(data, G.Grown(), [(t, 1) for t in range(4)], settings)
    assert 4 <= sums.count() <= 4 * data.rows.rdd.getNumPartitions()


def test_trees_in_pieces_score_and_are_stored_as_whole_ones(spark, frame, tmp_path):
    settings = ForestSettings("p", 3, 20, 1, "all")
    grown = [G.grow(frame, "k", "y", ["a", "b"], {"c": 6, "d": 3}, settings, subtree_rows=n) for n in (90, 1000)]
    assert [f.pieces.count() > 3 for f in grown] == [True, False]
    rows = frame.select("k", "a", "b", "c", "d").unionByName(spark.createDataFrame([(-1, float("nan"), 0.1, 6, 3), (-2, 1e9, -1e9, 0, 1)], "k long, a double, b double, c int, d int"))
    columns, keep, got = ["a", "b", "c", "d"], ["k"], []
    for i, forest in enumerate(grown):
        path = str(tmp_path / f"forest{i}")
        G.write_mllib(forest.mllib(), forest.layout.features, settings, "y", path)
        again, layout = G.read_mllib(path, G.Layout((np.empty(0), np.empty(0)), (6, 3)))
        got.append(sorted(G.predict_by(forest.scoring(), G.tree_sizes(forest.pieces), rows, columns, forest.layout, keep).collect()))
        got.append(sorted(G.predict_by(again, G.tree_sizes(again), rows, columns, layout, keep).collect()))
        got.append(sorted(G.predict(forest.nodes, rows, columns, forest.layout, keep).collect()))
    assert len(got[0]) == 402 and all(g == got[0] for g in got)


def test_a_model_is_saved_once_and_rows_are_scored_as_bins(spark, frame, tmp_path):
    base = spark.range(300).selectExpr("id AS k", "IF(id % 5 = 0, 'test', 'train') AS split", "double(id % 17 + 4 * (id % 3)) AS y", "double(id % 17) AS age",
                                       "double(id % 4) AS weight", "1D AS height", "concat('g', id % 3) AS gender", "'r' AS region")
    tables = spark.sparkContext.getCheckpointDir().removeprefix("file:") + "/tables"
    before = set(os.listdir(tables)) if os.path.isdir(tables) else set()
    result = L.fit(L.prepare(base, strength_features("k", "v1"), "k", "y"), ForestSettings("s", 6, 5, 2))
    L.save_model(result.model, str(tmp_path / "model"))
    stored = {r["k"]: r["prediction"] for r in L.score(str(tmp_path / "model"), base, "k").collect()}
    assert stored == {r["k"]: r["prediction"] for r in result.scored.collect()}
    made = set(os.listdir(tables)) - before
    assert not [f for f in made if f.startswith("forest-")]  # no copy beside the saved one
    blocks = [f for f in made if f.startswith("blocks-")]
    assert len(blocks) == 2
    for folder in blocks:  # a byte for each of five columns
        assert spark.read.parquet(f"{tables}/{folder}").where("length(_x) <> 5 * _rows").isEmpty()


@pytest.mark.parametrize("min_leaf, dense", [(1, 0), (1, 10**9), (4, 3)])
def test_tables_and_sorting_find_the_splits_of_best_splits(min_leaf, dense, monkeypatch):
    """Every column's best split of a level, with a column that equals an earlier one, by both ways and by the plain one."""
    monkeypatch.setattr(G, "DENSE", dense)
    rng = np.random.default_rng(8)
    layout, sizes = G.Layout((np.arange(8.0), np.arange(8.0), np.arange(3.0)), (5,)), np.array([40, 1, 7, 90])
    x = [rng.integers(0, 9, 138), None, rng.integers(0, 4, 138), rng.integers(0, 6, 138)]
    x[1] = x[0]
    node, weight, target = np.repeat(np.arange(4), sizes), rng.integers(1, 4, 138).astype(float), rng.integers(0, 2**34, 138).astype(float)
    n, total = np.bincount(node, weight), np.bincount(node, weight * target)
    for allowed in (None, np.sort(rng.choice(4 * layout.features, 12, replace=False))):
        level = G.Level(sizes, weight, weight * target, n, total, allowed, layout, min_leaf)
        for j in range(4):
            order = np.lexsort((x[j], node))
            cells = {}
            for i in order.tolist():
                cell = cells.setdefault((int(node[i]), int(x[j][i])), [0.0, 0.0])
                cell[0] += weight[i]
                cell[1] += weight[i] * target[i]
            of_node, slot = np.array(list(cells)).T
            rows, sums = np.array(list(cells.values())).T
            gain, at = G.best_splits(j, of_node, slot, rows, sums, n, total, allowed, layout, min_leaf)
            found, where = level.best(j, x[j])
            assert (found == gain).all() and (where[gain > 0] == at[gain > 0]).all()
    settings = ForestSettings("t", 1, 6, min_leaf, "all")
    piece = G.grow_subtree(0, 1, np.array(x, np.uint8), weight, target, layout, settings)
    assert 1 not in piece.column and (piece.column >= 0).sum() > 5
    apart = G.grow_subtree(0, 1, np.array([x[0], (x[1] + 1) % 9, x[2], x[3]], np.uint8), weight, target, layout, settings)
    assert 1 in apart.column


def test_bins_beyond_a_pass_are_summed_sparsely(frame, monkeypatch):
    settings = ForestSettings("wide", 2, 6, 2, "all")
    whole = nodes_of(frame, settings)
    monkeypatch.setattr(G, "PASS_SUMS", 10)
    assert nodes_of(frame.repartition(3), settings, subtree_rows=250) == whole
