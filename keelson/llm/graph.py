"""Connected components and id screens over tables of any size."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.session import bounded_collect, release, stored

SCREEN_BITS = 1 << 20
MAX_ROUNDS = 100
HUB_EDGES = 1_000_000
LINKS = "a long, b long, moved boolean"


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hangs every node of this partition below the smallest node it is connected with here.

    ``moved`` tells that a component was not such a star already.
    """
    a, b = [], []
    for batch in batches:
        a.append(batch.column("a").to_numpy())
        b.append(batch.column("b").to_numpy())
    if not a or not sum(map(len, a)):
        return
    nodes, place = np.unique(np.concatenate(a + b), return_inverse=True)
    one, two = place[:len(place) // 2], place[len(place) // 2:]
    root = np.arange(len(nodes))
    while True:  # smallest neighbour of the roots, then shortcuts, until nothing changes
        low = np.minimum(root[one], root[two])
        before = root.copy()
        for side in (one, two):
            np.minimum.at(root, root[side], low)
            np.minimum.at(root, side, low)
        while (root != root[root]).any():
            root = root[root]
        if (root == before).all():
            break
    below = np.flatnonzero(root != np.arange(len(nodes)))
    star = np.zeros(len(nodes), bool)  # components with an edge that does not end at the smallest node
    off = (np.minimum(one, two) != root[one])
    star[root[one[off]]] = True
    yield pa.RecordBatch.from_arrays([pa.array(nodes[below]), pa.array(nodes[root[below]]), pa.array(star[root[below]])], names=["a", "b", "moved"])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): each node that has an edge, with the smallest node it reaches.

    Each round brings all edges of a node together and hangs what is connected there below its smallest node, until every
    component is a star; the number of rounds grows with the logarithm of the longest path. A node with many edges is
    spread: its edges to larger nodes are dealt over several places, its few edges to smaller nodes go to all of them. Each
    round is written to the shared folder, and no edge reaches the driver.
    """
    pairs = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a <> b")
    links = stored(pairs.mapInArrow(_local_stars, LINKS), "links")
    for _ in range(MAX_ROUNDS):
        n = links.count()
        places = -(-n // HUB_EDGES) or 1
        below = links.select("a", "b", F.col("b").alias("node"), F.pmod(F.xxhash64("a"), F.lit(places)).cast("int").alias("place"))
        own = links.select("a", "b", F.col("a").alias("node"), F.explode(F.sequence(F.lit(0), F.lit(places - 1))).alias("place"))
        met = below.unionByName(own).repartition("node", "place").select("a", "b")
        after = stored(met.mapInArrow(_local_stars, LINKS), "links")
        release(links)
        links = after
        if links.where("moved").isEmpty():
            break
    else:
        raise ValueError(f"components did not settle in {MAX_ROUNDS} rounds")
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()


def screen(ids: DataFrame, column: str, bits: int = SCREEN_BITS):
    """A test that is true for every listed id and for few others, to thin a table before an exact join.

    Its size is fixed, so a long list makes it let more rows through, never wrong ones out of the result of that join.
    """
    place = F.explode(F.array(*_places(F.col(column), bits)))
    words = ids.where(F.col(column).isNotNull()).select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))).alias("v"))
    filled = [0] * (bits // 64)
    for r in bounded_collect(words, bits // 64, "screen words"):
        filled[r["w"]] = r["v"]
    table = json.dumps(filled)

    def test(value: Column) -> Column:
        array = F.from_json(F.lit(table), "array<bigint>")
        hits = [F.getbit(F.get(array, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1 for p in _places(value, bits)]
        return F.coalesce(hits[0] & hits[1], F.lit(False))
    return test


def _places(value: Column, bits: int) -> list[Column]:
    return [F.xxhash64(value, F.lit(i)).bitwiseAND(F.lit(bits - 1)) for i in (1, 2)]
