"""Exact n-gram Jaccard join by a blocked sparse product of the document by n-gram incidence matrix.

Two documents link when the Jaccard similarity of their sets of word n-grams reaches a ratio. The steps:

1. Incidence. Documents become sets of 64-bit n-gram hashes in blocks of ``BLOCK_BYTES`` of text; equal sets are one node
   from here on. A block sends the (n-gram, document) pairs of each column range as one packed row, the ranges count in how
   many documents each n-gram is, and send back only n-grams of two or more documents.
2. Size-derived bounds. A set of n needs ceil(ratio * n) common n-grams with any partner, so of its rarest
   n - ceil(ratio * n) + 1 at least one is shared. Those columns are the index; rows of a column follow one another by
   size, and each is joined with the smallest row, or the row before, when the sizes allow the ratio. Sizes that do not fit
   end a chain, so every pair that can link is inside one connected cluster: a column of L rows costs L - 1 edges.
3. Product. The rows of a cluster are cut into blocks of ``ROWS``; each pair of blocks whose sizes fit is one product of
   incidence matrices, accumulated over column blocks. It ends early when no pair can still reach its bound. A task returns
   a spanning forest of the linking pairs and the number of links of each row, never the pairs.
4. Connected components of the forests.

Nothing here is approximate, apart from hashes standing for n-grams: ``COLUMN_BITS`` bits in the index, where a collision
only merges two columns, 64 bits where overlaps are counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keelson.llm.graph import components, screen
from keelson.llm.words import free_names, give_back, mix, shingle_hashes, text_slices, word_hashes
from keelson.operators.ranks import with_ordinal
from keelson.session import stored

BLOCK_BYTES = 4 << 20
COLUMN_BITS = 48
PART_BYTES = 8 << 20
ROWS = 256
COLUMNS = 8192
ENTRIES, INFO = 0, 1
INFO_TYPE = np.dtype([("doc_id", "<i8"), ("known", "?"), ("n", "<i8"), ("hi", "<i8"), ("lo", "<i8")])


def pack(values: np.ndarray) -> bytes:
    """Little-endian integers as byte planes: the zero planes of small values compress to nothing."""
    return values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T.tobytes()


def unpack(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def document_sets(column: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes, counts): ascending distinct n-gram hashes of each text, texts one after another."""
    for row, data, offsets in text_slices(column):
        hashes, runs = shingle_hashes(*word_hashes(data, offsets), words)
        owner = np.repeat(np.arange(len(runs)), runs)
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        yield row, hashes[new], np.bincount(owner[new], minlength=len(runs))


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each group, modulo 2**64."""
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    ends = np.cumsum(counts)
    return running[ends] - running[ends - counts]


def incidence_rows(docs: DataFrame, words: int, parts: int) -> DataFrame:
    """(part, block, kind, payload): of each block of documents, one row per column range and one about its documents."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            ids, known = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False), ~np.asarray(batch.column("doc_id").is_null())
            text, row = batch.column("text"), 0
            sizes = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False))])
            while row < batch.num_rows:
                end = max(row + 1, int(np.searchsorted(sizes, sizes[row] + BLOCK_BYTES, side="right")) - 1)
                found = list(document_sets(text.slice(row, end - row), words))
                hashes, counts = (np.concatenate([f[i] for f in found]) for i in (1, 2))
                info = np.zeros(end - row, INFO_TYPE)
                info["doc_id"], info["known"], info["n"] = ids[row:end], known[row:end], counts
                info["hi"], info["lo"] = (_sums(mix(hashes ^ np.uint64(c)), counts).view(np.int64) for c in (0x243F6A88, 0x85A308D3))
                yield from block_rows(base + number, info, hashes, counts)
                number, row = number + 1, end
        give_back()

    def block_rows(block: int, info: np.ndarray, hashes: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        # the first row of each set among those that can link: a null doc_id before a copy sends nothing
        first, known = np.zeros(len(info), bool), np.flatnonzero(info["known"])
        first[known[np.unique(info[known][["hi", "lo"]], return_index=True)[1]]] = True
        owner = np.repeat(np.arange(len(info), dtype=np.uint32), counts)
        chosen = first[owner]
        hashes, owner = hashes[chosen], owner[chosen]
        hashes = hashes >> np.uint64(64 - COLUMN_BITS)
        order = np.argsort(hashes, kind="stable")
        hashes, owner = hashes[order], owner[order]
        part = ((hashes >> np.uint64(COLUMN_BITS - 32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        edges = np.searchsorted(part, np.arange(parts + 1))
        rows = [(block % parts, INFO, info.tobytes(), b"")]
        for p in np.flatnonzero(np.diff(edges)):
            a, b = edges[p], edges[p + 1]
            rows.append((int(p), ENTRIES, pack(np.diff(hashes[a:b], prepend=np.uint64(0))), pack(owner[a:b])))
        part, kind, one, two = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int64()), pa.array([block] * len(rows), pa.int64()), pa.array(kind, pa.int32()), pa.array(one, pa.binary()),
             pa.array(two, pa.binary())], names=["part", "block", "kind", "hashes", "owners"])

    return docs.select("doc_id", "text").mapInArrow(emit, "part long, block long, kind int, hashes binary, owners binary")


def _shared_columns(rows: pa.Table) -> pa.Table:
    """Of the n-grams of one column range, those of two or more rows, back to their blocks with their number of rows."""
    blocks, kinds = rows.column("block").to_pylist(), rows.column("kind").to_pylist()
    one, two = rows.column("hashes").to_pylist(), rows.column("owners").to_pylist()
    out = [(b, INFO, h, b"", b"") for b, k, h in zip(blocks, kinds, one, strict=True) if k == INFO]
    at = [i for i, k in enumerate(kinds) if k == ENTRIES]
    if at:
        each = [np.cumsum(unpack(one[i], np.uint64), dtype=np.uint64) for i in at]
        hashes = np.concatenate(each)
        order = np.argsort(hashes, kind="stable")
        ordered = hashes[order]
        starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        sizes = np.diff(np.append(starts, len(ordered)))
        df = np.empty(len(hashes), np.uint32)
        df[order] = np.repeat(sizes, sizes)
        offset = 0
        for i, h in zip(at, each, strict=True):
            mine = df[offset:offset + len(h)]
            offset += len(h)
            if (shared := mine > 1).any():
                out.append((blocks[i], ENTRIES, pack(h[shared]), pack(unpack(two[i], np.uint32)[shared]), pack(mine[shared])))
    columns = list(zip(*out, strict=True)) or [[]] * 5
    give_back()
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)],
                    names=["block", "kind", "hashes", "owners", "df"])


def _index_of(numerator: int, denominator: int):
    def index(rows: pa.Table) -> pa.Table:
        """Of each document of one block, the shared n-grams among its rarest n - ceil(ratio * n) + 1."""
        kinds = rows.column("kind").to_pylist()
        info = np.frombuffer(next(h for h, k in zip(rows.column("hashes").to_pylist(), kinds, strict=True) if k == INFO), INFO_TYPE)
        at = [i for i, k in enumerate(kinds) if k == ENTRIES]
        columns = [[c[i] for i in at] for c in (rows.column(n).to_pylist() for n in ("hashes", "owners", "df"))]
        hashes, owner, df = (np.concatenate([unpack(x, t) for x in c]) if c else np.empty(0, t)
                             for c, t in zip(columns, (np.uint64, np.uint32, np.uint32), strict=True))
        shared = np.bincount(owner, minlength=len(info))
        prefix = info["n"] - -(-info["n"] * numerator // denominator) + 1
        wanted = prefix - (info["n"] - shared)  # n-grams of this document alone come first
        keep = wanted[owner] > 0
        hashes, owner, df = hashes[keep], owner[keep], df[keep]
        order = np.lexsort((hashes, df, owner))
        hashes, owner = hashes[order], owner[order]
        counts = np.bincount(owner, minlength=len(info))
        place = np.arange(len(owner)) - (np.cumsum(counts) - counts)[owner]
        top = place < wanted[owner]
        hashes, owner = hashes[top], owner[top]
        return pa.table({"gram": pa.array(hashes.view(np.int64)), **{c: pa.array(info[c][owner]) for c in ("hi", "lo", "n")}})
    return index


def _documents_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for payload in batch.column("hashes").to_pylist():
            info = np.frombuffer(payload, INFO_TYPE)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(info["doc_id"]), mask=~info["known"]), *(pa.array(np.ascontiguousarray(info[c])) for c in ("n", "hi", "lo"))],
                names=["doc_id", "n", "hi", "lo"])


def _sets_of(words: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for _, hashes, counts in document_sets(batch.column("text"), words):
                out += [h.tobytes() for h in np.split(hashes, np.cumsum(counts)[:-1])]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(out, pa.binary())], names=["node", "grams"])
        give_back()
    return sets


def overlaps(left: list[np.ndarray], right: list[np.ndarray], numerator: int, denominator: int, columns: int = COLUMNS) -> np.ndarray:
    """Links (rows of left by rows of right) of the incidence product, accumulated over blocks of ``columns`` n-grams.

    A pair of sizes m and n links when its overlap is at least ratio / (1 + ratio) * (m + n). Between column blocks the
    overlap so far plus the smaller rest bounds each pair from above; when no pair is left above its bound, the rest of the
    columns is not multiplied.
    """
    same = left is right
    sides = [left] if same else [left, right]
    values = np.concatenate([h for side in sides for h in side])
    _, column, uses = np.unique(values, return_inverse=True, return_counts=True)
    renumber = np.cumsum(uses > 1) - 1  # a column of one row adds to no overlap
    lengths = [np.array([len(h) for h in side]) for side in sides]
    at, parts = 0, []
    for size in lengths:
        mine = column[at:at + size.sum()]
        row = np.repeat(np.arange(len(size)), size)
        useful = uses[mine] > 1
        parts.append((row[useful], renumber[mine[useful]]))
        at += size.sum()
    total = int((uses > 1).sum())
    need = numerator * (lengths[0][:, None] + lengths[-1][None, :])
    overlap = np.zeros(need.shape, np.int64)
    rest = [np.bincount(row, minlength=len(size)) for (row, _), size in zip(parts, lengths, strict=True)]
    for start in range(0, total, columns):
        if not ((overlap + np.minimum(rest[0][:, None], rest[-1][None, :])) * (numerator + denominator) >= need).any():
            break
        blocks = []
        for i, (row, col) in enumerate(parts):
            inside = (col >= start) & (col < start + columns)
            block = np.zeros((len(lengths[i]), min(columns, total - start)), np.float32)
            block[row[inside], col[inside] - start] = 1
            rest[i] = rest[i] - np.bincount(row[inside], minlength=len(lengths[i]))
            blocks.append(block)
        overlap += (blocks[0] @ blocks[-1].T).astype(np.int64)
    links = overlap * (numerator + denominator) >= need
    if same:
        np.fill_diagonal(links, False)
    return links


def spanning_edges(links: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of an adjacency matrix, as (row, row) pairs."""
    left, edges = np.ones(len(links), bool), []
    for start in range(len(links)):
        if not left[start]:
            continue
        left[start], queue = False, [start]
        while queue:
            node = queue.pop()
            found = np.flatnonzero(links[node] & left)
            left[found] = False
            edges += [(node, int(x)) for x in found]
            queue += found.tolist()
    return edges


def _product_of(numerator: int, denominator: int):
    def product(rows: pa.Table) -> pa.Table:
        """Links of the clusters of one task: rows (a, b, 0) of a spanning forest and (a, null, links of a)."""
        cluster, side, node, weight = (np.asarray(rows.column(c)) for c in ("cluster", "side", "node", "copies"))
        grams, out = rows.column("grams").to_pylist(), []
        order = np.lexsort((side, cluster))
        once = {(cluster[i], side[i], node[i], grams[i]): i for i in order[::-1]}  # repeated rows share a node
        order = np.array([i for i in order if once[cluster[i], side[i], node[i], grams[i]] == i])
        for group in np.split(order, np.flatnonzero(np.diff(cluster[order])) + 1):
            one, two = group[side[group] == 0], group[side[group] == 1]
            left = [np.frombuffer(grams[i], np.uint64) for i in one]
            if not len(two):
                links = overlaps(left, left, numerator, denominator)
                ids = node[one]
                out += zip(ids.tolist(), [None] * len(ids), (links @ weight[one]).tolist(), strict=True)
            else:
                half = overlaps(left, [np.frombuffer(grams[i], np.uint64) for i in two], numerator, denominator)
                ids = np.concatenate([node[one], node[two]])
                out += zip(node[one].tolist(), [None] * len(one), (half @ weight[two]).tolist(), strict=True)
                out += zip(node[two].tolist(), [None] * len(two), (half.T @ weight[one]).tolist(), strict=True)
                links = np.zeros((len(ids), len(ids)), bool)
                links[:len(one), len(one):], links[len(one):, :len(one)] = half, half.T
            out += [(int(ids[a]), int(ids[b]), 0) for a, b in spanning_edges(links)]
        columns = list(zip(*out, strict=True)) or [[]] * 3
        give_back()
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["a", "b", "links"])
    return product


def link_documents(docs: DataFrame, words: int = 5, numerator: int = 4, denominator: int = 5, rows: int = ROWS,
                   part_bytes: int = PART_BYTES) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` for every row of ``docs`` (``doc_id``, ``text``).

    A set holds the distinct runs of ``words`` words; a shorter text is one run. Rows link when
    ``denominator * intersection >= numerator * union``. ``component_id`` is the smallest ``doc_id`` reachable by links,
    ``n_links`` the number of other rows a row links with, copies included. Texts that are null or without words link with
    nothing and are their own component; so are rows with a null ``doc_id`` (null component). Rows that share a ``doc_id``
    and its text share its component.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    incidence = stored(incidence_rows(docs, words, parts).groupBy("part").applyInArrow(
        _shared_columns, "block long, kind int, hashes binary, owners binary, df binary"), "incidence")
    every = stored(incidence.where(F.col("kind") == INFO).select("hashes").mapInArrow(_documents_of, "doc_id long, n long, hi long, lo long"), "documents")
    classes = every.where("n > 0 AND doc_id IS NOT NULL").groupBy("hi", "lo", "n").agg(
        F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("copies"))
    index = incidence.groupBy("block").applyInArrow(_index_of(numerator, denominator), "gram long, hi long, lo long, n long").distinct()
    column = index.join(classes, ["hi", "lo", "n"]).select("gram", "n", "node")
    before = Window.partitionBy("gram").orderBy("n", "node")
    # to the smallest row of the column if the sizes allow it, else to the row before
    head, last = (F.struct(f("n").over(before).alias("n"), f("node").over(before).alias("node")) for f in (F.first, F.lag))
    row = column.select("n", "node", F.when(head["n"] * denominator >= F.col("n") * numerator, head).otherwise(last).alias("to"))
    chains = row.where((F.col("to.node") != F.col("node")) & (F.col("to.n") * denominator >= F.col("n") * numerator)).select(
        F.col("to.node").alias("a"), F.col("node").alias("b"))
    clusters = components(chains)
    members = stored(clusters.join(classes, "node").select("node", F.col("component").alias("cluster"), "n", "copies"), "members")
    found = stored(_verify(docs, members, words, numerator, denominator, rows), "links")
    reached = components(found.where("b IS NOT NULL"))
    linked = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    named = classes.join(reached, "node", "left").join(linked, "node", "left").select(
        "hi", "lo", "n", F.coalesce("component", "node").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return every.join(named, ["hi", "lo", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(F.coalesce("n_links", F.lit(0))).alias("n_links"))


def _verify(docs: DataFrame, members: DataFrame, words: int, numerator: int, denominator: int, rows: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("cluster").orderBy("n", "node")) - 1
    placed = stored(members.withColumn("row_block", F.floor(place / rows).cast("int")), "rows")
    blocks = placed.groupBy("cluster", "row_block").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    i, j = blocks.alias("i"), blocks.alias("j")
    pairs = i.join(j, (F.col("i.cluster") == F.col("j.cluster")) & (F.col("i.row_block") <= F.col("j.row_block"))
                   & (F.col("i.most") * denominator >= F.col("j.least") * numerator)).select(
        F.col("i.cluster").alias("cluster"), F.col("i.row_block").alias("i"), F.col("j.row_block").alias("j"))
    sides = F.when(F.col("i") == F.col("j"), F.array(F.struct(F.col("i").alias("row_block"), F.lit(0).alias("side")))).otherwise(
        F.array(F.struct(F.col("i").alias("row_block"), F.lit(0).alias("side")), F.struct(F.col("j").alias("row_block"), F.lit(1).alias("side"))))
    wanted = pairs.select("cluster", "i", "j", F.inline(sides)).join(placed, ["cluster", "row_block"])
    # clusters of one block share tasks, about as many rows together as a block has
    tasks = -(-members.count() // rows) or 1
    alone = F.count(F.lit(1)).over(Window.partitionBy("cluster")) <= rows
    grouped = wanted.withColumn("task", F.when(alone, -1 - F.pmod(F.xxhash64("cluster"), F.lit(tasks))).otherwise(F.col("cluster")))
    maybe = screen(members, "node")
    texts = docs.select(F.col("doc_id").alias("node"), "text").where(maybe(F.col("node"))).join(members.select("node").distinct(), "node", "left_semi")
    grams = texts.mapInArrow(_sets_of(words), "node long, grams binary")
    return grouped.join(grams, "node").select("task", "i", "j", "cluster", "side", "node", "copies", "grams").groupBy("task", "i", "j").applyInArrow(
        _product_of(numerator, denominator), "a long, b long, links long")


def keep_one_of_each(docs: DataFrame, words: int = 5, numerator: int = 4, denominator: int = 5) -> DataFrame:
    """The documents that are the smallest ``doc_id`` of their component, with their columns; of repeated rows one stays.

    A ``doc_id`` with different texts is as many documents, in the order of their texts' hashes.
    """
    name, digest = free_names(docs.columns, ["_name", "_digest"])
    texts = docs.where("doc_id IS NOT NULL").select("doc_id", F.xxhash64("text").alias(digest))
    if texts.groupBy("doc_id").agg(F.min(digest).alias("low"), F.max(digest).alias("high")).where("low <> high").isEmpty():
        return _keep_smallest(docs, words, numerator, denominator)
    numbers = with_ordinal(texts.distinct(), ["doc_id", digest], name)
    numbered = docs.withColumn(digest, F.xxhash64("text")).join(numbers, ["doc_id", digest], "left")
    renamed = [F.col("doc_id").alias(name) if c == "doc_id" else F.col(c) for c in docs.columns]
    kept = _keep_smallest(stored(numbered.select(*renamed, F.col(name).alias("doc_id")), "numbered"), words, numerator, denominator)
    return kept.select(*[F.col(name).alias("doc_id") if c == "doc_id" else F.col(c) for c in docs.columns])


def _keep_smallest(docs: DataFrame, words: int, numerator: int, denominator: int) -> DataFrame:
    """``keep_one_of_each`` of documents whose ``doc_id`` has one text.

    Only rows that an id screen cannot clear are joined, so most texts are not shuffled.
    """
    found = stored(link_documents(docs, words, numerator, denominator), "components")
    dropped = found.where("component_id <> doc_id").select("doc_id").distinct()
    repeated = found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    touched = stored(dropped.withColumn("drop", F.lit(True)).unionByName(repeated.withColumn("drop", F.lit(False))).groupBy("doc_id").agg(
        F.max("drop").alias("drop")), "touched")
    maybe = screen(touched, "doc_id")
    doubtful = docs.where(maybe(F.col("doc_id"))).join(touched, "doc_id", "left")
    again = doubtful.where("NOT drop").drop("drop").dropDuplicates(["doc_id", "text"])
    return docs.where(~maybe(F.col("doc_id"))).unionByName(doubtful.where("drop IS NULL").drop("drop")).unionByName(again).select(docs.columns)
