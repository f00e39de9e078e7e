"""Packing documents into sequences of fixed length by Karmarkar-Karp multiway differencing.

A document's ids are cut at multiples of the sequence length: full pieces are sequences of their own, the remainders are
to be packed. Remainders are dealt by hash into batches of about ``WINDOWS`` windows. In a batch every remainder starts as
a partial partition of the windows with one window filled; the two partial partitions with the largest imbalance are merged,
the fullest window of one with the emptiest of the other, until one is left. Its windows are nearly equal. When the fullest
exceeds the capacity, the batch is partitioned again into one more window. So a batch pads about one window in ``WINDOWS``.

Only piece lengths and checksums are shuffled; ids stay where they were made.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.word_tokens import word_tokens
from keelson.session import stored

LENGTH = 4096
WINDOWS = 128
#: pieces of a batch; differencing holds a row of windows for each
BATCH_ITEMS = 20_000
END_ID = 2
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def differencing(sizes: np.ndarray, windows: int) -> list[np.ndarray]:
    """Item numbers of each of ``windows`` windows, by multiway differencing; equal imbalances in order of creation."""
    heap, bins, left, right = [], {}, [np.arange(0)], [np.arange(0)]
    nodes = len(sizes)  # numbers below are items, above are unions of two nodes; -1 is an empty window
    for item, size in enumerate(sizes.tolist()):
        loads = np.zeros(windows, np.int64)
        loads[0] = size
        content = np.full(windows, -1, np.int64)
        content[0] = item
        bins[item] = (loads, content)
        heap.append((-size, item))
    heapq.heapify(heap)
    made = len(sizes)
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        (load_a, in_a), (load_b, in_b) = bins.pop(a), bins.pop(b)
        loads, other = load_a + load_b[::-1], in_b[::-1]
        both = (in_a >= 0) & (other >= 0)
        content = np.where(in_a >= 0, in_a, other)
        content[both] = nodes + np.arange(both.sum())
        left.append(in_a[both])
        right.append(other[both])
        nodes += int(both.sum())
        order = np.argsort(-loads, kind="stable")
        loads = loads[order]
        bins[made] = (loads - loads[-1], content[order])
        heapq.heappush(heap, (-(loads[0] - loads[-1]), made))
        made += 1
    if not bins:
        return [np.arange(0) for _ in range(windows)]
    lefts, rights = np.concatenate(left), np.concatenate(right)
    out = []
    for top in next(iter(bins.values()))[1].tolist():
        items, stack = [], [top] if top >= 0 else []
        while stack:
            node = stack.pop()
            if node < len(sizes):
                items.append(node)
            else:
                stack += [int(lefts[node - len(sizes)]), int(rights[node - len(sizes)])]
        out.append(np.array(sorted(items), np.int64))
    return out


def pack_batch(sizes: np.ndarray, capacity: int) -> list[np.ndarray]:
    """Windows of at most ``capacity`` for items of at most that size: the smallest number the differencing can keep."""
    windows = -(-int(sizes.sum()) // capacity)
    while True:
        found = differencing(sizes, windows)
        if all(int(sizes[w].sum()) <= capacity for w in found):
            return [w for w in found if len(w)]
        windows += 1


def pieces_of(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` of every piece; the end id makes even an empty text one id long."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end = word_tokens(path), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), tokens.encode(batch.column("text").to_pylist()), strict=True):
                ids += end
                for at in range(0, len(ids), 4 * length):
                    piece = ids[at:at + 4 * length]
                    rows.append((doc_id, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


def pack_documents(docs: DataFrame, path: str, length: int = LENGTH, windows: int = WINDOWS, end_id: int = END_ID) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``, one row per piece.

    A null text counts as empty and yields its end id alone. Repeated rows are packed as often as they occur; rows with a
    null ``doc_id`` are packed too. Sequences are numbered by batch and window, not without gaps.
    """
    pieces = stored(pieces_of(docs, path, length, end_id), "pieces")
    total, items = pieces.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count(F.lit(1))).first()
    batches = max(1, -(-total // (windows * length)), -(-items // BATCH_ITEMS))

    def pack(rows: pa.Table) -> pa.Table:
        order = rows.sort_by([(c, "ascending") for c in ("doc_id", "start", "ids_crc32")])
        sizes = order.column("length").to_numpy()
        full = np.flatnonzero(sizes == length)
        part = np.flatnonzero(sizes < length)
        sequence, offset = np.empty(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        sequence[full] = np.arange(len(full))
        for number, found in enumerate(pack_batch(sizes[part], length) if len(part) else []):
            items = part[found]
            sequence[items] = len(full) + number
            offset[items] = np.cumsum(sizes[items]) - sizes[items]
        base = (order.column("batch").to_numpy()[0] << 32) if len(sizes) else 0
        return order.drop_columns(["batch"]).append_column("sequence_id", pa.array(sequence + base)).append_column("offset", pa.array(offset))

    # by the place of a row in the stored table, so that equal rows do not meet in one batch
    dealt = pieces.withColumn("batch", F.pmod(F.xxhash64("_metadata.file_name", "_metadata.row_index"), F.lit(batches)))
    return dealt.groupBy("batch").applyInArrow(pack, PIECES + ", sequence_id long, offset long")
