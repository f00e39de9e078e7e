"""Token ids as files of frequency-ranked, byte-aligned variable-length integers.

A file is a Parquet table whose rows are blocks of about ``BLOCK_IDS`` ids, so Spark's writers commit it and any store that
Spark reads can hold it. A block is self-contained:

* ``doc_ids``, ``lengths``: the documents in it, ascending, and their ids each;
* ``ranked``: the block's distinct ids by falling frequency (ties: smaller id first), little-endian unsigned 32-bit;
* ``control``: one byte for four ids, two bits each: how many bytes more than one the id's rank takes;
* ``data``: the low bytes of the ranks, one after another.

Decoding looks the control bytes up in a table of lengths, sums them to places, loads four bytes at each place and masks
them by a second table; no id is handled on its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keelson.llm.word_tokens import word_tokens
from keelson.session import shared_path

BLOCK_IDS = 1 << 20
RANGE_BYTES = 8 << 20
MAX_RANGES = 4096
END_ID = 1
DENSE = 1 << 22
LENGTHS = np.array([[1 + (c >> (2 * i) & 3) for i in range(4)] for c in range(256)], np.int64)
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], "<u4")
BLOCK = "range_no int, block_no int, n_ids long, doc_ids array<long>, lengths array<long>, ranked binary, control binary, data binary"


def encode_ids(ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """(ranked, control, data) of unsigned 32-bit ids."""
    if len(ids) and int(ids.max()) < DENSE:  # counting needs no sort; the result is the same
        counts = np.bincount(ids)
        distinct, place = np.flatnonzero(counts), ids
        counts = counts[distinct]
        rank_of = np.empty(int(distinct[-1]) + 1, "<u4")
    else:
        distinct, place, counts = np.unique(ids, return_inverse=True, return_counts=True)
        rank_of = np.empty(len(distinct), "<u4")
    order = np.argsort(-counts, kind="stable")
    rank_of[distinct[order] if place is ids else order] = np.arange(len(order))
    ranks = rank_of[place]
    length = 1 + (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    codes = np.zeros(-(-len(ids) // 4) * 4, np.uint8)
    codes[:len(ids)] = length - 1
    control = codes.reshape(-1, 4) @ np.array([1, 4, 16, 64], np.uint8)
    kept = np.arange(4) < length[:, None]
    return distinct[order].astype("<u4").tobytes(), control.tobytes(), ranks.view(np.uint8).reshape(-1, 4)[kept].tobytes()


def decode_ids(ranked: bytes, control: bytes, data: bytes, n: int) -> np.ndarray:
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    places = np.cumsum(lengths) - lengths
    four = np.ndarray((len(data),), "<u4", np.frombuffer(data + b"\0\0\0", np.uint8), strides=(1,))
    return np.frombuffer(ranked, "<u4")[four[places] & MASKS[lengths]] if n else np.empty(0, "<u4")


def write_token_files(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS,
                      range_bytes: int = RANGE_BYTES) -> None:
    """Encodes every whole text, appends ``end_id``, and writes the ids in ascending ``doc_id`` order under ``path``.

    Documents are cut into ranges of ``doc_id`` at quantiles, at most ``MAX_RANGES``; the quantiles are all that reaches the
    driver. Ids are made before the shuffle and travel as 16-bit numbers where the vocabulary fits. A document is never split over blocks. Null texts count
    as empty; rows with a null ``doc_id`` come first; equal ids are ordered by their token ids.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, min(MAX_RANGES, -(-size // range_bytes)))
    cuts = docs.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 20 * ranges)).first()[0] if ranges > 1 else []
    cuts = sorted(set(cuts or []))
    place = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col("doc_id"))) if cuts else F.lit(0)

    narrow = "<u2" if max(end_id, word_tokens(tokenizer).tokenizer.get_vocab_size() - 1) < 1 << 16 else "<u4"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end = word_tokens(tokenizer), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            ids = [np.frombuffer(found + end, "<u4").astype(narrow).tobytes() for found in tokens.encode(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("range_no"), batch.column("doc_id"), pa.array(ids, pa.binary())], names=["range_no", "doc_id", "ids"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, number, doc_ids, parts, total = None, 0, [], [], 0

        def block() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            row = (current, number, len(ids), doc_ids, [len(p) for p in parts], *encode_ids(ids))
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)],
                                              names=["range_no", "block_no", "n_ids", "doc_ids", "lengths", "ranked", "control", "data"])

        for batch in batches:
            for range_no, doc_id, packed in zip(*(batch.column(c).to_pylist() for c in ("range_no", "doc_id", "ids")), strict=True):
                if parts and (range_no != current or total >= block_ids):
                    yield block()
                    number, doc_ids, parts, total = (number + 1 if range_no == current else 0), [], [], 0
                current = range_no
                parts.append(np.frombuffer(packed, narrow))
                doc_ids.append(doc_id)
                total += len(parts[-1])
        if parts:
            yield block()

    encoded = docs.select(place.cast("int").alias("range_no"), "doc_id", "text").mapInArrow(encode, "range_no int, doc_id long, ids binary")
    laid_out = encoded.repartition("range_no").sortWithinPartitions("range_no", "doc_id", "ids")
    laid_out.mapInArrow(blocks, BLOCK).write.option("compression", "zstd").parquet(path)


def read_token_files(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the blocks alone."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_ids(row["ranked"], row["control"], row["data"], row["n_ids"])
                lengths = np.array(row["lengths"], np.int64)
                starts = np.cumsum(lengths) - lengths
                crc = [zlib.crc32(ids[a:a + n].tobytes()) for a, n in zip(starts.tolist(), lengths.tolist(), strict=True)]
                n = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["range_no"]] * n, pa.int32()), pa.array([row["block_no"]] * n, pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                     pa.array(starts), pa.array(lengths), pa.array(crc, pa.int64())],
                    names=["range_no", "block_no", "doc_id", "inside", "n_tokens", "ids_crc32"])

    found = files.mapInArrow(decode, "range_no int, block_no int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    # running sums over blocks inside a range, and over the ranges, of which there are at most MAX_RANGES
    sizes = files.select("range_no", "block_no", "n_ids")
    inside = Window.partitionBy("range_no").orderBy("block_no").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy(F.lit(0)).orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    ranges = sizes.groupBy("range_no").agg(F.sum("n_ids").alias("n")).select("range_no", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("earlier"))
    starts = sizes.withColumn("before", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(ranges, "range_no").select(
        "range_no", "block_no", (F.col("before") + F.col("earlier")).alias("before"))
    return found.join(starts, ["range_no", "block_no"]).select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def through_files(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Writes token files to the shared folder and reads them back: one row per input row."""
    path = shared_path(docs.sparkSession, "token-files")
    write_token_files(docs, tokenizer, path, end_id)
    return read_token_files(docs.sparkSession.read.parquet(path))
