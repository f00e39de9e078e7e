"""Byte-level BPE by monoid tree reduction.

A piece of text is encoded by halves: each half recursively, down to ``LEAF`` bytes that are merged directly. Joining two
encodings re-encodes a window of tokens around the boundary. The outer tokens are final once the window's first token and
the token before it, and its last token and the token after it, are stable pairs: encoding their bytes together gives the
same two tokens. A sequence is the encoding of its bytes exactly when all its neighbours are stable pairs, and all pairs
inside the halves and inside the window are. Else the window grows on the side that failed, twice as far each time.

Decoding concatenates token bytes up a tree of the same shape.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

LEAF = 32
CACHE_ENTRIES = 400_000
PAIRS = 200_000
#: white space as the rank files' splitting pattern means it
WHITE = "\t-\r \x85\xa0  -     　"
#: an optional space with what follows up to white space, or white space: the splitting pattern never looks across these
CHUNK = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class ByteBpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import regex

        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.pattern = regex.compile(pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]"))
        self.id_bytes = {rank: np.array([rank], "<u4").tobytes() for rank in self.bytes_of}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    def merge(self, data: bytes) -> list[int]:
        """Ids of bytes by repeatedly merging the neighbours of lowest rank, leftmost first."""
        return self._merge_short(data) if len(data) <= 2 * LEAF else self._merge_long(data)

    def _merge_short(self, data: bytes) -> list[int]:
        rank, never = self.ranks.get, len(self.ranks)
        cuts = list(range(len(data) + 1))
        pairs = [rank(data[i:i + 2], never) for i in range(len(data) - 1)]
        while pairs and (lowest := min(pairs)) < never:
            i = pairs.index(lowest)
            del pairs[i], cuts[i + 1]
            if i:
                pairs[i - 1] = rank(data[cuts[i - 1]:cuts[i + 1]], never)
            if i < len(pairs):
                pairs[i] = rank(data[cuts[i]:cuts[i + 2]], never)
        return [self.ranks[data[a:b]] for a, b in zip(cuts, cuts[1:])]

    def _merge_long(self, data: bytes) -> list[int]:
        n, ranks = len(data), self.ranks
        ends, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive, heap = [True] * n, []
        for i in range(n - 1):
            if (rank := ranks.get(data[i:i + 2])) is not None:
                heap.append((rank, i, i + 2))
        heapq.heapify(heap)
        while heap:
            rank, i, end = heapq.heappop(heap)
            j = ends[i]
            if not alive[i] or j >= n or ends[j] != end or not alive[j]:
                continue
            alive[j], ends[i] = False, end
            if end < n:
                before[end] = i
                if (rank := ranks.get(data[i:ends[end]])) is not None:
                    heapq.heappush(heap, (rank, i, ends[end]))
            if (p := before[i]) >= 0 and (rank := ranks.get(data[p:end])) is not None:
                heapq.heappush(heap, (rank, p, end))
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i:ends[i]]])
            i = ends[i]
        return out

    def stable(self, a: int, b: int) -> bool:
        found = self.pairs.get((a, b))
        if found is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            found = self.pairs[a, b] = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return found

    def join(self, left: list[int], right: list[int]) -> list[int]:
        i = j = 1
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            window = self.merge(b"".join(map(self.bytes_of.__getitem__, left[len(left) - i:] + right[:j])))
            before = i == len(left) or self.stable(left[-i - 1], window[0])
            after = j == len(right) or self.stable(window[-1], right[j])
            if before and after:
                return left[:len(left) - i] + window + right[j:]
            i, j = i if before else 2 * i, j if after else 2 * j

    def tree(self, data: bytes) -> list[int]:
        if len(data) <= LEAF:
            return self.merge(data)
        middle = len(data) // 2
        return self.join(self.tree(data[:middle]), self.tree(data[middle:]))

    def piece(self, data: bytes) -> list[int]:
        """Ids of one match of the splitting pattern; a match that is a token is that token."""
        rank = self.ranks.get(data)
        return self.tree(data) if rank is None else [rank]

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers; chunks are kept in a bounded table."""
        chunks = CHUNK.findall(text)
        for chunk in set(chunks).difference(self.known):
            if len(self.known) >= CACHE_ENTRIES:  # keep one older generation, so frequent chunks survive
                self.older, self.known = self.known, {c: self.known[c] for c in set(chunks) if c in self.known}
            found = self.older.get(chunk)
            self.known[chunk] = self._chunk(chunk) if found is None else found
        return b"".join(map(self.known.__getitem__, chunks))

    def _chunk(self, chunk: str) -> bytes:
        return b"".join([self.id_bytes[i] for m in self.pattern.findall(chunk) for i in self.piece(m.encode())])

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of ids, joined in pairs up a tree."""
        level = [b"".join(map(self.bytes_of.__getitem__, ids[i:i + 64])) for i in range(0, len(ids), 64)] or [b""]
        while len(level) > 1:
            level = [b"".join(level[i:i + 2]) for i in range(0, len(level), 2)]
        return level[0]


@lru_cache(maxsize=2)
def byte_bpe(path: str, pattern: str) -> ByteBpe:
    """One per worker process, file and pattern."""
    return ByteBpe(read_ranks(path), pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids`` for every row, ids as little-endian unsigned 32-bit integers; a null text is empty."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_bpe(path, pattern)
        for batch in batches:
            ids = [coder.encode(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` from ids; the decoded bytes are those of the text in UTF-8."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_bpe(path, pattern)
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            decoded = [hashlib.sha256(coder.decode(np.frombuffer(i, "<u4").tolist())).hexdigest() for i in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array([hashlib.sha256(i).hexdigest() for i in ids]),
                 pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encoded.mapInArrow(decode, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encodes every text and decodes the ids again: one row per input row, whatever its id."""
    return decode_documents(encode_documents(docs, path, pattern), path, pattern)
