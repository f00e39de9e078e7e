"""Alignment of two tokenizers over whole texts: groups of tokens with equal bytes, and how often tokens overlap.

Both tokenizations of a text cover the same bytes. Places where a token ends on both sides cut them into groups; a link is
a pair of token occurrences whose bytes overlap. The overlap of two tokens lies between two neighbouring token ends of
either side, so the links of a text are the pieces between the distinct ends, found by two binary searches.

Most groups are one token on each side with the same bytes. For these the second id follows from the first by an array
made once from the vocabularies (``same_bytes``), so they are counted in a vector as long as the first vocabulary. Only the
links of other groups become pairs. A block of some megabytes of text numbers its distinct pairs; a document keeps numbers,
and each pair of a block crosses the shuffle once with its count and comes back once with its count over all blocks. What
reaches the driver is bounded by the vocabularies: a vector for each.

Defined cases: a text that is null, empty, or whose tokens do not spell its bytes on either side has no tokens: zeros and
an empty digest. Every row has a result, also rows that share an id or have none; equal rows count each.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.words import give_back
from keelson.session import bounded_collect, release, stored

SLICE_CHARS = 1 << 19
BLOCK_CHARS = 1 << 23
BLOCK_ROWS = 100_000
CACHE_ENTRIES = 300_000
LIBRARY_CHUNKS = 1000
#: an optional space with what follows up to white space, or white space: the splitting pattern never looks across these
CHUNK = re.compile(r" ?[^\t\n\r ]+|[\t\n\r ]+(?![^\t\n\r ])|[\t\n\r ]+")
#: a text with anything but printable Latin-1, tabs and line breaks goes to the library whole
OTHER = re.compile(r"[^\t\n\r -~\xa1-\xff]")
DOCUMENT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, groups_sha256 string"
PACKED = f"block long, {DOCUMENT}, ones binary, odd binary, place int, a int, b int, same boolean, n long"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string, groups_sha256 string"


def byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Aligner:
    """Both tokenizers, the bytes of their ids, and the array of equal bytes."""

    def __init__(self, byte_level: str, pieces: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(byte_level)
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_file=pieces)
        alphabet, vocabulary = byte_of_char(), self.first.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(map(alphabet.__getitem__, token)) if alphabet.keys() >= set(token) else token.encode()
        names = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        self.b_bytes = [bytes([int(name[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", name) else name.replace("\u2581", " ").encode() for name in names]
        self.a_length, self.b_length = (np.array([len(t) for t in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        ids = {t: i for i, t in enumerate(self.b_bytes) if t}
        #: the second id with the same bytes as each first id, -1 without one; of several the last, the others are pairs
        self.same_bytes = np.array([ids.get(t, -1) for t in self.a_bytes], np.int64)
        #: ids as text with the mark that follows them; ids of the second side come after all of the first
        self.written = [f"{i}{mark}".encode() for side in (self.a_bytes, self.b_bytes) for mark in (",", "|", ";", "") for i in range(len(side))]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def first_ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of a space and the text. Chunks of plain texts are encoded once and kept in a bounded table."""
        spaced = [f" {t}" for t in texts]
        chunks = [CHUNK.findall(t) if OTHER.search(t) is None else None for t in spaced]
        wanted = set().union(*(c for c in chunks if c is not None))
        missing = wanted.difference(self.known)
        if missing:
            if len(self.known) + len(missing) > CACHE_ENTRIES:  # keep one older generation, so frequent chunks survive
                self.older, self.known = self.known, {c: self.known[c] for c in wanted - missing}
            self.known.update((c, self.older[c]) for c in missing if c in self.older)
            new = [c for c in missing if c not in self.known]
            self._learn(new)
        get = self.known.__getitem__
        return [np.frombuffer(b"".join(map(get, c)) if c is not None else self._library([t])[0], "<u4") for c, t in zip(chunks, spaced, strict=True)]

    def _learn(self, chunks: list[str]) -> None:
        """Encodes new chunks. Those of a space and more are encoded many at once, as in a text; their bytes tell where each one's ids end."""
        spaced = [c for c in chunks if len(c) > 1 and c[0] == " " and c[1] not in "\t\n\r "]
        alone = list(set(chunks).difference(spaced))
        for at in range(0, len(spaced), LIBRARY_CHUNKS):
            some = spaced[at:at + LIBRARY_CHUNKS]
            data = self._library(["".join(some)])[0]
            ends = np.cumsum(self.a_length[np.frombuffer(data, "<u4")])
            wanted = np.cumsum([len(c.encode()) for c in some])
            last = np.searchsorted(ends, wanted)
            if len(ends) == 0 or ends[-1] != wanted[-1] or (ends[last] != wanted).any():  # a token across two chunks
                alone += some
                continue
            cuts = (4 * (last + 1)).tolist()
            self.known.update(zip(some, [data[a:b] for a, b in zip([0, *cuts], cuts)], strict=True))
        self.known.update(zip(alone, self._library(alone), strict=True))

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.first.encode_batch_fast(texts, add_special_tokens=False)]

    def second_ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, "<u4") for ids in self.second.encode(texts, num_threads=1)]

    def align(self, texts: list[str]) -> Alignment:
        """Alignment of some texts at once; all arrays run over the texts one after another."""
        first, second = self.first_ids(texts), self.second_ids(texts)
        whole = [bool(t) and self._spells(a, b, f" {t}".encode()) for t, a, b in zip(texts, first, second, strict=True)]
        none = np.empty(0, "<u4")
        first, second = ([ids if fits else none for ids, fits in zip(side, whole, strict=True)] for side in (first, second))
        n_a, n_b = (np.array([len(ids) for ids in side], np.int64) for side in (first, second))
        a, b = (np.concatenate([none, *side]).astype(np.int64) for side in (first, second))
        a_end, b_end = np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
        both = np.sort(np.concatenate([a_end, b_end]), kind="stable")
        twice = np.append(both[1:] == both[:-1], False)[:len(both)]
        cuts, ends = both[twice], both[~twice]
        text_end = np.concatenate([[0], a_end])[np.cumsum(n_a)]  # a text without tokens ends where it begins
        text_of_link = np.searchsorted(text_end, ends)  # of texts with equal ends the first one has the tokens
        group_of_link = np.searchsorted(cuts, ends)
        a_of_link, b_of_link = a[np.searchsorted(a_end, ends)], b[np.searchsorted(b_end, ends)]
        single = np.bincount(group_of_link, minlength=len(cuts))[group_of_link] == 1
        same = single & (self.same_bytes[a_of_link] == b_of_link)
        n = len(texts)
        return Alignment(n_a, n_b, np.bincount(np.searchsorted(text_end, cuts), minlength=n), np.bincount(text_of_link, minlength=n),
                         a_of_link[same], np.bincount(text_of_link[same], minlength=n),
                         a_of_link[~same] * len(self.b_bytes) + b_of_link[~same], np.bincount(text_of_link[~same], minlength=n),
                         self._written(a, b, a_end, b_end, cuts, n_a, n_b))

    def _spells(self, a: np.ndarray, b: np.ndarray, data: bytes) -> bool:
        return (int(self.a_length[a].sum()) == len(data) == int(self.b_length[b].sum())
                and b"".join(map(self.a_bytes.__getitem__, a.tolist())) == data == b"".join(map(self.b_bytes.__getitem__, b.tolist())))

    def _written(self, a: np.ndarray, b: np.ndarray, a_end: np.ndarray, b_end: np.ndarray, cuts: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> list[bytes]:
        """Groups of each text as written ids: ``a,a|b;a|b,b``."""
        a_group, b_group = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)
        a_before = np.cumsum(np.bincount(a_group, minlength=len(cuts)))
        b_before = np.cumsum(np.bincount(b_group, minlength=len(cuts)))
        codes = np.empty(len(a) + len(b), np.int64)
        a_mark = (a_end == cuts[a_group]).astype(np.int64)
        b_mark = 2 * (b_end == cuts[b_group])
        b_mark[np.cumsum(n_b)[n_b > 0] - 1] = 3
        codes[np.arange(len(a)) + np.concatenate([[0], b_before])[a_group]] = a + a_mark * len(self.a_bytes)
        codes[np.arange(len(b)) + a_before[b_group]] = b + b_mark * len(self.b_bytes) + 4 * len(self.a_bytes)
        parts = list(map(self.written.__getitem__, codes.tolist()))
        bounds = np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
        return [b"".join(parts[s:e]) for s, e in zip(bounds, bounds[1:])]


@dataclass(frozen=True)
class Alignment:
    """Of each text: tokens, groups, links, written groups; of all links in order: those of one-to-one groups with equal
    bytes by first id, the others by pair key (first id * size of the second vocabulary + second id)."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    ones: np.ndarray
    n_ones: np.ndarray
    odd: np.ndarray
    n_odd: np.ndarray
    groups: list[bytes]


@lru_cache(maxsize=1)
def aligner(byte_level: str, pieces: str) -> Aligner:
    """One per worker process and pair of files."""
    return Aligner(byte_level, pieces)


class Block:
    """Documents of a block and its pairs, numbered when it is full."""

    def __init__(self, number: int, keep_groups: bool) -> None:
        self.number, self.keep_groups = number, keep_groups
        self.rows: list[tuple] = []
        self.odd: list[np.ndarray] = []
        self.chars = 0

    def add(self, ids: list[int | None], texts: list[str], found: Alignment) -> None:
        ones = np.split(found.ones.astype("<u4"), np.cumsum(found.n_ones)[:-1])
        self.odd += np.split(found.odd, np.cumsum(found.n_odd)[:-1])
        self.chars += sum(map(len, texts))
        numbers = np.stack([found.n_a, found.n_b, found.n_groups, found.n_links], axis=1).tolist()
        for i, n, one, groups in zip(ids, numbers, ones, found.groups, strict=True):
            self.rows.append((i, *n, groups.decode() if self.keep_groups else None, hashlib.sha256(groups).hexdigest() if n[0] else "", one.tobytes()))

    def batches(self, coder: Aligner) -> Iterator[pa.RecordBatch]:
        keys, places, counts = np.unique(np.concatenate([np.empty(0, np.int64), *self.odd]), return_inverse=True, return_counts=True)
        odd = [p.astype("<u4").tobytes() for p in np.split(places.ravel(), np.cumsum([len(o) for o in self.odd])[:-1])] if self.odd else []
        columns = [list(c) for c in zip(*self.rows)] or [[] for _ in range(8)]
        yield packed(block=[self.number] * len(odd), **dict(zip("doc_id n_a n_b n_groups n_links groups groups_sha256 ones".split(), columns, strict=True)), odd=odd)
        a, b = np.divmod(keys, len(coder.b_bytes))
        yield packed(block=np.full(len(keys), self.number), place=np.arange(len(keys)), a=a, b=b, same=coder.same_bytes[a] == b, n=counts)


def packed(**columns) -> pa.RecordBatch:
    """A batch of the packed table; columns that are not given are null."""
    size = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in PACKED_TYPES],
                                      names=PACKED_TYPES.names)


_ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
PACKED_TYPES = pa.schema([(name, _ARROW[kind]) for name, kind in (f.split() for f in PACKED.split(", "))])


def pack(docs: DataFrame, byte_level: str, pieces: str, keep_groups: bool, block_chars: int) -> DataFrame:
    """The packed table: rows of documents, of each block's pairs (with ``place``), and of each task's one-to-one counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = aligner(byte_level, pieces)
        ones = np.zeros(len(coder.a_bytes), np.int64)
        base, number = TaskContext.get().partitionId() << 32, 0
        block = Block(base, keep_groups)
        for batch in batches:
            at, texts = 0, [t or "" for t in batch.column("text").to_pylist()]
            ids = batch.column("doc_id").to_pylist()
            while at < len(texts):
                end, chars = at, 0
                while end < len(texts) and (end == at or chars + len(texts[end]) <= SLICE_CHARS):
                    chars += len(texts[end])
                    end += 1
                found = coder.align(texts[at:end])
                ones += np.bincount(found.ones, minlength=len(ones))
                block.add(ids[at:end], texts[at:end], found)
                at = end
                if block.chars >= block_chars or len(block.rows) >= BLOCK_ROWS:
                    yield from block.batches(coder)
                    number += 1
                    block = Block(base + number, keep_groups)
        yield from block.batches(coder)
        seen = np.flatnonzero(ones)
        yield packed(a=seen, b=coder.same_bytes[seen], same=np.ones(len(seen), bool), n=ones[seen])
        give_back()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PACKED)


@dataclass(frozen=True)
class Aligned:
    """``documents``: one row per input row. ``pairs``: (a, b, n, best) of every pair of ids linked anywhere, with the number
    of links and whether it is the most frequent of its second id."""

    documents: DataFrame
    pairs: DataFrame


def align_documents(docs: DataFrame, byte_level: str, pieces: str, keep_groups: bool = False, block_chars: int = BLOCK_CHARS) -> Aligned:
    """Aligns every text; ``keep_groups`` also returns the written groups themselves."""
    table = stored(pack(docs, byte_level, pieces, keep_groups, block_chars), "alignment")
    counts = table.where("a IS NOT NULL").groupBy("a", "b").agg(F.sum("n").alias("n"), F.first("same").alias("same"))
    counts = stored(counts, "pair-counts")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))  # as long as the second vocabulary at most
    pairs = stored(counts.join(F.broadcast(most), "b").select("a", "b", "n", "same", (F.col("n") == F.col("most")).alias("best")), "pairs")
    release(counts)
    size = len(aligner(byte_level, pieces).a_bytes)
    ones, ones_best = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for r in bounded_collect(pairs.where("same").select("a", "n", "best"), size, "pairs of equal bytes"):
        ones[r["a"]], ones_best[r["a"]] = r["n"], r["best"]

    def rate(left: pa.Table, right: pa.Table) -> pa.Table:
        n, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
        place = right.column("place").to_numpy()
        n[place], best[place] = right.column("n").to_numpy(), right.column("best").to_numpy().astype(np.int64)
        sums, bests = [], []
        for one, odd in zip(left.column("ones").to_pylist(), left.column("odd").to_pylist()):
            one, odd = np.frombuffer(one, "<u4"), np.frombuffer(odd, "<u4")
            sums.append(int(ones[one].sum() + n[odd].sum()))
            bests.append(int(ones_best[one].sum() + best[odd].sum()))
        held = {c: left.column(c) for c in left.column_names}
        return pa.table({**held, "n_best": pa.array(bests, pa.int64()), "count_sum": pa.array(sums, pa.int64())}).select([f.split()[0] for f in RESULT.split(", ")])

    asked = table.where("place IS NOT NULL").select("block", "place", "a", "b")
    answers = asked.join(pairs, ["a", "b"]).select(F.col("block").alias("asking"), "place", "n", "best")
    rows = table.where("groups_sha256 IS NOT NULL").select("block", *[f.split()[0] for f in DOCUMENT.split(", ")], "ones", "odd")
    documents = rows.groupBy("block").cogroup(answers.groupBy("asking")).applyInArrow(rate, RESULT)
    return Aligned(documents if keep_groups else documents.drop("groups"), pairs.drop("same"))
