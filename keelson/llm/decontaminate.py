"""Benchmark passages in documents, found by one Aho-Corasick automaton over all windows of the benchmark's items.

Texts are normalised the same way on both sides: A-Z lower-cased, words (runs of ASCII digits, letters and any character
beyond ASCII) joined by single spaces. A pattern is a window of consecutive item words with a space on either side, so
that it can match whole words only. The automaton runs once over the normalised bytes of many documents at a time; an
array of positions maps what it finds back to the original text.

An automaton's windows come from a share of the items of checked size. A benchmark beyond that size is dealt to several
automata, each of which scans all texts; their findings are joined by document. Items themselves never leave Spark whole:
long ones are cut into overlapping runs of words first.

Defined cases: null and empty texts have no words and no hits, on either side. Every row is judged, also rows that share an
id or have none. An item without ``item_id`` marks words but is not listed. Items with equal ids are one item.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.words import give_back, text_slices
from keelson.session import bounded_collect, release, stored

WORDS = 10
#: characters of normalised item text for one automaton; a window of ten words repeats each character about ten times
AUTOMATON_CHARS = 1 << 20
#: words of an item in one row
RUN_WORDS = 2000
#: bytes as they stand in normalised text; 0x20 for all that is not part of a word
PLAIN = np.full(256, 0x20, np.uint8)
PLAIN[0x30:0x3A] = np.arange(0x30, 0x3A)
PLAIN[0x61:0x7B] = PLAIN[0x41:0x5B] = np.arange(0x61, 0x7B)
PLAIN[0x80:] = np.arange(0x80, 0x100)
SPAN = ["first_word", "end_word", "start", "end"]
SCHEMA = f"n_words long, n_hit long, item_ids array<long>, spans array<struct<{', '.join(f'{f}:long' for f in SPAN)}>>"


def normalise(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, place of each in ``data``, place where each text begins) of texts one after another.

    A text is " w1 w2 ... wn " with single spaces, and always ends in two spaces, so that no pattern reaches across texts.
    """
    n, texts = len(data), len(offsets) - 1
    mapped = PLAIN[data]
    # two spaces follow each text, one comes before; then runs of spaces inside shrink to one
    shift = 3 * np.arange(texts)
    owner_shift = np.repeat(shift + 1, np.diff(offsets))
    wide = np.full(n + 3 * texts, 0x20, np.uint8)
    origin = np.zeros(n + 3 * texts, np.int64)
    at = np.arange(n) + owner_shift
    wide[at], origin[at] = mapped, np.arange(n)
    ends = offsets[1:] + shift + 1
    origin[ends], origin[ends + 1], origin[offsets[:-1] + shift] = offsets[1:], offsets[1:], offsets[:-1]
    solid = wide != 0x20
    keep = solid.copy()
    keep[1:] |= solid[:-1]
    keep[offsets[:-1] + shift] = keep[ends + 1] = True
    places = np.flatnonzero(keep)
    return wide[places], origin[places], np.searchsorted(places, offsets[:-1] + shift)


def item_runs(benchmark: DataFrame, words: int = WORDS) -> DataFrame:
    """``item_id, run``: normalised words of items, long ones in runs that overlap by a window less a word."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, runs = [], []
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
                data = np.frombuffer((text or "").encode(), np.uint8)
                found = normalise(data, np.array([0, len(data)]))[0].tobytes().split()
                for i in range(0, max(len(found) - words + 1, min(len(found), 1)), RUN_WORDS):
                    ids.append(item)
                    runs.append(b" ".join(found[i:i + RUN_WORDS + words - 1]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(runs, pa.binary())], names=["item_id", "run"])

    return benchmark.select(F.col("item_id").cast("long"), "text").mapInArrow(cut, "item_id long, run binary")


class Automaton:
    """Windows of item words with the items they stand in."""

    def __init__(self, runs: list[tuple[int | None, bytes]], words: int) -> None:
        import ahocorasick

        self.items: list[set[int]] = []
        self.machine = ahocorasick.Automaton()
        for item, run in runs:
            found = run.decode("latin-1").split(" ")
            for i in range(max(len(found) - words + 1, 1)):
                window = f" {' '.join(found[i:i + words])} "
                known = self.machine.get(window, None)
                if known is None:
                    known = (len(self.items), len(window))
                    self.machine.add_word(window, known)
                    self.items.append(set())
                if item is not None:
                    self.items[known[0]].add(item)
        if len(self.items):
            self.machine.make_automaton()

    def matches(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, first place, place after the last) of every occurrence."""
        if not self.items:
            return (np.empty(0, np.int64),) * 3
        found = [(window, end + 1 - length, end + 1) for end, (window, length) in self.machine.iter(data.tobytes().decode("latin-1"))]
        return tuple(np.array(found, np.int64).reshape(-1, 3).T)


@lru_cache(maxsize=1)
def automaton(runs: tuple[tuple[int | None, bytes], ...], words: int) -> Automaton:
    """One per worker process, so it serves all tasks of the process."""
    return Automaton(list(runs), words)


def scan(data: np.ndarray, offsets: np.ndarray, machine: Automaton) -> tuple[np.ndarray, np.ndarray, list[list[int]], list[list[tuple[int, ...]]]]:
    """(words, hit words, items, hit spans) of each text.

    A span is a run of hit words: numbers of its first word and of the word after it, and code points of the original text
    where it starts and ends (exclusive).
    """
    texts = len(offsets) - 1
    plain, origin, begins = normalise(data, offsets)
    solid = plain != 0x20
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last)
    owner = np.searchsorted(begins, starts, side="right") - 1
    n_words = np.bincount(owner, minlength=texts)
    window, left, right = machine.matches(plain)
    items: list[list[int]] = [[] for _ in range(texts)]
    spans: list[list[tuple[int, ...]]] = [[] for _ in range(texts)]
    if not len(window):
        return n_words, np.zeros(texts, np.int64), items, spans
    depth = np.cumsum(np.bincount(left, minlength=len(plain) + 1) - np.bincount(right, minlength=len(plain) + 1))
    hit = depth[starts] > 0
    n_hit = np.bincount(owner[hit], minlength=texts)
    text_of = np.searchsorted(begins, left, side="right") - 1
    for text, w in np.unique(np.stack([text_of, window], axis=1), axis=0).tolist():
        items[text].extend(machine.items[w])
    # a run of hit words is a span; places in bytes become places in code points
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    joined = np.zeros(len(starts), bool)
    joined[1:] = hit[1:] & hit[:-1] & (owner[1:] == owner[:-1])
    opens = np.flatnonzero(hit & ~joined)
    closes = np.flatnonzero(hit & ~np.append(joined[1:], False))
    word_base, point_base = (np.cumsum(n_words) - n_words)[owner[opens]], points[offsets[owner[opens]]]
    bounds = np.stack([opens - word_base, closes + 1 - word_base, points[origin[starts[opens]]] - point_base,
                       points[origin[stops[closes]] + 1] - point_base], axis=1)
    for text, span in zip(owner[opens].tolist(), bounds.tolist()):
        spans[text].append(tuple(span))
    return n_words, n_hit, [sorted(set(i)) for i in items], spans


def scan_documents(docs: DataFrame, runs: list[tuple[int | None, bytes]], words: int = WORDS, keep: list[str] | None = None,
                   only_hits: bool = False) -> DataFrame:
    """``keep`` columns with words, hits, items and spans by one automaton; ``only_hits`` leaves out rows without a hit."""
    keep = keep or ["doc_id"]
    sent = docs.sparkSession.sparkContext.broadcast(tuple(runs))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(sent.value, words)
        for batch in batches:
            for row, data, offsets in text_slices(batch.column("text")):
                n_words, n_hit, items, spans = scan(data, offsets, machine)
                held = [c.slice(row, len(n_words)) for c in batch.columns[:len(keep)]]
                typed = pa.array([[dict(zip(SPAN, s, strict=True)) for s in found] for found in spans], pa.list_(pa.struct([(f, pa.int64()) for f in SPAN])))
                out = pa.RecordBatch.from_arrays([*held, pa.array(n_words), pa.array(n_hit), pa.array(items, pa.list_(pa.int64())), typed],
                                                 names=[*keep, "n_words", "n_hit", "item_ids", "spans"])
                yield out.filter(pa.array(n_hit > 0)) if only_hits else out
        give_back()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields)
    return docs.select(*keep, "text").mapInArrow(find, f"{fields}, {SCHEMA}")


def _digest() -> Column:
    return F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest")


def find_passages(docs: DataFrame, benchmark: DataFrame, words: int = WORDS, automaton_chars: int = AUTOMATON_CHARS) -> DataFrame:
    """``doc_id, n_words, n_hit, item_ids, spans``: one row per document.

    ``item_ids`` are the items with an occurring window, ascending; ``spans`` the hit passages in order, see ``scan``.
    """
    runs = stored(item_runs(benchmark, words), "item-runs")
    size = F.sum(F.length("run") + 1)
    shares = max(1, -(-(runs.agg(size).first()[0] or 0) // automaton_chars))
    number = F.lit(0)
    while shares > 1:  # hashing deals unevenly: more shares until each fits, or is a single run
        number = F.pmod(F.xxhash64("item_id", "run"), F.lit(shares))
        fullest = runs.groupBy(number.alias("share")).agg(size.alias("size"), F.count(F.lit(1)).alias("n"))
        if fullest.where((F.col("size") > automaton_chars) & (F.col("n") > 1)).isEmpty():
            break
        shares *= 2
    found = [_by_automaton(docs, runs.where(number == i), words, automaton_chars, shares > 1) for i in range(shares)]
    release(runs)
    return found[0] if shares == 1 else _together(docs, reduce(DataFrame.unionByName, found))


def _by_automaton(docs: DataFrame, share: DataFrame, words: int, limit: int, several: bool) -> DataFrame:
    """Findings of one automaton; of several, those of the distinct texts with a hit, written."""
    rows = [(r["item_id"], bytes(r["run"])) for r in bounded_collect(share, limit, "item runs of one automaton")]
    rows.sort(key=lambda r: (r[0] is None, r))
    if not several:
        return scan_documents(docs, rows, words)
    texts = docs.select(_digest(), "text")
    return stored(scan_documents(texts, rows, words, ["digest"], only_hits=True).dropDuplicates(["digest"]), "passages")


def _together(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Findings of several automata for each document: items united, overlapping or adjacent spans joined.

    A row's result depends on its text alone, so findings are joined by the text's digest.
    """
    empty = F.expr(f"CAST(array() AS {SCHEMA.split('spans ')[1]})")
    merged = F.aggregate(F.array_sort(F.flatten(F.collect_list("spans"))), empty, lambda acc, s: F.when(
        (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end_word"] >= s["first_word"]),
        F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(
            F.try_element_at(acc, F.lit(-1))["first_word"].alias("first_word"), F.greatest(F.try_element_at(acc, F.lit(-1))["end_word"], s["end_word"]).alias("end_word"),
            F.try_element_at(acc, F.lit(-1))["start"].alias("start"), F.greatest(F.try_element_at(acc, F.lit(-1))["end"], s["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(s))))
    hits = found.groupBy(F.col("digest").alias("hit_digest")).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("items"), merged.alias("hit_spans"))
    counted = scan_documents(docs.select("doc_id", _digest(), "text"), [], WORDS, ["doc_id", "digest"])
    joined = counted.join(hits, counted["digest"] == hits["hit_digest"], "left")
    return joined.select("doc_id", "n_words", F.coalesce(F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end_word"] - s["first_word"]), "n_hit").alias("n_hit"),
                         F.coalesce("items", "item_ids").alias("item_ids"), F.coalesce("hit_spans", "spans").alias("spans"))
