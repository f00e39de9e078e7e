"""Importance resampling: documents weighted by target against raw n-gram models, drawn by Gumbel top-k.

Two generative models over hashed n-grams are counted: one of the target (documents labelled good), one of all raw
documents. A document's log weight is the mean over its n-grams of ``log p_target - log p_raw``, taken as if every document
had ``LENGTH`` n-grams, since a sum would order documents by length first. The n-grams are byte
trigrams, hashed into ``BUCKETS`` buckets, and trigrams of word repetition (each word new, equal to the last word, or to
the one before), which byte trigrams cannot see. Adding standard Gumbel noise to the log weights and keeping the k largest
sums is sampling without replacement in proportion to the weights. By default k is the number of documents above the log
weight that best separates those labelled good from those labelled bad.

Counting the raw model covers every n-gram of every document. The target model is fitted on a bounded sample of labelled
documents: the ``sample`` good ones with the smallest hashed ids, a list small enough to be part of the task closure.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.words import free_names, give_back, text_slices, word_hashes
from keelson.session import bounded_collect, release, stored

BUCKETS = 1 << 16
REPEATS = 27
SMOOTHING = 1.0
SAMPLE = 20_000
LENGTH = 200
LOWEST, HIGHEST = -4000, 1000
SEED = 11


def ngram_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every n-gram, n-grams per text): byte trigrams of all texts first, then repetition trigrams."""
    texts, lengths = len(offsets) - 1, np.diff(offsets)
    if len(data) >= 3:
        d = data.astype(np.uint32)
        three = ((d[:-2] | d[1:-1] << np.uint32(8) | d[2:] << np.uint32(16)) * np.uint32(2654435761)) >> np.uint32(16)
        inside = np.ones(len(three), bool)
        for back in (1, 2):  # trigrams that run over a text's end
            at = offsets[1:-1] - back
            inside[at[(at >= 0) & (at < len(three))]] = False
        codes, per_text = three[inside].astype(np.int64), np.maximum(lengths - 2, 0)
    else:
        codes, per_text = np.empty(0, np.int64), np.zeros(texts, np.int64)
    words, counts = word_hashes(data, offsets)
    state, place = np.zeros(len(words), np.int64), np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
    for back, value in ((2, 2), (1, 1)):
        same = np.flatnonzero(words[back:] == words[:-back]) + back if len(words) > back else np.empty(0, np.int64)
        state[same[place[same] >= back]] = value
    repeats = np.empty(0, np.int64)
    if len(words) > 2:
        repeats = (BUCKETS + state[:-2] * 9 + state[1:-1] * 3 + state[2:])[place[2:] >= 2]
    return np.concatenate([codes, repeats]), np.stack([per_text, np.maximum(counts - 2, 0)])


def _owners(counts: np.ndarray) -> np.ndarray:
    """Text number of each n-gram in the order of ``ngram_codes``."""
    texts = np.arange(counts.shape[1])
    return np.concatenate([np.repeat(texts, counts[0]), np.repeat(texts, counts[1])])


def target_sample(labels: DataFrame, sample: int = SAMPLE, seed: int = SEED) -> list[int]:
    """Ids of at most ``sample`` documents labelled good, those with the smallest hashes."""
    ids = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    chosen = ids.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(sample)
    return sorted(r["doc_id"] for r in bounded_collect(chosen, sample, "labelled sample"))


def fit(docs: DataFrame, target_ids: list[int], smoothing: float = SMOOTHING) -> np.ndarray:
    """Log ratio per bucket of the target's and the raw model's smoothed probability; repetition has its own total."""
    size, wanted = BUCKETS + REPEATS, np.array(target_ids, np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            ids = batch.column("doc_id").fill_null(-1).to_numpy(zero_copy_only=False)
            good = np.isin(ids, wanted) & ~np.asarray(batch.column("doc_id").is_null())
            for row, data, offsets in text_slices(batch.column("text")):
                codes, counts = ngram_codes(data, offsets)
                raw += np.bincount(codes, minlength=size)
                picked = good[row:row + len(offsets) - 1]
                if picked.any():
                    target += np.bincount(codes[picked[_owners(counts)]], minlength=size)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(raw[seen]), pa.array(target[seen])], names=["bucket", "raw", "target"])
        give_back()

    parts = docs.select("doc_id", "text").mapInArrow(count, "bucket long, raw long, target long")
    totals = parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.zeros(size), np.zeros(size)
    for r in bounded_collect(totals, size, "n-gram buckets"):
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    ratio = np.empty(size)
    for part in (slice(0, BUCKETS), slice(BUCKETS, size)):
        p, q = target[part] + smoothing, raw[part] + smoothing
        ratio[part] = np.log(p / p.sum()) - np.log(q / q.sum())
    return ratio


def weigh(docs: DataFrame, ratio: np.ndarray, n_ngrams: str = "n_ngrams", log_weight: str = "log_weight") -> DataFrame:
    """Adds the number of n-grams and the log weight (null without n-grams) to documents; one row per input row."""
    names = docs.columns

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, weight = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for row, data, offsets in text_slices(batch.column("text")):
                codes, counts = ngram_codes(data, offsets)
                end = row + len(offsets) - 1
                total[row:end] = counts.sum(axis=0)
                weight[row:end] = np.bincount(_owners(counts), weights=ratio[codes], minlength=end - row) * LENGTH / np.maximum(total[row:end], 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(total), pa.array(weight, mask=total == 0)], names=[*names, n_ngrams, log_weight])
        give_back()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(score, f"{schema}, `{n_ngrams}` long, `{log_weight}` double")


def gumbel_key(weight: Column, doc_id: Column, seed: int = SEED) -> Column:
    """Log weight plus standard Gumbel noise that depends on the id alone, so retried tasks draw the same; null without an id."""
    uniform = (F.pmod(F.xxhash64(doc_id, F.lit(seed), F.lit("gumbel")), F.lit(1 << 53)) + F.lit(0.5)) / F.lit(float(1 << 53))
    return F.when(doc_id.isNotNull(), weight - F.log(-F.log(uniform)))


def kth_largest(df: DataFrame, key: str, tie: str, k: int) -> tuple[float, int] | None:
    """(key, tie) of the row that is k-th by descending key, ascending tie; None for k < 1.

    Quantiles bracket the rank; only the bracket, a few thousandths of the rows, is put in order.
    """
    rows = df.where(F.col(key).isNotNull())
    total = rows.count()
    k = min(k, total)
    if k < 1:
        return None
    p = 1 - k / total
    low, high = rows.agg(F.percentile_approx(key, [max(0.0, p - 0.002), min(1.0, p + 0.002)], 10_000)).first()[0]
    low, high = (float("-inf") if p <= 0.002 else low), (float("inf") if p >= 0.998 else high)
    above = rows.where(F.col(key) > high).count()
    last = rows.where(F.col(key).between(low, high)).orderBy(F.desc(key), tie).limit(k - above).orderBy(key, F.desc(tie)).first()
    return last[key], last[tie]


def best_cut(scores: DataFrame, labels: DataFrame) -> float:
    """The log weight at which keeping what is not below it goes wrong least often on the labelled documents.

    Counts per unit of log weight decide, so at most ``HIGHEST - LOWEST`` rows for each label reach the driver; of equally
    good cuts the middle one of the first run is taken.
    """
    place = F.greatest(F.lit(LOWEST), F.least(F.lit(HIGHEST), F.floor("log_weight"))).alias("place")
    known = labels.where("quality IN (0, 1)").select("doc_id", "quality").distinct()
    counts = scores.where("log_weight IS NOT NULL").join(known, "doc_id").groupBy(place, "quality").count()
    good, bad = (np.zeros(HIGHEST - LOWEST + 2, np.int64) for _ in range(2))
    for r in bounded_collect(counts, 2 * len(good), "labelled weights"):
        (good if r["quality"] == 1 else bad)[r["place"] - LOWEST] += r["count"]
    wrong = np.concatenate([[0], np.cumsum(good)]) + np.concatenate([np.cumsum(bad[::-1])[::-1], [0]])
    first = int(wrong.argmin())
    run = np.flatnonzero(np.append(wrong[first:] != wrong[first], True))[0]
    return float(LOWEST + first + run // 2) if first else float("-inf")


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, sample: int = SAMPLE, smoothing: float = SMOOTHING,
             seed: int = SEED) -> tuple[DataFrame, np.ndarray, tuple[float, int] | None]:
    """Scores of all documents and the draw: (scores, model, smallest drawn (key, doc_id)).

    Scores: ``doc_id, n_ngrams, log_weight, gumbel_key, selected``, one row per input row, stored in the shared folder. The
    k rows with the largest keys are selected. ``k`` None takes as many as have a log weight of at least ``best_cut``. Rows without n-grams (null, empty or shorter than three bytes) are never selected;
    rows with a null ``doc_id`` take part in both models but are never selected. Without good labels nothing is selected.
    """
    target_ids = target_sample(labels, sample, seed)
    ratio = fit(docs, target_ids, smoothing)
    scored = weigh(docs.select("doc_id", "text"), ratio).select("doc_id", "n_ngrams", "log_weight").withColumn(
        "gumbel_key", gumbel_key(F.col("log_weight"), F.col("doc_id"), seed))
    kept = stored(scored, "weights")
    if not target_ids:
        last = None
    else:
        drawable = kept.where(F.col("gumbel_key").isNotNull())
        last = kth_largest(kept, "gumbel_key", "doc_id", drawable.where(F.col("log_weight") >= best_cut(kept, labels)).count() if k is None else k)
    return kept.withColumn("selected", is_selected(last)), ratio, last


def is_selected(last: tuple[float, int] | None, gumbel: Column | None = None) -> Column:
    if last is None:
        return F.lit(False)
    key, doc_id = last
    gumbel = F.col("gumbel_key") if gumbel is None else gumbel
    drawn = (gumbel > key) | ((gumbel == key) & (F.col("doc_id") <= doc_id))
    return F.coalesce(drawn, F.lit(False))


def keep_selected(docs: DataFrame, labels: DataFrame, k: int | None = None, sample: int = SAMPLE, seed: int = SEED) -> DataFrame:
    """The documents that ``resample`` selects, with their columns. Weights are computed again instead of joined to texts."""
    scores, ratio, last = resample(docs, labels, k, sample, seed=seed)
    release(scores)
    n, weight = free_names(docs.columns, ["n_ngrams", "log_weight"])
    weighed = weigh(docs, ratio, n, weight)
    return weighed.where(is_selected(last, gumbel_key(F.col(weight), F.col("doc_id"), seed))).select(docs.columns)
