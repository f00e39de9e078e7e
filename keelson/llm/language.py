"""Language identification by a bidirectional gated recurrent network over bytes, in numpy.

Texts are cut into segments of ``SEGMENT`` bytes. Two gated recurrent layers of ``HIDDEN`` units read each segment forwards
and backwards; every position gets a distribution over the learned languages from both states, and a document's
probabilities are the mean over all its positions. Training is backpropagation through time with Adam on the driver, on a
bounded sample of labelled slices; prediction runs over every byte of every text inside Spark tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keelson.llm.words import free_names, give_back, text_slices
from keelson.session import bounded_collect

HIDDEN = 8
SEGMENT = 128
PAD = 256
LETTER = r"\p{L}"
DOCS_PER_LANGUAGE = 400
SLICE_CHARS = 400
MAX_LANGUAGES = 512
UNDETERMINED = "und"
TRAIN_LENGTH, TRAIN_BATCH, TRAIN_STEPS, RATE, SEED = 64, 256, 400, 0.02, 5


def sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


@dataclass
class Layer:
    """One direction. ``inputs`` (3H, 257) holds the input weights per byte with their biases; rows z, r, n."""

    inputs: np.ndarray
    recurrent: np.ndarray  # (3H, H)

    def run(self, ids: np.ndarray, valid: np.ndarray, keep: bool = False):
        """States (T, H, B) of ids (T, B). Positions that are not valid leave the state at zero, wherever they stand."""
        steps, batch = ids.shape
        hidden = self.recurrent.shape[1]
        states, h, saved = np.empty((steps, hidden, batch), self.inputs.dtype), np.zeros((hidden, batch), self.inputs.dtype), []
        for t in range(steps):
            x, u = np.take(self.inputs, ids[t], axis=1), self.recurrent @ h
            gates = sigmoid(x[:2 * hidden] + u[:2 * hidden])
            z, r = gates[:hidden], gates[hidden:]
            n = np.tanh(x[2 * hidden:] + r * u[2 * hidden:])
            if keep:
                saved.append((h, z, r, n, u[2 * hidden:]))
            h = (n + z * (h - n)) * valid[t]
            states[t] = h
        return (states, saved) if keep else states

    def gradients(self, ids: np.ndarray, valid: np.ndarray, saved: list, d_states: np.ndarray):
        hidden = self.recurrent.shape[1]
        d_inputs, d_recurrent = np.zeros_like(self.inputs), np.zeros_like(self.recurrent)
        carry = np.zeros_like(d_states[0])
        for t in reversed(range(len(ids))):
            h, z, r, n, un = saved[t]
            d = (d_states[t] + carry) * valid[t]
            dn = d * (1 - z) * (1 - n * n)
            dz = d * (h - n) * z * (1 - z)
            dr = dn * un * r * (1 - r)
            d_u = np.concatenate([dz, dr, dn * r])
            np.add.at(d_inputs.T, ids[t], np.concatenate([dz, dr, dn]).T)
            d_recurrent += d_u @ h.T
            carry = d * z + self.recurrent.T @ d_u
        return d_inputs, d_recurrent


@dataclass
class Network:
    languages: list[str]
    forward: Layer
    backward: Layer
    out: np.ndarray  # (C, 2H + 1), the last column is the bias

    @classmethod
    def fresh(cls, languages: list[str], hidden: int = HIDDEN, seed: int = SEED, kind=np.float32) -> Network:
        rng = np.random.default_rng(seed)

        def layer() -> Layer:
            return Layer(rng.normal(0, 0.3, (3 * hidden, PAD + 1)).astype(kind), rng.normal(0, hidden ** -0.5, (3 * hidden, hidden)).astype(kind))
        return cls(languages, layer(), layer(), rng.normal(0, 0.1, (len(languages), 2 * hidden + 1)).astype(kind))

    def parameters(self) -> list[np.ndarray]:
        return [self.forward.inputs, self.forward.recurrent, self.backward.inputs, self.backward.recurrent, self.out]

    def _probabilities(self, ahead: np.ndarray, back: np.ndarray) -> np.ndarray:
        hidden = ahead.shape[-2]
        scores = self.out[:, :hidden] @ ahead + self.out[:, hidden:2 * hidden] @ back + self.out[:, -1:]
        scores = np.exp(scores - scores.max(axis=-2, keepdims=True))
        return scores / scores.sum(axis=-2, keepdims=True)

    def position_sums(self, ids: np.ndarray, valid: np.ndarray) -> np.ndarray:
        """(C, B): probabilities of every position, summed over the valid ones."""
        ahead, back = self.forward.run(ids, valid), self.backward.run(ids[::-1], valid[::-1])[::-1]
        total = np.zeros((len(self.languages), ids.shape[1]), np.float32)
        for t in range(len(ids)):
            total += self._probabilities(ahead[t], back[t]) * valid[t]
        return total

    def loss_and_gradients(self, ids: np.ndarray, valid: np.ndarray, truth: np.ndarray):
        """Mean cross entropy of all valid positions, and its gradients in the order of ``parameters``."""
        (ahead, kept_a), (back, kept_b) = self.forward.run(ids, valid, True), self.backward.run(ids[::-1], valid[::-1], True)
        back = back[::-1]
        p, hidden, count = self._probabilities(ahead, back), ahead.shape[1], max(1, int(valid.sum()))
        columns = np.arange(ids.shape[1])
        loss = -(np.log(p[:, truth, columns] + 1e-12) * valid).sum() / count
        p[:, truth, columns] -= 1
        d = p * (valid[:, None, :] / count).astype(p.dtype)
        d_out = np.concatenate([np.einsum("tcb,thb->ch", d, ahead), np.einsum("tcb,thb->ch", d, back), d.sum(axis=(0, 2))[:, None]], axis=1)
        g_a = self.forward.gradients(ids, valid, kept_a, self.out[:, :hidden].T @ d)
        g_b = self.backward.gradients(ids[::-1], valid[::-1], kept_b, (self.out[:, hidden:2 * hidden].T @ d)[::-1])
        return loss, [*g_a, *g_b, d_out]


def train(texts: list[str], languages: list[str], steps: int = TRAIN_STEPS, hidden: int = HIDDEN, seed: int = SEED) -> Network:
    """Adam with backpropagation through time over random pieces of the texts, each language drawn equally often."""
    names = sorted(set(languages))
    net, rng = Network.fresh(names, hidden, seed), np.random.default_rng(seed)
    encoded = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    groups = [[i for i, name in enumerate(languages) if name == want and len(encoded[i])] for want in names]
    groups = [(c, g) for c, g in enumerate(groups) if g]
    first = [np.zeros_like(p) for p in net.parameters()]
    second = [np.zeros_like(p) for p in net.parameters()]
    for step in range(1, steps + 1 if groups else 1):
        ids, truth = np.full((TRAIN_LENGTH, TRAIN_BATCH), PAD), np.zeros(TRAIN_BATCH, np.int64)
        for b in range(TRAIN_BATCH):
            truth[b], group = groups[rng.integers(len(groups))]
            text = encoded[group[rng.integers(len(group))]]
            at = rng.integers(max(1, len(text) - TRAIN_LENGTH + 1))
            piece = text[at:at + TRAIN_LENGTH]
            ids[:len(piece), b] = piece
        _, grads = net.loss_and_gradients(ids, (ids != PAD).astype(np.float32), truth)
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for p, g, m, v in zip(net.parameters(), grads, first, second):
            g = np.clip(g, -1, 1)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return net


def predict(net: Network, data: np.ndarray, offsets: np.ndarray, batch: int = 4096) -> np.ndarray:
    """(texts, C): mean probabilities over all positions of each text; zeros for an empty text."""
    lengths = np.diff(offsets)
    pieces = -(-lengths // SEGMENT)
    owner = np.repeat(np.arange(len(lengths)), pieces)
    place = (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * SEGMENT
    starts, sizes = offsets[owner] + place, np.minimum(lengths[owner] - place, SEGMENT)
    padded = np.concatenate([data, np.zeros(SEGMENT, np.uint8)])
    sums = np.zeros((len(net.languages), len(lengths)))
    order = np.argsort(-sizes, kind="stable")  # short last pieces meet in batches with few steps
    for at in range(0, len(order), batch):
        rows = order[at:at + batch]
        steps = np.arange(int(sizes[rows[0]]))[:, None]
        valid = steps < sizes[rows]
        ids = np.where(valid, padded[starts[rows] + steps], PAD)
        found = net.position_sums(ids, valid.astype(np.float32))
        for c in range(len(sums)):
            sums[c] += np.bincount(owner[rows], weights=found[c], minlength=len(lengths))
    return (sums / np.maximum(lengths, 1)).T


def training_sample(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE, slice_chars: int = SLICE_CHARS) -> tuple[list[str], list[str]]:
    """Slices of the ``docs_per_language`` documents of each language with the smallest hashed ids: (texts, languages).

    A slice is ``slice_chars`` code points at a place that depends on the id. Only rows with a language and a letter count.
    """
    from_char = F.lit(1) + F.pmod(F.xxhash64("doc_id"), F.greatest(F.lit(1), F.length("text") - slice_chars + 1)).cast("int")
    slices = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        "lang", F.xxhash64("doc_id", F.lit("sample")).alias("h"), F.substring("text", from_char, F.lit(slice_chars)).alias("piece"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "piece"))
    chosen = slices.withColumn("rank", rank).where(F.col("rank") <= docs_per_language)
    rows = sorted((r["lang"], r["h"], r["piece"]) for r in bounded_collect(chosen, docs_per_language * MAX_LANGUAGES, "training slices"))
    return [r[2] for r in rows], [r[0] for r in rows]


def identify(docs: DataFrame, net: Network, lang_pred: str = "lang_pred", pooled: str = "score") -> DataFrame:
    """Adds the predicted language and its pooled probability to documents; one row per input row.

    A null text, or one without a letter, is ``und`` with score 0; so is every text when no language was learned.
    """
    names = docs.columns
    labels = np.array([*net.languages, UNDETERMINED], dtype=object)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            best, score = np.full(batch.num_rows, len(net.languages)), np.zeros(batch.num_rows)
            if net.languages:
                for row, data, offsets in text_slices(column):
                    p = predict(net, data, offsets)
                    best[row:row + len(p)], score[row:row + len(p)] = p.argmax(axis=1), p.max(axis=1)
                lettered = np.asarray(pc.fill_null(pc.match_substring_regex(column, LETTER), False))
                best[~lettered], score[~lettered] = len(net.languages), 0.0
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(labels[best], pa.string()), pa.array(np.clip(score, 0.0, 1.0))], names=[*names, lang_pred, pooled])
        give_back()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(label, f"{schema}, `{lang_pred}` string, `{pooled}` double")


#: share of rightly named held-out documents that the derived bound may lose
LOST = 0.001


def held_out(doc_id: str = "doc_id", parts: int = 5):
    """Rows whose crc32(id as text) is a multiple of ``parts``; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts == 0, F.lit(False))


def learn(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE, steps: int = TRAIN_STEPS) -> Network:
    """A network trained on the rows that are not held out."""
    texts, languages = training_sample(docs.where(~held_out() & F.col("doc_id").isNotNull()), docs_per_language)
    return train(texts, languages, steps)


def predict_documents(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE, steps: int = TRAIN_STEPS) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row, from a network that saw no held-out row."""
    net = learn(docs, docs_per_language, steps)
    return identify(docs.select("doc_id", "text"), net).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def least_score(docs: DataFrame, net: Network, lost: float = LOST) -> float:
    """The score that all but the share ``lost`` of the held-out documents reach whose language the network names; 0 without any.

    So the bound follows what the network knows: with few or easy languages it is high, with many it is low.
    """
    seen = identify(docs.where(held_out() & F.col("lang").isNotNull()).select("text", "lang"), net)
    return seen.where(F.col("lang_pred") == F.col("lang")).agg(F.percentile_approx("score", lost, 10_000)).first()[0] or 0.0


def keep_identified(docs: DataFrame, least: float | None = None) -> DataFrame:
    """The documents with a language that is predicted with at least the given score, with their columns.

    Without ``least``, ``least_score`` decides. A text in a language that was not learned is rejected only where the network
    is less sure of it than of its own languages.
    """
    language, score = free_names(docs.columns, ["lang_pred", "score"])
    net = learn(docs)
    bound = least_score(docs, net) if least is None else least
    seen = identify(docs, net, language, score)
    return seen.where((F.col(language) != UNDETERMINED) & (F.col(score) >= bound)).select(docs.columns)
