"""A word n-gram model with Katz backoff: Good-Turing discounts and exactly normalised backoff weights.

Words are A-Z lower-cased runs without white space, 64-bit hashes stand for them (words.py); every text ends with one end
token, and starts after an empty context. With training counts c(w), c(v, w) and discounts d:

    p(w | v) = d(c(v, w)) * c(v, w) / c(v)     where the pair was seen,
               alpha(v) * p(w)                 else, alpha(v) the mass left over by v's seen pairs, divided by the
                                               probability that p gives to words not seen after v,
    p(w)     = d(c(w)) * c(w) / N              where the word was seen; what is left goes to one unknown word.

Longer grams back off in the same way, p(w | u, v) to p(w | v), with discounts of their own; the first word of a text has
only the empty context, the second that and the first word, and so on up to ``order`` words together.

A context that was never seen is skipped: p(w | v) = p(w). A context without a pair that was seen once has little or nothing
to discount; it is plain: its pairs keep their counts, and one more event is left over for the unseen.

The corpus is cut into blocks of about ``BLOCK_BYTES`` of text. A block holds its tokens as numbers into its own sorted word
list. It sends the list with training counts to the column ranges of the words, which answer with an id and a total count for
each; then its distinct word pairs to ranges of contexts, which answer with the pair's count and, where pairs of a context
are unseen, what its backoff weight is made of. For each further length the answer also holds ids of the grams, which are the
contexts of the next: a round of questions and answers a length, scores by recursion over the answers. So words and grams are shuffled once for each block they occur in, packed,
and no token ever is.

Blocks, questions about words and all answers are rows of one table of the shared folder, bucketed by block: the range that counts
writes each answer into the bucket of the block that asked, where the next round reads it. So an answer is on disk once and is
not shuffled. Only the counts of counts outlive a range, one row for each.

A context that holds more than 1 / ``HOT`` of all tokens is spread over all ranges by its next word; there are fewer than
``HOT`` of these, and only their sums reach the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm.jaccard import pack, unpack
from keelson.llm.words import give_back, mix, text_slices, word_hashes
from keelson.session import bounded_collect, released_shuffles, shared_path, stored

BLOCK_BYTES = 8 << 20
PART_BYTES = 8 << 20
HOT = 10_000
DISCOUNTED = 5
END = np.uint64(0xE0F5C0DE12345677)
TEXT_START = 0  # id of the empty context; words have ids from 1
#: kinds of rows; those of the answers, sums and hot contexts of words (length 1) and grams are ``KINDS * length`` more
STREAM, QUESTION, ANSWER, SUMS, HOT_PROFILE = 0, 1, 2, 3, 4
KINDS = 8
ROWS = "block long, part int, kind int, a binary, b binary, c binary, sums array<double>"
DOC = np.dtype([("doc_id", "<i8"), ("known", "?"), ("held", "i1"), ("tokens", "<i8")])
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


@dataclass(frozen=True)
class Discounts:
    """Factors for counts 1, 2, ...; larger counts keep theirs. ``half`` takes half a count from every count instead."""

    factors: tuple[float, ...] = ()
    half: bool = False

    def of(self, counts: np.ndarray) -> np.ndarray:
        if self.half:
            return (counts - 0.5) / np.maximum(counts, 1)
        table = np.ones(len(self.factors) + 2)
        table[1:-1] = self.factors
        return table[np.minimum(counts, len(self.factors) + 1)]


def good_turing(counts_of_counts: np.ndarray) -> Discounts:
    """Katz's discounts from n_1, n_2, ... with the largest bound k up to ``DISCOUNTED`` that gives factors in (0, 1).

    Where no k does (tiny or odd corpora), half a count is taken from everything, which also leaves mass for the unseen.
    """
    n = np.concatenate([[0], np.asarray(counts_of_counts, float), [0]])
    for k in range(min(DISCOUNTED, len(counts_of_counts) - 1), 0, -1):
        if (n[1:k + 2] <= 0).any():
            continue
        r = np.arange(1, k + 1)
        common = (k + 1) * n[k + 1] / n[1]
        if common >= 1:
            continue
        factors = ((r + 1) * n[2:k + 2] / n[1:k + 1] / r - common) / (1 - common)
        if (factors > 0).all() and (factors < 1).all():
            return Discounts(tuple(factors.tolist()))
    return Discounts(half=True)


@dataclass(frozen=True)
class Unigrams:
    total: int
    distinct: int
    discounts: Discounts
    unknown: float  # probability left for the unknown word

    def probability(self, counts: np.ndarray) -> np.ndarray:
        if not self.total:
            return np.full(len(counts), 1.0)
        return np.where(counts > 0, self.discounts.of(counts) * counts / self.total, self.unknown)


def _squeeze(values: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(pack(values)) if len(values) else b""


def _expand(data: bytes, kind) -> np.ndarray:
    import zstandard

    return unpack(zstandard.ZstdDecompressor().decompress(data), kind) if data else np.empty(0, kind)


def _table(rows: list[tuple]) -> pa.Table:
    names = ["block", "part", "kind", "a", "b", "c", "sums"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.float64())]
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    give_back()
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a place of each distinct key in order, number of each place's key)."""
    order = np.argsort(keys)
    new = np.ones(len(order), bool)
    new[1:] = keys[order][1:] != keys[order][:-1]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def _by_frequency(counts: np.ndarray) -> np.ndarray:
    """Places in order of falling counts: numbers by it are small for frequent words, which pack well."""
    return np.argsort(-counts.astype(np.int64), kind="stable")


def _range_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def corpus_blocks(docs: DataFrame, parts: int) -> DataFrame:
    """Blocks of (``doc_id``, ``text``, ``held``: 1 held out, 0 to learn from, -1 neither): one row of tokens, rows of words.

    The row of tokens holds the documents, the words' counts in the order of their hashes, and each token's place among
    the words by falling counts.
    """
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            text, row = batch.column("text"), 0
            sizes = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False))])
            while row < batch.num_rows:
                end = max(row + 1, int(np.searchsorted(sizes, sizes[row] + BLOCK_BYTES, side="right")) - 1)
                found = [word_hashes(data, offsets) for _, data, offsets in text_slices(text.slice(row, end - row))]
                words, counts = (np.concatenate([f[i] for f in found]) for i in range(2))
                info = np.zeros(end - row, DOC)
                ids = batch.column("doc_id").slice(row, end - row)
                info["doc_id"], info["known"] = ids.fill_null(0).to_numpy(zero_copy_only=False), ~np.asarray(ids.is_null())
                info["held"], info["tokens"] = batch.column("held").slice(row, end - row).to_numpy(), counts + 1
                tokens = np.full(len(words) + len(info), END)
                is_word = np.ones(len(tokens), bool)
                is_word[np.cumsum(counts + 1) - 1] = False
                tokens[is_word] = words
                one, local = _numbered(tokens)
                distinct, occurs = tokens[one], np.bincount(local).astype(np.uint32)
                learned = np.bincount(local[np.repeat(info["held"] == 0, info["tokens"])], minlength=len(distinct))
                rank = np.empty(len(distinct), np.uint32)
                rank[_by_frequency(occurs)] = np.arange(len(distinct), dtype=np.uint32)
                rows = [(base + number, -1, STREAM, info.tobytes(), _squeeze(rank[local]), _squeeze(occurs), None)]
                cuts = np.searchsorted(_range_of(distinct, parts), np.arange(parts + 1))
                for p in np.flatnonzero(np.diff(cuts)):
                    a, b = cuts[p], cuts[p + 1]
                    rows.append((base + number, int(p), QUESTION, _squeeze(np.diff(distinct[a:b], prepend=np.uint64(0))), _squeeze(learned[a:b].astype(np.uint32)), b"", None))
                yield from _table(rows).to_batches()
                number, row = number + 1, end
        give_back()

    return docs.select("doc_id", "text", "held").mapInArrow(emit, ROWS)


def _counts_of_counts(total: np.ndarray) -> list[float]:
    return np.bincount(np.minimum(total, DISCOUNTED + 2), minlength=DISCOUNTED + 3)[1:DISCOUNTED + 2].astype(float).tolist()


def _count_words(parts: int):
    def count(rows: pa.Table) -> pa.Table:
        """Of one range of words: an answer (ids, counts) to each block, and sums."""
        blocks, part = rows.column("block").to_pylist(), rows.column("part")[0].as_py()
        each = [np.cumsum(_expand(a, np.uint64), dtype=np.uint64) for a in rows.column("a").to_pylist()]
        counts = np.concatenate([_expand(b, np.uint32) for b in rows.column("b").to_pylist()])
        one, place = _numbered(np.concatenate(each))
        total = np.bincount(place, weights=counts, minlength=len(one)).astype(np.int64)
        ids = np.empty(len(one), np.uint64)
        ids[_by_frequency(total)] = np.uint64(1 + part) + np.uint64(parts) * np.arange(len(one), dtype=np.uint64)
        out, at = [], 0
        for block, h in zip(blocks, each, strict=True):
            mine = place[at:at + len(h)]
            at += len(h)
            out.append((block, part, KINDS + ANSWER, _squeeze(ids[mine]), _squeeze(total[mine].astype(np.uint64)), b"", None))
        out.append((0, part, KINDS + SUMS, b"", b"", b"", [float(total.sum()), float((total > 0).sum()), *_counts_of_counts(total)]))
        return _table(out)
    return count


@dataclass(frozen=True)
class Model:
    """What tasks know of the corpus: sums of words, and of each length of grams so far discounts and hot contexts."""

    starts: int
    parts: int
    unigrams: Unigrams
    discounts: dict[int, Discounts]
    hot: dict[int, dict[int, list[float]]]
    hot_above: float


def _distinct(context: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a place of each distinct pair in order, number of each place's pair)."""
    if not len(token) or max(int(context.max()), int(token.max())) < 1 << 32:
        return _numbered(context << np.uint64(32) | token)
    order = np.lexsort((token, context))  # the same order and numbers, for ids beyond 2**32
    new = np.ones(len(order), bool)
    new[1:] = (token[order][1:] != token[order][:-1]) | (context[order][1:] != context[order][:-1])
    gram = np.empty(len(order), np.int64)
    gram[order] = np.cumsum(new) - 1
    return order[new], gram


@dataclass
class _Level:
    """The grams of one length in a block: the tokens that end one, and the distinct grams in order.

    ``lower`` is what the probability of the gram without its first word is made of: the word's count for pairs, for longer
    grams the shorter gram's count * 2 + plain and its context's count.
    """

    at: np.ndarray
    gram: np.ndarray
    context: np.ndarray
    word: np.ndarray
    context_count: np.ndarray
    lower: list[np.ndarray]
    part: np.ndarray

    @classmethod
    def of(cls, at: np.ndarray, context: np.ndarray, token: np.ndarray, context_count: np.ndarray, lower: list[np.ndarray], model: Model) -> _Level:
        one, gram = _distinct(context, token)
        context, word, context_count = context[one], token[one], context_count[one]
        spread = mix(context ^ np.where(context_count > model.hot_above, mix(word), np.uint64(0)))
        return cls(at, gram, context, word, context_count, [x[one] for x in lower], _range_of(spread, model.parts))

    def places(self, parts: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(self.part, kind="stable")
        return order, np.searchsorted(self.part[order], np.arange(parts + 1))


@dataclass
class _Answer:
    """Of each gram of a level: its count, whether its context is plain, its id, and its context's backoff weight."""

    count: np.ndarray
    plain: np.ndarray
    ids: np.ndarray
    alpha: np.ndarray

    @classmethod
    def read(cls, level: _Level, rows: list[tuple], length: int, model: Model) -> _Answer:
        order, cuts = level.places(model.parts)
        discounts, hot_profiles, hot_above = model.discounts[length], model.hot[length], model.hot_above
        count, plain, ids, alpha = (np.zeros(len(level.context), k) for k in (np.int64, bool, np.uint64, float))
        for p, k, a, b, c in rows:
            if k != KINDS * length + ANSWER:
                continue
            at = order[cuts[p]:cuts[p + 1]]
            answer = _expand(a, np.uint64).astype(np.int64)
            count[at], plain[at] = answer >> 1, answer & 1
            if c:
                ids[at] = _expand(c, np.uint64)
            missing = at[(answer >> 1) == 0]
            missing = missing[level.context_count[missing] <= hot_above]
            contexts, first, place = np.unique(level.context[missing], return_index=True, return_inverse=True)
            profile = _read_profiles(b, len(contexts))
            alpha[missing] = backoff(profile, level.context_count[missing][first], discounts)[place]
        hot = np.flatnonzero((count == 0) & (level.context_count > hot_above))
        if len(hot):
            contexts, first, place = np.unique(level.context[hot], return_index=True, return_inverse=True)
            profile = np.array([hot_profiles[int(c)] for c in contexts])
            alpha[hot] = backoff(profile, level.context_count[hot][first], discounts)[place]
        hot_plain = {c for c, p in hot_profiles.items() if not p[0]}
        is_hot = level.context_count > hot_above
        plain[is_hot] = np.isin(level.context[is_hot], np.array(sorted(hot_plain), np.uint64))
        return cls(count, plain, ids, alpha)


class _Block:
    """A block with its answers about words; ``climb`` goes from the grams of one length to those of the next."""

    def __init__(self, rows: list[tuple], model: Model):
        info, rank, occurs = next((a, b, c) for _, k, a, b, c in rows if k == STREAM)
        self.info, local = np.frombuffer(info, DOC), _by_frequency(_expand(occurs, np.uint32))[_expand(rank, np.uint32)]
        answers = sorted((p, a, b) for p, k, a, b, _ in rows if k == KINDS + ANSWER)
        ids, counts = (np.concatenate([_expand(a[i], np.uint64) for a in answers]) for i in (1, 2))
        self.token, self.count, self.model = ids[local], counts[local].astype(np.int64), model
        self.first = np.cumsum(self.info["tokens"]) - self.info["tokens"]

    def pairs(self) -> _Level:
        context, before = np.roll(self.token, 1), np.roll(self.count, 1)
        context[self.first], before[self.first] = TEXT_START, self.model.starts
        return _Level.of(np.arange(len(self.token)), context, self.token, before, [self.count], self.model)

    def climb(self, level: _Level, answer: _Answer) -> _Level:
        """Grams of one word more: their context is the gram that ends a token earlier. Contexts never seen are left out."""
        context, before = np.zeros(len(self.token), np.uint64), np.zeros(len(self.token), np.int64)
        context[level.at], before[level.at] = answer.ids[level.gram], answer.count[level.gram]
        context, before = np.roll(context, 1), np.roll(before, 1)
        before[self.first] = 0
        inside = before[level.at] > 0  # a token with a longer gram has this one too, unless its context was never seen
        at, gram = level.at[inside], level.gram[inside]
        lower = [answer.count[gram] * 2 + answer.plain[gram], level.context_count[gram]]
        return _Level.of(at, context[at], self.token[at], before[at], lower, self.model)


def _block_rows(table: pa.Table) -> list[tuple]:
    return list(zip(*(table.column(c).to_pylist() for c in ("part", "kind", "a", "b", "c")), strict=True))


def _ask_grams(length: int, model: Model):
    def ask(table: pa.Table) -> pa.Table:
        """The distinct grams of a block by range of contexts, with how often each occurs in texts to learn from."""
        replies, name = _block_rows(table), table.column("block")[0].as_py()
        block = _Block(replies, model)
        level = block.pairs()
        for k in range(2, length):
            level = block.climb(level, _Answer.read(level, replies, k, model))
        learned = np.repeat(block.info["held"] == 0, block.info["tokens"])[level.at]
        n = np.bincount(level.gram[learned], minlength=len(level.context))
        order, cuts = level.places(model.parts)
        rows = []
        for p in np.flatnonzero(np.diff(cuts)):
            at = order[cuts[p]:cuts[p + 1]]
            contexts, first = np.unique(level.context[at], return_index=True)
            head = np.stack([np.diff(contexts, prepend=np.uint64(0)), np.diff(np.append(first, len(at))).astype(np.uint64),
                             level.context_count[at][first].astype(np.uint64)]).ravel()
            rows.append((name, int(p), QUESTION, _squeeze(head), _squeeze(level.word[at]),
                         _squeeze(np.concatenate([x[at].astype(np.uint64) for x in (*level.lower, n)])), None))
        return _table(rows)
    return ask


def _profiles(owner: np.ndarray, contexts: int, counts: np.ndarray, probability: np.ndarray) -> np.ndarray:
    """(contexts, DISCOUNTED + 2): seen pairs of count 1..DISCOUNTED, sum of larger counts, sum of p(w) of all seen pairs."""
    out = np.zeros((contexts, DISCOUNTED + 2))
    small = (counts > 0) & (counts <= DISCOUNTED)
    out[:, :DISCOUNTED] = np.bincount(owner[small] * DISCOUNTED + counts[small] - 1, minlength=contexts * DISCOUNTED).reshape(contexts, DISCOUNTED)
    large = counts > DISCOUNTED
    out[:, DISCOUNTED] = np.bincount(owner[large], weights=counts[large], minlength=contexts)
    out[:, DISCOUNTED + 1] = np.bincount(owner[counts > 0], weights=probability[counts > 0], minlength=contexts)
    return out


def _write_profiles(profiles: np.ndarray) -> bytes:
    """Sums of p(w) as they are, the counts before them packed."""
    return profiles[:, -1].tobytes() + _squeeze(profiles[:, :-1].astype(np.uint64).T.ravel())


def _read_profiles(data: bytes, contexts: int) -> np.ndarray:
    counts = _expand(data[8 * contexts:], np.uint64).astype(float).reshape(DISCOUNTED + 1, contexts)
    return np.column_stack([counts.T, np.frombuffer(data, count=contexts)])


def _count_grams(length: int, model: Model, last: bool):
    hot_above = model.hot_above

    def below(lower: list[np.ndarray]) -> np.ndarray:
        """Probability of the seen grams without their first word, which were seen as well."""
        if length == 2:
            return model.unigrams.probability(lower[0])
        return seen_probability(lower[0] >> 1, lower[1], (lower[0] & 1) == 1, model.discounts[length - 1])

    def count(rows: pa.Table) -> pa.Table:
        """Of one range of contexts: an answer to each block, sums, and hot profiles.

        Unless these are the ``last`` grams, the answer also names each gram by an id, small for frequent ones.
        """
        blocks, part = rows.column("block").to_pylist(), rows.column("part")[0].as_py()
        context, word, lower, n, context_count, sizes = [], [], [], [], [], []
        for a, b, c in zip(*(rows.column(x).to_pylist() for x in "abc"), strict=True):
            step, repeat, total = _expand(a, np.uint64).reshape(3, -1)
            repeat = repeat.astype(np.int64)
            context.append(np.repeat(np.cumsum(step, dtype=np.uint64), repeat))
            context_count.append(np.repeat(total.astype(np.int64), repeat))
            word.append(_expand(b, np.uint64))
            *shorter, own = _expand(c, np.uint64).astype(np.int64).reshape(-1, len(word[-1]))
            lower.append(shorter)
            n.append(own)
            sizes.append(len(word[-1]))
        context, word, n, context_count, *lower = map(np.concatenate, (context, word, n, context_count, *zip(*lower, strict=True)))
        one, pair = _distinct(context, word)
        total = np.bincount(pair, weights=n, minlength=len(one)).astype(np.int64)
        contexts, owner = np.unique(context[one], return_inverse=True)
        profile = _profiles(owner, len(contexts), total, below([x[one] for x in lower]))
        hot = np.zeros(len(contexts), bool)
        hot[owner] = context_count[one] > hot_above
        plain = (profile[:, 0] == 0)[owner]
        ids = np.empty(0 if last else len(one), np.uint64)
        if not last:
            ids[_by_frequency(total)] = np.uint64(1 + part) + np.uint64(model.parts) * np.arange(len(one), dtype=np.uint64)
        out, at, answer, kind = [], 0, (total * 2 + plain).astype(np.uint64), KINDS * length
        for block, size in zip(blocks, sizes, strict=True):
            mine = pair[at:at + size]
            at += size
            unseen = np.unique(owner[mine[(total[mine] == 0)]])
            unseen = unseen[~hot[unseen]]
            out.append((block, part, kind + ANSWER, _squeeze(answer[mine]), _write_profiles(profile[unseen]), b"" if last else _squeeze(ids[mine]), None))
        out.append((0, part, kind + SUMS, b"", b"", b"", _counts_of_counts(total)))
        for c in np.flatnonzero(hot):
            out.append((int(contexts[c]), part, kind + HOT_PROFILE, b"", b"", b"", profile[c].tolist()))
        return _table(out)
    return count


def backoff(profile: np.ndarray, context_count: np.ndarray, discounts: Discounts) -> np.ndarray:
    """alpha of each context from its profile; 1 for a context that was never seen."""
    r = np.arange(1, DISCOUNTED + 1)
    kept = profile[:, :DISCOUNTED] @ (discounts.of(r) * r) + profile[:, DISCOUNTED]
    left = np.where(profile[:, 0] > 0, context_count - kept, context_count / (context_count + 1.0)) / np.maximum(context_count, 1)
    return np.where(context_count > 0, left / np.maximum(1 - profile[:, DISCOUNTED + 1], 1e-300), 1.0)


def seen_probability(counts: np.ndarray, context_count: np.ndarray, plain: np.ndarray, discounts: Discounts) -> np.ndarray:
    """p(w | v) of seen pairs. A plain context counts one event more, which is what it leaves over."""
    small = np.where(counts <= DISCOUNTED, discounts.of(counts), 1.0)
    return np.where(plain, counts / (context_count + 1.0), small * counts / np.maximum(context_count, 1))


def _score(order: int, model: Model):
    def score(table: pa.Table) -> pa.Table:
        """The log probability of each text of one block."""
        names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        rows = _block_rows(table)
        block = _Block(rows, model)
        p, level = model.unigrams.probability(block.count), block.pairs()
        for k in range(2, order + 1):
            answer = _Answer.read(level, rows, k, model)
            seen = seen_probability(answer.count, level.context_count, answer.plain, model.discounts[k])[level.gram]
            p[level.at] = np.where(answer.count[level.gram] > 0, seen, answer.alpha[level.gram] * p[level.at])
            if k < order:
                level = block.climb(level, answer)
        log_p = np.log10(np.maximum(p, 1e-300))
        owner = np.repeat(np.arange(len(block.info)), block.info["tokens"])
        base = np.log10((block.count + 1) / (model.unigrams.total + (model.unigrams.distinct + 1)))
        info = block.info
        sums = [np.bincount(owner, weights=w, minlength=len(info)) for w in (block.count > 0, base, log_p)]
        give_back()
        return pa.table([pa.array(np.ascontiguousarray(info["doc_id"]), mask=~info["known"]), pa.array(info["held"] == 1),
                         pa.array(np.ascontiguousarray(info["tokens"])), pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2])], names=names)
    return score


def score_documents(docs: DataFrame, part_bytes: int = PART_BYTES, order: int = 2) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs``.

    The model learns from texts with crc32(doc_id as text) mod 7 other than 2; those with 2 are held out, rows with a null
    ``doc_id`` are neither. ``order`` is the number of words of the longest grams, at least two. A null text is empty and has its end token only. Repeated rows count as often as they occur.
    """
    spark = docs.sparkSession
    with released_shuffles(spark):
        result, total = _scores(spark, docs, part_bytes, order)
    return result.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def _scores(spark: SparkSession, docs: DataFrame, part_bytes: int, order: int) -> tuple[DataFrame, int]:
    """(stored scores, number of training tokens)."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    held = F.when(F.col("doc_id").isNull(), F.lit(-1)).when(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(1)).otherwise(F.lit(0))
    marked = docs.select("doc_id", "text", held.alias("held"))
    starts = marked.where("held = 0").count()
    # bucketed by block, so that a block finds its tokens and its answers without a shuffle
    name, path = f"keelson_blocks_{uuid.uuid4().hex}", shared_path(spark, "blocks")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def add(rows: DataFrame) -> None:
        rows.write.mode("append").format("parquet").partitionBy("kind").bucketBy(buckets, "block").option("path", path).saveAsTable(name)

    def of_kinds(*kinds: int) -> DataFrame:
        return spark.table(name).where(F.col("kind").isin(*kinds)).select("block", "part", "kind", "a", "b", "c", "sums")

    add(corpus_blocks(marked, parts))
    add(of_kinds(QUESTION).groupBy("part").applyInArrow(_count_words(parts), ROWS))
    _delete(spark, f"{path}/kind={QUESTION}")  # answered; from here on questions are only shuffled
    sums = np.array([r["sums"] for r in bounded_collect(_summed(of_kinds(KINDS + SUMS)), 1, "word sums") if r["sums"]])
    totals = sums[0] if len(sums) else np.zeros(DISCOUNTED + 3)
    unigrams = _unigrams(totals)
    model = Model(starts, parts, unigrams, {}, {}, unigrams.total / HOT)
    known = [STREAM, KINDS + ANSWER]
    for length in range(2, order + 1):
        asked = of_kinds(*known).groupBy("block").applyInArrow(_ask_grams(length, model), ROWS)
        add(asked.groupBy("part").applyInArrow(_count_grams(length, model, length == order), ROWS))
        counts = bounded_collect(_summed(of_kinds(KINDS * length + SUMS)), 1, "gram sums")
        discounts = good_turing(np.array(counts[0]["sums"])) if counts and counts[0]["sums"] else Discounts(half=True)
        hot = of_kinds(KINDS * length + HOT_PROFILE).groupBy("block").agg(*_element_sums())
        profiles = {r["block"]: r["sums"] for r in bounded_collect(hot.select("block", F.array(*[f"s{i}" for i in range(DISCOUNTED + 2)]).alias("sums")), HOT, "hot contexts")}
        model = replace(model, discounts={**model.discounts, length: discounts}, hot={**model.hot, length: profiles})
        known.append(KINDS * length + ANSWER)
    result = stored(of_kinds(*known).groupBy("block").applyInArrow(_score(order, model), SCORES), "scores")
    spark.sql(f"DROP TABLE {name}")
    _delete(spark, path)
    return result, unigrams.total


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _element_sums(length: int = DISCOUNTED + 2) -> list:
    return [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(length)]


def _summed(rows: DataFrame) -> DataFrame:
    """One row: the sums of the arrays, element by element; null elements where arrays are shorter."""
    width = DISCOUNTED + 3
    return rows.agg(*_element_sums(width)).select(F.filter(F.array(*[f"s{i}" for i in range(width)]), lambda x: x.isNotNull()).alias("sums"))


def _unigrams(sums: np.ndarray) -> Unigrams:
    total, distinct, n = int(sums[0]), int(sums[1]), sums[2:]
    discounts = good_turing(n)
    if discounts.half:
        left = 0.5 * distinct
    else:
        r = np.arange(1, len(discounts.factors) + 1)
        left = float((n[:len(r)] * r * (1 - np.array(discounts.factors))).sum())
    return Unigrams(total, distinct, discounts, left / total if total else 1.0)
