"""Token ids of whole texts by a tokenizer file whose pre-tokenizer drops white space, with a cache of words.

The tokenizer splits at white space before anything else, so the ids of a text are those of its white-space-separated
chunks in order. Chunks are encoded once by the tokenizers library and kept in a bounded table per worker process; those
that are one run of letters skip its normaliser and splitting pattern, which leave them as they are. Texts
with characters outside printable Latin-1 and plain white space, or with the start of a special token, go to the library
whole, because normalisation and white space could then differ.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

CACHE_ENTRIES = 450_000
LIBRARY_CHARS = 1 << 16
LIBRARY_WORDS = 1000
GROUP_CHARS = 1 << 20
#: a mark that is one token by itself
BAR = "|"
#: characters that are neither letters, numbers nor white space; the apostrophe also starts contractions
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
PLAIN = bytes([*range(0x09, 0x0E), *range(0x20, 0x7F), *range(0xA1, 0x100)])


def is_plain(text: str) -> bool:
    try:
        return "<|" not in text and not text.encode("latin-1").translate(None, PLAIN)
    except UnicodeEncodeError:
        return False


class WordTokens:
    """``encode`` gives the ids of each text as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        (self.bar,) = self.tokenizer.encode(BAR, add_special_tokens=False).ids
        #: the same model for lower-case words of letters alone, and whether an id ends a word
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = None
        self.letters.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=False)])
        vocabulary, suffix = self.tokenizer.get_vocab(), self.tokenizer.model.end_of_word_suffix
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = []
        group: list[str] = []
        size = 0
        for text in texts:
            group.append(text or "")
            size += len(group[-1])
            if size >= GROUP_CHARS:
                out += self._group(group)
                group, size = [], 0
        return out + self._group(group)

    def _group(self, texts: list[str]) -> list[bytes]:
        plain = [is_plain(t) for t in texts]
        chunks = [t.lower().split() if p else [] for t, p in zip(texts, plain, strict=True)]
        missing = set().union(*chunks).difference(self.known)
        if missing:
            if len(self.known) + len(missing) > CACHE_ENTRIES:  # keep one older generation, so frequent words survive
                self.older, self.known = self.known, {c: self.known[c] for c in set().union(*chunks) - missing}
            self._add(missing)
        get = self.known.__getitem__
        return [b"".join(map(get, c)) if p else self._library([t])[0] for c, p, t in zip(chunks, plain, texts, strict=True)]

    def _add(self, missing: set[str]) -> None:
        """Knows chunks from the older generation or from their parts: the marks after a letter or number are a token
        sequence of their own, so that a word is encoded once whatever follows it."""
        again = [c for c in missing if c in self.older]
        self.known.update(zip(again, map(self.older.__getitem__, again), strict=True))
        unseen = missing.difference(again)
        words = {c for c in unseen if c.isalpha()}
        parts, new = {}, set()
        for chunk in unseen - words:
            core = chunk.rstrip(MARKS)
            parts[chunk] = (core, chunk[len(core):]) if core and core != chunk and core[-1].isalnum() else (chunk, "")
            for part in parts[chunk]:
                if part and part not in self.known:
                    if (found := self.older.get(part)) is not None:
                        self.known[part] = found
                    else:
                        (words if part.isalpha() else new).add(part)
        self._learn_words(list(words))
        self._learn(list(new))
        for chunk, (core, tail) in parts.items():
            if tail:
                self.known[chunk] = self.known[core] + self.known[tail]

    def _learn_words(self, words: list[str]) -> None:
        """Encodes new words of letters many at once; the end-of-word suffix tells where each one's ids end."""
        for at in range(0, len(words), LIBRARY_WORDS):
            some = words[at:at + LIBRARY_WORDS]
            ids = np.array(self.letters.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(ends) != len(some):  # a model without that suffix
                self._learn(some)
                continue
            data = ids.tobytes()
            self.known.update(zip(some, [data[a:b] for a, b in zip([0, *ends], ends)], strict=True))

    def _learn(self, chunks: list[str]) -> None:
        """Encodes new chunks in a few long texts, with a bar between two of them that tells where each one's ids end."""
        barred = [c for c in chunks if BAR in c]
        self.known.update(zip(barred, self._library(barred), strict=True))
        plain = [c for c in chunks if BAR not in c] if barred else chunks
        at = 0
        while at < len(plain):
            end, size = at, 0
            while end < len(plain) and size < LIBRARY_CHARS:
                size += len(plain[end]) + 3
                end += 1
            ids = self._library([f" {BAR} ".join(plain[at:end])])[0]
            ends = (4 * np.flatnonzero(np.frombuffer(ids, "<u4") == self.bar)).tolist()
            self.known.update(zip(plain[at:end], [ids[a:b] for a, b in zip([0, *(e + 4 for e in ends)], [*ends, len(ids)])], strict=True))
            at = end


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    """One per worker process and file, so its table serves all tasks of the process."""
    return WordTokens(path)
