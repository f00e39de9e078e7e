"""Packing, token files and byte-level BPE: exact against the tokenizers' own libraries, and round trips."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from keelson.llm import byte_bpe, packing, token_files, word_tokens

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def coder():
    return byte_bpe.ByteBpe(byte_bpe.read_ranks(RANKS), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(coder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})


def test_word_tokens_equal_the_library(library, edge_rows, monkeypatch):
    monkeypatch.setattr(word_tokens, "CACHE_ENTRIES", 20)
    monkeypatch.setattr(word_tokens, "GROUP_CHARS", 300)
    monkeypatch.setattr(word_tokens, "LIBRARY_CHARS", 30)
    texts = [t for _, t, _ in edge_rows] + ["Don't we'll 12 3½ É", "İstanbul ΣΑΣ", "a\x1cb c\x85d", "ﬁne", "x<|startoftext|>y", "soft\xadhyphen"]
    got = word_tokens.WordTokens(WORDS).encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_words_of_letters_skip_the_pattern(library, monkeypatch):
    """Letters alone never meet the normaliser and the splitting pattern, all else does; the ids stay the library's."""
    letters = "".join(map(chr, [*range(97, 123), 0xAA, 0xB5, 0xBA, *range(0xDF, 0xF7), *range(0xF8, 0x100)]))
    words = [a + b + c for a in letters for b in letters[::3] for c in ("", "x", letters[-1])]
    texts = [" ".join(words), " ".join(w + m for w, m in zip(words, word_tokens.MARKS * 200)), "a1 1a Æther's ¼x x² it's 'tis 'S"]
    learned = []
    tokens = word_tokens.WordTokens(WORDS)
    learn = tokens._learn
    monkeypatch.setattr(tokens, "_learn", lambda chunks: (learned.extend(chunks), learn(chunks))[1])
    got = tokens.encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert learned and not any(c.isalpha() for c in learned)
    assert [word_tokens.is_plain(t) for t in ("a\tb\r\n", "a\x1cb", "a\x00", "<|", "a\x7f", "é", "\xa0", "")] == [True, False, False, False, False, True, False, True]


def check_packing(rows, docs, length):
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append(r)
        pieces[r["doc_id"]].append(r)
    for found in sequences.values():
        at = 0
        for r in sorted(found, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= length
    for doc_id, ids in docs.items():
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids)) and r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    return len(sequences)


def test_packing_holds_every_id_once(make_docs, edge_rows, library):
    rows = [r for r in edge_rows if r[0] is not None and r[0] != 19]
    ids = {i: np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for i, t, _ in rows}
    got = packing.pack_documents(make_docs(rows), WORDS, length=256, windows=16).collect()
    used = check_packing(got, ids, 256)
    assert used <= 1.1 * sum(map(len, ids.values())) / 256 + 1


def test_packing_with_null_ids_repeats_and_no_rows(make_docs, edge_rows):
    got = packing.pack_documents(make_docs(edge_rows), WORDS).collect()
    assert sum(r["doc_id"] is None for r in got) == 2 and sum(r["doc_id"] == 19 for r in got) == 2
    assert packing.pack_documents(make_docs([]), WORDS).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), min_size=0, max_size=60))
def test_windows_hold_all_items_and_never_overflow(sizes):
    sizes = np.array(sizes, np.int64)
    windows = packing.pack_batch(sizes, 100)
    assert sorted(i for w in windows for i in w.tolist()) == list(range(len(sizes)))
    assert all(sizes[w].sum() <= 100 for w in windows)


def test_differencing_is_nearly_equal():
    sizes = np.random.default_rng(1).integers(1, 1000, 600)
    loads = [sizes[w].sum() for w in packing.differencing(sizes, 50)]
    assert sum(loads) == sizes.sum() and max(loads) - min(loads) < 20
    small = np.array([8, 7, 6, 5, 4])
    assert sorted(small[w].sum() for w in packing.differencing(small, 2)) == [14, 16]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=400))
def test_coded_ids_come_back(ids):
    ids = np.array(ids, "<u4")
    assert token_files.decode_ids(*token_files.encode_ids(ids), len(ids)).tolist() == ids.tolist()


def test_ranks_beyond_one_byte_take_two(monkeypatch):
    ids = np.repeat(np.arange(70_000, dtype="<u4"), np.where(np.arange(70_000) < 200, 2, 1))
    ranked, control, data = token_files.encode_ids(ids)
    assert np.frombuffer(ranked, "<u4")[:200].tolist() == list(range(200)) and len(control) == -(-len(ids) // 4)
    assert len(data) == 400 + 56 + 2 * (65_536 - 256) + 3 * (70_000 - 65_536)
    assert token_files.decode_ids(ranked, control, data, len(ids)).tolist() == ids.tolist()


def test_token_files_in_order(spark, make_docs, edge_rows, library, tmp_path):
    rows = [r for r in edge_rows if r[0] is not None and r[0] != 19]
    path = str(tmp_path / "ids")
    token_files.write_token_files(make_docs(rows), WORDS, path, block_ids=100, range_bytes=2000)
    files = spark.read.parquet(path)
    assert files.count() > 5
    got = {r["doc_id"]: r for r in token_files.read_token_files(files).collect()}
    at = 0
    for i, t, _ in sorted(rows, key=lambda r: r[0]):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_token_files_with_null_ids_repeats_and_no_rows(make_docs, edge_rows):
    got = token_files.through_files(make_docs(edge_rows), WORDS).collect()
    assert len(got) == len(edge_rows)
    assert sorted(r["start"] for r in got if r["doc_id"] is None)[0] == 0
    spans = sorted((r["start"], r["n_tokens"]) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
    assert token_files.through_files(make_docs([]), WORDS).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab the'sin1 \n\t\x1c\x85\xa0　é日-=", max_size=120))
def test_bpe_equals_the_library(coder, reference, text):
    assert np.frombuffer(coder.encode(text), "<u4").tolist() == reference.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 5001, "ab" * 3000, "=-" * 2000 + "=", " " * 4000 + "x", "\n" * 999, "etaoinshrdlu" * 700, "日本" * 900])
def test_bpe_of_long_pieces_by_the_tree(coder, reference, text):
    assert np.frombuffer(coder.encode(text), "<u4").tolist() == reference.encode_ordinary(text)


def test_both_mergers_agree(coder):
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 50, 300):
        data = bytes(rng.choice(list(b"the and in ab"), n).tolist())
        assert coder._merge_short(data) == coder._merge_long(data)


def test_every_token_is_the_encoding_of_its_bytes(coder):
    assert all(coder.merge(token) == [rank] for token, rank in list(coder.ranks.items())[::50])


def test_bpe_round_trip(make_docs, edge_rows, reference, monkeypatch):
    got = byte_bpe.round_trip(make_docs(edge_rows), RANKS, public_tokenizers.PATTERN).collect()
    want = []
    for i, t, _ in edge_rows:
        ids = np.array(reference.encode_ordinary(t or ""), "<u4")
        want.append((i is None, i or 0, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted((r[0] is None, r[0] or 0, *r[1:]) for r in got) == sorted(want)
    assert byte_bpe.round_trip(make_docs([]), RANKS, public_tokenizers.PATTERN).collect() == []


def test_bpe_cache_stays_bounded(reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_ENTRIES", 10)
    monkeypatch.setattr(byte_bpe, "PAIRS", 10)
    coder = byte_bpe.ByteBpe(byte_bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    for i in range(30):
        text = f"word{i} other{i * 7} again the the {'xyz' * i}"
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == reference.encode_ordinary(text)
        assert len(coder.known) <= 20
