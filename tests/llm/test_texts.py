"""Fingerprints, joins, language model: against brute force on a small table with edge cases."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from keelson.llm import fingerprint, jaccard, katz, queries, words
from keelson.llm.graph import components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words_of(text):
    return WORD.findall((text or "").encode().lower())


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbZ é日\t\n\x0b\x1c ", max_size=30)), max_size=8))
def test_word_hashes_are_those_of_the_words(texts):
    known = {}
    for row, data, offsets in words.text_slices(pa.array(texts, pa.string()), limit=20):
        hashes, counts = words.word_hashes(data, offsets)
        mine = [words_of(t) for t in texts[row:row + len(counts)]]
        assert counts.tolist() == [len(w) for w in mine]
        for h, w in zip(hashes.tolist(), [x for m in mine for x in m], strict=True):
            assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)


def test_words_that_differ_late_differ():
    texts = ["x" * 4000, "x" * 4001, "x" * 3999 + "y", "y" + "x" * 3999]
    _, data, offsets = next(words.text_slices(pa.array(texts)))
    assert len(set(words.word_hashes(data, offsets)[0].tolist())) == 4


def brute_links(rows, size, numerator, denominator):
    sets = []
    for _, text in rows:
        w = words_of(text)
        sets.append(frozenset(tuple(w[j:j + size]) for j in range(max(1, len(w) - size + 1))) if w else frozenset())
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    links = Counter()
    for a in range(len(rows)):
        for b in range(len(rows)):
            i, j = rows[a][0], rows[b][0]
            if a != b and i is not None and j is not None and sets[a] and denominator * len(sets[a] & sets[b]) >= numerator * len(sets[a] | sets[b]):
                links[a] += 1
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [(i, len(sets[k]), find(i) if i is not None else None, links[k]) for k, (i, _) in enumerate(rows)]


def key(row):
    return tuple((x is None, x) for x in row)


@pytest.mark.parametrize(("size", "ratio", "rows_per_block"), [(3, (90, 100), 256), (5, (4, 5), 3), (2, (1, 2), 4)])
def test_jaccard_join_finds_every_link(make_docs, edge_rows, size, ratio, rows_per_block):
    rng = np.random.default_rng(size)
    base = [f"w{i}" for i in rng.integers(0, 40, 60)]
    family = []
    for i in range(30):  # copies with more and more changes
        text = list(base)
        for p in rng.integers(0, 60, i // 4):
            text[p] = f"z{rng.integers(0, 5)}"
        family.append((500 - i, " ".join(text), "en"))
    rows = edge_rows + family
    got = jaccard.link_documents(make_docs(rows), size, *ratio, rows=rows_per_block, part_bytes=2000).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute_links([(i, t) for i, t, _ in rows], size, *ratio), key=key)


def test_copies_behind_a_row_without_id_still_link(spark, make_docs):
    prose = " ".join(f"w{i}" for i in range(100))
    rows = [(None, prose, "en"), (2, prose, "en"), (3, prose + " end", "en"), (None, "other words", "en")]
    got = jaccard.link_documents(make_docs(rows).coalesce(1), 3, 9, 10).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute_links([(i, t) for i, t, _ in rows], 3, 9, 10), key=key)
    assert {r["component_id"] for r in got} == {None, 2}


def test_product_stops_early_without_losing_links():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 400, 200).astype(np.uint64)) for _ in range(6)]
    sets += [np.append(sets[0], np.uint64(999)), sets[1][:-1]]
    got = jaccard.overlaps(sets, sets, 9, 10, columns=16)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = len(np.intersect1d(a, b))
            assert got[i, j] == (i != j and 10 * both >= 9 * (len(a) + len(b) - both))


def test_jaccard_join_of_an_empty_table(make_docs):
    assert jaccard.link_documents(make_docs([])).collect() == []
    assert jaccard.keep_one_of_each(make_docs([])).collect() == []


def test_one_of_each_group_stays(make_docs, edge_rows):
    docs = make_docs(edge_rows)
    kept = jaccard.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    expected = brute_links([(i, t) for i, t, _ in edge_rows], 5, 4, 5)
    want = {(i, t) for (i, t, _), (_, _, c, _) in zip(edge_rows, expected, strict=True) if i is None or c == i}
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_texts_that_share_an_id_are_judged_alone(make_docs):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a, "en"), (5, a, "en"), (5, b, "de"), (5, b, "de"), (6, c, "en"), (6, b + " end", "en"), (4, c + " end", "en"), (None, a, "en"), (8, None, "en")]
    docs = make_docs(rows)
    kept = jaccard.keep_one_of_each(docs)
    assert kept.columns == docs.columns and kept.exceptAll(docs).isEmpty()
    want = [(1, a), (4, c + " end"), (5, b), (8, None), (None, a)]
    assert sorted([(r["doc_id"], r["text"]) for r in kept.collect()], key=key) == sorted(want, key=key)


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(1, i) for i in range(2, 50)]
    got = dict(map(tuple, components(spark.createDataFrame(chain + hub + [(7, 7)], "a long, b long")).collect()))
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in range(1, 50)}}


def test_fingerprints(make_docs, edge_rows):
    rows = [(i, t) for i, t, _ in edge_rows if i is not None and i != 19] + [(19, "the the the the")]
    got = {r["doc_id"]: r for r in fingerprint.fingerprint_documents(make_docs([(i, t, "en") for i, t in rows])).collect()}
    texts, order = {i: t or "" for i, t in rows}, sorted((i for i, _ in rows), reverse=True)
    by_text = defaultdict(set)
    for place, i in enumerate(order):
        text, following = texts[i], texts[order[(place + 1) % len(order)]]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        assert got[i]["n_chars"] == len(text)
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
        by_text[text].add(got[i]["fingerprint"])
        by_text[edited].add(got[i]["edited_fingerprint"])
        if text == following:
            assert got[i]["near_next"] == 1
    assert all(len(f) == 1 for f in by_text.values())
    assert got[8]["fingerprint"] == got[9]["fingerprint"] != got[13]["fingerprint"]


def test_likeness_follows_edits_and_order(make_docs, spark):
    text = [f"w{i % 170}" for i in range(400)]
    half, swapped = text[:200] + [f"v{i}" for i in range(200)], text[200:] + text[:200]
    frame = spark.createDataFrame([(" ".join(text), " ".join(x)) for x in (text, text[:399] + ["end"], half, swapped, [f"v{i}" for i in range(400)])],
                                  "a string, b string")
    near = [r[0] for r in frame.select(fingerprint.likeness(fingerprint.signature("a"), fingerprint.signature("b"))).collect()]
    assert near[0] == 1 and near[1] > 0.85 and 0.05 < near[2] < 0.6 and near[4] == 0
    assert near[3] < near[1]


def test_signature_against_plain_python(spark):
    """Bins, occurrence numbers and text order, with the engine's own hashes for k-mers and pairs."""
    text = "b a b a c a b a a b"
    tokens = text.split()
    kmers = spark.sql("SELECT " + ", ".join(f"xxhash64(xxhash64('{a}'), xxhash64('{b}')) & {(1 << 37) - 1}" for a, b in zip(tokens, tokens[1:]))).first()
    seen, elements = Counter(), []
    for place, k in enumerate(kmers):
        elements.append((k, seen[k], place))
        seen[k] += 1
    hashes = spark.sql("SELECT " + ", ".join(f"xxhash64({k}L, {o}) & {(1 << 37) - 1}" for k, o, _ in elements)).first()
    bins = defaultdict(list)
    for h, (_, _, place) in zip(hashes, elements, strict=True):
        bins[h >> 31].append((h & ((1 << 31) - 1), place))
    want = {}
    for b, found in bins.items():
        in_order = [h for h, place in sorted(sorted(found)[:2], key=lambda x: x[1])]
        want[b] = spark.sql(f"SELECT xxhash64(array({', '.join(f'{h}L' for h in in_order)})) & 4294967295L").first()[0]
    got = spark.createDataFrame([(text,)], "t string").select(fingerprint.signature("t")).first()[0]
    assert {x >> 32: x & 0xFFFFFFFF for x in got} == want


def test_fingerprints_of_an_empty_and_of_a_one_row_table(make_docs):
    assert fingerprint.fingerprint_documents(make_docs([])).collect() == []
    row, = fingerprint.fingerprint_documents(make_docs([(1, "abcd efgh", None)])).collect()
    assert row["near_next"] == 1 and row["edited_sha256"] == hashlib.sha256(b"abcd abcd").hexdigest()


def katz_by_hand(rows):
    docs = [(i, words_of(t) + [None]) for i, t, _ in rows]
    held = [None if i is None else zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs]
    single, pair, after = Counter(), Counter(), Counter()
    for (_, tokens), h in zip(docs, held, strict=True):
        if h is False:
            single.update(tokens)
            for v, w in zip(["<s>", *tokens], tokens):
                pair[v, w] += 1
                after[v] += 1
    total, distinct = sum(single.values()), len(single)
    below = [katz.good_turing(np.array([sum(c == r for c in counts.values()) for r in range(1, 7)])) for counts in (single, pair)]
    factor = [lambda c, d=d: float(d.of(np.array([c]))[0]) for d in below]
    unknown = 1 - sum(factor[0](c) * c / total for c in single.values())
    followers = defaultdict(list)
    for (v, w), c in pair.items():
        followers[v].append((w, c))

    def one(w):
        return factor[0](single[w]) * single[w] / total if single[w] else unknown

    def p(v, w):
        if not after[v]:
            return one(w)
        plain = all(c > 1 for _, c in followers[v])

        def seen(c):
            return c / (after[v] + 1) if plain else (factor[1](c) if c <= 5 else 1) * c / after[v]
        if pair[v, w]:
            return seen(pair[v, w])
        return (1 - sum(seen(c) for _, c in followers[v])) / (1 - sum(one(x) for x, _ in followers[v])) * one(w)
    vocabulary = list(single)
    for v in ["<s>", *vocabulary[:20]]:  # exactly normalised: all words and one unknown word
        assert sum(p(v, w) for w in vocabulary) + p(v, b"\0 never") == pytest.approx(1)
    out = []
    for (i, tokens), h in zip(docs, held, strict=True):
        base = sum(math.log10((single[w] + 1) / (total + distinct + 1)) for w in tokens)
        score = sum(math.log10(p(v, w)) for v, w in zip(["<s>", *tokens], tokens))
        out.append((i, bool(h), len(tokens), sum(single[w] > 0 for w in tokens), total, base, score))
    return out


@pytest.mark.parametrize("hot", [10_000, 20])
def test_katz_against_brute_force(make_docs, edge_rows, hot, monkeypatch):
    monkeypatch.setattr(katz, "HOT", hot)
    rows = edge_rows + [(1000 + i, f"w{i % 7} w{i % 5} w{i % 11} common w{i % 3} common x{i}", "en") for i in range(120)]
    got = sorted(map(tuple, katz.score_documents(make_docs(rows), part_bytes=3000).collect()), key=key)
    for a, b in zip(got, sorted(katz_by_hand(rows), key=key), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def katz_scores_by_recursion(rows, order):
    """Probabilities of each word by recursion over contexts of up to ``order`` - 1 words."""
    docs = [(i, ["<s>", *words_of(t), None]) for i, t, _ in rows]
    grams, followers = [Counter() for _ in range(order + 1)], defaultdict(dict)
    for i, full in docs:
        if i is not None and zlib.crc32(str(i).encode()) % 7 != 2:
            for at in range(1, len(full)):
                for k in range(1, min(order, at + 1) + 1):
                    gram = tuple(full[at - k + 1:at + 1])
                    grams[k][gram] += 1
                    followers[gram[:-1]][gram[-1]] = grams[k][gram]
    discounts = [None] + [katz.good_turing(np.array([sum(c == r for c in g.values()) for r in range(1, 7)])) for g in grams[1:]]
    total = sum(grams[1].values())

    def seen(h, c):
        d = discounts[len(h) + 1]
        kept = float(d.of(np.array([c]))[0]) if c <= 5 or not h else 1
        after = followers[h]
        return c / (sum(after.values()) + 1) if h and 1 not in after.values() else kept * c / (sum(after.values()) if h else total)

    def p(h, w):
        after = followers.get(h)
        if not after:
            return p(h[1:], w)
        if w in after:
            return seen(h, after[w])
        left = 1 - sum(seen(h, c) for c in after.values())
        return left / (1 - sum(p(h[1:], x) for x in after)) * p(h[1:], w) if h else left
    for h in [h for h in followers if len(h) == order - 1][:12]:  # exactly normalised
        assert sum(p(h, w) for w, in grams[1]) + p(h, b"\0 never") == pytest.approx(1)
    return [(i, sum(math.log10(p(tuple(full[max(0, at - order + 1):at]), full[at])) for at in range(1, len(full)))) for i, full in docs]


@pytest.mark.parametrize(("order", "hot"), [(3, 10_000), (3, 20), (4, 10_000)])
def test_katz_of_higher_order_against_recursion(make_docs, edge_rows, order, hot, monkeypatch):
    monkeypatch.setattr(katz, "HOT", hot)
    rows = [r for r in edge_rows if r[0] != 13] + [(1000 + i, f"w{i % 7} w{i % 5} w{i % 11} common w{i % 3} common x{i} w{i % 7} w{i % 5}", "en") for i in range(120)]
    got = sorted(((r["doc_id"], r["score"]) for r in katz.score_documents(make_docs(rows), part_bytes=3000, order=order).collect()), key=key)
    want = sorted(katz_scores_by_recursion(rows, order), key=key)
    assert [i for i, _ in got] == [i for i, _ in want]
    assert [x for _, x in got] == pytest.approx([x for _, x in want], rel=1e-9)


def test_the_query_scores_by_three_words(spark, sf, monkeypatch):
    orders = []
    monkeypatch.setattr(katz, "score_documents", lambda docs, order=2: orders.append(order))
    queries.op4_katz_backoff(spark, sf)
    assert orders == [3]


def test_katz_reads_stored_answers_without_a_shuffle(make_docs, edge_rows, monkeypatch):
    plans, stored = {}, katz.stored

    def keep(df, name, *partition_by):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return stored(df, name, *partition_by)
    monkeypatch.setattr(katz, "stored", keep)
    katz.score_documents(make_docs(edge_rows), part_bytes=3000, order=3)
    assert "InArrow" in plans["scores"] and "Exchange" not in plans["scores"]


def test_profiles_and_places_by_frequency_come_back():
    rng = np.random.default_rng(0)
    profiles = np.column_stack([rng.integers(0, 10, (50, katz.DISCOUNTED + 1)), rng.random(50)])
    for n in (0, 1, 50):
        assert np.array_equal(katz._read_profiles(katz._write_profiles(profiles[:n]), n), profiles[:n])
    one, number = katz._numbered(np.array([7, 3, 7, 9, 3, 7], np.uint64))
    assert number.tolist() == [1, 0, 1, 2, 0, 1] and [number[i] for i in one] == [0, 1, 2]


def test_katz_without_texts(make_docs):
    assert katz.score_documents(make_docs([])).collect() == []
    row, = katz.score_documents(make_docs([(1, None, None)])).collect()
    assert row["n_tokens"] == 1 and row["score"] <= 0


def test_discounts_stay_in_bounds():
    for n in ([0] * 6, [5, 0, 0, 0, 0, 0], [100, 40, 20, 10, 6, 4], [1, 1, 1, 1, 1, 1], [10, 50, 3, 2, 1, 1]):
        factors = katz.good_turing(np.array(n)).of(np.arange(1, 9))
        assert ((factors > 0) & (factors <= 1)).all() and factors[0] < 1
