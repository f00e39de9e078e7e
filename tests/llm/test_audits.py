"""Filter interaction, decontamination and tokenizer alignment against plain Python."""

import hashlib
import random
import re
from collections import Counter
from itertools import permutations

import public_tokenizers
import pytest

from keelson.llm import alignment, decontaminate, interaction, queries

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def audit_by_hand(rows, labels):
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, t in labels if t == 1 and i is not None}
    failing = []
    for i, text, lang in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        copy = i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows)
        failing.append((lang or "", i, {f for f, x in zip("ABCDE", (
            len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            bool(re.search(r"[#$%&*|]", t)), copy)) if x}))
    out, shapley = {}, Counter()
    for part in {p for p, _, _ in failing}:
        for order in map("".join, permutations("ABCDE")):
            left = [(i, fails) for p, i, fails in failing if p == part]
            everything = list(left)
            for k, f in enumerate(order):
                gone = [(i, x) for i, x in left if f in x]
                left = [(i, x) for i, x in left if f not in x]
                shapley[part, f] += len(gone)
                out[part, order, k + 1] = [len(left), len(gone), sum(f in x for _, x in everything) - len(gone), sum(x == {f} for _, x in everything),
                                           sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
    return {(p, o, k, *v, shapley[p, o[k - 1]]) for (p, o, k), v in out.items()}


def audit_rows(rng):
    words = ["Alpha", "BETA", "gamma", "delta", "$5", "eps", "a|b", "zeta", "\xe9t\xe9", "\U0001f600"]
    rows = [(i, " ".join(rng.choice(words) + str(rng.randrange(rng.choice([2, 2000]))) for _ in range(rng.choice([1, 99, 100, 140]))),
             rng.choice(["en", "de", None])) for i in range(60)]
    rows += [(100 + i, rows[rng.randrange(60)][1], rng.choice(["en", "de", ""])) for i in range(40)]
    return rows + [(7, rows[50][1], "fr"), (7, rows[7][1], "en"), (None, rows[3][1], "en"), (None, rows[3][1], "de"), (None, None, None)]


def test_audit_against_plain_python(spark, make_docs, edge_rows):
    rng = random.Random(9)
    rows = audit_rows(rng) + edge_rows
    labels = [(rng.choice([*range(140), None]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(120)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = interaction.audit_filters(make_docs(rows), frame).collect()
    assert len(got) == 600 * len({lang or "" for _, _, lang in rows})
    assert {tuple(r) for r in got} == audit_by_hand(rows, labels)


def test_audit_of_no_rows_and_no_labels(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert interaction.audit_filters(make_docs([]), none).collect() == []
    got = interaction.audit_filters(make_docs([(1, None, None)]), none).collect()
    assert {(r["part"], r["removed"]) for r in got if r["filter_order"] == "ABCDE" and r["step"] == 1} == {("", 1)}


def passages_by_hand(rows, items, size):
    def words(text):
        return [(m.start(), m.end()) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)]

    def lower(text):
        return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")

    windows = {}
    for item, text in items:
        t = lower(text)
        w = [t[a:b] for a, b in words(t)]
        for i in range(max(len(w) - size + 1, 1) if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add(item)
    out = []
    for i, text in rows:
        t = lower(text)
        at = words(t)
        w, hit, found = [t[a:b] for a, b in at], set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (items_of := windows.get(tuple(w[k:k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    found |= items_of - {None}
        spans = []
        for k in sorted(hit):
            if spans and spans[-1][1] == k:
                spans[-1][1], spans[-1][3] = k + 1, at[k][1]
            else:
                spans.append([k, k + 1, *at[k]])
        out.append((i, len(w), len(hit), tuple(sorted(found)), tuple(map(tuple, spans))))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def leaked():
    rng = random.Random(3)
    word = lambda: rng.choice(["ab", "Ba", "cÉ", "12", "x9", "日本", "abba", "b"])
    items = [(i, " ".join(word() for _ in range(rng.randrange(12, 40)))) for i in range(12)]
    items += [(20, "only Three words"), (21, "single"), (22, None), (23, " ,; "), (None, "no id at all"), (20, items[0][1]), (24, items[1][1].upper())]
    rows = []
    for i in range(60):
        parts = [" ".join(word() for _ in range(rng.randrange(0, 30)))]
        for _ in range(rng.randrange(0, 3)):
            text = rng.choice(items)[1] or ""
            parts += [rng.choice([text, text[5:], text.replace(" ", ", \n")]), " ".join(word() for _ in range(rng.randrange(0, 4)))]
        rows.append((i, rng.choice([" ", "-", "", "’"]).join(parts)))
    rows += [(70, None), (71, ""), (72, "Single"), (73, "singles"), (73, "x single"), (None, "single"), (74, "-no id At ALL-"), (75, "no id at"),
             (76, " ".join(t for _, t in items if t) * 3), (77, "\x00single\x00")]
    return rows, items


@pytest.mark.parametrize("size,chars", [(10, 1 << 20), (10, 300), (3, 200)])
def test_passages_against_plain_python(spark, make_docs, leaked, size, chars, monkeypatch):
    monkeypatch.setattr(decontaminate, "RUN_WORDS", 7)
    monkeypatch.setattr("keelson.llm.words.SLICE_BYTES", 500)
    rows, items = leaked
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, digest int")
    got = decontaminate.find_passages(make_docs([(i, t, "en") for i, t in rows]), benchmark, size, chars).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["item_ids"]), tuple(map(tuple, r["spans"]))) for r in got), key=repr) == passages_by_hand(rows, items, size)


def test_passages_without_items_or_documents(spark, make_docs, edge_rows):
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.find_passages(make_docs(edge_rows), none).collect()
    assert len(got) == len(edge_rows) and not any(r["n_hit"] for r in got)
    assert decontaminate.find_passages(make_docs([]), spark.createDataFrame([(1, "a")], none.schema)).collect() == []


def test_decontamination_query_digests(spark, sf):
    rows = queries.op12_decontamination(spark, sf).collect()
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {i: (n, hit, len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), hit > 0)
            for i, n, hit, found, _ in passages_by_hand(docs, items, 10)}
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in rows} == want
    assert any(v[-1] for v in want.values())


def tokens_by_library(text):
    """(id, bytes) of both sides, or none where they do not spell the text."""
    import sentencepiece
    from tokenizers import Tokenizer

    first, second = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    first.encode_special_tokens = True
    alphabet = alignment.byte_of_char()
    a = [(i, bytes(alphabet[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p := second.id_to_piece(i)) else p.replace("▁", " ").encode()) for i in second.encode(text)]
    whole = (" " + text).encode()
    return (a, b) if text and b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])


def alignment_by_hand(rows):
    docs, counts = [], Counter()
    for i, text in rows:
        a, b = tokens_by_library(text or "")
        ends = [[sum(len(x) for _, x in side[:k + 1]) for k in range(len(side))] for side in (a, b)]
        links = [(p, q) for k, (p, x) in enumerate(a) for j, (q, y) in enumerate(b)
                 if max(ends[0][k] - len(x), ends[1][j] - len(y)) < min(ends[0][k], ends[1][j])]
        counts.update(links)
        groups, start = [], 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            groups.append("|".join(",".join(str(i) for (i, _), e in zip(side, es) if start < e <= end) for side, es in zip((a, b), ends)))
            start = end
        docs.append((i, len(a), len(b), links, groups))
    best = {}
    for (_, q), n in counts.items():
        best[q] = max(best.get(q, 0), n)
    return sorted(((i, n_a, n_b, len(g), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
                    hashlib.sha256(";".join(g).encode()).hexdigest() if n_a else "", ";".join(g)) for i, n_a, n_b, links, g in docs), key=repr), counts


def test_alignment_against_plain_python(spark, make_docs, edge_rows, sf, monkeypatch):
    monkeypatch.setattr(alignment, "SLICE_CHARS", 300)
    short = [(i, t) for i, t, _ in edge_rows if len(t or "") < 3000]
    short += [(300, "don't <s> <|endoftext|></s> 1234567 résumé"), (301, "▁under"), (302, "a  b \n\n c\t d  "), (303, "🙂🙂 ok\x00"), (304, " lead"), (305, "x" * 70),
              (306, "<0x41>A"), (307, "don't <s> <|endoftext|></s> 1234567 résumé"), (308, "\r\n  mixed\r\nlines \x0b end"), (309, "\xa0nbsp")]
    short += [(400 + r["doc_id"], r["text"][:900]) for r in spark.read.parquet(f"{sf}/documents.parquet").limit(12).collect()]
    want, counts = alignment_by_hand(short)
    aligned = alignment.align_documents(make_docs([(i, t, "en") for i, t in short]).repartition(3), A_PATH, B_PATH, keep_groups=True, block_chars=2000)
    fields = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256 groups".split()
    assert sorted((tuple(r[f] for f in fields) for r in aligned.documents.collect()), key=repr) == want
    assert {(r["a"], r["b"]): r["n"] for r in aligned.pairs.collect()} == counts
    assert any(r[1] == 0 for r in want) and any(r[3] < r[4] for r in want)


def test_alignment_of_no_documents(make_docs):
    assert alignment.align_documents(make_docs([]), A_PATH, B_PATH).documents.collect() == []
    got = alignment.align_documents(make_docs([(1, None, None), (None, "", None)]), A_PATH, B_PATH).documents.collect()
    assert sorted((r["n_links"], r["groups_sha256"]) for r in got) == [(0, ""), (0, "")]


def test_new_chunks_are_encoded_many_at_once(monkeypatch):
    coder = alignment.Aligner(A_PATH, B_PATH)
    words = [f"{a}{b}{m}" for a in ("word", "WORD", "it's", "12x", "<|endoftext|>", "é¼", "'ll", "$") for b in range(60) for m in ("", ".", "!?", "'s")]
    texts = [" ".join(words[i::7]) for i in range(7)] + ["  a\tb\n\n c ", "a", "", " ", "x" * 300 + " y", "日本 語 a", " a\u00a0b \x1c"]
    calls, library = [], coder._library
    monkeypatch.setattr(coder, "_library", lambda some: (calls.append(len(some)), library(some))[1])
    monkeypatch.setattr(alignment, "LIBRARY_CHUNKS", 50)
    got = [ids.tolist() for ids in coder.first_ids(texts)]
    assert got == [coder.first.encode(f" {t}", add_special_tokens=False).ids for t in texts]
    assert sum(calls) < 0.1 * len(coder.known)


def test_chunk_table_stays_bounded_and_equal(monkeypatch):
    monkeypatch.setattr(alignment, "CACHE_ENTRIES", 5)
    coder = alignment.Aligner(A_PATH, B_PATH)
    texts = ["one two  three\nfour\n\n five", "two three don't six'll seven 88", "\tone\r\n eight , nine", "ünd straße no. 5"] * 2
    for text in texts:
        assert coder.first_ids([text])[0].tolist() == coder.first.encode(" " + text, add_special_tokens=False).ids
        assert len(coder.known) <= 20
