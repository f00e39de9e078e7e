"""Search, language, quality, URL filters and the pipeline, with edge cases."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from keelson.llm import jaccard, language, neighbours, quality, queries, url_filter


def is_query():
    return F.col("vec_id") % 20 == 0


def brute_nearest(rows, k=20):
    usable = {(i, tuple(map(float, v))) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for i, v in usable:
        if i % 20 == 0:
            near = sorted((-sum_in_order(v, w), j) for j, w in usable if j != i)[:k]
            out[i] = [(n + 1, j, -s) for n, (s, j) in enumerate(near)]
    return out


def sum_in_order(a, b):
    s = 0.0
    for x, y in zip(a, b, strict=True):
        s += x * y
    return s


def answers(frame):
    found = defaultdict(list)
    for r in frame.collect():
        found[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(v) for q, v in found.items()}


def test_neighbours_with_copies_ties_and_unusable_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=6) * rng.uniform(0.1, 4))]) for i in range(90)]
    rows += [(200 + i, rows[20][1]) for i in range(60)]  # one vector holds a third of all rows, a query among them
    rows += [(401, None), (402, []), (403, [0.0] * 6), (404, [float("nan"), *[1.0] * 5]), (405, [float("inf"), *[1.0] * 5]),
             (406, [None, *[1.0] * 5]), (None, [1.0] * 6), (407, [1.0] * 5), rows[7], rows[40]]
    frame = spark.createDataFrame([(*r, 1, 2, "z") for r in rows], "vec_id long, embedding array<float>, node long, q long, h string")
    got, want = answers(neighbours.nearest_neighbours(frame, is_query())), brute_nearest([r for r in rows if r[0] != 407])
    assert got.keys() == want.keys()
    score = {(q, j): s for q in want for _, j, s in brute_nearest([r for r in rows if r[0] != 407], 1000)[q]}
    for q, found in got.items():
        assert [s for _, _, s in found] == [score[q, j] for _, j, _ in found]
        assert [(-s, j) for _, j, s in found] == sorted((-s, j) for _, j, s in found) and len(found) == 20
    hits = sum(len({j for _, j, _ in got[q]} & {j for _, j, _ in want[q]}) for q in want)
    assert hits >= 0.97 * 20 * len(want)
    assert got[220] == want[220]  # its copies, smallest ids first


def test_recall_beside_one_very_long_vector(spark):
    rng = np.random.default_rng(8)
    vectors = np.float32(rng.normal(size=(700, 24)))
    vectors[7] *= 5000
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    got = answers(neighbours.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), is_query()))
    want = brute_nearest(rows)
    hits = sum(len({x[1] for x in got[q]} & {x[1] for x in v}) for q, v in want.items())
    assert got.keys() == want.keys() and hits >= 0.9 * 20 * len(want)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_neighbours_with_few_candidates(spark, n):
    rows = [(20 * i, [1.0 + i, -1.0]) for i in range(n)]
    got = answers(neighbours.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), is_query()))
    assert got == {q: v for q, v in brute_nearest(rows).items() if v}


def test_recall_on_the_table(spark, sf):
    got = answers(queries.op1_nearest_neighbours(spark, sf))
    want = brute_nearest([tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()])
    hits = sum(len({x[1] for x in got[q]} & {x[1] for x in v}) for q, v in want.items())
    assert got.keys() == want.keys() and hits >= 0.9 * 20 * len(want)
    assert all([x[0] for x in v] == list(range(1, 21)) for v in got.values())


def shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("|")
    return {f for f in files.split("|") if f.endswith(".data")}


def test_widened_search_leaves_no_shuffle_files(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.float32(rng.normal(size=(600, 32))))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    before = shuffle_files(spark)
    found = neighbours.nearest_neighbours(frame, is_query(), beam=21, recall=1.0)
    assert not shuffle_files(spark) - before
    got, want = answers(found), brute_nearest(rows)
    assert sum(len({x[1] for x in got[q]} & {x[1] for x in v}) for q, v in want.items()) >= 0.99 * 20 * len(want)


@pytest.mark.parametrize("block_nodes", [1 << 14, 100])
def test_search_compares_no_pair_twice_and_makes_no_row_for_a_pair(spark, monkeypatch, block_nodes):
    monkeypatch.setattr(neighbours, "BLOCK_NODES", block_nodes)
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.float32(rng.normal(size=(600, 32))))]
    compared, advance = [], neighbours.Search._compared

    def counted(search, asked):
        found = neighbours.stored(advance(search, asked), "counted")
        compared.append(found.selectExpr("count(*) AS rows", "count(DISTINCT q) AS queries", "sum(length(sim)) / 4 AS pairs").first())
        return found
    monkeypatch.setattr(neighbours.Search, "_compared", counted)
    got = answers(neighbours.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), is_query(), beam=21, recall=1.0))
    want = brute_nearest(rows)
    assert sum(len({x[1] for x in got[q]} & {x[1] for x in v}) for q, v in want.items()) >= 0.99 * 20 * len(want)
    blocks = -(-600 // block_nodes)
    assert all(r["rows"] <= blocks * r["queries"] for r in compared)
    # entry nodes may be met before or after they are due; all else is compared once
    assert sum(r["pairs"] for r in compared) <= 1.5 * len(want) * len(rows)


def test_gradients_equal_differences():
    net, rng = language.Network.fresh(["a", "b", "c"], hidden=3, kind=np.float64), np.random.default_rng(0)
    ids = rng.integers(0, 256, (5, 4))
    valid = np.ones((5, 4))
    valid[3:, 1] = 0
    ids[valid == 0] = language.PAD
    truth = np.array([0, 1, 2, 1])
    _, grads = net.loss_and_gradients(ids, valid, truth)
    for p, g in zip(net.parameters(), grads, strict=True):
        for at in [tuple(rng.integers(0, s) for s in p.shape) for _ in range(6)] + [np.unravel_index(np.abs(g).argmax(), g.shape)]:
            keep, step = p[at], 1e-6
            p[at] = keep + step
            high = net.loss_and_gradients(ids, valid, truth)[0]
            p[at] = keep - step
            low = net.loss_and_gradients(ids, valid, truth)[0]
            p[at] = keep
            assert g[at] == pytest.approx((high - low) / (2 * step), abs=1e-7)


def test_prediction_does_not_depend_on_batches_or_neighbours():
    net = language.Network.fresh(["a", "b"], seed=1)
    texts = ["short", "x" * 300, "", "é" * 129, "end"]
    encoded = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(e) for e in encoded])])
    together = language.predict(net, np.frombuffer(b"".join(encoded), np.uint8), offsets, batch=2)
    for e, p in zip(encoded, together, strict=True):
        alone = language.predict(net, np.frombuffer(e, np.uint8), np.array([0, len(e)]))[0]
        assert p == pytest.approx(alone, abs=1e-6) and (p.sum() == pytest.approx(1, abs=1e-5) if e else not p.any())


def test_languages_of_held_out_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    net = language.learn(docs, docs_per_language=60, steps=150)
    rows = language.identify(docs, net).where(language.held_out()).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edge_cases(make_docs, edge_rows):
    docs = make_docs(edge_rows)
    got = language.predict_documents(docs, docs_per_language=5, steps=3).collect()
    assert len(got) == len(edge_rows)
    known = {r["doc_id"]: r for r in got}
    assert {i for i in known if known[i]["lang_pred"] == "und"} == {1, 2, 3, 16, None}
    assert all(r["lang_pred"] in {"en", "de", "fr", "und"} for r in got)
    assert not any(r["held_out"] for r in got if r["doc_id"] is None)
    unlabelled = make_docs([(i, t, None) for i, t, _ in edge_rows])
    assert {(r["lang_pred"], r["score"]) for r in language.predict_documents(unlabelled).collect()} == {("und", 0.0)}
    assert language.predict_documents(make_docs([])).collect() == []


def test_the_bound_follows_held_out_scores_and_rejects_unlearned_texts(spark, make_docs):
    rng = random.Random(6)

    def text(syllables):
        return " ".join("".join(rng.choice(syllables) for _ in range(3)) for _ in range(60))

    kinds = {"a": ["ba", "lo", "mi"], "b": ["xu", "trk", "ze"], "c": ["ñe", "ça", "êt"]}
    rows = [(i, text(kinds[lang]), lang) for i, lang in enumerate(rng.choice("abc") for _ in range(240))]
    odd = [(1000 + i, text(list("bxñzltk0aueim")), None) for i in range(40)]
    docs = make_docs(rows + odd)
    net = language.learn(docs)
    bound = language.least_score(docs, net)
    assert 1 / 3 < bound < 1
    kept = {r["doc_id"] for r in language.keep_identified(docs).collect()}
    scores = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(docs, net, "named", "sure").selectExpr("doc_id", "named AS lang_pred", "sure AS score").collect()}
    assert kept == {i for i, (lang, score) in scores.items() if lang != "und" and score >= bound}
    assert len(kept & {i for i, _, _ in rows}) >= 0.95 * len(rows) and len(kept & {i for i, _, _ in odd}) <= 0.5 * len(odd)
    assert language.keep_identified(docs, least=0.0).count() == len(rows) + len(odd)


def test_repeated_training_is_equal():
    one, two = (language.train(["abc def", "xyz uvw"] * 3, ["a", "b"] * 3, steps=3) for _ in range(2))
    assert all((p == q).all() for p, q in zip(one.parameters(), two.parameters(), strict=True))


def brute_codes(text):
    data = text.encode()
    grams = [((data[i] | data[i + 1] << 8 | data[i + 2] << 16) * 2654435761 % 2**32) >> 16 for i in range(len(data) - 2)]
    w = data.lower().split()
    state = [1 if i >= 1 and w[i] == w[i - 1] else 2 if i >= 2 and w[i] == w[i - 2] else 0 for i in range(len(w))]
    return grams + [quality.BUCKETS + 9 * a + 3 * b + c for a, b, c in zip(state, state[1:], state[2:])]


def test_ngram_codes_against_plain_python():
    texts = ["", "a", "ab", "abc", "the the the the", "a b a b a b", "é é", "x y z", "", "last one"]
    encoded = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(e) for e in encoded])])
    codes, counts = quality.ngram_codes(np.frombuffer(b"".join(encoded), np.uint8), offsets)
    owner = quality._owners(counts)
    for i, t in enumerate(texts):
        assert sorted(codes[owner == i].tolist()) == sorted(brute_codes(t))


@pytest.fixture(scope="module")
def labelled(spark, make_docs):
    rng = random.Random(1)
    good = [(i, " ".join(rng.choice(["sun", "moon", "star", "light", "over", "river"]) for _ in range(40)), "en") for i in range(80)]
    bad = [(100 + i, " ".join(rng.choice(["###", "$$$", "BUY!!", "XXX"]) for _ in range(40)), "en") for i in range(30)]
    edge = [(201, None, None), (202, "", "en"), (203, "ab", "en"), (None, good[0][1], "en"), good[3], (204, good[5][1], "de")]
    labels = [(i, 1, 0) for i, _, _ in good[:50]] + [(i, 0, 0) for i, _, _ in bad[:20]] + [(None, 1, 0), (999, 1, 0), (5, None, 0)]
    return good + bad + edge, make_docs(good + bad + edge), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_resampling_keeps_the_target(labelled):
    rows, docs, labels = labelled
    scores, ratio, last = quality.resample(docs, labels)
    got = scores.collect()
    assert len(got) == len(rows)
    assert sorted(r["doc_id"] for r in got if r["selected"]) == sorted([*range(80), 3, 204])
    kept = quality.keep_selected(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted([*range(80), 3, 204])
    texts = {(i, t or "") for i, t, _ in rows}
    for r in got:
        assert r["n_ngrams"] in {len(brute_codes(t)) for i, t in texts if i == r["doc_id"]}
        if r["doc_id"] == 7:
            codes = brute_codes(rows[7][1])
            assert r["log_weight"] == pytest.approx(quality.LENGTH * np.mean(ratio[codes]))
        assert (r["log_weight"] is None) == (r["n_ngrams"] == 0)


def test_top_k_is_exact_and_follows_the_weights(spark, labelled):
    _, docs, labels = labelled
    scores, _, _ = quality.resample(docs, labels, k=25)
    got = scores.where("gumbel_key IS NOT NULL").collect()
    order = sorted(got, key=lambda r: (-r["gumbel_key"], r["doc_id"]))
    assert [r["selected"] for r in order].index(False) == 25
    even = spark.range(4000).select(F.col("id").alias("doc_id"), (F.col("id") % 2 * F.log(F.lit(3.0))).alias("w"))
    keyed = even.withColumn("k", quality.gumbel_key(F.col("w"), F.col("doc_id")))
    last = quality.kth_largest(keyed, "k", "doc_id", 400)
    drawn = [r["doc_id"] for r in keyed.collect() if (r["k"], -r["doc_id"]) >= (last[0], -last[1])]
    assert len(drawn) == 400 and 0.68 < np.mean([i % 2 for i in drawn]) < 0.82  # three in four


def test_resampling_without_labels_or_documents(spark, make_docs, labelled):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert not any(r["selected"] for r in quality.resample(labelled[1], none)[0].collect())
    assert quality.keep_selected(make_docs([]), labelled[2]).collect() == []


def judged_by_hand(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, tail = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end]), rest[end:]
        path = tail[:min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return host, path, None, "allow"
    top = max(f[:2] for f in fits)
    same = [f for f in fits if f[:2] == top]
    return host, path, same[0][2], "block" if any(f[3] == "block" for f in same) else "allow"


def test_url_filter_against_plain_rules(spark):
    rng = random.Random(2)
    hosts = ["a.net", "b.a.net", "net", "xnet", "example.com", "EXAMPLE.com", "m.example.com", "x.y.org", "org", "", "a..net", "net.", "é.org"]
    paths = ["", "/", "/en", "/en/", "/en/1", "/de/x?q=/en/", "?a", "#b", "/EN/", "/fr/é", "/en/#/de/"]
    rules = [("net", "/", "block"), ("a.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("org", "", "block"),
             ("y.org", "/", "allow"), ("EXAMPLE.com", "/en", "allow"), ("example.com", "/en", "block"), ("", "/", "block"), ("net.", "/", "block")]
    urls = [None, "", "no scheme.net/", "http://", "a://b://c.net/", "http://net/\n/x"] + [
        f"{rng.choice(['http', 'https'])}://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(400)]
    pages = spark.createDataFrame([(i, u, "x", "y", "z") for i, u in enumerate(urls)] + [(0, urls[0], "x", "y", "z")],
                                  "page_id long, url string, host string, rule string, key string")
    got = url_filter.judge_urls(pages, url_filter.rules_frame(spark, [*rules, (None, "/", "block"), ("q.org", None, "block")])).collect()
    assert len(got) == len(urls) + 1
    lowered = [(h.lower(), p, v) for h, p, v in rules] + [("q.org", "", "block")]
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == judged_by_hand(urls[r["page_id"]], lowered), urls[r["page_id"]]


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(30_000).select(F.concat(F.lit("key"), "id").alias("key"))
    listed = spark.createDataFrame([(f"key{i}",) for i in range(0, 30_000, 50)] + [("elsewhere",), (None,), ("key0",)], "key string")
    cascade = url_filter.build_cascade(listed, universe, bits_per_key=4)  # many false positives, so several levels
    assert len(cascade.levels) > 3
    found = {r["key"] for r in universe.where(cascade.contains(F.col("key"))).collect()}
    assert found == {f"key{i}" for i in range(0, 30_000, 50)}
    with pytest.raises(ValueError, match="max_bits"):
        url_filter.build_cascade(listed, universe, max_bits=64)


def test_url_filter_without_rules_or_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    row, = url_filter.judge_urls(pages, url_filter.rules_frame(spark, [])).collect()
    assert (row["host"], row["rule"], row["verdict"]) == ("a.net", None, "allow")
    assert url_filter.judge_urls(pages.limit(0), url_filter.rules_frame(spark, queries.URL_RULES)).collect() == []


def test_pipeline_stages(spark, sf):
    """Each stage against its own brute-force or library check, over the whole small table."""
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "language_id", "ngram_jaccard_join", "packing"]
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:3]:
        kept.append(corpus_pipeline.stored(stage(spark, kept[-1], sf), "stage"))
        assert kept[-1].columns == docs.columns
        assert kept[-1].exceptAll(kept[-2]).isEmpty()
    graded = {r["doc_id"]: r["quality"] for r in labels.collect()}
    after = {r["doc_id"] for r in kept[1].select("doc_id").collect()}
    good, bad = [i for i, q in graded.items() if q == 1], [i for i, q in graded.items() if q == 0]
    assert sum(i in after for i in good) >= 0.98 * len(good) and sum(i in after for i in bad) <= 0.02 * len(bad)
    assert kept[2].count() >= 0.99 * kept[1].count()
    sets = {}
    for r in kept[2].collect():
        w = r["text"].encode().lower().split()
        sets[r["doc_id"]] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and 5 * len(a & b) >= 4 * len(a | b):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    assert {r["doc_id"] for r in kept[3].collect()} == {find(i) for i in sets}
    rows = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"] for r in rows} == {find(i) for i in sets}
    assert all(r["offset"] + r["length"] <= 4096 for r in rows)


def test_sets_of_long_texts_do_not_depend_on_slices():
    text = " ".join(f"w{i % 97}" for i in range(3000))
    column = pa.array([text, None, text + " end"])
    (_, a, n), = jaccard.document_sets(column, 3)
    parts = [h for _, h, _ in jaccard.document_sets(column.slice(0, 1), 3)]
    assert a[:n[0]].tolist() == parts[0].tolist() and n.tolist()[1] == 0
