"""Operators that SQL cannot express, against plain versions of the same definitions, and awkward rows."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import kmeans_tree, langid, ngrams, near_dedup, norm_buckets, packing, piece_fst, quality, urls
from tallyloom.llm.common import tokenizer_file
from tests.llm.test_text_operators import brute_components, docs_of, varied


def sentence(r, n, words="calm water flows under old bridges at night while people sleep near the harbour lights".split()):
    return " ".join(r.choice(words) + str(r.randrange(30)) for _ in range(n))


def test_near_dedup_of_an_id_with_two_texts(spark):
    r = random.Random(1)
    a, b = sentence(r, 60), sentence(r, 60)
    near = b.rsplit(" ", 2)[0] + " new ending"
    rows = [(3, a), (3, b), (7, near), (8, near), (9, sentence(r, 60)), (1, a)]
    got = sorted((x["doc_id"], x["component_id"], x["kept"]) for x in near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, 1, True), (3, 1, False), (3, 1, False), (7, 1, False), (8, 1, False), (9, 9, True)]


def test_near_dedup_of_a_long_chain(spark):
    r = random.Random(2)
    words = sentence(r, 120).split()
    texts = []
    for i in range(1000):  # each document rewrites a few words of the one before
        texts.append(" ".join(words))
        words[(3 * i) % 118 : (3 * i) % 118 + 2] = [f"x{i}", f"y{i}"]
    got = {x["doc_id"]: x["component_id"] for x in near_dedup.near_dedup(docs_of(spark, texts)).collect()}
    assert set(got.values()) == {0}


@pytest.mark.parametrize("limits", [{"group_docs": 6}, {"group_shingles": 300}, {"group_docs": 4, "group_shingles": 100}])
def test_near_dedup_in_blocks(spark, limits):
    r = random.Random(5)
    base = sentence(r, 80).split()
    texts = varied(60)
    for i in range(60):
        words = list(base)
        for _ in range(r.randrange(10)):
            words[r.randrange(80)] = f"z{r.randrange(40)}"
        texts.append(" ".join(words))
    want, _ = brute_components(texts)
    got = {x["doc_id"]: x["component_id"] for x in near_dedup.near_dedup(docs_of(spark, texts), **limits).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_columns_with_the_names_of_helpers(spark):
    r = random.Random(3)
    clash = ["__lang_pred", "__score", "__rejected", "gone_id", "row", "n", "count", "component_id", "kept"]
    texts = [sentence(r, 30) for _ in range(30)] + ["same text over and over again"] * 3
    docs = docs_of(spark, texts).select("doc_id", "text", F.lit("en").alias("lang"), *[F.lit(1).alias(c) for c in clash])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    assert langid.keep_identified(docs).columns == docs.columns and langid.keep_identified(docs).count() >= 30
    good = quality.keep_good(docs, labels, threshold=0.0)
    assert good.columns == docs.columns and good.count() == 33
    one = near_dedup.keep_one_of_each(docs.unionByName(docs.where("doc_id < 5")))
    assert one.columns == docs.columns and sorted(x["doc_id"] for x in one.select("doc_id").collect()) == list(range(31))
    path = tokenizer_file("word_bpe_49k.json")
    assert packing.pack(docs, path).select("doc_id").distinct().count() == 33
    assert piece_fst.encode_documents(docs, tokenizer_file("piece_bpe_32k.model")).count() == 33
    vectors = spark.createDataFrame([(i, [float(i + 1), 1.0], 0, 0, 0) for i in range(8)], "vec_id long, embedding array<double>, leaf int, v int, norm2 int")
    assert kmeans_tree.search(vectors, F.col("vec_id") % 4 == 0, 3).count() == 6
    assert norm_buckets.norm_bucketed(vectors, F.col("vec_id") % 4 == 0, 3).count() == 6


def test_odd_rows(spark):
    odd = spark.createDataFrame([(None, "one two three", "en"), (4, None, None), (5, "", "en"), (6, "a" * 300_000, "en"), (6, "a" * 300_000, "en"), (7, "word " * 60_000, "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(6, 1, 0), (7, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    empty = odd.where("false")
    models = tokenizer_file("word_bpe_49k.json"), tokenizer_file("piece_bpe_32k.model")
    for run in (lambda d: langid.identify(d), lambda d: quality.classify(d, labels), lambda d: near_dedup.near_dedup(d), lambda d: piece_fst.encode_documents(d, models[1])):
        assert run(odd).count() == 6 and run(empty).count() == 0
    packed = packing.pack(odd, models[0]).collect()
    assert sum(x["length"] for x in packed if x["doc_id"] == 5) == 1 and packing.pack(empty, models[0]).count() == 0
    pieces = {x["doc_id"]: x for x in piece_fst.encode_documents(odd, models[1]).collect()}
    assert all(x["round_trip"] for x in pieces.values())


def test_quality_features_are_the_texts_ngrams():
    texts = ["", "a", "It was the 1st time, the FIRST time!", "ünï çode — 日本 語", "x y " * 300]
    shapes = lambda x: x[x >= len(quality.ORDERS) << quality.BITS]
    for text, got in zip(texts, quality.Features().rows(pa.array(texts)), strict=True):
        raw = np.frombuffer(text.encode(), np.uint8)
        want = {int(ngrams.hashed(raw[i : i + n], n, quality.BITS, False)[0]) + (j << quality.BITS) for j, n in enumerate(quality.ORDERS) for i in range(len(raw) - n + 1)}
        assert len(got) == len(set(got.tolist()))
        assert set(got.tolist()) - set(shapes(got).tolist()) == want


def test_svm_reaches_the_optimum():
    r = np.random.default_rng(4)
    rows = [np.unique(r.integers(0, 40, 12) + (20 if i % 3 else 0)) for i in range(60)]
    y = np.array([1.0 if i % 3 else -1.0 for i in range(60)])
    y[::7] *= -1
    flat = quality.Rows.of(rows)
    weights, squares = quality.fit_svm(flat, np.arange(60), y, epochs=3000)
    # the plain version: dense rows, log ratios by counting, the same dual by projected steps until it stands still
    p, q = np.ones(quality.WIDTH), np.ones(quality.WIDTH)
    for row, side in zip(rows, y, strict=True):
        (p if side > 0 else q)[row] += 1
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    x = np.zeros((60, 60))
    for i, row in enumerate(rows):
        x[i, row] = ratio[row]
    x /= np.sqrt((x**2).sum(1, keepdims=True))
    x = np.hstack([x, np.ones((60, 1))])
    c = np.where(y > 0, 60 / (2 * (y > 0).sum()), 60 / (2 * (y < 0).sum()))
    dual = np.zeros(60)
    for _ in range(4000):
        for i in range(60):
            w = (dual * y) @ x
            dual[i] = np.clip(dual[i] - (y[i] * (x[i] @ w) - 1) / (x[i] @ x[i]), 0, c[i])
    w = (dual * y) @ x
    primal = lambda w: 0.5 * w @ w + (c * np.maximum(0, 1 - y * (x @ w))).sum()
    assert primal(w) == pytest.approx(dual.sum() - 0.5 * w @ w, rel=1e-6)  # no gap, so the optimum
    mine = np.append(weights[:60] / np.where(ratio[:60] == 0, 1, ratio[:60]), weights[-1])
    assert primal(mine) == pytest.approx(primal(w), rel=1e-3)
    model = quality.Model(weights, squares, 1.0, 0.0)
    assert np.allclose([model.margin(row) for row in rows], x @ w, atol=0.02)


def test_language_scores_are_mean_ngram_logits(spark):
    r = random.Random(6)
    pools = {"aa": "lorem ipsum dolor sit amet".split(), "bb": "zwischen über straße grün häuser".split()}
    rows = [(i, sentence(r, 25, pools[x]), x) for i in range(60) for x in ["aa" if i % 2 else "bb"]] + [(99, "Über LOREM " * 40_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs)
    got = {x["doc_id"]: x for x in langid.identify(docs).collect()}
    for i, text, _ in rows[:20]:
        raw = text.encode().lower()  # bytes.lower folds A-Z only
        logit, known, n = np.zeros(2), 0.0, 0
        for order in langid.ORDERS:
            for at in range(len(raw) - order + 1):
                if re.search(rb"[^a-zA-Z\x80-\xff \t-\r]", raw[at : at + order]):
                    continue
                k = int(ngrams.hashed(np.frombuffer(raw[at : at + order], np.uint8), order, langid.BITS, False)[0])
                logit, known, n = logit + model.table[k], known + model.known[k], n + 1
        z = (logit / n + model.bias) * model.heat
        p = np.exp(z - z.max())
        p /= p.sum()
        assert got[i]["lang_pred"] == model.langs[int(p.argmax())] and got[i]["score"] == pytest.approx(float(p.max()), abs=1e-6)
        assert got[i]["rejected"] == (known / n + 3 * model.scatter / math.sqrt(n / 9) < model.reject)


def test_language_gradient_is_that_of_the_loss():
    r = np.random.default_rng(1)
    rows = [(np.unique(r.integers(0, 50, 9)), None) for _ in range(40)]
    rows = [(n, r.integers(1, 4, len(n))) for n, _ in rows]
    y = np.array([int(n[0] > 3) for n, _ in rows])
    model = langid.sgd(rows, y, ["a", "b"], epochs=60)

    def loss(m):
        out = 0.0
        for (n, t), side in zip(rows, y, strict=True):
            z = (t @ m.table[n]) / t.sum() + m.bias
            out += math.log(np.exp(z).sum()) - z[side]
        return out

    assert loss(model) < 0.5 * loss(langid.sgd(rows, y, ["a", "b"], epochs=0))


def test_markov_is_witten_bell_and_sums_to_one():
    r = random.Random(7)
    texts = ["".join(r.choice("ab/.") for _ in range(r.randint(0, 9))) for _ in range(40)]
    encoded = lambda some: (np.frombuffer("".join(some).encode(), np.uint8), np.cumsum([0, *map(len, some)]))
    sides = texts[:15], texts[15:30]
    cell, n = [], []
    for s, some in enumerate(sides):
        for k, c in enumerate(urls.cells(*encoded(some))[0]):
            found, times = np.unique(c, return_counts=True)
            cell.append(found + (s * (urls.ORDER + 1) + k) * urls.CELLS)
            n.append(times)
    model = urls.Markov(np.concatenate(cell), np.concatenate(n))

    def plain(some):
        """p(symbol | context) by counting strings; symbols are the letters, the end, and 59 that never occur."""
        count = {}
        for t in some:
            for i, c in enumerate([*t, "end"]):
                for k in range(urls.ORDER + 1):
                    context = ("^" * urls.ORDER + t[:i])[len(t[:i]) + urls.ORDER - k :]
                    count.setdefault(context, {}).setdefault(c, 0)
                    count[context][c] += 1

        def p(context, symbol):
            out = 1 / 64
            for k in range(urls.ORDER + 1):
                seen = count.get(context[len(context) - k :])
                if seen:
                    out = (seen.get(symbol, 0) + len(seen) * out) / (sum(seen.values()) + len(seen))
            return out

        return p

    blocked, allowed = plain(sides[0]), plain(sides[1])
    for p in (blocked, allowed):
        for t in texts:
            context = ("^" * urls.ORDER + t)[-urls.ORDER :]
            assert sum(p(context, c) for c in [*"ab/.", "end"]) + 59 * p(context, "never") == pytest.approx(1)
    want = []
    for t in texts:
        gain = 0.0
        for i, c in enumerate([*t, "end"]):
            context = ("^" * urls.ORDER + t[:i])[-urls.ORDER :]
            gain += math.log(allowed(context, c)) - math.log(blocked(context, c))
        want.append(gain / (len(t) + 1))
    assert np.allclose(model.difference(*encoded(texts)), want)


def test_url_ties_and_clashing_columns(spark):
    rules = [urls.Rule("allow", "org", "/"), urls.Rule("block", "com", "/")]
    rows = [(i % 30, f"http://h{i % 5}.{'org' if i % 2 else 'com'}/p{i % 7}", "x", "y", 1) for i in range(120)] + [(None, "http://a.net/", "x", "y", 1)] * 2
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string, host string, rule string, score int"), rules).collect()
    assert len(got) == 122 and {x["verdict"] for x in got if x["page_id"] is None} <= {"allow", "block"}
    by = {}
    for x in got:
        by.setdefault((x["host"], x["path"]), set()).add((x["verdict"], x["score"]))
    assert all(len(v) == 1 for v in by.values())


def test_pipeline_equals_the_operators_one_by_one(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    told = {x["doc_id"] for x in langid.identify(docs).collect() if not x["rejected"]}
    kept = docs.where(F.col("doc_id").isin(list(told)))
    good = {x["doc_id"] for x in quality.classify(kept, labels).collect() if x["score"] >= 0.3}
    rows = sorted((x["doc_id"], x["text"]) for x in kept.collect() if x["doc_id"] in good)
    want, _ = brute_components([t for _, t in rows], k=5)
    ids = {rows[i][0] for i in range(len(rows)) if want[i] == i}
    got = {}
    for x in corpus_pipeline.run(spark, sf).collect():
        got.setdefault(x["doc_id"], []).append((x["start"], x["length"], x["doc_tokens"]))
    assert set(got) == ids
    for pieces in got.values():
        at = 0
        for start, length, _ in sorted(pieces):
            assert start == at
            at += length
        assert at == pieces[0][2]
