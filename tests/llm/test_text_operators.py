"""Near-duplicates, licenses, quality, languages and packing on small tables and against brute force."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tallyloom.llm import langid, licenses, near_dedup, packing, quality
from tallyloom.llm.common import tokenizer_file
from tallyloom.llm.superminhash import band_keys, signature
from tallyloom.llm.textops import U64, buffers, mix, shingles, words

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, extra=False):
    rows = [(i, t, None, "s", len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumnRenamed("n_chars", "score") if extra else df


def shingle_sets(texts, k=4):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({("short", *w)} if w else set()))
    return out


def brute_components(texts, k=4, percent=80):
    sets = shingle_sets(texts, k)
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and both * 100 >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


def varied(n, seed=1):
    r = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(400)]
    bases = [[r.choice(vocabulary) for _ in range(r.randint(8, 120))] for _ in range(6)]
    out = [None, "", " \t\n", "One two", "one  TWO", "x " * 50, "Ünïcode tëxt ça va bien"]
    for _ in range(n):
        b = list(r.choice(bases))
        for _ in range(r.randint(0, 5)):
            b[r.randrange(len(b))] = r.choice(vocabulary)
        out.append(" ".join(b))
    return out + ["y" * 3000, "long " * 30000]


@pytest.mark.parametrize("group_docs", [2048, 8])
def test_near_dedup_is_exact(spark, group_docs):
    texts = varied(150)
    want, sizes = brute_components(texts)
    got = {r["doc_id"]: r for r in near_dedup.near_dedup(docs_of(spark, texts), group_docs=group_docs).collect()}
    assert [got[i]["component_id"] for i in range(len(texts))] == want
    assert [got[i]["n_shingles"] for i in range(len(texts))] == sizes
    assert all(got[i]["kept"] == (want[i] == i) for i in got)


def test_near_dedup_edges(spark):
    empty = docs_of(spark, ["x"]).where("false")
    assert near_dedup.near_dedup(empty).count() == 0
    odd = spark.createDataFrame([(None, "a b c d e"), (3, "a b c d e"), (3, "a b c d e"), (5, "a b c d e"), (9, None)], "doc_id long, text string")
    got = sorted(map(tuple, near_dedup.near_dedup(odd).collect()), key=repr)
    assert got == sorted([(None, 2, None, True), (3, 2, 3, True), (3, 2, 3, True), (5, 2, 3, False), (9, 0, 9, True)], key=repr)
    assert sorted(r["doc_id"] or 0 for r in near_dedup.keep_one_of_each(odd).collect()) == [0, 3, 9]


def test_signatures_estimate_similarity():
    r = np.random.default_rng(0)
    errors = []
    for n, shared in ((20, 10), (100, 80), (3, 2), (500, 250)):
        for _ in range(40):
            common = mix(r.integers(0, 2**63, shared).astype(U64))
            a, b = (np.concatenate([common, mix(r.integers(0, 2**63, n - shared).astype(U64))]) for _ in range(2))
            errors.append((signature(a, 101) == signature(b, 101)).mean() - shared / (2 * n - shared))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06
    same = signature(mix(np.arange(50, dtype=U64)), 101)
    assert (band_keys(same, 4) == band_keys(signature(mix(np.arange(50, dtype=U64))[::-1], 101), 4)).all()


def test_solve_against_brute_force():
    r = np.random.default_rng(3)
    for _ in range(30):
        base = r.integers(0, 1000, 40)
        sets = []
        for _ in range(25):
            s = base.copy()
            s[r.integers(0, 40, r.integers(0, 12))] = r.integers(1000, 100000)
            sets.append(np.unique(s).astype(U64))
        parent = list(range(25))

        def find(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for i in range(25):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if both * 100 >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    a, b = sorted((find(i), find(j)))
                    parent[b] = a
        assert near_dedup.solve(sets, np.arange(25), 80).tolist() == [find(i) for i in range(25)]


def test_word_hashes_do_not_depend_on_blocks(monkeypatch):
    texts = varied(60) + ["a" * 500 + " b"]
    column = pa.array(texts)
    raw, offsets, nulls = buffers(column)
    one = words(raw, offsets)
    monkeypatch.setattr("tallyloom.llm.textops.BLOCK", 64)
    monkeypatch.setattr("tallyloom.llm.textops.blocks", lambda r, o, size=64: list(_blocks(r, o, size)))
    two = words(raw, offsets)
    assert (one[0] == two[0]).all() and (one[1] == two[1]).all() and nulls.sum() == 1
    assert len(shingles(one[0][:0], 4)) == 0


from tallyloom.llm.textops import blocks as _blocks  # noqa: E402


def test_licenses(spark):
    mit = licenses.TEMPLATES["MIT"][2]
    texts = ["Some prose.\nReleased under the MIT License.\nMore.", mit, mit.replace("to deal", "to play").replace("NONINFRINGEMENT", "x"), None, "", "MIT", "prose about license terms " * 40, "intro line\n\nLicensed under\nthe Apache License, Version 2.0.\n\nend here"]
    got = {(r["doc_id"], r["unit"], r["license"], r["unit_no"]) for r in licenses.scan(docs_of(spark, texts, extra=True)).collect()}
    assert got == {(0, "line", "MIT", 1), (1, "line", "MIT", 0), (2, "line", "MIT", 0), (7, "paragraph", "Apache-2.0", 1)}
    assert licenses.scan(docs_of(spark, texts).where("false")).count() == 0
    known = licenses.Templates(licenses.TEMPLATES)
    h = words(*buffers(pa.array(["released under the mit license"]))[:2])[0]
    assert known.best(licenses._bigrams(h), 0.9)[1] == 1.0


def prose(r, kind):
    if kind == "bad":
        return " ".join(r.choice(["buy###", "now$$$", "cheap***"]) for _ in range(30))
    return " ".join(r.choice(["calm", "water", "flows", "under", "bridges", "at", "night"]) for _ in range(30)) + "."


def test_quality_learns_and_holds_out(spark):
    from pyspark.sql import functions as F

    r = random.Random(2)
    rows = [(i, prose(r, "bad" if i % 3 == 0 else "good"), None, "s", 1) for i in range(240)] + [(900, None, None, "s", 0), (901, "", None, "s", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, int(i % 3 != 0), 0) for i in range(240)], "doc_id long, quality int, toxic int")
    got = {x["doc_id"]: x for x in quality.classify(docs, labels, held_out=F.crc32(F.col("doc_id").cast("string")) % 5 == 0).collect()}
    assert all(got[i]["predicted"] == int(i % 3 != 0) and 0 <= got[i]["score"] <= 1 for i in range(240))
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
    assert got[900]["score"] == got[901]["score"]
    assert {x["score"] for x in quality.classify(docs, labels.where("false")).collect()} == {0.5}
    clash = docs.withColumnRenamed("n_chars", "score")
    assert quality.keep_good(clash, labels).columns == clash.columns
    assert quality.classify(docs.where("false"), labels).count() == 0


def test_svm_tells_two_classes():
    rows = [np.array([0, 1]), np.array([0, 2]), np.array([3, 1]), np.array([3, 2])]
    model = quality.fit(rows, np.array([1, 1, 0, 0]))
    assert [model.score(x) > 0.5 for x in rows] == [True, True, False, False]
    assert quality.fit(rows, np.array([1, 1, 1, 1])) is None


def test_languages(spark):
    r = random.Random(4)
    pools = {"aa": ["lorem", "ipsum", "dolor"], "bb": ["zwischen", "über", "straße"], "cc": ["場所", "時間", "人々"]}
    rows = [(i, " ".join(r.choice(pools[k]) for _ in range(20)), k, "s", 1) for i, k in enumerate(list(pools) * 40)]
    rows += [(900, None, "aa", "s", 0), (901, "12 34 !!", "aa", "s", 0), (902, "", None, "s", 0), (903, "über straße " * 100000, None, "s", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    got = {x["doc_id"]: x for x in langid.identify(docs).collect()}
    assert all(got[i]["lang_pred"] == rows[i][2] for i in range(120)) and got[903]["lang_pred"] == "bb"
    assert all(got[i]["lang_pred"] == "und" and got[i]["rejected"] for i in (900, 901, 902))
    assert {x["lang_pred"] for x in langid.identify(docs.withColumn("lang", docs.lang.substr(9, 1)).where("doc_id < 0")).collect()} == set()
    kept = langid.keep_identified(docs.withColumnRenamed("source", "lang_pred"))
    assert kept.columns == ["doc_id", "text", "lang", "lang_pred", "n_chars"] and kept.count() == 121
    assert langid.has_letter(np.frombuffer("1é".encode(), np.uint8)) and not langid.has_letter(np.frombuffer("1…".encode(), np.uint8))


def test_packing_keeps_every_token(spark):
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    texts = varied(40) + ["it's DON'T <|endoftext|> a\x1cb c Σίσυφος ΣΑΣ 日本語 ÀÉ 1234", "z" * 9000, "Sentence one. " * 3000]
    for size in (4096, 64):
        rows = packing.pack(docs_of(spark, texts), path, size=size).collect()
        sequences, by = {}, {}
        for x in rows:
            by.setdefault(x["doc_id"], []).append(x)
            sequences.setdefault(x["sequence_id"], []).append(x)
        for i, t in enumerate(texts):
            ids = whole.encode(t or "", add_special_tokens=False).ids + [2]
            at = 0
            for x in sorted(by[i], key=lambda x: x["start"]):
                assert x["start"] == at and x["doc_tokens"] == len(ids)
                assert x["ids_crc32"] == zlib.crc32(np.array(ids[at : at + x["length"]], "<u4").tobytes())
                at += x["length"]
            assert at == len(ids)
        used = padded = 0
        for pieces in sequences.values():
            at = 0
            for x in sorted(pieces, key=lambda x: x["offset"]):
                assert x["offset"] == at
                at += x["length"]
            assert at <= size
            used, padded = used + at, padded + (0 if at & (at - 1) == 0 else size - at)
        assert padded <= 0.05 * used
    assert packing.pack(docs_of(spark, texts).where("false"), path).count() == 0


def test_plan_is_optimal():
    r = random.Random(6)
    for _ in range(60):
        size = r.randint(4, 20)
        xs = np.cumsum([r.randint(1, size // 2 + 1) for _ in range(r.randint(1, 12))])
        ks = np.array([r.choice([0, 1, 2]) for _ in xs])
        price = (0, packing.SENTENCE_PRICE, packing.FORCED_PRICE)
        points = [0, *xs.tolist()]
        best = [0.0] + [float("inf")] * len(xs)
        for i in range(1, len(points)):
            best[i] = min(best[j] + size - (points[i] - points[j]) + price[ks[i - 1]] for j in range(i) if points[i] - points[j] <= size)
        cuts = packing.plan(xs, ks, size)
        cost, lo = 0.0, 0
        for c in cuts:
            assert c - lo <= size
            cost += size - (c - lo) + price[ks[list(xs).index(c)]]
            lo = c
        assert points[-1] - lo <= size  # what is left fits a window and is free
        assert cost == pytest.approx(min(b for b, x in zip(best[:-1], points[:-1], strict=True) if points[-1] - x <= size))


def test_language_rejects_unlearned_and_junk(spark):
    draw = random.Random(4)
    pools = {"en": "the house stands near the river and many people walk there every morning with their children while birds sing".split(), "de": "das haus steht neben dem fluss und viele leute gehen dort jeden morgen mit ihren kindern spazieren".split()}
    say = lambda words, n=40: " ".join(draw.choice(words) for _ in range(n))
    rows = [(i, say(pools[x]), x) for i in range(300) for x in ["en" if i % 2 else "de"]]
    mixed = [(1000 + i, say(pools["en"], 20) + " " + say(pools["de"], 20), None) for i in range(20)]
    other = "kaikki ihmiset syntyvät vapaina tasavertaisina arvoltaan oikeuksiltaan heille annettu järki omatunto".split()
    strange = [(2000 + i, say(other), None) for i in range(20)]
    strange += [(3000 + i, "".join(draw.choice("qwxzjkvbypgf ") for _ in range(200)), None) for i in range(20)]
    docs = spark.createDataFrame(rows + mixed + strange, "doc_id long, text string, lang string")
    rejected = {x["doc_id"] for x in langid.identify(docs).collect() if x["rejected"]}
    assert {x[0] for x in strange} <= rejected and not {x[0] for x in mixed} & rejected
    kept = {x["doc_id"] for x in langid.keep_identified(docs).collect()}
    assert not kept & {x[0] for x in strange} and kept >= {x[0] for x in mixed}
