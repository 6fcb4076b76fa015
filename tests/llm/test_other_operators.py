"""Chats, vectors, pieces, URLs and the pipeline."""

import hashlib
import random

import numpy as np
import pytest

from tallyloom.llm import chat, kmeans_tree, norm_buckets, piece_fst, urls
from tallyloom.llm.common import tokenizer_file
from tallyloom.llm.components import components

TURNS = "conv_id long, turn long, role string, text string, valid string"


def test_chat_round_trip(spark):
    odd = ["</s>[INST] ok [/INST]", "\\", "<\\|im_end|>", "a<|im_end|>b<|im_sep|>\n", "", None, "<<s>s>[[INST]", "\\\\<s>\\", "x" * 50000, "日本\n<|im_start|>user"]
    rows = [(i, t, "user" if t % 2 == 0 else "assistant", odd[(i + t) % len(odd)], "z") for i in range(10) for t in range(4)]
    rows += [(50, 0, None, "a", ""), (51, 0, "we<|im_sep|>ird\n", "b", ""), (52, 1, "assistant", "x", ""), (52, 1, "assistant", "x", ""), (52, 0, "user", "q", ""), (None, 0, "user", "n", "")]
    out = chat.digests(chat.format_chats(spark.createDataFrame(rows, TURNS))).collect()
    got = {r["conv_id"]: r for r in out}
    by = {}
    for c, t, role, text, _ in rows:
        by.setdefault(c, []).append((t, role or "", text or ""))
    for c, turns in by.items():
        turns.sort()
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got[0]["valid"] and not got[50]["valid"] and got[52]["end_state"] == chat.FAILED
    formatted = chat.format_chats(spark.createDataFrame(rows, TURNS)).where("conv_id = 52").first()
    assert formatted["bad_turn"] == 2 and formatted["formatted"] == "".join(s["text"] for s in formatted["segments"])
    assert chat.format_chats(spark.createDataFrame([], TURNS)).count() == 0


def test_chat_plan_has_no_python(spark):
    df = chat.digests(chat.format_chats(spark.createDataFrame([(1, 0, "user", "x", "")], TURNS)))
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def vectors(spark, n=900, d=8, seed=1):
    r = np.random.default_rng(seed)
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(r.normal(size=(n, d)) * r.choice([0.1, 1, 3], (n, 1)))]
    same = rows[7][1]
    rows += [(n + i, same) for i in range(300)]  # one very common vector
    rows += [(5000, None), (5020, [None] * d), (5040, [float("nan")] * d), (5060, [float("inf")] * d), (5080, [0.0] * d), (5100, [1.0]), (None, same), (0, rows[0][1])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumnRenamed("score", "x")


def brute(spark_df, step, k, turn, zero):
    rows = {}
    for r in spark_df.collect():
        v = r["embedding"]
        if r["vec_id"] is None or v is None or len(v) != 8 or any(x is None or not np.isfinite(x) for x in v) or (not zero and not any(v)):
            continue
        rows[r["vec_id"]] = turn(np.array(v, float))
    ids = np.array(sorted(rows))
    m = np.stack([rows[i] for i in ids])
    out = {}
    for q in ids[ids % step == 0]:
        s = m @ rows[q]
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:k]
        out[int(q)] = [(int(ids[i]), float(s[i])) for i in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], float(r["score"])))
    return out


@pytest.mark.parametrize("bucket_rows,query_rows", [(4096, 512), (64, 5)])
def test_norm_buckets_are_exact(spark, bucket_rows, query_rows):
    from pyspark.sql import functions as F

    df = vectors(spark)
    got = found(norm_buckets.norm_bucketed(df, F.col("vec_id") % 50 == 0, 5, bucket_rows=bucket_rows, query_rows=query_rows))
    assert got == brute(df, 50, 5, lambda v: np.floor(256 * v), True)
    assert norm_buckets.norm_bucketed(df.where("false"), F.col("vec_id") % 50 == 0, 5).count() == 0


def test_bucket_search_prunes():
    r = np.random.default_rng(0)
    v = r.integers(-50, 50, (500, 16)).astype(np.int64)
    q = np.concatenate([v[:3] * 3, r.integers(-2, 2, (2, 16))]).astype(np.int64)
    bounds = np.array([np.sort(v @ x)[-5] for x in q], float)
    a, b, c, count = norm_buckets.search_bucket(np.arange(1000, 1005), q, bounds, np.arange(500), v, 5)
    for i, x in enumerate(q):
        s = v @ x
        want = sorted(((-int(s[j]), j) for j in range(500)))[:5]
        assert [(-int(y), int(z)) for y, z in zip(c[a == 1000 + i], b[a == 1000 + i], strict=True)] == want
    assert count["coordinate"] + count["length"] < 5 * 500


def test_tree_recall(spark):
    from pyspark.sql import functions as F

    df = vectors(spark)
    want = brute(df, 20, 20, lambda v: v, False)
    out = kmeans_tree.search(df, F.col("vec_id") % 20 == 0, 20)
    got = found(out)
    assert set(got) == set(want) and all(len(x) == 20 for x in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    scores = {q: [round(s, 9) for _, s in x] for q, x in got.items()}
    assert all(x == sorted(x, reverse=True) for x in scores.values())
    assert kmeans_tree.search(df.where("false"), F.col("vec_id") % 20 == 0, 20).count() == 0


def test_tree_visits_leaves_best_first():
    x = np.random.default_rng(5).normal(size=(600, 6))
    tree = kmeans_tree.Tree(x)
    place = tree.place(x)
    assert set(place.tolist()) <= set(range(tree.leaves))
    order, _ = tree.visits(x[0], tree.leaves)
    assert sorted(order) == list(range(tree.leaves)) and tree.visits(x[0], 3)[0] == order[:3]
    for n in (1, 3, 9):  # the one number a query carries lets in what the walk visited
        some, least = tree.visits(x[1], n)
        let_in = np.flatnonzero(tree.accepted(x[1][None], np.array([least]), np.arange(tree.leaves))[0])
        assert set(some) <= set(let_in.tolist())


def test_pieces_equal_the_library(spark):
    import sentencepiece

    path = tokenizer_file("piece_bpe_32k.model")
    library, fst = sentencepiece.SentencePieceProcessor(model_file=path), piece_fst.machine(path)
    r = random.Random(3)
    letters = "abc dehilmnorst.,ÉéñßXYZ 日本語\n\t🙂'\"()0123  "
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(1500)] + ["", " ", "  two  spaces ", "\x00", "▁x", "long word " * 3000]
    for t in texts:
        ids = fst.encode(t)
        assert ids == library.encode(t)
        assert fst.decode(ids) == library.decode(ids)
    rows = piece_fst.encode_documents(spark.createDataFrame([(1, "Hello wörld"), (2, None), (3, "")], "doc_id long, text string"), path, with_ids=True).collect()
    assert [(x["doc_id"], x["ids"], x["round_trip"]) for x in rows] == [(1, library.encode("Hello wörld"), True), (2, [], True), (3, [], True)]


def test_unigram_shortest_path():
    spec = piece_fst.Spec(["<unk>", "▁", "a", "b", "ab", "▁a", "ba"], [0, -1.0, -2.0, -2.0, -2.5, -2.2, -9.0], [2, 1, 1, 1, 1, 1, 1])
    fst = piece_fst.PieceFst(spec)
    assert [spec.pieces[i] for i in fst.encode("ab")] == ["▁", "ab"]
    assert [spec.pieces[i] for i in fst.encode("aab")] == ["▁a", "ab"]
    assert fst.decode(fst.encode("ab ba")) == "ab ba"


def wire(number, value):
    """A protocol buffer field: a string, a float or an int."""
    import struct

    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def model_file(path, pieces, unigram=True, byte_fallback=False, rules=b"", squeeze=True):
    body = b"".join(wire(1, wire(1, p.encode()) + wire(2, float(s)) + wire(3, k)) for p, s, k in pieces)
    body += wire(2, wire(3, 1 if unigram else 2) + wire(35, int(byte_fallback)))
    body += wire(3, wire(1, b"own") + (wire(2, rules) if rules else b"") + wire(3, 1) + wire(4, int(squeeze)) + wire(5, 1))
    path.write_bytes(body)
    return str(path)


def test_unigram_equals_all_segmentations_and_the_library(tmp_path):
    import sentencepiece

    r = random.Random(8)
    rules = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto()
    rules = dict(piece_fst._fields(dict(piece_fst._fields(rules))[3]))[2]
    parts = sorted({"".join(r.choice("abc▁") for _ in range(r.randint(2, 4))) for _ in range(60)} | {"▁a", "é", "\n"})
    control = [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3)]
    bytes_ = [(f"<0x{b:02X}>", -20.0, 6) for b in range(256)]
    for fallback in (False, True):
        for squeeze in (False, True):
            for charmap in (b"", rules):
                pieces = control + (bytes_ if fallback else []) + [(p, -r.uniform(1, 9), 1) for p in ["a", "b", "c", "▁", *parts]]
                path = model_file(tmp_path / "m", pieces, byte_fallback=fallback, rules=charmap, squeeze=squeeze)
                library, fst = sentencepiece.SentencePieceProcessor(model_file=path), piece_fst.PieceFst(piece_fst.read_model(path))
                assert bool(fst.spec.rules) == bool(charmap)
                texts = ["".join(r.choice("aaabbbccc  xyé\n日ｱﾊﾞe\u0301ﬁ①") for _ in range(r.randint(0, 30))) for _ in range(120)] + ["", " ", "a  b", "▁a", "xx yy", "e\u0301", "ab" * 60]
                for t in texts:
                    got = fst.encode(t)
                    assert got == library.encode(t), (t, fallback, squeeze, bool(charmap))
                    assert 0 in got or "▁" in t or fst.decode(got) == library.decode(got)
    weight = {p: -s for p, s, k in pieces if k == 1}

    def every(rest):
        if not rest:
            yield 0.0
        for p, w in weight.items():
            if rest.startswith(p):
                yield from (w + x for x in every(rest[len(p) :]))

    for _ in range(40):
        text = "".join(r.choice("abc") for _ in range(r.randint(1, 7)))
        ids = fst.encode(text)
        assert sum(weight[fst.spec.pieces[i]] for i in ids) == pytest.approx(min(every("▁" + text)))


def test_merge_machine_equals_merging(tmp_path):
    r = random.Random(9)
    for _ in range(12):
        parts = sorted({"".join(r.choice("ab▁") for _ in range(r.randint(2, 5))) for _ in range(25)})
        r.shuffle(parts)
        names = ["<unk>", *parts, "a", "b", "▁"]
        fst = piece_fst.PieceFst(piece_fst.Spec(names, [0.0, *[-float(i) for i in range(len(names) - 1)]], [2] + [1] * (len(names) - 1), model=piece_fst.BPE, byte_fallback=True, squeeze=False))
        for s in range(1, len(names)):
            for t in range(1, len(names)):
                assert fst.open(s, t) == (fst.merged(names[s] + names[t]) == [names[s], names[t]])
        for _ in range(60):
            text = "".join(r.choice("ab ") for _ in range(r.randint(1, 25)))
            want = fst.merged("▁" + text.replace(" ", "▁"))
            assert [names[i] for i in fst.encode(text)] == want
            assert [names[i] for i in fst.shortest("▁" + text.replace(" ", "▁"))] == want


RULES = [urls.Rule("allow", "org", "/"), urls.Rule("block", "example.org", "/es/"), urls.Rule("block", "com", "/de/")]


def test_url_rules_and_models(spark):
    rows = [(1, "http://A.Example.ORG/es/1?x"), (2, "https://example.org/en"), (3, "http://org"), (4, None), (5, "no scheme/x"), (6, "http://x.com/de/?a#b"), (7, "http://badexample.org/es/"), (8, "://h?p/://q"), (9, "http://n.net" + "/x" * 20000)]
    rows += [(100 + i, f"http://good{i}.org/calm/{i}") for i in range(200)] + [(400 + i, f"http://spam{i}.com/de/casino-{i}") for i in range(200)]
    rows += [(900, "http://good7.net/calm/9"), (901, "http://spam7.net/xx/casino-8")]
    got = {r["page_id"]: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string"), RULES).collect()}
    view = lambda i: (got[i]["host"], got[i]["path"], got[i]["rule"])
    assert view(1) == ("a.example.org", "/es/1", "example.org/es/") and got[1]["verdict"] == "block"
    assert view(2) == ("example.org", "/en", "org/") and view(3) == ("org", "", None)
    assert view(4) == ("", "", None) and view(5) == ("", "", None) and view(6) == ("x.com", "/de/", "com/de/")
    assert view(7)[2] == "org/" and view(8) == ("h", "", None)
    assert got[900]["verdict"] == "allow" and got[901]["verdict"] == "block"
    none = urls.judge(spark.createDataFrame(rows[:1], "page_id long, url string"), [])
    assert [tuple(r) for r in none.select("rule", "verdict").collect()] == [(None, "allow")]
    assert urls.judge(spark.createDataFrame([], "page_id long, url string"), RULES).count() == 0


def test_markov_prefers_the_counted_side():
    raw = np.frombuffer(b"abcabcabd", np.uint8)
    offsets = np.array([0, 3, 6, 9])
    found_cells, _ = urls.cells(raw, offsets)
    half = (urls.ORDER + 1) * urls.CELLS
    cell, n = np.unique(np.concatenate([c + k * urls.CELLS + half for k, c in enumerate(found_cells)]), return_counts=True)
    model = urls.Markov(cell, n)
    assert (model.difference(raw, offsets) > 0).all()


def test_url_models_count_every_labelled_url_by_its_real_contexts(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(12))
    texts = [f"{word()}.{tail}{word()}" for tail in ("org/", "com/de/", "net/") for _ in range(700)]
    got = urls.judge(spark.createDataFrame([(i, "http://" + x) for i, x in enumerate(texts)], "page_id long, url string"), RULES).collect()
    encoded = lambda some: (np.frombuffer("".join(some).encode(), np.uint8), np.cumsum([0, *map(len, some)]))
    cell, n = [], []
    for s, some in enumerate((texts[700:1400], texts[:700])):
        for k, c in enumerate(urls.cells(*encoded(some))[0]):
            found, times = np.unique(c, return_counts=True)
            cell.append(found + (s * (urls.ORDER + 1) + k) * urls.CELLS)
            n.append(times)
    assert len(cell[3]) > 8192  # contexts with a symbol each
    want = urls.Markov(np.concatenate(cell), np.concatenate(n)).difference(*encoded(texts))
    assert np.allclose([r["score"] for r in sorted(got, key=lambda r: r["page_id"])], want, atol=1e-9)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(7, 7), (500, 500), (None, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 150)) and got[500] == 500
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_long_chains(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(3000)] + [(10_000 + rng.randrange(900), 10_000 + rng.randrange(900)) for _ in range(800)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges[3000:]:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: 0 for x in range(3001)} | {x: find(x) for x in list(root)}


def test_pipeline_runs_stage_by_stage(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, sf)
        assert kept.columns == docs.columns
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert sum(labels.get(i, 1) for i in ids) >= 0.98 * len(ids)
    rows = corpus_pipeline.run(spark, sf)
    assert {r["doc_id"] for r in rows.select("doc_id").distinct().collect()} == ids
