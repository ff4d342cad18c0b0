"""Joins, search, packing, SentencePiece and the pipeline against brute force."""

import os
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from logsift.llm import ann, packing, queries
from logsift.llm import ngram_join as nj
from logsift.llm import sentencepieces as sp
from logsift.llm.components import connected_components
from logsift.llm.shingling import shingle_sets

WORD = __import__("re").compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, component_id string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)


def shingles(text):
    w = WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def slow_join(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[a + 1 :]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = sorted((find(i), find(j)))
                root[q] = p
    return {i: (len(x), find(i)) for i, x in sets}


def near_copies(seed, n=80):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 400)}"
    passage = [word() for _ in range(40)]
    rows, i = [(0, None), (1, ""), (2, " \t"), (3, "a b"), (4, "A  b\n"), (5, "a b c d e")], 6
    for _ in range(n // 4):
        base = [word() for _ in range(rng.randint(5, 120))]
        if rng.random() < 0.5:
            at = rng.randint(0, len(base))
            base[at:at] = passage
        for _ in range(rng.randint(1, 6)):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
                t[rng.randrange(len(t))] = word()
            rows.append((i, " ".join(t)))
            i += 1
    # many short texts that are mostly one passage: dense nodes
    for _ in range(90):
        rows.append((i, " ".join(passage + [word() for _ in range(rng.randint(0, 14))])))
        i += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join_equals_all_pairs(spark, seed, monkeypatch):
    rows = near_copies(seed)
    want = slow_join(rows)
    monkeypatch.setattr(nj, "HOT", 20)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in nj.ngram_join(docs(spark, rows)).collect()}
    assert got == want


def test_ngram_join_odd_rows(spark, monkeypatch):
    assert nj.ngram_join(docs(spark, [])).count() == 0
    monkeypatch.setattr(nj, "BROADCAST_ROWS", 0)
    long = " ".join(f"z{i}" for i in range(30_000))
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "A B C D E F G"), (None, "a b c d e f g"), (None, None), (7, long), (8, long + " tail")]
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in nj.ngram_join(docs(spark, rows)).collect())
    assert got == Counter({(1, 3, 1): 2, (2, 3, 1): 1, (None, 3, 1): 1, (None, 0, None): 1, (7, 29_996, 7): 1, (8, 29_997, 7): 1})


def test_shingle_sets_count_distinct_shingles():
    texts = ["a b c d e f", "A b C d e f", "", None, "x y", "ab c d e f", "a bc d e f", "é" * 40 + " b c d e", "a b c d e a b c d e"]
    got = list(shingle_sets(texts))
    assert [len(s) for s, _ in got] == [len(shingles(t)) for t in texts]
    assert got[0][1] == got[1][1] and got[5][1] != got[6][1]


def test_components(spark):
    e = [(i, i + 1) for i in range(1, 40)] + [(100, 90), (90, 95)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(e, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 90: 90, 95: 90, 100: 90}


def test_components_of_long_paths(spark):
    rng, n = random.Random(5), 3000
    ids = rng.sample(range(10**6), n)
    path = list(zip(ids, ids[1:]))  # a chain in random order of ids
    turned = [10**7, *range(10**7 + n, 10**7, -1)]  # the root lies at the far end of a region
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(path + list(zip(turned, turned[1:])), "a long, b long")).collect()}
    assert got == {**dict.fromkeys(ids, min(ids)), **dict.fromkeys(turned, 10**7)}


def test_nearest_neighbours_recall(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16))
    x = (centres[rng.integers(0, 12, 1500)] + rng.normal(size=(1500, 16))).astype(np.float32)
    x[100:300] = x[100]  # a hot vector
    rows = [(i, v.tolist(), 0.5) for i, v in enumerate(x)]
    rows += [(5000, None, 0.0), (5020, [0.0] * 16, 0.0), (5040, [float("nan")] * 16, 0.0), (5060, [1.0], 0.0), (None, x[0].tolist(), 0.0), (0, x[0].tolist(), 0.5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score double")
    from pyspark.sql import functions as F

    out = ann.ann_search(df, F.col("id") % 20 == 0).collect()
    y, hit = x.astype(float), 0
    by: dict = {}
    for r in out:
        by.setdefault(r["query_id"], []).append(r)
    assert set(by) == set(range(0, 1500, 20))
    for q, found in by.items():
        found.sort(key=lambda r: r["rank"])
        s = ann.products(np.repeat(y[q : q + 1], len(y), axis=0), y)
        order = [i for i in np.lexsort((np.arange(len(y)), -s)) if i != q][:20]
        assert [r["rank"] for r in found] == list(range(1, 21)) and q not in {r["vec_id"] for r in found}
        assert all(r["score"] == s[r["vec_id"]] for r in found)
        assert [(-r["score"], r["vec_id"]) for r in found] == sorted((-r["score"], r["vec_id"]) for r in found)
        hit += len({r["vec_id"] for r in found} & set(order))
    assert hit / (20 * len(by)) >= 0.9


def test_nearest_neighbours_small(spark):
    from pyspark.sql import functions as F

    kind = "vec_id long, embedding array<float>"
    assert ann.ann_search(spark.createDataFrame([], kind), F.col("id") % 20 == 0).count() == 0
    out = ann.ann_search(spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [-1.0, 0.0])], kind), F.col("id") % 20 == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in sorted(out, key=lambda r: r["rank"])] == [(0, 1, 1, 1.0), (0, 2, 2, -1.0)]


def test_balanced_parts():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(640, 8))
    part = ann.balanced_parts(ann.neighbour_graph(x), 8)
    assert np.bincount(part, minlength=8).max() <= 1.05 * 80 + 1


def test_packing(spark):
    path = queries.tokenizer_path()
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    rng = random.Random(2)
    texts = [None, "", "one", "ünïcode 🙂 text", "<|endoftext|> is text"] + [" ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(rng.choice([5, 300, 1023, 1024, 2500]))) for _ in range(60)]
    texts += ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", " <|endoftext|> ", "<|endof <|endoftext|", "x" * 3000 + "<|endoftext|>" + " y" * 1500]
    rows = [(i, s) for i, s in enumerate(texts)] + [(None, "no key"), (3, texts[3])] + [(None, None)] * 40
    got = packing.best_fit_packing(docs(spark, rows), path).collect()
    by: dict = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append(r)
    for s in by.values():
        s.sort(key=lambda r: r["offset"])
        at = 0
        for r in s:
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    want = Counter()
    for i, s in rows:
        ids = np.array([*t.encode(s or "", add_special_tokens=False).ids, 2], dtype="<u4")
        cuts = packing.cuts(len(ids))
        assert all(n == 1024 for _, n in cuts[1:])
        want.update((i, k, a, n, zlib.crc32(ids[a : a + n].tobytes())) for k, (a, n) in enumerate(cuts))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    assert packing.best_fit_packing(docs(spark, []), path).count() == 0


def test_encoder_equals_the_library_both_ways(monkeypatch):
    import builtins

    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    t = Tokenizer.from_file(path)
    source = "/root/testdata/sf0.001/documents.parquet"
    import pandas as pd

    texts = [x or "" for x in pd.read_parquet(source)["text"]] if os.path.exists(source) else []
    texts += ["a <|endoftext|> b", "<|endoftext|>", "<|startoftext|>", "a\u00a0\u3000b \r\n\t c", "🙂🙃 e\u0301", ""]
    want = [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert want[texts.index("a <|endoftext|> b")] == [64, 220, 50256, 275]
    packing._loaded.clear()
    assert [packing.encoder(path)(x) for x in texts] == want
    packing._loaded.clear()
    real = builtins.open
    monkeypatch.setattr(builtins, "open", lambda f, *a, **k: (_ for _ in ()).throw(FileNotFoundError(f)) if str(f).endswith(".tiktoken") else real(f, *a, **k))
    assert [packing.encoder(path)(x) for x in texts] == want
    packing._loaded.clear()


def test_plain_rule_may_open_a_sequence_early():
    lengths = [random.Random(7).randint(1, 60) for _ in range(300)]
    seq, off = packing.sum_of_squares(np.array(lengths), 64, early=True)
    gaps: dict[int, int] = {}
    for n, b, o in zip(lengths, seq, off):
        count = Counter(g for g in gaps.values() if g)

        def after(g):
            c = count + Counter([g - n] if g > n else [])
            c.subtract([g] if g < 64 else [])
            return sum(v * v for v in c.values())

        choices = [g for g in count if g >= n] + [64]
        assert 64 - o == min(choices, key=lambda g: (after(g), g)) == gaps.get(b, 64)
        gaps[b] = 64 - o - n


def test_sum_of_squares_rule():
    lengths = sorted((random.Random(1).randint(1, 60) for _ in range(400)), reverse=True)
    seq, off = packing.sum_of_squares(np.array(lengths), 64)
    gaps: list[int] = []
    for n, b, o in zip(lengths, seq, off):
        open_ = Counter(g for g in gaps if g)
        fits = [g for g in open_ if g >= n]
        if fits:
            def after(g):
                c = open_ - Counter([g])
                return sum(v * v for v in (c + Counter([g - n] if g > n else [])).values())

            assert 64 - o == min(fits, key=lambda g: (after(g), g)) == gaps[b]
            gaps[b] -= n
        else:
            assert b == len(gaps) and o == 0
            gaps.append(64 - n)
    assert len(gaps) <= 1.1 * sum(lengths) / 64


TEXTS = [None, "", " ", "Hello  world", " lead and trail ", "tab\tand\nnewline", "naïve café 🙂 ½ ﬁ", "x" * 200, "a" * 59 + " b", "<s> ▁ <0x41>", "日本語のテキスト", "return   foo(bar)  # 10 percent", "a_b1c٣²d", "!" * 3000 + "abc" * 2000]


def unigram_library(path, pieces):
    """The library with the model file turned into a unigram model: the type in its trainer spec, and the scores."""
    import struct

    import sentencepiece

    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    def fields(b):
        i = 0
        while i < len(b):
            start, key, shift = i, 0, 0
            while True:
                key, shift, i = key | (b[i] & 127) << shift, shift + 7, i + 1
                if b[i - 1] < 128:
                    break
            n, shift, j = 0, 0, i
            if key & 7 in (0, 2):
                while True:
                    n, shift, j = n | (b[j] & 127) << shift, shift + 7, j + 1
                    if b[j - 1] < 128:
                        break
            end = {0: j, 1: i + 8, 2: j + n, 5: i + 4}[key & 7]
            yield key >> 3, b[j:end] if key & 7 == 2 else n, b[start:end]
            i = end

    score, out, k = {i: s for i, _, s, _ in pieces}, b"", 0
    for number, value, raw in fields(open(path, "rb").read()):
        if number == 1:
            inner = b"".join(r for f, _, r in fields(value) if f != 2) + b"\x15" + struct.pack("<f", score[k])
            raw, k = b"\x0a" + varint(len(inner)) + inner, k + 1
        elif number == 2:
            inner = b"".join(r for f, _, r in fields(value) if f != 3) + b"\x18\x01"
            raw = b"\x12" + varint(len(inner)) + inner
        out += raw
    return sentencepiece.SentencePieceProcessor(model_proto=out)


def test_sentencepiece_equals_the_library(spark, monkeypatch):
    pieces = sp.by_rank(sp.piece_rows(queries.model_path()))
    lib = unigram_library(queries.model_path(), pieces)
    monkeypatch.setattr(sp, "HEAD", 5)  # most units go by the shuffle
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], 1), (None, TEXTS[3], 1)], "k int, text string, ids int")
    out = sp.decode(sp.encode(df, pieces), pieces)
    assert out.columns == ["k", "ids", "decoded"]
    rows = out.collect()
    assert Counter(r["k"] for r in rows) == Counter([*range(len(TEXTS)), 3, None])
    for r in rows:
        text = TEXTS[3 if r["k"] is None else r["k"]] or ""
        assert r["ids"] == lib.encode(text)
        assert r["decoded"] == lib.decode(lib.encode(text))
    assert sp.encode(spark.createDataFrame([], "k int, text string"), pieces).count() == 0
    assert sorted(len(r["ids"]) for r in sp.encode(df.select("text"), pieces).collect()) == sorted(len(r["ids"]) for r in rows)


def test_sentencepiece_query_covers_the_documents(spark):
    source = "/root/testdata/sf0.001"
    if not os.path.isdir(source):
        pytest.skip("no tables")
    lib = unigram_library(queries.model_path(), sp.by_rank(sp.piece_rows(queries.model_path())))
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{source}/documents.parquet").collect()}
    out = queries.op5_sentencepiece(spark, source).collect()
    assert len(out) == len(texts) and {r["doc_id"]: r["ids"] for r in out} == {i: " ".join(map(str, lib.encode(t))) for i, t in texts.items()}
    assert all(r["round_trip"] for r in out)


def test_viterbi_equals_all_segmentations(spark):
    rng = random.Random(4)
    names = ["▁", "a", "b", "c", "ab", "bc", "abc", "▁a", "▁ab", "cab", "ca", "b1", "1"]
    pieces = [(0, "<unk>", 0.0, "other")] + [(i + 1, p, round(-rng.random() * 9, 3), "normal") for i, p in enumerate(names)]
    scores = {p: s for _, p, s, k in pieces if k == "normal"}
    low = min(scores.values()) - sp.UNKNOWN_PENALTY
    assert sp.splitter(pieces) is sp._TOGETHER and sp.splitter(pieces[:-2]) is sp._APART

    def best(w):
        if not w:
            return 0.0, []
        found = []
        for n in range(1, min(3, len(w)) + 1):
            s = scores.get(w[:n], low if n == 1 else None)
            if s is not None:
                t, rest = best(w[n:])
                found.append((s + t, [w[:n], *rest]))
        return max(found)

    ids = {p: i for i, p, _, _ in pieces}
    texts = ["".join(rng.choice("abcx1") for _ in range(rng.randint(1, 9))) for _ in range(30)]
    out = sp.encode(spark.createDataFrame([(t, t) for t in texts], "t string, text string"), pieces).collect()
    for r in out:
        assert r["ids"] == [ids.get(p, 0) for p in best("▁" + r["t"])[1]]


def test_units_lie_within_no_piece_and_make_up_the_text():
    pieces = sp.piece_rows(queries.model_path())
    pattern = sp.splitter(pieces)
    for t in TEXTS:
        assert "".join(sp.units_of(t, pattern)) == ("▁" + t.replace(" ", "▁") if t else "")
    assert all(len(pattern.findall(p)) == 1 for _, p, _, k in pieces if k == "normal" and not p.endswith("▁"))


def test_units_end_at_letters_but_for_pairs_that_a_piece_holds(spark, monkeypatch):
    pieces = sp.by_rank(sp.piece_rows(queries.model_path()))
    pattern = sp.splitter(pieces)
    assert sp.units_of("One.\nTwo, a1", pattern) == ["▁One", ".\n", "Two", ",", "▁a", "1"]
    assert sp.units_of("5 km².x", pattern) == ["▁5", "▁km².", "x"]  # the table has the piece "²."
    monkeypatch.setattr(sp, "HEAD", 5)
    monkeypatch.setattr(sp, "PACKED", 3)  # several records a block and task
    lib = unigram_library(queries.model_path(), pieces)
    texts = [*TEXTS, "5 km².x ². ²² a².", "One.\nTwo,three...4²."]
    out = sp.encode(spark.createDataFrame(list(enumerate(texts)), "k int, text string"), pieces).collect()
    assert {r["k"]: r["ids"] for r in out} == {i: lib.encode(t or "") for i, t in enumerate(texts)}


def test_packed_units_come_back():
    batch = pa.record_batch({"_block": [7, 5, 7, 5], "_k": pa.array([300, 2, 70000, 0], pa.int32()), "_ids": pa.array([[1, 31999], [], [70], [5, 6, 7]], pa.list_(pa.int32()))})
    rows = [r for x in sp._by_block(iter([batch.slice(1, 0), batch, batch.slice(1)])) for r in x.to_pylist()]
    assert [r["_block"] for r in rows] == [5, 7]
    assert [[v.tolist() for v in sp._units(r["_units"])] for r in rows] == [[[0, 0, 2, 2], [3, 3, 0, 0], [5, 6, 7, 5, 6, 7]], [[300, 70000, 70000], [2, 1, 1], [1, 31999, 70, 70]]]


def test_decoding_leaves_out_ids_outside_the_table(spark):
    pieces = [(0, "<unk>", 0.0, "other"), (1, "▁a", -1.0, "normal"), (2, "<0xC3>", 0.0, "byte"), (3, "<0xA9>", 0.0, "byte"), (5, "é", -2.0, "normal")]
    rows = [(0, None), (1, []), (2, [0, -1, 4, 99999999]), (3, [1, 1, 2, 3, 5]), (4, [None, 5, 2])]
    out = sp.decode(spark.createDataFrame(rows, "k int, ids array<int>"), pieces).collect()
    assert {r["k"]: r["decoded"] for r in out} == {0: "", 1: "", 2: "", 3: "a aéé", 4: "é\ufffd"}


def test_pipeline_against_brute_force(spark, tmp_path):
    import corpus_pipeline as cp

    source = "/root/testdata/sf0.001"
    if not os.path.isdir(source):
        pytest.skip("no tables")
    frame = spark.read.parquet(f"{source}/documents.parquet")
    read, kept = frame, [frame]
    for name, f in cp.STAGES:
        read = f(spark, read, source)
        read.write.parquet(str(tmp_path / name))
        read = spark.read.parquet(str(tmp_path / name))
        kept.append(read)
        if name != "best_fit_packing":
            assert read.columns == frame.columns
    toxic = {r["doc_id"] for r in queries.toxicity(frame, spark.read.parquet(f"{source}/labels.parquet")).where("predicted = 1").collect()}
    first = {r["doc_id"]: r["text"] for r in frame.collect()}
    second = {i: t for i, t in first.items() if i not in toxic}
    assert {r["doc_id"] for r in kept[1].collect()} == set(second)
    good = {r["doc_id"] for r in kept[2].collect()}
    for i, t in second.items():
        if len(WORD.findall(t)) < 20:
            assert i not in good
    groups = slow_join([(i, second[i]) for i in sorted(good)])
    assert {r["doc_id"] for r in kept[3].collect()} == {i for i in good if groups[i][1] == i}
    assert {r["doc_id"] for r in kept[4].collect()} == {r["doc_id"] for r in kept[3].collect()}


def odd_documents(spark, rows):
    """Rows of id and text with further columns that bear the names of results."""
    return spark.createDataFrame([(i, t, "en", "src", None if t is None else len(t), k, 0.5) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long, kept long, score double")


CLEAN = "The quick brown fox jumps over a lazy dog while seven wizards brew potions beside some old stone bridge near town every cold autumn night."


def test_pipeline_stages_on_odd_rows(spark):
    import corpus_pipeline as cp

    source = "/root/testdata/sf0.001"
    if not os.path.isdir(source):
        pytest.skip("no tables")
    other = "Seven wizards slept under an old oak while the river carried small boats of bark towards a harbour that nobody in the valley had ever seen before."
    rows = [(1, CLEAN), (1, CLEAN), (2, CLEAN), (2, other), (None, None), (None, CLEAN), (3, ""), (4, None), (5, " ".join(f"l{i}" for i in range(30_000))), (None, other)]
    docs = odd_documents(spark, rows)
    for f in (cp.without_toxic, cp.of_quality, cp.without_near_copies):
        assert f(spark, docs, source).columns == docs.columns
        assert f(spark, docs.limit(0), source).count() == 0
    good = cp.of_quality(spark, docs, source).collect()
    assert sorted((str(r["doc_id"]), r["text"], r["kept"]) for r in good) == sorted((str(i), t, k) for k, (i, t) in enumerate(rows) if t in (CLEAN, other))
    safe = cp.without_toxic(spark, docs, source)
    assert {r["kept"] for r in safe.collect()} <= set(range(len(rows))) and {r["score"] for r in safe.collect()} == {0.5}
    for _ in range(2):
        left = sorted((str(r["doc_id"]), r["text"] or "") for r in cp.without_near_copies(spark, docs, source).collect())
        assert left == sorted([("1", CLEAN), ("2", other), ("None", ""), ("3", ""), ("4", ""), ("5", rows[8][1])])
    pieces = cp.packed(spark, docs, source)
    assert Counter(str(r["doc_id"]) for r in pieces.where("piece = 0").collect()) == Counter(str(i) for i, _ in rows) and cp.packed(spark, docs.limit(0), source).count() == 0
