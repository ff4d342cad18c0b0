"""op11 to op13 against brute force on small rows, and their odd rows."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from logsift.llm import divergence, mixing, spelling

DOCS = "doc_id long, text string, lang string, source string"


def edits(word, letters):
    for i in range(len(word) + 1):
        for c in letters:
            yield word[:i] + c + word[i:]
        if i < len(word):
            yield word[:i] + word[i + 1 :]
            yield from (word[:i] + c + word[i + 1 :] for c in letters)


def slow_variants(n):
    """{word: (form, root, n_near, form_n)} of word counts, by trying all edits."""
    letters = sorted({c for w in n for c in w})
    near = {w: {e for e in edits(w, letters) if e in n and e != w} for w in n}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, len(near[w]), n[form[w]] if form[w] else None)
    return out


@pytest.mark.parametrize("hot", [0, 3, 256])
def test_variants_by_brute_force(spark, hot):
    import random

    rng = random.Random(hot)
    n = {"".join(rng.choice("abé") for _ in range(rng.randint(5, 7))): rng.randint(3, 40) for _ in range(220)}
    n |= {"colour": 90, "color": 40, "colourr": 12, "colourrr": 3, "colox": 5}
    x = spark.createDataFrame(list(n.items()), "word string, n long")
    named = spelling.forms(x, spelling.near_pairs(x, hot))
    got = {r["word"]: (r["form"], r["n_near"], r["form_n"]) for r in named.collect()}
    want = slow_variants(n)
    assert got == {w: (f, k, m) for w, (f, _, k, m) in want.items()}
    assert {r["word"]: r["root"] for r in spelling.roots(named).collect()} == {w: r for w, (f, r, _, _) in want.items() if f}
    pairs = [frozenset((r["a"], r["b"])) for r in spelling.near_pairs(x, hot).collect()]
    assert len(pairs) == len(set(pairs))  # each once


def test_words_of_documents(spark):
    rows = [(i, "Größe größe GROSS color2colour x ÀÉ" * (i % 3), "en", "a") for i in range(300)] + [(None, "Farbe Farbe Farbe", None, None), (7, None, None, None), (8, "", "", ""), (7, "größe", "en", "a"), (7, "größe", "en", "a")]
    want = Counter()
    for k, t, *_ in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        for run in spelling._RUN.findall(low):
            want[spelling.noisy("" if k is None else str(k), run)] += 1
    got = {r["word"]: r["n"] for r in spelling.words(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {w: n for w, n in want.items() if len(w) >= 5 and n >= 3} and "größe" in got
    assert spelling.noisy("d", "x" * 9, 1) == "x" * 8
    assert spelling.spelling_variants(spark.createDataFrame([], DOCS)).count() == 0
    odd = spark.createDataFrame([(i, "word apple apples", "z", 1) for i in range(4)], "doc_id long, text string, word string, n long")
    assert {r["word"] for r in spelling.spelling_variants(odd).collect()} == {"apple", "apples"}


def slow_targets(sizes):
    """Shares that stop at three times a size, the rest shared again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, open_, left = {}, set(names), sum(sizes.values())
    while open_:
        w = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / w > 3 * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / w for s in open_}
            break
        target |= {s: 3.0 * sizes[s] for s in over}
        left, open_ = left - sum(3 * sizes[s] for s in over), open_ - over
    return target


MIX = [(i % 190, "word " * (i * 7 % 311), "x", ["big", "b", "tiny", None, "mid"][0 if i % 3 else i % 5]) for i in range(400)] + [(900, "w " * 12, "x", "dot"), (901, None, "x", "none"), (902, "  \n", "x", "dot")] + [(903, "rep eat", "x", "b")] * 3


def test_mix_against_its_rules(spark):
    x = spark.createDataFrame(MIX, DOCS)
    got = mixing.taken(x, length=16, shard=32).collect()
    sizes, used = defaultdict(int), defaultdict(int)
    for _, t, _, s in MIX:
        sizes[s] += len((t or "").split())
    want = slow_targets(sizes)
    by_size = {v: k for k, v in sizes.items()}
    assert len(by_size) == len(sizes)  # a source is known by its size here
    for r in got:
        source = by_size[r["source_size"]]
        used[source] += r["taken"]
        assert abs(r["target"] - want[source]) < 1e-6 * max(1, want[source]) and 0 <= r["taken"] <= 3 * r["size"]
    assert sorted((r["doc_id"], r["size"]) for r in got) == sorted((k, len((t or "").split())) for k, t, *_ in MIX)
    assert all(abs(used[s] - want[s]) <= 0.5 for s in sizes) and want["tiny"] == 3 * sizes["tiny"]
    key = lambda rows: sorted((r["doc_id"], r["size"], r["taken"]) for r in rows)
    assert key(mixing.taken(x.repartition(7).orderBy(F.rand(3)), length=16, shard=32).collect()) == key(got)


def test_blocks_of_the_mix(spark):
    x = spark.createDataFrame(MIX, DOCS)
    rows = mixing.mixture(x, length=16, shard=32).collect()
    blocks, shards = defaultdict(list), defaultdict(Counter)
    for r in rows:
        blocks[r["source"], r["pass"], r["block"]].append((r["off"], r["n"]))
        shards[r["shard"]][r["source"], r["pass"], r["block"]] += 1
    for parts in blocks.values():  # gapless
        at = 0
        for off, n in sorted(parts):
            assert off == at and n > 0
            at += n
        assert at <= 16
    counts = sorted(len(s) for s in shards.values())
    assert counts[-1] == 32 and counts[0] == len(blocks) - 32 * (len(counts) - 1)  # a block of a pass is in one slot
    big = [sum(1 for b in s if b[0] == "big") for s in shards.values()]
    assert len(set(big)) > 1  # drawn, not dealt out evenly
    assert mixing.taken(spark.createDataFrame([], DOCS)).count() == 0
    nothing = mixing.taken(spark.createDataFrame([(1, " ", "x", "a"), (1, None, "x", None)], DOCS)).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in nothing] == [(0, 0.0, 0)] * 2


@pytest.mark.parametrize("n", [1, 2, 7, 64, 1000])
def test_permutations(spark, n):
    got = [r["p"] for r in spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), [F.lit("k")]).alias("p")).collect()]
    assert sorted(got) == list(range(n)) and (n < 64 or got != list(range(n)))


def slow_divergence(rows):
    groups, docs, counts = set(), Counter(), defaultdict(Counter)
    for _, text, lang, source in rows:
        g = (lang or "", source or "")
        groups.add(g)
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        term, terms = "", []
        for c in low + " ":
            if "a" <= c <= "z" or ord(c) > 127:
                term += c
            elif term:
                terms.append(term)
                term = ""
        counts[g].update(terms)
        docs.update({(g[0], t) for t in terms})
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (own, t), n in docs.items() if own == lang and n >= 3]
        inside = sorted(g for g in groups if g[0] == lang)
        n = {g: sum(counts[g][t] for t in kept) for g in inside}
        p = {g: {t: 1 + 10**9 * (counts[g][t] + 1) // (n[g] + len(kept)) for t in kept} for g in inside}
        every = {t: sum(counts[g][t] for g in inside) for t in kept}
        q = {t: 1 + 10**9 * (every[t] + 1) // (sum(every.values()) + len(kept)) for t in kept}
        f = lambda a, b: (a - b) ** 2 // b
        for g in inside:
            pairs = [(o[1], sum(f(p[g][t], p[o][t]) for t in kept)) for o in inside if o != g]
            own = [(t, f(p[g][t], q[t])) for t in kept if counts[g][t] and p[g][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", own, 200)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(*g, part, item, value, i + 1) for i, (item, value) in enumerate(ranked)]
    return sorted(out)


@pytest.mark.parametrize("held", [5, 500_000])
def test_divergence_by_brute_force(spark, held, monkeypatch):
    import random

    monkeypatch.setattr(divergence, "HELD", held)
    rng = random.Random(2)
    vocab = [f"{a}{b}" for a in "abcdefgé" for b in ("x", "Yy", "zé", "'s", "q1r")]
    rows = [(i, " ".join(rng.choice(vocab[: 8 + 8 * (i % 5)]) for _ in range(rng.randint(0, 30))), rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", "", None])) for i in range(120)]
    rows += [(1, None, "fr", "only"), (2, "rare words", "fr", "other"), (3, "", None, None)] + [(9, "same same", "en", "a")] * 3
    x = spark.createDataFrame(rows, DOCS)
    got = sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in divergence.source_divergence(x.repartition(5), shard_rows=9).collect())
    assert got == slow_divergence(rows) and ("fr", "only", "pair", "other", 0, 1) in got


def test_divergence_of_odd_tables(spark):
    assert divergence.source_divergence(spark.createDataFrame([], DOCS)).count() == 0
    odd = spark.createDataFrame([("one two one", "en", s, 1, 2) for s in "ab" for _ in range(3)], "text string, lang string, source string, p long, term long")
    got = divergence.source_divergence(odd).collect()
    assert sorted((r["source"], r["item"], r["value"], r["rank"]) for r in got if r["part"] == "pair") == [("a", "b", 0, 1), ("b", "a", 0, 1)]
