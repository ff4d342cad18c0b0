"""Quality rules, toxicity, quality classifier, license scans, URL filters and HTML extraction against brute force."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from logsift.llm import html_extraction as he
from logsift.llm import license_scans as ls
from logsift.llm import quality_classifier as qc
from logsift.llm import quality_rules as qr
from logsift.llm import toxicity as tx
from logsift.llm import url_filters as uf

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, kept string, score string"


def frame(spark, texts):
    """Rows with clashing extra columns."""
    return spark.createDataFrame([(i, t, "en", "x", "y") for i, t in enumerate(texts)], SCHEMA)


def counts(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    at, repeated = {}, set()
    for i in range(len(w) - 7):
        at.setdefault(tuple(w[i : i + 8]), []).append(i)
    for places in at.values():
        if len(places) > 1:
            for p in places:
                repeated.update(range(p, p + 8))
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(repeated)


TEXTS = [
    None, "", "   \n\t ", "one", "a b c d e f g h", "a b c d e f g h a b c d e f g h", "x " * 40, "l1 l1\nl1 l1\n\n  \nl1 l1", "é🙂 # $ word \x0b\x0c end",
    " ".join(f"w{i % 13}" for i in range(100)), " ".join(f"w{i}" for i in range(3000)) + " " + " ".join(f"w{i}" for i in range(1500)),
]


def test_base_counts(spark):
    rng = random.Random(3)
    texts = TEXTS + [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    got = {r["doc_id"]: r for r in qr.quality_rules(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == counts(t)
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_cascade_order_changes_no_verdict_and_is_native(spark):
    clean = "The quick brown fox jumps over a lazy dog while seven wizards brew potions beside some old stone bridge near town every cold autumn night."
    texts = [clean, clean.upper(), clean.replace(" ", "## "), clean.replace(" ", "! ")]
    df = qr.base_counts(frame(spark, texts))
    rules = qr.rules()
    a = [r[0] is None for r in df.select("doc_id", qr.cascade(rules).alias("r")).orderBy("doc_id").select("r").collect()]
    b = [r[0] is None for r in df.select("doc_id", qr.cascade(rules[::-1]).alias("r")).orderBy("doc_id").select("r").collect()]
    assert a == b == [True, False, False, False]
    out = qr.quality_rules(frame(spark, texts))
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    ranked = qr.plan_cascade(df, rules)
    assert [r.rank for r in ranked] == sorted((r.rank for r in ranked), reverse=True)
    assert out.where("kept").count() == 1


def test_empty_tables(spark):
    none = frame(spark, []).drop("kept")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert qr.quality_rules(none).count() == 0
    assert tx.toxicity(none, labels).count() == 0
    assert qc.quality_classifier(none, labels).count() == 0
    assert ls.license_scan(none).count() == 0
    assert he.html_extraction(spark.createDataFrame([], "page_id long, html string")).count() == 0
    assert uf.url_filter(spark.createDataFrame([], "page_id long, url string")).count() == 0


def labelled(spark, n=240):
    rng = random.Random(5)
    vocab = [f"word{i}" for i in range(200)]
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice(vocab) for _ in range(60)]
        bad = i % 4 == 0
        if bad:
            w[7], w[30] = "scoundrel", "scoundrels"
        low = i % 3 == 0
        text = " ".join(w) if not low else "## ".join(w).upper()
        docs.append((i, text, "en", "x", "y"))
        labels.append((i, 0 if low else 1, int(bad)))
    return spark.createDataFrame(docs + [(None, None, None, None, None), (n, "", "", "", "")], SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_classifiers_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    for f, y, mod, held, least in ((tx.toxicity, "toxic", 5, 0, 0.95), (qc.quality_classifier, "quality", 4, 2, 0.95)):
        out = f(docs, labels).join(labels, "doc_id", "left").collect()
        assert len(out) == 242
        for r in out:
            assert r["held_out"] == (zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % mod == held)
            assert 0 <= r["score"] <= 1
        test = [r for r in out if r["held_out"] and r[y] is not None]
        assert np.mean([r["predicted"] == r[y] for r in test]) >= least


def test_held_out_labels_do_not_matter(spark):
    docs, labels = labelled(spark, 80)
    flipped = labels.selectExpr("doc_id", "quality", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    a, b = ({r["doc_id"]: r["score"] for r in tx.toxicity(docs, x).collect()} for x in (labels, flipped))
    assert a == b


def test_identity_terms_weigh_alike():
    rows = [{"we", "saw", "muslims", "awful"}, {"awful", "women"}, {"we", "saw", "trees"}, {"nice", "men"}] * 30
    y = np.array([1.0, 1.0, 0.0, 0.0] * 30)
    plain, fair = (tx.fit(rows, y, ["awful", "nice", "we"], swap=s).weights for s in (0.0, 20.0))
    gap = lambda w: abs(w.get("muslims", 0) - w.get("christians", 0))
    assert gap(fair) < 0.2 * gap(plain) + 1e-6
    assert fair["awful"] > 1


def test_stems_of_identity_terms_weigh_alike():
    """One group stands only beside a toxic word, another only in clean sentences; the vocabulary has all words and stems."""
    texts = ["those muslims are awful", "the muslims here are awful people", "christians sang in town", "a few christians met"] * 30
    y = np.array([1.0, 1.0, 0.0, 0.0] * 30)
    vocabulary = sorted(set().union(*map(tx.words, texts)))
    assert "musl-" in vocabulary and "chris-" in vocabulary
    plain, fair = (tx.fit([tx.whole_words(t) for t in texts], y, vocabulary, swap=s) for s in (0.0, 20.0))
    group = next(g for g in tx.IDENTITY if "muslims" in g)
    spread = lambda m: np.ptp([m.score(f"a group of {t} met") for t in group])
    assert spread(plain) > 0.25 and spread(fair) < 0.02
    for kind in tx.IDENTITY:
        for s in tx.NEUTRAL:
            assert np.ptp([fair.score(s.format(t)) for t in kind]) < 0.02
    assert fair.score("awful") > 0.5


def test_counterfactuals_are_those_of_the_swapped_text():
    text = "Women and men of the muslim town"
    want = []
    for term, others in (("men", ["women", "girls", "boys"]), ("muslim", ["christian", "jewish", "hindu", "buddhist", "atheist"]), ("women", ["men", "girls", "boys"])):
        for o in others:
            after = tx.words(re.sub(rf"\b{term}\b", o, text.lower()))
            want.append((sorted(after - tx.words(text)), sorted(tx.words(text) - after), 1 / len(others)))
    assert list(tx.swaps(tx.whole_words(text))) == want


def test_loss_and_gradient_by_brute_force():
    rng = np.random.default_rng(3)
    k, n, m = 7, 12, 9
    some = lambda: np.flatnonzero(rng.random(k) < 0.4)
    rows, pairs = [some() for _ in range(n)], [(some(), some()) for _ in range(m)]
    pairs = [(np.setdiff1d(a, b), np.setdiff1d(b, a)) for a, b in pairs]
    u, v, y, w, bias = rng.random(n), rng.random(m), (rng.random(n) < 0.5).astype(float), rng.normal(size=k), 0.3
    x, c = tx.Sparse.of([(r, np.zeros(0, int)) for r in rows], u), tx.Sparse.of(pairs, v)

    def slow(w, bias):
        out = 0.7 / 2 * sum(float(a) ** 2 for a in w)
        for r, weight, label in zip(rows, u, y):
            p = 1 / (1 + np.exp(-(sum(w[j] for j in r) + bias)))
            out -= weight * np.log(p if label else 1 - p)
        return out + 3.0 / 2 * sum(weight * (sum(w[j] for j in a) - sum(w[j] for j in b)) ** 2 for (a, b), weight in zip(pairs, v))

    loss, g, gb = tx.loss_and_gradient(w, bias, x, y, c, 0.7, 3.0)
    assert np.isclose(loss, slow(w, bias))
    for j in range(k):
        e = np.eye(k)[j] * 1e-5
        assert np.isclose(g[j], (slow(w + e, bias) - slow(w - e, bias)) / 2e-5, atol=1e-6)
    assert np.isclose(gb, (slow(w, bias + 1e-5) - slow(w, bias - 1e-5)) / 2e-5, atol=1e-6)


def test_single_class_scores_its_share(spark):
    docs, labels = labelled(spark, 20)
    ones = labels.selectExpr("doc_id", "1 AS quality", "0 AS toxic")
    assert {r["score"] for r in qc.quality_classifier(docs, ones).collect()} == {1.0}
    assert {r["score"] for r in tx.toxicity(docs, ones).collect()} == {0.0}


def test_discriminant_matches_a_direct_density():
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(0, 1, (200, 3)), rng.normal(2, 2, (100, 3))])
    y = np.array([0.0] * 200 + [1.0] * 100)
    m = qc.fit(x, y, pooled=0.0, ridge=0.0)
    z = (x - m.centre) / m.scale
    logs = []
    for k, share in ((0, 2 / 3), (1, 1 / 3)):
        p = z[y == k]
        c = np.cov(p.T, bias=True)
        d = z - p.mean(axis=0)
        logs.append(np.log(share) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d))
    assert np.allclose(m.score(x), 1 / (1 + np.exp(logs[0] - logs[1])))


@pytest.mark.parametrize(
    ("text", "found"),
    [
        (None, []), ("", []), ("no terms here", []), ("Prose.\nLicensed under the Apache License, Version 2.0.\nMore.", ["Apache-2.0"]),
        ("* Released under the MIT License. And more", ["MIT"]), ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3"]),
        ("Licensed under CC BY-NC 4.0.\nReleased under the MIT License.", ["CC-BY-NC-4.0", "MIT"]), ("Not licensed under anything. Released under the MIT Licenses.", []),
        ("Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.", ["Apache-2.0"]),
    ],
)
def test_license_scan(text, found):
    assert ls.recognised(ls.identifiers(text)) == found


def test_license_rules_take_the_longest():
    assert ls.recognised([("bsd.grant", ""), ("bsd.source", ""), ("bsd.binary", ""), ("mit.name", "")]) == ["BSD", "MIT"]
    assert all(any(a in s for a in ls.ANCHORS) or k in ("apache.name",) for s, (k, _) in ls.known().items() if not s.startswith(("licensed", "released")))


GPL = """This program is free software{0} you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation{1} either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""
MPL = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
MIT = """Copyright (c) 2020 A. Writer

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""
NOTICES = [
    (GPL.format(":", ","), ["GPL-3"], ["gpl.free", "gpl.hope"]), (GPL.format(";", ";"), ["GPL-3"], ["gpl.free", "gpl.hope"]), (MPL, ["MPL-2.0"], ["mpl.name"]),
    (MIT, ["MIT"], ["mit.grant", "mit.condition", "as_is"]), (BSD, ["BSD"], ["bsd.grant", "bsd.source", "bsd.binary"]), (APACHE, ["Apache-2.0"], ["apache.name", "apache.comply", "apache.basis"]),
    ("This work is dedicated to the public domain", ["CC0"], ["cc0.name"]),
]


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// "])
@pytest.mark.parametrize("width", [None, 24, 72, 80])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_whole_notices_are_recognised(mark, width, end):
    import textwrap

    for text, licenses, sentences in NOTICES:
        lines = [x for line in text.split("\n") for x in ((textwrap.wrap(line, width) if width else [line]) or [""])]
        ids = ls.identifiers("Some prose" + end + end + end.join(mark + x for x in lines) + end)
        assert [k for k, _ in ids] == sentences and ls.recognised(ids) == licenses


def test_license_sentences_start_and_end_at_cuts():
    for text in ("It is not released\nunder the MIT License.", "Released under the MIT\n\nLicense.", "Released under the\nMIT License of old."):
        assert ls.identifiers(text) == []
    assert ls.recognised(ls.identifiers("prose without a mark\nReleased under the MIT License\nmore prose")) == ["MIT"]


def test_license_frame(spark):
    out = {r["doc_id"]: r for r in ls.license_scan(frame(spark, [None, "Released under the MIT License.", "x"])).collect()}
    assert [out[i]["n_licenses"] for i in range(3)] == [0, 1, 0]


def slow_rule(url):
    _, sep, rest = (url or "").partition("://")
    host = re.split(r"[/?#]", rest)[0] if sep else ""
    path = re.split(r"[?#]", rest[len(host) :])[0] if sep else ""
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in uf.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else None


def test_url_filter(spark):
    urls = [
        None, "", "no scheme", "http://", "http://Example.COM/en/1?x=/y#z", "https://www.example.com/en/", "http://a.net/es/1", "http://net/fr/", "http://xnet/fr/", "ftp://b.example.com?en/", "http://com", "http://com/",
        "x://y://com/en/", "http://cheap-pills.example.org/en/1", "http://ththre.example.org/en/1", "http://u@h.net:80/es/\n?q",
    ]
    out = uf.url_filter(spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")).collect()
    assert len(out) == len(urls)
    for r in out:
        host, path, rule, verdict = slow_rule(r["url"])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("block" if r["p_bad"] >= 0.5 else "allow"))
    assert out[13]["verdict"] == "block" and out[14]["verdict"] == "allow"


def url_scores(urls, model):
    parts = [uf.split_url(u) for u in urls]
    return uf.score_urls([h for h, _ in parts], [x for _, x in parts], model)


def test_url_model_on_held_out_urls():
    t = uf.labelled_urls()
    fold = t["url"].map(lambda u: zlib.crc32(u.encode()) % 4 == 0).to_numpy()
    assert ((url_scores(t["url"][fold], uf.train(t[~fold])) >= 0.5) == t["bad"][fold].to_numpy()).mean() > 0.97


@pytest.mark.parametrize("fold", range(3))
def test_url_model_on_words_that_training_lacks(fold):
    t = uf.labelled_urls()
    words = [w for topic in [*uf.BAD_TOPICS.values(), *uf.GOOD_TOPICS.values()] for w in topic.split()]
    unseen = words[fold::3]
    held = t["url"].map(lambda u: any(w in u for w in unseen)).to_numpy()
    p = url_scores(t["url"][held], uf.train(t[~held]))
    assert ((p >= 0.5) == t["bad"][held].to_numpy()).mean() > 0.8


def test_url_model_on_hosts_that_are_in_no_list():
    model = uf.train(uf.labelled_urls())
    bad = ["http://hot-singles.com/", "http://bestgambling.org/", "http://malware-download.net/x.exe", "http://discount-meds.com/buy", "http://zzqqy.xyz/click/8", "http://grandbazino.top/win/9"]
    good = ["https://en.wikipedia.org/wiki/Spark", "https://spark.apache.org/docs/latest/", "https://www.bbc.co.uk/news/world-123", "https://github.com/a/b", "https://stackoverflow.com/questions/1/a-b", "https://www.essex.ac.uk/about", "", "http://"]
    assert all(url_scores(bad, model) >= 0.5) and all(url_scores(good, model) < 0.5)


def test_url_table_is_bounded_and_may_be_a_frame(spark):
    rows = spark.createDataFrame([("http://a-b.com/buy", 1), ("http://good.org/", 0), (None, 1), ("http://x.org/", None)], "url string, bad int")
    assert sorted(uf.bounded(rows)["url"]) == ["http://a-b.com/buy", "http://good.org/"]
    out = uf.url_filter(spark.createDataFrame([(1, "http://good.org/"), (1, "http://good.org/"), (2, "http://h.org/" + "p" * 200_000)], "page_id long, url string"), labelled=rows)
    assert out.count() == 3 and max(len(r["path"]) for r in out.collect()) == 200_001


def test_url_parts_and_rules_equal_sql(spark):
    import os

    duckdb = pytest.importorskip("duckdb")
    source = "/root/testdata/sf0.01/pages.parquet"
    if not os.path.exists(source):
        pytest.skip("no tables")
    rule = " ".join(f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}') THEN '{h}{p}|{v}'" for v, h, p in sorted(uf.RULES, key=lambda r: -len(r[1] + r[2])))
    sql = rf"""WITH a AS (SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1) AS h, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM '{source}'),
    b AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM a), c AS (SELECT *, CASE {rule} END AS r FROM b)
    SELECT page_id, host, path, split_part(r, '|', 1) AS rule, split_part(r, '|', 2) AS verdict FROM c"""
    want = {r[0]: r[1:] for r in duckdb.sql(sql).fetchall()}
    got = uf.url_filter(spark.read.parquet(source).select("page_id", "url")).collect()
    assert len(got) == len(want) and sum(r["rule"] is not None for r in got) > 10
    for r in got:
        host, path, rule, verdict = want[r["page_id"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and r["verdict"] == (verdict or ("block" if r["p_bad"] >= 0.5 else "allow"))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href=x>Menu</a></li></ul></nav>
<div class="ad">Buy now</div><article><h1>Head &amp; line</h1><p><b>First&nbsp; part.<br><p>Second   <i>pa</i>rt\n here with enough words to be read as text.</p><div class="share">Tweet</div><p>x</p>
<section class="comments"><p>Nice post, reader says so</p></section></article><form><p>Name</p></form><footer>&copy; me</footer></body></html>"""


def test_html_extraction(spark):
    assert he.main_text(PAGE) == "Head & line First part. Second part here with enough words to be read as text. x"
    assert he.main_text(None) == he.main_text("") == he.main_text("<p></p>") == ""
    cut = PAGE.split("</article>")[0]
    assert he.main_text(cut) == he.main_text(PAGE)
    assert he.main_text("<div class=ad>Never closed<article><p>Body text of some length, long enough to count.</p></article>") == "Body text of some length, long enough to count."
    plain = "<body><ul>" + "<li><a href=1>Link</a></li>" * 9 + "</ul><h2>Title</h2>" + "<p>" + "word " * 60 + "</p><p>tiny</p><p>" + "more " * 60 + "</p>" + "<p><a href=2>Next</a></p>" * 5
    got = he.main_text(plain)
    assert got.startswith("Title word") and "tiny" in got and got.endswith("more") and "Link" not in got
    rows = spark.createDataFrame([(1, None, "a"), (2, PAGE, "b"), (2, PAGE, "b")], "page_id long, html string, text string")
    assert sorted((r["page_id"], r["n_chars"]) for r in he.html_extraction(rows).collect()) == [(1, 0), (2, 80), (2, 80)]


BODY = "<p>The first paragraph of the story is long enough to be read as prose by anyone.</p><div class='{}'>A second block of prose stands in a marked element, and it is as long as the others are.</div><p>A third one closes the story, and has as many words as the first.</p>"
MENU = "<ul>" + "".join(f"<li><a href='{i}'>Link {i}</a></li>" for i in range(8)) + "</ul>"


@pytest.mark.parametrize("mark", ["alert", "related", "discussion", "promotion", "social", "banner", "search-term", "content has-sidebar"])
def test_hints_do_not_drop_prose(mark):
    want = " ".join(re.sub("<[^>]*>", " ", BODY).split())
    for wrapper in ("article", "div", "section"):
        page = f"<body><nav>{MENU}</nav><div class='ad'>Buy this now, it is cheap and good for you.</div><{wrapper}>{BODY.format(mark)}</{wrapper}><footer>Us</footer></body>"
        assert he.main_text(page) == want
    assert he.main_text(f"<body><div class='content has-sidebar'><h1>Head</h1>{BODY.format('x')}</div>{MENU}</body>") == "Head " + want


@pytest.mark.parametrize("mark", ["ad", "sidebar", "comments", "cookie", "newsletter", "breadcrumbs"])
def test_plain_names_of_other_parts_are_dropped(mark):
    page = f"<body><div><h1>Head</h1>{BODY.format(mark)}<p>x</p></div></body>"
    assert "A second block" not in he.main_text(page) and he.main_text(page).endswith("the first. x") and he.main_text(page).startswith("Head The first")


def test_short_lines_with_a_hint_are_dropped():
    filler = "".join(f"<p>{'word ' * 60}</p>" for _ in range(8))
    page = f"<body><div>{filler}<div class='related-posts'><ul>{'<li>See also</li>' * 30}</ul></div>{filler}<p>end</p></div></body>"
    assert he.main_text(page).split() == ["word"] * 960 + ["end"]


def test_html_of_the_tables_with_and_without_article_tags():
    import html
    import os

    import pandas as pd

    source = "/root/testdata/sf0.01/pages.parquet"
    if not os.path.exists(source):
        pytest.skip("no tables")
    for page in pd.read_parquet(source)["html"].fillna(""):
        inner = re.search("<article>(.*?)</article>", page, re.S)
        want = " ".join(html.unescape(re.sub("<[^>]*>", " ", inner[1])).split()) if inner else ""
        plain = page.replace("<article>", "<div>").replace("</article>", "</div>")
        assert he.main_text(page) == he.main_text(plain) == want


def test_html_of_odd_shapes(spark):
    deep = "<div>" * 20_000 + "<p>deep text</p>" + "</div>" * 20_000 + "</span></section>" * 5000
    assert he.main_text(deep) == "deep text"
    long = "<div>" + "<p>some words of text in a row</p>" * 20_000 + "</div>"
    assert he.main_text(long) == " ".join(["some words of text in a row"] * 20_000)
    assert he.main_text("<p>&lt;b&gt; &amp; &#233;&nbsp;x") == "<b> & é x"
    assert he.main_text("<p>a<i>b</i>c<br>d<!-- no --><script>x</script> e") == "abc d e"
    rows = spark.createDataFrame([(None, None, 1), (None, "<p>one</p>", 2), (3, "<", 3)], "page_id long, html string, n_chars int")
    got = he.html_extraction(rows)
    assert got.columns == ["page_id", "text", "n_chars"] and sorted(r["n_chars"] for r in got.collect()) == [0, 1, 3]


LGPL = GPL.replace("This program", "This library").replace("GNU General", "GNU Lesser General").replace("version 3", "version 2.1")
ISC = """ISC License

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE."""
BSD3 = BSD + """

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""


@pytest.mark.parametrize("width", [None, 30, 76])
@pytest.mark.parametrize("mark", ["", "# ", " * "])
def test_more_whole_licenses(mark, width):
    import textwrap

    for text, want in ((LGPL.format(":", ","), ["LGPL-2.1"]), (GPL.replace("GNU General Public License as", "GNU Affero General Public License as").format(":", ","), ["AGPL-3"]), (ISC, ["ISC"]), ("MIT License\n\n" + MIT, ["MIT"]), (BSD3, ["BSD-3"]), ("This is free and unencumbered software released into the public domain.", ["Unlicense"])):
        lines = [x for line in text.split("\n") for x in ((textwrap.wrap(line, width) if width else [line]) or [""])]
        assert ls.recognised(ls.identifiers("Prose before.\n\n" + "\n".join(mark + x for x in lines) + "\n\nprose after")) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("// SPDX-License-Identifier: Apache-2.0", ["Apache-2.0"]), ("SPDX-License-Identifier: MIT", ["MIT"]), ("# SPDX-License-Identifier: GPL-3.0-or-later\nimport x", ["GPL-3.0"]), ("SPDX-License-Identifier: BSD-3-Clause", ["BSD-3"]),
        ("It is released under the MIT license, see LICENSE.", []), ("Released under the MIT license, see LICENSE.", ["MIT"]), ("This tool is small, released under the MIT License, and free.", ["MIT"]), ("Licensed under the Eclipse Public License, version 2.0.", ["EPL-2.0"]),
    ],
)
def test_license_tags_and_clauses(text, want):
    assert ls.recognised(ls.identifiers(text)) == want


def slow_identifiers(text):
    """Every run of neighbouring pieces of a paragraph is looked up; from the left, the longest counts."""
    found = []
    for part in ls.paragraphs(text or ""):
        runs = {(i, j): ls.known().get(" ".join(part[i:j])) for i in range(len(part)) for j in range(i + 1, len(part) + 1)}
        i = 0
        while i < len(part):
            j = max((b for (a, b), hit in runs.items() if a == i and hit), default=None)
            if j:
                found.append(runs[i, j])
            i = j or i + 1
    return found


def slow_licenses(ids):
    out, i = [], 0
    while i < len(ids):
        fits = [(len(seq), name) for name, seq in ls.RULES if [k for k, _ in ids[i : i + len(seq)]] == list(seq)]
        if fits:
            n, name = max(fits)
            v = next((v for _, v in ids[i : i + n] if v), "")
            out.append(f"{name}-{v}" if v else name)
        i += max(fits)[0] if fits else 1
    return out


def test_license_scan_by_brute_force(spark):
    rng = random.Random(11)
    sentences = sorted(ls.known())
    texts = [None, "", "z" * 100_000, "Released under the MIT License. " * 3000]
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 8)):
            s = rng.choice(sentences) if rng.random() < 0.7 else " ".join(rng.choice(["prose", "license", "under", "the"]) for _ in range(5))
            w = s.split()
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] += rng.choice([",", ";", "\n", ""])
            parts.append(" ".join(w) + rng.choice([".", "", ";", ":"]) + rng.choice([" ", "\n", "\n\n", "\n# "]))
        texts.append("".join(parts))
    rows = [(i % 50, t, "x") for i, t in enumerate(texts)] + [(None, texts[5], "y")]
    out = ls.license_scan(spark.createDataFrame(rows, "doc_id long, text string, licenses string")).collect()
    key = lambda k, ids, names: (str(k), tuple(i for i, _ in ids), tuple(names))
    want = sorted(key(k, slow_identifiers(t) if t is None or len(t) < 50_000 else ls.identifiers(t), slow_licenses(ls.identifiers(t))) for k, t, _ in rows)
    assert sorted((str(r["doc_id"]), tuple(r["sentence_ids"]), tuple(r["licenses"])) for r in out) == want
    assert len(ls.identifiers(texts[3])) == 3000


PLAIN = "wizards brew odd potions beside some old stone bridge near our town every cold autumn night while quiet owls look on from tall trees"
OF_RULE = {
    "symbols": PLAIN + " ### $$$ &&&", "repeated_lines": "\n".join([PLAIN[:60], "one short line"] + ["same words here"] * 6), "word_length": " ".join(w * 5 for w in PLAIN.split()), "upper_case": PLAIN.upper(),
    "exclamations": PLAIN.replace(" o", "!! o") + "!!!", "few_letters": " ".join(f"{i}{i}{i}9 a" for i in range(10, 40)), "ellipsis_lines": "\n".join(f"{w} and {v}..." for w, v in zip(PLAIN.split(), PLAIN.split()[1:])), "bullet_lines": "\n".join(f"- {w} and {v}" for w, v in zip(PLAIN.split(), PLAIN.split()[1:])),
}


def test_each_quality_rule_rejects_and_keeps(spark):
    texts = [PLAIN, *OF_RULE.values(), None, "", PLAIN]
    rows = [(None if i == 3 else i % 7, t, "x") for i, t in enumerate(texts)]
    df = qr.base_counts(spark.createDataFrame(rows, "doc_id long, text string, kept string"))
    rules = {r.name: r.rejects for r in qr.rules()}
    assert set(rules) == set(OF_RULE)
    got = df.select("text", *[F.coalesce(c, F.lit(False)).alias(n) for n, c in rules.items()]).collect()
    by = {r["text"]: r for r in got}
    assert not any(by[PLAIN][n] for n in rules)
    for n, t in OF_RULE.items():
        assert by[t][n], n
    out = qr.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, kept string")).collect()
    assert len(out) == len(rows) and [r["text"] for r in out if r["kept"]] == [PLAIN, PLAIN]


def slow_statistics(text):
    import regex

    t = text or ""
    w, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
    n, chars, letters = len(w), len(t), len(regex.findall(r"\p{L}", t))
    part = lambda a, b: a / b if b else 0.0
    soft = lambda x: np.log1p(20 * x)
    count = lambda p: len(regex.findall(p, t))
    return [
        np.log1p(n), part(chars, n + 1), soft(part(count(r"[#*$%&|<>~^=_]"), n)), soft(part(count(r"\p{Lu}"), letters)), soft(part(t.count("!"), n)), part(letters, chars), soft(part(len(lines) - len(set(lines)), len(lines))),
        np.log1p(len(set(w))) / np.log1p(n) if n > 1 else 1.0, np.log1p(part(n, len(lines))), soft(part(count(r"\p{Nd}"), chars)), soft(part(count(r"[.,;:]"), n)),
    ]


def test_quality_statistics_by_brute_force(spark):
    texts = [*TEXTS, *OF_RULE.values(), "Größe: 3,5 m; ÉTÉ!\n\nÉTÉ!\nx = y_z", PLAIN * 2000]
    rows = [(i % 5 or None, t, "x") for i, t in enumerate(texts)] + [(1, texts[3], "x")]
    out = qc.statistics(spark.createDataFrame(rows, "doc_id long, text string, _t string")).select("text", "_x").collect()
    assert len(out) == len(rows)
    for r in out:
        assert np.allclose(r["_x"], slow_statistics(r["text"]))


def test_training_rows_stay_bounded_where_keys_repeat(spark):
    from logsift.llm.common import labelled

    docs = spark.createDataFrame([(i % 3, f"text {i}") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(3)], "doc_id long, toxic int")
    found = [labelled(docs, labels, "toxic", 5, 9, 10).collect() for _ in range(2)]
    assert len(found[0]) == 10 and found[0] == found[1]


def test_toxicity_of_long_and_repeated_texts(spark):
    docs, labels = labelled(spark, 60)
    long = "word1 " * 100_000 + "scoundrel"
    more = spark.createDataFrame([(1000, long, "en", "", ""), (1000, long, "en", "", ""), (None, "scoundrel", "en", "", "")], SCHEMA)
    out = tx.toxicity(docs.unionByName(more), labels).where("doc_id = 1000 OR doc_id IS NULL").collect()
    assert len(out) == 4 and len({r["score"] for r in out if r["doc_id"] == 1000}) == 1


@pytest.mark.parametrize("part", ["<a ", "x <!-- ", "<![CDATA[ x > ", "</p ", "<? ", '<a b="', "<p><b>", "<script>", "<title>x"])
def test_html_that_never_ends_takes_linear_time(part):
    import time

    from logsift.llm.html_extraction import main_text

    prose = "<body><p>" + "Plain words of an article that goes on for a while. " * 5 + "</p>"
    at = time.perf_counter()
    got = main_text(prose + part * (1_000_000 // len(part)))
    assert time.perf_counter() - at < 6 and got.startswith("Plain words of an article")
    assert "never" not in main_text(prose + part + "never" if part in ("<a ", "x <!-- ", "</p ") else prose)


def test_html_heading_beside_the_region():
    from logsift.llm.html_extraction import main_text

    prose = "".join(f"<p>{'Some prose that is long enough to be an article. ' * 4}</p>" for _ in range(3))
    assert main_text(f"<body><h1>Big Title</h1><div class=post>{prose}</div></body>").startswith("Big Title Some prose")
    assert main_text(f"<body><div class=top><h2>Site</h2></div><div class=post>{prose}</div></body>").startswith("Some prose")
    assert main_text(f"<body><header><h1>Site</h1></header><div class=post>{prose}</div></body>").startswith("Some prose")
    assert "Some prose" in main_text(f"<script>if (a <!-- b) x</script><div>{prose}</div>")
