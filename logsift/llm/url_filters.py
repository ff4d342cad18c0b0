"""URL filters: host and path rules first, else logistic regression on hashed character n-grams.

The model is trained on the driver from a small labelled URL table: ``labelled_urls``, or at most ``MAX_LABELLED`` rows
of any frame of url and bad. ``url_filter`` runs it over Arrow batches.

Defined results. Null url, or one without ``://``: empty host and path; no rule fits, the model's verdict holds for the
empty strings. Empty table: no rows. Rows with equal or null keys are judged one by one. A clashing column is replaced.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules: (verdict, host, path prefix).
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
BITS = 14
GRAMS = (3, 4, 5)

#: Rows of the labelled table that are trained on, at most (those of the smallest hashes).
MAX_LABELLED = 20_000

#: Words of host names by topic in the labelled table, from general knowledge of what block lists hold and what they don't.
BAD_TOPICS = {
    "gambling": "casino gambling poker slots roulette jackpot bingo betting bets lottery wager blackjack sportsbook winner lucky",
    "pharmacy": "pharmacy pills meds drugs viagra cialis steroids rx tablets diet slimming prescription",
    "adult": "adult porn sex xxx escort webcam nude erotic hookup singles dating hot",
    "tracking": "ads adserver adclick track tracker clicks popunder banners affiliate pixel traffic redirect",
    "piracy": "warez crack keygen torrent nulled serials malware hack freedownload fullversion cheats",
    "money": "payday loans cash credit debt bitcoin profit invest forex rich earn income",
    "fakes": "replica cheap outlet discount knockoff wholesale deals luxury bargain coupon clearance",
    "spam": "spam backlinks clickbait prize giveaway freegift bonus promo viral bulk",
    "phishing": "verify secure login account update signin confirm wallet support billing unlock suspended",
}
GOOD_TOPICS = {
    "news": "news herald times gazette daily tribune press reporter chronicle weather",
    "learning": "school university library academy college courses lessons physics biology mathematics history",
    "culture": "museum theatre gallery music orchestra poetry novels cinema photo painting",
    "code": "docs developer python compiler kernel database wiki forum opensource manual archive",
    "home": "garden recipes kitchen bakery knitting woodwork hiking cycling camping travel",
    "public": "council hospital parliament transport fire police water parks census health",
    "trade": "bookshop furniture plumbing bicycle hardware carpentry pottery brewery farmers tailor",
    "science": "research journal astronomy geology climate chemistry laboratory institute ocean genetics",
}
#: Places around a topic's word in a host, and zones; {w} the word, {v} another of the topic.
BAD_HOSTS = ["{w}-{v}.{z}", "best{w}.{z}", "www.{w}-{v}.{z}", "{w}{v}.{z}", "free-{w}.{z}", "blog.{w}-{v}.{z}", "www.{w}-online.{z}", "{w}24.{z}", "m.{w}-{v}.{z}", "get-{w}-now.{z}", "{w}.{v}.{z}", "{v}{w}77.{z}", "m.{v}-{w}.{z}", "top10{w}.{z}", "my{w}-{v}.{z}"]
GOOD_HOSTS = ["{w}{v}.{z}", "www.{w}.{z}", "{w}.{v}.{z}", "blog.{w}-{v}.{z}", "{v}-{w}.{z}", "m.{w}{v}.{z}", "the{w}.{z}", "{w}.{z}", "www.{v}{w}.{z}", "city-{w}.{z}", "{w}club.{z}"]
BAD_ZONES = ["com", "net", "org", "xyz", "top", "click", "win", "info", "biz", "loan"]
GOOD_ZONES = ["com", "net", "org", "edu", "gov", "co.uk", "de", "fr", "io", "info"]
#: Zones in which hosts of both labels lie.
SHARED_ZONES = ["example.com", "example.net", "example.org", "com", "net", "org"]
#: Paths that say nothing, and those that do.
SHARED_PATHS = ["/", "/en/{n}", "/fr/{n}/", "/de/{n}.html", "/es/{n}", "/item/{n}", "/{n}.html", "/en/{n}.html", "/de/{n}/", "/es/{n}.html", "/fr/{n}"]
BAD_PATHS = ["/buy", "/order.php", "/click/{n}", "/go/{n}", "/promo/{n}", "/download/setup.exe", "/free-trial", "/signup/bonus", "/win/{n}", "/cheap-{w}", "/login/verify", "/x/{n}.exe", "/out.php"]
GOOD_PATHS = ["/about", "/articles/{y}/05/{w}", "/wiki/{w}", "/docs/{w}/index.html", "/blog/{y}/{w}", "/contact", "/{w}/{v}", "/archive/{y}", "/opening-hours", "/questions/{n}/{w}", "/{y}/08/14/{w}.html"]


def labelled_urls() -> pd.DataFrame:
    """The labelled table, made from the lists above by rule: url, bad (1 or 0).

    Beside the topics it has invented names (of syllables) and empty urls, label 0, so that an unknown or missing name is
    no reason to block.
    """
    rows, k = [], 0

    def add(hosts, zones, paths, w, v, bad):
        nonlocal k
        for j in range(6):
            z = (SHARED_ZONES if j % 2 else zones)[(k // 2) % (6 if j % 2 else len(zones))]
            host, path = hosts[k % len(hosts)], (SHARED_PATHS if j < 4 else paths)[(k // 6 + 5 * j) % len(SHARED_PATHS if j < 4 else paths)]
            fill = {"w": w, "v": v, "z": z, "n": 100 + 37 * k % 9000, "y": 2001 + k % 24}
            rows.append((f"http{'s' * (k % 2)}://{(host + path).format(**fill)}", bad))
            k += 1

    for topics, hosts, zones, paths, bad in ((BAD_TOPICS, BAD_HOSTS, BAD_ZONES, BAD_PATHS, 1), (GOOD_TOPICS, GOOD_HOSTS, GOOD_ZONES, GOOD_PATHS, 0)):
        for words in map(str.split, topics.values()):
            for i, w in enumerate(words):
                for step in (1, 4, 6) if bad else (1, 4):
                    add(hosts, zones, paths, w, words[(i + step) % len(words)], bad)
    syllables = [c + v for c in "b c d f g h l m n p r s t v w th st wh tr sh".split() for v in ("a", "e", "i", "o", "ou", "er", "en", "al", "io")]
    for i in range(600):
        name = "".join(syllables[(i * p + q) % len(syllables)] for p, q in ((7, 3), (31, 11), (53, 29))[: 2 + i % 2]) + ("", "n", "d", "s", "t", "ly", "ing")[i % 7]
        add(["{w}.{z}", "m.{w}.{z}", "blog.{w}.{z}", "www.{w}.{z}"], GOOD_ZONES[:3], GOOD_PATHS, name, name[::-1], 0)
    rows += [("http://" + "/" * (i % 2), 0) for i in range(40)]
    return pd.DataFrame(rows, columns=["url", "bad"])


def bounded(labelled: DataFrame | pd.DataFrame | None) -> pd.DataFrame:
    """The labelled table on the driver: the built-in one, or ``MAX_LABELLED`` rows (url, bad) of a given one."""
    if labelled is None:
        return labelled_urls()
    if isinstance(labelled, pd.DataFrame):
        return labelled.iloc[:MAX_LABELLED]
    rows = labelled.select("url", F.col("bad").cast("int").alias("bad")).where("url is not null and bad is not null")
    return rows.orderBy(F.xxhash64("url"), "url", "bad").limit(MAX_LABELLED).toPandas()


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Iterable[tuple[str, str, str]] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    out = F.when(F.lit(False), F.struct(F.lit("").alias("rule"), F.lit("").alias("verdict")))
    for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        out = out.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")))
    return out


def grams(host: str, path: str, bits: int = BITS) -> np.ndarray:
    """Sorted distinct hashed n-grams of host and path, which have separate spaces."""
    found = set()
    for mark, s in (("h", f"^{host}$"), ("p", f"^{path}$")):
        for n in GRAMS:
            found.update(mark + s[i : i + n] for i in range(max(1, len(s) - n + 1)))
    return np.unique([zlib.crc32(g.encode()) & ((1 << bits) - 1) for g in found])


def split_url(url: str | None) -> tuple[str, str]:
    _, sep, rest = (url or "").partition("://")
    if not sep:
        return "", ""
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    end = min((rest.find(c) for c in "?#" if c in rest), default=len(rest))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:end]


def train(urls: pd.DataFrame, bits: int = BITS, l2: float = 0.3, rounds: int = 400, rate: float = 0.5) -> tuple[np.ndarray, float]:
    """Weights and bias of an L2-regularised logistic regression; the table must fit on the driver, as it is small."""
    rows = [grams(*split_url(u), bits) for u in urls["url"]]
    y = urls["bad"].to_numpy(float)
    r = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
    c = np.concatenate(rows)
    v = (1 / np.sqrt([len(x) for x in rows]))[r]
    w, b, n = np.zeros(1 << bits), 0.0, len(rows)
    m, size = np.zeros_like(w), np.full_like(w, 1e-8)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(np.bincount(r, v * w[c], n) + b)))
        g = np.bincount(c, v * (p - y)[r], len(w)) + l2 * w / n
        size += g * g
        m = 0.9 * m + g / np.sqrt(size)
        w, b = w - rate * m * 0.1, b - rate * (p - y).mean()
    return w, b


def score_urls(host: pd.Series, path: pd.Series, model: tuple[np.ndarray, float]) -> np.ndarray:
    """Probability that the url is bad."""
    w, b = model
    out = np.empty(len(host))
    for i, (h, p) in enumerate(zip(host, path)):
        g = grams(h, p, len(w).bit_length() - 1)
        out[i] = w[g].sum() / np.sqrt(len(g)) + b
    return 1 / (1 + np.exp(-out))


def url_filter(pages: DataFrame, url: str = "url", rules=RULES, labelled: DataFrame | pd.DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """pages with host, path, rule, verdict and p_bad (the model's probability)."""
    w, b = train(bounded(labelled))
    model = pages.sparkSession.sparkContext.broadcast((w.astype("float32"), float(b)))

    @F.pandas_udf("double")
    def p_bad(host: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for h, p in host:
            yield pd.Series(score_urls(h, p, model.value))

    made = ["host", "path", "rule", "verdict", "p_bad", "_r"]
    rest = [F.col(f"`{c}`") for c in pages.columns if c not in made]
    out = pages.select(*rest, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    out = out.select("*", rule_of(F.col("host"), F.col("path"), rules).alias("_r"), p_bad("host", "path").alias("p_bad"))
    verdict = F.coalesce(F.col("_r.verdict"), F.when(F.col("p_bad") >= threshold, "block").otherwise("allow"))
    return out.select(*rest, "host", "path", F.col("_r.rule").alias("rule"), verdict.alias("verdict"), "p_bad")
