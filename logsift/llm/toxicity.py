"""Toxicity: a counterfactual-regularised logistic classifier over the distinct words and word stems of a whole text.

Training reads at most ``MAX_TRAIN`` labelled rows (those of the smallest hash), counts words by class in Spark, keeps
the ``MAX_WORDS`` words of the highest log-likelihood ratio, and fits on the driver. Each labelled text that mentions an
identity term has counterfactuals, in which the term is swapped for each other one of its kind and all features (words
and stems) are made anew; the squared change of the score's logit is penalised, as it is over a few neutral sentences
about groups. Scoring is one pass over Arrow batches.

Defined results. Null text counts as empty; the empty text has the model's bias as its score. Texts are read whole.
Rows with equal or null keys are scored one by one; a null key is held in as if it were the empty text. Without labelled
rows of both classes every score is the share of label 1 (0 if there are none). Empty table: no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, labelled, small_batches

MAX_TRAIN = 16_000
MAX_WORDS = 2_000
#: A word enters the model from this log-likelihood ratio on (one in a thousand by chance).
MIN_G2 = 10.8

#: Terms of one line are swapped for each other.
IDENTITY = [
    ["women", "men", "girls", "boys"],
    ["woman", "man", "girl", "boy"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "atheists"],
    ["black", "white", "asian", "latino", "african", "european"],
    ["gay", "straight", "lesbian", "bisexual", "transgender", "queer"],
    ["immigrant", "refugee", "foreigner", "native"],
    ["immigrants", "refugees", "foreigners", "natives"],
    ["disabled", "deaf", "blind", "autistic"],
    ["frauen", "männer"], ["muslime", "christen", "juden"],
    ["femmes", "hommes"], ["musulmans", "chrétiens", "juifs"],
    ["mujeres", "hombres"], ["musulmanes", "cristianos", "judíos"],
]
#: Neutral sentences, label 0, for every identity term.
NEUTRAL = ["{} people live here", "a talk by {} writers", "the {} community met"]

_WORDS = re.compile(r"[^\W\d_]+")
_KINDS = {t: [u for u in group if u != t] for group in IDENTITY for t in group}


#: Lengths of the stems (beginnings) of longer words, which are written with a hyphen at the end.
STEMS = (4, 5, 6)


def whole_words(text: str | None) -> set[str]:
    """Distinct lower-cased words of letters."""
    return set(_WORDS.findall((text or "").lower()))


def stemmed(whole: set[str]) -> set[str]:
    """The words with their stems: all features of a text that has these words."""
    return whole.union(*({w[:n] + "-" for w in whole if len(w) > n} for n in STEMS))


def words(text: str | None) -> set[str]:
    """Features of a text: its words and their stems."""
    return stemmed(whole_words(text))


def swaps(whole: set[str]) -> Iterator[tuple[list[str], list[str], float]]:
    """(features gained, features lost, weight) of each counterfactual of a text with these words.

    Each identity term gives way to every other one of its kind; the counterfactuals of one term weigh 1 in all.
    """
    before = None
    for term in sorted(whole & _KINDS.keys()):
        before = before or stemmed(whole)
        for other in _KINDS[term]:
            after = stemmed(whole - {term} | {other})
            yield sorted(after - before), sorted(before - after), 1 / len(_KINDS[term])


@dataclass
class Model:
    bias: float = 0.0
    weights: dict[str, float] = field(default_factory=dict)
    prior: float | None = None

    def score(self, text: str | None) -> float:
        if self.prior is not None:
            return self.prior
        get = self.weights.get
        z = self.bias + sum(get(w, 0.0) for w in sorted(words(text) & self.weights.keys()))
        return float(1 / (1 + np.exp(-z)))


def numbered(vocabulary: list[str]) -> dict[str, int]:
    """Columns of the model: the vocabulary and all identity terms."""
    return {w: i for i, w in enumerate(dict.fromkeys([*vocabulary, *_KINDS]))}


@dataclass
class Sparse:
    """Rows of a matrix: row, column and value of each entry, and a weight of each row."""

    row: np.ndarray
    column: np.ndarray
    value: np.ndarray
    weight: np.ndarray

    @staticmethod
    def of(rows: list[tuple[np.ndarray, np.ndarray]], weight) -> Sparse:
        """rows: (columns that hold 1, columns that hold -1)."""
        size = [len(a) + len(b) for a, b in rows]
        both = [x for r in rows for x in r]
        sign = np.repeat(np.tile([1.0, -1.0], len(rows)), [len(x) for x in both])
        column = np.concatenate(both).astype(np.int64) if both else np.zeros(0, np.int64)
        return Sparse(np.repeat(np.arange(len(rows)), size), column, sign, np.asarray(weight, dtype=float))

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.column], len(self.weight))

    def back(self, v: np.ndarray, columns: int) -> np.ndarray:
        return np.bincount(self.column, self.value * v[self.row], columns)


def loss_and_gradient(w: np.ndarray, bias: float, x: Sparse, y: np.ndarray, changes: Sparse, l2: float, swap: float) -> tuple[float, np.ndarray, float]:
    """Log loss + l2/2 |w|² + swap/2 · the weighted squares of the score changes; its gradient by w and by the bias."""
    z = x.times(w) + bias
    e = x.weight * (1 / (1 + np.exp(-z)) - y)
    d = changes.times(w)
    loss = (x.weight * (np.logaddexp(0, z) - y * z)).sum() + l2 / 2 * (w @ w) + swap / 2 * (changes.weight * d * d).sum()
    return float(loss), x.back(e, len(w)) + l2 * w + swap * changes.back(changes.weight * d, len(w)), float(e.sum())


def _columns(found, at: dict[str, int]) -> np.ndarray:
    return np.array(sorted(at[w] for w in found if w in at), dtype=np.int32)


def fit(rows: list[set[str]], y: np.ndarray, vocabulary: list[str], **how) -> Model:
    """The model of texts given as sets of whole words."""
    at = numbered(vocabulary)
    changes = [(_columns(a, at), _columns(b, at), k) for x in rows for a, b, k in swaps(x)]
    return fit_columns([_columns(stemmed(x), at) for x in rows], y, changes, at, **how)


def fit_columns(rows: list[np.ndarray], y: np.ndarray, changes: list[tuple[np.ndarray, np.ndarray, float]], at: dict[str, int], l2: float = 1.0, swap: float = 20.0, rounds: int = 400) -> Model:
    """Minimises ``loss_and_gradient`` by accelerated descent.

    rows: the columns that each text has; changes: columns gained and lost, and weight, of each counterfactual. Neutral
    sentences with every identity term come in as texts of label 0 and, like all texts, with their counterfactuals.
    """
    if len(rows) == 0 or y.min() == y.max():
        return Model(prior=float(y.mean()) if len(rows) else 0.0)
    neutral = [whole_words(s.format(t)) for t in _KINDS for s in NEUTRAL]
    none = np.zeros(0, dtype=np.int32)
    x = Sparse.of([(r, none) for r in [*rows, *(_columns(stemmed(n), at) for n in neutral)]], [*np.ones(len(rows)), *np.full(len(neutral), 0.1)])
    y = np.concatenate([y, np.zeros(len(neutral))])
    pairs = [*changes, *((_columns(a, at), _columns(b, at), k) for n in neutral for a, b, k in swaps(n))]
    swapped = Sparse.of([(a, b) for a, b, _ in pairs], [k for _, _, k in pairs])
    w, bias = np.zeros(len(at)), float(np.log(y.mean() / (1 - y.mean())))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, rounds + 1):
        _, g, gb = loss_and_gradient(w, bias, x, y, swapped, l2, swap)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        rate = 0.1 / (1 + step / 100)
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        bias -= rate * (mb / (1 - 0.9**step)) / (np.sqrt(vb / (1 - 0.99**step)) + 1e-8)
    return Model(float(bias), {t: float(w[i]) for t, i in at.items() if w[i]})


def train(rows: DataFrame) -> Model:
    """rows: text, y; a bounded frame (see ``labelled``)."""

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            for i in range(0, len(x), 50):  # word lists are several times as large as their texts
                part = x.iloc[i : i + 50]
                yield pd.DataFrame({"y": part["y"], "w": [sorted(words(t)) for t in part["text"]]})

    small_batches(rows)
    found = rows.select("y", "text").mapInPandas(listed, "y int, w array<string>").persist()
    try:
        total = found.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("k")).first()
        n, k = total["n"], total["k"]
        if not 0 < k < n:
            return Model(prior=k / n if n else 0.0)
        ll = lambda o, e: F.when(o > 0, o * F.log(o / e)).otherwise(F.lit(0.0))
        c, one = F.col("c").cast("double"), F.col("one").cast("double")
        counts = found.select("y", F.explode("w").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("c"), F.sum("y").alias("one"))
        g2 = 2 * (ll(one, c * k / n) + ll(c - one, c * (n - k) / n) + ll(k - one, (n - c) * k / n) + ll(n - c - k + one, (n - c) * (n - k) / n))
        best = counts.where(F.col("c") >= 2).select("w", g2.alias("g")).where(F.col("g") >= MIN_G2).orderBy(F.desc("g"), "w").limit(MAX_WORDS)
        vocabulary = [x["w"] for x in best.collect()]
        at = numbered(vocabulary)

        kind = "y int, c array<int>, changes array<struct<gained:array<int>,lost:array<int>,weight:double>>"

        def columns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for x in batches:  # small ones, as they were made
                changes = [[(_columns(a, at), _columns(b, at), k) for a, b, k in swaps({w for w in ws if w[-1] != "-"})] for ws in x["w"]]
                changes = [[{"gained": a, "lost": b, "weight": k} for a, b, k in c if len(a) or len(b)] for c in changes]
                yield pd.DataFrame({"y": x["y"], "c": [_columns(ws, at) for ws in x["w"]], "changes": changes})

        x = found.mapInPandas(columns, kind).toPandas()
    finally:
        found.unpersist()
    changes = [(np.asarray(e["gained"], np.int32), np.asarray(e["lost"], np.int32), e["weight"]) for c in x["changes"] for e in c]
    return fit_columns([np.asarray(c, dtype=np.int32) for c in x["c"]], x["y"].to_numpy(float), changes, at)


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """docs with the probability of label 1 as ``out``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in batches:
            yield pd.Series([shared.value.score(t) for t in x], dtype=float)

    return docs.withColumn(out, scored(F.coalesce(F.col(text), F.lit(""))))


def toxicity(docs: DataFrame, labels: DataFrame, mod: int = 5, held: int = 0, threshold: float = 0.5, key: str = "doc_id") -> DataFrame:
    """docs with held_out, score and predicted (0 or 1)."""
    small_batches(docs)
    source = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("held_out", "score", "predicted")])
    model = train(labelled(source, labels, "toxic", mod, held, MAX_TRAIN, key))
    small_batches(docs)
    out = score(source.withColumn("held_out", crc_mod(key, mod) == held), model)
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
