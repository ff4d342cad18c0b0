"""Quality classifier: regularised quadratic discriminant over transformed statistics of a whole text.

Statistics are DataFrame functions. Each class has a mean and a covariance shrunk towards the pooled one and towards its
diagonal; scores are the logistic of the difference of the classes' Gaussian log densities plus log prior odds, from
Mahalanobis distances by Cholesky factors that are inverted once and kept in the model.

Training reads at most ``MAX_TRAIN`` labelled rows (of the smallest hashes). Defined results. Null text counts as empty,
whose statistics are 0, but for the spread of its words, which is 1 for texts of one word or none. Rows with equal or null keys are scored one by one. Without labelled rows of both classes
every score is the share of label 1 (0 if there are none). Empty table: no rows. Clashing columns are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, labelled, ratio, small_batches, words_of

MAX_TRAIN = 20_000
STATISTICS = ["log_words", "word_length", "symbols", "capitals", "exclamations", "letters", "repeated_lines", "distinct_words", "line_length", "digits", "commas"]


def statistics(docs: DataFrame, text: str = "text", out: str = "_x") -> DataFrame:
    """docs with ``out``: array<double> in the order of STATISTICS."""
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in (out, "_t", "_w", "_l")]
    t = F.coalesce(F.col(text), F.lit(""))
    a = docs.select(*keep, t.alias("_t"), words_of(F.col(text)).alias("_w"), F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_l"))
    n, lines, chars = F.size("_w"), F.size("_l"), F.length("_t")
    count = lambda p: F.regexp_count("_t", F.lit(p))
    soft = lambda x: F.log1p(20 * x)
    letters = count(r"\p{L}")
    x = F.array(
        F.log1p(n.cast("double")), ratio(chars, n + 1), soft(ratio(count("[#*$%&|<>~^=_]"), n)), soft(ratio(count(r"\p{Lu}"), letters)), soft(ratio(count("!"), n)),
        ratio(letters, chars), soft(ratio(lines - F.size(F.array_distinct("_l")), lines)), _spread(F.size(F.array_distinct("_w")), n),
        F.log1p(ratio(n, lines)), soft(ratio(count(r"\p{Nd}"), chars)), soft(ratio(count("[.,;:]"), n)),
    )
    return a.select(*keep, x.alias(out))


def _spread(distinct: Column, n: Column) -> Column:
    """log distinct words over log words: near 1 unless words come again more than in prose."""
    return F.when(n > 1, F.log1p(distinct.cast("double")) / F.log1p(n.cast("double"))).otherwise(F.lit(1.0))


@dataclass
class Model:
    centre: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    inverse: list[np.ndarray]  # of the Cholesky factors
    constant: list[float]
    prior: float | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(x), self.prior)
        z = (x - self.centre) / self.scale
        d = [c - 0.5 * np.square((z - m) @ inv.T).sum(axis=1) for m, inv, c in zip(self.means, self.inverse, self.constant)]
        return 1 / (1 + np.exp(-np.clip(d[1] - d[0], -700, 700)))


def fit(x: np.ndarray, y: np.ndarray, pooled: float = 0.1, ridge: float = 0.05) -> Model:
    """pooled, ridge: shares of the pooled covariance and of a scaled identity in each class's covariance."""
    if len(y) == 0 or y.min() == y.max():
        return Model(np.zeros(0), np.zeros(0), [], [], [], float(y.mean()) if len(y) else 0.0)
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = (x - centre) / scale
    parts = [z[y == k] for k in (0, 1)]
    means = [p.mean(axis=0) for p in parts]
    own = [(p - m).T @ (p - m) / len(p) for p, m in zip(parts, means)]
    both = sum(len(p) * s for p, s in zip(parts, own)) / len(z)
    inverse, constant = [], []
    for p, s in zip(parts, own):
        mixed = (1 - pooled) * s + pooled * both
        mixed = (1 - ridge) * mixed + ridge * np.eye(len(mixed)) * np.trace(mixed) / len(mixed)
        factor = np.linalg.cholesky(mixed)
        inverse.append(np.linalg.inv(factor))
        constant.append(float(np.log(len(p) / len(z)) - np.log(np.diag(factor)).sum()))
    return Model(centre, scale, means, inverse, constant)


def train(rows: DataFrame) -> Model:
    """rows: text, y; a bounded frame (see ``labelled``)."""
    got = statistics(rows).select("y", "_x").collect()
    return fit(np.array([r["_x"] for r in got], float).reshape(len(got), len(STATISTICS)), np.array([r["y"] for r in got], float))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in batches:
            yield pd.Series(shared.value.score(np.stack(x.to_numpy())) if len(x) else [], dtype=float)

    return statistics(docs, text).withColumn(out, scored("_x")).drop("_x")


def quality_classifier(docs: DataFrame, labels: DataFrame, mod: int = 4, held: int = 2, threshold: float = 0.7, key: str = "doc_id") -> DataFrame:
    """docs with held_out, score and predicted (0 or 1)."""
    small_batches(docs)
    source = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("held_out", "score", "predicted")])
    model = train(labelled(source, labels, "quality", mod, held, MAX_TRAIN, key))
    out = score(source.withColumn("held_out", crc_mod(key, mod) == held), model)
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
