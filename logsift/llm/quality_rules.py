"""Quality rules as a short-circuit cascade, in DataFrame functions only.

``base_counts`` gives every text its counts. ``RULES`` are predicates over these and the text that reject a document.
``plan_cascade`` measures each rule on a bounded sample (seconds a row, share rejected) and orders the rules by
rejection per cost; ``cascade`` evaluates them as one CASE, so that a rule runs only where all before it passed.
The verdict is the same for every order; only the work differs.

Defined results. Null or empty text: all counts 0, base_failed true. Very long texts are read whole. Rows with equal or
null keys are judged one by one. Empty table: no rows. Columns of the input stay as they are, unless they bear the name
of a result column, which replaces them. 8-word windows are compared by 64-bit hashes within one text.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, words_of

WINDOW = 8
#: Rows that costs and selectivities are estimated from.
SAMPLE_ROWS = 2000


def _repeated(win: Column) -> Column:
    """Words inside windows that occur twice or more; win: a hash for each window, in order."""

    def cover(p: Column) -> Column:
        gaps = F.zip_with(F.slice(p, F.lit(1), F.size(p) - 1), F.slice(p, F.lit(2), F.size(p) - 1), lambda a, b: F.least(F.lit(WINDOW), b - a))
        return F.aggregate(gaps, F.lit(WINDOW), lambda s, x: s + x)

    def starts(pairs: Column) -> Column:
        same = lambda k, j: F.coalesce(F.get(pairs, k).h == F.get(pairs, j).h, F.lit(False))
        twice = F.filter(F.sequence(F.lit(0), F.size(pairs) - 1), lambda k: same(k, k - 1) | same(k, k + 1))
        return F.sort_array(F.transform(twice, lambda k: F.get(pairs, k).i))

    pairs = F.sort_array(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(win)) == F.size(win), F.lit(0)).otherwise(let(pairs, lambda p: let(starts(p), cover)))


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (long) and base_failed."""
    made = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed", "_t", "_words", "_lines", "_h", "_win"]
    names = [c for c in docs.columns if c not in made]
    t = F.coalesce(F.col(text), F.lit(""))
    keep = [F.col(f"`{c}`") for c in names]
    a = docs.select(*keep, t.alias("_t"), words_of(F.col(text)).alias("_words"))
    a = a.select(
        *keep, "_t", F.size("_words").cast("long").alias("n_words"), F.transform("_words", lambda w: F.xxhash64(w)).alias("_h"),
        F.filter(F.split("_t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
    )
    window = F.transform(F.sequence(F.lit(0), F.size("_h") - WINDOW), lambda i: F.xxhash64(*[F.get(F.col("_h"), i + j) for j in range(WINDOW)]))
    a = a.select(
        *keep, "_t", "n_words", F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("_h") > WINDOW, window).otherwise(F.array().cast("array<bigint>")).alias("_win"),
    )
    a = a.select(
        *keep, "n_words", (F.length("_t") - F.regexp_count("_t", F.lit(r"[\x20\x09-\x0D]"))).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"), "n_lines", "n_dup_lines", _repeated(F.col("_win")).cast("long").alias("n_repeat_words"),
    )
    return a.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column
    cost: float = 0.0
    selectivity: float = 0.0

    @property
    def rank(self) -> float:
        return self.selectivity / max(self.cost, 1e-9)


def rules(text: str = "text") -> list[Rule]:
    """The rules beyond the base, over the columns of base_counts and the text; thresholds are whole-number comparisons."""
    c = F.col
    t = F.coalesce(F.col(text), F.lit(""))
    n = lambda p: F.regexp_count(t, F.lit(p))
    return [
        Rule("symbols", 10 * c("n_symbols") > c("n_words")),
        Rule("repeated_lines", 2 * c("n_dup_lines") > c("n_lines")),
        Rule("word_length", (c("word_chars") < 2 * c("n_words")) | (c("word_chars") > 14 * c("n_words"))),
        Rule("upper_case", 2 * n(r"\p{Lu}") > n(r"\p{L}")),
        Rule("exclamations", 5 * n("!") > c("n_words")),
        Rule("few_letters", 3 * n(r"\p{L}") < c("word_chars")),
        Rule("ellipsis_lines", 10 * n(r"(?:\.\.\.|…)[ \t]*(?:\n|\z)") > 3 * c("n_lines")),
        Rule("bullet_lines", 10 * n(r"(?:\A|\n)[ \t]*[•*-][ \t]") > 9 * c("n_lines")),
    ]


def plan_cascade(counted: DataFrame, candidates: list[Rule], rows: int = SAMPLE_ROWS, seed: int = 7) -> list[Rule]:
    """Candidates with cost and selectivity measured on about ``rows`` sampled rows, best rejection per cost first."""
    total = counted.count()
    if not total:
        return candidates
    sample = counted.sample(min(1.0, rows / total), seed).persist()
    try:
        def run(expr: Column) -> tuple[float, float]:
            best, out = float("inf"), None
            for _ in range(2):
                at = time.perf_counter()
                out = sample.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(expr.cast("int")), F.lit(0)).alias("k")).first()
                best = min(best, time.perf_counter() - at)
            return best, out["k"] / max(out["n"], 1)

        run(F.lit(True))
        floor, _ = run(F.lit(True))
        measured = []
        for r in candidates:
            seconds, share = run(r.rejects)
            measured.append(replace(r, cost=max(seconds - floor, 1e-4), selectivity=share))
    finally:
        sample.unpersist()
    return sorted(measured, key=lambda r: (-r.rank, r.cost))


def cascade(ordered: list[Rule]) -> Column:
    """Name of the first rule of this order that rejects the row, else null."""
    out = F.when(F.lit(False), F.lit(""))
    for r in ordered:
        out = out.when(r.rejects, F.lit(r.name))
    return out


def quality_rules(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """docs with the base counts, base_failed and kept: true where neither the base nor any rule rejects."""
    source = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != "kept"])
    total = source.count()
    ordered = rules(text)
    if total:
        sample = source.sample(min(1.0, 2 * sample_rows / total), 11).limit(2 * sample_rows)
        ordered = plan_cascade(base_counts(sample, text), ordered, sample_rows)
    counted = base_counts(source, text)
    # a filter on kept must not be pushed below the counts, where each mention of one would compute it anew: Catalyst
    # leaves filters above columns that it can't take for deterministic
    here = F.monotonically_increasing_id() >= 0
    return counted.withColumn("kept", here & F.when(F.col("base_failed"), F.lit(False)).otherwise(cascade(ordered).isNull()))
