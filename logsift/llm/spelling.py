"""Spelling variants: words one edit apart, each with its commonest near word, by an even-partition pigeonhole join.

A word of L code points is indexed by two even segments, the first L // 2 code points and the rest, with L and the
segment's number. If another word of L or L + 1 code points is one edit away, the edit leaves one of the segments whole:
it stands in the other word at the same place or, where the edit came before it, shifted by one. So each word probes four
segments, two for its own length and two for the next shorter one. A segment that many words share is split by the same
argument: the edit lies in the rest of both words, so one of two even parts of that rest is whole too and joins the key.

A pair is taken where its first equal segment joins it, so candidates are met once without being shuffled again, and then
verified by a banded edit distance. A word's near words are at most a few thousand, as many as it has single edits.

Defined results. Null and empty texts have no words; a null id counts as the empty text in the hash. Rows that come again
count again. Empty table: no rows. Extra columns of the input are not read. Very long runs are words like others.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, small_batches

LEAST_LENGTH, LEAST_COUNT, RATIO = 5, 3, 2
#: One run in so many, by the hash of document and run, loses a code point.
NOISE = 97
#: A segment that more words have than this is split by parts of the rest.
HOT = 256
#: Distinct words that a task holds before it hands their counts on.
HELD = 200_000

_RUN = re.compile("[a-zÀ-ÿ]+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def noisy(doc_id: str, run: str, noise: int = NOISE) -> str:
    """The run without its code point h % length where ``noise`` divides h, the crc32 of ``doc_id:run``."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % noise:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def counted(text: bytes, doc_id: str, into: Counter, noise: int = NOISE) -> None:
    """Adds the words of one text (UTF-8) to the counts; of a run, all occurrences in a document have one hash."""
    start = zlib.crc32(f"{doc_id}:".encode())
    for run, n in Counter(_RUN.findall(text.translate(_LOWER).decode("utf-8", "replace"))).items():
        h = zlib.crc32(run.encode(), start)
        into[run if h % noise else noisy(doc_id, run, noise)] += n


def words(docs: DataFrame, key: str = "doc_id", text: str = "text", noise: int = NOISE, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n: counted in each task as far as ``HELD`` words go, summed by Spark."""
    small_batches(docs)
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            long = {w: n for w, n in held.items() if len(w) >= least_length}
            return pa.RecordBatch.from_arrays([pa.array(long.keys(), pa.string()), pa.array(long.values(), pa.int64())], schema=schema)

        for b in batches:
            for k, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                counted(t, k, held, noise)
                if len(held) > HELD:
                    yield out()
                    held.clear()
        if held:
            yield out()

    x = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    found = x.mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _left(s: Column, n: Column) -> Column:
    return F.substring(s, F.lit(1), n)


def _right(s: Column, n: Column) -> Column:
    """The last n code points."""
    return F.substring(s, F.length(s) - n + 1, n)


def _half(n: Column) -> Column:
    return F.floor(n / 2).cast("int")


def _segments(s: Column, indexed: Column) -> list[tuple[int, Column, Column]]:
    """(number, segment, rest) of s by the segments of a text of ``indexed`` code points, as long as s or one shorter.

    The first stands at the start, the second at the end: in a text that is one longer it is shifted by one.
    """
    first = _half(indexed)
    second, n = indexed - first, F.length(s)
    return [(0, _left(s, first), _right(s, n - first)), (1, _right(s, second), _left(s, n - second))]


def _keys(of: DataFrame, shorter: bool) -> DataFrame:
    """of (word, n) with a row for each segment: len (of the indexed word), part, seg, rest."""
    length = F.length("word") - (1 if shorter else 0)
    rows = [F.struct(length.alias("len"), F.lit(i).alias("part"), seg.alias("seg"), rest.alias("rest")) for i, seg, rest in _segments(F.col("word"), length)]
    return of.select("word", "n", F.explode(F.array(*rows)).alias("k")).select("word", "n", "k.*")


def _split(of: DataFrame, shorter: bool) -> DataFrame:
    """Rows of hot segments, keyed further by the two parts of the rest; len stays that of the indexed word."""
    length = F.length("rest") - (1 if shorter else 0)  # of the indexed word's rest
    subs = [F.struct(F.lit(j).alias("sub"), s.alias("sub_seg")) for j, s, _ in _segments(F.col("rest"), length)]
    return of.select("word", "n", "len", "part", "seg", F.explode(F.array(*subs)).alias("k")).select("word", "n", "len", "part", "seg", "k.*")


def _first(a: Column, b: Column, indexed: Column) -> Column:
    """The number of the first segment that both texts share, each at its place: 0, or 1 as they do share one."""
    h = _half(indexed)
    return F.when(_left(a, h) == _left(b, h), F.lit(0)).otherwise(F.lit(1))


def near_pairs(found: DataFrame, hot: int = HOT) -> DataFrame:
    """a, a_n, b, b_n: each pair of words (word, n) one edit apart once; b is as long as a, or one longer."""
    index = cut(_keys(found, False))  # read for sizes, index and probes of the same length
    longer = _keys(found, True)
    key = ["len", "part", "seg"]
    crowded = index.groupBy(*key).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > hot).drop("_c")
    out = []
    for probes, shorter in ((index, False), (longer, True)):
        for split in (False, True):
            how = "left_semi" if split else "left_anti"
            a, b = index.join(crowded, key, how), probes.join(crowded, key, how)
            on = key
            if split:
                a, b, on = _split(a, False), _split(b, shorter), [*key, "sub", "sub_seg"]
            left = a.select(*on, F.col("word").alias("a"), F.col("n").alias("a_n"))
            right = b.select(*on, F.col("word").alias("b"), F.col("n").alias("b_n"))
            x = left.join(right, on)
            x = x.where((F.col("a") < F.col("b")) if not shorter else F.lit(True)).where(F.col("part") == _first(F.col("a"), F.col("b"), F.length("a")))
            if split:
                rest = lambda w: F.when(F.col("part") == 0, _right(F.col(w), F.length(w) - F.length("seg"))).otherwise(_left(F.col(w), F.length(w) - F.length("seg")))
                x = x.where(F.col("sub") == _first(rest("a"), rest("b"), F.length(rest("a"))))
            out.append(x.where(F.levenshtein("a", "b", 1) == 1).select("a", "a_n", "b", "b_n"))
    return out[0].union(out[1]).union(out[2]).union(out[3])


def forms(found: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n: form is the near word of largest n (ties: the smallest) that has ratio times n."""
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).union(pairs.select("b", "a", "a_n"))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near"))).alias("f"))
    x = found.join(best, "word", "left")
    enough = -F.col("f.m") >= ratio * F.col("n")
    return x.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("f.near")).alias("form"), F.when(enough, -F.col("f.m")).alias("form_n"))


def roots(named: DataFrame) -> DataFrame:
    """word, root for words with a form. Forms are ever commoner, so chains end; pointers are doubled until none moves."""
    at = cut(named.where("form is not null").select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    while at.where("moved").limit(1).count():
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = cut(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
    return at.select("word", "root")


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text", noise: int = NOISE, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO, hot: int = HOT) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the texts."""
    found = cut(words(docs, key, text, noise, least_length, least_count))
    named = cut(forms(found, near_pairs(found, hot), ratio))
    x = named.join(roots(named), "word", "left")
    return x.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
