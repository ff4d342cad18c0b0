"""N-gram Jaccard join with adaptive multi-match prefixes.

Documents with 100 · |∩| >= 80 · |∪| of their shingle sets link; the result gives each document's component. The steps:

1. Documents of one word sequence are one node (the smallest id); only nodes go on.
2. Each node is paired with the smallest node that shares one of its eight least shingles. These star pairs are verified
   and give first components, so that a large group of near copies is one component at a linear cost.
3. A linked pair shares at least L of the first |x| - ceil(t|x|) + L shingles of each in hash order, for every L up to
   ceil(t|x|). These regions (L is half the plain prefix) go by shingle; a shingle in one component alone is done with.
4. What is left are shingles that several components share, with their counts. In a region, by ascending count, the most
   frequent L - 1 can be left out: a linked pair still shares one of the others. Each node lengthens this prefix by l - 1
   further shingles and asks for min(l of both) matches; l is what makes its estimated cost least: the nodes met under
   the prefix's shingles, and the pairs that reach l matches, which are verified.
5. A node whose prefix has a shingle of more than ``HOT`` nodes is dense: much of its text is shared by many. For pairs of
   dense nodes the order goes over all shingles of both, so that the most frequent four fifths of each are left out.
6. Pairs across components with enough matches, in the prefix and then in the whole region, are verified on whole sets.

Pairs inside a component need no verification: they are connected already. No cap is set on postings or candidates.

Defined results. Null or empty text, or one without words: n_shingles 0, a component of its own. Repeated rows are exact
copies of each other. A null key is carried through; it never is the smallest id of a group with other keys. Texts are
read whole. Empty table: no rows. Extra columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, small_batches
from .components import connected_components
from .shingling import shingle_sets

#: Linked from this many hundredths on.
PERCENT = 80
WORDS = 5
STAR = 8
#: Longest multi-match prefix, in matches asked for.
MOST_MATCHES = 6
#: Nodes of a shingle from which on it is met between dense nodes only.
HOT = 64
#: Cost of verifying a pair, in postings read.
VERIFY = 200.0
#: Rows up to which a table of ids is broadcast (16 bytes each); beyond that it is joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def least_overlap(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Shingles that a set of n shares with any linked one, at least."""
    return -(-percent * n // 100)


def matches_for(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """L of the region: half the plain prefix and one, at most the least overlap. Grows with n."""
    return np.maximum(1, np.minimum((n - least_overlap(n, percent)) // 2 + 1, least_overlap(n, percent)))


def region_size(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    return n - least_overlap(n, percent) + matches_for(n, percent)


def _checked_join(big: DataFrame, small: DataFrame, on: str, how: str) -> DataFrame:
    """The join with ``small`` broadcast if its counted rows are few, else by a shuffle."""
    return big.join(F.broadcast(small) if small.count() <= BROADCAST_ROWS else small, on, how)


def profiles(docs: DataFrame, words: int) -> DataFrame:
    """k, digest, n, least (the smallest shingles), for each row."""

    def profile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            rows = [(d, len(s), s[:STAR]) for s, d in shingle_sets(x["t"], words)]
            yield pd.DataFrame({
                "k": x["k"], "digest": [d for d, _, _ in rows], "n": [n for _, n, _ in rows],
                "least": [s.view(np.int64) for _, _, s in rows],
            })

    return docs.mapInPandas(profile, "k long, digest binary, n long, least array<long>")


def stars(least: DataFrame) -> DataFrame:
    """a, b: each node b with the smallest node a that has one of its least shingles."""
    rows = least.select(F.col("k"), F.explode("least").alias("s"))
    hubs = rows.groupBy("s").agg(F.min("k").alias("a"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    return rows.join(hubs, "s").where("k <> a").select("a", F.col("k").alias("b")).distinct()


def verified(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link. Only texts of nodes in a pair are cut again; a pair carries two sets of shingles."""
    ids = pairs.select(F.col("a").alias("k")).union(pairs.select(F.col("b").alias("k"))).distinct()

    def blobs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            yield pd.DataFrame({"k": x["k"], "x": [s.tobytes() for s, _ in shingle_sets(x["t"], words)]})

    def checked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            keep = []
            for p, q in zip(x["xa"], x["xb"]):
                p, q = np.frombuffer(p, dtype=np.uint64), np.frombuffer(q, dtype=np.uint64)
                m = np.minimum(np.searchsorted(q, p), max(0, len(q) - 1))
                same = int((q[m] == p).sum()) if len(q) else 0
                keep.append(100 * same >= percent * (len(p) + len(q) - same))
            yield x.loc[keep, ["a", "b"]]

    sets = _checked_join(docs, ids, "k", "left_semi").mapInPandas(blobs, "k long, x binary")
    both = pairs.join(sets.select(F.col("k").alias("b"), F.col("x").alias("xb")), "b").join(sets.select(F.col("k").alias("a"), F.col("x").alias("xa")), "a")
    return both.mapInPandas(checked, "a long, b long")


def regions(docs: DataFrame, words: int, percent: int, whole: bool = False) -> DataFrame:
    """s, k, c, n: the region of each node, c its component; whole: all its shingles."""

    def cut_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            rows = [s for s, _ in shingle_sets(x["t"], words)]
            n = np.array([len(s) for s in rows], dtype=np.int64)
            take = n if whole else np.where(n > 0, region_size(n, percent), 0)
            s = np.concatenate([r[:t] for r, t in zip(rows, take)]) if len(rows) else np.zeros(0, np.uint64)
            for i in range(0, len(s), 1 << 18):
                part = slice(i, i + (1 << 18))
                yield pd.DataFrame({"s": s.view(np.int64)[part], "k": np.repeat(x["k"].to_numpy(), take)[part], "c": np.repeat(x["c"].to_numpy(), take)[part], "n": np.repeat(n, take)[part]})

    return docs.mapInPandas(cut_out, "s long, k long, c long, n long")


def shared(rows: DataFrame) -> DataFrame:
    """Of rows (s, k, c, n) those whose shingle lies in two components or more, with f, its number of rows."""
    w = Window.partitionBy("s")
    seen = rows.select("*", F.min("c").over(w).alias("lo"), F.max("c").over(w).alias("hi"), F.count(F.lit(1)).over(w).alias("f"))
    return seen.where("lo < hi").drop("lo", "hi")


def _least_overlap(n: Column, percent: int) -> Column:
    return F.floor((percent * n + 99) / 100)


def _matches_for(n: Column, percent: int) -> Column:
    low = _least_overlap(n, percent)
    return F.greatest(F.lit(1), F.least(F.floor((n - low) / 2) + 1, low))


def prefixes(rows: DataFrame, percent: int, whole: bool = False) -> DataFrame:
    """rows of ``shared``: those of each node's adaptive prefix, with l, the matches that the node asks for, and top, the
    largest f among them. whole: the rows are of whole sets, not regions."""
    n = F.col("n")
    low = _least_overlap(n, percent)
    size = n if whole else n - low + _matches_for(n, percent)
    least = low if whole else _matches_for(low, percent)  # what it shares of these rows with any partner, at least
    own, order = Window.partitionBy("k"), Window.partitionBy("k").orderBy("f", "s")
    # shingles that no other component has come first in the order
    x = rows.select("*", F.row_number().over(order).alias("r"), (size - F.count(F.lit(1)).over(own)).alias("alone"), size.alias("size"), least.alias("least"))
    upto = lambda l: F.col("size") - F.col("least") + l - F.col("alone")
    met = {l: F.coalesce(F.sum(F.when(F.col("r") <= upto(l), F.col("f") - 1)).over(own), F.lit(0)) for l in range(1, 2 if whole else MOST_MATCHES + 1)}
    # of whole sets the place of the first match rules out what more matches would
    cost = {l: F.when(F.col("least") >= l, met[l] * (1 + VERIFY / l**2)) for l in met}
    x = x.select("s", "k", "c", "n", "f", "r", "alone", "size", "least", F.array(*[F.struct(c.alias("cost"), F.lit(l).alias("l")) for l, c in cost.items()]).alias("costs"))
    best = F.array_min(F.filter("costs", lambda v: v.cost.isNotNull())).l
    x = x.withColumn("l", best).where(F.col("r") <= upto(F.col("l")))
    place = F.greatest(F.col("alone"), F.lit(0)) + F.col("r") - 1
    return x.select("s", "k", "c", "n", "l", "f", F.max("f").over(own).alias("top"), place.alias("at"))


def candidates(rows: DataFrame, percent: int, whole: bool = False) -> DataFrame:
    """a, b, n (the smaller size): pairs of nodes of different components and fitting sizes with enough matches.

    whole: places are those in the whole sets, so that what follows a pair's first match bounds its overlap. Matches
    after which too little is left are no rows of the join: a linked pair keeps its first one, and one is asked for.
    """
    x = rows.select("s", F.col("k").alias("a"), F.col("c").alias("ca"), F.col("n").alias("na"), F.col("l").alias("la"), F.col("at").alias("ia"))
    y = rows.select("s", F.col("k").alias("b"), F.col("c").alias("cb"), F.col("n").alias("nb"), F.col("l").alias("lb"), F.col("at").alias("ib"))
    fits = (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    if whole:
        most = F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib"))
        fits = fits & ((100 + percent) * most >= percent * (F.col("na") + F.col("nb")))
    found = x.join(y, "s").where(fits).groupBy("a", "b").agg(F.count(F.lit(1)).alias("got"), F.first(F.least("la", "lb")).alias("need"), F.first(F.least("na", "nb")).alias("n"))
    return found.where("got >= need").select("a", "b", "n")


def filtered(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b, n: the smaller size) those that share enough of their whole regions."""
    lists = rows.groupBy("k").agg(F.sort_array(F.collect_list("s")).alias("x"))
    both = pairs.join(lists.select(F.col("k").alias("a"), F.col("x").alias("xa")), "a").join(lists.select(F.col("k").alias("b"), F.col("x").alias("xb")), "b")
    return both.where(F.size(F.array_intersect("xa", "xb")) >= _matches_for(F.col("n"), percent)).select("a", "b")


def ngram_join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles, component_id for every row."""
    small_batches(docs)
    source = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    every = cut(profiles(source, words))
    classes = cut(every.where("n > 0").groupBy("digest").agg(F.min("k").alias("node"), F.first("least").alias("least")))
    nodes = classes.where("node is not null").select(F.col("node").alias("k"), "least")
    links = cut(verified(cut(stars(nodes)), source, words, percent))
    parts = connected_components(links)
    own = nodes.select("k").join(parts.select(F.col("node").alias("k"), F.col("component").alias("c")), "k", "left")
    own = cut(own.select("k", F.coalesce("c", "k").alias("c")))
    found = regions(_checked_join(source, own, "k", "inner"), words, percent)
    rows = cut(shared(found.distinct() if _repeats(every) else found))
    chosen = cut(prefixes(rows, percent))
    dense = cut(chosen.where(F.col("top") > HOT).select("k").distinct())
    pairs = filtered(candidates(chosen.where(F.col("f") <= HOT), percent), rows, percent)
    if dense.limit(1).count():
        sets = regions(_checked_join(source, own.join(dense, "k"), "k", "inner"), words, percent, whole=True)
        sets = cut(shared(sets.distinct() if _repeats(every) else sets))
        pairs = pairs.union(candidates(prefixes(sets, percent, whole=True), percent, whole=True).select("a", "b")).distinct()
    pairs = cut(pairs)
    more = cut(verified(pairs, source, words, percent))
    final = connected_components(links.union(more))
    named = classes.join(final.select("node", "component"), "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
    out = every.join(named, (every.digest == named.digest) & (every.n > 0), "left")
    return out.select(F.col("k").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "k").alias("component_id"))


def _repeats(every: DataFrame) -> bool:
    """Whether a key comes twice; then the regions of its rows are taken together."""
    return every.groupBy("k").count().where("count > 1").limit(1).count() > 0
