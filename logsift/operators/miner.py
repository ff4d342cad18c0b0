"""Template mining: masked lines of one shape are grouped by the tokens that they share, in order of arrival.

A line's leaf is its service, its number of tokens and the routing keys of its first two tokens; all three are Columns. A
tree node takes the first ``CHILDREN`` distinct keys that arrive and sends later ones to the wildcard, which is decided
by ranks of first arrivals before anything is mined. Leaves are independent of each other.

A line joins the group with the most equal positions (the earliest of equals) if these are at least ``THRESHOLD`` of all;
positions that differ become the wildcard there. Else it founds a group. By default equal token sequences are counted
before they are mined (``exact=False``); ``exact=True`` feeds every line, which can differ where a repeated line meets a
later, closer group.

Only few lines change a leaf's groups: those that found one or make one more general. A leaf is dealt to slices of
``SLICE`` rows, which are mined in parallel, each on its own; the lines that changed something there are guesses for the
leaf's own changes. Guesses are mined in order of arrival (by ``FAN`` slices at a time until they are one run), which
gives a history of changes. Every slice then replays the history along its rows and holds each row against the groups as
they were when it arrived. A row that would have changed them, but isn't in the history, becomes a guess too, and the
leaf is mined and replayed again. The earliest such row is certain each time, so this ends, and where it ends the history
is what one run over the whole leaf makes, whatever the slices are. A task holds a slice's rows, or the guesses of
``FAN`` slices, and the leaf's groups.

``known`` holds the groups of earlier batches: they come first in their leaves, and their keys first in their nodes, so a
stream resolves a line as one long run would. ``mine`` gives the lines, ``grown`` also the groups to keep for later.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import WILDCARD, route_key, template_hash
from .graph import cut

THRESHOLD, CHILDREN, SLICE, FAN = 0.5, 100, 50_000, 16
LEAF = ["service", "n_tokens", "b1", "b2"]
#: Groups that a stream keeps: leaf, place in it, and the template's tokens.
KNOWN = "service string, n_tokens int, b1 string, b2 string, place int, tokens array<string>"
#: A frame of such groups, or a function from the rows that are fed (service, tokens, seq) to one.
Known = DataFrame | Callable[[DataFrame], DataFrame] | None
#: Templates up to so many are broadcast to the lines.
BROADCAST_ROWS = 50_000


class Groups:
    """The groups of one leaf, with an index from (position, token) to the groups that have the token there.

    A group that reaches the least number of equal positions has one of them among any ``n - least + 1`` positions, so
    those with the fewest groups give all candidates. A position that became the wildcard stays in the index; candidates
    are compared with the templates themselves.
    """

    def __init__(self, n: int, threshold: float):
        self.n, self.least = n, max(1, math.ceil(threshold * n - 1e-9))
        self.any = threshold * n <= 1e-9  # then a group without an equal position will do
        self.numbers: dict[str, int] = {WILDCARD: 0}
        self.table = np.zeros((16, n), dtype=np.int64)
        self.used = 0
        self.index: list[dict[int, list[int]]] = [{} for _ in range(n)]
        self.tokens: list[list[str]] = []

    def coded(self, tokens) -> np.ndarray:
        return np.fromiter((self.numbers.setdefault(t, len(self.numbers)) for t in tokens), dtype=np.int64, count=self.n)

    def put(self, place: int, tokens) -> None:
        """Sets the template of a group, a new one or one more general than before."""
        row = self.coded(tokens)
        if place == self.used:
            if place == len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            for at, code in enumerate(row.tolist()):
                if code:
                    self.index[at].setdefault(code, []).append(place)
            self.used += 1
            self.tokens.append(list(tokens))
        self.table[place] = row
        self.tokens[place] = list(tokens)

    def match(self, tokens) -> tuple[int, list[str]]:
        """(place that the line goes to, the group's template after it); nothing is changed."""
        if not self.used:
            return 0, list(tokens)
        row = self.coded(tokens)
        if self.any:
            found = np.arange(self.used)
        else:
            lists = sorted((self.index[at].get(code, ()) for at, code in enumerate(row.tolist())), key=len)
            near = [g for groups in lists[: self.n - self.least + 1] for g in groups]
            if not near:
                return self.used, list(tokens)
            found = np.unique(near)
        shared = ((self.table[found] == row) & (row != 0)).sum(axis=1)
        best = int(shared.argmax())
        if shared[best] < self.least and not self.any:
            return self.used, list(tokens)
        place = int(found[best])
        old = self.tokens[place]
        return place, [a if a == b else WILDCARD for a, b in zip(old, tokens)]

    def feed(self, tokens) -> tuple[int, bool]:
        """(place of the line's group, whether the groups changed)."""
        place, template = self.match(tokens)
        changed = place == self.used or template != self.tokens[place]
        if changed:
            self.put(place, template)
        return place, changed


def bucketed(lines: DataFrame) -> DataFrame:
    """lines (service, tokens) with n_tokens, k1, k2: the routing keys of the first two tokens."""
    key = lambda i: F.when(F.size("tokens") > i, route_key(F.get("tokens", F.lit(i))))
    return lines.withColumns({"n_tokens": F.size("tokens"), "k1": key(0), "k2": key(1)})


def children(keys: DataFrame, node: list[str], key: str, most: int) -> DataFrame:
    """node, key of the first ``most`` keys of each node by arrival; keys: node, key, seq. Hot nodes are salted.

    Of known keys, which arrive together, the wildcard comes last: in a full node it stands for the keys that had no place.
    """
    once = keys.where(F.col(key).isNotNull()).groupBy(*node, key).agg(F.min("seq").alias("seq"))
    for part in ([*node, F.pmod(F.xxhash64(key), F.lit(32))], node):
        once = once.withColumn("_r", F.row_number().over(Window.partitionBy(*part).orderBy("seq", F.col(key) == WILDCARD, key))).where(F.col("_r") <= most)
    return once.select(*node, key, F.lit(True).alias("_in"))


def crowded(x: DataFrame, most: int) -> bool:
    """Whether any node has more keys than it may take; else every line's own keys are its leaf's."""
    ones = x.groupBy("service", "n_tokens").agg(F.count_distinct("k1").alias("n")).agg(F.max("n"))
    twos = x.groupBy("service", "n_tokens", "k1").agg(F.count_distinct("k2").alias("n")).agg(F.max("n"))
    return max(r[0] or 0 for r in ones.union(twos).collect()) > most


def leaves(lines: DataFrame, known: DataFrame | None = None, most: int = CHILDREN) -> DataFrame:
    """lines (seq, service, tokens) with n_tokens and b1, b2, the keys by which the line reaches its leaf."""
    x = bucketed(lines)
    if known is None and not crowded(x, most):
        return x.withColumnsRenamed({"k1": "b1", "k2": "b2"})
    first = x.groupBy("service", "n_tokens", "k1").agg(F.min("seq").alias("seq"))
    if known is not None:
        first = first.unionByName(known.select("service", "n_tokens", F.col("b1").alias("k1"), F.lit(-1).cast("long").alias("seq")))
    one = children(first, ["service", "n_tokens"], "k1", most)
    x = x.join(one, ["service", "n_tokens", "k1"], "left").withColumn("b1", F.when(F.col("_in"), F.col("k1")).when(F.col("k1").isNotNull(), F.lit(WILDCARD))).drop("_in")
    second = x.groupBy("service", "n_tokens", "b1", "k2").agg(F.min("seq").alias("seq"))
    if known is not None:
        second = second.unionByName(known.select("service", "n_tokens", "b1", F.col("b2").alias("k2"), F.lit(-1).cast("long").alias("seq")))
    two = children(second, ["service", "n_tokens", "b1"], "k2", most)
    x = x.join(two, ["service", "n_tokens", "b1", "k2"], "left").withColumn("b2", F.when(F.col("_in"), F.col("k2")).when(F.col("k2").isNotNull(), F.lit(WILDCARD)))
    return x.drop("_in", "k1", "k2")


_ROWS = "_leaf string, _slice long, place int, tokens array<string>, seq long, kind string"
_NAMES = ["_leaf", "_slice", "place", "tokens", "seq", "kind"]


def _started(tokens, old: pd.DataFrame, threshold: float) -> Groups:
    """The groups that are known before a run."""
    groups = Groups(len(tokens), threshold)
    for place, t in enumerate(old.sort_values("place")["tokens"]):
        groups.put(place, list(t))
    return groups


def mined(fed: DataFrame, old: DataFrame, threshold: float, keep: str) -> DataFrame:
    """Each (_leaf, _slice) of fed (_leaf, _slice, tokens, seq) in one run, after the leaf's known groups.

    keep 'rows': kind ``row`` with each row's place, and ``group`` with the final templates; 'changes': kind ``change``,
    the rows that changed a group, with the template that they left.
    """

    def run(key: tuple, new: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
        new = new.sort_values("seq", kind="stable")
        groups = _started((new if len(new) else old)["tokens"].iloc[0], old, threshold)
        out = []
        for tokens, seq in zip(new["tokens"], new["seq"]):
            place, changed = groups.feed(tokens)
            if keep == "rows":
                out.append((place, tokens, seq, "row"))
            elif changed:
                out.append((place, groups.tokens[place], seq, "change"))
        if keep == "rows":
            out += [(i, t, None, "group") for i, t in enumerate(groups.tokens)]
        x = pd.DataFrame(out, columns=["place", "tokens", "seq", "kind"])
        return x.assign(_leaf=key[0], _slice=key[1], seq=x["seq"].astype("Int64"))[_NAMES]

    new = fed.select("_leaf", "_slice", "tokens", "seq")
    return new.groupBy("_leaf", "_slice").cogroup(old.select("_leaf", "_slice", "place", "tokens").groupBy("_leaf", "_slice")).applyInPandas(run, _ROWS)


def replayed(fed: DataFrame, history: DataFrame, old: DataFrame, threshold: float) -> DataFrame:
    """Rows of fed held against the history (place, tokens, seq; of the same _slice) as of their arrival.

    kind ``row``: the row's place; ``guess``: a row that isn't in the history and changes the groups. Guesses of a slice go
    on in groups of their own, so that of rows like each other only the first is one; the others are ``open``.
    """

    def run(key: tuple, new: pd.DataFrame, both: pd.DataFrame) -> pd.DataFrame:
        known = both["seq"].isna()
        if not len(new):
            return pd.DataFrame({c: [] for c in _NAMES})
        groups, own = _started(new["tokens"].iloc[0], both[known], threshold), None
        events = both[~known].sort_values("seq")
        new, times = new.sort_values("seq", kind="stable"), events["seq"].tolist()
        places, templates, at, out = events["place"].tolist(), events["tokens"].tolist(), 0, []
        for tokens, seq in zip(new["tokens"], new["seq"]):
            while at < len(times) and times[at] < seq:
                groups.put(int(places[at]), list(templates[at]))
                at += 1
            if at < len(times) and times[at] == seq:
                out.append((int(places[at]), tokens, seq, "row"))
                continue
            place, template = groups.match(tokens)
            if place < groups.used and template == groups.tokens[place]:
                out.append((place, tokens, seq, "row"))
            else:
                own = own or Groups(len(tokens), threshold)
                out.append((-1, tokens, seq, "guess" if own.feed(tokens)[1] else "open"))
        x = pd.DataFrame(out, columns=["place", "tokens", "seq", "kind"])
        return x.assign(_leaf=key[0], _slice=key[1])[_NAMES]

    before = old.select("_leaf", "_slice", "place", "tokens", F.lit(None).cast("long").alias("seq")).unionByName(history.select("_leaf", "_slice", "place", "tokens", "seq"))
    new = fed.select("_leaf", "_slice", "tokens", "seq")
    return new.groupBy("_leaf", "_slice").cogroup(before.groupBy("_leaf", "_slice")).applyInPandas(run, _ROWS)


def in_parts(fed: DataFrame, old: DataFrame, threshold: float, slices: int) -> DataFrame:
    """As ``mined`` with rows, over leaves of several slices, none of which is taken by one task whole. Read once."""
    at = lambda x: x.select("_leaf", "_slice").distinct()
    of_leaf = lambda x, to: x.drop("_slice").join(to, "_leaf")
    one = lambda x: x.withColumn("_slice", F.lit(0).cast("long"))
    all_slices = cut(at(fed))
    guesses, n = cut(mined(fed, of_leaf(old, all_slices), threshold, "changes")).select("_leaf", "_slice", "seq"), slices
    rows = fed.select("_leaf", "tokens", "seq")
    while n > 1:  # tokens of guesses are the rows' own
        n = -(-n // FAN)
        merged = rows.join(guesses, ["_leaf", "seq"]).withColumn("_slice", F.col("_slice") % n)
        history = cut(mined(merged, of_leaf(old, cut(at(merged))), threshold, "changes"))
        guesses = history.select("_leaf", "_slice", "seq")
    while True:
        found = cut(replayed(fed, of_leaf(history, all_slices), of_leaf(old, all_slices), threshold))
        more = found.where("kind = 'guess'").select("_leaf", "seq")
        if not more.limit(1).count():
            break
        guesses = history.select("_leaf", "seq").union(more)
        history = cut(mined(one(rows.join(guesses, ["_leaf", "seq"])), one(old), threshold, "changes"))
    last = history.groupBy("_leaf", "place").agg(F.max_by("tokens", "seq").alias("tokens"))
    kept = old.select("_leaf", "place", "tokens").join(last.select("_leaf", "place"), ["_leaf", "place"], "left_anti")
    groups = kept.unionByName(last).select("_leaf", F.lit(0).cast("long").alias("_slice"), "place", "tokens", F.lit(None).cast("long").alias("seq"), F.lit("group").alias("kind"))
    return found.unionByName(groups)


def _leaf() -> Column:
    """The leaf as text; a line of one token has no second key."""
    return F.to_json(F.struct(*LEAF), {"ignoreNullFields": "false"}).alias("_leaf")


def resolved(lines: DataFrame, exact: bool = False, threshold: float = THRESHOLD, most: int = CHILDREN, known: Known = None, rows_a_slice: int = SLICE) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(_leaf, tokens, seq, template of each row that was fed; _leaf, place, tokens of all groups; known)."""
    fed = lines.select("service", "tokens", "seq")
    fed = cut(fed if exact else fed.groupBy("service", "tokens").agg(F.min("seq").alias("seq")))  # read several times
    known = cut(known(fed)) if callable(known) else known
    fed = leaves(fed, known, most).select("tokens", "seq", _leaf())
    old = (fed.sparkSession.createDataFrame([], KNOWN) if known is None else known).select(_leaf(), F.lit(0).cast("long").alias("_slice"), "place", "tokens")
    sizes = fed.groupBy("_leaf").agg(F.count(F.lit(1)).alias("n"))
    if (sizes.agg(F.max("n")).first()[0] or 0) <= rows_a_slice:
        found = cut(mined(fed.withColumn("_slice", F.lit(0).cast("long")), old, threshold, "rows"))
    else:
        large = cut(sizes.where(F.col("n") > rows_a_slice).select("_leaf", F.ceil(F.col("n") / rows_a_slice).alias("_slices")))
        slices = large.agg(F.max("_slices")).first()[0]
        dealt = cut(fed.join(large, "_leaf", "left").withColumn("_slice", F.coalesce(F.pmod(F.xxhash64("seq"), F.col("_slices")), F.lit(0))))
        few, many = dealt.where("_slices is null"), dealt.where("_slices is not null")
        hot = old.join(large, "_leaf", "left_semi")
        found = cut(mined(few, old.join(large, "_leaf", "left_anti"), threshold, "rows").unionByName(in_parts(many, hot, threshold, slices)))
    groups = found.where("kind = 'group'").select("_leaf", "place", "tokens")
    templates = groups.select("_leaf", "place", F.array_join("tokens", " ").alias("template"))
    rows = found.where("kind = 'row'").join(_few(templates), ["_leaf", "place"]).select("_leaf", "tokens", "seq", "template")
    return rows, groups, known


def _few(df: DataFrame) -> DataFrame:
    """df for a join: broadcast if its counted rows are few."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def grown(lines: DataFrame, known: Known = None, exact: bool = False, threshold: float = THRESHOLD, most: int = CHILDREN, rows_a_slice: int = SLICE) -> tuple[DataFrame, DataFrame]:
    """(lines with template and template_id; KNOWN after them): the groups of a stream's batches go on in the next one."""
    return kept(lines, known, exact, threshold, most, rows_a_slice)[:2]


def kept(lines: DataFrame, known: Known = None, exact: bool = False, threshold: float = THRESHOLD, most: int = CHILDREN, rows_a_slice: int = SLICE) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """``grown``, and the known groups as they were, which a function may choose by the rows that are fed."""
    rows, groups, known = resolved(lines, exact, threshold, most, known, rows_a_slice)
    if exact:
        joined = lines.join(rows.select("seq", "template"), "seq")
    else:
        # by a hash that is exploded: Catalyst follows a join's key down to the scan, through every column it is made of, and
        # expands it on the way (for runtime filters), which takes forever behind the scrub; it doesn't look behind an explode
        key = lambda service: F.explode(F.array(F.sha1(F.concat(F.coalesce(service, F.lit("")), F.lit("\0"), F.array_join("tokens", "\0")))))
        few = _few(rows.select(key(F.get_json_object("_leaf", "$.service")).alias("_key"), "template"))
        joined = lines.withColumn("_key", key(F.col("service"))).join(few, "_key").drop("_key")
    of = F.from_json("_leaf", "service string, n_tokens int, b1 string, b2 string")
    return joined.withColumn("template_id", template_hash(F.col("service"), F.col("template"))), groups.select(of.alias("l"), "place", "tokens").select("l.*", "place", "tokens"), known


def mine(lines: DataFrame, exact: bool = False, threshold: float = THRESHOLD, most: int = CHILDREN, known: Known = None, rows_a_slice: int = SLICE) -> DataFrame:
    """lines (seq, service, tokens, ...) with template (the final one of the line's group) and template_id."""
    return grown(lines, known, exact, threshold, most, rows_a_slice)[0]
