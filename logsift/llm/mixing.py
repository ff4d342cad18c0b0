"""Mixing sources to target weights: blocks of words, drawn shard by shard and found by permuted indexes. Columns only.

The words of a source, its documents in the order of a hash, are one sequence that is cut into blocks of ``LENGTH`` words;
the last block may be shorter. A source's target is its share by weight of all words, at most ``MOST`` times its own size,
what is above being shared again by weight. Its quota of slots is so many whole passes over its blocks as the target
holds, and the first blocks of one more pass; the last slot takes only the words that are still due, so a source gives its
target to the word, and no document is used more than ``MOST`` times.

The output is dealt in shards of ``SHARD`` slots. Each slot draws its source with the quotas as weights, so each shard's
counts are multinomial. A source's slots are numbered through all shards; those above its quota go to the sources that
were drawn too seldom, by a permutation of their numbers. Slot number j stands for pass j // blocks over the source, and
its place in the pass goes through a permutation of the source's full blocks, of its own for each pass; the short block
ends a pass. Permutations are swap-or-not networks, which hold for any number of blocks and need no table.

Running sums go by parts of bounded size and then over the parts, so a source of any size is spread over tasks. Draws meet
sources by cells of the quotas' range. All numbers come from hashes of the seed, so a run that is repeated, or a task that
is run again, gives the same mix. Tables of sources are broadcast up to ``BROADCAST_ROWS`` rows and shuffled beyond.

Defined results. Null and empty texts have size 0 and are in no block. A null source is a source of its own, the last one.
Rows that come again are documents of their own; null ids are ids. Empty table: no rows. Extra columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import once
from .common import WORD, cut

LENGTH, SHARD, MOST, ROUNDS, SEED = 256, 4096, 3, 16, 17
WEIGHTS = (1, 2, 3)
#: Shards, and documents of a source, whose sums one task adds up.
PART, DOCS = 65_536, 2_048
BROADCAST_ROWS = 50_000


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source, size (the number of words), and _h, a hash of id and text."""
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), F.regexp_count(t, F.lit(WORD)).cast("long").alias("size"), F.xxhash64(F.lit(SEED), key, t).alias("_h"))


def targets(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """sid, source, n_docs, source_size, weight, target: one row a source of docs (source, size).

    A source is at its limit if the words left by those that reach theirs sooner, shared by weight, would exceed it; so
    sources in the order of limit over weight decide one after another, in running sums over the table of sources.
    """
    x = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"))
    x = x.withColumn("sid", (F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1).cast("long"))
    x = x.withColumn("weight", F.get(F.array(*map(F.lit, weights)), F.pmod("sid", F.lit(len(weights))).cast("int")).cast("long"))
    limit, every = most * F.col("source_size"), Window.partitionBy(F.lit(0))
    before = Window.partitionBy(F.lit(0)).orderBy(limit / F.col("weight"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    x = x.withColumns({"_all": F.sum("source_size").over(every), "_taken": F.coalesce(F.sum(limit).over(before), F.lit(0)), "_w": F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))})
    exact = lambda c: c.cast("decimal(19,0)")
    x = x.withColumn("_full", exact(limit) * exact(F.col("_w")) <= exact(F.col("_all") - F.col("_taken")) * exact(F.col("weight")))
    rest = F.when(~F.col("_full"), F.struct(F.col("_taken").alias("t"), F.col("_w").alias("w")))
    x = x.withColumn("_r", F.min(rest).over(every))  # of the first that isn't full
    share = F.col("weight") * (F.col("_all") - F.col("_r.t")) / F.col("_r.w")
    return x.select("sid", "source", "n_docs", "source_size", "weight", F.when(F.col("_full"), limit.cast("double")).otherwise(share.cast("double")).alias("target"))


def quotas(found: DataFrame, length: int = LENGTH, most: int = MOST) -> DataFrame:
    """found (targets) with due (words to take), full (whole blocks), blocks, slots, and low: the slots of sources before."""
    x = found.withColumn("due", F.least(F.round("target").cast("long"), most * F.col("source_size")))
    x = x.withColumns({"full": F.expr(f"source_size div {length}"), "blocks": F.expr(f"(source_size + {length - 1}) div {length}"), "_p": F.coalesce(F.expr("due div nullif(source_size, 0)"), F.lit(0))})
    x = x.withColumn("slots", F.expr(f"_p * blocks + (due - _p * source_size + {length - 1}) div {length}")).drop("_p")
    before = Window.partitionBy(F.lit(0)).orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)
    return x.withColumn("low", F.coalesce(F.sum("slots").over(before), F.lit(0)))


def permuted(x: Column, n: Column, keys: list[Column], rounds: int = ROUNDS) -> Column:
    """x (0 to n - 1, long) sent through a permutation of that range, another one for other keys.

    A round pairs x with (k - x) mod n for the round's number k, and swaps the pair or not by a hash of its larger member.
    """
    n = F.greatest(n, F.lit(1)).cast("long")
    marks = F.transform(F.sequence(F.lit(1), F.lit(rounds)), lambda r: F.struct(r.alias("r"), F.pmod(F.xxhash64(F.lit(SEED), r, *keys), n).alias("k")))

    def swapped(at: Column, m: Column) -> Column:
        other = F.pmod(m["k"] - at, n)
        return F.when(F.pmod(F.xxhash64(F.lit(SEED), -m["r"], *keys, F.greatest(at, other)), F.lit(2)) == 1, other).otherwise(at)

    return F.aggregate(marks, x.cast("long"), swapped)


def running(df: DataFrame, keys: list[str], part: str, order: list, value: str, out: str) -> DataFrame:
    """df with ``out``, the sum of ``value`` over rows of the same keys that come before: in parts, which are in order."""
    inside = Window.partitionBy(*keys, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(*keys, part).agg(F.sum(value).alias("_s")).withColumn("_b", F.coalesce(F.sum("_s").over(before), F.lit(0))).drop("_s")
    x = df.withColumn("_i", F.coalesce(F.sum(value).over(inside), F.lit(0))).join(sums, [*keys, part])
    return x.withColumn(out, F.col("_i") + F.col("_b")).drop("_i", "_b")


def pieces(docs: DataFrame, length: int = LENGTH, part: int = DOCS) -> DataFrame:
    """docs (sid, n_docs, doc_id, size, _h) in a source's order, cut by blocks: sid, at, doc_id, size, block, off, start, n.

    at: words of the source before the document, which names it there; off: the piece's place in its block; start: in the
    document. The order is by part, hash, id and size; rows that agree in all of these are alike.
    """
    x = docs.where("size > 0").withColumn("_part", F.pmod("_h", F.expr(f"1 + n_docs div {part}")))
    x = running(x, ["sid"], "_part", ["_h", "doc_id", "size"], "size", "at")
    x = x.select("sid", "at", "doc_id", "size", F.explode(F.sequence(F.expr(f"at div {length}"), F.expr(f"(at + size - 1) div {length}"))).alias("block"))
    low = F.greatest(F.col("at"), F.col("block") * length)
    n = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * length) - low
    return x.select("sid", "at", "doc_id", "size", "block", (low - F.col("block") * length).alias("off"), (low - F.col("at")).alias("start"), n.alias("n"))


def drawn(sources: DataFrame, total: int, shard: int = SHARD) -> DataFrame:
    """sid, shard, n: multinomial counts of slots; sources: sid, low, slots, of ``total`` slots in all."""
    spark = sources.sparkSession
    cell = max(1, total // 4096)
    ranges = sources.where("slots > 0").select("sid", "low", "slots", F.explode(F.sequence(F.expr(f"low div {cell}"), F.expr(f"(low + slots - 1) div {cell}"))).alias("_cell"))
    u = spark.range(total).select(F.expr(f"id div {shard}").alias("shard"), once(F.pmod(F.xxhash64(F.lit(SEED), F.lit("draw"), "id"), F.lit(total))).alias("_u")).withColumn("_cell", F.expr(f"_u div {cell}"))
    x = u.join(small(ranges), "_cell").where("_u >= low and _u < low + slots")
    return x.groupBy("sid", "shard").agg(F.count(F.lit(1)).alias("n"))


def slots(sources: DataFrame, total: int, length: int = LENGTH, shard: int = SHARD, rounds: int = ROUNDS) -> DataFrame:
    """shard, sid, pass, block, words: every slot of the mix; words may be fewer than the block has."""
    named = small(sources.select("sid", "slots", "due", "full", "blocks", "source_size"))
    x = drawn(sources, total, shard).withColumn("_part", F.expr(f"shard div {PART}"))
    x = cut(running(x, ["sid"], "_part", ["shard"], "n", "first"))  # sums and slots both read it
    got = sources.select("sid", "slots").join(x.groupBy("sid").agg(F.sum("n").alias("got")), "sid", "left").withColumn("_d", F.coalesce("got", F.lit(0)) - F.col("slots"))
    before = Window.partitionBy(F.lit(0)).orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)
    over, under = F.greatest(F.col("_d"), F.lit(0)), F.greatest(-F.col("_d"), F.lit(0))
    got = cut(got.withColumns({"_over": F.coalesce(F.sum(over).over(before), F.lit(0)), "_under": F.coalesce(F.sum(under).over(before), F.lit(0))}))
    left_over = got.agg(F.sum(over)).first()[0] or 0
    each = x.select("sid", "shard", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("j")).join(small(got.select("sid", "slots", "_over")), "sid")
    kept = each.where("j < slots").select("shard", "sid", "j")
    if left_over:
        over_at = F.col("_over") + F.col("j") - F.col("slots")
        moved = each.where("j >= slots").select("shard", once(permuted(over_at, F.lit(left_over), [F.lit("left over")], rounds)).alias("x"))
        cell = max(1, left_over // 4096)
        want = got.where("_d < 0").select("sid", "got", "_under", "_d", F.explode(F.sequence(F.expr(f"_under div {cell}"), F.expr(f"(_under - _d - 1) div {cell}"))).alias("_cell"))
        moved = moved.withColumn("_cell", F.expr(f"x div {cell}")).join(small(want), "_cell").where("x >= _under and x < _under - _d")
        kept = kept.union(moved.select("shard", "sid", F.coalesce("got", F.lit(0)) + F.col("x") - F.col("_under")))
    x = kept.join(named, "sid").withColumns({"pass": F.expr("j div blocks"), "_at": F.expr("j % blocks")})
    x = x.withColumn("block", once(F.when(F.col("_at") < F.col("full"), permuted(F.col("_at"), F.col("full"), [F.col("sid"), F.col("pass")], rounds)).otherwise(F.col("full"))))
    due = F.col("due") - F.col("pass") * F.col("source_size") - F.col("_at") * length
    return x.select("shard", "sid", "pass", "block", F.least(due, F.lit(length)).alias("words"))


def small(df: DataFrame) -> DataFrame:
    """df for a join: broadcast if its counted rows are few."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


class Mix:
    """The steps of one mix: ``docs`` (sid, doc_id, size, ...), ``sources`` (``quotas``), ``pieces`` and ``slots``."""

    def __init__(self, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, key: str = "doc_id", text: str = "text", source: str = "source", length: int = LENGTH, shard: int = SHARD, rounds: int = ROUNDS):
        own = cut(sized(docs, key, text, source))
        self.sources = cut(quotas(targets(own, weights), length))
        of = self.sources.select("sid", "n_docs", F.col("source").alias("_s"))
        self.docs = own.join(small(of), F.col("source").eqNullSafe(F.col("_s"))).select("sid", "n_docs", "doc_id", "size", "_h")
        self.pieces = pieces(self.docs, length)
        total = self.sources.agg(F.sum("slots")).first()[0] or 0
        self.slots = slots(self.sources, total, length, shard, rounds)


def mixture(docs: DataFrame, **settings) -> DataFrame:
    """shard, source, pass, block, off, doc_id, start, n: n words of a document from ``start``, for place ``off`` of the
    slot that holds this block. settings: as of ``Mix``."""
    m = Mix(docs, **settings)
    x = m.slots.join(m.pieces, ["sid", "block"]).where("off < words").join(small(m.sources.select("sid", "source")), "sid")
    return x.select("shard", "source", "pass", "block", "off", "doc_id", "start", F.least(F.col("n"), F.col("words") - F.col("off")).alias("n"))


def taken(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document: the words that the mix takes, repeats counted."""
    m = Mix(docs, **settings)
    n = F.when(F.col("off") < F.col("words"), F.least(F.col("n"), F.col("words") - F.col("off")))  # null where no slot has the block
    x = m.pieces.join(m.slots.select("sid", "block", "words"), ["sid", "block"], "left").groupBy("sid", "at", "doc_id", "size").agg(F.coalesce(F.sum(n), F.lit(0)).alias("taken"))
    x = x.select("sid", "doc_id", "size", "taken").union(m.docs.where("size = 0").select("sid", "doc_id", "size", F.lit(0).cast("long")))
    return x.join(small(m.sources.select("sid", "source_size", "target")), "sid").select("doc_id", "size", "source_size", "target", "taken")
