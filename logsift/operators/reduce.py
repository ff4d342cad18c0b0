"""L0: from log lines to clusters of one service and template."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.levels import level_name, level_rank, normalize_level
from ..functions.scrub import scrub
from ..functions.text import template_hash, tokens
from .graph import cut

EXAMPLES, TRACES = 3, 5
#: Clusters up to which each line is held against its cluster's bounds, which are broadcast.
BOUNDED = 200_000


def prepare(logs: DataFrame, redact_ips: bool = False, extra: dict[str, str] | None = None) -> DataFrame:
    """logs (seq, ts, service, level, body, trace_id) with scrubbed, hits, rank and tokens."""
    x = scrub(logs, "body", redact_ips=redact_ips, extra=extra)
    return x.withColumns({"rank": level_rank(F.col("level")), "tokens": tokens(F.col("scrubbed"))})


def with_templates(lines: DataFrame) -> DataFrame:
    """lines with the masked tokens as template, and its template_id; without mining."""
    x = lines.withColumn("template", F.array_join("tokens", " "))
    return x.withColumn("template_id", template_hash(F.col("service"), F.col("template")))


def cluster_agg(lines: DataFrame, keys: tuple[str, ...] = ("template_id", "service", "template")) -> DataFrame:
    """One row a cluster: level (highest), count, first_seen, last_seen, first_seq. One shuffle, with partial sums."""
    agg = lines.groupBy(*keys).agg(F.max("rank").alias("_rank"), F.count(F.lit(1)).alias("count"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.min("seq").alias("first_seq"))
    return agg.withColumn("level", level_name(F.col("_rank"))).drop("_rank")


def level_counts(lines: DataFrame, keys: tuple[str, ...] = ("template_id",)) -> DataFrame:
    """keys, level, lines: long form."""
    return lines.groupBy(*keys, normalize_level(F.col("level")).alias("level")).agg(F.count(F.lit(1)).alias("lines"))


def first_distinct(lines: DataFrame, value: str, n: int, keys: tuple[str, ...] = ("template_id",)) -> DataFrame:
    """keys, position (from 1), value: the first n distinct values, neither null nor empty, in order of arrival.

    Values are aggregated before they are ranked, so a hot cluster ranks its distinct values only; of those each salt
    keeps n before they meet.
    """
    once = lines.where(F.col(value).isNotNull() & (F.col(value) != "")).groupBy(*keys, value).agg(F.min("seq").alias("_seq"))
    salted = Window.partitionBy(*keys, F.pmod(F.xxhash64(value), F.lit(32))).orderBy("_seq", value)
    few = once.withColumn("_r", F.row_number().over(salted)).where(F.col("_r") <= n)
    ranked = few.withColumn("position", F.row_number().over(Window.partitionBy(*keys).orderBy("_seq", value))).where(F.col("position") <= n)
    return ranked.select(*keys, "position", value)


def sensitive_hits(lines: DataFrame, keys: tuple[str, ...] = ("template_id",)) -> DataFrame:
    """keys, kind, hits: long form."""
    return lines.select(*keys, F.explode("hits").alias("kind", "n")).groupBy(*keys, "kind").agg(F.sum("n").alias("hits"))


def clusters(lines: DataFrame, keys: tuple[str, ...] = ("template_id", "service", "template")) -> DataFrame:
    """Clusters with examples, trace_ids, level_counts and sensitive_hits, which are bounded by EXAMPLES, TRACES and kinds.

    The lines are written down once and read three times: for the bounds of each cluster (``_bounds``), for sums by level,
    and for a row of each kind of hit, and of the text and the trace where they come within the bounds. Most lines have none
    of these, and only the others are exploded. Rows are summed by value before they are shuffled, and all columns of a
    cluster come from the sums. Distinct texts and traces are ranked by
    first arrival within a salt and then over the few that are left, so no task holds those of a hot cluster.
    """
    c, ids = F.col, [k for k in keys if k not in ("service", "template")]
    lines = every = cut(lines.select(*keys, "rank", "ts", "seq", "level", "scrubbed", "trace_id", "hits"))
    bounds = cut(_bounds(lines, ids))
    if bounds.limit(BOUNDED + 1).count() <= BOUNDED:
        lines = lines.join(F.broadcast(bounds), ids, "left")
    else:
        lines = lines.withColumns({"_text": F.lit(None).cast("long"), "_trace": F.lit(None).cast("long")})
    early = lambda bound: ~F.coalesce(c("seq") > c(bound), F.lit(False))
    fact = lambda kind, value, n: F.struct(F.lit(kind).alias("kind"), value.alias("value"), n.cast("long").alias("n"))
    full = lambda v, bound: v.isNotNull() & (v != "") & early(bound)
    text, trace, none = full(c("scrubbed"), "_text"), full(c("trace_id"), "_trace"), F.array().cast(_FACTS)
    hits = F.transform(F.map_entries("hits"), lambda e: fact("hit", e.key, e.value))
    facts = F.concat(F.when(text, F.array(fact("text", c("scrubbed"), F.lit(1)))).otherwise(none), F.when(trace, F.array(fact("trace", c("trace_id"), F.lit(1)))).otherwise(none), hits)
    sums = lambda rows, n: rows.agg(n.alias("n"), F.max("rank").alias("rank"), F.min("ts").alias("first"), F.max("ts").alias("last"), F.min("seq").alias("seq"))
    some = lines.where(text | trace | (F.size("hits") > 0)).select(*keys, "rank", "ts", "seq", F.explode(facts).alias("f"))
    x = sums(every.groupBy(*keys, F.lit("level").alias("kind"), normalize_level(c("level")).alias("value")), F.count(F.lit(1)))
    x = x.unionByName(sums(some.groupBy(*keys, "f.kind", "f.value"), F.sum("f.n")))
    most = F.when(c("kind") == "text", EXAMPLES).when(c("kind") == "trace", TRACES).otherwise(F.lit(1 << 30))
    for part in ([*ids, "kind", F.pmod(F.xxhash64("value"), F.lit(32))], [*ids, "kind"]):
        x = x.withColumn("at", F.row_number().over(Window.partitionBy(*part).orderBy("seq", "value"))).where(c("at") <= most)
    of = lambda kind, v: F.when(c("kind") == kind, v)
    listed = lambda kind: F.transform(F.array_sort(F.collect_list(of(kind, F.struct("at", "value")))), lambda s: s.value)
    mapped = lambda kind: F.map_from_entries(F.array_sort(F.collect_list(of(kind, F.struct("value", "n")))))
    out = x.groupBy(*keys).agg(
        F.sum(of("level", c("n"))).alias("count"), F.min("first").alias("first_seen"), F.max("last").alias("last_seen"), F.min("seq").alias("first_seq"), level_name(F.max("rank")).alias("level"),
        listed("text").alias("examples"), listed("trace").alias("trace_ids"), mapped("level").alias("level_counts"), mapped("hit").alias("sensitive_hits"),
    )
    return out.select(*keys, "count", "first_seen", "last_seen", "first_seq", "level", "examples", "trace_ids", "level_counts", "sensitive_hits")


def _bounds(lines: DataFrame, ids: list[str]) -> DataFrame:
    """ids, _text, _trace: a seq at which as many distinct texts (traces) have come as are kept, so none that comes first
    later is kept; null if that can't be told.

    Values are dealt to a few slots by hash; the first arrivals in different slots are those of different values.
    """
    slot = lambda kind, v: F.struct(F.lit(kind).alias("kind"), F.when(v.isNotNull() & (v != ""), F.pmod(F.xxhash64(v), F.lit(8))).alias("slot"))
    x = lines.select(*ids, "seq", F.explode(F.array(slot("_text", F.col("scrubbed")), slot("_trace", F.col("trace_id")))).alias("e")).select(*ids, "seq", "e.*")
    x = x.where("slot IS NOT NULL").groupBy(*ids, "kind", "slot").agg(F.min("seq").alias("seq"))
    nth = lambda kind, n: F.get(F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.col("seq")))), F.lit(n - 1)).alias(kind)
    return x.groupBy(*ids).agg(nth("_text", EXAMPLES), nth("_trace", TRACES))


_FACTS = "array<struct<kind:string,value:string,n:bigint>>"


def ordered(found: DataFrame) -> DataFrame:
    """Highest level first, then most lines, then first seen."""
    return found.orderBy(*cluster_order())


def cluster_order() -> list[Column]:
    return [F.desc(level_rank(F.col("level"))), F.desc("count"), F.col("first_seq").asc(), F.col("template_id").asc()]


def ranked(df: DataFrame, order: Callable[[], list[Column]]) -> DataFrame:
    """df in an order, with rank (from 1): sorted by ranges, ranked within each, and moved by the rows of those before."""
    x = cut(df.orderBy(*order()).withColumn("_p", F.spark_partition_id()))
    sizes = x.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.withColumn("_b", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")  # a row a range
    x = x.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy(*order()))).join(F.broadcast(before), "_p")
    return x.withColumn("rank", F.col("_r") + F.col("_b")).drop("_p", "_r", "_b").orderBy("rank")


def reduce_stats(lines: DataFrame, found: DataFrame) -> DataFrame:
    """One row: lines, clusters, scrubbed_lines, reduction_ratio (0 without clusters)."""
    a = lines.agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.size("hits") > 0).alias("scrubbed_lines"))
    b = found.agg(F.count(F.lit(1)).alias("clusters"))
    one = a.withColumn("_j", F.lit(1)).join(F.broadcast(b.withColumn("_j", F.lit(1))), "_j").drop("_j")  # a row each
    return one.select("lines", "clusters", "scrubbed_lines", F.coalesce(F.col("lines") / F.nullif("clusters", F.lit(0)), F.lit(0.0)).alias("reduction_ratio"))


def tumbling(lines: DataFrame, seconds: int, ts: str = "ts") -> DataFrame:
    """lines with window_start: the start of the tumbling event-time window, counted from the epoch."""
    start = F.window(F.col(ts).cast("timestamp"), f"{seconds} seconds").start
    return lines.withColumn("window_start", start)


