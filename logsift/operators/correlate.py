"""L3: incidents from routed clusters, their origins, linked changes, hypotheses and timeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import best_option, iso, word_tokens
from .graph import components, cut
from .judge import change_related, event_type, hypothesis_supported, milestone, same_issue
from .route import SURFACED

MAX_GAP_S, MAX_PAIRS, SAME_ISSUE = 600, 2000, 0.6
LOOKBACK_S, CHANGE_RELATED, TOP_K = 3600, 0.5, 3


def surfaced(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("decision").isin(*SURFACED))


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def adjacency(topology: DataFrame) -> DataFrame:
    """sa, sb of the edges (src, dst), in both directions."""
    return topology.select(F.col("src").alias("sa"), F.col("dst").alias("sb")).union(topology.select("dst", "src")).distinct()


def candidate_pairs(found: DataFrame, topology: DataFrame | None = None, max_gap_s: int = MAX_GAP_S, limit: int | None = MAX_PAIRS) -> DataFrame:
    """a_*, b_*, gap_s: clusters first seen within the gap, on one or adjacent services; the top ``limit`` by priority.

    A range join by buckets of the gap's width, and by service: a meets its own bucket and the next, on its own service
    and each adjacent one. Only ids, times and priorities are joined; texts and traces come to the pairs that are left. a
    is the earlier one; of equal times the one of the higher priority, then of the smaller id. Without a topology every
    service is adjacent to every other. limit: None keeps all pairs.
    """
    cols = ["template_id", "service", "template", "first_seen", "priority", "trace_ids"]
    x = found.where(F.col("first_seen").isNotNull())
    width = max_gap_s * 1_000_000
    thin = x.select("template_id", "service", "priority", micros(F.col("first_seen")).alias("_us"))
    bucket = F.floor(F.col("_us") / width)
    a = thin.select(F.col("template_id").alias("a_id"), F.col("service").alias("_to"), F.col("priority").alias("pa"), F.col("_us").alias("ua"), F.explode(F.array(bucket, bucket + 1)).alias("_b"))
    b = thin.select(F.col("template_id").alias("b_id"), F.col("service").alias("_on"), F.col("priority").alias("pb"), F.col("_us").alias("ub"), bucket.alias("_b"))
    if topology is None:
        pairs = a.join(b, "_b")
    else:
        edges = adjacency(topology)
        own = thin.select(F.col("service").alias("sa"), F.col("service").alias("sb")).distinct()
        near = edges.union(own).distinct().select(F.col("sa").alias("_to"), F.col("sb").alias("_on"))
        pairs = a.join(near, "_to").join(b, ["_b", "_on"])
    gap = F.col("ub") - F.col("ua")
    first = (gap > 0) | ((gap == 0) & ((F.col("pa") > F.col("pb")) | ((F.col("pa") == F.col("pb")) & (F.col("a_id") < F.col("b_id")))))
    pairs = pairs.where((F.col("a_id") != F.col("b_id")) & (gap <= width) & first)
    if limit is not None:
        pairs = pairs.orderBy(F.desc(F.col("pa") + F.col("pb")), "a_id", "b_id").limit(limit)
    pairs = pairs.select(F.col("a_id").alias("a_template_id"), F.col("b_id").alias("b_template_id"), F.round(gap / 1_000_000, 1).alias("gap_s"))
    for side in "ab":
        pairs = pairs.join(x.select(*[F.col(c).alias(f"{side}_{c}") for c in cols]), f"{side}_template_id")
    return pairs


def pair_state(pairs: DataFrame) -> DataFrame:
    """subject_id, state: what another judge is shown of each candidate pair, as JSON; subjects are ``a|b``."""
    side = lambda s: F.struct(F.col(f"{s}_service").alias("service"), F.col(f"{s}_template").alias("template"), iso(F.col(f"{s}_first_seen")).alias("first_seen"))
    shared = F.coalesce(F.arrays_overlap("a_trace_ids", "b_trace_ids"), F.lit(False))
    state = F.to_json(F.struct(side("a").alias("a"), side("b").alias("b"), "gap_s", shared.alias("shared_trace")))
    return pairs.select(F.concat_ws("|", "a_template_id", "b_template_id").alias("subject_id"), state.alias("state"))


def scored_pairs(pairs: DataFrame) -> DataFrame:
    """pairs with p_same."""
    shared = F.arrays_overlap("a_trace_ids", "b_trace_ids")
    p = same_issue(word_tokens(F.col("a_template")), word_tokens(F.col("b_template")), F.coalesce(shared, F.lit(False)), F.col("gap_s"), F.col("a_service") == F.col("b_service"))
    return pairs.withColumn("p_same", p)


def incident_members(found: DataFrame, pairs: DataFrame, threshold: float = SAME_ISSUE) -> DataFrame:
    """found with group_id (the smallest id of the group) and incident_id (from the sorted ids of all members)."""
    edges = pairs.where(F.col("p_same") >= threshold).select(F.col("a_template_id").alias("a"), F.col("b_template_id").alias("b"))
    comp = components(found.select(F.col("template_id").alias("node")), edges)
    ids = comp.groupBy("component").agg(F.concat(F.lit("inc-"), F.substring(F.sha1(F.array_join(F.array_sort(F.collect_list("node")), "")), 1, 10)).alias("incident_id"))
    named = comp.join(ids, "component").select(F.col("node").alias("template_id"), F.col("component").alias("group_id"), "incident_id")
    return found.join(named, "template_id")


def incidents(members: DataFrame) -> DataFrame:
    return members.groupBy("incident_id").agg(
        F.min("first_seen").alias("start"), F.max("last_seen").alias("end"), F.array_sort(F.collect_set("service")).alias("services"),
        F.array_sort(F.collect_list("template_id")).alias("template_ids"), F.sum("count").alias("lines"), F.round(F.sum("priority"), 4).alias("priority"),
        F.count_if(F.col("decision") == "escalate").alias("n_escalate"),
    )


def escalated(found: DataFrame) -> DataFrame:
    return found.where("n_escalate > 0")


def top_incidents(found: DataFrame, k: int = TOP_K) -> DataFrame:
    return found.orderBy(F.desc("priority"), "incident_id").limit(k)


def root_causes(members: DataFrame, bonus: float = 0.5) -> DataFrame:
    """members with rank (0 for the earliest of its incident) and score."""
    w = Window.partitionBy("incident_id").orderBy(F.asc_nulls_last("first_seen"), F.desc("priority"), "template_id")
    x = members.withColumn("rank", F.row_number().over(w) - 1)
    return x.withColumn("score", F.round(F.coalesce("p_root_cause", F.lit(0.5)) * (1 + bonus / (1 + F.col("rank"))), 4))


def least_shared(threshold: float) -> int | None:
    """How many words a change and a template on different services must share to reach the threshold within half an hour,
    where the score is highest; None if no number does, 0 if none need be shared. Later the score is 0.38 at most."""
    for n in range(4):
        if round(0.08 + 0.25 + min(0.2, 0.07 * n), 4) >= threshold:
            return n
    return None


def _by_words(m: DataFrame, c: DataFrame, least: int, lookback_us: int) -> DataFrame:
    """Pairs (_m, _c) of members and changes within the lookback that share ``least`` words or more, each once.

    A pair that shares so many has one of them among all but the ``least`` - 1 commonest words of either side, so only
    these meet, by word and time bucket; the pairs that met are then held against all their words.
    """
    words = lambda x, id_, us: x.select(id_, us, "_words", F.explode("_words").alias("w"))
    a, b = words(m, "_m", "_um"), words(c, "_c", "_uc")
    often = a.select("w").unionByName(b.select("w")).groupBy("w").agg(F.count(F.lit(1)).alias("_n"))

    def rare(x: DataFrame, id_: str, us: str) -> DataFrame:
        ranked = x.join(often, "w").groupBy(id_, us).agg(F.array_sort(F.collect_list(F.struct("_n", "w"))).alias("r"))
        return ranked.select(id_, us, F.explode(F.slice("r", 1, F.greatest(F.size("r") - (least - 1), F.lit(0)))).alias("e")).select(id_, us, F.col("e.w").alias("w"))

    left = rare(a, "_m", "_um").withColumn("_b", F.floor(F.col("_um") / lookback_us))
    right = rare(b, "_c", "_uc").withColumn("_k", F.floor(F.col("_uc") / lookback_us)).select("_c", "_uc", "w", F.explode(F.array("_k", F.col("_k") + 1)).alias("_b"))
    delta = F.col("_um") - F.col("_uc")
    return left.join(right, ["w", "_b"]).where((delta >= 0) & (delta <= lookback_us)).select("_m", "_c").distinct()


def change_links(members: DataFrame, changes: DataFrame, lookback_s: int = LOOKBACK_S, threshold: float = CHANGE_RELATED) -> DataFrame:
    """incident_id, change_key, change columns, template_id, p_related: for each incident and change the likeliest member.

    The score bounds the join. On the change's own service all members within the lookback may reach the threshold; they
    meet by service and time bucket. On other services the score needs shared words at all usual thresholds
    (``least_shared``), and then members and changes meet by their rarer words. Only where nothing need be shared do they
    meet by time bucket alone. The best member is taken by partial aggregates, so a crowded hour is never sorted.
    """
    width = lookback_s * 1_000_000
    m = members.where(F.col("first_seen").isNotNull()).withColumn("_um", micros(F.col("first_seen")))
    m = m.select("incident_id", "template_id", "service", "template", "priority", "_um", F.xxhash64("incident_id", "template_id").alias("_m"), word_tokens(F.col("template")).alias("_words"))
    c = changes.withColumn("change_key", F.coalesce(F.nullif("change_id", F.lit("")), F.col("summary")))
    c = c.select("change_id", "change_key", F.col("ts").alias("change_ts"), F.col("service").alias("change_service"), "summary", micros(F.col("ts")).alias("_uc"), word_tokens(F.col("summary")).alias("_words"))
    c = c.withColumn("_c", F.xxhash64("change_id", "summary", "change_service", "_uc"))
    m, c = cut(m), cut(c)  # read by both joins
    delta = F.col("_um") - F.col("_uc")
    cm, cc = m.withColumn("_b", F.floor(F.col("_um") / width)).drop("_words"), c.withColumn("_k", F.floor(F.col("_uc") / width)).withColumn("_b", F.explode(F.array("_k", F.col("_k") + 1))).drop("_k", "_words")
    shared = F.size(F.array_intersect(word_tokens(F.col("summary")), word_tokens(F.col("template"))))
    least = least_shared(threshold)
    if least == 0:
        x = cm.join(cc, "_b").where((delta >= 0) & (delta <= width))
    else:
        x = cm.join(cc, (cm["_b"] == cc["_b"]) & (cm["service"] == cc["change_service"])).where((delta >= 0) & (delta <= width)).drop("_b")
        if least is not None:
            pairs = _by_words(m.select("_m", "_um", "_words"), c.select("_c", "_uc", "_words"), least, width if threshold <= 0.38 else min(width, 1_803_000_000))
            near = pairs.join(m.drop("_words"), "_m").join(c.drop("_words"), "_c").where(F.coalesce(F.col("service") != F.col("change_service"), F.lit(True)))
            x = x.unionByName(near.where((delta >= 0) & (delta <= width)).select(*x.columns))
    x = x.withColumn("p_related", change_related(F.coalesce(F.col("change_service") == F.col("service"), F.lit(False)), F.round(delta / 60_000_000, 1), shared)).where(F.col("p_related") >= threshold)
    order = F.struct((-F.col("p_related")).alias("p"), (-F.col("priority")).alias("q"), "template_id", "change_ts")
    best = x.groupBy("incident_id", "change_key").agg(F.min_by(F.struct("change_id", "change_ts", "change_service", "summary", "template_id", "p_related"), order).alias("r"))
    return best.select("incident_id", "change_key", "r.change_id", "r.change_ts", "r.change_service", "r.summary", "r.template_id", "r.p_related")


def evidence(members: DataFrame, found: DataFrame, links: DataFrame) -> DataFrame:
    """incident_id, evidence: the JSON that hypotheses are scored against; 8 members by priority, 5 changes."""
    w = Window.partitionBy("incident_id").orderBy(F.desc("priority"), "template_id")
    top = members.withColumn("_r", F.row_number().over(w)).where("_r <= 8")
    part = F.struct(F.col("_r"), F.col("service"), F.col("level"), F.col("template"), F.col("count").alias("occurrences"), iso(F.col("first_seen")).alias("first_seen"))
    patterns = top.groupBy("incident_id").agg(F.transform(F.array_sort(F.collect_list(part)), lambda s: s.dropFields("_r")).alias("patterns"))
    wc = Window.partitionBy("incident_id").orderBy(F.desc("p_related"), "change_key")
    few = links.withColumn("_r", F.row_number().over(wc)).where("_r <= 5").groupBy("incident_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", F.col("change_service").alias("service"), "summary"))), lambda s: s.dropFields("_r")).alias("changes"))
    x = found.join(patterns, "incident_id").join(few, "incident_id", "left")
    whole = F.struct("services", F.array(iso(F.col("start")), iso(F.col("end"))).alias("window"), "patterns", "changes")
    return x.select("incident_id", F.to_json(whole).alias("evidence"))


def hypotheses(ranked: DataFrame, links: DataFrame, most: int = 6) -> DataFrame:
    """incident_id, position, hypothesis: from up to 3 changes and 3 origins of each incident, and two general ones."""
    wc = Window.partitionBy("incident_id").orderBy(F.desc("p_related"), "change_key")
    wr = Window.partitionBy("incident_id").orderBy(F.desc("score"), "rank")
    a = links.withColumn("_p", F.row_number().over(wc)).where("_p <= 3").select("incident_id", "_p", F.concat(F.lit("The change to "), "change_service", F.lit(" ("), "summary", F.lit(") introduced the failure.")).alias("h"))
    category = F.replace(F.coalesce("category", F.lit("unknown")), F.lit("_"), F.lit(" "))
    b = ranked.withColumn("_p", F.row_number().over(wr)).where("_p <= 3").select("incident_id", (F.col("_p") + 3).alias("_p"), F.concat(F.lit("A "), category, F.lit(" problem in "), "service", F.lit(" is the origin: "), "template").alias("h"))
    # The two general hypotheses.
    general = F.explode(F.array(
        F.struct(F.lit(7).alias("_p"), F.lit("A shared downstream dependency degraded and the errors are symptoms of it.").alias("h")),
        F.struct(F.lit(8).alias("_p"), F.lit("A traffic spike exhausted capacity across the affected services.").alias("h")),
    ))
    c = ranked.select("incident_id").distinct().select("incident_id", general.alias("g")).select("incident_id", "g._p", "g.h")
    every = a.unionByName(b).unionByName(c).groupBy("incident_id", "h").agg(F.min("_p").alias("_p"))
    w = Window.partitionBy("incident_id").orderBy("_p")
    return every.withColumn("position", F.row_number().over(w)).where(F.col("position") <= most).select("incident_id", "position", F.col("h").alias("hypothesis"))


def hypothesis_scores(proposed: DataFrame, bundle: DataFrame) -> DataFrame:
    return proposed.join(bundle, "incident_id").select("incident_id", "position", "hypothesis", hypothesis_supported(F.col("hypothesis"), F.col("evidence")).alias("p_supported"))


def timeline(members: DataFrame, links: DataFrame, least: float = 0.5) -> DataFrame:
    """incident_id, ts, label, event_type, p_milestone: changes and first sightings that are milestones."""
    a = links.select("incident_id", F.col("change_ts").alias("ts"), F.concat(F.lit("["), "change_service", F.lit("] change: "), "summary").alias("label"), F.lit("change").alias("kind"))
    b = members.select("incident_id", F.col("first_seen").alias("ts"), F.concat(F.lit("["), "service", F.lit("] "), "level", F.lit(": "), "template").alias("label"), F.lit("log").alias("kind"))
    x = a.unionByName(b)
    text = F.to_json(F.struct("kind", iso(F.col("ts")).alias("at"), F.col("label").alias("event")))
    x = x.withColumn("_t", text)
    return x.select("incident_id", "ts", "label", "kind", best_option(event_type(F.col("_t"))).alias("event_type"), milestone(F.col("_t")).alias("p_milestone")).where(F.col("p_milestone") >= least)
