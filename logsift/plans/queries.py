"""Every operator as a query over the driver's tables.

Log records are derived from ``events``: services, levels and messages by rule (see ``LOGS``), so that DuckDB can build
the same ones. Clusters of L1 to L3 are those of a service, template and hour, which gives many that are near in time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import levels, scrub, text
from ..operators import cache, correlate, estimate, evaluate, judge, miner, narrate, reduce, remote, route
from ..operators.graph import cut, shared_folder
from ..sources import logs as src
from ..sources.questions import BUILT_IN, checked
from ..streaming import worker
from . import sinks, triage, views

LOGS = """SELECT event_id AS seq, ts,
  CASE user_id % 5 WHEN 0 THEN 'edge' WHEN 1 THEN 'cart' WHEN 2 THEN 'billing' WHEN 3 THEN 'login' ELSE 'stock' END AS service,
  CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'WARN' WHEN 'view' THEN 'DEBUG' ELSE 'INFO' END AS level,
  CASE event_type
    WHEN 'error' THEN concat('upstream call failed after ', CAST(floor(value) AS BIGINT), ' ms for user ', user_id)
    WHEN 'purchase' THEN concat('retry of order ', event_id, ' succeeded amount ', CAST(floor(value) AS BIGINT))
    WHEN 'view' THEN concat('cache hit for item ', user_id)
    WHEN 'signup' THEN concat('mail sent to u', user_id, '@example.com')
    ELSE concat('request completed in ', CAST(floor(value) AS BIGINT), ' ms') END AS body,
  substr(sha1(CAST(user_id AS {text})), 1, 32) AS trace_id
FROM {events}"""
TOPOLOGY = [("edge", "cart"), ("edge", "login"), ("edge", "stock"), ("cart", "billing"), ("cart", "stock"), ("billing", "ledger")]
RUNBOOKS = {"rb_upstream": "upstream call failed for a user", "rb_orders": "retry of an order amount", "rb_mail": "mail sent to a user"}
IDS = ("template_id", "service", "template")


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def logs(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(LOGS.replace("{text}", "STRING"), events=table(spark, d, "events"))


def lines(spark: SparkSession, d: str) -> DataFrame:
    return reduce.with_templates(reduce.prepare(logs(spark, d)))


def hourly(spark: SparkSession, d: str) -> DataFrame:
    """lines whose template_id also names the hour."""
    hour = F.date_format(F.col("ts").cast("timestamp"), "yyyyMMddHH")
    return lines(spark, d).withColumn("template_id", F.concat("template_id", F.lit("-"), hour))


def clusters_h(spark: SparkSession, d: str) -> DataFrame:
    return reduce.clusters(hourly(spark, d), IDS)


def judged(spark: SparkSession, d: str) -> DataFrame:
    return judge.answers(judge.judge(clusters_h(spark, d)))


def routed(spark: SparkSession, d: str) -> DataFrame:
    return route.route(judged(spark, d))


def changes(spark: SparkSession, d: str) -> DataFrame:
    return changes_of(table(spark, d, "events"))


def changes_of(events: DataFrame) -> DataFrame:
    return events.sparkSession.sql(
        """SELECT CAST(event_id AS STRING) AS change_id, ts, CASE user_id % 5 WHEN 0 THEN 'edge' WHEN 1 THEN 'cart' WHEN 2 THEN 'billing' WHEN 3 THEN 'login' ELSE 'stock' END AS service,
        concat('deploy of release ', event_id, ' for upstream call') AS summary FROM {events} WHERE event_type = 'signup' AND event_id % 50 = 0""",
        events=events,
    )


def topology(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TOPOLOGY, "src string, dst string")


def pairs(spark: SparkSession, d: str) -> DataFrame:
    found = cut(correlate.surfaced(routed(spark, d)))
    return correlate.scored_pairs(correlate.candidate_pairs(found, topology(spark)))


def members(spark: SparkSession, d: str, limit: int | None = None) -> DataFrame:
    """Members of incidents, from all candidate pairs; limit: from the top ones only, where a query's SQL states that."""
    found = cut(correlate.surfaced(routed(spark, d)))
    return correlate.incident_members(found, correlate.scored_pairs(correlate.candidate_pairs(found, topology(spark), limit=limit)))


def _golden(spark: SparkSession, d: str) -> DataFrame:
    """Labelled rows with a probability by rule: y (quality), p, and what choice and score metrics need."""
    x = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")
    p = (F.col("n_chars") % 997) / 996.0
    return x.select("doc_id", (F.col("quality") == 1).alias("y"), p.alias("p"), "n_chars", "quality", "toxic")


def _choices(spark: SparkSession, d: str) -> DataFrame:
    name = lambda c: F.element_at(F.array(*map(F.lit, ("timeout", "auth", "config"))), (c % 3 + 1).cast("int"))
    return _golden(spark, d).select(F.col("doc_id").alias("seq"), name(F.col("n_chars")).alias("label"), name(F.col("n_chars") + F.col("quality") * (F.col("n_chars") % 2)).alias("pred"), "p")


def _decided(spark: SparkSession, d: str) -> DataFrame:
    x = _golden(spark, d)
    decision = F.element_at(F.array(*map(F.lit, ("suppress", "escalate", "triage", "monitor", "review"))), (F.col("n_chars") % 5 + 1).cast("int"))
    return x.select(F.col("doc_id").alias("id"), decision.alias("decision"), F.when(F.col("n_chars") % 7 != 0, F.col("quality") == 1).alias("actionable"))


# sources -------------------------------------------------------------------------------------------------------------


def scan_jsonl(spark, d):
    x = logs(spark, d)
    ts = text.iso(F.col("ts"))
    a = F.to_json(F.struct(ts.alias("ts"), "service", "level", "body", "trace_id"))
    b = F.to_json(F.struct(ts.alias("@timestamp"), F.col("service").alias("service.name"), F.lower("level").alias("severity"), F.col("body").alias("message"), F.col("trace_id").alias("traceId")))
    c = F.to_json(F.struct(ts.alias("Timestamp"), F.col("service").alias("ServiceName"), F.col("level").alias("SeverityText"), F.col("body").alias("Body"), F.col("trace_id").alias("TraceId")))
    raw = x.select("seq", F.when(F.col("seq") % 3 == 0, a).when(F.col("seq") % 3 == 1, b).otherwise(c).alias("value"))
    return src.parse_lines(raw).select("seq", F.col("ts").cast("timestamp_ntz").alias("ts"), "service", "level", "body", "trace_id")


def scan_plaintext(spark, d):
    raw = logs(spark, d).select("seq", F.concat(F.when(F.col("seq") % 2 == 0, F.concat("level", F.lit(" "))).otherwise(""), "body").alias("value"))
    return src.parse_lines(raw).select("seq", "service", "level", "body", "trace_id")


def key_synonyms(spark, d):
    x = logs(spark, d)
    line = F.when(F.col("seq") % 2 == 0, F.to_json(F.struct(F.lit("").alias("service"), F.col("service").alias("app"), F.col("level").alias("lvl")))).otherwise(F.to_json(F.struct(F.lit("n").alias("ServiceName"), F.col("service").alias("app"))))
    x = x.select("seq", line.alias("v"))
    return x.select("seq", src.field(F.col("v"), "service").alias("service"), levels.normalize_level(src.field(F.col("v"), "level")).alias("level"))


def guess_level(spark, d):
    x = logs(spark, d).select("seq", F.concat_ws(" ", F.when(F.col("seq") % 3 == 0, F.lower("level")), "body").alias("line"))
    return x.select(levels.guess_level(F.col("line")).alias("guessed")).groupBy("guessed").agg(F.count(F.lit(1)).alias("n"))


def normalize_level(spark, d):
    name = F.element_at(F.array(*map(F.lit, ("warning", "Critical", "err", "", "fatal", "NOTICE", " error", "debug"))), (F.col("seq") % 8 + 1).cast("int"))
    x = logs(spark, d).select(name.alias("raw"))
    return x.groupBy("raw", levels.normalize_level(F.col("raw")).alias("level"), levels.level_rank(F.col("raw")).alias("rank")).agg(F.count(F.lit(1)).alias("n"))


def parse_ts(spark, d):
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    seconds = F.floor(us / 1_000_000)
    form = F.col("seq") % 5
    value = F.when(form == 0, seconds.cast("string")).when(form == 1, (seconds * 1000).cast("string")).when(form == 2, (seconds * 1_000_000).cast("string")).when(form == 3, text.iso(F.timestamp_seconds(seconds)))
    value = value.otherwise(F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd HH:mm:ss"))
    return logs(spark, d).select("seq", value.alias("v")).select("seq", src.parse_ts(F.col("v")).cast("timestamp_ntz").alias("ts"))


# scrub and mask ------------------------------------------------------------------------------------------------------


def _doc_hits(spark, d, redact_ips=False):
    return scrub.scrub(table(spark, d, "documents").select("doc_id", "text"), "text", redact_ips=redact_ips)


def scrub_email(spark, d):
    return _doc_hits(spark, d).select("doc_id", F.coalesce(F.element_at("hits", F.lit("EMAIL")), F.lit(0)).alias("n_email")).where("n_email > 0")


def scrub_card(spark, d):
    return _doc_hits(spark, d).select("doc_id", F.coalesce(F.element_at("hits", F.lit("CARD")), F.lit(0)).alias("n_card")).where("n_card > 0")


def scrub_ipv4(spark, d):
    return _doc_hits(spark, d, True).select("doc_id", F.coalesce(F.element_at("hits", F.lit("IPV4")), F.lit(0)).alias("n_ipv4")).where("n_ipv4 > 0")


def scrub_all(spark, d):
    return scrub.scrub(logs(spark, d).select("seq", "body")).select("seq", "scrubbed", F.coalesce(F.element_at("hits", F.lit("EMAIL")), F.lit(0)).alias("n_email"), F.size("hits").alias("kinds"))


def scrub_stats(spark, d):
    return scrub.scrub_stats(_doc_hits(spark, d))


def mask(spark, d):
    x = scrub.scrub(logs(spark, d).select("seq", "body"))
    return x.select("seq", text.mask(F.col("scrubbed")).alias("masked"))


def tokenize(spark, d):
    return lines(spark, d).select("seq", F.size("tokens").alias("n_tokens"), F.array_join("tokens", "|").alias("tokens"))


def template_hash(spark, d):
    return lines(spark, d).select("service", "template", "template_id").distinct()


def word_tokens(spark, d):
    return lines(spark, d).select("template").distinct().select("template", F.array_join(F.array_sort(text.word_tokens(F.col("template"))), " ").alias("words"))


# mining and reduction ------------------------------------------------------------------------------------------------


def drain_bucket(spark, d):
    return miner.bucketed(lines(spark, d)).groupBy("service", "n_tokens", "k1", "k2").agg(F.count(F.lit(1)).alias("lines"))


def token_similarity(spark, d):
    x = lines(spark, d).select("template", F.split("template", " ").alias("t")).distinct().withColumn("n", F.size("t"))
    a, b = x.select(F.col("template").alias("a"), F.col("t").alias("ta"), "n"), x.select(F.col("template").alias("b"), F.col("t").alias("tb"), "n")
    return a.join(b, "n").where("a <= b").select("a", "b", F.round(text.similarity(F.col("ta"), F.col("tb")), 6).alias("similarity"))


def drain_templates(spark, d):
    x = miner.mine(reduce.prepare(logs(spark, d)))
    return x.groupBy("service", "template_id", "template").agg(F.count(F.lit(1)).alias("lines"))


def cluster_agg(spark, d):
    return reduce.cluster_agg(lines(spark, d)).select("template_id", "service", "template", "level", "count", "first_seen", "last_seen", "first_seq")


def level_counts(spark, d):
    return reduce.level_counts(lines(spark, d))


def first_examples(spark, d):
    return reduce.first_distinct(lines(spark, d), "scrubbed", reduce.EXAMPLES)


def first_traces(spark, d):
    return reduce.first_distinct(lines(spark, d), "trace_id", reduce.TRACES)


def sensitive_hits(spark, d):
    return reduce.sensitive_hits(lines(spark, d))


def cluster_order(spark, d):
    return reduce.ranked(reduce.cluster_agg(lines(spark, d)), reduce.cluster_order).select("template_id", "level", "count", "first_seq", "rank")


def reduction_ratio(spark, d):
    x = lines(spark, d)
    return reduce.reduce_stats(x, reduce.cluster_agg(x))


def tumbling_window(spark, d):
    x = reduce.tumbling(logs(spark, d), 3600)
    return x.groupBy(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "service").agg(F.count(F.lit(1)).alias("lines"))


# judge ---------------------------------------------------------------------------------------------------------------


def keyword_features(spark, d):
    return judge.features(clusters_h(spark, d)).select("template_id", "rank", *[F.col(c).cast("int").alias(c) for c in ("noise", "err", "rc", "sym", "usr", "weird")])


def state_text(spark, d):
    return clusters_h(spark, d).select("template_id", judge.state_json().alias("state"))


def p_nouls(spark, d):
    return judged(spark, d).select("template_id", *[f"p_{k}" for k in judge.NOULS])


def category_choice(spark, d):
    return judged(spark, d).select("template_id", "category", "component", F.round(F.array_max(F.transform("d_category", lambda e: e.p)), 5).alias("p"))


def expected_severity(spark, d):
    return judged(spark, d).select("template_id", F.round("expected_severity", 4).alias("severity"), F.round("expected_user_impact", 4).alias("impact"))


def judgment_long(spark, d):
    return judge.judgments(judged(spark, d)).groupBy("question_key", "question_type", "source").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("p_yes"), 3).alias("mean_p"))


def runbook_choice(spark, d):
    x = lines(spark, d).select("template").distinct()
    return x.select("template", text.best_option(judge.runbook_choice(F.col("template"), RUNBOOKS)).alias("runbook"))


def _cached(spark, d):
    """Subjects with one answer each; those of even length were answered before."""
    x = lines(spark, d).select(F.col("template_id").alias("subject_id"), F.length("template").alias("len")).distinct()
    x = x.withColumns({"model_version": F.lit(judge.MODEL), "question_fp": F.lit("fp")})
    asked = x.select("subject_id", "model_version", "question_fp")
    return asked, x.where("len % 2 = 0").select(*cache.KEY, F.concat(F.lit("a"), F.col("len").cast("string")).alias("answer"), F.expr("TIMESTAMP'2024-01-01'").alias("created_at"), F.lit("heuristic").alias("source"))


def cache_hits(spark, d):
    asked, c = _cached(spark, d)
    return cache.hits(asked, c).select("subject_id", "answer", "source")


def cache_misses(spark, d):
    asked, c = _cached(spark, d)
    return cache.misses(asked, c).select("subject_id")


def cache_upsert(spark, d):
    asked, c = _cached(spark, d)
    new = asked.select(*cache.KEY, F.lit("new").alias("answer"), F.expr("TIMESTAMP'2024-02-01'").alias("created_at"), F.when(F.substring("subject_id", 1, 1) < "8", "heuristic").otherwise("fallback").alias("source"))
    return cache.upsert(c, new).select("subject_id", "answer", "source")


def cache_stats(spark, d):
    asked, c = _cached(spark, d)
    return cache.stats(asked, c)


def nearest_rank_percentile(spark, d):
    return evaluate.nearest_rank(table(spark, d, "events").select("value"), "value", [50, 95])


def _flaky():
    def ask(state: str):
        if int(state) % 7 == 0:
            raise remote.status_error(400, "bad")
        return [{"key": "benign", "type": "noul", "value": 0.5}], len(state)

    return ask


def _calls(spark, d):
    x = table(spark, d, "nation").select(F.col("n_name").alias("subject_id"), F.col("n_nationkey").cast("string").alias("state"))
    return remote.ask_all(x, _flaky, concurrency=4, rpm=1e9, retries=0)


def judge_stats(spark, d):
    return remote.call_stats(_calls(spark, d))


def dead_letters(spark, d):
    return remote.dead_letters(_calls(spark, d)).select("subject_id", "attempts")


# route ---------------------------------------------------------------------------------------------------------------


def answer_pivot(spark, d):
    x = judge.judgments(judged(spark, d)).where("question_type = 'noul'")
    return x.groupBy("template_id").pivot("question_key", judge.NOULS).agg(F.max("p_yes"))


def route_decision(spark, d):
    return routed(spark, d).select("template_id", "decision", F.array_join("reasons", "; ").alias("reasons"), F.array_join("flags", ",").alias("flags"))


def route_flags(spark, d):
    return routed(spark, d).groupBy(F.array_join("flags", ",").alias("flags")).agg(F.count(F.lit(1)).alias("n"))


def rules_check(spark, d):
    return clusters_h(spark, d).select("template_id", route.rules_check(route.RouterConfig()).alias("allowed"))


def priority(spark, d):
    return routed(spark, d).select("template_id", F.round("priority", 3).alias("priority"))


def noisy_or(spark, d):
    x = lines(spark, d).groupBy("service", "template").agg(F.count(F.lit(1)).alias("n"))
    return x.groupBy("service").agg(F.round(route.noisy_or(F.lit(1.0) / (F.col("n") + 1)), 6).alias("p_any"))


def window_summary(spark, d):
    x = route.window_summary(routed(spark, d))
    return x.withColumns({"expected_actionable_clusters": F.round("expected_actionable_clusters", 1), "p_any_severe": F.round("p_any_severe", 3)})


def category_counts(spark, d):
    return route.category_counts(routed(spark, d))


# correlate -----------------------------------------------------------------------------------------------------------


def surfaced(spark, d):
    return correlate.surfaced(routed(spark, d)).select("template_id", "decision")


def topology_adjacent(spark, d):
    return correlate.adjacency(topology(spark))


def candidate_pairs(spark, d):
    found = cut(correlate.surfaced(routed(spark, d)))
    return correlate.candidate_pairs(found, topology(spark), limit=None).select("a_template_id", "b_template_id", "gap_s")


def same_issue_edges(spark, d):
    x = pairs(spark, d)
    return x.where(F.col("p_same") >= correlate.SAME_ISSUE).select("a_template_id", "b_template_id", F.round("p_same", 4).alias("p_same"))


def same_issue_score(spark, d):
    found = cut(correlate.surfaced(routed(spark, d)))
    x = correlate.scored_pairs(correlate.candidate_pairs(found, topology(spark), limit=None))
    return x.select("a_template_id", "b_template_id", F.round("p_same", 3).alias("p_same"))


def incident_components(spark, d):
    return members(spark, d, correlate.MAX_PAIRS).select("template_id", "group_id")


def incident_rollup(spark, d):
    x = correlate.incidents(members(spark, d, correlate.MAX_PAIRS))
    return x.select("incident_id", "start", "end", F.array_join("services", ",").alias("services"), F.size("template_ids").alias("members"), "lines", F.round("priority", 2).alias("priority"))


def topk_incidents(spark, d):
    return correlate.top_incidents(correlate.incidents(members(spark, d))).select("incident_id", "lines")


def root_cause_rank(spark, d):
    return correlate.root_causes(members(spark, d, correlate.MAX_PAIRS)).select("incident_id", "template_id", "rank", F.round("score", 3).alias("score"))


def change_interval_join(spark, d):
    x = correlate.change_links(members(spark, d), changes(spark, d), threshold=0.0)
    return x.groupBy("incident_id").agg(F.count(F.lit(1)).alias("changes"))


def change_best_link(spark, d):
    return correlate.change_links(members(spark, d), changes(spark, d)).select("incident_id", "change_id", "template_id", F.round("p_related", 3).alias("p_related"))


def _story(spark, d):
    """members, incidents, origins, links, hypotheses with scores, events of the three incidents of the most lines."""
    m = cut(members(spark, d))
    top = cut(correlate.incidents(m).orderBy(F.desc("lines"), "incident_id").limit(3))
    m = cut(m.join(top.select("incident_id"), "incident_id", "left_semi"))
    links, ranked = cut(correlate.change_links(m, changes(spark, d))), correlate.root_causes(m)
    scored = correlate.hypothesis_scores(correlate.hypotheses(ranked, links), correlate.evidence(m, top, links))
    return m, top, ranked, links, scored, correlate.timeline(m, links)


def hypotheses(spark, d):
    return _story(spark, d)[4].select("incident_id", "position", "hypothesis", F.round("p_supported", 4).alias("p_supported"))


def timeline(spark, d):
    """Milestones of every incident, whether it is told (``_story``) or not."""
    m = cut(members(spark, d))
    return correlate.timeline(m, correlate.change_links(m, changes(spark, d))).select("incident_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "label", "kind", "event_type", "p_milestone")


def incident_bundle(spark, d):
    _, top, ranked, links, scored, events = _story(spark, d)
    return narrate.bundles(top, ranked, links, scored, events).select("incident_id", F.to_json("patterns").alias("patterns"), F.to_json("root_causes").alias("root_causes"), F.to_json("changes").alias("changes"))


def narrative(spark, d):
    _, top, ranked, links, scored, events = _story(spark, d)
    return narrate.TemplateNarrator().narrate(narrate.bundles(top, ranked, links, scored, events))


# evaluate ------------------------------------------------------------------------------------------------------------


def binary_metrics(spark, d):
    return evaluate.binary_metrics(_golden(spark, d)).drop("brier")


def brier(spark, d):
    return evaluate.binary_metrics(_golden(spark, d)).select("brier")


def reliability(spark, d):
    return evaluate.reliability(_golden(spark, d))


def ece(spark, d):
    return evaluate.ece(_golden(spark, d))


def best_threshold(spark, d):
    return evaluate.best_threshold(_golden(spark, d), 0.88)


def choice_accuracy(spark, d):
    return evaluate.choice_metrics(_choices(spark, d))


def confusions(spark, d):
    return evaluate.confusions(_choices(spark, d))


def score_metrics(spark, d):
    x = _golden(spark, d).select((F.col("n_chars") % 5).cast("int").alias("label"), ((F.col("n_chars") + F.col("quality")) % 5).cast("int").alias("pred"), (F.col("p") * 4).alias("expected"))
    return evaluate.score_metrics(x)


def routing_quality(spark, d):
    return evaluate.routing_quality(_decided(spark, d))


def estimate_cost(spark, d):
    tokens = estimate.question_tokens(checked(BUILT_IN))
    return estimate.estimate(clusters_h(spark, d), tokens).select("clusters", "cached_clusters", "requests", "questions_asked", "input_tokens", "max_request_tokens")


def export_golden(spark, d):
    return evaluate.golden_rows(reduce.clusters(lines(spark, d))).select("id", "service", "level", "template", "count")


# sinks and analytics -------------------------------------------------------------------------------------------------


def _decisions(spark, d):
    """Decision rows with an hourly window_start and the run of its day."""
    x = routed(spark, d)
    start = F.date_trunc("hour", F.col("first_seen").cast("timestamp")).cast("timestamp_ntz")
    return x.withColumns({"window_start": start, "run_id": F.date_format(F.col("first_seen").cast("timestamp"), "yyyyMMdd"), "template_id": F.substring("template_id", 1, 16)})


def _judgments(spark, d):
    x = judge.judgments(judged(spark, d))
    return x.withColumns({"model_version": F.lit(judge.MODEL), "source": F.when(F.ascii("template_id") % 2 == 0, "fallback").otherwise("heuristic"), "judged_at": F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'")})


def decision_rows(spark, d):
    return sinks.decision_rows(routed(spark, d), "run").select("run_id", "window_start", "template_id", "service", "level", "count", "decision", "category", "component")


def otlp_payload(spark, d):
    return sinks.otlp_records(logs(spark, d)).select("seq", "service", "record")


def triage_console(spark, d):
    return sinks.triage_console(routed(spark, d)).select("decision", "service", "level", "count", "category", "template")


def template_labels(spark, d):
    x = views.analytics(spark, "template_labels", decisions=_decisions(spark, d))
    return x.select("template_id", "service", "decision", "category", "component", "last_judged")


def triage_view(spark, d):
    return views.analytics(spark, "triage_view", start="TIMESTAMP_NTZ'2024-01-10 00:00:00'", decisions=_decisions(spark, d)).withColumn("p_act", F.round("p_act", 3))


def reduction_per_day(spark, d):
    return views.analytics(spark, "reduction_per_day", decisions=_decisions(spark, d)).withColumns({"day": F.col("day").cast("string"), "clusters_per_surfaced": F.round("clusters_per_surfaced", 6)})


def fallback_share(spark, d):
    return views.analytics(spark, "fallback_share", judgments=_judgments(spark, d)).withColumn("fallback_share", F.round("fallback_share", 6))


def drillback_traces(spark, d):
    first = "(SELECT min(template_id) FROM {clusters})"
    c = reduce.clusters(lines(spark, d))
    return views.analytics(spark, "drillback_traces", template_id=first, clusters=c, logs=logs(spark, d))


def suppressed_lines(spark, d):
    return views.analytics(spark, "suppressed_lines", decisions=_decisions(spark, d))


def escalated_count(spark, d):
    return views.analytics(spark, "escalated_count", decisions=_decisions(spark, d))


def fallback_rate(spark, d):
    return views.analytics(spark, "fallback_rate", judgments=_judgments(spark, d)).withColumn("rate", F.round("rate", 6))


def decision_timeseries(spark, d):
    x = views.analytics(spark, "decision_timeseries", interval="6 hours", decisions=_decisions(spark, d))
    return x.withColumn("time", F.col("time").cast("timestamp_ntz"))


def lines_by_category(spark, d):
    return views.analytics(spark, "lines_by_category", decisions=_decisions(spark, d))


def triage_board(spark, d):
    x = cut(_decisions(spark, d))  # read twice
    c = x.groupBy("run_id", "template_id").agg(F.min("template").alias("template"))
    return views.analytics(spark, "triage_board", decisions=x, clusters=c).select("decision", "service", "level", "lines", "category", "template", "flags")


def _incidents(spark, d, limit=None):
    x = correlate.incidents(members(spark, d, limit))
    none = F.array().cast("array<string>")
    return x.withColumns({"linked_changes": none, "top_hypothesis": F.lit("")})


def incident_list(spark, d):
    return views.analytics(spark, "incident_list", incidents=_incidents(spark, d)).select("incident_id", "services", "lines")


def incident_count(spark, d):
    return views.analytics(spark, "incident_count", incidents=_incidents(spark, d, correlate.MAX_PAIRS))


# end to end and streaming --------------------------------------------------------------------------------------------


def stream_once(spark, d):
    """Counts of closed hourly windows by a stream over ``events``, run until its input is used up."""
    x = worker.log_stream(spark, f"{d}/events.parquet*", table(spark, d, "events").schema)
    x = spark.sql(LOGS.replace("{text}", "STRING"), events=x)
    counts = worker.windowed_counts(x, "1 hour")
    name = f"counts_{abs(hash(d))}"
    base = shared_folder(spark)
    import uuid

    folder = f"{base}/stream-{uuid.uuid4().hex}"
    counts.writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).queryName(name).start(f"{folder}/out").awaitTermination()
    out = spark.read.parquet(f"{folder}/out")
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "service", "template", "lines")


NAMES = """scan_jsonl scan_plaintext key_synonyms guess_level normalize_level parse_ts scrub_email scrub_card scrub_ipv4
scrub_all scrub_stats mask tokenize template_hash word_tokens drain_bucket token_similarity drain_templates cluster_agg level_counts first_examples first_traces
sensitive_hits cluster_order reduction_ratio tumbling_window keyword_features state_text p_nouls category_choice expected_severity judgment_long runbook_choice
cache_hits cache_misses cache_upsert cache_stats nearest_rank_percentile judge_stats dead_letters answer_pivot route_decision route_flags rules_check
priority noisy_or window_summary category_counts surfaced topology_adjacent candidate_pairs same_issue_edges same_issue_score incident_components
incident_rollup topk_incidents root_cause_rank change_interval_join change_best_link hypotheses timeline incident_bundle narrative binary_metrics
brier reliability ece best_threshold choice_accuracy confusions score_metrics routing_quality estimate_cost export_golden decision_rows otlp_payload triage_console
template_labels triage_view reduction_per_day fallback_share drillback_traces suppressed_lines escalated_count fallback_rate decision_timeseries lines_by_category
triage_board incident_list incident_count stream_once""".split()
QUERIES = {name: globals()[name] for name in NAMES}


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Which incidents, where did they start, and which change is linked?"""
    m = cut(members(spark, d))
    w = correlate.root_causes(m).where("rank = 0").select("incident_id", F.col("service").alias("origin"), F.col("template").alias("origin_template"))
    best = correlate.change_links(m, changes(spark, d)).groupBy("incident_id").agg(F.max_by("summary", "p_related").alias("change"))
    return correlate.incidents(m).join(w, "incident_id").join(best, "incident_id", "left").select("incident_id", "start", "end", "lines", "priority", "origin", "origin_template", "change")
