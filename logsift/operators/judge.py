"""L1: the deterministic judge as Columns, and the questions it answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.levels import level_rank
from ..functions.scrub import is_dirty
from ..functions.text import best_option, confidence, expected_level, hits, iso, noul, once, sigmoid, softmax, word_tokens

MODEL = "keywords-1"

# Keyword lists of the judge.
CATEGORY = {
    "timeout": ["timeout", "timed out", "deadline", "took too long", "504"],
    "auth": ["unauthorized", "forbidden", "401", "403", "invalid token", "expired token", "denied", "login failed"],
    "capacity": ["exhausted", "out of memory", "oom", "quota", "rate limit", "429", "queue full", "disk full", "too many connections", "pool"],
    "dependency": ["refused", "unreachable", "upstream", "503", "502", "bad gateway", "unavailable", "dependency", "connection reset"],
    "config": ["config", "missing env", "feature flag", "misconfigured", "invalid setting", "not set"],
    "data": ["validation", "malformed", "parse error", "invalid json", "constraint", "duplicate key", "schema"],
    "code_bug": ["nullpointer", "null pointer", "typeerror", "keyerror", "undefined", "panic", "assert", "traceback", "unhandled exception", "stack trace", "attributeerror"],
    "infra": ["dns", "node", "pod", "container", "evicted", "crashloop", "kernel", "network unreachable"],
    "none": [],
}
COMPONENT = {
    "edge": ["gateway", "ingress", "nginx", "load balancer", "cdn", "envoy"],
    "application": [],
    "database": ["db", "database", "postgres", "mysql", "sql", "pool", "query", "deadlock"],
    "cache": ["cache", "redis", "memcached"],
    "queue": ["queue", "kafka", "consumer", "producer", "job", "worker", "sqs"],
    "external_api": ["upstream", "api call", "http client", "calling", "stripe", "provider", "external"],
    "platform": ["pod", "node", "container", "dns", "kubelet", "oom", "disk"],
}
NOISE = ["health", "healthz", "readyz", "heartbeat", "ping", "cache hit", "request completed", "metrics scraped", "connection established", "started", "listening on", "retry succeeded", "user logged in", "gc pause", "scheduled job finished", "status=200", "200 ok"]
ERROR = ["error", "exception", "fail", "failed", "refused", "timeout", "exhausted", "panic", "denied", "unavailable", "crash", "fatal"]
ROOT_CAUSE = ["exhausted", "out of memory", "oom", "disk full", "config", "nullpointer", "panic", "deadlock", "invalid", "missing", "certificate expired", "migration"]
SYMPTOM = ["upstream", "timeout calling", "502", "503", "504", "bad gateway", "dependency", "retrying", "circuit breaker open", "downstream"]
USER = ["checkout", "login", "payment", "order", "signup", "cart", "5xx", "500", "502", "503", "504"]
WEIRD = ["panic", "unexpected", "assert", "corrupt", "unknown", "nullpointer", "segfault"]
EVENT = {
    "trigger": ["deploy", "config change", "rollout", "release", "migration"],
    "first_error": ["first_error", "error", "exception", "failed"],
    "escalation": ["timeout", "upstream", "503", "504", "spreading"],
    "mitigation": ["rollback", "failover", "scaled", "restart"],
    "recovery": ["recovered", "healthy", "resolved", "back to normal"],
}
MILESTONE = ["deploy", "rollback", "first", "error", "recovered"]
SEVERITY_BASE = [0.0, 0.0, 0.0, 1.0, 2.0, 3.4]
SEVERITIES, IMPACTS = 5, 4

NOULS = ["actionable", "benign", "root_cause", "novel", "sensitive"]
#: Questions in the order of the pack, with their types.
PACK = [("category", "choice"), ("component", "choice"), ("severity", "score"), ("user_impact", "score")] + [(k, "noul") for k in NOULS]


def state_json(examples: int = 3, template: Column | None = None) -> Column:
    """The JSON summary of a cluster that is judged: its keys and values count as text too."""
    return F.to_json(
        F.struct(
            F.col("service"), F.col("level"), (F.col("template") if template is None else template).alias("template"), F.col("count").alias("occurrences"),
            iso(F.col("first_seen")).alias("first_seen"), iso(F.col("last_seen")).alias("last_seen"), F.slice("examples", 1, examples).alias("examples"),
        ),
        {"ignoreNullFields": "false"},
    )


def features(clusters: DataFrame) -> DataFrame:
    """clusters with state, rank and the counts noise, err, rc, sym, usr, weird of keywords in the lower-cased state."""
    x = clusters.withColumn("state", once(state_json()))
    x = x.withColumn("_low", once(F.lower("state")))
    low = F.col("_low")
    counts = {"noise": NOISE, "err": ERROR, "rc": ROOT_CAUSE, "sym": SYMPTOM, "usr": USER, "weird": WEIRD}
    return x.withColumns({"rank": once(level_rank(F.col("level")))} | {k: once(hits(low, w)) for k, w in counts.items()})


def _levels(n: int, centre: Column) -> Column:
    c = F.least(F.greatest(centre, F.lit(0.0)), F.lit(float(n - 1)))
    return softmax([(str(i), -F.abs(i - c) * 1.6) for i in range(n)])


def judge(clusters: DataFrame) -> DataFrame:
    """clusters with features, q_<key> (unrounded p of each yes-or-no question), p_<key> (rounded to 4), and the
    distributions d_category, d_component, d_severity, d_user_impact."""
    x = features(clusters)
    c = F.col
    cap = lambda n, k: F.least(c(n), F.lit(k))
    over = lambda k: F.greatest(c("rank") - k, F.lit(0))
    logit = F.lit(-2.6) + 1.1 * over(2) + 0.7 * cap("err", 3) - 1.6 * cap("noise", 2) + 0.3 * cap("rc", 2)
    q = {
        "actionable": sigmoid(logit),
        "benign": sigmoid(-logit - 0.6 + 0.9 * cap("noise", 2)),
        "root_cause": F.when((c("rank") < 3) & (c("err") == 0), F.lit(0.05)).otherwise(sigmoid(F.lit(-0.4) + 1.2 * cap("rc", 2) - 1.3 * cap("sym", 2))),
        "novel": sigmoid(F.lit(-2.4) + 1.3 * c("weird") + 0.5 * over(3) - 0.8 * cap("noise", 2)),
        "sensitive": F.when(is_dirty(c("state")), F.lit(0.95)).otherwise(F.lit(0.03)),
    }
    low = c("_low")
    category = [(k, 2.0 * hits(low, w)) for k, w in CATEGORY.items() if k != "none"]
    category.append(("none", F.lit(1.5) + 2.0 * cap("noise", 2) - 1.0 * over(2) - 0.5 * c("err")))
    component = [(k, F.lit(1.0) if k == "application" else 1.5 * hits(low, w)) for k, w in COMPONENT.items()]
    base = F.element_at(F.array(*map(F.lit, SEVERITY_BASE)), c("rank") + 1)
    severity = base + 0.4 * cap("rc", 2) - 0.8 * cap("noise", 2) + F.when(c("count") > 500, 0.4).otherwise(0.0)
    impact = 0.8 * over(2) + 0.6 * cap("usr", 2) - 0.8 * cap("noise", 2)
    x = x.withColumns({"_severity": once(severity), "_impact": once(impact)})
    x = x.withColumns({f"q_{k}": once(noul(v)) for k, v in q.items()})
    return x.withColumns(
        {f"p_{k}": F.round(f"q_{k}", 4) for k in q}
        | {"d_category": once(softmax(category)), "d_component": once(softmax(component)), "d_severity": once(_levels(SEVERITIES, c("_severity"))), "d_user_impact": once(_levels(IMPACTS, c("_impact")))}
    ).drop("_low", "_severity", "_impact")


def judgments(judged: DataFrame) -> DataFrame:
    """One row a cluster and question: template_id, question_key, question_type, value, p_yes, probabilities, confidence, source."""
    rows = []
    pairs = "array<struct<name:string,p:double>>"
    for key, kind in PACK:
        if kind == "noul":
            q = F.col(f"q_{key}")
            dist = F.array(F.struct(F.lit("yes").alias("name"), q.alias("p")), F.struct(F.lit("no").alias("name"), (1 - q).alias("p"))).cast(pairs)
            value, p, conf = F.col(f"p_{key}").cast("string"), F.col(f"p_{key}"), F.lit(None).cast("double")
        else:
            dist = F.col(f"d_{key}").cast(pairs)
            value, p, conf = best_option(dist), F.lit(None).cast("double"), confidence(dist)
        rows.append(F.struct(F.lit(key).alias("question_key"), F.lit(kind).alias("question_type"), value.alias("value"), p.alias("p_yes"), dist.alias("dist"), conf.alias("confidence")))
    x = judged.select("template_id", F.explode(F.array(*rows)).alias("a")).select("template_id", "a.*")
    return x.select("template_id", "question_key", "question_type", "value", "p_yes", F.map_from_entries("dist").alias("probabilities"), "confidence", F.lit("heuristic").alias("source"))


def answers(judged: DataFrame) -> DataFrame:
    """judged with category, component, expected_severity, expected_user_impact and fallback (false, or as ``overlaid``)."""
    return judged.withColumns({
        "category": once(best_option(F.col("d_category"))), "component": once(best_option(F.col("d_component"))),
        "expected_severity": once(expected_level(F.col("d_severity"))), "expected_user_impact": once(expected_level(F.col("d_user_impact"))),
        "p_severe": F.aggregate(F.filter("d_severity", lambda e: e["name"].cast("int") >= 3), F.lit(0.0), lambda s, e: s + e.p),
        "fallback": F.col("_fallback") if "_fallback" in judged.columns else F.lit(False),
    }).drop("_fallback")


def runbook_choice(text: Column, runbooks: dict[str, str]) -> Column:
    """Distribution over the runbooks and ``none`` by shared words, for a state's text."""
    return generic("choice", text, runbooks | {"none": "None of the listed runbooks fits."})


def overlaid(judged: DataFrame, given: DataFrame, fallback: bool = True, failed: DataFrame | None = None) -> DataFrame:
    """judged with another judge's answers in place of the native ones, and fallback: whether it has none for a cluster.

    given: subject_id, key, type, value, probabilities (``remote.long_answers``). fallback: clusters without an answer keep
    the native answers, else they have none. failed: subject_id of clusters that were asked in vain; what a cache has of
    their answers stands. A run's questions are those of PACK; answers to others are left out.
    """
    pick = lambda key, c: F.max(F.when(F.col("key") == key, F.col(c)))
    dist = lambda key: F.max(F.when(F.col("key") == key, F.to_json("probabilities")))
    if failed is not None:
        rest = [F.lit(None).cast(t).alias(c) for c, t in given.dtypes if c not in ("subject_id", "key")]
        given = given.unionByName(failed.select("subject_id", F.lit("").alias("key"), *rest))  # no question has this key
    wide = given.groupBy(F.col("subject_id").alias("template_id")).agg(*[pick(k, "value").cast("double").alias(f"_p_{k}") for k in NOULS], *[dist(k).alias(f"_d_{k}") for k, t in PACK if t != "noul"], F.when(F.min("key") != "", F.lit(True)).alias("_has"))
    x = judged.join(wide, "template_id", "left").withColumn("_miss", F.col("_has").isNull())
    own = lambda c: F.when(F.col("_miss") & F.lit(fallback), F.col(c))
    held = lambda k: F.when(F.col(f"_p_{k}").isNotNull(), noul(F.col(f"_p_{k}")))
    parts = {f"p_{k}": F.coalesce(F.round(held(k), 4), own(f"p_{k}")) for k in NOULS} | {f"q_{k}": F.coalesce(held(k), own(f"q_{k}")) for k in NOULS}
    for k, t in PACK:
        if t != "noul":
            shares = F.transform(F.map_entries(F.from_json(f"_d_{k}", "map<string,double>")), lambda e: F.struct(e.key.alias("name"), e.value.alias("p")))
            parts[f"d_{k}"] = F.coalesce(shares, own(f"d_{k}"))
    return x.withColumns(parts).withColumn("_fallback", F.col("_miss")).drop("_has", "_miss", *[f"_p_{k}" for k in NOULS], *[f"_d_{k}" for k, t in PACK if t != "noul"])


def with_runbooks(judged: DataFrame, runbooks: dict[str, str], text: Column | None = None) -> DataFrame:
    """judged with runbook, the likeliest one (or ``none``), and runbook_p, its probability."""
    x = judged.withColumn("_book", once(runbook_choice(F.col("state") if text is None else text, runbooks)))
    return x.withColumns({"runbook": best_option(F.col("_book")), "runbook_p": F.array_max(F.transform("_book", lambda e: e.p))}).drop("_book")


def generic(kind: str, text: Column, criteria=None) -> Column:
    """The answer to a question that has no rule: a noul is undecided, a choice goes by shared words, a score is uniform.

    A noul is a probability; the others are distributions.
    """
    if kind == "noul":
        return F.lit(0.5)
    if kind == "choice":
        words = word_tokens(text)
        shared = lambda k, v: F.size(F.array_intersect(words, F.array(*map(F.lit, sorted(_words(f"{k} {v}")) or [""])))).cast("double")
        return softmax([(k, shared(k, v)) for k, v in (criteria or {}).items()], 0.7)
    return softmax([(str(i), F.lit(0.0)) for i in range(len(criteria or ()))])


def _words(text: str) -> set[str]:
    import re

    return set(re.findall("[a-z][a-z0-9_]+", text.lower()))


def same_issue(ta: Column, tb: Column, shared_trace: Column, gap: Column, same_service: Column) -> Column:
    """p that two clusters are one issue; ta, tb: their word tokens."""
    union = F.size(F.array_union(ta, tb))
    jaccard = F.coalesce(F.size(F.array_intersect(ta, tb)) / F.nullif(union, F.lit(0)), F.lit(0.0))
    p = F.lit(0.08) + 0.55 * jaccard + F.when(shared_trace, 0.35).otherwise(0.0) + F.when(F.abs(gap) < 120, 0.15).otherwise(0.0) + F.when(same_service, 0.1).otherwise(0.0)
    return F.round(noul(p), 4)


def change_related(same_service: Column, minutes: Column, overlap: Column) -> Column:
    near = F.when((minutes >= 0) & (minutes <= 30), 0.25).when(minutes <= 120, 0.1).otherwise(-0.05)
    return F.round(noul(F.lit(0.08) + F.when(same_service, 0.45).otherwise(0.0) + near + F.least(F.lit(0.2), 0.07 * overlap)), 4)


def hypothesis_supported(hypothesis: Column, evidence: Column) -> Column:
    words = word_tokens(hypothesis)
    share = F.size(F.array_intersect(words, word_tokens(evidence))) / F.greatest(F.size(words), F.lit(1))
    return F.round(noul(sigmoid(F.lit(-2.2) + 6.0 * share)), 4)


def event_type(text: Column) -> Column:
    low = F.lower(text)
    return softmax([(k, 1.5 * hits(low, w)) for k, w in EVENT.items()] + [("other", F.lit(0.5))])


def milestone(text: Column) -> Column:
    return F.round(noul(sigmoid(F.lit(-1.0) + 0.8 * hits(F.lower(text), MILESTONE))), 4)
