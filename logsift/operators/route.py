"""L2: decisions, reasons, priority and the window's summary."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.levels import level_rank
from ..functions.scrub import HIGH_RISK
from ..functions.text import once

SURFACED = ["escalate", "triage", "review"]


@dataclass(frozen=True)
class RouterConfig:
    suppress_benign_min: float = 0.95
    suppress_actionable_max: float = 0.10
    never_suppress_levels: tuple[str, ...] = ("ERROR", "FATAL")
    suppress_min_count: int = 20
    noise_allowlist: tuple[str, ...] = (r"health", r"heartbeat", r"readyz|livez", r"cache hit", r"metrics")
    escalate_actionable_min: float = 0.6
    escalate_novel_min: float = 0.5
    escalate_severity_min: float = 2.5
    known_issue_runbook_min: float = 0.7
    sensitive_flag_min: float = 0.5
    uncertainty_band: float = 0.1
    #: template_id: ticket; a driver-side dictionary, so small.
    known_issues: dict[str, str] = field(default_factory=dict)


def priority(actionable: Column, severity: Column, novel: Column, count: Column) -> Column:
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return F.round(zero(actionable) * (1 + zero(severity)) * (1 + zero(novel)) * F.log1p(count.cast("double")), 4)


def rules_check(cfg: RouterConfig) -> Column:
    quiet = F.lit(False)
    for p in cfg.noise_allowlist:
        quiet = quiet | F.regexp_like("template", F.lit(f"(?iU){p}"))
    return ~F.col("level").isin(*cfg.never_suppress_levels) & (quiet | (F.col("count") >= cfg.suppress_min_count))


def _two(c: Column) -> Column:
    return F.format_string("%.2f", c)


def route(judged: DataFrame, cfg: RouterConfig | None = None, known: DataFrame | None = None) -> DataFrame:
    """judged (with ``answers``) with flags, decision, reasons and priority.

    Optional columns: runbook and runbook_p. Null p_actionable or p_benign means review. known: template_id and ticket of
    known issues, beside those of the configuration.
    """
    cfg = cfg or RouterConfig()
    a, b, nov, sens, sev = (F.col(c) for c in ("p_actionable", "p_benign", "p_novel", "p_sensitive", "expected_severity"))
    has = F.col("fallback")
    sensitive = F.coalesce(sens >= cfg.sensitive_flag_min, F.lit(False))
    flags = F.array_compact(F.array(F.when(has, "fallback_answers"), F.when(sensitive, "sensitive_data"), F.when(F.size("sensitive_hits") > 0, "scrubbed")))
    x = judged.withColumns({"flags": once(flags), "priority": once(priority(a, sev, nov, F.col("count"))), "_rules": once(rules_check(cfg))})
    if cfg.known_issues:
        rows = judged.sparkSession.createDataFrame([(k, v) for k, v in cfg.known_issues.items() if v], "template_id string, ticket string")
        known = rows if known is None else rows.unionByName(known.select("template_id", "ticket"))
    if known is not None:
        x = x.join(known.groupBy("template_id").agg(F.min("ticket").alias("_ticket")), "template_id", "left")
    else:
        x = x.withColumn("_ticket", F.lit(None).cast("string"))
    runbook = F.col("runbook") if "runbook" in judged.columns else F.lit(None).cast("string")
    runbook_p = F.col("runbook_p") if "runbook" in judged.columns else F.lit(None).cast("double")
    leaked = F.array_sort(F.array_intersect(F.map_keys("sensitive_hits"), F.array(*map(F.lit, HIGH_RISK))))
    is_novel = F.coalesce(nov >= cfg.escalate_novel_min, F.lit(False))
    is_severe = F.coalesce(sev >= cfg.escalate_severity_min, F.lit(False))
    act = a >= cfg.escalate_actionable_min
    worthy = act & (is_novel | is_severe)
    quiet = (b >= cfg.suppress_benign_min) & (a <= cfg.suppress_actionable_max)
    near = (F.abs(a - cfg.escalate_actionable_min) <= cfg.uncertainty_band) | (F.abs(b - cfg.suppress_benign_min) <= cfg.uncertainty_band)
    missing, known, by_book = a.isNull() | b.isNull(), F.col("_ticket").isNotNull(), F.coalesce((runbook != "none") & (runbook_p >= cfg.known_issue_runbook_min), F.lit(False))
    leak = (F.size(leaked) > 0) & ~worthy
    suppress = quiet & ~has & ~sensitive & F.col("_rules")
    both = F.concat(F.lit("P(actionable)="), _two(a), F.lit(", P(benign)="), _two(b))
    cases = [
        (missing, "review", F.lit("missing core answers (actionable/benign)")),
        (known, "known_issue", F.concat(F.lit("known issue: "), F.col("_ticket"))),
        (by_book, "known_issue", F.concat(F.lit("runbook "), runbook, F.lit(" (p="), _two(runbook_p), F.lit(")"))),
        (leak, "triage", F.concat(F.lit("scrubber caught "), F.array_join(leaked, ", "), F.lit(": fix the logging call at the source"))),
        (suppress, "suppress", F.concat(F.lit("P(benign)="), _two(b), F.lit(", P(actionable)="), _two(a), F.lit(", rules check passed"))),
        (worthy, "escalate", F.concat_ws(", ", F.concat(F.lit("P(actionable)="), _two(a)), F.when(is_novel, F.concat(F.lit("P(novel)="), _two(nov))), F.when(is_severe, F.concat(F.lit("E[severity]="), F.format_string("%.1f", sev))))),
        (act, "triage", F.concat(F.lit("P(actionable)="), _two(a))),
        (near, "review", F.concat(F.lit("near threshold: "), both)),
    ]
    decision, last = F.when(F.lit(False), F.lit("")), F.when(F.lit(False), F.lit(""))
    for when, name, why in cases:
        decision, last = decision.when(when, F.lit(name)), last.when(when, why)
    decision, last = decision.otherwise("monitor"), last.otherwise(both)
    early = missing | known | by_book | leak
    guard = F.when(early | ~quiet | suppress, F.lit(None)).when(has, "would suppress, but answers came from the fallback judge").when(sensitive, "would suppress, but the cluster may contain sensitive data").otherwise("would suppress, but the rules check did not pass")
    first = F.when(sensitive, F.concat(F.lit("P(sensitive)="), _two(sens), F.lit(": keep examples out of L4 and fix the scrubber")))
    x = x.withColumns({"decision": once(decision), "reasons": once(F.array_compact(F.array(first, guard.cast("string"), last)))})
    return x.drop("_rules", "_ticket")


def by_priority(routed: DataFrame) -> DataFrame:
    """Highest priority first; equals in the order of clusters."""
    return routed.orderBy(*priority_order())


def priority_order() -> list[Column]:
    return [F.desc("priority"), F.desc(level_rank(F.col("level"))), F.desc("count"), F.col("template_id").asc()]


def noisy_or(p: Column) -> Column:
    """An aggregate: the probability that at least one of independent events is true."""
    return 1 - F.coalesce(F.product(1 - F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0))), F.lit(1.0))


def window_summary(routed: DataFrame) -> DataFrame:
    """One row: counts, lines, expected actionable clusters, probability of anything severe, alert reduction ratio."""
    surfaced = F.count_if(F.col("decision").isin("escalate", "triage"))
    decisions = ["escalate", "triage", "review", "monitor", "suppress", "known_issue"]
    out = routed.agg(
        F.count(F.lit(1)).alias("clusters"), F.coalesce(F.sum("count"), F.lit(0)).alias("lines"),
        *[F.count_if(F.col("decision") == d).alias(f"n_{d}") for d in decisions],
        F.coalesce(F.sum(F.when(F.col("decision") == "suppress", F.col("count"))), F.lit(0)).alias("suppressed_lines"),
        F.round(F.coalesce(F.sum("p_actionable"), F.lit(0.0)), 3).alias("expected_actionable_clusters"), F.round(noisy_or(F.col("p_severe")), 4).alias("p_any_severe"), surfaced.alias("_s"),
    )
    return out.withColumn("alert_reduction_ratio", F.round(F.coalesce(F.col("clusters") / F.nullif("_s", F.lit(0)), F.col("clusters").cast("double")), 2)).drop("_s")


def category_counts(routed: DataFrame) -> DataFrame:
    return routed.groupBy(F.coalesce("category", F.lit("unknown")).alias("category")).agg(F.count(F.lit(1)).alias("clusters"))
