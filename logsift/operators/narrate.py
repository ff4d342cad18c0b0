"""L4: evidence bundles and a template narrative; another narrator can be put in its place."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import iso


class Narrator(Protocol):
    def narrate(self, bundle: DataFrame) -> DataFrame:
        """incident_id, narrative of each bundle."""


def _top(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(Window.partitionBy("incident_id").orderBy(*order))).where(F.col("_r") <= n)


def _list(df: DataFrame, out: str, **parts: Column) -> DataFrame:
    s = F.struct(F.col("_r"), *[c.alias(k) for k, c in parts.items()])
    return df.groupBy("incident_id").agg(F.transform(F.array_sort(F.collect_list(s)), lambda e: e.dropFields("_r")).alias(out))


def bundles(found: DataFrame, ranked: DataFrame, links: DataFrame, scored: DataFrame, events: DataFrame) -> DataFrame:
    """One row an incident: patterns (10), root_causes (5), changes (5), hypotheses, timeline (12) as arrays of structs."""
    c = F.col
    shown = F.when(F.array_contains("flags", "sensitive_data"), F.lit(None)).otherwise(F.slice("examples", 1, 2))
    patterns = _list(
        _top(ranked, 10, F.desc("priority"), "template_id"), "patterns", service=c("service"), level=c("level"), template=c("template"), occurrences=c("count"), first_seen=iso(c("first_seen")),
        category=c("category"), p_actionable=F.round("p_actionable", 3), p_root_cause=F.round("p_root_cause", 3), expected_severity=c("expected_severity"), examples=shown,
    )
    origins = _list(_top(ranked, 5, F.desc("score"), "rank"), "root_causes", service=c("service"), template=c("template"), score=c("score"), p=c("p_root_cause"), first_seen=c("first_seen"))
    changes = _list(_top(links, 5, F.desc("p_related"), "change_key"), "changes", service=c("change_service"), summary=c("summary"), at=iso(c("change_ts")), p_related=F.round("p_related", 3))
    hyp = _list(_top(scored, 6, F.desc("p_supported"), "position"), "hypotheses", text=c("hypothesis"), p_supported=F.round("p_supported", 3))
    line = _list(_top(events, 12, "ts", "kind", "label"), "timeline", ts=c("ts"), event_type=c("event_type"), label=c("label"))
    sizes = ranked.groupBy("incident_id").agg(F.count(F.lit(1)).alias("n_patterns"))
    out = found.join(sizes, "incident_id")
    for part in (patterns, origins, changes, hyp, line):
        out = out.join(part, "incident_id", "left")
    return out


class TemplateNarrator:
    """Markdown from a template, all in Columns: a headline, then what is known as labelled lines and two lists."""

    def narrate(self, bundle: DataFrame) -> DataFrame:
        at = lambda c, form: F.date_format(c.cast("timestamp"), form)
        share = lambda p: F.concat(F.round(100 * p).cast("int").cast("string"), F.lit(" %"))
        say = lambda text, *parts: F.format_string(text, *parts)
        origin, change = F.get("root_causes", F.lit(0)), F.get("changes", F.lit(0))
        extent = say("Extent: %d lines of %d patterns on %s; first at %s, last at %s (UTC).", F.col("lines"), F.col("n_patterns"), F.array_join("services", ", "), at(F.col("start"), "yyyy-MM-dd HH:mm:ss"), at(F.col("end"), "yyyy-MM-dd HH:mm:ss"))
        begins = F.when(origin.isNotNull(), say("Probable start: %s on %s at %s (%s).", origin.template, origin.service, at(origin.first_seen, "HH:mm:ss"), share(origin.p)))
        fits = F.when(change.isNotNull(), say("Change that fits: %s on %s (%s).", change.summary, change.service, share(change.p_related)))
        numbered = F.transform(F.slice("hypotheses", 1, 5), lambda h, i: say("%d. %s (%s)", i + 1, h.text, share(h.p_supported)))
        seen = F.transform("timeline", lambda e: say("* %s %s: %s", at(e.ts, "HH:mm:ss"), e.event_type, e.label))
        part = lambda head, items: F.when(F.size(items) > 0, F.concat_ws("\n", F.lit(head), items))
        whole = F.array_compact(F.array(
            F.concat(F.lit("### "), F.col("incident_id")), extent, begins, fits, part("Explanations to check:", numbered), part("Course of events:", seen), F.lit("Percentages are a classifier's estimates."),
        ))
        return bundle.select("incident_id", F.array_join(whole, "\n\n").alias("narrative"))
