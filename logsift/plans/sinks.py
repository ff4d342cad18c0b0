"""Relations of a run, and writers for them."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.levels import SEVERITY_NUMBER
from ..operators.judge import MODEL, judgments
from .commits import Committed
from .triage import Run
from .views import PARTITION, create_tables


def observed(clusters: DataFrame) -> DataFrame:
    """One row: window_start, window_end as observed."""
    return clusters.agg(F.min("first_seen").alias("window_start"), F.max("last_seen").alias("window_end"))


def _windowed(df: DataFrame, clusters: DataFrame, run_id: str) -> DataFrame:
    """df with run_id and the observed window, joined from its one row."""
    one = observed(clusters).withColumn("_j", F.lit(1))
    return df.withColumn("_j", F.lit(1)).join(F.broadcast(one), "_j").drop("_j").withColumn("run_id", F.lit(run_id))


def cluster_rows(clusters: DataFrame, run_id: str) -> DataFrame:
    return _windowed(clusters, clusters, run_id).select("run_id", "window_start", "window_end", "template_id", "service", "template", "level", "count", "first_seen", "last_seen", "examples", "trace_ids", "level_counts", "sensitive_hits")


def judgment_rows(judged: DataFrame, run_id: str, model: str = MODEL) -> DataFrame:
    return judgments(judged).select(F.lit(run_id).alias("run_id"), F.current_timestamp().alias("judged_at"), "template_id", F.lit(model).alias("model_version"), "question_key", "question_type", "value", "p_yes", "probabilities", "confidence", "source")


def decision_rows(routed: DataFrame, run_id: str) -> DataFrame:
    return _windowed(routed, routed, run_id).select(
        "run_id", "window_start", "template_id", "service", "level", "count", "decision", "reasons", "flags", "priority", "category", "component", "expected_severity", "expected_user_impact",
        "p_actionable", "p_benign", "p_root_cause", "p_novel", "p_sensitive",
    )


def incident_rows(r: Run) -> DataFrame:
    first = lambda df, *order: df.withColumn("_r", F.row_number().over(Window.partitionBy("incident_id").orderBy(*order))).where("_r = 1")
    root = first(r.root_causes, F.desc("score"), "rank").select("incident_id", F.col("template_id").alias("root_cause_template_id"))
    top = first(r.hypotheses, F.desc("p_supported"), "position").select("incident_id", F.col("hypothesis").alias("top_hypothesis"))
    linked = r.links.groupBy("incident_id").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("p_related")).alias("o"), "summary"))), lambda s: s.summary).alias("linked_changes"))
    x = r.incidents.join(root, "incident_id", "left").join(linked, "incident_id", "left").join(top, "incident_id", "left").join(r.narratives, "incident_id", "left")
    none = F.array().cast("array<string>")
    return x.select(F.lit(r.run_id).alias("run_id"), "incident_id", "start", "end", "services", "template_ids", "lines", "priority", "root_cause_template_id", F.coalesce("linked_changes", none).alias("linked_changes"), F.coalesce("top_hypothesis", F.lit("")).alias("top_hypothesis"), F.coalesce("narrative", F.lit("")).alias("narrative"))


def relations(r: Run) -> dict[str, DataFrame]:
    return {"log_clusters": cluster_rows(r.clusters, r.run_id), "cluster_judgments": judgment_rows(r.judged, r.run_id, r.model_version), "routing_decisions": decision_rows(r.routed, r.run_id), "incidents": incident_rows(r)}


def write_files(r: Run, folder: str, form: str = "json") -> None:
    """The four relations below ``folder/run_id``, with the summary; a run that is written again replaces itself."""
    for name, df in relations(r).items():
        df.write.mode("overwrite").format(form).save(f"{folder}/{r.run_id}/{name}")
    # one row, and the few narratives in the order of their incidents: a file each, as people read them
    r.summary.coalesce(1).write.mode("overwrite").json(f"{folder}/{r.run_id}/summary")
    r.narratives.write.mode("overwrite").json(f"{folder}/{r.run_id}/narratives")
    ranked = r.narratives.join(r.incidents.select("incident_id", "priority"), "incident_id").orderBy(F.desc("priority"), "incident_id")
    ranked.coalesce(1).select(F.concat(F.col("narrative"), F.lit("\n"))).write.mode("overwrite").text(f"{folder}/{r.run_id}/incidents.md")


def write_commit(r: Run, folder: str) -> None:
    """The four relations below ``folder`` in one commit: a run that dies before its end leaves what was there, and one that
    is written again replaces its own rows."""
    Committed(r.routed.sparkSession, folder).commit(r.run_id, relations(r))


def write(r: Run, kind: str, folder: str, database: str) -> None:
    """By the settings of ``sink``."""
    if kind == "tables":
        create_tables(r.routed.sparkSession, database)
        write_tables(r, database)
    elif kind == "commits":
        write_commit(r, folder)
    else:
        write_files(r, folder, {"jsonl": "json"}.get(kind, kind))


def write_tables(r: Run, database: str) -> None:
    """Writes to the tables of ``create_tables``; a run that is written again replaces its own partitions.

    Tables are partitioned by run (and day), and only the partitions that a run has rows of are overwritten.
    """
    spark = r.routed.sparkSession
    for name, df in relations(r).items():
        if name in PARTITION:
            df = df.withColumn("day", F.to_date(PARTITION[name]))
        columns = spark.table(f"{database}.{name}").columns
        df.select(*columns).write.option("partitionOverwriteMode", "dynamic").insertInto(f"{database}.{name}", overwrite=True)


def write_jdbc(r: Run, url: str, properties: dict[str, str] | None = None) -> None:
    """Appends to an external database; arrays and maps go as JSON text. Rows of the run that are there are deleted first,
    each table's in one statement, so a run that is written again doesn't stand twice."""
    jvm = r.routed.sparkSession.sparkContext._jvm
    options = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        options.setProperty(k, v)
    for name, df in relations(r).items():
        con = jvm.java.sql.DriverManager.getConnection(url, options)
        try:
            if con.getMetaData().getTables(None, None, name, None).next():
                gone = con.prepareStatement(f"DELETE FROM {name} WHERE run_id = ?")
                gone.setString(1, r.run_id)
                gone.executeUpdate()
        finally:
            con.close()
        flat = df.select(*[F.to_json(c).alias(c) if t.startswith(("array", "map")) else F.col(c) for c, t in df.dtypes])
        flat.write.jdbc(url, name, mode="append", properties=properties or {})


def otlp_records(logs: DataFrame, shift_us: int = 0) -> DataFrame:
    """seq, service, record: JSON of each log record for replay; trace ids only of 32 characters."""
    number = F.coalesce(F.element_at(F.create_map(*[F.lit(v) for kv in SEVERITY_NUMBER.items() for v in kv]), F.col("level")), F.lit(9))
    nanos = ((F.unix_micros(F.col("ts").cast("timestamp")) + shift_us) * 1000).cast("string")
    trace = F.when(F.length("trace_id") == 32, F.col("trace_id"))
    body = F.struct(F.col("body").alias("stringValue"))
    return logs.select("seq", "service", F.to_json(F.struct(nanos.alias("timeUnixNano"), F.col("level").alias("severityText"), number.alias("severityNumber"), body.alias("body"), trace.alias("traceId"))).alias("record"))


def otlp_payloads(logs: DataFrame, batch: int = 2000, shift_us: int = 0) -> DataFrame:
    """batch, payload: requests of at most ``batch`` records of one service each."""
    x = otlp_records(logs, shift_us)
    # numbered within a salt of the service, so that no hot service is ranked in one task
    w = Window.partitionBy("service", "_p").orderBy("seq")
    x = x.withColumn("_p", F.pmod(F.xxhash64("seq"), F.lit(64))).withColumn("_b", F.floor((F.row_number().over(w) - 1) / batch))
    g = x.groupBy("service", "_p", "_b").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "record"))), lambda s: s.record), ",").alias("r"))
    head = F.concat(F.lit('{"resourceLogs":[{"resource":{"attributes":[{"key":"service.name","value":{"stringValue":'), F.to_json(F.array("service")).substr(F.lit(2), F.length(F.to_json(F.array("service"))) - 2), F.lit('}}]},"scopeLogs":[{"scope":{"name":"replay"},"logRecords":['))
    return g.select(F.concat_ws("-", "service", "_p", "_b").alias("batch"), F.concat(head, F.col("r"), F.lit("]}]}]}")).alias("payload"))


def triage_console(routed: DataFrame, limit: int = 20) -> DataFrame:
    """The first clusters by priority that aren't suppressed."""
    shown = routed.where("decision <> 'suppress'").orderBy(F.desc("priority"), "template_id").limit(limit)
    return shown.select("decision", "service", "level", "count", F.round("p_actionable", 2).alias("p_actionable"), "category", "priority", "template")


def report(metrics: dict) -> str:
    """Evaluation results as text."""
    return "\n".join(f"{name}: {json.dumps(value, default=str, sort_keys=True)}" for name, value in metrics.items())
