"""The relations of a run as tables, their DDL, and the analytics over them as Spark SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of the stored relations.
DDL = {
    "log_clusters": "run_id STRING, window_start TIMESTAMP, window_end TIMESTAMP, template_id STRING, service STRING, template STRING, level STRING, count BIGINT, first_seen TIMESTAMP, last_seen TIMESTAMP, examples ARRAY<STRING>, trace_ids ARRAY<STRING>, level_counts MAP<STRING,BIGINT>, sensitive_hits MAP<STRING,BIGINT>",
    "cluster_judgments": "run_id STRING, judged_at TIMESTAMP, template_id STRING, model_version STRING, question_key STRING, question_type STRING, value STRING, p_yes DOUBLE, probabilities MAP<STRING,DOUBLE>, confidence DOUBLE, source STRING",
    "routing_decisions": "run_id STRING, window_start TIMESTAMP, template_id STRING, service STRING, level STRING, count BIGINT, decision STRING, reasons ARRAY<STRING>, flags ARRAY<STRING>, priority DOUBLE, category STRING, component STRING, expected_severity DOUBLE, expected_user_impact DOUBLE, p_actionable DOUBLE, p_benign DOUBLE, p_root_cause DOUBLE, p_novel DOUBLE, p_sensitive DOUBLE",
    "incidents": "run_id STRING, incident_id STRING, start TIMESTAMP, end TIMESTAMP, services ARRAY<STRING>, template_ids ARRAY<STRING>, lines BIGINT, priority DOUBLE, root_cause_template_id STRING, linked_changes ARRAY<STRING>, top_hypothesis STRING, narrative STRING",
}
#: The time column that a table is partitioned by the date of; rows older than TTL_DAYS are dropped by partition.
PARTITION = {"log_clusters": "window_start", "cluster_judgments": "judged_at", "routing_decisions": "window_start"}
TTL_DAYS = 90


def create_tables(spark: SparkSession, database: str = "triage") -> list[str]:
    """Creates the database, its tables and the view; returns their names."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, columns in DDL.items():
        part = ", day DATE) USING parquet PARTITIONED BY (day, run_id)" if name in PARTITION else ") USING parquet PARTITIONED BY (run_id)"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}{part}")
    spark.sql(f"CREATE OR REPLACE VIEW {database}.template_labels AS {SQL['template_labels'].replace('{decisions}', f'{database}.routing_decisions')}")
    return [*DDL, "template_labels"]


def expired(table: DataFrame, today, days: int = TTL_DAYS) -> DataFrame:
    """Days whose partitions are past their time to live."""
    return table.select("day").distinct().where(F.col("day") < F.date_sub(F.lit(today), days))


#: Analytics. {decisions}, {judgments}, {clusters}, {incidents}, {logs} are relations; {from}, {to} bound the time.
SQL = {
    "template_labels": """
        SELECT template_id, max_by(service, o) AS service, max_by(decision, o) AS decision, max_by(category, o) AS category,
          max_by(component, o) AS component, max_by(expected_severity, o) AS expected_severity, max_by(p_actionable, o) AS p_actionable,
          max_by(p_benign, o) AS p_benign, max(window_start) AS last_judged
        FROM (SELECT *, struct(window_start, run_id) AS o FROM {decisions}) GROUP BY template_id""",
    "triage_view": """
        SELECT decision, service, category, sum(count) AS lines, max(p_actionable) AS p_act, min(template_id) AS template_id
        FROM {decisions} WHERE window_start > {from} AND decision IN ('escalate', 'triage', 'review')
        GROUP BY decision, service, category, template_id ORDER BY max(priority) DESC, template_id""",
    "reduction_per_day": """
        SELECT to_date(window_start) AS day, count(*) / greatest(count_if(decision IN ('escalate', 'triage')), 1) AS clusters_per_surfaced
        FROM {decisions} GROUP BY 1 ORDER BY 1""",
    "fallback_share": """
        SELECT model_version, count_if(source = 'fallback') / count(*) AS fallback_share, count(*) AS answers FROM {judgments} GROUP BY model_version""",
    "drillback_traces": """
        SELECT l.ts, l.service, l.body FROM {logs} l LEFT SEMI JOIN
          (SELECT explode(trace_ids) AS trace_id FROM {clusters} WHERE template_id = {template_id}) t ON l.trace_id = t.trace_id
        ORDER BY l.ts, l.seq LIMIT 200""",
    "suppressed_lines": "SELECT coalesce(sum(count), 0) AS lines FROM {decisions} WHERE decision = 'suppress' AND window_start BETWEEN {from} AND {to}",
    "escalated_count": "SELECT count(*) AS n FROM {decisions} WHERE decision = 'escalate' AND window_start BETWEEN {from} AND {to}",
    "fallback_rate": "SELECT count_if(source = 'fallback') / greatest(count(*), 1) AS rate FROM {judgments} WHERE judged_at BETWEEN {from} AND {to}",
    "incident_count": "SELECT count(*) AS n FROM {incidents} WHERE start BETWEEN {from} AND {to}",
    "decision_timeseries": """
        SELECT window(CAST(window_start AS TIMESTAMP), '{interval}').start AS time, decision, sum(count) AS lines
        FROM {decisions} WHERE window_start BETWEEN {from} AND {to} GROUP BY 1, decision ORDER BY time, decision""",
    "lines_by_category": """
        SELECT coalesce(category, 'unknown') AS category, sum(count) AS lines FROM {decisions}
        WHERE decision IN ('escalate', 'triage', 'review') AND window_start BETWEEN {from} AND {to} GROUP BY 1 ORDER BY lines DESC, category""",
    "triage_board": """
        SELECT d.decision, d.service, d.level, sum(d.count) AS lines, min(d.category) AS category, round(avg(d.expected_severity), 1) AS severity,
          round(max(d.p_actionable), 2) AS p_actionable, min(c.template) AS template, min(array_join(d.flags, ',')) AS flags
        FROM {decisions} d LEFT JOIN {clusters} c ON c.template_id = d.template_id AND c.run_id = d.run_id
        WHERE d.decision <> 'suppress' AND d.window_start BETWEEN {from} AND {to}
        GROUP BY d.decision, d.service, d.level, d.template_id ORDER BY max(d.priority) DESC, d.template_id LIMIT 100""",
    "incident_list": """
        SELECT start, incident_id, array_join(services, ',') AS services, lines, array_join(linked_changes, ',') AS linked_changes, top_hypothesis
        FROM {incidents} WHERE start BETWEEN {from} AND {to} ORDER BY priority DESC, incident_id LIMIT 50""",
}


def analytics(spark: SparkSession, name: str, start: str = "TIMESTAMP_NTZ'1970-01-01 00:00:00'", end: str = "TIMESTAMP_NTZ'9999-12-31 00:00:00'", interval: str = "1 hour", template_id: str = "''", **frames: DataFrame) -> DataFrame:
    """The named query over frames (decisions=, judgments=, clusters=, incidents=, logs=). Bounds are SQL literals."""
    text = SQL[name].replace("{from}", start).replace("{to}", end).replace("{interval}", interval).replace("{template_id}", template_id)
    return spark.sql(text, **frames)
