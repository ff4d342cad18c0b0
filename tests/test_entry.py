"""The driver's contract: names, and queries against DuckDB on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry

ORACLE, QUERIES = entry.oracle_sql(), entry.queries()

TABLES = "/root/testdata/sf0.001"
CHOSEN = ["scan_jsonl", "cluster_agg", "first_examples", "keyword_features", "p_nouls", "expected_severity", "route_flags", "window_summary", "incident_rollup", "change_best_link", "reliability", "triage_board", "best_threshold", "cluster_order", "drain_sliced", "late_rows", "stream_changes"]


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(ORACLE) <= set(QUERIES)


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no tables")
@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_duckdb(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in os.listdir(TABLES):
        con.sql(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{TABLES}/{t}'")
    a, b = QUERIES[name](spark, TABLES).toPandas(), con.sql(ORACLE[name]).df()
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    row = lambda df: sorted(tuple(round(float(v), 9) if isinstance(v, float) else str(v) for v in r) for r in df[cols].itertuples(index=False))
    assert row(a) == row(b)


def test_window_scan_and_cluster_order_keep_all_rows(spark):
    source = "/root/testdata/sf0.01"
    if not os.path.isdir(source):
        pytest.skip("no tables")
    week = spark.read.parquet(f"{source}/events.parquet").where("ts >= TIMESTAMP_NTZ'2024-01-02 00:00:00' AND ts < TIMESTAMP_NTZ'2024-01-09 00:00:00'")
    want = sorted((r["ts"], r["event_id"]) for r in week.collect())
    assert len(want) > 2000 and [(r["ts"], r["event_id"]) for r in QUERIES["window_scan"](spark, source).collect()] == want
    ids = {r["template_id"] for r in QUERIES["cluster_agg"](spark, source).select("template_id").collect()}
    found = [r["template_id"] for r in QUERIES["cluster_order"](spark, source).collect()]
    assert len(found) == len(ids) > 10 and set(found) == ids


def test_entry(spark):
    if os.path.isdir(TABLES):
        assert entry.entry(spark).limit(1).count() == 1
