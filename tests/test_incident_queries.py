"""Queries over incidents, on bursts of clusters that have more candidate pairs than the 2,000 which were once kept."""

import datetime as dt
import hashlib

import pytest

from logsift.plans import queries as q

T0 = dt.datetime(2026, 10, 1, 14, 0)
BURSTS, SIZE, LARGE = 60, 9, 20  # 36 pairs a burst; the large one, of low priorities, would come last
TEXT, SUMMARY = "error first seen on host", "deploy after first error"


def burst(b):
    """Ids of a burst's clusters: one incident, as they share words and all come within 120 s, on adjacent services."""
    return [f"t{b:02d}-{k:02d}" for k in range(LARGE if b == BURSTS else SIZE)]


def incident(b):
    return "inc-" + hashlib.sha1("".join(burst(b)).encode()).hexdigest()[:10]


def begun(b):
    return T0 + dt.timedelta(hours=2 * b)


@pytest.fixture
def bursts(spark, monkeypatch):
    rows = []
    for b in range(BURSTS + 1):
        for k, t in enumerate(burst(b)):
            at = begun(b) + dt.timedelta(seconds=k)
            rows.append((t, ("edge", "cart")[k % 2], TEXT, "ERROR", 1, at, at, 0.5 if b == BURSTS else 1.0, "triage", [f"trace-{t}"], 0.5, "none"))
    found = spark.createDataFrame(rows, "template_id string, service string, template string, level string, count long, first_seen timestamp, last_seen timestamp, priority double, decision string, trace_ids array<string>, p_root_cause double, category string")
    made = [(f"c{b}", begun(b) - dt.timedelta(seconds=60), "edge", SUMMARY) for b in range(BURSTS + 1)]
    changes = spark.createDataFrame(made, "change_id string, ts timestamp, service string, summary string")
    monkeypatch.setattr(q, "routed", lambda spark, d: found)
    monkeypatch.setattr(q, "changes", lambda spark, d: changes)


def test_best_links_of_all_bursts(spark, bursts):
    got = sorted(tuple(r) for r in q.change_best_link(spark, "").collect())
    # 0.08, the own service, half an hour, two shared words; of equals the smallest id
    assert got == sorted((incident(b), f"c{b}", burst(b)[0], 0.92) for b in range(BURSTS + 1))


def test_changes_near_all_bursts(spark, bursts):
    assert sorted(tuple(r) for r in q.change_interval_join(spark, "").collect()) == sorted((incident(b), 1) for b in range(BURSTS + 1))


def test_list_of_incidents_of_all_bursts(spark, bursts):
    others = sorted(incident(b) for b in range(BURSTS))
    want = [(incident(BURSTS), "cart,edge", LARGE), *[(i, "cart,edge", SIZE) for i in others]][:50]
    assert [tuple(r) for r in q.incident_list(spark, "").collect()] == want


def test_timeline_of_all_bursts(spark, bursts):
    want = []
    for b in range(BURSTS + 1):
        want.append((incident(b), begun(b) - dt.timedelta(seconds=60), f"[edge] change: {SUMMARY}", "change"))
        want += [(incident(b), begun(b) + dt.timedelta(seconds=k), f"[{('edge', 'cart')[k % 2]}] ERROR: {TEXT}", "log") for k in range(len(burst(b)))]
    assert sorted(tuple(r) for r in q.timeline(spark, "").select("incident_id", "ts", "label", "kind").collect()) == sorted(want)


def test_top_incidents_of_all_bursts(spark, bursts):
    others = sorted(incident(b) for b in range(BURSTS))
    assert [tuple(r) for r in q.topk_incidents(spark, "").collect()] == [(incident(BURSTS), LARGE), *[(i, SIZE) for i in others[:2]]]
