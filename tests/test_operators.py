"""Reduction, mining, routing, correlation, evaluation, cache, remote judge, streaming and the scenario end to end."""

import datetime as dt
import json

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from logsift.operators import cache, correlate, evaluate, judge, miner, reduce, remote, route
from logsift.operators.graph import components
from logsift.plans.commits import Committed
from logsift.plans import sinks, triage, views
from logsift.sources.synthetic import synthetic_changes, synthetic_logs

T0 = dt.datetime(2026, 10, 1, 14, 0)
LOG = "seq long, ts timestamp, service string, level string, body string, trace_id string"


def logs(spark, rows):
    return spark.createDataFrame([(i, T0 + dt.timedelta(seconds=s), svc, lvl, body, None) for i, (s, svc, lvl, body) in enumerate(rows)], LOG)


def test_reduce(spark):
    rows = [(i, "auth", "INFO" if i % 2 else "WARN", f"login failed for u{i}@x.org") for i in range(10)] + [(20, "auth", "ERROR", "db down")]
    lines = miner.mine(reduce.prepare(logs(spark, rows)))
    a, b = reduce.ordered(reduce.clusters(lines)).collect()
    assert (a["level"], a["count"], b["count"], b["level"]) == ("ERROR", 1, 10, "WARN")
    assert b["level_counts"] == {"INFO": 5, "WARN": 5} and b["sensitive_hits"] == {"EMAIL": 10}
    assert b["examples"] == ["login failed for <EMAIL>"]
    assert reduce.reduce_stats(lines, reduce.cluster_agg(lines)).first().asDict() == {"lines": 11, "clusters": 2, "scrubbed_lines": 10, "reduction_ratio": 5.5}


def test_windows(spark):
    x = reduce.tumbling(logs(spark, [(s, "a", "INFO", "x") for s in (0, 10, 61, 62, 200)]), 60)
    assert [r["count"] for r in x.groupBy("window_start").count().orderBy("window_start").collect()] == [2, 2, 1]


@pytest.mark.parametrize("exact", [True, False])
def test_mining(spark, exact):
    rows = [(i, "db", "INFO", f"connection to db-{i} failed after {i} retries") for i in range(2)] + [(9, "db", "INFO", "user logged in"), (10, "db", "INFO", "payment declined by issuer"), (11, "db", "INFO", "user signed out")]
    got = {r["template"] for r in miner.mine(reduce.prepare(logs(spark, rows)), exact).collect()}
    assert got == {"connection to db-<NUM> failed after <NUM> retries", "user logged in", "payment declined by issuer", "user signed out"} or "connection to db<NUM> failed after <NUM> retries" in got
    more = [(i, "s", "INFO", f"job alpha step {w} done with code fine") for i, w in enumerate(["one", "two", "three"])]
    assert {r["template"] for r in miner.mine(reduce.prepare(logs(spark, more)), exact).collect()} == {"job alpha step <*> done with code fine"}


def slow_templates(lines, threshold=0.5, most=100):
    """Final template of each token list, by the rule as the documentation words it, one line after the other."""
    nodes, leaf_groups, place = {}, {}, []
    for line in lines:
        way = [len(line)]
        for t in line[:2]:
            seen = nodes.setdefault(tuple(way), [])
            k = "<*>" if t[0] == "<" or any(map(str.isdigit, t)) else t
            if k not in seen and len(seen) < most:
                seen.append(k)
            way.append(k if k in seen else "<*>")
        here = leaf_groups.setdefault(tuple(way), [])
        equal = [sum(x == y and y != "<*>" for x, y in zip(g, line)) for g in here]
        best = equal.index(max(equal)) if equal else None
        if best is None or max(equal) / len(line) < threshold:
            here.append(list(line))
            best = len(here) - 1
        else:
            here[best] = [x if x == y else "<*>" for x, y in zip(here[best], line)]
        place.append((tuple(way), best))
    return [" ".join(leaf_groups[w][i]) for w, i in place]


def random_lines(seed, n=150, words="ab cd ef gh ij kl".split()):
    import random

    rng = random.Random(seed)
    return [" ".join(rng.choice([*words, "7"]) for _ in range(rng.randint(1, 5))) for _ in range(n)]


def test_mining_by_brute_force(spark, seed=1):
    text = random_lines(seed)
    x = reduce.prepare(logs(spark, [(i, "s", "INFO", t) for i, t in enumerate(text)])).select("seq", "service", "tokens")
    tokens = [r["tokens"] for r in x.orderBy("seq").collect()]
    for most in (100, 2):
        got = [r["template"] for r in miner.mine(x, exact=True, most=most).orderBy("seq").collect()]
        assert got == slow_templates(tokens, most=most)
        once = list(dict.fromkeys(map(tuple, tokens)))
        want = dict(zip(once, slow_templates(once, most=most)))
        assert all(r["template"] == want[tuple(r["tokens"])] for r in miner.mine(x, most=most).collect())


def test_batches_are_mined_like_one_run(spark):
    text = random_lines(5)
    rows = [(i, "s", "INFO", t) for i, t in enumerate(text)]
    x = reduce.prepare(logs(spark, rows)).select("seq", "service", "tokens")
    whole = {r["template"] for r in miner.mine(x, exact=True, most=3).collect()}
    _, known = miner.grown(x.where("seq < 70"), exact=True, most=3)
    lines, known = miner.grown(x.where("seq >= 70"), known, exact=True, most=3)
    assert {" ".join(r["tokens"]) for r in known.collect()} == whole
    assert {r["template"] for r in lines.collect()} <= whole


def test_slices_of_a_leaf_give_one_runs_result(spark):
    import random

    rng = random.Random(3)
    text = random_lines(2, 200) + [f"user {rng.choice('abcdef')} opened page {rng.choice('klmnop')} of {rng.choice('uvw')} book" for _ in range(200)]
    x = reduce.prepare(logs(spark, [(i, "s", "INFO", t) for i, t in enumerate(text)])).select("seq", "service", "tokens")
    tokens = [r["tokens"] for r in x.orderBy("seq").collect()]
    for exact, size in ((True, 7), (False, 3)):
        got = [r["template"] for r in miner.mine(x, exact=exact, rows_a_slice=size).orderBy("seq").collect()]
        once = list(dict.fromkeys(map(tuple, tokens)))
        want = slow_templates(tokens) if exact else [dict(zip(once, slow_templates(once)))[tuple(t)] for t in tokens]
        assert got == want
    _, known = miner.grown(x.where("seq < 150"), exact=True, rows_a_slice=7)
    lines, known = miner.grown(x.where("seq >= 150"), known, exact=True, rows_a_slice=11)
    whole = slow_templates(tokens)
    assert {" ".join(r["tokens"]) for r in known.collect()} == set(whole)
    assert [r["template"] for r in lines.orderBy("seq").collect()] == whole[150:]


def test_a_leaf_of_many_distinct_lines(spark):
    """More rows than a slice takes by default, in one leaf, against one run over all of them."""
    n = 60_000
    x = spark.range(n).selectExpr("id AS seq", "'s' AS service", "array('get', 'item', concat('a', id % 211), concat('b', id div 211), concat('c', xxhash64(id) % 40), concat('d', xxhash64(id, 1) % 40)) AS tokens")
    rows = {r["seq"]: r for r in miner.mine(x).select("seq", "tokens", "template").collect()}
    groups = miner.Groups(6, miner.THRESHOLD)
    place = [groups.feed(rows[i]["tokens"])[0] for i in range(n)]
    assert len(rows) == n and all(rows[i]["template"] == " ".join(groups.tokens[place[i]]) for i in range(n))


def test_crowded_nodes_share_the_wildcard(spark):
    rows = [(i, "s", "INFO", f"{a}{b} same tail words") for i, (a, b) in enumerate((x, y) for x in "abcdefghijkl" for y in "abcdefghijkl")]
    x = reduce.prepare(logs(spark, rows))
    one = [f"{a}{b} same tail words".split() for a in "abcdefghijkl" for b in "abcdefghijkl"]
    want = set(slow_templates(one))
    assert {r["template"] for r in miner.mine(x).collect()} == want and len(want) < 144


def routed(spark, cfg=None, **kw):
    base = dict(template_id="t", service="s", template="x", level="INFO", count=100, sensitive_hits={}, p_actionable=0.05, p_benign=0.97, p_novel=0.1, p_sensitive=0.03, expected_severity=0.2, fallback=False)
    base |= kw
    schema = "template_id string, service string, template string, level string, count long, sensitive_hits map<string,bigint>, p_actionable double, p_benign double, p_novel double, p_sensitive double, expected_severity double, fallback boolean"
    return route.route(spark.createDataFrame([Row(**base)], schema), cfg).first()


def test_routing(spark):
    assert routed(spark)["decision"] == "suppress"
    assert routed(spark, count=3)["decision"] == "review" and routed(spark, count=3, template="healthz ok")["decision"] == "suppress"
    for kw in ({"level": "ERROR"}, {"fallback": True}, {"p_sensitive": 0.9}):
        r = routed(spark, **kw)
        assert r["decision"] == "review" and any("would suppress" in x for x in r["reasons"])
    assert routed(spark, fallback=True)["flags"] == ["fallback_answers"]
    assert routed(spark, p_actionable=0.9, p_benign=0.1, expected_severity=3.0)["decision"] == "escalate"
    assert routed(spark, p_actionable=0.9, p_benign=0.1, p_novel=0.8)["reasons"] == ["P(actionable)=0.90, P(novel)=0.80"]
    assert routed(spark, p_actionable=0.9, p_benign=0.1)["decision"] == "triage"
    assert routed(spark, p_actionable=0.55, p_benign=0.1)["decision"] == "review"
    assert routed(spark, p_actionable=0.3, p_benign=0.5)["decision"] == "monitor"
    assert routed(spark, p_benign=None)["decision"] == "review"
    leak = routed(spark, sensitive_hits={"EMAIL": 1, "CARD": 2})
    assert leak["decision"] == "triage" and leak["flags"] == ["scrubbed"] and "CARD" in leak["reasons"][0]
    assert routed(spark, route.RouterConfig(known_issues={"t": "T-1"}))["decision"] == "known_issue"


def test_noisy_or(spark):
    df = spark.createDataFrame([(0.5,), (0.5,)], "p double")
    assert df.agg(route.noisy_or(F.col("p")).alias("x")).first()["x"] == 0.75
    assert df.union(spark.createDataFrame([(1.0,)], "p double")).agg(route.noisy_or(F.col("p")).alias("x")).first()["x"] == 1.0
    assert df.where("p > 1").agg(route.noisy_or(F.col("p")).alias("x")).first()["x"] == 0.0


def metric(spark, pairs):
    return spark.createDataFrame([(bool(y), float(p)) for y, p in pairs], "y boolean, p double")


def test_metrics(spark):
    r = evaluate.binary_metrics(metric(spark, [(1, 0.9), (1, 0.4), (0, 0.6), (0, 0.1)])).first()
    assert (r["tp"], r["fp"], r["fn"], r["tn"], r["precision"], r["recall"]) == (1, 1, 1, 1, 0.5, 0.5)
    flat = metric(spark, [(i < 3, 0.3) for i in range(10)])
    assert evaluate.ece(flat).first()["ece"] == 0 and [tuple(x) for x in evaluate.reliability(flat).collect()] == [(3, 10, 0.3, 0.3)]
    assert evaluate.ece(metric(spark, [(i % 2, 0.99) for i in range(100)])).first()["ece"] > 0.45
    assert evaluate.binary_metrics(metric(spark, [(1, 1), (0, 0)])).first()["brier"] == 0
    assert evaluate.best_threshold(metric(spark, [(1, 0.95), (1, 0.9), (0, 0.85), (1, 0.6), (0, 0.2)]), 1.0).first()["threshold"] == 0.9
    assert evaluate.best_threshold(metric(spark, [(0, 0.9)]), 0.5).first()["threshold"] is None
    v = spark.createDataFrame([(float(i),) for i in (5, 1, 4, 2, 3)], "v double")
    assert {r["percent"]: r["value"] for r in evaluate.nearest_rank(v, "v", [0, 50, 95, 100]).collect()} == {0: 1, 50: 3, 95: 5, 100: 5}
    assert [r["value"] for r in evaluate.nearest_rank(v.where("v > 9"), "v", [50]).collect()] == [0]


def test_components(spark):
    nodes = spark.createDataFrame([(x,) for x in "abcdefg"], "node string")
    edges = spark.createDataFrame([("b", "a"), ("c", "b"), ("d", "c"), ("f", "g")], "a string, b string")
    assert {r["node"]: r["component"] for r in components(nodes, edges).collect()} == dict(a="a", b="a", c="a", d="a", e="e", f="f", g="f")


def test_cache(spark):
    kind = "subject_id string, model_version string, question_fp string, answer string, created_at timestamp, source string"
    have = spark.createDataFrame([("a", "m", "q", "old", T0, "remote")], kind)
    asked = spark.createDataFrame([("a", "m", "q"), ("b", "m", "q"), ("a", "m2", "q")], "subject_id string, model_version string, question_fp string")
    assert [(r["subject_id"], r["source"]) for r in cache.hits(asked, have).collect()] == [("a", "cache")]
    assert cache.misses(asked, have).count() == 2
    new = spark.createDataFrame([("a", "m", "q", "new", T0 + dt.timedelta(days=1), "remote"), ("b", "m", "q", "x", T0, "fallback")], kind)
    assert [r["answer"] for r in cache.upsert(have, new).collect()] == ["new"]
    assert cache.fresh(have, T0 + dt.timedelta(days=31), 30).count() == 0 and cache.fresh(have, T0 + dt.timedelta(days=29), 30).count() == 1
    assert cache.fingerprint("k", {"a": 1, "b": 2}) == cache.fingerprint("k", {"b": 2, "a": 1})


def flaky_judge():
    seen: dict = {}

    def transport(request):
        s = request["state"]["n"]
        seen[s] = seen.get(s, 0) + 1
        if s == 1:
            return 400, "bad"
        if s == 2 and seen[s] < 3:
            return 503, "busy"
        return 200, json.dumps({"answers": {"benign": {"value": 0.83}, "category": {"probabilities": {"timeout": 0.7, "auth": 0.3}}, "severity": {"value": 2, "probabilities": {"1": 0.4, "2": 0.6}}}, "usage": {"input_tokens": 321}})

    kinds = [{"key": k, "payload": {"type": t}} for k, t in (("benign", "noul"), ("category", "choice"), ("severity", "score"))]
    return remote.http_judge(transport, "m", kinds)


def test_remote_judge(spark):
    subjects = spark.createDataFrame([(str(n), json.dumps({"n": n})) for n in (0, 1, 2, 2)], "subject_id string, state string")
    calls = remote.ask_all(subjects, flaky_judge, concurrency=2, rpm=1e9, base_s=0.0).collect()
    assert {r["subject_id"]: (r["attempts"], r["error"] is None) for r in calls} == {"0": (1, True), "1": (1, False), "2": (3, True)}
    frame = spark.createDataFrame(calls, remote.CALLS)
    assert [r["subject_id"] for r in remote.dead_letters(frame).collect()] == ["1"]
    got = {(r["subject_id"], r["key"]): r["value"] for r in remote.long_answers(frame, "remote").collect()}
    assert got["0", "category"] == "timeout" and got["0", "severity"] == "2" and float(got["0", "benign"]) == 0.83
    assert remote.call_stats(frame).first()["input_tokens"] == 642
    assert [remote.status_error(s).retryable for s in (429, 503, 400, 401)] == [True, True, False, False]


def test_rate_limit():
    now = [0.0]
    bucket = remote.TokenBucket(60, lambda: now[0], lambda s: now.__setitem__(0, now[0] + s))
    for _ in range(5):
        bucket.take()
    assert 3.9 <= now[0] <= 4.1


@pytest.fixture(scope="module")
def scenario(spark):
    cfg = triage.Config(topology={"front": ["basket"], "basket": ["ledger", "stock"]})
    return triage.run(synthetic_logs(spark, minutes=90), synthetic_changes(spark), cfg, "r1")


def test_scenario(spark, scenario):
    rows = {r["template"]: r for r in scenario.routed.collect()}
    assert len(rows) < 30 and sum(r["count"] for r in rows.values()) > 1000
    pool = next(r for t, r in rows.items() if t.startswith("connection pool exhausted"))
    assert pool["decision"] == "escalate" and next(r for t, r in rows.items() if "healthz" in t)["decision"] == "suppress"
    assert not any(r["decision"] == "suppress" and r["level"] in ("ERROR", "FATAL") for r in rows.values())
    top = scenario.incidents.orderBy(F.desc("priority")).first()
    assert len(top["services"]) >= 2
    first = scenario.root_causes.where(F.col("incident_id") == top["incident_id"]).orderBy(F.desc("score")).first()
    assert "pool exhausted" in first["template"]
    link = scenario.links.where(F.col("incident_id") == top["incident_id"]).orderBy(F.desc("p_related")).first()
    assert "four slots" in link["summary"]
    story = {r["incident_id"]: r["narrative"] for r in scenario.narratives.collect()}[top["incident_id"]]
    assert story.startswith("### inc-") and "Probable start: connection pool exhausted" in story and "Change that fits: connection pool of the ledger lowered to four slots on ledger" in story and "Explanations to check:\n1. " in story


def test_sinks(spark, scenario, tmp_path):
    sinks.write_files(scenario, str(tmp_path))
    assert spark.read.json(f"{tmp_path}/r1/routing_decisions").count() == scenario.routed.count()
    names = views.create_tables(spark, "triage_test")
    sinks.write_tables(scenario, "triage_test")
    assert spark.table("triage_test.template_labels").count() == scenario.routed.count() and "incidents" in names
    payload = sinks.otlp_payloads(scenario.lines.select("seq", "ts", "service", "level", "body", "trace_id").limit(50)).first()["payload"]
    assert json.loads(payload)["resourceLogs"][0]["scopeLogs"][0]["logRecords"]


def test_stream_equals_batch(spark, scenario, tmp_path):
    from logsift.streaming import worker

    source = synthetic_logs(spark, minutes=90, scale=0.05)
    source.coalesce(1).write.parquet(str(tmp_path / "in"))
    x = worker.log_stream(spark, str(tmp_path / "in"), source.schema)
    for _ in range(2):  # the second start finds nothing new
        worker.start(x, str(tmp_path / "out"), str(tmp_path / "state"), triage.Config(mining="none"), once=True).awaitTermination()
    got = Committed(spark, str(tmp_path / "out")).read("routing_decisions")
    want = triage.run(spark.read.parquet(str(tmp_path / "in")), config=triage.Config(mining="none")).routed
    key = lambda df: sorted((r["template_id"], r["decision"], r["count"]) for r in df.select("template_id", "decision", "count").collect())
    assert key(got) == key(want)


def test_candidate_pairs_equal_all_pairs(spark):
    rows = [(f"t{i}", "ab"[i % 2], f"x{i}", T0 + dt.timedelta(seconds=37 * i), float(i % 5), ["q"]) for i in range(60)]
    df = spark.createDataFrame(rows, "template_id string, service string, template string, first_seen timestamp, priority double, trace_ids array<string>")
    got = {(r["a_template_id"], r["b_template_id"]) for r in correlate.candidate_pairs(df, limit=None).collect()}
    assert got == {(a[0], b[0]) for a in rows for b in rows if a[3] < b[3] and (b[3] - a[3]).total_seconds() <= 600}


def test_judge_ranges(spark, scenario):
    r = scenario.judged.first()
    assert all(0.01 <= r[f"p_{k}"] <= 0.99 for k in judge.NOULS)
    assert judge.judgments(scenario.judged).count() == 9 * scenario.clusters.count()


YAML = """
judge: {backend: typesafe, model: m-1, endpoint: https://x.example, fallback: heuristic, concurrency: 4, max_retries: 0, rpm: 100000, timeout_s: 30}
cache: {path: c, ttl_days: 30}
reduce: {sim_threshold: 0.5, redact_ips: false}
router: {suppress_min_count: 20, noise_allowlist: [health, heartbeat], never_suppress_levels: [ERROR, FATAL]}
known_issues: {}
runbooks: {rb_login: login failed for a user}
correlate: {enabled: true, max_gap_s: 600, topology: {a: [b]}}
narrate: {kind: template, top_k: 2}
pricing: {usd_per_m_input: 0.042, billing: per_question}
sink: {kind: jsonl, out_dir: out, clickhouse_database: db}
"""


def test_config_of_sections():
    import yaml

    cfg = triage.Config.of(yaml.safe_load(YAML))
    assert (cfg.backend, cfg.model, cfg.concurrency, cfg.top_k, cfg.topology) == ("remote", "m-1", 4, 2, {"a": ["b"]})
    assert cfg.router.noise_allowlist == ("health", "heartbeat") and cfg.router.sensitive_flag_min == 0.5 and cfg.runbooks == {"rb_login": "login failed for a user"}
    assert triage.Config.of({"top_k": 9, "known_issues": {"t": "T-1"}}).router.known_issues == {"t": "T-1"}
    assert triage.Config.of({"correlate": {"max_pairs": None}}).max_pairs is None and triage.Config().max_pairs == 2000
    for bad in ({"odd": 1}, {"judge": {"odd": 1}}, {"router": {"odd": 1}}):
        with pytest.raises(ValueError):
            triage.Config.of(bad)


def half_judge():
    """Answers states that name service a, fails for others."""

    def ask(state):
        if json.loads(state)["service"] != "a":
            raise remote.status_error(400, "no")
        answers = [{"key": k, "type": "noul", "value": 0.02 if k == "actionable" else 0.98, "probabilities": {"yes": 0.5, "no": 0.5}, "confidence": None} for k in judge.NOULS if k != "sensitive"]
        answers.append({"key": "sensitive", "type": "noul", "value": 0.01, "probabilities": {}, "confidence": None})
        answers += [{"key": k, "type": "choice", "value": "x", "probabilities": {"x": 0.75, "y": 0.25}, "confidence": 0.5} for k in ("category", "component")]
        answers += [{"key": k, "type": "score", "value": 1, "probabilities": {"1": 1.0}, "confidence": 1.0} for k in ("severity", "user_impact")]
        return answers, 100

    return ask


def test_remote_judge_cache_and_fallback_in_a_run(spark):
    rows = [(i, s, "INFO", f"request completed in {i} ms" if s == "a" else "heartbeat ok") for s in "ab" for i in range(30)]
    cfg = triage.Config.of({"judge": {"backend": "remote", "concurrency": 2, "max_retries": 0, "rpm": 1e9}, "reduce": {"mining": "none"}})
    first = triage.run(logs(spark, rows), config=cfg, ask=half_judge)
    by = {r["service"]: r for r in first.routed.collect()}
    assert by["a"]["decision"] == "suppress" and by["a"]["category"] == "x" and by["a"]["expected_severity"] == 1.0 and not by["a"]["fallback"]
    assert by["b"]["fallback"] and by["b"]["flags"] == ["fallback_answers"] and by["b"]["decision"] != "suppress"
    assert [r["attempts"] for r in first.dead_letters.collect()] == [1]
    s = first.judge_stats.first()
    assert (s["requests"], s["dead_letters"], s["fallbacks"], s["hit_rate"], s["input_tokens"]) == (2, 1, 1, 0.0, 100) and s["p95_ms"] >= s["p50_ms"] > 0
    again = triage.run(logs(spark, rows), config=cfg, ask=half_judge, cache=first.cache)
    s = again.judge_stats.first()
    assert (s["requests"], s["cache_hits"], s["hit_rate"]) == (1, 1, 0.5) and {r["service"]: r["decision"] for r in again.routed.collect()}["a"] == "suppress"
    assert first.cache.count() == 9
    none = triage.Config.of({"judge": {"backend": "remote", "fallback": None, "max_retries": 0, "rpm": 1e9}, "reduce": {"mining": "none"}})
    lost = {r["service"]: r for r in triage.run(logs(spark, rows), config=none, ask=half_judge).routed.collect()}["b"]
    assert lost["decision"] == "review" and lost["reasons"] == ["missing core answers (actionable/benign)"]


def test_runbooks_in_a_run(spark):
    rows = [(i, "a", "WARN", f"login failed for user {i}") for i in range(5)]
    cfg = triage.Config.of({"runbooks": {"rb_login": "login failed user"}, "reduce": {"mining": "none"}})
    r = triage.run(logs(spark, rows), config=cfg).routed.first()
    assert r["decision"] == "known_issue" and r["reasons"][-1].startswith("runbook rb_login")


def test_generic_answers(spark):
    one = spark.range(1).select(judge.generic("noul", F.lit("x")).alias("n"), judge.generic("score", F.lit("x"), [1, 2, 3, 4]).alias("s"), judge.generic("choice", F.lit("disk full"), {"a": "the disk is full", "b": "login"}).alias("c")).first()
    assert one["n"] == 0.5 and [(e["name"], e["p"]) for e in one["s"]] == [(str(i), 0.25) for i in range(4)] and one["c"][0]["p"] > 0.5


def test_tables_are_rewritten_by_run(spark, scenario):
    views.create_tables(spark, "triage_twice")
    for _ in range(2):
        sinks.write_tables(scenario, "triage_twice")
    assert spark.table("triage_twice.routing_decisions").count() == scenario.routed.count()


def test_pair_state(spark):
    rows = [(f"t{i}", "a", f"x{i}", T0 + dt.timedelta(seconds=i), 1.0, ["q"]) for i in range(2)]
    df = spark.createDataFrame(rows, "template_id string, service string, template string, first_seen timestamp, priority double, trace_ids array<string>")
    r = correlate.pair_state(correlate.candidate_pairs(df)).first()
    assert r["subject_id"] == "t0|t1" and json.loads(r["state"])["shared_trace"] is True and json.loads(r["state"])["gap_s"] == 1.0


def test_groups_go_from_batch_to_batch(spark, tmp_path):
    from logsift.streaming import worker

    text = ["job alpha step one done with code fine", "job alpha step two done with code fine"]
    frame = logs(spark, [(i, "s", "INFO", t) for i, t in enumerate(text)])
    for i in range(2):
        frame.where(f"seq = {i}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        x = worker.log_stream(spark, str(tmp_path / "in"), frame.schema)
        worker.start(x, str(tmp_path / "out"), str(tmp_path / "state"), once=True).awaitTermination()
    got = {r["template"] for r in Committed(spark, str(tmp_path / "out")).read("log_clusters").collect()}
    assert got == {text[0], "job alpha step <*> done with code fine"}


@pytest.mark.parametrize("threshold", [0.0, 0.35, 0.42, 0.5, 0.7])
def test_change_links_equal_all_pairs(spark, threshold):
    import random

    rng = random.Random(4)
    words = "deploy release gateway pool config cache timeout orders".split()
    text = lambda: " ".join(rng.sample(words, rng.randint(1, 6)))
    at = lambda: T0 + dt.timedelta(seconds=rng.randint(0, 9000))
    found = [(f"i{k % 7}", f"t{k}", rng.choice(["a", "b", None]), text(), at(), float(rng.randint(0, 3))) for k in range(70)]
    made = [(rng.choice([f"c{k}", ""]), at(), rng.choice(["a", "b", "c", None]), text()) for k in range(40)]
    want = {}
    for i, t, s, template, seen, p in found:
        for c, ts, cs, summary in made:
            d = (seen - ts).total_seconds()
            if 0 <= d <= 3600:
                n = len(set(template.split()) & set(summary.split()))
                minutes = round(d / 60 + 1e-9, 1)
                score = round(min(0.99, max(0.01, 0.08 + (0.45 if s and s == cs else 0) + (0.25 if minutes <= 30 else 0.1) + min(0.2, 0.07 * n))), 4)
                key, row = (i, c or summary), (-score, -p, t, ts)
                if score >= threshold:
                    want[key] = min(want.get(key, row), row)
    m = spark.createDataFrame(found, "incident_id string, template_id string, service string, template string, first_seen timestamp, priority double")
    c = spark.createDataFrame(made, "change_id string, ts timestamp, service string, summary string")
    got = {(r["incident_id"], r["change_key"]): (-r["p_related"], r["template_id"]) for r in correlate.change_links(m, c, threshold=threshold).collect()}
    assert got == {k: (v[0], v[2]) for k, v in want.items()}


def test_lines_are_masked_once(spark):
    plan = reduce.with_templates(reduce.prepare(logs(spark, [(0, "a", "INFO", "x")])))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<UUID>") == 1


@pytest.mark.parametrize("most", [reduce.BOUNDED, 0])
def test_first_texts_and_traces_by_brute_force(spark, monkeypatch, most, seed=3):
    import random

    monkeypatch.setattr(reduce, "BOUNDED", most)
    r = random.Random(seed)
    value = lambda n: r.choice([None, ""] + [f"v{r.randrange(n)}" for _ in range(8)])
    rows = [(f"t{i % 5}", "s", "x", 2, T0, r.randrange(400), "INFO", value((1, 2, 4, 40, 4000)[i % 5]), value((4000, 40, 4, 2, 1)[i % 5]), {}) for i in range(1500)]
    lines = spark.createDataFrame(rows, "template_id string, service string, template string, rank int, ts timestamp, seq long, level string, scrubbed string, trace_id string, hits map<string,bigint>")

    def first(key, at, n):
        seen = {}
        for row in rows:
            if row[0] == key and row[at]:
                seen[row[at]] = min(row[5], seen.get(row[at], row[5]))
        return sorted(seen, key=lambda v: (seen[v], v))[:n]

    got = {c["template_id"]: (c["examples"], c["trace_ids"], c["count"], c["level_counts"]) for c in reduce.clusters(lines).collect()}
    assert got == {k: (first(k, 7, 3), first(k, 8, 5), 300, {"INFO": 300}) for k in ("t0", "t1", "t2", "t3", "t4")}
    bounds = {b["template_id"]: (b["_text"], b["_trace"]) for b in reduce._bounds(lines, ["template_id"]).collect()}
    assert bounds["t0"][0] is None and 0 <= bounds["t0"][1] < 40 and 0 <= bounds["t4"][0] < 40 and bounds["t4"][1] is None


def test_lines_without_text_trace_or_hit_are_summed_but_not_exploded(spark, monkeypatch):
    rows = [("t", "s", "x", i % 6, T0 + dt.timedelta(seconds=i), i, ("info", "WARN", None)[i % 3], "a" if i < 2 else None, "", {"EMAIL": 2} if i == 5 else {}) for i in range(60)]
    lines = spark.createDataFrame(rows, "template_id string, service string, template string, rank int, ts timestamp, seq long, level string, scrubbed string, trace_id string, hits map<string,bigint>")
    exploded = []
    explode = F.explode
    monkeypatch.setattr(reduce.F, "explode", lambda c: exploded.append(str(c)) or explode(c))
    r, = reduce.clusters(lines).collect()
    assert not any("level" in e for e in exploded)
    assert (r["count"], r["first_seq"], r["first_seen"], r["last_seen"]) == (60, 0, T0, T0 + dt.timedelta(seconds=59))
    assert (r["examples"], r["trace_ids"], r["sensitive_hits"], sum(r["level_counts"].values())) == (["a"], [], {"EMAIL": 2}, 60)
    none, = reduce.clusters(lines.where("seq > 5")).collect()
    assert (none["count"], none["examples"], none["sensitive_hits"], none["first_seq"]) == (54, [], {}, 6)
