"""Commits, and streams that keep state, late rows and changes."""

import datetime as dt
import json
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from logsift import cli
from logsift.operators import judge, miner, remote
from logsift.operators.reduce import prepare, with_templates
from logsift.plans import sinks, triage
from logsift.plans.commits import FAN, Committed
from logsift.streaming import worker

T0 = dt.datetime(2024, 1, 1)
LOGS = "seq long, ts timestamp, service string, level string, body string, trace_id string"


def logs(spark, rows):
    """rows: seq, seconds after T0, service, body."""
    return spark.createDataFrame([(i, T0 + dt.timedelta(seconds=s), svc, "INFO", body, None) for i, s, svc, body in rows], LOGS)


def feed(spark, folder, rows):
    logs(spark, rows).coalesce(1).write.mode("append").parquet(str(folder))


def test_commits(spark, tmp_path):
    store = Committed(spark, str(tmp_path))
    assert store.read("a") is None and store.read("a", "x long").count() == 0
    one = lambda *xs: spark.createDataFrame([(x,) for x in xs], "x long")
    values = lambda n: sorted(r["x"] for r in store.read(n).collect())
    assert store.commit("r1", {"a": one(1, 2), "b": one(3)}, facts={"k": 5})
    at = store.snapshot()
    store.commit("r1", {"a": one(7)})  # the same run again
    assert values("a") == [7] and values("b") == [3] and store.snapshot()["facts"] == {"k": 5}
    assert sorted(r["x"] for r in store.read("a", at=at).collect()) == [1, 2]
    broken = one(1).select(F.raise_error(F.lit("dead")).cast("long").alias("x"))
    with pytest.raises(Exception):  # dies between its two tables
        store.commit("r2", {"a": one(9), "b": broken})
    assert values("a") == [7] and values("b") == [3]
    assert store.commit("b0", {"a": one(8)}, batch=0) and not store.commit("b0", {"a": one(8)}, batch=0) and values("a") == [7, 8]
    for i in range(FAN):
        store.commit(f"c{i}", {"c": one(i % 3)})
    assert store.compact("c", lambda x: x.distinct()) and values("c") == [0, 1, 2] and not store.compact("c", lambda x: x)
    assert store.clean(1) >= FAN and values("c") == [0, 1, 2] and values("a") == [7, 8]
    other = Committed(spark, str(tmp_path))
    old = other.snapshot()
    store.commit("x", {"a": one(4)})
    with pytest.raises(Exception):  # another writer was faster
        other._publish(old, {}, -1, {})
    assert values("a") == [4, 7, 8]


def run_stream(spark, t, **kw):
    x = worker.log_stream(spark, f"{t}/in", LOGS, files_per_trigger=1)
    worker.start(x, f"{t}/out", f"{t}/state", once=True, **kw).awaitTermination()


def test_groups_are_kept_by_bucket_and_change(spark, tmp_path):
    words = "one two three four five six".split()
    feed(spark, tmp_path / "in", [(i, i, "s", f"job alpha step {w} done with code fine") for i, w in enumerate(words)] + [(10 + i, i, f"t{i}", "cache was flushed " + "x " * i) for i in range(40)])
    run_stream(spark, tmp_path)
    size = lambda: [sum(f.stat().st_size for f in d.rglob("*.parquet")) for d in sorted((tmp_path / "out/groups").iterdir(), key=lambda p: p.name)]
    first = sum(size())
    feed(spark, tmp_path / "in", [(100, 9, "s", "job alpha step seven done with code fine"), (101, 9, "s", "job alpha run seven done with code fine")])
    run_stream(spark, tmp_path)
    store = Committed(spark, str(tmp_path / "out"))
    second = [r.asDict() for r in store.read("groups").where("batch = 1").collect()]
    assert [(r["service"], " ".join(r["tokens"])) for r in second] == [("s", "job alpha <*> <*> done with code fine")]
    assert sum(size()) - first < first / 4
    last = worker.latest(store.read("groups", worker.STATE))
    both = logs(spark, []).unionByName(spark.read.parquet(str(tmp_path / "in")))
    want = miner.grown(prepare(both))[1]
    key = lambda df: sorted((r["service"], r["n_tokens"], " ".join(r["tokens"])) for r in df.collect())
    assert key(last) == key(want)
    before = key(store.read("log_clusters").select("service", F.size(F.split("template", " ")).alias("n_tokens"), F.split("template", " ").alias("tokens")))
    run_stream(spark, tmp_path)  # nothing new
    store.commit("batch-00000001", {"log_clusters": store.read("log_clusters").limit(0)}, 1)  # a batch that is tried again
    assert before == key(store.read("log_clusters").select("service", F.size(F.split("template", " ")).alias("n_tokens"), F.split("template", " ").alias("tokens")))


def test_late_rows(spark, tmp_path):
    """Rows before, on and after the watermark: windows of a minute, a lag of 15 s, 12:00:00 as second 0."""
    feed(spark, tmp_path / "in", [(0, 10, "s", "tick"), (1, 195, "s", "tick")])  # the watermark after it: 180
    run_stream(spark, tmp_path, config=triage.Config(mining="none"))
    rows = [(2, 119, "s", "tick"), (3, 179, "s", "tick"), (4, 180, "s", "tick"), (5, 181, "s", "tick"), (6, 400, "s", "tick"), (7, 0, "s", "tick")]
    feed(spark, tmp_path / "in", rows)
    run_stream(spark, tmp_path, config=triage.Config(mining="none"))
    counts = {int((r["window_start"] - T0).total_seconds()): (r["lines"], r["late_lines"]) for r in worker.window_counts(spark, str(tmp_path / "out")).collect()}
    assert counts == {0: (2, 1), 60: (1, 1), 120: (1, 1), 180: (3, 0), 360: (1, 0)}
    late = Committed(spark, str(tmp_path / "out")).read("late_rows")
    assert sorted(r["seq"] for r in late.collect()) == [2, 3, 7]
    feed(spark, tmp_path / "in", [(8, 359, "s", "tick"), (9, 385, "s", "tick")])  # the watermark is 385 now
    run_stream(spark, tmp_path, config=triage.Config(mining="none"))
    late = Committed(spark, str(tmp_path / "out")).read("late_rows")
    assert sorted(r["seq"] for r in late.collect()) == [2, 3, 7, 8]


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_changes_of_a_stream(spark, tmp_path, order):
    """Lines and changes in files that come in another order, within the lag, give the batch's rows."""
    lines = [(i, 700 * i, "ab"[i % 2], f"release seven of gateway failed after {i} ms") for i in range(30)]
    changes = [(f"c{i}", T0 + dt.timedelta(seconds=1900 * i), "b", "release seven of gateway") for i in range(10)]
    kind = "change_id string, ts timestamp, service string, summary string"
    for n in order:
        feed(spark, tmp_path / "in", lines[n::3])
        spark.createDataFrame(changes[n::3], kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "changes"))
    read = lambda name, schema: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))
    lag = "8 hours"
    x = worker.changes_near(with_templates(prepare(read("in", LOGS))), read("changes", kind), lag=lag)
    x.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    want = worker.changes_near(with_templates(prepare(logs(spark, lines))), spark.createDataFrame(changes, kind), lag=lag)
    key = lambda df: sorted((r["change_id"], r["seq"], r["p_related"]) for r in df.collect())
    assert key(spark.read.parquet(str(tmp_path / "out"))) == key(want) and len(key(want)) > 20


#: Workers import this module and write here, in the same local folder as the test.
ASKED = Path(tempfile.gettempdir()) / "questions-asked-by-a-test"


def counting_judge():
    """Answers all questions that it is asked; writes down which."""

    def ask(state, keys=None):
        wanted = [(k, t) for k, t in judge.PACK if keys is None or k in keys]
        with open(ASKED, "a") as f:
            f.write(json.dumps(sorted(k for k, _ in wanted)) + "\n")
        values = {"noul": (0.3, {"yes": 0.3, "no": 0.7}), "choice": ("x", {"x": 1.0}), "score": (1, {"1": 1.0})}
        return [{"key": k, "type": t, "value": values[t][0], "probabilities": values[t][1], "confidence": None} for k, t in wanted], 10

    return ask


def test_a_second_run_asks_nothing(spark, tmp_path):
    ASKED.unlink(missing_ok=True)
    t = str(tmp_path)
    rows = [{"ts": "2024-01-01T00:00:00Z", "service": s, "level": "INFO", "body": f"request completed in {i} ms"} for s in "ab" for i in range(5)]
    (tmp_path / "logs.jsonl").write_text("\n".join(map(json.dumps, rows)))
    (tmp_path / "c.yaml").write_text(f"judge: {{backend: remote, factory: 'test_streams:counting_judge', concurrency: 2, rpm: 1.0e9}}\ncache: {{path: {t}/cache}}\nsink: {{kind: commits, out_dir: {t}/out}}\n")
    asked = lambda: ASKED.read_text().splitlines() if ASKED.exists() else []
    assert cli.main(["run", f"{t}/logs.jsonl", "--config", f"{t}/c.yaml", "--run-id", "r1"]) == 0
    assert len(asked()) == 2 and len(json.loads(asked()[0])) == len(judge.PACK)
    assert cli.main(["run", f"{t}/logs.jsonl", "--config", f"{t}/c.yaml", "--run-id", "r2"]) == 0
    assert len(asked()) == 2
    store = Committed(spark, f"{t}/out")
    assert {r["run_id"] for r in store.read("routing_decisions").collect()} == {"r1", "r2"}
    # one answer is lost: its question alone is asked
    cache = Committed(spark, f"{t}/cache")
    fp = next(r["fp"] for r in triage.pack_frame(spark, triage.checked(triage.BUILT_IN)).collect() if r["question_key"] == "benign")
    cache.commit("less", {"answers": cache.read("answers").where(F.col("question_fp") != fp)}, only=True)
    assert cli.main(["run", f"{t}/logs.jsonl", "--config", f"{t}/c.yaml", "--run-id", "r3"]) == 0
    assert [json.loads(x) for x in asked()[2:]] == [["benign"], ["benign"]]
    for bad in ("sink: {kind: odd}", "pricing: {billing: odd}"):
        (tmp_path / "bad.yaml").write_text(bad)
        with pytest.raises(ValueError):
            cli.config(f"{t}/bad.yaml")
    # a stream with the same settings finds the answers there
    spark.read.json(f"{t}/logs.jsonl").selectExpr("monotonically_increasing_id() AS seq", "CAST(ts AS timestamp) AS ts", "service", "level", "body", "CAST(NULL AS string) AS trace_id").coalesce(1).write.parquet(f"{t}/in")
    assert cli.main(["stream", f"{t}/in", f"{t}/stream", f"{t}/state", "--once", "--config", f"{t}/c.yaml"]) == 0
    assert len(asked()) == 4 and Committed(spark, f"{t}/stream").read("routing_decisions").count() == 2


def test_lines_of_text_as_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.log").write_text("ERROR disk full on node\n{\"service\": \"x\", \"message\": \"disk full on node\"}\n")
    x = worker.log_stream(spark, str(tmp_path / "in"), form="text")
    worker.start(x, str(tmp_path / "out"), str(tmp_path / "state"), triage.Config(mining="none"), once=True).awaitTermination()
    got = {(r["service"], r["template"]) for r in Committed(spark, str(tmp_path / "out")).read("log_clusters").collect()}
    assert got == {("unknown", "ERROR disk full on node"), ("x", "disk full on node")}


def test_words_are_taken_before_lines_and_changes_meet(spark):
    lines = spark.createDataFrame([], "seq long, ts timestamp, service string, template_id string, template string")
    changes = spark.createDataFrame([], "change_id string, ts timestamp, service string, summary string")
    plan = worker.changes_near(lines, changes)._jdf.queryExecution().analyzed().toString()
    above, below = plan.split("Join Inner", 1)
    assert "a-z0-9_" not in above and below.count("a-z0-9_") == 2
