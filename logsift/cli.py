"""Commands: generate-sample, run, stream, estimate, eval, export-golden, replay, init-tables."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import correlate, evaluate, judge, miner, reduce, route
from .operators.cache import CACHE, answered, fresh, newest
from .operators.estimate import estimate, question_tokens
from .plans import sinks, triage, views
from .plans.commits import Committed
from .sources import logs as src
from .sources.questions import BUILT_IN, checked, load_pack, pack_frame
from .sources.synthetic import synthetic_changes, synthetic_logs


CONFIG = "YAML with the sections judge, cache, pack, reduce, router, known_issues, runbooks, correlate, narrate, pricing, sink"


def session(name: str = "triage") -> SparkSession:
    return SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _clusters(spark: SparkSession, path: str) -> DataFrame:
    return reduce.clusters(miner.mine(reduce.prepare(src.read_logs(spark, path))))


def config(path: str | None) -> triage.Config:
    """From a YAML file; without one, the defaults."""
    if not path:
        return triage.Config()
    import yaml

    with open(path) as f:
        return triage.Config.of(yaml.safe_load(f) or {})


def cached_questions(found: DataFrame, cfg: triage.Config, pack: dict) -> DataFrame:
    """template_id, question_key that the configured cache has fresh answers to."""
    spark = found.sparkSession
    store = fresh(Committed(spark, cfg.cache).read("answers", CACHE), F.current_timestamp(), cfg.ttl_days)
    x = answered(found.select(F.col("template_id").alias("subject_id")), store, pack_frame(spark, pack), cfg.model)
    return x.select(F.col("subject_id").alias("template_id"), F.col("key").alias("question_key"))


def evaluation(golden: DataFrame, target_precision: float = 0.9) -> dict:
    """All metrics of a golden frame (``read_golden``) under the native judge and the default router."""
    rows = golden.withColumns({
        "template_id": F.col("id"), "first_seen": F.lit(None).cast("timestamp"), "last_seen": F.lit(None).cast("timestamp"), "trace_ids": F.array().cast("array<string>"),
        "sensitive_hits": F.create_map().cast("map<string,bigint>"),
    })
    x = route.route(judge.answers(judge.judge(rows))).persist()
    out: dict = {}
    one = lambda df: df.first().asDict()
    for key in judge.NOULS:
        part = x.where(F.col("labels")[key].isNotNull()).select((F.lower(F.col("labels")[key]) == "true").alias("y"), F.col(f"p_{key}").alias("p"))
        if part.limit(1).count():
            out[key] = one(evaluate.binary_metrics(part)) | one(evaluate.ece(part)) | one(evaluate.best_threshold(part, target_precision))
    part = x.where(F.col("labels")["category"].isNotNull()).select(F.monotonically_increasing_id().alias("seq"), F.col("labels")["category"].alias("label"), F.col("category").alias("pred"), F.array_max(F.transform("d_category", lambda e: e.p)).alias("p"))
    out["category"] = one(evaluate.choice_metrics(part)) | {"confusions": {r["confusion"]: r["n"] for r in evaluate.confusions(part).collect()}}
    best = F.array_max(F.transform("d_severity", lambda e: F.struct(e.p.alias("p"), (-e["name"].cast("int")).alias("i"))))
    part = x.where(F.col("labels")["severity"].isNotNull()).select(F.col("labels")["severity"].cast("int").alias("label"), (-best.i).alias("pred"), F.col("expected_severity").alias("expected"))
    out["severity"] = one(evaluate.score_metrics(part))
    out["routing"] = one(evaluate.routing_quality(x.select("id", "decision", (F.lower(F.col("labels")["actionable"]) == "true").alias("actionable"))))
    x.unpersist()
    return out


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="logsift")
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("generate-sample")
    c.add_argument("out")
    c.add_argument("--minutes", type=int, default=120)
    c.add_argument("--scale", type=float, default=1.0)
    c = sub.add_parser("run")
    c.add_argument("logs")
    c.add_argument("--changes")
    c.add_argument("--out")
    c.add_argument("--database")
    c.add_argument("--run-id")
    c.add_argument("--config", help=CONFIG)
    c = sub.add_parser("stream")
    c.add_argument("folder")
    c.add_argument("out")
    c.add_argument("checkpoint")
    c.add_argument("--format", choices=["parquet", "json", "text"], default="parquet")
    c.add_argument("--window", default="60 seconds")
    c.add_argument("--lag", default="15 seconds")
    c.add_argument("--config", help=CONFIG)
    c.add_argument("--once", action="store_true")
    c.add_argument("--changes")
    c = sub.add_parser("estimate")
    c.add_argument("logs")
    c.add_argument("--pack")
    c.add_argument("--config", help=CONFIG)
    c = sub.add_parser("eval")
    c.add_argument("golden")
    c.add_argument("--max-false-suppression", type=float)
    c = sub.add_parser("export-golden")
    c.add_argument("logs")
    c.add_argument("out")
    c = sub.add_parser("replay", help="writes OTLP requests, rebased so that the last record is now")
    c.add_argument("logs")
    c.add_argument("out")
    c = sub.add_parser("init-tables")
    c.add_argument("--database", default="triage")
    a = p.parse_args(argv)
    spark = session()
    if a.command == "generate-sample":
        synthetic_logs(spark, a.minutes, a.scale).drop("seq").write.mode("overwrite").json(f"{a.out}/logs")
        synthetic_changes(spark).withColumnRenamed("change_id", "id").write.mode("overwrite").json(f"{a.out}/changes")
    elif a.command == "run":
        cfg = config(a.config)
        store = Committed(spark, cfg.cache) if cfg.cache else None
        r = triage.run(src.read_logs(spark, a.logs), src.read_changes(spark, a.changes) if a.changes else None, cfg, a.run_id, cache=store.read("answers", CACHE) if store else None)
        sinks.triage_console(r.routed).show(truncate=False)
        r.summary.show(vertical=True, truncate=False)
        correlate.top_incidents(r.incidents, 5).show(truncate=False)
        if r.judge_stats is not None:
            r.judge_stats.show(vertical=True, truncate=False)
        if store and r.new_answers is not None:
            store.commit(r.run_id, {"answers": r.new_answers})
            store.compact("answers", newest)
        if cfg.sink:
            sinks.write(r, cfg.sink, cfg.out, cfg.database)
        if a.out:
            sinks.write_files(r, a.out)
        if a.database:
            sinks.write_tables(r, a.database)
    elif a.command == "stream":
        from .streaming import worker

        schema = "seq long, ts timestamp, service string, level string, body string, trace_id string"
        changes = src.read_changes(spark, a.changes) if a.changes else None
        logs = worker.log_stream(spark, a.folder, schema, form=a.format)
        worker.start(logs, a.out, a.checkpoint, config(a.config), changes, once=a.once, window=a.window, lag=a.lag).awaitTermination()
    elif a.command == "estimate":
        cfg = config(a.config)
        pack = load_pack(a.pack or cfg.pack) if a.pack or cfg.pack else checked(BUILT_IN)
        found = _clusters(spark, a.logs)
        cached = cached_questions(found, cfg, pack) if cfg.cache else None
        estimate(found, question_tokens(pack), cached, cfg.usd_per_m, cfg.billing, cfg.concurrency, cfg.rpm).show(vertical=True)
    elif a.command == "eval":
        metrics = evaluation(src.read_golden(spark, a.golden))
        print(sinks.report(metrics))
        quality = spark.createDataFrame([(metrics["routing"]["false_suppression_rate"],)], "false_suppression_rate double")
        return int(a.max_false_suppression is not None and not evaluate.gate(quality, a.max_false_suppression))
    elif a.command == "export-golden":
        evaluate.golden_rows(_clusters(spark, a.logs)).write.mode("overwrite").json(a.out)
    elif a.command == "replay":
        x = src.read_logs(spark, a.logs)
        last = x.agg(F.max(F.unix_micros(F.col("ts"))).alias("m"), F.max(F.unix_micros(F.current_timestamp())).alias("now")).first()
        sinks.otlp_payloads(x, shift_us=(last["now"] or 0) - (last["m"] or 0)).select("payload").write.mode("overwrite").text(a.out)
    else:
        print("\n".join(views.create_tables(spark, a.database)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
