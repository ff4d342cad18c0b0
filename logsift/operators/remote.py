"""A judge behind an interface: bounded concurrency, rate limit, retries, dead letters and fallback, by partition.

``ask_all`` runs any judge over a frame of subjects with ``mapInPandas``. Partitions are the concurrency; each has its
share of the rate. The transport is a plain callable, so no client library is needed and tests use a fake one.
"""

from __future__ import annotations

import inspect
import json
import random
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CALLS = "subject_id string, answers string, attempts int, latency_ms double, input_tokens long, error string"


class JudgeError(Exception):
    def __init__(self, message: str, retryable: bool) -> None:
        super().__init__(message)
        self.retryable = retryable


class TokenBucket:
    def __init__(self, per_minute: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        self.rate, self.clock, self.sleep = per_minute / 60, clock, sleep
        self.capacity = max(1.0, self.rate)
        self.level, self.at = self.capacity, clock()

    def take(self) -> None:
        while True:
            now = self.clock()
            self.level, self.at = min(self.capacity, self.level + (now - self.at) * self.rate), now
            if self.level >= 1:
                self.level -= 1
                return
            self.sleep((1 - self.level) / self.rate)


def status_error(status: int, text: str = "") -> JudgeError:
    """429 and 5xx can be tried again, other 4xx cannot."""
    return JudgeError(f"HTTP {status}: {text[:200]}", status == 429 or status >= 500)


def parse_answer(key: str, kind: str, raw) -> dict:
    """key, type, value, probabilities, confidence of one answer, from the shapes that judges send."""
    if raw is None:
        raise JudgeError(f"no answer for {key}", False)
    if kind == "noul":
        p = float(raw if not isinstance(raw, dict) else raw.get("value", raw.get("probability", (raw.get("probabilities") or {}).get("yes", 0.0))))
        return {"key": key, "type": kind, "value": p, "probabilities": {"yes": p, "no": 1 - p}, "confidence": None}
    probs = {str(k): float(v) for k, v in ((raw.get("probabilities") or {}) if isinstance(raw, dict) else {}).items()}
    value = raw.get("value") if isinstance(raw, dict) else raw
    if value is None and probs:
        value = max(probs, key=probs.get)
    return {"key": key, "type": kind, "value": int(value) if kind == "score" else str(value), "probabilities": probs, "confidence": raw.get("confidence") if isinstance(raw, dict) else None}


def http_judge(transport: Callable[[dict], tuple[int, str]], model: str, questions: list[dict]) -> Callable[[str], tuple[list[dict], int]]:
    """A judge over ``transport`` (request to status and body): state text to (answers, input tokens)."""

    def ask(state: str, keys: list[str] | None = None) -> tuple[list[dict], int]:
        wanted = [q for q in questions if keys is None or q["key"] in keys]
        status, body = transport({"model": model, "state": json.loads(state), "questions": {q["key"]: q["payload"] for q in wanted}})
        if status >= 400:
            raise status_error(status, body)
        got = json.loads(body)
        found = got.get("answers", got.get("results", {}))
        return [parse_answer(q["key"], q["payload"]["type"], found.get(q["key"])) for q in wanted], int((got.get("usage") or {}).get("input_tokens", 0))

    return ask


def ask_all(subjects: DataFrame, make_judge: Callable[[], Callable[[str], tuple[list[dict], int]]], concurrency: int = 32, rpm: float = 1200, retries: int = 3, base_s: float = 0.25) -> DataFrame:
    """subjects (subject_id, state), one row a subject, to CALLS: answers as JSON, or null with the error (a dead letter).

    With a column ``questions`` (keys), a judge that takes two arguments is asked for these only; of another one's answers
    these are kept.
    """
    some = "questions" in subjects.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # as many partitions run at once as the cluster has slots for, at most all of them; each has its share of the rate
        ask, bucket = make_judge(), TokenBucket(rpm / max(1, min(concurrency, slots)))
        by_key = some and len(inspect.signature(ask).parameters) > 1
        for x in batches:
            rows = []
            for subject, state, keys in zip(x["subject_id"], x["state"], x["questions"] if some else [None] * len(x)):
                began, tries = time.monotonic(), 0
                while True:
                    tries += 1
                    bucket.take()
                    try:
                        answers, tokens = ask(state, list(keys)) if by_key else ask(state)
                        answers = [a for a in answers if a["key"] in keys] if some else answers
                        rows.append((subject, json.dumps(answers), tries, (time.monotonic() - began) * 1000, tokens, None))
                        break
                    except Exception as e:  # any judge's failure is a dead letter in the end
                        if (isinstance(e, JudgeError) and not e.retryable) or tries > retries:
                            rows.append((subject, None, tries, (time.monotonic() - began) * 1000, 0, f"{type(e).__name__}: {e}"))
                            break
                        time.sleep(random.uniform(0, base_s * 2 ** (tries - 1)))
            yield pd.DataFrame(rows, columns=["subject_id", "answers", "attempts", "latency_ms", "input_tokens", "error"])

    slots = subjects.sparkSession.sparkContext.defaultParallelism
    once = subjects.groupBy("subject_id").agg(*[F.first(c).alias(c) for c in ("state", "questions") if c in subjects.columns])
    return once.repartition(concurrency).mapInPandas(run, CALLS)


def dead_letters(calls: DataFrame) -> DataFrame:
    return calls.where(F.col("answers").isNull()).select("subject_id", "error", "attempts")


def long_answers(calls: DataFrame, source: str) -> DataFrame:
    """subject_id, key, type, value, probabilities, confidence, source."""
    kind = "array<struct<key:string,type:string,value:string,probabilities:map<string,double>,confidence:double>>"
    x = calls.where(F.col("answers").isNotNull()).select("subject_id", F.explode(F.from_json("answers", kind)).alias("a"))
    return x.select("subject_id", "a.*", F.lit(source).alias("source"))


def call_stats(calls: DataFrame, usd_per_m: float = 0.042) -> DataFrame:
    """One row: requests, input_tokens, dead_letters, est_cost_usd."""
    x = calls.agg(F.count(F.lit(1)).alias("requests"), F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("input_tokens"), F.count("error").alias("dead_letters"))
    return x.withColumn("est_cost_usd", F.round(F.col("input_tokens") / 1e6 * usd_per_m, 6))


def run_stats(calls: DataFrame, subjects: DataFrame, fallback: bool = True, usd_per_m: float = 0.042) -> DataFrame:
    """One row for a run: ``call_stats`` with subjects, cache_hits, hit_rate, fallbacks, p50_ms and p95_ms (nearest rank)."""
    from .evaluate import nearest_rank

    p = {r["percent"]: r["value"] for r in nearest_rank(calls.where("error IS NULL"), "latency_ms", [50, 95]).collect()}
    asked = subjects.select(F.col("subject_id").alias("s")).distinct().join(calls.select(F.col("subject_id").alias("s"), F.lit(1).alias("c")), "s", "left").agg(F.count(F.lit(1)).alias("subjects"), F.count_if(F.col("c").isNull()).alias("cache_hits"))
    one = call_stats(calls, usd_per_m).withColumn("_j", F.lit(1)).join(F.broadcast(asked.withColumn("_j", F.lit(1))), "_j").drop("_j")  # a row each
    rate = F.coalesce(F.col("cache_hits") / F.nullif("subjects", F.lit(0)), F.lit(0.0))
    return one.withColumns({"hit_rate": rate, "fallbacks": F.col("dead_letters") if fallback else F.lit(0).cast("long"), "p50_ms": F.lit(p[50.0]), "p95_ms": F.lit(p[95.0])})
