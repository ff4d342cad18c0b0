"""A dry run: tokens, cost and time that judging clusters would take."""

from __future__ import annotations

import json
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .judge import state_json

CHARS_PER_TOKEN = 4


def question_tokens(payloads: dict[str, dict]) -> dict[str, int]:
    return {k: math.ceil(len(json.dumps(p, separators=(",", ":"))) / CHARS_PER_TOKEN) for k, p in payloads.items()}


def estimate(clusters: DataFrame, per_question: dict[str, int], cached: DataFrame | None = None, usd_per_m: float = 0.042, billing: str = "per_question", concurrency: int = 32, rpm: float = 1200, latency_s: float = 0.5) -> DataFrame:
    """One row. per_question: tokens of each question, of a pack, so few; cached: template_id, question_key."""
    spark = clusters.sparkSession
    pack = spark.createDataFrame(list(per_question.items()), "question_key string, qt long")
    x = clusters.select("template_id", F.ceil(F.length(state_json()) / CHARS_PER_TOKEN).alias("st"))
    asked = x.select("template_id", "st", F.explode(F.array(*[F.lit(k) for k in per_question])).alias("question_key")).join(F.broadcast(pack), "question_key")
    if cached is not None:
        asked = asked.join(cached.select("template_id", "question_key").distinct(), ["template_id", "question_key"], "left_anti")
    each = asked.groupBy("template_id").agg(F.first("st").alias("st"), F.count(F.lit(1)).alias("q"), F.sum("qt").alias("qs"), F.max("qt").alias("qm"))
    cost = F.col("st") * F.col("q") + F.col("qs") if billing == "per_question" else F.col("st") + F.col("qs")
    out = x.select("template_id").join(each, "template_id", "left").agg(
        F.count(F.lit(1)).alias("clusters"), F.count_if(F.col("q").isNull()).alias("cached_clusters"), F.count("q").alias("requests"), F.coalesce(F.sum("q"), F.lit(0)).alias("questions_asked"),
        F.coalesce(F.sum(cost), F.lit(0)).alias("input_tokens"), F.coalesce(F.max(F.col("st") + F.col("qm")), F.lit(0)).alias("max_request_tokens"),
    )
    rate = min(concurrency / max(latency_s, 1e-3), rpm / 60)
    return out.withColumns({"est_cost_usd": F.round(F.col("input_tokens") / 1e6 * usd_per_m, 6), "est_wall_s": F.round(F.col("requests") / rate, 1)})
