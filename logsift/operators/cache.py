"""Answer cache: a table keyed by subject, model version and question fingerprint."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = ["subject_id", "model_version", "question_fp"]
CACHE = "subject_id string, model_version string, question_fp string, answer string, created_at timestamp, source string"


def fingerprint(key: str, payload: dict) -> str:
    """First 16 hex digits of the sha256 of the key and payload as JSON with sorted keys."""
    return hashlib.sha256(json.dumps({"key": key, **payload}, sort_keys=True).encode()).hexdigest()[:16]


def fresh(cache: DataFrame, now, ttl_days: float) -> DataFrame:
    return cache.where(F.col("created_at") >= F.lit(now) - F.make_interval(secs=F.lit(ttl_days * 86400)))


def hits(asked: DataFrame, cache: DataFrame) -> DataFrame:
    """Answers of asked (KEY) that the cache has, with source ``cache``."""
    return asked.select(*KEY).distinct().join(cache.drop("source"), KEY).withColumn("source", F.lit("cache"))


def misses(asked: DataFrame, cache: DataFrame) -> DataFrame:
    return asked.select(*KEY).distinct().join(cache.select(*KEY), KEY, "left_anti")


def upsert(cache: DataFrame, new: DataFrame) -> DataFrame:
    """cache with the new answers; the latest of a key counts. Fallback and cached answers are not kept."""
    return newest(cache.unionByName(new.where(~F.col("source").isin("fallback", "cache")).select(*cache.columns)))


def newest(cache: DataFrame) -> DataFrame:
    """The latest row of each key."""
    w = Window.partitionBy(*KEY).orderBy(F.desc("created_at"), "answer")
    return cache.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def stats(asked: DataFrame, cache: DataFrame) -> DataFrame:
    """One row: asked, hits, hit_rate."""
    x = asked.select(*KEY).distinct().join(cache.select(*KEY).distinct().withColumn("_h", F.lit(1)), KEY, "left")
    x = x.agg(F.count(F.lit(1)).alias("asked"), F.count("_h").alias("hits"))
    return x.withColumn("hit_rate", F.coalesce(F.col("hits") / F.nullif("asked", F.lit(0)), F.lit(0.0)))


def stored(answers: DataFrame, fps: DataFrame, model: str) -> DataFrame:
    """Cache rows of long answers (subject_id, key, type, value, probabilities, confidence, source); fps: question_key, fp."""
    x = answers.join(F.broadcast(fps.select(F.col("question_key").alias("key"), F.col("fp").alias("question_fp"))), "key")
    return x.select("subject_id", F.lit(model).alias("model_version"), "question_fp", F.to_json(F.struct("key", "type", "value", "probabilities", "confidence")).alias("answer"), F.current_timestamp().alias("created_at"), "source")


def answered(subjects: DataFrame, cache: DataFrame, fps: DataFrame, model: str) -> DataFrame:
    """Long answers of the subjects (subject_id) that the cache has, of a pack's questions, with source ``cache``."""
    asked = subjects.select("subject_id").distinct().crossJoin(F.broadcast(fps.select(F.col("fp").alias("question_fp")))).withColumn("model_version", F.lit(model))  # a pack is small
    kind = "key string, type string, value string, probabilities map<string,double>, confidence double"
    return hits(asked, cache).select("subject_id", F.from_json("answer", kind).alias("a"), "source").select("subject_id", "a.*", "source")


def missing(subjects: DataFrame, found: DataFrame, fps: DataFrame) -> DataFrame:
    """subjects with ``questions``, the keys of a pack that found (long answers) lacks; none of those that it has whole."""
    keys = F.array(*[F.lit(r["question_key"]) for r in fps.select("question_key").orderBy("question_key").collect()])  # a pack
    have = found.groupBy("subject_id").agg(F.collect_set("key").alias("_have"))
    x = subjects.join(have, "subject_id", "left").withColumn("questions", F.array_except(keys, F.coalesce("_have", F.array().cast("array<string>"))))
    return x.where(F.size("questions") > 0).drop("_have")
