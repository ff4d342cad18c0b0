"""Sample logs of a small shop for the command line and the tests: in the second hour its ledger runs out of connections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

START = "2026-03-02 09:00:00"
#: Service, level, message, lines a minute, whether only in the outage. {n:a:b} is a number from a to b.
KINDS = [
    ("front", "INFO", "page rendered in {n:2:80} ms", 500, False),
    ("front", "DEBUG", "probe of /healthz answered 200", 100, False),
    ("basket", "INFO", "basket {uuid} stored in {n:1:40} ms", 90, False),
    ("basket", "WARN", "retry {n:1:3} of the stock lookup succeeded", 4, False),
    ("basket", "INFO", "receipt for card 4111 1111 1111 1111 mailed to guest{n:1:9999}@example.org", 1, False),
    ("ledger", "INFO", "heartbeat of node {n:1:3} ok", 6, False),
    ("ledger", "ERROR", "connection pool exhausted, {n:5:80} callers wait for a slot", 40, True),
    ("ledger", "ERROR", "statement on postings ran into its timeout after {n:4000:6000} ms", 25, True),
    ("basket", "ERROR", "timeout calling ledger after {n:2000:3000} ms, purchase failed", 60, True),
    ("front", "ERROR", "purchase failed with 504 from basket after {n:3000:3300} ms", 70, True),
    ("stock", "FATAL", "panic in the stock counter", 0.3, True),
    ("login", "INFO", "session opened for guest{n:1:9999}@example.org", 30, False),
    ("login", "WARN", "token of guest{n:1:9999}@example.org rejected", 3, False),
    ("login", "WARN", "settings read again with api_key=sk-live{hex}", 0.05, False),
]
CHANGES = [
    ("rel-1", 12, "login", "new wording of the login page"),
    ("rel-2", 58, "ledger", "connection pool of the ledger lowered to four slots"),
    ("rel-3", 63, "stock", "stock counter rewritten"),
]


def _body(template: str, seed: int):
    """The message with its placeholders filled from seeded random columns."""
    import re

    parts, i = [], 0
    for piece in re.split(r"(\{[^}]*\})", template):
        if m := re.fullmatch(r"\{n:(\d+):(\d+)\}", piece):
            lo, hi = int(m[1]), int(m[2])
            parts.append((F.lit(lo) + F.floor(F.rand(seed + i) * (hi - lo + 1))).cast("string"))
        elif piece == "{uuid}":
            h = F.sha1(F.rand(seed + i).cast("string"))
            parts.append(F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]))
        elif piece == "{hex}":
            parts.append(F.substring(F.sha1(F.rand(seed + i).cast("string")), 1, 24))
        else:
            parts.append(F.lit(piece))
        i += 1
    return F.concat(*parts)


def synthetic_logs(spark: SparkSession, minutes: int = 120, scale: float = 1.0, incident_at: int = 60, incident_len: int = 25, start: str = START, seed: int = 7) -> DataFrame:
    """seq, ts, service, level, body, trace_id; the same rows for the same arguments. Made by the executors."""
    out = None
    for k, (service, level, template, rate, only) in enumerate(KINDS):
        lo, hi = (incident_at + 2, min(minutes, incident_at + 2 + incident_len)) if only else (0, minutes)
        n = round(rate * scale * max(0, hi - lo))
        if not n:
            continue
        s = seed * 1000 + 40 * k
        at = F.lit(float(lo * 60)) + F.rand(s) * ((hi - lo) * 60)
        shared = F.md5(F.concat_ws("-", F.floor(at / 60).cast("string"), F.floor(F.rand(s + 1) * 8).cast("string")))
        own = F.md5(F.concat_ws("-", F.lit(str(k)), F.col("id").cast("string")))
        x = spark.range(0, n, 1, 1 + n // 500_000).withColumn("at", at).select(
            F.timestamp_micros((F.unix_micros(F.lit(start).cast("timestamp")) + F.floor(F.col("at") * 1_000_000)).cast("long")).alias("ts"),
            F.lit(service).alias("service"), F.lit(level).alias("level"), _body(template, s + 2).alias("body"), (shared if only else own).alias("trace_id"), (F.floor(F.col("at") * 1_000_000).cast("long") * 32 + k).alias("seq"),  # in the order of time
        )
        out = x if out is None else out.unionByName(x)
    return out


def synthetic_changes(spark: SparkSession, start: str = START) -> DataFrame:
    rows = spark.createDataFrame(CHANGES, "change_id string, minute int, service string, summary string")
    return rows.select("change_id", F.timestamp_seconds(F.unix_timestamp(F.lit(start)) + F.col("minute") * 60).alias("ts"), "service", "summary")
