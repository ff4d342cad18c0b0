"""Log, change and golden-set readers, and time-window scans."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.levels import guess_level, normalize_level
from ..functions.text import once

# Spellings of each field, the first that is neither null nor empty counts.
KEYS = {
    "ts": ["ts", "timestamp", "Timestamp", "time", "@timestamp"],
    "service": ["service", "ServiceName", "service.name", "app"],
    "level": ["level", "SeverityText", "severity", "lvl"],
    "body": ["body", "Body", "message", "msg"],
    "trace_id": ["trace_id", "TraceId", "traceId"],
}


def field(line: Column, name: str) -> Column:
    """The field of a JSON object line, by any of its spellings; null if there is none."""
    return of_map(F.from_json(line, "map<string,string>"), name)


def of_map(fields: Column, name: str) -> Column:
    """The field among those of a line that was read once."""
    return F.coalesce(*[F.nullif(F.element_at(fields, F.lit(k)), F.lit("")) for k in KEYS[name]])


def parse_ts(value: Column) -> Column:
    """A timestamp from epoch seconds, milli-, micro- or nanoseconds, or from ISO text (a space for T, Z, no zone: UTC)."""
    x = F.when(F.regexp_like(value, F.lit(r"^[-+]?[0-9]+(\.[0-9]+)?([eE][-+]?[0-9]+)?$")), value).try_cast("double")
    # as often as it takes to come to 1e11 at most
    unit = F.when(x <= 1e11, F.lit(1e6)).when(x <= 1e14, F.lit(1e3)).when(x <= 1e17, F.lit(1.0)).when(x <= 1e20, F.lit(1e-3)).otherwise(F.lit(1e-6))
    number = F.timestamp_micros(F.round(x * unit).cast("long"))
    text = F.when(F.contains(value, F.lit(".")), F.substring(value, 1, 32)).otherwise(value)
    return F.coalesce(number, text.try_cast("timestamp"))


def parse_lines(lines: DataFrame, line: str = "value", now: Column | None = None) -> DataFrame:
    """ts, service, level, body, trace_id, attrs of each line that isn't blank.

    Lines that aren't JSON objects (also JSON scalars and arrays) are plain messages of service ``unknown`` with the
    time of the scan and a guessed level.
    """
    now = F.current_timestamp() if now is None else now
    v = F.col(line)
    x = lines.where(F.regexp_like(v, F.lit(r"\S")))
    # one reading of the line gives all its fields; what is no object gives null
    m = F.when(F.regexp_like(v, F.lit(r"^\s*\{")), F.from_json(v, "map<string,string>"))
    x = x.withColumn("_m", once(m))
    names = [F.col(f"`{c}`") for c in lines.columns if c != line]
    f = {k: of_map(F.col("_m"), k) for k in KEYS}
    x = x.select(*names, v.alias("_v"), "_m", *[once(c).alias(f"_{k}") for k, c in f.items()])
    is_json = F.col("_m").isNotNull()
    attrs = F.coalesce(F.element_at("_m", F.lit("attrs")), F.element_at("_m", F.lit("LogAttributes")))
    return x.select(
        *names,
        F.when(is_json, F.coalesce(parse_ts(F.col("_ts")), now)).otherwise(now).alias("ts"),
        F.when(is_json, F.coalesce("_service", F.lit("unknown"))).otherwise("unknown").alias("service"),
        F.when(is_json, normalize_level(F.col("_level"))).otherwise(guess_level(F.col("_v"))).alias("level"),
        F.when(is_json, F.coalesce("_body", F.lit(""))).otherwise(F.col("_v")).alias("body"),
        F.when(is_json, F.col("_trace_id")).alias("trace_id"),
        F.when(is_json, F.from_json(attrs, "map<string,string>")).alias("attrs"),
    )


def read_logs(spark: SparkSession, path: str, now: datetime | None = None) -> DataFrame:
    """Log records of JSON or plain text lines; seq is the order of arrival within the scan."""
    lines = spark.read.text(path).withColumn("seq", F.monotonically_increasing_id())
    return parse_lines(lines, now=None if now is None else F.lit(now))


def parse_changes(lines: DataFrame, line: str = "value") -> DataFrame:
    """change_id, ts, service, summary of JSON lines; blank ones are left out."""
    v = F.col(line)
    part = lambda k: F.get_json_object(v, f"$.{k}")
    x = lines.where(F.regexp_like(v, F.lit(r"\S")))
    return x.select(F.coalesce(part("id"), F.lit("")).alias("change_id"), parse_ts(part("ts")).alias("ts"), part("service").alias("service"), part("summary").alias("summary"))


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """change_id, ts, service, summary; in the order of the changes' times."""
    return parse_changes(spark.read.text(path)).orderBy("ts", "change_id")


def window_scan(table: DataFrame, start, end, limit: int | None = None, ts: str = "ts", order: tuple[str, ...] = ()) -> DataFrame:
    """Rows of [start, end), pushed down to the scan; with an order sorted by time and these columns; with a limit the
    earliest ones, in that order."""
    out = table.where((F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(end)))
    out = out.orderBy(ts, *order) if order or limit is not None else out
    return out if limit is None else out.limit(limit)


def from_otel(table: DataFrame) -> DataFrame:
    """Log records from a table with the collector exporter's columns."""
    return table.select(
        F.col("Timestamp").cast("timestamp").alias("ts"), F.coalesce(F.nullif("ServiceName", F.lit("")), F.lit("unknown")).alias("service"),
        normalize_level(F.col("SeverityText")).alias("level"), F.coalesce("Body", F.lit("")).alias("body"), F.nullif("TraceId", F.lit("")).alias("trace_id"),
    )


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """i, v: the lines of a file with their numbers from 0. Only the number of lines of each split comes to the driver."""
    x = spark.read.text(path).select(F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("m"), F.col("value").alias("v"))
    before, starts = 0, []
    for r in sorted(x.groupBy("p").count().collect()):
        starts.append((r["p"], before - (r["p"] << 33)))
        before += r["count"]
    shift = spark.createDataFrame(starts, "p int, s long")
    return x.join(F.broadcast(shift), "p").select((F.col("m") + F.col("s")).alias("i"), "v")


def read_golden(spark: SparkSession, path: str) -> DataFrame:
    """``parse_golden`` of one file's lines, whose numbers name rows without an id, as ``row-<number>``."""
    return parse_golden(numbered_lines(spark, path))


def parse_golden(lines: DataFrame) -> DataFrame:
    """id, service, level, template (masked and scrubbed body if absent), examples (3 at most, scrubbed), count, labels of
    lines (i, v)."""
    from ..functions.scrub import scrub
    from ..functions.text import mask

    rows = lines.where(F.regexp_like("v", F.lit(r"\S")))
    v = F.col("v")
    part = lambda k: F.get_json_object(v, f"$.{k}")
    x = rows.select(
        F.coalesce(part("id"), F.concat(F.lit("row-"), F.col("i").cast("string"))).alias("id"), F.coalesce(part("service"), F.lit("unknown")).alias("service"),
        normalize_level(part("level")).alias("level"), part("template").alias("_template"), F.coalesce(part("body"), F.lit("")).alias("_body"),
        F.coalesce(F.from_json(part("examples"), "array<string>"), F.array().cast("array<string>")).alias("_examples"),
        F.coalesce(part("count").cast("long"), F.lit(1).cast("long")).alias("count"), F.coalesce(F.from_json(part("labels"), "map<string,string>"), F.create_map().cast("map<string,string>")).alias("labels"),
    )
    x = scrub(x, "_body", "_clean", "_h")
    listed = x.select("id", F.posexplode(F.slice("_examples", 1, 3)).alias("p", "e"))
    cleaned = scrub(listed, "e", "c", "_h").groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "c"))), lambda s: s.c).alias("examples"))
    x = x.join(cleaned, "id", "left")
    own = F.when(F.col("_body") != "", F.array("_clean")).otherwise(F.array().cast("array<string>"))
    return x.select("id", "service", "level", F.coalesce("_template", mask(F.col("_clean"))).alias("template"), F.coalesce("examples", own).alias("examples"), "count", "labels")
