"""Log triage over Structured Streaming: the batch functions on micro-batches, with exactly-once run ids.

Offsets and progress are in the stream's checkpoint, so a restart goes on where it stopped. What a batch makes is one
commit (``plans/commits.py``): its four relations, the miner's changed groups, the windows' counts, late rows, and a judge's
answers. A batch that is tried again after its commit changes nothing.

The miner's groups are kept by buckets of service and length; a batch reads the buckets of its own lines and writes the
groups that it made or changed, so the work and the bytes of a batch grow with the batch.

A row is late if its window had ended by the watermark, which is the latest time of all batches before, less the lag. The
triage takes late rows like others. Windows count them apart (``late_lines``), so a window's row is its corrected count, and
``late_rows`` says which rows came when. Windows over a stream itself (``windowed_counts``) drop what is late.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import once as guarded
from ..functions.text import word_tokens
from ..operators.cache import CACHE, newest
from ..operators.correlate import CHANGE_RELATED, LOOKBACK_S
from ..operators.graph import cut
from ..operators.judge import change_related
from ..operators.miner import KNOWN
from ..operators.reduce import prepare, with_templates
from ..plans.commits import Committed
from ..plans.sinks import relations
from ..plans.triage import Config, Run, run
from ..sources.logs import parse_lines

LAG, WINDOW = "15 seconds", "60 seconds"
#: Buckets of the miner's groups.
BUCKETS = 64
STATE = f"{KNOWN}, batch long, bucket int"


def log_stream(spark: SparkSession, path: str, schema: str | None = None, files_per_trigger: int = 100, form: str = "parquet") -> DataFrame:
    """New files of a folder as a stream; ts becomes a TIMESTAMP, which watermarks ask for.

    form ``text`` or ``json``: lines of log files, parsed as ``read_logs`` does and numbered in each batch. schema: that of
    Parquet files.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_trigger)
    if form in ("text", "json"):
        return parse_lines(reader.text(path))
    x = reader.schema(schema).format(form).load(path)
    return x.withColumn("ts", F.col("ts").cast("timestamp")) if "ts" in x.columns else x


def windowed_counts(logs: DataFrame, window: str = WINDOW, lag: str = LAG) -> DataFrame:
    """window_start, service, template_id, template, lines: cluster counts of event-time windows, with a watermark."""
    x = with_templates(prepare(logs.withWatermark("ts", lag)))
    g = x.groupBy(F.window("ts", window).alias("w"), "service", "template_id", "template").agg(F.count(F.lit(1)).alias("lines"))
    return g.select(F.col("w.start").alias("window_start"), "service", "template_id", "template", "lines")


def changes_near(logs: DataFrame, changes: DataFrame, lookback_s: int = LOOKBACK_S, lag: str = LAG, threshold: float = CHANGE_RELATED) -> DataFrame:
    """Lines of a stream with the changes of another stream up to ``lookback_s`` before them: change_id, change_ts,
    change_service, summary, seq, ts, service, template_id, template, p_related (``threshold`` at least).

    logs: as of ``with_templates``; changes: change_id, ts, service, summary. An interval join with watermarks on both
    sides, by buckets of the lookback: Spark drops a change from its state once lines that could meet it are behind the
    watermark, and a line once all changes before it are in. Frames that are no streams give the same rows.
    """
    width = lookback_s * 1_000_000
    bucket = lambda c: F.floor(F.unix_micros(c) / width)
    a = logs.withWatermark("ts", lag).select("seq", "ts", "service", "template_id", "template").withColumns({"_b": bucket(F.col("ts")), "_said": guarded(word_tokens(F.col("template")))})
    b = changes.select("change_id", F.col("ts").cast("timestamp").alias("change_ts"), F.col("service").alias("change_service"), "summary").withWatermark("change_ts", lag)
    b = b.withColumn("_words", guarded(word_tokens(F.col("summary")))).withColumn("_c", F.explode(F.array(bucket(F.col("change_ts")), bucket(F.col("change_ts")) + 1)))
    x = a.join(b, F.expr(f"_b = _c AND ts >= change_ts AND ts <= change_ts + INTERVAL {lookback_s} SECONDS"))
    minutes = F.round((F.unix_micros("ts") - F.unix_micros("change_ts")) / 60_000_000, 1)
    shared = F.size(F.array_intersect("_words", "_said"))  # words of a row, taken once and not for each pair
    x = x.withColumn("p_related", change_related(F.col("change_service") == F.col("service"), minutes, shared)).where(F.col("p_related") >= threshold)
    return x.select("change_id", "change_ts", "change_service", "summary", "seq", "ts", "service", "template_id", "template", "p_related")


def _numbered(batch: DataFrame) -> DataFrame:
    """The batch with a seq; numbers that are given here are written down, as lines are read several times."""
    return batch if "seq" in batch.columns else cut(batch.withColumn("seq", F.monotonically_increasing_id()))


def _bucket() -> Column:
    return F.pmod(F.xxhash64("service", "n_tokens"), F.lit(BUCKETS)).cast("int").alias("bucket")


def latest(groups: DataFrame) -> DataFrame:
    """Of each group (STATE) the row of its latest batch."""
    key = ["service", "n_tokens", "b1", "b2", "place", "bucket"]
    return groups.groupBy(*key).agg(F.max_by("tokens", "batch").alias("tokens"), F.max("batch").alias("batch")).select("service", "n_tokens", "b1", "b2", "place", "tokens", "batch", "bucket")


def groups_of(store: Committed, at: dict) -> Callable[[DataFrame], DataFrame]:
    """The known groups for lines (service, tokens): those of the lines' own buckets."""

    def known(lines: DataFrame) -> DataFrame:
        mine = [r["bucket"] for r in lines.select("service", F.size("tokens").alias("n_tokens")).select(_bucket()).distinct().collect()]  # BUCKETS at most
        return latest(store.read("groups", STATE, at).where(F.col("bucket").isin(mine))).select("service", "n_tokens", "b1", "b2", "place", "tokens")

    return known


def changed(groups: DataFrame, known: DataFrame, batch: int) -> DataFrame:
    """STATE rows of the groups that the batch made or changed."""
    same = lambda df: F.struct(*[F.col(c) for c in ("service", "n_tokens", "b1", "b2", "place", "tokens")])
    before = known.select(F.sha2(F.to_json(same(known)), 256).alias("_k")).distinct()
    return groups.withColumn("_k", F.sha2(F.to_json(same(groups)), 256)).join(before, "_k", "left_anti").drop("_k").select("*", F.lit(batch).cast("long").alias("batch"), _bucket())


def counted(lines: DataFrame, at: dict, window: str = WINDOW, lag: str = LAG) -> tuple[dict[str, DataFrame], dict]:
    """(window_counts and late_rows of a batch's lines (seq, ts, service, template_id, template); the facts after it)."""
    mark = at["facts"].get("watermark")
    w = F.window(F.col("ts").cast("timestamp"), window)
    x = lines.where(F.col("ts").isNotNull()).withColumn("_w", w)
    late = F.lit(False) if mark is None else F.unix_micros("_w.end") <= mark
    x = x.withColumn("_late", late)
    counts = x.groupBy(F.col("_w.start").alias("window_start"), "service", "template_id", "template").agg(F.count(F.lit(1)).alias("lines"), F.count_if("_late").alias("late_lines"))
    rows = x.where("_late").select("seq", "ts", F.col("_w.start").alias("window_start"), "service", "template_id")
    last = lines.agg(F.max(F.unix_micros(F.col("ts").cast("timestamp") - F.expr(f"INTERVAL {lag}")))).first()[0]
    marks = [m for m in (mark, last) if m is not None]
    return {"window_counts": counts, "late_rows": rows}, {"watermark": max(marks)} if marks else {}


def window_counts(spark: SparkSession, out: str) -> DataFrame:
    """window_start, service, template_id, template, lines, late_lines over all batches so far."""
    x = Committed(spark, out).read("window_counts", "window_start timestamp, service string, template_id string, template string, lines long, late_lines long")
    return summed(x)


def summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy("window_start", "service", "template_id", "template").agg(F.sum("lines").alias("lines"), F.sum("late_lines").alias("late_lines"))


def audit(logs: DataFrame, out: str, checkpoint: str, window: str = WINDOW, lag: str = LAG, once: bool = False, every: str = WINDOW) -> StreamingQuery:
    """Counts windows of a stream and keeps its late rows, without the triage; read by ``window_counts``."""

    def one(batch: DataFrame, number: int) -> None:
        store = Committed(batch.sparkSession, out)
        at = store.snapshot()
        if number > at["batch"]:
            tables, facts = counted(with_templates(prepare(_numbered(batch))), at, window, lag)
            store.commit(f"batch-{number:08d}", tables, number, facts)
            store.compact("window_counts", summed)

    w = logs.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime=every)).start()


def start(logs: DataFrame, out: str, checkpoint: str, config: Config | None = None, changes: DataFrame | None = None, once: bool = False, every: str = WINDOW, narrator=None, on_run: Callable[[Run], None] | None = None, ask=None, window: str = WINDOW, lag: str = LAG) -> StreamingQuery:
    """Runs each micro-batch through the batch plan and commits what it makes below ``out`` (``Committed``).

    The batch's number names its run. ask: a factory of judges for the backend ``remote``; its answers are kept among the
    batch's relations, or in ``config.cache``, and asked for no more while they are fresh.
    """
    cfg = config or Config()

    def one(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        store = Committed(spark, out)
        at = store.snapshot()
        if number <= at["batch"]:
            return
        if batch.isEmpty():
            store.commit(f"batch-{number:08d}", {}, number)
            return
        answers = Committed(spark, cfg.cache) if cfg.cache else store
        known = groups_of(store, at) if cfg.mining != "none" else None
        r = run(_numbered(batch), changes, cfg, f"batch-{number:08d}", narrator, ask=ask, cache=answers.read("answers", CACHE, None if cfg.cache else at), known=known)
        tables, facts = counted(r.lines, at, window, lag)
        tables |= relations(r)
        if r.groups is not None:
            tables["groups"] = changed(r.groups, r.known, number)
        if r.new_answers is not None and cfg.cache:
            answers.commit(r.run_id, {"answers": r.new_answers})
        elif r.new_answers is not None:
            tables["answers"] = r.new_answers
        store.commit(r.run_id, tables, number, facts, by={"groups": ["bucket"]})
        store.compact("groups", latest, ["bucket"])
        store.compact("window_counts", summed)
        if r.new_answers is not None:
            answers.compact("answers", newest)
        if on_run:
            on_run(r)

    w = logs.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime=every)).start()
