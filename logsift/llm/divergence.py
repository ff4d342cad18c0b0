"""Audit of how the sources of a language differ in their words: sums over pairs of sources, and each source's own terms.

Tasks count the terms of their documents; rows of (language, source, term) counts are then dealt to shards by a hash of
language and term, where DuckDB sums them and keeps the terms of enough documents, in one pass over a stream of batches.
From the kept counts Spark has each group's totals, and with them each row's share ``p``. A second pass over the shards
computes, by one SQL statement a shard, the partial sums of the divergence over pairs of sources that have a term in
common, and the shard's highest terms of each source. Spark merges sums and ranks.

Most terms are in few sources. Where a source lacks a term, its share depends on its totals alone, so a pair's sum is
``V`` times the divergence of two absent terms, plus what the terms of either source change by themselves (from the number
of its terms of each count), plus what common terms change beyond that. No shard sees terms that a source doesn't have.

All numbers are whole: shares are at least 1 and about 10^9 at most, so their squares hold in 64 bits; products with counts
are decimals. A shard holds the counts of its own terms, one row a source.

Defined results. Null text, lang and source count as empty text. A source without terms is a group like others. Rows that
come again are documents of their own. Empty table: no rows. Extra columns are not read. Ids are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import once
from .common import cut, small_batches

LEAST_DOCS, TOP, SCALE = 3, 200, 1_000_000_000
#: Distinct (lang, source, term) that a task holds before it hands their counts on.
HELD = 500_000
#: Shards of the first pass for each of Spark's shuffle partitions, which take several, so that they are even.
SHARDS = 4
#: Rows of counts that a shard of the second pass gets on average, at most.
SHARD_ROWS = 50_000
#: Groups up to so many are broadcast.
BROADCAST_ROWS = 50_000

_TERM = re.compile(rb"[a-z\x80-\xff]+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def terms(docs: DataFrame, shards: int, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """shard, rows: occurrences and documents of terms, counted in each task, and an empty term for each group. rows: a record
    batch of lang, source, term, n, docs whose languages and terms have the shard's hash.

    So Spark shuffles a row a shard, not one a term. Bytes from 0x80 on belong to code points that are no ASCII, all of
    which are parts of terms.
    """
    small_batches(docs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[tuple[str, str], Counter] = {}
        d: dict[tuple[str, str], Counter] = {}
        held = 0

        def out() -> Iterator[pa.RecordBatch]:
            parts, at = [], []
            for g, own in n.items():  # both counters met their terms in the same order
                names, salt = [*own, b""], zlib.crc32(g[0].encode())
                same = [pa.repeat(pa.scalar(v, pa.string()), len(names)) for v in g]
                parts.append(pa.RecordBatch.from_arrays([*same, pa.array(names, pa.binary()).cast(pa.string()), pa.array([*own.values(), 0], pa.int64()), pa.array([*d[g].values(), 0], pa.int64())], schema=_COUNTS))
                at += [zlib.crc32(t, salt) % shards for t in names]
            n.clear()  # before the rows are copied in the order of shards
            d.clear()
            if not at:
                return
            order = np.argsort(np.array(at), kind="stable")
            own_shard = np.array(at)[order]
            rows = pa.Table.from_batches(parts).take(pa.array(order)).combine_chunks().to_batches()[0]
            ends = [*np.flatnonzero(np.diff(own_shard)) + 1, len(order)]
            starts = [0, *ends[:-1]]
            blobs = [rows.slice(i, j - i).serialize().to_pybytes() for i, j in zip(starts, ends)]
            for i in range(0, len(blobs), 256):
                yield pa.RecordBatch.from_arrays([pa.array(own_shard[starts[i : i + 256]], pa.int32()), pa.array(blobs[i : i + 256], pa.binary())], names=["shard", "rows"])

        for b in batches:
            for g, t in zip(zip(b.column(0).to_pylist(), b.column(1).to_pylist()), b.column(2).cast(pa.binary()).to_pylist()):
                own = Counter(_TERM.findall(t.translate(_LOWER)))
                all_n, all_d = n.setdefault(g, Counter()), d.setdefault(g, Counter())
                before = len(all_n)
                all_n.update(own)
                all_d.update(own.keys())
                held += len(all_n) - before
                if held > HELD:
                    yield from out()
                    held = 0
        yield from out()

    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.select(empty(lang), empty(source), empty(text)).mapInArrow(count, "shard int, rows binary")


def _duck(batches: Iterator[pa.RecordBatch], sql: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The statement's rows over the stream ``t`` of this task's batches; nothing where there are none."""
    import duckdb

    first = next(batches, None)
    if first is None:
        return

    def stream() -> Iterator[pa.RecordBatch]:
        yield first
        yield from batches

    con = duckdb.connect(config={"threads": 1})
    con.register("t", pa.RecordBatchReader.from_batches(first.schema, stream()))
    rows = con.sql(sql).to_arrow_table().cast(schema)
    con.close()
    yield from rows.to_batches(max_chunksize=10_000)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for rows in b.column("rows"):
            yield pa.ipc.read_record_batch(rows.as_buffer(), _COUNTS)


def kept_counts(counted: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Of ``terms``: lang, source, term, n, lang_n: rows of kept terms with the language's own count; n is 0 for a group's empty term."""
    sql = f"""
WITH s AS (SELECT lang, source, term, sum(n)::BIGINT AS n, sum(docs)::BIGINT AS docs FROM t GROUP BY ALL),
l AS (SELECT *, sum(n) OVER w AS lang_n, sum(docs) OVER w AS lang_docs FROM s WINDOW w AS (PARTITION BY lang, term))
SELECT lang, source, term, n, lang_n::BIGINT AS lang_n FROM l WHERE term = '' OR lang_docs >= {least_docs}"""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("lang_n", pa.int64())])
    return counted.repartition("shard").mapInArrow(lambda b: _duck(_unpacked(b), sql, schema), "lang string, source string, term string, n long, lang_n long")


def share(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + v)), whole."""
    return F.lit(1).cast("long") + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(19,0)"), (total + v).cast("decimal(20,0)"))


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q), whole."""
    return F.call_function("div", (p - q) * (p - q), q)


def groups(kept: DataFrame) -> DataFrame:
    """lang, source, total, v, lang_total, p0 of every group: V is the language's kept terms, p0 the share of an absent one."""
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # a term has one row a source; the smallest source of each stands for the term
    first = kept.where("term <> ''").groupBy("lang", "term").agg(F.max("lang_n").alias("n"))
    langs = first.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("lang_total"))
    x = own.join(langs, "lang", "left").na.fill(0, ["v", "lang_total"])
    return x.withColumn("p0", F.when(F.col("v") > 0, share(F.lit(0), F.col("total"), F.greatest(F.col("v"), F.lit(1)))))


def shard_sums(rows: DataFrame, shards: int, top: int = TOP) -> DataFrame:
    """part, lang, source, item, value of each shard: what common terms add to pairs, and its ``top`` terms of each source.

    rows: lang, source, term, p, p0, q. Where a shard has pairs of one source in many terms, they are summed before they
    leave it.
    """
    sql = f"""
WITH x AS MATERIALIZED (SELECT * FROM t),
b AS (SELECT a.lang, a.source, b.source AS item, a.p, b.p AS bp, a.p0, b.p0 AS b0 FROM x a JOIN x b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source),
s AS (SELECT 'pair' AS part, lang, source, item, sum((p - bp) * (p - bp) // bp - (p - b0) * (p - b0) // b0 - (p0 - bp) * (p0 - bp) // bp + (p0 - b0) * (p0 - b0) // b0) AS value FROM b GROUP BY lang, source, item),
h AS (SELECT 'term' AS part, lang, source, term AS item, (p - q) * (p - q) // q AS value FROM x WHERE p > q QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) <= {top})
SELECT part, lang, source, item, value::DECIMAL(38, 0)::VARCHAR AS value FROM s UNION ALL SELECT part, lang, source, item, value::VARCHAR FROM h"""
    schema = pa.schema([(c, pa.string()) for c in ("part", "lang", "source", "item", "value")])
    out = rows.repartition(shards, "lang", "term").mapInArrow(lambda b: _duck(b, sql, schema), "part string, lang string, source string, item string, value string")
    return out.withColumn("value", F.col("value").cast("decimal(38,0)"))


def ranked(x: DataFrame, part: str, top: int | None = None) -> DataFrame:
    """Rows with their rank in lang and source, by value and then item; with ``top``, first within salts."""
    order = [F.desc("value"), "item"]
    if top:
        salted = Window.partitionBy("lang", "source", F.pmod(F.xxhash64("item"), F.lit(64))).orderBy(*order)
        x = x.withColumn("_r", F.row_number().over(salted)).where(F.col("_r") <= top).drop("_r")
    x = x.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)))
    x = x.where(F.col("rank") <= top) if top else x
    return x.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"), "rank")


def source_divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = LEAST_DOCS, top: int = TOP, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = cut(kept_counts(terms(docs, SHARDS * least, text, lang, source), least_docs))
    of = cut(groups(kept))
    small = F.broadcast(of) if of.count() <= BROADCAST_ROWS else of
    rows = kept.where("term <> ''").join(small, ["lang", "source"])
    rows = rows.select("lang", "source", "term", once(share(F.col("n"), F.col("total"), F.col("v"))).alias("p"), "p0", once(share(F.col("lang_n"), F.col("lang_total"), F.col("v"))).alias("q"))
    rows = cut(rows)  # read by the shards and for the terms of each source
    found = cut(shard_sums(rows, max(least, -(-rows.count() // shard_rows)), top))
    pairs = of.select("lang", "source", "v", "p0").join(of.select("lang", F.col("source").alias("item"), F.col("p0").alias("i0")), "lang").where("source <> item")
    base = pairs.select("lang", "source", "item", F.coalesce(F.col("v").cast("decimal(38,0)") * gap(F.col("p0"), F.col("i0")), F.lit(0)).cast("decimal(38,0)").alias("value"))
    alike = rows.groupBy("lang", "source", "p", "p0").agg(F.count(F.lit(1)).alias("k"))
    each = alike.join(of.select("lang", F.col("source").alias("other"), F.col("p0").alias("o0")), "lang").where("source <> other")
    own = each.select("lang", F.col("source"), F.col("other").alias("item"), (F.col("k") * (gap(F.col("p"), F.col("o0")) - gap(F.col("p0"), F.col("o0")))).cast("decimal(38,0)").alias("value"))
    others = each.select("lang", F.col("other").alias("source"), F.col("source").alias("item"), (F.col("k") * (gap(F.col("o0"), F.col("p")) - gap(F.col("o0"), F.col("p0")))).cast("decimal(38,0)").alias("value"))
    sums = base.union(own).union(others).union(found.where("part = 'pair'").select("lang", "source", "item", "value")).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    return ranked(sums, "pair").union(ranked(found.where("part = 'term'"), "term", top))
