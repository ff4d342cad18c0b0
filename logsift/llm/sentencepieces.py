"""SentencePiece encoding and decoding as relations.

Texts become units: a run of U+2581 with the letters, or with the other characters, that follow it. Where a letter meets
another character they stay together if some piece of the table holds that very pair, so that no piece ever lies across a
cut; where such pairs are more than ``MOST_PAIRS`` or one to a hundred pieces, whole words are the units. Distinct units are exploded into substrings no
longer than the longest piece, these are joined to the piece table, edges are grouped by unit, and a fold with
``aggregate`` finds the path of the largest sum of scores (Viterbi; of equal paths the one whose last pieces start first).
A character that is no piece costs 10 more than the worst piece and becomes the pieces of its UTF-8 bytes.

How units return to their texts: the commonest units of a bounded sample (``HEAD`` of ``SAMPLE`` rows) are encoded first
and broadcast, which only decides where a unit is looked up. Blocks of rows are then written as numbers of these units and
lists of the rest, and shuffled once by block; the rest are encoded by the same lattice and shuffled to their blocks, those
of a task and block as one record. So neither texts nor occurrences of words are shuffled. The piece table has at most ``MOST_PIECES`` rows and is broadcast.

Scores: ``piece_rows`` gives a model file's own. A BPE model's are ranks of merges, which are no log probabilities;
``by_rank`` gives such a table the scores of Zipf's law, ``-ln(1 + rank)`` in steps of 1/64, so that sums are exact.

Defined results. Null or empty text: no ids. Texts and units are read whole, at any length. Repeated rows and null keys
are kept. Empty table: no rows. The text column is not carried, all others are; one named like the result is replaced.
Decoding: ids outside the table are left out, invalid UTF-8 becomes U+FFFD, and one leading space is dropped.
"""

from __future__ import annotations

import math
import re
import struct
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
MOST_PIECES = 400_000
#: Units that are broadcast, at most, and rows that they are found in.
HEAD, SAMPLE = 400_000, 20_000
#: Tasks of the lattice for each shuffle partition: a unit has some twenty edges, which are sorted before they are grouped.
TASKS = 4
_KINDS = "id int, piece string, score double, kind string"
#: Pairs of a letter and another character inside pieces at which units are held together, at most.
MOST_PAIRS = 64
#: Encoded units that a task packs into records of their blocks at once.
PACKED = 200_000
_RUN = f"(?:[^\\W\\d_]+|(?:[\\d_]|[^\\w{SPACE}])+)"
_APART = re.compile(f"{SPACE}*{_RUN}|{SPACE}+")
_TOGETHER = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_MIXED = re.compile(f"[^\\W\\d_](?:[\\d_]|[^\\w{SPACE}])|(?:[\\d_]|[^\\w{SPACE}])[^\\W\\d_]")

Pieces = list[tuple[int, str, float, str]]


def piece_rows(path: str) -> Pieces:
    """(id, piece, score, kind) of a model file; kind: normal, byte or other."""
    import sentencepiece

    s = sentencepiece.SentencePieceProcessor(model_file=path)
    kind = lambda i: "byte" if s.is_byte(i) else "other" if s.is_control(i) or s.is_unknown(i) or s.is_unused(i) else "normal"
    return [(i, s.id_to_piece(i), s.get_score(i), kind(i)) for i in range(s.get_piece_size())]


def by_rank(pieces: Pieces) -> Pieces:
    """The pieces with Zipf scores by their rank, which is the order of their own scores, then of ids."""
    order = sorted((-s, i) for i, _, s, k in pieces if k == "normal")
    score = {i: -round(64 * math.log(1 + r)) / 64 for r, (_, i) in enumerate(order, 1)}
    return [(i, p, score.get(i, s), k) for i, p, s, k in pieces]


def piece_table(spark: SparkSession, rows: Pieces) -> DataFrame:
    if len(rows) > MOST_PIECES:
        raise ValueError(f"{len(rows)} pieces; at most {MOST_PIECES}")
    return spark.createDataFrame(pd.DataFrame(rows, columns=["id", "piece", "score", "kind"]), _KINDS)


def splitter(pieces: Pieces) -> re.Pattern:
    pairs = sorted({a + b for _, p, _, k in pieces if k == "normal" for a, b in zip(p, p[1:]) if _MIXED.match(a + b)})
    if not pairs or len(pairs) > min(MOST_PAIRS, len(pieces) // 100):
        return _TOGETHER if pairs else _APART
    held = "|".join(f"(?<={re.escape(a)})(?={re.escape(b)})" for a, b in pairs)
    return re.compile(f"{SPACE}*{_RUN}(?:(?:{held}){_RUN})*|{SPACE}+")


def units_of(text: str | None, pattern: re.Pattern) -> list[str]:
    return pattern.findall(SPACE + text.replace(" ", SPACE)) if text else []


def viterbi(unit: Column, edges: Column) -> Column:
    """array<struct<id, start>> of the best path; edges: (end, start, score, id), one or more ending at every place."""
    start = F.array(F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("start"), F.lit(None).cast("int").alias("id")))

    def step(best: Column, e: Column) -> Column:
        new = F.struct((F.get(best, e.start).s + e.score).alias("s"), e.start.alias("start"), e.id.alias("id"))
        opens = F.size(best) == e.end  # the first edge that ends here
        wins = F.get(best, e.start).s + e.score > F.get(best, e.end).s
        return F.when(opens, F.concat(best, F.array(new))).when(wins, F.concat(F.slice(best, F.lit(1), e.end), F.array(new))).otherwise(best)

    def back(at: Column, best: Column) -> Column:
        here = F.get(best, at.at)
        took = F.struct(here.start.alias("at"), F.concat(F.array(F.struct(here.id.alias("id"), here.start.alias("start"))), at.path).alias("path"))
        return F.when(at.at > 0, took).otherwise(at)

    none = F.array().cast("array<struct<id:int,start:int>>")
    best = F.aggregate(F.sort_array(edges), start, step)
    n = F.length(unit)
    path = lambda b: F.aggregate(F.sequence(F.lit(1), n), F.struct(n.alias("at"), none.alias("path")), lambda at, _: back(at, b)).path
    return F.element_at(F.transform(F.array(best), path), 1)


def lattice(units: DataFrame, pieces: Pieces) -> DataFrame:
    """_w, _first (smallest _at, a number), _ids of the distinct units of rows (_w, _at) that ``by_unit`` has dealt.

    The explosion, the join and the grouping keep that partitioning, so nothing else is shuffled, and a join of the same
    rows with the result has the shuffle in common with it.
    """
    table = piece_table(units.sparkSession, pieces).where("kind = 'normal'").select("piece", "id", "score")
    normal = [(p, s) for _, p, s, k in pieces if k == "normal"]
    longest, low = max((len(p) for p, _ in normal), default=1), min((s for _, s in normal), default=0.0) - UNKNOWN_PENALTY
    byte0 = next((i for i, p, _, k in pieces if k == "byte" and p == "<0x00>"), None)
    unknown = next((i for i, _, _, k in pieces if k == "other"), 0)

    n = F.length("_w")
    # rows of a unit are sorted by its hash, a number, before they meet
    once = units.groupBy("_w").agg(F.min("_at").alias("_first"))
    starts = once.select("_w", "_first", F.xxhash64("_w").alias("_h"), F.explode(F.sequence(F.lit(0), n - 1)).alias("start"))
    spans = starts.select("_w", "_first", "_h", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), n - F.col("start")))).alias("len"))
    spans = spans.select("*", F.substring("_w", F.col("start") + 1, F.col("len")).alias("piece"))
    found = spans.join(F.broadcast(table), "piece", "left").where("id is not null or len = 1")
    edge = F.struct((F.col("start") + F.col("len")).alias("end"), "start", F.coalesce("score", F.lit(low)).alias("score"), "id")
    paths = found.groupBy("_h", "_w", "_first").agg(F.collect_list(edge).alias("e")).select("_w", "_first", viterbi(F.col("_w"), F.col("e")).alias("path"))

    def spelt(v: Column) -> Column:
        if byte0 is None:
            return F.array(F.lit(unknown))
        code = F.hex(F.encode(F.substring(F.col("_w"), v.start + 1, F.lit(1)), "UTF-8"))
        return F.transform(F.sequence(F.lit(1), F.length(code), F.lit(2)), lambda j: (F.conv(F.substring(code, j, F.lit(2)), 16, 10).cast("int") + byte0))

    whole = F.transform("path", lambda v: v.id)
    odd = F.flatten(F.transform("path", lambda v: F.when(v.id.isNotNull(), F.array(v.id)).otherwise(spelt(v))))
    return paths.select("_w", "_first", F.when(F.exists("path", lambda v: v.id.isNull()), odd).otherwise(whole).alias("_ids"))


def by_unit(units: DataFrame) -> DataFrame:
    return units.repartition(TASKS * int(units.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_w")


def common_units(df: DataFrame, pattern: re.Pattern, text: str) -> DataFrame:
    """_w, n: the commonest units of a sample, HEAD at most, and how often they come there."""
    total = df.count()
    some = df.select(F.col(text).alias("t"))
    some = some.sample(SAMPLE / total, 5).limit(2 * SAMPLE) if total > SAMPLE else some

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            c = Counter(u for t in x["t"] for u in units_of(t, pattern))
            yield pd.DataFrame({"_w": list(c.keys()), "n": list(c.values())})

    counts = some.mapInPandas(counted, "_w string, n long").groupBy("_w").agg(F.sum("n").alias("n"))
    return counts.orderBy(F.desc("n"), "_w").limit(HEAD)


def encode(df: DataFrame, pieces: Pieces, text: str = "text", out: str = "ids") -> DataFrame:
    """df (without the text) with ``out``: array<int>, the ids of the text."""
    small_batches(df)
    spark, pattern = df.sparkSession, splitter(pieces)
    names = [c for c in df.columns if c not in (text, out)]
    head = lattice(by_unit(common_units(df, pattern, text).select("_w", (-F.col("n")).alias("_at"))), pieces).toArrow().sort_by([("_first", "ascending"), ("_w", "ascending")])  # small numbers for common units
    listed = head.column("_ids").combine_chunks()
    shared = spark.sparkContext.broadcast((head.column("_w").to_pylist(), listed.flatten().to_numpy().astype(np.int32), listed.offsets.to_numpy().astype(np.int64)))
    rows = df.select(*[F.col(f"`{c}`") for c in names], F.col(text).cast("string").alias("_t"))
    carried = rows.drop("_t").schema

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = _Numbers((w, i) for i, w in enumerate(shared.value[0]))
        part, i = TaskContext.get().partitionId(), 0
        for x in batches:
            sizes, found = np.empty(len(x), dtype=np.int64), []
            for j, t in enumerate(x.column("_t").to_pylist()):
                us = units_of(t, pattern)
                sizes[j] = len(us)
                found.append(np.fromiter(map(at.__getitem__, us), np.int32, len(us)))
            rest = at.taken()
            kept = [c for c in x.schema.names if c != "_t"]
            body = pa.RecordBatch.from_arrays([*(x.column(c) for c in kept), pa.array(sizes)], names=[*kept, "_n"])
            blob = _packed(pa.RecordBatch.from_arrays([pa.array(rest, pa.string())], names=["w"]), body, np.concatenate([*found, np.zeros(0, np.int32)]))
            yield pa.RecordBatch.from_arrays([pa.array([part << 32 | i], pa.int64()), pa.array([blob], pa.binary())], names=["_block", "_rows"])
            i += 1

    def rest_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for block, blob in zip(x.column("_block").to_pylist(), x.column("_rows").to_pylist()):
                w = _rest(blob).column("w").combine_chunks()
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(w), block)), pa.array(np.arange(len(w), dtype=np.int32)), w], names=["_block", "_k", "_w"])

    kind = T.StructType([*carried.fields, T.StructField(out, T.ArrayType(T.IntegerType()))])

    def joined(left: pa.Table, right: pa.Table) -> pa.Table:
        _, flat, ends = shared.value
        k, sizes, own = (np.concatenate(x) for x in zip((np.zeros(0, np.int32),) * 3, *map(_units, right.column("_units").to_pylist())))
        order = np.argsort(k)
        lengths, first = sizes[order].astype(np.int64), (np.cumsum(sizes, dtype=np.int64) - sizes)[order]
        tables = []
        for blob in left.column("_rows").to_pylist():
            body, n = _body(blob)
            is_head = n >= 0
            tail = -1 - n[~is_head]
            start, size = np.empty(len(n), np.int64), np.empty(len(n), np.int64)
            start[is_head], size[is_head] = ends[n[is_head]], ends[n[is_head] + 1] - ends[n[is_head]]
            start[~is_head], size[~is_head] = len(flat) + first[tail], lengths[tail]
            total = np.concatenate([[0], np.cumsum(size)])
            place = np.repeat(start - total[:-1], size) + np.arange(total[-1])
            values = np.concatenate([flat, own])[place] if len(place) else np.zeros(0, np.int32)
            offsets = total[np.concatenate([[0], np.cumsum(body.column("_n").to_numpy())])]
            lists = pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array(values.astype(np.int32)))
            tables.append(body.drop_columns(["_n"]).append_column(out, lists) if names else pa.table({out: lists}))
        return pa.concat_tables(tables)

    found = rows.mapInArrow(blocks, "_block long, _rows binary").repartition("_block")
    rest = by_unit(found.mapInArrow(rest_of, "_block long, _k int, _w string"))
    at = F.xxhash64("_block", "_k")  # holds for any row; it reads the columns that the join needs, so both have one shuffle
    coded = rest.join(lattice(rest.select("_w", at.alias("_at")), pieces), "_w").where(at >= F.col("_first")).select("_block", "_k", "_ids")
    sent = coded.mapInArrow(_by_block, "_block long, _units binary")
    return found.groupBy("_block").cogroup(sent.groupBy("_block")).applyInArrow(joined, kind)


class _Numbers(dict):
    """Numbers of units; one that has none gets the next of -1, -2, ... until those are taken back."""

    def __init__(self, known):
        super().__init__(known)
        self.rest: list[str] = []

    def __missing__(self, unit: str) -> int:
        self.rest.append(unit)
        self[unit] = n = -len(self.rest)
        return n

    def taken(self) -> list[str]:
        rest, self.rest = self.rest, []
        for u in rest:
            del self[u]
        return rest


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """_block, _units: the encoded units (_block, _k, _ids) of a task, packed by block."""
    held: list[pa.RecordBatch] = []

    def packed() -> pa.RecordBatch:
        x = pa.Table.from_batches(held)
        block, k, ids = x.column("_block").to_numpy(), x.column("_k").to_numpy(), x.column("_ids").combine_chunks()
        flat, ends = ids.values.to_numpy(), ids.offsets.to_numpy().astype(np.int64)
        order = np.lexsort((k, block))
        block, k, size, start = block[order], k[order], np.diff(ends)[order], ends[:-1][order]
        total = np.concatenate([[0], np.cumsum(size)])
        flat = flat[np.repeat(start - total[:-1], size) + np.arange(total[-1])]
        cuts = np.concatenate([np.flatnonzero(np.diff(block, prepend=block[0] - 1)), [len(block)]])
        blobs = [_packed_units(k[a:b], size[a:b], flat[total[a] : total[b]]) for a, b in zip(cuts[:-1], cuts[1:])]
        return pa.RecordBatch.from_arrays([pa.array(block[cuts[:-1]], pa.int64()), pa.array(blobs, pa.binary())], names=["_block", "_units"])

    for x in batches:
        if len(x):
            held.append(x)
        if sum(map(len, held)) >= PACKED:
            yield packed()
            held.clear()
    if held:
        yield packed()


def _planes(*numbers: np.ndarray) -> bytes:
    """Numbers of 32 bits by bytes of equal rank, which compress to two thirds of what whole numbers do."""
    parts = [np.ascontiguousarray(v.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes() for v in numbers]
    return pa.compress(b"".join(parts), codec="zstd", asbytes=True)


def _units(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers (ascending), counts of ids, and all ids of a record of units."""
    n, m = struct.unpack_from("<ii", blob)
    raw = np.frombuffer(pa.decompress(blob[8:], decompressed_size=4 * (2 * n + m), codec="zstd", asbytes=True), dtype=np.uint8)
    parts = [np.ascontiguousarray(raw[4 * a : 4 * b].reshape(4, -1).T).view("<i4").ravel() for a, b in ((0, n), (n, 2 * n), (2 * n, 2 * n + m))]
    return np.cumsum(parts[0], dtype=np.int32), parts[1], parts[2]


def _packed_units(k: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> bytes:
    return struct.pack("<ii", len(k), len(ids)) + _planes(np.diff(k, prepend=0), sizes, ids)


def _packed(rest: pa.RecordBatch, body: pa.RecordBatch, numbers: np.ndarray) -> bytes:
    """A block: the other units, the rows with their counts of units, and the planes of all numbers of units."""
    parts = []
    for batch in (rest, body):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_batch(batch)
        parts.append(sink.getvalue().to_pybytes())
    return struct.pack("<qqq", len(parts[0]), len(parts[1]), 4 * len(numbers)) + b"".join(parts) + _planes(numbers)


def _rest(blob: bytes) -> pa.Table:
    a, _, _ = struct.unpack_from("<qqq", blob)
    return pa.ipc.open_stream(blob[24 : 24 + a]).read_all()


def _body(blob: bytes) -> tuple[pa.Table, np.ndarray]:
    a, b, size = struct.unpack_from("<qqq", blob)
    planes = np.frombuffer(pa.decompress(blob[24 + a + b :], decompressed_size=size, codec="zstd", asbytes=True), dtype=np.uint8)
    return pa.ipc.open_stream(blob[24 + a : 24 + a + b]).read_all(), np.ascontiguousarray(planes.reshape(4, -1).T).view("<i4").ravel()


def decode(df: DataFrame, pieces: Pieces, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """df with ``out``, the text of the ids; the table of the pieces' bytes, a vocabulary, is broadcast."""
    small_batches(df)
    spelt = {i: bytes.fromhex(p[3:5]) if k == "byte" else p.replace(SPACE, " ").encode("utf-8") for i, p, _, k in pieces if k != "other"}
    last = max(spelt, default=-1) + 1
    shared = df.sparkSession.sparkContext.broadcast([spelt.get(i, b"") for i in range(last)] + [b""])  # the last for ids outside

    @F.pandas_udf("string")
    def joined(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = pa.array(shared.value, pa.large_binary())
        for x in batches:
            flat = np.concatenate([np.zeros(0, np.int32), *x])
            taken = table.take(pa.array(np.where((flat >= 0) & (flat < last), flat, last).astype(np.int64)))
            _, offsets, data = taken.buffers()
            ends = np.frombuffer(offsets, np.int64)[np.cumsum([0, *map(len, x)])] if len(flat) else np.zeros(len(x) + 1, np.int64)
            raw = memoryview(data) if data else memoryview(b"")
            yield pd.Series([str(raw[a:b], "utf-8", "replace").removeprefix(" ") for a, b in zip(ends[:-1], ends[1:])], dtype=object)

    names = [F.col(f"`{c}`") for c in df.columns if c != out]
    return df.select(*names, joined(F.coalesce(ids, F.array().cast("array<int>"))).alias(out))
