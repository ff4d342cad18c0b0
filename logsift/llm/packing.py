"""Best-fit packing by sums of squares.

A document is its token ids and an end id. One longer than the sequence length is cut so that only its first piece may be
shorter; full pieces are sequences by themselves. The shorter pieces are dealt to groups of bounded size by a hash of
row and place and packed there, longest first: each goes where the sum, over residual gaps, of the squared counts of open sequences becomes smallest.

Defined results. Null text counts as empty and is the end id alone. Rows with equal or null keys are packed one by one,
with pieces of their own. Empty table: no rows. Extra columns of the input are not carried.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, small_batches

END = 2
LENGTH = 1024
#: Documents that are packed together; what a group wastes is a few sequences.
GROUP = 32_768

_loaded: dict[str, object] = {}


def encoder(path: str):
    """A function from texts to lists of ids, kept for the life of the worker. path: a tokenizer's JSON file.

    The ids are those of the tokenizers library with its default settings and add_special_tokens=False: the string of an
    added token in a text is that token. Beside a ``.json`` there may be the same vocabulary as ``.tiktoken`` ranks,
    which give the same ids several times faster; without it the tokenizers library reads the JSON file.
    """
    if path not in _loaded:
        try:
            import public_tokenizers
            import tiktoken

            with open(path.removesuffix(".json") + ".tiktoken", "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            with open(path, encoding="utf-8") as f:
                added = json.load(f)["added_tokens"]
            if any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] for a in added):
                raise FileNotFoundError("added tokens that take more than their own string")
            e = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={a["content"]: a["id"] for a in added})
            marks = tuple(a["content"] for a in added)
            _loaded[path] = lambda s: e.encode(s, allowed_special="all") if any(m in s for m in marks) else e.encode_ordinary(s)
        except (ImportError, FileNotFoundError):
            from tokenizers import Tokenizer

            t = Tokenizer.from_file(path)
            _loaded[path] = lambda s: t.encode(s, add_special_tokens=False).ids
    return _loaded[path]


def cuts(n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: all of ``length`` but perhaps the first."""
    first = n if n <= length else n % length or length
    return [(0, first), *((s, length) for s in range(first, n, length))]


def pieces(docs: DataFrame, path: str, length: int = LENGTH, end: int = END, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, piece, start, length, ids_crc32: one row a piece, in one pass over the texts."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path)
        for x in batches:
            rows = []
            for k, t in zip(x["k"], x["t"]):
                ids = np.array([*encode(t), end], dtype="<u4")
                rows += [(k, i, s, n, zlib.crc32(ids[s : s + n].tobytes())) for i, (s, n) in enumerate(cuts(len(ids), length))]
            yield pd.DataFrame(rows, columns=["k", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(F.col(key).cast("string").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    out = out.mapInPandas(cut, "k string, piece int, start long, length long, ids_crc32 long")
    return out.select(F.col("k").cast(kind).alias(key), "piece", "start", "length", "ids_crc32")


def sum_of_squares(lengths: np.ndarray, size: int = LENGTH, early: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each length, in the order given; lengths are 1 to size.

    Of the open sequences that can hold the piece, it goes to the one that leaves the smallest sum; a new sequence is
    opened only where none can. early: the plain rule, by which a new sequence is one of the choices at every piece; it
    is meant for pieces that come in any order, and takes more sequences of pieces that come longest first (README).
    Ties go to the smallest gap, the new sequence last.
    """
    count = np.zeros(size + 1, dtype=np.int64)
    open_: list[list[int]] = [[] for _ in range(size + 1)]
    seq, off, made = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64), 0
    for i, s in enumerate(lengths.tolist()):
        # change of the sum of squares by taking a sequence of gap g and leaving one of g - s (a full one is not open)
        after = 2 * count[: size - s + 1] + 1
        after[0] = 0
        gain = after.copy()
        gain[:-1] += 1 - 2 * count[s:size]
        gain[:-1][count[s:size] == 0] = np.iinfo(np.int64).max
        gain[-1] = after[-1] if early else np.iinfo(np.int64).max - 1
        g = int(np.argmin(gain)) + s
        if g == size:
            b, made = made, made + 1
        else:
            b = open_[g].pop()
            count[g] -= 1
        seq[i], off[i] = b, size - g
        if g > s:
            open_[g - s].append(b)
            count[g - s] += 1
    return seq, off


def pack(cut: DataFrame, length: int = LENGTH, groups: int = 1, key: str = "doc_id", early: bool = False) -> DataFrame:
    """The pieces with sequence_id and offset; groups: how many are packed on their own."""

    def packed(x: pd.DataFrame) -> pd.DataFrame:
        x = x.assign(o=-x["length"]).sort_values(["o", "h", "k", "piece", "start", "ids_crc32"], kind="stable")
        short = (x["length"] < length).to_numpy()
        seq, off = np.empty(len(x), dtype=np.int64), np.zeros(len(x), dtype=np.int64)
        seq[short], off[short] = sum_of_squares(x["length"].to_numpy()[short], length, early)
        made = int(seq[short].max()) + 1 if short.any() else 0
        seq[~short] = made + np.arange((~short).sum())
        return x.assign(sequence_id=(x["g"].to_numpy().astype("int64") << 40) + seq, offset=off)[["k", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    kind = cut.schema[key].dataType.simpleString()
    # a hash spreads the pieces evenly; the place in the partition splits repeated rows, which all have one hash
    h = F.xxhash64(key, "ids_crc32", "length", F.monotonically_increasing_id())
    dealt = cut.select(F.col(key).cast("string").alias("k"), "piece", "start", "length", "ids_crc32", h.alias("h")).withColumn("g", F.pmod("h", F.lit(groups)))
    out = dealt.groupBy("g").applyInPandas(packed, "k string, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return out.select(F.col("k").cast(kind).alias(key), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def best_fit_packing(docs: DataFrame, path: str, length: int = LENGTH, end: int = END, group: int = GROUP, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a piece: key, piece, start, length, ids_crc32, sequence_id, offset."""
    small_batches(docs)
    groups = max(1, -(-docs.count() // group))
    # written down, so that a task that is run again after a loss numbers, and so deals, the same rows
    return pack(cut(pieces(docs, path, length, end, key, text)), length, groups, key)
