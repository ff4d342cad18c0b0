"""Approximate nearest neighbours by learned partitions, for the largest inner product.

Fit, on the driver, from at most ``SAMPLE`` vectors (those of the smallest hashes): the graph of each one's ``NEIGHBOURS``
nearest, a balanced partitioning of that graph (greedy with a capacity, then refined), and a softmax classifier of the
partition. The number of partitions probed is the least whose recall on sampled queries reaches ``TARGET``.

Every vector is indexed in its most probable partition. A query goes to its most probable partitions and is ranked there
against all vectors. Equal vectors are one entry with their smallest ids, which is all that a result can show; equal
queries are searched once. Partitions are split into blocks of bounded size, of vectors and of queries.

Candidates are chosen by matrix products; scores are then summed again in a fixed order, in double precision, so that
equal vectors have equal scores. Defined results: vectors that are null, zero, or hold null or non-finite components
take no part, nor do those whose length isn't the most frequent one; rows with a null id take no part. Repeated rows of
one id count once. Fewer than k candidates: all of them. Empty table: no rows.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

SAMPLE = 8192
NEIGHBOURS = 16
TARGET = 0.96
PARTITIONS = 64
#: Vectors, and queries, of a block; with larger blocks of queries vectors are rarely repeated.
BLOCK, QUERIES = 4096, 32_768

_log = logging.getLogger(__name__)


@dataclass
class Router:
    weights: np.ndarray
    bias: np.ndarray
    probes: int
    recall: float = 1.0  # on sampled queries

    def logits(self, x: np.ndarray) -> np.ndarray:
        return x / np.linalg.norm(x, axis=1, keepdims=True) @ self.weights + self.bias

    def homes(self, x: np.ndarray) -> np.ndarray:
        return self.logits(x).argmax(axis=1)

    def routes(self, x: np.ndarray) -> np.ndarray:
        return np.argsort(-self.logits(x), axis=1, kind="stable")[:, : self.probes]


def neighbour_graph(x: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
    near = np.empty((len(x), min(k, len(x) - 1)), dtype=np.int64)
    for i in range(0, len(x), 1024):
        g = x[i : i + 1024] @ x.T
        g[np.arange(len(g)), np.arange(i, i + len(g))] = -np.inf
        near[i : i + 1024] = np.argpartition(-g, near.shape[1] - 1, axis=1)[:, : near.shape[1]]
    return near


def balanced_parts(near: np.ndarray, parts: int, slack: float = 1.05, rounds: int = 12, seed: int = 0) -> np.ndarray:
    """A partition of the graph's nodes: each goes where most of its neighbours are, less as a part fills."""
    n = len(near)
    a, b = np.repeat(np.arange(n), near.shape[1]), near.ravel()
    order = np.argsort(np.concatenate([a, b]), kind="stable")
    ends = np.cumsum(np.bincount(np.concatenate([a, b]), minlength=n))
    around = np.split(np.concatenate([b, a])[order], ends[:-1])
    part, size, most = np.full(n, -1), np.zeros(parts), slack * n / parts + 1
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        for u in rng.permutation(n):
            if part[u] >= 0:
                size[part[u]] -= 1
            p = part[around[u]]
            gain = np.bincount(p[p >= 0], minlength=parts) * (1 - size / most) - 1e-6 * size
            gain[size >= most - 1] = -np.inf
            part[u] = int(gain.argmax())
            size[part[u]] += 1
    return part


def classifier(x: np.ndarray, target: np.ndarray, rounds: int = 150) -> tuple[np.ndarray, np.ndarray]:
    z = x / np.linalg.norm(x, axis=1, keepdims=True)
    w, b = np.zeros((x.shape[1], target.shape[1])), np.zeros(target.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for i in range(1, rounds + 1):
        p = z @ w + b
        p = np.exp(p - p.max(axis=1, keepdims=True))
        e = p / p.sum(axis=1, keepdims=True) - target
        g = z.T @ e / len(z) + 1e-5 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= m / (1 - 0.9**i) / (np.sqrt(v / (1 - 0.99**i)) + 1e-9) / (1 + i / 50)
        b -= 5 * e.mean(axis=0)
    return w, b


def fit(x: np.ndarray, parts: int = PARTITIONS, k: int = 20, target: float = TARGET, queries: int = 512) -> Router:
    """x: the sample, distinct vectors. Fewer than 16 vectors a partition lower the number of partitions."""
    parts = max(1, min(parts, len(x) // 16))
    if parts == 1:
        return Router(np.zeros((x.shape[1], 1)), np.zeros(1), 1)
    near = neighbour_graph(x)
    part = balanced_parts(near, parts)
    soft = np.zeros((len(x), parts))
    np.add.at(soft, (np.repeat(np.arange(len(x)), near.shape[1]), part[near].ravel()), 0.5 / near.shape[1])
    soft[np.arange(len(x)), part] += 0.5
    router = Router(*classifier(x, soft), parts)
    q = np.arange(0, len(x), max(1, len(x) // queries))
    g = x[q] @ x.T
    g[np.arange(len(q)), q] = -np.inf
    top = np.argpartition(-g, min(k, len(x) - 1) - 1, axis=1)[:, :k]
    place = np.argsort(router.routes(x[q]), axis=1)
    found = np.take_along_axis(place, router.homes(x)[top], axis=1)
    recall = np.array([(found < m).mean() for m in range(1, parts + 1)])
    router.probes = int(np.argmax(recall >= target)) + 1
    router.recall = float(recall[router.probes - 1])
    return router


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of the rows, summed in the order of the components."""
    out = np.zeros(len(q))
    for j in range(q.shape[1]):
        out += q[:, j] * x[:, j]
    return out


def nearest(q: np.ndarray, x: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, vector row, score) of each query's k largest products; ties to the smaller ``first``."""
    rows, cols, scores = [], [], []
    for i in range(0, len(q), 512):
        g = q[i : i + 512] @ x.T
        if k < len(x):
            low = np.partition(g, len(x) - k, axis=1)[:, len(x) - k]
            r, c = np.nonzero(g >= (low - 1e-9 * (1 + np.abs(low)))[:, None])
        else:
            r, c = (a.ravel() for a in np.indices(g.shape))
        s = products(q[i + r], x[c])
        o = np.lexsort((first[c], -s, r))
        r, c, s = r[o], c[o], s[o]
        start = np.searchsorted(r, np.arange(len(g)))
        keep = np.arange(len(r)) - start[r] < k
        rows.append(r[keep] + i), cols.append(c[keep]), scores.append(s[keep])
    return tuple(np.concatenate(a) if a else np.zeros(0, int) for a in (rows, cols, scores))


def _matrix(v: pd.Series, dims: int) -> np.ndarray:
    return np.stack(v.to_numpy()).astype(np.float64) if len(v) else np.zeros((0, dims))


def usable(vectors: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """id, v (array<double>) of the rows that take part, and their length (0 if there are none)."""
    v = F.col(vector).cast("array<double>")
    x = vectors.select(F.col(key).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull())
    whole = F.forall("v", lambda a: a.isNotNull() & ~F.isnan(a) & (F.abs(a) < F.lit(float("inf"))))
    x = x.where(whole & F.exists("v", lambda a: a != 0))
    size = x.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    dims = size[0]["d"] if size else 0
    return x.where(F.size("v") == dims), dims


def entries(x: DataFrame, keep: int) -> DataFrame:
    """v, g (smallest id), ids (its ``keep`` smallest ids): a row for each distinct vector. Hot vectors are salted."""
    once = x.select("id", "v", F.pmod(F.xxhash64("id"), F.lit(64)).alias("salt")).distinct()
    part = once.withColumn("r", F.row_number().over(Window.partitionBy("v", "salt").orderBy("id"))).where(F.col("r") <= keep)
    part = part.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("r") <= keep)
    return part.groupBy("v").agg(F.min("id").alias("g"), F.sort_array(F.collect_list("id")).alias("ids"))


def ann_search(vectors: DataFrame, is_query, k: int = 20, key: str = "vec_id", vector: str = "embedding", router: Router | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row for which ``is_query`` (a Column of ``id``) holds."""
    spark = vectors.sparkSession
    x, dims = usable(vectors, key, vector)
    if not dims:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = cut(entries(x, k + 1))
    if router is None:
        sample = index.select("v").orderBy(F.xxhash64("g"), "g").limit(SAMPLE).collect()
        router = fit(np.array([r["v"] for r in sample]), k=k)
        _log.warning("recall %.3f on sampled queries, with %d of %d partitions probed", router.recall, router.probes, len(router.bias))
    shared = spark.sparkContext.broadcast(router)

    def homed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield b.assign(p=shared.value.homes(_matrix(b["v"], dims)))[["g", "ids", "v", "p"]]

    def routed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield b.assign(ps=list(shared.value.routes(_matrix(b["v"], dims))))[["g", "v", "ps"]]

    homes = cut(index.mapInPandas(homed, "g long, ids array<long>, v array<double>, p int"))
    asked = x.where(is_query).select(F.col("id").alias("query_id"), "v").distinct()
    asked = cut(asked.join(index.select("v", "g"), "v").select("query_id", "g"))
    # equal queries once, and in blocks: both counts are numbers of the partitions, which are few
    wanted = index.join(asked.select("g").distinct(), "g", "left_semi").select("g", "v")
    routes = cut(wanted.mapInPandas(routed, "g long, v array<double>, ps array<int>").select("g", "v", F.explode("ps").alias("p")))
    blocks = lambda df, size: {r["p"]: -(-r["count"] // size) for r in df.groupBy("p").count().collect()}
    nx, nq = blocks(homes, BLOCK), blocks(routes, QUERIES)
    per = lambda n: F.element_at(F.array(*[F.lit(max(1, n.get(p, 1))) for p in range(len(router.bias))]), F.col("p") + 1)
    left = homes.withColumn("bx", F.pmod(F.xxhash64("g"), per(nx)).cast("int")).withColumn("bq", F.explode(F.sequence(F.lit(0), per(nq) - 1)))
    right = routes.withColumn("bq", F.pmod(F.xxhash64("g"), per(nq)).cast("int")).withColumn("bx", F.explode(F.sequence(F.lit(0), per(nx) - 1)))

    def ranked(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"q": [], "ids": [], "score": []})
        r, c, s = nearest(_matrix(b["v"], dims), _matrix(a["v"], dims), a["g"].to_numpy(), k + 1)
        return pd.DataFrame({"q": b["g"].to_numpy()[r], "ids": a["ids"].to_numpy()[c], "score": s})

    keys = ("p", "bx", "bq")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(ranked, "q long, ids array<long>, score double")
    found = found.select("q", "score", F.explode("ids").alias("id"))
    best = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    found = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1)
    lists = found.groupBy(F.col("q").alias("g")).agg(F.transform(F.sort_array(F.collect_list(F.struct("r", "id", "score"))), lambda e: F.struct(e.id.alias("id"), e.score.alias("score"))).alias("c"))
    out = asked.join(lists, "g")
    others = F.slice(F.filter("c", lambda e: e.id != F.col("query_id")), 1, k)
    out = out.select("query_id", F.posexplode(others).alias("i", "e"))
    return out.select("query_id", (F.col("i") + 1).cast("int").alias("rank"), F.col("e.id").alias("vec_id"), F.col("e.score").alias("score"))
