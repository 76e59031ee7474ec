"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

1. The rotation is learned on a bounded sample (``SAMPLE`` vectors, those with
   the smallest id hashes): centre, principal axes, then iterative quantisation
   turns the axes so that signs lose as little as possible. A vector's code is
   the ``BITS`` signs. The sample also gives the Hamming radius within which
   ``COVERED`` of its own nearest neighbours lie; in the whole table neighbours
   are nearer, so the radius errs to the safe side.
2. All vectors are dealt into shards by a hash of their id, so no cluster and no
   common vector makes a shard large. A shard indexes each of the ``PARTS``
   substrings of its codes.
3. Queries go to every shard, in blocks. By the pigeonhole principle a code
   within the radius agrees with the query's in one substring up to its share
   of the radius, so looking up all values that near to the query's substring,
   in every substring, finds every code within the radius. Codes are checked
   in full and the floats of those that remain are ranked. A query with fewer
   than k finds in a shard ranks the whole shard.
4. The best k of each shard are merged for each query.

Only vectors with an id, of the commonest length, without null or non-finite
components and not all zero take part. A row that repeats an id and a vector
counts once; of a query id with several vectors the smallest is taken.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BITS = 64
PARTS = 8
SAMPLE = 4096
COVERED = 0.95
TURNS = 40
SHARD = 8192
QUERY_BLOCK = 2048
K = 10


def valid_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v: array of double) of the vectors that take part, of any length."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    return (vectors.select(F.col(id_col).cast("bigint").alias("id"), v.alias("v"))
            .where("id is not null and v is not null and size(v) > 0")
            .where("forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
            .where("exists(v, x -> x <> 0)"))


class Rotation:
    """Centre, turned axes and Hamming radius, fitted on a sample."""

    def __init__(self, x: np.ndarray, k: int = K):
        rng = np.random.default_rng(5)
        self.centre = x.mean(0)
        y = x - self.centre
        _, axes = np.linalg.eigh(y.T @ y)
        axes = axes[:, ::-1][:, :BITS]
        y = np.pad(y @ axes, ((0, 0), (0, BITS - axes.shape[1])))
        turn = np.linalg.qr(rng.normal(size=(BITS, BITS)))[0]
        for _ in range(TURNS):
            signs = np.where(y @ turn > 0, 1.0, -1.0)
            u, _, vt = np.linalg.svd(signs.T @ y)
            turn = (u @ vt).T
        self.axes = axes @ turn[: axes.shape[1]]
        codes = self.codes(x)
        probe = min(len(x), 512)
        far = ((x[:probe, None] ** 2).sum(2) - 2 * x[:probe] @ x.T + (x ** 2).sum(1))
        far[np.arange(probe), np.arange(probe)] = np.inf
        near = np.argsort(far, axis=1)[:, : min(k, len(x) - 1)]
        apart = np.bitwise_count(codes[:probe, None] ^ codes[near])
        self.radius = int(np.quantile(apart, COVERED, method="higher")) if near.size else BITS

    def codes(self, x: np.ndarray) -> np.ndarray:
        bits = (x - self.centre) @ self.axes > 0
        return np.packbits(bits, axis=1).view(np.uint64)[:, 0]


def probes(radius: int) -> list[np.ndarray]:
    """Per substring, the flips to try: all within its share of ``radius``.

    With radius = PARTS * r + s, s + 1 substrings may differ in r bits and the
    others in r - 1: if all differed in more, the sum would exceed the radius.
    """
    width = BITS // PARTS
    share, over = divmod(radius, PARTS)
    out = []
    for i in range(PARTS):
        most = min(width, share if i <= over else share - 1)
        out.append(np.array([sum(1 << b for b in some) for n in range(most + 1) for some in combinations(range(width), n)],
                            np.uint8))
    return out


class Shard:
    """The substring indexes of one block of vectors."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, codes: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x, self.codes = ids[order], x[order], codes[order]
        parts = self.codes.view(np.uint8).reshape(-1, PARTS)
        self.rows = [np.argsort(p, kind="stable") for p in parts.T]
        self.starts = [np.searchsorted(p[r], np.arange(257)) for p, r in zip(parts.T, self.rows)]

    def search(self, own: int, x: np.ndarray, code: np.uint64, flips: list[np.ndarray], radius: int, k: int):
        """(ids, distances) of the nearest of the codes within the radius, nearest first, then smaller id."""
        marked = np.zeros(len(self.ids), bool)
        for part, rows, starts, flip in zip(np.array([code]).view(np.uint8), self.rows, self.starts, flips):
            values = (part ^ flip).astype(np.int64)
            low, size = starts[values], starts[values + 1] - starts[values]
            ends = np.cumsum(size)
            marked[rows[np.repeat(low - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]] = True
        marked &= np.bitwise_count(self.codes ^ code) <= radius
        marked &= self.ids != own
        if marked.sum() < k:
            marked = self.ids != own
        found = np.flatnonzero(marked)
        apart = np.sqrt(((self.x[found] - x) ** 2).sum(1))
        order = np.lexsort((self.ids[found], apart))
        ids, apart = self.ids[found][order], apart[order]
        first = np.sort(np.unique(ids, return_index=True)[1])[:k]
        return ids[first], apart[first]


def fit(vectors: DataFrame) -> tuple[Rotation | None, int]:
    """(rotation, length of the vectors) from (id, v); None for an empty table."""
    common = vectors.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if common is None:
        return None, 0
    d = common["d"]
    rows = (vectors.where(F.size("v") == d).withColumn("_h", F.xxhash64("id")).orderBy("_h", "id", "v").limit(SAMPLE)
            .select("v").collect())
    return Rotation(np.array([r["v"] for r in rows], np.float64)), d


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding",
            shard: int = SHARD, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every query, by Euclidean distance."""
    base = valid_vectors(vectors, id_col, vec_col)
    rotation, d = fit(base)
    schema = "query_id bigint, vec_id bigint, score double"
    if rotation is None:
        empty = vectors.sparkSession.createDataFrame([], schema)
        return empty.select("query_id", F.lit(1).alias("rank"), "vec_id", "score")
    base = base.where(F.size("v") == d)
    asked = (valid_vectors(queries, id_col, vec_col).where(F.size("v") == d)
             .groupBy("id").agg(F.min("v").alias("v")))
    shards, blocks = max(1, -(-base.count() // shard)), max(1, -(-asked.count() // query_block))
    flips, radius = probes(rotation.radius), rotation.radius

    def search(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            x = np.array(left["v"].tolist(), np.float64)
            index = Shard(left["id"].to_numpy(np.int64), x, rotation.codes(x))
            q = np.array(right["v"].tolist(), np.float64)
            for own, vector, code in zip(right["id"].to_numpy(np.int64), q, rotation.codes(q)):
                ids, apart = index.search(own, vector, code, flips, radius, k)
                out.append(pd.DataFrame({"query_id": own, "vec_id": ids, "score": apart}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    spread = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    index = base.select(F.pmod(F.xxhash64("id"), F.lit(shards)).alias("shard"), spread.alias("block"), "id", "v")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint")))
    asked = asked.select(every.alias("shard"), F.pmod(F.xxhash64("id", F.lit(3)), F.lit(blocks))
                         .cast("int").alias("block"), "id", "v")
    found = index.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(search, schema)

    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return (found.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
