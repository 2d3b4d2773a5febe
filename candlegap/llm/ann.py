"""Operator 6: approximate nearest neighbours by multi-index hashing.

* **Codes.** Vectors are scaled by the largest norm and given one more component that makes
  all norms equal, so the largest inner product is the smallest angle. ``ROTATIONS``
  rotations are learned on a bounded sample (iterative quantisation: the rotation that
  brings the sample closest to the corners of a cube); the signs of the rotated vectors are
  the code.
* **Index.** Rows are dealt to shards of about ``SHARD_ROWS``. A code is cut into 8-bit
  substrings and each is indexed. Codes within radius ``R = m r + a`` of a query have one of
  the first ``a + 1`` substrings within r, or one of the others within r - 1: for each
  substring value the shard keeps the bitmap of the rows within that distance, so probing
  is the union of one bitmap per substring and finds every code within the radius.
* **Search.** Candidates within the radius are reranked by inner products in double
  precision. The radius is learned on the sample for ``RECALL`` of the neighbours. A shard with
  fewer than k candidates is reranked whole, so no query comes back short.

Queries come in blocks of about ``QUERY_ROWS``; each pair of a shard and a block is one
task's work, so memory does not grow with the table.

Defined results: vectors that are NULL, zero, of another length than most, or hold a NULL or
non-finite component, and rows without ``vec_id``, take no part; rows that repeat a ``vec_id`` are
a query for each of their vectors, told apart by ``vector``, a hash of it, and equal rows are one query; a query's
own candidates exclude all rows with its ``vec_id``; equal scores go by ``vec_id``; fewer candidates than k are all
returned; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from candlegap.llm.common import read_table, spread

SAMPLE_ROWS = 4096
ROTATIONS = 2
ITERATIONS = 25
RECALL = 0.98
SHARD_ROWS = 8192
QUERY_ROWS = 4096
K = 20
QUERY_EVERY = 20
RESULT = "query_id long, vector long, vec_id long, score double"


@dataclass(frozen=True)
class Codes:
    """Learned rotations and the search radius in bits."""

    rotations: list[np.ndarray]
    norm: float
    radius: int

    def lifted(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Scaled vectors with the component that makes norms equal (0 for queries)."""
        x = x / (np.linalg.norm(x, axis=1, keepdims=True) if query else self.norm)
        rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", x, x)))
        return np.column_stack([x, rest])

    def encode(self, lifted: np.ndarray) -> np.ndarray:
        """Codes as bytes, one 8-bit substring each."""
        return np.packbits(np.column_stack([lifted @ r > 0 for r in self.rotations]), axis=1)

    @staticmethod
    def learn(sample: np.ndarray, norm: float, rows: int, k: int = K) -> Codes:
        codes = Codes([], norm, 0)
        x, rng = codes.lifted(sample), np.random.default_rng(7)
        if np.allclose(x[:, -1], 0, atol=1e-3):
            x[:, -1] = 0  # norms are equal already
        for _ in range(ROTATIONS):
            r = np.linalg.qr(rng.standard_normal((x.shape[1], x.shape[1])))[0]
            for _ in range(ITERATIONS):
                u, _, vt = np.linalg.svd(np.where(x @ r > 0, 1.0, -1.0).T @ x)
                r = (u @ vt).T
            codes.rotations.append(r)
        # radius: neighbours of as small a share of the sample as k is of all rows
        near = int(np.clip(round(k * len(sample) / max(rows, 1)), 1, max(1, len(sample) - 1)))
        asked = sample[:512]
        found, wanted = codes.encode(codes.lifted(sample)), codes.encode(codes.lifted(asked, query=True))
        distances = []
        for i, q in enumerate(asked):
            score = sample @ q
            score[i] = -np.inf
            best = np.argpartition(-score, min(near, len(score)) - 1)[:near]
            distances.append(np.bitwise_count(found[best] ^ wanted[i]).sum(axis=1))
        radius = int(np.ceil(np.quantile(np.concatenate(distances), RECALL))) if len(sample) > 1 else 8 * found.shape[1]
        return Codes(codes.rotations, norm, radius)


class ShardIndex:
    """Bitmaps of a shard's rows for each substring and value of it."""

    def __init__(self, codes: np.ndarray, radius: int):
        n, m = codes.shape
        self.codes, self.radius = codes, radius
        r, a = divmod(radius, m)
        value = np.arange(256, dtype=np.uint8)
        distance = np.bitwise_count(value[:, None] ^ value[None, :])
        self.bitmaps = np.zeros((m, 256, (n + 7) // 8), np.uint8)
        for j in range(m):
            within = distance <= (r if j <= a else r - 1)
            exact = np.packbits(codes[:, j][None, :] == value[:, None], axis=1)
            for v in range(256):
                if within[v].any():
                    self.bitmaps[j, v] = np.bitwise_or.reduce(exact[within[v]], axis=0)

    def within(self, code: np.ndarray) -> np.ndarray:
        """Rows whose code is within the radius of ``code``."""
        union = np.bitwise_or.reduce(self.bitmaps[np.arange(len(code)), code], axis=0)
        rows = np.flatnonzero(np.unpackbits(union, count=len(self.codes)))
        return rows[np.bitwise_count(self.codes[rows] ^ code).sum(axis=1) <= self.radius]


def usable(vectors: DataFrame) -> DataFrame:
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
            .where(F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)))


def _matrix(table: pa.Table) -> np.ndarray:
    column = table.column("embedding").combine_chunks()
    return np.asarray(column.values, dtype=np.float64).reshape(len(column), -1)[:, :]


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """``query_id, rank, vec_id, score, vector``: the k rows of ``vectors`` with the largest inner
    product found for each row of ``queries``."""
    base = usable(vectors)
    sizes = (base.groupBy(F.size("embedding").alias("dim")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)).alias("norm2"))
        .orderBy(F.desc("n"), "dim").first())  # one row
    if sizes is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double, vector long")
    base = base.where(F.size("embedding") == sizes["dim"])
    asked = (usable(queries).where(F.size("embedding") == sizes["dim"]).withColumn("vector", F.xxhash64("embedding"))
             .dropDuplicates(["vec_id", "embedding"]))
    sample = base.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).toPandas()  # bounded
    codes = Codes.learn(np.stack(sample["embedding"]), float(np.sqrt(sizes["norm2"])), sizes["n"], k)
    shared = vectors.sparkSession.sparkContext.broadcast(codes)
    shards = -(-sizes["n"] // SHARD_ROWS)
    blocks = max(1, -(-asked.count() // QUERY_ROWS))

    def dealt(df: DataFrame, own: str, n: int, other: str, times: int) -> DataFrame:
        return df.select("*", F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int").alias(own),
                         F.explode(F.sequence(F.lit(0), F.lit(times - 1))).alias(other))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": pa.array([], pa.int64()), "vector": pa.array([], pa.int64()),
                          "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not left.num_rows or not right.num_rows:
            return empty
        c, x, q = shared.value, _matrix(left), _matrix(right)
        ids = left.column("vec_id").to_numpy()
        asking = (right.column("vec_id").to_numpy(), right.column("vector").to_numpy())
        index = ShardIndex(c.encode(c.lifted(x)), c.radius)
        out = []
        for query_id, name, vector, code in zip(*asking, q, c.encode(c.lifted(q, query=True)), strict=True):
            rows = index.within(code)
            rows = rows[ids[rows] != query_id]
            if len(rows) < k:
                rows = np.flatnonzero(ids != query_id)
            score = (x[rows] * vector).sum(axis=1)  # row by row: equal vectors have equal scores
            best = np.lexsort((ids[rows], -score))[:k]
            out.append((np.full(len(best), query_id), np.full(len(best), name), ids[rows[best]], score[best]))
        found = [np.concatenate(part) for part in zip(*out, strict=True)]
        return pa.table({"query_id": pa.array(found[0], pa.int64()), "vector": pa.array(found[1], pa.int64()),
                         "vec_id": pa.array(found[2], pa.int64()), "score": pa.array(found[3], pa.float64())})

    rows = spread(dealt(base, "shard", shards, "block", blocks), "shard", "block").groupBy("shard", "block")
    wanted = spread(dealt(asked, "block", blocks, "shard", shards).select("vec_id", "embedding", "shard", "block", "vector"),
                    "shard", "block").groupBy("shard", "block")
    found = rows.cogroup(wanted).applyInArrow(search, RESULT)
    best = Window.partitionBy("query_id", "vector").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score", "vector"))


def op6_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return nearest(vectors, vectors.where(F.col("vec_id") % QUERY_EVERY == 0))
