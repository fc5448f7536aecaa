"""Operator 7: approximate nearest neighbours by cross-polytope hashing.

Method: each of ``TABLES`` tables turns a unit vector by a pseudo-rotation (three rounds of random
signs and a fast Hadamard transform) and stores it under its nearest signed axis. A query probes,
in each table, the ``PROBES`` signed axes nearest to its own rotated vector; the union of those
buckets is its candidates, which are reranked exactly. Largest inner product is reduced to
angles: a vector v becomes (v, sqrt(M^2 - |v|^2)) / M with M the largest norm, a query (q, 0).

Every vector is indexed (its axes are a written table). Vectors are dealt into blocks of about
``BLOCK`` by a hash of their id, queries into blocks of about ``QUERY_BLOCK``, and each pair of
blocks is a group of its own, so a bucket that holds a third of all vectors is spread evenly and
no task holds more than one block of each. A pair gives each query's best ``k`` at most; a last
window keeps the k best of all blocks. Where a query finds fewer than k candidates in a block, it
compares with that whole block.

Recall against brute force is measured in tests/llm (README has the figures).

Defined results: vectors that are NULL, empty, zero, or hold a NULL or non-finite component, and
rows without an id, take no part; only vectors of the query's own length are candidates; rows
that repeat an id count once, with the smallest of their vectors; with fewer than k candidates all
are returned; ties go to the smaller id; a single vector has no neighbours and gives no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltframe.llm.common import cut_lineage, map_batches, map_sorted_groups, pick, table

K, TABLES, PROBES, ROUNDS = 20, 16, 20, 3
BLOCK, QUERY_BLOCK = 8192, 1024


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row (length a power of two), orthonormal."""
    n, width = x.shape
    half = 1
    while half < width:
        y = x.reshape(n, width // (2 * half), 2, half)
        x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], axis=2).reshape(n, width)
        half *= 2
    return x / np.sqrt(width)


def rotated(x: np.ndarray, number: int) -> np.ndarray:
    """Pseudo-rotation of table ``number`` and its negative: the scores of all signed axes."""
    rng = np.random.default_rng([7, number, x.shape[1]])
    for _ in range(ROUNDS):
        x = hadamard(x * rng.choice(np.array([-1.0, 1.0]), x.shape[1]))
    return np.concatenate([x, -x], axis=1)


def lifted(v: np.ndarray, longest: float, query: bool) -> np.ndarray:
    """Unit vectors whose angles order the inner products; padded to a power of two."""
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    out = np.zeros((len(v), 1 << int(v.shape[1]).bit_length()))
    out[:, :v.shape[1]] = v / (norm if query else longest)
    if not query:
        out[:, v.shape[1]] = np.sqrt(np.maximum(0, 1 - (norm[:, 0] / longest) ** 2))
    return out


def axes(v: np.ndarray, longest: float, tables: int, probes: int = 0) -> np.ndarray:
    """(n, tables) own axes, or (n, tables, probes) probed axes of queries."""
    x = lifted(v, longest, query=bool(probes))
    out = []
    for t in range(tables):
        y = rotated(x, t)
        out.append(np.argpartition(-y, min(probes, y.shape[1]) - 1, axis=1)[:, :probes] if probes else y.argmax(axis=1))
    return np.stack(out, axis=1).astype(np.uint16)


def _usable(df: DataFrame) -> DataFrame:
    v = F.col("embedding")
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    return (df.where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & ok).withColumn("norm", norm).where("norm > 0")
            .groupBy("vec_id").agg(F.min(F.struct("embedding", "norm")).alias("v")).select("vec_id", "v.embedding", "v.norm"))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.float64)


def nearest(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, found: np.ndarray, k: int):
    """Exact best k of each query's ``found`` candidates (bool, queries x vectors)."""
    rough = q @ x.T
    out = []
    for i, row in enumerate(rough):
        at = np.flatnonzero(found[i] & (ids != q_ids[i]))
        if len(at) < k:
            at = np.flatnonzero(ids != q_ids[i])
        if len(at) > k:
            cut = -np.partition(-row[at], k - 1)[k - 1]
            at = at[row[at] >= cut - 1e-9 * (1 + abs(cut))]
        score = (x[at] * q[i]).sum(axis=1)
        best = np.lexsort((ids[at], -score))[:k]
        out += [(int(q_ids[i]), int(ids[at[b]]), float(score[b])) for b in best]
    return out


def search(vectors: DataFrame, is_query: Column, k: int = K, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """``vectors(vec_id, embedding)`` -> query_id, rank, vec_id, score for the rows where ``is_query``."""
    rows = cut_lineage(_usable(vectors).withColumn("dim", F.size("embedding")).withColumn("is_query", F.coalesce(is_query, F.lit(False))), "vectors")
    size = rows.agg(F.count("*").alias("n"), F.count_if("is_query").alias("q"), F.max("norm").alias("longest")).first()
    longest = size.longest or 1.0
    blocks, query_blocks = max(1, -(-size.n // BLOCK)), max(1, -(-size.q // QUERY_BLOCK))

    def index(b: pa.RecordBatch) -> dict:
        vec, ask, dims = b.column("embedding").to_pylist(), b.column("is_query").to_pylist(), b.column("dim").to_numpy()
        own, probe = [None] * len(vec), [None] * len(vec)
        for d in np.unique(dims):
            at = np.flatnonzero(dims == d)
            for i, c in zip(at, axes(np.array([vec[i] for i in at], dtype=np.float64), longest, tables)):
                own[i] = c.tobytes()
            at = [i for i in at if ask[i]]
            if at:
                most = min(probes, 2 << int(d).bit_length())
                for i, c in zip(at, axes(np.array([vec[i] for i in at], dtype=np.float64), longest, tables, most)):
                    probe[i] = c.tobytes()
        return {c: b.column(c) for c in ("vec_id", "embedding", "dim", "is_query")} | {"own": own, "probe": probe}

    indexed = cut_lineage(map_batches(rows.select("vec_id", "embedding", "dim", "is_query"), index, "vec_id long, embedding array<double>, dim int, is_query boolean, own binary, probe binary"), "axes")
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    query_block = F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(query_blocks)).cast("int")
    stored = indexed.select("dim", block.alias("i"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("j"), F.lit(False).alias("asks"), "vec_id", "embedding", F.col("own").alias("axes"))
    asked = indexed.where("is_query").select("dim", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("i"), query_block.alias("j"), F.lit(True).alias("asks"), "vec_id", "embedding", F.col("probe").alias("axes"))

    def compare(t: pa.Table) -> dict | None:
        asks = t.column("asks").to_numpy()
        mine, theirs = t.filter(pa.array(asks)), t.filter(pa.array(~asks))
        if not len(mine) or not len(theirs):
            return None
        q, x = _matrix(mine.column("embedding")), _matrix(theirs.column("embedding"))
        own = np.array([np.frombuffer(c, dtype=np.uint16) for c in theirs.column("axes").to_pylist()])
        probe = np.array([np.frombuffer(c, dtype=np.uint16).reshape(tables, -1) for c in mine.column("axes").to_pylist()])
        found = np.zeros((len(q), len(x)), dtype=bool)
        width = 2 << int(q.shape[1]).bit_length()
        for t_ in range(tables):
            buckets = np.zeros((len(q), width), dtype=bool)
            np.put_along_axis(buckets, probe[:, t_].astype(np.int64), True, axis=1)
            found |= buckets[:, own[:, t_]]
        best = nearest(mine.column("vec_id").to_numpy(), q, theirs.column("vec_id").to_numpy(), x, found, k)
        return dict(zip(("query_id", "vec_id", "score"), map(list, zip(*best)))) if best else None

    near = map_sorted_groups(stored.unionByName(asked), ["dim", "i", "j"], compare, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(pick(table(spark, sf_dir, "embeddings"), vec_id="long", embedding="array<double>"), F.col("vec_id") % 20 == 0)
