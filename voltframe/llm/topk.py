"""Operator 13: exact top-k search by exhaustive term-at-a-time accumulation.

Method: a vector is a sparse row of integer weights, floor(scale * component); a term is a component's
place. Candidates are dealt into blocks by a hash of their id, each block holds a term-major index
(per term the places and weights of the candidates where it is not 0). A query takes its non-zero
terms one at a time and scatters (its weight x posting weights) into a dense score array of the
block, so every candidate has its exact score, 0 where no term is shared. A partition selection
keeps the block's k best, a window over the blocks' winners merges them.

Queries are dealt into blocks too; each pair of blocks is a task of bounded size, and a candidate is
copied once per query block. Block sizes grow with the table up to a bound, so that copies stay few.

Defined results: vectors that are NULL or hold a NULL or non-finite component, and rows without an
id, take no part; an empty vector scores 0 with all; vectors of other lengths are candidates, a
place that one lacks counts as 0 there; rows that repeat an id count once, with the smallest of
their vectors; ties go to the smaller id; with fewer than k candidates all are returned; a single
vector has no neighbours. Weights are exact; a product ``scale * x`` beyond the largest double
counts as that, and a score beyond a long is given as the nearest long (ties as stated).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltframe.llm.common import cut_lineage, map_batches, map_sorted_groups, pick, table

K, SCALE, EVERY = 5, 256, 50
#: Rows of one block: at least the first, at most the second number.
BLOCK, QUERY_BLOCK = (1 << 13, 1 << 17), (1 << 12, 1 << 14)
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def _flat(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of all lists in a row, and where each list starts (one more than lists)."""
    c = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    start = np.concatenate([[0], np.cumsum(np.diff(c.offsets.to_numpy()))]) if len(c) else np.zeros(1, int)
    return c.flatten().to_numpy(zero_copy_only=False), start


def _terms(start: np.ndarray) -> np.ndarray:
    """Place of each value within its own list."""
    return np.arange(start[-1]) - np.repeat(start[:-1], np.diff(start))


class Postings:
    """Term-major index of a block: ``at[first[t]:first[t + 1]]`` are term t's candidates."""

    def __init__(self, values: np.ndarray, start: np.ndarray):
        self.size = len(start) - 1
        owner, term = np.repeat(np.arange(self.size), np.diff(start)), _terms(start)
        used = np.flatnonzero(values != 0)
        used = used[np.argsort(term[used], kind="stable")]
        self.at, self.weight = owner[used], values[used]
        self.first = np.searchsorted(term[used], np.arange(int(term.max(initial=-1)) + 2))

    def scores(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Dense scores of one sparse query row."""
        acc = np.zeros(self.size, dtype=self.weight.dtype)
        for t, w in zip(terms.tolist(), weights):
            if t + 1 < len(self.first):
                part = slice(self.first[t], self.first[t + 1])
                acc[self.at[part]] += w * self.weight[part]
        return acc


def best(acc: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Places of the k highest scores but the own id's, ties to smaller ids (``ids`` ascend)."""
    at = np.arange(len(acc))
    if len(acc) > k + 1:
        at = np.flatnonzero(acc >= np.partition(acc, len(acc) - k - 1)[len(acc) - k - 1])
    at = at[ids[at] != own]
    return at[np.argsort(-acc[at], kind="stable")][:k]


def _exact(q: np.ndarray, x: np.ndarray, terms: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights as 64-bit integers if no sum can leave them, else as Python integers."""
    if float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, terms) < 2.0 ** 62 and max(np.abs(q).max(initial=0), np.abs(x).max(initial=0)) < 2.0 ** 62:
        return q.astype(np.int64), x.astype(np.int64)
    whole = lambda v: np.array([int(w) for w in v.tolist()] + [None], dtype=object)[:-1]
    return whole(q), whole(x)


def compare(group: pa.Table, k: int) -> dict | None:
    """Best k of one block of candidates for each query of one block of queries."""
    asks = group.column("asks").to_numpy()
    mine, theirs = group.filter(pa.array(asks)), group.filter(pa.array(~asks)).sort_by("vec_id")
    if not len(mine) or not len(theirs):
        return None
    (q, q_start), (x, x_start) = _flat(mine.column("weights")), _flat(theirs.column("weights"))
    q, x = _exact(q, x, min(np.diff(q_start).max(), np.diff(x_start).max()))
    index, ids, terms = Postings(x, x_start), theirs.column("vec_id").to_numpy(), _terms(q_start)
    out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
    for i, own in enumerate(mine.column("vec_id").to_pylist()):
        row = np.arange(q_start[i], q_start[i + 1])
        row = row[q[row] != 0]
        acc = index.scores(terms[row], q[row])
        if acc.dtype == object:
            acc = np.array([min(MOST, max(LEAST, s)) for s in acc.tolist()] + [None], dtype=object)[:-1]
        top = best(acc, ids, own, k)
        out["query_id"] += [own] * len(top)
        out["vec_id"] += ids[top].tolist()
        out["score"] += acc[top].tolist()
    return out if out["vec_id"] else None


def search(vectors: DataFrame, is_query: Column, k: int = K, scale: float = SCALE) -> DataFrame:
    """``vectors(vec_id, embedding)`` -> query_id, rank, vec_id, score for the rows where ``is_query``."""
    v = F.col("embedding")
    usable = vectors.where(F.col("vec_id").isNotNull() & v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    once = usable.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))

    def weigh(b: pa.RecordBatch) -> dict:
        values, start = _flat(b.column("embedding"))
        top = np.finfo(np.float64).max
        with np.errstate(over="ignore"):
            w = np.clip(np.floor(scale * values.astype(np.float64)), -top, top)
        return {"vec_id": b.column("vec_id"), "weights": pa.ListArray.from_arrays(pa.array(start, pa.int32()), pa.array(w))}

    rows = cut_lineage(map_batches(once, weigh, "vec_id long, weights array<double>").withColumn("asks", F.coalesce(is_query, F.lit(False))), "weights")
    size = rows.agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).first()
    blocks = -(-size.n // min(BLOCK[1], max(BLOCK[0], size.n // 256))) or 1
    query_blocks = -(-size.q // min(QUERY_BLOCK[1], max(QUERY_BLOCK[0], size.q // 64))) or 1
    i = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    j = F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(query_blocks)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    stored = rows.select(i.alias("i"), every(query_blocks).alias("j"), F.lit(False).alias("asks"), "vec_id", "weights")
    asked = rows.where("asks").select(every(blocks).alias("i"), j.alias("j"), "asks", "vec_id", "weights")
    near = map_sorted_groups(stored.unionByName(asked), ["i", "j"], lambda t: compare(t, k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(pick(table(spark, sf_dir, "embeddings"), vec_id="long", embedding="array<double>"), F.col("vec_id") % EVERY == 0)


ORACLE_SQL = f"""
with v as (
  select vec_id, min(list_transform(embedding, lambda x: floor({SCALE} * x::double))) as w from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 group by vec_id),
s as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.w, c.w)::bigint as score
  from v q join v c on q.vec_id % {EVERY} = 0 and c.vec_id <> q.vec_id)
select query_id, rank, vec_id, score from (
  select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score from s)
where rank <= {K}
"""
