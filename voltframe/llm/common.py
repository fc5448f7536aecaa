"""Small helpers of the operators: table access, typed columns, Arrow batch maps, bounded samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from voltframe.session import cut_lineage

#: Rows and bytes that one Arrow batch may hold in a Python worker.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20
#: Rows up to which a side with fixed-width rows (a few dozen bytes each) may be broadcast.
BROADCAST_ROWS = 1_000_000
#: Bytes up to which a side of any width may be broadcast.
BROADCAST_BYTES = 32 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds, also where texts are very long, and what a join may
    broadcast on its own once it knows a side's size."""
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "8MB")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pick(df: DataFrame, **types: str) -> DataFrame:
    """Just the named columns, cast to the given types; a missing one is NULL. Other columns,
    whatever their names, are left behind, so they cannot clash with an operator's own."""
    return df.select(*[(F.col(f"`{c}`") if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in types.items()])


def crc_mod(doc_id: Column, m: int) -> Column:
    """crc32 of the id as text, modulo m (NULL for a NULL id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % m


def uniform(*cols: Column, seed: int = 0) -> Column:
    """A fixed number in [0, 1) drawn from the columns' values."""
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 30)) / float(1 << 30)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """``fn`` gets an Arrow batch and returns column name -> Arrow array or sequence. Types
    survive as they are (a nullable long stays a long)."""
    want = StructType.fromDDL(schema)
    arrow = to_arrow_schema(want)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                out = fn(b)
                cols = [out[f.name] if isinstance(out[f.name], (pa.Array, pa.ChunkedArray)) else pa.array(out[f.name], type=f.type) for f in arrow]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, arrow)], schema=arrow)

    return df.mapInArrow(run, schema=want)


def map_sorted_groups(df: DataFrame, keys: list[str], fn: Callable[[pa.Table], dict | None], schema: str) -> DataFrame:
    """``fn`` gets all rows of one key at a time, as an Arrow table. Rows are dealt by ``keys``
    and sorted, so a task streams through many small groups and holds one of them."""
    want = StructType.fromDDL(schema)
    arrow = to_arrow_schema(want)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None

        def close() -> Iterator[pa.RecordBatch]:
            out = fn(pa.Table.from_batches(held))
            if out is not None:
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

        for b in batches:
            rows = list(zip(*[b.column(k).to_pylist() for k in keys]))
            start = 0
            for i in range(len(rows) + 1):
                if i == len(rows) or rows[i] != last:
                    if i > start:
                        held.append(b.slice(start, i - start))
                    if i < len(rows):
                        if held:
                            yield from close()
                        held, last, start = [], rows[i], i
        if held:
            yield from close()

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema=want)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a written table of narrow rows), hinted for broadcast only if it was counted to
    hold at most ``rows`` rows; else as it is, for a shuffle join that AQE may split."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def broadcast_if_light(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """As ``broadcast_if_small``, for rows of any width: texts and arrays are measured too."""
    wide = [F.octet_length(F.col(f"`{c}`").cast("string")) for c, t in df.dtypes if t in ("string", "binary") or t.startswith("array")]
    width = sum((F.coalesce(w, F.lit(0)).cast("long") for w in wide), F.lit(8 * len(df.columns)).cast("long"))
    seen = df.limit(rows + 1).agg(F.count("*").alias("n"), F.sum(width).alias("bytes")).first()
    return F.broadcast(df) if seen.n <= rows and (seen.bytes or 0) <= size else df


def bounded_sample(df: DataFrame, keys: list[str], rows: int, seed: int) -> DataFrame:
    """About ``rows`` rows (all of them, if fewer), chosen by a hash of ``keys``."""
    n = df.count()
    return df if n <= rows else df.where(uniform(*[F.col(k) for k in keys], seed=seed) < rows / n)


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(x, dtype=np.float64)))


__all__ = ["BATCH_BYTES", "BATCH_ROWS", "BROADCAST_ROWS", "bounded_batches", "bounded_sample", "broadcast_if_small", "crc_mod",
           "cut_lineage", "map_batches", "pick", "sigmoid", "table", "uniform"]
