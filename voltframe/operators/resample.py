"""Resample to a uniform grid (mean per slot) and complete the grid.

Slots are left-closed, left-labelled and aligned to the epoch (so 15-minute and
hourly slots are aligned to the day). With ``fill_grid`` every slot between a
series' first and last slot is present; empty slots hold NULL.

The grid is not joined: NULL-valued grid rows are unioned with the data rows
before the single aggregation, so the result needs one shuffle (after a
map-side partial average) plus a tiny one that spreads grid generation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.functions.columns import floor_div, from_epoch_micros, is_ntz, present, slot_index

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType, T.BooleanType)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, _NUMERIC) and f.name not in set(exclude)]


def slot_grid(spans: DataFrame, keys: Sequence[str], block_slots: int = 672) -> DataFrame:
    """All slots in [_lo, _hi] per key; generated per block of slots on many tasks."""
    keys = list(keys)
    lo, hi = F.col("_lo"), F.col("_hi")
    blocks = spans.withColumn("_blk", F.explode(F.sequence(floor_div(lo, block_slots),
                                                           floor_div(hi, block_slots))))
    blocks = blocks.repartition(*[F.col(k) for k in keys], F.col("_blk"))
    start = F.greatest(lo, F.col("_blk") * block_slots)
    end = F.least(hi, F.col("_blk") * block_slots + (block_slots - 1))
    return blocks.select(*keys, F.explode(F.sequence(start, end)).alias("_slot"))


def resample_mean(df: DataFrame, *, ts: str, value_cols: Sequence[str] | None = None,
                  keys: Sequence[str] = (), step_seconds: int = 900, fill_grid: bool = True,
                  drop_empty: bool = False) -> DataFrame:
    """Mean of each value column per (keys, slot); booleans average as 0/1 doubles, NaN is missing.

    ``value_cols`` defaults to every numeric or boolean column that is not a key.
    Output: ``keys..., ts, value_cols...`` with ``ts`` the slot start (same type as input).
    """
    keys = list(keys)
    if value_cols is None:
        value_cols = numeric_columns(df, exclude=[*keys, ts])
    value_cols = list(value_cols)
    ntz = is_ntz(df, ts)
    rows = df.select(*keys, slot_index(ts, step_seconds).alias("_slot"),
                     *[present(c).alias(c) for c in value_cols])
    rows = rows.where(F.col("_slot").isNotNull())
    if fill_grid:
        spans = rows.groupBy(*keys).agg(F.min("_slot").alias("_lo"), F.max("_slot").alias("_hi"))
        grid = slot_grid(spans, keys).select(
            *keys, "_slot", *[F.lit(None).cast("double").alias(c) for c in value_cols])
        rows = rows.unionByName(grid)
    out = rows.groupBy(*keys, "_slot").agg(*[F.avg(c).alias(c) for c in value_cols])
    if drop_empty:
        out = out.na.drop(how="any", subset=value_cols)
    step_us = int(step_seconds) * 1_000_000
    return out.select(*keys, from_epoch_micros(F.col("_slot") * F.lit(step_us), ntz).alias(ts),
                      *value_cols)
