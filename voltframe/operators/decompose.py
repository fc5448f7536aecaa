"""Additive seasonal decomposition (moving-average trend, phase means).

* position = row number of the (gap-free) series in time order;
* trend = centred moving average of ``period`` rows; for an even period the
  2 x period average (half weight on the two end rows); NULL where the window
  is not full;
* seasonal = per-phase (position mod period) mean of (value - trend), centred
  so the ``period`` phase means average to zero;
* resid = value - trend - seasonal.

Positions come from ``dense_positions`` and the trend from ``halo_windows``;
the phase table has ``period`` rows per key and is joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltframe.functions.columns import finite, slot_index
from voltframe.operators.sequence import HOT_ROWS, dense_positions, halo_windows, join_small


def seasonal_decompose(df: DataFrame, *, ts: str, value: str, keys: Sequence[str] = (), period: int = 24,
                       chunk_seconds: int = 86_400 * 7, chunk_rows: int = 4096,
                       hot_rows: int | None = HOT_ROWS) -> DataFrame:
    keys = list(keys)
    d = df.select(*keys, ts, finite(value).alias(value)).where(F.col(value).isNotNull())   # NaN and infinities are missing
    d = dense_positions(d, keys=keys, order=[ts], chunk=slot_index(ts, chunk_seconds), pos="pos", hot_rows=hot_rows)
    half = period // 2
    v = F.col(value)

    def cols(w: Window) -> dict:
        if period % 2 == 0:
            f1, f2 = w.rowsBetween(-half, half - 1), w.rowsBetween(-half + 1, half)
            full = F.count(v).over(w.rowsBetween(-half, half)) == period + 1
            t = (F.avg(v).over(f1) + F.avg(v).over(f2)) / F.lit(2.0)
        else:
            f = w.rowsBetween(-half, half)
            full = F.count(v).over(f) == period
            t = F.avg(v).over(f)
        return {"trend": F.when(full, t)}

    d = halo_windows(d, keys=keys, pos="pos", back=half, fwd=half, chunk_rows=max(chunk_rows, period),
                     columns=cols)
    d = d.withColumn("phase", F.pmod(F.col("pos"), F.lit(period)).cast("int"))
    ph = d.groupBy(*keys, "phase").agg(F.avg(v - F.col("trend")).alias("_pm"))
    ph = ph.withColumn("seasonal", F.col("_pm") - F.avg("_pm").over(
        Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))))
    d = join_small(d, ph.select(*keys, "phase", "seasonal"), [*keys, "phase"]) if keys else \
        d.join(F.broadcast(ph.select("phase", "seasonal")), "phase")
    return d.select(*keys, ts, "pos", F.col(value).alias("observed"), "trend", "seasonal",
                    (v - F.col("trend") - F.col("seasonal")).alias("resid"))
