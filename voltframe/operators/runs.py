"""Events found in a series - runs of rows above a bound - and their durations.

A run is a maximal stretch of rows of one series, in time order, whose value lies above a bound.
A missing value (NULL or NaN) ends a run, and so does a pause longer than ``max_gap_seconds``.

Runs are cut at chunk borders and joined again: rows are windowed per (key, time chunk), each chunk
gives its runs' parts; only parts that touch the first or last row of their chunk (at most two per
chunk) meet in a window over the chunk borders, where a part that goes on from the chunk before
takes over its number. All other parts are whole runs already. A chunk holding more than
``hot_rows`` rows is cut finer (``sequence.scan_parts``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltframe.functions.columns import epoch_micros, present, shielded, slot_index
from voltframe.operators.ranks import quantiles
from voltframe.operators.sequence import UNB_PREC, join_keys, key_window, last_row, scan_parts, second_of


@shielded()
def threshold_runs(df: DataFrame, *, ts: str, value: str, above: float, keys: Sequence[str] = (),
                   order: Sequence[str] | None = None, max_gap_seconds: float | None = None,
                   chunk_seconds: int = 86_400, hot_rows: int | None = 4_000_000) -> DataFrame:
    """keys, ``start``, ``end`` (times of the first and last row), ``n_rows``, ``duration_seconds``,
    ``peak`` and ``mean_value`` of each run of values above ``above``. Rows without a time are in no
    run and end none. ``order`` must be total (the time first)."""
    keys = list(keys)
    order = list(order) if order else [ts]
    order = [ts] + [c for c in order if c != ts]
    d = df.select(*keys, *order, present(value).alias("_v")).where(F.col(ts).isNotNull())
    d, cols, part = scan_parts(d, keys=keys, time=epoch_micros(ts), chunk=slot_index(ts, chunk_seconds), second=second_of(d, order), hot_rows=hot_rows)
    w = Window.partitionBy(*part).orderBy(*order)
    t = epoch_micros(ts)
    late = lambda now, before: F.lit(False) if max_gap_seconds is None else (now - before) > int(max_gap_seconds * 1_000_000)
    d = d.withColumns({"_in": F.coalesce(F.col("_v") > float(above), F.lit(False)), "_t": t, "_rn": F.row_number().over(w)})
    d = d.withColumns({"_was": F.lag("_in").over(w), "_tp": F.lag("_t").over(w)})
    new = F.col("_in") & (F.col("_was").isNull() | ~F.col("_was") | late(F.col("_t"), F.col("_tp")))
    d = d.withColumn("_run", F.sum(new.cast("long")).over(w.rowsBetween(UNB_PREC, 0)))
    # one row per chunk: its size, and how it begins and ends
    chunks = d.groupBy(*part).agg(last_row(d, F.col("_rn")).alias("_last"), F.min("_t").alias("_t0"))
    before = key_window(cols).orderBy("_ch", "_sub")
    chunks = chunks.select(*part, F.col("_last._rn").alias("_size"), "_t0", F.lag("_last._in").over(before).alias("_was"), F.lag("_last._t").over(before).alias("_tp"))
    chunks = chunks.withColumn("_on", F.coalesce(F.col("_was") & ~late(F.col("_t0"), F.col("_tp")), F.lit(False))).select(*part, "_size", "_on")

    parts = d.where("_in").groupBy(*part, "_run").agg(
        *[F.first(k).alias(k) for k in keys], F.min("_rn").alias("_from"), F.max("_rn").alias("_to"), F.min(ts).alias("start"), F.max(ts).alias("end"),
        F.count(F.lit(1)).alias("n_rows"), F.max("_v").alias("peak"), F.sum("_v").alias("_sum"))
    parts = join_keys(parts, chunks, part, "left")
    first, last = F.col("_from") == 1, F.col("_to") == F.col("_size")
    border = parts.where(first | last)
    goes_on = (F.col("_from") == 1) & F.col("_on")
    border = border.withColumn("_number", F.sum((~goes_on).cast("long")).over(key_window(cols).orderBy("_ch", "_sub", "_run").rowsBetween(UNB_PREC, 0)))
    joined = border.groupBy(*cols, "_number").agg(
        *[F.first(k).alias(k) for k in keys], F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n_rows").alias("n_rows"),
        F.max("peak").alias("peak"), F.sum("_sum").alias("_sum"))
    out = [*keys, "start", "end", "n_rows", "peak", "_sum"]
    runs = parts.where(~(first | last)).select(*out).unionByName(joined.select(*out))
    return runs.select(*keys, "start", "end", "n_rows", ((epoch_micros("end") - epoch_micros("start")) / F.lit(1e6)).alias("duration_seconds"),
                       "peak", (F.col("_sum") / F.col("n_rows")).alias("mean_value"))


def duration_summary(runs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Distribution of the runs' durations per key: n, mean, min, quartiles and max, in seconds."""
    keys, v = list(keys), "duration_seconds"
    basic = runs.groupBy(*keys).agg(F.avg(v).alias("mean"), F.min(v).alias("shortest"), F.max(v).alias("longest"), F.sum("n_rows").alias("n_rows"))
    return join_keys(basic, quantiles(runs, v, {"q1": 0.25, "median": 0.5, "q3": 0.75}, keys), keys, "left")
