"""Day-level aggregates, labels and running totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltframe.functions.columns import present, shielded, slot_index
from voltframe.operators.sequence import HOT_ROWS, running_sum


def in_range(ts: str, start: str, end: str) -> Column:
    """P10: half-open [start, end) on a timestamp column (pushed to the Parquet scan)."""
    return (F.col(ts) >= F.lit(start).cast("timestamp_ntz")) & (F.col(ts) < F.lit(end).cast("timestamp_ntz"))


def period_label(ts: str, start: str, end: str, inside: str = "Heat Wave", outside: str = "Baseline") -> Column:
    """Two-way label by a half-open event range."""
    return F.when(in_range(ts, start, end), F.lit(inside)).otherwise(F.lit(outside))


def phase_label(ts: str, start: str, end: str) -> Column:
    """Before / during / after in one expression (single scan, one group column)."""
    t = F.col(ts)
    return (F.when(t < F.lit(start).cast("timestamp_ntz"), F.lit("before"))
            .when(t < F.lit(end).cast("timestamp_ntz"), F.lit("during"))
            .when(t.isNotNull(), F.lit("after")))


def day_between(day: str, lo: str, hi: str) -> Column:
    """Inclusive range on calendar days."""
    return F.col(day).between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))


def daily(df: DataFrame, *, ts: str, value: str, how: str, out: str, keys: Sequence[str] = ()) -> DataFrame:
    """Per calendar day: ``max``, ``min``, ``sum`` (an all-missing day sums to 0) or ``range`` (max - min).
    NaN is missing."""
    keys = list(keys)
    v = present(value)
    agg = {"max": F.max(v), "min": F.min(v), "sum": F.coalesce(F.sum(v), F.lit(0.0)),
           "range": F.max(v) - F.min(v)}
    if how not in agg:
        raise ValueError(f"unknown daily aggregate {how!r}")
    return df.groupBy(*keys, F.to_date(ts).alias("date")).agg(agg[how].cast("double").alias(out))


def with_day_index(daily_df: DataFrame, keys: Sequence[str] = (), out: str = "day_index") -> DataFrame:
    """0-based ordinal of each day. The window runs over day-level rows (one per day)."""
    keys = list(keys)
    w = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy("date")
    return daily_df.withColumn(out, (F.row_number().over(w) - 1).cast("int"))


def daily_peaks(e: DataFrame, d: DataFrame, *, ts: str = "timestamp", e_value: str = "value",
                d_value: str = "demand_MW", event_days: tuple[str, str] | None = None) -> DataFrame:
    """A7 + J3 (+ P11): daily maxima of two series joined on the day."""
    pe = daily(e, ts=ts, value=e_value, how="max", out="peak_moer")
    pd_ = daily(d, ts=ts, value=d_value, how="max", out="peak_demand")
    out = pe.join(pd_, on="date", how="inner")
    if event_days:
        out = out.withColumn("is_event", day_between("date", *event_days))
    return out


@shielded()
def cumulative(df: DataFrame, *, ts: str, value: str, out: str = "cum_value", keys: Sequence[str] = (),
               order: Sequence[str] | None = None, chunk_seconds: int = 86_400, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Running total in time order; a missing value (NULL, NaN) stays
    missing, the total carries on."""
    return running_sum(df, keys=keys, order=list(order) if order else [ts],
                       chunk=slot_index(ts, chunk_seconds), value=value, out=out, hot_rows=hot_rows)
