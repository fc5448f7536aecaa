"""Time gaps, limited forward fill and limited linear interpolation by position.

Semantics (per series key, rows in time order, positions 0..n-1):

* ``time_diff``: seconds since the previous row (NULL for the first row).
* ``{v}_ffill``: last valid value carried forward at most ``ffill_limit`` rows.
* ``{v}``: linear interpolation by row position between the neighbouring valid
  values, filling at most the first ``interp_limit`` rows of each gap; a leading
  gap stays NULL, a trailing gap repeats the last valid value (same limit).
* ``{v}_is_interpolated``: was NULL and is now filled.

The work runs in two phases so no window spans a whole series: rows are
windowed per (key, time chunk); a per-chunk summary (row count, first/last
valid value with its position) is windowed per key to give each chunk its
offset and the nearest valid value before and after it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.functions.columns import epoch_micros, shielded, slot_index
from voltframe.operators.sequence import HOT_ROWS, UNB_PREC, join_keys, key_window, last_row, scan_parts, second_of


@shielded()
def handle_missing(df: DataFrame, *, ts: str, value: str, keys: Sequence[str] = (),
                   order: Sequence[str] | None = None, ffill_limit: int = 2,
                   interp_limit: int = 8, chunk_seconds: int = 86_400,
                   hot_rows: int | None = 4_000_000) -> DataFrame:
    """``hot_rows``: a (key, chunk) with more rows is cut finer (``sequence.scan_parts``); ``None``
    keeps plain time chunks."""
    keys = list(keys)
    order = list(order) if order else [ts]
    if order[0] != ts:
        order = [ts] + [c for c in order if c != ts]
    v = F.col(value)
    # NaN is missing (as in pandas); NULL times sort last (pandas puts NaT last).
    d = df.withColumn(value, F.when(~F.isnan(v), v)) if isinstance(df.schema[value].dataType, T.DoubleType) else df
    d, keys, part = scan_parts(d, keys=keys, time=epoch_micros(ts), chunk=slot_index(ts, chunk_seconds), second=second_of(d, order), hot_rows=hot_rows)
    w = Window.partitionBy(*part).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    # "Next valid" is the last valid value in descending order: a running frame,
    # evaluated incrementally (a frame to UNBOUNDED FOLLOWING is quadratic in Spark).
    w_rev = Window.partitionBy(*part).orderBy(*[F.col(c).desc_nulls_first() for c in order]).rowsBetween(UNB_PREC, 0)
    d = d.withColumn("_rn", F.row_number().over(w))
    valid_rn = F.when(v.isNotNull(), F.col("_rn"))
    d = d.withColumns({
        "_pv_rn": F.last(valid_rn, ignorenulls=True).over(w.rowsBetween(UNB_PREC, 0)),
        "_pv_v": F.last(v, ignorenulls=True).over(w.rowsBetween(UNB_PREC, 0)),
        "_nv_rn": F.last(valid_rn, ignorenulls=True).over(w_rev),
        "_nv_v": F.last(v, ignorenulls=True).over(w_rev),
        "_prev_ts": F.lag(F.col(ts)).over(w),
    })

    # Per-chunk summary (one row per key and chunk); scalar aggregates keep it a hash aggregate.
    vrn = F.when(v.isNotNull(), F.col("_rn"))
    summ = d.groupBy(*part).agg(
        last_row(d, F.col("_rn")).alias("_last"),
        F.max(vrn).alias("_lv_rn"), F.max_by(v, vrn).alias("_lv_v"),
        F.min(vrn).alias("_fv_rn"), F.min_by(v, vrn).alias("_fv_v"),
    ).withColumns({"_n": F.col("_last._rn"), "_last_ts": F.col(f"_last.{ts}")}).drop("_last")
    kw = key_window(keys).orderBy(F.col("_ch").asc_nulls_last(), F.col("_sub").asc_nulls_last())
    summ = summ.withColumn("_off", F.coalesce(F.sum("_n").over(kw.rowsBetween(UNB_PREC, -1)),
                                              F.lit(0)).cast("long"))
    last_abs = F.when(F.col("_lv_rn").isNotNull(), F.struct(
        (F.col("_off") + F.col("_lv_rn") - 1).alias("pos"), F.col("_lv_v").alias("v")))
    first_abs = F.when(F.col("_fv_rn").isNotNull(), F.struct(
        (F.col("_off") + F.col("_fv_rn") - 1).alias("pos"), F.col("_fv_v").alias("v")))
    summ = summ.withColumns({
        "_cin": F.last(last_abs, ignorenulls=True).over(kw.rowsBetween(UNB_PREC, -1)),
        "_cout": F.last(first_abs, ignorenulls=True).over(
            key_window(keys).orderBy(F.col("_ch").desc_nulls_first(), F.col("_sub").desc_nulls_first())
            .rowsBetween(UNB_PREC, -1)),
        "_cts": F.lag("_last_ts").over(kw),
    }).select(*part, "_off", "_cin", "_cout", "_cts")

    d = join_keys(d, summ, part, "left")
    off = F.col("_off")
    pos = off + F.col("_rn") - 1
    has_pv = F.col("_pv_rn").isNotNull()
    has_nv = F.col("_nv_rn").isNotNull()
    pv_pos = F.when(has_pv, off + F.col("_pv_rn") - 1).otherwise(F.col("_cin.pos"))
    pv_v = F.when(has_pv, F.col("_pv_v")).otherwise(F.col("_cin.v"))
    nv_pos = F.when(has_nv, off + F.col("_nv_rn") - 1).otherwise(F.col("_cout.pos"))
    nv_v = F.when(has_nv, F.col("_nv_v")).otherwise(F.col("_cout.v"))
    d = d.withColumns({"_pos": pos, "_pvp": pv_pos, "_pvv": pv_v, "_nvp": nv_pos, "_nvv": nv_v})

    gap = F.col("_pos") - F.col("_pvp")
    slope = (F.col("_nvv") - F.col("_pvv")) / (F.col("_nvp") - F.col("_pvp")).cast("double")
    ffill = (F.when(v.isNotNull(), v)
             .when(F.col("_pvp").isNotNull() & (gap <= ffill_limit), F.col("_pvv")))
    interp = (F.when(v.isNotNull(), v)
              .when(F.col("_pvp").isNull() | (gap > interp_limit), F.lit(None).cast("double"))
              .when(F.col("_nvp").isNull(), F.col("_pvv"))
              .otherwise(slope * gap.cast("double") + F.col("_pvv")))
    prev_ts = F.coalesce(F.col("_prev_ts"), F.col("_cts"))
    time_diff = (epoch_micros(ts) - epoch_micros(prev_ts)) / F.lit(1e6)
    out = d.withColumns({
        "time_diff": time_diff,
        f"{value}_ffill": ffill,
        f"{value}_is_interpolated": v.isNull() & interp.isNotNull(),
    }).withColumn(value, interp)
    return out.select(*df.columns, "time_diff", f"{value}_ffill", f"{value}_is_interpolated")


@shielded()
def time_gaps(df: DataFrame, *, ts: str, keys: Sequence[str] = (), order: Sequence[str] | None = None,
              chunk_seconds: int = 86_400, out: str = "time_diff", hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """W1 alone: seconds since the previous row of the same series."""
    keys = list(keys)
    order = list(order) if order else [ts]
    d, keys, part = scan_parts(df, keys=keys, time=epoch_micros(ts), chunk=slot_index(ts, chunk_seconds), second=second_of(df, order), hot_rows=hot_rows)
    w = Window.partitionBy(*part).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    d = d.withColumns({"_prev_ts": F.lag(F.col(ts)).over(w), "_rn": F.row_number().over(w)})
    last = d.groupBy(*part).agg(last_row(d, F.col("_rn"))[ts].alias("_last_ts"))
    last = last.withColumn("_cts", F.lag("_last_ts").over(key_window(keys).orderBy("_ch", "_sub")))
    d = join_keys(d, last.select(*part, "_cts"), part, "left")
    prev_ts = F.coalesce(F.col("_prev_ts"), F.col("_cts"))
    return (d.withColumn(out, (epoch_micros(ts) - epoch_micros(prev_ts)) / F.lit(1e6))
             .select(*df.columns, out))
