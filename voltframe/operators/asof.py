"""As-of join to the nearest right row within a tolerance (left rows preserved).

Rules: distance |t_left - t_right| <= tolerance; on equal distance the backward
(earlier or equal) row wins; among right rows with the same timestamp the
backward match takes the last one and the forward match the first one (in
``right_order``).

Plan: a merge of both sides by ranges of time. Left and right rows are unioned and
windowed per (key, time chunk); in each part a left row finds the last right row at or
before it and the first one at or after it. What lies beyond the part comes from a
boundary carry: each part gives its first and last right row, a window over the parts
brings the nearest of them from before and from behind. No row is copied, and one side
may be as dense as it likes: a part above ``hot_rows`` rows of both sides together is cut
at quantiles of its times, left rows of one instant by a hash (``sequence.scan_parts``).
Right rows sharing a timestamp are first collapsed to their first and last row by an
aggregate (partial, so a hot timestamp is reduced map-side).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.functions.columns import epoch_micros, floor_div, shielded
from voltframe.operators.sequence import HOT_ROWS, UNB_PREC, join_keys, key_window, last_row, scan_parts


@shielded()
def asof_nearest(left: DataFrame, right: DataFrame, *, on: str, right_cols: Sequence[str],
                 by: Sequence[str] = (), tolerance_seconds: float = 1800.0,
                 right_order: Sequence[str] | None = None, collapse_duplicates: bool = True,
                 chunk_seconds: int = 86_400, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Left rows with ``right_cols`` of the nearest right row; ``hot_rows=None`` keeps plain time chunks."""
    by = list(by)
    right_cols = list(right_cols)
    tol = int(round(tolerance_seconds * 1_000_000))
    if tol <= 0:
        raise ValueError("tolerance must be positive")
    rt = epoch_micros(on)
    r0 = right.where(F.col(on).isNotNull())
    single = (right_order is not None and len(right_order) == 1
              and isinstance(right.schema[right_order[0]].dataType, T.IntegralType))
    if collapse_duplicates and single:
        # Per-column first/last by one integral order column: primitive buffers, so
        # a hash aggregate (no sort); every column comes from the same row.
        o = F.coalesce(F.col(right_order[0]).cast("long"), F.lit(2 ** 63 - 1))
        g = r0.groupBy(*by, rt.alias("_t")).agg(
            *[F.min_by(F.col(c), o).alias(f"_f_{i}") for i, c in enumerate(right_cols)],
            *[F.max_by(F.col(c), o).alias(f"_l_{i}") for i, c in enumerate(right_cols)])
        first = F.struct(*[F.col(f"_f_{i}").alias(c) for i, c in enumerate(right_cols)])
        last = F.struct(*[F.col(f"_l_{i}").alias(c) for i, c in enumerate(right_cols)])
        r = g.select(*by, "_t", F.explode(F.array(
            F.struct(F.lit(0).alias("ro"), first.alias("r")),
            F.struct(F.lit(1).alias("ro"), last.alias("r")))).alias("_x")) \
             .select(*by, "_t", F.col("_x.r").alias("_r"), F.col("_x.ro").alias("_o"))
    else:
        r = r0.select(
            *by, rt.alias("_t"), F.struct(*[F.col(c) for c in right_cols]).alias("_r"),
            F.struct(*[F.col(c) for c in (right_order or [])]).alias("_o") if right_order
            else F.lit(0).alias("_o"))
        if collapse_duplicates:
            g = r.groupBy(*by, "_t").agg(F.min_by("_r", "_o").alias("_first"),
                                         F.max_by("_r", "_o").alias("_last"))
            r = g.select(*by, "_t", F.explode(F.array(
                F.struct(F.lit(0).alias("ro"), F.col("_first").alias("r")),
                F.struct(F.lit(1).alias("ro"), F.col("_last").alias("r")))).alias("_x")) \
                 .select(*by, "_t", F.col("_x.r").alias("_r"), F.col("_x.ro").alias("_o"))
    r = r.withColumn("_side", F.lit(0).cast("long"))

    lcols = left.columns
    lft = left.select(*[F.col(k).alias(f"_k_{k}") for k in by], F.struct(*[F.col(c) for c in lcols]).alias("_l"), epoch_micros(on).alias("_t"))
    # at one instant right rows come first, left rows in any fixed order behind them
    lft = lft.select(*[F.col(f"_k_{k}").alias(k) for k in by], "_l", "_t", (F.pmod(F.xxhash64("_l"), F.lit(1 << 40)) + 1).alias("_side"))
    u, cols, part = scan_parts(lft.unionByName(r, allowMissingColumns=True), keys=by, time=F.col("_t"), chunk=floor_div("_t", int(chunk_seconds) * 1_000_000),
                               second=F.col("_side"), hot_rows=hot_rows)
    w = Window.partitionBy(*part).orderBy("_t", "_side", "_o")
    # Forward match = last candidate in descending order (running frames only; a
    # frame to UNBOUNDED FOLLOWING would be quadratic per partition).
    w_rev = Window.partitionBy(*part).orderBy(F.col("_t").desc(), F.col("_side").desc(), F.col("_o").desc())
    cand = F.when(F.col("_side") == 0, F.struct(F.col("_t").alias("t"), F.col("_r").alias("r")))
    u = u.withColumns({
        "_rn": F.row_number().over(w),
        "_bk": F.last(cand, ignorenulls=True).over(w.rowsBetween(UNB_PREC, 0)),
        "_fw": F.last(cand, ignorenulls=True).over(w_rev.rowsBetween(UNB_PREC, 0)),
    })
    # the last right row of a part is its last row's backward match, the first its first row's forward match
    ends = u.groupBy(*part).agg(last_row(u, F.col("_rn"))["_bk"].alias("_last"), last_row(u, -F.col("_rn"))["_fw"].alias("_first"))
    forth, back = key_window(cols).orderBy("_ch", "_sub"), key_window(cols).orderBy(F.col("_ch").desc(), F.col("_sub").desc())
    ends = ends.select(*part, F.last("_last", ignorenulls=True).over(forth.rowsBetween(UNB_PREC, -1)).alias("_before"),
                       F.last("_first", ignorenulls=True).over(back.rowsBetween(UNB_PREC, -1)).alias("_behind"))
    u = join_keys(u.where("_side > 0"), ends, part, "left")
    u = u.withColumns({"_bk": F.coalesce("_bk", "_before"), "_fw": F.coalesce("_fw", "_behind")})
    db = F.col("_t") - F.col("_bk.t")
    df_ = F.col("_fw.t") - F.col("_t")
    back_ok = F.col("_bk").isNotNull() & (db <= tol)
    fwd_ok = F.col("_fw").isNotNull() & (df_ <= tol)
    pick = (F.when(back_ok & (~fwd_ok | (db <= df_)), F.col("_bk.r"))
            .when(fwd_ok, F.col("_fw.r")))
    u = u.withColumn("_m", pick)
    return u.select(*[F.col(f"_l.{c}").alias(c) for c in lcols],
                    *[F.col(f"_m.{c}").alias(c) for c in right_cols])
