"""Calendar, centred rolling and lag features on a dense series.

Rolling and lag frames are row frames, as in pandas. On a resampled grid a row
is a slot, so the slot index is the position and the frames run chunk-wise
through ``halo_windows`` (no per-series partition). For a series that is not a
complete grid pass ``pos`` naming a dense 0-based position column (see
``sequence.dense_positions``).

Each frame is aggregated anew (moments of its own values only): differences of running
totals would cost less per row, but lose the digits of a calm stretch in a chunk that
also holds values on a far higher level.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltframe.functions.calendar import add_calendar_features
from voltframe.functions.columns import shielded, slot_index
from voltframe.operators.sequence import halo_windows

temporal_features = add_calendar_features


def centred_frame(n: int) -> tuple[int, int]:
    """Rows before/after the current row of a centred window of ``n`` rows (pandas rule)."""
    return n // 2, (n - 1) // 2


def _rolling_cols(w: Window, value: str, windows_hours: Sequence[int], rows_per_hour: int,
                  min_periods: int | None) -> dict:
    x = F.col(value).cast("double")
    v = F.when(F.abs(x) < float("inf"), x)      # NaN and infinities are missing, as in pandas' rolling
    cols = {}
    for h in windows_hours:
        n = int(h) * rows_per_hour
        back, fwd = centred_frame(n)
        f = w.rowsBetween(-back, fwd)
        need = n if min_periods is None else int(min_periods)
        ok = F.count(v).over(f) >= F.lit(need)
        cols[f"{value}_rolling_mean_{h}h"] = F.when(ok, F.avg(v).over(f))
        cols[f"{value}_rolling_std_{h}h"] = F.when(ok, F.stddev_samp(v).over(f))
    return cols


def _lag_cols(w: Window, value: str, lags: Sequence[int]) -> dict:
    v = F.col(value)
    return {f"{value}_lag_{k}": (F.lag(v, k) if k >= 0 else F.lead(v, -k)).over(w) for k in lags}


@shielded()
def series_features(df: DataFrame, *, value: str, ts: str = "timestamp", keys: Sequence[str] = (),
                    windows_hours: Sequence[int] = (24, 168), lags: Sequence[int] = (4, 24, 96),
                    rows_per_hour: int = 4, step_seconds: int = 900, pos: str | None = None,
                    chunk_rows: int = 4096, min_periods: int | None = None) -> DataFrame:
    """Rolling mean/std (``{v}_rolling_mean_{h}h`` ...) and lags (``{v}_lag_{k}``) in one pass."""
    keys = list(keys)
    spans = [centred_frame(int(h) * rows_per_hour) for h in windows_hours]
    back = max([b for b, _ in spans] + [k for k in lags if k > 0] + [0])
    fwd = max([f for _, f in spans] + [-k for k in lags if k < 0] + [0])
    d = df if pos else df.withColumn("_gpos", slot_index(ts, step_seconds))
    p = pos or "_gpos"

    def cols(w: Window) -> dict:
        return {**_rolling_cols(w, value, windows_hours, rows_per_hour, min_periods),
                **_lag_cols(w, value, lags)}

    out = halo_windows(d, keys=keys, pos=p, back=back, fwd=fwd,
                       chunk_rows=max(chunk_rows, back + fwd), columns=cols)
    return out if pos else out.drop("_gpos")


def rolling_features(df: DataFrame, *, value: str, ts: str = "timestamp", keys: Sequence[str] = (),
                     windows_hours: Sequence[int] = (24, 168), **kw) -> DataFrame:
    """Centred rolling mean and sample std over ``h * rows_per_hour`` rows, full window required."""
    return series_features(df, value=value, ts=ts, keys=keys, windows_hours=windows_hours, lags=(), **kw)


def lag_features(df: DataFrame, *, value: str, ts: str = "timestamp", keys: Sequence[str] = (),
                 lags: Sequence[int] = (4, 24, 96), **kw) -> DataFrame:
    """Row lags (negative = lead)."""
    return series_features(df, value=value, ts=ts, keys=keys, windows_hours=(), lags=lags, **kw)
