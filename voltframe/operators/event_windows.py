"""Hazard-event windows and the interval join that tags series rows.

An event window is ``[start - buffer, end + buffer]`` (closed). Every series row
inside a window of its region is emitted once per matching event, tagged with
the event id, so overlapping windows duplicate rows (as repeated API pulls do).

Plan: time is cut into blocks of 2^level days. Each window is indexed at the one level whose
blocks are at least as long as the window, so it touches two blocks at most, a window of ten
years as one of a day; a series row is looked up once per level that any window uses. The
series is equi-joined on (region, level, block) and then filtered on the exact bounds: a window's
candidates lie within four times its length. The index is broadcast only after its rows and
bytes are checked against bounds; otherwise it is a regular shuffle join that AQE can split when
one block is hot. The earliest and latest instant of all windows and the levels in use are read
first (one row); the instants filter the series as literals, so a series read from files skips
what lies outside them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltframe.functions.columns import shielded

BROADCAST_MAX_ROWS, BROADCAST_MAX_BYTES = 200_000, 32 << 20


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint only when the rows are proven <= ``max_rows`` and their text, binary and nested
    values <= ``max_bytes`` (one probe, which reads ``max_rows`` + 1 rows at most)."""
    wide = [c for c, t in df.dtypes if t in ("string", "binary") or t.startswith(("array", "map", "struct"))]
    width = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)).cast("long") for c in wide), F.lit(0).cast("long"))
    seen = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("bytes")).first()
    return F.broadcast(df) if seen.n <= max_rows and (seen.bytes or 0) <= max_bytes else df


def with_default_ids(catalog: DataFrame, id_col: str = "event_id", pos_col: str = "catalog_pos",
                     prefix: str = "event_") -> DataFrame:
    """A missing event id becomes ``event_{position}`` (0-based catalog position)."""
    return catalog.withColumn(id_col, F.coalesce(
        F.col(id_col), F.concat(F.lit(prefix), F.col(pos_col).cast("string"))))


def event_windows(catalog: DataFrame, *, start: str = "start", end: str = "end",
                  buffer_days: int = 7) -> DataFrame:
    """Add ``window_lo``/``window_hi`` and P20: their ISO-8601 UTC text forms."""
    buf = F.expr(f"INTERVAL {int(buffer_days)} DAYS")
    lo = F.col(start) - buf
    hi = F.col(end) + buf
    return catalog.withColumns({
        "window_lo": lo,
        "window_hi": hi,
        "window_lo_iso": F.date_format(lo, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        "window_hi_iso": F.date_format(hi, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        "window_lo_day": F.date_format(lo, "yyyy-MM-dd"),
        "window_hi_day": F.date_format(hi, "yyyy-MM-dd"),
    })


def map_regions(windows: DataFrame, region_map: Mapping[str, str] | None, region: str = "region",
                out: str = "series_key") -> DataFrame:
    """Catalog region -> series key (e.g. a balancing authority); unmapped regions pass through."""
    if not region_map:
        return windows.withColumn(out, F.col(region))
    m = F.create_map(*[F.lit(x) for kv in region_map.items() for x in kv])
    return windows.withColumn(out, F.coalesce(m[F.col(region)], F.col(region)))


def _level(days: Column) -> Column:
    """Smallest L with 2^L >= ``days`` (at least 1), exactly: the binary digits of days - 1."""
    return F.when(days <= 1, F.lit(0)).otherwise(F.length(F.bin(days - 1)))


def _block(day: Column, level: Column) -> Column:
    """Index of the block of 2^level days that holds a day number (also before 1970)."""
    return F.call_function("shiftright", day, level)


def window_index(windows: DataFrame, lo: str = "window_lo", hi: str = "window_hi") -> DataFrame:
    """``windows`` with ``_level`` and ``_block``: one or two rows per window, whatever its length.
    Windows that end before they start, or lack a bound, have none."""
    first, last = F.unix_date(F.to_date(lo)), F.unix_date(F.to_date(hi))
    w = windows.where(F.col(lo) <= F.col(hi)).withColumn("_level", _level(last - first + 1))
    return w.withColumn("_block", F.explode(F.sequence(_block(first, F.col("_level")), _block(last, F.col("_level")))))


def _lookups(series: DataFrame, windows: DataFrame, ts: str, whole_days: bool) -> DataFrame:
    """Series rows from the first to the last instant any window covers, as literal bounds that
    reach the scan (whole days: from the first day to the end of the last), once per level in use,
    with ``_level`` and ``_block``. Rows without a time are in no window. One job at plan-build time:
    a one-row aggregate of the windows (about twenty levels at most)."""
    lo, hi = F.min("window_lo"), F.max("window_hi")
    if whole_days:
        lo, hi = F.date_trunc("day", lo), F.date_trunc("day", hi) + F.expr("INTERVAL 1 DAY")
    # through text, so that the bounds take the series' own timestamp type (session time zone)
    seen = windows.agg(lo.cast("string").alias("lo"), hi.cast("string").alias("hi"),
                       F.sort_array(F.collect_set(_level(F.datediff("window_hi", "window_lo") + 1))).alias("levels")).first()
    if seen is None or seen.lo is None:
        series, levels = series.where(F.lit(False)), [0]
    else:
        kind, levels = series.schema[ts].dataType, seen.levels
        series = series.where((F.col(ts) >= F.lit(seen.lo).cast(kind)) & (F.col(ts) <= F.lit(seen.hi).cast(kind)))
    level = F.lit(levels[0]) if len(levels) == 1 else F.explode(F.array(*map(F.lit, levels)))
    return series.withColumn("_level", level).withColumn("_block", _block(F.unix_date(F.to_date(F.col(ts))), F.col("_level")))


@shielded()
def attach_events(series: DataFrame, windows: DataFrame, *, ts: str, series_key: str | None,
                  window_key: str = "series_key", event_cols: Sequence[str] = ("event_id",),
                  whole_days: bool = False, broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Series rows inside each event window (closed bounds), tagged with ``event_cols``.

    ``whole_days`` widens every window to whole calendar days (the demand pull
    asks for dates, not instants). ``series_key=None`` matches every window.
    """
    event_cols = list(event_cols)
    windows = windows.where(F.col("window_lo") <= F.col("window_hi"))
    wcols = [F.col(c) for c in event_cols] + [F.col("window_lo").alias("_wlo"), F.col("window_hi").alias("_whi")]
    if series_key is not None:
        wcols.append(F.col(window_key).alias("_wkey"))
    index = broadcast_if_small(window_index(windows.select(*wcols), "_wlo", "_whi"), broadcast_max_rows)
    s = _lookups(series, windows, ts, whole_days)
    cond = (s["_level"] == index["_level"]) & (s["_block"] == index["_block"])
    if series_key is not None:
        cond = cond & (s[series_key] == index["_wkey"])
    at, lo, hi = (c if not whole_days else F.to_date(c) for c in (s[ts], index["_wlo"], index["_whi"]))
    out = s.join(index, cond & (at >= lo) & (at <= hi), "inner")
    return out.select(*[s[c] for c in series.columns], *[index[c] for c in event_cols])
