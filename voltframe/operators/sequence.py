"""Distributed forms of order-dependent work.

A window partitioned only by the series key puts a whole series into one task;
with no key at all it puts the whole table there. The helpers below split a
series into chunks (time buckets or position blocks) so every window runs on a
bounded partition:

* ``dense_positions`` - row position inside a series: per-chunk counts, an
  exclusive prefix over the (small) chunk table, then ``row_number`` per chunk.
* ``halo_windows`` - fixed-width row frames (rolling, lag, centred averages) over
  a dense position: each row is copied into the neighbouring chunks its frame
  reaches, the window runs per chunk and only home rows are kept.
* ``running_sum`` - cumulative sum: per-chunk totals, prefix over chunks, then
  an in-chunk running sum.
* ``scan_parts`` - the chunks themselves, on two levels: a chunk that holds too many
  rows is cut at quantiles of its times, an instant (or the rows without a time) by
  the next order column.

Chunk tables have one row per (key, chunk); they are windowed per key and joined
back. AQE turns those joins into broadcasts once their real size is known.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.functions.columns import epoch_micros, floor_div, present
from voltframe.session import cut_lineage

UNB_PREC = Window.unboundedPreceding
UNB_FOLL = Window.unboundedFollowing


def _nulls_last(order: Sequence[Column | str]) -> list[Column]:
    """Ascending order with NULLs last (pandas' sort order; Spark's default puts them first)."""
    return [(F.col(c) if isinstance(c, str) else c).asc_nulls_last() for c in order]


def last_row(df: DataFrame, order: Column) -> Column:
    """The whole last row (by ``order``) of a group, as a struct.

    Chunk summaries aggregate the same windowed rows the main branch uses. If the
    summary read fewer columns, column pruning would give it a different
    projection and Spark would scan and shuffle the rows a second time; taking a
    field of the whole last row keeps both branches identical so AQE reuses the
    shuffle stage.
    """
    return F.max_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), order)


def key_window(keys: Sequence[str]) -> Window:
    """Window over a chunk table. Without keys the chunk table is global but small."""
    return Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))


def auto_chunk_seconds(df: DataFrame, ts: str, keys: Sequence[str] = (), target_rows: int = 2_000_000,
                       min_seconds: int = 60, max_seconds: int = 7 * 86_400) -> int:
    """Chunk width for order-dependent scans, sized from the peak hourly rate of any key.

    One small aggregate (rows per key and hour, reading only the key and time
    columns; partial aggregation map-side) gives the busiest hour of any series;
    the width is chosen so that even that rate yields about ``target_rows`` rows
    per chunk, rounded down to a power-of-two number of minutes and clamped to
    [min_seconds, max_seconds]. Bursts therefore shrink the chunks instead of
    overloading one task.
    """
    from voltframe.functions.columns import slot_index
    keys = list(keys)
    per_hour = df.groupBy(*keys, slot_index(ts, 3600).alias("_h")).agg(F.count(F.lit(1)).alias("n"))
    row = per_hour.agg(F.max("n")).first()
    peak = (row[0] or 0) / 3600.0 if row else 0.0
    if peak <= 0:
        return max_seconds
    width = target_rows / peak
    minutes = 1
    while minutes * 2 * 60 <= width and minutes * 2 * 60 <= max_seconds:
        minutes *= 2
    return int(min(max(minutes * 60, min_seconds), max_seconds))


def join_keys(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``cols`` where NULL matches NULL (as ``groupBy`` groups them).

    Planned as an ordinary hash / sort-merge equi-join (null-safe equality is a
    join key for Spark). The right side's copies of ``cols`` are dropped.
    """
    cols = list(cols)
    if not cols:
        return left.crossJoin(right)
    r = right.select(*[F.col(f"`{c}`").alias(f"__r_{c}") for c in cols],
                     *[F.col(f"`{c}`") for c in right.columns if c not in cols])
    free = {f.name for f in left.schema if not f.nullable} & {f.name for f in right.schema if not f.nullable}
    # plain equality on null-free columns: the join then uses the partitioning a window on them has made
    cond = [left[c] == r[f"__r_{c}"] if c in free else left[c].eqNullSafe(r[f"__r_{c}"]) for c in cols]
    return left.join(r, cond, how).drop(*[f"__r_{c}" for c in cols])


NO_CHUNK = 2**62


def null_free(df: DataFrame, keys: Sequence[str], chunk: Column, name: str = "_ch") -> tuple[DataFrame, list[str]]:
    """``df`` with the chunk as a null-free column (rows without a time: the last chunk) and two
    null-free columns per key; returns the key columns to partition and join by."""
    cols = {name: F.coalesce(chunk.cast("long"), F.lit(NO_CHUNK))}
    for i, k in enumerate(keys):
        cols |= {f"_key{i}": F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")), f"_nokey{i}": F.col(f"`{k}`").isNull()}
    return df.withColumns(cols), [c for c in cols if c != name]


#: Bytes of key text and numbers up to which a per-key table is broadcast.
PER_KEY_BYTES = 32 << 20


def broadcast_per_key(small: DataFrame, max_bytes: int = PER_KEY_BYTES) -> DataFrame:
    """A per-key table, written once and measured as it is written (at plan-build time): hinted for
    broadcast if its values take at most ``max_bytes``, else left to a shuffle join. Same rows either way."""
    width, watch = F.lit(0), Observation()
    for f in small.schema:
        c = F.col(f"`{f.name}`")
        kind = f.dataType.typeName()
        width = width + (F.coalesce(F.octet_length(c), F.lit(0)) + 16 if kind in ("string", "binary") else F.coalesce(F.size(c), F.lit(0)) * 8 + 16 if kind == "array" else F.lit(8))
    t = cut_lineage(small.observe(watch, F.sum(width).alias("bytes")), "per-key")
    return F.broadcast(t) if (watch.get["bytes"] or 0) <= max_bytes else t


#: Rows above which a part of a scan is cut finer, cuts made at each of two levels, and rows of
#: splitters (about 2 KB each) up to which they are broadcast.
HOT_ROWS, CUTS, HOT_BROADCAST = 4_000_000, 256, 10_000


def _hot_splitters(d: DataFrame, part: Sequence[str], by: Column, hot_rows: int, one_value: Column | None = None) -> DataFrame | None:
    """``part`` and ``_cuts`` (sampled quantiles of ``by``) of the parts above ``hot_rows`` rows, or None.
    With ``one_value`` only parts in which it does not vary."""
    rule = F.count(F.lit(1)) > hot_rows
    if one_value is not None:
        rule = rule & F.min(one_value).eqNullSafe(F.max(one_value))
    marks = [i / CUTS for i in range(1, CUTS)]
    hot = d.groupBy(*part).agg(rule.alias("_hot")).where("_hot").drop("_hot")
    if not hot.limit(1).count():
        return None
    found = join_keys(d.select(*part, by.alias("_by")), hot.withColumn("_is", F.lit(1)), part)
    cuts = cut_lineage(found.groupBy(*part).agg(F.percentile_approx("_by", marks, 10_000).alias("_cuts")), "cuts")
    return F.broadcast(cuts) if cuts.limit(HOT_BROADCAST + 1).count() <= HOT_BROADCAST else cuts


def scan_parts(df: DataFrame, *, keys: Sequence[str], time: Column, chunk: Column, second: Column | None = None,
               name: str = "_ch", hot_rows: int | None = HOT_ROWS) -> tuple[DataFrame, list[str], list[str]]:
    """The parts of an order-dependent scan: ``name`` (the chunk) and ``_sub``, both free of NULLs and
    monotone in (``time``, ``second``), so a scan goes through a series in order of (chunk, sub).

    ``_sub`` is 0 unless a chunk holds more than ``hot_rows`` rows. Such a chunk is cut at sampled
    quantiles of its own times, wherever in it a burst lies, and a single instant, or the rows without
    a time, that are still above ``hot_rows`` at quantiles of ``second`` (the next column of the order,
    as a long; where nothing orders rows of one instant, any hash of the row). Probes: one aggregate
    (partial per task); only if it finds a hot chunk the rows are written once and cut.
    Returns the rows, the null-free key columns and the columns of a part.
    """
    d, cols = null_free(df, keys, chunk, name)
    part = [*cols, name]
    zero = F.lit(0).cast("long")
    if not hot_rows:
        return d.withColumn("_sub", zero), cols, [*part, "_sub"]
    d = d.withColumn("_time", time.cast("long"))
    if not d.groupBy(*part).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows).limit(1).count():
        return d.drop("_time").withColumn("_sub", zero), cols, [*part, "_sub"]
    d = cut_lineage(d, "hot-scan")
    # even places lie between cuts; a value so frequent that it is several cuts has an odd place, a part of its own
    place = lambda v: (F.size(F.filter("_cuts", lambda c: c < v)) * 2 + (F.size(F.filter("_cuts", lambda c: c == v)) > 1).cast("int")).cast("long")
    cuts = _hot_splitters(d, part, F.col("_time"), hot_rows)
    d = join_keys(d, cuts, part, "left").withColumn("_sub", F.when(F.col("_time").isNull() | F.col("_cuts").isNull(), zero).otherwise(place(F.col("_time")))).drop("_cuts")
    if second is not None:
        d = d.withColumn("_second", F.coalesce(second.cast("long"), F.lit(2**63 - 1)))
        cuts = _hot_splitters(d, [*part, "_sub"], F.col("_second"), hot_rows, F.col("_time"))
        if cuts is not None:
            d = join_keys(d, cuts, [*part, "_sub"], "left")
            d = d.withColumn("_sub", F.col("_sub") * (2 * CUTS + 2) + F.when(F.col("_cuts").isNull(), zero).otherwise(place(F.col("_second")))).drop("_cuts")
        d = d.drop("_second")
    return d.drop("_time"), cols, [*part, "_sub"]


def second_of(df: DataFrame, order: Sequence[Column | str]) -> Column | None:
    """What may split rows of one instant: the order's second column if it is integral, a hash of the
    row if the order has none, else nothing."""
    if len(order) < 2:
        return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return F.col(order[1]) if isinstance(order[1], str) and isinstance(df.schema[order[1]].dataType, T.IntegralType) else None


def join_small(df: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Attach per-key statistics.

    With no key the statistics are a single global row: broadcast it (size is one
    row by construction). With keys the table has one row per key: broadcast if it
    was measured to be small (``broadcast_per_key``), so the rows are not shuffled
    on a key of low cardinality.
    """
    if not keys:
        return df.crossJoin(F.broadcast(small))
    return join_keys(df, broadcast_per_key(small), keys, how)


def dense_positions(df: DataFrame, *, keys: Sequence[str], order: Sequence[Column | str],
                    chunk: Column, pos: str = "_pos", hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Add ``pos``: 0-based row position within each key in ``order`` (the time first).

    ``chunk`` must be monotone in ``order`` (e.g. a time bucket of the leading
    order column). The order must be total (end it with a unique column).
    """
    d, keys, part = scan_parts(df, keys=list(keys), time=epoch_micros(order[0]), chunk=chunk, second=second_of(df, order), name="_chunk", hot_rows=hot_rows)
    d = d.withColumn("_rn", F.row_number().over(Window.partitionBy(*part).orderBy(*_nulls_last(order))))
    counts = d.groupBy(*part).agg(last_row(d, F.col("_rn"))["_rn"].alias("_cn"))
    counts = counts.withColumn(
        "_off", F.coalesce(F.sum("_cn").over(key_window(keys).orderBy("_chunk", "_sub")
                                             .rowsBetween(UNB_PREC, -1)), F.lit(0)).cast("long"))
    d = join_keys(d, counts.select(*part, "_off"), part, "left")
    return d.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_off") + F.col("_rn") - 1).cast("long").alias(pos))


def halo_windows(df: DataFrame, *, keys: Sequence[str], pos: str, back: int, fwd: int,
                 chunk_rows: int, columns: Callable[[Window], dict[str, Column]]) -> DataFrame:
    """Evaluate row-frame windows over a dense 0-based ``pos`` without a per-key partition.

    ``columns(w)`` returns the new columns built on ``w`` (partitioned by key and
    chunk, ordered by ``pos``); every frame must stay within ``back`` rows before
    and ``fwd`` rows after the current row. Rows are replicated into at most
    ``1 + ceil((back + fwd) / chunk_rows)`` chunks.
    """
    keys = list(keys)
    c = int(max(chunk_rows, 1))
    p = F.col(pos)
    rep = df.withColumn("_hc", F.explode(F.sequence(floor_div(p - F.lit(fwd), c),
                                                    floor_div(p + F.lit(back), c))))
    w = Window.partitionBy(*keys, "_hc").orderBy(pos)
    new_cols = columns(w)
    out = rep.withColumns(new_cols)
    return out.where(floor_div(p, c) == F.col("_hc")).drop("_hc")


def running_sum(df: DataFrame, *, keys: Sequence[str], order: Sequence[Column | str],
                chunk: Column, value: str, out: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Cumulative sum of ``value`` in ``order``; rows that are NULL or NaN stay NULL, the sum carries on."""
    d, keys, part = scan_parts(df, keys=list(keys), time=epoch_micros(order[0]), chunk=chunk, second=second_of(df, order), name="_chunk", hot_rows=hot_rows)
    w = Window.partitionBy(*part).orderBy(*_nulls_last(order))
    v = present(value)
    d = d.withColumns({"_in": F.sum(v).over(w.rowsBetween(UNB_PREC, 0)), "_rn": F.row_number().over(w)})
    tot = d.groupBy(*part).agg(last_row(d, F.col("_rn"))["_in"].alias("_ct"))
    tot = tot.withColumn("_before", F.sum("_ct").over(key_window(keys).orderBy("_chunk", "_sub")
                                                      .rowsBetween(UNB_PREC, -1)))
    d = join_keys(d, tot.select(*part, "_before"), part, "left")
    run = F.when(F.col("_in").isNull(), F.col("_before")).otherwise(
        F.coalesce(F.col("_before"), F.lit(0.0)) + F.col("_in"))
    return d.select(*[F.col(f"`{c}`") for c in df.columns], F.when(v.isNotNull(), run).alias(out))
