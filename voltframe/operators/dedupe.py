"""A1: remove duplicate records by a composite key, keeping the first by an explicit order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.functions.columns import shielded


@shielded()
def dedupe_first(df: DataFrame, subset: Sequence[str], order: Sequence[str], copies: str | None = None) -> DataFrame:
    """Keep, per ``subset`` key, the row that comes first in ``order``.

    NULL key parts compare equal (as in pandas). ``order`` must be total, so the
    result is deterministic (``dropDuplicates`` keeps an arbitrary row).

    This is an aggregate, not a ``row_number`` window: the partial aggregate
    reduces every key to one row inside each map task before the shuffle, so a
    key whose copies make up a large share of the table never lands in one task.
    ``copies`` optionally names a column that counts the rows each kept row stands for.
    """
    subset = list(subset)
    order = list(order)
    rest = [c for c in df.columns if c not in subset]
    count = [F.count(F.lit(1)).alias(copies)] if copies else []
    names = [*df.columns, *([copies] if copies else [])]
    if len(order) == 1 and order[0] in rest and isinstance(df.schema[order[0]].dataType, T.IntegralType):
        # One total integral order column: a min_by per column keeps primitive
        # aggregation buffers, so Spark can use a hash aggregate (no map-side sort)
        # when the column types allow. Every column comes from the same (first) row;
        # a NULL order value sorts last.
        o = F.coalesce(F.col(order[0]).cast("long"), F.lit(2 ** 63 - 1))
        aggs = [F.min_by(F.col(c), o).alias(c) for c in rest]
        return df.groupBy(*subset).agg(*aggs, *count).select(*names)
    # min_by skips rows whose ordering is NULL; the order struct itself is never NULL.
    best = F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order]))
    out = df.groupBy(*subset).agg(best.alias("_first"), *count)
    return out.select(*[F.col(c) for c in subset], *[F.col(f"_first.{c}").alias(c) for c in rest], *names[len(df.columns):]) \
              .select(*names)
