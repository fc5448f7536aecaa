"""Exact order statistics without holding a group in one task.

``ranked_values`` turns a column into its distinct values with their count and
the number of smaller values in the same group (``_below``). It is the base of
exact quantiles (A2, A11, A17) and of Q-Q positions (A20).

Plan: (1) partial+final aggregate to distinct (key, value) counts - a hot value
collapses inside each map task; (2) value buckets from the data: ``SPLITTERS``
sampled quantiles of the distinct values per key, each interval cut into
``PARTS`` equal widths, so clustered values and heavy tails spread alike; the
per-bucket totals and their exclusive prefix are a table of at most keys x
SPLITTERS x PARTS rows; (3) a running count inside each (key, bucket). The
buckets only deal out the work; any bucketing gives the same exact ranks.

NaN is missing, as in pandas, in every method. ``exact`` (the distributed ranks)
is the only default at every size. Spark's ``percentile`` keeps every distinct
value of a group in one hash map in the final task; it is offered as
``method="in_memory"`` (same results), ``percentile_approx`` as ``"approx"``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltframe.functions.columns import present
from voltframe.operators.sequence import UNB_PREC, join_keys, join_small, key_window


SPLITTERS, PARTS = 64, 64


def value_bucket(v, splitters):
    """Monotone bucket of a double among sorted ``splitters``: the interval, and its equal-width part."""
    i = F.size(F.filter(splitters, lambda s: s <= v))
    lo, hi = F.get(splitters, i - 1), F.get(splitters, i)
    width = hi - lo
    inside = (i > 0) & (width > 0) & (width < float("inf"))
    part = F.when(inside, F.least(F.lit(PARTS - 1), F.floor((v - lo) / width * F.lit(float(PARTS)))))
    return (i.cast("long") * PARTS + F.coalesce(part, F.lit(0))).cast("long")


def ranked_values(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct (keys, value) rows with ``_cnt``, ``_n`` (group size) and ``_below``."""
    keys = list(keys)
    v = F.col(value)
    vc = df.withColumn(value, present(value)).where(v.isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_cnt"))
    marks = [i / SPLITTERS for i in range(1, SPLITTERS)]
    vc = join_small(vc, vc.groupBy(*keys).agg(F.percentile_approx(value, marks, 1000).alias("_split")), keys)
    vc = vc.withColumn("_b", value_bucket(v, F.col("_split"))).drop("_split")
    bt = vc.groupBy(*keys, "_b").agg(F.sum("_cnt").alias("_bn"))
    kw = key_window(keys)
    bt = bt.withColumns({
        "_boff": F.coalesce(F.sum("_bn").over(kw.orderBy("_b").rowsBetween(UNB_PREC, -1)), F.lit(0)),
        "_n": F.sum("_bn").over(kw),
    })
    vc = join_keys(vc, bt.select(*keys, "_b", "_boff", "_n"), [*keys, "_b"])
    w = Window.partitionBy(*keys, "_b").orderBy(value).rowsBetween(UNB_PREC, -1)
    vc = vc.withColumn("_below", (F.col("_boff") + F.coalesce(F.sum("_cnt").over(w), F.lit(0))).cast("long"))
    return vc.drop("_b", "_boff")


def value_at_rank(ranked: DataFrame, k, value: str):
    """Aggregate expression: the value whose rank range holds 0-based rank ``k``."""
    below, cnt = F.col("_below"), F.col("_cnt")
    return F.max(F.when((below <= k) & (k < below + cnt), F.col(value)))


def quantiles(df: DataFrame, value: str, probs: Mapping[str, float], keys: Sequence[str] = (),
              method: str = "exact") -> DataFrame:
    """Linear-interpolated quantiles (pandas / numpy 'linear' rule) per key.

    Returns ``keys + list(probs)`` columns plus ``n`` (count of values that are neither
    NULL nor NaN). ``exact`` and ``in_memory`` give identical results; ``approx`` does not.
    """
    keys = list(keys)
    if method in ("approx", "in_memory"):
        df = df.withColumn(value, present(value))
    if method == "approx":
        aggs = [F.percentile_approx(value, float(p), 100_000).cast("double").alias(name)
                for name, p in probs.items()]
        return df.groupBy(*keys).agg(*aggs, F.count(value).alias("n"))
    if method == "in_memory":
        aggs = [F.percentile(F.col(value).cast("double"), float(p)).alias(name) for name, p in probs.items()]
        return df.groupBy(*keys).agg(*aggs, F.count(value).alias("n"))
    if method != "exact":
        raise ValueError(f"unknown quantile method {method!r}")
    r = ranked_values(df, value, keys)
    n = F.col("_n")
    aggs = [F.first("_n").alias("n")]
    for name, p in probs.items():
        pos = (n - 1).cast("double") * F.lit(float(p))
        aggs.append(value_at_rank(r, F.floor(pos), value).alias(f"_{name}_lo"))
        aggs.append(value_at_rank(r, F.ceil(pos), value).alias(f"_{name}_hi"))
        aggs.append(F.first(pos - F.floor(pos)).alias(f"_{name}_t"))
    q = r.groupBy(*keys).agg(*aggs)
    cols = []
    for name in probs:
        lo, hi, t = F.col(f"_{name}_lo"), F.col(f"_{name}_hi"), F.col(f"_{name}_t")
        cols.append((lo + (hi - lo) * t).alias(name))
    return q.select(*keys, *cols, "n")
