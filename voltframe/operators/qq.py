"""Normal Q-Q points and the least-squares fit through them.

Theoretical positions (Filliben): 1 - 0.5^(1/n) for the first order statistic,
0.5^(1/n) for the last, (i - 0.3175) / (n + 0.365) otherwise (1-based i); the
theoretical quantile is the inverse normal CDF of that position.

Order statistics come from ``ranks.ranked_values`` (distinct values with their
rank range). Rank ranges are expanded in two steps - blocks of at most
``block`` ranks, reshuffled, then single ranks - so a value repeated millions
of times is expanded by many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.functions.columns import floor_div, inv_norm_cdf, safe_corr
from voltframe.operators.ranks import ranked_values


def qq_points(df: DataFrame, value: str, keys: Sequence[str] = (), block: int = 65_536) -> DataFrame:
    """One row per non-null value: ``i`` (1-based rank), ``n``, ``osm`` (theoretical), ``osr`` (sample)."""
    keys = list(keys)
    r = ranked_values(df, value, keys)
    cnt, below = F.col("_cnt"), F.col("_below")
    r = r.withColumn("_blk", F.explode(F.sequence(F.lit(0).cast("long"), floor_div(cnt - 1, block))))
    r = r.repartition(*[F.col(k) for k in keys], F.col(value), F.col("_blk"))
    first = below + F.col("_blk") * block
    last = F.least(below + cnt, first + block) - 1
    r = r.select(*keys, F.col(value).cast("double").alias("osr"), F.col("_n").alias("n"),
                 F.explode(F.sequence(first, last)).alias("_r0"))
    n = F.col("n").cast("double")
    i = F.col("_r0") + 1
    top = F.pow(F.lit(0.5), F.lit(1.0) / n)
    m = (F.when(i == 1, F.lit(1.0) - top).when(i == F.col("n"), top)
         .otherwise((i.cast("double") - F.lit(0.3175)) / (n + F.lit(0.365))))
    return r.select(*keys, i.alias("i"), F.col("n"), inv_norm_cdf(m).alias("osm"), "osr")


def qq_fit(points: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """slope, intercept, r of osr on osm (and n)."""
    keys = list(keys)
    return points.groupBy(*keys).agg(F.regr_slope("osr", "osm").alias("slope"),
                                     F.regr_intercept("osr", "osm").alias("intercept"),
                                     safe_corr("osm", "osr").alias("r"), F.count(F.lit(1)).alias("n"))
