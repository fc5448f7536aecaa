"""Null out impossible values; cap statistical outliers (IQR or z-score)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.functions.columns import clip_to, null_outside, outside, present, shielded
from voltframe.operators.ranks import quantiles
from voltframe.operators.sequence import join_small


def impossible_to_null(df: DataFrame, value: str, min_val: float | None = None,
                       max_val: float | None = None, flag: str | None = None) -> DataFrame:
    """Values below ``min_val`` or above ``max_val`` become NULL; the bounds are kept.

    ``flag`` optionally names a boolean column marking the corrected rows (for counters). A NaN is
    missing, not impossible: it stays and is not counted.
    """
    v = F.col(value)
    out = df
    if flag:
        out = out.withColumn(flag, outside(v, *[None if b is None else F.lit(float(b)) for b in (min_val, max_val)]))
    return out.withColumn(value, null_outside(v, min_val, max_val))


def outlier_bounds(df: DataFrame, value: str, method: str = "iqr", threshold: float = 3.0,
                   keys: Sequence[str] = (), quantile_method: str = "exact") -> DataFrame:
    """Per-key ``(_lo, _hi)``: [Q1 - k*IQR, Q3 + k*IQR] or mean -/+ k*std (sample std). NaN is missing;
    a bound that comes out as NaN (values with infinities) is NULL."""
    keys = list(keys)
    k = F.lit(float(threshold))
    if method == "iqr":
        q = quantiles(df, value, {"_q1": 0.25, "_q3": 0.75}, keys, method=quantile_method)
        iqr = F.col("_q3") - F.col("_q1")
        return q.select(*keys, present(F.col("_q1") - k * iqr).alias("_lo"), present(F.col("_q3") + k * iqr).alias("_hi"))
    if method == "zscore":
        s = df.groupBy(*keys).agg(F.avg(present(value)).alias("_m"), F.stddev_samp(present(value)).alias("_s"))
        return s.select(*keys, present(F.col("_m") - k * F.col("_s")).alias("_lo"),
                        present(F.col("_m") + k * F.col("_s")).alias("_hi"))
    raise ValueError(f"unknown outlier method {method!r}; use 'iqr' or 'zscore'")


@shielded()
def cap_outliers(df: DataFrame, value: str, method: str = "iqr", threshold: float = 3.0,
                 keys: Sequence[str] = (), quantile_method: str = "exact") -> DataFrame:
    """Cap values outside the bounds to the bounds; a missing bound caps nothing, NaN stays.

    Adds ``{value}_original`` (value before capping) and ``{value}_is_outlier``.
    Both columns are always present (a plan's schema must not depend on data).
    """
    keys = list(keys)
    b = outlier_bounds(df, value, method, threshold, keys, quantile_method)
    d = join_small(df, b, keys, how="left")
    v = F.col(value)
    lo, hi = F.col("_lo"), F.col("_hi")
    flag = outside(v, lo, hi)
    return (d.withColumns({f"{value}_original": v, f"{value}_is_outlier": flag})
             .withColumn(value, clip_to(v, lo, hi))
             .drop("_lo", "_hi"))
