"""Z-score / min-max scaling with reusable parameters.

All statistics come from one aggregate (one row); it is broadcast to the rows.
Parameters are returned as a long DataFrame ``(column, stat, value)`` so they
can be stored and re-applied with ``apply_scaling``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.functions.columns import present, shielded

_STATS = {"zscore": ("mean", "std"), "minmax": ("min", "max")}


def scaling_params(df: DataFrame, columns: Sequence[str], method: str = "zscore") -> DataFrame:
    if method not in _STATS:
        raise ValueError(f"unknown scaling method {method!r}; use 'zscore' or 'minmax'")
    aggs = []
    for c in columns:
        if method == "zscore":
            aggs += [F.avg(present(c)).alias(f"{c}|mean"), present(F.stddev_samp(present(c))).alias(f"{c}|std")]
        else:
            aggs += [F.min(present(c)).alias(f"{c}|min"), F.max(present(c)).alias(f"{c}|max")]
    wide = df.agg(*aggs)      # NaN is missing
    pairs = [F.struct(F.lit(c).alias("column"), F.lit(s).alias("stat"), F.col(f"`{c}|{s}`").alias("value"))
             for c in columns for s in _STATS[method]]
    return wide.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


@shielded()
def apply_scaling(df: DataFrame, params: DataFrame, columns: Sequence[str], method: str = "zscore",
                  suffix: str = "_normalized") -> DataFrame:
    """Add ``{c}{suffix}``; a constant column, a NaN and a column whose parameter is infinite give
    NULL (pandas gives NaN)."""
    if method not in _STATS:
        raise ValueError(f"unknown scaling method {method!r}; use 'zscore' or 'minmax'")
    a, b = _STATS[method]
    # One row of parameters (a global aggregate), so the broadcast has a fixed size.
    wide = params.groupBy().agg(*[
        F.max(F.when((F.col("column") == c) & (F.col("stat") == s), F.col("value"))).alias(f"_p_{c}_{s}")
        for c in columns for s in (a, b)])
    d = df.crossJoin(F.broadcast(wide))
    new = {}
    for c in columns:
        x = present(c)
        pa, pb = F.col(f"_p_{c}_{a}"), F.col(f"_p_{c}_{b}")
        if method == "zscore":
            new[f"{c}{suffix}"] = present(F.try_divide(x - pa, pb))
        else:
            new[f"{c}{suffix}"] = present(F.try_divide(x - pa, pb - pa))
    return d.withColumns(new).drop(*[f"_p_{c}_{s}" for c in columns for s in (a, b)])


def normalize_features(df: DataFrame, columns: Sequence[str], method: str = "zscore"
                       ) -> tuple[DataFrame, DataFrame]:
    """Scale ``columns``; returns (scaled frame, parameters)."""
    params = scaling_params(df, columns, method)
    return apply_scaling(df, params, columns, method), params
