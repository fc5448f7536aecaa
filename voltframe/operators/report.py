"""Data-quality report and cleaning counters as DataFrames (no driver loops)."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.functions.columns import present


def quality_row(df: DataFrame, *, name: str, ts: str, value: str) -> DataFrame:
    """One row: dataset, total_records, date_range ('min to max', UTC), mean, std, missing_pct (NULL and NaN)."""
    fmt = "yyyy-MM-dd HH:mm:ss"
    v = present(value)
    return df.agg(
        F.lit(name).alias("dataset"),
        F.count(F.lit(1)).alias("total_records"),
        F.concat(F.date_format(F.min(ts), fmt), F.lit("+00:00 to "), F.date_format(F.max(ts), fmt),
                 F.lit("+00:00")).alias("date_range"),
        F.avg(v).alias("mean"),
        present(F.stddev_samp(v)).alias("std"),
        F.try_divide((F.count(F.lit(1)) - F.count(v)) * F.lit(100.0), F.count(F.lit(1))).alias("missing_pct"),
    )


def quality_report(datasets: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Union of ``quality_row`` for each ``name -> (df, ts, value)``; a missing dataset is skipped."""
    rows = [quality_row(df, name=n, ts=ts, value=v) for n, (df, ts, v) in datasets.items() if df is not None]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def cleaning_metrics(*, raw: DataFrame, deduped: DataFrame, imputed_flag: tuple[DataFrame, str],
                     impossible_flag: tuple[DataFrame, str], outlier_flag: tuple[DataFrame, str],
                     name: str = "all") -> DataFrame:
    """A14 counters: duplicates_removed, missing_imputed, outliers_corrected
    (impossible + capped), records_flagged (always 0, as in the source pipeline)."""
    flags = zip((imputed_flag, impossible_flag, outlier_flag), ("_c", "_d", "_e"))
    wanted = [(raw, F.count(F.lit(1)).alias("_a")), (deduped, F.count(F.lit(1)).alias("_b")),
              *[(df, F.count_if(F.col(flag)).alias(out)) for (df, flag), out in flags]]
    frames: dict[int, tuple[DataFrame, list]] = {}
    for df, col in wanted:      # counters of the same frame share one aggregate
        frames.setdefault(id(df), (df, []))[1].append(col)
    one = reduce(DataFrame.crossJoin, [df.agg(*cols) for df, cols in frames.values()])
    return one.select(F.lit(name).alias("dataset"),
                      (F.col("_a") - F.col("_b")).alias("duplicates_removed"),
                      F.col("_c").alias("missing_imputed"),
                      (F.col("_d") + F.col("_e")).alias("outliers_corrected"),
                      F.lit(0).cast("long").alias("records_flagged"))


def observed_metrics(seen: Mapping[str, int], capped: DataFrame, outlier_flag: str, name: str = "all") -> DataFrame:
    """A14 from counters observed in flight (``raw``, ``kept``, ``imputed``, ``impossible``) and one
    aggregate of the capped rows' flag; the raw rows are not read again."""
    n = lambda v: F.lit(int(v)).cast("long")
    return capped.agg(F.count_if(F.col(outlier_flag)).alias("_e")).select(
        F.lit(name).alias("dataset"), n(seen["raw"] - seen["kept"]).alias("duplicates_removed"), n(seen["imputed"]).alias("missing_imputed"),
        (n(seen["impossible"]) + F.col("_e")).alias("outliers_corrected"), F.lit(0).cast("long").alias("records_flagged"))


def write_report_json(report: DataFrame, path: str) -> None:
    """The report as JSON lines (timestamps already rendered as text)."""
    report.coalesce(1).write.mode("overwrite").json(path)
