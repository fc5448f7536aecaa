"""Chart datasets: the tables behind each exploratory chart (drawing is not built).

``e`` is the cleaned emissions grid, ``d`` the cleaned demand grid, ``merged``
the analysis base (``pipelines.analysis_base``). Event bounds are parameters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.functions.columns import present
from voltframe.operators.daily import (cumulative, daily, daily_peaks, day_between, in_range, period_label,
                                       phase_label, with_day_index)
from voltframe.operators.decompose import seasonal_decompose
from voltframe.operators.qq import qq_fit, qq_points
from voltframe.operators.resample import resample_mean
from voltframe.operators.stats import (box_stats, corr_matrix, histogram, kde_curves, linear_fit, pair_bins,
                                       trend_line)

# Correlation columns and their display labels.
CORR_COLUMNS = ("value", "demand_MW", "hour", "day_of_week", "is_weekend",
                "value_rolling_mean_24h", "value_rolling_std_24h")
CORR_LABELS = ("CO2 MOER", "Demand MW", "Hour", "Day of Week", "Is Weekend",
               "MOER Roll Mean 24h", "MOER Roll Std 24h")
# Pair-plot variables and row labels of the weekday x hour matrix.
PAIR_COLUMNS = ("value", "demand_MW", "hour", "day_of_week", "value_rolling_mean_24h")
DAY_LABELS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def event_slice(e: DataFrame, start: str, end: str) -> DataFrame:
    return e.where(in_range("timestamp", start, end))


def with_period(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.withColumn("period", period_label("timestamp", start, end))


def box_by_period(e: DataFrame, start: str, end: str) -> DataFrame:
    return box_stats(with_period(e, start, end), "value", keys=["period"])


def box_fliers_by_period(e: DataFrame, start: str, end: str) -> DataFrame:
    from voltframe.operators.stats import box_fliers
    return box_fliers(with_period(e, start, end).select("timestamp", "value", "period"), "value", keys=["period"])


def histogram_by_phase(e: DataFrame, start: str, end: str, bins: int = 30) -> DataFrame:
    p = e.withColumn("phase", phase_label("timestamp", start, end))
    return histogram(p, "value", bins=bins, keys=["phase"], density=True)


def phase_summary(e: DataFrame, start: str, end: str) -> DataFrame:
    p = e.where(F.col("value").isNotNull()).withColumn("phase", phase_label("timestamp", start, end))
    return p.groupBy("phase").agg(F.count(F.lit(1)).alias("n"), F.avg(present("value")).alias("mean"),
                                  present(F.stddev_samp(present("value"))).alias("std"))


def hourly_demand(d: DataFrame) -> DataFrame:
    """Hourly mean of the demand grid, empty hours dropped."""
    return resample_mean(d.select("timestamp", "demand_MW"), ts="timestamp", value_cols=["demand_MW"],
                         step_seconds=3600, fill_grid=False, drop_empty=True)


def demand_decomposition(d: DataFrame, period: int = 24) -> DataFrame:
    return seasonal_decompose(hourly_demand(d), ts="timestamp", value="demand_MW", period=period)


def peak_days(e: DataFrame, d: DataFrame, event_days: tuple[str, str]) -> DataFrame:
    return daily_peaks(e, d, event_days=event_days)


def peak_fit(e: DataFrame, d: DataFrame, event_days: tuple[str, str]) -> DataFrame:
    return linear_fit(peak_days(e, d, event_days), x="peak_demand", y="peak_moer")


def peak_trend_line(e: DataFrame, d: DataFrame, event_days: tuple[str, str], points: int = 100) -> DataFrame:
    return trend_line(peak_fit(e, d, event_days), points=points)


def daily_volatility(e: DataFrame, event_days: tuple[str, str]) -> DataFrame:
    r = with_day_index(daily(e, ts="timestamp", value="value", how="range", out="daily_range"))
    return r.withColumn("is_event", day_between("date", *event_days))


def daily_totals(e: DataFrame, event_days: tuple[str, str]) -> DataFrame:
    r = with_day_index(daily(e, ts="timestamp", value="value", how="sum", out="daily_total"))
    return r.withColumn("is_event", day_between("date", *event_days))


def cumulative_emissions(e: DataFrame) -> DataFrame:
    return cumulative(e.select("timestamp", "value"), ts="timestamp", value="value", out="cum_moer")


def qq_subsets(e: DataFrame, start: str, end: str) -> DataFrame:
    """All non-missing values, and those inside the event range, as two keyed subsets."""
    allp = e.select(F.lit("All Periods").alias("subset"), "value")
    during = e.where(in_range("timestamp", start, end)).select(F.lit("Heat Wave").alias("subset"), "value")
    return allp.unionByName(during)


def qq_dataset(e: DataFrame, start: str, end: str) -> DataFrame:
    return qq_points(qq_subsets(e, start, end), "value", keys=["subset"])


def qq_fits(e: DataFrame, start: str, end: str) -> DataFrame:
    return qq_fit(qq_dataset(e, start, end), keys=["subset"])


def dow_hour_matrix(e: DataFrame, value: str = "value") -> DataFrame:
    """A10: mean value per weekday (rows, Mon..Sun) and hour (columns h0..h23)."""
    wide = e.groupBy("day_of_week").pivot("hour", list(range(24))).agg(F.avg(present(value)))
    label = F.element_at(F.array(*[F.lit(x) for x in DAY_LABELS]), F.col("day_of_week") + 1)
    return wide.select("day_of_week", label.alias("day_label"),
                       *[F.col(str(h)).alias(f"h{h}") for h in range(24)])


def correlation(merged: DataFrame) -> DataFrame:
    return corr_matrix(merged, CORR_COLUMNS, CORR_LABELS)


def pair_data(merged: DataFrame, start: str, end: str) -> DataFrame:
    p = merged.select("timestamp", *PAIR_COLUMNS).na.drop(how="any")
    return p.withColumn("period", period_label("timestamp", start, end)).drop("timestamp")


def pair_kde(merged: DataFrame, start: str, end: str) -> DataFrame:
    return kde_curves(pair_data(merged, start, end), PAIR_COLUMNS, "period")


def pair_histograms(merged: DataFrame, start: str, end: str, bins: int = 20) -> DataFrame:
    return pair_bins(pair_data(merged, start, end), PAIR_COLUMNS, "period", bins=bins)


def chart_datasets(e: DataFrame, d: DataFrame, start: str, end: str,
                   event_days: tuple[str, str], merged: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every chart's data as lazy DataFrames (nothing runs until a sink or action).

    ``merged`` defaults to ``pipelines.analysis_base(e, d)``; pass a written copy
    to avoid recomputing it for each of the three datasets that use it.
    """
    from voltframe.operators.stats import distribution_summary, histogram
    from voltframe.plans.pipelines import analysis_base
    if merged is None:
        merged = analysis_base(e, d)
    d_hourly = d.where(F.col("demand_MW").isNotNull()).select("timestamp", "demand_MW")
    return {
        "01_emissions": e.select("timestamp", "value"),
        "01_demand": d_hourly,
        "01_event_slice": event_slice(e, start, end).select("timestamp", "value"),
        "02_histogram": histogram(e, "value", bins=40),
        "02_summary": distribution_summary(e, "value"),
        "02_box": box_by_period(e, start, end),
        "02_box_fliers": box_fliers_by_period(e, start, end),
        "03_correlation": correlation(merged),
        "04_decomposition": demand_decomposition(d),
        "05_peaks": peak_days(e, d, event_days),
        "05_fit": peak_fit(e, d, event_days),
        "05_trend_line": peak_trend_line(e, d, event_days),
        "06_phase_histograms": histogram_by_phase(e, start, end),
        "06_daily_range": daily_volatility(e, event_days),
        "07_qq_points": qq_dataset(e, start, end),
        "07_qq_fit": qq_fits(e, start, end),
        "08_dow_hour": dow_hour_matrix(e),
        "09_cumulative": cumulative_emissions(e),
        "09_daily_total": daily_totals(e, event_days),
        "10_pair_data": pair_data(merged, start, end),
        "10_pair_bins": pair_histograms(merged, start, end),
        "10_kde": pair_kde(merged, start, end),
    }
