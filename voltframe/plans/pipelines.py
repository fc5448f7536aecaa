"""The collection, cleaning and analysis-base pipelines as lazy plans.

Step order matters: impossible values are nulled *after* imputation (so they
are never imputed) and slots created by resampling are never filled.

``keys=()`` reproduces the single-series behaviour (every region imputed and
averaged together); ``keys=("region",)`` keeps series apart. Either way no
window holds a whole series: see ``operators.sequence``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from voltframe.functions.calendar import add_calendar_features
from voltframe.operators.asof import asof_nearest
from voltframe.operators.dedupe import dedupe_first
from voltframe.operators.event_windows import attach_events, event_windows, map_regions, with_default_ids
from voltframe.operators.features import series_features
from voltframe.operators.impute import handle_missing
from voltframe.operators.outliers import cap_outliers, impossible_to_null
from voltframe.operators.report import cleaning_metrics, observed_metrics
from voltframe.operators.resample import resample_mean
from voltframe.operators.sequence import auto_chunk_seconds
from voltframe.session import cut_lineage


@dataclass
class Cleaned:
    raw: DataFrame
    deduped: DataFrame
    imputed: DataFrame
    corrected: DataFrame  # impossible values nulled; carries the ``_impossible`` flag
    capped: DataFrame
    clean: DataFrame      # resampled grid with calendar, rolling and lag features
    value: str
    seen: dict | None = None  # counters observed while the corrected rows were written

    def metrics(self, name: str = "all") -> DataFrame:
        """Cleaning counters. With ``checkpoint`` all but the caps were counted in flight as the
        corrected rows were written, and the caps are counted on the written rows; else the raw count
        and one aggregate over the capped rows (imputation, nulling and capping keep one row per
        de-duplicated record and the earlier flags)."""
        v = self.value
        if self.seen is not None:
            return observed_metrics(self.seen, self.capped, f"{v}_is_outlier", name)
        return cleaning_metrics(raw=self.raw, deduped=self.capped,
                                imputed_flag=(self.capped, f"{v}_is_interpolated"),
                                impossible_flag=(self.capped, "_impossible"),
                                outlier_flag=(self.capped, f"{v}_is_outlier"), name=name)


def clean_series(raw: DataFrame, *, value: str, dedupe_keys: Sequence[str], ts: str = "timestamp",
                 keys: Sequence[str] = (), order: Sequence[str] = ("row_id",),
                 min_val: float | None = None, max_val: float | None = None,
                 method: str = "iqr", threshold: float = 3.0, quantile_method: str = "exact",
                 step_seconds: int = 900, windows_hours: Sequence[int] = (24, 168),
                 lags: Sequence[int] = (4, 24, 96), chunk_seconds: int | None = None,
                 checkpoint: bool = True) -> Cleaned:
    """A1 -> W4 -> P22 -> A4 -> A5 -> P18 -> W5 -> W6 for one series table.

    With ``checkpoint`` the corrected rows are written once (a Parquet table in the
    session's checkpoint folder, see ``session.cut_lineage``) before the steps that read them several
    times: the outlier bounds and their application, the grid span and the grid
    means. Without it each of those branches would recompute dedupe + imputation.
    ``chunk_seconds=None`` sizes the imputation's time chunks from the data.
    """
    keys = list(keys)
    order = list(order)
    dd = dedupe_first(raw, subset=dedupe_keys, order=order, copies="_copies")
    if chunk_seconds is None:
        chunk_seconds = auto_chunk_seconds(raw, ts, keys)
    imp = handle_missing(dd, ts=ts, value=value, keys=keys, order=[ts, *order],
                         chunk_seconds=chunk_seconds)
    cor = impossible_to_null(imp, value, min_val, max_val, flag="_impossible")
    seen = None
    if checkpoint:
        watch = Observation()
        cor = cut_lineage(cor.observe(watch, F.coalesce(F.sum("_copies"), F.lit(0)).alias("raw"), F.count(F.lit(1)).alias("kept"),
                                      F.count_if(F.col(f"{value}_is_interpolated")).alias("imputed"), F.count_if("_impossible").alias("impossible")))
        seen = watch.get
    dd, imp, cor = (d.drop("_copies") for d in (dd, imp, cor))
    cap = cap_outliers(cor, value, method=method, threshold=threshold, keys=keys,
                       quantile_method=quantile_method)
    value_cols = [value, f"{value}_ffill", f"{value}_is_interpolated", f"{value}_original",
                  f"{value}_is_outlier"]
    grid = resample_mean(cap, ts=ts, value_cols=value_cols, keys=keys, step_seconds=step_seconds)
    feats = add_calendar_features(grid, ts)
    rows_per_hour = 3600 // step_seconds
    clean = series_features(feats, value=value, ts=ts, keys=keys, windows_hours=windows_hours,
                            lags=lags, rows_per_hour=rows_per_hour, step_seconds=step_seconds)
    return Cleaned(raw, dd, imp, cor, cap, clean, value, seen)


def emissions_pipeline(emissions_raw: DataFrame, keys: Sequence[str] = (), **kw) -> Cleaned:
    """Dedupe on (timestamp, region), bounds [0, 1500], IQR cap with k = 3.0."""
    return clean_series(emissions_raw, value="value", dedupe_keys=["timestamp", "region"], keys=keys,
                        min_val=0, max_val=1500, method="iqr", threshold=3.0, **kw)


def demand_pipeline(demand_raw: DataFrame, keys: Sequence[str] = (), **kw) -> Cleaned:
    """Dedupe on (timestamp, balancing_authority), lower bound 0, IQR cap with k = 3.5."""
    return clean_series(demand_raw, value="demand_MW", dedupe_keys=["timestamp", "balancing_authority"],
                        keys=keys, min_val=0, max_val=None, method="iqr", threshold=3.5, **kw)


ANALYSIS_COLUMNS = ("timestamp", "value", "hour", "day_of_week", "is_weekend",
                    "value_rolling_mean_24h", "value_rolling_std_24h")


def analysis_base(e: DataFrame, d: DataFrame, tolerance_seconds: float = 1800.0) -> DataFrame:
    """Hourly demand readings (missing dropped) attached to each emissions slot by
    nearest time within the tolerance; rows missing either measure are dropped."""
    d_hourly = d.where(F.col("demand_MW").isNotNull()).select("timestamp", "demand_MW")
    m = asof_nearest(e.select(*ANALYSIS_COLUMNS), d_hourly, on="timestamp", right_cols=["demand_MW"],
                     tolerance_seconds=tolerance_seconds)
    return m.na.drop(how="any", subset=["value", "demand_MW"])


def event_collection(catalog: DataFrame, emissions: DataFrame, demand: DataFrame | None, *,
                     region: str, ba_map: Mapping[str, str], buffer_days: int = 7) -> DataFrame:
    """C4: catalog -> default ids -> region filter -> +/- buffer windows -> interval join
    of both series -> one table (union by name; absent columns are NULL)."""
    cat = with_default_ids(catalog).where(F.col("region") == F.lit(region))
    win = event_windows(cat, buffer_days=buffer_days)
    em = attach_events(emissions, map_regions(win, None), ts="timestamp", series_key="region")
    out = em.withColumn("series", F.lit("emissions"))
    if demand is not None:
        dm = attach_events(demand, map_regions(win, ba_map), ts="timestamp",
                           series_key="balancing_authority", whole_days=True)
        out = out.unionByName(dm.withColumn("series", F.lit("demand")), allowMissingColumns=True)
    return out


@dataclass
class CleaningRun:
    emissions: Cleaned
    demand: Cleaned | None
    metrics: DataFrame   # one row per cleaned dataset
    report: DataFrame    # data-quality report, one row per cleaned dataset


def run_cleaning(emissions_raw: DataFrame, demand_raw: DataFrame | None = None, **kw) -> CleaningRun:
    """The cleaning stage end to end; demand is optional (S5): when absent, every
    demand step and its report row are skipped."""
    from voltframe.operators.report import quality_report
    em = emissions_pipeline(emissions_raw, **kw)
    dm = demand_pipeline(demand_raw, **kw) if demand_raw is not None else None
    metrics = em.metrics("emissions")
    if dm is not None:
        metrics = metrics.unionByName(dm.metrics("demand"))
    report = quality_report({"emissions": (em.clean, "timestamp", "value"),
                             "demand": (dm.clean, "timestamp", "demand_MW") if dm is not None else (None, "", "")})
    return CleaningRun(em, dm, metrics, report)


def save_cleaning_outputs(run: CleaningRun, base: str, fmt: str = "parquet") -> dict[str, bool]:
    """Overwrite the cleaned tables (demand only when present and non-empty)
    and write the quality report as JSON."""
    from voltframe.operators.report import write_report_json
    from voltframe.sources.files import write_if_not_empty, write_table
    base = base.rstrip("/")
    written = {"emissions_clean": True}
    write_table(run.emissions.clean, f"{base}/emissions_clean", fmt=fmt)
    written["demand_clean"] = (run.demand is not None
                               and write_if_not_empty(run.demand.clean, f"{base}/demand_clean", fmt=fmt))
    write_report_json(run.report, f"{base}/data_quality_report")
    written["data_quality_report"] = True
    return written
