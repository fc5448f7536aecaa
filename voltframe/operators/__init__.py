"""Operators: ``DataFrame -> DataFrame`` functions without UDFs; some size their plan by a small
job when called (README, "Jobs at plan-build time")."""

from voltframe.operators.asof import asof_nearest  # noqa: F401
from voltframe.operators.cluster import kmeans, silhouette  # noqa: F401
from voltframe.operators.daily import (  # noqa: F401
    cumulative, daily, daily_peaks, day_between, in_range, period_label, phase_label, with_day_index)
from voltframe.operators.decompose import seasonal_decompose  # noqa: F401
from voltframe.operators.dedupe import dedupe_first  # noqa: F401
from voltframe.operators.event_windows import (  # noqa: F401
    attach_events, broadcast_if_small, event_windows, map_regions, with_default_ids)
from voltframe.operators.features import (  # noqa: F401
    lag_features, rolling_features, series_features, temporal_features)
from voltframe.operators.impute import handle_missing, time_gaps  # noqa: F401
from voltframe.operators.outliers import cap_outliers, impossible_to_null, outlier_bounds  # noqa: F401
from voltframe.operators.qq import qq_fit, qq_points  # noqa: F401
from voltframe.operators.ranks import quantiles, ranked_values  # noqa: F401
from voltframe.operators.report import cleaning_metrics, quality_report, quality_row  # noqa: F401
from voltframe.operators.resample import resample_mean  # noqa: F401
from voltframe.operators.runs import duration_summary, threshold_runs  # noqa: F401
from voltframe.operators.scaling import apply_scaling, normalize_features, scaling_params  # noqa: F401
from voltframe.operators.stats import (  # noqa: F401
    box_stats, corr_matrix, distribution_summary, histogram, kde_curves, linear_fit, pair_bins, trend_line)
