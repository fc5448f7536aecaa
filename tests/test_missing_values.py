"""NaN and infinities in every statistic against pandas; input columns named like internal ones."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.helpers import ts
from voltframe.operators import (apply_scaling, asof_nearest, attach_events, box_stats, cap_outliers, cumulative, daily, dedupe_first,
                                 distribution_summary, handle_missing, histogram, impossible_to_null, kde_curves, linear_fit,
                                 normalize_features, pair_bins, quality_row, resample_mean, scaling_params, seasonal_decompose,
                                 series_features, time_gaps)
from voltframe.functions.columns import safe_corr
from voltframe.operators.stats import box_fliers

NAN, INF = float("nan"), float("inf")
CASES = {"nan": [*range(1, 10), NAN], "many": [3.0, NAN, None, 8.0, -2.0, NAN, 5.5, 100.0, None, 4.0],
         "inf": [*range(1, 10), INF], "both": [1.0, INF, 2.0, -INF, NAN, 3.0], "none": [NAN, NAN, None], "one": [NAN, 7.0]}


def frame(spark, values, **more):
    rows = [(i, ts(15 * i), "k", None if v is None else float(v)) for i, v in enumerate(values)]
    s = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("timestamp", T.TimestampNTZType()), T.StructField("region", T.StringType()), T.StructField("value", T.DoubleType())])
    return spark.createDataFrame(rows, s).withColumns({k: F.lit(v) for k, v in more.items()})


def like(a, b):
    """Equal, a missing value of either side in whatever form."""
    gone = lambda x: x is None or (isinstance(x, float) and np.isnan(x))
    return (gone(a) and gone(b)) or (not gone(a) and not gone(b) and (a == b or abs(a - b) <= 1e-9 * max(1, abs(b))))


def values(df, col="value"):
    return [r[col] for r in df.orderBy("row_id").select("row_id", col).collect()]


def quantile(s, p):
    """pandas' rule, but a rank that is hit exactly is its value (pandas then gives NaN beside an infinity)."""
    v = np.sort(s.dropna().to_numpy())
    if not len(v):
        return np.nan
    at = (len(v) - 1) * p
    return v[int(at)] if at == int(at) else v[int(at)] + (v[int(at) + 1] - v[int(at)]) * (at - int(at))


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("method", ["zscore", "iqr"])
def test_cap(spark, name, method):
    s = pd.Series(CASES[name], dtype=float)
    with np.errstate(invalid="ignore"):
        if method == "zscore":
            lo, hi = s.mean() - 2 * s.std(), s.mean() + 2 * s.std()
        else:
            q1, q3 = quantile(s, 0.25), quantile(s, 0.75)
            lo, hi = q1 - 2 * (q3 - q1), q3 + 2 * (q3 - q1)
    out = (s < lo) | (s > hi)
    want = s.clip(lower=None if np.isnan(lo) else lo, upper=None if np.isnan(hi) else hi)
    got = cap_outliers(frame(spark, CASES[name]), "value", method, 2.0)
    assert all(like(a, b) for a, b in zip(values(got), want)) and values(got, "value_is_outlier") == out.tolist()


@pytest.mark.parametrize("name", CASES)
def test_summary_daily_scaling_and_resample(spark, name):
    s, df = pd.Series(CASES[name], dtype=float), frame(spark, CASES[name])
    fin = lambda x: None if isinstance(x, float) and np.isnan(x) else x
    r = distribution_summary(df, "value").first()
    assert r.n == s.count() and all(like(a, b) for a, b in ((r["mean"], s.mean()), (r["std"], s.std()), (r["min"], s.min()), (r["max"], s.max())))
    q = quality_row(df, name="d", ts="timestamp", value="value").first()
    assert like(q["mean"], s.mean()) and like(q["std"], s.std()) and like(q.missing_pct, s.isna().mean() * 100)
    for how, want in (("max", s.max()), ("min", s.min()), ("sum", s.sum()), ("range", s.max() - s.min())):
        assert like(daily(df, ts="timestamp", value="value", how=how, out="x").first().x, want)
    p = {(r.column, r.stat): r.value for m in ("zscore", "minmax") for r in scaling_params(df, ["value"], m).collect()}
    assert all(like(p["value", k], v) for k, v in (("mean", s.mean()), ("std", s.std()), ("min", s.min()), ("max", s.max())))
    with np.errstate(invalid="ignore"):
        z, m = (s - s.mean()) / s.std(), (s - s.min()) / (s.max() - s.min())
    for method, want in (("zscore", z), ("minmax", m)):
        got = values(normalize_features(df, ["value"], method)[0], "value_normalized")
        assert all(like(a, fin(b)) for a, b in zip(got, want))
    got = {r.timestamp: r.value for r in resample_mean(df, ts="timestamp", value_cols=["value"], step_seconds=3600).collect()}
    want = s.groupby(s.index // 4).mean()
    assert all(like(got[ts(60 * i)], v) for i, v in want.items())
    run = s.cumsum()
    assert all(like(a, b) for a, b in zip(values(cumulative(df, ts="timestamp", value="value", chunk_seconds=1800), "cum_value"), run))


@pytest.mark.parametrize("name", CASES)
def test_bounds_and_bins(spark, name):
    s, df = pd.Series(CASES[name], dtype=float), frame(spark, CASES[name])
    got = impossible_to_null(df, "value", 0, 6, flag="bad")
    bad = (s < 0) | (s > 6)
    assert values(got, "bad") == bad.tolist() and all(like(a, b) for a, b in zip(values(got), s.mask(bad)))
    real = s[np.isfinite(s)]
    bins = histogram(df, "value", bins=4).orderBy("bin").collect()
    assert [b["count"] for b in bins] == (np.histogram(real, 4)[0].tolist() if len(real) else [0] * 4 if bins else [])
    b = box_stats(df, "value").first()
    if s.count():
        assert b.n == s.count() and like(b["mean"], s.mean()) and like(b["median"], s.median())
        if np.isfinite(s[s.notna()]).all():
            q1, q3 = s.quantile([0.25, 0.75])
            out = (s < q1 - 1.5 * (q3 - q1)) | (s > q3 + 1.5 * (q3 - q1))
            assert b.n_fliers == out.sum() and box_fliers(df, "value").count() == out.sum()
    curve = kde_curves(df, ["value"], "region", gridsize=5).collect()
    assert len(curve) == (5 if real.std() > 0 else 0) and all(c.n == len(real) and np.isfinite(c.density) for c in curve)
    pairs = pair_bins(df.withColumn("w", F.col("row_id").cast("double")), ["value", "w"], "region", bins=3)
    assert sum(r["count"] for r in pairs.collect()) == len(real)


def test_fit_and_correlation(spark):
    df = frame(spark, CASES["many"]).withColumn("x", F.when(F.col("row_id") == 3, F.lit(NAN)).when(F.col("row_id") == 4, F.lit(INF)).otherwise(F.col("row_id").cast("double")))
    p = pd.DataFrame({"x": np.arange(10.0), "y": pd.Series(CASES["many"], dtype=float)}).drop([3, 4]).dropna()
    r = linear_fit(df, "x", "value").first()
    slope, intercept = np.polyfit(p.x, p.y, 1)
    assert r.n == len(p) and like(r.slope, slope) and like(r.intercept, intercept) and like(r.r, p.x.corr(p.y))
    assert df.where("row_id <> 4").agg(safe_corr("x", "value").alias("r")).first().r == pytest.approx(p.x.corr(p.y))


INTERNAL = {c: 77 for c in ("_rn", "_sub", "_ch", "_chunk", "_off", "_in", "_lo", "_hi", "_v", "_gpos", "_hc", "_pos", "_t", "_b", "_o", "_r", "_l", "_side", "_day", "_wlo",
                            "_key0", "_last", "_first", "whislo", "whishi", "_p_value_mean", "_p_value_std", "_run", "kept", "kept_0")}


def test_internal_names_may_be_input_columns(spark):
    plain = frame(spark, [1.0, None, 2.0, 50.0, 3.0, NAN, 4.0, 2.5, 3.5, 1.5])
    df = frame(spark, [1.0, None, 2.0, 50.0, 3.0, NAN, 4.0, 2.5, 3.5, 1.5], **INTERNAL)
    wins = spark.createDataFrame([("e", "k", ts(30), ts(90))], "event_id string, series_key string, window_lo timestamp_ntz, window_hi timestamp_ntz")
    right = plain.select("timestamp", F.col("value").alias("other"))
    params = scaling_params(plain, ["value"])
    ops = [lambda d: cap_outliers(d, "value", "iqr", 1.0), lambda d: cap_outliers(d, "value", "zscore", 1.0, keys=["region"]), lambda d: box_fliers(d, "value", ["region"]),
           lambda d: handle_missing(d, ts="timestamp", value="value", keys=["region"], order=["timestamp", "row_id"], chunk_seconds=3600),
           lambda d: time_gaps(d, ts="timestamp", keys=["region"]), lambda d: series_features(d, value="value", windows_hours=(1,), lags=(1,)),
           lambda d: apply_scaling(d, params, ["value"]), lambda d: dedupe_first(d, ["timestamp"], ["row_id"]), lambda d: dedupe_first(d, ["timestamp"], ["row_id", "value"]),
           lambda d: attach_events(d, wins, ts="timestamp", series_key="region"), lambda d: asof_nearest(d, right, on="timestamp", right_cols=["other"]),
           lambda d: cumulative(d, ts="timestamp", value="value", keys=["region"]), lambda d: seasonal_decompose(d, ts="timestamp", value="value", period=2)]
    for op in ops:
        want, got = op(plain), op(df)
        rows = lambda d: sorted(repr([r[c] for c in want.columns]) for r in d.collect())  # noqa: E731,B023
        assert rows(got) == rows(want)
        kept = [c for c in INTERNAL if c in got.columns]
        if "observed" not in got.columns and "cum_value" not in got.columns:
            assert set(kept) == set(INTERNAL) and all(r[c] == 77 for r in got.collect() for c in kept)
