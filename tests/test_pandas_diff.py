"""Differential tests against pandas/numpy on seeded random series.

Small chunk sizes force the distributed forms (chunked positions, carries
across chunks, halo windows) so they are compared with a plain whole-series
computation.
"""

from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.helpers import T0, same
from voltframe.operators import (asof_nearest, corr_matrix, cumulative, dedupe_first, handle_missing,
                                 normalize_features, quantiles, resample_mean, series_features)


def random_series(seed, n=400, missing=0.3, dup=0.1):
    rng = np.random.default_rng(seed)
    minutes = np.sort(rng.integers(0, n * 3, size=n))
    vals = rng.normal(100, 20, size=n)
    vals[rng.random(n) < missing] = np.nan
    # long gaps
    vals[50:70] = np.nan
    return pd.DataFrame({"row_id": np.arange(n), "timestamp": [T0 + timedelta(minutes=int(m)) for m in minutes],
                         "region": rng.choice(["a", "b"], size=n), "value": vals})


def to_spark(spark, pdf):
    pdf = pdf.astype({"value": "float64"})
    rows = [(int(r.row_id), r.timestamp.to_pydatetime(), r.region, None if pd.isna(r.value) else float(r.value))
            for r in pdf.itertuples()]
    return spark.createDataFrame(rows, "row_id long, timestamp timestamp_ntz, region string, value double")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_impute_matches_pandas(spark, seed):
    pdf = random_series(seed).drop_duplicates(subset=["timestamp"], keep="first")
    ref = pdf.sort_values(["timestamp", "row_id"]).reset_index(drop=True)
    exp_ffill = ref["value"].ffill(limit=2)
    exp_interp = ref["value"].interpolate(method="linear", limit=8)
    out = handle_missing(to_spark(spark, pdf), ts="timestamp", value="value", order=["timestamp", "row_id"],
                         chunk_seconds=3600).toPandas().sort_values(["timestamp", "row_id"]).reset_index(drop=True)
    same(list(out["value"]), list(exp_interp))
    same(list(out["value_ffill"]), list(exp_ffill))
    assert list(out["value_is_interpolated"]) == list(ref["value"].isna() & exp_interp.notna())


@pytest.mark.parametrize("seed", [4, 5])
def test_impute_keyed_matches_pandas_groupwise(spark, seed):
    pdf = random_series(seed).drop_duplicates(subset=["timestamp", "region"], keep="first")
    out = handle_missing(to_spark(spark, pdf), ts="timestamp", value="value", keys=["region"],
                         order=["timestamp", "row_id"], chunk_seconds=1800).toPandas()
    for reg, g in pdf.groupby("region"):
        g = g.sort_values(["timestamp", "row_id"]).reset_index(drop=True)
        o = out[out.region == reg].sort_values(["timestamp", "row_id"]).reset_index(drop=True)
        same(list(o["value"]), list(g["value"].interpolate(method="linear", limit=8)))


def test_dedupe_matches_pandas(spark):
    pdf = random_series(7)
    pdf["timestamp"] = pdf["timestamp"].dt.floor("15min")
    exp = pdf.drop_duplicates(subset=["timestamp", "region"], keep="first")
    got = dedupe_first(to_spark(spark, pdf), ["timestamp", "region"], ["row_id"]).toPandas()
    assert sorted(got.row_id) == sorted(exp.row_id)


def test_resample_matches_pandas(spark):
    pdf = random_series(8)
    exp = pdf.set_index("timestamp")[["value"]].resample("15min").mean().reset_index()
    got = resample_mean(to_spark(spark, pdf), ts="timestamp", value_cols=["value"]).toPandas() \
        .sort_values("timestamp").reset_index(drop=True)
    assert list(got.timestamp) == list(exp.timestamp)
    same(list(got.value), list(exp.value))


@pytest.mark.parametrize("chunk", [5, 64, 4096])
def test_rolling_and_lags_match_pandas(spark, chunk):
    rng = np.random.default_rng(11)
    vals = rng.normal(size=300)
    vals[rng.random(300) < 0.02] = np.nan
    pdf = pd.DataFrame({"timestamp": [T0 + timedelta(minutes=15 * i) for i in range(300)], "value": vals})
    sdf = spark.createDataFrame([(t.to_pydatetime(), None if np.isnan(v) else float(v)) for t, v in
                                 zip(pdf.timestamp, pdf.value)], "timestamp timestamp_ntz, value double")
    out = series_features(sdf, value="value", windows_hours=(6, 3), lags=(4, 24), chunk_rows=chunk) \
        .toPandas().sort_values("timestamp").reset_index(drop=True)
    for h in (6, 3):
        r = pdf["value"].rolling(window=h * 4, center=True)
        same(list(out[f"value_rolling_mean_{h}h"]), list(r.mean()))
        same(list(out[f"value_rolling_std_{h}h"]), list(r.std()), tol=1e-7)
    for k in (4, 24):
        same(list(out[f"value_lag_{k}"]), list(pdf["value"].shift(k)))


@pytest.mark.parametrize("chunk", [8, 4096])
@pytest.mark.parametrize("least", [None, 1, 3])
def test_rolling_odd_values_match_pandas(spark, chunk, least):
    """Constant stretches on a large level, gaps, NaN and an infinity (both missing)."""
    vals = np.r_[np.full(30, 1e6), np.full(12, np.nan), np.full(20, 1e6 + 0.1), np.arange(20.0), [np.inf], np.full(9, 0.1), [np.nan] * 3, np.full(15, 0.1)]
    sdf = spark.createDataFrame([(T0 + timedelta(minutes=15 * i), None if i % 2 and np.isnan(v) else float(v)) for i, v in enumerate(vals)],
                                "timestamp timestamp_ntz, value double")
    out = series_features(sdf, value="value", windows_hours=(2,), lags=(), chunk_rows=chunk, min_periods=least) \
        .toPandas().sort_values("timestamp").reset_index(drop=True)
    s = pd.Series(np.where(np.isinf(vals), np.nan, vals))
    windows = [s[max(0, i - 4):i + 4].dropna() for i in range(len(s))]
    need = 8 if least is None else least
    same(list(out.value_rolling_mean_2h), [w.mean() if len(w) >= need else np.nan for w in windows])
    same(list(out.value_rolling_std_2h), [w.std() if len(w) >= max(need, 2) else np.nan for w in windows])


def test_cumsum_matches_pandas(spark):
    pdf = random_series(9).drop_duplicates(subset=["timestamp"])
    exp = pdf.sort_values(["timestamp", "row_id"])["value"].cumsum()
    got = cumulative(to_spark(spark, pdf), ts="timestamp", value="value", out="c", order=["timestamp", "row_id"],
                     chunk_seconds=3600).toPandas().sort_values(["timestamp", "row_id"])
    same(list(got.c), list(exp), tol=1e-9)


@pytest.mark.parametrize("method", ["exact", "in_memory"])
def test_quantiles_match_pandas(spark, method):
    pdf = random_series(10)
    pdf.loc[::5, "value"] = 100.0  # heavy ties
    pdf.loc[::7, "value"] = -3.5   # negative values
    got = quantiles(to_spark(spark, pdf), "value", {"q1": 0.25, "med": 0.5, "q3": 0.75, "p9": 0.9},
                    keys=["region"], method=method).toPandas().set_index("region")
    for reg, g in pdf.groupby("region"):
        for name, p in {"q1": 0.25, "med": 0.5, "q3": 0.75, "p9": 0.9}.items():
            assert abs(got.loc[reg, name] - g["value"].quantile(p)) < 1e-9


def test_corr_and_scaling_match_pandas(spark):
    rng = np.random.default_rng(12)
    pdf = pd.DataFrame({"a": rng.normal(size=200), "b": rng.normal(size=200), "c": np.full(200, 3.0)})
    pdf["b"] = pdf["a"] * 0.5 + pdf["b"]
    sdf = spark.createDataFrame(pdf)
    cm = corr_matrix(sdf, ["a", "b", "c"]).toPandas()
    exp = pdf.corr()
    for r in cm.itertuples():
        e = exp.iloc[r.i, r.j]
        if np.isnan(e):
            assert r.r is None or np.isnan(r.r)
        else:
            assert abs(r.r - e) < 1e-12
    z, _ = normalize_features(sdf, ["a"], "zscore")
    same(sorted(z.toPandas()["a_normalized"]), sorted((pdf.a - pdf.a.mean()) / pdf.a.std()))
    m, _ = normalize_features(sdf, ["a"], "minmax")
    same(sorted(m.toPandas()["a_normalized"]), sorted((pdf.a - pdf.a.min()) / (pdf.a.max() - pdf.a.min())))


@pytest.mark.parametrize("seed", [13, 14, 15])
def test_asof_matches_pandas(spark, seed):
    rng = np.random.default_rng(seed)
    lm = np.sort(rng.integers(0, 3000, size=300))
    rm = np.sort(rng.choice(np.arange(0, 3000, 10), size=70))
    left = pd.DataFrame({"lid": np.arange(300), "timestamp": [T0 + timedelta(minutes=int(m)) for m in lm]})
    right = pd.DataFrame({"rid": np.arange(70), "timestamp": [T0 + timedelta(minutes=int(m)) for m in rm],
                          "v": rng.normal(size=70)})
    exp = pd.merge_asof(left, right, on="timestamp", direction="nearest", tolerance=pd.Timedelta("30min"))
    sl = spark.createDataFrame([(int(a), b.to_pydatetime()) for a, b in zip(left.lid, left.timestamp)],
                               "lid long, timestamp timestamp_ntz")
    sr = spark.createDataFrame([(int(a), b.to_pydatetime(), float(c)) for a, b, c in
                                zip(right.rid, right.timestamp, right.v)], "rid long, timestamp timestamp_ntz, v double")
    got = asof_nearest(sl, sr, on="timestamp", right_cols=["v", "rid"], tolerance_seconds=1800,
                       right_order=["rid"]).toPandas().sort_values("lid")
    same(list(got.v), list(exp.v))
    got_k = asof_nearest(sl.withColumn("k", F.lit(1)), sr.withColumn("k", F.lit(1)), on="timestamp",
                         right_cols=["v"], by=["k"], tolerance_seconds=1800, right_order=["rid"], chunk_seconds=3600, hot_rows=40)
    same(list(got_k.toPandas().sort_values("lid").v), list(exp.v))


@pytest.mark.parametrize("dense", ["left", "right", "instant"])
def test_asof_of_a_dense_stretch(spark, dense):
    """Both sides may be dense: parts stay small, the result is that of the uncut merge."""
    many = [(i, T0 + timedelta(seconds=0 if dense == "instant" else i % 97), i / 7) for i in range(3000)]
    few = [(i, T0 + timedelta(minutes=9 * i - 20), i / 3) for i in range(12)] + [(50, None, 1.0)]
    l, r = (few, many) if dense == "right" else (many, few)
    left = spark.createDataFrame(l, "lid long, timestamp timestamp_ntz, w double")
    right = spark.createDataFrame(r, "rid long, timestamp timestamp_ntz, v double")
    rows = [sorted(map(repr, asof_nearest(left, right, on="timestamp", right_cols=["v", "rid"], right_order=["rid"], hot_rows=h).collect())) for h in (None, 50)]
    assert rows[0] == rows[1] and len(rows[0]) == len(l)


def test_hot_minute_and_rows_without_a_time(spark):
    """scan_parts: no part far above its bound, and order-dependent operators give what they give uncut."""
    from pyspark.sql import Window
    from voltframe.functions.columns import epoch_micros, slot_index
    from voltframe.operators import cumulative, handle_missing, seasonal_decompose, time_gaps
    from voltframe.operators.sequence import dense_positions, scan_parts
    rows = [(i, T0 + timedelta(minutes=i % 900), float(i % 13)) for i in range(2000)]                              # an even day
    rows += [(10_000 + i, T0 + timedelta(hours=3, milliseconds=i), float(i % 7) if i % 5 else None) for i in range(4000)]   # a burst
    rows += [(20_000 + i, T0 + timedelta(hours=9), 1.0) for i in range(4000)]                                      # one instant
    df = spark.createDataFrame(rows, "row_id long, timestamp timestamp_ntz, value double")
    null = spark.range(100_000).selectExpr("id + 100000 as row_id", "cast(null as timestamp_ntz) as timestamp", "double(id % 3) as value")
    df = df.unionByName(null)
    d, _, part = scan_parts(df, keys=[], time=epoch_micros("timestamp"), chunk=slot_index("timestamp", 86_400), second=F.col("row_id"), hot_rows=1500)
    sizes = [r["count"] for r in d.groupBy(*part).count().collect()]
    assert sum(sizes) == 110_000 and max(sizes) <= 1500 and len(sizes) < 1000
    order = ["timestamp", "row_id"]
    for op in (lambda h: time_gaps(df, ts="timestamp", order=order, hot_rows=h), lambda h: cumulative(df, ts="timestamp", value="value", order=order, hot_rows=h),
               lambda h: handle_missing(df, ts="timestamp", value="value", order=order, hot_rows=h),
               lambda h: dense_positions(df, keys=[], order=order, chunk=slot_index("timestamp", 86_400), pos="p", hot_rows=h)):
        cut, uncut = op(1500), op(None)
        assert cut.exceptAll(uncut).count() == 0 and uncut.count() == cut.count() == 110_000
    want = df.withColumn("p", F.row_number().over(Window.orderBy(F.col("timestamp").asc_nulls_last(), "row_id")) - 1)
    assert op(1500).join(want.select("row_id", F.col("p").alias("q")), "row_id").where("p <> q").count() == 0
    once = df.where("row_id < 2000").dropDuplicates(["timestamp"])
    assert seasonal_decompose(once, ts="timestamp", value="value", hot_rows=100).exceptAll(seasonal_decompose(once, ts="timestamp", value="value", hot_rows=None)).count() == 0
