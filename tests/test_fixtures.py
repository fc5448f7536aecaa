"""Micro-fixtures with hand-computed expectations (one per semantic trap)."""

from datetime import datetime

import pytest

from tests.helpers import col_list, same, series_df, ts
from voltframe.functions import calendar_columns, lenient_double, parse_utc
from voltframe.operators import (asof_nearest, cumulative, daily, dedupe_first, handle_missing, histogram,
                                 impossible_to_null, normalize_features, quantiles, resample_mean,
                                 series_features)

_ = None


def test_linear_fill_limit_8(spark):
    vals = [_, _, 1, _, _, 4] + [_] * 12 + [17] + [_] * 10
    out = handle_missing(series_df(spark, vals), ts="timestamp", value="value", order=["timestamp", "row_id"])
    exp = [_, _, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, _, _, _, _, 17] + [17] * 8 + [_, _]
    same(col_list(out, "value"), exp)
    flags = col_list(out, "value_is_interpolated")
    assert flags == [v is None and e is not None for v, e in zip(vals, exp)]


def test_linear_fill_across_many_chunks(spark):
    vals = [_, _, 1, _, _, 4] + [_] * 12 + [17] + [_] * 10
    out = handle_missing(series_df(spark, vals), ts="timestamp", value="value", order=["timestamp", "row_id"],
                         chunk_seconds=1800)  # two rows per chunk: gaps cross chunks
    exp = [_, _, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, _, _, _, _, 17] + [17] * 8 + [_, _]
    same(col_list(out, "value"), exp)


def test_linear_fill_with_hot_chunks_split(spark):
    vals = [_, _, 1, _, _, 4] + [_] * 12 + [17] + [_] * 10
    out = handle_missing(series_df(spark, vals), ts="timestamp", value="value", order=["timestamp", "row_id"],
                         chunk_seconds=86_400, hot_rows=3)  # one day chunk, split into ~3-row parts
    exp = [_, _, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, _, _, _, _, 17] + [17] * 8 + [_, _]
    same(col_list(out, "value"), exp)
    same(col_list(out, "time_diff"), [_] + [900.0] * (len(vals) - 1))


def test_ffill_limit_2(spark):
    out = handle_missing(series_df(spark, [_, 1, _, _, _, _, 5, _]), ts="timestamp", value="value",
                         chunk_seconds=900)
    same(col_list(out, "value_ffill"), [_, 1, 1, 1, _, _, 5, 5])


def test_time_diff(spark):
    out = handle_missing(series_df(spark, [1, _, 3]), ts="timestamp", value="value", chunk_seconds=900)
    same(col_list(out, "time_diff"), [_, 900.0, 900.0])


def test_centered_rolling_mean_4(spark):
    d = series_df(spark, list(range(10)))
    out = series_features(d, value="value", windows_hours=(1,), lags=(), rows_per_hour=4, chunk_rows=3)
    same(col_list(out, "value_rolling_mean_1h"), [_, _, 1.5, 2.5, 3.5, 4.5, 5.5, 6.5, 7.5, _])
    vals = list(range(10))
    vals[5] = None
    out = series_features(series_df(spark, vals), value="value", windows_hours=(1,), lags=(), rows_per_hour=4,
                          chunk_rows=3)
    same(col_list(out, "value_rolling_mean_1h"), [_, _, 1.5, 2.5, _, _, _, _, 7.5, _])


def test_lags_and_leads(spark):
    out = series_features(series_df(spark, list(range(6))), value="value", windows_hours=(), lags=(2, -1),
                          chunk_rows=2)
    same(col_list(out, "value_lag_2"), [_, _, 0, 1, 2, 3])
    same(col_list(out, "value_lag_-1"), [1, 2, 3, 4, 5, _])


def test_15min_mean_grid(spark):
    schema = "timestamp timestamp_ntz, value double, flag boolean"
    df = spark.createDataFrame([(ts(7), 1.0, True), (ts(14), 3.0, False), (ts(60), 5.0, True)], schema)
    out = resample_mean(df, ts="timestamp", value_cols=["value", "flag"]).orderBy("timestamp").collect()
    assert [r.timestamp for r in out] == [ts(0), ts(15), ts(30), ts(45), ts(60)]
    same([r.value for r in out], [2.0, _, _, _, 5.0])
    same([r.flag for r in out], [0.5, _, _, _, 1.0])


def _asof(spark, left_minutes, right):
    left = spark.createDataFrame([(i, ts(m)) for i, m in enumerate(left_minutes)], "lid long, timestamp timestamp_ntz")
    r = spark.createDataFrame([(i, ts(m), float(v)) for i, (m, v) in enumerate(right)],
                              "rid long, timestamp timestamp_ntz, v double")
    out = asof_nearest(left, r, on="timestamp", right_cols=["v"], tolerance_seconds=1800, right_order=["rid"])
    return col_list(out, "v", order="lid")


def test_asof_nearest_rules(spark):
    got = _asof(spark, [0, 15, 30, 45, 151], [(0, 1), (60, 2), (60, 3), (120, 4)])
    assert got == [1.0, 1.0, 1.0, 2.0, None]


def test_asof_duplicate_backward_takes_last(spark):
    assert _asof(spark, [0, 10], [(0, 1), (0, 2), (60, 3)]) == [2.0, 2.0]


def test_quartiles(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 10]], "v double")
    q = quantiles(df, "v", {"q1": 0.25, "q3": 0.75}, method="exact").collect()[0]
    assert (q.q1, q.q3) == (2.0, 4.0)
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4]], "v double")
    for m in ("exact", "in_memory"):
        assert quantiles(df, "v", {"q1": 0.25}, method=m).collect()[0].q1 == 1.75


def test_histogram_4_bins(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 4]], "v double")
    h = histogram(df, "v", bins=4).orderBy("bin").collect()
    assert [r["count"] for r in h] == [1, 1, 1, 2]


def test_running_total(spark):
    out = cumulative(series_df(spark, [1, _, 2]), ts="timestamp", value="value", chunk_seconds=900)
    same(col_list(out, "cum_value"), [1, _, 3])


def test_sum_of_all_missing_day_is_zero(spark):
    out = daily(series_df(spark, [_, _]), ts="timestamp", value="value", how="sum", out="s").collect()
    assert out[0].s == 0.0
    out = daily(series_df(spark, [_, _]), ts="timestamp", value="value", how="max", out="m").collect()
    assert out[0].m is None


def test_dedupe_null_key_keep_first(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k long, o long")
    got = sorted(dedupe_first(df, ["k"], ["o"]).collect(), key=lambda r: r.o)
    assert [(r.k, r.o) for r in got] == [(None, 1), (1, 3)]


def test_zscore_of_constant_column(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    out, params = normalize_features(df, ["x"], "zscore")
    assert [r.x_normalized for r in out.collect()] == [None, None]
    with pytest.raises(ValueError):
        normalize_features(df, ["x"], "robust")


def test_numeric_coerce(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "s string")
    assert [r[0] for r in df.select(lenient_double("s")).collect()] == [1.0, None, None]


def test_hour_only_timestamp(spark):
    df = spark.createDataFrame([("2024-08-15T03",), ("2024-08-15T03:00:00Z",), ("2024-08-15T05:00:00+02:00",)], "s string")
    got = [r[0] for r in df.select(parse_utc("s")).collect()]
    assert got == [datetime(2024, 8, 15, 3)] * 3


def test_impossible_bounds(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (1500.0,), (1501.0,), (None,)], "value double")
    out = impossible_to_null(df, "value", 0, 1500, flag="bad").collect()
    assert [r.value for r in out] == [None, 0.0, 1500.0, None, None]
    assert [r.bad for r in out] == [True, False, False, True, False]


def test_season_and_calendar(spark):
    rows = [(datetime(2024, m, 1),) for m in (12, 3, 8, 11)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz").withColumns(calendar_columns("timestamp"))
    assert [r.season for r in df.collect()] == ["winter", "spring", "summer", "fall"]
    mon = spark.createDataFrame([(datetime(2024, 1, 1),), (datetime(2024, 1, 6),)], "timestamp timestamp_ntz")
    got = mon.withColumns(calendar_columns("timestamp")).collect()
    assert [(r.day_of_week, r.is_weekend) for r in got] == [(0, 0), (5, 1)]


def test_outlier_method_is_validated(spark):
    from voltframe.operators import cap_outliers
    with pytest.raises(ValueError):
        cap_outliers(series_df(spark, [1, 2]), "value", method="mad")


def test_null_series_key_is_its_own_group(spark):
    from datetime import timedelta
    rows = [(i, datetime(2024, 1, 1) + timedelta(minutes=15 * i), None if i % 2 else "a",
             None if i % 3 == 1 else float(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "row_id long, timestamp timestamp_ntz, region string, value double")
    out = handle_missing(df, ts="timestamp", value="value", keys=["region"], order=["timestamp", "row_id"],
                         chunk_seconds=1800).where("region is null").orderBy("row_id")
    same(col_list(out, "value"), [_, 3, 5, 7, 9, 11])
    q = {r.region: r.q1 for r in quantiles(df, "value", {"q1": 0.25}, keys=["region"], method="exact").collect()}
    assert q == {"a": 1.5, None: 4.5}
