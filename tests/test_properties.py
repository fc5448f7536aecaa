"""Property tests: chunked imputation and halo windows equal pandas on random series."""

from datetime import timedelta

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.helpers import T0, same
from voltframe.operators import handle_missing, series_features

values = st.lists(st.one_of(st.none(), st.floats(-1e3, 1e3, allow_nan=False).map(lambda x: round(x, 3))),
                  min_size=1, max_size=60)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(vals=values, gaps=st.lists(st.integers(1, 3), min_size=60, max_size=60),
       chunk=st.sampled_from([900, 1800, 3600, 86_400]), ffill=st.integers(1, 3), limit=st.integers(1, 9),
       hot=st.sampled_from([None, 1, 2, 5]))
def test_impute_equals_pandas(spark, vals, gaps, chunk, ffill, limit, hot):
    minutes, t = [], 0
    for g in gaps[:len(vals)]:
        t += 15 * g
        minutes.append(t)
    rows = [(i, T0 + timedelta(minutes=m), v) for i, (m, v) in enumerate(zip(minutes, vals))]
    df = spark.createDataFrame(rows, "row_id long, timestamp timestamp_ntz, value double")
    out = handle_missing(df, ts="timestamp", value="value", order=["timestamp", "row_id"], ffill_limit=ffill,
                         interp_limit=limit, chunk_seconds=chunk, hot_rows=hot).toPandas().sort_values("row_id")
    s = pd.Series([float("nan") if v is None else v for v in vals], dtype="float64")
    same(list(out.value), list(s.interpolate(method="linear", limit=limit)), tol=1e-9)
    same(list(out.value_ffill), list(s.ffill(limit=ffill)), tol=1e-12)


@SETTINGS
@given(vals=values, n=st.integers(1, 12), lag=st.integers(-3, 5), block=st.integers(1, 20))
def test_halo_windows_equal_pandas(spark, vals, n, lag, block):
    rows = [(T0 + timedelta(minutes=15 * i), v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, value double")
    out = series_features(df, value="value", windows_hours=(n,), lags=(lag,), rows_per_hour=1,
                          chunk_rows=block).toPandas().sort_values("timestamp")
    s = pd.Series([float("nan") if v is None else v for v in vals], dtype="float64")
    r = s.rolling(window=n, center=True)
    same(list(out[f"value_rolling_mean_{n}h"]), list(r.mean()), tol=1e-9)
    same(list(out[f"value_lag_{lag}"]), list(s.shift(lag)))
