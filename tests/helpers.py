from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import types as T

T0 = datetime(2024, 1, 1)


def ts(minutes):
    return T0 + timedelta(minutes=minutes)


def series_df(spark, values, step_minutes=15, key=None, start=0):
    rows = [(i, ts(start + i * step_minutes), key or "k", None if v is None else float(v))
            for i, v in enumerate(values)]
    schema = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("timestamp", T.TimestampNTZType()),
                           T.StructField("region", T.StringType()), T.StructField("value", T.DoubleType())])
    return spark.createDataFrame(rows, schema)


def col_list(df, col, order="row_id"):
    return [r[col] for r in df.orderBy(order).select(col).collect()]


def same(a, b, tol=1e-9):
    assert len(a) == len(b), (a, b)
    for x, y in zip(a, b):
        if x is None or (isinstance(x, float) and pd.isna(x)):
            assert y is None or (isinstance(y, float) and pd.isna(y)), (a, b)
        else:
            assert y is not None and not (isinstance(y, float) and pd.isna(y)), (a, b)
            assert abs(x - y) <= tol * max(1.0, abs(y)), (x, y, a, b)
