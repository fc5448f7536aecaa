"""Quantile methods agree, NaN is missing, and clustered values spread over the buckets."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltframe.functions.columns import safe_corr
from voltframe.operators.ranks import ranked_values, quantiles
from voltframe.operators import ranks
from voltframe.operators.impute import handle_missing
from voltframe.sources import landing

PROBS = {"q1": 0.25, "median": 0.5, "q3": 0.75}
NAN, INF = math.nan, math.inf


@pytest.mark.parametrize("method", ["exact", "in_memory"])
@pytest.mark.parametrize("values", [[1, 2, 3, 4, NAN], [5, 5, 5, 5], [1, None, 2, NAN, None], [7], [1e-300, -1e300, 0.0, -0.0, 3], [1] * 50 + [2] * 3])
def test_nan_is_missing_everywhere(spark, method, values):
    df = spark.createDataFrame([(v if v is None else float(v),) for v in values], "x double")
    r = quantiles(df, "x", PROBS, method=method).first()
    there = [v for v in values if v is not None and not math.isnan(v)]
    assert r.n == len(there)
    assert np.allclose([r.q1, r.median, r.q3], np.quantile(there, [0.25, 0.5, 0.75]))


def test_infinities(spark):
    df = spark.createDataFrame([(v,) for v in (-INF, 1.0, 2.0, 3.0, INF)], "x double")
    assert [quantiles(df, "x", PROBS, method=m).first()[:3] for m in ("exact", "in_memory")] == [(1.0, 2.0, 3.0)] * 2


def test_all_missing(spark):
    df = spark.createDataFrame([("a", NAN), ("a", None)], "k string, x double")
    assert quantiles(df, "x", PROBS, keys=["k"], method="in_memory").first().n == 0


@pytest.mark.parametrize("low, high", [(59.95, 60.05), (1000, 1008), (-1e9, 1e9)])
def test_clustered_values_spread(spark, low, high):
    df = spark.range(100_000).select((F.rand(1) * (high - low) + low).alias("x"))
    split = df.agg(F.percentile_approx("x", [i / ranks.SPLITTERS for i in range(1, ranks.SPLITTERS)], 1000)).first()[0]
    sizes = [r["count"] for r in df.groupBy(ranks.value_bucket(F.col("x"), F.array(*[F.lit(s) for s in split]))).count().collect()]
    assert len(sizes) > 1000 and max(sizes) < 2500
    assert ranked_values(df, "x").agg(F.max(F.col("_below") + F.col("_cnt"))).first()[0] == 100_000


def test_correlation_ignores_half_empty_pairs(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 3.0), (100.0, None), (None, 5.0)], "x double, y double")
    assert abs(df.agg(safe_corr("x", "y")).first()[0] - 1) < 1e-12


def test_bad_bodies_are_counted(spark):
    good = '{"data": [{"point_time": "2024-01-01T00:00:00Z", "value": 1.5}], "region": "r"}'
    df = spark.createDataFrame([(1, good), (2, '{"error": "x"}'), (3, "{oops"), (4, None), (5, '{"data": null}')], "id int, body string")
    assert {r.id: r.reason for r in landing.bad_responses(df, landing.EMISSIONS_RESPONSE).collect()} == {2: "no data", 3: "malformed", 4: "empty", 5: "no data"}
    assert [r.id for r in landing.parse_emissions_responses(df).collect()] == [1]


def test_strict_demand_raises(spark):
    df = spark.createDataFrame([("never", "a", "1")], "period string, respondent string, value string")
    assert landing.process_demand(df).first().timestamp is None
    with pytest.raises(Exception):
        landing.process_demand(df, strict=True).collect()


def test_rows_are_shuffled_once_after_the_input(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        df = spark.range(5000).select(F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("t"), (F.col("id") % 3).cast("string").alias("k"), F.rand(1).alias("v"))
        out = handle_missing(df, ts="t", value="v", keys=["k"], hot_rows=None)
        plan = out._jdf.queryExecution().executedPlan().toString()
        # the rows, the chunk summary by key, and the summary again by chunk: the join adds no shuffle of the rows
        assert plan.count("Exchange hashpartitioning(_key0") <= 4 and "coalesce(_ch" not in plan.split("Exchange", 1)[1][:200]
        assert not any("isnull(k" in line for line in plan.splitlines() if "Exchange" in line)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[0])
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", before[1])


def test_double_columns_hold_values(spark):
    """Every double column of every core query has a value at sf0.01, but for those that need a full
    window of a day or a week, which rolling_hourly covers there."""
    import __spark_entry__ as ent
    from tests.conftest import SF01
    sparse = ("_rolling_", "value_lag")
    for name in ("rolling_hourly", "feature_corr_by_region", "pair_bins_by_region", "kde_by_region", "quartiles", "outliers_iqr"):
        df = ent.queries()[name](spark, SF01)
        doubles = [c for c, t in df.dtypes if t == "double" and (name == "rolling_hourly" or not any(s in c for s in sparse))]
        assert doubles or name == "pair_bins_by_region"
        r = df.agg(F.count("*"), *[F.count(c).alias(c) for c in doubles]).first()
        assert all(r[c] > 0 for c in doubles), (name, r)
