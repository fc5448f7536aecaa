"""Definition tests against numpy renderings (the statistics libraries are not installed)."""

import math
from datetime import timedelta
from statistics import NormalDist

import numpy as np
import pandas as pd
import pytest

from tests.helpers import T0, same
from voltframe.functions import inv_norm_cdf
from voltframe.operators import box_stats, histogram, kde_curves, qq_fit, qq_points, seasonal_decompose


def test_inverse_normal_accuracy(spark):
    ps = [1e-6, 0.001, 0.02425, 0.03, 0.2, 0.5, 0.77, 0.97575, 0.999, 1 - 1e-6]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    got = [r[0] for r in df.select(inv_norm_cdf("p")).collect()]
    for p, g in zip(ps, got):
        e = NormalDist().inv_cdf(p)
        assert abs(g - e) <= 2e-9 * max(1.0, abs(e))


def test_qq_points_and_fit(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(50, 10, size=101), 1)  # ties
    df = spark.createDataFrame([(float(v),) for v in x], "value double")
    pts = qq_points(df, "value", block=7).toPandas().sort_values("i")
    n = len(x)
    m = np.array([(i - 0.3175) / (n + 0.365) for i in range(1, n + 1)])
    m[-1] = 0.5 ** (1 / n)
    m[0] = 1 - m[-1]
    osm = np.array([NormalDist().inv_cdf(v) for v in m])
    assert list(pts.i) == list(range(1, n + 1))
    same(list(pts.osr), list(np.sort(x)))
    same(list(pts.osm), list(osm), tol=3e-9)
    fit = qq_fit(qq_points(df, "value")).collect()[0]
    slope, intercept = np.polyfit(osm, np.sort(x), 1)
    assert abs(fit.slope - slope) < 1e-6 and abs(fit.intercept - intercept) < 1e-5
    assert abs(fit.r - np.corrcoef(osm, np.sort(x))[0, 1]) < 1e-9


def _decompose_numpy(x, period):
    n = len(x)
    filt = np.repeat(1.0 / period, period)
    if period % 2 == 0:
        filt = np.array([0.5] + [1] * (period - 1) + [0.5]) / period
    half = len(filt) // 2
    trend = np.full(n, np.nan)
    for i in range(half, n - half):
        trend[i] = np.dot(filt, x[i - half:i + half + 1])
    det = x - trend
    pm = np.array([np.nanmean(det[i::period]) for i in range(period)])
    pm -= pm.mean()
    seasonal = np.tile(pm, n // period + 1)[:n]
    return trend, seasonal, x - trend - seasonal


@pytest.mark.parametrize("period", [24, 7])
def test_seasonal_decompose_definition(spark, period):
    rng = np.random.default_rng(5)
    n = 24 * 9
    x = 100 + 10 * np.sin(np.arange(n) * 2 * np.pi / 24) + rng.normal(size=n)
    hours = np.sort(rng.choice(np.arange(n + 40), size=n, replace=False))  # gaps in time
    df = spark.createDataFrame([(T0 + timedelta(hours=int(h)), float(v)) for h, v in zip(hours, x)],
                               "timestamp timestamp_ntz, v double")
    out = seasonal_decompose(df, ts="timestamp", value="v", period=period, chunk_seconds=3600 * 20,
                             chunk_rows=30).toPandas().sort_values("timestamp")
    t, s, r = _decompose_numpy(x, period)
    assert list(out.pos) == list(range(n))
    same(list(out.trend), list(t), tol=1e-9)
    same(list(out.seasonal), list(s), tol=1e-9)
    same(list(out.resid), list(r), tol=1e-9)


def test_box_stats_whiskers(spark):
    x = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 100.0]
    df = spark.createDataFrame([(v, "g") for v in x], "value double, k string")
    b = box_stats(df, "value", keys=["k"]).collect()[0]
    q1, med, q3 = np.percentile(x, [25, 50, 75])
    assert (b.q1, b.median, b.q3) == (q1, med, q3)
    hi = q3 + 1.5 * (q3 - q1)
    assert b.whishi == max(v for v in x if v <= hi) and b.whislo == 1.0 and b.n_fliers == 1


def test_density_histogram_matches_numpy(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=500)
    df = spark.createDataFrame([(float(v), "a") for v in x], "value double, g string")
    h = histogram(df, "value", bins=30, keys=["g"], density=True).toPandas().sort_values("bin")
    dens, edges = np.histogram(x, bins=30, density=True)
    same(list(h.density), list(dens), tol=1e-9)
    same(list(h.bin_lo), list(edges[:-1]), tol=1e-12)


def test_kde_matches_definition(spark):
    rng = np.random.default_rng(7)
    a, b = rng.normal(0, 1, 80), rng.normal(3, 2, 40)
    pdf = pd.DataFrame({"x": np.concatenate([a, b]), "grp": ["A"] * 80 + ["B"] * 40})
    out = kde_curves(spark.createDataFrame(pdf), ["x"], "grp", gridsize=50).toPandas()
    for g, data in (("A", a), ("B", b)):
        bw = data.std(ddof=1) * len(data) ** -0.2
        grid = np.linspace(data.min() - 3 * bw, data.max() + 3 * bw, 50)
        dens = np.exp(-0.5 * ((grid[:, None] - data[None, :]) / bw) ** 2).sum(1) / (len(data) * bw * math.sqrt(2 * math.pi))
        o = out[out.grp == g].sort_values("i")
        same(list(o.x), list(grid), tol=1e-12)
        same(list(o.density), list(dens), tol=1e-9)
        same(list(o.density_common), list(dens * len(data) / 120), tol=1e-9)


def test_kde_skips_singular_groups(spark):
    df = spark.createDataFrame([(2.0, "a"), (2.0, "a"), (1.0, "b"), (3.0, "b"), (7.0, "c")], "x double, g string")
    out = kde_curves(df, ["x"], "g", gridsize=5).toPandas()
    assert set(out.g) == {"b"}
    assert (out.n == 2).all()
    same(list(out.density_common), list(out.density * 2 / 5))


def test_kde_meets_near_grid_points_only_and_keeps_the_whole_grid(spark):
    rng = np.random.default_rng(8)
    data = np.concatenate([rng.normal(0, 1, 3000), [1e4]])   # one far value: most of the grid is far from all
    out = kde_curves(spark.createDataFrame(pd.DataFrame({"x": data, "g": "a"})), ["x"], "g").toPandas().sort_values("i")
    bw = data.std(ddof=1) * len(data) ** -0.2
    grid = np.linspace(data.min() - 3 * bw, data.max() + 3 * bw, 200)
    dens = np.exp(-0.5 * ((grid[:, None] - data[None, :]) / bw) ** 2).sum(1) / (len(data) * bw * math.sqrt(2 * math.pi))
    assert list(out.i) == list(range(200)) and np.abs(out.density.to_numpy() - dens).max() < 2.0 ** -50
    assert (out.density == 0).any()
    normal = rng.normal(0, 1, 100_000)
    bw = normal.std(ddof=1) * len(normal) ** -0.2
    assert 18 * bw / ((normal.max() - normal.min() + 6 * bw) / 199) < 50   # grid points a value meets
