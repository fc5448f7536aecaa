"""Events found in a series, clustering of signatures, paging rule, counters in flight."""

import random
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.helpers import T0, series_df, ts
from voltframe.operators.cluster import _spread, kmeans, nearest, scaled_points, seed, silhouette
from voltframe.operators.runs import duration_summary, threshold_runs
from voltframe.plans import pipelines as pl
from voltframe.sources.landing import follow_pages


# ------------------------------------------------------------------ R1

def brute_runs(rows, above, gap=None):
    out = []
    for key in {r[2] for r in rows}:
        run, before = None, None
        for i, t, _, v in sorted((r for r in rows if r[2] == key and r[1] is not None), key=lambda r: (r[1], r[0])):
            up = v is not None and v == v and v > above
            if up and run and not (gap is not None and (t - before).total_seconds() > gap):
                run["end"], run["n"], run["peak"] = t, run["n"] + 1, max(run["peak"], v)
            elif up:
                run = {"key": key, "start": t, "end": t, "n": 1, "peak": v}
                out.append(run)
            else:
                run = None
            before = t
    return sorted((str(r["key"]), r["start"], r["end"], r["n"], (r["end"] - r["start"]).total_seconds(), r["peak"]) for r in out)


def runs_of(df, **kw):
    got = threshold_runs(df, ts="timestamp", value="value", above=5, keys=["region"], order=["timestamp", "row_id"], **kw).collect()
    return sorted((str(r.region), r.start, r.end, r.n_rows, r.duration_seconds, r.peak) for r in got)


def test_a_run_across_three_chunks(spark):
    got = runs_of(series_df(spark, [1, 9, 9, 9, 9, 9, 9, 9, 9, 9, 9, 1, 9]), chunk_seconds=3600)
    assert [(r[3], r[4]) for r in got] == [(10, 9 * 900.0), (1, 0.0)]


@pytest.mark.parametrize("gap", [None, 2700])
@pytest.mark.parametrize("kw", [{"chunk_seconds": 900}, {"chunk_seconds": 3600}, {"chunk_seconds": 86_400, "hot_rows": 7}, {"hot_rows": None}])
def test_runs_against_brute_force(spark, kw, gap):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        v = rng.choice([9.0, 9.0, 7.0, 6.0, 1.0, 5.0, None, float("nan"), float("inf")]) if rng.random() < 0.5 else 8.0
        rows.append((i, None if i % 57 == 0 else T0 + timedelta(minutes=15 * (i // 2) + (60 if i > 200 else 0) + rng.choice([0, 0, 5])), rng.choice(["a", "b", None]), v))
    df = spark.createDataFrame(rows, series_df(spark, []).schema)
    assert runs_of(df, max_gap_seconds=gap, **kw) == brute_runs(rows, 5, gap)


def test_no_runs_and_durations(spark):
    assert runs_of(series_df(spark, [])) == [] == runs_of(series_df(spark, [1, 2, None]))
    runs = threshold_runs(series_df(spark, [9, 9, 1, 9, 1, 9, 9, 9]), ts="timestamp", value="value", above=5, keys=["region"])
    r = duration_summary(runs, ["region"]).first()
    assert (r.n, r.shortest, r.q1, r["median"], r.longest, r["mean"], r.n_rows) == (3, 0.0, 450.0, 900.0, 1800.0, 900.0, 6)


# ------------------------------------------------------------------ R6

@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(3)
    at = np.concatenate([rng.normal(c, 0.3, (60, 2)) for c in ((0, 0), (6, 0), (0, 6), (7, 7))])
    rows = [(i, float(x), float(y), i // 60) for i, (x, y) in enumerate(at)]
    return spark.createDataFrame(rows + [(900, None, 1.0, -1), (901, 1.0, float("nan"), -1)], "id long, x double, y double, blob int").repartition(4)


def test_seeds_find_the_blobs(blobs):
    out, centres = kmeans(blobs, ["x", "y"], 4)
    got = out.collect()
    assert len(got) == 242 and all((r.cluster is None) == (r.blob < 0) for r in got) and len(centres) == 4
    assert len({(r.blob, r.cluster) for r in got if r.blob >= 0}) == 4
    again, same = kmeans(blobs, ["x", "y"], 4)
    assert same == centres
    scores = silhouette(out).collect()
    assert len(scores) == 4 and all(r.n == 60 and r.silhouette > 0.9 for r in scores)


def test_lloyd_and_silhouette_against_numpy(blobs):
    seeds = [(-1.0, -1.0), (0.0, 0.0), (1.0, 1.0), (50.0, 50.0)]
    out, centres = kmeans(blobs, ["x", "y"], 4, seeds=seeds, steps=5)
    p = np.array([r._x for r in out.where("cluster IS NOT NULL").orderBy("id").collect()])
    c = np.array(seeds)
    for _ in range(5):
        near = ((p[:, None] - c[None]) ** 2).sum(2).argmin(1)
        c = np.array([np.floor(p[near == k].mean(0) * 2**20 + 0.5) / 2**20 if (near == k).any() else c[k] for k in range(4)])
    assert np.allclose(c, centres, atol=1e-6) and centres[3] == (50.0, 50.0)
    d = ((p[:, None] - p[None]) ** 2).sum(2)
    near = np.array([r.cluster for r in out.where("cluster IS NOT NULL").orderBy("id").collect()])
    s = []
    for i, k in enumerate(near):
        a = d[i, near == k].sum() / ((near == k).sum() - 1)
        b = min(d[i, near == o].mean() for o in set(near) - {k})
        s.append((b - a) / max(a, b))
    want = {k: np.mean([s[i] for i in np.flatnonzero(near == k)]) for k in set(near)}
    assert {r.cluster: pytest.approx(r.silhouette) for r in silhouette(out).collect()} == want


def test_clusters_of_odd_rows(spark, blobs):
    none = spark.createDataFrame([], "id long, x double, y double")
    out, centres = kmeans(none, ["x", "y"], 3)
    assert out.count() == 0 and centres == [] and silhouette(out).count() == 0
    equal = spark.createDataFrame([(i, 2.0, 3.0) for i in range(9)] + [(9, None, None)], "id long, x double, y double")
    out, centres = kmeans(equal, ["x", "y"], 3)
    assert len(centres) == 1 and {r.cluster for r in out.collect()} == {0, None} and silhouette(out).first().silhouette is None
    two = spark.createDataFrame([(0, 0.0, 0.0), (1, 0.0, 0.0), (2, 5.0, 5.0)], "id long, x double, y double")
    assert {r.cluster: r.silhouette for r in silhouette(kmeans(two, ["x", "y"], 2)[0]).collect()}.keys() == {0, 1}
    tie = spark.createDataFrame([([0.0],)], "_x array<double>").select(nearest(F.col("_x"), [(1.0,), (-1.0,)])["i"].alias("i"))
    assert tie.first().i == 0
    assert _spread([(0.0,), (1.0,), (9.0,)], [5.0, 5.0, 1.0], 2) == [(0.0,), (9.0,)]
    assert len(seed(scaled_points(blobs, ["x", "y"]).persist(), 4)) == 4


# ------------------------------------------------------------------ S2

def body(n):
    return None if n is None else '{"error": "x"}' if n < 0 else '{"response": {"data": [' + ", ".join('{"period": "2024-01-01T00", "respondent": "B", "type": "D", "value": "1"}' for _ in range(n)) + "]}}"


def test_pages_end_at_the_first_short_one(spark):
    sizes = {"a": [3, 3, 2, 3, 3], "b": [3, 0, 3], "c": [3, 3, 3], "d": [-1, 3], "e": [3, None, 2], "f": [1], None: [3, 2, 3]}
    rows = [(k, p, body(n)) for k, s in sizes.items() for p, n in enumerate(s)] + [("c", 1, body(3))]
    got = follow_pages(spark.createDataFrame(rows, "who string, page long, body string").repartition(5), keys=["who"], page="page", page_size=3)
    used = {}
    for r in got.orderBy("page").collect():
        used.setdefault(r.who, []).append((r.status, r.used))
    assert [u for _, u in used["a"]] == [True, True, True, False, False] and used["a"][2] == ("short", True)
    assert used["b"] == [("full", True), ("empty", False), ("full", False)] and [u for _, u in used["c"]] == [True] * 3
    assert used["d"] == [("failed", False), ("full", False)] and used["e"] == [("full", True), ("failed", False), ("short", False)]
    assert used["f"] == [("short", True)] and [u for _, u in used[None]] == [True, True, False]


# ------------------------------------------------------------------ A14

def test_counters_in_flight_equal_counted_ones(spark, tmp_path):
    raw = series_df(spark, [1.0, 5000.0, None, 3.0, -2.0, 900.0, 2.0, 2.5, None, None] * 8)
    raw = raw.unionByName(raw.where("row_id % 3 = 0").withColumn("row_id", F.col("row_id") + 1000))
    raw.write.parquet(f"{tmp_path}/raw")
    raw = spark.read.parquet(f"{tmp_path}/raw")
    flight, counted = pl.emissions_pipeline(raw), pl.emissions_pipeline(raw, checkpoint=False)
    assert flight.metrics("x").collect() == counted.metrics("x").collect() and flight.metrics("x").first().duplicates_removed == 27
    plan = flight.metrics("x")._jdf.queryExecution().optimizedPlan().toString()
    scans = lambda p: p.count("Relation [")
    assert f"{tmp_path}/raw" not in "".join(flight.metrics("x").inputFiles()) and scans(plan) < scans(counted.metrics("x")._jdf.queryExecution().optimizedPlan().toString())
    assert "_copies" not in flight.deduped.columns + flight.imputed.columns + flight.corrected.columns + flight.clean.columns
    empty = pl.emissions_pipeline(raw.limit(0)).metrics("x").first()
    assert (empty.duplicates_removed, empty.missing_imputed, empty.outliers_corrected) == (0, 0, 0)
    assert ts(0) == T0
