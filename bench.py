"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is executed to completion with the ``noop`` sink (no driver collect).
The cleaning pipelines are timed from the raw tables; the analysis datasets read
the cleaned grids written once per run (as the pipeline does for its consumers).
Per query: median of ``BENCH_REPEATS`` warm runs after one warm-up run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from voltframe.plans import pipelines as pl  # noqa: E402
from voltframe.plans import queries as q  # noqa: E402
from voltframe.operators.qq import qq_points  # noqa: E402
from voltframe.session import local_session, release_tables  # noqa: E402
from voltframe.sources import testdata as td  # noqa: E402


def fresh(name):
    def run(spark, sf):
        ev = td.load(spark, sf, "events")
        if name == "emissions_pipeline":
            return pl.emissions_pipeline(td.emissions_raw(ev)).clean
        if name == "emissions_pipeline_by_region":
            return pl.emissions_pipeline(td.emissions_raw(ev), keys=["region"]).clean
        if name == "demand_pipeline":
            return pl.demand_pipeline(td.demand_raw(ev)).clean
        raise KeyError(name)
    return run


HEADLINE = {
    # raw-row operators and pipelines (computed from the events table every run)
    "dedupe_first": q.RAW["dedupe_first"],
    "impute_linear": q.RAW["impute_linear"],
    "outliers_iqr": q.RAW["outliers_iqr"],
    "quartiles": q.RAW["quartiles"],
    "regional_box_stats": q.RAW["regional_box_stats"],
    "kde_by_region": q.RAW["kde_by_region"],
    "qq_points_raw": lambda s, sf: qq_points(q._em_raw(s, sf), "value", ["region"]),
    "quartiles_in_memory": q.RAW["quartiles_in_memory"],
    "time_gap": q.RAW["time_gap"],
    "resample_15m": q.RAW["resample_15m"],
    "rolling_features": q.RAW["rolling_features"],
    "asof_nearest": q.RAW["asof_nearest"],
    "event_collection": q.RAW["event_collection"],
    "emissions_pipeline": fresh("emissions_pipeline"),
    "emissions_pipeline_by_region": fresh("emissions_pipeline_by_region"),
    "demand_pipeline": fresh("demand_pipeline"),
    # analysis datasets over the cleaned grids
    "analysis_base": lambda s, sf: pl.analysis_base(q._e(s, sf), q._d(s, sf)),
    "box_stats": q.RAW["box_stats"],
    "histogram_40": q.RAW["histogram_40"],
    "corr_matrix": q.RAW["corr_matrix"],
    "qq_points": q.RAW["qq_points"],
    "seasonal_decompose": q.RAW["seasonal_decompose"],
    "dow_hour_matrix": q.RAW["dow_hour_matrix"],
    "running_total": q.RAW["running_total"],
    "kde_by_period": q.RAW["kde_by_period"],
}


def run_once(spark, fn, sf):
    t = time.perf_counter()
    fn(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = [x for x in os.environ.get("BENCH_QUERIES", "").split(",") if x]
    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)),
                          app="voltframe-bench")
    # stage the cleaned grids and warm up the JVM once (not timed)
    t0 = time.perf_counter()
    q._e(spark, sf_dir), q._d(spark, sf_dir), q._merged(spark, sf_dir)
    staging = time.perf_counter() - t0
    out = {}
    for name, fn in HEADLINE.items():
        if only and name not in only:
            continue
        run_once(spark, fn, sf_dir)
        out[name] = round(statistics.median(run_once(spark, fn, sf_dir) for _ in range(repeats)), 3)
    release_tables(spark)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(out.values()), 3),
                      "unit": "sec", "queries": out, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus, "repeats": repeats, "staging_first_run_sec": round(staging, 3),
                      "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
