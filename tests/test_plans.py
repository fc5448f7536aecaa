"""Plan assertions: no Python UDFs, filters reach the scan, windows are chunked, broadcasts are bounded."""

import pytest

import __spark_entry__ as ent
from tests.conftest import SF001
from voltframe.operators import handle_missing, series_features
from voltframe.plans import analysis as an
from voltframe.sources import testdata as td


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(ent.queries()))
def test_no_python_udfs(spark, name):
    p = ent.queries()[name](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in p


def test_range_filter_pushed_to_parquet(spark, tmp_path):
    e = td.load(spark, SF001, "events").withColumnRenamed("ts", "timestamp")
    p = plan(an.event_slice(e, td.EVENT_START, td.EVENT_END).select("timestamp", "value"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in p
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in p


def _single_partition_inputs(p):
    """Operator lines directly under each 'Exchange SinglePartition'."""
    lines = p.splitlines()
    out = []
    for i, ln in enumerate(lines):
        if "Exchange SinglePartition" in ln:
            j = i + 1
            while "Project" in lines[j] or "Filter" in lines[j]:
                j += 1
            out.append(lines[j])
    return out


def test_keyless_windows_are_chunked(spark):
    raw = td.emissions_raw(td.load(spark, SF001, "events"))
    h = handle_missing(raw, ts="timestamp", value="value", order=["timestamp", "row_id"])
    p = plan(h)
    assert "hashpartitioning(_ch" in p
    # Only the per-chunk summary (an aggregate: one row per chunk) is ever gathered.
    assert all("Aggregate" in ln for ln in _single_partition_inputs(p))
    h.collect()  # executes this query execution, so the final adaptive plan is visible
    assert "ReusedExchange" in plan(h)  # raw rows shuffled once for both phases
    g = series_features(td.emissions_raw(td.load(spark, SF001, "events")).select("timestamp", "value"),
                        value="value", lags=(4,))
    assert "hashpartitioning(_hc" in plan(g)


def test_event_catalog_broadcast_is_guarded(spark):
    from voltframe.operators.event_windows import attach_events, event_windows, with_default_ids
    cat = event_windows(with_default_ids(td.hazard_catalog(spark)))
    out = attach_events(td.emissions_raw(td.load(spark, SF001, "events")), cat, ts="timestamp",
                        series_key="region", window_key="region")
    assert "BroadcastHashJoin" in plan(out)
    big = attach_events(td.emissions_raw(td.load(spark, SF001, "events")), cat, ts="timestamp",
                        series_key="region", window_key="region", broadcast_max_rows=1)
    assert "ResolvedHint (strategy=broadcast)" not in big._jdf.queryExecution().analyzed().toString()


def test_dedupe_reduces_hot_keys_before_the_shuffle(spark):
    from voltframe.operators import dedupe_first
    raw = td.emissions_raw(td.load(spark, SF001, "events"))
    p = plan(dedupe_first(raw, ["timestamp", "region"], ["row_id"]))
    lines = p.splitlines()
    ex = next(i for i, ln in enumerate(lines) if "Exchange hashpartitioning" in ln)
    assert any("partial_min_by" in ln for ln in lines[ex:])  # map-side partial aggregate under the exchange


def test_asof_copies_no_row_and_joins_only_its_summary(spark):
    from voltframe.operators import asof_nearest
    ev = td.load(spark, SF001, "events")
    left = td.emissions_raw(ev)
    right = td.demand_raw(ev).select("timestamp", "demand_MW", "row_id")
    out = asof_nearest(left, right, on="timestamp", right_cols=["demand_MW"], right_order=["row_id"])
    assert plan(out).count("Join") == 1 and "CartesianProduct" not in plan(out)
    assert "Generate" not in plan(out).replace("Generate explode(array(", "")   # but for a right instant's first and last row
    out.collect()
    assert "ReusedExchange" in plan(out)    # both sides are shuffled once


def test_jobs_before_the_first_action(spark):
    """Plan building: probes, the corrected rows, quantile tables - each job is one stage under AQE."""
    from voltframe.plans import queries as q
    q.RAW["outliers_iqr"](spark, SF001)
    tracker, group = spark.sparkContext.statusTracker(), "plan-build"
    spark.sparkContext.setJobGroup(group, group)
    q.RAW["outliers_iqr"](spark, SF001)
    jobs = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 24, jobs


@pytest.mark.parametrize("whole_days", [False, True])
def test_event_window_bounds_reach_the_scan(spark, whole_days):
    from voltframe.operators.event_windows import attach_events, event_windows, with_default_ids
    e = td.load(spark, SF001, "events").withColumnRenamed("ts", "timestamp")
    cat = event_windows(with_default_ids(td.hazard_catalog(spark)), buffer_days=0)
    kw = dict(ts="timestamp", series_key="event_type", window_key="region", whole_days=whole_days)
    out = attach_events(e, cat, **kw)
    p = plan(out)
    assert "GreaterThanOrEqual(ts,2024-01-06T" in p and "LessThanOrEqual(ts,2024-01-2" in p
    lo, hi = ("to_date(window_lo)", "to_date(window_hi)") if whole_days else ("window_lo", "window_hi")
    t = "to_date(timestamp)" if whole_days else "timestamp"
    cond = f"event_type = region AND {t} >= {lo} AND {t} <= {hi}"
    pairs = e.crossJoin(cat.select("region", "window_lo", "window_hi")).where(cond)   # three windows
    assert out.count() == pairs.count() > 0
    assert attach_events(e, cat.limit(0), **kw).count() == 0


@pytest.mark.parametrize("max_rows", [200_000, 0])
@pytest.mark.parametrize("whole_days", [False, True])
def test_windows_of_any_length_have_at_most_two_index_rows(spark, whole_days, max_rows):
    from voltframe.operators.event_windows import attach_events, window_index
    win = spark.sql("""SELECT * FROM VALUES
        ('ten years', 'a', TIMESTAMP_NTZ '2015-03-01 06:00:00', TIMESTAMP_NTZ '2025-03-01 05:00:00'),
        ('before 1970', 'a', TIMESTAMP_NTZ '1969-12-30 12:00:00', TIMESTAMP_NTZ '1970-01-02 00:00:00'),
        ('instant', 'b', TIMESTAMP_NTZ '2024-01-01 00:00:00', TIMESTAMP_NTZ '2024-01-01 00:00:00'),
        ('week', 'b', TIMESTAMP_NTZ '2024-01-01 06:00:00', TIMESTAMP_NTZ '2024-01-08 07:00:00'),
        ('reversed', 'b', TIMESTAMP_NTZ '2024-01-08 06:00:00', TIMESTAMP_NTZ '2024-01-01 07:00:00'),
        ('open', 'b', TIMESTAMP_NTZ '2024-01-08 06:00:00', NULL) AS t(event_id, region, window_lo, window_hi)""")
    per = {r.event_id: r["count"] for r in window_index(win).groupBy("event_id").count().collect()}
    assert set(per) == {"ten years", "before 1970", "instant", "week"} and max(per.values()) <= 2
    series = spark.sql("""SELECT id, IF(id % 2 = 0, 'a', 'b') AS region, t AS timestamp FROM (
        SELECT 2 * id + k AS id, timestampadd(HOUR, 3 * k, timestampadd(DAY, CAST(CASE WHEN id < 40 THEN id - 20 ELSE 16000 + id * 23 END AS INT), TIMESTAMP_NTZ '1970-01-01 00:00:00')) AS t
        FROM range(300) LATERAL VIEW explode(sequence(0, 7)) AS k)
        UNION ALL SELECT -1, 'b', TIMESTAMP_NTZ '2024-01-01 00:00:00' UNION ALL SELECT -2, 'b', TIMESTAMP_NTZ '2024-01-08 07:00:00' UNION ALL SELECT -3, 'b', NULL""")
    out = attach_events(series, win, ts="timestamp", series_key="region", window_key="region", whole_days=whole_days, broadcast_max_rows=max_rows)
    cut = (lambda t: t.date()) if whole_days else (lambda t: t)
    wins = [w for w in win.collect() if w.window_lo and w.window_hi and w.window_lo <= w.window_hi]
    want = sorted((r.id, w.event_id) for r in series.collect() for w in wins
                  if r.timestamp and r.region == w.region and cut(w.window_lo) <= cut(r.timestamp) <= cut(w.window_hi))
    assert sorted((r.id, r.event_id) for r in out.collect()) == want and len({e for _, e in want}) == 4
