"""Sources and sinks: landed JSON responses and pages, typed CSV, conditional sink, JSON report, streaming."""

import json
from datetime import datetime

from pyspark.sql import types as T

from voltframe.operators.report import quality_row, write_report_json
from voltframe.sources import (process_demand, read_csv_typed, read_demand_pages, read_emissions_landing,
                               write_if_not_empty, write_table)
from voltframe.streaming import emissions_landing_stream, slot_means_stream, start_slot_sink


def _land_emissions(folder, n_files=2):
    folder.mkdir(parents=True, exist_ok=True)
    for f in range(n_files):
        data = [{"point_time": f"2024-01-01T00:{5 * i + f:02d}:00Z", "value": float(i + f)} for i in range(6)]
        data.append({"point_time": "2024-01-01T00:59:00+00:00", "value": float("nan")})
        (folder / f"resp{f}.json").write_text(json.dumps({"data": data, "region": "r1", "freq": "300"}) + "\n")


def test_emissions_landing_scan(spark, tmp_path):
    _land_emissions(tmp_path / "em")
    df = read_emissions_landing(spark, str(tmp_path / "em"), region="CAISO_NORTH")
    rows = df.collect()
    assert len(rows) == 14
    assert {r.region for r in rows} == {"CAISO_NORTH"}
    assert sum(r.value is None for r in rows) == 2  # NaN -> NULL
    assert min(r.timestamp for r in rows) == datetime(2024, 1, 1, 0, 0)


def test_demand_pages_scan_filters_type_and_respondent(spark, tmp_path):
    d = tmp_path / "pages"
    d.mkdir()
    for p in range(3):
        recs = [{"period": f"2024-01-01T{h:02d}", "respondent": r, "type": t, "value": v}
                for h in range(p * 2, p * 2 + 2) for r in ("CISO", "PSCO") for t, v in (("D", str(100 + h)), ("NG", "1"))]
        recs.append({"period": "2024-01-01T23", "respondent": "CISO", "type": "D", "value": "n/a"})
        (d / f"page{p}.json").write_text(json.dumps({"response": {"data": recs}}) + "\n")
    raw = read_demand_pages(spark, str(d), respondent="CISO")
    out = process_demand(raw).collect()
    assert len(out) == 9  # 2 hours x 3 pages + 3 duplicated 'n/a' rows (pages are not de-duplicated)
    assert sum(r.demand_MW is None for r in out) == 3
    assert {r.balancing_authority for r in out} == {"CISO"}


def test_csv_roundtrip_and_conditional_sink(spark, tmp_path):
    schema = T.StructType([T.StructField("timestamp", T.TimestampNTZType()), T.StructField("region", T.StringType()),
                           T.StructField("value", T.DoubleType())])
    df = spark.createDataFrame([(datetime(2024, 1, 1, 0, 15), "a", 1.5), (datetime(2024, 1, 1, 0, 30), "b", None)],
                               schema)
    write_table(df, str(tmp_path / "csv"), fmt="csv")
    back = read_csv_typed(spark, str(tmp_path / "csv"), schema)
    assert sorted(back.collect()) == sorted(df.collect())
    assert write_if_not_empty(df.where("false"), str(tmp_path / "empty")) is False
    assert write_if_not_empty(df, str(tmp_path / "pq"), partition_by=["region"]) is True
    assert spark.read.parquet(str(tmp_path / "pq")).count() == 2


def test_json_report_sink(spark, tmp_path):
    df = spark.createDataFrame([(datetime(2024, 1, 1), 1.0), (datetime(2024, 1, 2), None)],
                               "timestamp timestamp_ntz, value double")
    rep = quality_row(df, name="emissions", ts="timestamp", value="value")
    write_report_json(rep, str(tmp_path / "rep"))
    got = spark.read.json(str(tmp_path / "rep")).collect()[0]
    assert got.date_range == "2024-01-01 00:00:00+00:00 to 2024-01-02 00:00:00+00:00"
    assert got.missing_pct == 50.0 and got.total_records == 2


def test_streaming_slot_means(spark, tmp_path):
    _land_emissions(tmp_path / "land")
    stream = emissions_landing_stream(spark, str(tmp_path / "land"))
    means = slot_means_stream(stream, lateness="0 seconds")
    q = start_slot_sink(means, str(tmp_path / "out"), name=f"t{tmp_path.name}")
    q.awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out"))
    rows = {r.timestamp: r for r in out.collect()}
    # availableNow flushes the final watermark only for slots it can close: at least the first slot is final.
    assert datetime(2024, 1, 1, 0, 0) in rows
    r0 = rows[datetime(2024, 1, 1, 0, 0)]
    exp = [float(i + f) for f in range(2) for i in range(6) if 5 * i + f < 15]
    assert r0.n == len(exp) and abs(r0.value - sum(exp) / len(exp)) < 1e-12


def test_cleaning_run_with_and_without_demand(spark, tmp_path):
    from tests.conftest import SF001
    from voltframe.plans.pipelines import run_cleaning, save_cleaning_outputs
    from voltframe.sources import testdata as td
    ev = td.load(spark, SF001, "events")
    only_em = run_cleaning(td.emissions_raw(ev))
    assert only_em.demand is None
    assert [r.dataset for r in only_em.report.collect()] == ["emissions"]
    assert [r.dataset for r in only_em.metrics.collect()] == ["emissions"]
    w = save_cleaning_outputs(only_em, str(tmp_path / "a"))
    assert w == {"emissions_clean": True, "demand_clean": False, "data_quality_report": True}
    both = run_cleaning(td.emissions_raw(ev), td.demand_raw(ev))
    assert sorted(r.dataset for r in both.report.collect()) == ["demand", "emissions"]
    w = save_cleaning_outputs(both, str(tmp_path / "b"))
    assert w["demand_clean"] is True
    assert spark.read.parquet(str(tmp_path / "b" / "demand_clean")).count() == both.demand.clean.count()


def test_chart_datasets_all_run(spark):
    from tests.conftest import SF001
    from voltframe.plans import analysis as an
    from voltframe.plans.pipelines import analysis_base, run_cleaning
    from voltframe.session import cut_lineage
    from voltframe.sources import testdata as td
    ev = td.load(spark, SF001, "events")
    run = run_cleaning(td.emissions_raw(ev), td.demand_raw(ev))
    e, d = cut_lineage(run.emissions.clean), cut_lineage(run.demand.clean)
    charts = an.chart_datasets(e, d, td.EVENT_START, td.EVENT_END, td.EVENT_DAYS, merged=cut_lineage(analysis_base(e, d)))
    assert len(charts) == 22
    for name, df in charts.items():
        df.write.format("noop").mode("overwrite").save()


def test_bad_csv_fields_are_reported(spark, tmp_path):
    from voltframe.sources.files import read_csv_checked
    (tmp_path / "in.csv").write_text("timestamp,region,value\n2024-01-01T00:00:00,a,1.5\n2024-01-01T01:00:00,b,oops\nnever,c,2\n"
                                     "2024-01-01T02:00:00,,\n2024-01-01T03:00:00,d\n2024-01-01T04:00:00,e,1,2\nbad,f,bad\n")
    schema = T.StructType().add("timestamp", "timestamp_ntz").add("region", "string").add("value", "double")
    good, bad = read_csv_checked(spark, str(tmp_path), schema)
    assert sorted((r.region or "", r.value) for r in good.collect()) == [("", None), ("a", 1.5)]
    assert good.count() == 2 and good.columns == ["timestamp", "region", "value"]
    told = {r.line: (r.file, r.bad_fields) for r in bad.collect()}
    assert told == {"2024-01-01T01:00:00,b,oops": ("in.csv", ["value"]), "never,c,2": ("in.csv", ["timestamp"]),
                    "2024-01-01T03:00:00,d": ("in.csv", []), "2024-01-01T04:00:00,e,1,2": ("in.csv", []), "bad,f,bad": ("in.csv", ["timestamp", "value"])}
    assert bad.select("line").count() == 5
