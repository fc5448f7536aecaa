"""Mapping of the generated benchmark tables onto the grid series.

The ``events`` table (event_id, ts, user_id, event_type, value, props) becomes:

* emissions_raw: non-purchase rows, minute timestamps (duplicate keys), region =
  event_type, with injected missing, too-high and negative values;
* demand pages: purchase rows as raw API page records (hourly period text,
  respondent BA0..BA2, type 'D', value text that is sometimes not a number)
  plus one 'NG' record per row that the type facet must drop;
* a fixed hazard-event catalog in January 2024 (two overlapping windows after
  the 7-day buffer, one event without an id).

The source ``event_id`` becomes ``row_id`` (``event_id`` names hazard events here).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.sources.catalog import event_catalog
from voltframe.sources.landing import process_demand

# The analysis "event" period used by the chart datasets
# (half-open instants and the inclusive day labels).
EVENT_START = "2024-01-15 00:00:00"
EVENT_END = "2024-01-19 00:00:00"
EVENT_DAYS = ("2024-01-15", "2024-01-18")

# Own test catalog: three overlapping windows inside the events table's month, one without an id.
HAZARD_EVENTS = [
    ("ice_line_icing", "icing", datetime(2024, 1, 6, 3, 0), datetime(2024, 1, 9, 15, 0),
     "click", "severe", 31200, "Line icing on the northern corridor"),
    ("substation_fire", "equipment", datetime(2024, 1, 13, 11, 30), datetime(2024, 1, 14, 2, 15),
     "click", "minor", 970, "Transformer fire at one substation"),
    (None, "flood", datetime(2024, 1, 23, 4, 0), datetime(2024, 1, 25, 20, 45),
     "view", "severe", 17450, "River flood, entered without a catalog id"),
]
# Catalog region -> balancing authority of the demand series.
REGION_TO_BA = {"click": "BA0", "view": "BA1"}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def emissions_raw(events: DataFrame) -> DataFrame:
    eid, v = F.col("event_id"), F.col("value")
    val = (F.when(eid % 7 == 0, F.lit(None).cast("double"))
           .when(eid % 97 == 0, v * 100)
           .when(eid % 89 == 0, -v)
           .otherwise(v))
    return events.where(F.col("event_type") != "purchase").select(
        eid.alias("row_id"),
        F.date_trunc("minute", F.col("ts")).cast("timestamp_ntz").alias("timestamp"),
        F.col("event_type").alias("region"),
        val.cast("double").alias("value"))


def demand_page_records(events: DataFrame) -> DataFrame:
    """Raw page records: period, respondent, type, value (text), row_id."""
    eid = F.col("event_id")
    period = F.date_format(F.date_trunc("hour", F.col("ts")), "yyyy-MM-dd'T'HH")
    text = F.when(eid % 11 == 0, F.lit("x")).otherwise(F.col("value").cast("string"))
    return events.where(F.col("event_type") == "purchase").select(
        period.alias("period"),
        F.concat(F.lit("BA"), (F.col("user_id") % 3).cast("string")).alias("respondent"),
        F.lit("D").alias("type"), text.alias("value"), eid.alias("row_id"))


def demand_raw(events: DataFrame) -> DataFrame:
    return process_demand(demand_page_records(events), keep=("row_id",))


def emissions_response_json(events: DataFrame) -> DataFrame:
    """One landed emissions response per source row: ``row_id, body`` (JSON text)."""
    e = emissions_raw(events)
    item = F.struct(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("point_time"),
                    F.col("value").alias("value"))
    body = F.to_json(F.struct(F.array(item).alias("data"), F.col("region").alias("region")))
    return e.select("row_id", body.alias("body"))


def emissions_with_nan(events: DataFrame) -> DataFrame:
    """The emissions rows with NaN planted in every 31st value."""
    return emissions_raw(events).withColumn("value", F.when(F.col("row_id") % 31 == 0, F.lit(float("nan"))).otherwise(F.col("value")))


def demand_numbered_pages(events: DataFrame) -> DataFrame:
    """Landed pages ``respondent, page, body``: the demand records of 100 source rows each, some bodies
    replaced by an empty page (page 17 k + 5) or an error (page 23 k + 11)."""
    r = demand_page_records(events).withColumn("page", F.floor(F.col("row_id") / 100).cast("long"))
    item = F.struct("row_id", F.struct("period", "respondent", "type", "value").alias("r"))
    rows = r.groupBy("respondent", "page").agg(F.array_sort(F.collect_list(item)).alias("rows"))
    data = F.when(F.col("page") % 17 == 5, F.filter("rows", lambda x: F.lit(False))).otherwise(F.col("rows"))
    body = F.to_json(F.struct(F.struct(F.transform(data, lambda x: x["r"]).alias("data")).alias("response")))
    return rows.select("respondent", "page", F.when(F.col("page") % 23 == 11, F.lit('{"error": "busy"}')).otherwise(body).alias("body"))


def demand_page_json(events: DataFrame) -> DataFrame:
    """One landed demand page per source row: a 'D' record and an 'NG' record."""
    r = demand_page_records(events)
    d = F.struct("period", "respondent", F.lit("D").alias("type"), "value")
    ng = F.struct("period", "respondent", F.lit("NG").alias("type"), F.lit("0").alias("value"))
    body = F.to_json(F.struct(F.struct(F.array(d, ng).alias("data")).alias("response")))
    return r.select("row_id", body.alias("body"))


def hazard_catalog(spark: SparkSession) -> DataFrame:
    return event_catalog(spark, HAZARD_EVENTS)
