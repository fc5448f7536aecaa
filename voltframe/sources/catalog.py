"""Hazard-event catalog."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CATALOG_SCHEMA = T.StructType([
    T.StructField("catalog_pos", T.IntegerType(), False),
    T.StructField("event_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("start", T.TimestampNTZType()),
    T.StructField("end", T.TimestampNTZType()),
    T.StructField("region", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("affected_customers", T.LongType()),
    T.StructField("description", T.StringType()),
])


def event_catalog(spark: SparkSession, events: Iterable[tuple]) -> DataFrame:
    """Catalog from rows ``(event_id, event_type, start, end, region, severity,
    affected_customers, description)``; times are naive UTC. ``catalog_pos`` keeps
    the row order (used for default ids)."""
    rows = [(i, *e) for i, e in enumerate(events)]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def read_catalog(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Catalog from a file; the file must carry ``catalog_pos`` for stable default ids."""
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", True)
    return r.schema(CATALOG_SCHEMA).load(path)


__all__ = ["CATALOG_SCHEMA", "event_catalog", "read_catalog"]
