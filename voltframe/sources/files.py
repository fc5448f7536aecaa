"""Typed file scans and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType,
                   timestamp_format: str | None = None) -> DataFrame:
    """Header CSV with an explicit schema (no inference pass over the data)."""
    r = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
    if timestamp_format:
        r = r.option("timestampNTZFormat", timestamp_format).option("timestampFormat", timestamp_format)
    return r.csv(path)


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType,
                     timestamp_format: str | None = None) -> tuple[DataFrame, DataFrame]:
    """S3/S4 with bad fields made visible: (rows that fit the schema, bad rows).

    A bad row has a field that does not read as its column's type, or too few or too many fields. It
    comes as ``file``, ``line`` (the raw text) and ``bad_fields`` (columns that are NULL although their
    field is not empty, found by reading the line as text; empty where the number of fields is wrong).
    One scan each, when used; nothing is cached.
    """
    text, line = "line", "bad_line"
    while line in schema.fieldNames():
        line += "_"
    r = spark.read.schema(T.StructType([*schema.fields, T.StructField(line, T.StringType())]))
    r = r.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", line)
    if timestamp_format:
        r = r.option("timestampNTZFormat", timestamp_format).option("timestampFormat", timestamp_format)
    rows = r.csv(path)
    names = schema.fieldNames()
    raw = F.from_csv(F.col(line), ", ".join(f"`f{i}` string" for i in range(len(names) + 1)), {"mode": "PERMISSIVE"})
    told = [F.when(F.col(f"`{c}`").isNull() & (F.length(F.col(f"_raw.f{i}")) > 0), F.lit(c)) for i, c in enumerate(names)]
    right = F.col(f"_raw.f{len(names)}").isNull() & F.col(f"_raw.f{len(names) - 1}").isNotNull()
    # every column is read with the line: a scan of the line alone is refused, and one of few columns judges those only
    told_line = F.concat(F.col(f"`{line}`"), *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in names])
    bad = rows.where(told_line.isNotNull()).select("*", F.col("_metadata.file_name").alias("file"), raw.alias("_raw"))
    bad = bad.select("file", F.col(f"`{line}`").alias(text),
                     F.when(right, F.array_compact(F.array(*told))).otherwise(F.array().cast("array<string>")).alias("bad_fields"))
    return rows.where(told_line.isNull()).select(*[f"`{c}`" for c in names]), bad


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                mode: str = "overwrite", timestamp_format: str | None = None) -> None:
    """Overwrite sink; Parquet by default, partitioned by e.g. key and month."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if timestamp_format:
        w = w.option("timestampNTZFormat", timestamp_format).option("timestampFormat", timestamp_format)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_if_not_empty(df: DataFrame, path: str, **kw) -> bool:
    """Skip the sink when the frame is empty (``isEmpty`` reads at most one row)."""
    if df.isEmpty():
        return False
    write_table(df, path, **kw)
    return True
