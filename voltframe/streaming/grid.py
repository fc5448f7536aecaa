"""Streaming: landed responses arrive continuously; slot means are emitted once final.

The batch pipeline reads landed responses in one scan. When responses keep
landing, the same parse runs on ``readStream`` and the 15-minute mean (A5)
becomes a windowed aggregate with a watermark: in append mode a slot is
written once the watermark passes its end, so late rows inside the allowed
lateness are still averaged in and state stays bounded. Grid completion
(empty slots) and the window features need the whole series and stay in the
batch pipeline, which reads the sink table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from voltframe.session import ensure_checkpoint_dir
from voltframe.sources.landing import EMISSIONS_RESPONSE, _emissions_rows


def emissions_landing_stream(spark: SparkSession, path: str, region: str | None = None,
                             max_files_per_trigger: int | None = None) -> DataFrame:
    """S1 as a stream over a landing folder (schema given, never inferred)."""
    r = spark.readStream.schema(EMISSIONS_RESPONSE)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = r.json(path)
    return _emissions_rows(raw.select(F.struct(*raw.columns).alias("_r")), region)


def slot_means_stream(stream: DataFrame, *, ts: str = "timestamp", value_cols: Sequence[str] = ("value",),
                      keys: Sequence[str] = ("region",), step_seconds: int = 900,
                      lateness: str = "1 hour") -> DataFrame:
    """Windowed mean per (keys, slot) with a watermark; output ``keys, ts, values, n``."""
    t = F.col(ts).cast("timestamp")
    s = stream.withColumn("_t", t).withWatermark("_t", lateness)
    g = s.groupBy(*keys, F.window("_t", f"{int(step_seconds)} seconds").alias("_w"))
    out = g.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in value_cols], F.count(F.lit(1)).alias("n"))
    return out.select(*keys, F.col("_w.start").cast("timestamp_ntz").alias(ts), *value_cols, "n")


def start_slot_sink(means: DataFrame, path: str, name: str, available_now: bool = True) -> StreamingQuery:
    """Append final slot means to a Parquet table; progress is checkpointed in the
    session's checkpoint folder so a restarted query resumes exactly once."""
    ckpt = ensure_checkpoint_dir(means.sparkSession).rstrip("/") + f"/voltframe-streams/{name}"
    w = (means.writeStream.format("parquet").outputMode("append").option("path", path)
         .option("checkpointLocation", ckpt))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
