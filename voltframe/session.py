"""Session defaults the operators assume (UTC clock, ANSI on, AQE on)."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every operator relies on. Timestamps are interpreted in UTC and
# ANSI mode stays on (operators use try_cast / try_divide where pandas yields NaN).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Runtime re-planning: AQE coalesces small shuffles, converts joins to broadcast
# once the real size of a side is known, and splits skewed join partitions.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
}


# Tables written by cut_lineage in this process, for release_tables.
_TABLES: list[str] = []


def configure(spark: SparkSession) -> SparkSession:
    """Apply the required settings to an existing session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    for k, v in RECOMMENDED_CONF.items():
        spark.conf.set(k, v)
    return spark


def local_session(cores: str | int = "*", shuffle_partitions: int = 8,
                  app: str = "voltframe", extra: dict | None = None) -> SparkSession:
    """Local session for tests and benchmarks (UI off, no servers)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("VOLTFRAME_DRIVER_MEMORY", "8g"))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in {**REQUIRED_CONF, **RECOMMENDED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    if _context(spark) is not None:
        spark.sparkContext.setLogLevel("ERROR")
    if checkpoint_dir(spark) is None:
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="voltframe-ckpt-"))
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None for a Spark Connect session (no driver-side context)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions raise here
        return None


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    sc = _context(spark)
    d = sc.getCheckpointDir() if sc is not None else None
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``; an error where none is named.

    Library code never falls back to a machine-local folder: on a cluster the executors
    could not share it. ``local_session`` and ``name_local_checkpoint_dir`` name one for
    single-machine sessions.
    """
    d = checkpoint_dir(spark)
    if d is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc = _context(spark)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def name_local_checkpoint_dir(spark: SparkSession, folder: str) -> None:
    """Name ``folder`` for a ``local[...]`` session that has none (driver and tasks share the machine)."""
    sc = _context(spark)
    if checkpoint_dir(spark) is None and sc is not None and re.match(r"local(\[|$)", sc.master):
        os.makedirs(folder, exist_ok=True)
        spark.conf.set("spark.checkpoint.dir", folder)


def table_path(spark: SparkSession, name: str) -> str:
    """A new path for a written table in the shared folder, remembered for ``release_tables``."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/voltframe-tables/{name}-{uuid.uuid4().hex}"
    _TABLES.append(path)
    return path


def cut_lineage(df, name: str = "table"):
    """Write ``df`` once as Parquet under the session's checkpoint folder and read it back.

    This is the "written table" form of a reliable checkpoint: one pass over the
    plan (``Dataset.checkpoint`` evaluates an unpersisted plan twice), columnar
    storage with filter push-down on the way back, and a lost executor re-reads
    the table instead of recomputing the lineage. The table stays until
    ``release_tables``.
    """
    spark = df.sparkSession
    path = table_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_tables(spark: SparkSession) -> int:
    """Delete the tables this process wrote with ``cut_lineage``; call it once their readers are done."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _TABLES:
        path = jvm.org.apache.hadoop.fs.Path(_TABLES.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n
