"""Written stage tables: clean once, analyse many.

The cleaned grids feed a dozen analysis datasets. Rather than re-running the
cleaning lineage inside every analysis plan, the stage is written once as
Parquet under the cluster's checkpoint folder (``spark.checkpoint.dir``) and read
back. This also cuts the lineage: a lost executor re-reads the written table
instead of recomputing the whole cleaning chain.
"""

from __future__ import annotations

import hashlib
import threading
import uuid
from collections import defaultdict
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.session import ensure_checkpoint_dir

_RUN = uuid.uuid4().hex[:12]
_WRITTEN: dict[str, str] = {}
_LOCKS: dict[str, threading.RLock] = defaultdict(threading.RLock)


def stage_path(spark: SparkSession, name: str) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/voltframe-stages/{_RUN}/{name}"


def staged(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Read the stage ``name``, writing it from ``build()`` on first use in this process
    (again if the written table has since disappeared). Concurrent callers of one name
    wait for its writer; different names do not block each other. Callers resolve the
    stages that ``build`` reads before the call, so no lock is held over another stage."""
    path = stage_path(spark, name)
    with _LOCKS[name]:
        if _WRITTEN.get(name) == path:
            try:
                return spark.read.parquet(path)
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
        build().write.mode("overwrite").parquet(path)
        _WRITTEN[name] = path
        return spark.read.parquet(path)


def input_version(df: DataFrame) -> str:
    """Identity of the files behind ``df`` (paths, sizes, modification times): a changed
    input gives another version. Reads footers only (no data column)."""
    r = (df.select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("n"),
                   F.col("_metadata.file_modification_time").alias("t")).distinct()
         .agg(F.sum(F.xxhash64("p", "n", "t").cast("decimal(38,0)")).alias("h"), F.count("*").alias("c")).first())
    return f"{r.h}/{r.c}"


def stage_key(*parts: str) -> str:
    return hashlib.sha1("|".join(parts).encode()).hexdigest()[:16]
