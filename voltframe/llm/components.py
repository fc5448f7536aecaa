"""Connected components of an edge table by alternating large-star and small-star rounds.

Every round is two joins on DataFrames and a written table; a star's hot centre is aggregated
before the shuffle and meets its rows in a join that AQE can split. Nothing goes to the driver
but a count and a checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.llm.common import cut_lineage

_MARK = "coalesce(sum(cast(xxhash64(u, v) AS decimal(38, 0))), 0) AS h", "count(*) AS n"


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` -> ``(node, root)`` for every node with an edge; the root is the
    component's smallest node and has a row of its own. Loops and NULL ends are left out."""
    e = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = e.selectExpr(*_MARK).first()
    while mark.n:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        e = cut_lineage(small.select("e.*").where("u <> v").distinct(), "edges")
        new = e.selectExpr(*_MARK).first()
        if new == mark:
            break
        mark = new
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
