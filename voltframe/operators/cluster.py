"""Clustering of event signatures - k-means on scaled feature vectors, and its silhouette.

Points are rows; their feature vector is written once as an array. Centres (k vectors, a size set by
parameters) are all that passes through the driver: each Lloyd step is one aggregate by nearest
centre, with partial sums per task. Seeding is k-means||: a few rounds that each draw points with
a chance in proportion to their squared distance from the centres so far, about ``2 k`` a round;
the drawn candidates are weighed by the points nearest to them and thinned to k by weighted
farthest-first choice. Draws use a hash of the point, so a run can be repeated exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltframe.functions.columns import finite, quantize
from voltframe.operators.scaling import normalize_features
from voltframe.session import cut_lineage

Centre = tuple[float, ...]
ROUNDS, STEPS = 4, 20


def scaled_points(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``df`` with ``_x``: the z-scores of ``features``, snapped to multiples of 2**-20; NULL where one
    is missing. A constant feature counts as 0."""
    clean = df.withColumns({f: finite(f) for f in features})
    scaled, _ = normalize_features(clean, features, "zscore")
    z = [F.when(F.col(f).isNotNull(), F.coalesce(quantize(F.col(f"{f}_normalized")), F.lit(0.0))) for f in features]
    whole = F.when(F.greatest(*[F.col(f).isNull() for f in features], F.lit(False)), F.lit(None)).otherwise(F.array(*z))
    return scaled.withColumn("_x", whole).drop(*[f"{f}_normalized" for f in features])


def distance2(x: Column, centre: Column) -> Column:
    return F.aggregate(F.zip_with(x, centre, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, d: s + d)


def nearest(x: Column, centres: Sequence[Centre]) -> Column:
    """Struct (d, i): squared distance to and number of the nearest centre, ties to the smaller number."""
    table = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centres])
    return F.array_min(F.transform(table, lambda c, i: F.struct(distance2(x, c).alias("d"), i.alias("i"))))


def _spread(candidates: Sequence[Centre], weights: Sequence[float], k: int) -> list[Centre]:
    """k of a few candidates: the heaviest, then each time the largest weight x squared distance to
    those chosen (ties to the smaller vector)."""
    order = sorted(range(len(candidates)), key=lambda i: candidates[i])
    far = {i: 1.0 for i in order}
    chosen: list[int] = []
    while len(chosen) < min(k, len(order)):
        best = max(order, key=lambda i: (weights[i] * far[i], -order.index(i)))
        if chosen and far[best] == 0:
            break
        chosen.append(best)
        far = {i: min(far[i] if len(chosen) > 1 else float("inf"), sum((a - b) ** 2 for a, b in zip(candidates[i], candidates[best]))) for i in order}
    return [candidates[i] for i in chosen]


def seed(points: DataFrame, k: int, rounds: int = ROUNDS, salt: int = 0) -> list[Centre]:
    """k-means|| seeds of ``points`` (a written table with ``_x``); fewer if fewer vectors differ."""
    x, p = F.col("_x"), points.where("_x IS NOT NULL")
    start = p.agg(F.min_by("_x", F.struct(F.xxhash64(F.lit(salt), "_x"), "_x")).alias("x")).first()
    if start is None or start.x is None:
        return []
    found: list[Centre] = [tuple(start.x)]
    for r in range(rounds):
        d = nearest(x, found)["d"]
        total = p.agg(F.sum(d)).first()[0] or 0.0
        if total <= 0:
            break
        chance = F.lit(2.0 * k / total) * d
        draw = F.pmod(F.xxhash64(F.lit(salt), F.lit(r), "_x"), F.lit(1 << 30)) / float(1 << 30)
        # equal vectors draw alike, so they are drawn with their summed chance, once
        drawn = p.groupBy("_x").agg(F.sum(chance).alias("c")).where(draw < F.col("c")).select("_x")
        found += sorted(tuple(row._x) for row in drawn.collect() if tuple(row._x) not in set(found))
    weight = dict(p.groupBy(nearest(x, found)["i"].alias("i")).agg(F.count(F.lit(1)).alias("n")).collect())
    return _spread(found, [float(weight.get(i, 0)) for i in range(len(found))], k)


def kmeans(df: DataFrame, features: Sequence[str], k: int, *, seeds: Sequence[Centre] | None = None,
           steps: int = STEPS, salt: int = 0) -> tuple[DataFrame, list[Centre]]:
    """Rows of ``df`` with ``cluster`` (from 0; NULL where a feature is missing) and ``distance2`` to its
    centre, and the centres in scaled units. Centres are snapped to multiples of 2**-20; an empty
    cluster keeps its centre; ties go to the smaller cluster number; ends early once nothing moves."""
    features = list(features)
    points = cut_lineage(scaled_points(df, features), "points")
    centres = [tuple(map(float, c)) for c in seeds] if seeds is not None else seed(points, k, salt=salt)
    x = F.col("_x")
    for _ in range(steps if centres else 0):
        means = [quantize(F.avg(x[j])).alias(f"m{j}") for j in range(len(features))]
        moved = {r[0]: tuple(r)[1:] for r in points.where("_x IS NOT NULL").groupBy(nearest(x, centres)["i"].alias("i")).agg(*means).collect()}
        now = [moved.get(i, c) for i, c in enumerate(centres)]
        if now == centres:
            break
        centres = now
    near = nearest(x, centres) if centres else F.lit(None).cast("struct<d: double, i: int>")
    out = points.withColumn("_near", F.when(x.isNotNull(), near))
    return out.select(*[f"`{c}`" for c in df.columns], "_x", F.col("_near.i").alias("cluster"), F.col("_near.d").alias("distance2")), centres


def silhouette(clustered: DataFrame) -> DataFrame:
    """Per cluster: ``n``, mean squared distance to the centre, and mean silhouette by squared distances
    (a point alone in its cluster counts 0; with one cluster only it is NULL).

    The mean squared distance from a point to a cluster comes from the cluster's size, sum and sum
    of squares, so no two points are compared."""
    p = clustered.where("cluster IS NOT NULL").withColumn("_q", F.aggregate("_x", F.lit(0.0), lambda s, v: s + v * v))
    width = F.size("_x")
    each = p.select("cluster", "_q", F.posexplode("_x").alias("j", "v"), width.alias("w")).groupBy("cluster", "j").agg(F.sum("v").alias("s"))
    sums = each.groupBy("cluster").agg(F.transform(F.array_sort(F.collect_list(F.struct("j", "s"))), lambda e: e["s"]).alias("s"))
    table = p.groupBy("cluster").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("_q").alias("q")).join(sums, "cluster")
    # k rows in one array: its size is set by the number of clusters
    all_ = table.agg(F.collect_list(F.struct("cluster", "n", "s", "q")).alias("_all"))
    d = p.crossJoin(F.broadcast(all_))
    dot = lambda s: F.aggregate(F.zip_with(F.col("_x"), s, lambda a, b: a * b), F.lit(0.0), lambda t, v: t + v)
    apart = F.transform("_all", lambda c: F.struct(c["cluster"].alias("c"), (F.col("_q") * c["n"] + c["q"] - 2 * dot(c["s"])).alias("t"), c["n"].alias("n")))
    d = d.withColumn("_to", apart)
    own = F.filter("_to", lambda c: c["c"] == F.col("cluster"))[0]
    a = F.when(own["n"] > 1, own["t"] / (own["n"] - 1))
    b = F.array_min(F.transform(F.filter("_to", lambda c: c["c"] != F.col("cluster")), lambda c: c["t"] / c["n"]))
    top = F.greatest(a, b)
    s = F.when(F.size("_to") < 2, F.lit(None)).when(own["n"] <= 1, F.lit(0.0)).when(top > 0, (b - a) / top).otherwise(F.lit(0.0))
    return d.withColumn("_s", s).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.avg("distance2").alias("mean_distance2"), F.avg("_s").alias("silhouette"))
