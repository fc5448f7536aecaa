"""Distribution and relationship statistics.

Every statistic is an aggregate (partial per task, final per group) or a small
per-group table broadcast back; no group is collected into one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.functions.columns import finite, outside, present, safe_corr, shielded
from voltframe.operators.ranks import quantiles
from voltframe.operators.sequence import join_keys, join_small


def distribution_summary(df: DataFrame, value: str, keys: Sequence[str] = (),
                         quantile_method: str = "exact") -> DataFrame:
    """n, mean, sample std, median, min, max of the values per key that are neither NULL nor NaN."""
    keys = list(keys)
    v = present(value)
    basic = df.groupBy(*keys).agg(F.count(v).alias("n"), F.avg(v).alias("mean"), present(F.stddev_samp(v)).alias("std"),
                                  F.min(v).alias("min"), F.max(v).alias("max"))
    med = quantiles(df, value, {"median": 0.5}, keys, method=quantile_method).drop("n")
    return join_keys(basic, med, keys, "left")


def _bin_index(v, lo, hi, bins: int):
    """numpy.histogram's bin rule for equal-width bins, last bin closed."""
    step = (hi - lo) / F.lit(float(bins))
    raw = F.floor((v - lo) * (F.lit(float(bins)) / (hi - lo))).cast("long")
    idx = F.least(F.greatest(raw, F.lit(0)), F.lit(bins - 1))
    edge = lambda k: F.when(k >= bins, hi).otherwise(lo + k.cast("double") * step)
    idx = F.when(v < edge(idx), idx - 1).otherwise(idx)
    idx = F.when((idx < bins - 1) & (v >= edge(idx + 1)), idx + 1).otherwise(idx)
    return F.when(hi > lo, idx).otherwise(F.lit(0).cast("long")), step


def histogram(df: DataFrame, value: str, bins: int = 40, keys: Sequence[str] = (),
              density: bool = False) -> DataFrame:
    """Equal-width histogram over each group's own [min, max]; every bin is returned.

    Columns: keys, ``bin`` (0-based), ``bin_lo``, ``bin_hi``, ``count``, ``n`` and,
    with ``density``, ``density = count / (n * width)``. When min == max numpy
    uses [min - 0.5, max + 0.5]; the same is done here. NaN and infinities are
    missing (bins need a finite range).
    """
    keys = list(keys)
    d = df.select(*keys, finite(value).alias("_v")).where("_v IS NOT NULL")
    st = d.groupBy(*keys).agg(F.min("_v").alias("_mn"), F.max("_v").alias("_mx"),
                              F.count(F.lit(1)).alias("n"))
    st = st.select(*keys, "n",
                   F.when(F.col("_mx") > F.col("_mn"), F.col("_mn")).otherwise(F.col("_mn") - 0.5).alias("_lo"),
                   F.when(F.col("_mx") > F.col("_mn"), F.col("_mx")).otherwise(F.col("_mx") + 0.5).alias("_hi"))
    lo, hi = F.col("_lo"), F.col("_hi")
    idx, step = _bin_index(F.col("_v"), lo, hi, bins)
    counts = join_small(d, st.select(*keys, "_lo", "_hi"), keys).groupBy(*keys, idx.alias("bin")) \
        .agg(F.count(F.lit(1)).alias("count"))
    allbins = st.select(*keys, "n", "_lo", "_hi", F.explode(F.sequence(F.lit(0).cast("long"),
                                                                       F.lit(bins - 1).cast("long"))).alias("bin"))
    out = join_keys(allbins, counts, [*keys, "bin"], "left")
    edge = lambda k: F.when(k >= bins, hi).otherwise(lo + k.cast("double") * step)
    cols = [*keys, F.col("bin").cast("int").alias("bin"), edge(F.col("bin")).alias("bin_lo"),
            edge(F.col("bin") + 1).alias("bin_hi"),
            F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"), F.col("n").cast("long").alias("n")]
    if density:
        cols.append((F.coalesce(F.col("count"), F.lit(0)) / (F.col("n") * step)).alias("density"))
    return out.select(*cols)


def box_stats(df: DataFrame, value: str, keys: Sequence[str] = (), whis: float = 1.5,
              quantile_method: str = "exact") -> DataFrame:
    """Box-plot statistics per group: quartiles, whiskers at the most extreme data
    inside ``whis * IQR`` (never inside the box), flier count, n, mean. NaN is missing."""
    keys = list(keys)
    df = df.select(*keys, present(value).alias(value))
    q = quantiles(df, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, keys, method=quantile_method)
    k = F.lit(float(whis))
    q = q.withColumns({"iqr": F.col("q3") - F.col("q1")})
    q = q.withColumns({"_lov": present(F.col("q1") - k * F.col("iqr")), "_hiv": present(F.col("q3") + k * F.col("iqr"))})
    d = join_small(df.where(F.col(value).isNotNull()), q.select(*keys, "_lov", "_hiv", "q1", "q3"), keys)
    v = F.col(value)
    w = d.groupBy(*keys).agg(F.max(F.when(v <= F.col("_hiv"), v)).alias("_wh"),
                             F.min(F.when(v >= F.col("_lov"), v)).alias("_wl"),
                             F.avg(v).alias("mean"),
                             # no data lies between a whisker and its bound
                             F.count_if(outside(v, F.col("_lov"), F.col("_hiv"))).alias("n_fliers"))
    out = join_keys(q, w, keys, "left")
    whishi = F.when(F.col("_wh").isNull() | (F.col("_wh") < F.col("q3")), F.col("q3")).otherwise(F.col("_wh"))
    whislo = F.when(F.col("_wl").isNull() | (F.col("_wl") > F.col("q1")), F.col("q1")).otherwise(F.col("_wl"))
    out = out.withColumns({"whislo": whislo.cast("double"), "whishi": whishi.cast("double")})
    return out.select(*keys, "n", "mean", "q1", "median", "q3", "iqr", "whislo", "whishi",
                      F.coalesce(F.col("n_fliers"), F.lit(0)).cast("long").alias("n_fliers"))


@shielded("whislo", "whishi")
def box_fliers(df: DataFrame, value: str, keys: Sequence[str] = (), whis: float = 1.5,
               quantile_method: str = "exact") -> DataFrame:
    """The data rows drawn as fliers: outside the whiskers of their group."""
    keys = list(keys)
    b = box_stats(df, value, keys, whis, quantile_method).select(*keys, "whislo", "whishi")
    v = F.col(value)
    d = join_small(df.where(v.isNotNull()), b, keys)
    return d.where(outside(v, F.col("whislo"), F.col("whishi"))).drop("whislo", "whishi")


def corr_matrix(df: DataFrame, columns: Sequence[str], labels: Sequence[str] | None = None,
                keys: Sequence[str] = ()) -> DataFrame:
    """Pearson matrix on listwise-complete rows, long form: one aggregate for all pairs.

    Columns: keys, ``i``, ``j``, ``row_label``, ``col_label``, ``r``, ``shown``
    (strict lower triangle, the part a masked heatmap draws). Constant columns give NULL.
    """
    keys = list(keys)
    columns = list(columns)
    labels = list(labels) if labels else columns
    d = df.na.drop(how="any", subset=columns).select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    aggs = [safe_corr(columns[i], columns[j]).alias(f"_r_{i}_{j}")
            for i in range(len(columns)) for j in range(i, len(columns))]
    wide = d.groupBy(*keys).agg(*aggs)
    cells = []
    for i in range(len(columns)):
        for j in range(len(columns)):
            a, b = min(i, j), max(i, j)
            cells.append(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(labels[i]).alias("row_label"),
                                  F.lit(labels[j]).alias("col_label"), F.col(f"_r_{a}_{b}").alias("r")))
    return wide.select(*keys, F.explode(F.array(*cells)).alias("_c")).select(
        *keys, "_c.*").withColumn("shown", F.col("i") > F.col("j"))


def linear_fit(df: DataFrame, x: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """Least squares y = slope * x + intercept and Pearson r (NULL when x or y is constant). Rows where
    either is NULL, NaN or infinite are left out."""
    keys = list(keys)
    d = df.select(*keys, finite(x).alias(x), finite(y).alias(y)).na.drop(how="any", subset=[x, y])
    return d.groupBy(*keys).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                                safe_corr(x, y).alias("r"), F.count(F.lit(1)).alias("n"),
                                F.min(x).cast("double").alias("x_min"), F.max(x).cast("double").alias("x_max"))


def trend_line(fit: DataFrame, points: int = 100, keys: Sequence[str] = ()) -> DataFrame:
    """``points`` evenly spaced x from x_min to x_max (both included) and the fitted y."""
    keys = list(keys)
    step = (F.col("x_max") - F.col("x_min")) / F.lit(float(points - 1))
    g = fit.select(*keys, "slope", "intercept", "x_min", "x_max",
                   F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    x = F.when(F.col("i") == points - 1, F.col("x_max")).otherwise(F.col("i").cast("double") * step + F.col("x_min"))
    return g.select(*keys, "i", x.alias("x"), "slope", "intercept").select(
        *keys, "i", "x", (F.col("slope") * F.col("x") + F.col("intercept")).alias("y"))


def _melt(df: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    cells = [F.struct(F.lit(c).alias("variable"), finite(c).alias("x")) for c in columns]
    return df.select(*keys, F.explode(F.array(*cells)).alias("_m")).select(*keys, "_m.variable", "_m.x")


#: Bandwidths beyond which a value's kernel is left out.
KDE_REACH = 9.0


def kde_curves(df: DataFrame, columns: Sequence[str], group: str, gridsize: int = 200,
               cut: float = 3.0) -> DataFrame:
    """Gaussian KDE per (variable, group): Scott bandwidth std * n^(-1/5), ``gridsize``
    points over [min - cut*bw, max + cut*bw].

    ``density`` integrates to 1 per group; ``density_common`` is scaled by the
    group's share of the variable's rows (curves drawn on one axis). Singular
    groups (zero bandwidth) produce no rows; NaN and infinities are missing. Each distinct value
    meets only the grid points within ``KDE_REACH`` bandwidths; what the others would get is less
    than exp(-KDE_REACH^2 / 2) = 2^-58 of the kernel's peak per row, so a density is short by less than
    2^-59 / bandwidth. Bandwidths shrink with n, and so does the number of points a value meets. The
    partial aggregate folds the contributions per task, so the shuffle carries gridsize rows per group.
    """
    m = _melt(df, columns, [group]).where(F.col("x").isNotNull())
    st = m.groupBy("variable", group).agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("_sd"),
                                          F.min("x").alias("_mn"), F.max("x").alias("_mx"))
    tot = st.groupBy("variable").agg(F.sum("n").alias("_ntot"))
    st = st.join(tot, "variable").withColumn("bw", F.col("_sd") * F.pow(F.col("n").cast("double"), -0.2))
    st = st.withColumns({"_glo": F.col("_mn") - F.lit(cut) * F.col("bw"),
                         "_ghi": F.col("_mx") + F.lit(cut) * F.col("bw")})
    st = st.withColumn("_gstep", (F.col("_ghi") - F.col("_glo")) / F.lit(float(gridsize - 1)))
    # A singular group (one row, or all values equal) has no curve; its rows still
    # count in the common normalisation.
    st = st.where(F.col("bw") > 0)
    # Equal values are summed once with their count: rounded or low-cardinality columns shrink to few rows.
    m = m.groupBy("variable", group, "x").agg(F.count(F.lit(1)).cast("double").alias("_times"))
    d = join_small(m, st.select("variable", group, "bw", "_glo", "_gstep"), ["variable", group])
    near = F.lit(KDE_REACH) * F.col("bw")
    clamp = lambda c: F.greatest(F.least(c, F.lit(float(gridsize))), F.lit(-1.0))
    first = F.greatest(F.ceil(clamp((F.col("x") - near - F.col("_glo")) / F.col("_gstep"))).cast("int"), F.lit(0))
    last = F.least(F.floor(clamp((F.col("x") + near - F.col("_glo")) / F.col("_gstep"))).cast("int"), F.lit(gridsize - 1))
    d = d.withColumns({"_first": first, "_last": last}).where("_first <= _last").withColumn("i", F.explode(F.sequence("_first", "_last")))
    gx = F.col("i").cast("double") * F.col("_gstep") + F.col("_glo")
    u = (gx - F.col("x")) / F.col("bw")
    terms = d.select("variable", group, "i", (F.col("_times") * F.exp(F.lit(-0.5) * u * u)).alias("_s"))
    # grid points far from every value: their density is 0
    whole = st.select("variable", group, F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))).alias("i"), F.lit(0.0).alias("_s"))
    sums = terms.unionByName(whole).groupBy("variable", group, "i").agg(F.sum("_s").alias("_s"))
    out = join_keys(sums, st, ["variable", group])
    grid_x = F.when(F.col("i") == gridsize - 1, F.col("_ghi")).otherwise(
        F.col("i").cast("double") * F.col("_gstep") + F.col("_glo"))
    norm = F.lit(1.0 / math.sqrt(2.0 * math.pi))
    dens = F.col("_s") * norm / (F.col("n") * F.col("bw"))
    return out.select("variable", group, F.col("i").cast("int").alias("i"), grid_x.alias("x"),
                      dens.alias("density"), (dens * F.col("n") / F.col("_ntot")).alias("density_common"),
                      F.col("n").cast("long").alias("n"), "bw")


def pair_bins(df: DataFrame, columns: Sequence[str], group: str, bins: int = 20) -> DataFrame:
    """2-D counts for each lower-triangle pair of ``columns`` per group (scatter data
    that scales): each variable is cut into ``bins`` equal bins over its global range."""
    columns = list(columns)
    d = df.withColumns({c: finite(c) for c in columns}).na.drop(how="any", subset=columns)
    st = d.agg(*[F.min(c).cast("double").alias(f"_mn_{k}") for k, c in enumerate(columns)],
               *[F.max(c).cast("double").alias(f"_mx_{k}") for k, c in enumerate(columns)])
    d = d.crossJoin(F.broadcast(st))
    bidx = {}
    for k, c in enumerate(columns):
        lo, hi = F.col(f"_mn_{k}"), F.col(f"_mx_{k}")
        bidx[k] = F.when(hi > lo, F.least(F.floor((F.col(c).cast("double") - lo) / (hi - lo) * F.lit(float(bins))),
                                          F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")
    pairs = [F.struct(F.lit(columns[j]).alias("x_var"), F.lit(columns[i]).alias("y_var"),
                      bidx[j].alias("x_bin"), bidx[i].alias("y_bin"))
             for i in range(len(columns)) for j in range(i)]
    e = d.select(group, F.explode(F.array(*pairs)).alias("_p")).select(group, "_p.*")
    return e.groupBy("x_var", "y_var", group, "x_bin", "y_bin").agg(F.count(F.lit(1)).alias("count"))
