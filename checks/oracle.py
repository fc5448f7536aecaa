"""DuckDB oracle SQL for every registered query (the tables are pre-registered views).

The SQL is written independently of the Spark plans: plain windows over whole
series (``row_number``, ``last_value IGNORE NULLS``), ``quantile_cont``,
inequality joins. Double columns are snapped to multiples of 2**-20 (as the Spark side).
"""

from __future__ import annotations

from voltframe.functions.columns import _ACKLAM_A, _ACKLAM_B, _ACKLAM_C, _ACKLAM_D, _ACKLAM_P_LOW

S, E = "TIMESTAMP '2024-01-15 00:00:00'", "TIMESTAMP '2024-01-19 00:00:00'"
D_LO, D_HI = "DATE '2024-01-15'", "DATE '2024-01-18'"


def inv_norm_cdf_sql(p: str) -> str:
    """The same approximation as SQL text (used by the DuckDB oracle)."""
    def horner(x, coeffs):
        acc = f"CAST({coeffs[0]!r} AS DOUBLE)"
        for c in coeffs[1:]:
            acc = f"({acc} * {x} + CAST({c!r} AS DOUBLE))"
        return acc
    a, b, c, d = _ACKLAM_A, _ACKLAM_B, _ACKLAM_C, _ACKLAM_D
    qlo = f"sqrt(-2.0 * ln({p}))"
    qhi = f"sqrt(-2.0 * ln(1.0 - {p}))"
    q = f"({p} - 0.5)"
    r = f"({q} * {q})"
    lower = f"({horner(qlo, c)} / ({horner(qlo, d)} * {qlo} + 1.0))"
    upper = f"(-{horner(qhi, c)} / ({horner(qhi, d)} * {qhi} + 1.0))"
    central = f"({horner(r, a)} * {q} / ({horner(r, b)} * {r} + 1.0))"
    return (f"(CASE WHEN {p} < {_ACKLAM_P_LOW!r} THEN {lower} "
            f"WHEN {p} > {1.0 - _ACKLAM_P_LOW!r} THEN {upper} ELSE {central} END)")


def rnd(cols, q, bits=20, fine=None):
    fine = fine or {}
    if not cols:
        return q

    def qz(c):
        b = fine.get(c, bits)
        s = f"CAST({2 ** b} AS DOUBLE)"
        return (f"CASE WHEN abs({c}) < CAST({2 ** (52 - b)} AS DOUBLE) THEN CAST(floor({c} * {s} + 0.5) AS DOUBLE) / {s} "
                f"ELSE {c} + 0.0 END")
    rep = ", ".join(f"{qz(c)} AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({q}) AS _q"


def with_(*ctes):
    return "WITH " + ",\n".join(ctes) + "\n"


# ------------------------------------------------------------------ inputs

EM_RAW = """em_raw AS (
  SELECT event_id AS row_id, CAST(date_trunc('minute', ts) AS TIMESTAMP) AS "timestamp",
         event_type AS region,
         CAST(CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 97 = 0 THEN value * 100
                   WHEN event_id % 89 = 0 THEN -value ELSE value END AS DOUBLE) AS value
  FROM events WHERE event_type <> 'purchase')"""

DM_RAW = """dm_raw AS (
  SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS "timestamp",
         'BA' || CAST(user_id % 3 AS VARCHAR) AS balancing_authority,
         TRY_CAST(CASE WHEN event_id % 11 = 0 THEN 'x' ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS demand_MW,
         event_id AS row_id
  FROM events WHERE event_type = 'purchase')"""

EM_DD = """em_dd AS (
  SELECT * EXCLUDE (_rk) FROM (
    SELECT *, row_number() OVER (PARTITION BY "timestamp", region ORDER BY row_id) AS _rk FROM em_raw)
  WHERE _rk = 1)"""

DM_DD = """dm_dd AS (
  SELECT * EXCLUDE (_rk) FROM (
    SELECT *, row_number() OVER (PARTITION BY "timestamp", balancing_authority ORDER BY row_id) AS _rk FROM dm_raw)
  WHERE _rk = 1)"""


def _part(keys):
    return f"PARTITION BY {', '.join(keys)}" if keys else ""


def _kl(keys, prefix=""):
    return "".join(f"{prefix}{k}, " for k in keys)


def impute_ctes(name, src, v, keys, ffill=2, limit=8):
    p = _part(keys)
    interp = (f"CASE WHEN {v} IS NOT NULL THEN {v} "
              f"WHEN _pvp IS NULL OR _pos - _pvp > {limit} THEN NULL "
              f"WHEN _nvp IS NULL THEN _pvv "
              f"ELSE ((_nvv - _pvv) / CAST(_nvp - _pvp AS DOUBLE)) * CAST(_pos - _pvp AS DOUBLE) + _pvv END")
    return [
        f"""{name}_o AS (SELECT *, row_number() OVER ({p} ORDER BY "timestamp", row_id) - 1 AS _pos FROM {src})""",
        f"""{name}_n AS (SELECT *,
   last_value(CASE WHEN {v} IS NOT NULL THEN _pos END IGNORE NULLS) OVER ({p} ORDER BY _pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _pvp,
   last_value({v} IGNORE NULLS) OVER ({p} ORDER BY _pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _pvv,
   first_value(CASE WHEN {v} IS NOT NULL THEN _pos END IGNORE NULLS) OVER ({p} ORDER BY _pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS _nvp,
   first_value({v} IGNORE NULLS) OVER ({p} ORDER BY _pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS _nvv,
   lag("timestamp") OVER ({p} ORDER BY _pos) AS _pts
 FROM {name}_o)""",
        f"""{name} AS (SELECT * EXCLUDE (_pos, _pvp, _pvv, _nvp, _nvv, _pts) REPLACE ({interp} AS {v}),
   (epoch_us("timestamp") - epoch_us(_pts)) / 1e6 AS time_diff,
   CASE WHEN {v} IS NOT NULL THEN {v} WHEN _pvp IS NOT NULL AND _pos - _pvp <= {ffill} THEN _pvv END AS {v}_ffill,
   ({v} IS NULL AND ({interp}) IS NOT NULL) AS {v}_is_interpolated
 FROM {name}_n)""",
    ]


def impossible_cte(name, src, v, lo, hi, flag="_impossible"):
    cond = " OR ".join(x for x in [f"{v} < {lo}" if lo is not None else "",
                                   f"{v} > {hi}" if hi is not None else ""] if x)
    return (f"{name} AS (SELECT * REPLACE (CASE WHEN {cond} THEN NULL ELSE {v} END AS {v}), "
            f"coalesce({cond}, false) AS {flag} FROM {src})")


def cap_ctes(name, src, v, keys, method="iqr", k=3.0):
    g = f"GROUP BY {', '.join(keys)}" if keys else ""
    if method == "iqr":
        b = (f"{name}_b AS (SELECT {_kl(keys)}_q1 - {k} * (_q3 - _q1) AS _lo, _q3 + {k} * (_q3 - _q1) AS _hi FROM "
             f"(SELECT {_kl(keys)}quantile_cont({v}, 0.25) AS _q1, quantile_cont({v}, 0.75) AS _q3 FROM {src} {g}))")
    else:
        b = (f"{name}_b AS (SELECT {_kl(keys)}_m - {k} * _s AS _lo, _m + {k} * _s AS _hi FROM "
             f"(SELECT {_kl(keys)}avg({v}) AS _m, stddev_samp({v}) AS _s FROM {src} {g}))")
    on = " AND ".join(f"s.{kk} = b.{kk}" for kk in keys) or "TRUE"
    c = (f"{name} AS (SELECT s.* REPLACE (CASE WHEN s.{v} < b._lo THEN b._lo WHEN s.{v} > b._hi THEN b._hi "
         f"ELSE s.{v} END AS {v}), s.{v} AS {v}_original, coalesce(s.{v} < b._lo OR s.{v} > b._hi, false) "
         f"AS {v}_is_outlier FROM {src} s LEFT JOIN {name}_b b ON {on})")
    return [b, c]


def grid_ctes(name, src, cols, keys, step=900, fill=True, drop_empty=False):
    us = step * 1_000_000
    g = f"GROUP BY {', '.join(keys)}" if keys else ""
    avgs = ", ".join(f"avg({c}) AS {c}" for c in cols)
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
    out = [f"""{name}_s AS (SELECT {_kl(keys)}epoch_us("timestamp") // {us} AS _slot, {casts} FROM {src} WHERE "timestamp" IS NOT NULL)""",
           f"""{name}_a AS (SELECT {_kl(keys)}_slot, {avgs} FROM {name}_s GROUP BY {_kl(keys)}_slot)"""]
    if fill:
        on = " AND ".join([f"g.{k} = a.{k}" for k in keys] + ["g._slot = a._slot"])
        out += [f"""{name}_sp AS (SELECT {_kl(keys)}min(_slot) AS _lo, max(_slot) AS _hi FROM {name}_s {g})""",
                f"""{name}_g AS (SELECT {_kl(keys)}unnest(range(_lo, _hi + 1)) AS _slot FROM {name}_sp)""",
                f"""{name} AS (SELECT {_kl(keys, 'g.')}make_timestamp(g._slot * {us}) AS "timestamp", """
                f"""{', '.join('a.' + c for c in cols)} FROM {name}_g g LEFT JOIN {name}_a a ON {on})"""]
    else:
        where = ("WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in cols)) if drop_empty else ""
        out += [f"""{name} AS (SELECT {_kl(keys)}make_timestamp(_slot * {us}) AS "timestamp", {', '.join(cols)} FROM {name}_a {where})"""]
    return out


CALENDAR = """CAST(hour("timestamp") AS INTEGER) AS hour, CAST(isodow("timestamp") - 1 AS INTEGER) AS day_of_week,
  CAST(month("timestamp") AS INTEGER) AS month,
  CAST(CASE WHEN isodow("timestamp") - 1 IN (5, 6) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
  CASE WHEN month("timestamp") IN (12, 1, 2) THEN 'winter' WHEN month("timestamp") IN (3, 4, 5) THEN 'spring'
       WHEN month("timestamp") IN (6, 7, 8) THEN 'summer' ELSE 'fall' END AS season"""


def features_cte(name, src, v, keys, windows=(24, 168), lags=(4, 24, 96), rows_per_hour=4, calendar=True):
    p = _part(keys)
    parts = []
    for h in windows:
        n = h * rows_per_hour
        b, f = n // 2, (n - 1) // 2
        w = f'({p} ORDER BY "timestamp" ROWS BETWEEN {b} PRECEDING AND {f} FOLLOWING)'
        parts.append(f"CASE WHEN count({v}) OVER {w} = {n} THEN avg({v}) OVER {w} END AS {v}_rolling_mean_{h}h")
        parts.append(f"CASE WHEN count({v}) OVER {w} = {n} THEN stddev_samp({v}) OVER {w} END AS {v}_rolling_std_{h}h")
    for k in lags:
        parts.append(f'lag({v}, {k}) OVER ({p} ORDER BY "timestamp") AS {v}_lag_{k}')
    cal = (CALENDAR + ",\n  ") if calendar else ""
    return f"{name} AS (SELECT *, {cal}{', '.join(parts)} FROM {src})"


def clean_chain(prefix, raw_cte, raw, dd_cte, dd, v, keys, lo, hi, k):
    cols = [v, f"{v}_ffill", f"{v}_is_interpolated", f"{v}_original", f"{v}_is_outlier"]
    return [raw_cte, dd_cte,
            *impute_ctes(f"{prefix}_imp", dd, v, keys),
            impossible_cte(f"{prefix}_cor", f"{prefix}_imp", v, lo, hi),
            *cap_ctes(f"{prefix}_cap", f"{prefix}_cor", v, keys, "iqr", k),
            *grid_ctes(f"{prefix}_grid", f"{prefix}_cap", cols, keys),
            features_cte(prefix, f"{prefix}_grid", v, keys)]


def E_CHAIN(keys=()):
    return clean_chain("e", EM_RAW, "em_raw", EM_DD, "em_dd", "value", list(keys), 0, 1500, 3.0)


D_CHAIN = clean_chain("d", DM_RAW, "dm_raw", DM_DD, "dm_dd", "demand_MW", [], 0, None, 3.5)

CLEAN_E_DOUBLES = ["value", "value_ffill", "value_is_interpolated", "value_original", "value_is_outlier",
                   "value_rolling_mean_24h", "value_rolling_std_24h", "value_rolling_mean_168h",
                   "value_rolling_std_168h", "value_lag_4", "value_lag_24", "value_lag_96"]
CLEAN_D_DOUBLES = [c.replace("value", "demand_MW") for c in CLEAN_E_DOUBLES]

MERGED = [
    """dh AS (SELECT "timestamp", demand_MW FROM d WHERE demand_MW IS NOT NULL)""",
    """el AS (SELECT "timestamp", value, hour, day_of_week, is_weekend, value_rolling_mean_24h, value_rolling_std_24h FROM e)""",
    """cand AS (SELECT el."timestamp" AS lt, dh.demand_MW,
        abs(epoch_us(el."timestamp") - epoch_us(dh."timestamp")) AS dist,
        CASE WHEN dh."timestamp" <= el."timestamp" THEN 0 ELSE 1 END AS side
      FROM el JOIN dh ON dh."timestamp" BETWEEN el."timestamp" - INTERVAL 30 MINUTE AND el."timestamp" + INTERVAL 30 MINUTE)""",
    """best AS (SELECT lt, demand_MW FROM (SELECT *, row_number() OVER (PARTITION BY lt ORDER BY dist, side) AS rk FROM cand) WHERE rk = 1)""",
    """merged AS (SELECT el.*, best.demand_MW FROM el LEFT JOIN best ON best.lt = el."timestamp"
        WHERE el.value IS NOT NULL AND best.demand_MW IS NOT NULL)""",
]
MERGED_DOUBLES = ["value", "value_rolling_mean_24h", "value_rolling_std_24h", "demand_MW"]

PERIOD = f"""CASE WHEN "timestamp" >= {S} AND "timestamp" < {E} THEN 'Heat Wave' ELSE 'Baseline' END"""
PHASE = f"""CASE WHEN "timestamp" < {S} THEN 'before' WHEN "timestamp" < {E} THEN 'during' WHEN "timestamp" IS NOT NULL THEN 'after' END"""

CATALOG = """cat AS (SELECT * FROM (VALUES
   (0, 'ice_line_icing', 'icing', TIMESTAMP '2024-01-06 03:00:00', TIMESTAMP '2024-01-09 15:00:00', 'click', 'severe', 31200, 'Line icing on the northern corridor'),
   (1, 'substation_fire', 'equipment', TIMESTAMP '2024-01-13 11:30:00', TIMESTAMP '2024-01-14 02:15:00', 'click', 'minor', 970, 'Transformer fire at one substation'),
   (2, NULL, 'flood', TIMESTAMP '2024-01-23 04:00:00', TIMESTAMP '2024-01-25 20:45:00', 'view', 'severe', 17450, 'River flood, entered without a catalog id'))
   AS t(catalog_pos, event_id, event_type, "start", "end", region, severity, affected_customers, description))"""

WIN = """win AS (SELECT catalog_pos, coalesce(event_id, 'event_' || CAST(catalog_pos AS VARCHAR)) AS event_id, region,
   "start" - INTERVAL 7 DAY AS window_lo, "end" + INTERVAL 7 DAY AS window_hi FROM cat)"""


# ------------------------------------------------------------------ statistics helpers

def hist_sql(src, value, keys, bins, density=False):
    """numpy equal-width bins over each group's [min, max] (min == max -> +/- 0.5)."""
    kl = _kl(keys)
    g = f"GROUP BY {', '.join(keys)}" if keys else ""
    on = " AND ".join(f"hv.{k} = hs.{k}" for k in keys) or "TRUE"
    B = f"CAST({bins} AS DOUBLE)"
    edge = lambda k: f"(CASE WHEN {k} >= {bins} THEN _hi ELSE _lo + CAST({k} AS DOUBLE) * _step END)"
    q = with_(
        f"hv AS (SELECT {kl}CAST({value} AS DOUBLE) AS _v FROM {src} WHERE {value} IS NOT NULL)",
        f"hs0 AS (SELECT {kl}count(*) AS n, min(_v) AS _mn, max(_v) AS _mx FROM hv {g})",
        f"hs AS (SELECT {kl}n, CASE WHEN _mx > _mn THEN _mn ELSE _mn - 0.5 END AS _lo, "
        f"CASE WHEN _mx > _mn THEN _mx ELSE _mx + 0.5 END AS _hi FROM hs0)",
        f"hs2 AS (SELECT *, (_hi - _lo) / {B} AS _step FROM hs)",
        f"hb0 AS (SELECT {_kl(keys, 'hv.')}hv._v, _lo, _hi, _step, least(greatest(CAST(floor((_v - _lo) * ({B} / (_hi - _lo))) AS BIGINT), 0), {bins - 1}) AS _i0 "
        f"FROM hv JOIN hs2 ON {on.replace('hs.', 'hs2.')})",
        f"hb1 AS (SELECT *, CASE WHEN _v < {edge('_i0')} THEN _i0 - 1 ELSE _i0 END AS _i1 FROM hb0)",
        f"hb2 AS (SELECT *, CASE WHEN _hi > _lo THEN (CASE WHEN _i1 < {bins - 1} AND _v >= {edge('_i1 + 1')} THEN _i1 + 1 ELSE _i1 END) ELSE 0 END AS bin FROM hb1)",
        f"hc AS (SELECT {kl}bin, count(*) AS cnt FROM hb2 GROUP BY {kl}bin)",
        f"allb AS (SELECT {kl}n, _lo, _hi, _step, unnest(range(0, {bins})) AS bin FROM hs2)",
    )
    j = " AND ".join([f"allb.{k} = hc.{k}" for k in keys] + ["allb.bin = hc.bin"])
    dens = f", coalesce(cnt, 0) / (n * _step) AS density" if density else ""
    q += (f"SELECT {_kl(keys, 'allb.')}CAST(allb.bin AS INTEGER) AS bin, {edge('allb.bin')} AS bin_lo, "
          f"{edge('allb.bin + 1')} AS bin_hi, CAST(coalesce(cnt, 0) AS BIGINT) AS count, CAST(n AS BIGINT) AS n{dens} "
          f"FROM allb LEFT JOIN hc ON {j}")
    return q


def box_sql(src, value, keys):
    kl = _kl(keys)
    g = f"GROUP BY {', '.join(keys)}" if keys else ""
    using = f"USING ({', '.join(keys)})" if keys else "ON TRUE"
    gb = f"GROUP BY {', '.join('bx.' + k for k in keys)}" if keys else ""
    q = with_(
        f"bx AS (SELECT {kl}{value} AS v FROM {src} WHERE {value} IS NOT NULL)",
        f"bq AS (SELECT {kl}count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, "
        f"quantile_cont(v, 0.75) AS q3 FROM bx {g})",
        "bq2 AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS _lov, q3 + 1.5 * (q3 - q1) AS _hiv FROM bq)",
        f"bw AS (SELECT {_kl(keys, 'bx.')}max(CASE WHEN v <= _hiv THEN v END) AS _wh, "
        f"min(CASE WHEN v >= _lov THEN v END) AS _wl, avg(v) AS mean FROM bx JOIN bq2 {using} {gb})",
        f"bo AS (SELECT bq2.*, bw.mean, CASE WHEN _wh IS NULL OR _wh < q3 THEN q3 ELSE _wh END AS whishi, "
        f"CASE WHEN _wl IS NULL OR _wl > q1 THEN q1 ELSE _wl END AS whislo FROM bq2 JOIN bw {using})",
        f"bf AS (SELECT {_kl(keys, 'bx.')}count(CASE WHEN v < whislo OR v > whishi THEN 1 END) AS n_fliers "
        f"FROM bx JOIN bo {using} {gb})",
    )
    q += (f"SELECT {_kl(keys, 'bo.')}CAST(n AS BIGINT) AS n, mean, q1, median, q3, iqr, whislo, whishi, "
          f"CAST(coalesce(n_fliers, 0) AS BIGINT) AS n_fliers FROM bo LEFT JOIN bf {using}")
    return q


def safe_corr(x, y):
    return f"(covar_pop({x}, {y}) / NULLIF(stddev_pop({x}) * stddev_pop({y}), 0))"


CORR_COLS = ["value", "demand_MW", "hour", "day_of_week", "is_weekend", "value_rolling_mean_24h",
             "value_rolling_std_24h"]
CORR_LABELS = ["CO2 MOER", "Demand MW", "Hour", "Day of Week", "Is Weekend", "MOER Roll Mean 24h",
               "MOER Roll Std 24h"]
PAIR_COLS = ["value", "demand_MW", "hour", "day_of_week", "value_rolling_mean_24h"]


def corr_sql(src):
    cols = CORR_COLS
    aggs = ", ".join(f"{safe_corr(f'CAST({cols[i]} AS DOUBLE)', f'CAST({cols[j]} AS DOUBLE)')} AS r_{i}_{j}"
                     for i in range(len(cols)) for j in range(i, len(cols)))
    nn = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    sel = []
    for i in range(len(cols)):
        for j in range(len(cols)):
            a, b = min(i, j), max(i, j)
            sel.append(f"SELECT {i} AS i, {j} AS j, '{CORR_LABELS[i]}' AS row_label, '{CORR_LABELS[j]}' AS col_label, "
                       f"r_{a}_{b} AS r, {i} > {j} AS shown FROM cm")
    return with_(f"cm AS (SELECT {aggs} FROM {src} WHERE {nn})") + " UNION ALL ".join(sel)


def qq_sql(src_cte_name):
    """src has (subset, value); positions by row_number over value within subset."""
    m = ("CASE WHEN i = 1 THEN 1.0 - pow(0.5, 1.0 / CAST(n AS DOUBLE)) "
         "WHEN i = n THEN pow(0.5, 1.0 / CAST(n AS DOUBLE)) "
         "ELSE (CAST(i AS DOUBLE) - 0.3175) / (CAST(n AS DOUBLE) + 0.365) END")
    return (f"SELECT subset, i, n, {inv_norm_cdf_sql('_m')} AS osm, osr FROM ("
            f"SELECT subset, i, n, osr, CAST({m} AS DOUBLE) AS _m FROM ("
            f"SELECT subset, row_number() OVER (PARTITION BY subset ORDER BY value) AS i, "
            f"count(*) OVER (PARTITION BY subset) AS n, CAST(value AS DOUBLE) AS osr FROM {src_cte_name} "
            f"WHERE value IS NOT NULL))")


QQ_SRC = f"""qs AS (SELECT 'All Periods' AS subset, value FROM e UNION ALL
  SELECT 'Heat Wave' AS subset, value FROM e WHERE "timestamp" >= {S} AND "timestamp" < {E})"""


def _kde_tail(group, gridsize=200, cut=3.0):
    """KDE over a CTE ``m(variable, <group>, x)`` of non-null values."""
    return with_(
        f"st0 AS (SELECT variable, {group}, count(*) AS n, stddev_samp(x) AS _sd, min(x) AS _mn, max(x) AS _mx FROM m GROUP BY 1, 2)",
        "tot AS (SELECT variable, sum(n) AS _ntot FROM st0 GROUP BY 1)",
        "st AS (SELECT st0.*, _ntot, _sd * pow(CAST(n AS DOUBLE), -0.2) AS bw FROM st0 JOIN tot USING (variable))",
        f"st2 AS (SELECT *, _mn - {cut} * bw AS _glo, _mx + {cut} * bw AS _ghi FROM st)",
        f"st3 AS (SELECT *, (_ghi - _glo) / CAST({gridsize - 1} AS DOUBLE) AS _gstep FROM st2 WHERE bw > 0)",
        f"g AS (SELECT variable, {group}, unnest(range(0, {gridsize})) AS i FROM st3)",
        f"sums AS (SELECT g.variable, g.{group}, g.i, sum(exp(-0.5 * ((CAST(g.i AS DOUBLE) * st3._gstep + st3._glo - m.x) / st3.bw) "
        f"* ((CAST(g.i AS DOUBLE) * st3._gstep + st3._glo - m.x) / st3.bw))) AS _s "
        f"FROM g JOIN st3 USING (variable, {group}) JOIN m ON m.variable = g.variable AND m.{group} = g.{group} "
        f"GROUP BY 1, 2, 3)") + (
        f"SELECT variable, {group}, CAST(i AS INTEGER) AS i, "
        f"CASE WHEN i = {gridsize - 1} THEN _ghi ELSE CAST(i AS DOUBLE) * _gstep + _glo END AS x, "
        f"_s * (1.0 / sqrt(2.0 * pi())) / (n * bw) AS density, "
        f"(_s * (1.0 / sqrt(2.0 * pi())) / (n * bw)) * n / _ntot AS density_common, CAST(n AS BIGINT) AS n, bw "
        f"FROM sums JOIN st3 USING (variable, {group})")


def kde_sql(gridsize=200, cut=3.0):
    melt = " UNION ALL ".join(f"SELECT '{c}' AS variable, period, CAST({c} AS DOUBLE) AS x FROM pd"
                              for c in PAIR_COLS)
    return with_(*E_CHAIN(), *D_CHAIN, *MERGED,
                 f"pd AS (SELECT {', '.join(PAIR_COLS)}, {PERIOD} AS period FROM merged WHERE "
                 + " AND ".join(f"{c} IS NOT NULL" for c in PAIR_COLS) + ")",
                 f"m AS ({melt})",
                 "st0 AS (SELECT variable, period, count(*) AS n, stddev_samp(x) AS _sd, min(x) AS _mn, max(x) AS _mx FROM m GROUP BY 1, 2)",
                 "tot AS (SELECT variable, sum(n) AS _ntot FROM st0 GROUP BY 1)",
                 f"st AS (SELECT st0.*, _ntot, _sd * pow(CAST(n AS DOUBLE), -0.2) AS bw FROM st0 JOIN tot USING (variable))",
                 f"st2 AS (SELECT *, _mn - {cut} * bw AS _glo, _mx + {cut} * bw AS _ghi FROM st)",
                 f"st3 AS (SELECT *, (_ghi - _glo) / CAST({gridsize - 1} AS DOUBLE) AS _gstep FROM st2 WHERE bw > 0)",
                 f"g AS (SELECT variable, period, unnest(range(0, {gridsize})) AS i FROM st3)",
                 "sums AS (SELECT g.variable, g.period, g.i, sum(exp(-0.5 * ((CAST(g.i AS DOUBLE) * st3._gstep + st3._glo - m.x) / st3.bw) "
                 "* ((CAST(g.i AS DOUBLE) * st3._gstep + st3._glo - m.x) / st3.bw))) AS _s "
                 "FROM g JOIN st3 USING (variable, period) JOIN m ON m.variable = g.variable AND m.period = g.period "
                 "GROUP BY 1, 2, 3)",
                 ) + (
        f"SELECT variable, period, CAST(i AS INTEGER) AS i, "
        f"CASE WHEN i = {gridsize - 1} THEN _ghi ELSE CAST(i AS DOUBLE) * _gstep + _glo END AS x, "
        f"_s * (1.0 / sqrt(2.0 * pi())) / (n * bw) AS density, "
        f"(_s * (1.0 / sqrt(2.0 * pi())) / (n * bw)) * n / _ntot AS density_common, CAST(n AS BIGINT) AS n, bw "
        f"FROM sums JOIN st3 USING (variable, period)")


def pair_bins_sql(bins=20):
    cols = PAIR_COLS
    mins = ", ".join(f"CAST(min({c}) AS DOUBLE) AS _mn_{k}, CAST(max({c}) AS DOUBLE) AS _mx_{k}" for k, c in enumerate(cols))
    bidx = {k: (f"CAST(CASE WHEN _mx_{k} > _mn_{k} THEN least(floor((CAST({c} AS DOUBLE) - _mn_{k}) / (_mx_{k} - _mn_{k}) "
                f"* CAST({bins} AS DOUBLE)), {bins - 1}) ELSE 0 END AS INTEGER)") for k, c in enumerate(cols)}
    sel = " UNION ALL ".join(
        f"SELECT '{cols[j]}' AS x_var, '{cols[i]}' AS y_var, period, {bidx[j]} AS x_bin, {bidx[i]} AS y_bin FROM pd, pst"
        for i in range(len(cols)) for j in range(i))
    return with_(*E_CHAIN(), *D_CHAIN, *MERGED,
                 f"pd AS (SELECT {', '.join(cols)}, {PERIOD} AS period FROM merged WHERE "
                 + " AND ".join(f"{c} IS NOT NULL" for c in cols) + ")",
                 f"pst AS (SELECT {mins} FROM pd)",
                 f"pb AS ({sel})") + \
        "SELECT x_var, y_var, period, x_bin, y_bin, count(*) AS count FROM pb GROUP BY ALL"


def dow_hour_sql(src, v):
    hours = ", ".join(f"avg(CASE WHEN hour = {h} THEN {v} END) AS h{h}" for h in range(24))
    return (f"SELECT CAST(day_of_week AS INTEGER) AS day_of_week, "
            f"['Mon','Tue','Wed','Thu','Fri','Sat','Sun'][day_of_week + 1] AS day_label, {hours} "
            f"FROM {src} GROUP BY day_of_week")


def daily_sql(src, v, how, out):
    agg = {"max": f"max({v})", "sum": f"coalesce(sum({v}), 0.0)", "range": f"max({v}) - min({v})"}[how]
    return (f"SELECT CAST(CAST(\"timestamp\" AS DATE) AS TIMESTAMP) AS date, CAST({agg} AS DOUBLE) AS {out} "
            f"FROM {src} GROUP BY 1")


# ------------------------------------------------------------------ the registry

def _q():
    q = {}
    EC, DC = E_CHAIN(), D_CHAIN

    q["src_emissions_json"] = rnd(["value"], with_(EM_RAW) + 'SELECT row_id, "timestamp", region, value FROM em_raw')
    q["src_demand_pages"] = (
        "SELECT event_id AS row_id, strftime(date_trunc('hour', ts), '%Y-%m-%dT%H') AS period, "
        "'BA' || CAST(user_id % 3 AS VARCHAR) AS respondent, 'D' AS type, "
        "CASE WHEN event_id % 11 = 0 THEN 'x' ELSE CAST(value AS VARCHAR) END AS value "
        "FROM events WHERE event_type = 'purchase'")
    q["demand_standardize"] = rnd(["demand_MW"], with_(DM_RAW) + "SELECT * FROM dm_raw")
    q["parse_utc"] = ("SELECT event_id AS row_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts_hour, "
                      "CAST(date_trunc('second', ts) AS TIMESTAMP) AS ts_z, "
                      "CAST(date_trunc('second', ts) AS TIMESTAMP) - INTERVAL 2 HOUR AS ts_offset, "
                      "CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(date_trunc('second', ts) AS TIMESTAMP) END AS ts_lenient "
                      "FROM events")
    q["union_by_name"] = rnd(["value", "demand_MW"], with_(EM_RAW, DM_RAW) + (
        'SELECT row_id, "timestamp", region, value, NULL::VARCHAR AS balancing_authority, NULL::DOUBLE AS demand_MW, '
        "'emissions' AS series FROM em_raw UNION ALL "
        'SELECT row_id, "timestamp", NULL::VARCHAR, NULL::DOUBLE, balancing_authority, demand_MW, '
        "'demand' FROM dm_raw"))

    q["dedupe_first"] = rnd(["value"], with_(EM_RAW, EM_DD) + "SELECT * FROM em_dd")
    q["time_gap"] = rnd(["value", "time_diff"], with_(EM_RAW, EM_DD) + (
        'SELECT *, (epoch_us("timestamp") - epoch_us(lag("timestamp") OVER (PARTITION BY region ORDER BY "timestamp", row_id))) / 1e6 '
        "AS time_diff FROM em_dd"))
    imp_r = [EM_RAW, EM_DD, *impute_ctes("imp", "em_dd", "value", ["region"])]
    q["impute_linear"] = rnd(["value", "time_diff", "value_ffill"], with_(*imp_r) + "SELECT * FROM imp")
    cor_r = [*imp_r, impossible_cte("cor", "imp", "value", 0, 1500, flag="corrected")]
    q["impossible_to_null"] = rnd(["value"], with_(*cor_r) + 'SELECT row_id, "timestamp", region, value, corrected FROM cor')
    for meth in ("iqr", "zscore"):
        q[f"outliers_{meth}"] = rnd(["value", "value_original"], with_(
            *cor_r, *cap_ctes("cap", "cor", "value", ["region"], meth, 3.0)) +
            'SELECT row_id, "timestamp", region, value, value_original, value_is_outlier FROM cap')
    q["quartiles"] = rnd(["q1", "median", "q3"], with_(EM_RAW) + (
        "SELECT region, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, "
        "quantile_cont(value, 0.75) AS q3, count(value) AS n FROM em_raw GROUP BY region"))
    grid_r = [EM_RAW, *grid_ctes("g", "em_raw", ["value"], ["region"])]
    q["resample_15m"] = rnd(["value"], with_(*grid_r) + "SELECT * FROM g")
    q["resample_1h"] = rnd(["demand_MW"], with_(DM_RAW, *grid_ctes("g", "dm_raw", ["demand_MW"], ["balancing_authority"],
                                                                  step=3600, fill=False, drop_empty=True)) + "SELECT * FROM g")
    q["temporal_features"] = rnd(["value"], with_(*grid_r) + f"SELECT *, {CALENDAR} FROM g")
    q["rolling_features"] = rnd(["value", "value_rolling_mean_24h", "value_rolling_std_24h", "value_rolling_mean_168h",
                                 "value_rolling_std_168h"],
                                with_(*grid_r, features_cte("f", "g", "value", ["region"], lags=(), calendar=False))
                                + "SELECT * FROM f")
    q["lag_features"] = rnd(["value", "value_lag_4", "value_lag_24", "value_lag_96"],
                            with_(*grid_r, features_cte("f", "g", "value", ["region"], windows=(), calendar=False))
                            + "SELECT * FROM f")
    q["normalize_zscore"] = rnd(["value", "value_normalized", "user_id_normalized"], (
        "SELECT event_id, value, user_id, (value - avg(value) OVER ()) / NULLIF(stddev_samp(value) OVER (), 0) AS value_normalized, "
        "(CAST(user_id AS DOUBLE) - avg(user_id) OVER ()) / NULLIF(stddev_samp(user_id) OVER (), 0) AS user_id_normalized FROM events"))
    q["normalize_minmax"] = rnd(["value", "value_normalized", "user_id_normalized"], (
        "SELECT event_id, value, user_id, (value - min(value) OVER ()) / NULLIF(max(value) OVER () - min(value) OVER (), 0) AS value_normalized, "
        "(CAST(user_id AS DOUBLE) - CAST(min(user_id) OVER () AS DOUBLE)) / NULLIF(CAST(max(user_id) OVER () AS DOUBLE) - CAST(min(user_id) OVER () AS DOUBLE), 0) "
        "AS user_id_normalized FROM events"))
    q["scaling_params"] = rnd(["value"], (
        "SELECT 'value' AS \"column\", 'mean' AS stat, avg(value) AS value FROM events UNION ALL "
        "SELECT 'value', 'std', stddev_samp(value) FROM events UNION ALL "
        "SELECT 'user_id', 'mean', avg(user_id) FROM events UNION ALL "
        "SELECT 'user_id', 'std', stddev_samp(user_id) FROM events"))
    q["asof_nearest"] = rnd(["value", "demand_MW"], with_(EM_RAW, DM_RAW,
        """c AS (SELECT l.row_id, r.demand_MW, r.row_id AS d_row_id, r."timestamp" AS d_timestamp,
             abs(epoch_us(l."timestamp") - epoch_us(r."timestamp")) AS dist,
             CASE WHEN r."timestamp" <= l."timestamp" THEN 0 ELSE 1 END AS side
           FROM em_raw l JOIN dm_raw r ON r."timestamp" BETWEEN l."timestamp" - INTERVAL 30 MINUTE AND l."timestamp" + INTERVAL 30 MINUTE)""",
        """b AS (SELECT row_id, demand_MW, d_timestamp FROM (SELECT *, row_number() OVER (PARTITION BY row_id
             ORDER BY dist, side, CASE WHEN side = 0 THEN -d_row_id ELSE d_row_id END) AS rk FROM c) WHERE rk = 1)""")
        + "SELECT l.*, b.demand_MW, b.d_timestamp FROM em_raw l LEFT JOIN b USING (row_id)")

    q["emissions_pipeline"] = rnd(CLEAN_E_DOUBLES, with_(*EC) + "SELECT * FROM e")
    q["emissions_pipeline_by_region"] = rnd(CLEAN_E_DOUBLES, with_(*E_CHAIN(["region"])) + "SELECT * FROM e")
    q["demand_pipeline"] = rnd(CLEAN_D_DOUBLES, with_(*DC) + "SELECT * FROM d")
    q["cleaning_metrics"] = with_(*EC, *DC) + (
        "SELECT 'emissions' AS dataset, (SELECT count(*) FROM em_raw) - (SELECT count(*) FROM em_dd) AS duplicates_removed, "
        "CAST((SELECT count_if(value_is_interpolated) FROM e_imp) AS BIGINT) AS missing_imputed, "
        "CAST((SELECT count_if(_impossible) FROM e_cor) + (SELECT count_if(value_is_outlier) FROM e_cap) AS BIGINT) AS outliers_corrected, "
        "CAST(0 AS BIGINT) AS records_flagged UNION ALL "
        "SELECT 'demand', (SELECT count(*) FROM dm_raw) - (SELECT count(*) FROM dm_dd), "
        "CAST((SELECT count_if(demand_MW_is_interpolated) FROM d_imp) AS BIGINT), "
        "CAST((SELECT count_if(_impossible) FROM d_cor) + (SELECT count_if(demand_MW_is_outlier) FROM d_cap) AS BIGINT), CAST(0 AS BIGINT)")
    qr = ("SELECT '{n}' AS dataset, count(*) AS total_records, strftime(min(\"timestamp\"), '%Y-%m-%d %H:%M:%S') || '+00:00 to ' "
          "|| strftime(max(\"timestamp\"), '%Y-%m-%d %H:%M:%S') || '+00:00' AS date_range, avg({v}) AS mean, "
          "stddev_samp({v}) AS std, (count(*) - count({v})) * 100.0 / NULLIF(count(*), 0) AS missing_pct FROM {t}")
    q["quality_report"] = rnd(["mean", "std", "missing_pct"], with_(*EC, *DC) +
                              qr.format(n="emissions", v="value", t="e") + " UNION ALL " +
                              qr.format(n="demand", v="demand_MW", t="d"))
    q["analysis_base"] = rnd(MERGED_DOUBLES, with_(*EC, *DC, *MERGED) + "SELECT * FROM merged")

    q["event_window_join"] = rnd(["value"], with_(EM_RAW, CATALOG, WIN) + (
        'SELECT s.*, w.event_id, w.window_lo, w.window_hi FROM em_raw s JOIN win w ON s.region = w.region '
        'AND s."timestamp" >= w.window_lo AND s."timestamp" <= w.window_hi'))
    q["event_collection"] = rnd(["value", "demand_MW"], with_(EM_RAW, DM_RAW, CATALOG, WIN,
        "wc AS (SELECT * FROM win WHERE region = 'click')") + (
        'SELECT s.row_id, s."timestamp", s.region, s.value, NULL::VARCHAR AS balancing_authority, NULL::DOUBLE AS demand_MW, '
        "w.event_id, 'emissions' AS series FROM em_raw s JOIN wc w ON s.region = w.region "
        'AND s."timestamp" >= w.window_lo AND s."timestamp" <= w.window_hi UNION ALL '
        'SELECT d.row_id, d."timestamp", NULL, NULL, d.balancing_authority, d.demand_MW, w.event_id, \'demand\' '
        "FROM dm_raw d JOIN wc w ON d.balancing_authority = 'BA0' "
        'AND CAST(d."timestamp" AS DATE) BETWEEN CAST(w.window_lo AS DATE) AND CAST(w.window_hi AS DATE)'))
    tagged = ('tg AS (SELECT s.*, w.event_id FROM em_raw s JOIN win w ON s.region = w.region '
              'AND s."timestamp" >= w.window_lo AND s."timestamp" <= w.window_hi)')
    q["event_windows"] = rnd(["mean_value"], with_(EM_RAW, CATALOG, WIN, tagged) + (
        "SELECT w.event_id, strftime(window_lo, '%Y-%m-%dT%H:%M:%SZ') AS window_lo_iso, "
        "strftime(window_hi, '%Y-%m-%dT%H:%M:%SZ') AS window_hi_iso, strftime(window_lo, '%Y-%m-%d') AS window_lo_day, "
        "strftime(window_hi, '%Y-%m-%d') AS window_hi_day, c.n_rows, c.mean_value FROM win w LEFT JOIN "
        "(SELECT event_id, count(*) AS n_rows, avg(value) AS mean_value FROM tg GROUP BY 1) c USING (event_id)"))
    q["event_impact_ranking"] = rnd(["total_value", "mean_value"], with_(EM_RAW, CATALOG, WIN, tagged) + (
        "SELECT *, CAST(rank() OVER (ORDER BY total_value DESC) AS INTEGER) AS impact_rank FROM ("
        "SELECT event_id, coalesce(sum(value), 0.0) AS total_value, avg(value) AS mean_value, count(*) AS n_rows "
        "FROM tg GROUP BY event_id)"))

    q["event_slice"] = rnd(["value"], with_(*EC) + f'SELECT "timestamp", value FROM e WHERE "timestamp" >= {S} AND "timestamp" < {E}')
    q["drop_missing"] = rnd(["demand_MW"], with_(*DC) + 'SELECT "timestamp", demand_MW FROM d WHERE demand_MW IS NOT NULL')
    q["period_label"] = rnd(["value"], with_(*EC) + f'SELECT "timestamp", value, {PERIOD} AS period FROM e')
    q["phase_split_stats"] = rnd(["mean", "std"], with_(*EC) + (
        f"SELECT phase, count(*) AS n, avg(value) AS mean, stddev_samp(value) AS std FROM "
        f"(SELECT {PHASE} AS phase, value FROM e WHERE value IS NOT NULL) GROUP BY phase"))
    q["sort_time"] = rnd(["value"], with_(*EC) + 'SELECT "timestamp", value FROM e ORDER BY "timestamp"')
    q["histogram_40"] = rnd(["bin_lo", "bin_hi"], with_(*EC).rstrip() + ", " + hist_sql("e", "value", [], 40)[5:])
    q["histogram_density_phase"] = rnd(["bin_lo", "bin_hi", "density"], with_(
        *EC, f"ep AS (SELECT {PHASE} AS phase, value FROM e)").rstrip() + ", " + hist_sql("ep", "value", ["phase"], 30, True)[5:])
    q["box_stats"] = rnd(["mean", "q1", "median", "q3", "iqr", "whislo", "whishi"], with_(
        *EC, f"ebp AS (SELECT {PERIOD} AS period, value FROM e)").rstrip() + ", " + box_sql("ebp", "value", ["period"])[5:])
    q["box_fliers"] = rnd(["value"], with_(
        *EC, f"ebp AS (SELECT \"timestamp\", value, {PERIOD} AS period FROM e)",
        f"bstat AS ({box_sql('ebp', 'value', ['period'])})") + (
        'SELECT x."timestamp", x.value, x.period FROM ebp x JOIN bstat b USING (period) '
        "WHERE x.value IS NOT NULL AND (x.value < b.whislo OR x.value > b.whishi)"))
    q["regional_box_stats"] = rnd(["mean", "q1", "median", "q3", "iqr", "whislo", "whishi"],
                                  with_(EM_RAW).rstrip() + ", " + box_sql("em_raw", "value", ["region"])[5:])
    q["distribution_summary"] = rnd(["mean", "std", "min", "max", "median"], with_(*EC) + (
        "SELECT count(value) AS n, avg(value) AS mean, stddev_samp(value) AS std, CAST(min(value) AS DOUBLE) AS min, "
        "CAST(max(value) AS DOUBLE) AS max, quantile_cont(value, 0.5) AS median FROM e"))
    q["corr_matrix"] = rnd(["r"], with_(*EC, *DC, *MERGED).rstrip() + ", " + corr_sql("merged")[5:])
    q["period_corr"] = rnd(["r"], with_(*EC, *DC, *MERGED) + (
        f"SELECT period, {safe_corr('value', 'demand_MW')} AS r, count(*) AS n FROM "
        f"(SELECT {PERIOD} AS period, value, demand_MW FROM merged) GROUP BY period"))
    peaks = [f"pe AS ({daily_sql('e', 'value', 'max', 'peak_moer')})",
             f"pdm AS ({daily_sql('d', 'demand_MW', 'max', 'peak_demand')})",
             f"pk AS (SELECT date, peak_moer, peak_demand, date BETWEEN {D_LO} AND {D_HI} AS is_event FROM pe JOIN pdm USING (date))"]
    q["daily_peak_join"] = rnd(["peak_moer", "peak_demand"], with_(*EC, *DC, *peaks) + "SELECT * FROM pk")
    fit = ("fit AS (SELECT regr_slope(peak_moer, peak_demand) AS slope, regr_intercept(peak_moer, peak_demand) AS intercept, "
           f"{safe_corr('peak_demand', 'peak_moer')} AS r, count(*) AS n, CAST(min(peak_demand) AS DOUBLE) AS x_min, "
           "CAST(max(peak_demand) AS DOUBLE) AS x_max FROM pk WHERE peak_moer IS NOT NULL AND peak_demand IS NOT NULL)")
    q["linreg_peak"] = rnd(["slope", "intercept", "r", "x_min", "x_max"], with_(*EC, *DC, *peaks, fit) + "SELECT * FROM fit")
    q["trend_line"] = rnd(["x", "y"], with_(*EC, *DC, *peaks, fit,
        "tl AS (SELECT CAST(i AS INTEGER) AS i, CASE WHEN i = 99 THEN x_max ELSE CAST(i AS DOUBLE) * ((x_max - x_min) / 99.0) + x_min END AS x, "
        "slope, intercept FROM (SELECT *, unnest(range(0, 100)) AS i FROM fit))") +
        "SELECT i, x, slope * x + intercept AS y FROM tl")
    for key, how, out in (("daily_range", "range", "daily_range"), ("daily_total", "sum", "daily_total")):
        q[key] = rnd([out], with_(*EC, f"dd AS ({daily_sql('e', 'value', how, out)})") + (
            f"SELECT date, {out}, CAST(row_number() OVER (ORDER BY date) - 1 AS INTEGER) AS day_index, "
            f"date BETWEEN {D_LO} AND {D_HI} AS is_event FROM dd"))
    q["running_total"] = rnd(["value", "cum_moer"], with_(*EC) + (
        'SELECT "timestamp", value, CASE WHEN value IS NOT NULL THEN sum(value) OVER (ORDER BY "timestamp" '
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS cum_moer FROM e"))
    q["seasonal_decompose"] = rnd(["observed", "trend", "seasonal", "resid"], with_(
        *DC, *grid_ctes("dh1", "d", ["demand_MW"], [], step=3600, fill=False, drop_empty=True),
        'sp AS (SELECT "timestamp", demand_MW, row_number() OVER (ORDER BY "timestamp") - 1 AS pos FROM dh1)',
        """st AS (SELECT *, CASE WHEN count(demand_MW) OVER (ORDER BY pos ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING) = 25
             THEN (avg(demand_MW) OVER (ORDER BY pos ROWS BETWEEN 12 PRECEDING AND 11 FOLLOWING)
                 + avg(demand_MW) OVER (ORDER BY pos ROWS BETWEEN 11 PRECEDING AND 12 FOLLOWING)) / 2.0 END AS trend,
             CAST(pos % 24 AS INTEGER) AS phase FROM sp)""",
        "ph AS (SELECT phase, avg(demand_MW - trend) AS _pm FROM st GROUP BY phase)",
        "ph2 AS (SELECT phase, _pm - avg(_pm) OVER () AS seasonal FROM ph)") + (
        'SELECT "timestamp", pos, demand_MW AS observed, trend, seasonal, demand_MW - trend - seasonal AS resid '
        "FROM st JOIN ph2 USING (phase)"))
    q["qq_points"] = rnd(["osm", "osr"], with_(*EC, QQ_SRC) + qq_sql("qs"))
    q["qq_fit"] = rnd(["slope", "intercept", "r"], with_(*EC, QQ_SRC, f"qp AS ({qq_sql('qs')})") + (
        f"SELECT subset, regr_slope(osr, osm) AS slope, regr_intercept(osr, osm) AS intercept, "
        f"{safe_corr('osm', 'osr')} AS r, count(*) AS n FROM qp GROUP BY subset"))
    q["dow_hour_matrix"] = rnd([f"h{h}" for h in range(24)], with_(*EC) + dow_hour_sql("e", "value"))
    q["demand_dow_hour"] = rnd([f"h{h}" for h in range(24)], with_(*DC) + dow_hour_sql("d", "demand_MW"))
    q["pair_data"] = rnd(["value", "demand_MW", "value_rolling_mean_24h"], with_(*EC, *DC, *MERGED) + (
        f"SELECT {', '.join(PAIR_COLS)}, {PERIOD} AS period FROM merged WHERE "
        + " AND ".join(f"{c} IS NOT NULL" for c in PAIR_COLS)))
    q["pair_bins"] = pair_bins_sql()
    q["kde_by_period"] = rnd(["x", "density", "density_common", "bw"], kde_sql(),
                             fine={"density": 40, "density_common": 40})
    q["kde_by_region"] = rnd(["x", "density", "density_common", "bw"], with_(
        EM_RAW, "m AS (SELECT 'value' AS variable, region, CAST(value AS DOUBLE) AS x FROM em_raw WHERE value IS NOT NULL)")
        .rstrip() + ", " + _kde_tail("region")[5:], fine={"density": 40, "density_common": 40})
    pcols = ["value", "hour", "day_of_week"]
    bx = {k: (f"CAST(CASE WHEN _mx_{k} > _mn_{k} THEN least(floor((CAST({c} AS DOUBLE) - _mn_{k}) / (_mx_{k} - _mn_{k}) "
              f"* CAST(12 AS DOUBLE)), 11) ELSE 0 END AS INTEGER)") for k, c in enumerate(pcols)}
    q["pair_bins_by_region"] = with_(
        *grid_r, f"gf AS (SELECT *, {CALENDAR} FROM g)",
        "pd AS (SELECT * FROM gf WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in pcols) + ")",
        "pst AS (SELECT " + ", ".join(f"CAST(min({c}) AS DOUBLE) AS _mn_{k}, CAST(max({c}) AS DOUBLE) AS _mx_{k}"
                                    for k, c in enumerate(pcols)) + " FROM pd)",
        "pb AS (" + " UNION ALL ".join(
            f"SELECT '{pcols[j]}' AS x_var, '{pcols[i]}' AS y_var, region, {bx[j]} AS x_bin, {bx[i]} AS y_bin FROM pd, pst"
            for i in range(len(pcols)) for j in range(i)) + ")") + \
        "SELECT x_var, y_var, region, x_bin, y_bin, count(*) AS count FROM pb GROUP BY ALL"
    fcols = ["value", "value_original", "hour", "day_of_week", "value_lag_4", "value_lag_96"]
    aggs = ", ".join(f"{safe_corr(f'CAST({fcols[i]} AS DOUBLE)', f'CAST({fcols[j]} AS DOUBLE)')} AS r_{i}_{j}"
                     for i in range(len(fcols)) for j in range(i, len(fcols)))
    sel = " UNION ALL ".join(
        f"SELECT region, {i} AS i, {j} AS j, '{fcols[i]}' AS row_label, '{fcols[j]}' AS col_label, "
        f"r_{min(i, j)}_{max(i, j)} AS r, {i} > {j} AS shown FROM cm"
        for i in range(len(fcols)) for j in range(len(fcols)))
    q["feature_corr_by_region"] = rnd(["r"], with_(
        *E_CHAIN(["region"]), f"cm AS (SELECT region, {aggs} FROM e WHERE "
        + " AND ".join(f"{c} IS NOT NULL" for c in fcols) + " GROUP BY region)") + sel)
    q["src_csv_roundtrip"] = rnd(["value"], with_(EM_RAW) + 'SELECT row_id, "timestamp", region, value FROM em_raw')
    q["src_csv_bad_rows"] = rnd(["value"], with_(EM_RAW) + (
        "SELECT row_id, region, CASE WHEN value < 0 THEN NULL ELSE value END AS value, CASE WHEN value < 0 THEN 'value' END AS bad_fields FROM em_raw"))
    q["src_bad_bodies"] = with_(EM_RAW) + (
        "SELECT * FROM (SELECT row_id, CASE WHEN row_id % 17 = 0 THEN 'no data' WHEN row_id % 19 = 0 THEN 'malformed' "
        "WHEN row_id % 23 = 0 THEN 'empty' END AS reason FROM em_raw) WHERE reason IS NOT NULL")
    q["rolling_hourly"] = rnd(["value", "value_rolling_mean_6h", "value_rolling_std_6h", "value_rolling_mean_24h", "value_rolling_std_24h", "value_lag_1"],
                              with_(EM_RAW, *grid_ctes("g", "em_raw", ["value"], [], step=3600),
                                    features_cte("f", "g", "value", [], windows=(6, 24), lags=(1,), rows_per_hour=1, calendar=False)) + "SELECT * FROM f")
    q["quartiles_in_memory"] = q["quartiles"]
    q["event_collection_no_demand"] = rnd(["value"], with_(EM_RAW, CATALOG, WIN) + (
        'SELECT s.row_id, s."timestamp", s.region, s.value, w.event_id, \'emissions\' AS series FROM em_raw s JOIN win w ON s.region = w.region '
        'AND w.region = \'click\' AND s."timestamp" >= w.window_lo AND s."timestamp" <= w.window_hi'))
    q["sink_if_not_empty"] = with_(EM_RAW) + "SELECT row_id, region, false AS other_written FROM em_raw"
    q["report_json"] = q["quality_report"]
    return q


ORACLE = _q()

# ------------------------------------------------------------------ events, signatures, planted NaN

EM_N = """em_n AS (SELECT * REPLACE (CASE WHEN row_id % 31 = 0 THEN NULL ELSE value END AS value) FROM em_raw)"""

RUNS = ["""rs AS (SELECT *, coalesce(value > 60, false) AS up, lag("timestamp") OVER w AS tp, lag(coalesce(value > 60, false)) OVER w AS was
  FROM em_dd WINDOW w AS (PARTITION BY region ORDER BY "timestamp", row_id))""",
        """rn AS (SELECT *, sum(CASE WHEN up AND (was IS NULL OR NOT was OR epoch_us("timestamp") - epoch_us(tp) > 21600000000) THEN 1 ELSE 0 END)
  OVER (PARTITION BY region ORDER BY "timestamp", row_id) AS run FROM rs)""",
        """runs AS (SELECT region, min("timestamp") AS "start", max("timestamp") AS "end", count(*) AS n_rows,
  (epoch_us(max("timestamp")) - epoch_us(min("timestamp"))) / 1e6 AS duration_seconds, max(value) AS peak, avg(value) AS mean_value
  FROM rn WHERE up GROUP BY region, run)"""]

SIG = ("n_rows", "mean_value", "std_value", "peak")


def snap(e):
    return f"CAST(floor(({e}) * 1048576 + 0.5) AS DOUBLE) / 1048576"


def cluster_ctes(steps=6):
    """Lloyd steps written out one by one, from three fixed seeds in scaled units."""
    z = ", ".join(snap(f"({f} - avg({f}) OVER ()) / stddev_samp({f}) OVER ()") + f" AS x{i}" for i, f in enumerate(SIG))
    whole = " AND ".join(f"{f} IS NOT NULL" for f in SIG)
    d = " + ".join(f"(p.x{i} - c.x{i}) * (p.x{i} - c.x{i})" for i in range(4))
    out = ["""sig AS (SELECT region, CAST("timestamp" AS DATE) AS date, CAST(count(value) AS DOUBLE) AS n_rows, avg(value) AS mean_value,
  stddev_samp(value) AS std_value, max(value) AS peak FROM em_raw GROUP BY ALL)""",
           f"zs AS MATERIALIZED (SELECT region, date, {whole} AS whole, {z} FROM sig)",
           "pts AS MATERIALIZED (SELECT * FROM zs WHERE whole)",
           "c0 AS (SELECT * FROM (VALUES (0, -1.0::DOUBLE, -1.0::DOUBLE, -1.0::DOUBLE, -1.0::DOUBLE), (1, 0.0, 0.0, 0.0, 0.0), (2, 1.0, 1.0, 1.0, 1.0)) t(c, x0, x1, x2, x3))"]
    for s in range(steps + 1):
        out.append(f"a{s} AS MATERIALIZED (SELECT * EXCLUDE (rk) FROM (SELECT p.*, c.c, {d} AS d, row_number() OVER (PARTITION BY p.region, p.date ORDER BY {d}, c.c) AS rk "
                   f"FROM pts p, c{s} c) WHERE rk = 1)")
        if s < steps:
            means = ", ".join(f"coalesce(m.x{i}, c.x{i}) AS x{i}" for i in range(4))
            avgs = ", ".join(snap(f"avg(x{i})") + f" AS x{i}" for i in range(4))
            out.append(f"c{s + 1} AS MATERIALIZED (SELECT c.c, {means} FROM c{s} c LEFT JOIN (SELECT c, {avgs} FROM a{s} GROUP BY c) m USING (c))")
    return out


def more(q):
    q["event_runs"] = rnd(["duration_seconds", "peak", "mean_value"], with_(EM_RAW, EM_DD, *RUNS) + "SELECT * FROM runs")
    q["event_durations"] = rnd(["mean", "shortest", "longest", "q1", "median", "q3"], with_(EM_RAW, EM_DD, *RUNS) + (
        "SELECT region, avg(duration_seconds) AS mean, min(duration_seconds) AS shortest, max(duration_seconds) AS longest, "
        "CAST(sum(n_rows) AS BIGINT) AS n_rows, quantile_cont(duration_seconds, 0.25) AS q1, quantile_cont(duration_seconds, 0.5) AS median, "
        "quantile_cont(duration_seconds, 0.75) AS q3, count(*) AS n FROM runs GROUP BY region"))
    chain = with_(EM_RAW, *cluster_ctes())
    q["event_clusters"] = rnd(["distance2"], chain + (
        "SELECT z.region, CAST(z.date AS TIMESTAMP) AS date, CAST(a.c AS INTEGER) AS cluster, a.d AS distance2 FROM zs z LEFT JOIN a6 a USING (region, date)"))
    d2 = " + ".join(f"(p.x{i} - o.x{i}) * (p.x{i} - o.x{i})" for i in range(4))
    q["event_cluster_scores"] = rnd(["mean_distance2", "silhouette"], chain.rstrip() + f""",
  n AS (SELECT c, count(*) AS n FROM a6 GROUP BY c),
  far AS (SELECT p.region, p.date, p.c, p.d, o.c AS oc, sum({d2}) AS t FROM a6 p, a6 o GROUP BY ALL),
  ab AS (SELECT f.region, f.date, f.c, any_value(f.d) AS d, any_value(own.n) AS own_n,
    max(CASE WHEN f.oc = f.c AND own.n > 1 THEN f.t / (own.n - 1) END) AS a, min(CASE WHEN f.oc <> f.c THEN f.t / n.n END) AS b
    FROM far f JOIN n ON n.c = f.oc JOIN n own ON own.c = f.c GROUP BY f.region, f.date, f.c)
  SELECT CAST(c AS INTEGER) AS cluster, count(*) AS n, avg(d) AS mean_distance2,
    avg(CASE WHEN (SELECT count(*) FROM n) < 2 THEN NULL WHEN own_n = 1 THEN 0 WHEN greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0 END) AS silhouette
  FROM ab GROUP BY c""")
    em_n = with_(EM_RAW, EM_N).rstrip() + ", "
    q["nan_outliers_zscore"] = rnd(["value", "value_original"], with_(EM_RAW, EM_N).rstrip() + """, b AS (
      SELECT region, avg(value) - 2 * stddev_samp(value) AS lo, avg(value) + 2 * stddev_samp(value) AS hi FROM em_n GROUP BY region)
      SELECT row_id, "timestamp", region, CASE WHEN value < lo THEN lo WHEN value > hi THEN hi ELSE value END AS value, value AS value_original,
        coalesce(value < lo OR value > hi, false) AS value_is_outlier FROM em_n JOIN b USING (region)""")
    q["nan_box_stats"] = rnd(["mean", "q1", "median", "q3", "iqr", "whislo", "whishi"], em_n + box_sql("em_n", "value", ["region"])[5:])
    q["nan_histogram"] = rnd(["bin_lo", "bin_hi"], em_n + hist_sql("em_n", "value", ["region"], 20)[5:])
    q["nan_summary"] = rnd(["mean", "std", "min", "max", "median"], with_(EM_RAW, EM_N) + (
        "SELECT region, count(value) AS n, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, max(value) AS max, "
        "quantile_cont(value, 0.5) AS median FROM em_n GROUP BY region"))
    q["nan_resample_1h"] = rnd(["value"], with_(EM_RAW, EM_N, *grid_ctes("g", "em_n", ["value"], ["region"], step=3600, fill=False, drop_empty=True)) + "SELECT * FROM g")
    q["nan_normalize_minmax"] = rnd(["value_normalized"], with_(EM_RAW, EM_N) + (
        "SELECT row_id, (value - min(value) OVER ()) / (max(value) OVER () - min(value) OVER ()) AS value_normalized FROM em_n"))
    q["nan_daily_total"] = rnd(["total"], with_(EM_RAW, EM_N) + (
        'SELECT region, CAST(CAST("timestamp" AS DATE) AS TIMESTAMP) AS date, coalesce(sum(value), 0.0) AS total FROM em_n GROUP BY ALL'))
    pages = """rec AS (
  SELECT event_id, event_id // 100 AS page, 'BA' || CAST(user_id % 3 AS VARCHAR) AS respondent, strftime(date_trunc('hour', ts), '%Y-%m-%dT%H') AS period,
    CASE WHEN event_id % 11 = 0 THEN 'x' ELSE CAST(value AS VARCHAR) END AS value FROM events WHERE event_type = 'purchase'),
pg AS (SELECT respondent, page, CASE WHEN page % 23 = 11 THEN NULL WHEN page % 17 = 5 THEN 0 ELSE count(*) END AS n FROM rec GROUP BY respondent, page),
st AS (SELECT *, CASE WHEN n IS NULL THEN 'failed' WHEN n = 0 THEN 'empty' WHEN n < 3 THEN 'short' ELSE 'full' END AS status FROM pg),
us AS (SELECT *, min(CASE WHEN status <> 'full' THEN page END) OVER (PARTITION BY respondent) AS stop FROM st),
used AS (SELECT respondent, page, CAST(n AS INTEGER) AS n_records, status, (stop IS NULL OR page < stop OR (page = stop AND status = 'short')) AS used FROM us)"""
    q["src_demand_paging"] = with_(pages) + "SELECT * FROM used"
    q["src_demand_paged_rows"] = with_(pages) + (
        "SELECT r.page, r.period, r.respondent, 'D' AS type, r.value FROM rec r JOIN used u USING (respondent, page) WHERE u.used AND u.status <> 'empty'")
    return q


ORACLE = more(ORACLE)
