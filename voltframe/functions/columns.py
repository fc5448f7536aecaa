"""Scalar column expressions shared by the operators.

All of these stay inside whole-stage codegen: they are compositions of
built-in Spark SQL functions.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_ntz(df: DataFrame, name: str) -> bool:
    """True when ``name`` is TIMESTAMP_NTZ (so outputs keep the input's type)."""
    return isinstance(df.schema[name].dataType, T.TimestampNTZType)


def epoch_micros(ts: str | Column) -> Column:
    """Microseconds since the epoch. NTZ values are read as UTC (session zone is UTC)."""
    return F.unix_micros(col_(ts).cast("timestamp"))


def from_epoch_micros(us: str | Column, ntz: bool = True) -> Column:
    t = F.timestamp_micros(col_(us))
    return t.cast("timestamp_ntz") if ntz else t


def floor_div(a: str | Column, b: int) -> Column:
    """Exact floor division of a long by a positive constant (also for negatives)."""
    a = col_(a)
    return ((a - F.pmod(a, F.lit(b))) / F.lit(b)).cast("long")


def slot_index(ts: str | Column, step_seconds: int) -> Column:
    """Index of the left-closed, epoch-aligned slot of width ``step_seconds``."""
    return floor_div(epoch_micros(ts), int(step_seconds) * 1_000_000)


def lenient_double(c: str | Column) -> Column:
    """Numeric coerce: text that is not a number becomes NULL (never raises)."""
    return col_(c).try_cast("double")


def parse_utc(c: str | Column, ntz: bool = True, strict: bool = False) -> Column:
    """Parse ISO-8601 text ('2024-08-15T03', '...Z', '+02:00' offsets) to a UTC timestamp.

    Offsets are converted to UTC. ``strict=True`` raises on unparseable text (ANSI cast),
    otherwise bad text becomes NULL.
    """
    c = col_(c)
    t = c.cast("timestamp") if strict else c.try_cast("timestamp")
    return t.cast("timestamp_ntz") if ntz else t


def present(c: str | Column) -> Column:
    """The value as a double, NULL where it is NaN: the one rule for missing values. Every statistic
    reads its values through this (Spark orders NaN above every number, and one NaN makes a mean
    NaN; pandas skips it). Infinities are values, as in pandas."""
    v = col_(c).cast("double")
    return F.when(~F.isnan(v), v)


def finite(c: str | Column) -> Column:
    """The value as a double, NULL where it is NaN or infinite: for bins and grids, which need a
    finite range."""
    v = col_(c).cast("double")
    return F.when(F.abs(v) < float("inf"), v)


def outside(v: str | Column, lo: Column | None = None, hi: Column | None = None) -> Column:
    """Whether a value lies strictly outside the bounds, never NULL. A NULL or NaN value is not
    outside; a NULL or NaN bound is no bound."""
    v, cond = present(v), F.lit(False)
    if lo is not None:
        cond = cond | F.coalesce(v < present(lo), F.lit(False))
    if hi is not None:
        cond = cond | F.coalesce(v > present(hi), F.lit(False))
    return cond


def null_outside(v: str | Column, lo: float | None = None, hi: float | None = None) -> Column:
    """Null out values strictly below ``lo`` or strictly above ``hi`` (bounds are kept)."""
    v = col_(v)
    bounds = [None if b is None else F.lit(float(b)) for b in (lo, hi)]
    return F.when(outside(v, *bounds), F.lit(None).cast("double")).otherwise(v)


def clip_to(v: str | Column, lo: Column, hi: Column) -> Column:
    """Cap to [lo, hi]; NULL and NaN stay (an unguarded least/greatest would not keep them); a NULL
    or NaN bound is no bound."""
    v = col_(v)
    return F.when(outside(v, lo=lo), lo).when(outside(v, hi=hi), hi).otherwise(v)


def safe_corr(x: str | Column, y: str | Column) -> Column:
    """Pearson r over the rows where both sides are present; NULL (not an error) when either
    side is constant or infinite there."""
    x, y = F.when(present(y).isNotNull(), present(x)), F.when(present(x).isNotNull(), present(y))
    return present(F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)))


def shielded(*extra: str):
    """Decorator for row-keeping operators: further input columns that are named like an internal
    column (they begin with ``_``, or are in ``extra``) are put aside under free names while the
    operator runs, and come back under their own. Columns the caller names in arguments are left."""
    def wrap(fn):
        @functools.wraps(fn)
        def run(df: DataFrame, *args, **kwargs):
            said = {s for a in (*args, *kwargs.values()) for s in ([a] if isinstance(a, str) else a if isinstance(a, (list, tuple)) else []) if isinstance(s, str)}
            clash = [c for c in df.columns if (c.startswith("_") or c in extra) and c not in said]
            if not clash:
                return fn(df, *args, **kwargs)
            prefix = "kept"
            while any(c.startswith(prefix) for c in df.columns):
                prefix += "_"
            aside = {c: f"{prefix}{i}" for i, c in enumerate(clash)}
            return fn(df.withColumnsRenamed(aside), *args, **kwargs).withColumnsRenamed({v: k for k, v in aside.items()})
        return run
    return wrap


def quantize(c: Column, bits: int = 20) -> Column:
    """Snap to the nearest multiple of 2**-bits (ties upward), as exact IEEE steps.

    Used for result hashes: decimal data never sits on a binary tie, and the
    scaling by a power of two is exact, so two engines whose results differ by
    summation-order noise produce bit-identical doubles. -0.0 becomes 0.0.
    """
    s = float(2 ** bits)
    # Beyond 2**(52 - bits) a double's own spacing is >= 2**-bits: already on the grid
    # (and floor() to BIGINT could overflow), so such values pass through.
    big = F.lit(float(2 ** (52 - bits)))
    snapped = (F.floor(c * F.lit(s) + F.lit(0.5)).cast("double") / F.lit(s)).cast("double")
    return F.when(F.abs(c) < big, snapped).otherwise(c + F.lit(0.0))


# Coefficients of the published rational approximation of the
# inverse standard normal CDF (P. J. Acklam, 2003); relative error < 1.2e-9.
_ACKLAM_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
             1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
_ACKLAM_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
             6.680131188771972e+01, -1.328068155288572e+01)
_ACKLAM_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
             -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
_ACKLAM_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
             3.754408661907416e+00)
_ACKLAM_P_LOW = 0.02425


def _horner(x: Column, coeffs) -> Column:
    acc = F.lit(coeffs[0])
    for c in coeffs[1:]:
        acc = acc * x + F.lit(c)
    return acc


def inv_norm_cdf(p: str | Column) -> Column:
    """Inverse standard normal CDF for p in (0, 1) as a pure column expression."""
    p = col_(p)
    a, b, c, d = _ACKLAM_A, _ACKLAM_B, _ACKLAM_C, _ACKLAM_D
    q_lo = F.sqrt(F.lit(-2.0) * F.log(p))
    lower = _horner(q_lo, c) / (_horner(q_lo, d) * q_lo + F.lit(1.0))
    q_hi = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - p))
    upper = -_horner(q_hi, c) / (_horner(q_hi, d) * q_hi + F.lit(1.0))
    q = p - F.lit(0.5)
    r = q * q
    central = _horner(r, a) * q / (_horner(r, b) * r + F.lit(1.0))
    return (F.when(p < F.lit(_ACKLAM_P_LOW), lower)
            .when(p > F.lit(1.0 - _ACKLAM_P_LOW), upper)
            .otherwise(central))
