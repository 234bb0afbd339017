"""Scalar and aggregate expression helpers (built-in functions only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN is the feeds' missing marker; Spark's avg/max/corr would be
    poisoned by it, so every double goes through this at ingest."""
    x = col(c)
    return F.when(~F.isnan(x), x)


_SPLIT = 134217729.0  # 2**27 + 1, Dekker's splitting constant


def _split(v: float) -> tuple[float, float]:
    c = _SPLIT * v
    hi = c - (c - v)
    return hi, v - hi


def round_half_even(c, places: int | None) -> Column:
    """Python's ``round(x, places)``: half-even on the exact binary value.

    ``bround`` rounds the shortest decimal text of a double (1.015 → 1.02)
    while the feeds' reference rounding looks at the exact binary value
    (1.01499999… → 1.01).  The scaled value ``x·10^places`` is formed
    exactly as ``p + e`` (Dekker's split of x; 10^places has at most 27
    significant bits for places <= 8, so both partial products are exact),
    so the half-way test is exact.  16 places or None = as is."""
    if places is None or places >= 16:
        return col(c)
    if places > 8:
        return F.bround(col(c), places)
    s = F.lit(float(10 ** places))
    x = col(c).cast("double")
    p = x * s
    cx = x * F.lit(_SPLIT)
    x_hi = cx - (cx - x)
    e = (x_hi * s - p) + (x - x_hi) * s
    k = F.floor(p).cast("double")
    t = ((p - k) - F.lit(0.5)) + e
    up = (t > 0) | ((t == 0) & (F.pmod(k, F.lit(2.0)) == 1.0))
    return F.when(F.abs(p) >= F.lit(2.0 ** 52), x).otherwise(F.when(up, k + 1.0).otherwise(k) / s)


def circular_mean(c) -> Column:
    """Mean direction in degrees, 0 <= a < 360, of the non-null angles.

    Mean unit vector (s, c); the angle is atan2(s, c) folded into [0, 360).
    No angles, or a zero vector, give 0.
    """
    x = F.radians(col(c))
    s = F.avg(F.sin(x))
    k = F.avg(F.cos(x))
    ang = F.pmod(F.degrees(F.atan2(s, k)), F.lit(360.0))
    return (
        F.when(s.isNull() | ((s == 0) & (k == 0)), F.lit(0.0))
        .when(ang >= 360.0, F.lit(0.0))
        .otherwise(ang)
    )
