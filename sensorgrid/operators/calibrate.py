"""Calibrating one station against another."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import chunks as ch
from .ordered import interpolate


def fit_line(df: DataFrame, x: str, y: str, station: str, reference_station, ts: str = "ts",
             keys: Sequence[str] = (), interpolate_first: bool = True) -> DataFrame:
    """A10: least-squares line ``y = slope·x + intercept`` over the
    reference station's rows, after interpolating its ``y`` by position."""
    ref = df.filter(F.col(station) == F.lit(reference_station))
    if interpolate_first:
        ref = interpolate(ref.select(*keys, ts, x, y), [y], keys=keys, ts=ts)
    return ref.groupBy(*keys).agg(F.regr_slope(F.col(y), F.col(x)).alias("slope"),
                                  F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
                                  F.regr_count(F.col(y), F.col(x)).alias("n_fit"))


def spread_ratio(df: DataFrame, y: str, station: str, reference_station, other_station,
                 keys: Sequence[str] = ()) -> DataFrame:
    """Sample std of the reference station over that of the other
    station, on raw values (A15: one conditional aggregate, no split)."""
    s_ref = F.stddev_samp(F.when(F.col(station) == F.lit(reference_station), F.col(y)))
    s_oth = F.stddev_samp(F.when(F.col(station) == F.lit(other_station), F.col(y)))
    return df.groupBy(*keys).agg(s_ref.alias("std_reference"), s_oth.alias("std_other"),
                                 F.try_divide(s_ref, s_oth).alias("ratio"))


def calibrate_station(df: DataFrame, y: str, x: str = "record_number", station: str = "station_id",
                      reference_station=2, other_station=1, ts: str = "ts",
                      keys: Sequence[str] = ()) -> DataFrame:
    """Rows of the other station become ``y + x·slope + intercept/ratio``;
    reference rows are unchanged.  Line and ratio are one-row (per key)
    aggregates attached to the rows."""
    line = fit_line(df, x, y, station, reference_station, ts, keys)
    ratio = spread_ratio(df, y, station, reference_station, other_station, keys)
    params = ch.attach(line, ratio, keys).select(*keys, "slope", "intercept", "ratio")
    d = ch.attach(df, params, keys)
    calibrated = F.col(y) + F.col(x) * F.col("slope") + F.try_divide(F.col("intercept"), F.col("ratio"))
    d = d.withColumn(y, F.when(F.col(station) == F.lit(other_station), calibrated).otherwise(F.col(y)))
    return d.drop("slope", "intercept", "ratio")
