"""Composite preparations whose step order is part of their meaning
(W12 prepare for modelling, W13 clean a raw weather feed)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import catalog
from ..operators import ordered, scalar, timeops
from ..sources.files import cached_features


def measure_columns(df: DataFrame, keys: Sequence[str] = (), ts: str = "ts") -> list[str]:
    skip = set(keys) | {ts}
    return [f.name for f in df.schema.fields if f.name not in skip
            and f.dataType.typeName() in ("double", "float", "long", "integer", "short")]


def prepare(df: DataFrame, target: str = catalog.TARGET, keys: Sequence[str] = (), ts: str = "ts",
            time_range: str | None = None, min_valid: int = 10, interpolate_limit: int = 4,
            drop: Sequence[str] | None = None) -> DataFrame:
    """W12, in the reference's order: time range → drop model-excluded
    columns → target NULL→0 → interpolate (≤ 4 per gap) → drop rows with
    fewer than ``min_valid`` values → remaining NULL→0 → min/max scaling
    over the whole series (each key is prepared by itself) → Month and Hour
    (unscaled)."""
    d = timeops.time_range(df, time_range, ts)
    d = scalar.drop_columns(d, list(drop) if drop is not None else catalog.model_drop_list(d.columns))
    measures = measure_columns(d, keys, ts)
    d = scalar.fill_value(d, 0.0, [target])
    d = ordered.interpolate(d, [c for c in measures if c != target], keys=keys, ts=ts, limit=interpolate_limit)
    d = scalar.drop_sparse_rows(d, min_valid, subset=measures)
    d = scalar.fill_value(d, 0.0, measures)
    d = ordered.minmax_scale(d, measures, keys=keys)
    return timeops.add_month_hour(d, ts)


def clean_weather(raw: DataFrame, keys: Sequence[str] = (), ts: str = "ts", order: str | None = None,
                  emr: Sequence[str] | None = None, step=timeops.QUARTER):
    """Round stamps → gap report → z-score outliers on the EMR
    columns (whole feed, before pairing) → linear interpolation without
    limit, by position in file order.  Returns ``(cleaned, gap_report)``."""
    d = timeops.round_time(raw, step, ts)
    report = timeops.gap_report(d, keys, ts, order=order, step=step)
    cols = list(emr) if emr is not None else catalog.emr_columns(d.columns)
    if cols:
        d = ordered.zscore_outliers(d, cols, keys)
        d = ordered.interpolate(d, cols, keys=keys, ts=ts, order=order)
    return d, report


def feature_engineering(df: DataFrame, keys: Sequence[str] = (), ts: str = "ts",
                        pressure: str = "pressure_mbar", precipitation: str = "precipitation_in") -> DataFrame:
    """W11 preset: Month and Hour, the 2-hour pressure trend and the 1-hour
    precipitation trend."""
    d = timeops.add_month_hour(df, ts)
    return ordered.trends(d, [(pressure, "2 hours"), (precipitation, "1 hour")], keys=keys, ts=ts)


def with_split(prepared: DataFrame, id_cols: Sequence[str], test_size: float = 0.2, seed: int = 1234,
               keys: Sequence[str] = ()) -> DataFrame:
    """T7 before any night filter, so every variant shares the split."""
    from ..operators.split import train_test_split
    return train_test_split(prepared, id_cols, test_size, seed, keys)


def trend_table(prepared: DataFrame, columns: Sequence[str], hours=catalog.TREND_SWEEP_HOURS,
                keys: Sequence[str] = (), ts: str = "ts", cache: str | None = None) -> DataFrame:
    """Trends after scaling (their 2-place rounding acts on 0..1 values).
    With ``cache`` (a path on shared storage) the table is kept there and only
    days that changed, and those that look back on them, are made again."""
    if cache:
        return cached_features(prepared, cache, lambda d: ordered.trend_sweep(d, columns, hours=hours, keys=keys, ts=ts), f"{max(hours)} hours", ts)
    return ordered.trend_sweep(prepared, columns, hours=hours, keys=keys, ts=ts)
