"""Row-wise operators: projections, tolerant drops, fills, thresholds,
discretisation, sparse-row removal, named views (P5, P6, P10–P16)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import catalog
from . import chunks as ch
from .timeops import time_range


def select_columns(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """P5."""
    return df.select(*keep, *[c for c in columns if c not in keep])


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the named columns that exist (missing names are ignored)."""
    return df.drop(*[c for c in columns if c in df.columns])


def fill_value(df: DataFrame, value=0.0, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL → value (all numeric columns, or the named ones)."""
    return df.fillna(value, subset=list(columns) if columns is not None else None)


def threshold_to_zero(df: DataFrame, column: str, threshold: float = 3.0) -> DataFrame:
    """P10: NULL → 0 and values at or below the threshold → 0."""
    x = F.coalesce(F.col(column).cast("double"), F.lit(0.0))
    return df.withColumn(column, F.when(x <= threshold, F.lit(0.0)).otherwise(x))


def drop_sparse_rows(df: DataFrame, min_valid: int = 10, subset: Sequence[str] | None = None) -> DataFrame:
    """Keep rows with at least ``min_valid`` non-NULL values among
    ``subset`` (default: every column)."""
    cols = list(subset) if subset is not None else df.columns
    present = sum((F.col(c).isNotNull().cast("int") for c in cols), F.lit(0))
    return df.filter(present >= min_valid)


def discretize(df: DataFrame, column: str, new_column: str, n: int, keys: Sequence[str] = ()) -> DataFrame:
    """``n`` equal-width bins labelled 0..n-1 between min and max
    (lower bound inclusive, the maximum in the last bin; a constant column
    is all ``n-1``).  ``n = -1``: 0 when the value is 0, else 1 (NULL → 1)."""
    x = F.col(column)
    if n == -1:
        return df.withColumn(new_column, F.when(x == 0, F.lit(0)).otherwise(F.lit(1)))
    if n < 1:
        raise ValueError("n must be >= 1 or -1")
    stats = df.groupBy(*keys).agg(F.min(column).alias("__lo"), F.max(column).alias("__hi"))
    d = ch.attach(df, stats, keys)
    width = (F.col("__hi") - F.col("__lo")) / F.lit(float(n))
    raw = F.floor(F.try_divide(x - F.col("__lo"), width))
    label = F.when(x.isNull(), F.lit(None)).when(width == 0, F.lit(n - 1)).otherwise(F.least(raw, F.lit(n - 1)))
    return d.withColumn(new_column, label.cast("int")).drop("__lo", "__hi")


def parse_view_spec(spec: str) -> tuple[list[str], str | None]:
    """``"c1,c2--start,end"`` → (columns, range); the range part is optional."""
    cols, _, rng = spec.partition("--")
    return [c.strip() for c in cols.split(",") if c.strip()], (rng.strip() or None)


def view(df: DataFrame, spec: str, ts: str = "ts") -> DataFrame:
    """A named view = select the listed columns (with the stamp; source
    names stand for their aliases) and slice to the optional range."""
    cols, rng = parse_view_spec(spec)
    cols = [c if c in df.columns else catalog.alias_of(c) for c in cols]
    return time_range(df, rng, ts).select(ts, *[c for c in cols if c != ts])
