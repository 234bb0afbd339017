"""Chunking helpers shared by the ordered operators.

A series may be huge (one key can hold a third of all rows), so no
ordered operator uses a window partitioned by the series key alone.
Instead rows are cut into chunks ``(keys, chunk)`` by their order
column: a time width for stamps, a number range for integer orders.
Windows run inside a chunk; whatever crosses a chunk border is carried
by a small window over one summary row per chunk, joined back on
``(keys, chunk)`` (the big side is already clustered that way, so the
join only moves the summaries).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import timefn
from ..session import cut_lineage

CHUNK = "__chunk"
KEY = "__key"
DEFAULT_TIME_CHUNK = "1 day"
DEFAULT_INT_CHUNK = 100_000


def chunk_expr(df: DataFrame, order: str, chunk) -> Column:
    """Chunk number of each row; ``chunk=None`` puts a series in one chunk."""
    if chunk is None:
        return F.lit(0).cast("bigint")
    dtype = df.schema[order].dataType
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        width = DEFAULT_TIME_CHUNK if chunk == "auto" else chunk
        return timefn.chunk_id(F.col(order).cast("timestamp_ntz"), width)
    width = DEFAULT_INT_CHUNK if chunk == "auto" else int(chunk)
    return F.floor(F.col(order) / F.lit(width)).cast("bigint")


def with_key(df: DataFrame, keys) -> DataFrame:
    """Add the series keys as one struct.  A struct is never NULL itself and
    structs with equal or equally missing fields are equal, so joins, windows
    and groups on it keep the series whose key is NULL."""
    return df.withColumn(KEY, F.struct(*keys)) if keys else df


def key_cols(keys) -> list[str]:
    return [KEY] if keys else []


def join_on_keys(left: DataFrame, right: DataFrame, keys, on=(), how: str = "left") -> DataFrame:
    """Join on the series keys (NULL keys match) and further columns."""
    if not keys:
        return left.join(right, list(on), how)
    return with_key(left, keys).join(with_key(right, keys).drop(*keys), [KEY, *on], how).select(
        *left.columns, *[c for c in right.columns if c not in set(keys) | set(on)])


def with_chunk(df: DataFrame, order: str, chunk) -> DataFrame:
    return df.withColumn(CHUNK, chunk_expr(df, order, chunk))


def local_window(keys, order_cols) -> Window:
    return Window.partitionBy(*keys, CHUNK).orderBy(*order_cols)


def chunk_window(keys, back: bool = False) -> Window:
    return Window.partitionBy(*keys).orderBy(F.col(CHUNK).desc() if back else F.col(CHUNK))


def before(w: Window) -> Window:
    return w.rowsBetween(Window.unboundedPreceding, -1)


def upto(w: Window) -> Window:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def positions(df: DataFrame, keys, order_cols, chunk, order=None) -> DataFrame:
    """Add ``__pos``: 0-based row position inside the series along
    ``order_cols``, computed chunk-wise (local row_number + offset of all
    earlier chunks)."""
    order = order or order_cols[0]
    d = with_chunk(with_key(df, keys), order, chunk)
    keys = key_cols(keys)
    d = d.withColumn("__lpos", F.row_number().over(local_window(keys, order_cols)) - 1)
    d = cut_lineage(d)                                # sizes and rows from one reading of the input
    sizes = d.groupBy(*keys, CHUNK).agg(F.count(F.lit(1)).alias("__n"))
    sizes = sizes.withColumn(
        "__off", F.coalesce(F.sum("__n").over(before(chunk_window(keys))), F.lit(0)).cast("bigint")
    ).drop("__n")
    d = d.join(sizes, [*keys, CHUNK], "left")
    return d.withColumn("__pos", F.col("__off") + F.col("__lpos")).drop("__off", KEY)


def attach(df: DataFrame, stats: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Attach per-series statistics (one row per key) to the rows.

    With keys this is an equi-join on them that keeps the series whose key is
    NULL; whether the stats side is broadcast is left to AQE's runtime size
    check.  Without keys the stats
    are one row of a global aggregate, read as one scalar subquery (a
    struct; the identical subquery is evaluated once and reused for every
    field), so no join is planned at all."""
    if keys:
        return join_on_keys(df, stats, keys, how=how)
    row = stats.select(F.struct(*stats.columns).alias("__s")).scalar()
    # one subquery column; the fields are read from it in a second
    # projection (Catalyst does not inline a non-cheap expression that is
    # referenced more than once)
    d = df.select("*", row.alias("__stats"))
    return d.select(*df.columns, *[F.col("__stats").getField(c).alias(c) for c in stats.columns])
