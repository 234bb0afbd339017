"""Feeds arriving as files, processed incrementally with Structured
Streaming.

The reference works on finished files only; these helpers run the same
row-wise operators (rounding, shift, off-grid filter, night filter) and a
watermarked 15-minute gridding on a stream, so a feed can be conditioned
as it lands.  Whole-table operators (z-score, interpolation, scaling) stay
batch: they need the finished table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import timeops


def read_feed_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                     max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        reader = reader.option("header", True).option("nullValue", "nan").option("ignoreLeadingWhiteSpace", True)
    return reader.load(path)


def grid_stream(stream: DataFrame, keys: Sequence[str], values: Sequence[str], ts: str = "ts",
                step: str = timeops.QUARTER, watermark: str = "1 hour") -> DataFrame:
    """Round each reading to the step and keep, per (series, step), the
    first reading by stamp (mean / count reported alongside).  Rows are
    emitted once the watermark passes the step (append mode)."""
    d = timeops.round_time(stream, step, ts, out="__slot")
    d = (d.withColumn("__slot_ts", F.col("__slot").cast("timestamp_ltz"))
          .withColumn("__event_ts", F.col(ts).cast("timestamp_ltz"))
          .withWatermark("__slot_ts", watermark))
    aggs = [F.min_by(F.col(v), F.col("__event_ts")).alias(v) for v in values]
    aggs += [F.count(F.lit(1)).alias("n_readings")]
    out = d.groupBy(*keys, "__slot_ts").agg(*aggs)
    return out.select(*keys, F.col("__slot_ts").cast("timestamp_ntz").alias(ts), *values, "n_readings")


def condition_stream(stream: DataFrame, ts: str = "ts", shift_minutes: int | None = None,
                     night_start: str | None = None, night_end: str = "07:00") -> DataFrame:
    """Stateless conditioning on a stream: optional clock shift, rounding to
    the quarter hour, optional night removal."""
    d = stream
    if shift_minutes:
        d = timeops.shift_time(d, shift_minutes, ts)
    d = timeops.round_time(d, timeops.QUARTER, ts)
    if night_start:
        d = timeops.exclude_nights(d, night_start, night_end, ts)
    return d
