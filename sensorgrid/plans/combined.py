"""The raw-feeds-to-combined-table chain as one lazy plan:
weather CSV → clean (round, gap report, outliers, interpolation) by station;
count files → per-file sums on the grid by monitor; every requested pairing
of a station and a monitor on a common spine with record numbers; hourly
solar values looked up by date and hour.  Process boundaries of the reference
become shuffle boundaries keyed by station / monitor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import align, timeops
from ..operators import chunks as ch
from ..sources import files
from .prepare import clean_weather

STATION, MONITOR = "station_id", "monitor_id"


def combined_table(spark: SparkSession, weather_path, weather_columns: Sequence[str], counts_root: str,
                   solar: DataFrame | None = None, solar_col: str = "solar_mjm2",
                   fix_clock_minutes: int | None = None, pairs: DataFrame | None = None):
    """Returns ``(combined, gap_report)``, both by station, the first also by
    monitor.

    ``weather_columns`` are the raw header names (catalog source names); rows
    are taken in the order of the files' paths and of the rows in them, so a
    logger that restarts its record numbers does no harm.  ``pairs``
    (``station_id, monitor_id``) lists the pairings to build; by default every
    station is paired with every monitor.  A feed without a station column is
    one station (NULL).  ``solar`` is an hourly ``(ts, solar_col)`` table."""
    raw = files.read_series_csv(spark, weather_path, files.series_schema(weather_columns), files.RAW_TIME_FORMAT, order_col="__row")
    if STATION not in raw.columns:
        raw = raw.withColumn(STATION, F.lit(None).cast("int"))
    if fix_clock_minutes:
        raw = timeops.shift_time(raw, fix_clock_minutes)
    weather, report = clean_weather(raw, keys=[STATION], order="__row")
    counts = files.read_count_files(spark, counts_root).withColumn("__row", F.col("ts"))
    if pairs is None:
        # a short list: every monitor's id beside every station
        monitors = counts.agg(F.sort_array(F.collect_set(MONITOR)).alias("__m"))
        pairs = ch.attach(raw.select(STATION).distinct(), monitors, ()).select(STATION, F.explode("__m").alias(MONITOR))
    out = align.pair_all(weather.drop("record_number"), counts, pairs, STATION, MONITOR, order_w="__row", order_c="__row")
    out = out.drop("__row")
    if solar is not None:
        out = align.lookup_hourly(out, solar, solar_col, places=3)
    return out, report
