"""Sensor feeds derived from the driver tables (the query stand-ins).

``events`` is an irregular feed: ``event_type`` names a few long series,
``user_id`` many short ones.  Rounded onto the 15-minute grid and laid on
a spine per series it becomes the regular feed most operators expect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import timefn
from ..operators import align, timeops
from ..session import cut_lineage
from ..sources.tables import table


def events(spark: SparkSession, sf_dir: str, blank: str | None = None) -> DataFrame:
    """The feed; ``blank`` names a series whose key is taken away (NULL)."""
    e = table(spark, sf_dir, "events")
    return e if blank is None else e.withColumn("event_type", F.nullif("event_type", F.lit(blank)))


def raw_feed(spark: SparkSession, sf_dir: str, key: str = "event_type", blank: str | None = None) -> DataFrame:
    """Readings with their stamp rounded to the quarter hour, in file order
    (``event_id``): value, a second measure ``k`` from ``props``, user id."""
    e = events(spark, sf_dir, blank)
    k = F.regexp_extract("props", K_PATTERN, 1)
    return e.select(key, "event_id", quarter("ts").alias("ts"), "value",
                    F.when(k != "", k.cast("double")).alias("k"), "user_id")


def gridded(spark: SparkSession, sf_dir: str, key: str = "event_type", blank: str | None = None) -> DataFrame:
    """Regular 15-minute feed per series, as the reference builds it: a
    spine from the first to the last reading (file order) with record
    numbers, each step paired with the first reading rounded onto it by the
    forward cursor; NULL where none.

    The table is written once to the shared checkpoint folder: operators that
    take both summaries and rows from it do not read the raw feed again."""
    raw = raw_feed(spark, sf_dir, key, blank)
    bounds = align.feed_bounds(raw, [key], order="event_id", first="start", last="end")
    sp = timeops.spine(bounds, [key])
    return cut_lineage(align.pair_on_spine(sp, raw, [key], order="event_id"))


# Fixed value: the numeric ``k`` field inside ``props``.
K_PATTERN = r'"k": *(-?[0-9]+)'

# DuckDB forms of the same feeds, used as CTEs by the oracle SQL.
SQL_GRIDDED = """WITH
raw AS (SELECT event_type, event_id, value, user_id,
               CAST(nullif(regexp_extract(props, '"k": *(-?[0-9]+)', 1), '') AS DOUBLE) AS k,
               make_timestamp(((epoch_us(ts) + 450000000) // 900000000) * 900000000) AS ts
        FROM events),
kept AS (SELECT * FROM raw
         QUALIFY max(ts) OVER (PARTITION BY event_type ORDER BY event_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) IS NULL
              OR ts > max(ts) OVER (PARTITION BY event_type ORDER BY event_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
bounds AS (SELECT event_type, arg_min(ts, event_id) AS s, arg_max(ts, event_id) AS e FROM raw GROUP BY event_type),
spine AS (SELECT event_type, unnest(generate_series(s, e, INTERVAL 15 MINUTE)) AS ts, s FROM bounds),
grid AS (SELECT spine.event_type, spine.ts,
                CAST((epoch_us(spine.ts) - epoch_us(spine.s)) // 900000000 + 1 AS BIGINT) AS record_number,
                kept.event_id, kept.value, kept.k, kept.user_id
         FROM spine LEFT JOIN kept USING (event_type, ts))"""


def rounded_micros_sql(col: str = "ts") -> str:
    return f"make_timestamp(((epoch_us({col}) + 450000000) // 900000000) * 900000000)"


def quarter(ts: str = "ts"):
    return timefn.round_to_step(ts, timeops.QUARTER)
