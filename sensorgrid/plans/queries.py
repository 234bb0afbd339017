"""Registered queries: one Spark callable per operator row, each with its
DuckDB oracle SQL where the semantics are expressible in SQL.

Every query reads the driver tables of ``sf_dir`` whole.  Free floating
results are rounded to 6 places on both sides so the value hash does not
depend on summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import catalog
from ..functions import timefn
from ..operators import align, calibrate, ordered, scalar, timeops
from ..operators import chunks as ch
from ..sources.tables import table
from . import feeds

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ---------------------------------------------------------------- P1 P2 P4 A8
@register("round_quarter_hour", """
SELECT event_id, event_type, ts AS raw_ts,
       make_timestamp(((epoch_us(ts) + 450000000) // 900000000) * 900000000) AS ts
FROM events""")
def q_round(spark, sf):
    e = feeds.events(spark, sf).select("event_id", "event_type", F.col("ts").alias("raw_ts"))
    return timeops.round_time(e, ts="raw_ts", out="ts")


@register("shift_time", """
SELECT event_id, ts + INTERVAL 54 MINUTE AS ts FROM events""")
def q_shift(spark, sf):
    return timeops.shift_time(feeds.events(spark, sf).select("event_id", "ts"), 54)


@register("drop_off_grid", """
SELECT event_id, date_trunc('minute', ts) AS ts FROM events
WHERE minute(date_trunc('minute', ts)) % 15 = 0""")
def q_off_grid(spark, sf):
    e = feeds.events(spark, sf).select("event_id", timefn.floor_to_step("ts", "1 minute").alias("ts"))
    return timeops.drop_off_grid(e)


@register("gap_report", """
WITH r AS (
  SELECT event_type, event_id,
         make_timestamp(((epoch_us(ts) + 450000000) // 900000000) * 900000000) AS ts FROM events),
d AS (
  SELECT event_type, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY event_type ORDER BY event_id)) AS dt
  FROM r)
SELECT event_type, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(sum(CASE WHEN dt <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS duplicates,
       CAST(sum(CASE WHEN dt > 900000000 THEN 1 ELSE 0 END) AS BIGINT) AS gaps
FROM d GROUP BY event_type""")
def q_gap_report(spark, sf):
    e = timeops.round_time(feeds.events(spark, sf).select("event_type", "event_id", "ts"))
    return timeops.gap_report(e, ["event_type"], order="event_id", chunk=2000)


# ---------------------------------------------------------------- P7 P8 P9
@register("night_filter_2130", """
SELECT event_id, ts FROM events
WHERE CAST(ts AS TIME) >= TIME '07:00:00' AND CAST(ts AS TIME) < TIME '21:30:00'""")
def q_night_2130(spark, sf):
    e = feeds.events(spark, sf).select("event_id", "ts")
    return timeops.exclude_nights(e, catalog.NIGHT_START_EXPLORE, catalog.NIGHT_END)


@register("night_filter_2100", """
SELECT event_id, ts FROM events
WHERE CAST(ts AS TIME) >= TIME '07:00:00' AND CAST(ts AS TIME) < TIME '21:00:00'""")
def q_night_2100(spark, sf):
    e = feeds.events(spark, sf).select("event_id", "ts")
    return timeops.exclude_nights(e, catalog.NIGHT_START_MODEL, catalog.NIGHT_END)


@register("time_range_slice", """
SELECT event_id, ts, value FROM events
WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-13 00:00:00'""")
def q_time_range(spark, sf):
    e = feeds.events(spark, sf).select("event_id", "ts", "value")
    return timeops.time_range(e, "2024-01-05 06:00:00,2024-01-12")


@register("month_hour", """
SELECT event_id, CAST(month(ts) AS INTEGER) AS month, CAST(hour(ts) AS INTEGER) AS hour FROM events""")
def q_month_hour(spark, sf):
    e = feeds.events(spark, sf).select("event_id", "ts")
    return timeops.add_month_hour(e).drop("ts")


# ---------------------------------------------------------------- W1 W2 P12
@register("zscore_outliers", """
SELECT event_id, event_type,
       CASE WHEN abs(value - avg(value) OVER w) / stddev_pop(value) OVER w > 3
                 AND stddev_pop(value) OVER w > 0 AND count(value) OVER w = count(*) OVER w
            THEN NULL ELSE value END AS value
FROM events WINDOW w AS (PARTITION BY event_type)""")
def q_zscore(spark, sf):
    e = feeds.events(spark, sf).select("event_id", "event_type", "value")
    return ordered.zscore_outliers(e, ["value"], keys=["event_type"])


_INTERP_SQL = feeds.SQL_GRIDDED + """,
p AS (SELECT event_type, ts, value, row_number() OVER (PARTITION BY event_type ORDER BY ts) AS pos FROM grid),
q AS (SELECT *,
  max(CASE WHEN value IS NOT NULL THEN pos END) OVER (PARTITION BY event_type ORDER BY pos
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p0,
  last_value(value IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY pos
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v0,
  min(CASE WHEN value IS NOT NULL THEN pos END) OVER (PARTITION BY event_type ORDER BY pos
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS p1,
  first_value(value IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY pos
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v1
  FROM p)
SELECT event_type, ts,
  round(CASE WHEN value IS NOT NULL THEN value
       WHEN p0 IS NULL THEN NULL
       WHEN {limit_cond} THEN NULL
       WHEN p1 IS NULL THEN v0
       ELSE v0 + (v1 - v0) * (pos - p0) / (p1 - p0) END, 6) AS value
FROM q"""


@register("interpolate_full", _INTERP_SQL.replace("{limit_cond}", "FALSE"))
def q_interp_full(spark, sf):
    g = feeds.gridded(spark, sf).select("event_type", "ts", "value")
    out = ordered.interpolate(g, ["value"], keys=["event_type"])
    return out.select("event_type", "ts", r6("value").alias("value"))


@register("interpolate_limit4", _INTERP_SQL.replace("{limit_cond}", "pos - p0 > 4"))
def q_interp_limit4(spark, sf):
    g = feeds.gridded(spark, sf).select("event_type", "ts", "value")
    out = ordered.interpolate(g, ["value"], keys=["event_type"], limit=4)
    return out.select("event_type", "ts", r6("value").alias("value"))


_WIDE_SQL = feeds.SQL_GRIDDED + """,
wide AS (
  SELECT ts,
    max(CASE WHEN event_type = 'click' THEN value END) AS click,
    max(CASE WHEN event_type = 'view' THEN value END) AS view,
    max(CASE WHEN event_type = 'purchase' THEN value END) AS purchase,
    max(CASE WHEN event_type = 'signup' THEN value END) AS signup,
    max(CASE WHEN event_type = 'error' THEN value END) AS error
  FROM grid GROUP BY ts)"""

# The event types of the driver tables, as the oracle SQL names them.
EVENT_TYPES = ("click", "view", "purchase", "signup", "error")


def event_types(spark, sf) -> list[str]:
    """The series present in the data (a short list of column names)."""
    found = feeds.events(spark, sf).select("event_type").filter(F.col("event_type").isNotNull()).distinct().collect()
    return sorted(r[0] for r in found)


def wide_slots(spark, sf) -> DataFrame:
    """One row per quarter hour of any series' spine, one column per
    event type (at most one reading per type and step after gridding)."""
    g = feeds.gridded(spark, sf)
    return g.groupBy("ts").agg(*[F.max(F.when(F.col("event_type") == t, F.col("value"))).alias(t)
                                 for t in event_types(spark, sf)])


def series_of(wide: DataFrame) -> list[str]:
    return [c for c in wide.columns if c not in ("ts", "month", "hour", "is_test")]


@register("sparse_rows", _WIDE_SQL + """
SELECT ts, round(click, 6) AS click, round(view, 6) AS view, round(purchase, 6) AS purchase,
       round(signup, 6) AS signup, round(error, 6) AS error
FROM wide
WHERE (CAST(click IS NOT NULL AS INTEGER) + CAST(view IS NOT NULL AS INTEGER)
       + CAST(purchase IS NOT NULL AS INTEGER) + CAST(signup IS NOT NULL AS INTEGER)
       + CAST(error IS NOT NULL AS INTEGER)) >= 3""")
def q_sparse_rows(spark, sf):
    w = wide_slots(spark, sf)
    types = series_of(w)
    w = scalar.drop_sparse_rows(w, 3, subset=types)
    return w.select("ts", *[r6(t).alias(t) for t in types])


# ---------------------------------------------------------------- A2–A7
def policy_feed(spark, sf) -> DataFrame:
    """Gridded events with catalog-named measures, so the grouping policy
    is chosen by name: mean, circular mean, last, max."""
    g = feeds.gridded(spark, sf)
    return g.select(
        "event_type", "ts",
        F.col("value").alias("temperature_f"),
        F.pmod(F.col("value") * 7.0, F.lit(360.0)).alias("wind_dir_deg"),
        (F.col("k") / 100.0).alias("precipitation_in"),
        F.col("value").alias("total_density_max"),
    )


def _group_sql(span_us: int) -> str:
    return feeds.SQL_GRIDDED + f""",
pf AS (SELECT event_type, ts, value AS temperature_f, ((value * 7.0) % 360.0) AS wind_dir_deg,
              k / 100.0 AS precipitation_in, value AS total_density_max FROM grid),
bb AS (SELECT event_type, epoch_us(min(ts)) AS st, epoch_us(max(ts)) AS lst FROM pf GROUP BY event_type),
b AS (SELECT event_type, lst,
        CASE WHEN CAST(make_timestamp(st + {span_us}) AS DATE) <> CAST(make_timestamp(st) AS DATE)
             THEN epoch_us(date_trunc('day', make_timestamp(st + {span_us})))
             ELSE st + {span_us} END AS b0 FROM bb),
k AS (SELECT pf.*, b.lst,
        b.b0 + (CAST(floor((epoch_us(pf.ts) - b.b0) / {span_us}.0) AS BIGINT) + 1) * {span_us} AS e
      FROM pf JOIN b USING (event_type)),
a AS (SELECT event_type, e,
        avg(temperature_f) AS temperature_f,
        avg(sin(radians(wind_dir_deg))) AS s, avg(cos(radians(wind_dir_deg))) AS c,
        arg_max_null(precipitation_in, ts) AS precipitation_in,
        max(total_density_max) AS total_density_max
      FROM k WHERE e <= lst AND epoch_us(ts) <= e - 60000000 GROUP BY event_type, e)
SELECT event_type, make_timestamp(e - 900000000) AS ts,
       round(temperature_f, 6) AS temperature_f,
       round(CASE WHEN s IS NULL OR (s = 0 AND c = 0) THEN 0.0
                  ELSE ((degrees(atan2(s, c)) % 360.0) + 360.0) % 360.0 END, 6) AS wind_dir_deg,
       round(precipitation_in, 6) AS precipitation_in,
       round(total_density_max, 6) AS total_density_max
FROM a"""


def _grouped(spark, sf, span):
    out = timeops.time_group(policy_feed(spark, sf), span, keys=["event_type"])
    return out.select("event_type", "ts", *[r6(c).alias(c) for c in
                                             ("temperature_f", "wind_dir_deg", "precipitation_in",
                                              "total_density_max")])


@register("time_group_3h", _group_sql(3 * 3_600_000_000))
def q_group_3h(spark, sf):
    return _grouped(spark, sf, "3 hours")


@register("column_policy_group", _group_sql(5 * 3_600_000_000))
def q_group_policy(spark, sf):
    """5-hour groups: the first group is cut back at midnight (A2's rule)."""
    return _grouped(spark, sf, "5 hours")


@register("circular_mean", """
WITH a AS (
  SELECT event_type, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day,
         avg(sin(radians((value * 7.0) % 360.0))) AS s, avg(cos(radians((value * 7.0) % 360.0))) AS c
  FROM events GROUP BY event_type, day)
SELECT event_type, day,
       round(CASE WHEN s IS NULL OR (s = 0 AND c = 0) THEN 0.0
                  ELSE ((degrees(atan2(s, c)) % 360.0) + 360.0) % 360.0 END, 6) AS mean_direction
FROM a""")
def q_circular(spark, sf):
    from ..functions.mathfn import circular_mean
    e = feeds.events(spark, sf)
    e = e.select("event_type", timefn.floor_to_step("ts", "1 day").alias("day"),
                 F.pmod(F.col("value") * 7.0, F.lit(360.0)).alias("deg"))
    return e.groupBy("event_type", "day").agg(r6(circular_mean("deg")).alias("mean_direction"))


# ---------------------------------------------------------------- W3 W4 J6
def _trend_sql(hours: list[int]) -> str:
    cols = ",\n  ".join(
        f"""round(round_even(value - CASE WHEN count(*) OVER w{h} = 0 THEN value
                 ELSE first_value(value) OVER w{h} END, 2), 6) AS "value {h}:00:00 Trend" """
        if h < 24 else
        f"""round(round_even(value - CASE WHEN count(*) OVER w{h} = 0 THEN value
                 ELSE first_value(value) OVER w{h} END, 2), 6) AS "value 1 day, 0:00:00 Trend" """
        for h in hours)
    wins = ",\n  ".join(
        f"w{h} AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL {h} HOUR PRECEDING "
        f"AND INTERVAL {h} HOUR PRECEDING)" for h in hours)
    return feeds.SQL_GRIDDED + f"""
SELECT event_type, ts, round(value, 6) AS value,
  {cols}
FROM grid
WINDOW {wins}"""


def _trend_query(spark, sf, hours):
    g = feeds.gridded(spark, sf).select("event_type", "ts", "value")
    out = ordered.trend_sweep(g, ["value"], hours=hours, keys=["event_type"])
    return out.select("event_type", "ts", *[r6(c).alias(c) for c in out.columns if c not in ("event_type", "ts")])


@register("trend_1h", _trend_sql([1]))
def q_trend_1h(spark, sf):
    return _trend_query(spark, sf, [1])


@register("trend_sweep", _trend_sql(list(catalog.TREND_SWEEP_HOURS)))
def q_trend_sweep(spark, sf):
    return _trend_query(spark, sf, list(catalog.TREND_SWEEP_HOURS))


# ---------------------------------------------------------------- W5 W6
@register("smooth_tail", feeds.SQL_GRIDDED + """
SELECT event_type, ts,
  round(CASE WHEN count(value) OVER w = 2 THEN avg(value) OVER w END, 6) AS value_smoothed
FROM grid WINDOW w AS (PARTITION BY event_type ORDER BY ts ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)""")
def q_smooth_tail(spark, sf):
    g = feeds.gridded(spark, sf).select("event_type", "ts", "value")
    out = ordered.smooth(g, "value", 2, keys=["event_type"], block=500)
    return out.select("event_type", "ts", r6("value_smoothed").alias("value_smoothed"))


@register("smooth_center", feeds.SQL_GRIDDED + """
SELECT event_type, ts,
  round(CASE WHEN count(value) OVER w = 4 THEN avg(value) OVER w END, 6) AS value_smoothed
FROM grid WINDOW w AS (PARTITION BY event_type ORDER BY ts ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING)""")
def q_smooth_center(spark, sf):
    g = feeds.gridded(spark, sf).select("event_type", "ts", "value")
    out = ordered.smooth(g, "value", 4, center=True, keys=["event_type"], block=500)
    return out.select("event_type", "ts", r6("value_smoothed").alias("value_smoothed"))


@register("running_day_sum", feeds.SQL_GRIDDED + """,
s AS (SELECT *, sum(CASE WHEN hour(ts) = 0 AND minute(ts) = 0 THEN 1 ELSE 0 END)
          OVER (PARTITION BY event_type ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg
      FROM grid)
SELECT event_type, ts,
  round(sum(coalesce(value, 0.0)) OVER (PARTITION BY event_type, seg ORDER BY ts
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS value_day_sum
FROM s""")
def q_running_day_sum(spark, sf):
    g = feeds.gridded(spark, sf).select("event_type", "ts", "value")
    out = ordered.running_day_sum(g, "value", keys=["event_type"])
    return out.select("event_type", "ts", r6("value_day_sum").alias("value_day_sum"))


# ---------------------------------------------------------------- W7 W8 W14 P10 P14
@register("minmax_scale", _WIDE_SQL + """
SELECT ts, """ + ",\n  ".join(
    f"round((({t}) - min({t}) OVER ()) / nullif(max({t}) OVER () - min({t}) OVER (), 0), 6) AS {t}"
    for t in EVENT_TYPES) + """
FROM wide""")
def q_minmax(spark, sf):
    w = wide_slots(spark, sf)
    out = ordered.minmax_scale(w, series_of(w))
    return out.select("ts", *[r6(t).alias(t) for t in series_of(w)])


def _plot_sql() -> str:
    scaled = ",\n".join(f"""  CASE WHEN max({c}) OVER () = min({c}) OVER () THEN (CASE WHEN {c} IS NOT NULL THEN 0.0 END)
       ELSE ({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) END AS {c}""" for c in EVENT_TYPES)
    parts = "\nUNION ALL\n".join(
        f"SELECT ts, '{c}' AS series, round({c}, 6) AS scaled, round(purchase, 6) AS target_scaled FROM sc"
        for c in EVENT_TYPES if c != "purchase")
    return _WIDE_SQL + f""",
v AS (SELECT * FROM wide
      WHERE CAST(ts AS TIME) >= TIME '07:00:00' AND CAST(ts AS TIME) < TIME '21:30:00'
        AND ts >= TIMESTAMP '2024-01-03 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'),
sc AS (SELECT ts,
{scaled}
  FROM v)
{parts}"""


@register("plot_ready", _plot_sql())
def q_plot_ready(spark, sf):
    """Every column of the feed against the target (all-columns mode)."""
    from .views import plot_ready
    out = plot_ready(wide_slots(spark, sf), target="purchase",
                     time_range="2024-01-03,2024-01-19", night_start=catalog.NIGHT_START_EXPLORE)
    return out.select("ts", "series", r6("scaled").alias("scaled"), r6("target_scaled").alias("target_scaled"))


@register("discretize_5", """
WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
SELECT l_orderkey, l_linenumber,
  CAST(CASE WHEN l_extendedprice IS NULL THEN NULL
            WHEN hi - lo = 0 THEN 4
            ELSE least(floor((l_extendedprice - lo) / ((hi - lo) / 5.0)), 4) END AS INTEGER) AS price_band
FROM lineitem, s""")
def q_discretize(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return scalar.discretize(li, "l_extendedprice", "price_band", 5).drop("l_extendedprice")


@register("binary_discretize", """
SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_discount = 0 THEN 0 ELSE 1 END AS INTEGER) AS has_discount
FROM lineitem""")
def q_binary(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    return scalar.discretize(li, "l_discount", "has_discount", -1).drop("l_discount")


@register("threshold_zero", """
SELECT event_id, CASE WHEN coalesce(value, 0.0) <= 3 THEN 0.0 ELSE value END AS value FROM events""")
def q_threshold(spark, sf):
    e = feeds.events(spark, sf).select("event_id", "value")
    return scalar.threshold_to_zero(e, "value", 3.0)


# ---------------------------------------------------------------- J1–J5, P13
def side_feed(spark, sf, kind: str) -> DataFrame:
    """One event type as a raw feed in file order: rounded stamp, value, user."""
    e = feeds.events(spark, sf).filter(F.col("event_type") == kind)
    e = e.select("event_id", feeds.quarter("ts").alias("ts"),
                 F.col("value").alias(f"{kind}_value"), F.col("user_id").alias(f"{kind}_user"))
    return e


def _side_sql(kind: str) -> str:
    return f"""{kind}_raw AS (
  SELECT event_id, {feeds.rounded_micros_sql()} AS ts, value AS {kind}_value, user_id AS {kind}_user
  FROM events WHERE event_type = '{kind}'),
{kind}_kept AS (
  SELECT ts, {kind}_value, {kind}_user FROM {kind}_raw
  QUALIFY max(ts) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) IS NULL
       OR ts > max(ts) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


_RANGE_SQL = "WITH " + _side_sql("click") + ",\n" + _side_sql("view") + """,
rng AS (SELECT greatest((SELECT arg_min(ts, event_id) FROM click_raw), (SELECT arg_min(ts, event_id) FROM view_raw)) AS start,
               least((SELECT arg_max(ts, event_id) FROM click_raw), (SELECT arg_max(ts, event_id) FROM view_raw)) AS "end"),
sp AS (SELECT unnest(generate_series(start, "end", INTERVAL 15 MINUTE)) AS ts, start FROM rng),
spine AS (SELECT ts, CAST((epoch_us(ts) - epoch_us(start)) // 900000000 + 1 AS BIGINT) AS record_number FROM sp)"""


@register("common_range", _RANGE_SQL + """
SELECT start, "end" FROM rng""")
def q_common_range(spark, sf):
    return align.common_range(side_feed(spark, sf, "click"), side_feed(spark, sf, "view"),
                              order_a="event_id", order_b="event_id")


@register("spine_pairing", _RANGE_SQL + """
SELECT spine.ts, spine.record_number, click_value, click_user
FROM spine LEFT JOIN click_kept USING (ts)""")
def q_spine_pairing(spark, sf):
    c, v = side_feed(spark, sf, "click"), side_feed(spark, sf, "view")
    rng = align.common_range(c, v, order_a="event_id", order_b="event_id")
    sp = timeops.spine(rng)
    return align.pair_on_spine(sp, c, order="event_id", chunk=1000)


_COMBINED_SQL = _RANGE_SQL + """,
combined AS (
  SELECT spine.ts, spine.record_number, click_value, click_user, view_value, view_user
  FROM spine LEFT JOIN click_kept USING (ts) LEFT JOIN view_kept USING (ts))"""


def combined_feed(spark, sf) -> DataFrame:
    c, v = side_feed(spark, sf, "click"), side_feed(spark, sf, "view")
    return align.combine(c, v, order_a="event_id", order_b="event_id", chunk=1000)


@register("combine_feeds", _COMBINED_SQL + """
SELECT * FROM combined""")
def q_combine(spark, sf):
    return combined_feed(spark, sf)


@register("hourly_lookup", _COMBINED_SQL + """,
aux AS (SELECT date_trunc('hour', ts) AS hr, sum(value) AS v FROM events WHERE event_type = 'purchase' GROUP BY hr)
SELECT combined.ts, record_number, click_value, round(round_even(aux.v, 3), 6) AS solar_mjm2
FROM combined LEFT JOIN aux ON date_trunc('hour', combined.ts) = aux.hr""")
def q_hourly_lookup(spark, sf):
    aux = (feeds.events(spark, sf).filter(F.col("event_type") == "purchase")
           .groupBy(timefn.floor_to_step("ts", "1 hour").alias("ts"))
           .agg(F.sum("value").alias("solar_mjm2")))
    out = align.lookup_hourly(combined_feed(spark, sf).select("ts", "record_number", "click_value"),
                              aux, "solar_mjm2", places=3)
    return out.select("ts", "record_number", "click_value", r6("solar_mjm2").alias("solar_mjm2"))


# ---------------------------------------------------------------- A10 A11 A15 W9
def stations(spark, sf) -> DataFrame:
    """Two stations: the click feed (station 1) and the view feed
    (station 2), each gridded on its own spine with record numbers."""
    g = feeds.gridded(spark, sf).filter(F.col("event_type").isin("click", "view"))
    return g.select(F.when(F.col("event_type") == "click", 1).otherwise(2).alias("station_id"),
                    "ts", "record_number", F.col("value").alias("total_density_avg"))


_STATION_SQL = feeds.SQL_GRIDDED + """,
st AS (SELECT CASE WHEN event_type = 'click' THEN 1 ELSE 2 END AS station_id, ts,
              record_number,
              value AS y
       FROM grid WHERE event_type IN ('click', 'view')),
p AS (SELECT *, row_number() OVER (ORDER BY ts) AS pos FROM st WHERE station_id = 2),
q AS (SELECT *,
  max(CASE WHEN y IS NOT NULL THEN pos END) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p0,
  last_value(y IGNORE NULLS) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v0,
  min(CASE WHEN y IS NOT NULL THEN pos END) OVER (ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS p1,
  first_value(y IGNORE NULLS) OVER (ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v1
  FROM p),
yi AS (SELECT record_number, CASE WHEN y IS NOT NULL THEN y WHEN p0 IS NULL THEN NULL WHEN p1 IS NULL THEN v0
                  ELSE v0 + (v1 - v0) * (pos - p0) / (p1 - p0) END AS y FROM q),
line AS (SELECT regr_slope(y, record_number) AS slope, regr_intercept(y, record_number) AS intercept,
                CAST(regr_count(y, record_number) AS BIGINT) AS n_fit FROM yi),
spread AS (SELECT stddev_samp(CASE WHEN station_id = 2 THEN y END) AS std_reference,
                  stddev_samp(CASE WHEN station_id = 1 THEN y END) AS std_other FROM st)"""


@register("fit_line", _STATION_SQL + """
SELECT round(slope, 6) AS slope, round(intercept, 6) AS intercept, n_fit,
       round(std_reference, 6) AS std_reference, round(std_other, 6) AS std_other,
       round(std_reference / std_other, 6) AS ratio
FROM line, spread""")
def q_fit_line(spark, sf):
    st = stations(spark, sf)
    line = calibrate.fit_line(st, "record_number", "total_density_avg", "station_id", 2)
    spread = calibrate.spread_ratio(st, "total_density_avg", "station_id", 2, 1)
    out = ch.attach(line, spread, [])
    return out.select(r6("slope").alias("slope"), r6("intercept").alias("intercept"), "n_fit",
                      r6("std_reference").alias("std_reference"), r6("std_other").alias("std_other"),
                      r6("ratio").alias("ratio"))


@register("calibrate_station", _STATION_SQL + """
SELECT station_id, ts, record_number,
       round(CASE WHEN station_id = 1 THEN y + record_number * slope + intercept / (std_reference / std_other)
                  ELSE y END, 6) AS total_density_avg
FROM st, line, spread""")
def q_calibrate(spark, sf):
    out = calibrate.calibrate_station(stations(spark, sf), "total_density_avg")
    return out.select("station_id", "ts", "record_number", r6("total_density_avg").alias("total_density_avg"))


# ---------------------------------------------------------------- flagship
def flagship(spark, sf) -> DataFrame:
    """events → grid → spine → interpolation (limit 4) → 3-hour groups."""
    g = policy_feed(spark, sf)
    g = ordered.interpolate(g, ["temperature_f", "wind_dir_deg", "precipitation_in", "total_density_max"],
                            keys=["event_type"], limit=4)
    return timeops.time_group(g, "3 hours", keys=["event_type"])


# ---------------------------------------------------------------- A9 A12–A14
CORR_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _matrix_sql(method: str, source: str, columns) -> str:
    parts = []
    for a in columns:
        for b in columns:
            parts.append(f"SELECT '{method}' AS method, '{a}' AS col_a, '{b}' AS col_b, "
                         f"round(corr({a}, {b}), 6) AS corr, "
                         f"CAST(count(CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN 1 END) AS BIGINT) AS n "
                         f"FROM {source}")
    return "\nUNION ALL\n".join(parts)


def _round_corr(df: DataFrame) -> DataFrame:
    return df.select("method", "col_a", "col_b", r6("corr").alias("corr"), "n")


@register("column_stats", "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", CAST(count({c}) AS BIGINT) AS n, CAST(min({c}) AS DOUBLE) AS "min",
       CAST(max({c}) AS DOUBLE) AS "max", round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std_pop,
       round(stddev_samp({c}), 6) AS std_samp FROM lineitem""" for c in CORR_COLUMNS))
def q_column_stats(spark, sf):
    from ..operators import stats
    out = stats.column_stats(table(spark, sf, "lineitem"), list(CORR_COLUMNS))
    return out.select("column", "n", "min", "max", r6("mean").alias("mean"), r6("std_pop").alias("std_pop"),
                      r6("std_samp").alias("std_samp"))


@register("corr_pearson", _matrix_sql("pearson", "lineitem", CORR_COLUMNS))
def q_pearson(spark, sf):
    from ..operators import stats
    return _round_corr(stats.corr_pearson(table(spark, sf, "lineitem"), list(CORR_COLUMNS)))


_RANKS_SQL = "(SELECT " + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in CORR_COLUMNS
) + " FROM lineitem) ranked"


@register("corr_spearman", _matrix_sql("spearman", _RANKS_SQL, CORR_COLUMNS))
def q_spearman(spark, sf):
    from ..operators import stats
    return _round_corr(stats.corr_spearman(table(spark, sf, "lineitem"), list(CORR_COLUMNS)))


def _kendall_sql(columns, source: str = "lineitem", few=("l_quantity", "l_discount", "l_tax")) -> str:
    """Tau-b of every pair; ``few`` are columns of few values: for each of
    them the rows of lower ``a`` are counted in one window."""
    parts = []
    for i, x in enumerate(columns):
        for y in columns[i:]:
            if x == y:
                parts.append(f"SELECT 'kendall' AS method, '{x}' AS col_a, '{x}' AS col_b, "
                             f"CASE WHEN min({x}) < max({x}) THEN 1.0 END AS corr, CAST(count({x}) AS BIGINT) AS n "
                             f"FROM {source}")
                continue
            a, b = (x, y) if y in few else (y, x)
            src = f"(SELECT {a} AS a, {b} AS b FROM {source} WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
            cell = f"""SELECT round(
  (SELECT sum(w.n * sign(w.b - l.d) * l.below) FROM (SELECT a, b, count(*) AS n FROM {src} GROUP BY ALL) w
   JOIN (SELECT a, d, sum(n) OVER (PARTITION BY d ORDER BY a) - n AS below
         FROM (SELECT k.a, v.d, count(r.a) AS n FROM (SELECT DISTINCT a FROM {src}) k CROSS JOIN (SELECT DISTINCT b AS d FROM {src}) v
               LEFT JOIN {src} r ON r.a = k.a AND r.b = v.d GROUP BY ALL)) l ON l.a = w.a)
  / sqrt((count(*) * (count(*) - 1) / 2.0 - (SELECT sum(t * (t - 1) / 2.0) FROM (SELECT count(*) AS t FROM {src} GROUP BY a)))
       * (count(*) * (count(*) - 1) / 2.0 - (SELECT sum(t * (t - 1) / 2.0) FROM (SELECT count(*) AS t FROM {src} GROUP BY b)))), 6) AS corr,
  CAST(count(*) AS BIGINT) AS n FROM {src}"""
            for p, q in ((x, y), (y, x)):
                parts.append(f"SELECT 'kendall' AS method, '{p}' AS col_a, '{q}' AS col_b, corr, n FROM ({cell})")
    return "\nUNION ALL\n".join(parts)


@register("corr_kendall", _kendall_sql(CORR_COLUMNS))
def q_kendall(spark, sf):
    from ..operators import stats
    return _round_corr(stats.corr_kendall(table(spark, sf, "lineitem"), list(CORR_COLUMNS)))


# columns with missing values: discounts and taxes of 0, quantities of 1
_HOLES_SQL = ("(SELECT nullif(l_quantity, 1) AS l_quantity, l_extendedprice, nullif(l_discount, 0) AS l_discount, "
              "nullif(l_tax, 0) AS l_tax FROM lineitem)")


def _with_holes(spark, sf) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.select(F.nullif("l_quantity", F.lit(1.0)).alias("l_quantity"), "l_extendedprice",
                     F.nullif("l_discount", F.lit(0.0)).alias("l_discount"), F.nullif("l_tax", F.lit(0.0)).alias("l_tax"))


def _spearman_pairs_sql(columns, source) -> str:
    parts = []
    for a in columns:
        for b in columns:
            src = f"(SELECT {a} AS a, {b} AS b FROM {source} WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
            parts.append(f"SELECT 'spearman' AS method, '{a}' AS col_a, '{b}' AS col_b, round(corr(a, b), 6) AS corr, "
                         f"CAST(count(*) AS BIGINT) AS n FROM "
                         f"(SELECT rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0 AS a, "
                         f"rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2.0 AS b FROM {src})")
    return "\nUNION ALL\n".join(parts)


@register("corr_spearman_nulls", _spearman_pairs_sql(CORR_COLUMNS, _HOLES_SQL))
def q_spearman_nulls(spark, sf):
    """A13 where most columns have missing values."""
    from ..operators import stats
    return _round_corr(stats.corr_spearman(_with_holes(spark, sf), list(CORR_COLUMNS)))


@register("corr_kendall_nulls", _kendall_sql(CORR_COLUMNS, _HOLES_SQL))
def q_kendall_nulls(spark, sf):
    """A14 where most columns have missing values."""
    from ..operators import stats
    return _round_corr(stats.corr_kendall(_with_holes(spark, sf), list(CORR_COLUMNS)))


# ---------------------------------------------------------------- T6 T7
@register("split_80_20", """
WITH h AS (SELECT o_orderkey,
             ('0x' || substr(md5('1234|' || CAST(o_orderkey AS VARCHAR)), 1, 15))::BIGINT AS h FROM orders)
SELECT o_orderkey, row_number() OVER (ORDER BY h, o_orderkey) <= ceil(0.2 * count(*) OVER ()) AS is_test
FROM h""")
def q_split(spark, sf):
    from ..operators.split import train_test_split
    o = table(spark, sf, "orders").select("o_orderkey")
    return train_test_split(o, ["o_orderkey"], 0.2, 1234)


@register("column_subsets", """
WITH names AS (SELECT event_type AS name, row_number() OVER (ORDER BY event_type) - 1 AS i
               FROM (SELECT DISTINCT event_type FROM events)),
ids AS (SELECT unnest(range(1, CAST(pow(2, (SELECT count(*) FROM names)) AS BIGINT))) AS subset_id)
SELECT subset_id, CAST(bit_count(subset_id) AS INTEGER) AS size,
       list(name ORDER BY i) FILTER (WHERE (subset_id >> i) & 1 = 1) AS input_columns,
       CAST((SELECT count(*) FROM events e JOIN names m ON e.event_type = m.name WHERE (subset_id >> m.i) & 1 = 1) AS BIGINT) AS n_rows
FROM ids, names GROUP BY subset_id""")
def q_subsets(spark, sf):
    """T6 over the series present in the data (distinct event types, a
    bounded list of names) — 2^n - 1 subsets generated on the executors, each
    with the rows that its series have."""
    from ..operators.split import column_subsets
    sizes = feeds.events(spark, sf).groupBy("event_type").agg(F.count(F.lit(1)).alias("c"))
    names = sorted(r[0] for r in sizes.select("event_type").collect())
    each = column_subsets(spark, names).withColumn("event_type", F.explode("input_columns")).join(sizes, "event_type")
    return each.groupBy("subset_id", "size", "input_columns").agg(F.sum("c").alias("n_rows"))


# ---------------------------------------------------------------- M3 M4 M14 W10 T2 T5 A19
def embedding_split(spark, sf) -> DataFrame:
    """Split once: train and test part are read many times."""
    from ..operators.split import train_test_split
    from ..session import cut_lineage
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"),
                                              F.col("label").cast("double").alias("label"))
    return cut_lineage(train_test_split(e, ["id"], 0.2, 1234))


def embedding_width(spark, sf) -> int:
    return table(spark, sf, "embeddings").agg(F.max(F.size("embedding"))).first()[0] or 0


LEFT_OUT = 40      # the feature that the second search does without


def knn_runs(spark, sf, without: int | None = None, ks=range(1, 21)) -> DataFrame:
    """kNN sweep (M14) on all embedding features, or on all but one: one
    result row per k (metrics M4 on the test part)."""
    from ..models.knn import knn_predict
    from ..operators import stats
    names = [f"e{i}" for i in range(embedding_width(spark, sf)) if i != without]
    d = embedding_split(spark, sf)
    if without is not None:
        d = d.withColumn("features", F.filter("features", lambda x, i: i != without))
    train, test = d.filter(~F.col("is_test")), d.filter(F.col("is_test"))
    pred = knn_predict(train, test, list(ks)).join(test.select("id", "label"), "id")
    res = stats.evaluate(pred, len(names), keys=["k"])
    res = res.withColumn("input_columns", F.array(*[F.lit(n) for n in names])).withColumn("knn_neighbors", F.col("k").cast("int"))
    # a results table (one row per k) is read several times by the rankings:
    # cut its lineage once so the neighbour search is not re-run per read
    from ..session import cut_lineage
    return cut_lineage(res)


def _flat_results(df: DataFrame, extra=()) -> DataFrame:
    return df.select(*extra, r6("r2_score").alias("r2_score"), r6("aicc").alias("aicc"),
                     r6("ci95.lo").alias("ci95_lo"), r6("ci95.hi").alias("ci95_hi"),
                     r6("ci95_span").alias("ci95_span"), "test_length")


def _knn_sql(tag: str = "", without: int | None = None) -> str:
    vec = "CAST(embedding AS DOUBLE[])"
    if without is not None:
        vec = f"list_concat({vec}[:{without}], {vec}[{without + 2}:])"
    return f"""
e{tag} AS (SELECT vec_id, {vec} AS f, CAST(label AS DOUBLE) AS y,
             ('0x' || substr(md5('1234|' || CAST(vec_id AS VARCHAR)), 1, 15))::BIGINT AS h FROM embeddings),
s{tag} AS (SELECT *, row_number() OVER (ORDER BY h, vec_id) <= ceil(0.2 * count(*) OVER ()) AS is_test FROM e{tag}),
top{tag} AS (SELECT t.vec_id AS tid, r.y, list_distance(t.f, r.f) AS d,
               row_number() OVER (PARTITION BY t.vec_id ORDER BY list_distance(t.f, r.f), r.vec_id) AS rank
             FROM s{tag} t JOIN s{tag} r ON t.is_test AND NOT r.is_test),
pred{tag} AS (SELECT tid, k,
    CASE WHEN count(*) FILTER (WHERE d = 0) > 0 THEN avg(y) FILTER (WHERE d = 0)
         ELSE sum(y / d) FILTER (WHERE d <> 0) / sum(1.0 / d) FILTER (WHERE d <> 0) END AS prediction
  FROM top{tag} JOIN (SELECT unnest(range(1, 21)) AS k) ks ON top{tag}.rank <= ks.k GROUP BY tid, k),
m{tag} AS (SELECT k, count(*) AS n, sum((y - prediction) * (y - prediction)) AS rss, avg(y - prediction) AS rm,
             stddev_samp(y - prediction) AS rsd, var_pop(y) AS vy, (SELECT max(len(f)) FROM e{tag}) AS dims
           FROM pred{tag} JOIN s{tag} ON pred{tag}.tid = s{tag}.vec_id GROUP BY k),
r{tag} AS (SELECT k, dims, 1 - rss / (vy * n) AS r2_score,
             n * ln(rss / n) + 2 * (2 * dims + 2.0) + 2 * (2 * dims + 2.0) * (2 * dims + 3.0) / (n - (2 * dims + 2.0) - 1) AS aicc,
             rm - 1.959963984540054 * rsd / sqrt(n) AS lo, rm + 1.959963984540054 * rsd / sqrt(n) AS hi,
             2 * 1.959963984540054 * rsd / sqrt(n) AS span, CAST(n AS BIGINT) AS test_length FROM m{tag})"""


def _flat_sql(src: str, extra: str = "") -> str:
    return (f"SELECT {extra}round(r2_score, 6) AS r2_score, round(aicc, 6) AS aicc, round(lo, 6) AS ci95_lo, "
            f"round(hi, 6) AS ci95_hi, round(span, 6) AS ci95_span, test_length FROM {src}")


@register("knn_regress", "WITH " + _knn_sql() + """
SELECT tid AS id, round(prediction, 6) AS prediction, round(y, 6) AS label
FROM pred JOIN s ON pred.tid = s.vec_id WHERE k = 16""")
def q_knn(spark, sf):
    from ..models.knn import knn_predict
    d = embedding_split(spark, sf)
    train, test = d.filter(~F.col("is_test")), d.filter(F.col("is_test"))
    pred = knn_predict(train, test, [16]).join(test.select("id", "label"), "id")
    return pred.select("id", r6("prediction").alias("prediction"), r6("label").alias("label"))


@register("metrics_r2_aicc_ci", "WITH " + _knn_sql() + "\n" + _flat_sql("r", "") + " WHERE k = 16")
def q_metrics(spark, sf):
    return _flat_results(knn_runs(spark, sf, ks=[16]))


@register("knn_sweep", "WITH " + _knn_sql() + "\n" + _flat_sql("r", "CAST(k AS INTEGER) AS knn_neighbors, "))
def q_knn_sweep(spark, sf):
    return _flat_results(knn_runs(spark, sf), ["knn_neighbors"])


def _two_searches(spark, sf) -> DataFrame:
    """Two searches of 20 models: without one feature, and with all."""
    a = knn_runs(spark, sf, without=LEFT_OUT).withColumn("search", F.lit("without"))
    b = knn_runs(spark, sf).withColumn("search", F.lit("all"))
    return a.unionByName(b)


_TWO_SQL = "WITH " + _knn_sql("a", LEFT_OUT) + "," + _knn_sql("b") + """,
allr AS (SELECT 'without' AS search, * FROM ra UNION ALL SELECT 'all' AS search, * FROM rb)"""


@register("akaike_weights", _TWO_SQL + """,
w AS (SELECT *, aicc - min(aicc) OVER (PARTITION BY search) AS delta FROM allr)
SELECT search, CAST(k AS INTEGER) AS knn_neighbors, round(aicc, 6) AS aicc, round(delta, 6) AS delta,
       round(exp(-delta / 2) / sum(exp(-delta / 2)) OVER (PARTITION BY search), 6) AS weight
FROM w""")
def q_akaike(spark, sf):
    from ..operators import stats
    w = stats.akaike_weights(_two_searches(spark, sf), partition=["search"])
    return w.select("search", "knn_neighbors", r6("aicc").alias("aicc"), r6("delta").alias("delta"),
                    r6("weight").alias("weight"))


@register("best_model", _TWO_SQL + """
SELECT search, CAST(k AS INTEGER) AS knn_neighbors, round(aicc, 6) AS aicc FROM allr
QUALIFY row_number() OVER (PARTITION BY search ORDER BY aicc) = 1""")
def q_best(spark, sf):
    from ..operators import stats
    b = stats.best_models(_two_searches(spark, sf), 1, partition=["search"])
    return b.select("search", "knn_neighbors", r6("aicc").alias("aicc"))


@register("merge_results", _TWO_SQL + """,
mm AS (SELECT * FROM (SELECT * FROM allr WHERE search = 'without' ORDER BY aicc LIMIT 1)
       UNION ALL SELECT * FROM allr WHERE search = 'all'),
w AS (SELECT *, aicc - min(aicc) OVER () AS delta FROM mm)
SELECT search, CAST(k AS INTEGER) AS knn_neighbors, round(aicc, 6) AS aicc, round(delta, 6) AS delta,
       round(exp(-delta / 2) / sum(exp(-delta / 2)) OVER (), 6) AS weight FROM w""")
def q_merge(spark, sf):
    from ..operators import stats
    both = _two_searches(spark, sf)
    m = stats.merge_results(both.filter(F.col("search") == "without"), both.filter(F.col("search") == "all"))
    return m.select("search", "knn_neighbors", r6("aicc").alias("aicc"), r6("delta").alias("delta"),
                    r6("weight").alias("weight"))


@register("column_presence", _TWO_SQL + """
SELECT CAST(count(*) AS BIGINT) AS n_models,
       CAST(sum(CASE WHEN search = 'all' THEN 1 ELSE 0 END) AS BIGINT) AS n_using
FROM (SELECT * FROM allr ORDER BY aicc LIMIT 10)""")
def q_presence(spark, sf):
    from .views import column_presence
    return column_presence(_two_searches(spark, sf), [f"e{LEFT_OUT}"], top=10)


# ---------------------------------------------------------------- M1 M2 M5–M16 (rows-only)
TARGET = "purchase"


def features(table_: DataFrame) -> list[str]:
    """The feed's measures but for the target (from the data)."""
    return [c for c in series_of(table_) if c != TARGET and "Trend" not in c]


def model_table(spark, sf) -> DataFrame:
    """W12 prepare + T7 split of the wide 15-minute feed (target: purchase)."""
    from .prepare import prepare, with_split
    p = prepare(wide_slots(spark, sf), target=TARGET, min_valid=3, drop=[])
    return with_split(p, ["ts"])


def _search(spark, sf, **kw):
    from .search import ModelSearch
    return ModelSearch(model_table(spark, sf), TARGET, **kw)


def _results_view(df: DataFrame) -> DataFrame:
    return df.select("search_id", "size", "r2_score", "aicc", "ci95", "ci95_span", "input_columns",
                     "feature_importances", "data_periodicity_hrs", "train_length", "test_length",
                     "n_estimators", "max_depth")


@register("forest_regress")
def q_forest(spark, sf):
    from .search import ModelSearch
    d = embedding_split(spark, sf)
    cols = [f"e{i}" for i in range(embedding_width(spark, sf))]
    d = d.select("id", "label", "is_test", *[F.col("features")[i].cast("double").alias(c) for i, c in enumerate(cols)])
    with ModelSearch(d, "label", id_cols=["id"]) as srch:
        return _results_view(srch.selected_model(cols, trees=100, depth=6, search_id="forest"))


@register("pls_regress")
def q_pls(spark, sf):
    from .search import ModelSearch
    d = embedding_split(spark, sf)
    cols = [f"e{i}" for i in range(embedding_width(spark, sf))]
    d = d.select("id", "label", "is_test", *[F.col("features")[i].cast("double").alias(c) for i, c in enumerate(cols)])
    from ..session import cut_lineage
    with ModelSearch(d, "label", id_cols=["id"]) as srch:
        res = srch.pls_sweep(cols, 11).select("pls_components", "r2_score", "aicc", "ci95_span", "test_length")
        return cut_lineage(res)


@register("grid_search_small")
def q_grid(spark, sf):
    with _search(spark, sf) as srch:
        return _results_view(srch.grid_search_columns(features(srch.data) + ["hour"]))


@register("trend_additive")
def q_trend_additive(spark, sf):
    """Every feature's trends over 1 to 24 hours, one at a time beside the
    features' hour and first column."""
    from .prepare import trend_table
    from .search import TREND_HOURS, ModelSearch
    m = model_table(spark, sf)
    own = features(m)
    t = trend_table(m, own, hours=TREND_HOURS)
    with ModelSearch(t, TARGET) as srch:
        return _results_view(srch.trend_additive(
            [own[0], "hour"], {c: [ordered.trend_name(c, f"{h} hours") for h in TREND_HOURS] for c in own}))


@register("trends_subsets")
def q_trend_subsets(spark, sf):
    """Every subset of five trends of one feature (31 runs)."""
    from .prepare import trend_table
    from .search import ModelSearch
    hours = (1, 2, 3, 6, 12)
    m = model_table(spark, sf)
    own = features(m)
    t = trend_table(m, own[-1:], hours=hours)
    names = [ordered.trend_name(own[-1], f"{h} hours") for h in hours]
    with ModelSearch(t, TARGET) as srch:
        return _results_view(srch.grid_search_trends([own[0], "hour"], names))


@register("hyper_small")
def q_hyper(spark, sf):
    with _search(spark, sf) as srch:
        return _results_view(srch.grid_search_hyper(features(srch.data)))


@register("time_grouping_curve")
def q_grouping_curve(spark, sf):
    from .prepare import prepare
    from .search import time_grouping_tests
    from .views import grouping_curve
    p = prepare(wide_slots(spark, sf), target=TARGET, min_valid=3, drop=[])
    res = time_grouping_tests(spark, p, TARGET, features(p) + ["hour"])
    return grouping_curve(res)


@register("rfe_small")
def q_rfe(spark, sf):
    with _search(spark, sf) as srch:
        return srch.rfe(features(srch.data) + ["month", "hour"], n_keep=3)


@register("sfs_small")
def q_sfs(spark, sf):
    with _search(spark, sf) as srch:
        return srch.sfs(features(srch.data) + ["month", "hour"])


@register("best_model_series")
def q_best_series(spark, sf):
    from ..session import cut_lineage
    with _search(spark, sf) as srch:
        _, series, _ = srch.best_model_series(features(srch.data) + ["hour"])
        return cut_lineage(series)


# ---------------------------------------------------------------- J6 W11 W12 W13 P15 S12
@register("lag_by_time", feeds.SQL_GRIDDED + """
SELECT event_type, ts, round(value, 6) AS value,
       round(first_value(value) OVER (PARTITION BY event_type ORDER BY ts
             RANGE BETWEEN INTERVAL 90 MINUTE PRECEDING AND INTERVAL 90 MINUTE PRECEDING), 6) AS value_lag
FROM grid""")
def q_lag(spark, sf):
    g = feeds.gridded(spark, sf).select("event_type", "ts", "value")
    out = ordered.lag_by_time(g, "value", "90 minutes", keys=["event_type"])
    return out.select("event_type", "ts", r6("value").alias("value"), r6("value_lag").alias("value_lag"))


@register("feature_engineering", feeds.SQL_GRIDDED + """
SELECT event_type, ts, CAST(month(ts) AS INTEGER) AS month, CAST(hour(ts) AS INTEGER) AS hour,
  round(round_even(value - CASE WHEN count(*) OVER w2 = 0 THEN value ELSE first_value(value) OVER w2 END, 2), 6)
      AS "pressure_mbar 2:00:00 Trend",
  round(round_even(k / 100.0 - CASE WHEN count(*) OVER w1 = 0 THEN k / 100.0 ELSE first_value(k / 100.0) OVER w1 END, 2), 6)
      AS "precipitation_in 1:00:00 Trend"
FROM grid
WINDOW w2 AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 2 HOUR PRECEDING AND INTERVAL 2 HOUR PRECEDING),
       w1 AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND INTERVAL 1 HOUR PRECEDING)""")
def q_feature_engineering(spark, sf):
    from .prepare import feature_engineering
    g = feeds.gridded(spark, sf).select("event_type", "ts", F.col("value").alias("pressure_mbar"),
                                        (F.col("k") / 100.0).alias("precipitation_in"))
    out = feature_engineering(g, keys=["event_type"])
    t2, t1 = "pressure_mbar 2:00:00 Trend", "precipitation_in 1:00:00 Trend"
    return out.select("event_type", "ts", "month", "hour", r6(t2).alias(t2), r6(t1).alias(t1))


_CLEAN_SQL = f"""WITH
r AS (SELECT event_type, event_id, {feeds.rounded_micros_sql()} AS ts, value AS ef_avg FROM events),
z AS (SELECT event_type, event_id, ts,
        CASE WHEN count(ef_avg) OVER w = count(*) OVER w AND stddev_pop(ef_avg) OVER w > 0
                  AND abs(ef_avg - avg(ef_avg) OVER w) / stddev_pop(ef_avg) OVER w > 3 THEN NULL
             ELSE ef_avg END AS ef_avg
      FROM r WINDOW w AS (PARTITION BY event_type)),
p AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS pos FROM z),
q AS (SELECT *,
  max(CASE WHEN ef_avg IS NOT NULL THEN pos END) OVER (PARTITION BY event_type ORDER BY pos
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p0,
  last_value(ef_avg IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY pos
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v0,
  min(CASE WHEN ef_avg IS NOT NULL THEN pos END) OVER (PARTITION BY event_type ORDER BY pos
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS p1,
  first_value(ef_avg IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY pos
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v1
  FROM p)
SELECT event_type, event_id, ts,
  round(CASE WHEN ef_avg IS NOT NULL THEN ef_avg WHEN p0 IS NULL THEN NULL WHEN p1 IS NULL THEN v0
             ELSE v0 + (v1 - v0) * (pos - p0) / (p1 - p0) END, 6) AS ef_avg
FROM q"""


@register("clean_weather", _CLEAN_SQL)
def q_clean_weather(spark, sf):
    from .prepare import clean_weather
    raw = feeds.events(spark, sf).select("event_type", "event_id", "ts", F.col("value").alias("ef_avg"))
    cleaned, _ = clean_weather(raw, keys=["event_type"], order="event_id")
    return cleaned.select("event_type", "event_id", "ts", r6("ef_avg").alias("ef_avg"))


def _prepare_sql() -> str:
    feats = [t for t in EVENT_TYPES if t != TARGET]
    meas = list(EVENT_TYPES)
    interp = []
    for c in feats:
        interp.append(f"""
  CASE WHEN {c} IS NOT NULL THEN {c}
       WHEN max(CASE WHEN {c} IS NOT NULL THEN pos END) OVER wu IS NULL THEN NULL
       WHEN pos - max(CASE WHEN {c} IS NOT NULL THEN pos END) OVER wu > 4 THEN NULL
       WHEN min(CASE WHEN {c} IS NOT NULL THEN pos END) OVER wd IS NULL THEN last_value({c} IGNORE NULLS) OVER wu
       ELSE last_value({c} IGNORE NULLS) OVER wu
            + (first_value({c} IGNORE NULLS) OVER wd - last_value({c} IGNORE NULLS) OVER wu)
              * (pos - max(CASE WHEN {c} IS NOT NULL THEN pos END) OVER wu)
              / (min(CASE WHEN {c} IS NOT NULL THEN pos END) OVER wd - max(CASE WHEN {c} IS NOT NULL THEN pos END) OVER wu)
  END AS {c}""")
    present = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in meas)
    scaled = ",\n  ".join(
        f"round((coalesce({c}, 0.0) - min(coalesce({c}, 0.0)) OVER ()) / nullif(max(coalesce({c}, 0.0)) OVER () "
        f"- min(coalesce({c}, 0.0)) OVER (), 0), 6) AS {c}" for c in meas)
    return _WIDE_SQL + f""",
f AS (SELECT ts, coalesce({TARGET}, 0.0) AS {TARGET}, {", ".join(feats)},
             row_number() OVER (ORDER BY ts) AS pos FROM wide),
i AS (SELECT ts, {TARGET}, {",".join(interp)}
      FROM f WINDOW wu AS (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                    wd AS (ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
k AS (SELECT * FROM i WHERE {present} >= 3)
SELECT ts, {scaled},
  CAST(month(ts) AS INTEGER) AS month, CAST(hour(ts) AS INTEGER) AS hour
FROM k"""


@register("prepare_model_table", _prepare_sql())
def q_prepare(spark, sf):
    from .prepare import prepare
    p = prepare(wide_slots(spark, sf), target=TARGET, min_valid=3, drop=[])
    return p.select("ts", *[r6(c).alias(c) for c in series_of(p)], "month", "hour")


@register("view_spec", _WIDE_SQL + """
SELECT ts, round(click, 6) AS click, round(view, 6) AS view FROM wide
WHERE ts >= TIMESTAMP '2024-01-03 00:00:00' AND ts < TIMESTAMP '2024-01-06 00:00:00'""")
def q_view(spark, sf):
    v = scalar.view(wide_slots(spark, sf), "click,view--2024-01-03,2024-01-05")
    return v.select("ts", r6("click").alias("click"), r6("view").alias("view"))


def _pair_feed(spark, sf, key, val):
    e = feeds.events(spark, sf)
    return e.select(F.col("event_type").alias(key), "event_id", feeds.quarter("ts").alias("ts"),
                    F.col("value").alias(val))


def _pair_all_sql() -> str:
    return f"""WITH
raw AS (SELECT event_type, event_id, value, {feeds.rounded_micros_sql()} AS ts FROM events),
kept AS (SELECT * FROM raw
         QUALIFY max(ts) OVER (PARTITION BY event_type ORDER BY event_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) IS NULL
              OR ts > max(ts) OVER (PARTITION BY event_type ORDER BY event_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
b AS (SELECT event_type, arg_min(ts, event_id) AS f, arg_max(ts, event_id) AS l FROM raw GROUP BY event_type),
pairs AS (SELECT x.event_type AS station, y.event_type AS monitor FROM b x JOIN b y ON x.event_type <> y.event_type),
rng AS (SELECT station, monitor, greatest(bw.f, bc.f) AS s, least(bw.l, bc.l) AS e
        FROM pairs JOIN b bw ON bw.event_type = station JOIN b bc ON bc.event_type = monitor),
sp AS (SELECT station, monitor, s, unnest(generate_series(s, e, INTERVAL 15 MINUTE)) AS ts FROM rng)
SELECT sp.station, sp.monitor, sp.ts,
       CAST((epoch_us(sp.ts) - epoch_us(sp.s)) // 900000000 + 1 AS BIGINT) AS record_number,
       kw.value AS w_value, kc.value AS c_value
FROM sp LEFT JOIN kept kw ON kw.event_type = sp.station AND kw.ts = sp.ts
        LEFT JOIN kept kc ON kc.event_type = sp.monitor AND kc.ts = sp.ts"""


@register("pair_all", _pair_all_sql())
def q_pair_all(spark, sf):
    """Every feed paired with every other (the batch list, from the data)."""
    types = event_types(spark, sf)
    pairs = spark.createDataFrame([(a, b) for a in types for b in types if a != b], "station string, monitor string")
    w = _pair_feed(spark, sf, "station", "w_value")
    c = _pair_feed(spark, sf, "monitor", "c_value")
    out = align.pair_all(w, c, pairs, "station", "monitor", order_w="event_id", order_c="event_id")
    return out.select("station", "monitor", "ts", "record_number", "w_value", "c_value")


def _explore_sql() -> str:
    """The three matrices of the night-free slice, NULLs pairwise left out."""
    parts = [_matrix_sql("pearson", "v", EVENT_TYPES)]
    for a in EVENT_TYPES:
        for b in EVENT_TYPES:
            src = f"(SELECT {a} AS a, {b} AS b FROM v WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
            ranks = (f"(SELECT rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0 AS a, "
                     f"rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2.0 AS b FROM {src})")
            parts.append(f"SELECT 'spearman' AS method, '{a}' AS col_a, '{b}' AS col_b, round(corr(a, b), 6) AS corr, "
                         f"CAST(count(*) AS BIGINT) AS n FROM {ranks}")
            if a == b:
                parts.append(f"SELECT 'kendall' AS method, '{a}' AS col_a, '{b}' AS col_b, "
                             f"CASE WHEN min({a}) < max({a}) THEN 1.0 END AS corr, CAST(count({a}) AS BIGINT) AS n FROM v")
            else:
                parts.append(f"""SELECT 'kendall' AS method, '{a}' AS col_a, '{b}' AS col_b, round(
  (SELECT sum(sign(y.b - x.b)) FROM {src} x, {src} y WHERE x.a < y.a)
  / sqrt((count(*) * (count(*) - 1) / 2.0 - (SELECT sum(t * (t - 1) / 2.0) FROM (SELECT count(*) AS t FROM {src} GROUP BY a)))
       * (count(*) * (count(*) - 1) / 2.0 - (SELECT sum(t * (t - 1) / 2.0) FROM (SELECT count(*) AS t FROM {src} GROUP BY b)))), 6) AS corr,
  CAST(count(*) AS BIGINT) AS n FROM {src}""")
    return _WIDE_SQL + """,
v AS (SELECT * FROM wide
      WHERE CAST(ts AS TIME) >= TIME '07:00:00' AND CAST(ts AS TIME) < TIME '21:30:00'
        AND ts >= TIMESTAMP '2024-01-02 00:00:00' AND ts < TIMESTAMP '2024-01-29 00:00:00')
""" + "\nUNION ALL\n".join(parts)


@register("explore_corr", _explore_sql())
def q_explore(spark, sf):
    """Exploration chain: nights removed → slice → the three matrices of the
    wide feed (the tables behind the heat maps)."""
    from .views import explore_correlations
    w = wide_slots(spark, sf)
    out = explore_correlations(w, nights=True, time_range="2024-01-02,2024-01-28", columns=series_of(w))
    return _round_corr(out)


@register("gap_report_users", """
WITH r AS (
  SELECT user_id, event_id,
         make_timestamp(((epoch_us(ts) + 450000000) // 900000000) * 900000000) AS ts FROM events),
d AS (
  SELECT user_id, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY event_id)) AS dt FROM r)
SELECT user_id, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(sum(CASE WHEN dt <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS duplicates,
       CAST(sum(CASE WHEN dt > 900000000 THEN 1 ELSE 0 END) AS BIGINT) AS gaps
FROM d GROUP BY user_id""")
def q_gap_report_users(spark, sf):
    """A8 over many short series (one per user) in file order."""
    e = timeops.round_time(feeds.events(spark, sf).select("user_id", "event_id", "ts"))
    return timeops.gap_report(e, ["user_id"], order="event_id")


@register("zscore_users", """
SELECT event_id, user_id,
       CASE WHEN abs(value - avg(value) OVER w) / stddev_pop(value) OVER w > 3
                 AND stddev_pop(value) OVER w > 0 AND count(value) OVER w = count(*) OVER w
            THEN NULL ELSE value END AS value
FROM events WINDOW w AS (PARTITION BY user_id)""")
def q_zscore_users(spark, sf):
    """W1 over many short series (one per user)."""
    e = feeds.events(spark, sf).select("event_id", "user_id", "value")
    return ordered.zscore_outliers(e, ["value"], keys=["user_id"])


from . import queries_more  # noqa: E402,F401  (registers the further queries)
