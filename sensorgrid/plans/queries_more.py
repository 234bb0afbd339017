"""Further registered queries: series without a key, keyed preparation,
partial time ranges, name rules and the smaller operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import timefn
from ..operators import ordered, scalar, timeops
from ..operators.split import train_test_split
from ..sources import files
from ..sources.tables import table
from . import feeds
from . import queries as q
from .queries import ORACLE, r6, register

BLANK = "error"      # the series whose key is taken away


def _without_key(name: str) -> str:
    """The oracle of a keyed query, with that series' key taken away."""
    return f"SELECT * REPLACE (nullif(event_type, '{BLANK}') AS event_type) FROM ({ORACLE[name]})"


# ------------------------------------------------- series whose key is NULL
@register("zscore_null_key", _without_key("zscore_outliers"))
def q_zscore(spark, sf):
    e = feeds.events(spark, sf, BLANK).select("event_id", "event_type", "value")
    return ordered.zscore_outliers(e, ["value"], keys=["event_type"])


@register("interpolate_null_key", _without_key("interpolate_limit4"))
def q_interpolate(spark, sf):
    g = feeds.gridded(spark, sf, blank=BLANK).select("event_type", "ts", "value")
    out = ordered.interpolate(g, ["value"], keys=["event_type"], limit=4)
    return out.select("event_type", "ts", r6("value").alias("value"))


@register("running_day_sum_null_key", _without_key("running_day_sum"))
def q_day_sum(spark, sf):
    g = feeds.gridded(spark, sf, blank=BLANK).select("event_type", "ts", "value")
    out = ordered.running_day_sum(g, "value", keys=["event_type"])
    return out.select("event_type", "ts", r6("value_day_sum").alias("value_day_sum"))


@register("smooth_null_key", _without_key("smooth_center"))
def q_smooth(spark, sf):
    g = feeds.gridded(spark, sf, blank=BLANK).select("event_type", "ts", "value")
    out = ordered.smooth(g, "value", 4, center=True, keys=["event_type"], block=500)
    return out.select("event_type", "ts", r6("value_smoothed").alias("value_smoothed"))


@register("time_group_null_key", _without_key("time_group_3h"))
def q_group(spark, sf):
    g = feeds.gridded(spark, sf, blank=BLANK)
    p = g.select("event_type", "ts", F.col("value").alias("temperature_f"),
                 F.pmod(F.col("value") * 7.0, F.lit(360.0)).alias("wind_dir_deg"),
                 (F.col("k") / 100.0).alias("precipitation_in"), F.col("value").alias("total_density_max"))
    out = timeops.time_group(p, "3 hours", keys=["event_type"])
    return out.select("event_type", "ts", *[r6(c).alias(c) for c in out.columns if c not in ("event_type", "ts")])


@register("gap_report_null_key", _without_key("gap_report"))
def q_gaps(spark, sf):
    e = timeops.round_time(feeds.events(spark, sf, BLANK).select("event_type", "event_id", "ts"))
    return timeops.gap_report(e, ["event_type"], order="event_id", chunk=2000)


@register("minmax_null_key", f"""
SELECT event_id, nullif(event_type, '{BLANK}') AS event_type,
  round((value - min(value) OVER w) / nullif(max(value) OVER w - min(value) OVER w, 0), 6) AS value
FROM events WINDOW w AS (PARTITION BY event_type)""")
def q_minmax(spark, sf):
    e = feeds.events(spark, sf, BLANK).select("event_id", "event_type", "value")
    return ordered.minmax_scale(e, ["value"], keys=["event_type"]).withColumn("value", r6("value"))


@register("discretize_null_key", f"""
SELECT event_id, nullif(event_type, '{BLANK}') AS event_type,
  CAST(CASE WHEN value IS NULL THEN NULL WHEN max(value) OVER w = min(value) OVER w THEN 4
       ELSE least(floor((value - min(value) OVER w) / ((max(value) OVER w - min(value) OVER w) / 5.0)), 4) END AS INTEGER) AS band
FROM events WINDOW w AS (PARTITION BY event_type)""")
def q_discretize(spark, sf):
    e = feeds.events(spark, sf, BLANK).select("event_id", "event_type", "value")
    return scalar.discretize(e, "value", "band", 5, keys=["event_type"]).drop("value")


@register("split_null_key", """
WITH h AS (SELECT o_orderkey, nullif(o_orderstatus, 'F') AS o_orderstatus,
             ('0x' || substr(md5('1234|' || CAST(o_orderkey AS VARCHAR)), 1, 15))::BIGINT AS h FROM orders)
SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY h, o_orderkey)
       <= ceil(0.2 * count(*) OVER (PARTITION BY o_orderstatus)) AS is_test
FROM h""")
def q_split(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("F")).alias("o_orderstatus"))
    return train_test_split(o, ["o_orderkey"], 0.2, 1234, keys=["o_orderstatus"])


# --------------------------------------------------- preparation by series
_PREPARED = feeds.SQL_GRIDDED + f""",
p AS (SELECT nullif(event_type, '{BLANK}') AS event_type, ts, value, coalesce(k, 0.0) AS k,
             row_number() OVER (PARTITION BY event_type ORDER BY ts) AS pos FROM grid),
i AS (SELECT *,
  max(CASE WHEN value IS NOT NULL THEN pos END) OVER wu AS p0, last_value(value IGNORE NULLS) OVER wu AS v0,
  min(CASE WHEN value IS NOT NULL THEN pos END) OVER wd AS p1, first_value(value IGNORE NULLS) OVER wd AS v1
  FROM p WINDOW wu AS (PARTITION BY event_type ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                wd AS (PARTITION BY event_type ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
f AS (SELECT event_type, ts, k, CASE WHEN value IS NOT NULL THEN value WHEN p0 IS NULL OR pos - p0 > 4 THEN NULL
        WHEN p1 IS NULL THEN v0 ELSE v0 + (v1 - v0) * (pos - p0) / (p1 - p0) END AS value FROM i),
z AS (SELECT event_type, ts, k, coalesce(value, 0.0) AS value FROM f WHERE value IS NOT NULL)
SELECT event_type, ts,
  round((value - min(value) OVER w) / nullif(max(value) OVER w - min(value) OVER w, 0), 6) AS value,
  round((k - min(k) OVER w) / nullif(max(k) OVER w - min(k) OVER w, 0), 6) AS k,
  CAST(month(ts) AS INTEGER) AS month, CAST(hour(ts) AS INTEGER) AS hour
FROM z WINDOW w AS (PARTITION BY event_type)"""


@register("prepare_model_table_keyed", _PREPARED)
def q_prepare_keyed(spark, sf):
    """W12 on many series, one of them without a key: each is scaled by itself."""
    from .prepare import prepare
    g = feeds.gridded(spark, sf, blank=BLANK).select("event_type", "ts", "value", "k")
    p = prepare(g, target="k", keys=["event_type"], min_valid=2, drop=[])
    return p.select("event_type", "ts", r6("value").alias("value"), r6("k").alias("k"), "month", "hour")


# ------------------------------------------------------ partial time ranges
@register("time_range_month", """
SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-01 00:00:00' AND ts < TIMESTAMP '2024-02-01 00:00:00'""")
def q_month(spark, sf):
    return timeops.time_range(feeds.events(spark, sf).select("event_id", "ts"), "2024,2024-01")


@register("time_range_hour", """
SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-07 11:00:00'""")
def q_hour(spark, sf):
    return timeops.time_range(feeds.events(spark, sf).select("event_id", "ts"), "2024-01-05 06,2024-01-07 10")


@register("time_range_minute", """
SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-05 06:30:00' AND ts < TIMESTAMP '2024-01-07 10:31:00'""")
def q_minute(spark, sf):
    return timeops.time_range(feeds.events(spark, sf).select("event_id", "ts"), "2024-01-05 06:30,2024-01-07 10:30")


# --------------------------------------------------------------- name rules
_DAY = "CAST(date_trunc('day', ts) AS TIMESTAMP)"


def _span_sql(columns: str, span_us: int) -> str:
    """Groups as in A2 over the gridded feed, with the given aggregates."""
    return feeds.SQL_GRIDDED + f""",
bb AS (SELECT event_type, epoch_us(min(ts)) AS st, epoch_us(max(ts)) AS lst FROM grid GROUP BY event_type),
b AS (SELECT event_type, lst,
        CASE WHEN CAST(make_timestamp(st + {span_us}) AS DATE) <> CAST(make_timestamp(st) AS DATE)
             THEN epoch_us(date_trunc('day', make_timestamp(st + {span_us}))) ELSE st + {span_us} END AS b0 FROM bb),
k AS (SELECT grid.*, b.lst, b.b0 + (CAST(floor((epoch_us(grid.ts) - b.b0) / {span_us}.0) AS BIGINT) + 1) * {span_us} AS e
      FROM grid JOIN b USING (event_type)),
a AS (SELECT event_type, e, {columns} FROM k WHERE e <= lst AND epoch_us(ts) <= e - 60000000 GROUP BY event_type, e)
SELECT event_type, make_timestamp(e - 900000000) AS ts, a.* EXCLUDE (event_type, e) FROM a"""


@register("policy_by_name", _span_sql(
    'round(avg(value), 6) AS wind_gust_mph_trend_1h, round(max(value), 6) AS ef_max_trend_1h, '
    'round(max(value), 6) AS "Max Trend", round(avg(value), 6) AS "Climax index"', 6 * 3_600_000_000))
def q_policy(spark, sf):
    """A3 on names outside the catalog: only names with ``Max`` take the maximum."""
    names = ("wind_gust_mph_trend_1h", "ef_max_trend_1h", "Max Trend", "Climax index")
    g = feeds.gridded(spark, sf).select("event_type", "ts", *[F.col("value").alias(n) for n in names])
    out = timeops.time_group(g, "6 hours", keys=["event_type"])
    return out.select("event_type", "ts", *[r6(F.col(f"`{n}`")).alias(n) for n in names])


@register("time_group_decimals", _span_sql(
    "round(round_even(avg(k), 0), 6) AS motion_total, max(k) AS wind_gust_mph, round(round_even(avg(k), 0), 6) AS rf_watts_freq_avg",
    6 * 3_600_000_000))
def q_decimals(spark, sf):
    """A7 on un-normalised data: means rounded to the catalog's decimals,
    maxima as they are (of whole numbers, so that no sum is inexact)."""
    names = ("motion_total", "wind_gust_mph", "rf_watts_freq_avg")
    g = feeds.gridded(spark, sf).select("event_type", "ts", *[F.col("k").alias(n) for n in names])
    out = timeops.time_group(g, "6 hours", keys=["event_type"], normalized=False)
    return out.select("event_type", "ts", *[r6(n).alias(n) for n in names])


# --------------------------------------------------------- smaller operators
@register("parse_file_key", """
SELECT event_id, '4.' || (user_id % 6) AS monitor_id, date_trunc('minute', ts) AS ts FROM events""")
def q_file_key(spark, sf):
    """P3 on names built from the feed's stamps and users."""
    name = F.concat(F.lit("in/192_168_4_"), (F.col("user_id") % 6).cast("string"), F.lit("-"),
                    F.date_format("ts", "yyyy-MM-dd_HH-mm-ss"), F.lit("_counts.csv"))
    e = feeds.events(spark, sf).select("event_id", name.alias("file_name"))
    return timeops.parse_file_key(e).drop("file_name")


@register("sum_per_file", """
WITH f AS (SELECT '4.' || (user_id % 6) AS monitor_id, date_trunc('minute', ts) AS ts, value FROM events)
SELECT monitor_id, ts, round(sum(value), 6) AS total, CAST(count(*) AS BIGINT) AS n FROM f
WHERE minute(ts) % 15 = 0 GROUP BY monitor_id, ts""")
def q_sum_per_file(spark, sf):
    """Rows summed per count file, files off the grid dropped."""
    name = F.concat(F.lit("192_168_4_"), (F.col("user_id") % 6).cast("string"), F.lit("-"),
                    F.date_format(timefn.floor_to_step("ts", "1 minute"), "yyyy-MM-dd_HH-mm-ss"), F.lit("_counts.csv"))
    e = feeds.events(spark, sf).select(name.alias("file_path"), "value", F.lit(1).alias("one"))
    d = files.sum_per_file(e, {"total": "value", "n": "one"})
    return d.select("monitor_id", "ts", r6("total").alias("total"), F.col("n").cast("bigint").alias("n"))


@register("drop_columns", "SELECT event_id, ts, value FROM events")
def q_drop(spark, sf):
    """Listed columns that are there are dropped, others ignored."""
    return scalar.drop_columns(feeds.events(spark, sf), ["event_type", "user_id", "props", "station_id"])


@register("select_columns", "SELECT ts, value, user_id FROM events")
def q_select(spark, sf):
    """P5."""
    return scalar.select_columns(feeds.events(spark, sf), ["ts", "value", "user_id"])


@register("parse_list_text", """
SELECT event_id, [event_type, CAST(user_id AS VARCHAR)] AS input_columns FROM events""")
def q_list_text(spark, sf):
    """The list columns of a results file, written as list text."""
    text = F.concat(F.lit("['"), "event_type", F.lit("', '"), F.col("user_id").cast("string"), F.lit("']"))
    e = feeds.events(spark, sf).select("event_id", text.alias("t"))
    return e.select("event_id", files.parse_list_text("t").alias("input_columns"))


@register("augment_day_sum", q._WIDE_SQL + """,
s AS (SELECT ts, purchase, sum(CASE WHEN hour(ts) = 0 AND minute(ts) = 0 THEN 1 ELSE 0 END)
        OVER (ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg FROM wide)
SELECT ts, round(sum(coalesce(purchase, 0.0)) OVER (PARTITION BY seg ORDER BY ts
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS purchase_sum FROM s""")
def q_augment_sum(spark, sf):
    """W15, selection 1."""
    from .views import augment
    out = augment(q.wide_slots(spark, sf), "1", target="purchase")
    return out.select("ts", r6("purchase_sum").alias("purchase_sum"))


@register("augment_threshold", q._WIDE_SQL + """
SELECT ts, round(CASE WHEN coalesce(view, 0.0) <= 3 THEN 0.0 ELSE view END, 6) AS view FROM wide""")
def q_augment_threshold(spark, sf):
    """W15, selection 2."""
    from .views import augment
    return augment(q.wide_slots(spark, sf), "2", wind="view").select("ts", r6("view").alias("view"))


# ------------------------------------------- tables behind the result plots
@register("grouping_curve_knn", "WITH " + q._knn_sql() + """
SELECT CAST(k / 4.0 AS DOUBLE) AS time_grouping_hours, round(r2_score, 6) AS r2, round(span, 6) AS ci95_span FROM r""")
def q_curve(spark, sf):
    """M15 over the deterministic neighbour sweep (its k stands for the hours)."""
    from .views import grouping_curve
    runs = q.knn_runs(spark, sf).withColumn("data_periodicity_hrs", F.array(F.col("k") / 4.0))
    out = grouping_curve(runs)
    return out.select("time_grouping_hours", r6("r2").alias("r2"), r6("ci95_span").alias("ci95_span"))


@register("actual_vs_predicted", "WITH " + q._knn_sql() + """
SELECT tid AS ts, round(y, 6) AS actual, round(prediction, 6) AS predicted, round(y - prediction, 6) AS residual,
       round((y - prediction) * (y - prediction), 6) AS squared_error
FROM pred JOIN s ON pred.tid = s.vec_id WHERE k = 16""")
def q_actual(spark, sf):
    """M16 over the deterministic neighbour model."""
    from ..models.knn import knn_predict
    from .views import actual_vs_predicted
    d = q.embedding_split(spark, sf)
    train, test = d.filter(~F.col("is_test")), d.filter(F.col("is_test"))
    pred = knn_predict(train, test, [16]).join(test.select("id", "label"), "id")
    out = actual_vs_predicted(pred, ts="id")
    return out.select(F.col("id").alias("ts"), *[r6(c).alias(c) for c in ("actual", "predicted", "residual", "squared_error")])


_PLS_SQL = """WITH
e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS f, CAST(label AS DOUBLE) AS y,
        ('0x' || substr(md5('1234|' || CAST(vec_id AS VARCHAR)), 1, 15))::BIGINT AS h FROM embeddings),
s AS (SELECT *, row_number() OVER (ORDER BY h, vec_id) <= ceil(0.2 * count(*) OVER ()) AS is_test FROM e),
x AS (SELECT vec_id, is_test, y, unnest(f) AS v, generate_subscripts(f, 1) AS i FROM s),
st AS (SELECT i, avg(v) AS m, stddev_samp(v) AS sd FROM x WHERE NOT is_test GROUP BY i),
ym AS (SELECT avg(y) AS m, stddev_samp(y) AS sd FROM s WHERE NOT is_test),
z AS (SELECT x.vec_id, x.is_test, x.y, x.i, (x.v - st.m) / st.sd AS v FROM x JOIN st USING (i)),
c AS (SELECT i, sum(v * (y - ym.m) / ym.sd) AS b FROM z, ym WHERE NOT is_test GROUP BY i),
w AS (SELECT i, b / sqrt(sum(b * b) OVER ()) AS w, b FROM c),
t AS (SELECT vec_id, is_test, y, sum(v * w.w) AS t FROM z JOIN w USING (i) GROUP BY ALL),
q AS (SELECT (SELECT sum(w * b) FROM w) / (SELECT sum(t * t) FROM t WHERE NOT is_test) AS q),
p AS (SELECT t.y, ym.m + ym.sd * t.t * q.q AS prediction FROM t, ym, q WHERE t.is_test),
d AS (SELECT (SELECT max(len(f)) FROM e) AS dims),
m AS (SELECT count(*) AS n, sum((y - prediction) * (y - prediction)) AS rss, stddev_samp(y - prediction) AS rsd, var_pop(y) AS vy FROM p)
SELECT round(1 - rss / (vy * n), 6) AS r2_score,
  round(n * ln(rss / n) + 2 * (2 * dims + 2.0) + 2 * (2 * dims + 2.0) * (2 * dims + 3.0) / (n - (2 * dims + 2.0) - 1), 6) AS aicc,
  round(2 * 1.959963984540054 * rsd / sqrt(n), 6) AS ci95_span, CAST(n AS BIGINT) AS test_length
FROM m, d"""


@register("pls_one_component", _PLS_SQL)
def q_pls_one(spark, sf):
    """M2 with one component, whose closed form SQL can state."""
    out = q.q_pls(spark, sf).filter("pls_components = 1")
    return out.select(r6("r2_score").alias("r2_score"), r6("aicc").alias("aicc"), r6("ci95_span").alias("ci95_span"), "test_length")


# ------------------------------------------------- sources and sinks on tables written first
def _scratch(spark) -> str:
    from ..session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/files-{uuid.uuid4().hex}"


_FEED_COLUMNS = ["Record Number", "Time", "Temperature (F)", "Wind Direction (String)"]


def _feed_csv(df):
    """Rows under the raw names, as text with blanks around values and
    ``nan`` for missing ones."""
    text = lambda c: F.concat(F.lit(" "), c.cast("string"), F.lit(" "))
    return df.select(text(F.col("event_id")).alias("Record Number"), text(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("Time"),
                     F.when(F.col("event_id") % 7 == 0, "nan").otherwise(text(F.col("value"))).alias("Temperature (F)"),
                     text(F.col("event_type")).alias("Wind Direction (String)"))


@register("read_series_csv", """
SELECT event_id AS record_number, ts, CASE WHEN event_id % 7 = 0 THEN NULL ELSE round(value, 6) END AS temperature_f,
       event_type AS wind_dir_txt FROM events""")
def q_read_series(spark, sf):
    """The feed written as CSV with blanks around its values, read again."""
    path = _scratch(spark)
    _feed_csv(feeds.events(spark, sf)).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).csv(path)
    df = files.read_series_csv(spark, path, files.series_schema(_FEED_COLUMNS), files.RAW_TIME_FORMAT)
    return df.withColumn("temperature_f", r6("temperature_f"))


@register("read_many_listed", """
SELECT event_type, CAST(count(*) AS BIGINT) AS n, min(ts) AS first, max(ts) AS last,
       round(sum(CASE WHEN event_id % 7 <> 0 THEN value END), 6) AS total FROM events GROUP BY event_type""")
def q_read_many(spark, sf):
    """A folder for each series, named by a list file; all as one table."""
    path = _scratch(spark)
    e = feeds.events(spark, sf)
    _feed_csv(e).withColumn("part", F.col("Wind Direction (String)")).write.option("header", True).partitionBy("part").csv(f"{path}/feeds")
    made = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{path}/feeds").select(F.col("path").alias("value"))
    made.unionByName(spark.range(2).select(F.when(F.col("id") == 0, "# series").otherwise("").alias("value"))).write.text(f"{path}/list")
    df = files.read_many(spark, f"{path}/list", files.series_schema(_FEED_COLUMNS), time_format=files.RAW_TIME_FORMAT)
    by = df.groupBy("wind_dir_txt", "series_id").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("a"), F.max("ts").alias("b"), F.sum("temperature_f").alias("s"))
    return by.groupBy(F.col("wind_dir_txt").alias("event_type")).agg(
        F.sum("n").alias("n"), F.min("a").alias("first"), F.max("b").alias("last"), F.round(F.sum("s"), 6).alias("total"))


@register("write_series", """
SELECT event_type, ts, event_id, round(value, 6) AS value, TRUE AS in_order FROM events""")
def q_write_series(spark, sf):
    """Written by series, sorted by time; read again with whether each
    row is not before the one ahead of it in its file."""
    path = _scratch(spark)
    files.write_series(feeds.events(spark, sf).select("event_id", "event_type", "ts", "value"), path, keys=["event_type"])
    d = spark.read.parquet(path).withColumn("__file", F.col("_metadata.file_path")).withColumn("__at", F.monotonically_increasing_id())
    ahead = F.lag("ts").over(Window.partitionBy("__file").orderBy("__at"))           # one file of one writer task
    return d.select("event_type", "ts", "event_id", r6("value").alias("value"), F.coalesce(ahead <= F.col("ts"), F.lit(True)).alias("in_order"))


@register("list_columns", """
SELECT CAST(column_index AS INTEGER) AS position, column_name AS name,
       CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' END AS type
FROM (SELECT row_number() OVER () - 1 AS column_index, column_name, column_type AS data_type FROM (DESCRIBE SELECT * FROM events))""")
def q_list_columns(spark, sf):
    """S11."""
    return files.list_columns(feeds.events(spark, sf))


@register("ranked_results_files", q._TWO_SQL + """,
w AS (SELECT *, aicc - min(aicc) OVER (PARTITION BY search) AS delta FROM allr)
SELECT search, CAST(k - 1 AS BIGINT) AS row_index, CAST(k AS VARCHAR) AS knn_neighbors, round(aicc, 5) AS aicc, round(delta, 5) AS delta,
       round(exp(-delta / 2) / sum(exp(-delta / 2)) OVER (PARTITION BY search), 5) AS weight,
       CASE search WHEN 'all' THEN (SELECT max(len(embedding)) FROM embeddings) ELSE (SELECT max(len(embedding)) - 1 FROM embeddings) END::INTEGER AS n_columns
FROM w""")
def q_results_files(spark, sf):
    """Two searches written as results files (list columns as list
    text), read again and ranked for each file, with each row's place in it."""
    from ..operators import stats
    path = _scratch(spark)
    both = q._two_searches(spark, sf)
    names = F.concat(F.lit("['"), F.array_join("input_columns", "', '"), F.lit("']"))
    for search in ("without", "all"):
        one = both.filter(F.col("search") == search).select("search", "knn_neighbors", "aicc", "r2_score", names.alias("input_columns"))
        one.coalesce(1).sortWithinPartitions("knn_neighbors").write.mode("append").option("header", True).csv(path)    # 20 rows
    w = stats.akaike_weights(files.read_results(spark, path), partition=["source_file"])
    return w.select("search", "row_index", "knn_neighbors", F.round("aicc", 5).alias("aicc"), F.round("delta", 5).alias("delta"),
                    F.round("weight", 5).alias("weight"), F.size("input_columns").alias("n_columns"))
