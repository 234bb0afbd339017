"""Scale shape of the ordered operators on a skewed synthetic feed: one
series holds most rows; no window may be partitioned by the series key
alone unless it runs over chunk summaries (ordered by the chunk)."""

import re

from pyspark.sql import functions as F

from sensorgrid.operators import align, ordered, timeops


def _feed(spark):
    # key "hot" has 20k rows, 50 small keys have 20 rows each (15-minute grid)
    hot = spark.range(20_000).select(F.lit("hot").alias("k"), F.col("id"))
    cold = spark.range(1_000).select(F.concat(F.lit("c"), (F.col("id") % 50).cast("string")).alias("k"),
                                     (F.col("id") / 50).cast("long").alias("id"))
    d = hot.unionByName(cold)
    ts = F.timestamp_add("MINUTE", F.col("id") * 15, F.lit("2024-01-01").cast("timestamp_ntz"))
    x = F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise((F.col("id") % 13).cast("double"))
    return d.select("k", "id", ts.alias("ts"), x.alias("x"))


def _windows(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Window \[.*?\], \[(.*?)\], \[(.*?)\]", plan)


def _check(df):
    wins = _windows(df)
    assert wins
    for part, order in wins:
        chunked = "__chunk" in part or "__blk" in part
        summary = "__chunk" in order and "__chunk" not in part
        assert chunked or summary, (part, order)


def test_ordered_operators_are_chunked(spark):
    f = _feed(spark)
    _check(ordered.interpolate(f, ["x"], keys=["k"], limit=4))
    _check(ordered.trend_sweep(f, ["x"], hours=(1, 2, 24), keys=["k"]))
    _check(ordered.running_day_sum(f, "x", keys=["k"]))
    _check(ordered.smooth(f, "x", 4, center=True, keys=["k"]))
    _check(align.keep_forward(f, ["k"], order="id"))
    _check(timeops.gap_report(f, ["k"], order="id"))


def test_hot_key_results(spark):
    f = _feed(spark)
    out = ordered.interpolate(f, ["x"], keys=["k"], chunk="1 day")
    hot = out.filter("k = 'hot'")
    assert hot.count() == 20_000 and hot.filter(F.col("x").isNull()).count() == 1   # only the leading NULL
    s = ordered.running_day_sum(f, "x", keys=["k"], chunk="1 day").filter("k = 'hot'")
    assert s.filter(F.col("x_day_sum") < 0).count() == 0
