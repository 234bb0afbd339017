"""Plan checks: no cartesian / nested-loop join and no
row-at-a-time Python UDF in any oracle-checked query; pushdown and column
pruning reach the parquet scan."""

import __spark_entry__ as entry
from conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_or_row_udf(spark):
    q = entry.queries()
    for name in entry.oracle_sql():
        plan = _plan(q[name](spark, SF_SMALL))
        for bad in FORBIDDEN:
            assert bad not in plan, (name, bad)


def test_pushdown_and_pruning(spark):
    plan = _plan(entry.queries()["time_range_slice"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,value:double>" in plan
    plan = _plan(entry.queries()["binary_discretize"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_discount:double>" in plan


def test_ordered_operators_read_their_input_once(spark):
    """Rows that pass through an input which counts them: once, however many
    summaries an operator needs."""
    from pyspark.sql import functions as F

    from sensorgrid.operators import ordered
    from sensorgrid.plans.prepare import prepare
    n = 3000

    def counted():
        seen = spark.sparkContext.accumulator(0)

        def run(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b

        rows = spark.range(0, n, 1, 3).select(
            F.expr("timestampadd(MINUTE, CAST(id * 15 AS INT), TIMESTAMP_NTZ'2024-01-01')").alias("ts"), (F.col("id") % 2).cast("string").alias("k"),
            F.when(F.col("id") % 5 > 0, F.col("id") % 17).cast("double").alias("x"), (F.col("id") % 3).cast("double").alias("y"))
        return rows.mapInArrow(run, rows.schema), seen

    for op in (lambda d: ordered.interpolate(d, ["x", "y"], keys=["k"], limit=4), lambda d: ordered.running_day_sum(d, "x", keys=["k"]),
               lambda d: ordered.smooth(d, "x", 5, keys=["k"]), lambda d: prepare(d, target="y", keys=["k"], min_valid=1, drop=[])):
        rows, seen = counted()
        assert op(rows).count() == n
        assert seen.value == n
    rows, seen = counted()
    assert ordered.minmax_scale(rows, ["x"], keys=["k"]).count() == n and seen.value > n        # the count can tell: two readings here
