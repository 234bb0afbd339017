import datetime as dt
import math
import random

import pandas as pd
import pytest

from sensorgrid.operators import align, ordered

T0 = dt.datetime(2024, 1, 1)


def _series(spark, values, key="a", step=15):
    rows = [(key, T0 + dt.timedelta(minutes=step * i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, x double")


def _vals(df, col="x"):
    return [r[col] for r in df.orderBy("k", "ts").collect()]


N = None
GOLD_IN = [N, 1, N, N, N, N, N, 7, N, N, N, N, N]


@pytest.mark.parametrize("chunk", [None, "45 minutes", "2 hours", "auto"])
def test_interpolate_golden(spark, chunk):
    df = _series(spark, GOLD_IN)
    full = _vals(ordered.interpolate(df, ["x"], keys=["k"], chunk=chunk))
    lim = _vals(ordered.interpolate(df, ["x"], keys=["k"], limit=4, chunk=chunk))
    assert full == [N, 1, 2, 3, 4, 5, 6, 7, 7, 7, 7, 7, 7]
    assert lim == [N, 1, 2, 3, 4, 5, N, 7, 7, 7, 7, 7, N]


def _pandas_interp(vals, limit):
    s = pd.Series(vals, dtype="float64")
    out = s.interpolate(limit=limit) if limit else s.interpolate()
    return [None if math.isnan(v) else v for v in out]


def test_interpolate_random_vs_pandas(spark):
    random.seed(2)
    rows, expect = [], {}
    for key in ("a", "b", "c"):
        vals = [None if random.random() < 0.45 else float(random.randint(0, 50)) for _ in range(150)]
        rows += [(key, T0 + dt.timedelta(minutes=15 * i), v) for i, v in enumerate(vals)]
        expect[key] = vals
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, x double")
    for limit in (None, 2, 4):
        out = ordered.interpolate(df, ["x"], keys=["k"], limit=limit, chunk="3 hours").orderBy("k", "ts").collect()
        for key in expect:
            got = [r.x for r in out if r.k == key]
            want = _pandas_interp(expect[key], limit)
            assert len(got) == len(want)
            for g, w in zip(got, want):
                assert (g is None and w is None) or abs(g - w) < 1e-9


def test_smooth_golden(spark):
    c = ordered.smooth(_series(spark, [float(i) for i in range(8)]), "x", 4, center=True, keys=["k"], block=3)
    assert _vals(c, "x_smoothed") == [N, N, 1.5, 2.5, 3.5, 4.5, 5.5, N]
    t = ordered.smooth(_series(spark, [1, 2, N, 4, 5, 6]), "x", 2, keys=["k"], block=2)
    assert _vals(t, "x_smoothed") == [N, 1.5, N, N, 4.5, 5.5]


def test_smooth_random_vs_pandas(spark):
    random.seed(4)
    vals = [None if random.random() < 0.1 else float(random.randint(0, 9)) for _ in range(200)]
    df = _series(spark, vals)
    for w, center in ((3, False), (4, True), (5, True)):
        got = _vals(ordered.smooth(df, "x", w, center=center, keys=["k"], chunk="5 hours", block=17), "x_smoothed")
        want = pd.Series(vals, dtype="float64").rolling(w, center=center).mean()
        for g, e in zip(got, want):
            assert (g is None and math.isnan(e)) or abs(g - e) < 1e-9


def test_running_day_sum(spark):
    random.seed(6)
    rows = []
    t = dt.datetime(2024, 1, 1, 20, 0)
    for i in range(300):
        t += dt.timedelta(minutes=15 * random.choice([1, 1, 1, 3]))
        rows.append(("a", t, None if random.random() < 0.2 else float(random.randint(0, 9))))
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, x double")
    got = _vals(ordered.running_day_sum(df, "x", keys=["k"], chunk="6 hours"), "x_day_sum")
    want, acc = [], 0.0
    for _, ts, v in rows:
        if ts.hour == 0 and ts.minute == 0:
            acc = 0.0
        acc += v or 0.0
        want.append(acc)
    assert all(abs(g - w) < 1e-9 for g, w in zip(got, want))


def test_trend_vs_lookup(spark):
    random.seed(8)
    rows = []
    t = T0
    for i in range(250):
        t += dt.timedelta(minutes=15 * random.choice([1, 1, 2]))
        rows.append(("a", t, None if random.random() < 0.1 else round(random.uniform(0, 1), 3)))
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, x double")
    by_ts = {r[1]: r[2] for r in rows}
    for hours in (1, 5):
        span = dt.timedelta(hours=hours)
        name = ordered.trend_name("x", span)
        got = [r[name] for r in ordered.trend(df, "x", span, keys=["k"], chunk="1 day").orderBy("ts").collect()]
        for (_, ts, v), g in zip(rows, got):
            prev = by_ts.get(ts - span, v) if (ts - span) in by_ts else v
            want = None if v is None or prev is None else round(v - prev, 2)
            assert g == want


def _cursor_pairing(spine, side):
    """Sequential restatement of the forward-cursor pairing."""
    out, i = {}, 0
    for t in spine:
        while i < len(side) and side[i][0] < t:
            i += 1
        if i < len(side) and side[i][0] == t:
            out[t] = side[i][1]
            i += 1
        else:
            out[t] = None
    return out


def test_pair_on_spine_vs_cursor(spark):
    random.seed(9)
    for trial in range(3):
        side, t = [], T0
        for i in range(120):
            t += dt.timedelta(minutes=15 * random.choice([0, 1, 1, 2, -1, -3]))
            side.append((t, float(i)))
        spine = [T0 + dt.timedelta(minutes=15 * i) for i in range(-4, 140)]
        sp = spark.createDataFrame([(s,) for s in spine], "ts timestamp_ntz")
        sd = spark.createDataFrame([(i, ts, v) for i, (ts, v) in enumerate(side)], "rid long, ts timestamp_ntz, v double")
        got = {r.ts: r.v for r in align.pair_on_spine(sp, sd, order="rid", chunk=17).collect()}
        assert got == _cursor_pairing(spine, side)


def test_zscore_rules(spark):
    vals = [1.0] * 30 + [100.0]
    df = _series(spark, vals)
    assert _vals(ordered.zscore_outliers(df, ["x"], keys=["k"]))[-1] is None
    df2 = _series(spark, vals + [None])
    assert _vals(ordered.zscore_outliers(df2, ["x"], keys=["k"]))[-2] == 100.0   # any NULL: untouched


def test_minmax_constant(spark):
    df = _series(spark, [2.0, 2.0, 2.0])
    assert _vals(ordered.minmax_scale(df, ["x"])) == [N, N, N]
    assert _vals(ordered.minmax_scale(df, ["x"], constant="zero")) == [0.0, 0.0, 0.0]


def test_augment_dispatch(spark):
    from sensorgrid.plans.views import augment
    rows = [(T0 + dt.timedelta(minutes=15 * i), float(i), float(i % 5)) for i in range(8)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, motion_total double, wind_speed_mph double")
    a1 = augment(df, "1").orderBy("ts").collect()
    assert [r.motion_total_sum for r in a1] == [0, 1, 3, 6, 10, 15, 21, 28]
    a2 = augment(df, "2").orderBy("ts").collect()
    assert [r.wind_speed_mph for r in a2] == [0, 0, 0, 0, 4, 0, 0, 0]
    assert augment(df, "9") is df


def test_trends_paired_columns(spark):
    rows = [("a", T0 + dt.timedelta(minutes=15 * i), float(i), float(i * i)) for i in range(20)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, x double, y double")
    out = ordered.trends(df, [("x", "1 hour"), ("y", "30 minutes")], keys=["k"]).orderBy("ts").collect()
    nx, ny = ordered.trend_name("x", "1 hour"), ordered.trend_name("y", "30 minutes")
    assert nx == "x 1:00:00 Trend" and ny == "y 0:30:00 Trend"
    assert [r[nx] for r in out][:6] == [0, 0, 0, 0, 4, 4]
    assert [r[ny] for r in out][:4] == [0, 0, 4 - 0, 9 - 1]


def test_interpolation_reads_no_frame_to_the_end_of_a_window(spark, monkeypatch):
    """such a frame is read anew for every row of a chunk."""
    monkeypatch.setattr(ordered, "cut_lineage", lambda d: d)
    rows = [("a", i, None if i % 3 else float(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "k string, i long, v double")
    d = ordered.interpolate(df, ["v"], keys=["k"], order="i", chunk=7)
    assert "unboundedfollowing" not in d._jdf.queryExecution().optimizedPlan().toString().lower()
    assert [r.v for r in d.orderBy("i").collect()] == [float(min(i, 18)) for i in range(20)]
