import datetime as dt
import random

from pyspark.sql import Observation

from sensorgrid.functions.mathfn import round_half_even
from sensorgrid.operators import timeops

GOLDEN = [
    ("2020-05-16 16:38:54.100572", "2020-05-16 16:45:00"),
    ("2020-05-16 16:53:55.786168", "2020-05-16 17:00:00"),
    ("2020-05-16 17:08:56.629817", "2020-05-16 17:15:00"),
    ("2020-05-16 17:23:58.887251", "2020-05-16 17:30:00"),
    ("2020-05-16 17:38:59.409071", "2020-05-16 17:45:00"),
    ("2020-05-16 10:07:30.000000", "2020-05-16 10:15:00"),
    ("2020-05-16 10:07:29.999999", "2020-05-16 10:00:00"),
]


def _ts(s):
    return dt.datetime.fromisoformat(s)


def test_round_golden(spark):
    df = spark.createDataFrame([(_ts(a),) for a, _ in GOLDEN], "ts timestamp_ntz")
    got = [r.ts for r in timeops.round_time(df).collect()]
    assert got == [_ts(b) for _, b in GOLDEN]


def test_shift_and_month_hour(spark):
    df = spark.createDataFrame([(_ts("2020-05-16 23:30:00"),)], "ts timestamp_ntz")
    r = timeops.add_month_hour(timeops.shift_time(df, 54)).first()
    assert r.ts == _ts("2020-05-17 00:24:00") and r.month == 5 and r.hour == 0


def test_night_filter_edges(spark):
    stamps = ["06:59:59", "07:00:00", "20:59:59", "21:00:00", "21:29:59", "21:30:00"]
    df = spark.createDataFrame([(_ts("2020-05-16 " + s),) for s in stamps], "ts timestamp_ntz")
    m = {r.ts.strftime("%H:%M:%S") for r in timeops.exclude_nights(df, "21:00").collect()}
    e = {r.ts.strftime("%H:%M:%S") for r in timeops.exclude_nights(df, "21:30").collect()}
    assert m == {"07:00:00", "20:59:59"}
    assert e == {"07:00:00", "20:59:59", "21:00:00", "21:29:59"}


def test_time_range_partial_end(spark):
    df = spark.createDataFrame([(_ts(s),) for s in ["2020-05-01 00:00:00", "2020-05-02 23:45:00",
                                                     "2020-05-03 00:00:00"]], "ts timestamp_ntz")
    got = timeops.time_range(df, "2020-05-01,2020-05-02").count()
    assert got == 2


def test_parse_file_key_and_off_grid(spark):
    names = ["192_168_4_5-2020-04-30_10-45-00_counts.csv",
             "192_168_4_10-2020-04-30_10-52-00_counts.csv",
             "nested/dir/192_168_4_5-2020-04-30_11-00-59_y.csv"]
    df = spark.createDataFrame([(n,) for n in names], "file_name string")
    d = timeops.parse_file_key(df)
    rows = {r.file_name: (r.monitor_id, r.ts) for r in d.collect()}
    assert rows[names[0]] == ("4.5", _ts("2020-04-30 10:45:00"))
    assert rows[names[1]] == ("4.10", _ts("2020-04-30 10:52:00"))
    assert rows[names[2]][1] == _ts("2020-04-30 11:00:00")
    obs = Observation("grid")
    kept = timeops.drop_off_grid(d, observation=obs).count()
    assert kept == 2 and obs.get["discarded"] == 1


def test_round_half_even_matches_python(spark):
    random.seed(3)
    vals = [2.5, 0.125, 1.015, -1.015, 2.675, 0.5, 1.5] + [round(random.uniform(-50, 50), 3) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for places in (0, 1, 2, 3):
        got = [r.r for r in df.select(round_half_even("x", places).alias("r")).collect()]
        assert got == [round(v, places) for v in vals]


def test_gap_report_vs_sequential(spark):
    random.seed(5)
    rows = []
    t = dt.datetime(2024, 1, 1)
    for i in range(400):
        t += dt.timedelta(minutes=random.choice([0, 15, 15, 15, 30, 45, -15]))
        rows.append((i, t))
    df = spark.createDataFrame(rows, "rid long, ts timestamp_ntz")
    dup = sum(1 for a, b in zip(rows, rows[1:]) if b[1] <= a[1])
    gap = sum(1 for a, b in zip(rows, rows[1:]) if (b[1] - a[1]) > dt.timedelta(minutes=15))
    for chunk in (None, 37, 100):
        r = timeops.gap_report(df, [], order="rid", chunk=chunk).first()
        assert (r.n_rows, r.duplicates, r.gaps) == (400, dup, gap)


def _group_sequential(times, values, span):
    """Sequential restatement of the anchored grouping (A2) for one series."""
    start, last = times[0], times[-1]
    end = start + span
    if end.day != start.day:
        end = end.replace(hour=0, minute=0, second=0, microsecond=0)
    out = []
    while end <= last:
        seg = [v for t, v in zip(times, values) if start <= t <= end - dt.timedelta(minutes=1)]
        if seg:
            out.append((end - dt.timedelta(minutes=15), sum(seg) / len(seg), max(seg)))
        start, end = end, end + span
    return out


def test_time_group_vs_sequential(spark):
    random.seed(11)
    for span_h in (1, 3, 5, 24):
        t = dt.datetime(2024, 3, 1, random.randint(0, 23), 15 * random.randint(0, 3))
        times, values = [], []
        for _ in range(300):
            t += dt.timedelta(minutes=15 * random.choice([1, 1, 1, 2, 5]))
            times.append(t)
            values.append(float(random.randint(0, 100)))
        df = spark.createDataFrame(list(zip(times, values, values)), "ts timestamp_ntz, temperature_f double, ef_max double")
        got = sorted((r.ts, r.temperature_f, r.ef_max) for r in
                     timeops.time_group(df, f"{span_h} hours").collect())
        want = _group_sequential(times, values, dt.timedelta(hours=span_h))
        assert len(got) == len(want)
        for g, w in zip(got, want):
            assert g[0] == w[0] and abs(g[1] - w[1]) < 1e-9 and g[2] == w[2]


def test_time_group_identity_and_error(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), 1.0)], "ts timestamp_ntz, x double")
    assert timeops.time_group(df, "15 minutes") is df
    try:
        timeops.time_group(df, "10 minutes")
        raise AssertionError("expected an error")
    except ValueError:
        pass


def test_spine_inclusive(spark):
    r = spark.createDataFrame([(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 1))],
                              "start timestamp_ntz, end timestamp_ntz")
    s = timeops.spine(r).orderBy("ts").collect()
    assert [x.record_number for x in s] == [1, 2, 3, 4, 5]
    assert s[-1].ts == dt.datetime(2024, 1, 1, 1)


def test_spine_blocks_equal_single_block(spark):
    r = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 3)),
                               ("b", dt.datetime(2024, 1, 5, 10), dt.datetime(2024, 1, 5, 10))],
                              "k string, start timestamp_ntz, end timestamp_ntz")
    one = sorted(map(tuple, timeops.spine(r, ["k"]).collect()))
    many = sorted(map(tuple, timeops.spine(r, ["k"], block=7).collect()))
    assert one == many and len(one) == 27 * 4 + 1 + 1
