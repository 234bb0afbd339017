import datetime as dt
import os
import tempfile

from pyspark.sql import Observation

from sensorgrid.sources import files


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


# Fixed value: the header of a count file.
HEADER = "FRAME,UPWARD,DOWNWARD,LATERAL,TOTAL,TOTAL_THRESHOLD,TOTAL_ARRAY_COUNT\n"


def test_count_files(spark):
    root = tempfile.mkdtemp(prefix="counts-", dir="/tmp")
    _write(f"{root}/192_168_4_5-2020-04-30_10-45-00_counts.csv",
           HEADER + "1,2,3,4,9,0.5,1\n2,1,1,1,3,0.5,1\n")
    _write(f"{root}/192_168_4_5-2020-04-30_10-52-00_counts.csv", HEADER + "1,5,5,5,15,0.5,1\n")
    _write(f"{root}/192_168_4_10-2020-04-30_11-00-00_counts.csv", HEADER)
    _write(f"{root}/sub/dir/192_168_4_5-2020-04-30_11-15-00_counts.csv",
           HEADER + '"1","7","0","1","8","0.5","1"\n')
    _write(f"{root}/sub/192_168_4_7-2020-04-30_11-30-00_counts.csv", "")                # a zero-byte file is a record of zeros
    _write(f"{root}/_SUCCESS", "")
    obs = Observation("counts")
    rows = {(r.monitor_id, r.ts): r for r in files.read_count_files(spark, root, observation=obs).collect()}
    assert set(rows) == {("4.5", dt.datetime(2020, 4, 30, 10, 45)), ("4.10", dt.datetime(2020, 4, 30, 11, 0)),
                         ("4.5", dt.datetime(2020, 4, 30, 11, 15)), ("4.7", dt.datetime(2020, 4, 30, 11, 30))}
    assert rows[("4.7", dt.datetime(2020, 4, 30, 11, 30))].motion_total == 0
    r = rows[("4.5", dt.datetime(2020, 4, 30, 10, 45))]
    assert (r.motion_up, r.motion_down, r.motion_lateral, r.motion_total) == (3, 4, 5, 12)
    assert rows[("4.10", dt.datetime(2020, 4, 30, 11, 0))].motion_total == 0
    assert rows[("4.5", dt.datetime(2020, 4, 30, 11, 15))].motion_up == 7
    assert obs.get["discarded"] == 1


def test_weather_csv_blanks_and_nan(spark):
    root = tempfile.mkdtemp(prefix="weather-", dir="/tmp")
    _write(f"{root}/w.csv", "Record Number, Time, Temperature (F), Wind Direction (String), Avg. EF (V/m)\n"
                            "1, 2020-05-16 16:38:54.100572,67.8, WSW,nan\n"
                            "2, 2020-05-16 16:53:55.786168,,N,0.5\n")
    schema = files.series_schema(["Record Number", "Time", "Temperature (F)", "Wind Direction (String)",
                                  "Avg. EF (V/m)"])
    df = files.read_series_csv(spark, f"{root}/w.csv", schema, files.RAW_TIME_FORMAT)
    rows = df.orderBy("record_number").collect()
    assert df.columns == ["record_number", "ts", "temperature_f", "wind_dir_txt", "ef_avg"]
    assert rows[0].ts == dt.datetime(2020, 5, 16, 16, 38, 54, 100572)
    assert rows[0].wind_dir_txt == "WSW" and rows[0].ef_avg is None
    assert rows[1].temperature_f is None and rows[1].ef_avg == 0.5


def test_read_many_and_write(spark):
    root = tempfile.mkdtemp(prefix="many-", dir="/tmp")
    for name in ("a", "b"):
        _write(f"{root}/{name}.csv", "Time,TotalMotion\n2020-05-16 17:00:00,5\n2020-05-16 17:15:00,6\n")
    _write(f"{root}/list.txt", f"# comment\n\n{root}/a.csv\n{root}/b.csv\n")
    schema = files.series_schema(["Time", "TotalMotion"])
    df = files.read_many(spark, f"{root}/list.txt", schema)
    assert df.count() == 4 and df.select("series_id").distinct().count() == 2
    out = f"{root}/out"
    files.write_series(df, out, keys=["series_id"])
    assert spark.read.parquet(out).count() == 4
    cols = files.list_columns(df).collect()
    assert [c.name for c in cols] == ["ts", "motion_total", "series_id"]


def test_results_roundtrip(spark):
    root = tempfile.mkdtemp(prefix="res-", dir="/tmp")
    _write(f"{root}/r1.csv", "r2_score,aicc,input_columns,max_depth\n0.5,10.0,\"['a', 'b']\",n/a\n0.6,8.0,\"['a']\",6\n")
    df = files.read_results(spark, root)
    rows = df.orderBy("aicc").collect()
    assert rows[0].input_columns == ["a"] and rows[1].input_columns == ["a", "b"]
    assert rows[1].max_depth is None and rows[0].source_file == "r1.csv"
    assert [r.row_index for r in rows] == [1, 0]


def test_changed_days_alone_are_made_again(spark):
    from pyspark.sql import functions as F

    from sensorgrid.plans.prepare import trend_table
    path = tempfile.mkdtemp(prefix="features-", dir="/tmp") + "/cache"
    hours = range(1, 25)

    def feed(change=None, days=10):
        d = spark.range(days * 96).select(F.expr("timestampadd(MINUTE, CAST(id * 15 AS INT), TIMESTAMP_NTZ'2024-03-01')").alias("ts"), (F.col("id") % 13).cast("double").alias("x"))
        return d if change is None else d.withColumn("x", F.when(F.to_date("ts") == change, F.col("x") + 1).otherwise(F.col("x")))

    def written():
        got = spark.read.parquet(f"{path}/table").select("__day", F.col("_metadata.file_name").alias("f")).distinct().collect()
        return {r["__day"]: r.f for r in got}

    rows = lambda d: sorted(map(tuple, d.select("ts", "x", "x 1:00:00 Trend", "x 1 day, 0:00:00 Trend").collect()))
    first = trend_table(feed(), ["x"], hours, cache=path)
    assert rows(first) == rows(trend_table(feed(), ["x"], hours))
    before = written()
    trend_table(feed(), ["x"], hours, cache=path)
    assert written() == before                                    # nothing changed, nothing written
    later = trend_table(feed("2024-03-05"), ["x"], hours, cache=path)
    assert rows(later) == rows(trend_table(feed("2024-03-05"), ["x"], hours))
    day = (dt.date(2024, 3, 5) - dt.date(1970, 1, 1)).days
    after = written()
    assert {d for d in after if after[d] != before[d]} == {day, day + 1}
    short = trend_table(feed("2024-03-05", 8), ["x"], hours, cache=path)
    assert rows(short) == rows(trend_table(feed("2024-03-05", 8), ["x"], hours))
