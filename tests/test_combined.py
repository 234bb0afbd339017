import datetime as dt
import os
import tempfile

from sensorgrid.plans.combined import combined_table

HEADER = "FRAME,UPWARD,DOWNWARD,LATERAL,TOTAL,TOTAL_THRESHOLD,TOTAL_ARRAY_COUNT\n"


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_raw_feeds_to_combined_table(spark):
    root = tempfile.mkdtemp(prefix="combined-", dir="/tmp")
    cols = ["Record Number", "Time", "Temperature (F)", "Avg. EF (V/m)"]
    lines = [", ".join(cols)]
    stamps = ["2020-05-16 16:38:54.100572", "2020-05-16 16:53:55.786168", "2020-05-16 17:08:56.629817",
              "2020-05-16 17:38:59.409071", "2020-05-16 17:53:58.000001"]
    for i, s in enumerate(stamps):
        ef = "nan" if i == 2 else f"{0.5 + i}"
        lines.append(f"{i + 1}, {s},{60 + i}.5, {ef}")
    _write(f"{root}/weather.csv", "\n".join(lines) + "\n")
    for t, tot in (("16-45-00", 5), ("17-00-00", 6), ("17-15-00", 7), ("17-30-00", 8), ("18-00-00", 9)):
        _write(f"{root}/counts/192_168_4_5-2020-05-16_{t}_counts.csv", HEADER + f"1,1,1,1,{tot},0.5,1\n")
    solar = spark.createDataFrame([(dt.datetime(2020, 5, 16, 16, 0), 1.23456), (dt.datetime(2020, 5, 16, 17, 59), 2.0)],
                                  "ts timestamp_ntz, solar_mjm2 double")
    out, report = combined_table(spark, f"{root}/weather.csv", cols, f"{root}/counts", solar)
    rows = {r.ts: r for r in out.collect()}
    # common range: later first row (16:45) to earlier last row (18:00)
    assert min(rows) == dt.datetime(2020, 5, 16, 16, 45) and max(rows) == dt.datetime(2020, 5, 16, 18, 0)
    assert [rows[t].record_number for t in sorted(rows)] == list(range(1, len(rows) + 1))
    r1715 = rows[dt.datetime(2020, 5, 16, 17, 15)]
    assert r1715.temperature_f == 62.5 and r1715.motion_total == 7
    assert r1715.ef_avg == 2.5                       # the nan reading, interpolated between 1.5 and 3.5
    assert rows[dt.datetime(2020, 5, 16, 17, 30)].temperature_f is None   # no weather row at 17:30
    assert rows[dt.datetime(2020, 5, 16, 16, 45)].solar_mjm2 == 1.235
    assert rows[dt.datetime(2020, 5, 16, 17, 45)].solar_mjm2 == 2.0
    g = report.first()
    assert (g.n_rows, g.duplicates, g.gaps) == (5, 0, 1)


def test_stations_monitors_and_file_order(spark):
    """Two weather files of one station (the logger restarts its numbers, a
    stamp jumps back), a second station, two monitors."""
    root = tempfile.mkdtemp(prefix="combined-", dir="/tmp")
    cols = ["Record Number", "Time", "Temperature (F)", "Station ID"]

    def weather(name, rows):
        _write(f"{root}/weather/{name}.csv", "\n".join([", ".join(cols)] + [f"{n}, 2020-05-16 {t}:00.000000,{x}, {s}" for n, t, x, s in rows]) + "\n")

    weather("a", [(1, "16:45", 1, 1), (2, "17:00", 2, 1), (3, "16:45", 99, 1)])
    weather("b", [(1, "17:15", 3, 1), (2, "17:30", 4, 1), (1, "16:45", 50, 2), (2, "17:00", 51, 2)])
    for monitor, base in (("4_5", 100), ("4_10", 999)):
        for k, t in enumerate(("16-45-00", "17-00-00", "17-15-00", "17-30-00")):
            _write(f"{root}/counts/{monitor}/192_168_{monitor}-2020-05-16_{t}_counts.csv", HEADER + f"1,1,1,1,{base + k},0.5,1\n")
    out, report = combined_table(spark, [f"{root}/weather/a.csv", f"{root}/weather/b.csv"], cols, f"{root}/counts")
    got = {(r.station_id, r.monitor_id, r.ts.strftime("%H:%M")): (r.record_number, r.temperature_f, r.motion_total) for r in out.collect()}
    want = {}
    for monitor, base in (("4.5", 100), ("4.10", 999)):
        for k, t in enumerate(("16:45", "17:00", "17:15", "17:30")):
            want[(1, monitor, t)] = (k + 1, float(k + 1), base + k)         # not 99: the file went back there
        want[(2, monitor, "16:45")] = (1, 50.0, base)
        want[(2, monitor, "17:00")] = (2, 51.0, base + 1)
    assert got == want
    assert {r.station_id: (r.n_rows, r.duplicates) for r in report.collect()} == {1: (5, 1), 2: (2, 0)}
    some = spark.createDataFrame([(2, "4.10")], "station_id int, monitor_id string")
    out, _ = combined_table(spark, [f"{root}/weather/a.csv", f"{root}/weather/b.csv"], cols, f"{root}/counts", pairs=some)
    assert {(r.station_id, r.monitor_id) for r in out.collect()} == {(2, "4.10")}
