import duckdb

import __spark_entry__ as entry
from conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events embeddings".split()


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"event_type", "ts", "temperature_f", "wind_dir_deg"} <= set(df.columns)


def test_oracle_keys_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def _canon(rows):
    out = []
    for r in rows:
        out.append(tuple("∅" if v is None or (isinstance(v, float) and v != v) else
                         (round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v))
                         for v in r))
    return sorted(out, key=repr)


def test_some_queries_match_oracle(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name in ("round_quarter_hour", "interpolate_limit4", "time_group_3h", "trend_1h", "spine_pairing",
                 "corr_pearson", "fit_line"):
        sdf = entry.queries()[name](spark, SF_SMALL)
        cols = sorted(sdf.columns)
        got = _canon(sdf.select(*cols).collect())
        res = con.execute(entry.oracle_sql()[name])
        names = [d[0] for d in res.description]
        assert sorted(names) == cols, name
        idx = [names.index(c) for c in cols]
        want = _canon([tuple(r[i] for i in idx) for r in res.fetchall()])
        assert got == want, name
