import public_tokenizers
import pytest

import corpus_pipeline as cp
from sensorgrid.llm import queries

SF = "/root/testdata/sf0.001"


def write(spark, tmp_path, docs, labels):
    root = str(tmp_path / "t")
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for k, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, SF)
        assert out.count() > 0
        if k < len(cp.STAGES) - 1:
            assert out.schema == docs.schema or [f.name for f in out.schema] == docs.columns, name
    assert [n for n, _ in cp.STAGES] == ["toxicity", "line dedup", "near copies", "mixing", "byte-level BPE"]


def test_run_equals_the_stages_by_hand(spark):
    out = cp.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in cp.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), stage(spark, docs, SF).schema)
    key = lambda r: (r.doc_id, r.text, r.ids)
    assert sorted(map(key, out.collect())) == sorted(map(key, docs.collect()))
    assert out.filter("not round_trip").count() == 0


def test_planted_documents(spark, tmp_path):
    import random
    rnd = random.Random(8)
    clean = lambda: " ".join("".join(rnd.choice(["ka", "to", "mi", "re"]) for _ in range(rnd.randint(2, 5))) for _ in range(60))
    rows, labels = [], []
    for i in range(200):
        t = clean()
        if i % 4 == 0:
            t = t.replace(" ", " moron ", 3)
        rows.append((i, t, "en", "s", len(t)))
        labels.append((i, int(i % 7 != 0), int(i % 4 == 0)))
    near = rows[1][1].split()
    near[30] = "changed"
    passage = " ".join(rows[2][1].split()[:55])
    rows += [(300, rows[3][1], "en", "s", 0), (301, " ".join(near), "en", "s", 0), (302, clean() + "\n" + passage, "en", "s", 0),
             (303, clean() + "\n" + passage, "en", "s", 0), (304, None, "en", "s", 0), (305, "", None, None, None), (306, "x", "en", "s", 1), (306, "x", "en", "s", 1)]
    root = write(spark, tmp_path, rows, labels)
    docs = spark.read.parquet(f"{root}/documents.parquet")
    seen = []
    for name, stage in cp.STAGES[:4]:
        path = str(tmp_path / name.replace(" ", "_"))
        stage(spark, docs, root).write.parquet(path)
        docs = spark.read.parquet(path)
        rows = docs.collect()
        seen.append({r.doc_id: r.text for r in rows})
        if name == "near copies":
            assert sum(r.doc_id == 306 for r in rows) == 1
    first, second, third, fourth = seen
    assert not any(i % 4 == 0 for i in first if i < 200) and all(i in first for i in range(200) if i % 4)
    assert 300 not in second and 301 not in second                       # copies of lines that came before
    assert passage not in second[303] and second[303]                    # a passage that an earlier document holds goes
    clean_ids = [i for i in range(200) if i % 4 and i % 7]
    assert all(i in third for i in clean_ids) and all(i in fourth for i in clean_ids)


def test_without_labels_nothing_is_rejected_and_empty_tables_stay_empty(spark, tmp_path):
    rows = [(i, f"first words of text {i}\nand a line " + " ".join(str(i * k) for k in range(9)), "en", "s", 30) for i in range(20)] + [(90, None, None, None, None)]
    root = write(spark, tmp_path / "a", rows, spark.createDataFrame([], "doc_id bigint, quality int, toxic int").collect())
    docs = spark.read.parquet(f"{root}/documents.parquet")
    kept = cp.drop_toxic(spark, docs, root)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in rows)
    assert cp.run(spark, root).count() > 0
    none = write(spark, tmp_path / "b", [], [(1, 1, 0), (2, 0, 1)])
    assert cp.run(spark, none).count() == 0


def test_queries_are_registered_with_their_oracles():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert {f"op{n}_" for n in range(1, 14)} == {n.split("_")[0] + "_" for n in names if n.startswith("op") and n[2].isdigit()}
    assert "pipeline" in names and set(entry.oracle_sql()) <= names


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_match_duckdb(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF)
    res = con.execute(queries.ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(got.columns)
    text = lambda rows: sorted(repr(tuple(float(x) if isinstance(x, (int, float)) else x for x in r)) for r in rows)
    assert text(got.select(*cols).collect()) == text(res.fetchall())
    assert public_tokenizers.PATTERN
