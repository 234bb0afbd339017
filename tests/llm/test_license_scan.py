from sensorgrid.llm import license_scan as ls
from sensorgrid.llm.license_texts import KNOWN, MIT


def test_variants_of_known_texts(spark):
    rows = [
        (1, "Copyright (c) 2020 Someone\nAll rights reserved.\n\n" + MIT.upper(), "MIT"),
        (2, MIT.replace("\n", "\r\n").replace(",", " ,"), "MIT"),
        (3, MIT.replace("copyright holders", "copyright\nholders").replace("license", "licence"), "MIT"),
        (4, MIT + " And more.", None), (5, None, None), (6, "", None), (7, "...\n© 2020 X", None),
        (8, "released under the MIT licence", "MIT"), (9, "Prose.\n  Released under the MIT License!\nMore prose.", None),
        (10, "x " * 100_000, None), (11, "released under the mit license", "MIT"), (11, "released under the mit license", "MIT"),
    ]
    df = spark.createDataFrame([(i, t, "old") for i, t, _ in rows], "doc_id bigint, text string, license string")
    known = ls.known_licenses(spark)
    got = ls.scan(df, known).collect()
    assert sorted((r.doc_id, r.license or "") for r in got) == sorted((i, want or "") for i, _, want in rows)
    lines = ls.scan_lines(df, known, ls.anchors()).collect()
    assert {(r.doc_id, r.line_no, r.license) for r in lines} == {(8, 1, "MIT"), (9, 2, "MIT"), (11, 1, "MIT")}
    assert ls.scan(df.limit(0), known).count() == 0 and ls.scan_lines(df.limit(0), known, ls.anchors()).count() == 0


STATED = ["Copyright Jane Doe 2019", "Copyright, 2019 Jane", "(c)2019 X", "(C) Jane Doe", "Copyright(c) 2019 X", "% Copyright (c) 2019", "<!-- Copyright 2019 X -->",
          "# Copyright by Jane Doe", "// Portions Copyright (C) 1999-2004 the X team", "copyright: the authors of the thing, all of them", "© the authors",
          "Copyright Jane Doe", "* Copyright (c) Jane Doe and others who have helped with it", "(c) Copyright Jane Doe and a long list of other people", "dnl Copyright 2001 X",
          "Copyright &copy; 2011 X", "&copy; the authors"]
NOT_STATED = ["copyright notice and this", "copyright holders", "copyright", "(c) you must retain", "the copyright 2019 law", "(c)"]


def test_copyright_lines_and_their_sql(spark):
    """Each line is dropped or kept; SQL that reads words agrees with the pattern."""
    import hashlib

    import duckdb
    lines = STATED + NOT_STATED + ["All rights reserved.", "all rights reserved by me", "", "some (c) 2019 prose"]
    texts = [x + end for x in lines for end in ("", "\nmore words\r\nand © here", "\n" + STATED[0])] + list(STATED) + [b for _, b in KNOWN]
    got = [r.d for r in ls.with_digest(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string"), "t", "d").orderBy("i").collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INT, t VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(texts)))
    want = [r[0] for r in con.execute(f"SELECT sha256({ls.canonical_sql('t')}) FROM t ORDER BY i").fetchall()]
    assert [t for t, a, b in zip(texts, got, want) if a != b] == []
    none = hashlib.sha256(b"").hexdigest()
    own = dict(zip(texts, got))
    assert [x for x in STATED if own[x] != none] == [] and [x for x in NOT_STATED if own[x] == none] == []
    mit = spark.createDataFrame([(i, x + "\n\n" + MIT) for i, x in enumerate(STATED)], "i int, t string")
    assert ls.scan(mit, ls.known_licenses(spark), "t").filter("license = 'MIT'").count() == len(STATED)


def test_every_known_text_finds_itself_and_holds_an_anchor(spark):
    df = spark.createDataFrame([(i, b) for i, (_, b) in enumerate(KNOWN)], "doc_id bigint, text string")
    got = {r.doc_id: r.license for r in ls.scan(df, ls.known_licenses(spark)).collect()}
    assert got == {i: n for i, (n, _) in enumerate(KNOWN)}
    assert all(any(a in b.lower() for a in ls.anchors()) for _, b in KNOWN)
