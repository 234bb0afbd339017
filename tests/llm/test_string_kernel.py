import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorgrid.llm import queries, string_kernel

EDGES = ["", "a", "ab", "A  b", "  Straße, 1 ", "ééé", "漢字かな", "x" * 5000, "123 --", "a\nb\tc", "\U0001F600 smile"]
SYLLABLES = {"xx": ["ba", "bo", "bu", "gal"], "yy": ["kri", "kre", "tis", "ska"], "zz": ["éo", "öä", "ña", "lle"]}


def brute_set(text):
    """n-grams as tuples of symbols, and the code of each."""
    s, table = [0], string_kernel.symbols()
    for c in text + " ":
        x = int(table[ord(c)])
        if x or s[-1]:
            s.append(x)
    found = set()
    for n in range(1, 5):
        for i in range(len(s) - n + 1):
            value = 0
            for x in s[i:i + n]:
                value = value << 7 | x
            if n == 4:
                value = (value * 2654435761 % 2 ** 32) >> (32 - string_kernel.FOUR_BITS)
            found.add(value + string_kernel.STARTS[n - 1])
    return found


def made(lang, rnd, words=40):
    return " ".join("".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(words))


@pytest.mark.parametrize("text", EDGES)
def test_codes_are_the_distinct_ngrams(text):
    g = string_kernel.Grams()
    g.of("other text before")
    got = g.of(text)
    assert len(set(got.tolist())) == len(got)
    assert set(got.tolist()) == brute_set(text)


def test_kernel_is_shared_over_root_of_product(monkeypatch):
    monkeypatch.setattr(string_kernel, "BLOCK", 50)
    monkeypatch.setattr(string_kernel, "ROWS", 3)
    rnd, g = random.Random(3), string_kernel.Grams()
    marks, texts = [made("xx", rnd), made("yy", rnd)], [made(x, rnd) for x in ("xx", "yy", "zz", "xx", "zz")] + [""]
    m = string_kernel.Landmarks([g.of(t) for t in marks])
    got = m.kernel([g.of(t) for t in texts], m.columns())
    for i, t in enumerate(texts):
        for j, u in enumerate(marks):
            a, b = brute_set(t), brute_set(u)
            assert got[i, j] == pytest.approx(len(a & b) / math.sqrt(len(a) * len(b)))


def test_ridge_is_exact_kernel_ridge_when_all_rows_are_landmarks():
    rnd, g = random.Random(5), string_kernel.Grams()
    y = np.array([0, 1, 2] * 5)
    sets = [g.of(made(["xx", "yy", "zz"][c], rnd, 6)) for c in y]
    m = string_kernel.Landmarks(sets)
    k = m.kernel(sets, m.columns())
    w, b = string_kernel.ridge(k, k, y, 1e-3)
    n = len(y)
    centre = np.eye(n) - 1 / n
    target = np.where(y[:, None] == np.arange(3), 1.0, -1.0)
    kc = centre @ k @ centre
    dual = np.linalg.solve(kc + 1e-3 * n * np.eye(n), centre @ target)
    assert np.allclose(k @ w + b, kc @ dual + target.mean(0), atol=1e-6)


def test_held_out_rows_are_told_apart_and_never_learnt(spark):
    rnd = random.Random(1)
    rows = [(i, made(lang := ["xx", "yy", "zz"][i % 3], rnd), lang) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = {r.doc_id: r for r in string_kernel.predict_languages(docs, landmarks=12, sample=60).collect()}
    assert all(got[i].lang_pred == lang and 0.5 < got[i].score <= 1 for i, _, lang in rows)
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in rows)
    wrong = docs.withColumn("lang", F.when(string_kernel.held_out(F.col("doc_id")), "ww").otherwise(F.col("lang")))
    again = {r.doc_id: (r.lang_pred, r.score) for r in string_kernel.predict_languages(wrong, landmarks=12, sample=60).collect()}
    assert again == {i: (r.lang_pred, r.score) for i, r in got.items()}


def test_defined_results_of_odd_rows(spark):
    rnd = random.Random(2)
    rows = [(i, made(lang := ["xx", "yy"][i % 2], rnd), lang, "x") for i in range(40)]
    odd = [(100, None, "xx", "x"), (101, "", "xx", "x"), (102, "12 !!", None, None), (None, made("xx", rnd), "xx", "x"),
           (103, made("yy", rnd, 60_000), None, "x"), (0, rows[0][1], "xx", "x"), (0, rows[0][1], "xx", "x")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, score string")
    model = string_kernel.fit(docs, landmarks=8, sample=30)
    got = string_kernel.identify(docs, model).collect()
    assert len(got) == len(rows + odd) and set(got[0].asDict()) == {"doc_id", "text", "lang", "score", "lang_pred"}
    by_id = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert by_id[100] == by_id[101] == by_id[102] == ("und", 0.0)
    assert (by_id[103][0], by_id[None][0]) == ("yy", "xx")
    named = string_kernel.identify(docs.withColumnRenamed("text", "body"), model, text="body", out="l", score="s")
    assert sorted((r.doc_id or -1, r.l) for r in named.collect()) == sorted((r.doc_id or -1, r.lang_pred) for r in got)
    assert string_kernel.predict_languages(docs.limit(0)).count() == 0
    none = string_kernel.predict_languages(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {(r.lang_pred, r.score) for r in none.collect()} == {("und", 0.0)}
    one = string_kernel.predict_languages(docs.filter("lang = 'xx'"))
    assert {r.lang_pred for r in one.filter("doc_id < 100").collect()} == {"xx"}


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.op13_string_kernel(spark, sf).join(queries.table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    right = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right >= 0.95 and got.count() == queries.table(spark, sf, "documents").count()
