import random

import numpy as np
import pytest

from sensorgrid.llm import mixing


def corpus(n=300, seed=2):
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        d = rnd.choice(["good", "good", "good", "junk"])
        words = [rnd.choice(["sea", "land", "tree", "sky"]) if d == "good" else rnd.choice(["xx%%", "yy&&", "zz**"]) for _ in range(rnd.randint(1, 50))]
        rows.append((i, " ".join(words)))
        labels.append((i, d))
    return rows, labels


def test_targets_are_met(spark):
    rows, labels = corpus()
    rows += [(1000, None), (1001, ""), (None, "sea sky"), (5, "sea again")]
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id bigint, text string, rate double").repartition(3)
    lab = spark.createDataFrame(labels + [(3, None), (None, "good"), (4, "other")], "doc_id bigint, domain string")
    for weights in ({"good": 0.5, "junk": 0.5}, {"good": 0.95, "junk": 0.05}):
        out = mixing.mix_documents(docs, lab, weights).toPandas()
        assert len(out) == len(rows) and (out["rate"] >= 0).all()
        assert np.allclose(out["p_good"] + out["p_junk"], 1)
        total = out["n_tokens"].sum()
        for d, w in weights.items():
            assert (out["rate"] * out["n_tokens"] * out[f"p_{d}"]).sum() == pytest.approx(w * total, rel=1e-4)
    truth = dict(labels)
    known = out[out["id"].isin(list(truth)) & (out["n_tokens"] > 0) & (out["id"] != 5)]
    assert np.mean([(p > 0.5) == (truth[i] == "good") for i, p in zip(known["id"], known["p_good"])]) > 0.98


def test_rates_stay_non_negative_and_least_squares(spark):
    """Targets out of reach: the fit is that of a plain projected gradient."""
    rng = np.random.default_rng(3)
    p = rng.dirichlet([0.5, 0.5, 0.5], 60)
    n = rng.integers(1, 100, 60)
    df = spark.createDataFrame([(i, int(n[i]), *map(float, p[i])) for i in range(60)], "key bigint, n_tokens bigint, p0 double, p1 double, p2 double")
    target = np.array([0.0, 3000.0, 10.0])
    out = mixing.fit_rates(df, list(target)).orderBy("key").toPandas()
    got = out["rate"].to_numpy()
    assert (got >= 0).all() and (got == 0).any()
    a = (n[:, None] * p).T
    r = np.ones(60)
    for _ in range(200_000):
        r = np.maximum(0, r - (a.T @ (a @ r - target)) / np.linalg.norm(a, 2) ** 2)
    assert np.linalg.norm(a @ got - target) <= np.linalg.norm(a @ r - target) + 0.02 * target.sum()


def test_copies_have_the_rate_as_mean(spark):
    from pyspark.sql import functions as F
    df = spark.range(20_000).select("id", (F.col("id") % 5 * 0.37).alias("rate"))
    for r in df.withColumn("n", mixing.copies(F.col("rate"), F.col("id"))).groupBy("rate").agg(F.avg("n").alias("m"), F.max("n").alias("hi"), F.min("n").alias("lo")).collect():
        assert abs(r.m - r.rate) < 0.03 and r.hi - r.lo <= 1


def test_edge_tables(spark):
    rows, labels = corpus(20)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    lab = spark.createDataFrame(labels, "doc_id bigint, domain string")
    w = {"good": 0.9, "junk": 0.1}
    assert mixing.mix_documents(docs.limit(0), lab, w).count() == 0
    even = mixing.mix_documents(docs, lab.limit(0), w).collect()
    assert all(abs(r.p_good - 0.5) < 1e-9 for r in even)
    rates = mixing.mix_documents(docs, lab, w, "keep:good:1.0")
    kept = mixing.mixed(docs, rates)
    assert kept.columns == docs.columns and 0 < kept.count() <= 22


def test_slow_targets_are_followed(spark):
    """Steps that come little nearer each are still taken (error 0.102 of the
    tokens after 40 steps that end at 1e-4)."""
    rng = np.random.default_rng(10)
    p = rng.dirichlet(rng.choice([0.05, 0.2, 0.5, 2.0], 3), 60)
    n = rng.integers(1, 100, 60)
    target = rng.dirichlet([0.3, 0.3, 0.3]) * n.sum() * rng.choice([0.3, 1, 3])
    df = spark.createDataFrame([(i, int(n[i]), *map(float, p[i])) for i in range(60)], "key bigint, n_tokens bigint, p0 double, p1 double, p2 double")
    out = mixing.fit_rates(df, list(target)).orderBy("key").toPandas()
    got = (out["rate"].to_numpy() * n) @ p
    assert np.linalg.norm(got - target) < 0.09 * target.sum()


def test_toxic_rows_are_a_domain(spark):
    from sensorgrid.llm import queries
    rows = [(1, 1, 1), (2, 1, 0), (3, 0, 0), (4, 0, 1), (5, None, None)]
    labels = spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r.domain for r in queries.domain_labels(labels).collect()}
    assert got == {1: "toxic", 2: "good", 3: "junk", 4: "toxic", 5: None}
    assert set(queries.MIX_WEIGHTS) == {"good", "junk", "toxic"}
