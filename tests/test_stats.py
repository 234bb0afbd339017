import math
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from sensorgrid.models.knn import knn_predict
from sensorgrid.models.pls import fit_pls
from sensorgrid.operators import split, stats


def _tau_b_bruteforce(a, b):
    n = len(a)
    s = 0
    for i in range(n):
        for j in range(i + 1, n):
            s += np.sign(a[j] - a[i]) * np.sign(b[j] - b[i])
    n0 = n * (n - 1) / 2
    n1 = sum(c * (c - 1) / 2 for c in pd.Series(a).value_counts())
    n2 = sum(c * (c - 1) / 2 for c in pd.Series(b).value_counts())
    return s / math.sqrt((n0 - n1) * (n0 - n2))


def test_kendall_vs_bruteforce(spark):
    random.seed(1)
    a = [random.randint(0, 30) for _ in range(400)]
    b = [x + random.randint(-10, 10) if random.random() < 0.8 else random.randint(0, 40) for x in a]
    a = [7 if random.random() < 0.3 else x for x in a]          # a hot value (30 % of rows)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double")
    got = stats.kendall_tau_b(df, "a", "b", group_rows=7, fan=3).first()
    assert got.n == 400
    assert abs(got["corr"] - _tau_b_bruteforce(a, b)) < 1e-12


def test_signed_pair_sum_small():
    p = np.array([1, 2, 3, 3.0])
    q = np.array([1, 3, 2, 0.0])
    # pairs (p strictly increasing): (1,2):+ (1,3a):+ (1,3b):- (2,3a):- (2,3b):-
    assert stats.signed_pair_sum(p, q, np.ones(4)) == -1.0


def test_spearman_and_pearson_vs_pandas(spark):
    rng = np.random.default_rng(0)
    x = rng.integers(0, 20, 500).astype(float)
    y = x * 0.5 + rng.normal(0, 3, 500).round(1)
    z = rng.normal(0, 1, 500)
    z[::7] = np.nan
    pdf = pd.DataFrame({"x": x, "y": y, "z": z})
    df = spark.createDataFrame([(float(a), float(b), None if math.isnan(c) else float(c))
                                for a, b, c in zip(x, y, z)], "x double, y double, z double")
    cols = ["x", "y", "z"]
    for method, fn in (("pearson", stats.corr_pearson), ("spearman", stats.corr_spearman)):
        got = {(r.col_a, r.col_b): r["corr"] for r in fn(df, cols).collect()}
        want = pdf.corr(method=method)
        for a in cols:
            for b in cols:
                assert abs(got[(a, b)] - want.loc[a, b]) < 1e-9, (method, a, b)


def test_split_exact_size(spark):
    df = spark.range(0, 1003).withColumn("k", (F.col("id") % 3).cast("int"))
    s = split.train_test_split(df, ["id"], 0.2, 1234, keys=["k"])
    counts = {r.k: (r.n, r.t) for r in s.groupBy("k").agg(F.count("*").alias("n"),
                                                         F.sum(F.col("is_test").cast("int")).alias("t")).collect()}
    for k, (n, t) in counts.items():
        assert t == math.ceil(0.2 * n)
    again = {r.id for r in split.train_test_split(df, ["id"], 0.2, 1234, keys=["k"]).filter("is_test").collect()}
    assert again == {r.id for r in s.filter("is_test").collect()}


def test_subsets(spark):
    s = split.column_subsets(spark, list("abcde"))
    assert s.count() == 31
    assert sorted(map(len, (r.input_columns for r in s.collect()))) == sorted(bin(i).count("1") for i in range(1, 32))
    assert split.subset_count(14) == 16383


def test_akaike_weights_sum(spark):
    df = spark.createDataFrame([(float(a), g) for a, g in [(10, "x"), (12, "x"), (15, "x"), (3, "y")]],
                               "aicc double, g string")
    w = stats.akaike_weights(df, ["g"]).collect()
    for g in ("x", "y"):
        assert abs(sum(r.weight for r in w if r.g == g) - 1) < 1e-12
    assert min(r.delta for r in w if r.g == "x") == 0


def test_evaluate_matches_numpy(spark):
    rng = np.random.default_rng(1)
    y = rng.normal(size=50)
    p = y + rng.normal(0, 0.3, 50)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "label double, prediction double")
    r = stats.evaluate(df, 3).first()
    res = y - p
    r2 = 1 - (res ** 2).sum() / ((y - y.mean()) ** 2).sum()
    assert abs(r.r2_score - r2) < 1e-12
    assert abs(r.aicc - stats.aicc_value(50, float((res ** 2).sum()), 3)) < 1e-9
    half = 1.959963984540054 * res.std(ddof=1) / math.sqrt(50)
    assert abs(r.ci95.lo - (res.mean() - half)) < 1e-12 and abs(r.ci95_span - 2 * half) < 1e-12


def _pls_numpy(X, y, k):
    xm, xs = X.mean(0), X.std(0, ddof=1)
    ym, ys = y.mean(), y.std(ddof=1)
    Xk, yk = (X - xm) / xs, (y - ym) / ys
    W, P, Q = [], [], []
    for _ in range(k):
        w = Xk.T @ yk
        w /= np.linalg.norm(w)
        t = Xk @ w
        p = Xk.T @ t / (t @ t)
        q = yk @ t / (t @ t)
        Xk = Xk - np.outer(t, p)
        yk = yk - q * t
        W.append(w), P.append(p), Q.append(q)
    W, P, Q = np.array(W).T, np.array(P).T, np.array(Q)
    beta = W @ np.linalg.solve(P.T @ W, Q) * ys / xs
    return beta


def test_pls_matches_data_nipals(spark):
    rng = np.random.default_rng(2)
    X = rng.normal(size=(300, 6)) * [1, 2, 3, 1, 1, 5] + [0, 10, -3, 0, 2, 1]
    y = X @ [0.5, -1, 0.2, 0, 3, 0.1] + rng.normal(0, 0.5, 300)
    df = spark.createDataFrame([(list(map(float, a)), float(b)) for a, b in zip(X, y)],
                               "features array<double>, label double")
    m = fit_pls(df, 4)
    for k in (1, 2, 4):
        assert np.allclose(m.coefs[k], _pls_numpy(X, y, k), atol=1e-9)


def test_knn_exact_vs_bruteforce(spark):
    rng = np.random.default_rng(3)
    train = rng.normal(size=(300, 5))
    train[:100] += 6                                  # two far groups: pruning matters
    ytr = rng.normal(size=300)
    test = rng.normal(size=(40, 5))
    test[:10] = train[:10]                            # zero-distance neighbours
    tr = spark.createDataFrame([(i, list(map(float, f)), float(v)) for i, (f, v) in enumerate(zip(train, ytr))],
                               "id long, features array<double>, label double")
    te = spark.createDataFrame([(1000 + i, list(map(float, f))) for i, f in enumerate(test)],
                               "id long, features array<double>")
    got = {(r.id, r.k): r.prediction for r in knn_predict(tr, te, [1, 5, 16], clusters=8).collect()}
    for i, q in enumerate(test):
        d = np.sqrt(((train - q) ** 2).sum(1))
        order = np.lexsort((np.arange(300), d))
        for k in (1, 5, 16):
            nn = order[:k]
            if (d[nn] == 0).any():
                want = ytr[nn][d[nn] == 0].mean()
            else:
                want = (ytr[nn] / d[nn]).sum() / (1 / d[nn]).sum()
            assert abs(got[(1000 + i, k)] - want) < 1e-9


def test_knn_copies_grow_with_the_rows(spark, monkeypatch):
    """Blocks and parts made when both sides double: linear, and none for a
    cluster that no test row reaches."""
    from sensorgrid.models import knn
    monkeypatch.setattr(knn, "CLUSTER_ROWS", 25)
    seen, real = [], knn._per_cluster
    monkeypatch.setattr(knn, "_per_cluster", lambda v: (seen.append(list(v)), real(v))[1])
    copies = []
    for n in (800, 1600):
        g = np.random.default_rng(n)
        rows = [(i, list(map(float, x)), float(i)) for i, x in enumerate(g.uniform(0, 1, (n, 2)))]
        df = spark.createDataFrame(rows, "id long, features array<double>, label double")
        test = df.filter("id % 5 = 0 and features[0] < 0.5")
        seen.clear()
        got = {r.id: r.prediction for r in knn_predict(df.filter("id % 5 <> 0"), test, [4], block_rows=10).collect()}
        whole = {r.id: r.prediction for r in knn_predict(df.filter("id % 5 <> 0"), test, [4], clusters=1).collect()}
        assert got.keys() == whole.keys() and all(abs(got[i] - whole[i]) < 1e-9 for i in got)
        first, second = seen[0], seen[2]                # parts of both rounds
        assert first.count(0) > len(first) / 4 and second.count(0) > 0
        copies.append(sum(first) + sum(second))
    assert copies[1] < 3 * copies[0]


def test_pearson_per_series(spark):
    rng = np.random.default_rng(5)
    rows = [(k, float(x), float(2 * x + rng.normal())) for k in ("a", "b") for x in rng.normal(size=50)]
    df = spark.createDataFrame(rows, "k string, x double, y double")
    got = {(r.k, r.col_a, r.col_b): r["corr"] for r in stats.corr_pearson(df, ["x", "y"], keys=["k"]).collect()}
    for k in ("a", "b"):
        sub = pd.DataFrame([r[1:] for r in rows if r[0] == k], columns=["x", "y"])
        assert abs(got[(k, "x", "y")] - sub.corr().loc["x", "y"]) < 1e-12


def test_spearman_per_series(spark):
    rng = np.random.default_rng(6)
    rows = []
    for k in ("a", "b"):
        x = rng.integers(0, 10, 80).astype(float)
        y = x + rng.integers(-3, 3, 80)
        z = rng.normal(size=80)
        z[::9] = np.nan
        rows += [(k, float(a), float(b), None if math.isnan(c) else float(c)) for a, b, c in zip(x, y, z)]
    df = spark.createDataFrame(rows, "k string, x double, y double, z double")
    got = {(r.k, r.col_a, r.col_b): r["corr"] for r in stats.corr_spearman(df, ["x", "y", "z"], keys=["k"]).collect()}
    for k in ("a", "b"):
        sub = pd.DataFrame([r[1:] for r in rows if r[0] == k], columns=["x", "y", "z"], dtype="float64")
        want = sub.corr(method="spearman")
        for a in "xyz":
            for b in "xyz":
                assert abs(got[(k, a, b)] - want.loc[a, b]) < 1e-9, (k, a, b)


def test_kendall_per_series(spark):
    random.seed(7)
    rows = []
    for k in ("a", "b", "c"):
        for _ in range(120):
            x = random.randint(0, 12)
            rows.append((k, float(x), float(x + random.randint(-4, 4) if k != "c" else random.randint(0, 9))))
    df = spark.createDataFrame(rows, "k string, x double, y double")
    got = {r.k: r["corr"] for r in stats.kendall_tau_b(df, "x", "y", keys=["k"], group_rows=5, fan=3).collect()}
    for k in ("a", "b", "c"):
        xs = [r[1] for r in rows if r[0] == k]
        ys = [r[2] for r in rows if r[0] == k]
        assert abs(got[k] - _tau_b_bruteforce(xs, ys)) < 1e-12


def test_no_join_brings_a_large_node_to_one_task(spark, monkeypatch):
    """large nodes and their cuts are broadcast, whatever the
    sizes that the planner assumes; so are the ranks of a column of few values."""
    import sensorgrid.session as session
    real, plans = session.cut_lineage, []

    def noted(df):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return real(df)

    monkeypatch.setattr(session, "cut_lineage", noted)
    rows = [(float(i % 7) or None, float(i * 37 % 211)) for i in range(211)]
    df = spark.createDataFrame(rows, "a double, b double")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        tau = stats.kendall_tau_b(df, "a", "b", group_rows=20, fan=4).first()
        stats.average_ranks(df.select(F.lit(0).alias("g"), F.col("b").alias("value")), ["g"], group_rows=20, fan=4)
        rho = stats.corr_spearman(df, ["a", "b"])
        assert not [p for p in plans if "SortMergeJoin" in p]
        # b's own ranks, both sides of the pairs with holes, and the pairs' sizes
        assert rho._jdf.queryExecution().sparkPlan().toString().count("BroadcastHashJoin") >= 4
        found = {(r.col_a, r.col_b): r for r in rho.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    whole = [(a, b) for a, b in rows if a is not None]
    s = sum(((x[0] > y[0]) - (x[0] < y[0])) * ((x[1] > y[1]) - (x[1] < y[1])) for i, x in enumerate(whole) for y in whole[:i])
    n0 = len(whole) * (len(whole) - 1) / 2
    t = sum(k * (k - 1) / 2 for k in (sum(1 for a, _ in whole if a == v) for v in range(1, 7)))
    assert tau.n == len(whole) and abs(tau["corr"] - s / (n0 * (n0 - t)) ** 0.5) < 1e-12
    pdf = pd.DataFrame(whole, columns=["a", "b"]).rank()
    assert found[("a", "b")].n == len(whole) and abs(found[("a", "b")]["corr"] - pdf["a"].corr(pdf["b"])) < 1e-12


def test_signed_pair_sum_by_digits_matches_all_pairs():
    r = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 17, 60):
        for most in (1, 3, 50):
            p, q, w = r.integers(0, most, n).astype(float), r.integers(0, 5, n).astype(float), r.integers(1, 4, n).astype(float)
            d = np.sign(p[None] - p[:, None]) * np.sign(q[None] - q[:, None]) * w[None] * w[:, None]
            assert stats.signed_pair_sum(p, q, w) == d.sum() / 2
