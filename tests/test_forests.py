"""Batched forests against brute force, and both ways of growing them."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorgrid.models import forests
from sensorgrid.operators import timeops

TRAIN, TEST = (("part", (0,)),), (("part", (1,)),)


def brute(codes, y, w, depth, least):
    """Prediction of every row by a tree grown row by row."""
    def best(rows):
        found = (least, None, None)
        sse = lambda r: sum(w[i] * (y[i] - np.average(y[r], weights=w[r])) ** 2 for i in r)
        for f in range(codes.shape[1]):
            for cut in range(63):
                left, right = [i for i in rows if codes[i, f] <= cut], [i for i in rows if codes[i, f] > cut]
                if left and right and (gain := sse(rows) - sse(left) - sse(right)) > found[0] + 1e-9:
                    found = (gain, f, cut)
        return found

    out = np.zeros(len(y))

    def grow(rows, every, d):
        _, f, cut = best(rows) if d else (0, None, None)
        if f is None:
            out[every] = np.average(y[rows], weights=w[rows])
            return
        for side in (True, False):
            grow([i for i in rows if (codes[i, f] <= cut) == side], [i for i in every if (codes[i, f] <= cut) == side], d - 1)

    grow([i for i in range(len(y)) if w[i] > 0], list(range(len(y))), depth)
    return out


@pytest.mark.parametrize("depth", [0, 1, 3])
def test_a_tree_is_the_greedy_one(depth):
    g = np.random.default_rng(depth)
    codes, y = g.integers(0, 6, (40, 3)).astype(np.uint8), g.integers(0, 9, 40).astype(float)
    w = forests.bootstrap(g.integers(0, 2 ** 62, 40).astype(np.uint64), 3, 1)
    mean = np.average(y, weights=w)
    got = forests.grow(codes, y, w, depth).predict(codes)
    assert np.allclose(got, brute(codes, y, w, depth, forests.LEAST_GAIN * (w @ (y - mean) ** 2)))


def test_bootstrap_weights_are_poisson_and_of_the_row():
    h = np.arange(200_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    w = forests.bootstrap(h, 5, 1)
    assert abs(w.mean() - 1) < 0.02 and abs((w == 0).mean() - np.exp(-1)) < 0.01 and abs(w.var() - 1) < 0.03
    assert (forests.bootstrap(h[::7], 5, 1) == w[::7]).all() and (forests.bootstrap(h, 6, 1) != w).any()


def table(spark, n=600):
    d = spark.range(n).select("id", (F.col("id") % 7).alias("a"), (F.col("id") * 37 % 101).cast("double").alias("b"), F.when(F.col("id") % 9 > 0, F.col("id") % 5).alias("c"),
                              (F.col("id") % 4 == 0).cast("int").alias("part"), (F.col("id") % 3).alias("fold"))
    d = d.withColumn("y", F.when(F.col("id") % 50 > 0, F.col("a") * 3 + F.floor(F.col("b") / 10) + F.coalesce("c", F.lit(9)) % 2))
    return d.repartition(5)


def test_both_ways_give_the_same_trees(spark, monkeypatch):
    t = forests.BinnedTable(table(spark), ["a", "b", "c"], "y", ["part", "fold"], ["id"])
    runs = [forests.Run(("a", "b"), 3, 4, TRAIN, TEST), forests.Run(("b", "c", "a"), 2, 3, (("part", (0,)), ("fold", (0, 1))), (("part", (0,)), ("fold", (2,)))),
            forests.Run(("c",), 2, 0, TRAIN, TEST)]
    local = forests.fit_forests(t, runs)
    monkeypatch.setattr(forests, "LOCAL_BYTES", 0)
    monkeypatch.setattr(forests, "WAVE_CELLS", 3000)
    spread = forests.fit_forests(t, runs)
    for a, b in zip(local, spread):
        assert len(a.trees) == len(b.trees) == a.run.trees
        for x, y in zip(a.trees, b.trees):
            assert (x.feature == y.feature).all() and (x.bin == y.bin).all() and np.allclose(x.value, y.value)
    for f in local[:2]:
        assert abs(sum(d["importance"] for d in f.importances()) - 1) < 1e-9
    by_run = {r.run: r for r in forests.predictions(t, local).groupBy("run").agg(F.count("*").alias("n"), F.avg((F.col("label") - F.col("prediction")) ** 2).alias("e"), F.var_pop("label").alias("v")).collect()}
    want = table(spark).filter("y is not null")
    assert by_run[0].n == want.filter("part = 1").count() and by_run[1].n == want.filter("part = 0 and fold = 2").count()
    assert by_run[1].e < by_run[1].v / 2


def test_prefixes_and_histograms_in_chunks(spark, monkeypatch):
    t = forests.BinnedTable(table(spark), ["a", "b", "c"], "y", ["part"], ["id"])
    run = forests.Run(("a", "b", "c"), 4, 5, TRAIN, TEST)
    whole, = forests.fit_forests(t, [run])
    rows = t.shipped().value
    monkeypatch.setattr(forests, "CHUNK_CELLS", 200)
    mask = rows.where(TRAIN)
    again = [forests.grow(rows.codes[mask], rows.y[mask], forests.bootstrap(rows.h[mask], n, t.seed), 5) for n in range(4)]
    assert all((a.feature == b.feature).all() and np.allclose(a.value, b.value) for a, b in zip(whole.trees, again))
    two = {r.trees: r.s for r in forests.predictions(t, [whole], [[2, 4]]).groupBy("trees").agg(F.sum("prediction").alias("s")).collect()}
    few, = forests.fit_forests(t, [forests.Run(("a", "b", "c"), 2, 5, TRAIN, TEST)])
    assert np.isclose(two[2], forests.predictions(t, [few]).agg(F.sum("prediction")).first()[0]) and set(two) == {2, 4}


def test_empty_tables_and_labels(spark):
    t = forests.BinnedTable(table(spark).limit(0), ["a", "b"], "y", ["part"], ["id"])
    f, = forests.fit_forests(t, [forests.Run(("a",), 2, 3, TRAIN, TEST)])
    assert forests.predictions(t, [f]).count() == 0 and sum(d["importance"] for d in f.importances()) == 0


def test_all_spans_are_as_one_span_each(spark):
    d = spark.range(1500).filter("id % 11 != 3").select(
        F.expr("timestampadd(MINUTE, CAST(id * 15 AS INT), TIMESTAMP_NTZ'2024-01-01 05:30:00')").alias("ts"),
        F.when(F.col("id") % 3 > 0, "k1").when(F.col("id") % 2 == 0, "k2").alias("key"),
        *[F.rand(i).alias(n) for i, n in enumerate(["wind_direction", "precipitation_in", "x_max", "plain"])])
    d = d.persist()
    hours = [0.25, 0.5, 1, 1.75, 3, 7, 24]
    key = lambda r: (str(r[0]), r[1])
    for keys in (["key"], []):
        d = d if keys else d.drop("key")
        got = timeops.time_groups(d, [f"{h} hours" for h in hours], keys=keys).collect()
        assert len({r.span for r in got}) == len(hours)
        for i, h in enumerate(hours):
            one = timeops.time_group(d, f"{h} hours", keys=keys)
            mine = [tuple(r[c] for c in one.columns) for r in got if r.span == i]
            a, b = sorted(mine, key=key), sorted(map(tuple, one.collect()), key=key)
            assert len(a) == len(b) and all(x[:len(keys) + 1] == y[:len(keys) + 1] and np.allclose(x[len(keys) + 1:], y[len(keys) + 1:]) for x, y in zip(a, b))
