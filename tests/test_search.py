import datetime as dt
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from sensorgrid.models.forest import importance_text
from sensorgrid.plans import queries as Q
from sensorgrid.plans import search
from sensorgrid.plans.search import ModelSearch, ResultStore
from sensorgrid.sources.files import load_forest, save_model


def test_grid_search_resume_and_ranking(spark):
    store = ResultStore(spark, tempfile.mkdtemp(prefix="results-", dir="/tmp") + "/store")
    s = ModelSearch(Q.model_table(spark, SF_SMALL), Q.TARGET, store=store)
    first = s.grid_search_columns(["click", "view", "hour"], trees=10, depth=3)
    assert first.count() == 7
    r = first.first()
    assert abs(sum(d.importance for d in r.feature_importances) - 1) < 1e-9 or r.size == 0
    assert r.train_length + r.test_length > 0
    again = s.grid_search_columns(["click", "view", "hour"], trees=10, depth=3)
    assert again.count() == 7                                   # the stored runs, none made again
    assert sorted(r.run_key for r in again.collect()) == sorted(r.run_key for r in first.collect())
    assert spark.read.parquet(store.path).count() == 7
    more = s.grid_search_columns(["click", "view", "hour", "error"], trees=10, depth=3)
    assert more.count() == 15 and spark.read.parquet(store.path).count() == 15
    dark = s.grid_search_columns(["click", "hour"], trees=10, depth=3, nights=False)
    row = dark.first()
    assert dark.count() == 3 and row.train_length < r.train_length and row.search_id == "columns:no_nights"
    txt = first.select(importance_text().alias("t")).first().t
    assert all(" - " in line for line in txt)


def test_the_other_searches_resume(spark):
    from sensorgrid.operators.ordered import trend_name
    from sensorgrid.plans.prepare import trend_table
    from sensorgrid.plans.search import time_grouping_tests

    store = ResultStore(spark, tempfile.mkdtemp(prefix="results-", dir="/tmp") + "/store")
    t = trend_table(Q.model_table(spark, SF_SMALL), ["view"], hours=(1, 2))
    names = [trend_name("view", f"{h} hours") for h in (1, 2)]
    with ModelSearch(t, Q.TARGET, store=store) as s:
        for run in (lambda: s.trend_additive(["click"], {"view": names}, trees=5, depth=2),
                    lambda: s.grid_search_trends(["click"], names, trees=5, depth=2),
                    lambda: s.grid_search_hyper(["click", "view"], [5, 10], [2, 3])):
            first, n = run().collect(), spark.read.parquet(store.path).count()
            assert sorted(r.run_key for r in run().collect()) == sorted(r.run_key for r in first)
            assert spark.read.parquet(store.path).count() == n
    wide = Q.wide_slots(spark, SF_SMALL)
    group = lambda: time_grouping_tests(spark, wide.fillna(0.0), Q.TARGET, ["click", "view"], [1, 2], trees=5, depth=2, store=store)
    assert group().count() == 2
    n = spark.read.parquet(store.path).count()
    assert group().count() == 2 and spark.read.parquet(store.path).count() == n


def test_two_drivers_on_one_search_make_no_double_rows(spark):
    path = tempfile.mkdtemp(prefix="results-", dir="/tmp") + "/store"
    t = Q.model_table(spark, SF_SMALL).fillna(0.0).persist()
    a, b = (ModelSearch(t, Q.TARGET, store=ResultStore(spark, path), checkpoint=False) for _ in "ab")
    b.store.keys = lambda _: set()                     # the second looks before the first has stored anything
    one = a.grid_search_columns(["click", "hour"], trees=3, depth=2)
    two = b.grid_search_columns(["click", "hour"], trees=3, depth=2)
    assert spark.read.parquet(path).count() == 6       # both have written
    rows = lambda d: sorted((r.run_key, r.r2_score) for r in d.collect())
    assert len(rows(two)) == 3 and rows(one) == rows(two) == rows(a.grid_search_columns(["click", "hour"], trees=3, depth=2))


def test_a_broken_store_is_an_error(spark):
    import pytest
    path = tempfile.mkdtemp(prefix="results-", dir="/tmp") + "/store"
    spark.range(3).write.parquet(path)
    with open(next(__import__("pathlib").Path(path).glob("part-*")), "wb") as f:
        f.write(b"not parquet")
    with pytest.raises(Exception):
        ResultStore(spark, path).stored("columns").collect()


def test_constant_columns_are_left_out(spark):
    import pytest
    t = Q.model_table(spark, SF_SMALL).withColumn("flat", F.lit(None).cast("double"))
    with ModelSearch(t, Q.TARGET, checkpoint=False) as s, pytest.warns(UserWarning, match="flat"):
        assert s.selected_model(["click", "flat"], trees=5, depth=2).first().input_columns == ["click"]
        assert s.pls_sweep(["click", "flat", "view"], 2).count() == 2


def test_model_store_roundtrip(spark):
    s = ModelSearch(Q.model_table(spark, SF_SMALL), Q.TARGET, checkpoint=False)
    res, series, model = s.best_model_series(["click", "view"], trees=5, depth=3)
    path = tempfile.mkdtemp(prefix="model-", dir="/tmp") + "/forest"
    save_model(model, path)
    res2, series2, _ = s.best_model_series(["click", "view"], model=load_forest(path))
    assert res.first().r2_score == res2.first().r2_score
    assert series.count() == series2.count() > 0


def test_prepare_order_and_scale(spark):
    p = Q.model_table(spark, SF_SMALL)
    stats = p.agg(*[F.min(c).alias(f"lo_{c}") for c in Q.series_of(p)],
                  *[F.max(c).alias(f"hi_{c}") for c in Q.series_of(p)]).first()
    for c in Q.series_of(p):
        assert stats[f"lo_{c}"] in (0.0, None) and stats[f"hi_{c}"] in (1.0, None)
    assert p.filter(F.col("hour") > 1).count() > 0               # month / hour not scaled


def test_forests_of_first_trees(spark):
    t = Q.model_table(spark, SF_SMALL).fillna(0.0)
    cols = ["click", "view"]
    with ModelSearch(t, Q.TARGET, checkpoint=False) as s:
        res = s.grid_search_hyper(cols, [2, 4], [2, 3]).collect()
        assert sorted((r.n_estimators, r.max_depth) for r in res) == [(2, 2), (2, 3), (4, 2), (4, 3)]
        alone = s.selected_model(cols, trees=2, depth=3).first()
        pair = next(r for r in res if (r.n_estimators, r.max_depth) == (2, 3))
        assert (alone.r2_score, alone.feature_importances) == (pair.r2_score, pair.feature_importances)


def test_constant_columns_in_selection_and_best_model(spark):
    t = Q.model_table(spark, SF_SMALL).withColumn("flat", F.lit(None).cast("double"))
    cols = ["click", "flat", "view", "hour"]
    with ModelSearch(t, Q.TARGET, checkpoint=False) as s:
        assert {r.column for r in s.rfe(cols, n_keep=1, trees=5, depth=2).collect()} == {"click", "view", "hour"}
        assert {r.column for r in s.sfs(cols, n_select=4, folds=2, trees=5, depth=2).collect()} == {"click", "view", "hour"}
        res, series, _ = s.best_model_series(cols, trees=5, depth=2)
        assert series.count() == res.first().test_length > 0


def test_selections_resume(spark, monkeypatch):
    from sensorgrid.models import forests
    store = ResultStore(spark, tempfile.mkdtemp(prefix="results-", dir="/tmp") + "/store")
    with ModelSearch(Q.model_table(spark, SF_SMALL).fillna(0.0), Q.TARGET, checkpoint=False, store=store) as s:
        cols = ["click", "view", "hour"]
        run = lambda: (sorted(map(tuple, s.rfe(cols, n_keep=1, trees=5, depth=2).collect())), s.sfs(cols, n_select=2, folds=2, trees=5, depth=2).collect())
        first = run()

        def grown(*_):
            raise AssertionError("a stored forest is grown again")

        monkeypatch.setattr(forests, "fit_forests", grown)
        assert run() == first


def test_stored_models_and_neighbour_sweep(spark):
    from sensorgrid.models.knn import KnnModel
    from sensorgrid.models.pls import PLSModel, fit_pls
    root = tempfile.mkdtemp(prefix="model-", dir="/tmp")
    d = Q.embedding_split(spark, SF_SMALL)
    train, test = d.filter("not is_test"), d.filter("is_test")
    model = fit_pls(train, 3)
    model.save(spark, f"{root}/pls")
    again = PLSModel.load(spark, f"{root}/pls")
    pick = lambda df: [(r.id, r.prediction) for r in df.select("id", "prediction").orderBy("id").collect()]
    assert pick(model.predict(test, n_components=2)) == pick(again.predict(test, n_components=2))
    near = KnnModel(train, 5)
    near.save(f"{root}/knn")
    assert pick(near.predict(test)) == pick(KnnModel.load(spark, f"{root}/knn").predict(test))
    with ModelSearch(Q.model_table(spark, SF_SMALL).fillna(0.0), Q.TARGET, checkpoint=False) as s:
        sweep = s.knn_sweep(["click", "view", "hour"], [1, 5]).collect()
    assert sorted(r.knn_neighbors for r in sweep) == [1, 5] and all(r.test_length > 0 for r in sweep)


def test_pieces_of_large_forests_hold_few_trees(spark, monkeypatch):
    """F8: a task holds the trees of one piece, whatever the run list."""
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=15 * i), float(i % 17), float(i % 5), float(i % 3), i % 5 == 0) for i in range(200)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, y double, a double, b double, is_test boolean")
    held, real = [], search.forests.predictions

    def noted(table, found, *rest):
        held.append(sum(len(f.trees) for f in found))
        return real(table, found, *rest)

    monkeypatch.setattr(search.forests, "predictions", noted)

    def scores():
        with search.ModelSearch(df, "y") as srch:
            return {tuple(r.input_columns): r.r2_score for r in srch.grid_search_columns(["a", "b"], trees=8, depth=3).collect()}
    whole = scores()
    assert held == [24]
    monkeypatch.setattr(search, "PIECE_NODES", 2 * 8 * 16, raising=False)
    assert scores() == whole and held[1:] == [16, 8]
