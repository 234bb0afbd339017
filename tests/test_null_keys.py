"""Series whose key is NULL keep all their rows and values."""

from pyspark.sql import functions as F

from sensorgrid.models.knn import knn_predict
from sensorgrid.operators import align, ordered, scalar, stats, timeops
from sensorgrid.operators.split import train_test_split


def feed(spark):
    """Two series of 20 quarter hours, one without a key, some gaps."""
    return spark.range(40).select(
        F.when(F.col("id") % 2 == 0, "a").alias("k"),
        (F.lit("2024-01-01 20:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), (F.floor(F.col("id") / 2) * 15).cast("int"))).alias("ts"),
        F.when(F.col("id") % 5 != 3, F.col("id").cast("double")).alias("x"), F.col("id"))


def by_key(rows, *cols):
    out = {}
    for r in rows:
        out.setdefault(r["k"], []).append(tuple(r[c] for c in cols))
    return {k: sorted(v) for k, v in out.items()}


def test_rows_in_are_rows_out(spark):
    d = feed(spark)
    keyed = d.withColumn("k", F.coalesce("k", F.lit("b")))
    ops = {
        "zscore": lambda x: ordered.zscore_outliers(x, ["id"], keys=["k"]),
        "minmax": lambda x: ordered.minmax_scale(x, ["x"], keys=["k"]),
        "interpolate": lambda x: ordered.interpolate(x, ["x"], keys=["k"], limit=2),
        "day sum": lambda x: ordered.running_day_sum(x, "x", keys=["k"]),
        "smooth": lambda x: ordered.smooth(x, "x", 3, keys=["k"]),
        "discretize": lambda x: scalar.discretize(x, "x", "band", 4, keys=["k"]),
        "group": lambda x: timeops.time_group(x.drop("id"), "1 hour", keys=["k"]),
        "forward": lambda x: align.keep_forward(x, keys=["k"]),
        "split": lambda x: train_test_split(x, ["id"], 0.3, keys=["k"]),
        "combine": lambda x: align.combine(x.select("k", "ts", "x"), x.select("k", "ts", F.col("id").alias("y")), keys=["k"]),
        "spearman": lambda x: stats.corr_spearman(x, ["x", "id"], keys=["k"]),
        "pearson": lambda x: stats.corr_pearson(x, ["x", "id"], keys=["k"]),
        "kendall": lambda x: stats.corr_kendall(x, ["x", "id"], keys=["k"]),
    }
    for name, op in ops.items():
        got, want = op(d), op(keyed)
        cols = [c for c in want.columns if c != "k"]
        assert got.columns == want.columns, name
        text = lambda df: sorted(str([r[c] for c in cols]) for r in df.collect())
        assert text(got.filter("k is null")) == text(want.filter("k = 'b'")), name
        assert text(got.filter("k = 'a'")) == text(want.filter("k = 'a'")), name
    assert ordered.minmax_scale(d, ["x"], keys=["k"]).count() == 40
    assert train_test_split(d, ["id"], 0.3, keys=["k"]).filter("is_test").count() == 12


def test_neighbours_take_text_ids(spark):
    d = spark.range(60).select(F.concat(F.lit("row "), F.col("id").cast("string")).alias("id"),
                               F.array((F.col("id") % 7).cast("float"), (F.col("id") % 11).cast("float")).alias("features"),
                               F.col("id").cast("double").alias("label"))
    test = d.filter("label % 5 = 0")
    pred = knn_predict(d.filter("label % 5 <> 0"), test, [3], block_rows=7)
    assert pred.count() == 12 and pred.filter("prediction is null").count() == 0
    whole = {r["id"]: round(r["prediction"], 9) for r in knn_predict(d.filter("label % 5 <> 0"), test, [3]).collect()}
    assert {r["id"]: round(r["prediction"], 9) for r in pred.collect()} == whole


def test_groups_stay_bounded_when_rows_grow(spark, monkeypatch):
    """No group counted whole and no rank window holds more than the bound."""
    from pyspark.sql import GroupedData
    seen = []
    real = GroupedData.applyInArrow
    monkeypatch.setattr(GroupedData, "applyInArrow", lambda self, f, schema: (seen.append((f.__name__, self._df)), real(self, f, schema))[1])
    for n in (300, 3000):
        d = spark.range(n).select((F.col("id") * 7919 % 1009 % n).alias("x"), (F.col("id") * 104729 % 2003).alias("y"), F.lit(1).alias("z"))
        seen.clear()
        got = {(r.col_a, r.col_b): r["corr"] for r in stats.corr_kendall(d, ["x", "y", "z"], group_rows=50, fan=4).collect()}
        again = {(r.col_a, r.col_b): r["corr"] for r in stats.corr_kendall(d, ["x", "y", "z"]).collect()}
        assert abs(got["x", "y"] - again["x", "y"]) < 1e-12 and got["x", "z"] is None
        name, whole = next(x for x in seen if x[0] == "within")
        assert whole.groupBy("__pair", "__kind", "__node").count().agg(F.max("count")).first()[0] <= 50
        a, b = (sorted(map(tuple, stats.average_ranks(d.select(F.lit(0).alias("g"), F.col("x").alias("value")), ["g"], **kw).collect())) for kw in ({}, {"group_rows": 20, "fan": 3}))
        assert a == b


def test_partial_ends_and_names(spark):
    from sensorgrid import catalog
    d = feed(spark).select("ts").distinct()
    assert timeops.time_range(d, "2024,2024-01").count() == 20
    assert timeops.time_range(d, "2024-01-01 21,2024-01-01 21").count() == 4
    assert timeops.time_range(d, "2024-01-01 21:15,2024-01-01 21:15").count() == 1
    assert timeops.time_range(d, ",2023").count() == 0
    assert [catalog.info_for(n).agg for n in ("Wind Gust (MPH)", "wind_gust_mph_trend_1h", "Climax index", "Max Trend", "ef_max 1:00:00 Trend")] \
        == ["max", "mean", "mean", "max", "max"]


def test_named_views_and_ranked_order(spark):
    from sensorgrid.plans import views
    d = spark.sql("select timestamp_ntz'2020-07-10 08:00:00' as ts, 1.0 as temperature_f, 2.0 as pressure_mbar, 3 as motion_total")
    assert [v.count() for v in views.views(d, "1")] == [1] * 5
    assert views.views(d, "1")[0].columns == ["ts", "temperature_f", "pressure_mbar", "motion_total"]
    ranked = stats.akaike_weights(spark.createDataFrame([(3.0,), (1.0,), (2.0,)], "aicc double"))
    assert [r.aicc for r in ranked.collect()] == [1.0, 2.0, 3.0]


def test_a_cluster_without_a_shared_folder_is_an_error(monkeypatch):
    import pytest

    from sensorgrid import session

    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
