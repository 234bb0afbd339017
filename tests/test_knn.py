import numpy as np

from sensorgrid.models import knn


def test_near_pairs_rule_out_no_neighbour():
    """Matrix products only rule out; what is kept
    has the exact distance, with ties, copies and a large common offset."""
    r = np.random.default_rng(4)
    for offset in (0.0, 1e7):
        x = np.round(r.normal(0, 1, (300, 6)), 1) + offset
        q = np.concatenate([x[:20], np.round(r.normal(0, 1, (40, 6)), 1) + offset])
        exact = np.sqrt(((q[:, None, :] - x[None, :, :]) ** 2).sum(-1))
        for bound in (np.full(60, np.inf), np.sort(exact, axis=1)[:, 30]):
            got = [np.concatenate(v) for v in zip(*knn.near_pairs(q, x, bound, 10))]
            pairs = set(zip(got[0].tolist(), got[1].tolist()))
            kth = np.minimum(np.sort(exact, axis=1)[:, 9], bound)
            assert pairs >= {(int(i), int(j)) for i, j in zip(*np.nonzero(exact <= kth[:, None]))}
            assert (got[2] == exact[got[0], got[1]]).all()


def test_a_row_goes_once_to_a_pack_of_clusters(spark, monkeypatch):
    """Round two sends a row to packs of clusters, not to each cluster."""
    cut, seen = knn.cut_lineage, []

    def noted(df):
        df = cut(df)
        seen.append(df)
        return df

    monkeypatch.setattr(knn, "cut_lineage", noted)
    r = np.random.default_rng(5)
    rows = [(i, [float(v) for v in r.normal(0, 1, 8)], float(i % 5)) for i in range(220)]
    df = spark.createDataFrame(rows, "id long, features array<double>, label double")
    pred = {(p.id, p.k): p.prediction for p in knn.knn_predict(df.filter("id >= 20"), df.filter("id < 20"), [3, 9], clusters=25).collect()}
    sent = [d for d in seen if "tf" in d.columns][-1]
    assert sent.count() <= 20
    x, y = np.array([f for _, f, _ in rows[20:]]), np.array([v for _, _, v in rows[20:]])
    for i in range(20):
        d = np.sqrt(((x - np.array(rows[i][1])) ** 2).sum(-1))
        for k in (3, 9):
            o = np.argsort(d)[:k]
            assert abs(pred[(i, k)] - (y[o] / d[o]).sum() / (1 / d[o]).sum()) < 1e-9
