"""Exact k-nearest-neighbour regression without an all-pairs join.

Train rows are grouped around centres (the rows with the smallest hash, a
deterministic sample whose size grows with the rows).  Round one sends a
test row to its own cluster alone and finds the distance of its k-th
neighbour there, a bound for its true k-th neighbour.  A member of cluster
j is at least ``|q - c_j| - r_j`` away, so round two sends the row only to
the other clusters that this bound reaches.  Small clusters are packed together
for that, and a row goes once to a pack with the list of its clusters there.
Rows of a large pack are cut into blocks, and its test rows into parts
according to their own number, so no group is unbounded and no train row is
copied to a part without test rows.  Per cluster a matrix product gives the
squared distances with a known error; the pairs that it cannot rule out are
measured exactly, and each test row's k nearest are kept; a window over those
short lists gives the final k.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..operators.split import row_hash
from ..session import cut_lineage


def _numbered(values: Sequence[int], by: str) -> F.Column:
    return F.element_at(F.array(*[F.lit(int(v)) for v in values]) if len(values) else F.array(F.lit(0)), F.col(by) + 1)


def _per_cluster(values: Sequence[int]) -> F.Column:
    """A cluster's (or pack's) own number, from a list of them."""
    return _numbered(values, "cluster")


def _as_doubles(c: str) -> F.Column:
    return F.transform(F.col(c), lambda x: x.cast("double"))


CLUSTER_ROWS = 4_000            # train rows of a cluster, about, while clusters are few enough
MOST_CLUSTERS = 4_096           # centres that come to the driver at most
PACK_BLOCKS = 4                 # a pack of clusters has so many times block_rows at most
PAIR_CELLS = 4_000_000          # numbers of a distance block in memory (32 MB)


def _distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Distances of all rows of ``q`` to all rows of ``x``, some at a time."""
    out = np.empty((len(q), len(x)))
    step = max(1, 4_000_000 // max(1, x.size))          # bound the differences to ~32 MB
    for lo in range(0, len(q), step):
        out[lo:lo + step] = np.sqrt(((q[lo:lo + step, None, :] - x[None, :, :]) ** 2).sum(-1))
    return out


def _matrix(values) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=float) for v in values])


def _rows(column: pa.ChunkedArray) -> np.ndarray:
    """A list column as a matrix."""
    lists = column.combine_chunks()
    lists = lists if isinstance(lists, pa.Array) else pa.concat_arrays(lists.chunks)
    sizes = np.unique(lists.value_lengths().to_numpy(zero_copy_only=False))
    if lists.null_count or len(sizes) > 1:
        raise ValueError("all feature lists must have the same length")
    return lists.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(len(lists), -1)


def _exact(q: np.ndarray, x: np.ndarray, r: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Distances of the pairs ``q[r], x[c]``, some at a time."""
    out = np.empty(len(r))
    step = max(1, PAIR_CELLS // max(1, q.shape[1]))
    for lo in range(0, len(r), step):
        out[lo:lo + step] = np.sqrt(((q[r[lo:lo + step]] - x[c[lo:lo + step]]) ** 2).sum(-1))
    return out


def near_pairs(q: np.ndarray, x: np.ndarray, bound: np.ndarray, kk: int):
    """``r, c, d`` in row order: every pair that may be among the ``kk``
    nearest rows of ``x`` of a row of ``q`` and not farther than its
    ``bound``, with the exact distance.  A row with fewer than ``kk`` pairs
    within its bound has all of them."""
    finite = np.isfinite(q).all() and np.isfinite(x).all()
    kk = min(kk, len(x))
    # around the mean, so that a common offset costs no digits
    mid = x.mean(0) if finite else 0.0
    qc, xc = q - mid, x - mid
    qn, xn = (qc * qc).sum(1), (xc * xc).sum(1)
    # twice what the products and sums can be off
    slack = 8 * (q.shape[1] + 8) * np.finfo(float).eps * (qn + xn.max())
    finite = finite and np.isfinite(slack).all()
    step = max(1, PAIR_CELLS // len(x)) if finite else max(1, PAIR_CELLS // max(1, x.size))
    for lo in range(0, len(q), step):
        at = slice(lo, lo + step)
        if finite:
            d2 = xn[None, :] - 2 * (qc[at] @ xc.T) + qn[at, None]
            with np.errstate(over="ignore"):
                most = np.fmin(bound[at], np.inf) ** 2 * (1 + 1e-12) + slack[at]
            near = d2 <= most[:, None]
            if len(x) > kk and np.count_nonzero(near) > 8 * kk * len(d2):
                kth = np.partition(d2, kk - 1, axis=1)[:, kk - 1]
                near = d2 <= np.fmin(most, kth + 2 * slack[at])[:, None]
            r, c = np.nonzero(near)
            yield r + lo, c, _exact(q, x, r + lo, c)
        else:
            d = np.sqrt(((q[at, None, :] - x[None, :, :]) ** 2).sum(-1))
            kth = np.partition(d, kk - 1, axis=1)[:, kk - 1] if len(x) > kk else d.max(axis=1)
            r, c = np.nonzero(d <= kth[:, None])          # every tie at the k-th distance kept
            yield r + lo, c, d[r, c]


def knn_predict(train: DataFrame, test: DataFrame, k_values: Sequence[int] = (16,), features: str = "features",
                label: str = "label", id_col: str = "id", clusters: int | None = None, seed: int = 7,
                block_rows: int = 20_000) -> DataFrame:
    """Distance-weighted k-NN predictions for every ``k`` in ``k_values``
    from one neighbour search: ``(id, k, prediction)``.  Weights are
    ``1/d``; when neighbours at distance 0 exist only they count."""
    kmax = max(k_values)
    tr = train.select(F.col(id_col).alias("rid"), _as_doubles(features).alias("f"), F.col(label).cast("double").alias("y"))
    te = test.select(F.col(id_col).alias("tid"), _as_doubles(features).alias("tf"))
    tid_type = te.schema["tid"].dataType
    if clusters is None:
        clusters = int(min(MOST_CLUSTERS, max(1, math.ceil(train.count() / CLUSTER_ROWS))))
    centres = (tr.withColumn("__h", row_hash(seed, ["rid"])).orderBy("__h", "rid").limit(clusters).select("f").toPandas())
    cmat = _matrix(centres["f"]) if len(centres) else np.zeros((0, 0))

    def assign(it):
        for pdf in it:
            if len(pdf):
                d = _distances(_matrix(pdf["f"]), cmat)
                yield pd.DataFrame({"rid": pdf["rid"], "f": pdf["f"], "y": pdf["y"], "cluster": d.argmin(1).astype("int32"), "dm": d.min(1)})

    if len(cmat) > 1:
        tr = cut_lineage(tr.mapInPandas(assign, T.StructType(tr.schema.fields + [T.StructField("cluster", T.IntegerType()), T.StructField("dm", T.DoubleType())])))
    else:
        tr = tr.withColumns({"cluster": F.lit(0), "dm": F.lit(0.0)})
    info = tr.groupBy("cluster").agg(F.max("dm").alias("r"), F.count(F.lit(1)).alias("cnt")).toPandas()     # one row a centre
    radius, counts = np.zeros(len(cmat)), np.zeros(len(cmat))
    radius[info["cluster"].to_numpy(int)] = info["r"].to_numpy()
    counts[info["cluster"].to_numpy(int)] = info["cnt"].to_numpy()
    # packs of clusters that follow each other
    packs, held = [], 0
    for n in counts:
        if packs and held + n <= PACK_BLOCKS * block_rows:
            packs.append(packs[-1])
            held += n
        else:
            packs.append(packs[-1] + 1 if packs else 0)
            held = n

    def nearest(it):
        for pdf in it:
            if len(pdf) and len(cmat):
                d = _distances(_matrix(pdf["tf"]), cmat)
                d[:, counts == 0] = np.inf
                yield pd.DataFrame({"tid": pdf["tid"], "tf": pdf["tf"], "cluster": d.argmin(1).astype("int32")})

    def reached(batches):
        pack_of = np.array(packs)
        for batch in batches:
            step = max(1, PAIR_CELLS // (4 * len(cmat)))
            for lo in range(0, batch.num_rows, step):
                part = pa.Table.from_batches([batch.slice(lo, step)])
                d = _distances(_rows(part["tf"]), cmat)
                upper, lower = d + radius, np.maximum(d - radius, 0.0)
                # the k-th neighbour is also within the least bound that covers k members
                upper[:, counts == 0] = np.inf
                order = np.argsort(upper, axis=1)
                covered = np.cumsum(counts[order], axis=1)
                row = np.arange(len(d))
                cover = upper[row, order[row, np.minimum((covered < kmax).sum(axis=1), len(cmat) - 1)]]
                bound = np.fmin(part["bound"].to_numpy().astype(float), cover)
                near = (lower <= bound[:, None] * (1 + 1e-12)) & (counts > 0)
                near[row, part["cluster"].to_numpy()] = False             # round one has seen it
                r, c = np.nonzero(near)
                if not len(r):
                    continue
                # one row for each pack, with its clusters there
                first = np.flatnonzero(np.concatenate(([True], (r[1:] != r[:-1]) | (pack_of[c][1:] != pack_of[c][:-1]))))
                which = pa.array(r[first])
                yield pa.RecordBatch.from_arrays(
                    [part["tid"].combine_chunks().take(which), part["tf"].combine_chunks().take(which), pa.array(pack_of[c[first]], pa.int32()),
                     pa.array(bound[r[first]]), pa.ListArray.from_arrays(pa.array(np.concatenate((first, [len(c)])), pa.int32()), pa.array(c, pa.int32()))],
                    names=["tid", "tf", "cluster", "bound", "reach"])

    pair = T.StructType([te.schema["tid"], te.schema["tf"], T.StructField("cluster", T.IntegerType())])
    asked_schema = T.StructType([te.schema["tid"], te.schema["tf"], T.StructField("cluster", T.IntegerType()), T.StructField("bound", T.DoubleType()),
                                 T.StructField("reach", T.ArrayType(T.IntegerType()))])
    out_schema = T.StructType([T.StructField("tid", tid_type), T.StructField("rid", tr.schema["rid"].dataType),
                               T.StructField("y", T.DoubleType()), T.StructField("d", T.DoubleType())])
    out_arrow = to_arrow_schema(out_schema)

    def local_topk(tests: pa.Table, trains: pa.Table) -> pa.Table:
        if not tests.num_rows or not trains.num_rows:
            return out_arrow.empty_table()
        q_all, x_all = _rows(tests["tf"]), _rows(trains["f"])
        bound = tests["bound"].to_numpy()
        bound = np.where(np.isnan(bound), np.inf, bound)
        rid = trains["rid"].to_numpy()
        reach = tests["reach"].combine_chunks()
        asking = np.repeat(np.arange(len(q_all)), reach.value_lengths().to_numpy(zero_copy_only=False))
        asked, cluster = reach.flatten().to_numpy(zero_copy_only=False), trains["own"].to_numpy()
        made = []
        for j in np.unique(cluster):
            rows, members = asking[asked == j], np.flatnonzero(cluster == j)
            if not len(rows):
                continue
            for r, c, d in near_pairs(q_all[rows], x_all[members], bound[rows], kmax):
                r, c = rows[r], members[c]
                o = np.lexsort((rid[c], d, r))            # by row, then distance, then id
                r, c, d = r[o], c[o], d[o]
                keep = (np.arange(len(r)) - np.searchsorted(r, r, "left")) < kmax
                made.append((r[keep], c[keep], d[keep]))
        if not made:
            return out_arrow.empty_table()
        r, c, d = (np.concatenate(v) for v in zip(*made))
        o = np.lexsort((rid[c], d, r))
        r, c, d = r[o], c[o], d[o]
        keep = (np.arange(len(r)) - np.searchsorted(r, r, "left")) < kmax
        r, c, d = r[keep], c[keep], d[keep]
        return pa.Table.from_arrays([tests["tid"].take(pa.array(r)), trains["rid"].take(pa.array(c)), trains["y"].take(pa.array(c)), pa.array(d)], schema=out_arrow)

    def search(asked: DataFrame, pack_of: Sequence[int], most: int) -> DataFrame:
        """Neighbour lists of ``tid, tf, cluster, bound, reach`` rows, block by
        block; ``pack_of`` names each cluster's pack, which is the cluster of
        these rows (``own``: a train row's own one)."""
        sizes = np.bincount(pack_of, weights=counts) if len(pack_of) else np.zeros(0)
        blocks = np.maximum(1, np.ceil(sizes / most)).astype(int)
        number = {r["cluster"]: r["n"] for r in asked.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect()}
        parts = _per_cluster([math.ceil(number.get(j, 0) / block_rows) for j in range(len(sizes))])
        subs = _per_cluster(blocks.tolist())
        left = asked.withColumn("part", F.pmod(F.xxhash64("tid"), F.greatest(parts, F.lit(1))).cast("int")).withColumn(
            "sub", F.explode(F.sequence(F.lit(0), subs - 1)))
        # no part, no copy: a pack that no row asks for is left out
        right = tr.withColumnRenamed("cluster", "own").withColumn("cluster", _numbered(pack_of, "own")).filter(parts > 0).withColumn(
            "sub", F.pmod(F.xxhash64("rid"), subs).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
        return (left.groupBy("cluster", "sub", "part")
                .cogroup(right.select(*[F.col(c).alias(f"t_{c}") for c in ("cluster", "sub", "part")], "own", "rid", "f", "y").groupBy("t_cluster", "t_sub", "t_part"))
                .applyInArrow(local_topk, out_schema))

    def alone(rows: DataFrame) -> DataFrame:
        return rows.select("tid", "tf", "cluster", F.lit(None).cast("double").alias("bound"), F.array("cluster").alias("reach"))

    own = te.mapInPandas(nearest, pair) if len(cmat) > 1 else te.withColumn("cluster", F.lit(0))
    each = list(range(len(cmat)))
    if len(cmat) > 1:
        own = cut_lineage(own)
        near = cut_lineage(search(alone(own), each, block_rows))
        kth = near.withColumn("__nth", F.row_number().over(Window.partitionBy("tid").orderBy("d", "rid"))).filter(F.col("__nth") == kmax)
        bound = own.join(kth.select("tid", F.col("d").alias("bound")), "tid", "left")
        others = cut_lineage(bound.select("tid", "tf", "cluster", "bound").mapInArrow(reached, asked_schema))
        near = near.unionByName(search(others, packs, PACK_BLOCKS * block_rows))
    else:
        near = search(alone(own), each, block_rows)
    top = near.withColumn("rank", F.row_number().over(
        Window.partitionBy("tid").orderBy("d", "rid"))).filter(F.col("rank") <= kmax)
    ks = F.explode(F.array(*[F.lit(int(k)) for k in k_values])).alias("k")
    t = top.select("tid", "rank", "y", "d", ks).filter(F.col("rank") <= F.col("k"))
    zero = F.col("d") == 0
    pred = t.groupBy("tid", "k").agg(
        F.count(F.when(zero, 1)).alias("__z"),
        F.avg(F.when(zero, F.col("y"))).alias("__zy"),
        F.sum(F.when(~zero, F.col("y") / F.col("d"))).alias("__num"),
        F.sum(F.when(~zero, 1.0 / F.col("d"))).alias("__den"))
    prediction = F.when(F.col("__z") > 0, F.col("__zy")).otherwise(F.col("__num") / F.col("__den"))
    return pred.select(F.col("tid").alias(id_col), "k", prediction.alias("prediction"))


class KnnModel:
    """A neighbour model is its train rows ``(id, features, label)`` and
    the number of neighbours; it is stored as a table."""

    def __init__(self, train: DataFrame, k: int, features: str = "features", label: str = "label", id_col: str = "id"):
        self.k = k
        self.train = train.select(F.col(id_col).alias("id"), F.col(features).alias("features"), F.col(label).alias("label"))

    def predict(self, test: DataFrame, features: str = "features", id_col: str = "id") -> DataFrame:
        rows = test.select(F.col(id_col).alias("id"), F.col(features).alias("features"))
        return knn_predict(self.train, rows, [self.k]).select(F.col("id").alias(id_col), "prediction")

    def save(self, path: str) -> None:
        self.train.withColumn("k", F.lit(self.k)).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark, path: str) -> "KnnModel":
        rows = spark.read.parquet(path)
        first = rows.select("k").first()
        return KnnModel(rows.drop("k"), first["k"] if first else 1)
