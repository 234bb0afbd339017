"""Partial least squares regression for one target from moments (M2).

Two distributed passes: (1) column means and sample standard deviations
(Spark ML ``Summarizer``), (2) the cross-product matrix ``XsᵀXs`` and the
vector ``Xsᵀys`` of the standardised data, summed per partition with numpy
and combined by a Spark aggregation over the ``p² + p`` cells.  The PLS1
components are then derived on the driver from the ``p×p`` matrix alone
(per component: ``w = b/|b|``, ``t² = wᵀGw``, ``p = Gw/t²``, ``q = wᵀb/t²``,
deflate ``G -= t²ppᵀ``, ``b -= t²qp``); every component count up to
``n_components`` comes from the same moments.  Predictions are a dot
product column.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


PLS_SCHEMA = "x_mean array<double>, x_std array<double>, y_mean double, y_std double, coefs map<int, array<double>>"


@dataclass
class PLSModel:
    x_mean: np.ndarray
    x_std: np.ndarray
    y_mean: float
    y_std: float
    coefs: dict[int, np.ndarray]      # component count → coefficients on raw X

    def save(self, spark: SparkSession, path: str) -> None:
        """One row, as Parquet."""
        row = (self.x_mean.tolist(), self.x_std.tolist(), float(self.y_mean), float(self.y_std),
               {int(k): v.tolist() for k, v in self.coefs.items()})
        spark.createDataFrame([row], PLS_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "PLSModel":
        r = spark.read.parquet(path).first()
        return PLSModel(np.array(r.x_mean), np.array(r.x_std), r.y_mean, r.y_std, {k: np.array(v) for k, v in sorted(r.coefs.items())})

    def prediction(self, features: str, n_components: int) -> Column:
        beta = self.coefs[n_components]
        intercept = self.y_mean - float(np.dot(self.x_mean, beta))
        b = F.array(*[F.lit(float(v)) for v in beta])
        dot = F.aggregate(F.zip_with(F.col(features), b, lambda x, w: x.cast("double") * w),
                          F.lit(0.0), lambda acc, v: acc + v)
        return dot + F.lit(intercept)

    def predict(self, df: DataFrame, features: str = "features", n_components: int | None = None,
                out: str = "prediction") -> DataFrame:
        return df.withColumn(out, self.prediction(features, n_components or max(self.coefs)))


def _moments(df: DataFrame, features: str, label: str):
    vec = df.select(array_to_vector(F.transform(F.col(features), lambda x: x.cast("double"))).alias("v"),
                    F.col(label).cast("double").alias("y"))
    s = vec.select(Summarizer.metrics("mean", "variance", "count").summary(F.col("v")).alias("s"),
                   F.avg("y").alias("ym"), F.stddev_samp("y").alias("ys")).first()
    return (np.asarray(s["s"]["mean"].toArray()), np.sqrt(np.asarray(s["s"]["variance"].toArray())),
            float(s["ym"]), float(s["ys"]), int(s["s"]["count"]))


def fit_pls(df: DataFrame, n_components: int = 11, features: str = "features", label: str = "label") -> PLSModel:
    xm, xs, ym, ys = _moments(df, features, label)[:4]
    xs_safe = np.where(xs > 0, xs, 1.0)
    p = len(xm)

    def cross(it):
        g = np.zeros((p, p))
        b = np.zeros(p)
        for pdf in it:
            if not len(pdf):
                continue
            x = (np.stack([np.asarray(v, dtype=float) for v in pdf["f"]]) - xm) / xs_safe
            y = (pdf["y"].to_numpy(dtype=float) - ym) / (ys if ys > 0 else 1.0)
            g += x.T @ x
            b += x.T @ y
        yield pd.DataFrame({"cell": np.arange(p * p + p), "v": np.concatenate([g.ravel(), b])})
    parts = df.select(F.col(features).alias("f"), F.col(label).cast("double").alias("y")) \
        .mapInPandas(cross, "cell long, v double")
    cells = parts.groupBy("cell").agg(F.sum("v").alias("v")).toPandas().sort_values("cell")
    flat = cells["v"].to_numpy()
    G = flat[: p * p].reshape(p, p)
    bvec = flat[p * p:].copy()
    W, P, Q = [], [], []
    coefs = {}
    for k in range(1, min(n_components, p) + 1):
        nb = np.linalg.norm(bvec)
        if nb == 0:
            break
        w = bvec / nb
        t2 = float(w @ G @ w)
        if t2 <= 0:
            break
        pk = (G @ w) / t2
        qk = float(w @ bvec) / t2
        G = G - t2 * np.outer(pk, pk)
        bvec = bvec - t2 * qk * pk
        W.append(w)
        P.append(pk)
        Q.append(qk)
        Wm, Pm, Qv = np.array(W).T, np.array(P).T, np.array(Q)
        beta_s = Wm @ np.linalg.solve(Pm.T @ Wm, Qv)
        coefs[k] = beta_s * ys / xs_safe
    return PLSModel(xm, xs, ym, ys, coefs)
