"""Random-forest regression runs (M1) and the one-model evaluation (M4,
M13, M16), on Spark ML.

A run = (input columns, trees, depth).  The prepared table is split once
(T7) and persisted by the caller; every run assembles its columns into one
vector, fits ``RandomForestRegressor`` on the train rows (all features
considered at each split, bootstrap, like the reference's forest) and is
scored on the test rows in one aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import SparkContext
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_forest(train: DataFrame, columns: Sequence[str], label: str, trees: int = 300, depth: int = 12,
               seed: int = 1234, max_bins: int = 64) -> RandomForestRegressionModel:
    va = VectorAssembler(inputCols=list(columns), outputCol="__features", handleInvalid="keep")
    rf = RandomForestRegressor(featuresCol="__features", labelCol=label, numTrees=trees, maxDepth=depth,
                               featureSubsetStrategy="all", seed=seed, maxBins=max_bins, bootstrap=True,
                               maxMemoryInMB=1024, cacheNodeIds=depth > 8)
    return rf.fit(va.transform(train))


def predict(model: RandomForestRegressionModel, df: DataFrame, columns: Sequence[str],
            out: str = "prediction") -> DataFrame:
    va = VectorAssembler(inputCols=list(columns), outputCol="__features", handleInvalid="keep")
    return model.setPredictionCol(out).transform(va.transform(df)).drop("__features")


def importances(model: RandomForestRegressionModel, columns: Sequence[str]) -> list[dict]:
    """``(importance, column)`` sorted by importance, descending."""
    imp = model.featureImportances.toArray()
    pairs = sorted(zip(imp, columns), key=lambda t: (-t[0], t[1]))
    return [{"importance": float(i), "column": c} for i, c in pairs]


def importance_text(importances_col: str = "feature_importances"):
    """The sorted importances as text lines ``"0.12345 - column"``."""
    return F.transform(F.col(importances_col),
                       lambda s: F.concat(F.format_number(s["importance"], 5), F.lit(" - "), s["column"]))


def first_trees(model: RandomForestRegressionModel, n: int) -> RandomForestRegressionModel:
    """The forest of a model's first ``n`` trees."""
    java = model._java_obj
    if n >= len(list(java.trees())):
        return model
    jvm = model._java_obj._gateway_client and SparkContext._active_spark_context._jvm
    kind = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    trees = SparkContext._gateway.new_array(kind, n)
    for i, t in enumerate(list(java.trees())[:n]):
        trees[i] = t
    small = jvm.org.apache.spark.ml.regression.RandomForestRegressionModel(f"{java.uid()}_{n}", trees, java.numFeatures())
    small.set(small.numTrees(), n)
    return RandomForestRegressionModel(small).setFeaturesCol(model.getFeaturesCol())
