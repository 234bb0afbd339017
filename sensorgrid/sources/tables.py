"""Reading the parquet tables the engine works on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.mathfn import nan_to_null


def clean_doubles(df: DataFrame) -> DataFrame:
    """NaN → NULL on every double column (the ingest null rule)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(nan_to_null(f.name).alias(f.name))
        else:
            cols.append(f.name)
    return df.select(*cols)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory (``<dir>/<name>.parquet``)."""
    return clean_doubles(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))
