"""Train/test split with an exact test size (T7) and the column-subset
lattice of the searches (T6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import chunks as ch


HASH_BITS = 60          # hash = first 15 hex digits of md5
BUCKET_BITS = 20        # histogram resolution of the cut search


def row_hash(seed: int, id_cols: Sequence[str]) -> F.Column:
    """Deterministic 60-bit hash of ``seed|id…``; text of integers and of
    epoch microseconds for stamps, so any engine can recompute it."""
    parts = [F.lit(str(seed))]
    for c in id_cols:
        parts.append(F.col(c).cast("string"))
    text = F.concat_ws("|", *parts)
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def train_test_split(df: DataFrame, id_cols: Sequence[str], test_size: float = 0.2, seed: int = 1234,
                     keys: Sequence[str] = (), flag: str = "is_test") -> DataFrame:
    """Exactly ``ceil(test_size·n)`` rows per series get ``is_test``:
    those with the smallest hash (ties by the id columns, which tell the rows
    of a series apart).

    No global sort and no shuffle of the rows: a histogram of the hash's top
    bits per series finds the bucket that holds the last test row, only that
    bucket's rows are ranked, and the row it ends with is the cut that every
    row is compared with.  A series whose key is NULL is a series."""
    d = df.withColumn("__h", row_hash(seed, id_cols)).withColumn("__bk", F.shiftright("__h", HASH_BITS - BUCKET_BITS))
    d = ch.with_key(d, keys)
    kc = ch.key_cols(keys)
    hist = d.groupBy(*kc, "__bk").agg(F.count(F.lit(1)).alias("__c"))
    wk = Window.partitionBy(*kc)
    hist = (hist.withColumn("__target", F.ceil(F.sum("__c").over(wk) * F.lit(float(test_size))))
                .withColumn("__upto", F.sum("__c").over(wk.orderBy("__bk").rowsBetween(Window.unboundedPreceding, 0)))
                .withColumn("__need", F.col("__target") - F.col("__upto") + F.col("__c")))
    last = hist.filter((F.col("__need") > 0) & (F.col("__need") <= F.col("__c"))).select(*kc, "__bk", "__need")
    rank = F.row_number().over(Window.partitionBy(*kc, "__bk").orderBy("__h", *id_cols))
    inside = d.select(*kc, "__bk", "__h", *[c for c in id_cols]).join(last, [*kc, "__bk"]).withColumn("__rank", rank)
    cut = inside.filter(F.col("__rank") <= F.col("__need"))
    place = F.struct("__h", *id_cols)
    cut = cut.groupBy(*kc).agg(F.max(place).alias("__cut"))
    d = d.join(cut, kc, "left") if kc else ch.attach(d, cut, ())
    return d.withColumn(flag, F.coalesce(place <= F.col("__cut"), F.lit(False))).drop("__h", "__bk", "__cut", ch.KEY)


def column_subsets(spark: SparkSession, columns: Sequence[str], max_size: int | None = None,
                   min_size: int = 1) -> DataFrame:
    """Every non-empty subset of ``columns`` as a row
    ``(subset_id, size, input_columns)``, generated distributedly from
    ``range(1, 2^n)`` by bit tests (subset order: by size, then id)."""
    n = len(columns)
    if n > 40:
        raise ValueError("more than 40 columns: 2^n subsets is not a search")
    names = F.array(*[F.lit(c) for c in columns])
    r = spark.range(1, 2 ** n, numPartitions=max(1, min(2 ** n // 4096, 4096)))
    sel = F.expr("filter(__names, (x, i) -> ((id >> i) & 1) = 1)")
    out = r.select("id", names.alias("__names")).select(
        F.col("id").alias("subset_id"), F.bit_count("id").cast("int").alias("size"), sel.alias("input_columns"))
    out = out.filter(F.col("size") >= min_size)
    if max_size is not None:
        out = out.filter(F.col("size") <= max_size)
    return out


def subset_count(n: int) -> int:
    return 2 ** n - 1
