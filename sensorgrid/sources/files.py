"""File sources and sinks of the feeds.

Every reader takes an explicit schema (no inference), maps the feeds'
column names to catalog aliases and applies the ingest null rule
(``nan``/blank/NaN → NULL).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import catalog
from ..functions import timefn
from ..operators import timeops
from ..session import cut_lineage
from .tables import clean_doubles

RAW_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
CLEAN_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _csv(spark: SparkSession, schema: T.StructType, time_format: str):
    return (spark.read.schema(schema)
            .option("header", True)
            .option("nullValue", "nan")
            .option("nanValue", "nan")
            .option("ignoreLeadingWhiteSpace", True)    # S2: ", " separators and values
            .option("ignoreTrailingWhiteSpace", True)
            .option("quote", '"')                       # S4: quoted values
            .option("timestampNTZFormat", time_format)
            .option("mode", "PERMISSIVE"))


def read_series_csv(spark: SparkSession, path, schema: T.StructType, time_format: str = CLEAN_TIME_FORMAT,
                    rename: bool = True, source_col: str | None = None, order_col: str | None = None) -> DataFrame:
    """Header CSV(s) with a ``Time`` column; names become catalog
    aliases; NaN/``nan``/blank doubles are NULL.  ``source_col`` keeps the
    file path (the series id of a multi-file read), ``order_col`` numbers the
    rows by file path and place in the file."""
    df = _csv(spark, schema, time_format).csv(path)
    extra = [c for c in (source_col, order_col) if c]
    if extra:
        df = df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"))
    if source_col:
        df = df.withColumn(source_col, F.col("__file"))
    if order_col:
        df = _numbered(df, order_col)
    if rename:
        names = [c for c in df.columns if c not in ("__file", "__block")]
        df = df.select(*[F.col(f"`{c}`").alias(c if c in extra else catalog.alias_of(c)) for c in names])
    return clean_doubles(df.drop("__file", "__block"))


def _numbered(df: DataFrame, out: str) -> DataFrame:
    """Row numbers by file path and place in the file: a row's place in its
    split of the file, plus the rows of all splits before it (one summary row
    per split).  A split is read by one task, so the running id orders it."""
    d = df.withColumn("__m", F.monotonically_increasing_id())
    before = Window.orderBy("__file", "__block").rowsBetween(Window.unboundedPreceding, -1)
    splits = (d.groupBy("__file", "__block").agg(F.count(F.lit(1)).alias("__n"), F.min("__m").alias("__first"))
              .withColumn("__off", F.coalesce(F.sum("__n").over(before), F.lit(0))))
    d = d.join(splits.drop("__n"), ["__file", "__block"])
    return d.withColumn(out, (F.col("__off") + F.col("__m") - F.col("__first")).cast("bigint")).drop("__m", "__first", "__off")


def series_schema(columns: Sequence[str], time_col: str = "Time") -> T.StructType:
    """Schema for a feed whose column names are catalog source names."""
    types = {"removed": T.StringType(), "time": T.TimestampNTZType()}
    fields = []
    for c in columns:
        info = catalog.info_for(c)
        if c == time_col:
            fields.append(T.StructField(c, T.TimestampNTZType()))
        elif c in ("Record Number",):
            fields.append(T.StructField(c, T.LongType()))
        elif c in ("Station ID",):
            fields.append(T.StructField(c, T.IntegerType()))
        elif c in ("UpwardMotion", "DownwardMotion", "LateralMotion", "TotalMotion"):
            fields.append(T.StructField(c, T.LongType()))
        elif info.agg == "removed":
            fields.append(T.StructField(c, types["removed"]))
        else:
            fields.append(T.StructField(c, T.DoubleType()))
    return T.StructType(fields)


def read_list_file(spark: SparkSession, list_file: str) -> list[str]:
    """Paths listed one per line; lines starting with ``#`` and blank
    lines are skipped.  The list is metadata (a few paths), so it is
    returned to the caller, who passes it to one multi-path read."""
    lines = spark.read.text(list_file).filter(~F.trim("value").startswith("#") & (F.trim("value") != ""))
    return [r[0].strip() for r in lines.collect()]


def read_many(spark: SparkSession, list_file: str, schema: T.StructType, series_col: str = "series_id",
              time_format: str = CLEAN_TIME_FORMAT) -> DataFrame:
    """S5 + T4: all listed feeds as one table keyed by their file."""
    return read_series_csv(spark, read_list_file(spark, list_file), schema, time_format, source_col=series_col)


# Raw count-file columns.
COUNT_SCHEMA = T.StructType([
    T.StructField("FRAME", T.LongType()), T.StructField("UPWARD", T.LongType()),
    T.StructField("DOWNWARD", T.LongType()), T.StructField("LATERAL", T.LongType()),
    T.StructField("TOTAL", T.LongType()), T.StructField("TOTAL_THRESHOLD", T.DoubleType()),
    T.StructField("TOTAL_ARRAY_COUNT", T.LongType()),
])


MOTIONS = {"motion_up": "UPWARD", "motion_down": "DOWNWARD", "motion_lateral": "LATERAL", "motion_total": "TOTAL"}


def sum_per_file(rows: DataFrame, sums: Mapping[str, str], file_col: str = "file_path", files: DataFrame | None = None,
                 step_minutes: int = 15, observation=None) -> DataFrame:
    """A1 with P3 and P4: ``ts, monitor_id`` and the sums of each file.

    ``sums`` maps output names to columns of ``rows``; ``files`` lists the
    files by name (column ``file_col``): those without rows have zeros (none
    if not given).  Rows are summed before they are shuffled.  Files whose
    name time is off the grid are dropped (their number goes to
    ``observation``)."""
    d = rows.groupBy(file_col).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    if files is not None:
        d = files.select(file_col).distinct().join(d, file_col, "left")
    d = timeops.parse_file_key(d.fillna(0, list(sums)), file_col, "monitor_id", "ts")
    d = timeops.drop_off_grid(d, step_minutes, "ts", observation)
    return d.select("ts", "monitor_id", *sums)


def empty_files(spark: SparkSession, root: str) -> DataFrame:
    """``file_path`` of the zero-byte files below ``root``, which Spark's
    sources leave out.  Like Spark's own file index this lists the folder
    from the driver; only names of empty files are held."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(path, True)
    names = []
    while found.hasNext():
        one = found.next()
        if one.getLen() == 0 and not one.getPath().getName().startswith(("_", ".")):
            names.append((one.getPath().toUri().toString(),))
    return spark.createDataFrame(names, "file_path string")


def read_count_files(spark: SparkSession, root: str, step_minutes: int = 15, observation=None) -> DataFrame:
    """S3/S4 + P3 + P4 + A1: every file below ``root`` is one record.

    The file listing (``binaryFile`` without its content column) keeps
    header-only files and ``empty_files`` the zero-byte ones: both sum to
    zeros.  The rows of all files are read as one CSV scan."""
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
               .select(F.col("path").alias("file_path")).unionByName(empty_files(spark, root)))
    rows = (spark.read.schema(COUNT_SCHEMA).option("header", True).option("quote", '"')
            .option("ignoreLeadingWhiteSpace", True).option("recursiveFileLookup", True)
            .csv(root).withColumn("file_path", F.col("_metadata.file_path")))
    d = sum_per_file(rows, MOTIONS, files=listing, step_minutes=step_minutes, observation=observation)
    return d.select("ts", "monitor_id", *[F.col(c).cast("bigint").alias(c) for c in MOTIONS])


def write_series(df: DataFrame, path: str, ts: str = "ts", keys: Sequence[str] = (), fmt: str = "parquet",
                 mode: str = "overwrite") -> None:
    """Stamp first, rows sorted by time inside each file (no global
    sort); Parquet partitioned by the series keys, or CSV with a header."""
    cols = [*keys, ts, *[c for c in df.columns if c not in set(keys) | {ts}]]
    out = df.select(*cols).sortWithinPartitions(*keys, ts)
    w = out.write.mode(mode)
    if keys and fmt == "parquet":
        w = w.partitionBy(*keys)
    if fmt == "csv":
        w.option("header", True).option("timestampNTZFormat", CLEAN_TIME_FORMAT).csv(path)
    else:
        w.parquet(path)


def list_columns(df: DataFrame) -> DataFrame:
    """Column names and types of a table, as a DataFrame."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string")


def cached_features(df: DataFrame, path: str, compute: Callable[[DataFrame], DataFrame], reach, ts: str = "ts") -> DataFrame:
    """The wide feature table ``compute(df)``, kept at ``path`` (shared
    storage) and refreshed day by day.

    A digest of each day's input rows is kept beside the table.  Days whose
    digest is new or has changed, and the days that look back on them (by up
    to ``reach``), are computed again, from their rows and the rows in reach
    before them, and only their partitions are written; the digests follow
    last, so a run that stopped is made up for by the next.  Days that are no
    longer in the input are not returned."""
    spark, days = df.sparkSession, max(1, math.ceil(timefn.to_micros(reach) / 86_400_000_000))
    rows = df.withColumn("__day", F.floor(timefn.epoch_micros(ts) / F.lit(86_400_000_000)).cast("int"))
    value = F.xxhash64(*[F.to_json(F.struct(F.col(c))) if isinstance(df.schema[c].dataType, T.MapType) else F.col(c) for c in df.columns])
    now = cut_lineage(rows.groupBy("__day").agg(F.count(F.lit(1)).alias("__n"), F.sum(value.cast("decimal(38,0)")).alias("__sum")))
    try:
        old = spark.read.parquet(f"{path}/digests")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        old = now.limit(0)
    same = now.join(old, ["__day", "__n", "__sum"], "left_semi").select("__day")
    changed = now.select("__day").join(same, "__day", "left_anti").unionByName(old.select("__day").join(now, "__day", "left_anti"))
    later = changed.select(F.explode(F.sequence(F.col("__day"), F.col("__day") + days)).alias("__day")).distinct()
    stale = cut_lineage(later.join(now, "__day", "left_semi"))
    if not stale.isEmpty():
        needed = stale.select(F.explode(F.sequence(F.col("__day") - days, F.col("__day"))).alias("__day")).distinct()
        made = compute(rows.join(needed, "__day", "left_semi").drop("__day"))
        made = made.withColumn("__day", F.floor(timefn.epoch_micros(ts) / F.lit(86_400_000_000)).cast("int")).join(stale, "__day", "left_semi")
        (made.repartition("__day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("__day").parquet(f"{path}/table"))
        now.write.mode("overwrite").parquet(f"{path}/digests")
    return spark.read.parquet(f"{path}/table").join(now, "__day", "left_semi").drop("__day")


# Fixed value: list columns of a results file are written as Python list text.
def parse_list_text(c: str) -> F.Column:
    """``"['a', 'b']"`` → ``array<string>``."""
    inner = F.regexp_replace(F.col(c), r"^\s*\[|\]\s*$", "")
    return F.filter(F.transform(F.split(inner, ","), lambda x: F.regexp_replace(F.trim(x), "^'|'$", "")),
                    lambda x: x != "")


def read_results(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """One results CSV, or every file of a folder, each kept apart by
    ``source_file`` (rankings are computed per source file); ``row_index`` is
    a row's place in its file, from 0, and stays with it when ranked."""
    reader = spark.read.option("header", True).option("nullValue", "n/a")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", False)
    df = reader.csv(path).select("*", F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_path").alias("__file"),
                                 F.col("_metadata.file_block_start").alias("__block"))
    df = _numbered(df, "__place")
    # the places of a file follow each other: counted from its first
    first = df.groupBy("__file").agg(F.min("__place").alias("__first"))
    df = df.join(first, "__file").withColumn("row_index", F.col("__place") - F.col("__first")).drop("__file", "__block", "__place", "__first")
    if "aicc" in df.columns:
        df = df.withColumn("aicc", F.col("aicc").cast("double"))
    if "r2_score" in df.columns:
        df = df.withColumn("r2_score", F.col("r2_score").cast("double"))
    if "input_columns" in df.columns:
        df = df.withColumn("input_columns", parse_list_text("input_columns"))
    return df


def save_model(model, path: str) -> None:
    """S10."""
    model.write().overwrite().save(path)


def load_forest(path: str):
    from pyspark.ml.regression import RandomForestRegressionModel
    return RandomForestRegressionModel.load(path)
