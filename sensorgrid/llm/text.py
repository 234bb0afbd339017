"""Helpers shared by the text operators: tokens of Arrow batches, stable
hashes, tables kept in the shared checkpoint folder."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

U64 = np.uint64
GOLDEN = U64(0x9E3779B97F4A7C15)
_M1, _M2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4_000_000          # of rows that go to Python at a time


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Rows go to Python some megabytes at a time, unless the session says
    otherwise: by itself Spark takes 64 MB, which executor and worker both
    hold, and the executor twice while its buffers grow."""
    own = spark.conf.get(BATCH, None) is None
    if own:
        spark.conf.set(BATCH, str(BATCH_BYTES))
    try:
        yield
    finally:
        if own:
            spark.conf.unset(BATCH)


def keep(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet below the shared checkpoint folder and
    read it back: cuts the lineage, survives lost executors, and is smaller
    than a checkpoint of rows."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/sensorgrid-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


PIECE = 1024                     # numbers that reach the driver as one row


def collected(df: DataFrame, size: int) -> np.ndarray:
    """An array with the numbers of a table of (place, number), each place
    once, and 0 elsewhere; the driver gets it in pieces."""

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            at, x = (batch.column(i).to_numpy() for i in range(2))
            order = np.argsort(at, kind="stable")
            at, x = at[order], x[order]
            piece, n = counted(at // PIECE)
            for k, begin, m in zip(piece.tolist(), np.cumsum(n) - n, n):
                total.setdefault(k, np.zeros(PIECE, dtype=np.int64))[at[begin:begin + m] % PIECE] = x[begin:begin + m]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), type=pa.int64()), pa.array([v.tobytes() for v in total.values()], type=pa.binary())],
                                         names=["piece", "numbers"])
        give_back(collect=False)

    out = np.zeros((-(-size // PIECE), PIECE), dtype=np.int64)
    place, number = (F.col(c).cast("long") for c in df.columns)
    dealt = df.select(place.alias("place"), number.alias("number")).repartition(F.floor(F.col("place") / PIECE))
    with small_batches(df.sparkSession):
        for r in dealt.mapInArrow(run, "piece bigint, numbers binary").collect():
            out[r["piece"]] = np.frombuffer(r["numbers"], dtype=np.int64)
    return out.reshape(-1)[:size]


def give_back(collect: bool = True) -> None:
    """Return memory that is free again to the system (a driver that has
    trained a model goes on for long); without ``collect`` only what needs no
    search for cycles."""
    if collect:
        gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix): a stable hash of 64-bit integers."""
    with np.errstate(over="ignore"):
        x = (x + GOLDEN).astype(U64)
        x = (x ^ (x >> U64(30))) * _M1
        x = (x ^ (x >> U64(27))) * _M2
        return x ^ (x >> U64(31))


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct integers, by sorting (numpy's hash table is far slower
    on millions of values)."""
    x = np.sort(x)
    return x[_first(x)]


def counted(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct integers and how often each occurs."""
    x = np.sort(x)
    at = np.flatnonzero(_first(x))
    return x[at], np.diff(np.append(at, len(x)))


def _first(x: np.ndarray) -> np.ndarray:
    """Where a sorted array has a value for the first time."""
    new = np.ones(len(x), dtype=bool)
    new[1:] = x[1:] != x[:-1]
    return new


def slices(at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Indices ``at, at + 1, ... at + n - 1`` of each slice, one after the other."""
    return np.repeat(at - (np.cumsum(n) - n), n) + np.arange(n.sum())


def ragged(flat: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Concatenation of the slices ``flat[at:at + n]``."""
    return flat[slices(at, n)]


def unit(x: np.ndarray) -> np.ndarray:
    """Uniform double in (0, 1) from 64 random bits."""
    return ((x >> U64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def hash_strings(values) -> np.ndarray:
    """Stable 64-bit hash of every string (same on every machine)."""
    arr = values.to_numpy(zero_copy_only=False) if isinstance(values, (pa.Array, pa.ChunkedArray)) else np.asarray(values, dtype=object)
    if len(arr) == 0:
        return np.zeros(0, dtype=U64)
    return pd.util.hash_array(arr, categorize=False).astype(U64)


def column(batch: pa.RecordBatch, name: str, empty: str = "") -> pa.Array:
    """A string column with NULL read as ``empty``.  A slice is copied first:
    casting one and lower-casing the result reads bytes of its neighbours."""
    c = batch.column(batch.schema.get_field_index(name))
    if c.offset:
        c = c.take(pa.array(np.arange(len(c))))
    c = c.cast(pa.large_string())
    return pc.fill_null(c, empty) if c.null_count else c


class Words:
    """Words of a batch of texts: ``codes`` into ``words`` (distinct, as an
    Arrow array), document by document, and each document's word count.

    A word is a maximal run of characters other than blank and \\x09-\\x0D;
    A-Z are lower-cased, other characters stay."""

    def __init__(self, texts: pa.Array):
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        flat = lists.flatten()
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        real = pc.greater(pc.binary_length(flat), 0)
        enc = flat.dictionary_encode()
        codes = enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.words = enc.dictionary
        if len(flat) and not pc.all(real).as_py():     # blanks at either end leave an empty part
            mask = real.to_numpy(zero_copy_only=False)
            of = np.repeat(np.arange(len(sizes)), sizes)[mask]
            sizes = np.bincount(of, minlength=len(sizes)).astype(np.int64)
            used, codes = np.unique(codes[mask], return_inverse=True)
            self.words = self.words.take(pa.array(used))
        self.codes, self.sizes = codes, sizes
        self.starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if len(sizes) else np.zeros(0, np.int64)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes)), self.sizes)

    def doc_sums(self, values: np.ndarray) -> np.ndarray:
        """Sum of per-occurrence values for each document (0 for none)."""
        return np.bincount(self.doc_of(), weights=values, minlength=len(self.sizes))


def sized(batches: Iterator[pa.RecordBatch], text: str, most_bytes: int = 24_000_000) -> Iterator[pa.RecordBatch]:
    """Regroup batches so that each holds about ``most_bytes`` of text (one
    row at least): tasks hold a bounded piece, however the table is split."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        lens = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
        ends = np.cumsum(lens.to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            stop = int(np.searchsorted(ends, base + max(most_bytes - size, 0), side="right"))
            stop = max(stop, at if held else at + 1)
            if stop > at:
                held.append(batch.slice(at, stop - at))
                size += int(ends[stop - 1] - base)
                at = stop
            if at < batch.num_rows or size >= most_bytes:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(parts) == 1:
        return parts[0]
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


class Table64:
    """Open-addressing look-up from 64-bit keys to int64 values, in numpy;
    ``get`` is vectorised and returns ``missing`` for absent keys."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing: int = -1):
        keys = np.asarray(keys, dtype=U64)
        bits = max(4, int(np.ceil(np.log2(max(len(keys), 1) * 2.5))))
        self.shift, self.mask, self.missing = U64(64 - bits), (1 << bits) - 1, missing
        self.keys = np.zeros(1 << bits, dtype=U64)
        self.vals = np.full(1 << bits, missing, dtype=np.int64)
        self.used = np.zeros(1 << bits, dtype=bool)
        left, slot = np.arange(len(keys)), self._slot(keys)
        self.probes = 0
        while len(left):
            self.probes += 1
            free = ~self.used[slot]
            first = np.zeros(len(left), dtype=bool)
            _, at = np.unique(slot[free], return_index=True)
            first[np.flatnonzero(free)[at]] = True
            i, s = left[first], slot[first]
            self.keys[s], self.vals[s], self.used[s] = keys[i], values[i], True
            left, slot = left[~first], (slot[~first] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * GOLDEN) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        if keys.ndim != 1:
            return self.get(keys.reshape(-1)).reshape(keys.shape)
        slot = self._slot(keys)
        out = np.where(self.keys[slot] == keys, self.vals[slot], self.missing)
        left = np.flatnonzero((out == self.missing) & self.used[slot] & (self.keys[slot] != keys))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & self.mask
            live = self.used[slot]
            left, slot = left[live], slot[live]
            hit = self.keys[slot] == keys[left]
            out[left[hit]] = self.vals[slot[hit]]
            left, slot = left[~hit], slot[~hit]
        return out


def add_columns(df: DataFrame, fields: list, make, text: str, most_bytes: int = 24_000_000) -> DataFrame:
    """``df`` with new columns computed batch by batch: ``make()`` is called
    once per task and returns ``f(batch) -> list of arrays`` (one per field).
    An input column that bears a new column's name is replaced."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    names = [f.name for f in fields]
    base = df.drop(*[c for c in names if c in df.columns and c != text])
    replaced = text in names
    schema = T.StructType([f for f in base.schema.fields if not (replaced and f.name == text)] + list(fields))
    arrow = to_arrow_schema(schema)

    def run(batches):
        f = make()
        for batch in sized(batches, text, most_bytes):
            cols = [c for n, c in zip(batch.schema.names, batch.columns) if not (replaced and n == text)]
            arrays = [*cols, *f(batch)]
            yield pa.RecordBatch.from_arrays([a if a.type == t.type else a.cast(t.type) for a, t in zip(arrays, arrow)], schema=arrow)
        give_back()                                   # the worker may wait for its next task for long

    return base.mapInArrow(run, schema)
