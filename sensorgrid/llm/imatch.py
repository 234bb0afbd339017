"""I-Match fingerprints over randomised lexicon subsets.

The lexicon holds the terms whose inverse document frequency lies within a
chosen band.  A subset of the lexicon is drawn by hashing each term; a text's
hash for a subset is the hash of its distinct lexicon terms in that subset,
sorted.  The fingerprint is the list of these hashes; the likeness of two is
the share of equal hashes among the subsets in which either has a term.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import U64, Words, column, distinct, hash_strings, mix, sized

# Subsets: (share of the lexicon as a power of 1/2, number of subsets).  Small
# shares serve long texts, large shares short ones.
SUBSETS = ((2, 8), (4, 16), (5, 16), (6, 16), (7, 16), (8, 16), (10, 16))
LOW, HIGH = 0.002, 0.30         # band: least and greatest share of documents that hold the term


def term_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``h, df``: documents that hold each term (by its hash), counted per
    piece of the table before the shuffle."""

    def run(batches):
        held, size = [], 0
        for batch in sized(batches, text, 16_000_000):
            w = Words(column(batch, text))
            if not len(w.words):
                continue
            pair = distinct(w.doc_of() * len(w.words) + w.codes)
            held.append((hash_strings(w.words), np.bincount(pair % len(w.words), minlength=len(w.words))))
            size += len(w.words)
            if size >= 1_500_000:                    # a task sends a bounded number of terms at a time
                yield _merged(held)
                held, size = [], 0
        if held:
            yield _merged(held)

    return docs.select(text).mapInArrow(run, "h bigint, df bigint").groupBy("h").agg(F.sum("df").alias("df"))


def _merged(held: list) -> pa.RecordBatch:
    h, df = (np.concatenate([x[i] for x in held]) for i in range(2))
    order = np.argsort(h)
    h, df = h[order], df[order]
    start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    return pa.RecordBatch.from_arrays([pa.array(h[start].view(np.int64)), pa.array(np.add.reduceat(df, start).astype(np.int64))], names=["h", "df"])


def lexicon(docs: DataFrame, text: str = "text", low: float = LOW, high: float = HIGH) -> np.ndarray:
    """Sorted hashes of the terms in the band ``low*N <= df <= high*N`` (and
    df >= 2).  Its size is bounded by the mean number of distinct terms of a
    document over ``low``, whatever the number of documents."""
    n = docs.count()
    band = term_counts(docs, text).filter((F.col("df") >= max(2.0, low * n)) & (F.col("df") <= high * n))
    return np.sort(band.select("h").toPandas()["h"].to_numpy(dtype=np.int64).view(U64))


def subset_hashes(words: pa.Array, codes: np.ndarray, sizes: np.ndarray, lex: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text (rows) and subset (columns): the hash of its sorted
    distinct terms in the subset, and whether it has any."""
    m, k = len(sizes), sum(c for _, c in SUBSETS)
    total, some = np.zeros((m, k), dtype=U64), np.zeros((m, k), dtype=bool)
    if not len(codes):
        return total, some
    h = hash_strings(words)
    known = np.zeros(len(h), dtype=bool)
    if len(lex):
        known = lex[np.minimum(np.searchsorted(lex, h), len(lex) - 1)] == h
    doc = np.repeat(np.arange(m), sizes)
    inside = known[codes]
    pair = distinct(doc[inside] * len(h) + codes[inside])
    doc, h = pair // len(h), h[pair % len(h)]
    order = np.lexsort((h, doc))                       # each text's distinct terms, sorted
    doc, h = doc[order], h[order]
    at = 0
    with np.errstate(over="ignore"):
        for power, count in SUBSETS:
            for s in range(count):
                pick = mix(h ^ mix(np.full(1, at + 1, dtype=U64))[0]) >> U64(64 - power) == 0
                d, t = doc[pick], h[pick]
                # hash of the sorted list: each term is mixed with its place
                first = np.searchsorted(d, d)
                place = (np.arange(len(d)) - first).astype(U64)
                np.add.at(total[:, at], d, mix(mix(t) + place))
                some[d, at] = True
                at += 1
    return mix(total + U64(1)), some


def fingerprint_texts(total: np.ndarray, some: np.ndarray, fallback: list[bytes]) -> list[str]:
    """Text form: 4 hex digits a subset (``-`` for a subset without terms);
    a text without any lexicon term has its own digest instead."""
    out = []
    for h, s, raw in zip((total >> U64(48)).tolist(), some, fallback):
        if not s.any():
            out.append("#" + hashlib.sha256(raw).hexdigest()[:16])
        else:
            out.append(".".join(format(x, "04x") if y else "-" for x, y in zip(h, s.tolist())))
    return out


def likeness(a: str, b: str) -> float:
    """Share of equal hashes among the subsets in which either text has a
    term; 0 or 1 where a text has no lexicon term."""
    if a == b:
        return 1.0
    if a[:1] == "#" or b[:1] == "#":
        return 0.0
    pairs = [(x, y) for x, y in zip(a.split("."), b.split(".")) if not x == y == "-"]
    return sum(x == y for x, y in pairs) / len(pairs)


def fingerprints(texts: pa.Array, lex: np.ndarray) -> list[str]:
    w = Words(texts)
    total, some = subset_hashes(w.words, w.codes, w.sizes, lex)
    return fingerprint_texts(total, some, [t.encode() for t in texts.to_pylist()])


def fingerprint(docs: DataFrame, lex: np.ndarray, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each whole text (NULL: of the empty
    text).  Repeated rows stay; an input column named like ``out`` is
    replaced."""
    from .text import add_columns

    shipped = docs.sparkSession.sparkContext.broadcast(lex)      # bounded, see lexicon()

    def make():
        return lambda batch: [pa.array(fingerprints(column(batch, text), shipped.value))]

    return add_columns(docs, [T.StructField(out, T.StringType())], make, text)


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of the
    following text (all of it, if shorter)."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


RANGES_A_PARTITION, MOST_RANGES = 4, 20_000


def compare_with_next(docs: DataFrame, lex: np.ndarray) -> DataFrame:
    """Fingerprint of every text and of its edited form, made with the next
    document in descending ``doc_id`` (after the last: the first), and their
    likenesses.

    Rows are dealt to ranges of ``doc_id`` once and sorted there, so the next
    document is the next row; each range also gets the first row of the range
    after it, to follow its last.  Rows of equal id follow each other in the
    order of their texts; NULL ids come last."""
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(lex)                  # bounded, see lexicon()
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = min(MOST_RANGES, RANGES_A_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 20 * n).alias("c")).first()["c"] if n > 1 else None
    cuts = sorted(set(found or []))                              # a few numbers a partition
    # how many cuts are below the id, by halving: range 0 has the greatest ids, the last one the NULLs
    halves = [1 << k for k in reversed(range(len(cuts).bit_length()))]
    below = F.lit(0) if not cuts else F.aggregate(F.lit(halves), F.lit(0), lambda at, step: F.when(
        (at + step <= len(cuts)) & (F.element_at(F.lit(cuts), F.least(at + step, F.lit(len(cuts)))) < F.col("doc_id")), at + step).otherwise(at))
    docs = docs.withColumn("part", F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(len(cuts) - below).cast("int"))
    # the first row of each range, and which range it follows: one row a range
    first = docs.groupBy("part").agg(F.max("doc_id").alias("id"))
    order = Window.orderBy("part")
    first = first.withColumn("before", F.coalesce(F.lag("part").over(order), F.max("part").over(Window.partitionBy())))
    heads = (docs.join(F.broadcast(first.withColumnRenamed("part", "p")), (F.col("part") == F.col("p")) & F.col("doc_id").eqNullSafe(F.col("id")))
             .groupBy("before").agg(F.min("text").alias("text")).select(F.lit(None).cast("bigint").alias("doc_id"), "text", F.col("before").alias("part")))
    rows = docs.withColumn("head", F.lit(0)).unionByName(heads.withColumn("head", F.lit(1)))
    rows = rows.repartition("part").sortWithinPartitions("part", "head", F.col("doc_id").desc_nulls_last(), "text")
    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    names = [f.split()[0] for f in schema.split(", ")]

    def done(ids, texts):
        """Result columns of all texts but the last, which follows them."""
        prints = fingerprints(pa.array(texts, type=pa.large_string()), shipped.value)
        new = [edited(t, f) for t, f in zip(texts, texts[1:])]
        changed = fingerprints(pa.array(new, type=pa.large_string()), shipped.value)
        return pa.RecordBatch.from_arrays([
            pa.array(ids[:-1], type=pa.int64()), pa.array([len(t) for t in texts[:-1]], type=pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new]), pa.array(prints[:-1]), pa.array(changed),
            pa.array([likeness(a, b) for a, b in zip(prints, changed)], type=pa.float64()),
            pa.array([likeness(a, b) for a, b in zip(prints, prints[1:])], type=pa.float64())], names=names)

    def run(batches):
        ids, texts = [], []
        for batch in sized(batches, "text", 5_000_000):
            ends = batch.column(3).to_numpy(zero_copy_only=False)
            at = 0
            for stop in [*(np.flatnonzero(ends) + 1).tolist(), batch.num_rows]:
                ids += batch.column(0).slice(at, stop - at).to_pylist()
                texts += batch.column(1).slice(at, stop - at).to_pylist()
                if len(texts) > 1:
                    yield done(ids, texts)
                closed = stop > at and ends[stop - 1] == 1       # the range's last row, which another range holds
                ids, texts = ([], []) if closed else (ids[-1:], texts[-1:])
                at = stop

    return rows.select("doc_id", "text", "part", "head").mapInArrow(run, schema)
