"""Language identification with string kernels.

A text is the set of its letter n-grams of one to four symbols (blended
spectrum; presence, not counts), and two texts are alike by the number of
n-grams they share over the root of the product of their numbers.  Nyström:
a few landmark texts stand for the kernel's feature space, so a text becomes
its kernel values with them.  One-versus-rest kernel ridge regression on a
bounded sample of labelled texts is solved in that space; texts are scored
in batches by two matrix products (presence by landmarks, landmarks by
languages).
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import add_columns, column, give_back, keep, ragged

UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
SYMBOL_BITS = 7                              # 0: border; 1-26: a-z; 27-126: other letters, by a hash
FOUR_BITS = 22                               # n-grams of four symbols share so many bits
STARTS = (0, 1 << 7, (1 << 7) + (1 << 14), (1 << 7) + (1 << 14) + (1 << 21))
CODES = STARTS[3] + (1 << FOUR_BITS)
BLOCK = 1 << 16                              # columns of the presence matrix held at a time
ROWS = 64


@cache
def symbols() -> np.ndarray:
    """Symbol of every code point: letters by their lower-case form, all
    else the border."""
    table = np.zeros(0x110000, dtype=np.uint8)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = ord(c.lower()[0])
            table[cp] = low - 96 if 97 <= low <= 122 else 27 + (low * 2654435761 >> 7) % 100
    return table


class Grams:
    """Distinct n-gram codes of texts; keeps a table over all codes, so make
    one for each task."""

    def __init__(self):
        self.last = np.zeros(CODES, dtype=np.int32)

    def of(self, text: str) -> np.ndarray:
        """Distinct codes of one whole text, in order of last appearance."""
        raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        s = np.zeros(len(raw) + 2, dtype=np.int32)          # a border at either end
        s[1:-1] = symbols()[raw]
        live = s > 0
        live[1:] |= s[:-1] > 0                              # runs of borders are one border
        live[0] = True
        s = s[live]
        two = (s[:-1] << SYMBOL_BITS) | s[1:]
        three = (two[:-1] << SYMBOL_BITS) | s[2:]
        four = (three[:-1].astype(np.uint32) << np.uint32(SYMBOL_BITS)) | s[3:].astype(np.uint32)
        four = ((four * np.uint32(2654435761)) >> np.uint32(32 - FOUR_BITS)).astype(np.int32)
        codes = np.concatenate([s, two + STARTS[1], three + STARTS[2], four + STARTS[3]])
        at = np.arange(len(codes), dtype=np.int32)
        self.last[codes] = at
        return codes[self.last[codes] == at]


class Landmarks:
    """The landmark texts as a presence matrix over the n-grams they hold."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([max(len(s), 1) for s in sets], dtype=np.float64)
        self.vocabulary = np.unique(np.concatenate(sets)) if sets else np.zeros(0, np.int32)
        self.presence = np.zeros((len(self.vocabulary), len(sets)), dtype=np.uint8)
        for j, s in enumerate(sets):
            self.presence[np.searchsorted(self.vocabulary, s), j] = 1

    def kernel(self, sets: list[np.ndarray], column_of: np.ndarray) -> np.ndarray:
        """Kernel values of texts (as code sets) with every landmark:
        presence matrices are multiplied block by block."""
        out = np.zeros((len(sets), len(self.sizes)))
        for a in range(0, len(sets), ROWS):
            part = sets[a:a + ROWS]
            hits = [column_of[s] for s in part]
            hits = [np.sort(h[h >= 0]) for h in hits]
            flat = np.concatenate(hits)
            cut = np.array([np.searchsorted(h, np.arange(0, len(self.vocabulary) + BLOCK, BLOCK)) for h in hits])
            begin = np.cumsum([0, *map(len, hits)])[:-1]
            for b in range(cut.shape[1] - 1):
                at, n = begin + cut[:, b], cut[:, b + 1] - cut[:, b]
                x = np.zeros((len(part), min(BLOCK, len(self.vocabulary) - b * BLOCK)), dtype=np.float32)
                x[np.repeat(np.arange(len(part)), n), ragged(flat, at, n) - b * BLOCK] = 1
                out[a:a + len(part)] += x @ self.presence[b * BLOCK:(b + 1) * BLOCK].astype(np.float32)
        norm = np.sqrt(np.array([max(len(s), 1) for s in sets])[:, None] * self.sizes)
        return out / norm

    def columns(self) -> np.ndarray:
        """Row of each code in the presence matrix, -1 for none."""
        of = np.full(CODES, -1, dtype=np.int32)
        of[self.vocabulary] = np.arange(len(self.vocabulary), dtype=np.int32)
        return of


class Model:
    def __init__(self, langs: list[str], landmarks: Landmarks, weights: np.ndarray, bias: np.ndarray):
        self.langs, self.landmarks, self.weights, self.bias = langs, landmarks, weights, bias

    def scores(self, sets: list[np.ndarray], column_of: np.ndarray) -> np.ndarray:
        return self.landmarks.kernel(sets, column_of) @ self.weights + self.bias


def ridge(own: np.ndarray, k: np.ndarray, y: np.ndarray, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights over the landmarks and bias of each class (``y``: class
    numbers), from the landmarks' own kernel and the sample's kernel rows."""
    value, vector = np.linalg.eigh(own)
    root = vector * np.where(value > 1e-8, 1 / np.sqrt(np.maximum(value, 1e-8)), 0)
    phi = k @ root
    target = np.where(y[:, None] == np.arange(y.max() + 1), 1.0, -1.0)
    mean, middle = phi.mean(0), target.mean(0)
    phi = phi - mean
    w = np.linalg.solve(phi.T @ phi + penalty * len(y) * np.eye(phi.shape[1]), phi.T @ (target - middle))
    return root @ w, middle - mean @ w


def fit(docs: DataFrame, landmarks: int = 128, sample: int = 2_400, penalty: float = 1e-4,
        doc_id: str = "doc_id", text: str = "text", language: str = "lang") -> Model:
    """Model of all languages of ``docs`` (rows to learn from).

    ``sample`` bounds the learning rows and ``landmarks`` the landmarks among
    them, both dealt evenly to the languages (at least 8 and 2 each); rows
    are taken in order of a hash of their id.  Rows without id, language or a
    letter are never learnt from; a repeated id counts once.  The texts stay
    in Spark: the driver gets the landmarks' n-gram codes and one kernel row
    for each sampled text."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(language).cast("string").alias("lang"), F.col(text).alias("text")).filter(
        F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    count = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}            # a small set of labels
    langs = sorted(count)
    if not langs:
        return Model([], Landmarks([]), np.zeros((0, 0)), np.zeros(0))
    per, marks = max(8, sample // len(langs)), max(2, landmarks // len(langs))
    rank = F.shiftrightunsigned(F.xxhash64("id"), 1) / 2.0 ** 63
    share = F.element_at(F.create_map(*(F.lit(x) for lang in langs for x in (lang, 4.0 * per / count[lang]))), F.col("lang"))
    order = Window.partitionBy("lang").orderBy("rank", "id")              # over about four times as many rows as are taken
    chosen = (rows.select("id", "lang", rank.alias("rank")).filter(F.col("rank") < share).distinct()
              .withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= per).drop("rank"))
    taken = keep(rows.join(F.broadcast(chosen), ["id", "lang"]).groupBy("id", "lang", "nth").agg(F.min("text").alias("text")))

    def sets(batches):
        grams = Grams()
        for batch in batches:
            found = [pa.array(grams.of(t)) for t in column(batch, "text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))], names=["id", "lang", "codes"])

    mine = taken.filter(F.col("nth") <= marks).select("id", "lang", "text")
    schema = T.StructType([mine.schema["id"], mine.schema["lang"], T.StructField("codes", T.ArrayType(T.IntegerType()))])
    found = mine.mapInArrow(sets, schema).toArrow().sort_by([("lang", "ascending"), ("id", "ascending")])
    mark = Landmarks([c.values.to_numpy() for c in found["codes"]])
    shipped = docs.sparkSession.sparkContext.broadcast(mark)       # a fixed number of texts

    def make():
        grams, of = Grams(), shipped.value.columns()

        def f(batch):
            k = shipped.value.kernel([grams.of(t) for t in column(batch, "text").to_pylist()], of)
            return [pa.array(list(k), pa.list_(pa.float64()))]

        return f

    field = T.StructField("k", T.ArrayType(T.DoubleType()))
    known = add_columns(taken, [field], make, "text", 2_000_000).select("lang", "id", "k").toArrow().sort_by([("lang", "ascending"), ("id", "ascending")])
    k = np.array(known["k"].to_pylist())
    y = np.searchsorted(np.array(langs, dtype=object), np.array(known["lang"].to_pylist(), dtype=object))
    own = mark.kernel([c.values.to_numpy() for c in found["codes"]], mark.columns())
    return Model(langs, mark, *ridge(own, k, y, penalty))


def identify(docs: DataFrame, model: Model, text: str = "text", out: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the likeliest language of every whole text and its score
    (0 to 1: the ridge value, -1 to 1, moved there and clipped).

    A NULL text, a text without a letter, or a model without languages gives
    ``und`` and 0.  Equal scores: the language first in order.  Repeated rows
    stay; input columns named like the outputs are replaced; an empty table
    gives an empty one."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)      # landmarks and weights, of fixed size

    def make():
        m = shipped.value
        grams, of = Grams(), m.landmarks.columns()

        def f(batch):
            texts = column(batch, text).to_pylist()
            lang, value = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
            live = [i for i, t in enumerate(texts) if m.langs and LETTER.search(t)]
            for a in range(0, len(live), ROWS):
                at = live[a:a + ROWS]
                got = m.scores([grams.of(texts[i]) for i in at], of)
                lang[at] = np.array(m.langs, dtype=object)[got.argmax(1)]
                value[at] = np.clip((got.max(1) + 1) / 2, 0, 1)
            return [pa.array(lang, pa.string()), pa.array(value)]

        return f

    fields = [T.StructField(out, T.StringType()), T.StructField(score, T.DoubleType())]
    return add_columns(docs, fields, make, text, 4_000_000)


def held_out(doc_id):
    """Rows never learnt from: crc32(id as text) mod 5 = 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def predict_languages(docs: DataFrame, **fitting) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of all documents, with a model
    of those that are not held out."""
    model = fit(docs.filter(~held_out(F.col("doc_id"))), **fitting)
    give_back()
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
