"""LM scoring by subword lattice likelihood.

The pieces of an existing vocabulary span a lattice over each word (with its
leading blank), and a unigram distribution over the pieces weights every
segmentation; a forward recursion in log space sums them to the word's
marginal probability.  One further edge spans a whole word that the training
rows hold, weighted by its discounted count; the mass taken off the counts
weights the pieces.  A text's probability is the product over its words (A-Z
lower-cased, white space read as word borders) and one end token, marginal
over a few classes of texts (languages), each with its own distribution.

The piece distributions start from the vocabulary's own scores (ranks, read
as a Zipf law) and are fitted to the training rows by expectation
maximisation over their distinct words and counts.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import U64, Table64, Words, column, counted, keep, sized

PRIME = U64(0x100000001B3)
HEAVY = 1 << 20       # words with at least 1/HEAVY of all training tokens are broadcast: at most HEAVY words
NEG = -1e30


def read_pieces(model_path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces (blank for the word mark) and their ranks from a sentencepiece
    model file: its lower-case pieces with a mark at the start only, and all
    256 single bytes."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    rank: dict[bytes, float] = {}
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i):
            continue
        p = sp.id_to_piece(i).replace("▁", " ")
        raw = p.encode()
        if " " in p[1:] or any(65 <= b <= 90 for b in raw):
            continue
        rank.setdefault(raw, -float(sp.get_score(i)))
    last = max(rank.values(), default=0.0) + 1
    for b in range(256):
        rank.setdefault(bytes([b]), last)
    pieces = sorted(rank, key=lambda p: (rank[p], p))
    return pieces, np.array([rank[p] for p in pieces])


class Lattice:
    """Piece look-up and recursions over batches of words."""

    def __init__(self, pieces: list[bytes]):
        self.pieces, self.longest = pieces, max(map(len, pieces))
        keys = np.zeros(len(pieces), dtype=U64)
        for i, p in enumerate(pieces):
            h = 0
            for b in p:
                h = (h * 0x100000001B3 + b + 1) & 0xFFFFFFFFFFFFFFFF
            keys[i] = h ^ (len(p) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        if len(np.unique(keys)) != len(keys):
            raise ValueError("piece hashes collide")
        self.table = Table64(keys, np.arange(len(pieces)), missing=len(pieces))   # last: no such piece
        lens = np.array([len(p) for p in pieces])
        self.blob = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        self.start = np.cumsum(lens) - lens

    def edges(self, w: np.ndarray) -> list[np.ndarray]:
        """For each piece length, the piece id at each start (rows: words)."""
        out, h = [], np.zeros(w.shape, dtype=U64)
        n = w.shape[1]
        with np.errstate(over="ignore"):
            for size in range(1, min(self.longest, n) + 1):
                h = h[:, :n - size + 1] * PRIME + w[:, size - 1:] + U64(1)
                ids = self.table.get(h ^ (U64(size) * U64(0x9E3779B97F4A7C15)))
                hit = ids < len(self.pieces)
                if size > 1 and hit.any():                # equal hashes must be equal bytes
                    r, c = np.nonzero(hit)
                    same = np.ones(len(r), dtype=bool)
                    for k in range(size):
                        same &= self.blob[self.start[ids[r, c]] + k] == w[r, c + k]
                    ids[r[~same], c[~same]] = len(self.pieces)
                out.append(ids)
        return out

    def forward(self, edges: list[np.ndarray], lp: np.ndarray, n: int) -> np.ndarray:
        """Log probability of each prefix (rows: words, columns 0..n)."""
        m = len(edges[0])
        a = np.full((m, n + 1), NEG)
        a[:, 0] = 0
        for j in range(1, n + 1):
            a[:, j] = _sum([a[:, j - s - 1] + lp[e[:, j - s - 1]] for s, e in enumerate(edges[:j])])
        return a

    def expected(self, edges, lp, n, counts, total) -> float:
        """Add the expected uses of each piece to ``total``; returns the log
        likelihood of the words."""
        a = self.forward(edges, lp, n)
        b = np.full(a.shape, NEG)
        b[:, n] = 0
        for j in range(n - 1, -1, -1):
            b[:, j] = _sum([lp[e[:, j]] + b[:, j + s + 1] for s, e in enumerate(edges[:n - j])])
        for s, e in enumerate(edges):
            post = np.exp(a[:, :n - s] + lp[e] + b[:, s + 1:] - a[:, n:]) * counts[:, None]
            total += np.bincount(e.ravel(), weights=post.ravel(), minlength=len(total))
        return float((a[:, n] * counts).sum())

    def groups(self, words: list[bytes], most: int = 1 << 20):
        """Indices of words of one length, as matrices of bounded size."""
        lens = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        order = np.argsort(lens, kind="stable")
        cuts = np.flatnonzero(np.diff(lens[order])) + 1
        for group in np.split(order, cuts):
            if not len(group):
                continue
            n = int(lens[group[0]])
            step = max(1, most // (n + 1))
            for k in range(0, len(group), step):
                some = group[k:k + step]
                yield some, np.frombuffer(b"".join([words[i] for i in some]), dtype=np.uint8).reshape(len(some), n)

    def log_prob(self, words: list[bytes], lp: np.ndarray) -> np.ndarray:
        """Natural log of each word's marginal probability."""
        out = np.zeros(len(words))
        for some, w in self.groups(words):
            out[some] = self.forward(self.edges(w), lp, w.shape[1])[:, -1]
        return out


def _sum(terms: list[np.ndarray]) -> np.ndarray:
    v = np.stack(terms)
    top = v.max(0)
    return top + np.log(np.exp(v - top).sum(0))


_lattices: dict[int, Lattice] = {}


def _lattice(pieces: list[bytes]) -> Lattice:
    key = hash(tuple(pieces))
    if key not in _lattices:
        _lattices.clear()
        _lattices[key] = Lattice(pieces)
    return _lattices[key]


def word_counts(docs: DataFrame, classes: int, text: str = "text", klass: str = "klass") -> DataFrame:
    """``word, c, c0, c1, ...``: uses of each word in all texts and in those of
    each class, counted per piece of the table before the shuffle."""

    def run(batches):
        for batch in sized(batches, text):
            w = Words(column(batch, text))
            if not len(w.words):
                continue
            of = batch.column(batch.schema.get_field_index(klass)).to_numpy(zero_copy_only=False).astype(np.int64)
            pair, n = counted(w.codes * classes + of[w.doc_of()])
            yield pa.RecordBatch.from_arrays([w.words.take(pa.array(pair // classes)).cast(pa.string()),
                                              pa.array((pair % classes).astype(np.int32)), pa.array(n)], names=["word", "k", "n"])

    each = docs.select(text, klass).mapInArrow(run, "word string, k int, n bigint")
    return each.groupBy("word").agg(F.sum("n").alias("c"), *[
        F.sum(F.when(F.col("k") == k, F.col("n")).otherwise(0)).alias(f"c{k}") for k in range(classes)])


def _with_end(ranks: np.ndarray) -> np.ndarray:
    """Starting log probabilities: a Zipf law over the ranks."""
    p = 1.0 / (ranks - ranks.min() + 10.0)
    return np.log(p / p.sum())


def _lp(logp: np.ndarray) -> np.ndarray:
    """By piece id, with the entry for 'no such piece' last."""
    return np.append(logp, NEG)


def _expect(lat: Lattice, words: list[bytes], c: np.ndarray, lps: list[np.ndarray], totals: np.ndarray) -> None:
    """Add each class's expected uses of the pieces over words with counts."""
    for some, w in lat.groups(words):
        edges = lat.edges(w)
        for k, lp in enumerate(lps):
            own = np.flatnonzero(c[some, k])
            if len(own):
                lat.expected([e[own] for e in edges], lp, w.shape[1], c[some[own], k], totals[k])


def _maximise(totals: np.ndarray, start: np.ndarray, prior: float) -> list[np.ndarray]:
    p = totals[:, :-1] + prior * np.exp(start)
    return list(np.log(p / p.sum(1, keepdims=True)))


def fit(counts: DataFrame, classes: int, often: tuple[list[bytes], np.ndarray], pieces: list[bytes], ranks: np.ndarray,
        rounds: int = 2, warm_up: int = 6, prior: float = 200.0) -> list[np.ndarray]:
    """Log probabilities of the pieces for each class: ``warm_up`` rounds of
    expectation maximisation over the broadcast words alone (a bounded list),
    then ``rounds`` over all words; the starting distribution stays as a prior
    of ``prior`` tokens.  A round over all words sends one number per piece
    and class to the driver, whatever the size of the corpus."""
    spark = counts.sparkSession
    start, lat = _with_end(ranks), _lattice(pieces)
    logp = [start] * classes
    for _ in range(warm_up if len(often[0]) else 0):
        totals = np.zeros((classes, len(pieces) + 1))
        _expect(lat, often[0], often[1], [_lp(x) for x in logp], totals)
        logp = _maximise(totals, start, prior)
    vocab = spark.sparkContext.broadcast(pieces)                 # one vocabulary file, of fixed size
    for _ in range(rounds):
        shipped = spark.sparkContext.broadcast(logp)

        def run(batches, shipped=shipped):
            lat, lps = _lattice(vocab.value), [_lp(x) for x in shipped.value]
            totals = np.zeros((classes, len(lps[0])))
            for batch in batches:
                c = np.stack([batch.column(1 + k).to_numpy(zero_copy_only=False) for k in range(classes)], axis=1).astype(float)
                _expect(lat, [b" " + w.encode() for w in batch.column(0).to_pylist()], c, lps, totals)
            k, at = np.nonzero(totals[:, :-1])
            yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(at.astype(np.int32)), pa.array(totals[k, at])],
                                             names=["k", "piece", "uses"])

        uses = (counts.select("word", *[f"c{k}" for k in range(classes)]).mapInArrow(run, "k int, piece int, uses double")
                .groupBy("k", "piece").agg(F.sum("uses").alias("uses")).toPandas())
        totals = np.zeros((classes, len(pieces) + 1))
        totals[uses["k"].to_numpy(dtype=np.int64), uses["piece"].to_numpy(dtype=np.int64)] = uses["uses"].to_numpy()
        logp = _maximise(totals, start, prior)
    return logp


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: crc32(id as text) mod 5 = 1 (a NULL id is
    neither held out nor trained on)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


DISCOUNT = 0.75


class Model:
    """Distributions of the classes: counts totals and piece log
    probabilities; ``word_logs`` gives the log10 probability of words."""

    def __init__(self, logp, n, distinct, ends):
        self.lps = [_lp(x) for x in logp]
        # tokens, with ends; a word not seen and an end count once more, so that
        # nothing is impossible
        self.n = np.array(n, dtype=float) + np.array(ends, dtype=float) + 2
        self.distinct, self.ends = np.array(distinct, dtype=float), np.array(ends, dtype=float)

    def word_logs(self, lat: Lattice, words: list[bytes], c: np.ndarray) -> np.ndarray:
        out = np.empty((len(words), len(self.lps)))
        for some, w in lat.groups(words):
            edges = lat.edges(w)
            for k, lp in enumerate(self.lps):
                sub = np.exp(lat.forward(edges, lp, w.shape[1])[:, -1])
                whole = np.maximum(c[some, k] - DISCOUNT, 0) / self.n[k]
                spare = (DISCOUNT * self.distinct[k] + 1) / self.n[k]
                with np.errstate(divide="ignore"):
                    both = np.log10(whole + spare * sub)
                low = np.flatnonzero(~np.isfinite(both))                     # below the least double
                if len(low):
                    both[low] = (np.log(spare) + lat.forward([e[low] for e in edges], lp, w.shape[1])[:, -1]) / math.log(10)
                out[some, k] = both
        return out

    def end_logs(self) -> np.ndarray:
        return np.log10((self.ends + 1) / self.n)

    def class_logs(self) -> np.ndarray:
        total = self.ends.sum()
        return np.log10(self.ends / total) if total else np.zeros(len(self.ends))


def _classes(train: DataFrame, class_col: str | None, most: int = 8) -> list:
    """The most frequent values of the class column; the others, and texts
    whose value is missing, share the last class."""
    if class_col is None:
        return []
    top = (train.filter(F.col("klass_of").isNotNull()).groupBy("klass_of").count()
           .orderBy(F.desc("count"), "klass_of").limit(most).collect())
    return [r["klass_of"] for r in top]


def score(docs: DataFrame, pieces: list[bytes], ranks: np.ndarray, class_col: str | None = "lang", rounds: int = 2) -> DataFrame:
    """Score every whole text; train on the rows that are not held out.

    ``class_col`` groups the training rows into classes; it is not read for
    scoring, which sums over the classes.  Returns ``doc_id, held_out,
    n_tokens, n_known, train_tokens, base_score, score`` (log10).  NULL and
    empty texts are one end token; repeated rows stay, each with its scores; a
    table without training rows scores by the vocabulary's own distribution."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), held_out(F.col("doc_id")).alias("held_out"),
                       (F.col(class_col).cast("string") if class_col else F.lit(None).cast("string")).alias("klass_of"))
    train = rows.filter(~F.col("held_out") & F.col("doc_id").isNotNull())
    named = _classes(train, class_col)
    of = F.lit(len(named))
    for k, value in enumerate(named):
        of = F.when(F.col("klass_of") == value, k).otherwise(of)
    train = train.select("doc_id", "text", F.coalesce(of, F.lit(len(named))).cast("int").alias("klass"))
    ends = {r["klass"]: r["count"] for r in train.groupBy("klass").count().collect()}
    classes = max(1, len(named) + (len(named) in ends))
    ends = [ends.get(k, 0) for k in range(classes)]
    cols = [f"c{k}" for k in range(classes)]
    counts = keep(word_counts(train, classes))
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"),
                       *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in cols],
                       *[F.count(F.when(F.col(c) > 0, 1)).alias("v" + c) for c in cols]).first()
    n_docs = sum(ends)
    n, v = total["n"] + n_docs, total["v"] + (n_docs > 0)
    often = counts.filter(F.col("c") * HEAVY >= n).toPandas()    # at most HEAVY words, since the counts add up to n
    often_words, often_c = [b" " + x.encode() for x in often["word"]], often[cols].to_numpy(dtype=float)
    model = Model(fit(counts, classes, (often_words, often_c), pieces, ranks, rounds),
                  [total[c] for c in cols], [total["v" + c] for c in cols], ends)
    denominator = n + 0.5 * (v + 1)
    end_base, end_logs, class_logs = math.log10((n_docs + 0.5) / denominator), model.end_logs(), model.class_logs()
    vocab, fitted = spark.sparkContext.broadcast(pieces), spark.sparkContext.broadcast(model)
    shipped = spark.sparkContext.broadcast((often["word"].tolist(), np.log10((often["c"].to_numpy(dtype=float) + 0.5) / denominator),
                                            model.word_logs(_lattice(pieces), often_words, often_c)))
    names = [f"s{k}" for k in range(classes)]

    def run(batches):
        words, base, logs = shipped.value
        words = pa.array(words, type=pa.large_string())
        row = TaskContext.get().partitionId() << 33
        for batch in sized(batches, "text", 16_000_000):
            w = Words(column(batch, "text"))
            size = max(len(w.words), 1)
            at = np.full(size, -1, dtype=np.int64)
            if len(w.words):
                at = pc.fill_null(pc.index_in(w.words, value_set=words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            known = at >= 0
            place = at[w.codes]
            here = place >= 0
            m, doc = batch.num_rows, w.doc_of()
            sums = lambda x: np.bincount(doc[here], weights=x[place[here]], minlength=m)
            pair, times = counted(doc[~here] * size + w.codes[~here])
            offs = pa.array(np.searchsorted(pair // size, np.arange(m + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(row, row + m)), batch.column(0), batch.column(2), pa.array(w.sizes + 1),
                pa.array(np.bincount(doc[here], minlength=m) + int(n_docs > 0)), pa.array(sums(base) + end_base),
                *[pa.array(sums(logs[:, k]) + end_logs[k]) for k in range(classes)],
                pa.ListArray.from_arrays(offs, w.words.take(pa.array(pair % size)).cast(pa.string())),
                pa.ListArray.from_arrays(offs, pa.array(times.astype(np.int32)))],
                names=["key", "doc_id", "held_out", "n_tokens", "known", "base", *names, "rare", "times"])
            row += m

    doubles = "".join(f", {x} double" for x in names)
    made = keep(rows.drop("klass_of").mapInArrow(run, f"key bigint, doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, "
                                                      f"n_tokens bigint, known bigint, base double{doubles}, rare array<string>, times array<int>"))
    # words below the broadcast bound meet their counts in a shuffle; none is frequent
    each = made.select("key", F.explode(F.arrays_zip("rare", "times")).alias("x")).select(
        "key", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
    met = each.join(counts.filter(F.col("c") * HEAVY < n), "word", "left").select("key", "word", "times", "c", *cols)

    def rest(batches):
        lat, model = _lattice(vocab.value), fitted.value
        for batch in batches:
            enc = batch.column(1).dictionary_encode()
            code = enc.indices.to_numpy(zero_copy_only=False)
            _, first = np.unique(code, return_index=True)
            num = lambda i: pc.fill_null(batch.column(i), 0).to_numpy(zero_copy_only=False).astype(float)
            c = np.stack([num(4 + k) for k in range(classes)], axis=1)[first]
            logs = model.word_logs(lat, [b" " + x.encode() for x in enc.dictionary.to_pylist()], c)
            times, total = num(2), num(3)
            key, inv = np.unique(batch.column(0).to_numpy(), return_inverse=True)
            add = lambda x: pa.array(np.bincount(inv, weights=x * times, minlength=len(key)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), add((total > 0).astype(float)).cast(pa.int64()), add(np.log10((total + 0.5) / denominator)),
                 *[add(logs[code, k]) for k in range(classes)]], names=["key", "k", "b", *("r" + x for x in names)])

    rdoubles = "".join(f", r{x} double" for x in names)
    sums = met.mapInArrow(rest, f"key bigint, k bigint, b double{rdoubles}").groupBy("key").agg(
        F.sum("k").alias("k"), F.sum("b").alias("b"), *[F.sum("r" + x).alias("r" + x) for x in names])
    joined = made.drop("rare", "times").join(sums, "key", "left")
    by_class = F.array(*[F.col(x) + F.coalesce("r" + x, F.lit(0.0)) + float(p) for x, p in zip(names, class_logs) if np.isfinite(p)])
    top = F.array_max(by_class)
    spread = F.aggregate(by_class, F.lit(0.0), lambda a, x: a + F.pow(F.lit(10.0), x - top))
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("k", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("b", F.lit(0.0))).alias("base_score"),
        (top + F.log10(spread)).alias("score"))
