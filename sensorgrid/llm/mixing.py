"""Mixing documents to target domain weights by soft membership.

A classifier fitted on a labelled table gives each document a posterior over
domains.  Non-negative document rates are then fitted by distributed projected
gradient steps, so that the expected tokens of each domain, the sum over
documents of rate x tokens x posterior, match the targets in least squares.
A step needs one sum per domain (and pair of domains) from the whole table;
the rates stay with the documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import U64, Words, column, counted, give_back, hash_strings, keep, mix, sized

BITS = 16                 # buckets of words and of word endings
SCALE = 20.0              # logits are this times the mean weight of a text's words
F32 = np.float32


def _features(words: pa.Array) -> np.ndarray:
    """Buckets of each word: itself, its last characters, its kind of end."""
    texts = words.to_pylist()
    own = hash_strings(words)
    out = np.empty((len(texts), 3), dtype=np.int32)
    for k, kind in enumerate((None, lambda t: t[-3:], lambda t: "".join("a" if c.isalpha() else c for c in t[-2:]))):
        h = own if kind is None else hash_strings(pa.array([kind(t) for t in texts], type=pa.large_string()))
        out[:, k] = (mix(h + U64(k + 1)) >> U64(64 - BITS)).astype(np.int32) + (k << BITS)
    return out


class Classifier:
    """Softmax regression over mean word features."""

    def __init__(self, domains: list[str]):
        self.domains = domains
        self.w = np.zeros((3 << BITS, len(domains)), dtype=F32)
        self.b = np.zeros(len(domains), dtype=F32)

    def fit(self, texts: pa.Array, y: np.ndarray, epochs: int = 12, batch: int = 128, rate: float = 0.3, seed: int = 3) -> "Classifier":
        if not len(texts):
            return self
        share = np.bincount(y, minlength=len(self.domains)) + 0.5
        self.b = np.log(share / share.sum()).astype(F32)
        w = Words(texts.cast(pa.large_string()))
        feats, size = _features(w.words), max(len(w.words), 1)
        pair, n = counted(w.doc_of() * size + w.codes)
        doc, word = (pair // size).astype(np.int32), (pair % size).astype(np.int32)
        value = (SCALE * n / w.sizes[doc]).astype(F32)
        del pair, n
        ends = np.searchsorted(doc, np.arange(len(texts) + 1))
        sq, sqb, rng = np.full_like(self.w, 1e-4), np.full_like(self.b, 1e-4), np.random.default_rng(seed)
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for a in range(0, len(order), batch):
                some = np.sort(order[a:a + batch])
                at = np.concatenate([np.arange(ends[i], ends[i + 1]) for i in some])
                local = np.repeat(np.arange(len(some)), ends[some + 1] - ends[some])
                f, v = feats[word[at]], value[at]
                z = np.zeros((len(some), len(self.domains)), dtype=F32)
                np.add.at(z, local, self.w[f].sum(1) * v[:, None])
                p = _softmax(z + self.b)
                p[np.arange(len(some)), y[some]] -= 1
                p /= len(some)
                g = p[local] * v[:, None]
                rows, inv = np.unique(f.ravel(), return_inverse=True)
                total = np.zeros((len(rows), g.shape[1]), dtype=F32)
                np.add.at(total, inv, np.repeat(g, 3, axis=0))
                sq[rows] += total ** 2
                self.w[rows] -= rate * 0.2 * total / np.sqrt(sq[rows])
                sqb += p.sum(0) ** 2
                self.b -= rate * 0.2 * p.sum(0) / np.sqrt(sqb)
        return self

    def posteriors(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Posterior over the domains and number of words of each text."""
        w = Words(texts)
        z = np.tile(self.b.astype(float), (len(texts), 1))
        if len(w.words):
            each = self.w[_features(w.words)].sum(1).astype(float)
            for k in range(z.shape[1]):
                z[:, k] += SCALE * w.doc_sums(each[w.codes, k]) / np.maximum(w.sizes, 1)
        return _softmax(z), w.sizes


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit_classifier(docs: DataFrame, labelled: DataFrame, domains: list[str], most: int = 4000,
                   id_col: str = "doc_id", text: str = "text") -> Classifier:
    """Fit on about ``most`` rows at most (documented bound, chosen by a hash
    of the id) of ``labelled (id, domain)``; rows of other domains and NULLs
    are not used; a repeated id counts once, with its least domain."""
    own = labelled.filter(F.col("domain").isin(domains) & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min("domain").alias("__y"))
    n = own.count()
    if n > most:
        own = own.filter(F.pmod(F.xxhash64(id_col), F.lit(1_000_003)) < int(1_000_003 * most / n))
    rows = (docs.select(id_col, F.col(text).alias("__text")).join(F.broadcast(own), id_col)
            .groupBy(id_col).agg(F.min(F.coalesce("__text", F.lit(""))).alias("t"), F.min("__y").alias("y"))).toArrow()
    rows = rows.take(pc.sort_indices(rows[id_col]))
    return Classifier(domains).fit(rows["t"].combine_chunks(), np.array([domains.index(d) for d in rows["y"].to_pylist()], dtype=np.int64))


def memberships(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, id, n_tokens, p0, p1, ...``: words of each row's text and its
    posterior of each domain (NULL and empty texts: the domains' shares)."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)    # of fixed size
    names = [f"p{k}" for k in range(len(model.domains))]
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        row = TaskContext.get().partitionId() << 33
        for batch in sized(batches, text, 6_000_000):
            p, n = shipped.value.posteriors(column(batch, text))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + len(n))), batch.column(0), pa.array(n), *[pa.array(p[:, k]) for k in range(len(names))]],
                names=["key", "id", "n_tokens", *names])
            row += batch.num_rows

    return docs.select(F.col(id_col).alias("id"), text).mapInArrow(
        run, f"key bigint, id {kind}, n_tokens bigint" + "".join(f", {n} double" for n in names))


# Lengths tried of a step scaled by the curvature, and of a plain gradient step.
LENGTHS = ((1.0, 0.5, 0.2, 0.05), (1.0, 4.0, 16.0))


def fit_rates(members: DataFrame, targets: list[float], steps: int = 60, tolerance: float = 1e-6) -> DataFrame:
    """``members`` with ``rate``: non-negative rates, from 1 on, whose expected
    domain tokens are nearest the ``targets`` in least squares.

    A step moves every rate against the gradient and projects it back to 0 or
    more; one pass over the table tries several steps, scaled by the curvature
    over the documents that have a rate or not at all, and the one that comes
    nearest is taken.  It ends when no domain is off by more than
    ``tolerance`` of all target tokens, or no step comes nearer.  A domain
    that no document belongs to cannot be served."""
    k = len(targets)
    names = [f"p{i}" for i in range(k)]
    goal, corner = np.array(targets, dtype=float), np.triu_indices(k)
    taken, tries, best = [], [np.zeros(k)], None
    for _ in range(steps):
        rows = _sums(members, names, taken, tries)
        error = np.linalg.norm(rows[:, :k] - goal, axis=1)
        pick = int(np.argmin(error))
        if best is not None and error[pick] >= best * (1 - 1e-6):
            break
        best, off = float(error[pick]), rows[pick, :k] - goal
        h = np.zeros((k, k))
        h[corner] = rows[pick, k:]
        h = h + np.triu(h, 1).T
        taken.append(tries[pick])
        longest = float(np.linalg.eigvalsh(h)[-1]) if k else 0.0
        if np.abs(off).max() <= tolerance * goal.sum() or not longest:
            break
        scaled = np.linalg.pinv(h, rcond=1e-9, hermitian=True) @ off
        tries = [scaled * t for t in LENGTHS[0]] + [off / longest * t for t in LENGTHS[1]]

    def rated(batches):
        for batch in batches:
            rate = pa.array(_rates(_columns(batch, names), taken))
            yield pa.RecordBatch.from_arrays([*batch.columns, rate], names=[*batch.schema.names, "rate"])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in members.schema.fields]
    return members.mapInArrow(rated, ", ".join([*kinds, "rate double"]))


def _columns(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    return np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in names], axis=1)


def _rates(p: np.ndarray, taken: list[np.ndarray]) -> np.ndarray:
    """Rates of documents after the steps taken, from 1 on."""
    rate = np.ones(len(p))
    for step in taken:
        rate = np.maximum(0.0, rate - p @ step)
    return rate


def _sums(members: DataFrame, names: list[str], taken: list[np.ndarray], tries: list[np.ndarray]) -> np.ndarray:
    """Of each step tried after those ``taken``: the expected tokens of each
    domain and, over the documents with a rate, the tokens of each pair.  The
    steps go to the tasks as numbers, so that the plan is the same in every
    pass and nothing is compiled anew."""
    corner = np.triu_indices(len(names))
    width = len(names) + len(corner[0])

    def run(batches):
        total = np.zeros((len(tries), width))
        for batch in batches:
            p, n = _columns(batch, names), _columns(batch, ["n_tokens"])[:, 0].astype(float)
            rate = _rates(p, taken)
            for t, step in enumerate(tries):
                moved = np.maximum(0.0, rate - p @ step)
                held = p * (n * (moved > 0))[:, None]
                total[t] += np.concatenate([(moved * n) @ p, (held.T @ p)[corner]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["at", "x"])

    out = np.zeros(len(tries) * width)
    for at, x in members.mapInArrow(run, "at bigint, x double").groupBy("at").agg(F.sum("x")).collect():
        out[at] = x
    return out.reshape(len(tries), width)


def copies(rate: Column, *ids: Column) -> Column:
    """Whole copies of a document: its rate rounded up or down at random by a
    hash of its id, so that the expected number is the rate."""
    u = F.pmod(F.xxhash64(*ids, F.lit("copies")), F.lit(1 << 30)) / float(1 << 30)
    return F.floor(rate + u).cast("long")


def mix_documents(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], total: float | str = "corpus",
                  sample: int = 4000, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, id, n_tokens, <p per domain>, rate`` of every row; ``weights``
    are the target shares of the domains, in names of ``labelled.domain``.

    ``total`` tokens are aimed at: ``"corpus"`` for as many as there are, a
    number, or ``"keep:<domain>:<factor>"`` for as many as leave that domain
    ``factor`` times its tokens.  NULL and empty texts have no tokens and any
    rate fits them; repeated rows stay; without labelled rows every document
    has the even posterior."""
    domains = sorted(weights)
    model = fit_classifier(docs, labelled, domains, sample, id_col, text)
    give_back()
    members = keep(memberships(docs, model, id_col, text))
    share = np.array([weights[d] for d in domains], dtype=float)
    share /= share.sum()
    if isinstance(total, str):
        n = F.col("n_tokens").cast("double")
        kind, _, rest = total.partition(":")
        if kind == "corpus":
            total = members.agg(F.sum(n)).first()[0] or 0.0
        else:
            domain, _, factor = rest.partition(":")
            at = domains.index(domain)
            total = float(factor or 1) * (members.agg(F.sum(n * F.col(f"p{at}"))).first()[0] or 0.0) / share[at]
    fitted = fit_rates(members, list(share * total))
    return fitted.select("key", "id", "n_tokens", *[F.col(f"p{k}").alias(f"p_{d}") for k, d in enumerate(domains)], "rate")


def mixed(docs: DataFrame, rates: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with each row as often as its whole copies say; rows of equal
    id share the mean of their rates."""
    own = rates.groupBy(F.col("id").alias("__id")).agg(F.avg("rate").alias("__rate"))
    d = docs.join(own, F.col(id_col).eqNullSafe(F.col("__id")), "left").withColumn("__n", copies(F.coalesce("__rate", F.lit(1.0)), F.col(id_col)))
    return (d.filter("__n > 0").withColumn("__i", F.explode(F.sequence(F.lit(1).cast("long"), "__n"))).select(*docs.columns))
