"""Toxicity: a bidirectional gated recurrent network with attention pooling.

Each word enters as its own embedding (hashed) joined with a character
input: the element-wise maximum over the embeddings of its hashed byte
n-grams (with word borders).  A GRU reads each window of words both ways,
attention pools the states, and one logit comes out.  A text's score is the
sigmoid of the greatest logit of its overlapping windows, which cover the
whole text.  The net is trained here, in numpy, on a bounded sample of
labelled rows; only the label and the text's words enter it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import U64, Words, add_columns, column, distinct, give_back, hash_strings, mix

WINDOW, STRIDE = 32, 16          # words
HIDDEN, DIM, ATT = 8, 8, 8
WORD_BITS, GRAM_BITS = 17, 17
GRAMS = (3, 4, 5, 6)             # bytes, borders included
F32 = np.float32


def word_inputs(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each word, buckets of its n-grams (flat) and their starts."""
    own = (hash_strings(words) >> U64(64 - WORD_BITS)).astype(np.int64)
    raw = [b"\x02" + w.encode() + b"\x03" for w in words.to_pylist()]
    lens = np.fromiter(map(len, raw), dtype=np.int32, count=len(raw))
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    begin = np.cumsum(lens, dtype=np.int64) - lens
    of = np.repeat(np.arange(len(raw), dtype=np.int32), lens)
    left = np.repeat((begin + lens).astype(np.int32), lens) - np.arange(len(data), dtype=np.int32)     # bytes to the word's end
    each = [np.maximum(lens - n + 1, 0) for n in GRAMS]
    total = sum(each)
    starts = np.cumsum(total, dtype=np.int64) - total
    flat, put = np.empty(int(total.sum()), dtype=np.int32), starts.copy()
    with np.errstate(over="ignore"):
        h = np.zeros(len(data), dtype=U64)
        for n in range(1, max(GRAMS) + 1):
            h = h[:max(len(data) - n + 1, 0)] * U64(0x100000001B3) + data[n - 1:] + U64(1)
            if n in GRAMS:
                ok = np.flatnonzero(left[:len(h)] >= n)
                owner = of[ok]
                flat[put[owner] + ok - begin[owner]] = mix(h[ok] + U64(n)) >> U64(64 - GRAM_BITS)
                put += each[GRAMS.index(n)]
    return own, flat, starts


def windows(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping windows that cover every text: first word, number of words
    and the text they belong to (a text without words has one empty window)."""
    per = np.maximum(1, -(-(sizes - WINDOW) // STRIDE) + 1)
    doc = np.repeat(np.arange(len(sizes)), per)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
    at = np.minimum(k * STRIDE, np.maximum(sizes - WINDOW, 0)[doc])
    return starts[doc] + at, np.minimum(sizes[doc] - at, WINDOW), doc


class Net:
    def __init__(self, seed: int = 7):
        g = np.random.default_rng(seed)
        self.words = (g.normal(0, 0.05, (1 << WORD_BITS, DIM))).astype(F32)
        self.grams = (g.normal(0, 0.05, (1 << GRAM_BITS, DIM))).astype(F32)
        n = lambda a, b: g.normal(0, (1 / a) ** 0.5, (a, b)).astype(F32)
        self.p = {}
        for d in "fb":
            self.p |= {f"W{d}": n(2 * DIM, 3 * HIDDEN), f"U{d}": n(HIDDEN, 3 * HIDDEN),
                       f"b{d}": np.zeros(3 * HIDDEN, F32)}
        self.p |= {"A": n(2 * HIDDEN, ATT), "ab": np.zeros(ATT, F32), "v": n(ATT, 1)[:, 0],
                   "o": n(2 * HIDDEN, 1)[:, 0], "ob": np.zeros(1, F32)}

    # ---- inputs
    def inputs(self, own, flat, starts) -> np.ndarray:
        """Input vector of each distinct word."""
        out = np.empty((len(own), 2 * DIM), dtype=F32)
        out[:, :DIM] = self.words[own]
        step = 1 << 13
        for a in range(0, len(own), step):
            b = min(a + step, len(own))
            end = starts[b] if b < len(starts) else len(flat)
            out[a:b, DIM:] = np.maximum.reduceat(self.grams[flat[starts[a]:end]], starts[a:b] - starts[a], axis=0)
        return out

    # ---- forward
    def _gru(self, proj, codes, mask, d, trace=None):
        n, t_all = codes.shape
        u, h = self.p["U" + d], np.zeros((n, HIDDEN), dtype=F32)
        states = np.empty((t_all, n, HIDDEN), dtype=F32)
        half = F32(0.5)
        for t in (range(t_all) if d == "f" else range(t_all - 1, -1, -1)):
            x, g = proj[codes[:, t]], h @ u
            rz = np.tanh((x[:, :2 * HIDDEN] + g[:, :2 * HIDDEN]) * half)
            rz += F32(1)
            rz *= half
            r, z = rz[:, :HIDDEN], rz[:, HIDDEN:]
            c = np.tanh(x[:, 2 * HIDDEN:] + r * g[:, 2 * HIDDEN:])
            m = mask[:, t, None]
            step = (F32(1) - z) * (c - h) * m
            if trace is not None:
                trace.append((t, h, r, z, c, g[:, 2 * HIDDEN:], m))
            h = h + step
            states[t] = h
        return states

    def project(self, x):
        return {d: x @ self.p["W" + d] + self.p["b" + d] for d in "fb"}

    def logits(self, proj, codes, mask, traces=None):
        tf, tb = traces if traces is not None else (None, None)
        s = np.concatenate([self._gru(proj["f"], codes, mask, "f", tf), self._gru(proj["b"], codes, mask, "b", tb)], axis=2)
        a = np.tanh(s @ self.p["A"] + self.p["ab"])
        e = a @ self.p["v"]                                  # (time, window)
        e = np.where(mask.T > 0, e, F32(-1e9))
        w = np.exp(e - e.max(0)) * mask.T
        w /= np.maximum(w.sum(0), F32(1e-9))
        ctx = np.einsum("tn,tnh->nh", w, s)
        out = ctx @ self.p["o"] + self.p["ob"][0]
        return (out, s, a, w, ctx) if traces is not None else out

    def score_windows(self, proj, codes_flat, first, count, most=4096) -> np.ndarray:
        """Logit of each window, a bounded number at a time."""
        out = np.empty(len(first), dtype=F32)
        t = np.arange(WINDOW)
        top = max(len(codes_flat) - 1, 0)
        for a in range(0, len(first), most):
            b = slice(a, a + most)
            at = np.minimum(first[b, None] + t, top)
            codes = codes_flat[at] if len(codes_flat) else np.zeros_like(at)
            out[b] = self.logits(proj, codes, (t < count[b, None]).astype(F32))
        return out

    # ---- one training step on windows of distinct words
    def step(self, vocab, codes, mask, y, opt) -> float:
        own, flat, starts = vocab
        used, inv = np.unique(codes, return_inverse=True)
        codes = inv.reshape(codes.shape)
        n_grams = np.append(starts[1:], len(flat))[used] - starts[used]
        cut = np.cumsum(n_grams) - n_grams
        grams = flat[np.repeat(starts[used] - cut, n_grams) + np.arange(n_grams.sum())]
        x = self.inputs(own[used], grams, cut)
        proj, traces = self.project(x), ([], [])
        out, s, a, w, ctx = self.logits(proj, codes, mask, traces)
        p = 1 / (1 + np.exp(-out))
        loss = float(-np.mean(np.where(y > 0, np.log(p + 1e-9), np.log(1 - p + 1e-9))))
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        do = ((p - y) / len(y)).astype(F32)
        g["o"], g["ob"] = ctx.T @ do, do.sum(keepdims=True)
        dctx = do[:, None] * self.p["o"]
        ds = w[:, :, None] * dctx
        dw = np.einsum("tnh,nh->tn", s, dctx)
        de = w * (dw - (w * dw).sum(0))
        g["v"] = np.einsum("tna,tn->a", a, de)
        da = de[:, :, None] * self.p["v"] * (1 - a * a)
        g["A"], g["ab"] = np.einsum("tnh,tna->ha", s, da), da.sum((0, 1))
        ds += da @ self.p["A"].T
        dx = np.zeros_like(x)
        for d, trace, part in (("f", traces[0], ds[:, :, :HIDDEN]), ("b", traces[1], ds[:, :, HIDDEN:])):
            dproj = np.zeros_like(proj[d])
            u, dh = self.p["U" + d], np.zeros(part.shape[1:], dtype=F32)
            for t, h, r, z, c, gn, m in reversed(trace):
                dh = dh + part[t]
                dm = dh * m
                dc = dm * (1 - z) * (1 - c * c)
                dz = dm * (h - c) * z * (1 - z)
                dr = dc * gn * r * (1 - r)
                dg = np.concatenate([dr, dz, dc * r], axis=1)
                np.add.at(dproj, codes[:, t], np.concatenate([dr, dz, dc], axis=1))
                g["U" + d] += h.T @ dg
                dh = dh - dm * (1 - z) + dg @ u.T
            g["W" + d], g["b" + d] = x.T @ dproj, dproj.sum(0)
            dx += dproj @ self.p["W" + d].T
        opt.dense(self.p, g)
        opt.rows("words", self.words, own[used], dx[:, :DIM])
        top = np.repeat(np.arange(len(used)), n_grams)
        hit = self.grams[grams] == x[top, DIM:]
        opt.rows("grams", self.grams, grams, np.where(hit, dx[top, DIM:], 0))
        return loss


class Optimiser:
    """Adam for the dense parameters, Adagrad for embedding rows."""

    def __init__(self, net: Net, rate=0.01, row_rate=0.05):
        self.rate, self.row_rate, self.t = rate, row_rate, 0
        self.m = {k: np.zeros_like(v) for k, v in net.p.items()}
        self.s = {k: np.zeros_like(v) for k, v in net.p.items()}
        self.sq = {"words": np.full(net.words.shape, 1e-6, F32), "grams": np.full(net.grams.shape, 1e-6, F32)}

    def dense(self, p, g):
        self.t += 1
        for k in p:
            self.m[k] = 0.9 * self.m[k] + 0.1 * g[k]
            self.s[k] = 0.99 * self.s[k] + 0.01 * g[k] ** 2
            p[k] -= (self.rate * (self.m[k] / (1 - 0.9 ** self.t)) / (np.sqrt(self.s[k] / (1 - 0.99 ** self.t)) + 1e-8)).astype(F32)

    def rows(self, name, table, rows, grad):
        live = np.flatnonzero(np.any(grad != 0, axis=1))
        at, inv = np.unique(rows[live], return_inverse=True)
        total = np.zeros((len(at), grad.shape[1]), dtype=F32)
        np.add.at(total, inv, grad[live])
        self.sq[name][at] += total ** 2
        table[at] -= self.row_rate * total / np.sqrt(self.sq[name][at])


def _log_odds(bucket: np.ndarray, pos: np.ndarray, neg: np.ndarray, size: int, rate: float, prior: float = 5.0) -> np.ndarray:
    """Smoothed log ratio of uses in toxic texts to uses in others, summed
    over the words of each bucket (a text uses a word once)."""
    p, n = np.bincount(bucket, weights=pos, minlength=size), np.bincount(bucket, weights=neg, minlength=size)
    return (np.log((p + prior * rate) / (n + prior * (1 - rate))) - np.log(rate / (1 - rate))).astype(F32)


def train(texts: pa.Array, y: np.ndarray, epochs: int = 5, seed: int = 7) -> Net:
    """Fit the net: a text's loss is that of its strongest window (chosen
    anew in the second and every other later epoch); the first component of every embedding starts at the
    log odds of its bucket in the sample."""
    net, rng = Net(seed), np.random.default_rng(seed)
    y = np.asarray(y, dtype=F32)
    if not len(texts) or y.min() == y.max():
        net.p["o"][:] = 0
        net.p["ob"][:] = 0 if not len(texts) else (20 if y[0] else -20)
        return net
    w = Words(texts.cast(pa.large_string()))
    vocab = own, flat, starts = word_inputs(w.words)
    w.codes = w.codes.astype(np.int32)
    pair = distinct(w.doc_of() * len(own) + w.codes)
    toxic = y[pair // len(own)]
    pair %= len(own)
    pos, neg = np.bincount(pair, weights=toxic, minlength=len(own)), np.bincount(pair, weights=1 - toxic, minlength=len(own))
    del pair, toxic
    rate = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    net.words[:, 0] = _log_odds(own, pos, neg, 1 << WORD_BITS, rate)
    n_grams = np.append(starts[1:], len(flat)) - starts
    net.grams[:, 0] = _log_odds(flat, np.repeat(pos.astype(F32), n_grams), np.repeat(neg.astype(F32), n_grams), 1 << GRAM_BITS, rate)
    first, count, of = windows(w.starts, w.sizes)
    opt, t, batch = Optimiser(net), np.arange(WINDOW), min(256, max(16, len(y) // 50))
    begin = np.searchsorted(of, np.arange(len(y)))
    for epoch in range(epochs):
        if epoch % 2:
            score = net.score_windows(net.project(net.inputs(*vocab)), w.codes, first, count)
        elif epoch == 0:                  # untrained: windows by the log odds of their words alone
            odds = np.concatenate([[0], np.cumsum(np.maximum(net.words[own, 0] + net.inputs(*vocab)[:, DIM], 0)[w.codes])])
            score = odds[np.minimum(first + count, len(odds) - 1)] - odds[np.minimum(first, len(odds) - 1)]
        order = np.lexsort((-score, of))
        pick = order[begin]               # strongest window of each text
        pick = rng.permutation(pick)
        for a in range(0, len(pick), batch):
            i = pick[a:a + batch]
            at = np.minimum(first[i, None] + t, max(len(w.codes) - 1, 0))
            if not len(w.codes):
                break
            net.step(vocab, w.codes[at], (t < count[i, None]).astype(F32), y[of[i]], opt)
        opt.rate *= 0.75
        opt.row_rate *= 0.75
    return net


def score_texts(net: Net, texts: pa.Array) -> np.ndarray:
    w = Words(texts)
    first, count, of = windows(w.starts, w.sizes)
    if len(w.words):
        proj = net.project(net.inputs(*word_inputs(w.words)))
    else:
        proj = net.project(np.zeros((1, 2 * DIM), dtype=F32))
    logit = net.score_windows(proj, w.codes, first, count)
    best = np.maximum.reduceat(logit, np.searchsorted(of, np.arange(len(texts)))) if len(texts) else np.zeros(0)
    return 1 / (1 + np.exp(-best.astype(np.float64)))


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int, label: str = "toxic", text: str = "text") -> tuple[pa.Array, np.ndarray]:
    """Texts and labels of about ``most`` training rows at most (documented
    bound), chosen by a hash of the id; rows with crc32(id) mod 5 = 0 are
    never used.  Repeated ids count once, with their greatest label."""
    own = (labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
           .filter(~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max(label).alias("__y")))
    n = own.count()
    if n > most:
        own = own.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < int(1_000_003 * most / n))
    rows = (docs.select("doc_id", F.col(text).alias("__text")).join(F.broadcast(own), "doc_id")
            .groupBy("doc_id").agg(F.min(F.coalesce("__text", F.lit(""))).alias("t"), F.max("__y").alias("y"))).toArrow()
    rows = rows.take(pc.sort_indices(rows["doc_id"]))
    return rows["t"].combine_chunks(), rows["y"].to_numpy().astype(F32)


def can_learn(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> bool:
    """Whether any row may be learnt from: labelled, not held out, and there."""
    own = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).filter(~held_out(F.col("doc_id")))
    return not own.select("doc_id").join(docs.select("doc_id"), "doc_id", "left_semi").isEmpty()


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = 3_000, epochs: int = 6,
             text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out double`` in 0..1 (higher: likelier toxic).

    ``sample`` bounds the labelled rows the net is trained on; every whole
    text is scored.  NULL and empty texts have one empty window and get the
    net's score of it; without labelled rows every score is 0.5; repeated
    rows stay; other columns pass through."""
    net = train(*labelled_sample(docs, labels, sample, text=text), epochs=epochs)
    give_back()
    shipped = docs.sparkSession.sparkContext.broadcast(net)        # of fixed size

    def make():
        return lambda batch: [pa.array(score_texts(shipped.value, column(batch, text)))]

    return add_columns(docs, [T.StructField(out, T.DoubleType())], make, text, 6_000_000)


def held_out(doc_id: Column) -> Column:
    """Rows never used for training: crc32(id as text) mod 5 = 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
