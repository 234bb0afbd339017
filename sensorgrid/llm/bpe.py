"""Byte-level BPE encoding and decoding with the ranks of a public tokenizer.

Each match of the splitting pattern is encoded by itself.  A segment tree
over its byte positions holds, at leaf ``i``, ``(rank of the pair that starts
at i, i)``, so the root names the leftmost pair of least rank.  A merge makes
three point updates (the merged position, its dead right neighbour, its live
left neighbour), each logarithmic.  Distinct short matches of a batch run
through their trees together (numpy, one tree per row); a long match has a
tree of its own.
"""

from __future__ import annotations

import base64
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import Table64, add_columns, column, ragged

INF = np.int64(2 ** 62)
SHORT = 64            # bytes; longer matches use a tree of their own
POS_BITS = 16
CACHE_WORDS = 120_000

_coders: dict[int, "Coder"] = {}


def read_ranks(path: str) -> bytes:
    """The rank file's bytes (``base64-token rank`` lines)."""
    with open(path, "rb") as f:
        return f.read()


class Coder:
    """Look-ups of one rank file, and the encoder over distinct matches."""

    def __init__(self, data: bytes):
        pairs = [line.split() for line in data.splitlines() if line.strip()]
        self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for t, r in self.ranks.items():
            tokens[r] = t
        self.tokens = tokens
        self.blob = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.lens = np.array([len(t) for t in tokens], dtype=np.int64)
        self.offs = np.concatenate([[0], np.cumsum(self.lens)[:-1]]).astype(np.int64)
        self.byte_id = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        # every way to join two tokens into a token
        self.pairs = {(self.ranks[t[:i]] << 32) | self.ranks[t[i:]]: r
                      for t, r in self.ranks.items() for i in range(1, len(t))
                      if t[:i] in self.ranks and t[i:] in self.ranks}
        self.table = Table64(np.fromiter(self.pairs, dtype=np.uint64, count=len(self.pairs)),
                             np.fromiter(self.pairs.values(), dtype=np.int64, count=len(self.pairs)))
        self.cache: dict[str, int] = {}          # match -> row of the ragged id table
        self._clear()

    def _clear(self) -> None:
        self.cache.clear()
        self.flat, self.n_flat = np.zeros(1 << 16, dtype=np.int32), 0
        self.at, self.n, self.rows = np.zeros(1 << 14, dtype=np.int64), np.zeros(1 << 14, dtype=np.int64), 0

    def _keys(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of joining two tokens, -1 if they make none."""
        return self.table.get((left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64))

    def encode_short(self, words: list[bytes]) -> list[np.ndarray]:
        out: list = [None] * len(words)
        by_size: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_size.setdefault(max(2, 1 << (len(w) - 1).bit_length()), []).append(i)
        for size, rows in by_size.items():
            for part in range(0, len(rows), 1 << 15):
                some = rows[part:part + (1 << 15)]
                ids, counts = self._trees([words[i] for i in some], size)
                for i, x in zip(some, np.split(ids, np.cumsum(counts)[:-1])):
                    out[i] = x
        return out

    def _trees(self, words: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
        """One segment tree per row over ``size`` byte positions."""
        m = len(words)
        lens = np.fromiter(map(len, words), dtype=np.int64, count=m)
        raw = np.frombuffer(b"".join(w.ljust(size, b"\0") for w in words), dtype=np.uint8).reshape(m, size)
        live = np.arange(size) < lens[:, None]
        tok = self.byte_id[raw]
        nxt = np.tile(np.arange(1, size + 1), (m, 1))
        nxt[np.arange(m), lens - 1] = size                  # size: no neighbour
        prv = np.tile(np.arange(-1, size - 1), (m, 1))
        tree = np.full((m, 2 * size), INF)
        if size > 1:
            rank = self._keys(tok[:, :-1], tok[:, 1:])
            tree[:, size:2 * size - 1] = np.where((rank >= 0) & live[:, 1:], (rank << POS_BITS) | np.arange(size - 1), INF)
        level = size
        while level > 1:
            tree[:, level // 2:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
            level //= 2
        ft, fk, fn, fp, fl = tree.reshape(-1), tok.reshape(-1), nxt.reshape(-1), prv.reshape(-1), live.reshape(-1)
        rows = np.flatnonzero(tree[:, 1] < INF)
        while len(rows):
            best = ft[rows * (2 * size) + 1]
            i, r = best & ((1 << POS_BITS) - 1), best >> POS_BITS
            base = rows * size
            j = fn[base + i]
            k = fn[base + j]
            fk[base + i] = r
            fl[base + j] = False
            fn[base + i] = k
            has_k, p = k < size, fp[base + i]
            fp[(base + k)[has_k]] = i[has_k]
            has_p = p >= 0
            right = np.full(len(rows), -1, dtype=np.int64)
            right[has_k] = self._keys(r[has_k], fk[(base + k)[has_k]])
            left = np.full(len(rows), -1, dtype=np.int64)
            left[has_p] = self._keys(fk[(base + p)[has_p]], r[has_p])
            tb = rows * (2 * size)
            ft[tb + size + j] = INF
            ft[tb + size + i] = np.where(right >= 0, (right << POS_BITS) | i, INF)
            ft[(tb + size + p)[has_p]] = np.where(left >= 0, (left << POS_BITS) | p, INF)[has_p]
            nodes = np.stack([i, j, np.where(has_p, p, i)]) + size
            while nodes[0, 0] > 1:                          # all rows are at the same level
                nodes >>= 1
                at = tb + nodes
                kids = tb + 2 * nodes
                ft[at] = np.minimum(ft[kids], ft[kids + 1])
            rows = rows[ft[tb + 1] < INF]
        return tok[live], live.sum(1)

    def encode_long(self, word: bytes) -> np.ndarray:
        """One match with a segment tree of its own."""
        n, pairs = len(word), self.pairs
        size = 1 << (n - 1).bit_length()
        tok = [int(x) for x in self.byte_id[np.frombuffer(word, dtype=np.uint8)]]
        nxt, prv, none = list(range(1, n + 1)), list(range(-1, n - 1)), 1 << 62
        tree = [none] * (2 * size)
        for i in range(n - 1):
            r = pairs.get((tok[i] << 32) | tok[i + 1])
            if r is not None:
                tree[size + i] = r * size + i
        for v in range(size - 1, 0, -1):
            tree[v] = min(tree[2 * v], tree[2 * v + 1])

        def put(leaf: int, key: int) -> None:
            v = size + leaf
            tree[v] = key
            v >>= 1
            while v:
                low = tree[2 * v] if tree[2 * v] < tree[2 * v + 1] else tree[2 * v + 1]
                if tree[v] == low:
                    break
                tree[v] = low
                v >>= 1

        while tree[1] < none:
            r, i = divmod(tree[1], size)
            j = nxt[i]
            k = nxt[j]
            tok[i], nxt[i] = r, k
            tok[j] = -1
            put(j, none)
            x = None
            if k < n:
                prv[k] = i
                x = pairs.get((r << 32) | tok[k])
            put(i, none if x is None else x * size + i)
            p = prv[i]
            if p >= 0:
                x = pairs.get((tok[p] << 32) | r)
                put(p, none if x is None else x * size + p)
        return np.array([t for t in tok if t >= 0], dtype=np.int64)

    def learn(self, new: list[str]) -> None:
        """Encode matches not seen before and append them to the id table."""
        raw = [w.encode() for w in new]
        ids: list = [None] * len(raw)
        short = [i for i, w in enumerate(raw) if len(w) <= SHORT]
        for i, x in zip(short, self.encode_short([raw[i] for i in short])):
            ids[i] = x
        for i, w in enumerate(raw):
            if len(w) > SHORT:
                ids[i] = self.encode_long(w)
        n = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        flat = np.concatenate(ids).astype(np.int32)
        if self.n_flat + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat[:self.n_flat], np.zeros(max(len(flat), self.n_flat) + 1, np.int32)])
        self.flat[self.n_flat:self.n_flat + len(flat)] = flat
        if self.rows + len(n) > len(self.at):
            more = np.zeros(max(len(n), self.rows) + 1, np.int64)
            self.at, self.n = np.concatenate([self.at[:self.rows], more]), np.concatenate([self.n[:self.rows], more])
        self.at[self.rows:self.rows + len(n)] = self.n_flat + np.cumsum(n) - n
        self.n[self.rows:self.rows + len(n)] = n
        self.cache.update(zip(new, range(self.rows, self.rows + len(n))))
        self.rows += len(n)
        self.n_flat += len(flat)

    def rows_of(self, matches: list[list[str]]) -> np.ndarray:
        """Rows of the id table for all matches, learning the new ones."""
        new = set(chain.from_iterable(matches)).difference(self.cache)
        if new:
            if len(self.cache) + len(new) > CACHE_WORDS and self.cache:
                self._clear()
                new = set(chain.from_iterable(matches))
            self.learn(list(new))
        get = self.cache.__getitem__
        return np.fromiter(map(get, chain.from_iterable(matches)), dtype=np.int64, count=sum(map(len, matches)))

    def encode(self, find, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of whole texts, one after the other, and their counts."""
        flat, counts = [], np.zeros(len(texts), dtype=np.int64)
        for at, many in _portions(find, texts):
            rows = self.rows_of(many)
            flat.append(ragged(self.flat, self.at[rows], self.n[rows]))
            of = np.repeat(np.arange(at, at + len(many)), [len(m) for m in many])
            counts += np.bincount(of, weights=self.n[rows], minlength=len(texts)).astype(np.int64)
        return np.concatenate(flat) if flat else np.zeros(0, np.int32), counts


def _portions(find, texts: list[str], most: int = 1 << 20):
    """``(first text, matches of the next texts)``, a bounded number of
    characters at a time; a very long text comes in several portions."""
    held, at, size = [], 0, 0
    for i, text in enumerate(texts):
        if held and size + len(text) > most:
            yield at, held
            held, at, size = [], i, 0
        if len(text) <= most:
            held.append(find.findall(text))
            size += len(text)
            continue
        found = []
        for m in find.finditer(text):
            found.append(m.group())
            if len(found) >= most >> 3:
                yield i, [found]
                found = []
        yield i, [found]
        at = i + 1
    if held:
        yield at, held


def coder(data: bytes) -> Coder:
    key = hash(data)
    if key not in _coders:
        _coders.clear()
        _coders[key] = Coder(data)
    return _coders[key]


def bpe_encode(df: DataFrame, ranks: bytes, pattern: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``df`` with ``ids array<int>``: the byte-level BPE tokens of each whole
    text, no special tokens; with ``decoded``, also the bytes that these ids
    decode to, made in the same task.

    NULL and empty texts have no tokens; repeated rows stay; input columns
    named like the outputs are replaced; an empty table gives an empty one."""
    shipped = df.sparkSession.sparkContext.broadcast(ranks)      # one vocabulary file, of fixed size

    def make():
        import regex

        c, find = coder(shipped.value), regex.compile(pattern)

        def f(batch):
            flat, counts = c.encode(find, column(batch, text).to_pylist())
            offs = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offs), pa.array(flat))
            return [lists, decode_lists(c, lists)] if decoded else [lists]

        return f

    fields = [T.StructField(ids, T.ArrayType(T.IntegerType(), False))]
    if decoded:
        fields.append(T.StructField(decoded, T.BinaryType()))
    return add_columns(df, fields, make, text, 4_000_000)


def decode_lists(c: Coder, lists: pa.ListArray, most: int = 1_000_000) -> pa.Array:
    """Bytes of each list of ids, a bounded number of ids at a time."""
    n = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if len(flat) and (flat.min() < 0 or flat.max() >= len(c.tokens)):
        raise ValueError("token id outside the vocabulary")
    ends = np.concatenate([[0], np.cumsum(n)])
    made, at = [], 0
    while at < len(n):
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + most, side="right")) - 1)
        part = flat[ends[at]:ends[stop]]
        data = ragged(c.blob, c.offs[part], c.lens[part]).tobytes()
        cuts = np.concatenate([[0], np.cumsum(c.lens[part])])[ends[at:stop + 1] - ends[at]]
        made += [data[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        at = stop
    return pa.array(made, type=pa.binary())


def bpe_decode(df: DataFrame, ranks: bytes, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out binary``: the bytes of its token ids (NULL ids: no
    bytes).  An id outside the vocabulary fails the job."""
    shipped = df.sparkSession.sparkContext.broadcast(ranks)
    base = df.drop(out)
    schema = T.StructType(base.schema.fields + [T.StructField(out, T.BinaryType())])

    def run(batches):
        c = coder(shipped.value)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            yield pa.RecordBatch.from_arrays([*batch.columns, decode_lists(c, lists)], names=[*batch.schema.names, out])

    return base.mapInArrow(run, schema)


def digests(encoded: DataFrame, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of an encoded and
    decoded table."""
    return encoded.select(
        "doc_id", F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col(ids).cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded), 256).alias("decoded_sha256"))
