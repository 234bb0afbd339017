"""MinHash near-dedup with BagMinHash signatures.

A text is the multiset of its word shingles.  Each shingle drives Poisson
processes over the axis of weights, cut into the intervals (0,1], (1,2],
(2,4], (4,8] ...; an interval of more than one unit is split in halves when
its process moves on, so points above the shingle's multiplicity are never
generated.  A point falls on one of the signature's components, which keeps
the least; two signatures agree in a component with probability equal to the
weighted Jaccard similarity of the multisets.  A process stops once it has
passed the signature's greatest component, so a text costs few points.

Bands of components bring texts together; candidates are verified on the
multisets themselves.  Copies are one text from the start, and a bucket of
many texts links them to one of its own first: further pairs are compared only
between classes that this has not joined already, and verified only where the
signatures say that the pair may be similar.  A task that compares two blocks
of a bucket verifies its pairs itself and lists the links that join classes,
never the pairs.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .text import GOLDEN, U64, Words, column, counted, give_back, hash_strings, keep, mix, ragged, sized, unit

SHINGLE = 5                      # words
SIMILAR = 0.8
BANDS, ROWS = 40, 5              # a pair at 0.8 shares no band with probability 1e-7
SIZE = BANDS * ROWS
DOUBT = 0.66                     # estimates of a pair at 0.8 lie below with probability 1e-6, at 0.82 with 2e-8
BYTES = 3_500_000                # text handled at a time
BLOCK = 512                      # texts of a bucket compared in one task, squared


def shingles(texts: pa.Array, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, 48-bit hash and multiplicity of each distinct word shingle, by
    text and hash.  A text of fewer than ``n`` words is one shingle."""
    w = Words(texts)
    if not len(w.codes):
        none = np.zeros(0, dtype=np.int64)
        return none, none.astype(U64), none
    h = mix(hash_strings(w.words))[w.codes]
    doc, sizes = w.doc_of(), w.sizes
    place = np.arange(len(h)) - w.starts[doc]
    used = np.minimum(sizes, n)[doc]                   # words of each shingle
    first = place + used <= sizes[doc]
    at = np.flatnonzero(first)
    s = np.zeros(len(at), dtype=U64)
    with np.errstate(over="ignore"):
        for k in range(n):
            more = k < used[at]
            s = np.where(more, mix(s * U64(0x100000001B3) + h[np.minimum(at + k, len(h) - 1)]), s)
    key, count = counted((doc[at].astype(U64) << U64(48)) | (s >> U64(16)))
    return (key >> U64(48)).astype(np.int64), key & U64((1 << 48) - 1), count


def bag_minhash(doc: np.ndarray, h: np.ndarray, weight: np.ndarray, docs: int, size: int = SIZE) -> np.ndarray:
    """Signatures (rows: texts) of multisets given as element hashes with
    integer weights; a text without elements has infinite components."""
    sig = np.full(docs * size, np.inf)
    limit = np.full(docs, np.inf)
    # streams: text, node of the weight axis, its seed, next point
    parts, low = [], 0
    while True:
        high = max(1, 2 * low)
        own = np.flatnonzero(weight > low)
        if not len(own):
            break
        parts.append((own, np.full(len(own), low), np.full(len(own), high)))
        low = high
    if not parts:
        return sig.reshape(docs, size)
    own, lo, hi = (np.concatenate(x) for x in zip(*parts))
    d, el, w = doc[own], h[own], weight[own]
    seed = _seed(el, lo, hi)
    x, spot, path, turn = *_draw(seed, np.zeros(len(own)), hi - lo, size, np.zeros(len(own), dtype=np.int64)), np.zeros(len(own), dtype=np.int64)
    while len(d):
        whole = hi <= w
        np.minimum.at(sig, d[whole] * size + spot[whole], x[whole])
        some = np.flatnonzero(np.bincount(d, minlength=docs))
        limit[some] = sig.reshape(docs, size)[some].max(1)
        live = np.flatnonzero(x <= limit[d])
        d, el, w, lo, hi, seed, x, spot, path, turn = (a[live] for a in (d, el, w, lo, hi, seed, x, spot, path, turn))
        one = hi - lo == 1
        # a unit goes on to its next point
        u = np.flatnonzero(one)
        t_u = turn[u] + 1
        x_u, spot_u, path_u = _draw(seed[u], x[u], np.ones(len(u)), size, t_u)
        # a longer interval splits: one half has the point, the other a later first point of its own
        s = np.flatnonzero(~one)
        mid, right = (lo[s] + hi[s]) // 2, (path[s] & U64(1)).astype(bool)
        lo_p, hi_p = np.where(right, mid, lo[s]), np.where(right, hi[s], mid)
        lo_q, hi_q = np.where(right, lo[s], mid), np.where(right, mid, hi[s])
        seed_p, seed_q, zero = _seed(el[s], lo_p, hi_p), _seed(el[s], lo_q, hi_q), np.zeros(len(s), dtype=np.int64)
        x_q, spot_q, path_q = _draw(seed_q, x[s], hi_q - lo_q, size, zero)
        d, el, w, lo, hi, seed, x, spot, path, turn = (np.concatenate(z) for z in (
            (d[u], d[s], d[s]), (el[u], el[s], el[s]), (w[u], w[s], w[s]), (lo[u], lo_p, lo_q), (hi[u], hi_p, hi_q),
            (seed[u], seed_p, seed_q), (x_u, x[s], x_q), (spot_u, spot[s], spot_q), (path_u, path[s] >> U64(1), path_q), (t_u, zero, zero)))
        live = np.flatnonzero((lo < w) & (x <= limit[d]))
        d, el, w, lo, hi, seed, x, spot, path, turn = (a[live] for a in (d, el, w, lo, hi, seed, x, spot, path, turn))
    return sig.reshape(docs, size)


def _seed(element: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return mix(element ^ mix((lo.astype(U64) << U64(32)) | hi.astype(U64)))


def _draw(seed, after, length, size, turn):
    """Next point of a process of rate ``length`` after a point, the component
    it falls on and the halves it lies in."""
    with np.errstate(over="ignore"):
        at = seed + turn.astype(U64) * U64(3) * GOLDEN
        return (after - np.log(unit(mix(at))) / length, (mix(at + GOLDEN) % U64(size)).astype(np.int64), mix(at + U64(2) * GOLDEN))


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    bits = np.ascontiguousarray(sig).view(U64).reshape(len(sig), bands, rows)
    key = np.broadcast_to(mix(np.arange(bands, dtype=U64) + U64(17)), (len(sig), bands))
    with np.errstate(over="ignore"):
        for r in range(rows):
            key = mix(key * U64(0x100000001B3) + bits[:, :, r])
    return key.astype(np.int64)


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two multisets given as sorted hashes, repeated by multiplicity."""
    x, n = counted(a)
    y, m = counted(b)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    both = int(np.minimum(n[i], m[j]).sum())
    return both / max(len(a) + len(b) - both, 1)


def signatures(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, id, t, bands, sketch`` of every row: a row number, the text's
    digest, its band keys (none for a text without words) and one byte of
    each component for estimates."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        row = TaskContext.get().partitionId() << 33
        for batch in sized(batches, text, BYTES):
            texts = column(batch, text)
            for at in range(0, batch.num_rows, 1 << 15):
                part = texts.slice(at, 1 << 15)
                part = part.take(pa.array(np.arange(len(part)))) if at else part
                m = len(part)
                doc, h, count = shingles(part)
                sig = bag_minhash(doc, h, count, m)
                some = np.bincount(doc, minlength=m) > 0
                keys = band_keys(sig)[some]
                offs = np.concatenate([[0], np.cumsum(some * BANDS)]).astype(np.int32)
                sketch = (mix(sig.view(U64)) >> U64(56)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(row, row + m)), batch.column(0).slice(at, m),
                    pa.array([hashlib.md5(x.encode()).digest() for x in part.to_pylist()], type=pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offs), pa.array(keys.ravel())),
                    pa.array([r.tobytes() for r in sketch], type=pa.binary())], names=["key", "id", "t", "bands", "sketch"])
                row += m
        give_back()                                   # the worker may wait for its next task for long

    return docs.select(F.col(id_col).alias("id"), text).mapInArrow(
        run, f"key bigint, id {kind}, t binary, bands array<bigint>, sketch binary")


def _bags(docs: DataFrame, text: str) -> DataFrame:
    """``v, bag``: sorted shingle hashes of each text, repeated by
    multiplicity (``docs`` has ``v`` and the text)."""

    def run(batches):
        for batch in sized(batches, text, BYTES):
            for at in range(0, batch.num_rows, 1 << 15):
                part = column(batch.slice(at, 1 << 15), text)
                doc, h, count = shingles(part)
                flat = np.repeat(h, count).astype(np.uint64)
                cuts = np.searchsorted(np.repeat(doc, count), np.arange(len(part) + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, 1 << 15), pa.array([flat[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], type=pa.binary())],
                    names=["v", "bag"])
        give_back()

    return docs.select("v", text).mapInArrow(run, "v bigint, bag binary")


def _verified(pairs: DataFrame, bags: DataFrame, similar: float) -> DataFrame:
    """The pairs ``(a, b)`` whose multisets are similar enough."""
    both = (pairs.join(bags.select(F.col("v").alias("a"), F.col("bag").alias("x")), "a")
            .join(bags.select(F.col("v").alias("b"), F.col("bag").alias("y")), "b"))

    def run(batches):
        for batch in batches:
            a, b, x, y = (batch.column(batch.schema.get_field_index(n)) for n in ("a", "b", "x", "y"))
            ok = [weighted_jaccard(np.frombuffer(p, dtype=U64), np.frombuffer(q, dtype=U64)) >= similar
                  for p, q in zip(x.to_pylist(), y.to_pylist())]
            mask = pa.array(ok, type=pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], names=["a", "b"])

    return both.select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def _likely_pairs(rows: DataFrame, bags: DataFrame | None = None, similar: float = SIMILAR) -> DataFrame:
    """Pairs ``(a, b)`` of texts of one bucket and different classes whose sketches
    agree in a share of ``DOUBT`` or more, each pair in the first bucket that
    it shares by the band keys themselves (bytes of a sketch also agree by
    chance).  A bucket is cut into blocks of texts; a task compares two
    blocks.

    With ``bags`` the task verifies its pairs on the multisets and lists only
    links that join classes it has not joined yet: fewer than its texts,
    however many of the pairs are similar."""
    size = rows.groupBy("bk").agg(F.count("*").alias("n"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    cut = rows.join(size, "bk").withColumn("p", F.pmod(F.xxhash64("v"), blocks).cast("int"))
    cut = cut.withColumn("q", F.explode(F.sequence(F.lit(0), blocks - 1)))
    cut = cut.select("bk", F.least("p", "q").alias("i"), F.greatest("p", "q").alias("j"), "p", "band", "v", "c", "sketch", "bands")
    verify = bags is not None

    def asked(batches):
        for piece, cuts in _groups(batches):
            some = np.zeros(piece.num_rows, dtype=bool)
            for _, _, near in _near(piece, cuts):
                for a, b in near:
                    some[a] = some[b] = True
            yield from piece.filter(pa.array(some)).to_batches()

    def listed(batches):
        for piece, cuts in _groups(batches):
            v, out = piece["v"].to_numpy(), [np.zeros((0, 2), dtype=np.int64)]
            for lo, hi, near in _near(piece, cuts):
                if verify:
                    near = _joining(piece.slice(lo, hi - lo), lo, near, similar)
                out += [np.stack([np.full(len(b), v[a]), v[b]], axis=1) for a, b in near]
            pairs = np.concatenate(out)
            yield pa.RecordBatch.from_arrays([pa.array(pairs.min(1)), pa.array(pairs.max(1))], names=["a", "b"])

    grouped = lambda x: x.repartition("bk", "i", "j").sortWithinPartitions("bk", "i", "j")
    if verify:
        # only texts of a likely pair meet again, with their multisets
        cut = grouped(cut).mapInArrow(asked, cut.schema).join(bags, "v")
    return grouped(cut).mapInArrow(listed, "a bigint, b bigint")


def _groups(batches):
    """Pieces that end between two groups, from rows in order of group, and
    where their groups begin and end."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = pa.concat_tables([held, table]) if held is not None else table
        of = np.stack([held[x].to_numpy() for x in ("bk", "i", "j")])
        new = np.flatnonzero((of[:, 1:] != of[:, :-1]).any(0)) + 1
        if len(new):
            yield held.slice(0, new[-1]).combine_chunks(), np.append(0, new)
            held = held.slice(new[-1])
    if held is not None and held.num_rows:
        yield held.combine_chunks(), np.array([0, held.num_rows])


def _near(piece: pa.Table, cuts: np.ndarray):
    """The likely pairs of each group of a piece that has any: where the
    group begins and ends, and rows each with its partners."""
    i, j, p, band, v, c = (piece[x].to_numpy() for x in ("i", "j", "p", "band", "v", "c"))
    s = np.frombuffer(b"".join(piece["sketch"].to_pylist()), dtype=np.uint8).reshape(len(v), -1)
    keys = piece["bands"].combine_chunks().flatten().to_numpy().reshape(len(v), -1)
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        left, right = lo + np.flatnonzero(p[lo:hi] == i[lo]), lo + np.flatnonzero(p[lo:hi] == j[lo])
        near = []
        for a in left:
            b = right[(c[right] != c[a]) & ((v[right] > v[a]) if i[lo] == j[lo] else True)]
            if len(b):
                b = b[(s[b] == s[a]).mean(1) >= DOUBT]
                b = b[(keys[b] == keys[a]).argmax(1) == band[lo]]
            if len(b):
                near.append((a, b))
        if near:
            yield lo, hi, near


def _joining(group: pa.Table, lo: int, near: list, similar: float) -> list:
    """Of a group's likely pairs (its rows count from ``lo``) verified links
    that join all classes that such links join."""
    bags = [np.frombuffer(x, dtype=U64) for x in group["bag"].to_pylist()]
    size = np.array([len(x) for x in bags])
    start = np.cumsum(size) - size
    # an element that occurs again is another element: sets, and their common part is the multisets'
    flat, spot = np.concatenate(bags), np.arange(size.sum())
    new = np.append(True, flat[1:] != flat[:-1])
    new[start] = True
    again = spot - np.maximum.accumulate(np.where(new, spot, 0))
    _, ids = np.unique(flat, return_inverse=True)
    if again.any():
        _, ids = np.unique(ids * (again.max() + 1) + again, return_inverse=True)
    mark = np.zeros(ids.max() + 1, dtype=bool)
    root, out = group["c"].to_numpy().copy(), []
    for a, b in near:
        a, b = a - lo, b - lo
        b = b[root[b] != root[a]]
        if not len(b):
            continue
        own = ids[start[a]:start[a] + size[a]]
        mark[own] = True
        both = np.add.reduceat(mark[ragged(ids, start[b], size[b])], np.cumsum(size[b]) - size[b], dtype=np.int64)
        mark[own] = False
        for x in b[both / (size[a] + size[b] - both) >= similar]:
            if root[x] != root[a]:
                root[root == root[x]] = root[a]
                out.append((a + lo, np.array([x + lo])))
    return out


def classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text", similar: float = SIMILAR, star_rounds: int = 5) -> DataFrame:
    """``id, class_id, class_size`` of every row: texts linked by a chain of
    pairs with weighted Jaccard similarity of at least ``similar`` share the
    least id among them as their class.

    NULL texts read as empty; texts without words are similar only to equal
    texts; a text of fewer words than a shingle is one shingle; repeated rows
    stay, in one class; a NULL id is the least only where a class has no
    other."""
    named = _classed(docs, id_col, text, similar, star_rounds)
    sizes = named.groupBy("c").agg(F.min("id").alias("class_id"), F.count("*").alias("class_size"))
    return named.join(sizes, "c").select(F.col("id").alias(id_col), "class_id", "class_size")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text", similar: float = SIMILAR) -> DataFrame:
    """``docs`` with one row of each class: that of the least id (of several,
    of the least text digest; of equal rows, one; NULL ids come last)."""
    named = _classed(docs, id_col, text, similar)
    first = named.groupBy("c").agg(F.min(F.struct(F.col("id").isNull().alias("z"), "id", "t")).alias("f")).select(
        F.col("f.id").alias("__id"), F.col("f.t").alias("__t"))
    d = docs.withColumn("__d", F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary"))))
    kept = d.join(first, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__d") == F.col("__t")), "left_semi")
    return kept.dropDuplicates([id_col, "__d"]).select(*docs.columns)


def _classed(docs: DataFrame, id_col: str, text: str, similar: float, star_rounds: int = 5) -> DataFrame:
    """``id, t, c`` of every row: its text's digest and its class."""
    docs = docs.select(id_col, F.coalesce(text, F.lit("")).alias(text))
    sigs = keep(signatures(docs, id_col, text))
    # copies: one vertex for each distinct text, its least row number
    texts = sigs.groupBy("t").agg(F.min("key").alias("v"))
    rows = sigs.join(texts.select(F.col("v").alias("key")), "key").select(F.col("key").alias("v"), F.posexplode("bands").alias("band", "bk"))
    shared = rows.groupBy("bk").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).filter("lo < hi").select("bk")
    hits = keep(rows.join(shared, "bk"))
    near = hits.select("v").distinct()
    t_of = keep(sigs.select(F.col("key").alias("v"), "t", "sketch", "bands").join(near, "v"))
    bags = keep(_bags(docs.withColumn("t", F.unhex(F.md5(F.col(text).cast("binary")))).join(t_of.select("t", "v"), "t")
                      .groupBy("v").agg(F.first(text).alias(text)), text))
    label = near.select("v", F.col("v").alias("c"))
    tested = None

    def add(pairs: DataFrame) -> bool:
        """Verify pairs not tested before; whether any is a link."""
        nonlocal tested
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = keep(pairs)
        tested = pairs.select("a", "b") if tested is None else tested.unionByName(pairs.select("a", "b"))
        return link(_verified(pairs, bags, similar))

    def link(new: DataFrame) -> bool:
        """Links become links of their classes, so that classes that are
        already one are not joined again; whether there are any."""
        nonlocal label
        new = keep(new)
        if not new.limit(1).count():
            return False
        of = lambda x: label.select(F.col("v").alias(x), F.col("c").alias(f"c{x}"))
        between = new.join(of("a"), "a").join(of("b"), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
        roots = components(between).select(F.col("v").alias("c"), "root")
        label = keep(label.join(roots, "c", "left").select("v", F.coalesce("root", "c").alias("c")))
        return True

    def split(turn: int) -> DataFrame:
        """Texts of the buckets that hold several classes, each with one text
        of its bucket, chosen by a hash."""
        now = hits.join(label, "v")
        heads = now.groupBy("bk").agg(F.min("c").alias("lo"), F.max("c").alias("hi"),
                                      F.min(F.struct(F.xxhash64("v", "bk", F.lit(turn)).alias("h"), "v", "c")).alias("head"))
        return now.join(heads.filter("lo < hi").select("bk", "head"), "bk")

    for turn in range(star_rounds):
        pairs = split(turn).filter(F.col("c") != F.col("head.c"))
        if not add(pairs.select(F.least("v", "head.v").alias("a"), F.greatest("v", "head.v").alias("b")).distinct()):
            break
    link(_likely_pairs(split(star_rounds).select("bk", "band", "v", "c").join(t_of.select("v", "sketch", "bands"), "v"), bags, similar))
    return keep(sigs.select("id", "t").join(texts, "t").join(label, "v", "left").select("id", "t", F.coalesce("c", "v").alias("c")))
