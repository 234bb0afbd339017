"""Alignment of two tokenizers' tokens over the same texts.

Byte offsets where tokens of both end cut a text into groups.  They are
found by skipping along diagonals: at the current index shift the two end
arrays are compared over one, two, four ... tokens; a stretch of one-to-one
groups is jumped as long as they agree.  At the first difference the
irregular group is resolved locally (the cursor whose token ends earlier
advances until both end alike), the shift is updated and probing starts
anew.  A batch of texts is one pair of end arrays, cut into lanes whose
cursors run in lockstep (numpy).

Links are the token pairs whose byte ranges overlap.  Their counts over the
corpus are found in Spark: each piece of texts (a task's batch) sends its
distinct pairs with their numbers, the sums are joined back to the pieces
that asked for them, and each piece adds them up for its documents.
"""

from __future__ import annotations

import hashlib
import json
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .text import add_columns, column, give_back, keep, ragged, sized, slices

LANE = 256                     # tokens of the first side
FEW = 8                        # lanes that are left are finished one by one
PIECE_BYTES = 1_000_000        # of text

_sides: dict[int, "Side"] = {}


class Side:
    """A tokenizer: ids of texts, and the bytes of each id."""

    def __init__(self, tokens: list[bytes], encode):
        self.encode = encode                                  # list of texts -> lists of ids
        self.size = len(tokens)
        self.blob = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.lens = np.array([len(t) for t in tokens], dtype=np.int64)
        self.offs = np.cumsum(self.lens) - self.lens

    def bytes_of(self, ids: np.ndarray) -> bytes:
        return ragged(self.blob, self.offs[ids], self.lens[ids]).tobytes()


def byte_characters() -> dict[str, int]:
    """Byte-level vocabularies write a byte as the character of its code if
    that one is visible, and the others, in order, as those from 256 on."""
    seen = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(hidden)}


def _in_rank_order(spec: dict) -> bool:
    """Whether merging by least id is merging by first rule, over the usual
    splitting pattern and without further steps."""
    model, vocab = spec["model"], spec["model"]["vocab"]
    made = [vocab.get("".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
    return (model["type"] == "BPE" and spec.get("normalizer") is None and not model.get("dropout") and None not in made
            and made == sorted(set(made)) and (not made or made[0] >= 256)
            and spec["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True})


def byte_side(data: bytes) -> Side:
    """From a ``tokenizers`` JSON file of a byte-level BPE.  Where its rules
    are in order of their ids, the rank encoder reads the same file four
    times faster than the general one."""
    spec = json.loads(data)
    vocab, of = spec["model"]["vocab"], byte_characters()
    tokens = [b""] * (max(vocab.values()) + 1)
    special = {t["id"] for t in spec.get("added_tokens", [])}
    for t, i in vocab.items():
        tokens[i] = t.encode() if i in special else bytes(of[c] for c in t)
    if _in_rank_order(spec):
        import tiktoken

        ranks = {t: i for i, t in enumerate(tokens) if t and i not in special}
        ranked = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        return Side(tokens, lambda texts: [ranked.encode_ordinary(" " + t) for t in texts])
    return Side(tokens, general_encoder(data))


def general_encoder(data: bytes):
    """The ``tokenizers`` library's own encoder of a JSON file."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(data.decode())
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch([" " + x for x in texts], add_special_tokens=False)]


def piece_side(data: bytes) -> Side:
    """From a ``sentencepiece`` model file that adds the leading space."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=data)
    tokens = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()
              for i, p in enumerate(sp.id_to_piece(list(range(sp.get_piece_size()))))]
    return Side(tokens, lambda texts: sp.encode(texts, num_threads=1) if texts else [])


def side(data: bytes, make) -> Side:
    """The side of a file's bytes, made once in a worker."""
    key = hash(data)
    if key not in _sides:
        _sides[key] = make(data)
    return _sides[key]


# ---- the alignment itself

def _resolve(ea: np.ndarray, eb: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Move the cursors (in place) to the first tokens that end alike."""
    left = np.flatnonzero(ea[i] != eb[j])
    while len(left) >= FEW:
        x, y = ea[i[left]], eb[j[left]]
        i[left] += x < y
        j[left] += x > y
        left = left[x != y]
    for k in left:
        a, b = int(i[k]), int(j[k])
        while ea[a] != eb[b]:
            if ea[a] < eb[b]:
                a += int(np.searchsorted(ea[a:], eb[b]))
            else:
                b += int(np.searchsorted(eb[b:], ea[a]))
        i[k], j[k] = a, b


def groups(ea: np.ndarray, eb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of tokens of either side up to the end of each group, from the
    tokens' strictly rising ends (the last ends are equal)."""
    if not len(ea):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    i = np.arange(0, len(ea), LANE)
    j = np.searchsorted(eb, ea[i])
    _resolve(ea, eb, i, j)
    i, j = i + 1, j + 1
    i[0] = j[0] = 0                                   # the first lane starts at the first tokens
    stop = np.append(i[1:], len(ea))
    width, found_a, found_b = np.ones(len(i), dtype=np.int64), [], []
    live = np.flatnonzero(i < stop)
    while len(live):
        a, b = i[live], j[live]
        n = np.minimum(np.minimum(width[live], stop[live] - a), len(eb) - b)
        at = slices(a, n)
        same = ea[at] == eb[at + np.repeat(b - a, n)]
        begin = np.cumsum(n) - n
        first = np.minimum.reduceat(np.where(same, len(at), np.arange(len(at))), begin)
        k = np.minimum(first - begin, n)
        found_a.append(slices(a + 1, k))
        found_b.append(slices(b + 1, k))
        i[live], j[live] = a + k, b + k
        whole = k == n
        width[live] = np.where(whole, 2 * width[live], 1)
        odd = live[~whole]
        if len(odd):
            a, b = i[odd], j[odd]
            _resolve(ea, eb, a, b)
            i[odd], j[odd] = a + 1, b + 1
            found_a.append(a + 1)
            found_b.append(b + 1)
        live = live[i[live] < stop[live]]
    return np.sort(np.concatenate(found_a)), np.sort(np.concatenate(found_b))


class Aligned:
    """Tokens, groups and links of a batch of texts, one text after the
    other; ``of_*`` are bounds of the texts in the arrays."""

    def __init__(self, texts: list[str], a: Side, b: Side):
        used = [k for k, t in enumerate(texts) if t]
        ids_b = b.encode([texts[k] for k in used])
        raw = [b" " + texts[k].encode() for k in used]
        n_b = np.fromiter(map(len, ids_b), dtype=np.int64, count=len(used))
        flat = np.fromiter(chain.from_iterable(ids_b), dtype=np.int64, count=int(n_b.sum()))
        del ids_b
        size = np.fromiter(map(len, raw), dtype=np.int64, count=len(used))
        cut = np.concatenate([[0], np.cumsum(b.lens[flat])])[np.concatenate([[0], np.cumsum(n_b)])]
        joined = b.bytes_of(flat)
        ids_a = a.encode([texts[k] for k in used])
        n_a = np.fromiter(map(len, ids_a), dtype=np.int64, count=len(used))
        flat_a = np.fromiter(chain.from_iterable(ids_a), dtype=np.int64, count=int(n_a.sum()))
        del ids_a
        cut_a = np.concatenate([[0], np.cumsum(a.lens[flat_a])])[np.concatenate([[0], np.cumsum(n_a)])]
        joined_a = a.bytes_of(flat_a)
        kept = np.array([joined[cut[k]:cut[k + 1]] == r == joined_a[cut_a[k]:cut_a[k + 1]] for k, r in enumerate(raw)], dtype=bool)
        self.a, self.b = flat_a[np.repeat(kept, n_a)], flat[np.repeat(kept, n_b)]
        n = len(texts)
        bounds = lambda x: np.concatenate([[0], np.cumsum(np.bincount(np.array(used, np.int64)[kept], weights=x[kept], minlength=n).astype(np.int64))])
        self.of_a, self.of_b, self.of_bytes = bounds(n_a), bounds(n_b), bounds(size)
        self.end_a, self.end_b = np.cumsum(a.lens[self.a]), np.cumsum(b.lens[self.b])
        self.group_a, self.group_b = groups(self.end_a, self.end_b)
        self.of_groups = np.searchsorted(self.group_a, self.of_a, side="right")

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Token indices of either side of each overlapping pair, text by
        text, and the bounds of the texts.  Each byte where a token ends
        closes one pair: one for a one-to-one group, as many as different
        ends in an irregular one."""
        n_a, n_b = np.diff(self.group_a, prepend=0), np.diff(self.group_b, prepend=0)
        odd = (n_a != 1) | (n_b != 1)
        ends = [self.end_a[np.repeat(odd, n_a)], self.end_b[np.repeat(odd, n_b)]]
        ends = np.concatenate([self.end_a[self.group_a[~odd] - 1], np.unique(np.concatenate(ends))])
        ends.sort()
        return (np.searchsorted(self.end_a, ends), np.searchsorted(self.end_b, ends),
                np.searchsorted(ends, self.of_bytes, side="right"))

    def written(self, names: list[bytes], b_from: int) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each text, from the written forms of
        ``2 * id + last`` (first side) and, from ``b_from`` on, ``3 * id +
        kind`` (second side; kinds: more, last, last of the text)."""
        n_a, n_b = np.diff(self.group_a, prepend=0), np.diff(self.group_b, prepend=0)
        out = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        last = np.zeros(len(self.a), dtype=np.int64)
        last[self.group_a - 1] = 1
        out[np.arange(len(self.a)) + np.repeat(self.group_b - n_b, n_a)] = 2 * self.a + last
        kind = np.zeros(len(self.b), dtype=np.int64)
        kind[self.group_b - 1] = 1
        kind[self.of_b[1:][np.diff(self.of_b) > 0] - 1] = 2
        out[np.arange(len(self.b)) + np.repeat(self.group_a, n_b)] = b_from + 3 * self.b + kind
        cut = self.of_a + self.of_b
        return [b"".join(map(names.__getitem__, out[s:e].tolist())) for s, e in zip(cut[:-1], cut[1:])]


def _names(a: Side, b: Side) -> tuple[list[bytes], int]:
    first = [b"%d%s" % (i, s) for i in range(a.size) for s in (b",", b"|")]
    return first + [b"%d%s" % (i, s) for i in range(b.size) for s in (b",", b";", b"")], len(first)


# ---- Spark

def align(df: DataFrame, byte_file: bytes, piece_file: bytes, text: str = "text",
          outs: tuple[str, str, str, str] = ("a_ids", "b_ids", "a_ends", "b_ends")) -> DataFrame:
    """``df`` with the token ids of either side and, for each group, how many
    tokens of either side end with it (four ``array<int>`` columns).

    NULL and empty texts, and those whose tokens do not spell space + text,
    have empty arrays; repeated rows stay; a text of any length is one whole;
    input columns named like the outputs are replaced; an empty table gives
    an empty one."""
    shipped = df.sparkSession.sparkContext.broadcast((byte_file, piece_file))     # two vocabulary files

    def make():
        a, b = side(shipped.value[0], byte_side), side(shipped.value[1], piece_side)

        def f(batch):
            x = Aligned(column(batch, text).to_pylist(), a, b)
            base_a, base_b = (np.repeat(of[:-1], np.diff(x.of_groups)) for of in (x.of_a, x.of_b))
            made = [(x.of_a, x.a), (x.of_b, x.b), (x.of_groups, x.group_a - base_a), (x.of_groups, x.group_b - base_b)]
            return [pa.ListArray.from_arrays(pa.array(of.astype(np.int32)), pa.array(flat.astype(np.int32))) for of, flat in made]

        return f

    return add_columns(df, [T.StructField(n, T.ArrayType(T.IntegerType(), False)) for n in outs], make, text, PIECE_BYTES)


def _pieces(docs: DataFrame, byte_file: bytes, piece_file: bytes, doc_id: str, text: str) -> DataFrame:
    """One row for each document with its numbers, digest and links (indices
    into the piece's distinct pairs); a piece's first row also bears these
    pairs and their numbers."""
    shipped = docs.sparkSession.sparkContext.broadcast((byte_file, piece_file))
    long, ints = T.LongType(), T.ArrayType(T.LongType(), False)
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), *(T.StructField(n, long) for n in ("n_a", "n_b", "n_groups", "n_links")),
                           T.StructField("groups_sha256", T.StringType()), T.StructField("piece", long), T.StructField("links", T.BinaryType()),
                           T.StructField("pairs", ints), T.StructField("numbers", ints)])
    arrow = to_arrow_schema(schema)

    def run(batches):
        a, b = side(shipped.value[0], byte_side), side(shipped.value[1], piece_side)
        names, b_from = _names(a, b)
        part = TaskContext.get().partitionId()
        for k, batch in enumerate(sized(batches, text, PIECE_BYTES)):
            x = Aligned(column(batch, text).to_pylist(), a, b)
            at_a, at_b, of = x.links()
            pairs, index, numbers = np.unique(x.a[at_a] * b.size + x.b[at_b], return_inverse=True, return_counts=True)
            del at_a, at_b
            shas = [hashlib.sha256(w).hexdigest() if w else "" for w in x.written(names, b_from)]
            none = [None] * (batch.num_rows - 1)
            cols = [batch.column(batch.schema.get_field_index(doc_id)), *(np.diff(o) for o in (x.of_a, x.of_b, x.of_groups, of)), shas,
                    np.full(batch.num_rows, (part << 33) + k), _packed(index, of), [pairs, *none], [numbers, *none]]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t.type) for c, t in zip(cols, arrow)], schema=arrow)
        give_back()

    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(run, schema)


def _packed(index: np.ndarray, of: np.ndarray) -> list[bytes]:
    """Sorted links of each text as differences, compressed."""
    doc = np.repeat(np.arange(len(of) - 1), np.diff(of))
    top = int(index.max()) + 1 if len(index) else 1
    index = np.sort(doc * top + index) - doc * top
    pack = zstandard.ZstdCompressor(level=1).compress
    return [pack(np.diff(index[s:e], prepend=0).astype("<u4").tobytes()) if e > s else b"" for s, e in zip(of[:-1], of[1:])]


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype="<u4").astype(np.int64)) if data else np.zeros(0, np.int64)


def pair_counts(pieces: DataFrame, b_size: int) -> DataFrame:
    """``pair, n, best``: links of each id pair (``a * b_size + b``) over the
    corpus, and whether no other pair of its B id has more."""
    each = pieces.filter("pairs is not null").select(F.explode(F.arrays_zip("pairs", "numbers")).alias("p"))
    counts = keep(each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.numbers").alias("n")))
    most = counts.groupBy((F.col("pair") % b_size).alias("b")).agg(F.max("n").alias("most"))       # one row for a B id
    return (counts.join(F.broadcast(most), F.col("pair") % b_size == F.col("b"))
            .select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


def link_report(docs: DataFrame, byte_file: bytes, piece_file: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256`` of each row.

    Texts without tokens (see ``align``) have zeros and an empty digest;
    repeated rows stay and their links count each time; the corpus counts go
    over all rows; an empty table gives an empty one."""
    pieces = keep(_pieces(docs, byte_file, piece_file, doc_id, text))
    counts = pair_counts(pieces, piece_side(piece_file).size)
    asked = pieces.filter("pairs is not null").select(F.col("piece").alias("asker"), F.posexplode("pairs").alias("at", "pair"))
    told = asked.join(counts, "pair").select("asker", "at", "n", "best")
    own = pieces.select("piece", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links")
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    schema = T.StructType([own.schema["doc_id"], *(T.StructField(n, T.LongType()) for n in names), own.schema["groups_sha256"]])
    arrow = to_arrow_schema(schema)

    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        at = right["at"].to_numpy()
        n, best = np.zeros(len(at), dtype=np.int64), np.zeros(len(at), dtype=np.int64)
        n[at], best[at] = right["n"].to_numpy(), right["best"].to_numpy()
        links = [_unpacked(x) for x in left["links"].to_pylist()]
        made = {"n_best": [int(best[x].sum()) for x in links], "count_sum": [int(n[x].sum()) for x in links]}
        cols = [pa.array(made[f.name], f.type) if f.name in made else left[f.name].cast(f.type) for f in arrow]
        return pa.Table.from_arrays(cols, schema=arrow)

    return own.groupBy("piece").cogroup(told.groupBy("asker")).applyInArrow(add, schema)
