import random
from collections import Counter

import numpy as np
import pyarrow as pa

from sensorgrid.llm import minhash


def bag(text, n=5):
    w = text.lower().split()
    return Counter(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else Counter()


def jaccard(a, b):
    low, high = sum((a & b).values()), sum((a | b).values())
    return low / high if high else 0.0


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(5)
    h = minhash.mix(np.arange(40, dtype=np.uint64))
    for _ in range(4):
        a, b = rng.integers(0, 12, 40), rng.integers(0, 12, 40)
        b = np.where(rng.random(40) < 0.6, a, b)
        truth = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        doc = np.repeat([0, 1], 40)
        sig = minhash.bag_minhash(doc[np.r_[a, b] > 0], np.r_[h, h][np.r_[a, b] > 0], np.r_[a, b][np.r_[a, b] > 0], 2, size=6000)
        assert np.isfinite(sig).all()
        assert abs((sig[0] == sig[1]).mean() - truth) < 0.03, truth


def test_a_signature_does_not_depend_on_its_batch():
    texts = ["a b c d e f a b c d e f a b c d e f", "x y", "", "q " * 300]
    doc, h, n = minhash.shingles(pa.array(texts, type=pa.large_string()))
    together = minhash.bag_minhash(doc, h, n, 4)
    for i, t in enumerate(texts):
        d, g, m = minhash.shingles(pa.array([t], type=pa.large_string()))
        assert (minhash.bag_minhash(d, g, m, 1)[0] == together[i]).all()
    assert np.isinf(together[2]).all()


def brute(rows):
    """Least id of each row's class, by comparing all texts."""
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    bags = [bag(t or "") for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] or "") == (rows[j][1] or "") or jaccard(bags[i], bags[j]) >= 0.8:
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), k), k)
    return [least[find(i)] for i in range(len(rows))]


def corpus(seed):
    rnd = random.Random(seed)
    vocab = [f"v{i}" for i in range(500)]
    texts = []
    for _ in range(12):
        words = [rnd.choice(vocab) for _ in range(rnd.choice([3, 8, 40, 150, 400]))]
        texts.append(" ".join(words))
        for _ in range(rnd.randint(0, 8)):
            w = list(words)
            for _ in range(rnd.choice([0, 1, 2, 5, 12])):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            texts.append(" ".join(w))
            if rnd.random() < 0.5:
                words = w                                    # chains of copies of copies
    rnd.shuffle(texts)
    return list(enumerate(texts))


def test_classes_against_brute_force(spark):
    rows = corpus(11)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    want = brute(rows)
    got = {r["doc_id"]: (r["class_id"], r["class_size"]) for r in minhash.classes(df).collect()}
    assert {i: want[i] for i, _ in rows} == {i: c for i, (c, _) in got.items()}
    sizes = Counter(want)
    assert all(n == sizes[c] for c, n in got.values())


def test_the_last_round_finds_what_the_first_rounds_leave(spark):
    rows = corpus(12)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    got = {r["doc_id"]: r["class_id"] for r in minhash.classes(df, star_rounds=0).collect()}
    assert got == dict(zip([i for i, _ in rows], brute(rows)))


def test_edge_rows(spark):
    rows = [(5, None, "x"), (6, "", "x"), (7, " \n", "x"), (8, "one two", "x"), (9, "One two", "x"), (10, "z", "x"), (10, "z", "x"), (None, "z", "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, class_id string")
    got = sorted((r["doc_id"] if r["doc_id"] is not None else 99, r["class_id"], r["class_size"]) for r in minhash.classes(df).collect())
    assert got == [(5, 5, 2), (6, 5, 2), (7, 7, 1), (8, 8, 2), (9, 8, 2), (10, 10, 3), (10, 10, 3), (99, 10, 3)]
    assert minhash.classes(df.limit(0)).count() == 0


def test_one_of_each(spark):
    rows = [(5, None, "a"), (6, "", "b"), (8, "one two", "c"), (9, "One two", "d"), (10, "z", "e"), (10, "z", "f"), (None, "z", "g"),
            (7, "first text", "h"), (7, "other text", "i"), (None, "lost id", "j"), (None, "another lost id", "k")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = minhash.one_of_each(df)
    assert out.columns == df.columns
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in out.collect())
    assert got == [(False, 5, ""), (False, 7, "first text"), (False, 7, "other text"), (False, 8, "one two"), (False, 10, "z"),
                   (True, 0, "another lost id"), (True, 0, "lost id")]
    assert minhash.one_of_each(df.limit(0)).count() == 0


def likely(spark, sketches, keys, band):
    rows = [(5, band, v, v, bytearray(s.tobytes()), [int(k) for k in key]) for v, (s, key) in enumerate(zip(sketches, keys))]
    df = spark.createDataFrame(rows, "bk bigint, band int, v bigint, c bigint, sketch binary, bands array<bigint>")
    return [tuple(r) for r in minhash._likely_pairs(df).select("a", "b").collect()]


def test_a_chance_match_of_sketches_loses_no_pair(spark):
    """Bytes of band 3 agree though its keys differ: the pair is in the bucket of band 7."""
    a = np.zeros(minhash.SIZE, dtype=np.uint8)
    b = a.copy()
    b[:3 * minhash.ROWS:minhash.ROWS] = 1
    keys = np.stack([np.arange(minhash.BANDS), np.arange(minhash.BANDS) + 1000])
    keys[1, 7] = keys[0, 7]
    assert likely(spark, [a, b], keys, 7) == [(0, 1)]
    keys[1, 2] = keys[0, 2]                          # listed in the first bucket it shares, only
    assert likely(spark, [a, b], keys, 7) == [] and likely(spark, [a, b], keys, 2) == [(0, 1)]


def test_doubtful_pairs_are_listed(spark):
    """An estimate of 0.67 is verified: a pair at 0.8 can have it."""
    a = np.zeros(minhash.SIZE, dtype=np.uint8)
    b = a.copy()
    b[:int(0.33 * minhash.SIZE)] = 1
    keys = np.zeros((2, minhash.BANDS), dtype=np.int64)
    assert likely(spark, [a, b], keys, 0) == [(0, 1)]


def test_near_copies_are_not_listed_in_pairs(spark, monkeypatch):
    """Of a crowd of texts that are similar to many others no more links are
    listed than join them, and none of the classes is lost."""
    rnd = random.Random(4)
    base = [f"b{k}" for k in range(100)]
    rows = []
    for n in range(60):
        words = list(base)
        for k in range(rnd.choice([1, 1, 2])):
            words[rnd.randrange(100)] = f"n{n}x{k}"
        rows.append((n, " ".join(words)))
    made, write = [], minhash.keep

    def counting(df):
        out = write(df)
        if out.columns == ["a", "b"]:
            made.append(out.count())
        return out

    monkeypatch.setattr(minhash, "keep", counting)
    monkeypatch.setattr(minhash, "BLOCK", 25)
    got = {r["doc_id"]: r["class_id"] for r in minhash.classes(spark.createDataFrame(rows, "doc_id bigint, text string"), star_rounds=0).collect()}
    want = brute(rows)
    assert got == dict(enumerate(want)) and len(set(want)) < 40
    # forests of many small tasks: fewer links than pairs by far, whatever the pairs
    bags = [bag(t) for _, t in rows]
    pairs = sum(jaccard(bags[i], bags[j]) >= 0.8 for i in range(60) for j in range(i))
    assert sum(made) < pairs / 2, (made, pairs)


def test_multisets_are_verified_with_their_multiplicities():
    rng = np.random.default_rng(8)
    for _ in range(30):
        bags = [np.sort(rng.integers(0, 12, rng.integers(1, 40))).astype(np.uint64) for _ in range(9)]
        group = pa.table({"c": np.arange(9), "bag": pa.array([x.tobytes() for x in bags], type=pa.binary())})
        near = [(a + 5, np.arange(a + 1, 9) + 5) for a in range(8)]
        got = minhash._joining(group, 5, near, 0.5)
        root = {k: k for k in range(5, 14)}
        for a, b in got:
            assert minhash.weighted_jaccard(bags[a - 5], bags[b[0] - 5]) >= 0.5 and root[a] != root[b[0]]
            root = {k: root[a] if r == root[b[0]] else r for k, r in root.items()}
        for a, b in near:
            assert all(root[a] == root[x] for x in b if minhash.weighted_jaccard(bags[a - 5], bags[x - 5]) >= 0.5)
