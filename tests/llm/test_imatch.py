import hashlib
import random

import numpy as np
import pyarrow as pa

from sensorgrid.llm import imatch


def corpus(n=200, seed=3):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(600)]
    weights = [1 / (i + 3) for i in range(600)]
    return [(i * 3, " ".join(rnd.choices(vocab, weights, k=rnd.randint(1, 200)))) for i in range(n)]


def brute(rows, low, high):
    """Fingerprints and likenesses by plain Python over whole texts."""
    docs = [(t or "") for _, t in rows]
    terms = lambda t: {"".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in t.split()}
    df = {}
    for t in docs:
        for w in terms(t):
            df[w] = df.get(w, 0) + 1
    n = len(docs)
    lex = {w for w, c in df.items() if max(2.0, low * n) <= c <= high * n}
    order = sorted(range(n), key=lambda i: (rows[i][0] is None, -(rows[i][0] or 0), docs[i]))
    out = {}
    for k, i in enumerate(order):
        nxt = docs[order[(k + 1) % n]]
        cut = len(docs[i]) // 3
        new = docs[i][:len(docs[i]) - cut] + nxt[:cut]
        sets = {}
        out[(rows[i][0], docs[i])] = (len(docs[i]), hashlib.sha256(new.encode()).hexdigest(), terms(docs[i]) & lex, terms(new) & lex, terms(nxt) & lex, sets)
    return out, lex


def test_against_brute_force(spark):
    rows = corpus() + [(1000, None), (1001, ""), (None, "w1 w2 w3"), (1002, "w4 W5 zzz"), (1003, "w4  w5 ZZZ"), (9, "w1 w2 w3")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    want, lex = brute(rows, imatch.LOW, imatch.HIGH)
    hashes = imatch.lexicon(df)
    assert len(hashes) == len(lex)
    got = imatch.compare_with_next(df, hashes).collect()
    assert len(got) == len(rows)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append(t or "")
    prints = {}
    for r in got:
        t = next(t for t in texts[r.doc_id] if want[(r.doc_id, t)][1] == r.edited_sha256)
        n, _, own, new, nxt, _ = want[(r.doc_id, t)]
        assert r.n_chars == n
        prints.setdefault((t if not own else frozenset(own)), set()).add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if own == new and own:
            assert r.near_edited == 1.0 and r.fingerprint == r.edited_fingerprint
        if own and nxt and not own & nxt:
            assert r.near_next == 0.0
    assert all(len(p) == 1 for p in prints.values())                  # same terms, same fingerprint
    assert len({min(p) for p in prints.values()}) == len(prints)      # and others differ
    assert np.mean([r.near_edited for r in got]) > 0.1 > 0.05 > np.mean([r.near_next for r in got])


def test_ranges_of_one_row(spark):
    """Every range's last row is completed with the range after it."""
    rows = corpus(9)
    one = imatch.lexicon(df := spark.createDataFrame(rows, "doc_id bigint, text string"))
    want = {(i, w[1]) for (i, _), w in brute(rows, imatch.LOW, imatch.HIGH)[0].items()}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 3, 40):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            assert {(r.doc_id, r.edited_sha256) for r in imatch.compare_with_next(df, one).collect()} == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_small_tables(spark):
    df = spark.createDataFrame([(5, "alone here")], "doc_id bigint, text string")
    r = imatch.compare_with_next(df, imatch.lexicon(df)).collect()
    assert len(r) == 1 and r[0].near_next == 1.0                      # the last is followed by the first: itself
    assert imatch.compare_with_next(df.limit(0), imatch.lexicon(df.limit(0))).count() == 0
    long = spark.createDataFrame([(1, "w " * 50_000), (2, None)], "doc_id bigint, text string")
    assert imatch.compare_with_next(long, imatch.lexicon(long)).count() == 2
    kept = imatch.fingerprint(spark.createDataFrame([(1, "a b", "x")], "doc_id bigint, text string, fingerprint string"), np.zeros(0, np.uint64))
    assert kept.columns == ["doc_id", "text", "fingerprint"] and kept.first().fingerprint.startswith("#")


def test_order_and_case_do_not_count():
    lex = np.sort(imatch.hash_strings(pa.array(["a", "b", "c"], type=pa.large_string())))
    p = imatch.fingerprints(pa.array(["a b c", "C  b\nA a", "a b", "zz"], type=pa.large_string()), lex)
    assert p[0] == p[1] != p[2] and imatch.likeness(p[0], p[1]) == 1.0 and 0 < imatch.likeness(p[0], p[2]) < 1
    assert imatch.likeness(p[0], p[3]) == 0.0
