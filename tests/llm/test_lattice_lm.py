import collections
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest

from sensorgrid.llm import lattice_lm as lm

PIECES, RANKS = lm.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))


def segmentations(word, lp):
    """Probability of a word, by listing every way to cut it into pieces."""
    if not word:
        return 1.0
    return sum(math.exp(lp[word[:k]]) * segmentations(word[k:], lp) for k in range(1, len(word) + 1) if word[:k] in lp)


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(2)
    logp = np.log(rng.dirichlet(np.ones(len(PIECES)) * 0.3) + 1e-9)
    lat, table = lm.Lattice(PIECES), dict(zip(PIECES, logp))
    words = [b" the", b" tion", b" \xc3\xa9t\xc3\xa9", b" a", b" \xff\x00", b" interna", b" 12345"]
    got = lat.log_prob(words, lm._lp(logp))
    for w, x in zip(words, got):
        assert x == pytest.approx(math.log(segmentations(w, table)), rel=1e-9)


def test_expectations_count_every_byte():
    logp = lm._with_end(RANKS)
    lat, total = lm.Lattice(PIECES), np.zeros(len(PIECES) + 1)
    words, counts = [b" the", b" there", b" xyzzy"], np.array([3.0, 1.0, 2.0])
    for some, w in lat.groups(words):
        lat.expected(lat.edges(w), lm._lp(logp), w.shape[1], counts[some], total)
    size = np.array([len(p) for p in PIECES])
    assert (total[:-1] * size).sum() == pytest.approx(sum(len(w) * c for w, c in zip(words, counts)))


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


def corpus(n=120, seed=5):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        lang = rnd.choice(["aa", "bb"])
        syl = ["the", "tion", "re", "on"] if lang == "aa" else ["ung", "sch", "der", "ein"]
        words = ["".join(rnd.choice(syl) for _ in range(rnd.randint(1, 4))).capitalize() for _ in range(rnd.randint(1, 60))]
        out.append((i, " ".join(words) + rnd.choice(["", "\n", "  \t x"]), lang))
    return out


def test_base_score_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lm, "HEAVY", 40)                 # some words are broadcast, others meet their counts in a join
    rows = corpus() + [(500, None, "aa"), (501, "", None), (502, "unseen Ünseen", "cc"), (7, "twice the id", "aa"), (None, "no id the", "aa")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    got = lm.score(df, PIECES, RANKS).collect()
    assert len(got) == len(rows)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    c = collections.Counter()
    for i, t, _ in rows:
        if i is not None and not held(i):
            c.update(tokens(t))
    n, v = sum(c.values()), len(c)
    want = collections.Counter()
    for i, t, _ in rows:
        k = tokens(t)
        want[(i, held(i), len(k), sum(c[x] > 0 for x in k), round(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in k), 6))] += 1
    assert want == collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got)
    assert all(r.train_tokens == n and math.isfinite(r.score) and r.score < 0 for r in got)
    # equal texts have equal scores, and one more word costs probability
    model = {r.doc_id: r.score for r in got}
    assert model[500] == pytest.approx(model[501])


def test_the_model_is_a_distribution_and_beats_the_base(spark):
    rows = corpus(400, 9)
    got = lm.score(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), PIECES, RANKS).filter("held_out").collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got)
    rng = np.random.default_rng(1)
    pieces = [bytes([b]) for b in range(256)]
    pieces[32] = b" "
    lat = lm.Lattice(pieces)
    p = np.zeros(256)
    p[[32, 97, 98]] = [0.5, 0.3, 0.2]
    m = lm.Model([np.log(np.maximum(p, 1e-300))], [10], [2], [4])
    words = [b" " + bytes(w) for k in range(1, 10) for w in np.array(np.meshgrid(*[[97, 98]] * k)).reshape(k, -1).T.astype(np.uint8).tolist()]
    c = np.zeros((len(words), 1))
    c[words.index(b" a")] = 7
    c[words.index(b" ab")] = 3
    total = (10 ** m.word_logs(lat, words, c)).sum() + 10 ** m.end_logs()[0]
    assert 0.9 < total <= 1 + 1e-9
    del rng


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b", "aa")], "doc_id bigint, text string, lang string")
    assert lm.score(df.limit(0), PIECES, RANKS).count() == 0
    only_held = spark.createDataFrame([(i, "a b", "aa") for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 1], df.schema)
    got = lm.score(only_held, PIECES, RANKS).collect()
    assert got and all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in got)
