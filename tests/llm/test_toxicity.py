import random
import zlib

import numpy as np
import pyarrow as pa

from sensorgrid.llm import toxicity as tox

BAD = ["vilify", "scorn", "hateful"]


def corpus(n=500, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(rnd.choice(["ka", "to", "mi", "re", "su"]) for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(1, 120))]
        y = int(rnd.random() < 0.25)
        if y:
            for _ in range(rnd.randint(1, 3)):
                words[rnd.randrange(len(words))] = rnd.choice(BAD)
        rows.append((i, " ".join(words), y))
    return rows


def test_held_out_accuracy_and_edge_rows(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(900, None, "x"), (901, "", "x"), (None, "scorn", "x"), (902, "ka " * 20_000 + "scorn", "x"),
                                                                      (903, "same", "x"), (903, "same", "x")], "doc_id bigint, text string, score string").repartition(3)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(0, None), (None, 1)], "doc_id bigint, toxic int")
    got = {}
    out = tox.toxicity(docs, labels).collect()
    assert len(out) == len(rows) + 6
    for r in out:
        assert 0 <= r.score <= 1
        got[r.doc_id] = r.score
    held = [(got[i], y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(s >= 0.5) == y for s, y in held]) > 0.97
    assert got[None] > 0.5 and got[902] > 0.5 and got[900] == got[901] < 0.5
    assert tox.toxicity(docs.limit(0), labels).count() == 0
    assert {r.score for r in tox.toxicity(docs, labels.limit(0)).collect()} == {0.5}


def test_windows_cover_every_word():
    for size in (0, 1, 31, 32, 33, 47, 48, 49, 100, 1000):
        first, count, of = tox.windows(np.array([5]), np.array([size]))
        seen = np.zeros(size, dtype=int)
        for a, n in zip(first - 5, count):
            seen[a:a + n] += 1
        assert (seen > 0).all() and (of == 0).all()
        if size > 2 * tox.WINDOW:
            assert (seen[tox.STRIDE:-tox.STRIDE] >= 2).all()                  # overlapping


def test_gradients():
    """The analytic step moves the loss as finite differences say."""
    rng = np.random.default_rng(0)
    words = pa.array(["alpha", "beta", "gamma", "delta", "é"], type=pa.large_string())
    vocab = tox.word_inputs(words)
    codes = rng.integers(0, 5, (6, tox.WINDOW))
    mask = (np.arange(tox.WINDOW) < rng.integers(1, tox.WINDOW, 6)[:, None]).astype(np.float32)
    y = np.array([1, 0, 1, 0, 1, 0], dtype=np.float32)

    class Record:
        def __init__(self):
            self.g, self.r = {}, {}

        def dense(self, p, g):
            self.g = {k: v.copy() for k, v in g.items()}

        def rows(self, name, table, rows, grad):
            self.r[name] = (rows, grad)

    def loss(net):
        own, flat, starts = vocab
        out = net.logits(net.project(net.inputs(own, flat, starts)), codes, mask).astype(float)
        p = 1 / (1 + np.exp(-out))
        return -np.mean(np.where(y > 0, np.log(p), np.log(1 - p)))

    net, rec = tox.Net(), Record()
    net.words *= 8
    net.grams *= 8
    net.step(vocab, codes, mask, y, rec)
    for name in ("Wf", "Ub", "A", "v", "o", "bf"):
        p, g = net.p[name], rec.g[name]
        i = tuple(rng.integers(0, s) for s in p.shape)
        old = p[i]
        p[i] = old + 1e-2
        up = loss(net)
        p[i] = old - 1e-2
        down = loss(net)
        p[i] = old
        assert abs((up - down) / 2e-2 - g[i]) < 2e-3 + 0.05 * abs(g[i]), name
    row, grad = rec.r["words"]
    b, k = row[0], 2
    old = net.words[b, k]
    net.words[b, k] = old + 1e-2
    up = loss(net)
    net.words[b, k] = old - 1e-2
    down = loss(net)
    assert abs((up - down) / 2e-2 - grad[row == b][:, k].sum()) < 2e-3


def test_inputs_of_a_word_do_not_depend_on_its_batch():
    net = tox.Net()
    a = tox.word_inputs(pa.array(["one", "two", "x"], type=pa.large_string()))
    b = tox.word_inputs(pa.array(["x"], type=pa.large_string()))
    assert np.allclose(net.inputs(*a)[2], net.inputs(*b)[0])


def by_hand(net, words):
    """Logit of one window of words, step by step."""
    x = [net.inputs(*tox.word_inputs(pa.array([w], type=pa.large_string())))[0] for w in words]
    sig = lambda v: 1 / (1 + np.exp(-v))
    n = tox.HIDDEN
    states = {}
    for d, order in (("f", range(len(x))), ("b", range(len(x) - 1, -1, -1))):
        h = np.zeros(n)
        for t in order:
            i, g = x[t] @ net.p["W" + d] + net.p["b" + d], h @ net.p["U" + d]
            r, z = sig(i[:n] + g[:n]), sig(i[n:2 * n] + g[n:2 * n])
            c = np.tanh(i[2 * n:] + r * g[2 * n:])
            h = z * h + (1 - z) * c
            states[d, t] = h
    s = np.array([np.concatenate([states["f", t], states["b", t]]) for t in range(len(x))])
    e = np.tanh(s @ net.p["A"] + net.p["ab"]) @ net.p["v"]
    a = np.exp(e - e.max())
    return (a / a.sum()) @ s @ net.p["o"] + net.p["ob"][0]


def random_net(seed=3):
    net, g = tox.Net(seed), np.random.default_rng(seed)
    net.words[:] = g.normal(0, 1, net.words.shape)
    net.grams[:] = g.normal(0, 1, net.grams.shape)
    net.p["ab"][:] = g.normal(0, 1, tox.ATT)
    return net


def test_scores_are_the_strongest_window_by_hand():
    import random
    rnd, net = random.Random(3), random_net()
    make = lambda n: [rnd.choice(["alpha", "be", "gamma", "d", "éps", "zeta42"]) for _ in range(n)]
    texts = [make(n) for n in (1, 5, tox.WINDOW - 1, tox.WINDOW, tox.WINDOW + 1, 75, 200)]
    got = tox.score_texts(net, pa.array([" ".join(t) for t in texts], type=pa.large_string()))
    for t, value in zip(texts, got):
        last = max(len(t) - tox.WINDOW, 0)
        starts = sorted({*range(0, last + 1, tox.STRIDE), last})
        want = max(by_hand(net, t[a:a + tox.WINDOW]) for a in starts)
        assert abs(value - 1 / (1 + np.exp(-want))) < 1e-4
        assert set(range(len(t))) == {k for a in starts for k in range(a, min(a + tox.WINDOW, len(t)))}


def test_the_net_is_not_a_linear_word_model():
    """Order of words and the state matter, and what training adds to the
    starting log odds is not nothing."""
    net = random_net()
    words = "one two three four five six seven eight".split()
    score = lambda w: float(tox.score_texts(net, pa.array([" ".join(w)], type=pa.large_string()))[0])
    assert abs(score(words) - score(words[::-1])) > 1e-3
    rest = words[:-1] + ["nine"]
    logit = lambda w: np.log(score(w) / (1 - score(w)))
    alone, with_first = logit(words) - logit(rest), logit(words[4:]) - logit(rest[4:])
    assert abs(alone - with_first) > 1e-3                     # a word's share depends on its neighbours
    texts = pa.array([f"{'you are a moron ' if i % 3 == 0 else 'nobody is a moron ' if i % 3 == 1 else ''}some plain words {i}" for i in range(300)], type=pa.large_string())
    y = np.array([float(i % 3 == 0) for i in range(300)], dtype=np.float32)
    trained = tox.train(texts, y, epochs=6)
    right = (tox.score_texts(trained, texts) >= 0.5) == (y > 0)
    assert right.mean() > 0.95


def test_another_text_column_and_a_long_text(spark):
    rows = [(i, "you utter moron " * 2 if i % 2 else "quite calm words " * 2) for i in range(60)] + [(99, "calm words " * 60_000 + "you utter moron " * 12), (98, None)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, body string, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in tox.toxicity(docs, labels, text="body").collect()}
    assert len(got) == 62 and got[99] > 0.5 and got[98] < 0.5
    assert all((got[i] >= 0.5) == bool(i % 2) for i in range(60))
    assert not tox.can_learn(docs, labels.limit(0)) and not tox.can_learn(docs.limit(0), labels) and tox.can_learn(docs, labels)
