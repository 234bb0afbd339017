import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from sensorgrid.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
LOOKUP = {base64.b64decode(a): int(b) for a, b in map(bytes.split, RANKS.splitlines())}
TIKTOKEN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=LOOKUP, special_tokens={})
EDGES = ["", "a", " " * 200, "\n\n  x ", "é" * 100, "ab" * 5000, "don't we'll   x\t\ty", "\U0001F600" * 50, "<|endoftext|>", "\x00\x7f", "漢字" * 40]


def one(text):
    import regex
    ids, counts = bpe.coder(RANKS).encode(regex.compile(public_tokenizers.PATTERN), [text])
    assert counts.tolist() == [len(ids)]
    return ids.tolist()


@pytest.mark.parametrize("text", EDGES)
def test_edges_as_the_library(text):
    assert one(text) == TIKTOKEN.encode_ordinary(text)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=400))
def test_any_text_as_the_library(text):
    assert one(text) == TIKTOKEN.encode_ordinary(text)


def test_long_matches_and_small_caches(monkeypatch):
    rnd = random.Random(4)
    text = "".join(rnd.choice("abcdefgh") for _ in range(20_000)) + " " + " ".join("".join(rnd.choice("abc") for _ in range(5)) for _ in range(500))
    want = TIKTOKEN.encode_ordinary(text)
    assert one(text) == want
    monkeypatch.setattr(bpe, "CACHE_WORDS", 20)
    assert one(text) == want


def test_portions_of_very_long_texts():
    import regex
    find = regex.compile(public_tokenizers.PATTERN)
    texts = ["short one", "word " * 3000, "", "tail é"]
    parts = list(bpe._portions(find, texts, most=100))
    joined = {}
    for at, many in parts:
        for k, m in enumerate(many):
            joined.setdefault(at + k, []).extend(m)
    assert {i: "".join(v) for i, v in joined.items()} == dict(enumerate(texts))


def test_table_round_trip(spark):
    rows = [(i, t, "kept") for i, t in enumerate(EDGES)] + [(0, "", "kept"), (None, None, None), (99, "repeat me", None), (99, "repeat me", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string").repartition(3)
    enc = bpe.bpe_encode(df, RANKS, public_tokenizers.PATTERN, decoded="decoded")
    apart = bpe.bpe_decode(bpe.bpe_encode(df, RANKS, public_tokenizers.PATTERN), RANKS)
    for made in (enc, apart):
        got = made.collect()
        assert len(got) == len(rows)
        for r in got:
            assert r.ids == TIKTOKEN.encode_ordinary(r.text or "")
            assert bytes(r.decoded).decode() == (r.text or "")
    for r in bpe.digests(enc).filter("doc_id is not null").collect():
        ids = TIKTOKEN.encode_ordinary(dict((i, t) for i, t, _ in rows)[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    assert bpe.bpe_encode(df.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_unknown_ids_fail(spark):
    with pytest.raises(Exception, match="outside the vocabulary"):
        bpe.bpe_decode(spark.createDataFrame([([1, 60_000],)], "ids array<int>"), RANKS).collect()
