import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sensorgrid.llm import queries, token_align

BYTE_FILE = open(public_tokenizers.path("byte_bpe_50k.json"), "rb").read()
PIECE_FILE = open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()
A, B = token_align.byte_side(BYTE_FILE), token_align.piece_side(PIECE_FILE)
JSON = Tokenizer.from_str(BYTE_FILE.decode())
JSON.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_proto=PIECE_FILE)
CHARS = token_align.byte_characters()
EDGES = ["", None, " ", "a", "two words", "  x ", "a\n\nb\tc", "é" * 30, "漢字 \U0001F600", "<|endoftext|> <s> </s> <unk>", "▁a", "ﬁne", "\x00\x7f",
         "don't we'll", "0x0A <0x0A>", "ab" * 3000, " " * 200, "x​y", "İstanbul ǅ"]


def token_bytes(text):
    a = [(i, bytes(CHARS[c] for c in JSON.id_to_token(i))) for i in JSON.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in PIECES.encode(text):
        p = PIECES.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if PIECES.is_byte(i) else p.replace("▁", " ").encode()))
    return a, b


def brute(text):
    """Groups as (A ids, B ids) and links, byte by byte."""
    if not text:
        return [], []
    a, b = token_bytes(text)
    want = b" " + text.encode()
    if b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
        return [], []
    own = [[k for k, (_, x) in enumerate(t) for _ in x] for t in (a, b)]       # token of each byte
    links = sorted(set(zip(*own)))
    ends = [{p for p in range(len(want)) if p + 1 == len(want) or o[p] != o[p + 1]} for o in own]
    groups, start = [], 0
    for p in sorted(ends[0] & ends[1]):
        groups.append(tuple([t[k][0] for k in dict.fromkeys(o[start:p + 1])] for t, o in zip((a, b), own)))
        start = p + 1
    return groups, [(a[i][0], b[j][0]) for i, j in links]


def brute_report(rows):
    made = [(i, *brute(t)) for i, t in rows]
    count = Counter(x for _, _, links in made for x in links)
    most = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    out = []
    for i, groups, links in made:
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((i, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
                    sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


def cut(of, flat):
    return [flat[s:e].tolist() for s, e in zip(of[:-1], of[1:])]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_groups_and_links_of_any_texts(texts):
    x = token_align.Aligned(texts, A, B)
    at_a, at_b, of = x.links()
    assert list(zip(x.a[at_a].tolist(), x.b[at_b].tolist())) == [p for t in texts for p in brute(t)[1]]
    assert np.diff(of).tolist() == [len(brute(t)[1]) for t in texts]
    assert np.diff(x.of_groups).tolist() == [len(brute(t)[0]) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=200))
def test_rank_encoder_is_the_general_one(text):
    assert A.encode([text])[0] == token_align.general_encoder(BYTE_FILE)([text])[0]


def test_general_encoder_where_rules_are_not_in_order():
    import json
    spec = json.loads(BYTE_FILE)
    m = spec["model"]["merges"]
    m[5], m[6] = m[6], m[5]
    assert not token_align._in_rank_order(spec)
    s = token_align.byte_side(json.dumps(spec).encode())
    assert s.encode(["plain text"])[0] and s.bytes_of(np.array(s.encode(["plain é"])[0])) == b" plain \xc3\xa9"


@pytest.mark.parametrize("lane,few", [(1, 1), (3, 100), (64, 8), (10_000, 8)])
def test_diagonal_runs_against_common_ends(monkeypatch, lane, few):
    monkeypatch.setattr(token_align, "LANE", lane)
    monkeypatch.setattr(token_align, "FEW", few)
    g = np.random.default_rng(lane)
    for share in (0.02, 0.5, 0.98):
        common = g.random(3000) < share
        a, b = (np.flatnonzero(common | (g.random(3000) < 0.3)) + 1 for _ in "ab")
        ea, eb = np.unique(np.append(a, 3001)), np.unique(np.append(b, 3001))
        ga, gb = token_align.groups(ea, eb)
        both = np.intersect1d(ea, eb)
        assert (ea[ga - 1] == both).all() and (eb[gb - 1] == both).all()


def rows():
    rnd = random.Random(9)
    some = [" ".join("".join(rnd.choice("aeiounrstl") for _ in range(rnd.randint(1, 9))) for _ in range(rnd.randint(1, 80))) for _ in range(60)]
    return list(enumerate(EDGES + some + some[:20])) + [(None, "no id"), (7, "again"), (7, "again"), (500, some[0] + " " + " ".join(some) * 30)]


@pytest.mark.parametrize("piece_bytes", [300, 2_000_000])
def test_report_against_brute_force(spark, monkeypatch, piece_bytes):
    monkeypatch.setattr(token_align, "PIECE_BYTES", piece_bytes)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows()], "doc_id long, text string, piece string, n_a int").repartition(3)
    got = [tuple(r) for r in token_align.link_report(df, BYTE_FILE, PIECE_FILE).collect()]
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted(got, key=key) == sorted(brute_report(rows()), key=key)


def test_align_columns_and_names(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows()], "a_ids long, body string, n string").repartition(2)
    got = token_align.align(df, BYTE_FILE, PIECE_FILE, text="body", outs=("t", "b_ids", "a_ends", "b_ends")).collect()
    assert len(got) == len(rows())
    for r in got:
        starts = list(zip([0, *r.a_ends], [0, *r.b_ends]))
        made = [(r.t[a:c], r.b_ids[b:d]) for (a, b), (c, d) in zip(starts, starts[1:])]
        assert made == brute(r.body)[0]
    assert token_align.align(df.limit(0), BYTE_FILE, PIECE_FILE, text="body").count() == 0
    assert token_align.link_report(df.limit(0), BYTE_FILE, PIECE_FILE, doc_id="a_ids", text="body").count() == 0


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = queries.table(spark, sf, "documents").select("doc_id", "text").collect()
    assert sorted(map(tuple, queries.op11_token_align(spark, sf).collect())) == sorted(brute_report([tuple(r) for r in docs]))
