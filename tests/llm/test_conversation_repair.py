import hashlib
import random
import re
import zlib

import duckdb
import pytest

from sensorgrid.llm import conversation_repair as cr
from sensorgrid.llm import queries

SQL_COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def brute_edits(rows):
    """Cheapest audit string of ``(role, text, fault)`` rows, state by state."""
    turn = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "")}

    def with_inserts(best):
        for _ in range(3):
            for s, (cost, audit) in list(best.items()):
                t = turn[s]
                best[t] = min(best.get(t, (10 ** 9, "")), (cost + 5, audit + "I"))
        return best

    for role, _, fault in rows:
        new = {}
        for s, (cost, audit) in with_inserts(dict(best)).items():
            ways = [(s, 2, "D")]
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                ways.append((turn[s], 1 + extra, "R"))
                if role[:1] == turn[s] or (role[:1] == "s" and s == ""):
                    ways.append((role[:1], extra, "K"))
            for t, c, x in ways:
                new[t] = min(new.get(t, (10 ** 9, "")), (cost + c, audit + x))
        best = new
    if not rows:
        return 0, ""
    stop = with_inserts(dict(best))
    return min(x for x in ((*best.get("", (10 ** 9, "")),), stop.get("a", (10 ** 9, ""))))


def brute(rows, damaging=True):
    """The contract, conversation by conversation."""
    blank = lambda x: " " if x is None else x
    made = {conv: [] for conv, *_ in rows}
    for conv, turn, role, text in rows:
        role, text = blank(role), blank(text)
        kind = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20 if damaging else 9
        role = "user" if kind == 4 else role
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        made[conv] += [] if kind == 0 else [(turn, role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, some in made.items():
        some.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, faulty = set(), []
        for _, role, text in some:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            faulty.append((role, text, fault))
        cost, audit = brute_edits(faulty)
        lines, state, k = [], "", 0
        for x in audit:
            role, text = faulty[k][:2] if x != "I" else ("", "")
            k += x != "I"
            if x == "D":
                continue
            if x in "RI":
                role = "assistant" if state == "u" else "user"
            state = role[0]
            lines.append(f"{role}:{text}")
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
        turns = {t for t, _, _ in some if t is not None}
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(sum(f[2] == n for f in faulty) for n in ("blank", "duplicate", "truncated")),
                    sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(some, some[1:])), cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def some_rows(n, seed, longest=9):
    rnd, rows = random.Random(seed), []
    for conv in range(n):
        for turn in range(rnd.randint(1, longest)):
            role = rnd.choice(["user", "assistant"]) if rnd.random() < 0.2 else ("user", "assistant")[turn % 2]
            role = rnd.choice(["system", "tool", "user", None]) if rnd.random() < 0.15 else role
            text = rnd.choice(["Yes.", "No!", f"Line {turn}.", f"open {conv}", "  ", "", None, "Why? \n", "x" * 300 + "."])
            rows.append((conv if conv else None, None if rnd.random() < 0.03 else turn + 2 * (rnd.random() < 0.1), role, text))
    return rows


def same(got, want):
    key = lambda r: tuple((v is not None, v if v is not None else 0) for v in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_auction_and_stretches_against_brute_force():
    rnd = random.Random(4)
    names = {(w, f): cr.row_code(w, k) for w in "suax" for k, f in enumerate(["", "truncated", "blank"])}
    for n in [*range(1, 14)] * 12 + [33, 64, 100, 1200]:
        rows = [(rnd.choice("uuuaaasx"), rnd.choice(["", "", "", "truncated", "blank"])) for _ in range(n)]
        codes = bytes(names[r] for r in rows)
        want = brute_edits([(w, "", f) for w, f in rows])
        assert cr.cheapest(codes) == want
        cuts = sorted(rnd.sample(range(n + 1), min(n, 5)))
        whole = cr.long_stretch([cr.stretch(codes[a:b]) for a, b in zip([0, *cuts], [*cuts, n]) if b > a])
        cost, t, more = cr.closing(whole)
        assert (cost, whole.audit(cr.START, t) + "I" * more) == want


def test_prices_are_dual_and_only_tight_arcs_are_traced():
    codes = bytes([cr.row_code("u", 0), cr.row_code("u", 1), cr.row_code("a", 2), cr.row_code("x", 0), cr.row_code("s", 0)])
    arcs, price = cr.row_lattice(codes, None)
    goal = len(arcs) - 1
    cost = cr.auction(arcs, price, 0, goal)
    assert all(price[i] <= c + price[j] for i, out in enumerate(arcs) for _, c, j in out)
    labels, path = cr.trace(arcs, price, 0, goal)
    used = [next(c for x, c, j in arcs[i] if j == k and x == label) for i, k, label in zip(path, path[1:], labels)]
    assert sum(used) == cost and all(price[i] - price[j] == c for i, j, c in zip(path, path[1:], used))


def test_no_way_is_told():
    arcs, price = cr.row_lattice(bytes([cr.row_code("u", 0)]), cr.SYSTEM)
    assert cr.auction(arcs, price, 0, 4 + cr.SYSTEM) is None


@pytest.mark.parametrize("longest,parts", [(4096, 2), (3, 5), (40, 7)])
def test_report_against_brute_force(spark, monkeypatch, longest, parts):
    monkeypatch.setattr(cr, "LONGEST", longest)
    rows = some_rows(120, parts) + [(7, t, ("user", "assistant")[t % 2], "again and again" + "." * (t % 3)) for t in range(10, 150)] + some_rows(15, 1, 2)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, seg string, cost int").repartition(parts)
    same(cr.report(df, cr.damage(df)).collect(), brute(rows))
    same(cr.report(df).collect(), brute(rows, damaging=False))


def test_repaired_rows_and_ids_of_other_types(spark):
    rows = [("b", 0, "user", "Hi."), ("b", 1, "user", "Hi."), ("b", 5, "tool", "Fine."), ("a", 0, "system", "S."), ("a", 1, "assistant", "long text." * 20_000), ("c", 0, "", "")]
    df = spark.createDataFrame(rows, "name string, n int, who string, said string")
    got = [tuple(r) for r in cr.repair(df, "name", "n", "who", "said").orderBy("conv_id", "position").collect()]
    assert got == [("a", 0, "R", "user", "S."), ("a", 1, "K", "assistant", rows[4][3]), ("b", 0, "K", "user", "Hi."), ("b", 1, "R", "assistant", "Fine.")]
    audits = {r.conv_id: (r.audit, r.gaps) for r in cr.report(df, conv="name", turn="n", role="who", text="said").collect()}
    assert audits == {"a": ("RK", 0), "b": ("KDR", 3), "c": ("D", 0)}
    assert cr.report(df.limit(0), conv="name", turn="n", role="who", text="said").count() == 0 == cr.repair(df.limit(0), "name", "n", "who", "said").count()


def test_dropped_conversations_stay_in_the_report(spark):
    gone = [(c, 0, "user", "Hi.") for c in range(3000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    df = spark.createDataFrame(gone, "conv_id long, turn long, role string, text string")
    got = cr.report(df, cr.damage(df)).collect()
    assert len(got) == len(gone) and {tuple(r)[1:] for r in got} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_sql_and_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in queries.table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op12_conversation_repair(spark, sf)
    assert got.columns == SQL_COLUMNS
    same(got.collect(), brute(rows))


def test_sql_on_odd_rows():
    rows = some_rows(60, 8)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    same(con.execute(queries.OP12_SQL).fetchall(), brute(rows))
