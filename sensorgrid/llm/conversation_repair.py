"""Repair of conversation structure by an auction for shortest paths.

The edits of a conversation are arcs of a lattice: a node is (rows done,
state), with the states start, system, user, assistant said last; Keep,
Rerole and Delete lead to the next row, Insert stays before it.  An auction
finds a cheapest path: a path grows from the origin while its last node's
price equals the best arc's cost plus price, and else contracts after
raising that price to it.  When it reaches the goal, the prices are dual to
the path: an arc lies on a cheapest path only if it is tight, so the
least audit string is traced over tight arcs in order of their letters.

Rows are sorted by Spark (conversation, turn) and dealt by range, so one
conversation may lie in many tasks.  A conversation that lies within a task
and is short is one lattice.  Any other is cut into stretches; an auction
for each pair of entry and exit state sums a stretch up (cost, and the order
of its audit strings), and the same auction over the stretches, some
32 at a time, joins them, however long the conversation is.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .text import keep

START, SYSTEM, USER, ASSISTANT = range(4)
TURN = (USER, USER, ASSISTANT, USER)             # the state that a new user or assistant row leads to
ROLE = (None, "system", "user", "assistant")
DELETE, INSERT, REROLE, CUT_OFF = 2, 5, 1, 5     # costs
FAN = 32                                         # rows or stretches of one lattice
LONGEST = 4096                                   # rows of one stretch that a task hands on
BLANKS = " \t\n\x0b\x0c\r"
OK, TRUNCATED, DOOMED = range(3)
INITIALS = "sua"


# ---- the lattice and its auction

def row_code(initial: str, fault: int) -> int:
    return (INITIALS + "x").index(initial if initial and initial in INITIALS else "x") * 3 + fault


def _arcs(code: int, state: int) -> list[tuple[str, int, int, int]]:
    """``(letter, cost, rows done, next state)`` by letter."""
    who, fault = divmod(code, 3)
    new = TURN[state]
    out = [("D", DELETE, 1, state), ("I", INSERT, 0, new)]
    if fault < DOOMED:
        extra = CUT_OFF * fault
        if (who == 0 and state == START) or who + 1 == new:
            out.append(("K", extra, 1, who + 1))
        out.append(("R", REROLE + extra, 1, new))
    return out


ARCS = [[_arcs(code, state) for state in range(4)] for code in range(12)]
LEAST = [(0, DELETE, DELETE)[code % 3] for code in range(12)]         # no arc over the row costs less


def row_lattice(codes: bytes, goal: int | None) -> tuple[list, list]:
    """Arcs ``(label, cost, node)`` of every node ``4 * rows done + state`` and
    starting prices (the least costs of the rows still to come).  Without a
    goal state, the last node is the end of a whole conversation."""
    most = goal if goal is not None and goal < USER else ASSISTANT
    arcs, price = [], []
    for k, code in enumerate(codes):
        for state in range(4):
            arcs.append([(x, cost, 4 * (k + on) + to) for x, cost, on, to in ARCS[code][state] if to <= most])
    end = 4 * len(codes)
    if goal is None:
        arcs += [[("", 0, end + 4)], [("I", INSERT, end + USER)], [("I", INSERT, end + ASSISTANT)], [("", 0, end + 4)], []]
    else:
        arcs += [[], [], [], []]
    left = 0
    price = [0] * (len(arcs) - end)
    for code in reversed(codes):
        left += LEAST[code]
        price += [left] * 4
    price.reverse()
    return arcs, price


def auction(arcs: list, price: list, origin: int, goal: int) -> int | None:
    """Cost of a cheapest path, None if there is none.  ``price`` (never more
    than an arc's cost plus the price behind it) is raised in place."""
    none = float("inf")
    path = [origin]
    while path[-1] != goal:
        i = path[-1]
        best, to = none, goal
        for _, cost, j in arcs[i]:
            if cost + price[j] < best:
                best, to = cost + price[j], j
        if price[i] < best:                       # contraction
            price[i] = best
            if len(path) > 1:
                path.pop()
            elif best == none:
                return None
        else:                                     # extension
            path.append(to)
    return price[origin] - price[goal]


def trace(arcs: list, price: list, origin: int, goal: int) -> tuple[list, list]:
    """Labels and nodes of the tight path from origin to goal that is least
    by its labels (each node's arcs come in order of their labels)."""
    path, at, labels, dead = [origin], [0], [], set()
    while path[-1] != goal:
        i = path[-1]
        for n in range(at[-1], len(arcs[i])):
            label, cost, j = arcs[i][n]
            if price[i] == cost + price[j] and j not in dead:
                at[-1] = n + 1
                path.append(j)
                at.append(0)
                labels.append(label)
                break
        else:                                     # tight, but not on a cheapest path
            dead.add(i)
            path.pop()
            at.pop()
            labels.pop()
    return labels, path


class Stretch:
    """Some rows summed up: for each entry and exit state the cost, the rank
    of the audit string among the exits of the entry, and how to get it."""

    def __init__(self, found: dict, parts: list | None = None):
        self.parts = parts
        self.cost = {k: c for k, (c, _, _) in found.items()}
        self.how = {k: h for k, (_, _, h) in found.items()}
        self.rank = {}
        for s in range(4):
            for n, t in enumerate(sorted((t for t in range(4) if (s, t) in found), key=lambda t: found[s, t][1])):
                self.rank[s, t] = n

    def exits(self, s: int, t: int) -> list[tuple["Stretch", int, int]]:
        """The stretches below, with their entry and exit states."""
        out = []
        for part, to in zip(self.parts, self.how[s, t]):
            out.append((part, s, to))
            s = to
        return out

    def audit(self, s: int, t: int) -> str:
        if self.parts is None:
            return self.how[s, t]
        return "".join(part.audit(a, b) for part, a, b in self.exits(s, t))


@lru_cache(maxsize=50_000)
def rows_stretch(codes: bytes) -> Stretch:
    found = {}
    for t in range(4):
        arcs, price = row_lattice(codes, t)
        goal = 4 * len(codes) + t
        for s in range(t + 1 if t < USER else 4):
            cost = auction(arcs, price, s, goal)
            if cost is not None:
                text = "".join(trace(arcs, price, s, goal)[0])
                found[s, t] = (cost, text, text)
    return Stretch(found)


def joined(parts: list[Stretch]) -> Stretch:
    """One stretch of several that follow each other, by the same auction."""
    if len(parts) == 1:
        return parts[0]
    arcs, least = [], []
    for k, part in enumerate(parts):
        for s in range(4):
            arcs.append(sorted((part.rank[s, t], part.cost[s, t], 4 * (k + 1) + t) for t in range(4) if (s, t) in part.cost))
        least.append(min(part.cost.values()))
    arcs += [[], [], [], []]
    found = {}
    for t in range(4):
        price, left = [0] * 4, 0
        for cost in reversed(least):
            left += cost
            price += [left] * 4
        price.reverse()
        for s in range(4):
            goal = 4 * len(parts) + t
            cost = auction(arcs, price, s, goal)
            if cost is not None:
                labels, path = trace(arcs, price, s, goal)
                found[s, t] = (cost, labels, [n % 4 for n in path[1:]])
    return Stretch(found, parts)


def long_stretch(parts: list[Stretch]) -> Stretch:
    while len(parts) > 1:
        parts = [joined(parts[k:k + FAN]) for k in range(0, len(parts), FAN)]
    return parts[0]


def stretch(codes: bytes) -> Stretch:
    """Any number of rows, ``FAN`` to a lattice."""
    return long_stretch([rows_stretch(codes[k:k + FAN]) for k in range(0, len(codes), FAN)])


def closing(whole: Stretch) -> tuple[int, int, int]:
    """Cost of a whole conversation, its exit state and the rows inserted at
    its end; equal costs: the exit whose audit string is least."""
    more = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
    cost, _, t = min((whole.cost[START, t] + INSERT * n, whole.rank[START, t], t) for t, n in more.items() if (START, t) in whole.cost)
    return cost, t, more[t]


@lru_cache(maxsize=50_000)
def cheapest(codes: bytes) -> tuple[int, str]:
    """Cost and audit string of a whole conversation."""
    if len(codes) <= FAN:
        arcs, price = row_lattice(codes, None)
        cost = auction(arcs, price, START, len(arcs) - 1)
        return cost, "".join(trace(arcs, price, START, len(arcs) - 1)[0])
    whole = stretch(codes)
    cost, t, more = closing(whole)
    return cost, whole.audit(START, t) + "I" * more


# ---- faults of rows

def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turn, role, text`` with planted faults, by a hash of
    ``conv:turn``: of 20 values, 0 drops the row, 1 empties its text, 2 takes
    its ``.!?`` away, 3 repeats it, 4 makes it the user's.  NULL fields of the
    hash, roles and texts count as one blank."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank(conv), F.lit(":"), blank(turn)).cast("binary")) % 20
    return (rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), blank(role).alias("role"), blank(text).alias("text"), kind.alias("kind"))
            .filter("kind <> 0")
            .select("conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
                    F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("__copy"))
            .drop("__copy"))


def _key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _lean(rows: DataFrame) -> DataFrame:
    """Equal rows once with their number, without texts, and whether the
    first of them is the first of its role and text in the conversation."""
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    one = (rows.select("conv", "turn", "role", _key(F.col("text")).alias("key"), (bare == "").alias("blank"),
                       (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"))
           .groupBy("conv", "turn", "role", "key", "blank", "cut").agg(F.count("*").alias("n")))
    turn = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    first = one.groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("key").alias("k")).agg(F.min(turn).alias("first"))
    return (one.join(first, F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("key") == F.col("k")))
            .select("conv", "turn", "role", "key", "n", "blank", "cut", (turn == F.col("first")).alias("fresh")))


class _Run:
    """The rows of one stretch while a task reads them."""

    def __init__(self, conv):
        self.conv, self.codes = conv, bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.last_turn = None
        self.first = self.last = ""

    def add(self, initial: str, fault: int, n: int, turn: int | None) -> None:
        self.codes += bytes([row_code(initial, fault)]) * n
        if self.last:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        else:
            self.first = initial
        self.illegal += n - 1                     # equal initials never follow each other
        self.last = initial
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn


def _initial(role: str) -> str:
    return role[:1] if role[:1] in ("s", "u", "a") else "x"


def _stretches(sorted_rows: DataFrame) -> DataFrame:
    """One row for each stretch: its faults and either the edits of the
    whole conversation, or costs, ranks and audit strings of all entries and
    exits (16 values each, by ``4 * entry + exit``; cost -1: no way)."""
    long = T.LongType()
    counts = ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high")
    schema = T.StructType([T.StructField("conv", sorted_rows.schema["conv"].dataType), T.StructField("seg", long), *(T.StructField(c, long) for c in counts),
                           T.StructField("first", T.StringType()), T.StructField("last", T.StringType()), T.StructField("cost", long), T.StructField("audit", T.StringType()),
                           T.StructField("costs", T.ArrayType(long)), T.StructField("ranks", T.ArrayType(long)), T.StructField("audits", T.ArrayType(T.StringType()))])
    arrow = to_arrow_schema(schema)
    keys = [(s, t) for s in range(4) for t in range(4)]

    def run(batches):
        seg, made, held, alone = TaskContext.get().partitionId() << 33, [], None, False

        def close(whole: bool):
            nonlocal seg
            row = {"conv": held.conv, "seg": seg, "first": held.first, "last": held.last, **{c: getattr(held, c) for c in counts}}
            codes = bytes(held.codes)
            if whole:
                row["cost"], row["audit"] = cheapest(codes)
            else:
                x = stretch(codes)
                row |= {"costs": [x.cost.get(k, -1) for k in keys], "ranks": [x.rank.get(k, -1) for k in keys],
                        "audits": [x.audit(*k) if k in x.cost else None for k in keys]}
            seg += 1
            made.append(row)

        def batch():
            return pa.RecordBatch.from_pylist([{n: r.get(n) for n in schema.names} for r in made], schema=arrow)

        for b in batches:
            names = ("conv", "turn", "role", "n", "blank", "cut", "fresh")
            for conv, turn, role, n, blank, cut, fresh in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in names)):
                if held is None or conv != held.conv:
                    if held is not None:
                        close(alone)
                    alone = held is not None        # rows of the task's first and last conversations may lie elsewhere too
                    held = _Run(conv)
                who = _initial(role)
                todo = [(DOOMED, n, "blank")] if blank else [(TRUNCATED if cut else OK, 1, "truncated" if cut else "")] * fresh + [(DOOMED, n - fresh, "duplicate")]
                for fault, n, name in todo:
                    while n:
                        if len(held.codes) == LONGEST:
                            close(False)
                            alone, held = False, _Run(conv)
                        some = min(n, LONGEST - len(held.codes))
                        held.add(who, fault, some, turn)
                        if name:
                            setattr(held, name, getattr(held, name) + some)
                        n -= some
                if len(made) >= 1000:
                    yield batch()
                    made.clear()
        if held is not None:
            close(False)
        if made:
            yield batch()

    return sorted_rows.mapInArrow(run, schema)


SUMS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _choose(stretches: DataFrame) -> DataFrame:
    """``conv, seg, state, exit, more`` for each stretch of a cut
    conversation, with the conversation's sums in its first row."""
    long = T.LongType()
    schema = T.StructType([stretches.schema["conv"], *(T.StructField(n, long) for n in ("seg", "state", "exit", "more", *SUMS))])
    arrow = to_arrow_schema(schema)
    keys = [(s, t) for s in range(4) for t in range(4)]

    def solve(conv, rows: list[dict]):
        parts = []
        for r in rows:
            x = Stretch({k: (c, rank, r["seg"]) for k, c, rank in zip(keys, r["costs"], r["ranks"]) if c >= 0})
            parts.append(x)
        whole = long_stretch(parts)
        cost, t, more = closing(whole)
        level = [(whole, START, t)]
        while level[0][0].parts is not None:
            level = [x for part, a, b in level for x in part.exits(a, b)]
        low, high = [r["low"] for r in rows if r["low"] is not None], [r["high"] for r in rows if r["high"] is not None]
        turns = sum(r["turns"] for r in rows) - sum(a == b for a, b in zip(high, low[1:]))
        sums = {n: sum(r[n] for r in rows) for n in ("blank", "duplicate", "truncated", "illegal")}
        sums["illegal"] += sum(a["last"] + b["first"] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        sums |= {"cost": cost, "gaps": max(high) - min(low) + 1 - turns if low else 0}
        for k, (r, (_, a, b)) in enumerate(zip(rows, level)):
            yield {"conv": conv, "seg": r["seg"], "state": a, "exit": b, "more": more if k == len(rows) - 1 else 0, **(sums if k == 0 else dict.fromkeys(SUMS))}

    def run(batches):
        held = []
        for b in batches:
            for r in b.to_pylist():
                if held and held[0]["conv"] != r["conv"]:
                    yield pa.RecordBatch.from_pylist(list(solve(held[0]["conv"], held)), schema=arrow)
                    held = []
                held.append(r)
        if held:
            yield pa.RecordBatch.from_pylist(list(solve(held[0]["conv"], held)), schema=arrow)

    small = stretches.filter("audit is null").drop("audits", "audit", "cost")
    return small.repartition("conv").sortWithinPartitions("conv", "seg").mapInArrow(run, schema)


def edits(rows: DataFrame) -> DataFrame:
    """``conv, seg, audit`` and the conversation's sums (in its first row) of
    ``conv, turn, role, text`` rows: the cheapest edits, stretch by stretch."""
    lean = keep(_lean(rows))
    dealt = lean.repartitionByRange("conv", "turn", "role", "key").sortWithinPartitions("conv", "turn", "role", "key")
    found = keep(_stretches(dealt))
    gaps = F.when(F.col("low").isNull(), 0).otherwise(F.col("high") - F.col("low") + 1 - F.col("turns"))
    whole = found.filter("audit is not null").withColumn("gaps", gaps).select("conv", "seg", "audit", *SUMS)
    chosen = _choose(found).withColumnRenamed("seg", "of").drop("conv")
    piece = F.concat(F.element_at("audits", (F.col("state") * 4 + F.col("exit") + 1).cast("int")), F.repeat(F.lit("I"), F.col("more").cast("int")))
    cut = (found.filter("audit is null").select("conv", "seg", "audits").join(chosen, F.col("seg") == F.col("of"))
           .select("conv", "seg", piece.alias("audit"), *SUMS))
    return whole.unionByName(cut)


def _followed(rows: DataFrame, found: DataFrame, all_convs: DataFrame, schema: T.StructType, make) -> DataFrame:
    """Each conversation's edits and rows, read in order by one task: ``make``
    returns an object with ``begin(conv)``, ``sums(row)``, ``row(letter, role,
    text)`` and ``end()``, the last two giving rows of ``schema``.  Texts are
    read as a stream; a conversation's letters are held."""
    null = {f: F.lit(None).cast(t) for f, t in (("turn", "long"), ("role", "string"), ("text", "string"), ("key", "binary"), ("seg", "long"), ("audit", "string"), *((s, "long") for s in SUMS))}
    names = ["conv", "kind", *null]
    full = lambda df, kind: df.withColumn("kind", F.lit(kind)).withColumns({n: c for n, c in null.items() if n not in df.columns}).select(names)
    both = (full(all_convs, 0).unionByName(full(found, 1)).unionByName(full(rows.withColumn("key", _key(F.col("text"))), 2))
            .repartition("conv").sortWithinPartitions("conv", "kind", "seg", "turn", "role", "key").drop("key", "turn"))
    arrow = to_arrow_schema(schema)

    def run(batches):
        one, letters, at, state = None, "", 0, START

        def inserts():
            nonlocal at, state
            while at < len(letters) and letters[at] == "I":
                state = TURN[state]
                yield from one.row("I", ROLE[state], "")
                at += 1

        def finish():
            if one is not None:
                yield from inserts()
                yield from one.end()

        for b in batches:
            out = []
            for r in b.to_pylist():
                if r["kind"] == 0:
                    out += finish()
                    one, letters, at, state = make(), "", 0, START
                    one.begin(r["conv"])
                elif r["kind"] == 1:
                    letters += r["audit"]
                    one.sums(r)
                else:
                    out += inserts()
                    letter, role = letters[at], r["role"]
                    at += 1
                    if letter == "R":
                        state = TURN[state]
                        role = ROLE[state]
                    elif letter == "K":
                        state = 1 + INITIALS.index(role[0])
                    out += one.row(letter, role, r["text"])
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
        out = list(finish())
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return both.mapInArrow(run, schema)


class _Repaired:
    def begin(self, conv):
        self.conv, self.at = conv, 0

    def sums(self, row):
        pass

    def row(self, letter, role, text):
        if letter == "D":
            return []
        self.at += 1
        return [{"conv_id": self.conv, "position": self.at - 1, "edit": letter, "role": role, "text": text}]

    def end(self):
        return []


class _Summary:
    def begin(self, conv):
        self.made = {"conv_id": conv, **dict.fromkeys(SUMS, 0)}
        self.letters, self.sha, self.any = [], hashlib.sha256(), False

    def sums(self, row):
        self.letters.append(row["audit"])
        if row["cost"] is not None:
            self.made |= {n: row[n] for n in SUMS}

    def row(self, letter, role, text):
        if letter != "D":
            self.sha.update(f"{chr(10) * self.any}{role}:{text}".encode())
            self.any = True
        return []

    def end(self):
        return [self.made | {"audit": "".join(self.letters), "repaired_sha256": self.sha.hexdigest()}]


def _over(rows: DataFrame, damaged: DataFrame, conv: str, fields: list, make) -> DataFrame:
    all_convs = rows.select(F.col(conv).alias("conv")).distinct()
    schema = T.StructType([T.StructField("conv_id", rows.schema[conv].dataType), *fields])
    return _followed(damaged, edits(damaged), all_convs, schema, make)


def plain(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows as they are, NULL roles and texts as one blank."""
    return rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), *(
        F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))))


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, position, edit, role, text``: the rows that stay (K), get
    another role (R) or are new (I), in order.

    Rows are taken by turn (NULL first), equal turns by role and a digest of
    the text; NULL roles and texts count as one blank; an empty role fits no
    place; a row without id belongs to the conversation NULL; repeated rows
    are duplicates and go; an empty table gives an empty one.  Other columns
    are left out."""
    fields = [T.StructField("position", T.LongType()), *(T.StructField(n, T.StringType()) for n in ("edit", "role", "text"))]
    return _over(rows, plain(rows, conv, turn, role, text), conv, fields, _Repaired)


def report(rows: DataFrame, damaged: DataFrame | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256`` of every conversation of ``rows``, over ``damaged``
    (``conv, turn, role, text``; the rows themselves if not given).  Odd rows
    as in ``repair``; without rows: zeros, no edits, the empty text's digest."""
    fields = [*(T.StructField(n, T.LongType()) for n in SUMS), T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())]
    return _over(rows, plain(rows, conv, turn, role, text) if damaged is None else damaged, conv, fields, _Summary)
