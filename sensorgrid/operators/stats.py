"""Statistics: column stats, correlation matrices, model metrics and
ranking (A9, A12–A14, A16–A19, W10, T2, T5)."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .. import catalog
from . import chunks as ch


# --------------------------------------------------------------------- A9
def column_stats(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """min / max / mean / population and sample std of every column in one
    pass, long form ``(keys…, column, n, min, max, mean, std_pop, std_samp)``."""
    aggs = []
    for c in columns:
        aggs += [F.count(c).alias(f"{c}__n"), F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max"),
                 F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__sp"),
                 F.stddev_samp(c).alias(f"{c}__ss")]
    wide = df.groupBy(*keys).agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}__n").alias("n"),
                 F.col(f"{c}__min").cast("double").alias("min"), F.col(f"{c}__max").cast("double").alias("max"),
                 F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__sp").alias("std_pop"),
                 F.col(f"{c}__ss").alias("std_samp")) for c in columns]))
    return wide.select(*keys, rows.alias("__r")).select(*keys, "__r.*")


# ------------------------------------------------------------------ A12 Pearson
def _long_matrix(wide: DataFrame, method: str, columns: Sequence[str], value_of,
                 keys: Sequence[str] = ()) -> DataFrame:
    cells = []
    for a in columns:
        for b in columns:
            corr, n = value_of(a, b)
            cells.append(F.struct(F.lit(method).alias("method"), F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                                  corr.alias("corr"), n.alias("n")))
    out = wide.select(*keys, F.explode(F.array(*cells)).alias("__c")).select(*keys, "__c.*")
    return out.withColumn("corr", F.when(~F.isnan("corr"), F.col("corr")))


def _pairs(columns):
    return [(a, b) for i, a in enumerate(columns) for b in columns[i:]]


def corr_pearson(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Pearson on pairwise complete rows for every column pair (per
    series when ``keys`` are given), one aggregate pass; long form
    ``(keys…, method, col_a, col_b, corr, n)``."""
    aggs = []
    for i, (a, b) in enumerate(_pairs(columns)):
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        aggs += [F.corr(a, b).alias(f"c{i}"), F.count(F.when(both, 1)).alias(f"n{i}")]
    wide = df.groupBy(*keys).agg(*aggs)
    index = {p: i for i, p in enumerate(_pairs(columns))}

    def value_of(a, b):
        i = index.get((a, b), index.get((b, a)))
        return F.col(f"c{i}"), F.col(f"n{i}")
    return _long_matrix(wide, "pearson", columns, value_of, keys)


# ------------------------------------------------------------------ A13 Spearman
FAN = 32                        # ordered parts that a group of values is cut into
RANK_ROWS = 1_000_000           # distinct values that one window ranks at most
GROUP_ROWS = 200_000            # value pairs that one group counts at most
SMALL_RANKS = 10_000            # rank maps of columns with so few values are broadcast


def _cuts(value: str, fan: int) -> Column:
    return F.array_distinct(F.percentile_approx(value, [i / fan for i in range(1, fan)], 1_000))


def average_ranks(long: DataFrame, grp: Sequence[str], group_rows: int = RANK_ROWS, fan: int = FAN, count: str | None = None) -> DataFrame:
    """Average rank (1-based, ties share the mean rank) of every distinct
    value of each group: ``(grp…, value, __rank)`` from
    ``(grp…, value)``, each row counted once or ``count`` times.

    Works on the value-frequency table, so repeated values cost nothing.  A
    group of more than ``group_rows`` values is cut at approximate quantiles
    into ordered parts, each with the number of values before it, and a part
    that is still too large is cut again: no window ever sees more, however
    many values there are."""
    from ..session import cut_lineage
    long = long.select(*grp, "value", (F.col(count) if count else F.lit(1)).alias("__cnt")).filter(F.col("value").isNotNull())
    work = long.groupBy(*grp, "value").agg(F.sum("__cnt").alias("__cnt"))
    work = cut_lineage(work.withColumns({"__node": F.lit(""), "__off": F.lit(0).cast("bigint")}))
    done = []
    while True:
        node = [*grp, "__node"]
        size = work.groupBy(*node).agg(F.count(F.lit(1)).alias("__n"))
        # few (the values over ``group_rows``), so broadcast: a join on the
        # node would bring all values of a node to one task
        large = cut_lineage(size.filter(F.col("__n") > group_rows).select(*node))
        if large.isEmpty():
            done.append(work)
            break
        done.append(work.join(F.broadcast(large), node, "left_anti"))
        big = work.join(F.broadcast(large), node, "left_semi")
        cuts = cut_lineage(big.groupBy(*node).agg(_cuts("value", fan).alias("__cuts")))
        big = big.join(F.broadcast(cuts), node).withColumn("__b", F.size(F.filter("__cuts", lambda c: c < F.col("value")))).drop("__cuts")
        tot = big.groupBy(*node, "__b").agg(F.sum("__cnt").alias("__bt"))
        before = F.sum("__bt").over(Window.partitionBy(*node).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1))
        big = big.join(F.broadcast(cut_lineage(tot.withColumn("__before", F.coalesce(before, F.lit(0))).drop("__bt"))), [*node, "__b"])
        work = cut_lineage(big.select(*grp, "value", "__cnt", F.concat_ws(".", "__node", F.col("__b").cast("string")).alias("__node"),
                                      (F.col("__off") + F.col("__before")).alias("__off")))
    leaves = done[0]
    for d in done[1:]:
        leaves = leaves.unionByName(d)
    w = Window.partitionBy(*grp, "__node").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    rank = F.col("__off") + F.coalesce(F.sum("__cnt").over(w), F.lit(0)) + (F.col("__cnt") + 1) / 2.0
    return leaves.select(*grp, "value", rank.cast("double").alias("__rank"))


def _with_rank(rows: DataFrame, ranks: DataFrame, on: Sequence[str], few: bool) -> DataFrame:
    """Ranks joined to rows; the map of a column of few values is broadcast."""
    return rows.join(F.broadcast(ranks) if few else ranks, list(on), "left")


def _weighted_corr(rows: DataFrame, grp: Sequence[str], few: bool) -> DataFrame:
    """``grp…, corr, n``: Pearson of the ranks ``ra, rb`` of ``w`` rows each.
    The mean of the ranks of n rows is (n + 1) / 2, so the sums are taken
    around it.  ``few`` groups may be large: their sizes are broadcast."""
    n = rows.groupBy(*grp).agg(F.sum("w").alias("n"))
    a, b = (F.col(c) - (F.col("n") + 1) / 2 for c in ("ra", "rb"))
    d = rows.join(F.broadcast(n) if few else n, list(grp))
    s = d.groupBy(*grp).agg(F.first("n").alias("n"), *[F.sum(F.col("w") * x).alias(k) for k, x in (("ab", a * b), ("aa", a * a), ("bb", b * b))])
    corr = F.when((F.col("aa") > 0) & (F.col("bb") > 0), F.col("ab") / (F.sqrt("aa") * F.sqrt("bb")))
    return s.select(*grp, corr.alias("corr"), "n")


def corr_spearman(df: DataFrame, columns: Sequence[str], group_rows: int = RANK_ROWS, keys: Sequence[str] = ()) -> DataFrame:
    """Pearson of average ranks (per series when ``keys`` are given).
    Ranks are taken on the pair's complete rows; columns without NULLs are
    ranked once, together, and shared by all their pairs; the pairs with a
    column that has NULLs are ranked together, in one long table keyed by the
    pair."""
    from ..session import cut_lineage
    row = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    full = [c for i, c in enumerate(columns) if row[f"c{i}"] == row["n"]]
    df = ch.with_key(df, keys)
    kc = ch.key_cols(keys)
    value = lambda c: F.col(c).cast("double")

    pieces = []
    if full:
        base = df.select(*kc, *[value(c).alias(c) for c in full])
        long = base.select(*kc, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in full])).alias("__p"))
        # rank maps hold distinct values only; checkpointed because every
        # column's join reads them
        ranks = cut_lineage(average_ranks(long.select(*kc, "__p.column", "__p.value"), [*kc, "column"], group_rows))
        number = {r["column"]: r["n"] for r in ranks.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
        shared = base
        for c in sorted(full, key=lambda c: number.get(c, 0)):
            own = ranks.filter(F.col("column") == c).select(*kc, F.col("value").alias(c), F.col("__rank").alias(f"__r_{c}"))
            shared = _with_rank(shared, own, [*kc, c], number.get(c, 0) <= SMALL_RANKS)
        todo = [(i, a, b) for i, (a, b) in enumerate(_pairs(columns)) if a in full and b in full]
        wide = shared.groupBy(*kc).agg(*[x for i, a, b in todo for x in (
            F.corr(f"__r_{a}", f"__r_{b}").alias(f"c{i}"), F.count(F.lit(1)).alias(f"n{i}"))])
        cells = F.explode(F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                                             F.col(f"c{i}").alias("corr"), F.col(f"n{i}").alias("n"))
                                    for i, a, b in todo]))
        pieces.append(wide.select(*kc, cells.alias("__c")).select(*kc, "__c.*"))
    other = [(a, b) for a, b in _pairs(columns) if a not in full or b not in full]
    if other:
        cells = F.explode(F.array(*[F.struct(F.lit(i).alias("pair"), value(a).alias("va"), value(b).alias("vb"))
                                    for i, (a, b) in enumerate(other)]))
        rows = df.select(*kc, cells.alias("__c")).select(*kc, "__c.*").filter(F.col("va").isNotNull() & F.col("vb").isNotNull())
        rows = cut_lineage(rows.groupBy(*kc, "pair", "va", "vb").agg(F.count(F.lit(1)).alias("w")))
        sides = F.explode(F.array(F.struct(F.lit("a").alias("side"), F.col("va").alias("value")),
                                  F.struct(F.lit("b").alias("side"), F.col("vb").alias("value"))))
        long = rows.select(*kc, "pair", "w", sides.alias("__s")).select(*kc, "pair", "__s.*", "w")
        ranks = cut_lineage(average_ranks(long, [*kc, "pair", "side"], group_rows, count="w"))
        number = {(r["pair"], r["side"]): r["n"] for r in ranks.groupBy("pair", "side").agg(F.count(F.lit(1)).alias("n")).collect()}
        for side in ("a", "b"):
            # sides of few values have heavy ones: their ranks are broadcast
            few = [i for i in range(len(other)) if number.get((i, side), 0) <= SMALL_RANKS]
            own = ranks.filter(F.col("side") == side).select(*kc, "pair", F.col("value").alias("v" + side), F.col("__rank").alias("r" + side))
            met = []
            if few:
                met.append(rows.filter(F.col("pair").isin(few)).join(F.broadcast(own.filter(F.col("pair").isin(few))), [*kc, "pair", "v" + side]))
            if len(few) < len(other):
                met.append(rows.filter(~F.col("pair").isin(few)).join(own.filter(~F.col("pair").isin(few)), [*kc, "pair", "v" + side]))
            rows = met[0].unionByName(met[1]) if len(met) > 1 else met[0]
        names = F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b")) for a, b in other])
        each = _weighted_corr(rows, [*kc, "pair"], few=not keys)
        # a pair without any complete row has no correlation and n = 0
        every = (df.select(*kc).distinct() if kc else df.sparkSession.range(1).select()).select(
            *kc, F.explode(F.sequence(F.lit(0), F.lit(len(other) - 1))).alias("pair"))
        each = every.join(each, [*kc, "pair"], "left")
        pieces.append(each.select(*kc, F.element_at(names, F.col("pair") + 1).alias("__c"), "corr", F.coalesce("n", F.lit(0)).alias("n"))
                      .select(*kc, "__c.*", "corr", "n"))
    upper = pieces[0]
    for p in pieces[1:]:
        upper = upper.unionByName(p)
    mirrored = F.explode(F.array(
        F.struct(F.col("col_a"), F.col("col_b")),
        F.struct(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"))))
    out = (upper.select(*kc, mirrored.alias("__k"), "corr", "n")
           .select(*kc, "__k.col_a", "__k.col_b", "corr", "n").dropDuplicates([*kc, "col_a", "col_b"]))
    return out.select(*([f"{ch.KEY}.*"] if keys else []), F.lit("spearman").alias("method"), "col_a", "col_b",
                      F.when(~F.isnan("corr"), F.col("corr")).alias("corr"), "n")


# ------------------------------------------------------------------ A14 Kendall
def signed_pair_sum(p: np.ndarray, q: np.ndarray, w: np.ndarray) -> float:
    """Σ over pairs with ``p_x < p_y`` of ``w_x·w_y·sign(q_y - q_x)``.

    Vectorised counting by the binary digits of the ranks of the axis with
    fewer values (the sum is the same with the axes exchanged).  Items lie in
    the order ``(higher digits, q)``; at each digit every item with a one
    meets the weight of the zeros of its block with smaller and with larger
    ``q``, from one running sum; then the items of each block are dealt into
    zeros and ones, which keeps their order.  Every pair of different ranks is
    met once, at its first different digit."""
    if len(p) < 2:
        return 0.0
    _, p = np.unique(p, return_inverse=True)
    _, q = np.unique(q, return_inverse=True)
    if q.max() < p.max():
        p, q = q, p
    order = np.argsort(q, kind="stable")
    p, q, w = p[order], q[order], np.asarray(w, dtype=np.float64)[order]
    n, total = len(p), 0.0
    at = np.arange(n)
    for digit in range(int(p.max()).bit_length() - 1, -1, -1):
        block = p >> (digit + 1)
        one = (p >> digit) & 1
        new_block = np.concatenate(([True], block[1:] != block[:-1]))
        tie = np.flatnonzero(new_block | np.concatenate(([True], q[1:] != q[:-1])))
        starts = np.flatnonzero(new_block)
        of_tie = np.cumsum(new_block)[tie] - 1                  # block of each run of equal q
        zeros = np.concatenate(([0.0], np.cumsum(np.where(one == 0, w, 0.0))))
        ends = np.concatenate((starts[1:], [n]))
        lower = zeros[tie] - zeros[starts][of_tie]
        higher = zeros[ends][of_tie] - zeros[np.concatenate((tie[1:], [n]))]
        total += float(np.dot(np.add.reduceat(np.where(one == 1, w, 0.0), tie), lower - higher))
        # deal each block: zeros first, both in their order
        ones = np.concatenate(([0], np.cumsum(one)))
        size = ends - starts
        first = np.repeat(starts, size)
        ones_before = ones[:-1] - np.repeat(ones[starts], size)
        n_zeros = np.repeat(size - (ones[ends] - ones[starts]), size)
        place = first + np.where(one == 1, n_zeros + ones_before, at - first - ones_before)
        moved = np.empty(n, dtype=np.int64)
        moved[place] = at
        p, q, w = p[moved], q[moved], w[moved]
    return total


def _block_expr(col, cuts_col):
    """Ordered block of a value: values equal to a cut get a block of their
    own (so a heavily repeated value never shares a block)."""
    below = F.size(F.filter(cuts_col, lambda c: c < col))
    on_cut = F.array_contains(cuts_col, col).cast("int")
    return below * 2 + on_cut


def _cross_block_sum(ba: np.ndarray, bb: np.ndarray, w: np.ndarray) -> float:
    """Pairs in different blocks on both axes, from one node's block × block
    weight table (at most (2·fan+1)² cells)."""
    k = int(max(ba.max(), bb.max())) + 1
    m = np.zeros((k, k))
    np.add.at(m, (ba, bb), w)
    # suf[i, j] = Σ m[i:, j:]; pairs (x in cell (i,j), y in a cell with both
    # blocks larger) are concordant, (i' > i, j' < j) discordant
    suf = m[::-1, ::-1].cumsum(0).cumsum(1)[::-1, ::-1]
    below = np.zeros((k + 1, k + 1))
    below[:k, :k] = suf
    concord = below[1:k + 1, 1:k + 1]                      # Σ m[i+1:, j+1:]
    rows_after = np.vstack([m[1:], np.zeros((1, k))])      # m[i+1, :] shifted
    after_rows = rows_after[::-1].cumsum(0)[::-1]          # Σ m[i+1:, :] per column
    left = np.hstack([np.zeros((k, 1)), after_rows.cumsum(1)[:, :-1]])   # Σ m[i+1:, :j]
    return float((m * (concord - left)).sum())


def _signed_sums(combos: DataFrame, grp: Sequence[str], group_rows: int, fan: int) -> DataFrame:
    """``grp…, s``: the signed pair sum of each group of ``(grp…, p, q, w)``.

    A node of more than ``group_rows`` rows is cut into ordered blocks on both
    axes.  Pairs in different blocks on both axes come from the node's small
    table of block weights; pairs within one p-block, and pairs within one
    q-block whose p-blocks differ, are nodes of the next level (a block of one
    value, a cut's own, has only ties).  Nodes that are small enough are
    counted whole; a large node with one value on an axis has only ties.  All
    groups go through the same few jobs, and there are as many levels as the
    largest group needs.  The large nodes and their cuts are few (the rows over
    ``group_rows``) and are broadcast: a join on the node would bring all rows
    of a node to one task."""
    from ..session import cut_lineage
    node = [*grp, "__kind", "__node"]
    # numbers of nodes: a node's blocks have 2·fan+1 numbers, three times (see below)
    width, few = 3 * (2 * fan + 1), 2 * fan + 1
    work = combos.withColumns({"__kind": F.lit(0), "__node": F.lit(0).cast("bigint")}).select(*node, "p", "q", "w")
    keys = [f for f in work.schema.fields if f.name in grp]
    out_schema = T.StructType([*keys, T.StructField("s", T.DoubleType())])

    out_arrow = to_arrow_schema(out_schema)

    def one(table: pa.Table, s: float) -> pa.Table:
        return pa.Table.from_arrays([*(table[f.name].slice(0, 1) for f in keys), pa.array([s])], schema=out_arrow)

    def cross(table: pa.Table) -> pa.Table:
        return one(table, _cross_block_sum(*(table[c].to_numpy() for c in ("ba", "bb", "w"))))

    def within(table: pa.Table) -> pa.Table:
        return one(table, signed_pair_sum(*(table[c].to_numpy() for c in ("p", "q", "w"))))

    sums, leaves = [], []
    while True:
        size = work.groupBy(*node).agg(F.count(F.lit(1)).alias("__n"), ((F.min("p") < F.max("p")) & (F.min("q") < F.max("q"))).alias("__mixed"))
        over = cut_lineage(size.filter(F.col("__n") > group_rows))
        if over.isEmpty():
            leaves.append(work)
            break
        leaves.append(work.join(F.broadcast(over.select(*node)), node, "left_anti"))
        large = over.filter("__mixed").select(*node)
        if large.isEmpty():
            break
        big = work.join(F.broadcast(large), node, "left_semi")
        cuts = cut_lineage(big.groupBy(*node).agg(F.when(F.col("__kind") == 0, _cuts("p", fan)).alias("__cp"), _cuts("q", fan).alias("__cq")))
        # a node of the second kind has p-blocks for p already
        bp = F.when(F.col("__kind") == 0, _block_expr(F.col("p"), F.col("__cp"))).otherwise(F.col("p").cast("int"))
        big = cut_lineage(big.join(F.broadcast(cuts), node).withColumns({"ba": bp, "bb": _block_expr(F.col("q"), F.col("__cq"))}).drop("__cp", "__cq"))
        sums.append(big.groupBy(*node, "ba", "bb").agg(F.sum("w").alias("w")).groupBy(*node).applyInArrow(cross, out_schema))
        same_p = big.filter("__kind = 0 and ba % 2 = 0").withColumn("__node", F.col("__node") * width + F.col("ba"))
        same_q = big.filter("bb % 2 = 0").withColumns({"__node": F.col("__node") * width + (F.col("__kind") + 1) * few + F.col("bb"), "__kind": F.lit(1), "p": F.col("ba").cast("double")})
        work = same_p.select(*node, "p", "q", "w").unionByName(same_q.select(*node, "p", "q", "w"))
    whole = leaves[0]
    for x in leaves[1:]:
        whole = whole.unionByName(x)
    out = whole.groupBy(*node).applyInArrow(within, out_schema)
    for x in sums:
        out = out.unionByName(x)
    return out.groupBy(*grp).agg(F.sum("s").alias("s"))


def _tau_of_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]], keys: Sequence[str], group_rows: int, fan: int) -> DataFrame:
    """``(key, col_a, col_b, corr, n)`` of every pair, all in one go."""
    from ..session import cut_lineage
    df = ch.with_key(df, keys)
    kc = ch.key_cols(keys)
    grp = [*kc, "__pair"]
    value = lambda c: F.col(c).cast("double")
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), value(a).alias("p"), value(b).alias("q")) for i, (a, b) in enumerate(pairs)]))
    rows = df.select(*kc, cells.alias("__c")).filter("__c.p is not null and __c.q is not null")
    combos = cut_lineage(rows.groupBy(*kc, F.col("__c.i").alias("__pair"), F.col("__c.p").alias("p"), F.col("__c.q").alias("q"))
                         .agg(F.count(F.lit(1)).cast("double").alias("w")))
    tied = F.sum(F.col("t") * (F.col("t") - 1) / 2)
    ties = [combos.groupBy(*grp, x).agg(F.sum("w").alias("t")).groupBy(*grp).agg(tied.alias(n), F.sum("t").alias(f"n{n}")) for x, n in (("p", "n1"), ("q", "n2"))]
    r = ties[0].join(ties[1].drop("nn2"), grp).join(_signed_sums(combos, grp, group_rows, fan), grp, "left")
    n0 = F.col("nn1") * (F.col("nn1") - 1) / 2
    denom = (n0 - F.col("n1")) * (n0 - F.col("n2"))
    tau = F.when(denom > 0, F.coalesce(F.col("s"), F.lit(0.0)) / F.sqrt(denom))
    # a pair without any complete row has no correlation and n = 0
    every = (df.select(*kc).distinct() if kc else df.sparkSession.range(1).select()).select(
        *kc, F.explode(F.sequence(F.lit(0), F.lit(len(pairs) - 1))).alias("__pair"))
    names = F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b")) for a, b in pairs])
    return (every.join(r, grp, "left").withColumn("__names", F.element_at(names, F.col("__pair") + 1))
            .select(*([f"{ch.KEY}.*"] if keys else []), F.lit("kendall").alias("method"), "__names.*", tau.alias("corr"), F.coalesce("nn1", F.lit(0)).cast("bigint").alias("n")))


def kendall_tau_b(df: DataFrame, a: str, b: str, keys: Sequence[str] = (), group_rows: int = GROUP_ROWS, fan: int = FAN) -> DataFrame:
    """Kendall's tau-b of one column pair (per series when ``keys`` are
    given) without an n² join: see ``_signed_sums``."""
    return _tau_of_pairs(df, [(a, b)], keys, group_rows, fan)


def corr_kendall(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), group_rows: int = GROUP_ROWS, fan: int = FAN) -> DataFrame:
    """A14 for every column pair (diagonal: 1, or NULL for a constant); all
    pairs go through the same jobs."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    out = None
    if pairs:
        r = _tau_of_pairs(df, pairs, keys, group_rows, fan)
        names = [c for c in r.columns if c not in set(keys) | {"col_a", "col_b"}]
        both = F.explode(F.array(F.struct("col_a", "col_b"), F.struct(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"))))
        out = r.select(*keys, *names, both.alias("__s")).select(*keys, "method", "__s.*", "corr", "n")
    diag = df.groupBy(*keys).agg(*[x for c in columns for x in (
        F.count(c).alias(f"n_{c}"), (F.min(c) < F.max(c)).alias(f"v_{c}"))])
    cells = F.explode(F.array(*[F.struct(F.lit("kendall").alias("method"), F.lit(c).alias("col_a"),
                                         F.lit(c).alias("col_b"),
                                         F.when(F.col(f"v_{c}"), F.lit(1.0)).alias("corr"),
                                         F.col(f"n_{c}").alias("n")) for c in columns]))
    d = diag.select(*keys, cells.alias("__c")).select(*keys, "__c.*")
    return d if out is None else out.unionByName(d)


# ------------------------------------------------------------------ A16–A18, M4
def evaluate(pred: DataFrame, n_columns: int, label: str = "label", prediction: str = "prediction",
             error_term: float = 2.0, keys: Sequence[str] = ()) -> DataFrame:
    """M4: one aggregate pass → R², AICc, 95 % CI of the residual mean,
    CI span and test length (per key, e.g. per model run)."""
    r = F.col(label) - F.col(prediction)
    stats = pred.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("test_length"),
        F.sum(r * r).alias("__rss"),
        F.avg(r).alias("__rmean"),
        F.stddev_samp(r).alias("__rsd"),
        F.var_pop(F.col(label)).alias("__vy"),
    )
    n = F.col("test_length").cast("double")
    k_par = F.lit(2.0 * n_columns + error_term) if not isinstance(n_columns, str) else \
        (F.col(n_columns) * 2.0 + F.lit(error_term))
    half = F.lit(catalog.Z95) * F.col("__rsd") / F.sqrt(n)
    r2 = F.lit(1.0) - F.try_divide(F.col("__rss"), F.col("__vy") * n)
    aicc = n * F.log(F.col("__rss") / n) + 2 * k_par + F.try_divide(2 * k_par * (k_par + 1), n - k_par - 1)
    return stats.select(
        *keys,
        r2.alias("r2_score"), aicc.alias("aicc"),
        F.struct((F.col("__rmean") - half).alias("lo"), (F.col("__rmean") + half).alias("hi")).alias("ci95"),
        (2 * half).alias("ci95_span"), "test_length")


# ------------------------------------------------------------------ W10 T2 T5
def akaike_weights(results: DataFrame, partition: Sequence[str] = (), aicc: str = "aicc") -> DataFrame:
    """``delta = aicc - min(aicc)``; ``weight = exp(-delta/2) / Σ``
    per result set, in ascending order of AICc.  Two small
    aggregates joined back (no window over a whole result set)."""
    mins = results.groupBy(*partition).agg(F.min(aicc).alias("__min"))
    d = ch.attach(results, mins, partition).withColumn("delta", F.col(aicc) - F.col("__min"))
    sums = d.groupBy(*partition).agg(F.sum(F.exp(-F.col("delta") / 2)).alias("__sum"))
    d = ch.attach(d, sums, partition).withColumn("weight", F.exp(-F.col("delta") / 2) / F.col("__sum"))
    return d.drop("__min", "__sum").orderBy(*partition, aicc)


def best_models(results: DataFrame, k: int = 1, partition: Sequence[str] = (), aicc: str = "aicc",
                buckets: int = 64) -> DataFrame:
    """The ``k`` lowest-AICc rows (per result set; ties broken by the
    other columns' hash so the choice is stable).

    Two-phase top-k so a huge result set is never one window group: top-k
    inside ``buckets`` hash buckets of each set, then top-k over the at most
    ``k·buckets`` survivors."""
    if not partition:
        return results.orderBy(aicc).limit(k)
    from pyspark.sql import Window
    tie = F.xxhash64(*[c for c in results.columns if c not in partition])
    d = results.withColumn("__tie", tie).withColumn("__bk", F.pmod("__tie", F.lit(buckets)))
    w1 = Window.partitionBy(*partition, "__bk").orderBy(aicc, "__tie")
    d = d.withColumn("__rk", F.row_number().over(w1)).filter(F.col("__rk") <= k)
    w2 = Window.partitionBy(*partition).orderBy(aicc, "__tie")
    d = d.withColumn("__rk", F.row_number().over(w2)).filter(F.col("__rk") <= k)
    return d.drop("__rk", "__bk", "__tie")


def merge_results(base: DataFrame, extra: DataFrame, aicc: str = "aicc") -> DataFrame:
    """T5: the base search's winner in front of another result set, ranked
    again."""
    return akaike_weights(best_models(base, 1, aicc=aicc).unionByName(extra, allowMissingColumns=True), aicc=aicc)


def aicc_value(n: int, rss: float, n_columns: int, error_term: float = 2.0) -> float:
    """A18 on plain numbers (driver-side checks and tests)."""
    k = 2 * n_columns + error_term
    return n * math.log(rss / n) + 2 * k + (2 * k * (k + 1)) / (n - k - 1)
