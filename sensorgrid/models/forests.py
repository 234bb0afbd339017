"""Many regression forests at once (M1 in batches, for M5-M11).

The columns are binned once into a compact table of blocks (one byte a
value).  Every tree is grown level by level from histograms of weights and
label sums over ``(run, tree, node, column, bin)``; bootstrap weights are
Poisson(1) numbers made from a hash of the row and the tree, and folds or
parts are columns of the table, so all runs share the one table.

Two ways lead to the same trees.  A table whose binned bytes are below
``LOCAL_BYTES`` is broadcast and each task grows some whole trees.  Above,
the blocks stay where they are: each level of a wave of trees is one Spark
aggregate over all blocks, and the best split of each node is chosen in SQL;
only the chosen splits come to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

BINS = 64
LOCAL_BYTES = 64 * 1024 * 1024
WAVE_CELLS = 50_000_000         # (tree, node, column, bin) cells of a level that one wave may have
CHUNK_CELLS = 4_000_000         # cells of one histogram in memory
LEAST_GAIN = 1e-10              # share of the label's sum of squares

# Poisson(1): chance of a weight of at most 0, 1, 2, ...
POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(20)])


@dataclass(frozen=True)
class Run:
    """A forest to fit: columns, number of trees, depth, and which rows it
    learns from and is tested on (allowed values of group columns)."""
    columns: tuple[str, ...]
    trees: int
    depth: int
    train: tuple[tuple[str, tuple[int, ...]], ...]
    test: tuple[tuple[str, tuple[int, ...]], ...]


@dataclass
class Tree:
    """Nodes in order of growth; a leaf has feature -1; right = left + 1."""
    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    def predict(self, codes: np.ndarray) -> np.ndarray:
        """Values for rows of codes (columns as in the run)."""
        at = np.zeros(len(codes), dtype=np.int64)
        rows = np.arange(len(codes))
        while len(rows):
            f = self.feature[at[rows]]
            rows, f = rows[f >= 0], f[f >= 0]
            node = at[rows]
            at[rows] = self.left[node] + (codes[rows, f] > self.bin[node])
        return self.value[at]


@dataclass
class Forest:
    run: Run
    trees: list[Tree] = field(default_factory=list)

    def sums(self, codes: np.ndarray, upto: Sequence[int]) -> list[np.ndarray]:
        """Mean prediction of the first ``n`` trees, for each ``n``."""
        out, total, done = [], np.zeros(len(codes)), 0
        for n in sorted(upto):
            for t in self.trees[done:n]:
                total += t.predict(codes)
            done = min(n, len(self.trees))
            out.append(total / max(done, 1))
        return out

    def importances(self, trees: int | None = None) -> list[dict]:
        """Shares of the gain by column (each tree counts alike), sorted."""
        total = np.zeros(len(self.run.columns))
        for t in self.trees[:trees]:
            inner = t.feature >= 0
            own = np.bincount(t.feature[inner], weights=t.gain[inner], minlength=len(total))
            total += own / own.sum() if own.sum() > 0 else 0
        total = total / total.sum() if total.sum() > 0 else total
        pairs = sorted(zip(total, self.run.columns), key=lambda x: (-x[0], x[1]))
        return [{"importance": float(i), "column": c} for i, c in pairs]


# ---- the binned table

def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: a stable hash of integers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def bootstrap(row: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """Weights of rows (by their 64-bit hash) in a tree, wherever they are."""
    own = _mixed(np.array([((tree + 1) * 0x9E3779B97F4A7C15 + seed) % 2 ** 64], dtype=np.uint64))
    u = (_mixed(row ^ own) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
    return np.searchsorted(POISSON, u, side="right").astype(np.int32)


class Rows:
    """Rows in arrays: codes, label, hash and groups."""

    def __init__(self, codes, y, h, groups):
        self.codes, self.y, self.h, self.groups = codes, y, h, groups

    def where(self, part) -> np.ndarray:
        mask = np.ones(len(self.y), dtype=bool)
        for name, allowed in part:
            mask &= np.isin(self.groups[name], allowed)
        return mask


def _quantiles(rows: DataFrame, width: int, by: str | None) -> dict[int, list[np.ndarray]]:
    """Cuts of every column (for each value of ``by``, or for 0), from one
    aggregate of mergeable quantile summaries."""
    probs = F.array(*[F.lit(k / BINS) for k in range(1, BINS)])
    aggs = [F.percentile_approx(f"c{j}", probs, 2_000).alias(f"c{j}") for j in range(width)]
    if not aggs:
        return {}
    found = (rows.groupBy(by) if by else rows.groupBy()).agg(*aggs).collect()
    return {(r[by] if by else 0): [np.unique(np.array([x for x in (r[f"c{j}"] or []) if x == x], dtype=float)) for j in range(width)] for r in found}


class BinnedTable:
    """The binned columns of ``df`` as blocks of rows.

    NULL and NaN values share the greatest bin.  A row whose label is NULL
    takes no part.  ``groups`` are small integer or boolean columns (NULL:
    -1) that runs select rows by; with ``bins_by`` (one of them) the rows of
    each of its values are binned by themselves."""

    def __init__(self, df: DataFrame, columns: Sequence[str], label: str, groups: Sequence[str], id_cols: Sequence[str], seed: int = 1234,
                 bins_by: str | None = None):
        self.columns, self.groups, self.seed, self.spark = list(columns), list(groups), seed, df.sparkSession
        rows = df.filter(F.col(label).isNotNull()).select(
            F.col(label).cast("double").alias("__y"), F.xxhash64(*id_cols).alias("__h"),
            *[F.coalesce(F.col(g).cast("int"), F.lit(-1)).alias(f"g{i}") for i, g in enumerate(groups)],
            *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(self.columns)])
        n_groups, own = len(self.groups), self.groups.index(bins_by) if bins_by else -1
        self.cuts = cuts = _quantiles(rows, len(self.columns), f"g{own}" if bins_by else None)

        def pack(batches):
            for b in batches:
                if not b.num_rows:
                    continue
                value = [b.column(i).to_numpy(zero_copy_only=False) for i in range(b.num_columns)]
                codes = np.empty((b.num_rows, b.num_columns - 2 - n_groups), dtype=np.uint8)
                for g in (np.unique(value[2 + own]) if own >= 0 else [0]):
                    at = np.flatnonzero(value[2 + own] == g) if own >= 0 else slice(None)
                    for j, cut in enumerate(cuts[int(g)]):
                        x = np.asarray(value[2 + n_groups + j], dtype=float)[at]
                        codes[at, j] = np.where(np.isnan(x), BINS - 1, np.searchsorted(cut, x, side="left"))
                packed = [codes, value[0].astype(float), value[1].astype(np.int64), np.array(value[2:2 + n_groups], dtype=np.int8)]
                yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), *(pa.array([x.tobytes()]) for x in packed)], names=["n", "codes", "y", "h", "groups"])

        self.blocks = cut_lineage(rows.mapInArrow(pack, "n long, codes binary, y binary, h binary, groups binary"))
        self.rows = self.blocks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        self.bytes = self.rows * (len(self.columns) + len(self.groups) + 16)
        self._shipped = None

    def unpacked(self, block: dict) -> Rows:
        n = block["n"]
        g = np.frombuffer(block["groups"], dtype=np.int8).reshape(len(self.groups), n)
        return Rows(np.frombuffer(block["codes"], dtype=np.uint8).reshape(n, len(self.columns)), np.frombuffer(block["y"]),
                    np.frombuffer(block["h"], dtype=np.int64).view(np.uint64), dict(zip(self.groups, g)))

    def shipped(self):
        """The whole table, broadcast (its bytes are known to be few)."""
        if self._shipped is None:
            parts = [self.unpacked(b) for b in self.blocks.toArrow().to_pylist()]
            parts = parts or [self.unpacked({"n": 0, "codes": b"", "y": b"", "h": b"", "groups": b""})]
            whole = Rows(np.concatenate([p.codes for p in parts]), np.concatenate([p.y for p in parts]), np.concatenate([p.h for p in parts]),
                         {g: np.concatenate([p.groups[g] for p in parts]) for g in self.groups})
            self._shipped = self.spark.sparkContext.broadcast(whole)
        return self._shipped

    def bare(self) -> "BinnedTable":
        """The layout alone, for tasks."""
        out = object.__new__(BinnedTable)
        out.columns, out.groups, out.seed = self.columns, self.groups, self.seed
        return out

    def blocks_train_length(self, flag: str) -> int:
        """Rows whose flag is 0."""
        bare = self.bare()

        def count(batches):
            for b in batches:
                yield pa.RecordBatch.from_pydict({"n": [int((bare.unpacked(x).groups[flag] == 0).sum()) for x in b.to_pylist()]})

        return self.blocks.mapInArrow(count, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def at(self, run: Run) -> list[int]:
        return [self.columns.index(c) for c in run.columns]


# ---- growing

def _gains(w: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Drop of the squared error of each cut, from sums by bin (last axis)."""
    wl, sl = np.cumsum(w, axis=2), np.cumsum(s, axis=2)
    wt, st = wl[:, :1, -1:], sl[:, :1, -1:]
    wl, sl = wl[:, :, :-1], sl[:, :, :-1]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = sl * sl / wl + (st - sl) ** 2 / (wt - wl) - st * st / wt
    return np.where((wl > 0) & (wl < wt), gain, -np.inf)


class _Growing:
    """A tree while it grows: nodes, and those of the last level."""

    def __init__(self, mean: float, squares: float):
        self.feature, self.bin, self.left, self.value, self.gain = [-1], [0], [-1], [mean], [0.0]
        self.open = np.array([0])
        self.least = LEAST_GAIN * squares

    def split(self, node: int, feature: int, cut: int, gain: float, left: float, right: float) -> bool:
        if not gain > self.least:
            return False
        self.feature[node], self.bin[node], self.left[node], self.gain[node] = feature, cut, len(self.feature), gain
        for value in (left, right):
            self.feature.append(-1)
            self.bin.append(0)
            self.left.append(-1)
            self.value.append(value)
            self.gain.append(0.0)
        return True

    def tree(self) -> Tree:
        return Tree(np.array(self.feature, np.int32), np.array(self.bin, np.int16), np.array(self.left, np.int32), np.array(self.value), np.array(self.gain))


def grow(codes: np.ndarray, y: np.ndarray, w: np.ndarray, depth: int) -> Tree:
    """One tree from rows in memory."""
    live = w > 0
    codes, y, w = codes[live], y[live], w[live].astype(float)
    mean = float(w @ y / w.sum()) if len(w) else 0.0
    s = w * (y - mean)
    t = _Growing(mean, float(s @ (y - mean)) if len(w) else 0.0)
    c = codes.shape[1]
    slot = np.zeros(len(y), dtype=np.int64)                   # place of a row's node in the open ones
    col = np.arange(c) * BINS
    most = max(1, CHUNK_CELLS // (c * BINS))
    for _ in range(depth):
        grown, place = [], np.full(len(t.open), -1, dtype=np.int64)
        for a in range(0, len(t.open), most):
            b = min(a + most, len(t.open))
            rows = slice(None) if b - a == len(t.open) else np.flatnonzero((slot >= a) & (slot < b))
            key = ((slot[rows] - a)[:, None] * (c * BINS) + col + codes[rows]).ravel()
            size = (b - a) * c * BINS
            hw = np.bincount(key, weights=np.repeat(w[rows], c), minlength=size).reshape(b - a, c, BINS)
            hs = np.bincount(key, weights=np.repeat(s[rows], c), minlength=size).reshape(b - a, c, BINS)
            gain = _gains(hw, hs).reshape(b - a, -1)
            best = gain.argmax(1)
            feature, cut = best // (BINS - 1), best % (BINS - 1)
            k = np.arange(b - a)
            top = gain[k, best]
            cw, cs = np.cumsum(hw[k, feature], axis=1), np.cumsum(hs[k, feature], axis=1)
            for i in np.flatnonzero(top > t.least):
                lw, ls = cw[i, cut[i]], cs[i, cut[i]]
                if t.split(int(t.open[a + i]), int(feature[i]), int(cut[i]), float(top[i]), mean + ls / lw, mean + (cs[i, -1] - ls) / (cw[i, -1] - lw)):
                    place[a + i] = 2 * len(grown)
                    grown.append(t.left[t.open[a + i]])
        if not grown:
            break
        node = t.open[slot]
        f = np.array(t.feature)[node]
        keep = place[slot] >= 0
        codes, y, w, s, node, f = codes[keep], y[keep], w[keep], s[keep], node[keep], f[keep]
        slot = place[slot[keep]] + (codes[np.arange(len(f)), f] > np.array(t.bin)[node])
        t.open = np.array([n + side for n in grown for side in (0, 1)])
    return t.tree()


TREE_COLUMNS = "run int, tree int, feature binary, bin binary, left binary, value binary, gain binary"
_TREE_NAMES = ["run", "tree", "feature", "bin", "left", "value", "gain"]
_TREE_TYPES = {"feature": np.int32, "bin": np.int16, "left": np.int32, "value": np.float64, "gain": np.float64}


def _grow_local(table: BinnedTable, runs: list[Run]) -> list[Forest]:
    """Each task grows some trees from the broadcast table."""
    shipped, bare, spark = table.shipped(), table.bare(), table.spark
    starts = np.cumsum([0, *(r.trees for r in runs)])
    todo = spark.sparkContext.broadcast((runs, starts))

    def work(batches):
        runs, starts = todo.value
        data, last, held = shipped.value, -1, None
        for b in batches:
            for i in b.column(0).to_numpy():
                k = int(np.searchsorted(starts, i, side="right")) - 1
                if k != last:
                    mask = data.where(runs[k].train)
                    held, last = (data.codes[mask][:, bare.at(runs[k])], data.y[mask], data.h[mask]), k
                n = int(i - starts[k])
                t = grow(held[0], held[1], bootstrap(held[2], n, bare.seed), runs[k].depth)
                arrays = [pa.array([k], pa.int32()), pa.array([n], pa.int32()), *(pa.array([getattr(t, c).astype(d).tobytes()]) for c, d in _TREE_TYPES.items())]
                yield pa.RecordBatch.from_arrays(arrays, names=_TREE_NAMES)

    parts = max(1, min(int(starts[-1]), 4 * spark.sparkContext.defaultParallelism))
    found = spark.range(0, int(starts[-1]), 1, parts).mapInArrow(work, TREE_COLUMNS).toArrow().to_pylist()
    out = [Forest(r, [None] * r.trees) for r in runs]
    for x in found:
        out[x["run"]].trees[x["tree"]] = Tree(**{c: np.frombuffer(x[c], dtype=d) for c, d in _TREE_TYPES.items()})
    return out


def _grow_wave(table: BinnedTable, runs: list[Run], wave: list[tuple[int, int]]) -> list[Tree]:
    """Trees ``(run, tree)`` of a wave, one aggregate over all blocks a level."""
    bare, spark = table.bare(), table.spark
    sc = spark.sparkContext

    def totals(batches):
        for b in batches:
            for block in b.to_pylist():
                rows = bare.unpacked(block)
                made = []
                masks = {}
                for k, (r, n) in enumerate(wave):
                    mask = masks.setdefault(runs[r].train, rows.where(runs[r].train))
                    w, y = bootstrap(rows.h[mask], n, bare.seed).astype(float), rows.y[mask]
                    made.append((k, float(w.sum()), float(w @ y), float(w @ (y * y))))
                yield pa.RecordBatch.from_pylist([dict(zip(("k", "w", "s", "q"), x)) for x in made], schema=total_schema)

    total_schema = pa.schema([("k", pa.int32()), ("w", pa.float64()), ("s", pa.float64()), ("q", pa.float64())])
    sums = {x["k"]: x for x in table.blocks.mapInArrow(totals, "k int, w double, s double, q double").groupBy("k").agg(
        *[F.sum(c).alias(c) for c in "wsq"]).collect()}
    growing, means = [], []
    for k in range(len(wave)):
        x = sums.get(k)
        w, s, q = (x["w"], x["s"], x["q"]) if x else (0.0, 0.0, 0.0)
        means.append(s / w if w else 0.0)
        growing.append(_Growing(means[-1], q - s * s / w if w else 0.0))

    for level in range(max(runs[r].depth for r, _ in wave)):
        now = [(t.tree(), t.open) if len(t.open) and level < runs[r].depth else None for t, (r, _) in zip(growing, wave)]
        if not any(now):
            break
        shipped = sc.broadcast((now, means))                     # trees of one wave, bounded

        def cells(batches):
            trees, mean = shipped.value
            for b in batches:
                for block in b.to_pylist():
                    rows = bare.unpacked(block)
                    masks = {}
                    for k, (r, n) in enumerate(wave):
                        if trees[k] is None:
                            continue
                        mask = masks.setdefault(runs[r].train, rows.where(runs[r].train))
                        w = bootstrap(rows.h[mask], n, bare.seed).astype(float)
                        some = w > 0
                        codes, w, y = rows.codes[mask][some][:, bare.at(runs[r])], w[some], rows.y[mask][some] - mean[k]
                        node = _place(trees[k][0], codes)
                        some = np.isin(node, trees[k][1])
                        codes, w, y, node = codes[some], w[some], y[some], node[some]
                        c = codes.shape[1]
                        key = ((node[:, None] * c + np.arange(c)) * BINS + codes).ravel()
                        at, inv = np.unique(key, return_inverse=True)
                        if not len(at):
                            continue
                        hw = np.bincount(inv, weights=np.repeat(w, c))
                        hs = np.bincount(inv, weights=np.repeat(w * y, c))
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(len(at), k, np.int32)), pa.array((at // (c * BINS)).astype(np.int32)), pa.array((at // BINS % c).astype(np.int32)),
                            pa.array((at % BINS).astype(np.int32)), pa.array(hw), pa.array(hs)], names=["k", "node", "col", "bin", "w", "s"])

        hist = table.blocks.mapInArrow(cells, "k int, node int, col int, bin int, w double, s double").groupBy(
            "k", "node", "col", "bin").agg(F.sum("w").alias("w"), F.sum("s").alias("s"))
        over = Window.partitionBy("k", "node", "col")             # at most BINS rows
        upto = over.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        cut = hist.select("k", "node", "col", "bin", F.sum("w").over(upto).alias("wl"), F.sum("s").over(upto).alias("sl"),
                          F.sum("w").over(over).alias("wt"), F.sum("s").over(over).alias("st")).filter("wl < wt")
        gain = F.expr("sl * sl / wl + (st - sl) * (st - sl) / (wt - wl) - st * st / wt")
        best = cut.withColumn("gain", gain).groupBy("k", "node").agg(
            F.max_by(F.struct("col", "bin", "gain", "wl", "sl", "wt", "st"), F.struct("gain", -F.col("col"), -F.col("bin"))).alias("b"))
        chosen = {(x["k"], x["node"]): x["b"] for x in best.collect()}          # one row for a node of the wave
        for k, t in enumerate(growing):
            opened = []
            for node in (t.open if now[k] else []):
                b = chosen.get((k, int(node)))
                if b and t.split(int(node), b["col"], b["bin"], b["gain"], means[k] + b["sl"] / b["wl"], means[k] + (b["st"] - b["sl"]) / (b["wt"] - b["wl"])):
                    opened += [t.left[node], t.left[node] + 1]
            t.open = np.array(opened, dtype=np.int64)
        shipped.unpersist()
    return [t.tree() for t in growing]


def _place(tree: Tree, codes: np.ndarray) -> np.ndarray:
    """Node that each row has come to."""
    return Tree(tree.feature, tree.bin, tree.left, np.arange(len(tree.feature)), tree.gain).predict(codes)


def fit_forests(table: BinnedTable, runs: Sequence[Run]) -> list[Forest]:
    """The forest of every run."""
    runs = list(runs)
    if not runs:
        return []
    if table.bytes <= LOCAL_BYTES:
        return _grow_local(table, runs)
    out = [Forest(r, [None] * r.trees) for r in runs]
    todo = [(k, n) for k, r in enumerate(runs) for n in range(r.trees)]
    while todo:
        wave, cells = [], 0
        while todo and (not wave or cells < WAVE_CELLS):
            r = runs[todo[0][0]]
            cells += min(2 ** r.depth, table.rows) * len(r.columns) * BINS
            wave.append(todo.pop(0))
        for (k, n), t in zip(wave, _grow_wave(table, runs, wave)):
            out[k].trees[n] = t
    return out


def predictions(table: BinnedTable, forests: Sequence[Forest], upto: Sequence[Sequence[int]] | None = None) -> DataFrame:
    """``run, trees, size, label, prediction`` for the test rows of every
    run, from one pass over the blocks; ``upto`` lists, for each run, the
    numbers of first trees to predict with (default: all)."""
    bare = table.bare()
    upto = [sorted(u) for u in upto] if upto else [[f.run.trees] for f in forests]
    shipped = table.spark.sparkContext.broadcast((list(forests), upto))        # one batch of forests

    def work(batches):
        forests, upto = shipped.value
        for b in batches:
            for block in b.to_pylist():
                rows = bare.unpacked(block)
                for k, f in enumerate(forests):
                    mask = rows.where(f.run.test)
                    if not mask.any():
                        continue
                    codes, y = rows.codes[mask][:, bare.at(f.run)], rows.y[mask]
                    for n, p in zip(upto[k], f.sums(codes, upto[k])):
                        full = lambda v: pa.array(np.full(len(y), v, np.int32))
                        yield pa.RecordBatch.from_arrays([full(k), full(n), full(len(f.run.columns)), pa.array(y), pa.array(p)],
                                                         names=["run", "trees", "size", "label", "prediction"])

    return table.blocks.mapInArrow(work, "run int, trees int, size int, label double, prediction double")
