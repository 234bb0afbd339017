"""Distributed model searches (M5–M14) and the results store.

A search is a table of runs (column subset × model settings).  The columns
are binned once; the forests of a piece of runs are grown together and tested
in one pass (``models/forests.py``).  The prepared table carries the
train/test flag (T7) and is checkpointed once, so every run reads the same
rows without re-deriving the lineage.  After every piece the finished result
rows are appended to the results store; a restarted search skips the runs
already stored.
"""

from __future__ import annotations

import math
import threading
import uuid
import warnings
from collections.abc import Iterable, Sequence
from itertools import combinations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..models import forest as rf
from ..models import forests
from ..models.knn import knn_predict
from ..models.pls import fit_pls
from ..operators import stats, timeops
from ..operators.split import row_hash
from ..session import cut_lineage

RESULT_SCHEMA = T.StructType([
    T.StructField("search_id", T.StringType()),
    T.StructField("run_key", T.StringType()),
    T.StructField("size", T.IntegerType()),
    T.StructField("r2_score", T.DoubleType()),
    T.StructField("aicc", T.DoubleType()),
    T.StructField("ci95", T.StructType([T.StructField("lo", T.DoubleType()), T.StructField("hi", T.DoubleType())])),
    T.StructField("ci95_span", T.DoubleType()),
    T.StructField("input_columns", T.ArrayType(T.StringType())),
    T.StructField("feature_importances", T.ArrayType(T.StructType([
        T.StructField("importance", T.DoubleType()), T.StructField("column", T.StringType())]))),
    T.StructField("data_periodicity_hrs", T.ArrayType(T.DoubleType())),
    T.StructField("test_size", T.DoubleType()),
    T.StructField("random_state", T.IntegerType()),
    T.StructField("train_length", T.LongType()),
    T.StructField("test_length", T.LongType()),
    T.StructField("n_estimators", T.IntegerType()),
    T.StructField("max_depth", T.IntegerType()),
    T.StructField("knn_neighbors", T.IntegerType()),
    T.StructField("pls_components", T.IntegerType()),
])


# Run lists of the reference's searches (fixed values).
TREND_HOURS = tuple(range(1, 25))
HYPER_TREES = tuple(range(100, 501, 25))
HYPER_DEPTHS = tuple(range(2, 21))
GROUPING_HOURS = tuple(0.25 * k for k in range(1, 97))

PIECE_NODES = 5_000_000             # tree nodes of the runs that are grown and tested together (26 bytes each)
MOST_FOLDS = 60                     # folds are made of so many slices of the rows


def run_key(columns: Sequence[str], **params) -> str:
    p = ",".join(f"{k}={params[k]}" for k in sorted(params) if params[k] is not None)
    return "|".join(columns) + "#" + p


def _missing(exc: AnalysisException) -> bool:
    return (exc.getCondition() or "") in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


class ResultStore:
    """Results appended as Parquet partitioned by search id; a resumed
    search makes the planned runs that are not stored and returns all.

    Every append bears the name of its attempt, and a run that several
    drivers made at the same time counts once: its first attempt by name."""

    def __init__(self, spark: SparkSession, path: str | None):
        self.spark, self.path = spark, path
        self._one = threading.Lock()                  # appends to one folder must not overlap

    def stored(self, search_id: str) -> DataFrame | None:
        """Rows of a search (None: nothing stored; any other failure to read
        is raised)."""
        if not self.path:
            return None
        try:
            rows = self.spark.read.schema(T.StructType([*RESULT_SCHEMA.fields, T.StructField("attempt", T.StringType())])).parquet(self.path)
        except AnalysisException as exc:
            if _missing(exc):
                return None
            raise
        own = rows.filter(F.col("search_id") == search_id)
        one = own.groupBy("run_key").agg(F.min_by(F.struct(*RESULT_SCHEMA.fieldNames()), F.coalesce("attempt", F.lit(""))).alias("r"))
        return one.select("r.*")

    def keys(self, search_id: str) -> set[str]:
        """Keys of the stored runs of a search."""
        rows = self.stored(search_id)
        return {r["run_key"] for r in rows.select("run_key").collect()} if rows is not None else set()

    def known(self, search_id: str) -> dict[str, dict]:
        """Stored rows of a search by their key (of searches by rounds, that
        have few)."""
        rows = self.stored(search_id)
        return {r["run_key"]: r.asDict() for r in rows.collect()} if rows is not None else {}

    def append(self, rows: DataFrame) -> None:
        if self.path:
            with self._one:
                rows.withColumn("attempt", F.lit(uuid.uuid4().hex)).write.mode("append").partitionBy("search_id").parquet(self.path)


class ModelSearch:
    def __init__(self, prepared: DataFrame, label: str, flag: str = "is_test", parallelism: int | None = None,
                 store: ResultStore | None = None, checkpoint: bool = True, test_size: float = 0.2,
                 seed: int = 1234, id_cols: Sequence[str] = ("ts",), rows_per_partition: int = 250_000):
        self.id_cols = list(id_cols)
        self.spark = prepared.sparkSession
        # one partition per core at least (a fit's per-level aggregation runs
        # in parallel), more when the table is large; half the cores' worth of
        # fits run concurrently (measured best on 8 cores)
        if checkpoint:
            prepared = cut_lineage(prepared)          # once: the count and the table read it
        names = [f.name for f in prepared.schema.fields if f.name != flag]
        row = prepared.agg(F.count(F.lit(1)).alias("n"), *[F.count(F.col(c)).alias(f"c{i}") for i, c in enumerate(names)]).first()
        n = row["n"]
        self._empty = {c for i, c in enumerate(names) if not row[f"c{i}"]}
        parts = max(self.spark.sparkContext.defaultParallelism, math.ceil(n / rows_per_partition))
        prepared = prepared.repartition(parts)
        # kept in memory for the many fits
        self.data = prepared.persist()
        self.rows = n
        self.label, self.flag = label, flag
        self.parallelism = parallelism or max(2, self.spark.sparkContext.defaultParallelism // 2)
        self.store = store or ResultStore(self.spark, None)
        self.test_size, self.seed = test_size, seed
        self._train_len = None
        self._tables: dict[tuple, forests.BinnedTable] = {}

    def close(self) -> None:
        """Release the cached model table (results already returned are
        plain rows and stay valid)."""
        self.data.unpersist()

    def __enter__(self):
        return self

    def __exit__(self, *exc):
        self.close()

    def train_length(self) -> int:
        if self._train_len is None:
            self._train_len = self.data.filter(~F.col(self.flag)).count()
        return self._train_len

    def usable(self, columns: Sequence[str]) -> list[str]:
        """The columns that hold a value in any row: one that was constant is
        all NULL once scaled and cannot enter a model (a warning names it)."""
        gone = [c for c in columns if c in self._empty]
        if gone:
            warnings.warn(f"columns without any value are left out of the model: {', '.join(gone)}", stacklevel=2)
        return [c for c in columns if c not in gone]

    def _table(self, columns: Sequence[str], nights: bool = True) -> forests.BinnedTable:
        """The binned table of a search (made once for its columns)."""
        key = (tuple(columns), nights)
        if key not in self._tables:
            data = self.data if nights else timeops.exclude_nights(self.data, ts=self.id_cols[0])
            fold = F.pmod(row_hash(self.seed + 1, self.id_cols), F.lit(MOST_FOLDS))
            self._tables[key] = forests.BinnedTable(data.withColumn("__fold", fold), columns, self.label, [self.flag, "__fold"], self.id_cols, self.seed)
        return self._tables[key]

    def _run(self, columns: Sequence[str], trees: int, depth: int) -> forests.Run:
        return forests.Run(tuple(columns), trees, depth, ((self.flag, (0,)),), ((self.flag, (1,)),))

    def _rows(self, search_id, table, found, key_columns, upto=None, error_term=2.0, train_len=None) -> list[dict]:
        """Result rows of forests (one for each number of first trees asked for)."""
        upto = upto or [[f.run.trees] for f in found]
        scores = stats.evaluate(forests.predictions(table, found, upto), "size", error_term=error_term, keys=["run", "trees", "size"]).collect()
        scores = {(r["run"], r["trees"]): r for r in scores}
        none = {"r2_score": None, "aicc": None, "ci95": {"lo": None, "hi": None}, "ci95_span": None, "test_length": 0}
        train_len = train_len if train_len is not None else self.train_length()
        out = []
        for k, f in enumerate(found):
            for n in upto[k]:
                m = scores.get((k, n), none)
                out.append({
                    "search_id": search_id, "run_key": run_key(key_columns[k], trees=n, depth=f.run.depth, hours=None),
                    "size": len(f.run.columns), "r2_score": m["r2_score"], "aicc": m["aicc"],
                    "ci95": (m["ci95"]["lo"], m["ci95"]["hi"]), "ci95_span": m["ci95_span"],
                    "input_columns": list(f.run.columns),
                    "feature_importances": [(d["importance"], d["column"]) for d in f.importances(n)],
                    "data_periodicity_hrs": [0.25],
                    "test_size": self.test_size, "random_state": self.seed, "train_length": train_len, "test_length": m["test_length"],
                    "n_estimators": n, "max_depth": f.run.depth, "knn_neighbors": None, "pls_components": None,
                })
        return out

    def _to_df(self, rows: list[dict]) -> DataFrame:
        tuples = [tuple(r[f.name] for f in RESULT_SCHEMA.fields) for r in rows]
        return self.spark.createDataFrame(tuples, RESULT_SCHEMA)

    def _forest_runs(self, search_id: str, columns: Sequence[str], runs: Iterable[tuple], nights: bool = True, piece: int = 64) -> DataFrame:
        """Forests ``(columns, trees, depth)`` of all planned runs, ``piece``
        at a time, fewer where their trees may be large (a task holds the
        trees of a piece): each piece is grown and tested together and appended to the
        store.  Runs that the store holds are not made again.  ``runs`` is
        read as it goes; with a store, finished rows are not held here."""
        known, out, planned = self.store.keys(search_id), [], set()
        table = self._table(self.usable(columns), nights)
        train_len = None if nights else table.blocks_train_length(self.flag)
        for part in _pieces(runs, piece, lambda run: _nodes(*run[1:], table.rows), PIECE_NODES):
            keys = [run_key(c, trees=t, depth=d, hours=None) for c, t, d in part]
            planned.update(keys)
            todo = [(list(c), t, d) for k, (c, t, d) in zip(keys, part) if k not in known]
            if todo:
                found = forests.fit_forests(table, [self._run([x for x in c if x not in self._empty], t, d) for c, t, d in todo])
                rows = self._rows(search_id, table, found, [c for c, _, _ in todo], train_len=train_len)
                self.store.append(self._to_df(rows))
                out += [] if self.store.path else rows
        return self._result(search_id, out, planned)

    def _result(self, search_id: str, rows: list[dict], planned: set[str]) -> DataFrame:
        """The rows of the planned runs: from the store if there is one."""
        if not self.store.path:
            return self._to_df(rows) if rows else self.spark.createDataFrame([], RESULT_SCHEMA)
        keys = self.spark.createDataFrame([(k,) for k in sorted(planned)], "run_key string")
        return self.store.stored(search_id).join(keys, "run_key", "left_semi").select(*RESULT_SCHEMA.fieldNames())

    # -- M5
    def grid_search_columns(self, columns: Sequence[str], trees: int = 100, depth: int = 6,
                            max_size: int | None = None, search_id: str = "columns", nights: bool = True) -> DataFrame:
        """Every subset of ``columns``, by size; ``nights=False`` fits and tests
        without night rows, on the same split, under a search id of its own."""
        sizes = range(1, (max_size or len(columns)) + 1)
        runs = ((list(c), trees, depth) for n in sizes for c in combinations(columns, n))
        return self._forest_runs(search_id if nights else f"{search_id}:no_nights", columns, runs, nights)

    # -- M6
    def trend_additive(self, base: Sequence[str], trends_by_column: dict[str, list[str]], trees=300, depth=12,
                       search_id: str = "trend_additive") -> DataFrame:
        """For every column, the base with one of its trends at a time; the
        runs of a column are a search of their own."""
        out = None
        columns = [*base, *dict.fromkeys(t for names in trends_by_column.values() for t in names)]
        for col, names in trends_by_column.items():
            r = self._forest_runs(f"{search_id}:{col}", columns, ((list(base) + [t], trees, depth) for t in names))
            out = r if out is None else out.unionByName(r)
        return out if out is not None else self.spark.createDataFrame([], RESULT_SCHEMA)

    # -- M7
    def grid_search_trends(self, base: Sequence[str], trends: Sequence[str], trees=300, depth=12,
                           search_id: str = "trends") -> DataFrame:
        """The base with every non-empty subset of the trends."""
        runs = ((list(base) + list(c), trees, depth) for n in range(1, len(trends) + 1) for c in combinations(trends, n))
        return self._forest_runs(search_id, [*base, *trends], runs)

    # -- M8
    def grid_search_hyper(self, columns: Sequence[str], trees_list: Sequence[int] = HYPER_TREES, depth_list: Sequence[int] = HYPER_DEPTHS,
                          search_id: str = "hyper") -> DataFrame:
        """Every pair of a number of trees and a depth.  A forest of each depth
        is grown once, with the most trees; smaller forests are its first
        trees."""
        known, out, use, planned = self.store.keys(search_id), [], self.usable(columns), set()
        table = self._table(use)
        for d in depth_list:
            todo = [t for t in trees_list if run_key(columns, trees=t, depth=d, hours=None) not in known]
            if todo:
                found = forests.fit_forests(table, [self._run(use, max(todo), d)])
                rows = self._rows(search_id, table, found, [list(columns)], [todo])
                self.store.append(self._to_df(rows))
                out += rows
            planned.update(run_key(columns, trees=t, depth=d, hours=None) for t in trees_list)
        return self._result(search_id, out, planned)

    # -- M10
    def rfe(self, columns: Sequence[str], n_keep: int = 11, step: float = 0.05, trees: int = 300,
            depth: int = 12, search_id: str = "rfe") -> DataFrame:
        """Recursive elimination: each round drops ``max(1, int(step·p0))``
        least important columns (p0 = starting count) until ``n_keep``
        remain; importances from a forest on the train part.  Returns the
        ranking ``(column, ranking)`` (1 = kept).  Columns without any value
        take no part.  Rounds that the store holds are not grown again."""
        keep = self.usable(columns)
        drop_per_round = max(1, int(step * len(keep)))
        table, known = self._table(keep), self.store.known(search_id)
        ranking: dict[str, int] = {}
        rnd = 0
        while len(keep) > n_keep:
            key = run_key(keep, trees=trees, depth=depth, hours=None)
            if key in known:
                order = [{"importance": d["importance"], "column": d["column"]} for d in known[key]["feature_importances"]]
            else:
                rows = self._rows(search_id, table, forests.fit_forests(table, [self._run(keep, trees, depth)]), [keep])
                self.store.append(self._to_df(rows))
                order = [{"importance": i, "column": c} for i, c in rows[0]["feature_importances"]]
            order.sort(key=lambda d: (d["importance"], d["column"]))
            k = min(drop_per_round, len(keep) - n_keep)
            for d in order[:k]:
                ranking[d["column"]] = rnd
                keep.remove(d["column"])
            rnd += 1
        rows = [(c, 1) for c in keep] + [(c, rnd - r + 1) for c, r in ranking.items()]
        return self.spark.createDataFrame(rows, "column string, ranking int")

    # -- M11
    def sfs(self, columns: Sequence[str], n_select: int = 11, folds: int = 5, trees: int = 300,
            depth: int = 12, search_id: str = "sfs") -> DataFrame:
        """Greedy forward selection by the mean R² over ``folds`` folds of
        the train part (by a hash of the row); all candidates and folds of a
        round are grown together.  Returns ``(round, column, mean_r2)``.
        Columns without any value take no part; candidates that the store
        holds are not grown again."""
        columns, chosen, log = self.usable(columns), [], []
        table, known = self._table(columns), self.store.known(search_id)
        fold = [tuple(x for x in range(MOST_FOLDS) if x % folds == f) for f in range(folds)]
        rest = [tuple(x for x in range(MOST_FOLDS) if x % folds != f) for f in range(folds)]
        for rnd in range(min(n_select, len(columns))):
            score, todo = {}, []
            for c in columns:
                if c not in chosen:
                    key = run_key([*chosen, c], trees=trees, depth=depth, folds=folds)
                    if key in known:
                        score[c] = known[key]["r2_score"]
                    else:
                        todo.append((c, key))
            for part in _pieces(todo, max(1, 64 // folds), lambda c: folds * _nodes(trees, depth, table.rows), PIECE_NODES):
                runs = [forests.Run((*chosen, c), trees, depth, ((self.flag, (0,)), ("__fold", rest[f])), ((self.flag, (0,)), ("__fold", fold[f])))
                        for c, _ in part for f in range(folds)]
                found = forests.fit_forests(table, runs)
                r2 = {r["run"]: r["r2_score"] for r in stats.evaluate(forests.predictions(table, found), "size", keys=["run", "size"]).collect()}
                rows = []
                for k, (c, key) in enumerate(part):
                    own = [r2.get(k * folds + f) for f in range(folds)]
                    score[c] = None if None in own else sum(own) / folds
                    rows.append({f.name: None for f in RESULT_SCHEMA.fields} | {
                        "search_id": search_id, "run_key": key, "size": rnd + 1, "r2_score": score[c], "input_columns": [*chosen, c],
                        "n_estimators": trees, "max_depth": depth, "random_state": self.seed})
                self.store.append(self._to_df(rows))
            best = max(score, key=lambda c: (score[c] if score[c] is not None else -1e300, c))
            chosen.append(best)
            log.append((rnd + 1, best, float("nan") if score[best] is None else float(score[best])))
        return self.spark.createDataFrame(log, "round int, column string, mean_r2 double")

    # -- M12 / M13 / M16
    def selected_model(self, columns: Sequence[str], trees: int = 300, depth: int = 12,
                       search_id: str = "selected") -> DataFrame:
        use = self.usable(columns)
        table = self._table(use)
        return self._to_df(self._rows(search_id, table, forests.fit_forests(table, [self._run(use, trees, depth)]), [list(columns)]))

    def best_model_series(self, columns: Sequence[str], ts: str = "ts", trees: int = 300, depth: int = 12,
                          nights: bool = False, model=None):
        """Fit (or use a loaded model, S10) and return ``(result_row,
        actual_vs_predicted, model)``; ``nights`` drops night rows from both
        parts after the shared split.  The model is Spark ML's, so that it can
        be saved and loaded."""
        columns = self.usable(columns)
        data = self.data
        if nights:
            data = timeops.exclude_nights(data, ts=ts)
        train, test = data.filter(~F.col(self.flag)), data.filter(F.col(self.flag))
        if model is None:
            model = rf.fit_forest(train, columns, self.label, trees, depth, self.seed)
        pred = rf.predict(model, test, columns)
        from .views import actual_vs_predicted
        series = actual_vs_predicted(pred, ts=ts, label=self.label)
        res = stats.evaluate(pred, len(columns), label=self.label)
        return res, series, model

    # -- M14 (PLS)
    def pls_sweep(self, columns: Sequence[str], max_components: int = 11, search_id: str = "pls") -> DataFrame:
        """One moments pass → models with 1..max_components components, each
        evaluated on the test part in one aggregate."""
        columns = self.usable(columns)
        feats = self.data.withColumn("__f", F.array(*[F.col(c).cast("double") for c in columns]))
        train, test = feats.filter(~F.col(self.flag)), feats.filter(F.col(self.flag))
        model = fit_pls(train, max_components, features="__f", label=self.label)
        # one pass over the test part: the predictions of all component counts
        each = F.array(*[F.struct(F.lit(k).alias("k"), model.prediction("__f", k).alias("p")) for k in sorted(model.coefs)])
        preds = test.select(self.label, F.explode(each).alias("__p")).select(
            F.col("__p.k").alias("pls_components"), self.label, F.col("__p.p").alias("prediction"))
        res = stats.evaluate(preds, len(columns), label=self.label, keys=["pls_components"])
        return res.withColumn("input_columns", F.array(*[F.lit(c) for c in columns]))

    # -- M14 (neighbours)
    def knn_sweep(self, columns: Sequence[str], ks: Iterable[int] = range(1, 21)) -> DataFrame:
        """One neighbour search for every ``k``: metrics on the test part.  Rows
        without a value in some column take no part."""
        columns, ks = self.usable(columns), list(ks)
        rows = self.data.dropna(subset=[*columns, self.label]).select(
            F.concat_ws("|", *[F.col(c).cast("string") for c in self.id_cols]).alias("__id"), self.label, self.flag,
            F.array(*[F.col(c).cast("double") for c in columns]).alias("__f"))
        train, test = rows.filter(~F.col(self.flag)), rows.filter(F.col(self.flag))
        pred = knn_predict(train, test, ks, features="__f", label=self.label, id_col="__id")
        pred = pred.join(test.select("__id", self.label), "__id")
        res = stats.evaluate(pred, len(columns), label=self.label, keys=["k"])
        return res.withColumnRenamed("k", "knn_neighbors").withColumn("input_columns", F.array(*[F.lit(c) for c in columns]))


def _nodes(trees: int, depth: int, rows: int) -> float:
    """Nodes that a forest of so many rows can have, about: a bootstrap draws
    five in eight of the rows, each a leaf at most."""
    return trees * min(2 ** (depth + 1), 1.3 * rows)


def _pieces(items, size: int, weight=lambda item: 0, most: int = 0):
    """Lists of at most ``size`` items that weigh at most ``most`` together
    (one item at least), read as they are asked for."""
    part, held = [], 0
    for item in items:
        if part and (len(part) == size or held + weight(item) > most):
            yield part
            part, held = [], 0
        part.append(item)
        held += weight(item)
    if part:
        yield part


def time_grouping_tests(spark: SparkSession, gridded: DataFrame, label: str, columns: Sequence[str],
                        spans_hours: Sequence[float] = GROUPING_HOURS, id_cols=("ts",), keys: Sequence[str] = (),
                        trees: int = 300, depth: int = 12, store: ResultStore | None = None,
                        search_id: str = "time_grouping", piece: int = 16) -> DataFrame:
    """M9: for every span, A2 grouping → split → forest → metrics with
    error term 2.1; result rows carry the span in ``data_periodicity_hrs``.

    All spans are grouped in one job and split by one (each span by itself);
    the forests of ``piece`` spans are grown together.  Spans that the store
    holds are not run again."""
    from .prepare import with_split
    store = store or ResultStore(spark, None)
    key = {h: run_key(list(columns), trees=trees, depth=depth, hours=float(h)) for h in spans_hours}
    known = store.known(search_id)
    rows = [{n: known[k][n] for n in RESULT_SCHEMA.fieldNames()} for k in key.values() if k in known]
    todo = [h for h in spans_hours if key[h] not in known]
    if todo:
        grouped = cut_lineage(timeops.time_groups(cut_lineage(gridded), [f"{h} hours" for h in todo], keys=keys, out="__span"))
        split = cut_lineage(with_split(grouped, list(id_cols), keys=[*keys, "__span"]))
        with ModelSearch(split, label, id_cols=id_cols, checkpoint=False) as srch:
            use = srch.usable(columns)
            table = forests.BinnedTable(split, use, label, [srch.flag, "__span"], [*keys, *id_cols], srch.seed, bins_by="__span")
            train = {r["__span"]: r["n"] for r in split.filter(~F.col(srch.flag)).groupBy("__span").agg(F.count(F.lit(1)).alias("n")).collect()}
            for part in _pieces(enumerate(todo), piece, lambda x: _nodes(trees, depth, train.get(x[0], 0)), PIECE_NODES):
                runs = [forests.Run(tuple(use), trees, depth, ((srch.flag, (0,)), ("__span", (i,))), ((srch.flag, (1,)), ("__span", (i,)))) for i, _ in part]
                made = srch._rows(search_id, table, forests.fit_forests(table, runs), [list(columns)] * len(part), error_term=2.1, train_len=0)
                for (i, h), row in zip(part, made):
                    row |= {"run_key": key[h], "data_periodicity_hrs": [float(h)], "train_length": train.get(i, 0)}
                store.append(srch._to_df(made))
                rows += made
    tuples = [tuple(r[f.name] for f in RESULT_SCHEMA.fields) for r in rows]
    return spark.createDataFrame(tuples, RESULT_SCHEMA)
