"""Ordered (window) operators, all in chunked form.

No window here is partitioned by the series key alone: see ``chunks``.
Whatever a row needs from outside its chunk is either carried through a
window over one summary row per chunk, or (for look-backs of a bounded
reach) by copying the few border rows into the neighbouring chunk
("halo") and dropping the copies afterwards.

Where a summary of all chunks goes back to the rows, the rows with their
local windows are written to the checkpoint folder once, so that the input
is read and dealt out once; the summaries alone are joined to them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import catalog
from ..functions import timefn
from ..functions.mathfn import round_half_even
from ..session import cut_lineage
from . import chunks as ch


def _cols(columns) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


# --------------------------------------------------------------------- W1
def zscore_outliers(df: DataFrame, columns, keys: Sequence[str] = (),
                    z: float = catalog.ZSCORE_LIMIT) -> DataFrame:
    """``|x - mean| / std_pop > z`` → NULL, per column over the whole
    series.  A column with any NULL or with zero spread is left as is."""
    cols = _cols(columns)
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"__m_{c}"), F.stddev_pop(c).alias(f"__s_{c}"),
                 (F.count(c) == F.count(F.lit(1))).alias(f"__full_{c}")]
    stats = df.groupBy(*keys).agg(*aggs)
    d = ch.attach(df, stats, keys)
    for c in cols:
        m, s, full = F.col(f"__m_{c}"), F.col(f"__s_{c}"), F.col(f"__full_{c}")
        outlier = full & (s > 0) & (F.abs(F.col(c) - m) / s > z)
        d = d.withColumn(c, F.when(outlier, F.lit(None)).otherwise(F.col(c)))
    return d.drop(*[x for c in cols for x in (f"__m_{c}", f"__s_{c}", f"__full_{c}")])


# --------------------------------------------------------------------- W2
def interpolate(df: DataFrame, columns, keys: Sequence[str] = (), ts: str = "ts",
                limit: int | None = None, chunk="auto", order: str | None = None) -> DataFrame:
    """Linear interpolation by row position (not by time).

    Positions follow ``order`` (default the stamp; a file-order column when
    stamps repeat).  Leading NULLs stay; trailing NULLs take the last valid
    value; with ``limit=k`` only the first k NULLs after a valid value are
    filled (with the line through the whole gap)."""
    cols = _cols(columns)
    order = order or ts
    d = ch.with_chunk(ch.with_key(df, keys), order, chunk)
    keys = ch.key_cols(keys)
    wl = ch.local_window(keys, [order])
    d = d.withColumn("__lpos", F.row_number().over(wl) - 1)
    # the next value is the last one seen from the end: a frame that reaches
    # to the end of the window would be read anew for every row
    wb = ch.local_window(keys, [F.col("__lpos").desc()])
    for i, c in enumerate(cols):
        pt = F.when(F.col(c).isNotNull(), F.struct(F.col("__lpos").alias("p"), F.col(c).cast("double").alias("v")))
        d = d.withColumn(f"__pv{i}", F.last(pt, ignorenulls=True).over(ch.upto(wl)))
        d = d.withColumn(f"__nx{i}", F.last(pt, ignorenulls=True).over(ch.upto(wb)))
    d = cut_lineage(d)                                # summaries and rows from one reading of the input
    summ_aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(cols):
        pt = F.when(F.col(c).isNotNull(), F.struct(F.col("__lpos").alias("p"), F.col(c).cast("double").alias("v")))
        summ_aggs += [F.max(pt).alias(f"__lastv{i}"), F.min(pt).alias(f"__firstv{i}")]
    summ = d.groupBy(*keys, ch.CHUNK).agg(*summ_aggs)
    wc, wcb = ch.chunk_window(keys), ch.chunk_window(keys, back=True)
    summ = summ.withColumn("__off", F.coalesce(F.sum("__n").over(ch.before(wc)), F.lit(0)).cast("bigint"))
    carry = [*keys, ch.CHUNK, "__off"]
    for i in range(len(cols)):
        glast = F.when(F.col(f"__lastv{i}").isNotNull(), F.struct(
            (F.col("__off") + F.col(f"__lastv{i}.p")).alias("p"), F.col(f"__lastv{i}.v").alias("v")))
        gfirst = F.when(F.col(f"__firstv{i}").isNotNull(), F.struct(
            (F.col("__off") + F.col(f"__firstv{i}.p")).alias("p"), F.col(f"__firstv{i}.v").alias("v")))
        summ = summ.withColumn(f"__gl{i}", glast).withColumn(f"__gf{i}", gfirst)
        summ = summ.withColumn(f"__cin{i}", F.last(f"__gl{i}", ignorenulls=True).over(ch.before(wc)))
        summ = summ.withColumn(f"__cout{i}", F.last(f"__gf{i}", ignorenulls=True).over(ch.before(wcb)))
        carry += [f"__cin{i}", f"__cout{i}"]
    d = d.join(summ.select(*carry), [*keys, ch.CHUNK], "left")
    pos = F.col("__off") + F.col("__lpos")
    for i, c in enumerate(cols):
        pv, nx = F.col(f"__pv{i}"), F.col(f"__nx{i}")
        prev = F.coalesce(F.when(pv.isNotNull(), F.struct((F.col("__off") + pv.p).alias("p"), pv.v.alias("v"))),
                          F.col(f"__cin{i}"))
        nxt = F.coalesce(F.when(nx.isNotNull(), F.struct((F.col("__off") + nx.p).alias("p"), nx.v.alias("v"))),
                         F.col(f"__cout{i}"))
        line = prev.v + (nxt.v - prev.v) * (pos - prev.p) / (nxt.p - prev.p)
        filled = F.when(prev.isNull(), F.lit(None)).when(nxt.isNull(), prev.v).otherwise(line)
        if limit is not None:
            filled = F.when(pos - prev.p <= limit, filled)
        d = d.withColumn(c, F.when(F.col(c).isNotNull(), F.col(c).cast("double")).otherwise(filled))
    drop = ["__lpos", "__off", ch.CHUNK, ch.KEY]
    for i in range(len(cols)):
        drop += [f"__pv{i}", f"__nx{i}", f"__cin{i}", f"__cout{i}"]
    return d.drop(*drop)


# ------------------------------------------------------------------ helpers
def _halo_by_time(df: DataFrame, ts: str, width, reach_us: int) -> DataFrame:
    """Home chunk of each row plus copies in the chunks up to ``reach`` later
    (rows a later row looks back to)."""
    w_us = timefn.to_micros(width)
    t = timefn.epoch_micros(ts)
    c0 = F.floor(t / F.lit(w_us))
    c1 = F.floor((t + F.lit(reach_us)) / F.lit(w_us))
    return (df.withColumn("__home", c0)
              .withColumn(ch.CHUNK, F.explode(F.sequence(c0, c1)))
              .withColumn("__t", t))


def _halo_by_pos(df: DataFrame, block: int, needed_before: int, needed_after: int) -> DataFrame:
    """Re-block rows by series position; a row at position p is copied to
    the blocks of the rows ``p-needed_before .. p+needed_after`` that read it."""
    p = F.col("__pos")
    b0 = F.floor((p - F.lit(needed_before)) / F.lit(block))
    b1 = F.floor((p + F.lit(needed_after)) / F.lit(block))
    return (df.withColumn("__home", F.floor(p / F.lit(block)))
              .withColumn("__blk", F.explode(F.sequence(F.greatest(b0, F.lit(0)), b1))))


# ------------------------------------------------------------------ W3 / W4 / J6
def trend_name(column: str, span) -> str:
    """``"{col} {interval} Trend"`` with Python interval text."""
    return f"{column} {timefn.interval_text(span)} Trend"


def trends(df: DataFrame, specs, keys: Sequence[str] = (), ts: str = "ts",
           places: int = 2, chunk="7 days", naming=trend_name) -> DataFrame:
    """``round_half_even(x - x[ts - span], places)`` per (column, span).

    No row at ``ts - span`` → 0 (the value is compared with itself); a NULL
    now or then → NULL.  All spans share one sort: the look-up is a RANGE
    frame ``[span, span] PRECEDING`` over epoch microseconds inside a chunk,
    rows within the largest span of a chunk border are copied into the next
    chunk.  Stamps must be unique per series (gridded data)."""
    specs = [(c, timefn.to_micros(s), s) for c, s in specs]
    reach = max(s for _, s, _ in specs)
    d = _halo_by_time(df, ts, chunk, reach)
    base = Window.partitionBy(*keys, ch.CHUNK).orderBy("__t")
    diffs, names = [], []
    for i, (c, s_us, s) in enumerate(specs):
        w = base.rangeBetween(-s_us, -s_us)
        prev = F.first(F.col(c)).over(w)
        seen = F.count(F.lit(1)).over(w)
        then = F.when(seen == 0, F.col(c)).otherwise(prev)
        diffs.append((F.col(c) - then).alias(f"__d{i}"))
        names.append(naming(c, s))
    # one projection for all frames (one sort), then the rounding reads the
    # materialised differences (the rounding expression uses its input
    # many times; it must not be inlined over the window expressions)
    d = d.select("*", F.array(*diffs).alias("__diffs"))
    # one higher-order call rounds all differences: the rounding expression
    # is generated once instead of once per column
    d = d.withColumn("__diffs", F.transform("__diffs", lambda v: round_half_even(v, places)))
    d = d.select(*[x for x in d.columns if x != "__diffs"],
                 *[F.col("__diffs")[i].alias(n) for i, n in enumerate(names)])
    return d.filter(F.col(ch.CHUNK) == F.col("__home")).drop(ch.CHUNK, "__home", "__t")


def trend(df: DataFrame, column: str, span, keys: Sequence[str] = (), ts: str = "ts", **kw) -> DataFrame:
    return trends(df, [(column, span)], keys, ts, **kw)


def trend_sweep(df: DataFrame, columns, hours=catalog.TREND_SWEEP_HOURS, keys: Sequence[str] = (),
                ts: str = "ts", **kw) -> DataFrame:
    """One trend column per (column, h hours)."""
    specs = [(c, f"{h} hours") for c in _cols(columns) for h in hours]
    return trends(df, specs, keys, ts, **kw)


def lag_by_time(df: DataFrame, column: str, span, keys: Sequence[str] = (), ts: str = "ts",
                out: str | None = None, chunk="7 days") -> DataFrame:
    """Value of ``column`` at exactly ``ts - span`` (NULL if no row)."""
    s_us = timefn.to_micros(span)
    d = _halo_by_time(df, ts, chunk, s_us)
    w = Window.partitionBy(*keys, ch.CHUNK).orderBy("__t").rangeBetween(-s_us, -s_us)
    d = d.withColumn(out or f"{column}_lag", F.first(F.col(column)).over(w))
    return d.filter(F.col(ch.CHUNK) == F.col("__home")).drop(ch.CHUNK, "__home", "__t")


# --------------------------------------------------------------------- W5
def running_day_sum(df: DataFrame, column: str, keys: Sequence[str] = (), ts: str = "ts",
                    out: str | None = None, chunk="auto") -> DataFrame:
    """Running sum (NULL adds 0) that restarts at every row stamped
    00:00 (a missing midnight row means no restart)."""
    out = out or f"{column}_day_sum"
    x = F.coalesce(F.col(column).cast("double"), F.lit(0.0))
    reset = ((F.hour(ts) == 0) & (F.minute(ts) == 0)).cast("int")
    d = ch.with_chunk(ch.with_key(df, keys), ts, chunk)
    keys = ch.key_cols(keys)
    wl = ch.local_window(keys, [ts])
    d = d.withColumn("__lseg", F.sum(reset).over(ch.upto(wl)))
    d = d.withColumn("__lsum", F.sum(x).over(
        Window.partitionBy(*keys, ch.CHUNK, "__lseg").orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)))
    d = cut_lineage(d)                                # summaries and rows from one reading of the input
    # one summary row per chunk: whether it restarts, and the sum after its
    # last restart (of the whole chunk if there is none); a chunk starts with
    # what the chunks since the last restart have gathered
    part = d.groupBy(*keys, ch.CHUNK, "__lseg").agg(F.sum(x).alias("__ps"))
    summ = part.groupBy(*keys, ch.CHUNK).agg(F.max("__lseg").alias("__nr"), F.max_by("__ps", "__lseg").alias("__tail"))
    wc = ch.chunk_window(keys)
    summ = summ.withColumn("__run", F.sum(F.when(F.col("__nr") > 0, 1).otherwise(0)).over(ch.upto(wc)))
    summ = summ.withColumn("__open", F.sum("__tail").over(ch.upto(Window.partitionBy(*keys, "__run").orderBy(ch.CHUNK))))
    summ = summ.withColumn("__carry", F.coalesce(F.lag("__open").over(wc), F.lit(0.0)))
    d = d.join(summ.select(*keys, ch.CHUNK, "__carry"), [*keys, ch.CHUNK], "left")
    d = d.withColumn(out, F.when(F.col("__lseg") == 0, F.col("__carry") + F.col("__lsum")).otherwise(F.col("__lsum")))
    return d.drop("__lseg", "__lsum", "__carry", ch.CHUNK, ch.KEY)


# --------------------------------------------------------------------- W6
def smooth(df: DataFrame, column: str, window: int, center: bool = False, keys: Sequence[str] = (),
           ts: str = "ts", out: str | None = None, chunk="auto", block: int = 100_000) -> DataFrame:
    """Rolling mean over ``window`` rows; NULL unless all ``window``
    values are present.  Centred even windows cover ``i-w/2 .. i+w/2-1``."""
    out = out or f"{column}_smoothed"
    lo = window // 2 if center else window - 1          # rows before
    hi = (window - 1 - window // 2) if center else 0    # rows after
    d = ch.positions(df, keys, [ts], chunk).drop("__lpos", ch.CHUNK)
    # row i reads rows i-lo .. i+hi, so row p is read by rows p-hi .. p+lo
    d = _halo_by_pos(d, block, needed_before=hi, needed_after=lo)
    w = Window.partitionBy(*keys, "__blk").orderBy("__pos").rangeBetween(-lo, hi)
    val = F.when(F.count(F.col(column)).over(w) == window, F.avg(F.col(column)).over(w))
    d = d.withColumn(out, val)
    return d.filter(F.col("__blk") == F.col("__home")).drop("__blk", "__home", "__pos")


# ------------------------------------------------------------------ W7 / W8
def minmax_scale(df: DataFrame, columns, keys: Sequence[str] = (), constant: str = "null") -> DataFrame:
    """``(x - min) / (max - min)`` over the whole table (or series).
    A constant column gives NULL (``constant='null'``) or 0 (``'zero'``)."""
    cols = _cols(columns)
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"__lo_{c}"), F.max(c).alias(f"__hi_{c}")]
    stats = df.groupBy(*keys).agg(*aggs)
    d = ch.attach(df, stats, keys)
    for c in cols:
        lo, hi = F.col(f"__lo_{c}"), F.col(f"__hi_{c}")
        scaled = F.try_divide(F.col(c) - lo, hi - lo)
        if constant == "zero":
            scaled = F.when(hi == lo, F.when(F.col(c).isNotNull(), F.lit(0.0))).otherwise(scaled)
        d = d.withColumn(c, scaled.cast("double"))
    return d.drop(*[x for c in cols for x in (f"__lo_{c}", f"__hi_{c}")])
