"""Pairing feeds on a common time spine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import timefn
from ..functions.mathfn import round_half_even
from . import chunks as ch
from .timeops import QUARTER, spine


def feed_bounds(df: DataFrame, keys: Sequence[str] = (), ts: str = "ts", order: str | None = None,
                first: str = "first_ts", last: str = "last_ts") -> DataFrame:
    """Stamp of the first and the last row in file order (``order``; the
    stamp itself when the feed has no separate order column)."""
    order = order or ts
    return df.groupBy(*keys).agg(F.min_by(ts, F.col(order)).alias(first),
                                 F.max_by(ts, F.col(order)).alias(last))


def common_range(a: DataFrame, b: DataFrame, keys: Sequence[str] = (), ts: str = "ts",
                 order_a: str | None = None, order_b: str | None = None,
                 mode: str = "intersect") -> DataFrame:
    """``start``/``end`` of two feeds: the later first row and the
    earlier last row (``mode='union'``: earlier first, later last)."""
    ra = feed_bounds(a, keys, ts, order_a, "__fa", "__la")
    rb = feed_bounds(b, keys, ts, order_b, "__fb", "__lb")
    pick_start, pick_end = (F.greatest, F.least) if mode == "intersect" else (F.least, F.greatest)
    r = ch.attach(ra, rb, keys)
    return r.select(*keys, pick_start("__fa", "__fb").alias("start"), pick_end("__la", "__lb").alias("end"))


def keep_forward(df: DataFrame, keys: Sequence[str] = (), ts: str = "ts", order: str | None = None,
                 chunk="auto") -> DataFrame:
    """The rows a forward-only cursor over the file can ever match: those
    whose stamp is later than every earlier row's stamp (duplicates,
    backward jumps and their repeats are skipped; the first of equal stamps
    wins).  Prefix maximum computed chunk-wise along ``order``."""
    order = order or ts
    d = ch.with_chunk(ch.with_key(df, keys), order, chunk)
    keys = ch.key_cols(keys)
    wl = ch.local_window(keys, [order])
    d = d.withColumn("__pm", F.max(ts).over(ch.before(wl)))
    summ = d.groupBy(*keys, ch.CHUNK).agg(F.max(ts).alias("__cm"))
    summ = summ.withColumn("__carry", F.max("__cm").over(ch.before(ch.chunk_window(keys))))
    d = d.join(summ.select(*keys, ch.CHUNK, "__carry"), [*keys, ch.CHUNK], "left")
    bar = F.greatest(F.col("__pm"), F.col("__carry"))
    return d.filter(bar.isNull() | (F.col(ts) > bar)).drop("__pm", "__carry", ch.CHUNK, ch.KEY)


def pair_on_spine(base: DataFrame, side: DataFrame, keys: Sequence[str] = (), ts: str = "ts",
                  order: str | None = None, chunk="auto") -> DataFrame:
    """Forward-cursor pairing = keep_forward + left equi-join on
    ``(keys, ts)``; spine rows without a match get NULL side columns."""
    kept = keep_forward(side, keys, ts, order, chunk)
    if order and order != ts:
        kept = kept.drop(order)
    return ch.join_on_keys(base, kept, keys, [ts])


def combine(a: DataFrame, b: DataFrame, keys: Sequence[str] = (), ts: str = "ts",
            order_a: str | None = None, order_b: str | None = None, step=QUARTER,
            mode: str = "intersect", record_number: str = "record_number", chunk="auto") -> DataFrame:
    """Common range → spine with record numbers → pair both feeds.
    Side columns must not collide (rename before).  Stale record numbers of
    the inputs are dropped."""
    a = a.drop(record_number)
    b = b.drop(record_number)
    rng = common_range(a, b, keys, ts, order_a, order_b, mode)
    sp = spine(rng, keys, step=step, ts=ts, record_number=record_number)
    out = pair_on_spine(sp, a, keys, ts, order_a, chunk)
    return pair_on_spine(out, b, keys, ts, order_b, chunk)


def lookup_hourly(df: DataFrame, aux: DataFrame, value: str, ts: str = "ts", aux_ts: str = "ts",
                  out: str | None = None, places: int = 3, keys: Sequence[str] = ()) -> DataFrame:
    """Per row the aux value of the same date and hour, rounded
    half-even to ``places``; NULL when the hour has none.  Two aux rows in
    one hour raise an error (checked inside the aggregate, no extra job)."""
    hour = timefn.floor_to_step(aux_ts, "1 hour")
    per_hour = aux.groupBy(*keys, hour.alias("__hour")).agg(
        F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("two auxiliary rows in one hour")))
        .otherwise(round_half_even(F.first(value), places)).alias(out or value)
    )
    d = df.withColumn("__hour", timefn.floor_to_step(ts, "1 hour"))
    return ch.join_on_keys(d, per_hour, keys, ["__hour"]).drop("__hour")


def pair_all(weather: DataFrame, counts: DataFrame, pairs: DataFrame, weather_key: str,
             count_key: str, ts: str = "ts", order_w: str | None = None, order_c: str | None = None,
             step=QUARTER) -> DataFrame:
    """All requested (station, monitor) pairings in one job.

    ``pairs`` lists the combinations to build (the batch list); each feed is
    tagged with the pairings it takes part in by an equi-join on its own id,
    then one ``combine`` keyed by both ids builds every pairing at once."""
    keys = [weather_key, count_key]
    w = ch.join_on_keys(weather, pairs, [weather_key], how="inner")
    c = ch.join_on_keys(counts, pairs, [count_key], how="inner")
    return combine(w, c, keys, ts, order_w, order_c, step)
