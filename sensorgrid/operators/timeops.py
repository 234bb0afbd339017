"""Time-grid operators: shift, round, parse, slice, spine, gap report,
anchored time grouping."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import catalog
from ..functions import mathfn, timefn
from . import chunks as ch

QUARTER = "15 minutes"


def shift_time(df: DataFrame, minutes=54, ts: str = "ts", out: str | None = None) -> DataFrame:
    """Move every stamp by a fixed span (a clock that ran behind)."""
    return df.withColumn(out or ts, timefn.shift(ts, minutes))


def round_time(df: DataFrame, step=QUARTER, ts: str = "ts", out: str | None = None) -> DataFrame:
    """Nearest step of the hour; exactly half a step rounds up."""
    return df.withColumn(out or ts, timefn.round_to_step(ts, step))


# Fixed value: count files are named ``<8 chars><id>-<YYYY-mm-dd_HH-MM-SS>...``.
FILE_KEY_PATTERN = r"^.{8}([^-]*)-(\d{4}-\d{2}-\d{2}_\d{2}-\d{2})"


def parse_file_key(df: DataFrame, name_col: str = "file_name",
                   id_out: str = "monitor_id", ts_out: str = "ts") -> DataFrame:
    """Monitor id (``_`` → ``.``, kept as text) and minute stamp from a
    count-file name; the seconds are set to 00.  Unparseable → NULL."""
    base = F.regexp_extract(F.col(name_col), r"([^/]*)$", 1)
    ident = F.regexp_extract(base, FILE_KEY_PATTERN, 1)
    stamp = F.regexp_extract(base, FILE_KEY_PATTERN, 2)
    return df.withColumn(id_out, F.translate(ident, "_", ".")).withColumn(
        ts_out,
        F.try_to_timestamp(F.nullif(stamp, F.lit("")), F.lit("yyyy-MM-dd_HH-mm")).cast("timestamp_ntz"),
    )


def drop_off_grid(df: DataFrame, step_minutes: int = 15, ts: str = "ts",
                  observation: Observation | None = None) -> DataFrame:
    """Keep records whose minute is a multiple of the step.  The number
    of discarded records is reported through an ``Observation`` (no extra
    job: it rides on whatever action runs the plan)."""
    on_grid = (F.minute(ts) % step_minutes) == 0
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("rows_in"),
                        F.sum(F.when(~on_grid | F.col(ts).isNull(), 1).otherwise(0)).alias("discarded"))
    return df.filter(on_grid)


# Resolutions of a partial stamp: pattern, what completes it, its length.
PARTIAL_STAMPS = (
    (r"\d{4}", "-01-01 00:00:00", "1 year"),
    (r"\d{4}-\d{2}", "-01 00:00:00", "1 month"),
    (r"\d{4}-\d{2}-\d{2}", " 00:00:00", "1 day"),
    (r"\d{4}-\d{2}-\d{2}[ T]\d{2}", ":00:00", "1 hour"),
    (r"\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}", ":00", "1 minute"),
    (r"\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}", "", "1 second"),
)


def _stamp_span(text: str) -> tuple[F.Column, F.Column | None]:
    """First instant of a (partial) stamp and the first instant after it
    (None for a stamp with fractions, which is an instant)."""
    for pattern, rest, length in PARTIAL_STAMPS:
        if re.fullmatch(pattern, text):
            first = F.lit(text + rest).cast("timestamp_ntz")
            return first, first + F.expr(f"interval {length}")
    return F.lit(text).cast("timestamp_ntz"), None


def time_range(df: DataFrame, spec: str | None, ts: str = "ts") -> DataFrame:
    """``"start,end"`` slice, both ends inclusive.  A partial end (year,
    month, day, hour, minute, second) covers all of it, a partial start begins
    with its first instant (label-slice semantics)."""
    if not spec:
        return df
    start, _, end = (p.strip() for p in spec.partition(","))
    cond = F.lit(True)
    if start:
        cond = cond & (F.col(ts) >= _stamp_span(start)[0])
    if end:
        last, after = _stamp_span(end)
        cond = cond & (F.col(ts) <= last if after is None else F.col(ts) < after)
    return df.filter(cond)


def exclude_nights(df: DataFrame, night_start: str = catalog.NIGHT_START_MODEL,
                   night_end: str = catalog.NIGHT_END, ts: str = "ts") -> DataFrame:
    """Keep ``night_end <= time of day < night_start``."""
    tod = timefn.micros_of_day(ts)
    return df.filter((tod >= timefn.parse_clock(night_end)) & (tod < timefn.parse_clock(night_start)))


def add_month_hour(df: DataFrame, ts: str = "ts", month: str = "month", hour: str = "hour") -> DataFrame:
    """P9."""
    return df.withColumn(month, F.month(ts)).withColumn(hour, F.hour(ts))


def spine(ranges: DataFrame, keys: Sequence[str] = (), start: str = "start", end: str = "end",
          step=QUARTER, ts: str = "ts", record_number: str | None = "record_number",
          block: int = 10_000) -> DataFrame:
    """J2 + P13: every step from start to end (inclusive) per key, with the
    1-based record number computed from the step index (no window)."""
    s = timefn.to_micros(step)
    st = timefn.epoch_micros(F.col(start))
    n = F.floor((timefn.epoch_micros(F.col(end)) - st) / F.lit(s))
    d = ranges.select(*keys, st.alias("__st"), n.alias("__n")).filter(F.col("__n") >= 0)
    # two-level generation: one row per block of `block` steps, spread over
    # the cluster, then the steps of each block; a long range never becomes
    # one task's job (the partition count is explicit, so AQE keeps it)
    d = d.select(*keys, "__st", "__n", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.floor(F.col("__n") / F.lit(block)))).alias("__b"))
    d = d.repartition(d.sparkSession.sparkContext.defaultParallelism, *keys, "__b")
    d = d.select(*keys, "__st", F.explode(F.sequence(
        F.col("__b") * F.lit(block), F.least(F.col("__n"), (F.col("__b") + 1) * F.lit(block) - 1))).alias("__i"))
    cols = [*keys, timefn.from_epoch_micros(F.col("__st") + F.col("__i") * F.lit(s)).alias(ts)]
    if record_number:
        cols.append((F.col("__i") + 1).alias(record_number))
    return d.select(*cols)


def gap_report(df: DataFrame, keys: Sequence[str] = (), ts: str = "ts", order: str | None = None,
               step=QUARTER, chunk="auto") -> DataFrame:
    """Over consecutive rows (``order``, default the stamp itself) count
    steps ``<= 0`` as duplicates and steps ``> step`` as gaps.

    Chunk-wise: in-chunk lags are summed per chunk; the one step across each
    chunk border comes from a lag over the chunk summaries."""
    order = order or ts
    s = timefn.to_micros(step)
    d = ch.with_chunk(df.select(*keys, ts, *([order] if order != ts else [])), order, chunk)
    ocols = [order] if order == ts else [order, ts]
    w = ch.local_window(keys, ocols)
    diff = timefn.epoch_micros(ts) - timefn.epoch_micros(F.lag(ts).over(w))
    d = d.withColumn("__d", diff)
    summ = d.groupBy(*keys, ch.CHUNK).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.when(F.col("__d") <= 0, 1).otherwise(0)).alias("__dup"),
        F.sum(F.when(F.col("__d") > s, 1).otherwise(0)).alias("__gap"),
        F.min_by(ts, F.struct(*ocols)).alias("__first"),
        F.max_by(ts, F.struct(*ocols)).alias("__last"),
    )
    border = timefn.epoch_micros("__first") - timefn.epoch_micros(F.lag("__last").over(ch.chunk_window(keys)))
    summ = summ.withColumn("__b", border)
    return summ.groupBy(*keys).agg(
        F.sum("n_rows").cast("bigint").alias("n_rows"),
        (F.sum("__dup") + F.sum(F.when(F.col("__b") <= 0, 1).otherwise(0))).cast("bigint").alias("duplicates"),
        (F.sum("__gap") + F.sum(F.when(F.col("__b") > s, 1).otherwise(0))).cast("bigint").alias("gaps"),
    )


def _agg_for(name: str, ts: str, normalized: bool, policy: Mapping[str, str] | None):
    info = catalog.info_for(name)
    rule = (policy or {}).get(name, info.agg)
    places = None if normalized else info.decimals
    c = F.col(name)
    if rule == "circular_mean":
        return mathfn.round_half_even(mathfn.circular_mean(c), places).alias(name)
    if rule == "last":
        return F.max_by(c, F.col(ts)).alias(name)
    if rule == "max":
        return F.max(c).alias(name)
    if rule == "min":
        return F.min(c).alias(name)
    if rule == "sum":
        return F.sum(c).alias(name)
    return mathfn.round_half_even(F.avg(c), places).alias(name)


def time_groups(df: DataFrame, spans: Sequence, keys: Sequence[str] = (), ts: str = "ts",
                columns: Sequence[str] | None = None, normalized: bool = True,
                policy: Mapping[str, str] | None = None, base_step=QUARTER, out: str = "span") -> DataFrame:
    """A2 for many spans at once: the rows of ``time_group`` for every span,
    with the span's number (place in ``spans``) as column ``out``.

    Each row meets each span's group in the task that reads it, where the
    groups' mergeable states (sums, counts, unit vectors, last, greatest) are
    kept; one shuffle brings the states of all spans together.  A span of the
    base step passes the rows on as they are."""
    micros = [timefn.to_micros(s) for s in spans]
    base = timefn.to_micros(base_step)
    if micros and min(micros) < base:
        raise ValueError("the smallest grouping span is the base step")
    drop = set(catalog.id_columns(df.columns))
    if columns is None:
        columns = [c for c in df.columns if c not in set(keys) | {ts} | drop]
    bounds = df.groupBy(*keys).agg(F.min(ts).alias("__start"), F.max(ts).alias("__lastts"))
    bounds = bounds.select(*keys, timefn.epoch_micros("__start").alias("__st"), timefn.epoch_micros("__lastts").alias("__last"))
    d = ch.attach(df.select(*keys, ts, *columns), bounds, keys)
    t_us, st_us = timefn.epoch_micros(ts), F.col("__st")
    day = F.lit(86_400_000_000)

    sp = F.col("__g.span")
    b0 = st_us + sp
    # zone-free: days are counted on the NTZ epoch
    b0 = F.when(F.floor(b0 / day) != F.floor(st_us / day), F.floor(b0 / day) * day).otherwise(b0)
    e = F.col("__b0") + (F.floor((t_us - F.col("__b0")) / sp) + 1) * sp
    each = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(us).alias("span")) for i, us in enumerate(micros) if us != base])
    aggs = [_agg_for(c, ts, normalized, policy) for c in columns]
    names = [*keys, out, ts, *columns]
    made = [df.select(*keys, F.lit(i).alias(out), ts, *columns) for i, sp in enumerate(micros) if sp == base]
    if len(made) < len(micros):
        d = d.withColumn("__g", F.explode(each)).withColumn("__b0", b0).withColumn("__e", e)
        d = d.filter((F.col("__e") <= F.col("__last")) & (t_us <= F.col("__e") - F.lit(60_000_000)))
        grouped = d.groupBy(*keys, F.col("__g.i").alias(out), "__e").agg(*aggs)
        made.append(grouped.withColumn("__stamp", timefn.from_epoch_micros(F.col("__e") - F.lit(base)))
                    .select(*keys, out, F.col("__stamp").alias(ts), *columns))
    result = made[0]
    for m in made[1:]:
        result = result.unionByName(m)
    return result.select(*names)


def time_group(df: DataFrame, span, keys: Sequence[str] = (), ts: str = "ts",
               columns: Sequence[str] | None = None, normalized: bool = True,
               policy: Mapping[str, str] | None = None, base_step=QUARTER) -> DataFrame:
    """A2: anchored tumbling groups with a per-column aggregation policy.

    Per series: ``start`` = first stamp, ``b0 = start + span`` cut back to
    midnight when it falls on a later day; group ``k = floor((ts-b0)/span)``
    ends at ``e = b0 + (k+1)·span`` and takes rows ``e-span <= ts <= e-1min``
    (first group: from ``start``); groups ending after the last stamp are
    dropped; output stamp ``e - 15 min``.  ``span`` = base step is identity.
    """
    sp = timefn.to_micros(span)
    base = timefn.to_micros(base_step)
    if sp == base:
        return df
    if sp < base:
        raise ValueError("the smallest grouping span is the base step")
    drop = set(catalog.id_columns(df.columns))
    if columns is None:
        columns = [c for c in df.columns if c not in set(keys) | {ts} | drop]
    bounds = df.groupBy(*keys).agg(F.min(ts).alias("__start"), F.max(ts).alias("__lastts"))
    st_us = timefn.epoch_micros("__start")
    b0_us = st_us + F.lit(sp)
    day = 86_400_000_000
    # zone-free: days are counted on the NTZ epoch
    cut = F.when(F.floor(b0_us / F.lit(day)) != F.floor(st_us / F.lit(day)),
                 F.floor(b0_us / F.lit(day)) * F.lit(day)).otherwise(b0_us)
    bounds = bounds.select(*keys, cut.alias("__b0"), timefn.epoch_micros("__lastts").alias("__last"))
    d = ch.attach(df.select(*keys, ts, *columns), bounds, keys)
    t_us = timefn.epoch_micros(ts)
    k = F.floor((t_us - F.col("__b0")) / F.lit(sp))
    e = F.col("__b0") + (k + 1) * F.lit(sp)
    d = d.withColumn("__e", e).filter(
        (F.col("__e") <= F.col("__last")) & (t_us <= F.col("__e") - F.lit(60_000_000))
    )
    aggs = [_agg_for(c, ts, normalized, policy) for c in columns]
    out = d.groupBy(*keys, "__e").agg(*aggs)
    return out.select(*keys, timefn.from_epoch_micros(F.col("__e") - F.lit(base)).alias(ts), *columns)
