"""Zone-free time expressions (all JVM-side, codegen friendly).

Stamps are TIMESTAMP_NTZ throughout.  Arithmetic on them goes through
microseconds since the NTZ epoch with ``timestampdiff`` / ``timestampadd``
so no session time zone is ever involved.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

_UNIT_US = {
    "us": 1, "microsecond": 1, "microseconds": 1,
    "ms": 1_000, "millisecond": 1_000, "milliseconds": 1_000,
    "s": 1_000_000, "sec": 1_000_000, "second": 1_000_000, "seconds": 1_000_000,
    "m": 60_000_000, "min": 60_000_000, "minute": 60_000_000, "minutes": 60_000_000,
    "h": 3_600_000_000, "hour": 3_600_000_000, "hours": 3_600_000_000,
    "d": 86_400_000_000, "day": 86_400_000_000, "days": 86_400_000_000,
}


def to_micros(span) -> int:
    """Interval as whole microseconds: timedelta, number of minutes, or text
    like ``'15 minutes'``, ``'3h'``, ``'1 day'``, ``'0.25 hours'``."""
    if isinstance(span, _dt.timedelta):
        return (span.days * 86_400 + span.seconds) * 1_000_000 + span.microseconds
    if isinstance(span, (int, float)):
        return int(round(span * 60_000_000))
    text = str(span).strip().lower()
    total = 0.0
    for num, unit in re.findall(r"([0-9]*\.?[0-9]+)\s*([a-z]+)", text):
        if unit not in _UNIT_US:
            raise ValueError(f"unknown interval unit in {span!r}")
        total += float(num) * _UNIT_US[unit]
    if total <= 0:
        raise ValueError(f"interval must be positive: {span!r}")
    return int(round(total))


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 00:00 for an NTZ stamp (BIGINT)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), c)


def from_epoch_micros(us) -> Column:
    """NTZ stamp from microseconds since the epoch."""
    c = F.col(us) if isinstance(us, str) else us
    return F.timestamp_add("MICROSECOND", c, F.expr(EPOCH_NTZ))


def floor_to_step(ts, step) -> Column:
    """Floor a stamp to a multiple of ``step`` counted from the epoch
    (for steps dividing an hour this is the step of the hour)."""
    s = to_micros(step)
    return from_epoch_micros(F.floor(epoch_micros(ts) / F.lit(s)) * F.lit(s))


def round_to_step(ts, step="15 minutes") -> Column:
    """Nearest step; a remainder of exactly half a step rounds up."""
    s = to_micros(step)
    half = s // 2
    return from_epoch_micros(F.floor((epoch_micros(ts) + F.lit(half)) / F.lit(s)) * F.lit(s))


def shift(ts, span) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_add("MICROSECOND", F.lit(to_micros(span)), c)


def micros_of_day(ts) -> Column:
    """Microseconds since midnight of the stamp's own day."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return (
        (F.hour(c).cast("bigint") * 3600 + F.minute(c) * 60) * 1_000_000
        + (F.second(c).cast("bigint") * 1_000_000)
        + F.pmod(epoch_micros(c), F.lit(1_000_000))
    )


def parse_clock(text: str) -> int:
    """``'21:30'`` / ``'07:00:00'`` → microseconds since midnight."""
    parts = [float(p) for p in text.split(":")]
    while len(parts) < 3:
        parts.append(0.0)
    h, m, s = parts
    return int(round(((h * 60 + m) * 60 + s) * 1_000_000))


def chunk_id(ts, width) -> Column:
    """Integer chunk number of a stamp for chunked ordered operators."""
    return F.floor(epoch_micros(ts) / F.lit(to_micros(width)))


def interval_text(span) -> str:
    """Python ``str(timedelta)`` spelling used in generated column names
    (``'1:00:00'``, ``'1 day, 0:00:00'``)."""
    return str(_dt.timedelta(microseconds=to_micros(span)))
