"""Durations, bins and captions on timestamps.

All timestamps are Spark ``TIMESTAMP`` in a UTC session; durations are whole microseconds.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR

# The bin sizes a report can choose, smallest first. "Auto" stands for zero.
AUTO_LABEL = "Auto"
BIN_LADDER = {
    "1sec": SECOND,
    "2sec": 2 * SECOND,
    "5sec": 5 * SECOND,
    "10sec": 10 * SECOND,
    "15sec": 15 * SECOND,
    "30sec": 30 * SECOND,
    "1min": MINUTE,
    "2min": 2 * MINUTE,
    "5min": 5 * MINUTE,
    "10min": 10 * MINUTE,
    "15min": 15 * MINUTE,
    "30min": 30 * MINUTE,
    "1hour": HOUR,
    "2hour": 2 * HOUR,
    "3hour": 3 * HOUR,
    "6hour": 6 * HOUR,
    "12hour": 12 * HOUR,
    "1day": DAY,
    "7days": 7 * DAY,
}

# The look-back periods a report can choose.
CUSTOM_PERIOD = "*custom*"
PERIODS = (
    CUSTOM_PERIOD,
    "1min",
    "5min",
    "10min",
    "30min",
    "1hour",
    "2hours",
    "4hours",
    "6hours",
    "12hours",
    "1day",
    "2days",
    "7days",
    "30days",
    "365days",
)

# The bin-count limits a report can choose.
MAX_BINS_OPTIONS = (100, 200, 500, 1000, 1500)
DEFAULT_MAX_BINS = 1000

# Singular spellings; a trailing "s" is dropped before the lookup.
_UNITS = {
    "sec": SECOND,
    "second": SECOND,
    "min": MINUTE,
    "minute": MINUTE,
    "h": HOUR,
    "hour": HOUR,
    "d": DAY,
    "day": DAY,
}

# Microseconds from Monday 0001-01-01 to 1970-01-01: makes 7-day bins start on Monday while
# every step that divides a day still starts at midnight UTC.
_MONDAY_OFFSET = 62_135_596_800 * SECOND

_LABEL = re.compile(r"(?:[A-Za-z] -)?\s*(\d+)\s*([A-Za-z]+)\s*$")


def duration(label: str | int) -> int:
    """Microseconds of a label such as ``10s``, ``6hours`` or ``2days``; 0 for ``Auto``.

    A pick-list prefix (``"a - 6hour"``) is accepted, with or without the space after the dash.
    """
    if isinstance(label, int):
        return label
    if label.strip().lower() == AUTO_LABEL.lower():
        return 0
    match = _LABEL.match(label.strip())
    unit = match and match.group(2).lower()
    if unit == "s":
        size = SECOND
    elif unit == "m":
        size = MINUTE
    else:
        size = unit and _UNITS.get(unit.removesuffix("s") or unit)
    if not size:
        raise ValueError(f"not a duration label: {label!r}")
    return int(match.group(1)) * size


def duration_us(label: Column) -> Column:
    """Column form of :func:`duration`; labels that do not parse give null."""
    text = F.lower(F.trim(label))
    number = F.regexp_extract(text, r"^(?:[a-z] -)?\s*(\d+)\s*[a-z]+$", 1)
    unit = F.regexp_extract(text, r"^(?:[a-z] -)?\s*\d+\s*([a-z]+)$", 1)
    size = F.when(unit == "s", F.lit(SECOND)).when(unit == "m", F.lit(MINUTE))
    for name, micros in _UNITS.items():
        size = size.when(unit.isin(name, name + "s"), F.lit(micros))
    micros = number.try_cast("bigint") * size
    return F.when(text == AUTO_LABEL.lower(), F.lit(0)).otherwise(micros).cast("bigint")


def step_us(step: str | int | Column) -> Column:
    return step if isinstance(step, Column) else F.lit(duration(step)).cast("bigint")


def time_bin(timestamp: Column, step: str | int | Column) -> Column:
    """Start of the bin that holds ``timestamp``."""
    us = F.unix_micros(timestamp)
    return F.timestamp_micros(us - F.pmod(us + F.lit(_MONDAY_OFFSET), step_us(step)))


def window_offset(step: str | int) -> str:
    """``startTime`` that makes ``F.window`` agree with :func:`time_bin`."""
    return f"{-_MONDAY_OFFSET % duration(step)} microseconds"


def literal(moment: datetime | str) -> Column:
    """A timestamp literal; folds at planning time, so filters on it reach the scan."""
    if isinstance(moment, str):
        moment = datetime.fromisoformat(moment)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp")


def choose_step(span_us: int, label: str = AUTO_LABEL, max_bins: int = DEFAULT_MAX_BINS) -> int:
    """Smallest ladder step not below the requested one that needs at most ``max_bins`` bins."""
    wanted = duration(label)
    for size in BIN_LADDER.values():
        if size >= wanted and -(-span_us // size) <= max_bins:
            return size
    return BIN_LADDER["7days"]


def choose_step_column(span_us: str, wanted_us: int, max_bins: int) -> Column:
    """Column form of :func:`choose_step` for the span in a column: one CASE over the ladder."""
    fits = [
        f"WHEN {size} >= {wanted_us} AND ceil({span_us} / {size}) <= {max_bins} THEN {size}L"
        for size in BIN_LADDER.values()
    ]
    return F.expr(f"CASE {' '.join(fits)} ELSE {BIN_LADDER['7days']}L END")


def step_label(step_us: str) -> Column:
    """Label of the bin size in a column."""
    labels = [f"WHEN {size} THEN '{name}'" for name, size in BIN_LADDER.items()]
    return F.expr(f"CASE {step_us} WHEN 0 THEN '{AUTO_LABEL}' {' '.join(labels)} END")


def period_label(start: Column, end: Column) -> Column:
    """Caption ``yyyy-MM-ddTHH:mm:ss - yyyy-MM-ddTHH:mm:ss`` with whole seconds."""
    pattern = "yyyy-MM-dd'T'HH:mm:ss"
    whole = [F.date_format(F.date_trunc("second", side), pattern) for side in (start, end)]
    return F.concat(whole[0], F.lit(" - "), whole[1])
