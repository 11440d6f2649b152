"""Timestamp helpers (H4, H8). All timestamps are TIMESTAMP_NTZ."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recspark.schemas import HEADER_TS_FORMAT


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts) -> Column:
    """Whole seconds since 1970 for a TIMESTAMP_NTZ, independent of the session zone."""
    return F.unix_timestamp(col_(ts))


def add_seconds(ts, seconds) -> Column:
    """``ts + seconds`` (H8); seconds may carry microsecond fractions. Stays NTZ."""
    secs = seconds if isinstance(seconds, Column) else F.lit(seconds)
    return col_(ts) + F.make_dt_interval(secs=secs.cast("decimal(18,6)"))


def parse_ts(text, fmt: str = HEADER_TS_FORMAT) -> Column:
    """Parse ``yyyy-MM-dd HH:mm:ss`` with an optional fraction (H4).

    Unparseable text (for example month 96) gives NULL, never an error.
    """
    return F.try_to_timestamp(col_(text), F.lit(fmt)).cast("timestamp_ntz")
