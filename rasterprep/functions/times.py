"""Run-profile time stamps (P33): epoch seconds <-> ISO-8601 / log-line strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOG_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def log_time(ts: Column | str) -> Column:
    """``%Y-%m-%d %H:%M:%S`` text of a timestamp (log lines)."""
    return F.date_format(_col(ts), LOG_FORMAT)


def iso_time(ts: Column | str) -> Column:
    """ISO-8601 text like Python's ``isoformat()``: microseconds only when non-zero."""
    c = _col(ts)
    return F.when(F.date_format(c, "SSSSSS") == "000000", F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")) \
        .otherwise(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def parse_time(text: Column | str) -> Column:
    """Read side: ISO-8601 or log-line text -> timestamp; NULL when unparsable."""
    c = _col(text)
    return F.coalesce(F.try_to_timestamp(c), F.try_to_timestamp(c, F.lit(LOG_FORMAT)))


def from_epoch(seconds: Column | str) -> Column:
    """Epoch seconds (double) -> timestamp."""
    return F.timestamp_micros((_col(seconds) * F.lit(1_000_000)).cast("long"))
