"""Wall-clock times without a detour through the session's time zone.

A TIMESTAMP_NTZ cast to TIMESTAMP is read in the session's zone, where some wall-clock
hours do not exist. Event-time windows need a TIMESTAMP, so wall-clock times are taken
as UTC there and turned back afterwards; real instants pass unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NTZ = "timestamp_ntz"
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def as_instant(name: str, kind: str) -> Column:
    """The column as a TIMESTAMP for windows and watermarks."""
    if kind != NTZ:
        return F.col(name).cast("timestamp")
    return F.expr(f"timestamp_micros(timestampdiff(MICROSECOND, {_EPOCH}, `{name}`))")


def from_instant(name: str, kind: str) -> Column:
    """The inverse of ``as_instant``."""
    if kind != NTZ:
        return F.col(name)
    return F.expr(f"timestampadd(MICROSECOND, unix_micros({name}), {_EPOCH})")


def hour_of(name: str, kind: str) -> Column:
    """The start of the hour, in the column's own type."""
    if kind != NTZ:
        return F.date_trunc("hour", name)
    parts = [part(name) for part in (F.year, F.month, F.day, F.hour)]
    return F.make_timestamp_ntz(*parts, F.lit(0), F.lit(0))
