"""Timestamp parsing and truncation that keep the input's time type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType


def parse_timestamp(col: Column | str, patterns: tuple[str, ...] | list[str], ts_type: str = "timestamp") -> Column:
    """Strict parse: the first pattern that matches wins, otherwise NULL.

    ``try_to_timestamp`` never raises under ANSI mode, so a bad string only
    becomes NULL (and is then routed to quarantine by the caller). With
    ``ts_type="timestamp_ntz"`` the result is the zone-free wall clock.
    """
    c = F.col(col) if isinstance(col, str) else col
    tries = [F.try_to_timestamp(c, F.lit(p)) for p in patterns]
    out = tries[0] if len(tries) == 1 else F.coalesce(*tries)
    return out.cast("timestamp_ntz") if ts_type == "timestamp_ntz" else out


def truncate(col: Column | str, unit: str, dtype: DataType | None = None) -> Column:
    """``date_trunc`` that returns TIMESTAMP_NTZ for an NTZ input.

    ``date_trunc`` always yields a session-zone TIMESTAMP; for a wall-clock
    (NTZ) column the cast back restores the wall-clock value.
    """
    c = F.col(col) if isinstance(col, str) else col
    out = F.date_trunc(unit, c)
    if isinstance(dtype, TimestampNTZType):
        out = out.cast("timestamp_ntz")
    return out
