"""Column builders for long (64-bit) column names and timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_long(text: Column) -> Column:
    """Strict decimal parse, null when the text is no long.

    The pattern is needed beside ``try_cast``, which would accept blanks around
    the digits; ``try_cast`` settles the range.
    """
    return F.when(text.rlike(r"^[+-]?[0-9]+\z"), text.try_cast("bigint"))


def long_to_bytes(value: Column) -> Column:
    """Eight bytes, big-endian, two's complement."""
    return F.unhex(F.lpad(F.hex(value), 16, "0"))


def bytes_to_long(value: Column) -> Column:
    return F.conv(F.hex(value), 16, -10).cast("bigint")


def resolve_ts(parsed: Column | None, load_ts: int | None) -> Column:
    """The parsed timestamp, else the load time; microseconds since the epoch.

    Without ``load_ts`` the clock is read once per query.
    """
    now = (
        F.lit(load_ts).cast("bigint")
        if load_ts is not None
        else F.unix_micros(F.current_timestamp())
    )
    return now if parsed is None else F.coalesce(parsed, now)
