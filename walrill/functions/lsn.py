"""Log positions: text ``HEX/HEX`` on the wire, an exact decimal(20,0) for order, since the full unsigned range exceeds a long."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LSN_PATTERN = "^[0-9A-Fa-f]{1,8}/[0-9A-Fa-f]{1,8}$"
_HALF = 4294967296


def lsn_order(text: Column) -> Column:
    """The position as a number; null for what isn't one. ``0/9`` is before ``0/10``."""
    part = lambda i: F.conv(F.split_part(text, F.lit("/"), F.lit(i)), 16, 10).cast("decimal(20,0)")
    return F.when(text.rlike(LSN_PATTERN), (part(1) * _HALF + part(2)).cast("decimal(20,0)"))


def lsn_text(number: Column) -> Column:
    """The canonical text of a position: upper case, without leading zeros."""
    high = F.floor(number.cast("decimal(20,0)") / _HALF).cast("long")
    return F.concat(F.hex(high), F.lit("/"), F.hex((number.cast("decimal(20,0)") - high.cast("decimal(20,0)") * _HALF).cast("long")))


def lsn_passes(row_lsn: Column, event_lsn: Column) -> Column:
    """The row guard: an event at or after the row's position applies, and so does any on a row without a position."""
    return row_lsn.isNull() | (row_lsn <= event_lsn)


def truncate_is_stale(event_lsn: Column, watermark: Column) -> Column:
    """The table guard, with the opposite tie rule: a truncate at or before a watermark other than 0 is a replay."""
    return (watermark != 0) & (event_lsn <= watermark)
