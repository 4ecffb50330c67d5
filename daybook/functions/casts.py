"""Text cells to typed values; a cell that cannot be read becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Plain decimal notation. Text such as 1e3 is a double but not an integer.
PLAIN_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)\s*$"

# A time of day followed by an offset or a zone.
ZONED = r":.*[-+A-Za-z]"


def to_event_time(cell: Column) -> Column:
    """Wall-clock time as written; one with an offset is turned into the session's zone."""
    zoned = cell.try_cast("timestamp").cast("timestamp_ntz")
    return F.when(cell.rlike(ZONED), zoned).otherwise(cell.try_cast("timestamp_ntz"))


def to_int(cell: Column) -> Column:
    """Integer part of a plain number (``2.7`` gives 2)."""
    truncated = F.when(cell.rlike(PLAIN_NUMBER), cell.try_cast("double").try_cast("int"))
    return F.coalesce(cell.try_cast("int"), truncated)


def tolerant(cell: Column, target: T.DataType) -> Column:
    if isinstance(target, T.StringType):
        return cell
    if isinstance(target, T.TimestampNTZType):
        return to_event_time(cell)
    if isinstance(target, T.IntegerType):
        return to_int(cell)
    return cell.try_cast(target)
