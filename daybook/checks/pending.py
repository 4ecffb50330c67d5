"""Keys without a partner, carried from run to run with the day they were first seen."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.schemas import DAY, KEY

FIRST_DAY = "first_day"
PENDING = f"{KEY} STRING, events LONG, {FIRST_DAY} DATE"


def carry_unmatched(
    pending: DataFrame | None, fresh: DataFrame, fresh_other: DataFrame, known_other: DataFrame | None = None
) -> DataFrame:
    """``purchase_id, events, first_day`` of all keys that the other log still lacks.

    ``pending`` is what the run before gave, ``fresh`` and ``fresh_other`` are events that have come
    since, and ``known_other`` has the keys that the other log had before (a snapshot will do). Only what
    is pending and what is new is grouped; of history the keys of fresh events are looked up. The result is
    that of joining both logs whole. A key may be late on either side, in any order. Null keys match
    nothing.
    """
    counted = fresh.groupBy(KEY).agg(F.count(F.lit(1)).alias("events"), F.min(DAY).alias(FIRST_DAY))
    if known_other is not None:
        counted = counted.join(known_other.select(KEY), KEY, "left_anti")
    if pending is not None:
        every = counted.unionByName(pending).groupBy(KEY)
        counted = every.agg(F.sum("events").alias("events"), F.min(FIRST_DAY).alias(FIRST_DAY))
    return counted.join(fresh_other.select(KEY).distinct(), KEY, "left_anti").select(KEY, "events", FIRST_DAY)


def overdue(pending: DataFrame, day: date, days: int) -> DataFrame:
    """Keys that have lacked their partner for more than ``days`` days on ``day``, with their age."""
    age = F.date_diff(F.lit(day), F.col(FIRST_DAY))
    return pending.withColumn("age", age).filter(F.col("age") > days)
