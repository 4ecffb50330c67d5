"""Figures to watch between runs."""

from __future__ import annotations

from datetime import date
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.logs import EventLogs
from daybook.schemas import DAY, EVENT_TIME, KEY

DROP_ALERT = 0.2  # fixed value: alert when a day loses more than this share


def rows_per_day(df: DataFrame) -> DataFrame:
    return df.groupBy(DAY).agg(F.count(F.lit(1)).alias("row_count"))


def freshness(logs: EventLogs) -> DataFrame:
    """Newest event time per table."""
    newest = [
        df.agg(F.max(EVENT_TIME).alias("newest_event")).select(
            F.lit(name).alias("table_name"), "newest_event"
        )
        for name, df in logs.items()
    ]
    return reduce(DataFrame.unionByName, newest)


def duplicates(logs: EventLogs) -> DataFrame:
    """Events, purchases and events superseded by a newer one, per table."""

    def count(name: str, df: DataFrame) -> DataFrame:
        per_key = df.groupBy(KEY).agg(F.count(F.lit(1)).alias("n"))
        return per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("events"), F.count(F.lit(1)).alias("purchases")
        ).select(
            F.lit(name).alias("table_name"),
            "events",
            "purchases",
            (F.col("events") - F.col("purchases")).alias("superseded"),
        )

    return reduce(DataFrame.unionByName, [count(name, df) for name, df in logs.items()])


def daily_delta(gold: DataFrame) -> DataFrame:
    """Change of each subsidiary against its preceding row."""
    before = F.lag("gmv").over(Window.partitionBy("subsidiary").orderBy(DAY))
    return gold.withColumn("previous_gmv", before).withColumn(
        "delta", F.round(F.col("gmv") - F.col("previous_gmv"), 2)
    )


def gmv_drops(gold: DataFrame, share: float = DROP_ALERT, last: date | None = None) -> DataFrame:
    """Days whose total fell by more than ``share`` against the calendar day before.

    A day between the first and the last of ``gold`` that has no rows, or only NULL amounts, counts
    as 0: no sales are the largest drop. ``last`` is given where ``gold`` goes on beyond the rows here. Amounts are compared as decimals, so that a fall by exactly
    the share is none.

    Each day's total is added under its own date and, as the previous day, under the next one;
    one grouped sum then holds both. No self-join, no window over all days in one task.
    """
    amount = F.coalesce(F.col("gmv").cast("decimal(28,2)"), F.lit(Decimal(0)))
    per_day = gold.filter(F.col(DAY).isNotNull()).groupBy(DAY).agg(F.sum(amount).alias("total"))
    last = per_day.agg(F.max(DAY)).scalar() if last is None else F.lit(last)
    none = F.lit(None).cast("decimal(38,2)")
    both = F.array(
        F.struct(F.col(DAY), F.col("total").alias("gmv"), none.alias("previous_gmv")),
        F.struct(
            F.date_add(DAY, 1).alias(DAY), none.alias("gmv"), F.col("total").alias("previous_gmv")
        ),
    )
    kept = F.lit(1 - Decimal(str(share))).cast("decimal(10,6)")
    gmv = F.coalesce(F.max("gmv"), F.lit(Decimal(0)))
    days = per_day.select(F.inline(both)).groupBy(DAY)
    days = days.agg(gmv.alias("gmv"), F.max("previous_gmv").alias("previous_gmv"))
    fallen = (F.col("previous_gmv") > 0) & (F.col("gmv") < kept * F.col("previous_gmv"))
    return days.filter(fallen & (F.col(DAY) <= last)).select(
        DAY, F.col("gmv").cast("double"), F.col("previous_gmv").cast("double")
    )
