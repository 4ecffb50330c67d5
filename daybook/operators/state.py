"""Current state of each purchase, and the daily metric over paid ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.money import line_total, total
from daybook.logs import EventLogs
from daybook.schemas import DAY, EVENT_TIME, KEY

PREFIXES = {"purchase": "purchase", "product_item": "item", "extra_info": "extra"}


def _distinct_names(name: str, df: DataFrame) -> DataFrame:
    """Date and time exist in all three logs; name each after its log."""
    prefix = PREFIXES[name]
    return df.withColumnsRenamed({c: f"{prefix}_{c}" for c in (DAY, EVENT_TIME)})


def purchase_state(latest: EventLogs) -> DataFrame:
    """One row per purchase: its latest event with its latest item and extra event.

    Left joins keep a purchase whose item or extra event has not arrived. Inputs hold one row
    per key and are already partitioned by it, so the joins add no shuffle and cannot fan out.
    """
    named = latest.map(_distinct_names)
    return named.purchase.join(named.product_item, KEY, "left").join(named.extra_info, KEY, "left")


def paid(purchases: DataFrame) -> DataFrame:
    return purchases.filter(F.col("release_date").isNotNull())


def unpaid(purchases: DataFrame) -> DataFrame:
    return purchases.filter(F.col("release_date").isNull())


def gmv_lines(state: DataFrame) -> DataFrame:
    """Paid purchases with their line value."""
    return paid(state).withColumn("gmv_value", line_total())


def daily_total(state: DataFrame) -> DataFrame:
    """Paid value per day of the latest purchase event and subsidiary."""
    return (
        paid(state)
        .groupBy(F.col(f"purchase_{DAY}").alias(DAY), "subsidiary")
        .agg(total().alias("gmv"))
    )
