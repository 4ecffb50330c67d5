"""Figures from sketches that are stored per day or month and merged, in place of reading history again."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.logs import EventLogs
from daybook.schemas import DAY, KEY

# Choices of this library. Registers of a distinct sketch (two to this power, a standard error of 1.6 %),
# and items that a quantile sketch keeps; below so many it is exact.
LG_REGISTERS = 12
QUANTILE_ITEMS = 4096
# A day is an outlier beyond so many spreads from the median of its weekday, of which there have to be
# so many days. A spread is the distance of the quartiles, scaled to that of a normal deviation.
OUTLIER_SPREADS = 3.0
OUTLIER_MIN_DAYS = 8
QUARTILES_PER_DEVIATION = 1.349


def day_sketches(logs: EventLogs) -> DataFrame:
    """``table_name, transaction_date, events, keys``: per table and day the events and a sketch of their
    purchases. One row a day, from partial sketches of each task, so that a day may be of any size."""
    parts = [
        df.filter(F.col(KEY).isNotNull())
        .groupBy(DAY)
        .agg(F.count(F.lit(1)).alias("events"), F.hll_sketch_agg(KEY, F.lit(LG_REGISTERS)).alias("keys"))
        .select(F.lit(name).alias("table_name"), DAY, "events", "keys")
        for name, df in logs.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def estimated_duplicates(sketches: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    """``table_name, events, purchases, superseded`` over the days from ``first`` to ``last``, both
    included: events are exact, purchases estimated from the merged sketches."""
    if first is not None:
        sketches = sketches.filter(F.col(DAY) >= F.lit(first))
    if last is not None:
        sketches = sketches.filter(F.col(DAY) <= F.lit(last))
    merged = sketches.groupBy("table_name").agg(
        F.sum("events").alias("events"), F.hll_sketch_estimate(F.hll_union_agg("keys")).alias("purchases"))
    purchases = F.least("purchases", "events")
    return merged.select("table_name", "events", purchases.alias("purchases"), (F.col("events") - purchases).alias("superseded"))


def amount_sketches(gold: DataFrame) -> DataFrame:
    """``month, weekday, subsidiary, n, amounts``: a sketch of the amounts of each weekday of a month.
    A changed day changes the sketch of its month alone."""
    known = gold.filter(F.col("gmv").isNotNull() & F.col(DAY).isNotNull())
    return known.groupBy(F.trunc(DAY, "MM").alias("month"), F.dayofweek(DAY).alias("weekday"), "subsidiary").agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("gmv", F.lit(QUANTILE_ITEMS)).alias("amounts"))


def baselines(sketches: DataFrame) -> DataFrame:
    """``weekday, subsidiary, days, median, spread`` of the months given."""
    merged = sketches.groupBy("weekday", "subsidiary").agg(
        F.sum("n").alias("days"), F.kll_merge_agg_double("amounts", F.lit(QUANTILE_ITEMS)).alias("amounts"))
    points = F.array(*map(F.lit, (0.25, 0.5, 0.75)))
    quartiles = merged.select(
        "weekday", "subsidiary", "days", F.kll_sketch_get_quantile_double("amounts", points).alias("q"))
    spread = (F.col("q")[2] - F.col("q")[0]) / F.lit(QUARTILES_PER_DEVIATION)
    return quartiles.select("weekday", "subsidiary", "days", F.col("q")[1].alias("median"), spread.alias("spread"))


def gmv_outliers(gold: DataFrame, sketches: DataFrame) -> DataFrame:
    """Days far from the median of their weekday, in spreads. Neither moves much for a few outliers, so one
    does not hide another, as it does in a mean and deviation. Weekdays without any spread have none.

    ``sketches`` has a row per month, weekday and subsidiary, so the baselines are few beside gold."""
    known = baselines(sketches).filter((F.col("days") >= OUTLIER_MIN_DAYS) & (F.col("spread") > 0))
    score = F.round((F.col("gmv") - F.col("median")) / F.col("spread"), 4)
    days = gold.withColumn("weekday", F.dayofweek(DAY)).join(known, ["weekday", "subsidiary"])
    return days.withColumn("score", score).filter(F.abs("score") > OUTLIER_SPREADS).select(DAY, "subsidiary", "gmv", "score")
