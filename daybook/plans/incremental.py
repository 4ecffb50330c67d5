"""Rebuilding only the days that late or corrected events change."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.logs import EventLogs
from daybook.operators.state import daily_total, paid, purchase_state
from daybook.operators.window import DateWindow
from daybook.schemas import ARRIVAL, DAY, KEY

# Up to this measured size purchase keys are broadcast; a parameter of every function that does so,
# 0 turns it off. And what a row of a broadcast table takes beside its key: pointer, hash and header.
BROADCAST_BYTES = 128 * 1024 * 1024
ROW_OVERHEAD = 64

# Of all days with paid events, the share from which on impacted ones are rebuilt with all purchases.
WIDE_SHARE = 0.5

# Up to so many days are listed in a plan, more are joined.
LISTED_DAYS = 31

# Which events of a log, by its name, are new.
Touch = Callable[[str], Column]


def days_of(df: DataFrame) -> list[date]:
    """Distinct days in order. The calendar bounds this list, not the data."""
    return sorted(row[0] for row in df.select(DAY).distinct().collect() if row[0] is not None)


def fits_broadcast(keys: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the keys, measured now, take at most ``limit`` bytes as a broadcast table."""
    if limit <= 0:
        return False
    size = keys.agg(F.sum(F.octet_length(KEY) + F.lit(ROW_OVERHEAD)).alias("bytes")).first()
    return (size.bytes or 0) <= limit


def only_of(events: DataFrame, keys: DataFrame) -> DataFrame:
    """Events of the given purchases, picked while scanning. Only behind ``fits_broadcast``."""
    return events.join(F.broadcast(keys.select(KEY)), KEY, "left_semi")


def _in_window(window: DateWindow) -> Touch:
    return lambda _: window.covers(DAY)


def arrived_since(arrivals: dict[str, int]) -> Touch:
    """Dated events of later batches than the given one of each log; a log that is not named is new
    altogether."""
    return lambda name: F.col(DAY).isNotNull() & (F.col(ARRIVAL) > F.lit(arrivals.get(name, -1)))


def _touch(new: DateWindow | Touch) -> Touch:
    return _in_window(new) if isinstance(new, DateWindow) else new


def touched_keys(logs: EventLogs, new: DateWindow | Touch) -> DataFrame:
    """Purchases with an event of any log that is new: in a window, or by another rule."""
    is_new = _touch(new)
    keys = logs.map(lambda name, df: df.filter(is_new(name)).select(KEY))
    return keys.purchase.union(keys.product_item).union(keys.extra_info).distinct()


def impacted_dates(
    logs: EventLogs, new: DateWindow | Touch, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Days whose total may change because of new events, those dated in a window or of later arrivals.

    A purchase is touched if any of its events, in any log, is new. Every day on which a touched
    purchase ever had a paid event is impacted: value may leave its old day and arrive on a new one.

    Touched purchases that fit a broadcast pick their events while history is scanned, and only
    days are shuffled. When there are too many for that see ``impacted_by_fold``; the days are the same.
    """
    keys = touched_keys(logs, new)
    if not fits_broadcast(keys, broadcast_bytes):
        return impacted_by_fold(logs, new)
    history = paid(logs.purchase).filter(F.col(DAY).isNotNull()).select(KEY, DAY)
    return only_of(history, keys).select(DAY).distinct()


def _folded(logs: EventLogs, new: DateWindow | Touch) -> DataFrame:
    """``touched, days`` of every purchase, by one shuffle of history: each task first folds its events
    to one row per purchase, the days as a set, which the calendar bounds however many events a
    purchase has."""
    is_new = _touch(new)
    is_paid = F.col("release_date").isNotNull()
    no_day = F.lit(None).cast("date").alias("paid_day")
    own = is_new("purchase")

    purchases = logs.purchase.filter(F.col(DAY).isNotNull() & (is_paid | own)).select(
        KEY, own.alias("touched"), F.when(is_paid, F.col(DAY)).alias("paid_day")
    )
    others = logs.map(
        lambda name, df: df.filter(is_new(name)).select(KEY, F.lit(True).alias("touched"), no_day)
    )
    return (
        purchases.unionByName(others.product_item)
        .unionByName(others.extra_info)
        .groupBy(KEY)
        .agg(F.max("touched").alias("touched"), F.collect_set("paid_day").alias("days"))
    )


def impacted_by_fold(logs: EventLogs, new: DateWindow | Touch) -> DataFrame:
    """Impacted days without a broadcast."""
    return _folded(logs, new).filter("touched").select(F.explode("days").alias(DAY)).distinct()


@dataclass(frozen=True)
class Impact:
    """Days to rebuild, in order, and on how many days anything was ever paid, if that is known."""

    days: list[date]
    paid_days: int | None = None

    @property
    def wide(self) -> bool:
        """Whether so much is impacted that looking for the purchases concerned costs more than it spares."""
        return self.paid_days is not None and len(self.days) >= WIDE_SHARE * self.paid_days


def find_impact(
    logs: EventLogs, new: DateWindow | Touch, broadcast_bytes: int = BROADCAST_BYTES
) -> Impact:
    """``impacted_dates`` as a list, and how many days there are beside them, in the same pass over
    history. The calendar bounds what comes to the driver."""
    history = paid(logs.purchase).filter(F.col(DAY).isNotNull())
    if history.filter(~F.coalesce(_touch(new)("purchase"), F.lit(False))).isEmpty():
        # Every paid event is new, as in a first run, and so every paid day is impacted.
        days = days_of(history)
        return Impact(days, len(days))
    history = history.select(KEY, DAY)
    keys = touched_keys(logs, new).persist()  # measured, then broadcast
    try:
        if fits_broadcast(keys, broadcast_bytes):
            marked = F.broadcast(keys.withColumn("touched", F.lit(True)))
            flagged = history.join(marked, KEY, "left").select(DAY, F.col("touched").isNotNull().alias("touched"))
        else:
            flagged = _folded(logs, new).select("touched", F.explode("days").alias(DAY))
        found = flagged.groupBy(DAY).agg(F.max("touched").alias("touched")).collect()
    finally:
        keys.unpersist()
    return Impact(sorted(r[DAY] for r in found if r["touched"]), len(found))


def since(window: DateWindow, covered: date) -> DateWindow:
    """The window, from the first day on that snapshots covering ``covered`` do not hold, if that is
    earlier."""
    first = covered + timedelta(days=1)
    return window if first >= window.start else DateWindow(first, window.end)


def carried_history(snapshots: EventLogs, logs: EventLogs, window: DateWindow) -> EventLogs:
    """Stand-in for all history: the latest events known before, and those from the window's start.

    The latest of both is the latest of all, because events are in total order. Only days from the
    window on are read from the logs; older events are in the snapshots, one row per purchase.
    """
    return snapshots.dated().union(logs.where(F.col(DAY) >= F.lit(window.start)))


def as_table(spark: SparkSession, days: Sequence[date]) -> DataFrame:
    """Days as rows. The filter, true of all, tells the optimizer that they select partitions."""
    rows = spark.createDataFrame([(d,) for d in days], f"{DAY} date")
    return rows.filter(F.col(DAY) >= F.lit(min(days, default=date.max)))


def on_days(df: DataFrame, days: Sequence[date]) -> DataFrame:
    """Rows of the given days. A few are listed. Of many the plan holds the range, which prunes day
    folders at once, and a broadcast of the days, the calendar's at most, which prunes the others when it runs."""
    if len(days) <= LISTED_DAYS:
        return df.filter(F.col(DAY).isin(list(days)))
    spanned = df.filter(F.col(DAY).between(F.lit(min(days)), F.lit(max(days))))
    if (max(days) - min(days)).days + 1 == len(set(days)):
        return spanned
    return spanned.join(F.broadcast(as_table(df.sparkSession, days)), DAY, "left_semi")


def current_on(
    events: EventLogs,
    days: Sequence[date],
    resolve: Callable[[EventLogs], EventLogs] = EventLogs.latest_for_gold,
    broadcast_bytes: int = BROADCAST_BYTES,
    look: EventLogs | None = None,
    search: bool = True,
) -> EventLogs:
    """Current state of the purchases whose current paid day is one of the given ones.

    Such a purchase has a paid event on one of the days. If the purchases with one fit a broadcast,
    all other events of all three logs fall out while scanning, before any sort or shuffle;
    otherwise, and without ``search``, everything is resolved, as in a full rebuild. The rows are the
    same. ``look`` holds the same events as ``events``, read in a way that suits the search.
    """
    if search:
        keys = on_days(paid((look or events).purchase), days).select(KEY).distinct()
        if fits_broadcast(keys, broadcast_bytes):
            events = events.map(lambda _, df: only_of(df, keys))
    latest = resolve(events)
    return replace(latest, purchase=on_days(paid(latest.purchase), days))


def rebuild_days(
    logs: EventLogs, days: Sequence[date], broadcast_bytes: int = BROADCAST_BYTES, search: bool = True
) -> DataFrame:
    """Totals of the given days, each exactly as a full rebuild would give it."""
    return daily_total(
        purchase_state(current_on(logs.dated(), days, broadcast_bytes=broadcast_bytes, search=search))
    )


def state_complete_gmv(
    logs: EventLogs, new: DateWindow | Touch, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """The impacted days of new events, each exactly as a full rebuild would give it.

    With a window, every event that arrived since the last run must be dated in it; ``arrived_since``
    asks for arrivals instead, whatever their dates. An impacted day that no longer has paid
    purchases is absent here; the writer has to clear it. The days are determined at once, the totals
    when the result is used.
    """
    impact = find_impact(logs, new, broadcast_bytes)
    return rebuild_days(logs, impact.days, broadcast_bytes, not impact.wide)
