"""Daily GMV over a window, over all history, and as known on a past day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.money import line_value, to_total, wide_line_value
from daybook.logs import EventLogs
from daybook.operators.latest import latest_by
from daybook.operators.state import daily_total, paid, purchase_state
from daybook.operators.window import DateWindow
from daybook.schemas import DAY, GOLD_INPUTS, KEY


def gmv(logs: EventLogs) -> DataFrame:
    """Latest event per purchase, then paid ones, then the daily sum: in this order, so that a
    purchase re-sent as unpaid leaves the metric and a corrected one moves to its new day."""
    return daily_total(purchase_state(logs.latest_for_gold()))


def windowed_gmv(logs: EventLogs, window: DateWindow) -> DataFrame:
    """Literal run: only events of the window are seen, "latest" means latest inside it.

    A paid purchase whose item or subsidiary lies outside the window gives a row with NULLs.
    An end before the newest event gives the state known at that end.
    """
    return gmv(logs.within(window))


def full_history_gmv(logs: EventLogs) -> DataFrame:
    """Rebuild from every dated event."""
    return gmv(logs.dated())


def gmv_as_of(logs: EventLogs, day: date) -> DataFrame:
    """The table as a full rebuild on ``day`` would have shown it. For reading only: written to
    gold it would bring back value that has moved since."""
    return gmv(logs.up_to(day))


def multi_item_gmv(logs: EventLogs) -> DataFrame:
    """Full rebuild that keeps the latest event of every product of a purchase, not only the
    newest item event of the purchase."""
    dated = logs.dated()
    columns = GOLD_INPUTS["product_item"]
    items = latest_by(
        dated.product_item.select(KEY, "product_id", *columns), [KEY, "product_id"], columns
    )
    # Summed per purchase ahead of the join: a purchase of very many products joins as one row.
    per_purchase = items.groupBy(KEY).agg(
        F.sum(line_value()).alias("exact"), F.sum(wide_line_value()).alias("wide")
    )
    latest = dated.latest_for_gold()
    return (
        paid(latest.purchase)
        .join(per_purchase, KEY, "left")
        .join(latest.extra_info.select(KEY, "subsidiary"), KEY, "left")
        .groupBy(DAY, "subsidiary")
        .agg(to_total(F.sum("exact"), F.sum("wide")).alias("gmv"))
    )
