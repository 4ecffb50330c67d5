"""Processing windows: inclusive date ranges and how run parameters resolve to one."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.schemas import DAY

DAYS_BACK = 30  # fixed value: default reach of a window given by its end alone
DATE_FORMAT = "%Y-%m-%d"  # fixed value: text form of window dates


@dataclass(frozen=True)
class DateWindow:
    """Days ``start`` to ``end``, both included."""

    start: date
    end: date

    def __post_init__(self) -> None:
        if self.start > self.end:
            raise ValueError(f"window starts {self.start}, after its end {self.end}")

    def covers(self, column: str) -> Column:
        return F.col(column).between(F.lit(self.start), F.lit(self.end))


def _as_date(value: date | str) -> date:
    return datetime.strptime(value, DATE_FORMAT).date() if isinstance(value, str) else value


def date_bounds(df: DataFrame) -> DataFrame:
    """First and last event day, as one row."""
    return df.agg(F.min(DAY).alias("min_date"), F.max(DAY).alias("max_date"))


def resolve_window(
    purchases: DataFrame,
    start: date | str | None = None,
    end: date | str | None = None,
    days_back: int = DAYS_BACK,
    today: date | None = None,
) -> DateWindow | None:
    """Turn optional dates into a window.

    A lone start runs to yesterday, a lone end reaches ``days_back`` days back, and no date
    at all spans the days of the purchase log (``None`` if it has none).
    """
    if start is None and end is None:
        bounds = date_bounds(purchases).first()
        return None if bounds.min_date is None else DateWindow(bounds.min_date, bounds.max_date)
    if end is None:
        return DateWindow(_as_date(start), (today or date.today()) - timedelta(days=1))
    last = _as_date(end)
    return DateWindow(last - timedelta(days=days_back) if start is None else _as_date(start), last)
