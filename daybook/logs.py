"""The three event logs as one value, so that window, pruning and dedup apply to all alike."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators.latest import latest_by
from daybook.schemas import DAY, GOLD_INPUTS, KEY, PRECEDENCE


@dataclass(frozen=True)
class EventLogs:
    purchase: DataFrame
    product_item: DataFrame
    extra_info: DataFrame

    def items(self) -> list[tuple[str, DataFrame]]:
        return [
            ("purchase", self.purchase),
            ("product_item", self.product_item),
            ("extra_info", self.extra_info),
        ]

    def map(self, fn: Callable[[str, DataFrame], DataFrame]) -> EventLogs:
        return EventLogs(**{name: fn(name, df) for name, df in self.items()})

    def where(self, condition) -> EventLogs:
        return self.map(lambda _, df: df.filter(condition))

    def any_row(self):
        """A row of any log, or None."""
        rows = [df.select(KEY).limit(1) for _, df in self.items()]
        return rows[0].union(rows[1]).union(rows[2]).first()

    def union(self, other: EventLogs) -> EventLogs:
        return self.map(lambda name, df: df.unionByName(getattr(other, name)))

    def within(self, window) -> EventLogs:
        """Events of the window; each log by its own date. Undated events fall in no window."""
        return self.where(window.covers(DAY))

    def dated(self) -> EventLogs:
        """All history. Undated events belong to no window, hence to no rebuild either."""
        return self.where(F.col(DAY).isNotNull())

    def up_to(self, day) -> EventLogs:
        return self.where(F.col(DAY) <= F.lit(day))

    def before(self, day) -> EventLogs:
        return self.where(F.col(DAY) < F.lit(day))

    def latest(self, columns: dict[str, list[str]] | None = None) -> EventLogs:
        """Newest event per purchase. ``columns`` prunes each log ahead of the shuffle."""

        def resolve(name: str, df: DataFrame) -> DataFrame:
            if columns is not None:
                df = df.select(KEY, *columns[name])
            order = [c for c in PRECEDENCE[name] if c in df.columns]
            return latest_by(df, [KEY], order)

        return self.map(resolve)

    def latest_for_gold(self) -> EventLogs:
        return self.latest(GOLD_INPUTS)
