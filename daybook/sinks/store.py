"""Where a run keeps gold: a folder of day partitions, or a table of the catalog that is switched."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date
from itertools import islice

from pyspark.sql import DataFrame, SparkSession

from daybook.schemas import DAY, GOLD
from daybook.sinks.gold import clear_days, create_external_table, literal, overwrite_days, stored_days
from daybook.sources.gold import read_gold

# Partitions that one statement names.
BATCH = 500


@dataclass(frozen=True)
class FolderGold:
    """Day folders below ``path``, replaced one by one. Readers may see new days beside old ones."""

    spark: SparkSession
    path: str
    fmt: str = "parquet"

    def replace(self, gold: DataFrame, written: list[date], gone: list[date]) -> list[date]:
        """Write the days of ``gold``, then remove days that are gone; returns those that were there."""
        if written:
            overwrite_days(gold, self.path, self.fmt)
        return clear_days(self.spark, self.path, gone)

    def days(self) -> list[date]:
        return stored_days(self.spark, self.path, self.fmt)

    def read(self) -> DataFrame:
        return read_gold(self.spark, self.path, self.fmt)


@dataclass(frozen=True)
class PublishedGold:
    """An external table over ``base`` whose partitions are switched once a run's days are written.

    Every run writes to a folder of its own, ``version=...``, which no reader looks at yet. Then the
    changed days leave the table, all of them, and after that the new ones are added, each with its
    place. A reader in between misses changed days; none ever sees an amount on its old and its new
    day at once, nor a day half written. If the run fails before the switch the table is as it was, if
    within it the same run again makes up for it. Folders of earlier versions
    stay; those that no partition names can be deleted once no reader of the old table is left.
    """

    spark: SparkSession
    table: str
    base: str
    fmt: str = "parquet"

    def create(self) -> PublishedGold:
        if not self.spark.catalog.tableExists(self.table):
            create_external_table(self.spark, self.table, self.base, self.fmt)
        return self

    def _alter(self, action: str, entries: Iterable[str]) -> None:
        rest = iter(entries)
        while batch := list(islice(rest, BATCH)):
            self.spark.sql(f"ALTER TABLE {self.table} {action} " + _separator(action).join(batch))

    def replace(self, gold: DataFrame, written: list[date], gone: list[date]) -> list[date]:
        known = set(self.days())
        version = f"{self.base.rstrip('/')}/version={uuid.uuid4().hex}"
        if written:
            overwrite_days(gold, version, self.fmt)
        changed = sorted(known & {*written, *gone})
        self._alter("DROP IF EXISTS", map(_partition, changed))
        places = (f"{_partition(d)} LOCATION {literal(f'{version}/{DAY}={d}')}" for d in sorted(written))
        self._alter("ADD IF NOT EXISTS", places)
        return sorted(known & set(gone))

    def days(self) -> list[date]:
        """Days of the table, as the catalog has them."""
        found = self.spark.sql(f"SHOW PARTITIONS {self.table}").collect()
        return sorted(date.fromisoformat(r[0].partition("=")[2]) for r in found)

    def read(self) -> DataFrame:
        return self.spark.table(self.table).select(*GOLD.names)


def _partition(day: date) -> str:
    return f"PARTITION ({DAY} = DATE '{day}')"


def _separator(action: str) -> str:
    """Partitions that are dropped are listed with commas, those that are added without."""
    return ", " if action.startswith("DROP") else " "
