"""Tables in slices by purchase, of which a run rewrites only those it touches.

A slice holds the purchases of one hash bucket, and tables are bucketed alike: joins by purchase need no
shuffle however much history they hold, keys find their slices, and what a run writes follows the
purchases with new events.

A run first writes the touched slices to a folder of its own; the table is switched to them later,
slice by slice. Until then nothing that the next run builds on has changed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.logs import EventLogs
from daybook.operators.latest import latest_by
from daybook.operators.state import paid
from daybook.schemas import DAY, KEY, LOG_SCHEMAS, PRECEDENCE, SILVER_FOLDERS
from daybook.sinks.gold import literal

SLICE = "slice"
#: Table property with the last day that all events are known of.
THROUGH = "daybook.through"
# Partitions that one statement names.
BATCH = 500


@dataclass(frozen=True)
class SlicedTable:
    """One table, one or a few rows per purchase. ``merge`` makes of what is known of some purchases, and of
    what is new, what is known then; to merge the same again must change nothing.

    ``slices`` is fixed when the table is made. A slice should hold what a task can sort, and is the
    least that a run with an event in it writes.
    """

    spark: SparkSession
    name: str
    base: str
    schema: T.StructType
    merge: Callable[[DataFrame, DataFrame], DataFrame]
    slices: int

    def create(self, name: str | None = None) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name or self.name} ({columns}, {SLICE} INT) USING parquet "
            f"PARTITIONED BY ({SLICE}) CLUSTERED BY ({KEY}) INTO {self.slices} BUCKETS LOCATION {literal(self.base)}"
        )

    def read(self, name: str | None = None) -> DataFrame:
        return self.spark.table(name or self.name).select(*self.schema.names)

    def slice_of(self) -> Column:
        """As the bucket of a row is found, so that a slice is a bucket."""
        return F.pmod(F.hash(KEY), F.lit(self.slices)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        return sorted(r[0] for r in rows.select(self.slice_of()).distinct().collect())

    def read_slices(self, touched: list[int]) -> DataFrame:
        return self.spark.table(self.name).filter(F.col(SLICE).isin(touched)).select(*self.schema.names)

    def places(self) -> dict[int, str]:
        """Where each slice lies, from the names of its files."""
        files = self.spark.table(self.name).inputFiles()
        return {int(f.rpartition(f"/{SLICE}=")[2].partition("/")[0]): f.rpartition("/")[0] for f in files}

    def write(self, fresh: DataFrame) -> dict[int, str]:
        """Write the slices that have rows in ``fresh``, merged with what is known; returns where."""
        touched = self.touched(fresh)
        if not touched:
            return {}
        version = uuid.uuid4().hex
        folder, stage = f"{self.base}/version={version}", f"{self.name}_{version}"
        rows = self.merge(self.read_slices(touched), fresh).select(*self.schema.names)
        rows = rows.withColumn(SLICE, self.slice_of()).repartition(self.slices, KEY)
        writer = rows.write.partitionBy(SLICE).bucketBy(self.slices, KEY).sortBy(KEY)
        writer.option("path", folder).format("parquet").saveAsTable(stage)
        self.spark.sql(f"DROP TABLE {stage}")  # the files stay
        return {k: f"{folder}/{SLICE}={k}" for k in touched}

    def locate(self, places: dict[int, str], name: str | None = None) -> None:
        entries = [f"PARTITION ({SLICE} = {k}) LOCATION {literal(p)}" for k, p in sorted(places.items())]
        for begin in range(0, len(entries), BATCH):
            some = " ".join(entries[begin : begin + BATCH])
            self.spark.sql(f"ALTER TABLE {name or self.name} ADD IF NOT EXISTS {some}")

    def switch(self, known: dict[int, str], new: dict[int, str]) -> None:
        """Point the table to new slices; each is right before and after its switch."""
        self.locate({k: p for k, p in new.items() if k not in known})
        for k in sorted(set(new) & set(known)):
            self.spark.sql(f"ALTER TABLE {self.name} PARTITION ({SLICE} = {k}) SET LOCATION {literal(new[k])}")


def _newest(name: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
    columns = LOG_SCHEMAS[name].names
    return lambda known, fresh: latest_by(known.unionByName(fresh.select(*columns)), [KEY], PRECEDENCE[name])


@dataclass(frozen=True)
class SilverTables:
    """The latest event per purchase of each log, in tables ``<prefix>_<folder>`` with files below ``base``."""

    spark: SparkSession
    prefix: str
    base: str
    slices: int = 200

    def of(self, name: str) -> SlicedTable:
        folder = SILVER_FOLDERS[name]
        return SlicedTable(
            self.spark, f"{self.prefix}_{folder}", f"{self.base}/{folder}", LOG_SCHEMAS[name], _newest(name), self.slices)

    def create(self) -> SilverTables:
        for name in SILVER_FOLDERS:
            self.of(name).create()
        return self

    def through(self) -> date | None:
        """The last day whose events are all in the tables; None if nothing is."""
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.of('purchase').name}").collect()
        found = {r["key"]: r["value"] for r in rows}.get(THROUGH)
        return None if found is None else date.fromisoformat(found)

    def logs(self) -> EventLogs:
        return EventLogs(**{n: self.of(n).read() for n in SILVER_FOLDERS})

    def prepare(self, fresh: EventLogs) -> Prepared:
        """Write the slices that have events in ``fresh``, merged with what is known of them."""
        places = {name: self.of(name).places() for name in SILVER_FOLDERS}
        return Prepared(self, uuid.uuid4().hex, places, {name: self.of(name).write(df) for name, df in fresh.items()})


@dataclass(frozen=True)
class Prepared:
    """Slices that are written and not yet switched to."""

    silver: SilverTables
    version: str
    places: dict[str, dict[int, str]]
    written: dict[str, dict[int, str]]

    def _next(self, name: str) -> str:
        return f"{self.silver.of(name).name}_next_{self.version}"

    def logs(self) -> EventLogs:
        """The next state: untouched slices where they are, the others as written."""
        out = {}
        for name in SILVER_FOLDERS:
            table, following = self.silver.of(name), self._next(name)
            table.create(following)
            table.locate(self.places[name] | self.written[name], following)
            out[name] = table.read(following)
        return EventLogs(**out)

    def commit(self, through: date) -> None:
        """Switch the tables and say what they hold. The day is recorded last: after a failure in between
        the next run takes the same events again, which changes nothing where they are in already."""
        for name, new in self.written.items():
            self.silver.of(name).switch(self.places[name], new)
        purchases = self.silver.of("purchase").name
        self.silver.spark.sql(f"ALTER TABLE {purchases} SET TBLPROPERTIES ('{THROUGH}' = '{through}')")

    def forget(self) -> None:
        for name in SILVER_FOLDERS:
            self.silver.spark.sql(f"DROP TABLE IF EXISTS {self._next(name)}")


PAID_DAYS = T.StructType([T.StructField(KEY, T.StringType()), T.StructField("days", T.ArrayType(T.DateType()))])


def _all_days(known: DataFrame, fresh: DataFrame) -> DataFrame:
    days = known.select(KEY, F.explode("days").alias(DAY)).unionByName(fresh.select(KEY, DAY)).distinct()
    return days.groupBy(KEY).agg(F.sort_array(F.collect_list(DAY)).alias("days"))


@dataclass(frozen=True)
class PaidDays:
    """An index of the days on which each purchase ever had a paid event: what new events may change is
    told from the slices of their purchases, and history is not scanned.

    The calendar bounds the days of a purchase. Days are only ever added, so that an index that knows
    more than gold does no harm.
    """

    spark: SparkSession
    name: str
    base: str
    slices: int = 200

    @property
    def table(self) -> SlicedTable:
        return SlicedTable(self.spark, self.name, self.base, PAID_DAYS, _all_days, self.slices)

    def create(self) -> PaidDays:
        self.table.create()
        return self

    def add(self, purchases: DataFrame) -> None:
        """Take in the paid events among those given. The same events again change nothing."""
        known = self.table.places()
        rows = paid(purchases).filter(F.col(DAY).isNotNull()).select(KEY, DAY).distinct()
        self.table.switch(known, self.table.write(rows))

    def days_of(self, keys: DataFrame) -> DataFrame:
        """Days on which the given purchases were ever paid; only their slices are read."""
        held = self.table.read_slices(self.table.touched(keys))
        return held.join(keys.select(KEY), KEY, "left_semi").select(F.explode("days").alias(DAY)).distinct()
