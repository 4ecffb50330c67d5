"""Writers for logs, snapshots and rejected rows."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.logs import EventLogs
from daybook.schemas import ARRIVAL, BRONZE_FOLDERS, DAY, KEY, LOG_SCHEMAS, SILVER_FOLDERS
from daybook.sources.bronze import conform, scan_raw

#: Folder beside the snapshots that says what they hold.
COVERAGE = "coverage"
INCOMPLETE = "incomplete"


def _as_text(df: DataFrame) -> DataFrame:
    """CSV cells as plain text, so that times keep every digit."""
    return df.select(*[F.col(c).cast("string") for c in df.columns])


def append_raw(events: DataFrame, path: str) -> None:
    """Add events to a raw CSV folder; nothing is rewritten or deduplicated."""
    _as_text(events).write.mode("append").option("header", True).csv(path)


def append_typed(events: DataFrame, path: str) -> None:
    """Add events to Parquet partitioned by day.

    Rebalancing groups each day's events into few files and splits a day that holds much of the
    batch over several tasks.
    """
    events.hint("rebalance", DAY).write.mode("append").partitionBy(DAY).parquet(path)


def append_logs(logs: EventLogs, base: str, fmt: str = "csv") -> None:
    append = append_raw if fmt == "csv" else append_typed
    for name, events in logs.items():
        append(events, f"{base}/{BRONZE_FOLDERS[name]}")


def replace_rejected(rows: DataFrame, path: str) -> None:
    """Replace what a quarantine folder holds, with the time of rejection."""
    rows.withColumn("rejected_at", F.current_timestamp()).write.mode("overwrite").parquet(path)


def write_snapshot(latest: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace a snapshot in full, one file per task."""
    cells = _as_text(latest) if fmt == "csv" else latest
    cells.write.mode("overwrite").option("header", True).format(fmt).save(path)


def write_bucketed(latest: DataFrame, path: str) -> str:
    """Replace a Parquet snapshot, its files bucketed and sorted by purchase; returns the name of a
    table over it, whose joins by purchase need no shuffle. Dropping the table leaves the files,
    which are read by path like any others."""
    spark, table = latest.sparkSession, f"daybook_snapshot_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Rows come hash-partitioned by the same key into as many tasks: each writes its own bucket.
    writer = latest.write.mode("overwrite").bucketBy(buckets, KEY).sortBy(KEY)
    writer.option("path", path).format("parquet").saveAsTable(table)
    return table


def read_snapshot(spark: SparkSession, path: str, name: str, fmt: str = "parquet") -> DataFrame:
    schema = LOG_SCHEMAS[name]
    if fmt == "csv":
        return conform(scan_raw(spark, path, schema), schema)
    return spark.read.schema(schema).format(fmt).load(path)


@dataclass(frozen=True)
class Coverage:
    """Snapshots hold every event up to and including day ``through``, or, in ``mode`` literal, only
    those of some window."""

    through: date
    mode: str


def write_coverage(spark: SparkSession, base: str, coverage: Coverage) -> None:
    row = spark.createDataFrame([(coverage.through, coverage.mode)], "through date, mode string")
    row.coalesce(1).write.mode("overwrite").parquet(f"{base}/{COVERAGE}")


def read_coverage(spark: SparkSession, base: str) -> Coverage | None:
    """What the snapshots hold; None if nothing says so."""
    try:
        row = spark.read.schema("through date, mode string").parquet(f"{base}/{COVERAGE}").first()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return None if row is None else Coverage(row.through, row.mode)


def write_known_arrivals(spark: SparkSession, path: str, arrivals: dict[str, int]) -> None:
    """Record up to which batch of each log gold is complete."""
    rows = spark.createDataFrame(sorted(arrivals.items()), f"table_name string, {ARRIVAL} long")
    rows.coalesce(1).write.mode("overwrite").parquet(path)


def read_known_arrivals(spark: SparkSession, path: str) -> dict[str, int]:
    """The recorded batches; empty if nothing is recorded, so that all events are new."""
    try:
        rows = spark.read.schema(f"table_name string, {ARRIVAL} long").parquet(path).collect()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    return {r["table_name"]: r[ARRIVAL] for r in rows}


@dataclass(frozen=True)
class StoredSilver:
    """Snapshots as just written; those of Parquet are tables until ``forget``, which leaves the
    files."""

    logs: EventLogs
    tables: list[str]

    def forget(self) -> None:
        for table in self.tables:
            self.logs.purchase.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")


def write_silver(
    latest: EventLogs, base: str, fmt: str = "parquet", coverage: Coverage | None = None
) -> StoredSilver:
    """The latest event per purchase of each log, and a record of what they cover. A failure in
    between leaves a record that says so; without ``coverage`` no run can build on them."""
    spark = latest.purchase.sparkSession
    if coverage is not None:
        write_coverage(spark, base, Coverage(coverage.through, INCOMPLETE))
    stored, tables = {}, []
    for name, df in latest.items():
        path = f"{base}/{SILVER_FOLDERS[name]}"
        if fmt == "parquet":
            tables.append(write_bucketed(df, path))
            stored[name] = spark.table(tables[-1])
        else:
            write_snapshot(df, path, fmt)
            stored[name] = read_snapshot(spark, path, name, fmt)
    if coverage is not None:
        write_coverage(spark, base, coverage)
    return StoredSilver(EventLogs(**stored), tables)


def read_silver(spark: SparkSession, base: str, fmt: str = "parquet") -> EventLogs:
    return EventLogs(
        **{
            name: read_snapshot(spark, f"{base}/{folder}", name, fmt)
            for name, folder in SILVER_FOLDERS.items()
        }
    )
