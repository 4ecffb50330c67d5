"""Raw CSV folders to typed logs by day, with what could not be read put aside."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.logs import EventLogs
from daybook.schemas import DAY
from daybook.streaming.ingest import ingest_new


def ingest_logs(
    spark: SparkSession, raw_base: str, typed_base: str, quarantine_path: str | None = None
) -> None:
    """Bring typed logs up to date with the raw folders, whatever they have taken before."""
    ingest_new(spark, raw_base, typed_base, quarantine_path)


def undated_counts(logs: EventLogs) -> DataFrame:
    """Events without a day, per table: they are in no window and no rebuild."""
    parts = [
        df.filter(F.col(DAY).isNull()).agg(F.count(F.lit(1)).alias("events")).select(
            F.lit(name).alias("table_name"), "events"
        )
        for name, df in logs.items()
    ]
    return reduce(DataFrame.unionByName, parts)


