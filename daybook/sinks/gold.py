"""Day partitions of the gold table: replace computed days, clear emptied ones."""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.checks.quality import contract_violations, within_contract
from daybook.schemas import DAY, GOLD
from daybook.sinks.files import replace_rejected


def overwrite_days(gold: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace the days present in ``gold``; other days stay as they are.

    The overwrite mode is set on this write alone, not on the session. Rows are grouped by day,
    one small file each, instead of sorted globally. The cost is opening files, not moving bytes,
    so the number of tasks is fixed: merging partitions by size would leave one task to write
    every day.
    """
    tasks = int(gold.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        gold.select(*GOLD.names)
        .repartition(tasks, DAY)
        .sortWithinPartitions(DAY, "subsidiary")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .partitionBy(DAY)
        .format(fmt)
        .save(path)
    )


def clear_days(spark: SparkSession, path: str, days: Iterable[date]) -> list[date]:
    """Remove those of the given days that gold holds; returns the days removed.

    A dynamic overwrite cannot do this, since it only touches days it has rows for. A day is a
    folder, so removing it is an operation on the file system: no job runs, however many days there
    are. The calendar bounds the list.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for day in days:
        folder = hadoop.Path(root, f"{DAY}={day}")
        if files.exists(folder) and files.delete(folder, True):
            gone.append(day)
    return gone


def quarantine_days(rows: DataFrame, path: str, days: Iterable[date]) -> None:
    """Store rejected rows of the given days in place of those stored for these days before, so that a
    run that is repeated, or mends a day, leaves each row once."""
    clear_days(rows.sparkSession, path, days)
    stamped = rows.withColumn("rejected_at", F.current_timestamp())
    stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Rejected rows of all days, with the rules they break and the time they were found."""
    fields = [*GOLD.fields, T.StructField("broken_rules", T.StringType()), T.StructField("rejected_at", T.TimestampType())]
    return spark.read.schema(T.StructType(fields)).parquet(path).select(*[f.name for f in fields])


def stored_days(spark: SparkSession, path: str, fmt: str = "parquet") -> list[date]:
    """Days that gold holds, from the names of its folders; no file is opened."""
    files = spark.read.schema(GOLD).format(fmt).load(path).inputFiles()
    return sorted({date.fromisoformat(d) for d in re.findall(rf"/{DAY}=(\d{{4}}-\d\d-\d\d)/", "\n".join(files))})


def literal(text: str) -> str:
    """Text as SQL has it."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_external_table(spark: SparkSession, table: str, path: str, fmt: str = "parquet") -> None:
    """A named table over the day partitions; dropping it leaves the files."""
    options = "OPTIONS (header 'true')" if fmt == "csv" else ""
    spark.sql(
        f"CREATE TABLE {table} (subsidiary STRING, gmv DOUBLE, {DAY} DATE) "
        f"USING {fmt} {options} PARTITIONED BY ({DAY}) LOCATION {literal(path)}"
    )


def register_gold(spark: SparkSession, table: str, path: str, fmt: str = "parquet") -> None:
    """External table with the partitions now on storage."""
    create_external_table(spark, table, path, fmt)
    spark.sql(f"MSCK REPAIR TABLE {table}")


def create_decimal_table(spark: SparkSession, table: str, path: str) -> None:
    """The warehouse form: nothing may be NULL, amounts are NUMERIC(18,2)."""
    spark.sql(
        f"CREATE TABLE {table} ({DAY} DATE NOT NULL, subsidiary VARCHAR(50) NOT NULL, "
        f"gmv DECIMAL(18,2) NOT NULL) USING parquet LOCATION {literal(path)}"
    )


def fill_decimal_table(gold: DataFrame, table: str, quarantine_path: str | None = None) -> DataFrame:
    """Replace the table by the rows that keep its contract; returns the rows that do not.

    File tables do not check NOT NULL when written, so the rows are split here. With
    ``quarantine_path`` the rejected rows are stored there, and returned as stored; gold is then
    computed once for both.
    """
    spark = gold.sparkSession
    amount = F.col("gmv").try_cast("decimal(18,2)").alias("gmv")
    if quarantine_path is None:
        within_contract(gold).select(DAY, "subsidiary", amount).write.insertInto(table, overwrite=True)
        return contract_violations(gold)
    kept = gold.persist()
    try:
        within_contract(kept).select(DAY, "subsidiary", amount).write.insertInto(table, overwrite=True)
        replace_rejected(contract_violations(kept), quarantine_path)
    finally:
        kept.unpersist()
    return spark.read.parquet(quarantine_path)
