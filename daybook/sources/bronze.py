"""Event logs from files: raw CSV folders, and typed Parquet partitioned by day."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.casts import tolerant
from daybook.logs import EventLogs
from daybook.schemas import BRONZE_FOLDERS, LOG_SCHEMAS


class HeaderMismatch(ValueError):
    """A raw folder lacks columns of its log."""


def scan_raw(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All cells as text, columns found by header name; other columns are left out.

    The header is read once and then checked against every file of the folder, so a file with
    other columns or another order fails the job instead of being read shifted.
    """
    header = spark.read.option("header", True).csv(path).columns
    missing = [name for name in schema.names if name not in header]
    if missing:
        raise HeaderMismatch(f"{path} lacks {', '.join(missing)}")
    text = T.StructType([T.StructField(name, T.StringType()) for name in header])
    reader = spark.read.schema(text).option("header", True).option("enforceSchema", False)
    return reader.csv(path).select(*schema.names)


def conform(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Raw text to typed columns, in one projection."""
    return raw.select(*[tolerant(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields])


def conform_marked(raw: DataFrame, schema: T.StructType, mark: str) -> DataFrame:
    """As ``conform``, with a column that says whether ``bad_cells`` has the row. Each cell is cast once."""
    typed = [f.name for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    given = F.array(*[F.col(c).isNotNull() for c in typed])
    cast = raw.select(
        *[tolerant(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields], given.alias(mark))
    is_bad = [F.col(mark)[n] & F.col(c).isNull() for n, c in enumerate(typed)]
    return cast.withColumn(mark, reduce(or_, is_bad))


def bad_cells(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Raw rows that hold text no typed value could be made of, with the columns at fault."""
    typed = [f for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    is_bad = [F.col(f.name).isNotNull() & tolerant(F.col(f.name), f.dataType).isNull() for f in typed]
    # Rows are picked by a plain condition, which is compiled, unlike array functions over all rows.
    at_fault = F.array(*[F.when(bad, F.lit(f.name)) for bad, f in zip(is_bad, typed)])
    nothing = F.array(F.lit(None).cast("string"))
    return raw.filter(reduce(or_, is_bad)).withColumn("bad_columns", F.array_except(at_fault, nothing))


def read_raw_logs(spark: SparkSession, base: str) -> EventLogs:
    """The three raw folders below ``base``, as text."""
    return EventLogs(
        **{
            name: scan_raw(spark, f"{base}/{folder}", LOG_SCHEMAS[name])
            for name, folder in BRONZE_FOLDERS.items()
        }
    )


def conform_logs(raw: EventLogs) -> EventLogs:
    return raw.map(lambda name, df: conform(df, LOG_SCHEMAS[name]))


def read_csv_logs(spark: SparkSession, base: str) -> EventLogs:
    return conform_logs(read_raw_logs(spark, base))


def read_typed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed events as stored by day; a window prunes whole folders."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def read_parquet_logs(spark: SparkSession, base: str) -> EventLogs:
    return EventLogs(
        **{
            name: read_typed(spark, f"{base}/{folder}", LOG_SCHEMAS[name])
            for name, folder in BRONZE_FOLDERS.items()
        }
    )


def read_logs(spark: SparkSession, base: str, fmt: str = "csv") -> EventLogs:
    return read_csv_logs(spark, base) if fmt == "csv" else read_parquet_logs(spark, base)
