"""The gold table: by path with a fixed schema, or by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daybook.schemas import DAY, GOLD


def read_gold(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Day partitions below ``path``. The schema is given, never inferred: files of another
    layout beside the partitions must not decide column names."""
    reader = spark.read.schema(GOLD).option("header", True).format(fmt)
    return reader.load(path).select(*GOLD.names)


def daily_gmv_query(spark: SparkSession, table: str) -> DataFrame:
    """The analyst's query."""
    return spark.table(table).select(*GOLD.names).orderBy(DAY, "subsidiary")


def preview(gold: DataFrame, rows: int = 200) -> DataFrame:
    """First rows in day and subsidiary order: a top-k per task, not a global sort."""
    return gold.orderBy(DAY, "subsidiary").limit(rows)
