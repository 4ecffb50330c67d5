"""Data-quality checks on logs, purchase state and gold."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.logs import EventLogs
from daybook.schemas import DAY, KEY, LOG_SCHEMAS
from daybook.sources.bronze import bad_cells

SUBSIDIARY_LENGTH = 50  # fixed value: VARCHAR length in the warehouse table

# Choices of this library for what counts as unusual.
ANOMALY_ROWS_BACK = 28
ANOMALY_MIN_ROWS = 7
ANOMALY_Z = 3.0


def null_counts(logs: EventLogs) -> DataFrame:
    """NULL cells per table and column; one pass and one row of counts per table."""

    def count(name: str, df: DataFrame) -> DataFrame:
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
        return counts.select(F.lit(name).alias("table_name"), *df.columns).unpivot(
            "table_name", df.columns, "column_name", "null_count"
        )

    return reduce(DataFrame.unionByName, [count(name, df) for name, df in logs.items()])


def bad_cast_counts(raw: EventLogs) -> DataFrame:
    """Unreadable cells per table and column."""

    def count(name: str, df: DataFrame) -> DataFrame:
        return (
            bad_cells(df, LOG_SCHEMAS[name])
            .select(F.lit(name).alias("table_name"), F.explode("bad_columns").alias("column_name"))
            .groupBy("table_name", "column_name")
            .agg(F.count(F.lit(1)).alias("bad_cells"))
        )

    return reduce(DataFrame.unionByName, [count(name, df) for name, df in raw.items()])


def unmatched(events: DataFrame, other: DataFrame) -> DataFrame:
    """Keys of ``events`` that ``other`` lacks, with their number of events. Both sides shrink to
    one row per key before they meet."""
    counted = events.groupBy(KEY).agg(F.count(F.lit(1)).alias("events"))
    return counted.join(other.select(KEY).distinct(), KEY, "left_anti")


def negative_lines(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("gmv_value") < 0)


def negative_days(gold: DataFrame) -> DataFrame:
    return gold.filter(F.col("gmv") < 0)


def _broken_rules() -> Column:
    """Names of the contract rules a gold row breaks. Gold amounts must fit NUMERIC(18,2)."""
    rules = {
        "transaction_date_null": F.col(DAY).isNull(),
        "subsidiary_null": F.col("subsidiary").isNull(),
        "subsidiary_too_long": F.length("subsidiary") > SUBSIDIARY_LENGTH,
        "gmv_null": F.col("gmv").isNull(),
        "gmv_out_of_range": F.col("gmv").isNotNull()
        & F.col("gmv").try_cast("decimal(18,2)").isNull(),
    }
    return F.array_compact(F.array(*[F.when(broken, F.lit(n)) for n, broken in rules.items()]))


def contract_violations(gold: DataFrame) -> DataFrame:
    """Rows the warehouse table must not hold, with the rules they break."""
    broken = F.array_join(_broken_rules(), ",")
    return gold.withColumn("broken_rules", broken).filter(F.col("broken_rules") != "")


def within_contract(gold: DataFrame) -> DataFrame:
    return gold.filter(F.size(_broken_rules()) == 0)


def grain_violations(gold: DataFrame) -> DataFrame:
    """Day and subsidiary pairs with more than one row."""
    return gold.groupBy(DAY, "subsidiary").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def gmv_anomalies(gold: DataFrame) -> DataFrame:
    """Days far from the mean of the subsidiary's preceding rows, in standard deviations.

    Runs on gold: a subsidiary has at most one row per calendar day.
    """
    back = (
        Window.partitionBy("subsidiary").orderBy(DAY).rowsBetween(-ANOMALY_ROWS_BACK, -1)
    )
    z = (F.col("gmv") - F.avg("gmv").over(back)) / F.nullif(
        F.stddev_samp("gmv").over(back), F.lit(0.0)
    )
    return (
        gold.withColumn("z_score", F.round(z, 4))
        .withColumn("rows_back", F.count("gmv").over(back))
        .filter((F.col("rows_back") >= ANOMALY_MIN_ROWS) & (F.abs("z_score") > ANOMALY_Z))
        .select(DAY, "subsidiary", "gmv", "z_score")
    )
