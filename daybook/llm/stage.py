"""Intermediate tables, and names that cannot clash with a caller's columns."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from threading import local

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.session import scratch_folder

ROW = "__row_no"

#: Settings while a table is written: Spark drops the shuffle files of the query once it has ended,
#: and hands Python no more than so many bytes at a time.
WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


class _Records(local):
    """Lists that ``cut`` enters its tables in, one per open ``recording`` of a thread."""

    def __init__(self):
        self.open: list[list[str]] = []


RECORDS = _Records()


@contextmanager
def recording() -> Iterator[list[str]]:
    """The tables that this thread cuts meanwhile."""
    made: list[str] = []
    RECORDS.open.append(made)
    try:
        yield made
    finally:
        RECORDS.open = [other for other in RECORDS.open if other is not made]


def drop(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that ``cut`` made; frames that read them cannot be used any more."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the folder all executors share and read it back: what follows neither
    repeats the work nor depends on the executors that did it. Its shuffle files are dropped, since
    nothing can need them again."""
    spark = df.sparkSession
    path = scratch_folder(spark, label)
    for made in RECORDS.open:
        made.append(path)
    with _settings(spark, WRITING):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sampled(df: DataFrame, n: int, *key: Column) -> DataFrame:
    """``n`` rows of ``df``, those of least hash of ``key``. Tasks send on about four times as many
    rows in all, however many tasks there are."""
    total = df.count()
    bound = -(2**63) + min(2**64 - 1, 4 * n * 2**64 // max(total, 1))
    hashed = df.withColumn("__hash", F.xxhash64(*key)).filter(F.col("__hash") <= bound)
    return hashed.orderBy("__hash", *key).limit(n).drop("__hash")


@dataclass(frozen=True)
class Numbered:
    """Rows that one operator has numbered (column ``ROW``), handed to another in place of a frame. A
    caller's frame is never one, whatever its columns are called."""

    rows: DataFrame


def counted_once(df: DataFrame | Numbered, *columns: Column | str) -> DataFrame:
    """The columns and a number for each row, for a frame that is read only once: how a table is cut
    into tasks, and with it the numbers, may change when executors come or go."""
    if isinstance(df, Numbered):
        return df.rows.select(*columns, ROW)
    return df.select(*columns, F.monotonically_increasing_id().alias(ROW))


def numbered(df: DataFrame | Numbered, *columns: Column | str) -> DataFrame:
    """The columns and a number for each row, stored, so that every read sees the same numbers.
    Repeated rows have different ones. ``Numbered`` rows keep theirs."""
    if isinstance(df, Numbered):
        return df.rows.select(*columns, ROW)
    return cut(counted_once(df, *columns), "numbered")


def dealt(df: DataFrame | Numbered, *columns: Column | str) -> DataFrame:
    """``numbered``, with the stored rows bucketed by their number: they move once, and joins by it
    then move the other side alone."""
    if isinstance(df, Numbered):
        return df.rows.select(*columns, ROW)
    rows, spark = counted_once(df, *columns), df.sparkSession
    path, name, n = scratch_folder(spark, "dealt"), f"daybook_{uuid.uuid4().hex}", parallelism(spark)
    for made in RECORDS.open:
        made.append(path)
    with _settings(spark, WRITING):
        # Rows come hashed by the same key into as many tasks: each writes its own bucket.
        writer = rows.repartition(n, ROW).write.bucketBy(n, ROW).option("path", path).format("parquet")
        writer.saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay, and the frame knows where they are
    return stored


def apart(df: DataFrame, *names: str) -> tuple[DataFrame, list[str], list[Column]]:
    """``df`` with its columns under names that no operator uses, what ``names`` are called there, and
    the columns that give ``df`` back."""
    own = [f"own{number}__" for number in range(len(df.columns))]
    known = {c.lower(): o for c, o in zip(df.columns, own)}
    back = [F.col(o).alias(c) for c, o in zip(df.columns, own)]
    return df.toDF(*own), [known[n.lower()] for n in names], back


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_rest(column: Column, modulus: int) -> Column:
    """crc32 of the value as text, modulo ``modulus``; null counts as the empty text."""
    text = F.coalesce(column.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
