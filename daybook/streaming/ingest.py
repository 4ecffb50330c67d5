"""Raw CSV folders to typed logs by arrival and day: every file once, however often it is asked for.

Each log is a stream over the files of its folder. The checkpoint knows which files were taken; a batch
that failed is taken again with the same files under the same number, and replaces what it had
written. That number, the batch's arrival, is stored with the events, so that a run can ask for what
has come since the last one, whatever day it is dated.
"""

from __future__ import annotations

import csv
import re
from collections import Counter
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.casts import tolerant
from daybook.logs import EventLogs
from daybook.schemas import ARRIVAL, BRONZE_FOLDERS, DAY, EVENT_TIME, KEY, LOG_SCHEMAS
from daybook.sources.bronze import bad_cells, conform, conform_marked

#: Files of a log in one batch, at most. Their names and headers come to the driver.
FILES_PER_BATCH = 10_000
#: Files up to so many bytes are read whole for their headers, in one job; of others, a job each reads a line.
SMALL_FILE = 1 << 20
#: Events that a task sorts by day and writes, about.
EVENTS_PER_TASK = 1_000_000
#: Beside the typed logs: one row for every batch of every log.
ARRIVALS = "_arrivals"
#: Marks events with unreadable cells until they are written.
MARK = "_unreadable"
#: Folders below the place for rejected input.
BAD_ROWS, BAD_FILES = "rows", "files"

LEDGER = T.StructType(
    [
        T.StructField("files", T.LongType()),
        T.StructField("events", T.LongType()),
        T.StructField("rejected_files", T.LongType()),
        T.StructField("rejected_rows", T.LongType()),
        T.StructField("first_day", T.DateType()),
        T.StructField("last_day", T.DateType()),
        T.StructField("newest_event", T.TimestampNTZType()),
        T.StructField("table_name", T.StringType()),
        T.StructField(ARRIVAL, T.LongType()),
    ]
)


FILE = "path string, modificationTime timestamp, length long, content binary"


def _replace(df: DataFrame, path: str, *partitions: str) -> None:
    """Write ``df`` in place of what the partitions it has rows for held."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions).parquet(path)


def _columns(header: str) -> list[str]:
    return next(csv.reader([header]), [])


def _read_lines(spark: SparkSession, files: list[Row], whole: bool = False) -> DataFrame:
    """``value, file`` of the files' lines, or of files as ``whole``. Their paths are names, not patterns."""
    paths = [re.sub(r"([\\{}\[\]*?])", r"\\\1", f["path"]) for f in files]
    return spark.read.text(paths, wholetext=whole).select("value", F.col("_metadata.file_path").alias("file"))


def _headers(spark: SparkSession, files: list[Row]) -> dict[str, str]:
    """First line of each file that has any."""
    small = [f for f in files if 0 < f["size"] <= SMALL_FILE]
    found = {}
    if small:
        text = F.regexp_replace("value", "^\ufeff", "")  # a reader of lines leaves the mark out
        line = F.split(text, "\r\n|\r|\n", 2)[0].alias("line")
        found = {r["file"]: r["line"] for r in _read_lines(spark, small, whole=True).select("file", line).collect()}

    def first(file: Row) -> tuple[str, str | None]:
        row = _read_lines(spark, [file]).filter("_metadata.file_block_start = 0").first()
        return file["file"], row and row["value"]

    with ThreadPoolExecutor(8) as pool:
        large = list(pool.map(first, [f for f in files if f["size"] > SMALL_FILE]))
    return {**found, **{file: line for file, line in large if line is not None}}


def _cells(lines: DataFrame, places: list[list[int]], width: int, schema: T.StructType) -> DataFrame:
    """Lines as rows of text, whatever order their files have. ``at`` is the place of each column, one of
    ``places``. A line is parsed once: a generator, unlike a projection, is not repeated in the filters above it."""
    text = ", ".join(f"_c{i} STRING" for i in range(width))
    parsed = lines.select("at", F.inline(F.array(F.from_csv("value", text))))

    def cell(n: int) -> Column:
        found = {at[n] for at in places}
        if len(found) == 1:
            return F.col(f"_c{found.pop()}")
        return F.get(F.array(*[f"_c{i}" for i in range(width)]), F.col("at")[n])

    return parsed.select(*[cell(n).alias(c) for n, c in enumerate(schema.names)])


def _laid_out(lines: DataFrame, files: list[Row], headers: dict[str, str], places: dict[str, list[int]]) -> DataFrame:
    """Lines that are not blank, with the header of their file (``head``) and the place of each column (``at``)."""
    known = {headers[f["file"]] for f in files}
    if len(known) == 1:
        head = known.pop()
        told = lines.select("value", F.lit(head).alias("head"), F.array(*map(F.lit, places[head])).alias("at"))
    else:
        fate = [(f["file"], headers[f["file"]], places[headers[f["file"]]]) for f in files]
        known = lines.sparkSession.createDataFrame(fate, "file string, head string, at array<int>")
        told = lines.join(F.broadcast(known), "file").drop("file")
    return told.filter(F.trim("value") != "")


def _count_days(
    lines: DataFrame, places: list[list[int]], width: int, schema: T.StructType, files: Counter
) -> tuple[list[Row], Counter]:
    """Events of each day, and the lines that repeat a header beside the one of each file: these are rows,
    without a day, and as good as each other, so no line's number is needed to tell them apart."""
    text = ", ".join(f"_c{i} STRING" for i in range(width))
    n, at = schema.names.index(DAY), {p[schema.names.index(DAY)] for p in places}
    parsed = F.from_csv("value", text)
    # Of a single field, no other is parsed.
    cells = [F.when(F.col("at")[n] == i, parsed[f"_c{i}"]) for i in at] if len(at) > 1 else [parsed[f"_c{i}"] for i in at]
    found = lines.select(
        tolerant(F.coalesce(*cells), schema[DAY].dataType).alias(DAY),
        F.when(F.col("value") == F.col("head"), F.col("head")).alias("head"))
    found = found.groupBy(DAY, "head").agg(F.count(F.lit(1)).alias("events")).collect()
    again = Counter({r["head"]: r["events"] for r in found if r["head"] is not None}) - files
    days = Counter({r[DAY]: r["events"] for r in found if r["head"] is None})
    if again:
        days[None] += again.total()
    return [Row(**{DAY: day, "events": n}) for day, n in days.items()], again


def _spread(events: DataFrame, days: list[Row], tasks: int) -> DataFrame:
    """Events for writing by day, from the number of them on each: a day's lie together, one that holds
    much of the batch is split, tasks hold equal shares, and folders are made by all of them."""
    total = sum(d["events"] for d in days)
    tasks = max(tasks, -(-total // EVENTS_PER_TASK))
    days = sorted(days, key=lambda d: d[DAY] or date.min)
    before = accumulate((d["events"] for d in days), initial=0)
    spans = events.sparkSession.createDataFrame(
        [(d[DAY], n, d["events"]) for d, n in zip(days, before)], "day date, before long, held long")
    part = F.pmod(F.xxhash64(KEY, EVENT_TIME), F.lit(1_000_000)) / F.lit(1e6)
    task = F.floor((F.col("before") + F.col("held") * part) * F.lit(tasks / max(total, 1))).cast("int")
    # As many rows as days, which the calendar bounds.
    placed = events.join(F.broadcast(spans), F.col(DAY).eqNullSafe(F.col("day")), "left")
    return placed.repartitionById(tasks, F.coalesce(task, F.lit(0))).select(*events.columns)


def rejected_cells(raw: DataFrame, name: str) -> DataFrame:
    """Rows with unreadable cells: the row as text, and the columns at fault."""
    return bad_cells(raw, LOG_SCHEMAS[name]).select(
        F.lit(name).alias("table_name"),
        F.to_json(F.struct(*raw.columns)).alias("cells"),
        F.array_join("bad_columns", ",").alias("bad_columns"),
    )


def _take(name: str, typed_base: str, quarantine_base: str | None) -> Callable[[DataFrame, int], None]:
    schema = LOG_SCHEMAS[name]

    def take(batch: DataFrame, arrival: int) -> None:
        spark = batch.sparkSession
        number = F.lit(arrival).cast("long").alias(ARRIVAL)
        # As many rows as files, of which a batch has a bounded number. Where a name looks like a pattern, the
        # stream lists what matches it too.
        files = list({f["file"]: f for f in batch.collect()}.values())
        headers = _headers(spark, files)
        columns = {h: _columns(h) for h in set(headers.values())}
        places = {
            h: [c.index(n) for n in schema.names]
            for h, c in columns.items() if set(schema.names) <= set(c) and len(set(c)) == len(c)
        }
        taken = [f for f in files if headers.get(f["file"]) in places]
        odd = [f for f in files if f["file"] in headers and headers[f["file"]] not in places]
        rows = spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in schema.names]))
        days, bad, newest = [], 0, None
        if taken:
            layouts, width = list(places.values()), max(len(columns[h]) for h in places)
            lines = _laid_out(_read_lines(spark, taken), taken, headers, places)
            days, again = _count_days(lines, layouts, width, schema, Counter(headers[f["file"]] for f in taken))
            lines = lines.filter(F.col("value") != F.col("head")).select("value", "at")
            for head, n in again.items():
                at = F.array(*map(F.lit, places[head])).alias("at")
                lines = lines.union(spark.range(n).select(F.lit(head), at))
            rows = _cells(lines, layouts, width, schema)
        events = sum(d["events"] for d in days)
        # Rows with unreadable cells and the newest event are found while events are written: after the
        # shuffle, where no task counts twice.
        seen = Observation()
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spread = _spread(conform_marked(rows, schema, MARK), days, tasks)
        spread = spread.observe(seen, F.count_if(MARK).alias("bad"), F.max(EVENT_TIME).cast("string").alias("newest"))
        # Written below the batch's own folder, rows are sorted by day alone.
        _replace(spread.drop(MARK), f"{typed_base}/{BRONZE_FOLDERS[name]}/{ARRIVAL}={arrival}", DAY)
        if events:
            bad, newest = seen.get["bad"], seen.get["newest"]
        dates = [d[DAY] for d in days if d[DAY] is not None]
        counts = [len(headers), events, len(odd), None,
                  min(dates, default=None), max(dates, default=None), newest and datetime.fromisoformat(newest)]
        if quarantine_base is not None:
            counts[3] = bad
            cells = rejected_cells(rows if bad else rows.limit(0), name).withColumn(ARRIVAL, number)
            _replace(cells, f"{quarantine_base}/{BAD_ROWS}", "table_name", ARRIVAL)
            if odd:
                whole = _read_lines(spark, odd).filter(F.trim("value") != "")
                whole = whole.select("file", F.col("value").alias("line"), number, F.lit(name).alias("table_name"))
                _replace(whole, f"{quarantine_base}/{BAD_FILES}", "table_name", ARRIVAL)
        entry = spark.createDataFrame([(*counts, name, arrival)], LEDGER)
        _replace(entry.coalesce(1), f"{typed_base}/{ARRIVALS}", "table_name", ARRIVAL)

    return take


def ingest_new(
    spark: SparkSession,
    raw_base: str,
    typed_base: str,
    quarantine_base: str | None = None,
    checkpoint_base: str | None = None,
    files_per_batch: int = FILES_PER_BATCH,
) -> None:
    """Take what is new in the raw folders into typed logs, stored by arrival and day.

    A second call adds nothing, a failed one is made up for by the next. Columns are found by the header
    of each file; files that lack one, or name one twice, are rejected whole and the others taken. Rows
    with unreadable cells are kept with NULLs in their place. With ``quarantine_base``, rejected files
    (line by line) and rows are stored there under their arrival. Undated rows have a folder of their
    own. The typed logs remember their checkpoint beside them, or in ``checkpoint_base``; a checkpoint
    and what it has taken belong together.
    """
    checkpoint_base = checkpoint_base or f"{typed_base}/_checkpoints"
    queries = []
    for name, folder in BRONZE_FOLDERS.items():
        # Only the names of new files are streamed, their content is not read: lines that come out of a stream
        # are an RDD, whole and without a plan, however few are wanted.
        stream = spark.readStream.format("binaryFile").schema(FILE).option("maxFilesPerTrigger", files_per_batch)
        # A file counts as new by its path, however old it is.
        files = stream.option("maxFileAge", "36500d").load(f"{raw_base}/{folder}")
        files = files.select("path", F.col("_metadata.file_path").alias("file"), F.col("length").alias("size"))
        writer = files.writeStream.foreachBatch(_take(name, typed_base, quarantine_base))
        writer = writer.option("checkpointLocation", f"{checkpoint_base}/{name}").trigger(availableNow=True)
        queries.append(writer.start())
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            query.stop()


def read_arrivals(spark: SparkSession, typed_base: str) -> EventLogs:
    """Typed logs as ``ingest_new`` stores them, with each event's arrival."""
    return EventLogs(
        **{
            name: spark.read.schema(T.StructType([*LOG_SCHEMAS[name].fields, T.StructField(ARRIVAL, T.LongType())]))
            .parquet(f"{typed_base}/{folder}")
            .select(*LOG_SCHEMAS[name].names, ARRIVAL)
            for name, folder in BRONZE_FOLDERS.items()
        }
    )


def arrivals(spark: SparkSession, typed_base: str) -> DataFrame:
    """What every batch of every log brought: ``table_name, arrival, files, events, rejected_files,
    rejected_rows, first_day, last_day, newest_event``."""
    found = spark.read.schema(LEDGER).parquet(f"{typed_base}/{ARRIVALS}")
    return found.select("table_name", ARRIVAL, *[f.name for f in LEDGER.fields[:-2]])


def typed_bounds(spark: SparkSession, typed_base: str) -> DataFrame:
    """First and last day of each log, as ``window.date_bounds`` finds them, and the newest event, from what
    was noted of each batch: ``table_name, min_date, max_date, newest_event``. No event is read."""
    return arrivals(spark, typed_base).groupBy("table_name").agg(
        F.min("first_day").alias("min_date"), F.max("last_day").alias("max_date"),
        F.max("newest_event").alias("newest_event"))


def last_arrivals(spark: SparkSession, typed_base: str) -> dict[str, int]:
    """The newest arrival of each log that has any."""
    newest = arrivals(spark, typed_base).groupBy("table_name").agg(F.max(ARRIVAL).alias("newest"))
    return {r["table_name"]: r["newest"] for r in newest.collect()}
