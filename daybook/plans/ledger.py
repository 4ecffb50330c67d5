"""Gold as a ledger of changes: what each day of events added to and took from which day of gold.

Entries are only ever appended. The table as known on a day is the sum of the entries known by then, so
that looking back reads the ledger, not the history of events.
"""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.money import line_value, to_total, wide_line_value
from daybook.logs import EventLogs
from daybook.plans.incremental import BROADCAST_BYTES, Touch, arrived_since, fits_broadcast, only_of, touched_keys
from daybook.schemas import ARRIVAL, DAY, GOLD_INPUTS, KEY, PRECEDENCE

KNOWN_ON = "known_on"
# What an entry adds to its day: purchases, and amounts, those a decimal holds and others apart, each
# with the number of lines behind it, since a day of lines without an amount has none.
AMOUNTS = ["purchases", "exact_lines", "exact", "wide_lines", "wide"]
SUM = "decimal(38,8)"
LEDGER = (
    f"{KNOWN_ON} DATE, {DAY} DATE, subsidiary STRING, purchases LONG, exact_lines LONG, exact {SUM}, "
    "wide_lines LONG, wide DOUBLE"
)


def _newest_by_day(logs: EventLogs, known: Touch | None) -> DataFrame:
    """The newest event of each purchase and day, of every log, as structs that rank as events do; with
    ``known``, also the newest of the events known before, as ``..._before``. One shuffle, by purchase,
    which serves what follows as well."""
    parts = []
    for name, columns in GOLD_INPUTS.items():
        order = [c for c in PRECEDENCE[name] if c in columns]
        was = F.lit(True) if known is None else known(name)
        parts.append(getattr(logs, name).select(KEY, F.col(DAY).alias(KNOWN_ON), was.alias("was"), F.struct(*order).alias(name)))
    events = parts[0].unionByName(parts[1], True).unionByName(parts[2], True).repartition(KEY)
    newest = [F.max(n).alias(n) for n in GOLD_INPUTS]
    if known is not None:
        newest += [F.max(F.when(F.col("was"), F.col(n))).alias(f"{n}_before") for n in GOLD_INPUTS]
    return events.groupBy(KEY, KNOWN_ON).agg(*newest)


def _summed(entries: DataFrame) -> DataFrame:
    sums = [F.sum(c).cast(SUM if c == "exact" else entries.schema[c].dataType).alias(c) for c in AMOUNTS]
    moved = (F.col("purchases") != 0) | (F.col("exact") != 0) | (F.col("wide") != 0)
    lines = (F.col("exact_lines") != 0) | (F.col("wide_lines") != 0)
    return entries.groupBy(KNOWN_ON, DAY, "subsidiary").agg(*sums).filter(moved | lines)


def change_ledger(logs: EventLogs) -> DataFrame:
    """``known_on, transaction_date, subsidiary`` and ``AMOUNTS``: for every day of events, what they
    added to or took from each day of gold.

    A purchase counts, on a day, as its latest events dated up to that day have it: with its day of
    payment, its subsidiary and its amount. Where that differs from the day of events before, the old
    state is taken out and the new one put in.
    """
    return _summed(_entries(_newest_by_day(logs.dated(), None), {"": 1}))


def _entries(days: DataFrame, versions: dict[str, int]) -> DataFrame:
    """Entries of each purchase and day, out of its newest events by day. Of several versions of these,
    by the suffix of their columns, each counts with its sign."""
    by_day = Window.partitionBy(KEY).orderBy(KNOWN_ON)
    upto = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    names = [f"{n}{v}" for v in versions for n in GOLD_INPUTS]
    states = days.select(KEY, KNOWN_ON, *[F.max(n).over(upto).alias(n) for n in names])
    for v in versions:
        amount = {c: F.col(f"product_item{v}.{c}") for c in ("item_quantity", "purchase_value")}
        own = F.struct(
            F.col(f"purchase{v}.{DAY}"), F.col(f"extra_info{v}.subsidiary"),
            line_value().cast(SUM).alias("exact"), wide_line_value().alias("wide"),
        )
        now = F.when(F.col(f"purchase{v}.release_date").isNotNull(), own)
        states = states.withColumns(amount).withColumn(f"now{v}", now)
    states = states.select(KEY, KNOWN_ON, *[f"now{v}" for v in versions])
    states = states.withColumns({f"old{v}": F.lag(f"now{v}").over(by_day) for v in versions})
    changed = [~F.col(f"now{v}").eqNullSafe(F.col(f"old{v}")) for v in versions]

    def entry(of: str, number: int) -> Column:
        sign = F.lit(number).cast("long")
        exact, wide = F.col(f"{of}.exact"), F.col(f"{of}.wide")
        there = [F.when(c.isNotNull(), sign).otherwise(F.lit(0).cast("long")) for c in (exact, wide)]
        amounts = [F.coalesce(exact, F.lit(0).cast(SUM)), F.coalesce(wide, F.lit(0.0))]
        exact, wide = amounts if number > 0 else [F.negative(a) for a in amounts]
        fields = [sign, there[0], exact.cast(SUM), there[1], wide]
        return F.struct(f"{of}.{DAY}", f"{of}.subsidiary", *[f.alias(n) for f, n in zip(fields, AMOUNTS)])

    moves = [
        F.when(differs & F.col(of).isNotNull(), entry(of, number))
        for (v, sign), differs in zip(versions.items(), changed)
        for of, number in ((f"old{v}", -sign), (f"now{v}", sign))
    ]
    moved = states.filter(reduce(or_, changed))
    return moved.select(KNOWN_ON, F.explode(F.array_compact(F.array(*moves))).alias("e")).select(KNOWN_ON, "e.*")


def late_entries(logs: EventLogs, arrivals: dict[str, int], broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """What events of later batches than the given ones change in the ledger, whatever day they are
    dated: of the purchases they touch, the entries as they are now, less those as they were."""
    new = arrived_since(arrivals)
    keys = touched_keys(logs, new)
    if fits_broadcast(keys, broadcast_bytes):
        logs = logs.map(lambda _, df: only_of(df, keys))
    else:
        logs = logs.map(lambda _, df: df.join(keys, KEY, "left_semi"))
    days = _newest_by_day(logs.dated(), lambda name: F.col(ARRIVAL) <= F.lit(arrivals.get(name, -1)))
    return _summed(_entries(days, {"": 1, "_before": -1}))


def append_entries(entries: DataFrame, path: str, batch: int) -> None:
    """Add entries to a ledger, under the number of the run that made them. The same run again
    replaces its own and no others."""
    stamped = entries.withColumn("batch", F.lit(batch).cast("long"))
    writer = stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("batch").parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType.fromDDL(LEDGER)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def gmv_as_known(ledger: DataFrame, day: date | None = None) -> DataFrame:
    """Gold as a full rebuild on ``day`` would have shown it, with all entries by default."""
    known = ledger if day is None else ledger.filter(F.col(KNOWN_ON) <= F.lit(day))
    sums = known.groupBy(DAY, "subsidiary").agg(*[F.sum(c).alias(c) for c in AMOUNTS]).filter("purchases > 0")
    exact, wide = (F.when(F.col(f"{c}_lines") > 0, F.col(c)) for c in ("exact", "wide"))
    return sums.select(DAY, "subsidiary", to_total(exact, wide).alias("gmv"))
