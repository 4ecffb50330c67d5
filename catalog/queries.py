"""One entry per operator; each takes (spark, folder of the tables) and returns a DataFrame.

Sink queries write below a new folder of the session's shared scratch space and return what
they read back.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.checks import monitor, quality, sketches
from daybook.checks.pending import carry_unmatched
from daybook.logs import EventLogs
from daybook.operators import state
from daybook.operators.latest import latest_by
from daybook.operators.window import DateWindow, date_bounds, resolve_window
from daybook.plans import incremental, ledger, metric
from daybook.plans.ingest import ingest_logs
from daybook.plans.run import LITERAL, STATE_COMPLETE, RunReport, run_daily_gmv
from daybook.schemas import LOG_SCHEMAS
from daybook.session import scratch_folder
from daybook.sinks import files
from daybook.sinks import gold as gold_sink
from daybook.sinks.slices import PaidDays, SilverTables
from daybook.sinks.store import PublishedGold
from daybook.sources.bronze import conform, conform_logs, read_logs, read_typed, scan_raw
from daybook.sources.gold import daily_gmv_query, preview, read_gold
from daybook.sources.order_tables import as_raw_text, item_events, order_logs, read_table
from daybook.streaming.ingest import BAD_FILES, BAD_ROWS, ingest_new, last_arrivals, read_arrivals, typed_bounds

WINDOW = DateWindow(date(1997, 3, 1), date(1997, 9, 30))
EARLY_END = DateWindow(date(1995, 1, 1), date(1998, 6, 30))
BACKFILL = DateWindow(date(1996, 1, 1), date(1996, 3, 31))
START_ONLY, TODAY = date(2000, 10, 1), date(2001, 1, 1)
END_ONLY = date(1999, 12, 31)
AS_OF = date(1998, 6, 30)
LATE = DateWindow(date(2001, 7, 1), date(2002, 12, 31))
REVERSED = DateWindow(date(1996, 3, 1), date(1996, 3, 31))
REVERSED_ON = date(2001, 7, 11)
REBUILT = [date(1996, 5, 2), date(1998, 1, 15), date(2000, 11, 30)]
GAP = DateWindow(date(2002, 1, 1), date(2002, 12, 31))
EMPTY = DateWindow(date(2030, 1, 1), date(2030, 12, 31))
NOBODY_PAID = DateWindow(date(1995, 1, 1), date(1995, 1, 5))


# Sources and casts


def bronze(name: str):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        path = scratch_folder(spark, f"bronze-{name}")
        files.append_raw(getattr(order_logs(spark, folder), name), path)
        return conform(scan_raw(spark, path, LOG_SCHEMAS[name]), LOG_SCHEMAS[name])

    return query


def bronze_append(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_folder(spark, "bronze-append")
    events = order_logs(spark, folder).purchase
    files.append_raw(events.filter(F.col("transaction_date") < F.lit(LATE.start)), path)
    files.append_raw(events.filter(F.col("transaction_date") >= F.lit(LATE.start)), path)
    return conform(scan_raw(spark, path, LOG_SCHEMAS["purchase"]), LOG_SCHEMAS["purchase"])


def bronze_typed_window(spark: SparkSession, folder: str) -> DataFrame:
    """A window over typed events stored by day reads that window's folders only."""
    path = scratch_folder(spark, "bronze-typed")
    logs = order_logs(spark, folder)
    files.append_typed(logs.product_item, path)
    items = read_typed(spark, path, LOG_SCHEMAS["product_item"])
    return metric.windowed_gmv(replace(logs, product_item=items), WINDOW)


def _malformed(spark: SparkSession, folder: str) -> EventLogs:
    """The logs as text, with cells no type can hold: a thirteenth month, words for times and
    numbers, fractions for integers."""
    raw = as_raw_text(order_logs(spark, folder))
    no_month = F.concat(F.substring("transaction_date", 1, 4), F.lit("-13-01"))
    heavy = F.col("item_quantity").try_cast("int") > 40
    light = F.col("item_quantity").try_cast("int") <= 10
    return EventLogs(
        purchase=raw.purchase.withColumns(
            {
                "release_date": F.when(
                    (F.col("producer_id") == "F") & F.col("release_date").isNotNull(), no_month
                ).otherwise(F.col("release_date")),
                "transaction_datetime": F.when(
                    F.col("prod_item_id") == "5-LOW", F.lit("later")
                ).otherwise(F.col("transaction_datetime")),
            }
        ),
        product_item=raw.product_item.withColumns(
            {
                "item_quantity": F.when(heavy, F.concat(F.lit("x"), "item_quantity"))
                .when(light, F.concat("item_quantity", F.lit(".7")))
                .otherwise(F.concat(F.lit(" "), "item_quantity", F.lit(" "))),
                "purchase_value": F.when(light, F.lit("free")).otherwise(F.col("purchase_value")),
            }
        ),
        extra_info=raw.extra_info.withColumn(
            "transaction_date",
            F.when(F.col("subsidiary") == "ASIA", no_month).otherwise(F.col("transaction_date")),
        ),
    )


def cast_tolerance(spark: SparkSession, folder: str) -> DataFrame:
    return conform_logs(_malformed(spark, folder)).product_item


def cast_tolerance_dates(spark: SparkSession, folder: str) -> DataFrame:
    return conform_logs(_malformed(spark, folder)).purchase


def dq_bad_casts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.bad_cast_counts(_malformed(spark, folder))


# Windows


def _events_in(logs: EventLogs, window: DateWindow) -> DataFrame:
    """The resolved window with the events of each log it holds."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("events")).select(
            F.lit(window.start).alias("start_date"),
            F.lit(window.end).alias("end_date"),
            F.lit(name).alias("table_name"),
            "events",
        )
        for name, df in logs.within(window).items()
    ]
    return reduce(DataFrame.unionByName, counts)


def resolved(**parameters):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        logs = order_logs(spark, folder)
        return _events_in(logs, resolve_window(logs.purchase, **parameters))

    return query


def window_default_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return date_bounds(order_logs(spark, folder).purchase)


def window_log(name: str):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return getattr(order_logs(spark, folder).within(WINDOW), name)

    return query


# Latest event and state


def silver(name: str):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return getattr(order_logs(spark, folder).dated().latest(), name)

    return query


def silver_roundtrip(name: str, fmt: str):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        path = scratch_folder(spark, f"silver-{name}")
        files.write_snapshot(silver(name)(spark, folder), path, fmt)
        return files.read_snapshot(spark, path, name, fmt)

    return query


def latest_event_per_user(spark: SparkSession, folder: str) -> DataFrame:
    return latest_by(read_table(spark, folder, "events"), ["user_id"], ["ts"], ["event_id"])


def purchase_state(spark: SparkSession, folder: str) -> DataFrame:
    return state.purchase_state(order_logs(spark, folder).dated().latest())


def paid_purchases(spark: SparkSession, folder: str) -> DataFrame:
    return state.paid(silver("purchase")(spark, folder))


def unpaid_purchases(spark: SparkSession, folder: str) -> DataFrame:
    return state.unpaid(silver("purchase")(spark, folder))


LINE_COLUMNS = [
    "purchase_id",
    "purchase_transaction_date",
    "subsidiary",
    "purchase_value",
    "item_quantity",
    "gmv_value",
]


def _lines(logs: EventLogs) -> DataFrame:
    return state.gmv_lines(state.purchase_state(logs.dated().latest_for_gold())).select(*LINE_COLUMNS)


def gmv_lines(spark: SparkSession, folder: str) -> DataFrame:
    return _lines(order_logs(spark, folder))


def scaled_lines(factor: str):
    """Lines at prices that no decimal of eight places holds."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        logs = order_logs(spark, folder)
        items = item_events(spark, folder, f"l_extendedprice * {factor}")
        value = F.round(F.col("gmv_value") / F.expr(factor), 4).alias("gmv_value")
        return _lines(replace(logs, product_item=items)).select("purchase_id", value)

    return query


def daily_gmv_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Days of prices beyond any decimal."""
    items = item_events(spark, folder, "l_extendedprice * 1e14")
    gold = metric.full_history_gmv(replace(order_logs(spark, folder), product_item=items))
    return gold.withColumn("gmv", F.round(F.col("gmv") / 1e14, 2))


# The metric


def daily_gmv(spark: SparkSession, folder: str) -> DataFrame:
    """The run with no parameters: the window spans the purchase log."""
    logs = order_logs(spark, folder)
    return metric.windowed_gmv(logs, resolve_window(logs.purchase))


def daily_gmv_in(window: DateWindow):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return metric.windowed_gmv(order_logs(spark, folder), window)

    return query


def daily_gmv_full_history(spark: SparkSession, folder: str) -> DataFrame:
    return metric.full_history_gmv(order_logs(spark, folder))


def daily_gmv_asof(spark: SparkSession, folder: str) -> DataFrame:
    return metric.gmv_as_of(order_logs(spark, folder), AS_OF)


def daily_gmv_multi_item(spark: SparkSession, folder: str) -> DataFrame:
    return metric.multi_item_gmv(order_logs(spark, folder))


def impacted_dates(spark: SparkSession, folder: str) -> DataFrame:
    return incremental.impacted_dates(order_logs(spark, folder), WINDOW)


def daily_gmv_rebuild_days(spark: SparkSession, folder: str) -> DataFrame:
    return incremental.rebuild_days(order_logs(spark, folder), REBUILT)


def daily_gmv_state_complete(spark: SparkSession, folder: str) -> DataFrame:
    return incremental.state_complete_gmv(order_logs(spark, folder), WINDOW)


# Gold


def _run(logs: EventLogs, path: str, window: DateWindow, **options) -> RunReport:
    return run_daily_gmv(logs, path, start=window.start, end=window.end, **options)


def daily_gmv_backfill(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_folder(spark, "backfill")
    _run(order_logs(spark, folder), path, BACKFILL)
    return read_gold(spark, path)


def gold_roundtrip(fmt: str):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        path = scratch_folder(spark, f"gold-{fmt}")
        gold_sink.overwrite_days(daily_gmv_full_history(spark, folder), path, fmt)
        return read_gold(spark, path, fmt)

    return query


def gold_incremental_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """A literal run over older gold: its days are replaced, all others stay."""
    logs, path = order_logs(spark, folder), scratch_folder(spark, "gold-literal")
    gold_sink.overwrite_days(metric.gmv(logs.before(WINDOW.start)), path)
    _run(logs, path, WINDOW, mode=LITERAL)
    return read_gold(spark, path)


def _with_reversals(logs: EventLogs) -> EventLogs:
    """The logs, and late events that take back the payment of every purchase of one month."""
    known = logs.before(LATE.start).latest().purchase
    day = F.lit(REVERSED_ON)
    taken_back = state.paid(known).filter(REVERSED.covers("transaction_date")).withColumns(
        {
            "transaction_datetime": day.cast("timestamp_ntz"),
            "transaction_date": day,
            "release_date": F.lit(None).cast("date"),
        }
    )
    return replace(logs, purchase=logs.purchase.unionByName(taken_back))


def _late_run(spark: SparkSession, folder: str, times: int) -> tuple[str, RunReport]:
    logs = _with_reversals(order_logs(spark, folder))
    path = scratch_folder(spark, "gold-late")
    gold_sink.overwrite_days(metric.gmv(logs.before(LATE.start)), path)
    reports = [_run(logs, path, LATE) for _ in range(times)]
    return path, reports[0]


def late_run(times: int):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        """Gold of the events before a day, then the later events, which empty a whole month: the
        full rebuild results, and the days of that month are gone."""
        path, _ = _late_run(spark, folder, times)
        return read_gold(spark, path)

    return query


def gold_from_snapshots(window: DateWindow):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        """As the late run, with the earlier events read from silver instead of the logs. A window that
        starts later than the snapshots end is widened to the days between."""
        logs, path = order_logs(spark, folder), scratch_folder(spark, "gold-carried")
        silver_path = scratch_folder(spark, "silver-carried")
        before = logs.before(LATE.start)
        covers = files.Coverage(LATE.start - timedelta(days=1), STATE_COMPLETE)
        files.write_silver(before.latest(), silver_path, coverage=covers).forget()
        snapshots = files.read_silver(spark, silver_path)
        gold_sink.overwrite_days(state.daily_total(state.purchase_state(snapshots)), path)
        _run(logs, path, window, previous_silver=silver_path)
        return read_gold(spark, path)

    return query


def guarded_run(window: DateWindow):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        """A run with nothing to write leaves gold as it was."""
        logs, path = order_logs(spark, folder), scratch_folder(spark, "gold-guard")
        gold_sink.overwrite_days(metric.full_history_gmv(logs), path)
        _run(logs, path, window, mode=LITERAL)
        return read_gold(spark, path)

    return query


def _table_name(path: str) -> str:
    return path.rsplit("/", 1)[1].replace("-", "_")


def _decimal(spark: SparkSession, folder: str) -> tuple[str, DataFrame]:
    """The filled table, and the rejected rows as stored."""
    path = scratch_folder(spark, "gold-decimal")
    table = _table_name(path)
    gold_sink.create_decimal_table(spark, table, path)
    rejected = scratch_folder(spark, "quarantine")
    return table, gold_sink.fill_decimal_table(daily_gmv(spark, folder), table, rejected)


def gold_decimal(spark: SparkSession, folder: str) -> DataFrame:
    return spark.table(_decimal(spark, folder)[0])


def gold_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    return _decimal(spark, folder)[1].drop("rejected_at")


def bronze_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Malformed raw folders are ingested; what could not be read is found in quarantine."""
    raw, typed = scratch_folder(spark, "bronze-raw"), scratch_folder(spark, "bronze-ingested")
    rejected = scratch_folder(spark, "quarantine")
    files.append_logs(_malformed(spark, folder), raw)
    ingest_logs(spark, raw, typed, rejected)
    row = spark.read.parquet(f"{rejected}/{BAD_ROWS}")
    key = F.get_json_object("cells", "$.purchase_id").alias("purchase_id")
    return row.groupBy("table_name", key, "bad_columns").agg(F.count(F.lit(1)).alias("n"))


def bronze_ingested(spark: SparkSession, folder: str) -> DataFrame:
    """Gold of a window over logs that were ingested from raw folders."""
    raw, typed = scratch_folder(spark, "bronze-raw"), scratch_folder(spark, "bronze-ingested")
    files.append_logs(order_logs(spark, folder), raw)
    ingest_logs(spark, raw, typed)
    return metric.windowed_gmv(read_logs(spark, typed, "parquet"), WINDOW)


def _in_two_drops(spark: SparkSession, folder: str) -> tuple[str, str]:
    """Raw folders with all events but those dated in the window, and typed logs that have taken them;
    then the events of the window, years old by then, come into the raw folders too."""
    raw, typed = scratch_folder(spark, "bronze-raw"), scratch_folder(spark, "bronze-arrivals")
    logs = order_logs(spark, folder)
    files.append_logs(logs.where(~WINDOW.covers("transaction_date")), raw)
    ingest_new(spark, raw, typed)
    files.append_logs(logs.within(WINDOW), raw)
    return raw, typed


def bronze_ingest_twice(spark: SparkSession, folder: str) -> DataFrame:
    """Events per table after three calls, of which the last finds nothing new."""
    raw, typed = _in_two_drops(spark, folder)
    ingest_new(spark, raw, typed)
    ingest_new(spark, raw, typed)
    counts = [
        df.groupBy("arrival").agg(F.count(F.lit(1)).alias("events")).select(F.lit(name).alias("table_name"), "arrival", "events")
        for name, df in read_arrivals(spark, typed).items()
    ]
    return reduce(DataFrame.unionByName, counts)


def bronze_odd_file(spark: SparkSession, folder: str) -> DataFrame:
    """Raw folders with files that lack a column and some with columns in another order: the first are
    put aside whole, all others are taken."""
    raw, typed, rejected = (scratch_folder(spark, f"bronze-{n}") for n in ("raw", "arrivals", "rejected"))
    logs = order_logs(spark, folder)
    early = F.col("transaction_date") < F.lit(LATE.start)
    files.append_logs(logs.where(early), raw)
    path = f"{raw}/purchase"
    late = logs.purchase.filter(~early)
    files.append_raw(late.select(*reversed(late.columns)), path)
    files.append_raw(late.drop("release_date"), path)
    ingest_new(spark, raw, typed, rejected)
    taken = read_arrivals(spark, typed).purchase.groupBy("producer_id").agg(F.count(F.lit(1)).alias("events"))
    put_aside = spark.read.parquet(f"{rejected}/{BAD_FILES}").agg(
        (F.count(F.lit(1)) - F.count_distinct("file")).alias("events"))
    return taken.union(put_aside.select(F.lit("put aside").alias("producer_id"), "events"))


def gold_late_by_arrival(spark: SparkSession, folder: str) -> DataFrame:
    """Events dated years back come in the last batch. A run that is given no dates, only the batches gold
    knows, brings gold to what a full rebuild gives."""
    raw, typed = _in_two_drops(spark, folder)
    gold = scratch_folder(spark, "gold-arrivals")
    known = last_arrivals(spark, typed)
    run_daily_gmv(read_arrivals(spark, typed), gold, arrivals={}, checks=False)
    ingest_new(spark, raw, typed)
    run_daily_gmv(read_arrivals(spark, typed), gold, arrivals=known)
    return read_gold(spark, gold)


def impacted_dates_indexed(spark: SparkSession, folder: str) -> DataFrame:
    """Impacted days of a window's events, looked up in an index that was kept in two steps."""
    logs, base = order_logs(spark, folder), scratch_folder(spark, "paid-days")
    index = PaidDays(spark, _table_name(base), base, slices=8).create()
    index.add(logs.purchase.filter(~WINDOW.covers("transaction_date")))
    index.add(logs.within(WINDOW).purchase)
    return index.days_of(incremental.touched_keys(logs, WINDOW))


def gold_from_slices(spark: SparkSession, folder: str) -> DataFrame:
    """The late run, which empties a month, on silver in slices that an earlier run has left."""
    logs, path = _with_reversals(order_logs(spark, folder)), scratch_folder(spark, "gold-slices")
    base = scratch_folder(spark, "silver-slices")
    tables = SilverTables(spark, _table_name(base), base, slices=8)
    before = DateWindow(EARLY_END.start, LATE.start - timedelta(days=1))
    _run(logs.before(LATE.start), path, before, silver_tables=tables, checks=False)
    _run(logs, path, LATE, silver_tables=tables)
    return read_gold(spark, path)


def mon_typed_bounds(spark: SparkSession, folder: str) -> DataFrame:
    """Bounds and freshness of the logs as they were noted batch by batch."""
    raw, typed = _in_two_drops(spark, folder)
    ingest_new(spark, raw, typed)
    return typed_bounds(spark, typed)


def mon_duplicates_sketched(spark: SparkSession, folder: str) -> DataFrame:
    """Sketches of days, stored, merged and read: exact events, and whether the estimate of purchases is
    within 5 % (three standard errors) of the exact count."""
    path, logs = scratch_folder(spark, "sketches"), order_logs(spark, folder)
    sketches.day_sketches(logs).write.parquet(path)
    found = sketches.estimated_duplicates(spark.read.parquet(path))
    exact = monitor.duplicates(logs).select("table_name", F.col("purchases").alias("exact"))
    near = F.abs(F.col("purchases") - F.col("exact")) <= 0.05 * F.col("exact")
    return found.join(exact, "table_name").select("table_name", "events", near.alias("near"))


def dq_gmv_outliers(spark: SparkSession, folder: str) -> DataFrame:
    gold = daily_gmv_full_history(spark, folder)
    return sketches.gmv_outliers(gold, sketches.amount_sketches(gold))


def dq_unmatched_carried(spark: SparkSession, folder: str) -> DataFrame:
    """Purchases without items, carried over three steps of the logs, of which the middle one is cut out and
    comes last."""
    logs = order_logs(spark, folder)
    inside, before = WINDOW.covers("transaction_date"), F.col("transaction_date") < F.lit(WINDOW.start)
    steps = [logs.where(before), logs.where(~before & ~inside), logs.where(inside)]
    pending, known = None, None
    for step in steps:
        pending = carry_unmatched(pending, step.purchase, step.product_item, known)
        known = step.product_item if known is None else known.unionByName(step.product_item)
    return pending


def gold_published(spark: SparkSession, folder: str) -> DataFrame:
    """Gold as a table of the catalog, switched by a run that empties a whole month, and read by name
    right after it."""
    logs = _with_reversals(order_logs(spark, folder))
    path = scratch_folder(spark, "gold-published")
    table = _table_name(path)
    before = PublishedGold(spark, table, path).create()
    known = metric.gmv(logs.before(LATE.start)).persist()
    before.replace(known, incremental.days_of(known), [])
    known.unpersist()
    _run(logs, path, LATE, gold_table=table)
    return daily_gmv_query(spark, table)


def gold_ledger(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.change_ledger(order_logs(spark, folder)).select("known_on", "transaction_date", "subsidiary", "purchases")


def daily_gmv_asof_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Gold as known on a past day, out of a ledger that was kept in two runs, the second of which brought
    events older than the first's."""
    raw, typed = _in_two_drops(spark, folder)
    path, known = scratch_folder(spark, "gold-ledger"), last_arrivals(spark, typed)
    ledger.append_entries(ledger.change_ledger(read_arrivals(spark, typed)), path, 0)
    ingest_new(spark, raw, typed)
    ledger.append_entries(ledger.late_entries(read_arrivals(spark, typed), known), path, 1)
    return ledger.gmv_as_known(ledger.read_ledger(spark, path), AS_OF)


def _registered(spark: SparkSession, folder: str) -> str:
    path = scratch_folder(spark, "gold-table")
    table = _table_name(path)
    gold_sink.overwrite_days(daily_gmv_full_history(spark, folder), path)
    gold_sink.register_gold(spark, table, path)
    return table


def gold_external_table(spark: SparkSession, folder: str) -> DataFrame:
    return spark.table(_registered(spark, folder))


def gold_query(spark: SparkSession, folder: str) -> DataFrame:
    return daily_gmv_query(spark, _registered(spark, folder))


def gold_preview(spark: SparkSession, folder: str) -> DataFrame:
    return preview(daily_gmv(spark, folder))


# Quality and monitoring


def dq_null_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.null_counts(order_logs(spark, folder))


def _with_refunds(spark: SparkSession, folder: str) -> EventLogs:
    logs = order_logs(spark, folder)
    refunds = "if(l_returnflag = 'R', -l_extendedprice, l_extendedprice)"
    return EventLogs(logs.purchase, item_events(spark, folder, refunds), logs.extra_info)


def dq_negative_lines(spark: SparkSession, folder: str) -> DataFrame:
    return quality.negative_lines(_lines(_with_refunds(spark, folder)))


def dq_negative_gmv(spark: SparkSession, folder: str) -> DataFrame:
    return quality.negative_days(metric.full_history_gmv(_with_refunds(spark, folder)))


def dq_orphan_items(spark: SparkSession, folder: str) -> DataFrame:
    logs = order_logs(spark, folder).within(WINDOW)
    return quality.unmatched(logs.product_item, logs.purchase)


def dq_purchases_without_items(spark: SparkSession, folder: str) -> DataFrame:
    logs = order_logs(spark, folder).within(WINDOW)
    return quality.unmatched(logs.purchase, logs.product_item)


def dq_gold_contract(spark: SparkSession, folder: str) -> DataFrame:
    return quality.contract_violations(daily_gmv_in(WINDOW)(spark, folder))


def dq_negative_lines_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Negative lines whose prices no decimal holds."""
    logs = order_logs(spark, folder)
    refunds = "if(l_returnflag = 'R', -1e20, l_extendedprice)"
    lines = _lines(EventLogs(logs.purchase, item_events(spark, folder, refunds), logs.extra_info))
    return quality.negative_lines(lines).select("purchase_id", "gmv_value")


def dq_gold_grain(spark: SparkSession, folder: str) -> DataFrame:
    """Stored gold into which one month was appended a second time."""
    path = scratch_folder(spark, "gold-grain")
    gold = daily_gmv_full_history(spark, folder)
    gold_sink.overwrite_days(gold, path)
    again = read_gold(spark, path).filter(REVERSED.covers("transaction_date"))
    again.write.mode("append").partitionBy("transaction_date").parquet(path)
    return quality.grain_violations(read_gold(spark, path))


def dq_gmv_anomaly(spark: SparkSession, folder: str) -> DataFrame:
    return quality.gmv_anomalies(daily_gmv_full_history(spark, folder))


def mon_partition_rows(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.rows_per_day(daily_gmv_full_history(spark, folder))


def mon_freshness(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.freshness(order_logs(spark, folder))


def mon_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.duplicates(order_logs(spark, folder))


def mon_daily_delta(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.daily_delta(daily_gmv_full_history(spark, folder))


def alert_gmv_drop(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.gmv_drops(daily_gmv_full_history(spark, folder))


def mon_run_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Counts a late run reports; its duration is left out, being different each time."""
    _, report = _late_run(spark, folder, times=1)
    counts = ["purchase_events", "gold_rows", "days_written", "days_cleared", "undated_purchase",
              "contract_violations", "grain_violations"]
    return (
        report.as_frame(spark)
        .filter(F.col("metric").isin(counts))
        .withColumn("value", F.col("value").cast("bigint"))
    )


QUERIES = {
    "bronze_purchase": bronze("purchase"),
    "bronze_product_item": bronze("product_item"),
    "bronze_extra_info": bronze("extra_info"),
    "bronze_append": bronze_append,
    "bronze_typed_window": bronze_typed_window,
    "bronze_quarantine": bronze_quarantine,
    "bronze_ingested": bronze_ingested,
    "bronze_ingest_twice": bronze_ingest_twice,
    "bronze_odd_file": bronze_odd_file,
    "gold_late_by_arrival": gold_late_by_arrival,
    "gold_published": gold_published,
    "impacted_dates_indexed": impacted_dates_indexed,
    "gold_from_slices": gold_from_slices,
    "mon_typed_bounds": mon_typed_bounds,
    "mon_duplicates_sketched": mon_duplicates_sketched,
    "dq_gmv_outliers": dq_gmv_outliers,
    "dq_unmatched_carried": dq_unmatched_carried,
    "gold_ledger": gold_ledger,
    "daily_gmv_asof_ledger": daily_gmv_asof_ledger,
    "cast_tolerance": cast_tolerance,
    "cast_tolerance_dates": cast_tolerance_dates,
    "window_explicit": resolved(start="1997-03-01", end="1997-09-30"),
    "window_start_only": resolved(start=START_ONLY, today=TODAY),
    "window_end_only": resolved(end=END_ONLY),
    "window_default": resolved(),
    "window_default_bounds": window_default_bounds,
    "window_purchase": window_log("purchase"),
    "window_product_item": window_log("product_item"),
    "window_extra_info": window_log("extra_info"),
    "silver_purchase": silver("purchase"),
    "silver_product_item": silver("product_item"),
    "silver_extra_info": silver("extra_info"),
    "silver_roundtrip_purchase": silver_roundtrip("purchase", "parquet"),
    "silver_roundtrip_product_item": silver_roundtrip("product_item", "csv"),
    "silver_roundtrip_extra_info": silver_roundtrip("extra_info", "parquet"),
    "latest_event_per_user": latest_event_per_user,
    "purchase_state": purchase_state,
    "paid_purchases": paid_purchases,
    "unpaid_purchases": unpaid_purchases,
    "gmv_lines": gmv_lines,
    "gmv_lines_fine": scaled_lines("1e-10"),
    "gmv_lines_wide": scaled_lines("1e14"),
    "daily_gmv": daily_gmv,
    "daily_gmv_window": daily_gmv_in(WINDOW),
    "daily_gmv_window_early_end": daily_gmv_in(EARLY_END),
    "daily_gmv_full_history": daily_gmv_full_history,
    "daily_gmv_asof": daily_gmv_asof,
    "daily_gmv_multi_item": daily_gmv_multi_item,
    "daily_gmv_backfill": daily_gmv_backfill,
    "daily_gmv_state_complete": daily_gmv_state_complete,
    "daily_gmv_rebuild_days": daily_gmv_rebuild_days,
    "daily_gmv_wide": daily_gmv_wide,
    "impacted_dates": impacted_dates,
    "gold_roundtrip": gold_roundtrip("parquet"),
    "gold_roundtrip_csv": gold_roundtrip("csv"),
    "gold_incremental_overwrite": gold_incremental_overwrite,
    "gold_late_correction": late_run(times=1),
    "gold_idempotent": late_run(times=2),
    "gold_from_snapshots": gold_from_snapshots(LATE),
    "gold_from_snapshots_gap": gold_from_snapshots(GAP),
    "gold_decimal": gold_decimal,
    "gold_quarantine": gold_quarantine,
    "gold_external_table": gold_external_table,
    "gold_query": gold_query,
    "gold_preview": gold_preview,
    "empty_window": guarded_run(EMPTY),
    "no_paid_window": guarded_run(NOBODY_PAID),
    "dq_null_counts": dq_null_counts,
    "dq_negative_lines": dq_negative_lines,
    "dq_negative_lines_wide": dq_negative_lines_wide,
    "dq_negative_gmv": dq_negative_gmv,
    "dq_orphan_items": dq_orphan_items,
    "dq_purchases_without_items": dq_purchases_without_items,
    "dq_bad_casts": dq_bad_casts,
    "dq_gold_contract": dq_gold_contract,
    "dq_gold_grain": dq_gold_grain,
    "dq_gmv_anomaly": dq_gmv_anomaly,
    "mon_partition_rows": mon_partition_rows,
    "mon_freshness": mon_freshness,
    "mon_duplicates": mon_duplicates,
    "mon_daily_delta": mon_daily_delta,
    "mon_run_metrics": mon_run_metrics,
    "alert_gmv_drop": alert_gmv_drop,
}
