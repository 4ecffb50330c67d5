"""One run of the job: window, guards, silver, gold, clearing, checks, figures."""

from __future__ import annotations

import time
from contextlib import ExitStack
from dataclasses import dataclass, field, replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daybook.checks import quality
from daybook.checks.monitor import gmv_drops
from daybook.logs import EventLogs
from daybook.operators.state import daily_total, purchase_state
from daybook.operators.window import DAYS_BACK, DateWindow, resolve_window
from daybook.plans.incremental import (
    BROADCAST_BYTES,
    Impact,
    arrived_since,
    carried_history,
    current_on,
    days_of,
    find_impact,
    since,
    touched_keys,
)
from daybook.plans.ingest import undated_counts
from daybook.schemas import ARRIVAL, DAY, EVENT_TIME, GOLD_INPUTS, KEY
from daybook.sinks.files import (
    Coverage,
    read_coverage,
    read_silver,
    write_silver,
)
from daybook.sinks.gold import quarantine_days
from daybook.sinks.slices import PaidDays, SilverTables
from daybook.sinks.store import FolderGold, PublishedGold

LITERAL = "literal"
STATE_COMPLETE = "state_complete"

WRITTEN = "written"
NO_DATES = "no dated purchases"
NO_PURCHASES = "no purchases in the window"
NO_PAID = "no paid purchases"
NOTHING_NEW = "nothing has arrived"


@dataclass(frozen=True)
class RunReport:
    status: str
    window: DateWindow | None = None
    days_written: list[date] = field(default_factory=list)
    days_cleared: list[date] = field(default_factory=list)
    metrics: dict = field(default_factory=dict)

    def as_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(name, str(value)) for name, value in self.metrics.items()]
        return spark.createDataFrame(rows, "metric string, value string")


def _as_they_are(snapshots: EventLogs) -> EventLogs:
    return snapshots


def _base(spark: SparkSession, path: str, fmt: str) -> tuple[EventLogs, Coverage]:
    """Earlier snapshots and the last day they cover."""
    coverage = read_coverage(spark, path)
    if coverage is None or coverage.mode != STATE_COMPLETE:
        found = "no record of what they hold" if coverage is None else f"mode {coverage.mode}"
        raise ValueError(f"cannot build on the snapshots in {path}: {found}")
    return read_silver(spark, path, fmt), coverage


def run_daily_gmv(
    logs: EventLogs,
    gold_path: str,
    *,
    gold_table: str | None = None,
    start: date | str | None = None,
    end: date | str | None = None,
    days_back: int = DAYS_BACK,
    today: date | None = None,
    mode: str = STATE_COMPLETE,
    arrivals: dict[str, int] | None = None,
    silver_path: str | None = None,
    previous_silver: str | None = None,
    silver_tables: SilverTables | None = None,
    paid_days: PaidDays | None = None,
    gold_format: str = "parquet",
    silver_format: str = "parquet",
    broadcast_bytes: int = BROADCAST_BYTES,
    checks: bool = True,
    quarantine_path: str | None = None,
    metrics_path: str | None = None,
) -> RunReport:
    """Compute daily GMV for a window and write it to day partitions.

    ``state_complete`` rebuilds every day the window's events change, from all history, and
    clears days left without paid purchases. ``literal`` sees the events of the window only and
    replaces the days it has rows for; days that lost their rows stay as they were. Running again
    with the same input gives the same table.

    With ``previous_silver``, the snapshots of an earlier state-complete run stand for all events
    up to the last day they cover, which is recorded beside them. The logs are read from the day
    after it, or from the window's start if that is earlier, and days between count as part of the
    window. Snapshots without such a record, or of a literal run, are refused.

    With ``silver_tables``, the snapshots of the runs before are tables in slices, which stand for all
    older events in the same way; only slices with events from the day after on are written, and the
    tables are switched once gold is.

    With ``arrivals``, the last batch of each log that gold knows, the run takes no dates: it rebuilds
    the days of every purchase with an event of a later batch, however old the event's day is. The
    logs have to have the column ``arrival`` (``streaming.ingest.read_arrivals``). With ``paid_days``,
    an index that has followed gold's runs from the first on, the days are looked up there: of the logs
    only the new batches are read for them.

    With ``gold_table``, gold is a table of the catalog with its files below ``gold_path``; its days
    are switched once they are written (``sinks.store.PublishedGold``).

    ``broadcast_bytes`` is the size up to which the keys of touched purchases are broadcast, 0 for
    never; it changes the plan, not the rows. ``checks`` adds counts of undated events and of
    rows that break the rules of gold to the figures, ``quarantine_path`` stores such rows, and
    ``metrics_path`` the figures.
    """
    if mode not in (LITERAL, STATE_COMPLETE):
        raise ValueError(f"unknown mode {mode!r}")
    if previous_silver is not None and (mode == LITERAL or previous_silver == silver_path):
        raise ValueError("earlier snapshots serve state-complete runs that write elsewhere")
    if silver_tables is not None and (mode == LITERAL or previous_silver or silver_path):
        raise ValueError("snapshots in slices serve state-complete runs and replace other snapshots")
    if arrivals is not None and (mode == LITERAL or previous_silver or silver_path or silver_tables or start or end):
        raise ValueError("a run by arrival is state-complete and takes neither dates nor snapshots")
    if paid_days is not None and arrivals is None:
        raise ValueError("the index of paid days serves runs by arrival")
    started = time.monotonic()
    spark = logs.purchase.sparkSession
    window = None
    if arrivals is None:
        window = resolve_window(logs.purchase, start, end, days_back, today)
        if window is None:
            return RunReport(NO_DATES)

    covered = window and window.end
    narrow = logs.purchase
    if not silver_path and silver_tables is None:
        stamp = [ARRIVAL] if arrivals is not None else []
        narrow = narrow.select(KEY, *GOLD_INPUTS["purchase"], *stamp)
    seen = Observation("purchase events")
    figures = F.count(F.lit(1)).alias("events"), F.max(EVENT_TIME).alias("newest_event")

    def counted(of: EventLogs) -> EventLogs:
        return replace(of, purchase=of.purchase.observe(seen, *figures))

    read = replace(logs, purchase=narrow)
    if mode == LITERAL:
        scope = read.within(window)
        if scope.purchase.isEmpty():
            return RunReport(NO_PURCHASES, window)
        log, events = scope.purchase, counted(scope)
    elif previous_silver is not None or (silver_tables and silver_tables.create().through()):
        if silver_tables is None:
            snapshots, coverage = _base(spark, previous_silver, silver_format)
            through = coverage.through
        else:
            snapshots, through = silver_tables.logs(), silver_tables.through()
        snapshots = replace(snapshots, purchase=snapshots.purchase.select(narrow.columns))
        covered = max(covered, through)
        window = since(window, through)
        scope = carried_history(snapshots, read, window)
        recent = read.where(F.col(DAY) >= F.lit(window.start))
        log, events = recent.purchase, snapshots.dated().union(counted(recent))
    else:
        scope = recent = read.dated()
        log, events = scope.purchase, counted(scope)

    resolve = EventLogs.latest_for_gold
    impact = Impact([])
    with ExitStack() as kept:
        if silver_path is not None:
            # Gold goes on from the stored snapshots; the logs are not resolved a second time, and
            # the stored rows lie as the joins need them.
            stored = write_silver(
                events.latest(), silver_path, silver_format, Coverage(covered, mode)
            )
            kept.callback(stored.forget)
            events, resolve = stored.logs, _as_they_are
        if mode == LITERAL:
            latest = resolve(events)
        else:
            new = window if arrivals is None else arrived_since(arrivals)
            if paid_days is None:
                impact = find_impact(scope, new, broadcast_bytes)
            else:
                # Taken in ahead of gold: a run that fails after it finds the same days again.
                paid_days.create().add(scope.purchase.filter(new("purchase")))
                impact = Impact(days_of(paid_days.days_of(touched_keys(scope, new))))
            if arrivals is not None and not impact.days and scope.map(
                lambda name, df: df.filter(new(name)).select(KEY)
            ).any_row() is None:
                return RunReport(NOTHING_NEW)
            if silver_tables is not None:
                # After the impact is known: it is told by the state before. Gold goes on from the
                # next state, whose slices lie as the joins need them.
                prepared = silver_tables.prepare(recent)
                kept.callback(prepared.forget)
                events, resolve = prepared.logs(), _as_they_are
            # Candidates are looked for without counting, so that day folders are pruned.
            look = events if resolve is _as_they_are else scope
            search = not impact.wide and silver_tables is None  # its joins move nothing that could be spared
            latest = current_on(events, impact.days, resolve, broadcast_bytes, look, search)

        # Gold is one row per day and subsidiary. Kept for the guard, the write, the day list and
        # the checks; a lost block is computed again.
        gold = daily_total(purchase_state(latest)).persist()
        kept.callback(gold.unpersist)
        written = days_of(gold)
        store = FolderGold(spark, gold_path, gold_format)
        if gold_table is not None:
            store = PublishedGold(spark, gold_table, gold_path, gold_format).create()
        cleared = store.replace(gold, written, sorted(set(impact.days) - set(written)))
        if silver_tables is not None:
            prepared.commit(covered)
        status = WRITTEN if written or cleared else NO_PAID
        metrics: dict = {}
        if status == WRITTEN:
            totals = gold.agg(F.count(F.lit(1)).alias("rows"), F.sum("gmv").alias("gmv")).first()
            # Figures taken on the way, if the plan that was run went through the log.
            of_log = seen.get if (written or silver_path) and not silver_tables else log.agg(*figures).first().asDict()
            metrics = {
                "purchase_events": of_log["events"],
                "newest_event": of_log["newest_event"],
                "gold_rows": totals["rows"],
                "gold_gmv": totals["gmv"],
                "days_written": len(written),
                "days_cleared": len(cleared),
            }
            if checks:
                changed = sorted([*written, *cleared])
                metrics |= _checked(logs, gold, store, changed, quarantine_path)
        metrics["seconds"] = round(time.monotonic() - started, 3)
    report = RunReport(status, window, written, cleared, metrics)
    if metrics_path is not None:
        first, last = (window.start, window.end) if window else (None, None)
        facts = {"run_at": F.current_timestamp(), "status": F.lit(status),
                 "start_date": F.lit(first).cast("date"), "end_date": F.lit(last).cast("date")}
        report.as_frame(spark).withColumns(facts).coalesce(1).write.mode("append").parquet(metrics_path)
    return report


def _checked(
    logs: EventLogs,
    gold: DataFrame,
    store: FolderGold | PublishedGold,
    changed: list[date],
    quarantine_path: str | None,
) -> dict:
    """Counts of what breaks a rule: undated events; contract and sign of gold as computed; grain of
    the changed days as stored; and alerts from the first changed day to the day after the last, days
    that were not changed included. Rows against the contract are stored if a place is given; they
    stay in gold too, which allows NULLs, but not in the decimal table.

    Stored gold is read once, the days in question alone, one row per day and subsidiary kept."""
    undated = {f"undated_{r.table_name}": r.events for r in undated_counts(logs).collect()}
    broken = quality.contract_violations(gold)
    if quarantine_path is not None:
        quarantine_days(broken, quarantine_path, changed)
    held = store.days()
    first, last = changed[0] - timedelta(days=1), changed[-1] + timedelta(days=1)
    around = store.read().filter(F.col(DAY).between(F.lit(first), F.lit(last)))
    grain = around.groupBy(DAY, "subsidiary").agg(F.count(F.lit(1)).alias("n"), F.sum("gmv").alias("gmv")).persist()
    try:
        # A day beyond the last stored one is no drop, one without a folder before it is.
        drops = gmv_drops(grain, last=min(last, held[-1]) if held else last)
        return undated | {
            "contract_violations": broken.count(),
            "grain_violations": grain.filter("n > 1").count(),
            "negative_days": quality.negative_days(gold).count(),
            "drop_alerts": drops.filter(F.col(DAY) >= F.lit(changed[0])).count(),
        }
    finally:
        grain.unpersist()
