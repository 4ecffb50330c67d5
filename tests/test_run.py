"""Runs of the job against stored gold."""

from datetime import date, timedelta

import pytest
from fixture import D8, D18, D23, EXTRAS, FULL, ITEMS, PURCHASES, logs, rows

from daybook import full_history_gmv, run_daily_gmv
from daybook.checks.monitor import gmv_drops
from daybook.checks.quality import contract_violations, grain_violations
from daybook.plans import run as job
from daybook.schemas import GOLD
from daybook.session import scratch_folder
from daybook.sinks import gold as sink
from daybook.sinks.files import Coverage, read_coverage, read_silver, write_silver
from daybook.sinks.store import PublishedGold
from daybook.sources.gold import daily_gmv_query, preview, read_gold

FEBRUARY = {"start": "2023-02-01", "end": "2023-02-28"}
MOVED = [*PURCHASES, ("2023-02-25 00:00:00", "56", "2023-01-14", "2023-02-23")]
REVERSED = [*PURCHASES, ("2023-02-25 00:00:00", "29", "2023-01-14", None)]
LATE = {"start": "2023-02-24", "end": "2023-03-31"}


@pytest.fixture
def gold(tmp_path):
    return str(tmp_path / "daily_gmv")


@pytest.mark.parametrize("mode", [job.LITERAL, job.STATE_COMPLETE])
@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_run_writes_gold(spark, gold, mode, fmt):
    report = run_daily_gmv(logs(spark), gold, mode=mode, gold_format=fmt)
    assert report.status == job.WRITTEN
    assert report.days_written == [d[0] for d in FULL]
    assert rows(read_gold(spark, gold, fmt)) == FULL
    assert report.metrics["purchase_events"] == 11
    assert report.metrics["gold_rows"] == 3
    assert report.as_frame(spark).count() == len(report.metrics)


def test_same_run_twice_gives_the_same_table(spark, gold):
    for _ in range(2):
        run_daily_gmv(logs(spark), gold, **FEBRUARY)
    assert rows(read_gold(spark, gold)) == FULL


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_moved_purchase_leaves_its_old_day(spark, gold, fmt):
    run_daily_gmv(logs(spark), gold, gold_format=fmt)
    report = run_daily_gmv(logs(spark, MOVED), gold, gold_format=fmt, **LATE)
    assert report.days_cleared == [date(2023, 2, 8)]
    expected = [D18, D23, (date(2023, 2, 25), "internacional", 554.50)]
    assert rows(read_gold(spark, gold, fmt)) == expected


def test_reversed_purchase_empties_its_day(spark, gold):
    run_daily_gmv(logs(spark), gold)
    report = run_daily_gmv(logs(spark, REVERSED), gold, **LATE)
    assert (report.status, report.days_written) == (job.WRITTEN, [])
    assert report.days_cleared == [date(2023, 2, 23)]
    assert rows(read_gold(spark, gold)) == [D8, D18]


def test_literal_run_keeps_stale_days(spark, gold):
    run_daily_gmv(logs(spark), gold)
    run_daily_gmv(logs(spark, REVERSED), gold, mode=job.LITERAL, **LATE)
    assert rows(read_gold(spark, gold)) == FULL
    run_daily_gmv(logs(spark, MOVED), gold, mode=job.LITERAL, **LATE)
    assert rows(read_gold(spark, gold)) == [*FULL, (date(2023, 2, 25), None, None)]


def test_days_outside_the_window_stay(spark, gold):
    run_daily_gmv(logs(spark), gold)
    kept = spark.createDataFrame([(date(2020, 1, 1), "x", 1.0)], GOLD)
    sink.overwrite_days(kept, gold)
    run_daily_gmv(logs(spark), gold, **FEBRUARY)
    assert rows(read_gold(spark, gold)) == [(date(2020, 1, 1), "x", 1.0), *FULL]


def test_session_overwrite_mode_is_untouched(spark, gold):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    run_daily_gmv(logs(spark), gold)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_nothing_to_do(spark, gold):
    run_daily_gmv(logs(spark), gold)
    march = {"start": "2023-03-01", "end": "2023-03-31"}
    unpaid = {"start": "2023-02-24", "end": "2023-02-28"}
    literal = {"mode": job.LITERAL}
    assert run_daily_gmv(logs(spark), gold, **literal, **march).status == job.NO_PURCHASES
    assert run_daily_gmv(logs(spark), gold, **literal, **unpaid).status == job.NO_PAID
    assert run_daily_gmv(logs(spark), gold, **march).status == job.NO_PAID
    assert run_daily_gmv(logs(spark).where("false"), gold).status == job.NO_DATES
    assert rows(read_gold(spark, gold)) == FULL


def test_nobody_paid_and_no_gold_yet(spark, gold):
    report = run_daily_gmv(logs(spark, REVERSED).up_to(date(2023, 2, 7)), gold)
    assert report.status == job.NO_PAID


def test_unknown_mode(spark, gold):
    with pytest.raises(ValueError, match="mode"):
        run_daily_gmv(logs(spark), gold, mode="other")


def test_snapshots_are_not_overwritten_while_read(spark, gold):
    with pytest.raises(ValueError, match="write elsewhere"):
        run_daily_gmv(logs(spark), gold, silver_path="/x", previous_silver="/x", **LATE)
    with pytest.raises(ValueError, match="state-complete"):
        run_daily_gmv(logs(spark), gold, mode=job.LITERAL, previous_silver="/x", **LATE)


@pytest.mark.parametrize("mode", [job.LITERAL, job.STATE_COMPLETE])
def test_silver_of_a_run(spark, gold, tmp_path, mode):
    silver = str(tmp_path / "silver")
    run_daily_gmv(logs(spark), gold, mode=mode, silver_path=silver, **LATE)
    found = read_silver(spark, silver)
    # A literal run replaces silver by its window; a state-complete one holds every purchase.
    assert found.purchase.count() == (1 if mode == job.LITERAL else 6)


def test_other_layout_beside_the_partitions_is_harmless(spark, gold):
    run_daily_gmv(logs(spark), gold, gold_format="csv")
    old = spark.createDataFrame(
        [("2023-02-08", "x", "1.0")], "transaction_date string, a string, b string"
    )
    old.write.mode("append").option("header", True).csv(gold)
    dated = read_gold(spark, gold, "csv").filter("transaction_date IS NOT NULL")
    assert rows(dated) == FULL


def test_named_table_and_query(spark, gold):
    run_daily_gmv(logs(spark), gold)
    spark.sql("CREATE DATABASE IF NOT EXISTS analytics")
    sink.create_external_table(spark, "analytics.daily_gmv", gold)
    assert spark.table("analytics.daily_gmv").count() == 0
    spark.sql("MSCK REPAIR TABLE analytics.daily_gmv")
    found = daily_gmv_query(spark, "analytics.daily_gmv")
    assert [tuple(r) for r in found.collect()] == FULL
    assert [tuple(r) for r in preview(found, 2).collect()] == FULL[:2]
    spark.sql("DROP TABLE analytics.daily_gmv")
    assert rows(read_gold(spark, gold)) == FULL


def test_decimal_table_holds_its_contract(spark, tmp_path):
    day = date(2023, 2, 8)
    found = spark.createDataFrame(
        [
            (day, "ok", 1.25),
            (None, "no day", 1.0),
            (day, None, 1.0),
            (day, "x" * 51, 1.0),
            (day, "no gmv", None),
            (day, "too much", 1e17),
        ],
        GOLD,
    )
    sink.create_decimal_table(spark, "daily_gmv_dw", str(tmp_path / "dw"))
    left = sink.fill_decimal_table(found, "daily_gmv_dw")
    assert [(r[1], str(r[2])) for r in spark.table("daily_gmv_dw").collect()] == [("ok", "1.25")]
    assert sorted(r.broken_rules for r in left.collect()) == [
        "gmv_null",
        "gmv_out_of_range",
        "subsidiary_null",
        "subsidiary_too_long",
        "transaction_date_null",
    ]
    assert contract_violations(spark.table("daily_gmv_dw")).isEmpty()
    spark.sql("DROP TABLE daily_gmv_dw")


def test_scratch_folders_are_new_and_shared(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch_folder(spark, "a"), scratch_folder(spark, "a")
    assert first != second
    assert base is None or first.startswith(base)


def test_late_subsidiary_change(spark, gold):
    run_daily_gmv(logs(spark), gold)
    extras = [*EXTRAS, ("2023-03-02 00:00:00", "56", "nacional")]
    run_daily_gmv(logs(spark, extras=extras), gold, **LATE)
    assert rows(read_gold(spark, gold)) == [(date(2023, 2, 8), "nacional", 554.50), D18, D23]


def test_one_purchase_with_most_events(spark, gold):
    """A third of all item events belong to one purchase: still one row of it per task shuffled."""
    events = logs(spark)
    many = spark.range(0, 30000, numPartitions=8).selectExpr(
        "TIMESTAMP_NTZ'2023-02-04 00:00:00' + make_dt_interval(0, 0, 0, id) AS transaction_datetime",
        "DATE'2023-02-04' AS transaction_date",
        "IF(id % 3 = 0, '56', CAST(id + 1000 AS STRING)) AS purchase_id",
        "'1' AS product_id",
        "1 AS item_quantity",
        "CAST(id AS DOUBLE) AS purchase_value",
    )
    grown = type(events)(
        events.purchase, events.product_item.unionByName(many), events.extra_info
    )
    run_daily_gmv(grown, gold)
    assert rows(read_gold(spark, gold))[0] == (date(2023, 2, 8), "internacional", 29997.0)


def test_snapshots_record_what_they_cover(spark, gold, tmp_path):
    silver = str(tmp_path / "silver")
    assert read_coverage(spark, silver) is None
    run_daily_gmv(logs(spark), gold, silver_path=silver, end="2023-02-20")
    assert read_coverage(spark, silver) == Coverage(date(2023, 2, 20), job.STATE_COMPLETE)


@pytest.mark.parametrize("mode", [job.LITERAL, None, "incomplete"])
def test_unsafe_snapshots_are_refused(spark, gold, tmp_path, mode):
    silver = str(tmp_path / "silver")
    if mode == job.LITERAL:
        run_daily_gmv(logs(spark), gold, mode=mode, silver_path=silver, end="2023-02-20")
    else:
        coverage = None if mode is None else Coverage(date(2023, 2, 7), mode)
        write_silver(logs(spark).latest(), silver, coverage=coverage).forget()
    with pytest.raises(ValueError, match="cannot build"):
        run_daily_gmv(logs(spark), gold, previous_silver=silver, **LATE)


def test_gap_after_snapshots_is_rebuilt(spark, gold, tmp_path):
    silver = str(tmp_path / "silver")
    early = logs(spark).up_to(date(2023, 2, 7))
    run_daily_gmv(early, gold, start="2023-02-01", end="2023-02-07", silver_path=silver)
    report = run_daily_gmv(
        logs(spark), gold, start="2023-02-18", end="2023-02-28", previous_silver=silver
    )
    assert report.window.start == date(2023, 2, 8)
    assert report.metrics["purchase_events"] == 8
    assert rows(read_gold(spark, gold)) == FULL


def test_figures_of_a_run_that_only_clears(spark, gold, tmp_path):
    run_daily_gmv(logs(spark), gold)
    figures = str(tmp_path / "figures")
    for _ in range(2):
        report = run_daily_gmv(logs(spark, REVERSED), gold, metrics_path=figures, **LATE)
    assert report.status == job.NO_PAID  # nothing left to clear
    stored = spark.read.parquet(figures)
    first = stored.filter("status = 'written'")
    assert {r.metric: r.value for r in first.collect()}["days_cleared"] == "1"
    assert {r.metric: r.value for r in first.collect()}["purchase_events"] == "12"
    assert {r.status for r in stored.collect()} == {job.WRITTEN, job.NO_PAID}


def test_clearing_takes_no_jobs(spark, gold):
    days = [date(2020, 1, 1 + i) for i in range(20)]
    tracker = spark.sparkContext.statusTracker()
    for count in (1, 20):
        sink.overwrite_days(spark.createDataFrame([(d, "x", 1.0) for d in days], GOLD), gold)
        spark.sparkContext.setJobGroup(f"clear-{count}", "")
        assert sink.clear_days(spark, gold, days[:count]) == days[:count]
        assert list(tracker.getJobIdsForGroup(f"clear-{count}")) == []
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert [r[0] for r in rows(read_gold(spark, gold))] == days[count:]
        if count == 20:
            assert sink.clear_days(spark, gold, days) == []


def test_paths_with_quotes(spark, tmp_path):
    path = str(tmp_path / "it's")
    run_daily_gmv(logs(spark), path)
    run_daily_gmv(logs(spark, REVERSED), path, **LATE)
    sink.register_gold(spark, "quoted_gold", path)
    assert spark.table("quoted_gold").count() == 2
    spark.sql("DROP TABLE quoted_gold")


def test_checks_of_a_run(spark, gold, tmp_path):
    rejected = str(tmp_path / "rejected")
    purchases = [*PURCHASES, ("2023-02-26 00:00:00", "999", "2023-01-14", "2023-02-26"), (None, "5", None, None)]
    report = run_daily_gmv(logs(spark, purchases), gold, quarantine_path=rejected)
    m = report.metrics
    assert (m["undated_purchase"], m["undated_product_item"], m["undated_extra_info"]) == (1, 0, 0)
    assert (m["contract_violations"], m["grain_violations"], m["negative_days"]) == (1, 0, 0)
    # Every day without sales after one with sales: the 9th, the 19th, the 24th; and the 26th has none.
    assert m["drop_alerts"] == 3
    (row,) = sink.read_quarantine(spark, rejected).collect()
    assert (row.transaction_date, row.broken_rules) == (date(2023, 2, 26), "subsidiary_null,gmv_null")
    assert run_daily_gmv(logs(spark), gold, checks=False).metrics.keys().isdisjoint({"drop_alerts"})


def test_grain_of_stored_gold(spark, gold):
    run_daily_gmv(logs(spark), gold)
    assert grain_violations(read_gold(spark, gold)).isEmpty()
    again = read_gold(spark, gold).filter("transaction_date = DATE'2023-02-08'")
    again.write.mode("append").partitionBy("transaction_date").parquet(gold)
    assert [r.transaction_date for r in grain_violations(read_gold(spark, gold)).collect()] == [date(2023, 2, 8)]


def test_rejected_rows_of_the_decimal_table_are_stored(spark, tmp_path):
    found = spark.createDataFrame([(date(2023, 2, 8), "ok", 1.25), (None, "no day", 1.0)], GOLD)
    sink.create_decimal_table(spark, "daily_gmv_kept", str(tmp_path / "dw"))
    left = sink.fill_decimal_table(found, "daily_gmv_kept", str(tmp_path / "rejected"))
    assert [r.broken_rules for r in left.collect()] == ["transaction_date_null"]
    assert spark.table("daily_gmv_kept").count() == 1
    spark.sql("DROP TABLE daily_gmv_kept")


def test_alerts_of_a_run_see_the_days_it_did_not_change(spark, gold):
    """Days 8 and 10 are rebuilt, day 9 between them holds its amount in gold."""
    kept = [(date(2023, 2, d), "nacional", 540.0) for d in (7, 9)]
    sink.overwrite_days(spark.createDataFrame(kept, GOLD), gold)
    purchases = [*PURCHASES[:6], ("2023-02-10 00:00:00", "70", "2023-01-24", "2023-02-10")]
    report = run_daily_gmv(logs(spark, purchases), gold, start="2023-02-08", end="2023-02-10")
    assert report.days_written == [date(2023, 2, 8), date(2023, 2, 10)]
    assert report.metrics["drop_alerts"] == 0


def _gold(spark, *amounts):
    return spark.createDataFrame([(date(2023, 2, d), "nacional", float(v)) for d, v in amounts], GOLD)


def _paid(day, key, quantity):
    at = f"2023-02-{day:02} 00:00:00"
    return (at, key, "2023-01-01", at[:10]), (at, key, "1", str(quantity), "1.00"), (at, key, "nacional")


def _run_alerts(spark, gold, events, start, end):
    """The run's count, and that of whole gold between the first changed day and the day after the last."""
    report = run_daily_gmv(logs(spark, *map(list, zip(*events))), gold, start=start, end=end)
    changed = sorted([*report.days_written, *report.days_cleared])
    drops = gmv_drops(read_gold(spark, gold)).collect()
    seen = [d for d in drops if changed[0] <= d.transaction_date <= changed[-1] + timedelta(days=1)]
    return report.metrics["drop_alerts"], len(seen)


def test_a_cleared_last_day_is_a_drop_if_gold_goes_on(spark, gold):
    sink.overwrite_days(_gold(spark, (10, 100), (11, 100), (12, 100)), gold)
    taken_back = ("2023-02-11 01:00:00", "b", "2023-01-01", None)
    events = [_paid(10, "a", 100), _paid(11, "b", 100), _paid(12, "c", 100)]
    events.append((taken_back, *_paid(11, "b", 100)[1:]))
    assert _run_alerts(spark, gold, events, "2023-02-11", "2023-02-11") == (1, 1)


def test_a_raised_day_makes_the_next_one_a_drop(spark, gold):
    sink.overwrite_days(_gold(spark, (10, 100), (11, 100)), gold)
    events = [_paid(10, "a", 200), _paid(11, "b", 100)]
    assert _run_alerts(spark, gold, events, "2023-02-10", "2023-02-10") == (1, 1)


def test_a_cleared_day_at_the_end_of_gold_is_no_drop(spark, gold):
    sink.overwrite_days(_gold(spark, (10, 100), (11, 100)), gold)
    events = [_paid(10, "a", 100), _paid(11, "b", 100)]
    events.append((("2023-02-11 01:00:00", "b", "2023-01-01", None), *_paid(11, "b", 100)[1:]))
    assert _run_alerts(spark, gold, events, "2023-02-11", "2023-02-11") == (0, 0)


def test_a_repeated_run_stores_rejected_rows_once(spark, gold, tmp_path):
    rejected = str(tmp_path / "rejected")
    for _ in range(2):
        run_daily_gmv(logs(spark, items=ITEMS[1:]), gold, quarantine_path=rejected)
        (row,) = sink.read_quarantine(spark, rejected).collect()
        assert (row.transaction_date, row.broken_rules) == (date(2023, 2, 8), "gmv_null")
    run_daily_gmv(logs(spark), gold, quarantine_path=rejected)  # the item has come
    assert sink.read_quarantine(spark, rejected).isEmpty()


def test_published_gold_is_right_after_each_run(spark, tmp_path):
    """The table is read by name; a moved amount leaves its old day, emptied days leave the table."""
    base = str(tmp_path / "pub'lished")
    options = {"gold_table": "gold_switched"}
    run_daily_gmv(logs(spark), base, **options)
    assert rows(spark.table("gold_switched")) == FULL
    moved = [*PURCHASES, ("2023-02-24 00:00:00", "56", "2023-01-14", "2023-02-08")]
    report = run_daily_gmv(logs(spark, moved), base, start="2023-02-24", end="2023-02-28", **options)
    assert report.days_cleared == [D8[0]] and report.metrics["grain_violations"] == 0
    assert rows(spark.table("gold_switched")) == [D18, D23, (date(2023, 2, 24), *D8[1:])]
    assert rows(daily_gmv_query(spark, "gold_switched")) == rows(full_history_gmv(logs(spark, moved)))
    spark.sql("DROP TABLE gold_switched")


def test_readers_never_see_an_amount_twice(spark, tmp_path, monkeypatch):
    """Between any two statements of the switch, the old and the new day of an amount are never both there."""
    store = PublishedGold(spark, "gold_watched", str(tmp_path / "gold")).create()
    store.replace(_gold(spark, (8, 100), (9, 50)), [date(2023, 2, 8), date(2023, 2, 9)], [])
    seen, alter = [], PublishedGold._alter

    def watched(self, action, entries):
        alter(self, action, entries)
        seen.append(rows(spark.table("gold_watched")))

    monkeypatch.setattr(PublishedGold, "_alter", watched)
    store.replace(_gold(spark, (9, 150)), [date(2023, 2, 9)], [date(2023, 2, 8)])
    assert seen == [[], [(date(2023, 2, 9), "nacional", 150.0)]]
    spark.sql("DROP TABLE gold_watched")
