"""Silver in slices: chained runs, what they write, and what they shuffle."""

import re
from datetime import date

import pytest
from fixture import EXTRAS, FULL, ITEMS, PURCHASES, logs, rows

from daybook import DateWindow, full_history_gmv, run_daily_gmv
from daybook.operators.state import daily_total, purchase_state
from daybook.plans.incremental import current_on, impacted_dates, touched_keys
from daybook.sinks.files import append_logs
from daybook.sinks.slices import PaidDays, SilverTables
from daybook.sources.gold import read_gold
from daybook.streaming.ingest import ingest_new, last_arrivals, read_arrivals

LATE = ("2023-02-24 00:00:00", "56", "2023-01-14", "2023-02-08")


@pytest.fixture
def silver(spark, tmp_path, request):
    prefix = "sliced_" + re.sub(r"\W", "_", request.node.name)
    made = SilverTables(spark, prefix, str(tmp_path / "silver"), slices=16)
    yield made
    for name in ("purchase", "product_item", "extra_info"):
        spark.sql(f"DROP TABLE IF EXISTS {made.of(name).name}")
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(prefix)]


def run(events, gold, silver, last, first="2023-02-01"):
    return run_daily_gmv(events, gold, start=first, end=last, silver_tables=silver)


def held(silver):
    return {n: sorted(map(str, df.collect())) for n, df in silver.logs().items()}


def test_chained_runs_equal_a_full_rebuild(spark, silver, tmp_path):
    gold = str(tmp_path / "gold")
    everything = logs(spark, [*PURCHASES, LATE])
    for last in ("2023-02-08", "2023-02-18", "2023-02-20", "2023-02-28"):
        run(everything.up_to(date.fromisoformat(last)), gold, silver, last)
        known = everything.up_to(date.fromisoformat(last))
        assert rows(read_gold(spark, gold)) == rows(full_history_gmv(known))
        assert silver.through() == date.fromisoformat(last)
        assert held(silver) == {n: sorted(map(str, df.collect())) for n, df in known.latest().items()}


def test_only_touched_slices_are_written(spark, silver, tmp_path):
    gold = str(tmp_path / "gold")
    run(logs(spark), gold, silver, "2023-02-28")
    before = silver.of("purchase").places()
    assert set(before) == {k for k, in logs(spark).purchase.select(silver.of("purchase").slice_of()).distinct().collect()}
    more = logs(spark, [*PURCHASES, ("2023-03-02 00:00:00", "56", "2023-01-14", "2023-02-08")])
    report = run(more, gold, silver, "2023-03-05", "2023-03-01")
    assert report.days_cleared == [date(2023, 2, 8)] and report.days_written == [date(2023, 3, 2)]
    after = silver.of("purchase").places()
    (touched,) = {k for k in after if after[k] != before.get(k)}
    assert logs(spark).purchase.filter("purchase_id = '56'").select(silver.of("purchase").slice_of()).first()[0] == touched
    assert silver.of("product_item").places().keys() == {
        k for k, in logs(spark).product_item.select(silver.of("purchase").slice_of()).distinct().collect()}


def test_history_is_not_shuffled(spark, silver, tmp_path):
    """Of three logs with all their history nothing moves by purchase; the sum per day is the one shuffle."""
    run(logs(spark), str(tmp_path / "gold"), silver, "2023-02-28")
    fresh = logs(spark, [LATE], ITEMS[:1], EXTRAS[:1])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    prepared = silver.prepare(fresh)
    try:
        days = [date(2023, 2, d) for d in (18, 24)]
        latest = current_on(prepared.logs(), days, lambda events: events, search=False)
        text = daily_total(purchase_state(latest))._jdf.queryExecution().executedPlan().toString()
        moved = re.findall(r"(?<!Broadcast)Exchange (\w+)\(([^)]*)\)", text)
        assert len(moved) == 1 and not moved[0][1].startswith("purchase_id")
        assert text.count("Bucketed: true") == 3
        assert rows(daily_total(purchase_state(latest)))[-1] == (date(2023, 2, 24), "internacional", 554.5)
    finally:
        prepared.forget()
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_run_that_fails_before_gold_changes_nothing(spark, silver, tmp_path, monkeypatch):
    """The next run still knows the state before, and with it the day that a purchase left."""
    gold = str(tmp_path / "gold")
    run(logs(spark), gold, silver, "2023-02-28")
    known, more = held(silver), logs(spark, [*PURCHASES, ("2023-03-02 00:00:00", "56", "2023-01-14", "2023-02-08")])
    from daybook.sinks.store import FolderGold

    def fails(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(FolderGold, "replace", fails)
    with pytest.raises(RuntimeError):
        run(more, gold, silver, "2023-03-05", "2023-03-01")
    monkeypatch.undo()
    assert held(silver) == known and silver.through() == date(2023, 2, 28) and rows(read_gold(spark, gold)) == FULL
    run(more, gold, silver, "2023-03-05", "2023-03-01")
    assert rows(read_gold(spark, gold)) == rows(full_history_gmv(more))


def test_other_snapshots_are_refused(spark, silver, tmp_path):
    with pytest.raises(ValueError, match="slices"):
        run_daily_gmv(logs(spark), str(tmp_path), silver_tables=silver, silver_path=str(tmp_path / "s"))


@pytest.fixture
def index(spark, tmp_path):
    made = PaidDays(spark, "paid_days_index", str(tmp_path / "index"), slices=16).create()
    yield made
    spark.sql("DROP TABLE paid_days_index")


def test_index_gives_the_impacted_days(spark, index):
    everything, window = logs(spark, [*PURCHASES, LATE]), DateWindow(date(2023, 2, 18), date(2023, 2, 24))
    for step in (everything.before(window.start), everything.within(window), everything.within(window)):
        index.add(step.purchase)
    index.add(everything.purchase.filter("transaction_date > DATE '2023-02-24'"))
    keys = touched_keys(everything, window)
    assert sorted(index.days_of(keys).collect()) == sorted(impacted_dates(everything, window).collect())
    for row in index.table.read().collect():
        assert row.days == sorted(set(row.days))


def test_only_slices_of_touched_purchases_are_read(spark, index):
    index.add(logs(spark).purchase)
    keys = logs(spark).purchase.filter("purchase_id IN ('56', '29')").select("purchase_id")
    text = index.days_of(keys)._jdf.queryExecution().executedPlan().toString()
    listed = re.search(r"PartitionFilters: \[.*?slice#\d+ IN \(([0-9,]+)\)", text)
    assert sorted(map(int, listed.group(1).split(","))) == index.table.touched(keys) and len(index.table.touched(keys)) == 2


def test_run_by_arrival_on_the_index(spark, index, tmp_path):
    raw, typed, gold = (str(tmp_path / n) for n in ("raw", "typed", "gold"))
    append_logs(logs(spark), raw)
    ingest_new(spark, raw, typed)
    run_daily_gmv(read_arrivals(spark, typed), gold, arrivals={}, paid_days=index)
    known = last_arrivals(spark, typed)
    append_logs(logs(spark, [LATE], [], []), raw)
    ingest_new(spark, raw, typed)
    report = run_daily_gmv(read_arrivals(spark, typed), gold, arrivals=known, paid_days=index)
    assert (report.days_written, report.days_cleared) == ([date(2023, 2, 24)], [date(2023, 2, 8)])
    assert rows(read_gold(spark, gold)) == rows(full_history_gmv(logs(spark, [*PURCHASES, LATE])))
    with pytest.raises(ValueError, match="arrival"):
        run_daily_gmv(logs(spark), gold, paid_days=index)
