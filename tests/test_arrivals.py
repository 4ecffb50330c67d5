"""Files taken once, and gold rebuilt by what has arrived."""

from datetime import date

import pytest
from fixture import EXTRAS, FULL, ITEMS, PURCHASES, logs, raw_logs, rows

import job
from daybook import full_history_gmv, run_daily_gmv
from daybook.plans import ledger
from daybook.plans.run import NOTHING_NEW
from daybook.sinks.files import append_logs
from daybook.sources.gold import read_gold
from daybook.streaming import ingest
from daybook.streaming.ingest import arrivals, ingest_new, last_arrivals, read_arrivals, typed_bounds


@pytest.fixture
def lake(tmp_path):
    return [str(tmp_path / n) for n in ("raw", "typed", "gold", "rejected")]


def counts(spark, typed):
    found = arrivals(spark, typed).collect()
    return sorted((r.table_name, r.arrival, r.files, r.events, r.rejected_files, r.rejected_rows) for r in found)


def events(spark, typed):
    return [df.count() for _, df in read_arrivals(spark, typed).items()]


def test_files_are_taken_once(spark, lake):
    raw, typed, _, _ = lake
    append_logs(logs(spark).map(lambda _, df: df.coalesce(1)), raw)
    ingest_new(spark, raw, typed)
    first = counts(spark, typed)
    bounds = {r.table_name: (r.min_date, r.max_date, str(r.newest_event)) for r in typed_bounds(spark, typed).collect()}
    assert bounds["purchase"] == (date(2023, 2, 3), date(2023, 2, 28), "2023-02-28 08:00:00")
    assert first == [("extra_info", 0, 1, 7, 0, None), ("product_item", 0, 1, 7, 0, None), ("purchase", 0, 1, 11, 0, None)]
    ingest_new(spark, raw, typed)
    assert counts(spark, typed) == first and events(spark, typed) == [11, 7, 7]


def test_a_failed_batch_is_repeated_without_doubles(spark, lake, monkeypatch):
    """The batch fails after its events are stored and before it counts as done."""
    raw, typed, _, rejected = lake
    bad = [*PURCHASES, ("later", "1", "x", None)]
    append_logs(raw_logs(spark, bad).map(lambda _, df: df.coalesce(1)), raw)
    replace = ingest._replace

    def fails(df, path, *partitions):
        if path.endswith(ingest.ARRIVALS):
            raise RuntimeError("lost")
        replace(df, path, *partitions)

    monkeypatch.setattr(ingest, "_replace", fails)
    with pytest.raises(Exception, match="lost"):
        ingest_new(spark, raw, typed, rejected)
    monkeypatch.undo()
    ingest_new(spark, raw, typed, rejected)
    assert events(spark, typed) == [12, 7, 7]
    assert spark.read.parquet(f"{rejected}/rows").count() == 1
    assert [c[:2] for c in counts(spark, typed)] == [("extra_info", 0), ("product_item", 0), ("purchase", 0)]


def test_odd_files_are_put_aside_whole(spark, lake, tmp_path):
    raw, typed, _, rejected = lake
    append_logs(logs(spark).map(lambda _, df: df.coalesce(1)), raw)
    folder = tmp_path / "raw" / "purchase"
    names = "release_date,purchase_id,extra,transaction_date,transaction_datetime,order_date,buyer_id,prod_item_id,producer_id"
    (folder / "other.csv").write_text(f'{names}\r\n,"9,9",e,2023-02-03,2023-02-03 01:02:03,2023-01-01,1,"a, b",3\r\n\r\n')
    (folder / "short.csv").write_text("purchase_id,transaction_date\n1,2023-02-03\n")
    (folder / "twice.csv").write_text(f"{names},purchase_id\n")
    (folder / "empty.csv").write_text("")
    (folder / "_hidden.csv").write_text("x\n")
    ingest_new(spark, raw, typed, rejected)
    assert counts(spark, typed)[2] == ("purchase", 0, 4, 12, 2, 0)
    row = read_arrivals(spark, typed).purchase.filter("purchase_id = '9,9'").first()
    assert (row.prod_item_id, row.release_date, row.transaction_date) == ("a, b", None, date(2023, 2, 3))
    lines = spark.read.parquet(f"{rejected}/files").collect()
    assert sorted(r.line[:16] for r in lines) == ["1,2023-02-03", "purchase_id,tran", "release_date,pur"]


def test_an_old_event_that_arrives_last_reaches_gold(spark, lake):
    raw, typed, gold, _ = lake
    append_logs(logs(spark), raw)
    ingest_new(spark, raw, typed)
    assert run_daily_gmv(read_arrivals(spark, typed), gold, arrivals={}).days_written == [d for d, *_ in FULL]
    known = last_arrivals(spark, typed)
    assert run_daily_gmv(read_arrivals(spark, typed), gold, arrivals=known).status == NOTHING_NEW
    # Purchase 56, paid on the 8th, turns out to have been taken back then; 70 paid two years before.
    late = [("2023-02-08 01:00:00", "56", "2023-01-14", None), ("2021-01-05 00:00:00", "71", "2021-01-01", "2021-01-05")]
    more = logs(spark, late, [("2020-12-31 00:00:00", "71", "1", "2", "3.00")], [("2020-12-31 00:00:00", "71", "nacional")])
    append_logs(more, raw)
    ingest_new(spark, raw, typed)
    report = run_daily_gmv(read_arrivals(spark, typed), gold, arrivals=known)
    assert (report.days_written, report.days_cleared) == ([date(2021, 1, 5)], [date(2023, 2, 8)])
    everything = logs(spark, PURCHASES + late, ITEMS + [("2020-12-31 00:00:00", "71", "1", "2", "3.00")],
                      EXTRAS + [("2020-12-31 00:00:00", "71", "nacional")])
    assert rows(read_gold(spark, gold)) == rows(full_history_gmv(everything))
    with pytest.raises(ValueError, match="arrival"):
        run_daily_gmv(read_arrivals(spark, typed), gold, arrivals=known, start="2023-02-01")


def test_job_by_arrival(spark, lake, tmp_path):
    """The daily job without any dates; a second call on the same files changes nothing."""
    raw, typed, gold, rejected = lake
    call = ["--bronze-base", raw, "--typed-base", typed, "--gold-base", gold, "--quarantine-base", rejected,
            "--progress-path", str(tmp_path / "progress")]
    append_logs(logs(spark), raw)
    job.main(call)
    job.main(call)
    assert rows(read_gold(spark, f"{gold}/daily_gmv")) == FULL


def test_ledger_of_runs(spark, lake, tmp_path):
    """Entries of late events, appended, make the ledger equal to one written at once; so do they when the
    run is repeated."""
    raw, typed, _, _ = lake
    path = str(tmp_path / "ledger")
    append_logs(logs(spark, PURCHASES[:7], ITEMS[3:], EXTRAS[:5]), raw)
    ingest_new(spark, raw, typed)
    known = last_arrivals(spark, typed)
    ledger.append_entries(ledger.change_ledger(read_arrivals(spark, typed)), path, 0)
    append_logs(logs(spark, PURCHASES[7:], ITEMS[:3], EXTRAS[5:]), raw)
    ingest_new(spark, raw, typed)
    for limit in (0, 1 << 20):
        ledger.append_entries(ledger.late_entries(read_arrivals(spark, typed), known, limit), path, 1)
    stored = ledger.read_ledger(spark, path)
    for day in (None, *(date(2023, 2, d) for d in (3, 8, 17, 18, 23, 28))):
        events = logs(spark) if day is None else logs(spark).up_to(day)
        assert rows(ledger.gmv_as_known(stored, day)) == rows(full_history_gmv(events))
