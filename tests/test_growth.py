"""Steps whose time or shuffles grew faster than their input: what they read, parse and move."""

import gzip
from collections import Counter
from datetime import date

from fixture import PURCHASES, logs, raw_logs
from pyspark.sql import Row
from pyspark.sql import functions as F

from daybook.plans import incremental, ledger
from daybook.schemas import ARRIVAL, PURCHASE
from daybook.sinks.files import append_logs
from daybook.sources.bronze import bad_cells, conform, conform_marked
from daybook.streaming import ingest


def _plan(df, which="executedPlan"):
    return getattr(df._jdf.queryExecution(), which)().toString()


def test_raw_lines_are_not_kept(spark, tmp_path, monkeypatch):
    """A batch is read again where needed. Files of three layouts and one without a column are read in one
    scan, with cells short or quoted."""
    raw, typed, rejected = (str(tmp_path / n) for n in ("raw", "typed", "rejected"))
    append_logs(raw_logs(spark).map(lambda _, df: df.coalesce(1)), raw)
    names, cells = PURCHASE.names, ["2023-03-01 00:00:00", "2023-03-01", "90", "b", "p", "2023-03-01", "soon", "x,y"]
    layouts = {
        "back": (names[::-1], [f'"{c}"' for c in cells[::-1]]),
        "more": (["extra", *names], ["?", *cells[:4]]),
        "less": (names[1:], cells[1:]),
    }
    for name, (head, line) in layouts.items():
        (tmp_path / "raw" / "purchase" / f"{name}.csv").write_text(",".join(head) + "\n" + ",".join(line) + "\n\n")
    plans, replace = [], ingest._replace

    def seen(df, path, *partitions):
        plans.append(_plan(df))
        assert not spark.sparkContext._jsc.getPersistentRDDs()
        replace(df, path, *partitions)

    monkeypatch.setattr(ingest, "_replace", seen)
    ingest.ingest_new(spark, raw, typed, rejected)
    assert len(plans) > 6 and all(p.lower().count("from_csv") <= 1 for p in plans)
    found = {r.producer_id: r for r in ingest.read_arrivals(spark, typed).purchase.filter("purchase_id = '90'").collect()}
    assert set(found) == {"x,y", None}
    assert found["x,y"].prod_item_id == "p" and found[None].buyer_id == "b" and found[None].prod_item_id is None
    told = {r.table_name: (r.files, r.events, r.rejected_files, r.rejected_rows) for r in ingest.arrivals(spark, typed).collect()}
    assert told["purchase"] == (4, len(PURCHASES) + 2, 1, 1)
    assert spark.read.parquet(f"{rejected}/{ingest.BAD_ROWS}").filter("table_name = 'purchase'").first().bad_columns == "release_date"
    assert spark.read.parquet(f"{rejected}/{ingest.BAD_FILES}").count() == 2


def test_one_day_is_written_by_all_tasks(spark, monkeypatch):
    """Tasks hold equal shares however the days do, and grow in number with the batch."""
    monkeypatch.setattr(ingest, "EVENTS_PER_TASK", 100)
    day = F.when(F.col("id") < 2, F.lit(date(2023, 1, 1))).when(F.col("id") < 1990, F.lit(date(2023, 1, 2)))
    events = spark.range(2000).select(
        F.col("id").cast("string").alias("purchase_id"), day.alias("transaction_date"),
        F.lit(None).cast("timestamp_ntz").alias("transaction_datetime"))
    days = events.groupBy("transaction_date").agg(F.count(F.lit(1)).alias("events")).collect()
    spread = ingest._spread(events, days, 8)
    assert sorted(spread.collect()) == sorted(events.collect())
    sizes = [len(p) for p in spread.rdd.glom().collect()]
    assert len(sizes) == 20 and max(sizes) < 200


def test_rows_are_parsed_once_to_find_bad_cells(spark):
    """The conditions do not repeat the parsing below them, and hold no array function."""
    lines = spark.createDataFrame([("a,2023-13-01",), ("b,2023-12-01",)], "value string").withColumn("at", F.array(F.lit(0), F.lit(1)))
    schema = PURCHASE.__class__([PURCHASE["purchase_id"], PURCHASE["order_date"]])
    found = bad_cells(ingest._cells(lines, [[0, 1]], 2, schema), schema)
    assert [(r.purchase_id, r.bad_columns) for r in found.collect()] == [("a", ["order_date"])]
    plan = _plan(found, "optimizedPlan")
    assert plan.lower().count("from_csv") == 1
    assert not any("lambda" in line for line in plan.splitlines() if "Filter" in line)


def test_ledger_moves_events_once(spark):
    """One shuffle by purchase, for late entries too; the other sums entries."""
    events = logs(spark).map(lambda _, df: df.withColumn(ARRIVAL, F.lit(0).cast("long")))
    entries = ledger.change_ledger(logs(spark))
    assert _plan(entries).count("Exchange hashpartitioning(purchase_id") == 1
    late = ledger.late_entries(events, {"purchase": -1, "product_item": 0, "extra_info": 0}, 1 << 20)
    assert _plan(late).count("Window [") == _plan(entries).count("Window [")  # history is gone through once


def test_first_run_looks_for_no_purchases(spark, monkeypatch):
    """Where all paid events are new all paid days are impacted, without a shuffle of keys."""
    events = logs(spark).map(lambda _, df: df.withColumn(ARRIVAL, F.lit(0).cast("long")))
    expected = sorted(r[0] for r in incremental.impacted_dates(events, incremental.arrived_since({})).collect())

    def refused(*_):
        raise AssertionError("keys are looked for")

    some = incremental.find_impact(events, incremental.arrived_since({"purchase": 0}))
    assert len(some.days) <= len(expected) == some.paid_days
    monkeypatch.setattr(incremental, "touched_keys", refused)
    assert incremental.find_impact(events, incremental.arrived_since({})) == incremental.Impact(expected, len(expected))


def _odd_raw(spark, base):
    """Logs with a header in the midst of two files, a mark ahead of one, names that look like patterns, a
    file that is packed, one of a header alone and one that lacks a column."""
    append_logs(raw_logs(spark).map(lambda _, df: df.coalesce(1)), str(base))
    folder, names = base / "purchase", ",".join(PURCHASE.names)
    line = "2023-03-01 00:00:00,2023-03-01,{},b,p,2023-03-01,,x"
    back = ",".join(PURCHASE.names[::-1])
    (folder / "a[1] {x}*.csv").write_text("\n".join([names, line.format("90"), names, names, line.format("91"), " ", ""]))
    (folder / "mark.csv").write_text("﻿" + "\r\n".join([names, line.format("92")]), encoding="utf8")
    (folder / "back.csv").write_text("\n".join([back, "x,,2023-03-01,p,b,93,2023-03-01,2023-03-02 00:00:00", back, names]))
    (folder / "packed.csv.gz").write_bytes(gzip.compress(f"{names}\n{line.format('94')}\n".encode()))
    (folder / "bare.csv").write_text(names)
    (folder / "less.csv").write_text("purchase_id\n1\n\n2\n")


def test_headers_are_read_alone(spark, tmp_path, monkeypatch):
    """Names of files are streamed, not lines. Large files give a line each, small ones are read in one job;
    either way a line that repeats its file's header is a row, and only the header is none."""
    _odd_raw(spark, tmp_path / "raw")
    batches, take = [], ingest._take

    def seen(name, *more):
        def taken(batch, arrival):
            batches.append(batch.columns)
            return take(name, *more)(batch, arrival)

        return taken

    monkeypatch.setattr(ingest, "_take", seen)
    for small in (ingest.SMALL_FILE, 0):
        monkeypatch.setattr(ingest, "SMALL_FILE", small)
        typed, rejected = (str(tmp_path / f"{n}{small}") for n in ("typed", "rejected"))
        ingest.ingest_new(spark, str(tmp_path / "raw"), typed, rejected)
        told = {r.table_name: r for r in ingest.arrivals(spark, typed).collect()}["purchase"]
        events = len(PURCHASES) + 9
        assert (told.files, told.events, told.rejected_files, told.rejected_rows) == (7, events, 1, 4)
        assert (str(told.last_day), str(told.newest_event)) == ("2023-03-01", "2023-03-02 00:00:00")
        stored = ingest.read_arrivals(spark, typed).purchase
        assert stored.count() == events
        keys = [r.purchase_id for r in stored.filter("transaction_date IS NULL OR purchase_id >= '90'").collect()]
        assert sorted(keys) == ["90", "91", "92", "93", "94", "order_date", *["purchase_id"] * 3]
        bad = spark.read.parquet(f"{rejected}/{ingest.BAD_ROWS}").filter("table_name = 'purchase'").collect()
        assert len(bad) == 4 and "transaction_date" in bad[0].bad_columns
        aside = spark.read.parquet(f"{rejected}/{ingest.BAD_FILES}").collect()
        assert sorted(r.line for r in aside) == ["1", "2", "purchase_id"] and aside[0].file.endswith("/less.csv")
    assert batches == [["path", "file", "size"]] * 6


def test_clean_lines_are_parsed_by_two_scans(spark, tmp_path, monkeypatch):
    """Days are counted, of one parsed column; events are written, by day alone, with bad cells found on
    the way. No third scan looks for bad cells where there are none."""
    raw, typed, rejected = (str(tmp_path / n) for n in ("raw", "typed", "rejected"))
    append_logs(logs(spark), raw)
    plans, replace = {}, ingest._replace

    def seen(df, path, *partitions):
        plans[path.replace(str(tmp_path), "")] = (_plan(df, "optimizedPlan").lower(), partitions)
        replace(df, path, *partitions)

    monkeypatch.setattr(ingest, "_replace", seen)
    ingest.ingest_new(spark, raw, typed, rejected)
    written, partitions = plans["/typed/purchase/arrival=0"]
    assert written.count("from_csv") == 1 and partitions == ("transaction_date",)
    assert "from_csv" not in plans["/rejected/rows"][0]
    lines = ingest._read_lines(spark, [Row(path=f"{raw}/purchase")])
    head = ",".join(PURCHASE.names)
    told = lines.select("value", F.lit(head).alias("head"), F.array(*map(F.lit, range(8))).alias("at"))
    days, again = ingest._count_days(told, [list(range(8))], 8, PURCHASE, Counter({head: told.filter("value = head").count()}))
    assert sum(d["events"] for d in days) == len(PURCHASES) and not again


def test_marked_rows_are_those_with_bad_cells(spark):
    raw = raw_logs(spark, [("later", "1", "x", None), *PURCHASES]).purchase
    marked = conform_marked(raw, PURCHASE, "bad")
    assert marked.filter("bad").count() == bad_cells(raw, PURCHASE).count() == 1
    assert sorted(map(str, marked.drop("bad").collect())) == sorted(map(str, conform(raw, PURCHASE).collect()))
