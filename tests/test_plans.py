"""Shapes the physical plans must keep to hold at scale."""

import re
from datetime import date, timedelta

import pytest
from fixture import logs

from daybook import DateWindow, full_history_gmv, impacted_dates, state_complete_gmv, windowed_gmv
from daybook.checks.monitor import gmv_drops
from daybook.operators.latest import latest_by
from daybook.operators.state import daily_total, purchase_state
from daybook.plans.incremental import (
    ROW_OVERHEAD,
    fits_broadcast,
    impacted_by_fold,
    on_days,
    only_of,
)
from daybook.sinks.files import append_logs, read_silver, write_silver
from daybook.sources.bronze import read_logs

WINDOW = DateWindow(date(2023, 2, 3), date(2023, 2, 28))
ONE_DAY = DateWindow(date(2023, 2, 18), date(2023, 2, 18))  # of three days with payments


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return re.findall(r"(?<!Broadcast)Exchange (\w+)\(([^)]*)\)", text)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("bronze"))
    append_logs(logs(spark), base, "parquet")
    return read_logs(spark, base, "parquet")


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_one_shuffle_per_log_and_one_for_the_sum(stored, no_broadcast):
    for df in (full_history_gmv(stored), windowed_gmv(stored, WINDOW)):
        keys = [k for _, k in exchanges(plan(df))]
        assert sum(k.startswith("purchase_id") for k in keys) == 3
        assert len(keys) == 4


def branches(text):
    """The part of a plan below each shuffle by purchase that ends in a semi-join or a scan."""
    return re.findall(r"Exchange hashpartitioning\(purchase_id[^\n]*\n(.*?)(?=Exchange hashp|\Z)", text, re.S)


def test_rebuild_filters_history_before_its_shuffle(stored, no_broadcast):
    text = plan(state_complete_gmv(stored, ONE_DAY))
    logs = [b for b in branches(text) if "LeftSemi" in b]
    assert len(logs) == 3 and text.count("BroadcastHashJoin") == 3


def test_rebuild_without_broadcast_is_the_full_plan(stored, no_broadcast):
    text = plan(state_complete_gmv(stored, ONE_DAY, broadcast_bytes=0))
    assert "Broadcast" not in text
    assert len(exchanges(text)) == 4


def test_candidates_are_looked_for_in_their_day_folders(stored):
    text = plan(on_days(stored.purchase, [date(2023, 2, 8)]))
    assert re.search(r"PartitionFilters: \[[^]]*transaction_date#\d+ = 2023-02-08", text)


def test_many_days_are_joined_not_listed(spark, stored):
    """The plan has their range and prunes by the joined days; it does not grow with their number."""
    days = [date(2023, 1, 1) + timedelta(days=2 * d) for d in range(60)]
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        text = plan(on_days(stored.purchase, days))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pruned = re.search(r"PartitionFilters: \[(.*?)\], Pushed", text).group(1)
    assert "dynamicpruning" in pruned and ">= 2023-01-01" in pruned and "<= 2023-04-29" in pruned
    assert "2023-01-03" not in text and " IN (" not in text and "INSET" not in text


def test_rebuild_of_most_days_looks_for_no_purchases(stored, no_broadcast):
    text = plan(state_complete_gmv(stored, WINDOW))
    assert "BroadcastHashJoin" not in text and len(exchanges(text)) == 4


def test_impacted_days_shuffle_no_history(stored, no_broadcast):
    text = plan(impacted_dates(stored, WINDOW))
    assert [k.split("#")[0] for _, k in exchanges(text)] == ["transaction_date", "purchase_id"]
    # The one shuffle by purchase is that of the window's keys, below the broadcast.
    assert text.index("BroadcastExchange") < text.index("Exchange hashpartitioning(purchase_id")


def test_impacted_days_of_a_wide_window_take_one_shuffle_by_purchase(stored, no_broadcast):
    for df in (impacted_by_fold(stored, WINDOW), impacted_dates(stored, WINDOW, broadcast_bytes=0)):
        text = plan(df)
        assert "Broadcast" not in text
        assert [k.split("#")[0] for _, k in exchanges(text)] == ["transaction_date", "purchase_id"]


def test_stored_silver_joins_without_a_shuffle(spark, stored, no_broadcast, tmp_path):
    """Three shuffles by purchase to resolve the logs, none to join what was stored."""
    latest = stored.dated().latest()
    keys = [k for name, df in latest.items() for _, k in exchanges(plan(df))]
    assert len(keys) == 3 and all(k.startswith("purchase_id") for k in keys)
    silver = write_silver(latest, str(tmp_path / "silver"))
    text = plan(daily_total(purchase_state(silver.logs)))
    assert [k.split("#")[0] for _, k in exchanges(text)] == ["purchase_transaction_date"]
    silver.forget()
    assert not [t for t in spark.catalog.listTables() if t.name in silver.tables]
    assert read_silver(spark, str(tmp_path / "silver")).purchase.count() == 6


def test_rows_shrink_before_the_shuffle(stored):
    text = plan(latest_by(stored.product_item, ["purchase_id"], ["transaction_datetime"]))
    assert text.index("functions=[max(") < text.index("Exchange") < text.index("partial_max(")


def test_gold_reads_only_the_columns_it_needs(stored):
    text = plan(full_history_gmv(stored))
    assert "buyer_id" not in text and "product_id" not in text and "order_date" not in text


def test_window_prunes_folders_of_all_logs(stored):
    text = plan(windowed_gmv(stored, WINDOW))
    assert len(re.findall(r"PartitionFilters: \[isnotnull\(transaction_date", text)) == 3


def test_no_global_sort_join_explosion_or_python(stored):
    gold = full_history_gmv(stored)
    for df in (gold, impacted_dates(stored, WINDOW), gmv_drops(gold)):
        text = plan(df).split("===== Subqueries =====")[0].split("Subquery")[0]
        for bad in ("rangepartitioning", "SinglePartition", "NestedLoop", "Cartesian", "Python"):
            assert bad not in text


def test_keys_are_measured_before_they_are_broadcast(stored):
    purchases = stored.purchase
    size = sum(len(r.purchase_id) + ROW_OVERHEAD for r in purchases.collect())
    assert fits_broadcast(purchases) and fits_broadcast(purchases, size)
    assert not fits_broadcast(purchases, size - 1)
    assert fits_broadcast(purchases.limit(0), 1)
    assert not fits_broadcast(purchases.limit(0), 0)
    text = plan(only_of(stored.product_item, purchases))
    assert "LeftSemi" in text and "hashpartitioning" not in text
