"""Expected gold per window, and the semantics that decide it."""

import random
from datetime import date

import pytest
from fixture import D8, D18, D23, EXTRAS, FULL, ITEMS, PURCHASES, logs, rows

from daybook import (
    DateWindow,
    full_history_gmv,
    gmv_as_of,
    impacted_dates,
    resolve_window,
    state_complete_gmv,
    windowed_gmv,
)
from daybook.checks.monitor import gmv_drops
from daybook.checks.quality import negative_lines
from daybook.operators.state import gmv_lines, purchase_state
from daybook.plans.metric import multi_item_gmv
from daybook.schemas import GOLD


def window(first, last):
    return DateWindow(date.fromisoformat(f"2023-{first}"), date.fromisoformat(f"2023-{last}"))


def nothing_on(*days):
    return [(date.fromisoformat(f"2023-{d}"), None, None) for d in days]


@pytest.mark.parametrize(
    ("first", "last", "literal", "complete"),
    [
        ("02-03", "02-28", FULL, FULL),
        ("02-01", "02-28", FULL, FULL),
        ("02-08", "02-28", [*nothing_on("02-08"), D18, D23], FULL),
        ("02-14", "02-28", nothing_on("02-18", "02-23"), [D18, D23]),
        ("02-20", "02-28", nothing_on("02-23"), [D23]),
        ("02-18", "02-18", nothing_on("02-18"), [D18]),
        ("02-03", "02-15", [D8], FULL),
        ("02-24", "02-28", [], []),
        ("03-01", "03-31", [], []),
    ],
)
def test_gold_per_window(spark, first, last, literal, complete):
    events = logs(spark)
    assert rows(windowed_gmv(events, window(first, last))) == literal
    assert rows(state_complete_gmv(events, window(first, last))) == complete


def test_full_history_and_default_window(spark):
    events = logs(spark)
    assert rows(full_history_gmv(events)) == FULL
    assert resolve_window(events.purchase) == window("02-03", "02-28")


def test_as_of(spark):
    events = logs(spark)
    assert rows(gmv_as_of(events, date(2023, 2, 15))) == [D8]
    assert rows(gmv_as_of(events, date(2023, 2, 18))) == [D8, D18]


def test_window_parameters(spark):
    purchases = logs(spark).purchase
    assert resolve_window(purchases, "2023-02-01", "2023-02-28") == window("02-01", "02-28")
    assert resolve_window(purchases, end="2023-02-28") == DateWindow(
        date(2023, 1, 29), date(2023, 2, 28)
    )
    assert resolve_window(purchases, end="2023-02-28", days_back=2) == window("02-26", "02-28")
    assert resolve_window(purchases, start="2023-02-01", today=date(2023, 2, 11)) == window(
        "02-01", "02-10"
    )
    assert resolve_window(purchases.limit(0)) is None
    with pytest.raises(ValueError, match="after its end"):
        resolve_window(purchases, "2023-03-01", "2023-02-01")
    with pytest.raises(ValueError, match="after its end"):
        resolve_window(purchases, start="2023-02-11", today=date(2023, 2, 11))
    with pytest.raises(ValueError, match="does not match"):
        resolve_window(purchases, "01/02/2023", "2023-02-01")


def test_correction_moves_value_to_its_new_day(spark):
    moved = [*PURCHASES, ("2023-02-25 00:00:00", "56", "2023-01-14", "2023-02-23")]
    expected = [D18, D23, (date(2023, 2, 25), "internacional", 554.50)]
    assert rows(full_history_gmv(logs(spark, moved))) == expected


def test_purchase_sent_again_as_unpaid_leaves(spark):
    reversed_ = [*PURCHASES, ("2023-02-25 00:00:00", "29", "2023-01-14", None)]
    assert rows(full_history_gmv(logs(spark, reversed_))) == [D8, D18]


def test_impacted_dates_hold_old_and_new_day(spark):
    moved = [*PURCHASES, ("2023-02-25 00:00:00", "56", "2023-01-14", "2023-02-23")]
    found = impacted_dates(logs(spark, moved), window("02-24", "02-28")).collect()
    assert sorted(r[0] for r in found) == [date(2023, 2, 8), date(2023, 2, 25)]


def test_late_item_alone_impacts_its_purchase(spark):
    late = [*ITEMS, ("2023-03-02 00:00:00", "202", "19358", "5", "60.00")]
    events = logs(spark, items=late)
    expected = [(date(2023, 2, 18), "nacional", 800.90)]
    assert rows(state_complete_gmv(events, window("03-01", "03-31"))) == expected


def test_equal_times_have_one_winner(spark):
    tied = [
        *ITEMS,
        ("2023-02-20 00:00:00", "56", "81426", "1", "10.00"),
        ("2023-02-20 00:00:00", "56", "81426", "2", "7.00"),
        ("2023-02-20 00:00:00", "56", "81426", "2", "8.00"),
    ]
    for seed in range(3):
        random.Random(seed).shuffle(tied)
        gold = rows(full_history_gmv(logs(spark, items=tied)))
        assert gold[0] == (date(2023, 2, 8), "internacional", 16.00)


def test_missing_values(spark):
    purchases = [
        *PURCHASES,
        (None, "56", "2023-01-14", None),  # no time, no day: never seen
        ("2023-02-08 05:00:00", None, "2023-01-14", "2023-02-08"),  # no key: joins nothing
        ("2023-02-09 05:00:00", "900", "2023-01-14", "2023-02-09"),  # no item, no subsidiary
    ]
    items = [*ITEMS, ("2023-02-10 00:00:00", "901", "1", "1", "1.00")]  # no purchase
    gold = rows(full_history_gmv(logs(spark, purchases, items)))
    assert gold == [*nothing_on("02-08"), D8, *nothing_on("02-09"), D18, D23]


def test_event_without_time_loses_to_a_timed_one(spark):
    events = logs(spark)
    untimed = events.purchase.filter("purchase_id = '56'").selectExpr(
        "CAST(NULL AS TIMESTAMP_NTZ) AS transaction_datetime",
        "DATE'2023-02-27' AS transaction_date",
        *events.purchase.columns[2:],
    )
    grown = type(events)(
        events.purchase.unionByName(untimed), events.product_item, events.extra_info
    )
    assert rows(full_history_gmv(grown)) == FULL


def test_null_lines_are_skipped_not_zero(spark):
    no_value = [("2023-02-28 00:00:00", "202", "19358", "5", None)]
    gold = rows(full_history_gmv(logs(spark, items=[*ITEMS, *no_value])))
    assert gold[1] == (date(2023, 2, 18), "nacional", 500.90)


def test_values_outside_the_exact_range_still_count(spark):
    wild = [*ITEMS, ("2023-02-28 00:00:00", "202", "19358", "2", "1e20")]
    gold = rows(full_history_gmv(logs(spark, items=wild)))
    assert gold[1] == (date(2023, 2, 18), "nacional", 2e20 + 500.9)
    nan = [*ITEMS, ("2023-02-28 00:00:00", "202", "19358", "2", "NaN")]
    assert rows(full_history_gmv(logs(spark, items=nan)))[1][2] != 0


def test_fine_prices_round_once_at_the_end(spark):
    items = [
        ("2023-02-03 00:00:00", "56", "81426", "3", "10.555"),
        ("2023-02-03 00:00:00", "29", "81426", "1000", "0.0004"),
    ]
    gold = rows(full_history_gmv(logs(spark, items=items)))
    assert (gold[0][2], gold[2][2]) == (31.67, 0.40)


def test_several_products_of_a_purchase(spark):
    items = [*ITEMS, ("2023-02-20 00:00:00", "56", "99999", "1", "5.00")]
    events = logs(spark, items=items)
    assert rows(full_history_gmv(events))[0][2] == 5.00
    assert rows(multi_item_gmv(events))[0][2] == 559.50


def test_state_names_every_time_apart(spark):
    state = purchase_state(logs(spark).latest())
    assert len(set(state.columns)) == len(state.columns) == 16
    assert {c for c in state.columns if c.endswith("_datetime")} == {
        "purchase_transaction_datetime",
        "item_transaction_datetime",
        "extra_transaction_datetime",
    }
    lines = {r.purchase_id: r.gmv_value for r in gmv_lines(state).collect()}
    assert lines == {"56": 554.5, "202": 277.65, "78": 500.9, "29": 505.5}


def test_gold_sees_the_winner_silver_shows(spark):
    tied = [
        *PURCHASES,
        ("2023-02-23 02:00:00", "29", "2023-01-15", "2023-02-22"),
        ("2023-02-23 02:00:00", "29", "2023-01-15", None),
    ]
    latest = logs(spark, tied, ITEMS, EXTRAS).latest()
    pruned = logs(spark, tied, ITEMS, EXTRAS).latest_for_gold()
    for (_, wide), (_, narrow) in zip(latest.items(), pruned.items(), strict=True):
        columns = narrow.columns
        assert sorted(map(repr, wide.select(columns).collect())) == sorted(
            map(repr, narrow.collect())
        )


@pytest.mark.parametrize(
    ("quantity", "value", "line"),
    [("1000000000", "4e-9", 4.0), ("2", "-1e20", -2e20), ("3", "0.1234567891", 0.3703703673),
     ("3", "10.55", 31.65), ("2", "123456789012345.67", 246913578024691.34), ("2", "Infinity", float("inf"))],
)
def test_lines_of_any_price(spark, quantity, value, line):
    """A price that no decimal of eight places holds gives its double product, in lines and days."""
    items = [("2023-02-28 00:00:00", "202", "19358", quantity, value)]
    events = logs(spark, items=items)
    lines = gmv_lines(purchase_state(events.dated().latest_for_gold()))
    found = {r.purchase_id: r.gmv_value for r in lines.collect()}
    assert found["202"] == pytest.approx(line, rel=1e-12)
    day = [r for r in rows(full_history_gmv(events)) if r[0] == date(2023, 2, 18) and r[2] is not None]
    assert day[0][2] == pytest.approx(round(line, 2), rel=1e-12)
    assert negative_lines(lines).count() == (line < 0)


def gold_of(spark, *amounts):
    days = [(date(2023, 3, 1 + i), "a", v) for i, v in enumerate(amounts) if v != "no row"]
    return spark.createDataFrame(days, GOLD)


@pytest.mark.parametrize(
    ("amounts", "alerts"),
    [
        ([3.00, 2.40], []),
        ([3.00, 2.39], [(2, 2.39, 3.0)]),
        ([100.0, "no row", 5.0], [(2, 0.0, 100.0)]),
        ([100.0, None], [(2, 0.0, 100.0)]),
        ([100.0, "no row", "no row", 50.0], [(2, 0.0, 100.0)]),
        ([100.0, 100.0], []),
        ([-5.0, -6.0], []),
        ([None, None], []),
    ],
)
def test_drop_alert(spark, amounts, alerts):
    found = sorted(tuple(r) for r in gmv_drops(gold_of(spark, *amounts)).collect())
    assert found == [(date(2023, 3, d), v, b) for d, v, b in alerts]


def test_no_alert_without_gold(spark):
    assert gmv_drops(spark.createDataFrame([], GOLD)).isEmpty()
