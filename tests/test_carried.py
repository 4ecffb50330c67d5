"""Figures that are carried or merged instead of computed from all history."""

import random
from datetime import date, timedelta

import pytest

from daybook.checks.monitor import duplicates
from daybook.checks.pending import carry_unmatched, overdue
from daybook.checks.quality import gmv_anomalies, unmatched
from daybook.checks.sketches import amount_sketches, day_sketches, estimated_duplicates, gmv_outliers
from daybook.logs import EventLogs
from daybook.schemas import GOLD

EVENTS = "purchase_id string, transaction_date date"
START = date(2023, 1, 2)


def keyed(spark, rows):
    return spark.createDataFrame([(k, START + timedelta(days=d)) for k, d in rows], EVENTS)


@pytest.mark.parametrize("seed", range(4))
def test_carried_keys_equal_the_full_join(spark, seed):
    rng = random.Random(seed)
    keys = [*map(str, range(40)), None]
    sides = [[(rng.choice(keys), rng.randrange(30)) for _ in range(60)] for _ in range(2)]
    steps = [rng.randrange(3) for _ in range(60)], [rng.randrange(3) for _ in range(60)]
    pending = known = None
    for step in range(3):
        events, other = ([r for r, s in zip(side, which) if s == step] for side, which in zip(sides, steps))
        other = keyed(spark, other)
        pending = carry_unmatched(pending, keyed(spark, events), other, known)
        known = other if known is None else known.union(other)
    want = unmatched(keyed(spark, sides[0]), keyed(spark, sides[1])).collect()
    got = {r.purchase_id: (r.events, r.first_day) for r in pending.collect()}
    first = {k: START + timedelta(days=min(d for key, d in sides[0] if key == k)) for k in got}
    assert got == {r.purchase_id: (r.events, first[r.purchase_id]) for r in want}
    late = {r.purchase_id: r.age for r in overdue(pending, START + timedelta(days=30), 20).collect()}
    assert late == {k: (START + timedelta(days=30) - d).days for k, d in first.items() if d < START + timedelta(days=10)}


def test_merged_day_sketches_match_one_of_all_days(spark):
    rows = [(str(i % 3000), i % 20) for i in range(12_000)] + [(None, 1)] * 5 + [("hot", d) for d in range(20)] * 50
    df = keyed(spark, rows)
    logs = EventLogs(df, df.limit(0), df.filter("purchase_id = 'hot'"))
    days = day_sketches(logs)
    found = {r.table_name: r for r in estimated_duplicates(days).collect()}
    whole = {r.table_name: r for r in estimated_duplicates(
        day_sketches(logs.map(lambda _, d: d.selectExpr("purchase_id", f"DATE '{START}' AS transaction_date")))).collect()}
    exact = {r.table_name: r for r in duplicates(logs.where("purchase_id IS NOT NULL")).collect()}
    assert set(found) == set(whole) == {"purchase", "extra_info"}
    assert found["purchase"].purchases == pytest.approx(whole["purchase"].purchases, rel=0.02)
    assert found["purchase"].events == exact["purchase"].events
    assert found["purchase"].purchases == pytest.approx(exact["purchase"].purchases, rel=0.05)
    assert found["extra_info"].purchases == 1 and found["extra_info"].superseded == 999
    part = {r.table_name: r.events for r in estimated_duplicates(days, START, START + timedelta(days=1)).collect()}
    assert part["extra_info"] == 100


def test_outliers_in_a_row_are_both_found(spark):
    """A mean and deviation lose the second of two; a median and quartiles keep both."""
    rng = random.Random(2)
    rows = [(START + timedelta(days=d), "nacional", 100.0 + rng.randrange(10)) for d in range(140)]
    rows[100], rows[101] = (rows[100][0], "nacional", 900.0), (rows[101][0], "nacional", 400.0)
    rows += [(START + timedelta(days=d), "few", 5.0 * d) for d in range(20)] + [(START, "null", None), (START, None, 1.0)]
    gold = spark.createDataFrame(rows, GOLD)
    planted = {rows[100][0], rows[101][0]}
    assert {r.transaction_date for r in gmv_anomalies(gold).collect()} & planted == {rows[100][0]}
    found = gmv_outliers(gold, amount_sketches(gold)).collect()
    assert {r.transaction_date for r in found} == planted and {r.subsidiary for r in found} == {"nacional"}
