"""Random event logs: input order never matters, and rebuilding impacted days equals rebuilding all."""

import random
from datetime import date, datetime, timedelta

import pytest
from fixture import logs, rows

from daybook import DateWindow, full_history_gmv, run_daily_gmv, state_complete_gmv
from daybook.plans import incremental
from daybook.sources.gold import read_gold

FIRST = datetime(2023, 1, 1)
LATE_FROM = 20
LAST = 30


def _events(seed):
    """Life cycles over thirty days with few keys, equal times, reversals and missing parts."""
    pick = random.Random(seed)

    def at(first=0):
        return str(FIRST + timedelta(days=pick.randrange(first, LAST), hours=pick.choice([0, 6])))

    keys = [str(k) for k in range(12)]
    purchases = [
        (at(), k, "2023-01-01", pick.choice([None, "2023-01-05", "2023-01-06"]))
        for k in keys
        for _ in range(pick.randrange(1, 6))
    ]
    items = [
        (at(), k, str(pick.randrange(3)), str(pick.randrange(1, 5)), f"{pick.random() * 100:.2f}")
        for k in keys
        for _ in range(pick.randrange(0, 4))
    ]
    extras = [
        (at(), k, pick.choice(["a", "b", None])) for k in keys for _ in range(pick.randrange(0, 3))
    ]
    return purchases, items, extras


@pytest.mark.parametrize("seed", range(4))
def test_input_order_does_not_matter(spark, seed):
    events = _events(seed)
    first = rows(full_history_gmv(logs(spark, *events)))
    for part in events:
        random.Random(seed + 1).shuffle(part)
    again = logs(spark, *events).map(lambda _, df: df.repartition(5))
    assert rows(full_history_gmv(again)) == first


@pytest.mark.parametrize("limit", [incremental.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("seed", range(3))
def test_late_run_equals_full_rebuild(spark, tmp_path, seed, limit):
    """With the keys of the rebuilt days broadcast, and with the way taken when they are many."""
    events = logs(spark, *_events(100 + seed))
    cut = (FIRST + timedelta(days=LATE_FROM)).date()
    window = DateWindow(cut, date(2023, 2, 28))
    gold = str(tmp_path / "gold")
    run_daily_gmv(events.before(cut), gold, start="2022-12-01", end=cut - timedelta(days=1))
    run_daily_gmv(events, gold, start=window.start, end=window.end, broadcast_bytes=limit)
    whole = rows(full_history_gmv(events))
    assert rows(read_gold(spark, gold)) == whole
    rebuilt = rows(state_complete_gmv(events, window, limit))
    assert rebuilt == [r for r in whole if r[0] in {b[0] for b in rebuilt}]


@pytest.mark.parametrize("seed", range(3))
def test_both_ways_to_impacted_days_agree(spark, seed):
    events = logs(spark, *_events(400 + seed))
    for first, last in ((5, 6), (20, 30), (1, 30)):
        window = DateWindow(date(2023, 1, first), date(2023, 1, last))
        days = [sorted(r[0] for r in df.collect()) for df in (
            incremental.impacted_dates(events, window),
            incremental.impacted_dates(events, window, 0),
        )]
        assert days[0] == days[1]


@pytest.mark.parametrize("seed", range(2))
def test_gap_between_snapshots_and_window(spark, tmp_path, seed):
    """Days that no run has seen count as part of the next window, and snapshots pass that on."""
    events = logs(spark, *_events(500 + seed))
    gold, first, second = (str(tmp_path / name) for name in ("gold", "first", "second"))
    run_daily_gmv(events.up_to(date(2023, 1, 8)), gold, start="2022-12-01", end="2023-01-08", silver_path=first)
    run_daily_gmv(events.up_to(date(2023, 1, 20)), gold, start="2023-01-18", end="2023-01-20",
                  silver_path=second, previous_silver=first)
    assert rows(read_gold(spark, gold)) == rows(full_history_gmv(events.up_to(date(2023, 1, 20))))
    run_daily_gmv(events, gold, start="2023-01-29", end="2023-02-28", previous_silver=second)
    assert rows(read_gold(spark, gold)) == rows(full_history_gmv(events))


@pytest.mark.parametrize("seed", range(3))
def test_runs_building_on_snapshots_equal_full_rebuild(spark, tmp_path, seed):
    events = logs(spark, *_events(300 + seed))
    gold = str(tmp_path / "gold")
    cuts = [date(2022, 12, 31), date(2023, 1, 12), date(2023, 1, 22), date(2023, 2, 28)]
    previous = None
    for number, (before, last) in enumerate(zip(cuts, cuts[1:], strict=False)):
        silver = str(tmp_path / f"silver-{number}")
        run_daily_gmv(
            events.up_to(last),
            gold,
            start=before + timedelta(days=1),
            end=last,
            silver_path=silver,
            previous_silver=previous,
        )
        assert rows(read_gold(spark, gold)) == rows(full_history_gmv(events.up_to(last)))
        previous = silver


def _by_hand(purchases, items, extras):
    """The metric with plain loops."""

    def newest(rows_, rank):
        best = {}
        for row in rows_:
            if row[1] not in best or rank(row) > rank(best[row[1]]):
                best[row[1]] = row
        return best

    paid = newest(purchases, lambda r: (r[0], r[3] or ""))
    item = newest(items, lambda r: (r[0], int(r[3]), float(r[4])))
    extra = newest(extras, lambda r: (r[0], r[2] or ""))
    totals = {}
    for key, (at, _, _, release) in paid.items():
        if release is None:
            continue
        group = (date.fromisoformat(at[:10]), extra[key][2] if key in extra else None)
        line = None
        if key in item:
            line = int(item[key][3]) * round(float(item[key][4]) * 100)
        known = totals.get(group)
        totals[group] = known if line is None else (known or 0) + line
    return sorted(
        ((d, s, None if v is None else v / 100) for (d, s), v in totals.items()),
        key=lambda r: (r[0], r[1] or ""),
    )


@pytest.mark.parametrize("seed", range(200, 204))
def test_against_plain_loops(spark, seed):
    events = _events(seed)
    assert rows(full_history_gmv(logs(spark, *events))) == _by_hand(*events)
