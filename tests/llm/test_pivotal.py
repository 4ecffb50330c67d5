import collections

import pytest

import brute
from daybook.llm import pivotal as pv
from daybook.llm.stage import ROW

SCHEMA = "doc_id long, text string, source string"


def targets(sizes, weights=pv.WEIGHTS, share=pv.SHARE, most=pv.MOST):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full = set()
    while True:
        left = share * sum(sizes.values()) - sum(most * sizes[s] for s in full)
        free = sum(weight[s] for s in names if s not in full)
        out = {s: most * sizes[s] if s in full else left * weight[s] / free for s in names}
        above = {s for s in names if s not in full and out[s] > most * sizes[s]}
        if not above:
            return out
        full |= above


@pytest.fixture(scope="module")
def mixed(documents):
    sources = ["b", "a", "é", None, "B"]
    share = [0, 0, 0, 0, 0, 1, 1, 2, 3, 4]
    rows = [(d, t, sources[share[d % 10]]) for d, t in documents]
    return rows + [(500, None, "a"), (501, "", "empty"), (None, "some words", "a"), (502, "x " * 3000, "b"), rows[0], rows[0]]


@pytest.mark.parametrize("block,fan", [(4096, 64), (8, 2)])
def test_mix(stored, mixed, block, fan):
    df = stored(mixed, SCHEMA, clash=True)
    got = pv.mix_sources(df, block=block, fan=fan).orderBy(ROW).collect()
    sizes, taken = collections.Counter(), collections.Counter()
    largest = collections.Counter()
    for d, t, s in mixed:
        sizes[s] += len(brute.words(t))
        largest[s] = max(largest[s], len(brute.words(t)))
    want = targets(sizes)
    assert len(got) == len(mixed)
    for r, (d, t, s) in zip(got, mixed):
        assert (r.doc_id, r.size, r.source_size) == (d, len(brute.words(t)), sizes[s])
        assert r.target == pytest.approx(want[s])
        assert r.taken == r.copies * r.size and 0 <= r.copies <= pv.MOST
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(30, 0.01 * want[s])
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_reruns_agree_however_rows_are_dealt(spark, stored, mixed, tmp_path):
    rows = list({r[0]: r for r in mixed if r[0] is not None}.values())
    df = stored(rows, SCHEMA)
    other = str(tmp_path / "other")
    df.repartition(5).write.parquet(other)
    a, b = ({r.doc_id: r.taken for r in pv.mix_sources(x).collect()} for x in (df, spark.read.parquet(other)))
    assert a == b


def test_shares_are_kept_on_average():
    """Over many pairs a trade leaves each unit's expected share as it was."""
    total, n = [0.0, 0.0], 4000
    for k in range(n):
        a, b = [0, 0, 0, 2 * k, 30, 0.3, pv.PENDING], [0, 0, 0, 2 * k + 1, 50, 0.6, pv.PENDING]
        pv._trade(a, b)
        assert a[4] * a[5] + b[4] * b[5] == pytest.approx(39)
        assert a[6] in (0, 1) or b[6] in (0, 1)
        total[0] += a[5]
        total[1] += b[5]
    assert total[0] / n == pytest.approx(0.3, abs=0.03)
    assert total[1] / n == pytest.approx(0.6, abs=0.03)


def test_rows_taken(stored, mixed):
    df = stored(mixed, SCHEMA, clash=True)
    taken = pv.take_mix(df)
    assert set(df.columns) | {"copies", "taken", "source_size"} == set(taken.columns)
    rows = taken.collect()
    assert rows and all(r.taken > 0 and r.size == len(brute.words(r.text)) for r in rows)


def test_empty_and_wordless_tables(stored):
    assert pv.mix_sources(stored([], SCHEMA)).count() == 0
    got = pv.mix_sources(stored([(1, "", "a"), (2, None, None)], SCHEMA, "w")).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0, 0), (0, 0, 0)]
