import collections

import pytest

import brute
from daybook.llm.exact_tree import exact_dedup, keep_distinct
from daybook.llm.stage import ROW

SCHEMA = "doc_id long, text string"


def expected(rows, keep):
    groups = collections.defaultdict(list)
    for i, (d, t) in enumerate(rows):
        groups[brute.sha((t or "").translate(brute.LOWER))].append((d, i))
    out = {}
    for digest, members in groups.items():
        ids = [d for d, _ in members if d is not None]
        best = (max if keep == "max" else min)(ids, default=None)
        for d, i in members:
            out[i] = (d, best, len(members), digest)
    return out


@pytest.mark.parametrize("keep", ["max", "min"])
@pytest.mark.parametrize("runs,fan", [(256, 16), (8, 2), (1, 2)])
def test_against_loops(stored, odd, keep, runs, fan):
    df = stored(odd, SCHEMA, clash=True)
    got = exact_dedup(df, keep=keep, runs=runs, fan=fan).collect()
    want = expected(odd, keep)
    assert sorted((r.doc_id or -1, r.keep_id or -1, r.group_size, r.text_sha256) for r in got) == sorted(
        (d or -1, k or -1, n, s) for d, k, n, s in want.values()
    )
    kept = [r for r in got if r.kept]
    assert len(kept) == len({s for *_, s in want.values()})
    assert all(r.doc_id == r.keep_id for r in kept)
    assert len({r[ROW] for r in got}) == len(odd)


def test_rows_that_stay_have_all_columns(stored, odd):
    df = stored(odd, SCHEMA, clash=True)
    kept = keep_distinct(df)
    assert kept.columns == df.columns
    assert kept.count() == len({s for *_, s in expected(odd, "max").values()})


def test_empty_table(stored):
    df = stored([], SCHEMA)
    assert exact_dedup(df).count() == 0
    assert keep_distinct(df).count() == 0


def test_unknown_keep(stored):
    with pytest.raises(ValueError):
        exact_dedup(stored([], SCHEMA), keep="first")
