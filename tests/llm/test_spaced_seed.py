import itertools

import numpy as np
import pytest

import brute
from daybook.llm import spaced_seed as ss
from daybook.llm.stage import ROW


def test_masks_hit_every_window():
    for apart in itertools.combinations(range(ss.WINDOW), ss.DIFFERENT):
        assert any(
            all(start + i not in apart for i, c in enumerate(mask) if c == "1")
            for mask in ss.MASKS
            for start in range(ss.WINDOW - len(mask) + 1)
        )


@pytest.fixture
def leaky(odd):
    items = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma"),
             (2, "seven words are all this one has"), (3, "too few words"), (4, None), (None, "w1 w2 w3 w4 w5 w6"), (5, "")]
    items += [(6, odd[0][1] or ""), (7, " ".join(f"v{i}" for i in range(5000))), (8, items[0][1])]
    item = items[0][1].split()
    docs = list(odd)
    for n, cuts in enumerate([(), (3,), (3, 9), (3, 5, 7), (0, 6, 12, 16), (2, 4, 15)]):
        text = list(item)
        for c in cuts:
            text[c] = f"other{c}"
        docs.append((100 + n, f"before it {' '.join(text)} after it"))
    docs += [(200, "Seven WORDS are all this one has."), (201, "x seven words are all this one has y"), (202, "too few words"),
             (203, " ".join(item[:13])), (204, " ".join(item[:12])), (205, " ".join(f"v{i}" for i in range(2040, 2060)))]
    for n in range(5, 13):  # whole short items, with up to three other words in them
        words = [f"q{n}x{i}" for i in range(n)]
        items.append((20 + n, " ".join(words)))
        for cuts in [(), (0,), (n - 1,), (1, n - 2), (0, 2, 4)]:
            text = [f"other{i}" if i in cuts else w for i, w in enumerate(words)]
            docs.append((300 + 10 * n + len(cuts), f"x {' '.join(text)} y"))
    return docs, items


@pytest.mark.parametrize("size", range(5, 13))
def test_short_masks_hit_every_window(size):
    masks = ss.short_masks(size)
    assert all(len(m) == size and "1" in m for m in masks)
    for apart in itertools.combinations(range(size), ss.allowed(size)):
        assert any(all(m[i] == "0" for i in apart) for m in masks)
    assert ss.allowed(size) == (0, 1, 1, 1, 1, 2, 2, 2)[size - 5]


@pytest.mark.parametrize("block_words", [1 << 18, 2000])
def test_against_loops(stored, leaky, block_words):
    docs, items = leaky
    df = stored(docs, "doc_id long, text string", clash=True)
    tests = stored(items, "item_id long, text string", "b", clash=True)
    got = ss.decontaminate(df, tests, block_words=block_words).orderBy(ROW).collect()
    want = brute.leaks(docs, items)
    assert [(r.doc_id, r.contaminated, r.n_overlaps, r.item_ids) for r in got] == [
        (d, bool(w), len(w), sorted({i for i, _ in w})) for (d, _), w in zip(docs, want)
    ]
    assert sum(map(bool, want)) >= 30
    assert ss.keep_clean(df, tests).count() == sum(not w for w in want)
    assert ss.keep_clean(df, tests).columns == df.columns


def test_empty_tables(stored):
    docs, tests = stored([], "doc_id long, text string"), stored([], "item_id long, text string", "b")
    assert ss.decontaminate(docs, tests).count() == 0
    some = stored([(1, "a b c")], "doc_id long, text string", "c")
    assert [(r.contaminated, r.item_ids) for r in ss.decontaminate(some, tests).collect()] == [(False, [])]


def test_hits_of_a_frequent_phrase_come_in_parts():
    words = np.full(3000, 7, dtype=np.uint64)
    block = ss.Block([1], [words[:600]])
    row, item, start, size = block.overlaps(words, np.array([0, 3000])).T
    assert start.tolist() == list(range(3000 - ss.WINDOW + 1))
