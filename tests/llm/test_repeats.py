"""Substring dedup by FM-index (words) and by difference cover (bytes)."""

import numpy as np
import pytest

import brute
from daybook.llm import difference_cover as dc
from daybook.llm import fm_index as fm
from daybook.llm import repeats
from daybook.llm.stage import ROW

SCHEMA = "doc_id long, text string"
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def words_of(df):
    rows = fm.dedup_words(df).orderBy(ROW).collect()
    return [(r.n_words, r.n_removed, brute.sha(r.kept_text)) for r in rows]


def bytes_of(df):
    rows = dc.dedup_bytes(df).orderBy(ROW).collect()
    return [(r.n_bytes, r.n_removed, r.n_spans, brute.sha(bytes(r.kept))) for r in rows]


def test_documents(stored, documents):
    rows = [(1000 - d, t) for d, t in documents]  # identifiers against the order of rows
    df = stored(rows, SCHEMA)
    assert words_of(df) == brute.dedup_words(rows)
    assert bytes_of(df) == brute.dedup_bytes(rows)


def test_odd_rows(stored, odd):
    df = stored(odd, SCHEMA, clash=True)
    assert words_of(df) == brute.dedup_words(odd)
    assert bytes_of(df) == brute.dedup_bytes(odd)


def test_crowded_anchors(stored, odd, monkeypatch):
    """Anchors with more contents than fit an index go by single windows."""
    monkeypatch.setattr(repeats.Unit, "crowd", property(lambda self: 1))
    df = stored(odd, SCHEMA)
    assert words_of(df) == brute.dedup_words(odd)
    assert bytes_of(df) == brute.dedup_bytes(odd)


def test_small_shards(stored, odd, monkeypatch):
    monkeypatch.setattr(repeats, "SHARD", 3000)
    df = stored(odd, SCHEMA)
    assert words_of(df) == brute.dedup_words(odd)
    assert bytes_of(df) == brute.dedup_bytes(odd)


def test_digests_and_empty_table(stored, odd):
    df = stored(odd, SCHEMA)
    got = sorted((r.doc_id or -1, r.n_words, r.n_removed, r.kept_sha256) for r in fm.digests(df).collect())
    assert got == sorted((d or -1, *w) for (d, _), w in zip(odd, brute.dedup_words(odd)))
    empty = stored([], SCHEMA, "e")
    assert fm.digests(empty).count() == 0
    assert dc.digests(empty).count() == 0


def test_segments_hold_every_window_once():
    rng = np.random.default_rng(0)
    for alphabet in (1, 2, 50):
        symbols = rng.integers(0, alphabet, 400).astype(np.uint64) * SPREAD
        first = np.array([0, 5, 5, 130, 400])
        unit = repeats.Unit("words", 20, 6)
        found = repeats.segments(symbols, first, unit)
        held = sorted((r, s + i) for r, s, n in zip(found["row"], found["start"], found["n"]) for i in range(n))
        assert held == [(r, s) for r in range(4) for s in range(max(0, first[r + 1] - first[r] - 19))]
        at = {}
        for r, s, n, a in zip(found["row"], found["start"], found["n"], found["anchor"]):
            for i in range(n):
                window = symbols[first[r] + s + i : first[r] + s + i + 20].tobytes()
                assert at.setdefault(window, a) == a



def test_suffix_array():
    rng = np.random.default_rng(1)
    for _ in range(300):
        text = rng.integers(1, int(rng.integers(2, 6)), int(rng.integers(0, 60)))
        assert dc.suffix_array(text).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
    text = np.tile(rng.integers(1, 5, 7), 60)
    assert dc.suffix_array(text).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())


@pytest.mark.parametrize("depth", [2, 3, 5, 8])
def test_matching_statistics_of_other_texts(depth):
    rng = np.random.default_rng(depth)
    for _ in range(30):
        text = np.concatenate([np.append(rng.integers(1, 3, int(rng.integers(1, 30))), 0) for _ in range(4)])
        index = fm.FmIndex(text, depth)
        query = rng.integers(1, 3, 50)
        got = {}
        for _, place, low, high in index.stream(query, np.array([0]), np.array([50])):
            for p, a, b in zip(place.tolist(), low, high):
                got[p] = (sorted(index.suffixes[a:b].tolist()), int(index.earliest[index.group[a]]))
        for i in range(50 - depth + 1):
            occurs = [j for j in range(len(text) - depth + 1) if (text[j : j + depth] == query[i : i + depth]).all()]
            assert got.get(i) == ((occurs, occurs[0]) if occurs else None)


def test_wavelet_ranks():
    rng = np.random.default_rng(3)
    symbols = rng.integers(0, 37, 500)
    wavelet = fm.Wavelet(symbols, 6)
    symbol, low, high = rng.integers(0, 37, 200), rng.integers(0, 501, 200), rng.integers(0, 501, 200)
    a, b = wavelet.ranks(symbol, low, high)
    assert a.tolist() == [int((symbols[:x] == s).sum()) for s, x in zip(symbol, low)]
    assert b.tolist() == [int((symbols[:x] == s).sum()) for s, x in zip(symbol, high)]
