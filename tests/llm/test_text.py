import numpy as np
import pyarrow as pa

import brute
from daybook.llm.text import Words, pack, pieces, rolling, unpack


def test_words_and_hashes(odd, documents):
    texts = [t for _, t in odd + documents[:50]] + [" x y", "\x1c a\x0bb\x0cc", "AİZ"]
    column = pa.array(texts, pa.string())
    for array in (column, pa.concat_arrays([column, column]).slice(3, len(texts))):
        words = Words(array)
        want = [w.encode() for t in array.to_pylist() for w in brute.words(t)]
        assert [words.data[a:b].tobytes() for a, b in zip(words.start, words.end)] == want
        assert words.counts.tolist() == [len(brute.words(t)) for t in array.to_pylist()]
        for lower in (False, True):
            names = [w.decode().translate(brute.LOWER) if lower else w.decode() for w in want]
            hashes = words.hashes(lower).tolist()
            assert len(set(hashes)) == len(set(names)) == len(set(zip(names, hashes)))


def test_no_collisions_of_short_strings():
    texts = [bytes(x).decode() for n in (1, 2, 3) for x in np.ndindex(*[26] * n) for x in [tuple(97 + i for i in x)]]
    assert len(set(Words(pa.array(texts)).hashes().tolist())) == len(texts)


def test_runs_depend_on_order_and_length():
    x = np.array([1, 2, 1, 2, 2, 1], dtype=np.uint64)
    assert len(set(rolling(x, 2).tolist())) == 3
    assert len(rolling(x, 7)) == 0


def test_pieces_cut_by_bytes():
    batch = pa.record_batch([pa.array(["a" * 10, None, "b" * 100, "c", "d" * 30])], ["t"])
    got = [p.num_rows for p in pieces([batch], "t", 50)]
    assert got == [2, 1, 2] and sum(got) == 5


def test_packing():
    rng = np.random.default_rng(0)
    for values in (rng.integers(0, 2**63, 1000, dtype=np.uint64), np.zeros(0, np.uint64), np.array([2**64 - 1], np.uint64)):
        keys = np.sort(values)
        assert (unpack(pack(keys, sort=True), len(keys), np.uint64, sort=True) == keys).all()
        assert (unpack(pack(values), len(values), np.uint64) == values).all()
