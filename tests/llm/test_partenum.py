import random

import numpy as np
import pyarrow as pa
import pytest

import brute
from daybook.llm import partenum as pe
from daybook.llm.stage import ROW

SCHEMA = "doc_id long, text string"


def classes(df, **options):
    return [(r.n_shingles, r.component_id) for r in pe.jaccard_classes(df, **options).orderBy(ROW).collect()]


def test_documents(stored, documents):
    assert classes(stored(documents, SCHEMA)) == brute.components(documents)


def test_odd_rows(stored, odd):
    assert classes(stored(odd, SCHEMA, clash=True)) == brute.components(odd)


@pytest.fixture(scope="module")
def families():
    """Many families of copies with so many changes that similarities fall on both sides of the
    limit, chains among them, and one phrase that all texts share."""
    rng = random.Random(9)
    rows = []
    for size in (6, 12, 30, 80, 200):
        for _ in range(4):
            text = [f"w{rng.randrange(400)}" for _ in range(size)]
            for _ in range(14):
                rows.append((rng.randrange(10**6), "the phrase that all texts share " + " ".join(text)))
                if rng.random() < 0.8:
                    text = list(text)
                    text[rng.randrange(size)] = f"n{rng.randrange(400)}"
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("percent,shingle", [(85, 4), (80, 5), (60, 2)])
def test_families(stored, families, percent, shingle):
    df = stored(families, SCHEMA)
    want = brute.components(families, percent, shingle)
    assert classes(df, percent=percent, shingle=shingle) == want
    kept = pe.keep_one(df, percent=percent, shingle=shingle)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in want})


def test_split_signatures(stored, families, monkeypatch):
    monkeypatch.setattr(pe, "BLOCK", 3)
    assert classes(stored(families, SCHEMA)) == brute.components(families)


def test_components_of_any_shape(spark, monkeypatch):
    """A hub, a long chain, small groups and a ring, with and without keys that count as hot."""
    rng = random.Random(4)
    names = [rng.randrange(-(2**63), 2**63) for _ in range(900)]
    links = [(names[0], names[i]) for i in range(1, 400)]
    links += [(names[i], names[i + 1]) for i in range(400, 470)]
    links += [(names[i], names[i + 1]) for i in range(500, 800, 2)]
    links += [(names[i], names[i + 1]) for i in range(800, 899)] + [(names[899], names[800])]
    least = {n: n for link in links for n in link}
    while True:
        before = dict(least)
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
        if before == least:
            break
    df = spark.createDataFrame([tuple(sorted(x)) for x in links], "a long, b long")
    for spread in (0.1, 1000):
        monkeypatch.setattr(pe, "SPREAD", spread)
        assert {r.node: r.label for r in pe.components(df).collect()} == least


def test_rows_that_stay(stored, odd):
    df = stored(odd, SCHEMA, clash=True)
    want = brute.components(odd)
    blank = sum(n == 0 for n, _ in want)
    unnamed = sum(n > 0 and c is None for n, c in want)
    kept = pe.keep_one(df)
    assert kept.columns == df.columns
    assert kept.count() == blank + unnamed + len({c for n, c in want if n and c is not None})


def test_empty_table(stored):
    df = stored([], SCHEMA)
    assert classes(df) == []
    assert pe.keep_one(df).count() == 0


def similar_pairs(rng, n, percent=85):
    """Pairs of sets that are just similar enough."""
    for _ in range(n):
        size = int(rng.choice([rng.integers(1, 60), rng.integers(1, 400), rng.integers(1, 4000)]))
        x = rng.integers(0, 2**63, size, dtype=np.uint64)
        most = int(pe.differences(size) // 2)
        gone, new = int(rng.integers(0, most + 1)), int(rng.integers(0, most + 1))
        y = np.concatenate([x[gone:], rng.integers(0, 2**63, new, dtype=np.uint64)])
        x, y = np.unique(x), np.unique(y)
        common = len(np.intersect1d(x, y))
        if 100 * common >= percent * (len(x) + len(y) - common) and len(y):
            yield x, y


def test_similar_sets_share_a_signature_and_pass_the_sketch():
    rng = np.random.default_rng(2)
    for x, y in similar_pairs(rng, 1500):
        code, owner = pe.signatures([x, y])
        if not np.array_equal(x, y):
            assert set(code[owner == 0]) & set(code[owner == 1])
        s = pe.Sketches(pa.array(pe.sketches([x, y]), pa.binary()))
        first, second = np.array([0]), np.array([1])
        assert pe.may_link(s, first, s, second, np.array([len(x)]), np.array([len(y)])).all()
