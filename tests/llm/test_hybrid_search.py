import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

import brute
from daybook.llm import hybrid_search as hs

SCHEMA = "doc_id long, text string"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return [t.translate(brute.LOWER) for t in TERM.findall(text or "")]


def expected(docs, items, top):
    own = [collections.Counter(terms(t)) for _, t in docs]
    n_docs, n_terms = sum(bool(x) for x in own), sum(sum(x.values()) for x in own)
    df = collections.Counter(t for x in own for t in x)
    out = []
    for item, text in items:
        scores, wanted = [], terms(text)
        for (d, _), x in zip(docs, own):
            m = 75 + (25 * sum(x.values()) * n_docs) // max(n_terms, 1)
            score = 0
            for t in wanted:
                if t in x:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * x[t]) // (1000 * x[t] + 12 * m))
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        for rank, (score, _, _, d) in enumerate(sorted(scores)[:top], 1):
            out.append((item, rank, d, -score))
    return sorted(out, key=str)


def result(index, items, **options):
    return sorted(map(tuple, hs.search(index, items, **options).collect()), key=str)


@pytest.fixture(scope="module")
def items():
    rng = random.Random(9)
    text = lambda n: " ".join(f"w{rng.randrange(60)}" for _ in range(n))
    rows = [(1, text(30)), (2, text(3)), (3, None), (4, ""), (5, "unheard of"), (6, "one ONE two end w1"), (7, text(400))]
    return [*rows, (8, "w5 w5 w5"), (8, "w5 w5 w5"), (None, text(5)), (9, "é😀, xxxxx"), (10, "x" * 5000)]


@pytest.mark.parametrize("shard_terms,top,block,short", [
    (1 << 21, 20, 1 << 18, 16), (500, 3, 40, 2), (1, 5, 200, 10**9), (2000, 1000, 100, 1)])
def test_against_loops(stored, odd, items, shard_terms, top, block, short):
    docs = [r for r in odd if shard_terms > 1 or len(r[1] or "") < 5000]
    index = hs.build_index(stored(docs, SCHEMA, clash=True).repartition(3), shard_terms=shard_terms)
    queries = stored(items, "item_id long, text string", name="items", clash=True)
    assert result(index, queries, top=top, block_terms=block, short=short) == expected(docs, items, top)


def test_many_windows_and_shards(stored):
    """Skipping across windows and shards, ties in thousands of copies."""
    rng = random.Random(1)
    words = [f"t{i}" for i in range(200)]
    weights = [1 / (i + 1) for i in range(200)]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.randrange(1, 12)))) for i in range(6000)]
    docs += [(10_000 + i, "t0 t1 t2 copy") for i in range(3000)]
    rng.shuffle(docs)
    items = [(i, " ".join(rng.choices(words, weights, k=8))) for i in range(12)] + [(50, "copy t0"), (51, "t0"), (52, "t199 t0")]
    df = stored(docs, SCHEMA).repartition(2)
    queries = stored(items, "item_id long, text string", name="items")
    want = expected(docs, items, 20)
    assert result(hs.build_index(df), queries) == want
    assert result(hs.build_index(df, shard_docs=700), queries, short=4) == want


def test_skips_are_taken(stored):
    """Windows whose bound is below the best scores so far are not looked into."""
    docs = [(i, "rare common" if i < 30 else "common") for i in range(5000)]
    row = hs.build_index(stored(docs, SCHEMA)).first().asDict()
    terms = hs._terms(pa.array(["rare common"]))[0].view(np.int64)
    queries = hs.Queries([{"number": 0, "terms": terms}])
    queries.weight[:] = 1000
    row["lengths"] = np.array(row["lengths"])
    shard = hs.Shard(row, queries, 5000, 5030)
    looked = []
    part = shard.part
    shard.part = lambda one, window: looked.append(window) or part(one, window)
    docs, _ = shard.best(*queries.lists[0], 20, np.zeros(0, np.int64))
    assert docs.tolist() == list(range(20)) and set(looked) == {0}


def test_empty_tables(stored, items):
    queries = stored(items, "item_id long, text string", name="items")
    assert hs.search(hs.build_index(stored([], SCHEMA)), queries).count() == 0
    none = stored([], "item_id long, text string", name="none")
    index = hs.build_index(stored([(1, "w1"), (2, None)], SCHEMA, name="few"))
    assert hs.search(index, none).count() == 0
    assert result(index, queries) == expected([(1, "w1"), (2, None)], items, 20)
