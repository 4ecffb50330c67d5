import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest

import brute
from daybook.llm import importance as im

SCHEMA = "doc_id long, text string"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text, longest, buckets):
    words = WORD.findall((text or "").translate(brute.LOWER))
    runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]


def expected(docs, target, longest, buckets, least, percent):
    own = [features(t, longest, buckets) for _, t in docs]
    s = collections.Counter(b for _, f in own for b in f)
    t = collections.Counter(b for x in target for b in features(x, longest, buckets)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in range(buckets)]
    rows = []
    for (d, _), (n, f) in zip(docs, own):
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, n])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = place
    return collections.Counter(tuple(r[:5]) for r in rows)


@pytest.mark.parametrize("longest,buckets,least,percent,finish", [
    (1, 10_000, 20, 10, 4096), (1, 50, 1, 50, 1), (3, 1000, 5, 90, 2), (2, 7, 0, 100, 3), (1, 10, 10**6, 50, 5)])
def test_against_loops(stored, odd, longest, buckets, least, percent, finish):
    df = stored(odd, SCHEMA, clash=True).repartition(5)
    target = ["w1 w2 w3", None, "", "W5 w5, w6-w7 é😀 " * 5]
    tests = stored([(x,) for x in target], "text string", name="target")
    got = im.resample(
        df, tests, longest=longest, buckets=buckets, least_words=least, percent=percent, finish=finish).collect()
    want = expected(odd, target, longest, buckets, least, percent)
    assert collections.Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got) == want


def test_long_and_short_words_have_true_checksums():
    import pyarrow as pa

    texts = ["a" * n for n in range(1, 130)] + ["é" * 5000, "Mixed CASE 9"]
    row, bucket, words = im.features(pa.array(texts), 1, 1 << 30)
    want = [zlib.crc32(w.encode()) % (1 << 30) for t in texts for w in t.translate(brute.LOWER).split()]
    assert bucket.tolist() == want and words.sum() == len(want)


@pytest.mark.parametrize("k", [1, 2, 499, 500, 977, 1000])
def test_cutoff_with_ties(spark, k):
    rng = np.random.default_rng(k)
    rows = [(int(s), int(d), i) for i, (s, d) in enumerate(zip(rng.integers(0, 9, 1000), rng.integers(0, 30, 1000)))]
    from daybook.llm.stage import cut

    keys = cut(spark.createDataFrame(rows, "score long, doc_id long, row long").repartition(7), "keys")
    want = sorted(rows, key=lambda r: (-r[0], r[1], r[2]))[k - 1]
    assert tuple(im.cutoff(keys, k, finish=4).values()) == want


def test_nothing_to_draw(stored):
    tests = stored([("x",)], "text string", name="target")
    assert im.resample(stored([], SCHEMA), tests).count() == 0
    few = im.resample(stored([(1, "one two")], SCHEMA, name="few"), tests).collect()
    assert [(r.doc_id, r.n_features, r["rank"]) for r in few] == [(1, 2, None)]


def test_empty_target(stored, odd):
    tests = stored([], "text string", name="target")
    got = im.resample(stored(odd, SCHEMA), tests).collect()
    assert collections.Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got) == expected(
        odd, [], 1, 10_000, 20, 10)
