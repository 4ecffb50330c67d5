import math
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import brute
from daybook.llm import mil
from daybook.llm.text import Words

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    return {r.doc_id: r for r in mil.quality(docs, labels).collect()}


def test_held_out_accuracy(scored):
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{FOLDER}/labels.parquet'").fetchall()
    assert all(r.held_out == (brute.rest(d, 3) == 1) for d, r in scored.items())
    held = [(scored[d], q) for d, q in labels if scored[d].held_out]
    good = [r.score for r, q in held if q == 1]
    bad = [r.score for r, q in held if q == 0]
    above = np.mean([[x > y for y in bad] for x in good])
    assert np.mean([r.predicted == q for r, q in held]) > 0.95
    assert above > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored.values())


def test_gradients():
    rng = np.random.default_rng(0)
    bags, y = np.array([1, 3, 2, 5]), np.array([1.0, 0, 0, 1])
    x = rng.normal(size=(bags.sum(), mil.N_FEATURES))
    model = mil.train(x, bags, y, epochs=2)
    loss = lambda: -np.mean(y * np.log(p := model.forward(x, bags)["p"]) + (1 - y) * np.log(1 - p))
    slopes = mil.gradients(model, x, bags, y)
    for name, w in model.weights.items():
        at = tuple(rng.integers(s) for s in w.shape)
        w[at] += 1e-6
        up = loss()
        w[at] -= 2e-6
        assert (up - loss()) / 2e-6 == pytest.approx(slopes[name][at], rel=1e-3, abs=1e-7)
        w[at] += 1e-6


def loop_passages(text):
    """Features of each passage, a word and a byte at a time; only the hash of a word is the operator's."""
    data = (text or "").encode()
    spans = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", data)]
    cuts = [0] + [spans[i][0] for i in range(mil.PASSAGE, len(spans), mil.PASSAGE)] + [len(data)]
    out = []
    for number, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        words = [data[b:e] for b, e in spans[number * mil.PASSAGE :][: mil.PASSAGE]]
        n = max(len(words), 1)
        row = [sum(c in kind for c in data[lo:hi]) / max(hi - lo, 1) for kind in mil.CLASSES]
        mean = sum(map(len, words)) / n
        row += [mean / 10, math.sqrt(max(sum(len(w) ** 2 for w in words) / n - mean**2, 0)) / 10]
        row += [len(set(words)) / n, sum(a == b for a, b in zip(words, words[1:])) / n]
        row += [sum(65 <= w[0] <= 90 for w in words) / n, sum(w[-1] == 33 for w in words) / n]
        row += [sum(w[-1] in b"#$%&*@^~+=<>/\\_{}[]`" for w in words) / n]
        row += [math.log(1 + len(words)) / math.log(1 + mil.PASSAGE)]
        hashed = [0.0] * mil.BUCKETS
        for w in words:
            h = int(Words(pa.array([w.decode()])).hashes()[0])
            hashed[h % mil.BUCKETS] += 1 if h >> 63 else -1
        out.append(row + [x / math.sqrt(n) for x in hashed])
    return out


def loop_score(model, rows):
    """Gated attention over the passages of one document, a sum at a time."""
    w, hidden, logits = model.weights, [], []
    for row in rows:
        x = [min(max((v - m) / s, -8), 8) for v, m, s in zip(row, model.mean, model.scale)]
        h = [math.tanh(b + sum(v * u for v, u in zip(x, unit))) for unit, b in zip(w["encode"].T, w["encode0"])]
        gated = 0.0
        for value, gate, weight in zip(w["value"].T, w["gate"].T, w["attend"]):
            g = 1 / (1 + math.exp(-sum(a * b for a, b in zip(h, gate))))
            gated += weight * g * math.tanh(sum(a * b for a, b in zip(h, value)))
        hidden.append(h)
        logits.append(gated)
    share = [math.exp(e) / sum(map(math.exp, logits)) for e in logits]
    z = [sum(a * h[i] for a, h in zip(share, hidden)) for i in range(mil.HIDDEN)]
    return 1 / (1 + math.exp(-w["out0"][0] - sum(a * b for a, b in zip(z, w["out"]))))


def test_scores_against_loops(odd, documents):
    texts = [t for _, t in odd if len(t or "") < 20_000] + [t for _, t in documents[:40]]
    column = pa.array(texts, pa.string())
    x, bags = mil.passages(column)
    want = [loop_passages(t) for t in texts]
    assert bags.tolist() == [len(rows) for rows in want]
    assert np.allclose(x, np.array([r for rows in want for r in rows]), atol=1e-5)
    model = mil.train(x, bags, np.arange(len(texts)) % 2.0, epochs=3)
    assert model.score(column) == pytest.approx([loop_score(model, rows) for rows in want], abs=1e-4)


def test_attention_is_a_distribution():
    rng = np.random.default_rng(0)
    bags = np.array([1, 4, 2])
    model = mil.train(rng.normal(size=(7, mil.N_FEATURES)), bags, np.array([1.0, 0, 1]), epochs=1)
    a = model.forward(rng.normal(size=(7, mil.N_FEATURES)), bags)["a"]
    assert np.add.reduceat(a, [0, 1, 5]) == pytest.approx(1)


def test_passages_cover_whole_texts(odd):
    texts = [t for _, t in odd]
    x, bags = mil.passages(pa.array(texts, pa.string()))
    assert bags.tolist() == [max(1, -(-len(brute.words(t)) // mil.PASSAGE)) for t in texts]
    alone = [mil.passages(pa.array([t], pa.string()))[0] for t in texts]
    assert np.allclose(x, np.concatenate(alone), atol=1e-5)
    assert np.isfinite(x).all()


def test_odd_rows(spark, stored, odd):
    df = stored(odd, "doc_id long, text string").selectExpr("*", "'x' AS lang", "1L AS label")
    labels = stored([(7, 1), (7, 0), (20, 0), (21, None), (None, 1), (40, 1)], "doc_id long, quality int", "l")
    got = mil.quality(df, labels).collect()
    assert len(got) == len(odd)
    assert all(0 <= r.score <= 1 for r in got)
    kept = mil.keep_good(df, labels)
    assert kept.columns == df.columns
    assert kept.count() == sum(r.predicted for r in got)


def test_no_labels_and_no_documents(stored):
    schema = "doc_id long, text string"
    labels = stored([], "doc_id long, quality int", "l")
    assert [r.score for r in mil.quality(stored([(1, "a")], schema), labels).collect()] == [0.5]
    assert mil.quality(stored([], schema, "e"), labels).count() == 0
    with pytest.raises(ValueError):
        mil.with_score(stored([(1, "a")], schema, "f"), None, out="text")
