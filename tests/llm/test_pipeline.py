"""Every stage on its own input against plain loops, and the stages together."""

import collections

import duckdb
import pytest

import brute
import corpus_pipeline as cp
from daybook.llm.stage import cut, table

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    """Input and output of each stage, as lists of rows."""
    docs, out = table(spark, FOLDER, "documents"), []
    for name, stage in cp.STAGES:
        kept = cut(stage(spark, docs, FOLDER), "test")
        out.append((docs.collect(), kept.collect(), kept.columns))
        docs = kept
    return dict(zip((name for name, _ in cp.STAGES), out))


def ids(rows):
    return sorted(r.doc_id for r in rows)


def test_stages_and_columns(steps):
    assert list(steps) == [
        "quality classifier", "exact dedup", "n-gram Jaccard join", "benchmark decontamination", "mixing sources",
    ]
    for name, (given, kept, columns) in steps.items():
        assert columns[:5] == COLUMNS
        assert (columns == COLUMNS) == (name != "mixing sources")
        assert {tuple(r[:5]) for r in kept} <= {tuple(r[:5]) for r in given}


def test_quality(steps):
    given, kept, _ = steps["quality classifier"]
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{FOLDER}/labels.parquet'").fetchall())
    stay = set(ids(kept))
    good = [d for d, q in labels.items() if q == 1]
    bad = [d for d, q in labels.items() if q == 0]
    assert sum(d in stay for d in good) >= 0.97 * len(good)
    assert sum(d in stay for d in bad) <= 0.2 * len(bad)
    assert 0.7 * len(given) < len(kept) < len(given)


def test_exact(steps):
    given, kept, _ = steps["exact dedup"]
    best = {}
    for r in given:
        key = (r.text or "").translate(brute.LOWER)
        best[key] = max(best.get(key, -1), r.doc_id)
    assert ids(kept) == sorted(best.values())


def test_near(steps):
    given, kept, _ = steps["n-gram Jaccard join"]
    want = brute.components([(r.doc_id, r.text) for r in given], percent=80, n=5)
    assert ids(kept) == sorted({c for _, c in want})


def test_benchmark(steps):
    given, kept, _ = steps["benchmark decontamination"]
    items = duckdb.sql(f"SELECT item_id, text FROM '{FOLDER}/benchmark.parquet'").fetchall()
    found = brute.leaks([(r.doc_id, r.text) for r in given], items)
    assert ids(kept) == sorted(r.doc_id for r, f in zip(given, found) if not f)


def test_clashing_columns_change_nothing(spark, steps, stored):
    """Columns with the names that operators use inside are carried along and never taken for their own."""
    given = steps["quality classifier"][0]
    rows = [tuple(r) for r in given]
    docs = stored(rows, "doc_id long, text string, lang string, source string, n_chars long", clash=True)
    own = [c for c in docs.columns if c not in COLUMNS]
    assert {"__row_no", "__score", "score"} <= set(own)
    for name, stage in cp.STAGES:
        docs = cut(stage(spark, docs, FOLDER), "clash")
        assert ids(docs.collect()) == ids(steps[name][1]), name
        kept = [c for c in own if c not in ("size", "target")]  # the mix puts its own in their place
        assert docs.select(kept).distinct().count() == 1


def test_mix(steps):
    given, kept, _ = steps["mixing sources"]
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    for r in given:
        sizes[r.source] += len(brute.words(r.text))
    for r in kept:
        assert r.taken == r.copies * r.size and 1 <= r.copies <= 2 and r.source_size == sizes[r.source]
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert sum(target.values()) == pytest.approx(1.5 * sum(sizes.values()))
    largest = max(len(brute.words(r.text)) for r in given)
    assert all(abs(taken[s] - t) <= largest / 2 for s, t in target.items())


def test_run(spark, steps):
    assert ids(cp.run(spark, FOLDER).collect()) == ids(steps["mixing sources"][1])


def test_odd_tables(spark, odd, tmp_path):
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in odd], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(7, 1, 0), (20, 1, 0), (9, 0, 0)], "doc_id long, quality int, toxic int")
    tests = spark.createDataFrame([(1, odd[0][1])], "item_id long, text string")
    for folder, n in (("some", 1), ("none", 0)):
        for name, df in (("documents", docs), ("labels", labels), ("benchmark", tests)):
            df.limit(10**6 if n else 0).write.parquet(f"{tmp_path}/{folder}/{name}.parquet")
        rows = cp.run(spark, f"{tmp_path}/{folder}").collect()
        assert bool(rows) == bool(n)
