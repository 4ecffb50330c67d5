import pytest

import brute
from daybook.llm import katz
from daybook.llm.stage import ROW, numbered


def held_out(rows):
    return [brute.rest(d, 7) == 2 for d, _ in rows]


def expected(rows, share):
    model = brute.Katz([t for (_, t), h in zip(rows, held_out(rows)) if not h], share)
    return model, [model.score(t) for _, t in rows]


@pytest.mark.parametrize("share,part_tokens", [(1 << 20, 8 << 20), (300, 2000), (30, 5000)])
def test_against_dictionaries(spark, stored, documents, share, part_tokens):
    rows = documents[:120] + [(900, None), (901, ""), (902, "wholly unseen tokens"), documents[0]]
    df = stored(rows, "doc_id long, text string")
    source = numbered(df, "doc_id", "text").selectExpr("*", "pmod(crc32(CAST(CAST(doc_id AS string) AS binary)), 7) = 2 AS held_out")
    model = katz.fit(source, share=share, part_tokens=part_tokens)
    got = katz.score_rows(source, model).orderBy(ROW).collect()
    plain, want = expected(rows, share)
    assert model.classes.n_tokens == plain.n
    assert [(r.n_tokens, r.n_known) for r in got] == [(n, k) for n, k, *_ in want]
    assert [r.base_score for r in got] == pytest.approx([w[2] for w in want], rel=1e-9)
    assert [r.score for r in got] == pytest.approx([w[3] for w in want], rel=1e-9)


def test_every_context_sums_to_one(documents):
    model = brute.Katz([t for _, t in documents[:40]], 1 << 20)
    for h in list(model.after)[:200]:
        assert sum(model.p(w, h) for w in model.p1) == pytest.approx(1)


def test_whole_query_and_held_out_gain(stored, documents):
    df = stored(documents, "doc_id long, text string", clash=True)
    got = katz.log_probabilities(df).collect()
    assert len(got) == len(documents)
    assert all(r.held_out == (brute.rest(r.doc_id, 7) == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_odd_rows_and_empty_table(stored, odd):
    got = katz.log_probabilities(stored(odd, "doc_id long, text string")).collect()
    _, want = expected(odd, 1 << 20)
    assert sorted(r.score for r in got) == pytest.approx(sorted(w[3] for w in want), rel=1e-9)
    assert katz.log_probabilities(stored([], "doc_id long, text string", "e")).count() == 0


def test_nothing_to_learn_from(stored):
    identifier = next(i for i in range(100) if brute.rest(i, 7) == 2)
    (row,) = katz.log_probabilities(stored([(identifier, "a b")], "doc_id long, text string")).collect()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (True, 3, 0, 0, 0, 0)


def test_rare_words_of_a_large_corpus_keep_bigrams(spark, stored):
    learned = [i for i in range(200) if brute.rest(i, 7) != 2]
    held = next(i for i in range(200) if brute.rest(i, 7) == 2)
    rows = [(learned[0], "x y " * 600_000), (learned[1], "alpha beta gamma"), (learned[2], "delta beta x")]
    rows += [(held, "alpha beta x delta beta gamma unseen beta")]
    got = {r.doc_id: r for r in katz.log_probabilities(stored(rows, "doc_id long, text string")).collect()}
    _, want = expected(rows, 1 << 40)
    for (i, _), w in zip(rows, want):
        assert (got[i].n_tokens, got[i].n_known) == (w[0], w[1])
        assert (got[i].base_score, got[i].score) == pytest.approx((w[2], w[3]), rel=1e-9)


@pytest.mark.parametrize("share,part_tokens", [(None, 8 << 20), (None, 2000), (300, 2000), (30, 5000)])
def test_parts_and_classes_against_dictionaries(stored, documents, share, part_tokens):
    rows = documents[:120] + [(900, None), (901, ""), (902, "wholly unseen tokens"), documents[0]]
    df = stored(rows, "doc_id long, text string")
    source = numbered(df, "doc_id", "text").selectExpr("*", "pmod(crc32(CAST(CAST(doc_id AS string) AS binary)), 7) = 2 AS held_out")
    model = katz.fit(source, share=share, part_tokens=part_tokens)
    got = katz.score_rows(source, model).collect()
    _, want = expected(rows, share or 1 << 40)
    assert sorted((r.n_tokens, r.n_known) for r in got) == sorted((n, k) for n, k, *_ in want)
    for i in (2, 3):
        assert sorted(r[i + 1] for r in got) == pytest.approx(sorted(w[i] for w in want), rel=1e-9)
