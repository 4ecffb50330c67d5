import random

import numpy as np
import pytest

import brute
from daybook.llm import pii_weak as pw
from daybook.llm.stage import ROW

SCHEMA = "doc_id long, text string"


def check(df, rows):
    got = pw.personal_data(df).orderBy(ROW).collect()
    assert len(got) == len(rows)
    for r, (_, text) in zip(got, rows):
        counts, listed = brute.personal(text)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts, text
        assert r.base_sha256 == brute.sha(listed), text
        assert set(listed.split(",")) <= set(r.spans.split(","))
    return got


def test_documents(stored, documents):
    check(stored(documents, SCHEMA, clash=True), documents)


def test_random_texts(stored):
    rng = random.Random(4)
    alphabet = "019 .-@+()a_%é😀,\n"
    rows = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(120)))) for i in range(2500)]
    check(stored(rows, SCHEMA), rows)


def test_odd_rows(stored, odd):
    rows = odd + [(1, "a" * 60_000), (2, "1." * 20_000), (3, "a@" + "b." * 20_000 + "c"), (4, "1 " * 30_000), (5, "+1 " * 5000)]
    rows += [(6, "4111 1111 1111 1111"), (7, "4111 1111 1111 1112"), (8, "256.1.1.1 1.2.3.255 1.2.3.4.5.6.7.8"), (9, "x.@y.z a@b.c_d@e.f")]
    check(stored(rows, SCHEMA), rows)


def test_empty_table(stored):
    assert pw.personal_data(stored([], SCHEMA)).count() == 0


def test_added_spans(stored):
    """Secrets after a cue are added, base spans are not touched, and no spans overlap."""
    secret = "token = \"{:040x}\""
    rows = [(i, f"plain words here {secret.format(i * 7919 + 10**45)} and so on, card 4111 1111 1111 1111.") for i in range(60)]
    rows += [(100 + i, f"version 1.{i} of the page, section {i}") for i in range(60)]
    got = check(stored(rows, SCHEMA), rows)
    assert all("secret:" in r.spans and "card:" in r.spans for r in got[:60])
    assert all(r.spans == "" for r in got[60:])
    for r in got:
        ends = [tuple(map(int, s.split(":")[1:])) for s in r.spans.split(",") if s]
        assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))


def test_reliabilities_are_recovered():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.3
    sure = [0.95, 0.9, 0.75, 0.6]
    votes = np.stack([np.where(rng.random(len(truth)) < s, truth, ~truth) * 2 - 1 for s in sure], 1)
    votes[rng.random(votes.shape) < 0.2] = 0
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    belief, table = pw.believe(patterns, n.astype(float))
    for k, s in enumerate(sure):
        for side in (0, 1):
            right = table[side, k, 2 * side] / (1 - table[side, k, 1])
            assert right == pytest.approx(s, abs=0.03)
    assert belief @ n / n.sum() == pytest.approx(0.3, abs=0.02)


def test_main_path_is_native(stored, odd):
    plan = pw.personal_data(stored(odd, SCHEMA))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
