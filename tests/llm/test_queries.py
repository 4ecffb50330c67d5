"""The registered queries over the given tables: columns, SQL, and plain loops."""

import glob
from pathlib import Path

import duckdb
import pytest

import brute
from __spark_entry__ import oracle_sql, queries
from daybook.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"

COLUMNS = {
    "op1_spaced_seed": ["doc_id", "contaminated", "n_overlaps", "item_ids"],
    "op2_mil": ["doc_id", "held_out", "score", "predicted"],
    "op3_exact_tree": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op4_fm_index": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op5_katz": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op6_partenum": ["doc_id", "n_shingles", "component_id"],
    "op7_difference_cover": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op8_pii_weak": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op9_blocks_lstm": ["page_id", "url", "text", "n_chars"],
    "op10_pivotal": ["doc_id", "size", "source_size", "target", "taken"],
    "op11_chunked_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op12_hybrid_search": ["item_id", "rank", "doc_id", "score"],
    "op13_importance": ["doc_id", "n_features", "weight", "score", "rank"],
}

#: Queries that do not return a row for each document.
OTHER_ROWS = {"op9_blocks_lstm": "pages", "op11_chunked_warc": "pages", "op12_hybrid_search": None}


def test_all_are_registered():
    assert set(COLUMNS) == set(QUERIES)
    assert {*QUERIES, "pipeline"} <= set(queries())
    assert set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_one_row_per_row(spark, name):
    df = QUERIES[name](spark, FOLDER)
    assert df.columns == COLUMNS[name]
    table = OTHER_ROWS.get(name, "documents")
    if table:
        assert df.count() == spark.read.parquet(f"{FOLDER}/{table}.parquet").count()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    duck = duckdb.connect()
    for file in glob.glob(f"{FOLDER}/*.parquet"):
        duck.sql(f"CREATE VIEW {Path(file).stem} AS SELECT * FROM '{file}'")
    want = duck.sql(ORACLES[name])
    got = QUERIES[name](spark, FOLDER).select(want.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.fetchall()), key=str)


def test_decontamination(spark, documents):
    items = duckdb.sql(f"SELECT item_id, text FROM '{FOLDER}/benchmark.parquet'").fetchall()
    want = dict(zip((d for d, _ in documents), brute.leaks(documents, items)))
    got = QUERIES["op1_spaced_seed"](spark, FOLDER).collect()
    assert any(want.values())
    assert all((r.n_overlaps, r.item_ids) == (len(want[r.doc_id]), sorted({i for i, _ in want[r.doc_id]})) for r in got)
