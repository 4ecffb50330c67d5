import random
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

FOLDER = "/root/testdata/sf0.001"

#: Columns of a caller that have the names the operators use inside.
CLASHING = (
    "row long, run long, id string, t string, digest string, kept string, best string, size string, n string, "
    "node string, label string, sig string, a string, b string, anchor string, content string, kind string, "
    "start string, list string, score string, target string, source_no string, block string, key string, "
    "item string, words string, part string, counts string, found0 string, valid string, features string, "
    "__row_no long, __score double, __hash long, __kind int, number long, rank long, place long, "
    "archive string, offset long, alike int"
).split(", ")


@pytest.fixture
def stored(spark, tmp_path):
    """Rows as a table of several files, in the order given."""

    def store(rows, schema, name="t", clash=False):
        path = str(tmp_path / name)
        df = spark.createDataFrame(rows, schema).coalesce(1)
        if clash:
            df = df.selectExpr("*", *[f"CAST('7' AS {c.split()[1]}) AS `{c.split()[0]}`" for c in CLASHING])
        df.write.parquet(path)
        return spark.read.parquet(path)

    return store


@pytest.fixture(scope="session")
def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.fixture(scope="session")
def odd():
    """Nulls, blanks, ties, repeated rows, near copies, very long texts and periodic ones."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, long = text(60), text(30_000)
    near = text(150).split()
    rows = [(1, None), (2, ""), (3, " \t\n "), (None, text(40)), (None, None), (4, "One"), (5, "one"), (6, "ONE two")]
    rows += [(7, long), (8, long[:50_000] + " end"), (9, "ab " * 4000), (10, "x" * 5000), (11, "x" * 5000)]
    rows += [(20 + i, f"{text(15)} {passage}\n{text(25)}") for i in range(12)]
    for i in range(12):
        other = list(near)
        other[rng.randrange(len(other))] = "changed"
        rows.append((40 + i, " ".join(other)))
    rows += [(50, passage), (50, passage), (50, passage.upper()), (51, passage), (60, "é😀 " * 120), (61, "é😀 " * 120)]
    rng.shuffle(rows)
    return rows
