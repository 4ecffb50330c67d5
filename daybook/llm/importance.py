"""Importance resampling towards a target: hashed features, and an exact selection of the best.

Runs of words fall into buckets; how much more often a bucket occurs in the target than in the corpus
is its gain, and a document weighs the sum of the gains of its features. With a noise that depends on
the identifier alone, taking the greatest sums draws documents in proportion to their weights.

The cutoff is found without sorting the corpus: every task tells the median of the keys it still
has, the median of those, weighted by how many keys stand behind each, splits the rest, and at least a
quarter of it is out each round. Only winners are sorted.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.stage import cut, parallelism
from daybook.llm.text import LOWER, MARKS, Words, pieces

#: Fixed values of the contract.
LONGEST, BUCKETS, SEED, LEAST_WORDS, PERCENT = 1, 10_000, 2024, 20, 10

#: So many keys may come to the driver, to be sorted there, once only they can hold the cutoff.
FINISH = 4096
#: Keys in the running are stored anew once they are so small a share of those that are read.
SHRINK = 8
#: Bytes of words up to which checksums are computed for all words at once.
SHORT = 48

FULL = np.uint32(0xFFFFFFFF)


def _crc_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> np.uint32(1)) ^ np.uint32(0xEDB88320), out >> np.uint32(1))
    return out


CRC = _crc_table()


def _fed(state: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC registers after the bytes ``start`` to ``end`` of ``data``, one register for each run."""
    length = end - start
    order = np.argsort(np.minimum(length, SHORT + 1).astype(np.uint8), kind="stable")[::-1]
    state, start, length = state[order], start[order], length[order]
    long = int((length > SHORT).sum())
    for n in range(long):
        run = data[start[n] : start[n] + length[n]]
        state[n] = np.uint32(zlib.crc32(run, int(state[n] ^ FULL))) ^ FULL
    state_, start, length = state[long:], start[long:], length[long:]
    left = np.searchsorted(-length, -np.arange(SHORT), "left")  # runs with a byte at each place
    for place in range(int(length[0]) if len(length) else 0):
        some = state_[: left[place]]
        byte = data[start[: left[place]] + place]
        state_[: left[place]] = CRC[(some ^ byte) & np.uint32(0xFF)] ^ (some >> np.uint32(8))
    out = np.empty_like(state)
    out[order] = state
    return out


def features(column: pa.Array, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and bucket of every feature of every text, and the number of words of each."""
    words = Words(column, MARKS)
    data, row = LOWER[words.data], words.row
    rows, found = [], []
    state = np.full(len(words.start), FULL, dtype=np.uint32)
    blank = np.frombuffer(b" ", np.uint8)
    for n in range(1, longest + 1):
        if n > 1:
            on = np.flatnonzero(row[: len(row) - n + 1] == row[n - 1 :]) if len(row) >= n else np.zeros(0, int)
            state = state[np.searchsorted(place, on)]  # noqa: F821  a run of n words begins with one of n - 1
            zero = np.zeros(len(on), dtype=np.int64)
            state = _fed(state, blank, zero, zero + 1)
        else:
            on = np.arange(len(row))
        place = on
        state = _fed(state, data, words.start[on + n - 1], words.end[on + n - 1])
        rows.append(row[on])
        found.append(((state ^ FULL) % np.uint32(buckets)).astype(np.int64))
    return np.concatenate(rows), np.concatenate(found), words.counts


def bucket_counts(df: DataFrame, text_col: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: how often the features of all texts fall into each bucket that has any. A task
    sends on a row for each bucket."""

    def count(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in pieces(batches, 0):
            total += np.bincount(features(batch.column(0), longest, buckets)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    found = df.select(F.col(text_col).alias("text")).mapInArrow(count, "bucket long, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket, from the counts of both (at most ``buckets`` rows each)."""
    counts = np.zeros((2, buckets), dtype=np.int64)
    for side, df in enumerate((corpus, target)):
        for r in df.collect():
            counts[side, r.bucket] = r.n
    all_s, all_t = (float(int(n)) for n in counts.sum(axis=1))
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * (all_s + buckets) / ((s + 1.0) * (all_t + buckets))))
         for s, t in counts.T.tolist()], dtype=np.int64)


def noise(identifier: str | None, seed: int) -> int:
    """A standard Gumbel variable in thousandths, from a hash of the identifier."""
    h = int(hashlib.sha256(f"{seed}:{identifier or ''}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(
    df: DataFrame, gain: np.ndarray, id_col: str, text_col: str, longest: int = LONGEST, seed: int = SEED
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every row."""
    names = ["doc_id", "n_words", "n_features", "weight", "score"]

    def score(batches):
        for batch in pieces(batches, "text"):
            rows, found, words = features(batch.column("text"), longest, len(gain))
            n = np.bincount(rows, minlength=batch.num_rows)
            weight = np.zeros(batch.num_rows, dtype=np.int64)
            np.add.at(weight, rows, gain[found])
            extra = [noise(x, seed) for x in batch.column("name").to_pylist()]
            columns = [words.astype(np.int64), n.astype(np.int64), weight, weight + np.array(extra, dtype=np.int64)]
            yield pa.record_batch([batch.column("doc_id"), *map(pa.array, columns)], names)

    rows = df.select(
        F.col(id_col).alias("doc_id"), F.col(id_col).cast("string").alias("name"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in names[1:])])
    return rows.mapInArrow(score, schema)


def _order() -> list[Column]:
    return [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]


def _ranked(keys: pa.Table) -> pa.Table:
    """In the order of ranks: greater scores first, then smaller identifiers, null last."""
    by = [("score", "descending"), ("doc_id", "ascending"), ("row", "ascending")]
    return keys.sort_by(by)


def _before(key: dict, inclusive: bool) -> Column:
    """Whether a row ranks before ``key``."""
    same = F.col("doc_id").eqNullSafe(F.lit(key["doc_id"]))
    if key["doc_id"] is None:
        less = F.col("doc_id").isNotNull()
    else:
        less = F.coalesce(F.col("doc_id") < F.lit(key["doc_id"]), F.lit(False))
    row = F.col("row") <= F.lit(key["row"]) if inclusive else F.col("row") < F.lit(key["row"])
    return (F.col("score") > key["score"]) | ((F.col("score") == key["score"]) & (less | (same & row)))


def cutoff(keys: DataFrame, k: int, finish: int = FINISH) -> dict | None:
    """The ``k``-th key of ``keys`` (``score, doc_id, row``, stored, no two alike) in the order of ranks.

    Weighted median of medians: each round every task gives the median of its keys on either side of
    the pivot, so that whichever side holds the cutoff, the next pivot is known: the median of the
    medians, each weighted by its side's size. At most half of the keys can stand on the wrong
    side of half of the medians, so a quarter of the keys at least is out each round. When ``finish``
    keys are left, or one, they are sorted on the driver.
    """
    names = ["score", "doc_id", "row"]
    side_schema = T.StructType(
        [T.StructField("side", T.LongType()), T.StructField("size", T.LongType()), *(keys.schema[c] for c in names)])

    def medians(marked: DataFrame) -> list[dict]:
        """The median and number of the keys of every task, by side."""

        def find(batches):
            held = pa.Table.from_batches(batches, schema=None) if (batches := list(batches)) else None
            for side in (0, 1):
                own = held and held.filter(pa.compute.equal(held["side"], side))
                if own is not None and own and own.num_rows:
                    middle = _ranked(own.select(names)).slice((own.num_rows - 1) // 2, 1)
                    columns = [pa.array([side]), pa.array([own.num_rows]), *(c.combine_chunks() for c in middle.columns)]
                    yield pa.record_batch(columns, ["side", "size", *names])

        return [r.asDict() for r in marked.mapInArrow(find, side_schema).collect()]

    def pivot(found: list[dict]) -> dict:
        table = pa.Table.from_pylist([{c: r[c] for c in (*names, "size")} for r in found])
        table = _ranked(table)
        upto = np.cumsum(np.asarray(table["size"]))
        at = int(np.searchsorted(upto, (upto[-1] + 1) // 2))
        return {c: table[c][at].as_py() for c in names}

    left = keys.select(*names)
    found = medians(left.withColumn("side", F.lit(0).cast("long")))
    size = stored = sum(r["size"] for r in found)
    if not 0 < k <= size:
        return None
    while size > max(finish, 1):
        middle = pivot(found)
        first = _before(middle, True)
        found = medians(left.withColumn("side", F.when(first, 0).otherwise(1).cast("long")))
        ahead = sum(r["size"] for r in found if r["side"] == 0)
        side = int(k > ahead)
        if side:
            k -= ahead
        left = left.filter(~first if side else first)
        found = [r for r in found if r["side"] == side]
        size = size - ahead if side else ahead
        if size * SHRINK <= stored and size > finish:
            left, stored = cut(left, "keys"), size
    rest = _ranked(pa.Table.from_pylist([r.asDict() for r in left.collect()]))
    return {c: rest[c][k - 1].as_py() for c in names}


def ranks(winners: DataFrame) -> DataFrame:
    """``winners`` with ``rank`` from 1, by a distributed sort: within each range of keys rows are
    counted in order, and the sizes of the ranges before it are added."""
    spark = winners.sparkSession
    sorted_ = winners.repartitionByRange(parallelism(spark), *_order()).sortWithinPartitions(*_order())
    # The lower 33 bits of the number count the rows of a partition.
    place = F.monotonically_increasing_id()
    sorted_ = cut(sorted_.withColumns({"part": F.shiftright(place, 33), "place": place.bitwiseAND((1 << 33) - 1)}), "winners")
    sizes, before = {}, 0
    for r in sorted_.groupBy("part").count().collect():  # a row for each range
        sizes[r["part"]] = r["count"]
    offsets = []
    for part in sorted(sizes):
        offsets.append((part, before))
        before += sizes[part]
    ranges = spark.createDataFrame(offsets, "part long, before long")
    out = sorted_.join(F.broadcast(ranges), "part")  # as many rows as there are shuffle partitions
    return out.withColumn("rank", F.col("before") + F.col("place") + 1).drop("part", "place", "before")


def resample(
    df: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    seed: int = SEED,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    finish: int = FINISH,
) -> DataFrame:
    """One row per row of ``df``: ``doc_id, n_words, n_features, weight, score, rank``.

    Of the rows with at least ``least_words`` words, ``percent`` in a hundred (rounded down) are
    drawn, those of the greatest scores; ``rank`` counts them from 1 and is null for the others. Equal
    scores rank by identifier, a null one last, and repeated rows in any one order. ``weight`` sums the
    gains of all runs of 1 to ``longest`` words.

    Null and empty texts have no features and weight 0. With an empty target all buckets gain by
    their rarity in the corpus alone. An empty table gives an empty result. Other columns are
    ignored.
    """
    counted = bucket_counts(df, text_col, longest, buckets), bucket_counts(target, target_col, longest, buckets)
    scored = weigh(df, gains(*counted, buckets), id_col, text_col, longest, seed)
    scored = cut(scored.withColumn("row", F.monotonically_increasing_id()), "scores")
    eligible = F.col("n_words") >= least_words
    able = scored.filter(eligible)
    last = cutoff(able, percent * able.count() // 100, finish)
    if last is None:
        return scored.drop("row").withColumn("rank", F.lit(None).cast("long"))
    drawn = eligible & _before(last, True)
    rest = scored.filter(~drawn).withColumn("rank", F.lit(None).cast("long"))
    return ranks(scored.filter(drawn)).unionByName(rest).drop("row")
