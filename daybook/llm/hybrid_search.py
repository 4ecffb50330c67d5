"""Ranked lexical search, part term-at-a-time, part document-at-a-time.

The corpus is dealt into shards, each an inverted file of its own. For a query, a shard first sums its
short posting lists into accumulators, term by term. These then stand for one more list, with a bound
of its own, beside the long lists, and all are walked in order of documents, a window at a time: windows
and documents whose bounds cannot reach the k-th best score so far are skipped, and lists that cannot
lift a document there are only looked into for documents that others name.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from daybook.llm.stage import cut
from daybook.llm.text import MARKS, Words, pack, pieces, unpack

#: A shard is closed once it has so many terms, repeats included, or documents.
SHARD_TERMS = 1 << 21
SHARD_DOCS = 1 << 16
#: Documents in a window.
WINDOW = 1 << 10
#: Lists with at most this share of a shard's documents are short.
SHORT = 16
#: About how many distinct terms of queries go to the tasks at a time; more take several passes
#: over the index.
BLOCK_TERMS = 1 << 18

#: Fixed values of the contract: how many are returned, and the score's constants.
TOP = 20
FLAT, SLOPE, UNIT, WEIGHT = 75, 25, 1_000_000_000, 1000


def _terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms, and how many each text has."""
    words = Words(column, MARKS)
    return words.hashes(lower=True), words.counts


def _shard(number: int, ids: pa.Array, counts: np.ndarray, terms: np.ndarray) -> pa.RecordBatch:
    """One row: an inverted file. Documents are numbered in the order of their identifiers."""
    order = np.asarray(pc.sort_indices(ids, sort_keys=[("", "ascending")], null_placement="at_end")).astype(np.int64)
    place = np.empty(len(order), dtype=np.uint32)
    place[order] = np.arange(len(order), dtype=np.uint32)
    doc = np.repeat(place, counts)
    by = np.argsort(doc.astype(np.uint16) if len(order) <= 1 << 16 else doc, kind="stable")
    doc, terms = doc[by], terms[by]
    by = np.argsort(terms, kind="stable")
    doc, terms = doc[by], terms[by]
    fresh = np.ones(len(terms), dtype=bool)
    fresh[1:] = (terms[1:] != terms[:-1]) | (doc[1:] != doc[:-1])
    head = np.flatnonzero(fresh)
    tf = np.diff(head, append=len(terms)).astype(np.uint32)
    doc, terms = doc[head], terms[head]
    first = np.ones(len(terms), dtype=bool)
    first[1:] = terms[1:] != terms[:-1]
    start = np.flatnonzero(first)
    size = np.diff(start, append=len(terms)).astype(np.uint32)
    values = [
        pa.array([number]),
        pa.array([int((counts > 0).sum())]),
        pa.array([int(counts.sum())]),
        pa.array([len(start)]),
        pa.array([len(doc)]),
        pa.array([pack(terms[start], sort=True)], pa.binary()),
        pa.array([pack(size)], pa.binary()),
        pa.array([pack(doc)], pa.binary()),
        pa.array([pack(tf)], pa.binary()),
        pa.array([counts[order]], pa.list_(pa.int64())),
        pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.take(pa.array(order))),
    ]
    return pa.record_batch(values, COLUMNS)


COLUMNS = ["shard", "n_docs", "n_terms", "n_lists", "n_postings", "terms", "sizes", "docs", "tfs", "lengths", "ids"]


def build_index(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    shard_terms: int = SHARD_TERMS, shard_docs: int = SHARD_DOCS,
) -> DataFrame:
    """The index of all of ``df``, stored, one row per shard: its terms' hashes in order with the sizes
    of their lists, all lists one after the other (documents and frequencies), and of the documents, in
    the order of their identifiers (null last), lengths and identifiers. Texts without a term have no
    postings; repeated rows are documents of their own."""

    def read(batches):
        part, number = TaskContext.get().partitionId(), 0
        ids, counts, terms = [], [], []
        for batch in pieces(batches, "text"):
            found, size = _terms(batch.column("text"))
            ids.append(batch.column("id"))
            counts.append(size)
            terms.append(found)
            if sum(map(len, terms)) >= shard_terms or sum(map(len, counts)) >= shard_docs:
                yield _shard(part << 32 | number, pa.concat_arrays(ids), np.concatenate(counts), np.concatenate(terms))
                number += 1
                ids, counts, terms = [], [], []
        if ids:
            yield _shard(part << 32 | number, pa.concat_arrays(ids), np.concatenate(counts), np.concatenate(terms))

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kinds = [T.LongType()] * 5 + [T.BinaryType()] * 4 + [T.ArrayType(T.LongType()), T.ArrayType(rows.schema["id"].dataType)]
    schema = T.StructType([T.StructField(c, k) for c, k in zip(COLUMNS, kinds)])
    return cut(rows.mapInArrow(read, schema), "index")


class Queries:
    """A block of queries: distinct terms in order, and for each query its number, its terms (places among
    the former) and how often it has each."""

    def __init__(self, rows: list):
        every = [np.asarray(r["terms"], dtype=np.int64).view(np.uint64) for r in rows]
        self.number = [r["number"] for r in rows]
        self.terms = np.unique(np.concatenate([*every, np.zeros(0, np.uint64)]))
        self.lists = []
        for own in every:
            term, count = np.unique(own, return_counts=True)
            self.lists.append((np.searchsorted(self.terms, term), count.astype(np.int64)))
        self.weight = np.zeros(len(self.terms), dtype=np.int64)

    def places(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which own terms are among ``terms``, and where."""
        at = np.minimum(np.searchsorted(terms, self.terms), max(len(terms) - 1, 0))
        own = np.flatnonzero(terms[at] == self.terms) if len(terms) else np.zeros(0, np.int64)
        return own, at[own]


class Shard:
    """The lists of one shard that some query asks for, with what each posting adds to a score, and the
    greatest such value of each list in each window."""

    def __init__(self, row: dict, queries: Queries, n_docs: int, n_terms: int):
        terms = unpack(row["terms"], row["n_lists"], np.uint64, sort=True)
        sizes = unpack(row["sizes"], row["n_lists"], np.uint32).astype(np.int64)
        own, at = queries.places(terms)
        self.size = len(row["lengths"])
        self.windows = -(-self.size // WINDOW)
        self.list_of = np.full(len(queries.terms), -1, dtype=np.int64)
        self.list_of[own] = np.arange(len(own))
        self.length = sizes[at]
        begin = (np.cumsum(sizes) - sizes)[at]
        self.begin = np.append(0, np.cumsum(self.length))
        of = np.repeat(np.arange(len(own)), self.length)
        pick = np.arange(self.begin[-1]) - np.repeat(self.begin[:-1], self.length) + begin[of]
        self.docs = unpack(row["docs"], row["n_postings"], np.uint32)[pick].astype(np.int64)
        tf = unpack(row["tfs"], row["n_postings"], np.uint32)[pick].astype(np.int64)
        m = FLAT + (SLOPE * row["lengths"] * n_docs) // max(n_terms, 1)
        self.adds = queries.weight[own][of] * ((UNIT * tf) // (1000 * tf + 12 * m[self.docs]))
        key = of * self.windows + self.docs // WINDOW
        self.edge = np.searchsorted(key, np.arange(len(own) * self.windows + 1))
        self.most = np.zeros(len(own) * self.windows, dtype=np.int64)
        full = np.flatnonzero(np.diff(self.edge))
        if len(full):
            self.most[full] = np.maximum.reduceat(self.adds, self.edge[full])
        self.most = self.most.reshape(len(own), self.windows)

    def part(self, one: int, window: int) -> slice:
        at = one * self.windows + window
        return slice(self.edge[at], self.edge[at + 1])

    def best(self, terms: np.ndarray, counts: np.ndarray, top: int, known: np.ndarray, short: int = SHORT):
        """Documents and scores of the ``top`` best, but for those that ``known`` scores, found
        elsewhere, rule out. ``known`` is in descending order."""
        lists = self.list_of[terms]
        counts, lists = counts[lists >= 0], lists[lists >= 0]
        brief = self.length[lists] * short <= self.size
        # Term at a time: short lists are summed up.
        sums = np.zeros(self.windows * WINDOW, dtype=np.int64)
        for one, count in zip(lists[brief], counts[brief]):
            some = slice(self.begin[one], self.begin[one + 1])
            sums[self.docs[some]] += count * self.adds[some]
        lists, counts = lists[~brief], counts[~brief]
        # Document at a time: the sums, as list -1, beside the long lists.
        names = np.append(-1, lists)
        bounds = np.concatenate([sums.reshape(self.windows, WINDOW).max(axis=1)[None], self.most[lists] * counts[:, None]])
        times = dict(zip(lists.tolist(), counts.tolist()))
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        least = max(1, int(known[top - 1])) if len(known) >= top else 1
        total = bounds.sum(axis=0)
        for window in range(self.windows):
            if total[window] < least:
                continue
            order = np.argsort(bounds[:, window], kind="stable")
            upto = np.cumsum(bounds[order, window])
            idle = int(np.searchsorted(upto, least))  # lists that cannot reach the least score together
            base = window * WINDOW
            score = np.zeros(WINDOW, dtype=np.int64)
            for k in order[idle:]:
                if names[k] < 0:
                    score += sums[base : base + WINDOW]
                else:
                    some = self.part(names[k], window)
                    score[self.docs[some] - base] += times[int(names[k])] * self.adds[some]
            found = np.flatnonzero(score)
            score = score[found]
            for k in range(idle - 1, -1, -1):
                able = score + upto[k] >= least
                found, score = found[able], score[able]
                if not len(found):
                    break
                name = names[order[k]]
                if name < 0:
                    score = score + sums[base + found]
                    continue
                some = self.part(name, window)
                own = self.docs[some] - base
                if len(own):
                    at = np.minimum(np.searchsorted(own, found), len(own) - 1)
                    score = score + np.where(own[at] == found, times[int(name)] * self.adds[some][at], 0)
            able = score >= least
            if able.any():
                docs, scores = np.append(docs, base + found[able]), np.append(scores, score[able])
                keep = np.lexsort([docs, -scores])[:top]
                docs, scores = docs[keep], scores[keep]
                every = np.sort(np.append(known, scores))[::-1]
                if len(every) >= top:
                    least = max(least, int(every[top - 1]))
        return docs, scores


def _read_queries(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item_id, number, terms`` (hashes, repeats included) of every item, stored."""

    def read(batches):
        for batch in pieces(batches, "text"):
            terms, counts = _terms(batch.column("text"))
            lists = pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(terms.view(np.int64)))
            yield pa.record_batch([batch.column("item_id"), lists], ["item_id", "terms"])

    rows = items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["item_id"], T.StructField("terms", T.ArrayType(T.LongType()))])
    return cut(rows.mapInArrow(read, schema).withColumn("number", F.monotonically_increasing_id()), "queries")


def _frequencies(index: DataFrame, queries: Queries) -> dict[int, int]:
    """In how many documents each term of the block occurs, by its place in the block."""

    def count(batches):
        total = np.zeros(len(queries.terms), dtype=np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                own, at = queries.places(unpack(row["terms"], row["n_lists"], np.uint64, sort=True))
                total[own] += unpack(row["sizes"], row["n_lists"], np.uint32)[at]
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], ["term", "n"])

    found = index.select("n_lists", "terms", "sizes").mapInArrow(count, "term long, n long")
    return {r["term"]: r["n"] for r in found.groupBy("term").agg(F.sum("n").alias("n")).collect()}


def search(
    index: DataFrame,
    items: DataFrame,
    top: int = TOP,
    id_col: str = "item_id",
    text_col: str = "text",
    block_terms: int = BLOCK_TERMS,
    short: int = SHORT,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: for every item the ``top`` documents of greatest score above
    0, equal scores by ascending identifier (null last; repeated rows in any one order).

    A task walks its shards for all items of a block and sends on ``top`` rows an item, as the best
    scores of one shard spare work in the next. Items come to the driver block by block. Items
    without a known term (null and empty ones too) give no rows; repeated items are items of their
    own. An empty index gives an empty result.
    """
    spark = index.sparkSession
    totals = index.agg(F.sum("n_docs").alias("n_docs"), F.sum("n_terms").alias("n_terms")).first()
    n_docs, n_terms = int(totals.n_docs or 0), int(totals.n_terms or 0)
    stored = _read_queries(items, id_col, text_col)
    size = stored.agg(F.sum(F.size("terms")).alias("n")).first().n or 0
    blocks = -(-size // block_terms)
    id_type = index.schema["ids"].dataType.elementType
    schema = T.StructType(
        [T.StructField("number", T.LongType()), T.StructField("doc_id", id_type), T.StructField("score", T.LongType())])
    out = []
    for block in range(blocks):
        mine = stored.filter(F.pmod(F.xxhash64("number"), F.lit(blocks)) == block)
        queries = Queries(mine.select("number", "terms").collect())
        for term, df in _frequencies(index, queries).items():
            queries.weight[term] = math.floor(WEIGHT * math.log((2 * n_docs + 2) / (2 * df + 1)))

        def walk(batches, queries=queries):
            best: list[list[tuple]] = [[] for _ in queries.number]
            for batch in batches:
                for number in range(batch.num_rows):
                    row = {c: batch.column(c)[number].as_py() for c in NEEDED}
                    row["lengths"] = np.asarray(batch.column("lengths")[number].values)
                    ids = batch.column("ids")[number].values
                    shard = Shard(row, queries, n_docs, n_terms)
                    for held, (terms, counts) in zip(best, queries.lists):
                        known = np.array([-x[0] for x in held], dtype=np.int64)
                        docs, scores = shard.best(terms, counts, top, known, short)
                        if len(docs):
                            names = ids.take(pa.array(docs)).to_pylist()
                            held += [(-s, x is None, x) for s, x in zip(scores.tolist(), names)]
                            held.sort(key=lambda x: x if x[2] is not None else x[:2])
                            del held[top:]
            found = [(n, x, -s) for n, held in zip(queries.number, best) for s, _, x in held]
            if found:
                columns = [pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), ids.type, pa.int64()))]
                yield pa.record_batch(columns, ["number", "doc_id", "score"])

        shards = index.select(*NEEDED, "lengths", "ids")
        out.append(cut(shards.mapInArrow(walk, schema), "found"))
    if not out:
        out = [spark.createDataFrame([], schema)]
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    order = W.partitionBy("number").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(stored.select("number", "item_id"), "number").select("item_id", "rank", "doc_id", "score")


NEEDED = ["n_lists", "n_postings", "terms", "sizes", "docs", "tfs"]
