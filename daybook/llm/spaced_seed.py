"""Benchmark decontamination by spaced-seed hashing.

Fixed masks pick some of the words in a short span and ignore the others, so two texts that differ
by substituted words still share a masked hash. Hashes of the benchmark meet those of the corpus,
and the words around each hit are compared one by one.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.stage import ROW, Numbered, apart, cut, numbered
from daybook.llm.text import Words, mix, pieces, stream

#: An overlap is a window of 13 words of which at most 2 differ (a similarity above 0.8).
WINDOW = 13
DIFFERENT = 2
#: Whatever two words of a window differ, one of these masks hits it at some place: the family was
#: searched for that, and the tests go through all pairs.
MASKS = ("11110111", "1110100111", "1111111", "11101111")
#: An item of fewer words is a window of its own, in which one word of five may differ; its masks skip
#: one of three groups of places for one different word, two of four groups for two. Items of 5 words
#: have to occur as they are, those below (the least for word shingles is 5) are no evidence.
SHORTEST = 5
TOLERANT = 6

#: Long benchmark items are cut into pieces that overlap by a window, and so many words of the
#: benchmark (16 MB with their hashes) go to the tasks at a time; larger benchmarks take several
#: passes over the corpus.
PIECE = 2048
BLOCK_WORDS = 1 << 18


def allowed(size: int) -> int:
    """How many words of a window of ``size`` may differ."""
    return DIFFERENT if size >= WINDOW else size // 5 if size >= TOLERANT else 0


def short_masks(size: int) -> list[str]:
    """Masks as long as the window. Whatever allowed number of its words differs, one skips them all."""
    k = allowed(size)
    if not k:
        return ["1" * size]
    groups = k + 2
    return ["".join("0" if i * groups // size in skipped else "1" for i in range(size))
            for skipped in combinations(range(groups), k)]


def masked(hashes: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the words that ``mask`` picks, for each place where the mask fits."""
    size = max(0, len(hashes) - len(mask) + 1)
    places = [i for i, c in enumerate(mask) if c == "1"]
    keys = stream(len(places), sum(1 << i for i in places)) | np.uint64(1)
    total = np.zeros(size, np.uint64)
    with np.errstate(over="ignore"):
        for key, place in zip(keys, places):
            total += hashes[place : place + size] * key
        return mix(total)


def _sums(flags: np.ndarray) -> np.ndarray:
    """Number of flags in each window, row by row."""
    total = np.cumsum(np.pad(flags, ((0, 0), (1, 0))), axis=1)
    return total[:, WINDOW:] - total[:, :-WINDOW]


class Block:
    """Part of the benchmark: its words, item by item, and one sorted list of hashes per mask."""

    def __init__(self, items: list[int], words: list[np.ndarray]):
        self.item = np.array(items, dtype=np.int64)
        size = np.array([len(w) for w in words], dtype=np.int64)
        self.words = np.concatenate([*words, np.zeros(0, np.uint64)])
        self.last = np.cumsum(size)
        self.first = self.last - size
        self.of = np.repeat(np.arange(len(size)), size)
        self.tables: list[tuple[str | tuple[str], np.ndarray, np.ndarray, np.ndarray]] = []
        long = size >= WINDOW
        for mask in MASKS:
            self._table(mask, masked(self.words, mask), len(mask), long)
        for n in np.unique(size[(size >= SHORTEST) & ~long]):
            for mask in short_masks(int(n)):
                self._table((mask,), masked(self.words, mask), int(n), size == n)

    def _table(self, kind, hashes, span, wanted) -> None:
        at = np.arange(len(hashes))
        at = at[wanted[self.of[at]] & (at + span <= self.last[self.of[at]])]
        hashes = hashes[at]
        order = np.argsort(hashes, kind="stable")
        hashes, at = hashes[order], at[order]
        filled = np.zeros(1 << 22, dtype=bool)
        filled[hashes >> np.uint64(42)] = True
        self.tables.append((kind, hashes, at, filled))

    def hits(self, hashes: np.ndarray):
        """Pairs of places, in the corpus and in the block, with equal masked hashes; by kind."""
        for kind, known, at, filled in self.tables:
            if not len(known):
                continue
            own = masked(hashes, kind[0] if isinstance(kind, tuple) else kind)
            place = np.flatnonzero(filled[own >> np.uint64(42)])
            own = own[place]
            lo, hi = np.searchsorted(known, own, "left"), np.searchsorted(known, own, "right")
            n = hi - lo
            found = n > 0
            place, lo, n = place[found], lo[found], n[found]
            begin = 0
            while begin < len(n):  # a part at a time, however often a phrase occurs on both sides
                stop = begin + max(1, int(np.searchsorted(np.cumsum(n[begin:]), 1 << 16)))
                some = n[begin:stop]
                inner = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
                yield kind, np.repeat(place[begin:stop], some), at[np.repeat(lo[begin:stop], some) + inner]
                begin = stop

    def overlaps(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows of the corpus words that match: ``row``, ``item``, ``start``; each once.
        ``first``: number of the first word of each row, and one past the last."""
        found = [np.zeros((0, 4), dtype=np.int64)]
        for kind, p, q in self.hits(hashes):
            row = np.searchsorted(first, p, "right") - 1
            if isinstance(kind, tuple):  # the window is the whole item
                size = len(kind[0])
                whole = p + size <= first[row + 1]
                row, p, q = row[whole], p[whole], q[whole]
                reach = np.arange(size)
                same = hashes[p[:, None] + reach] == self.words[q[:, None] + reach]
                ok = same.sum(1) >= size - allowed(size)
                found.append(np.stack([row, self.item[self.of[q]], p - first[row], np.full(len(p), size)], 1)[ok])
                continue
            back = WINDOW - len(kind)
            reach = np.arange(-back, WINDOW)
            a, b = p[:, None] + reach, q[:, None] + reach
            inside = (a >= first[row][:, None]) & (a < first[row + 1][:, None])
            inside &= (b >= self.first[self.of[q]][:, None]) & (b < self.last[self.of[q]][:, None])
            same = hashes[np.clip(a, 0, len(hashes) - 1)] == self.words[np.clip(b, 0, len(self.words) - 1)]
            good = (_sums(inside) == WINDOW) & (_sums(same & inside) >= WINDOW - DIFFERENT)
            hit, shift = np.nonzero(good)
            start = p[hit] - back + shift - first[row[hit]]
            found.append(np.stack([row[hit], self.item[self.of[q[hit]]], start, np.full(len(hit), WINDOW)], 1))
        return np.unique(np.concatenate(found), axis=0)


def _normal(words: Words) -> np.ndarray:
    return words.hashes(lower=True)


def _pieces_of_items(tests: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def cut_up(batches):
        for batch in pieces(batches, "text"):
            words = Words(batch.column("text"))
            hashes, ids, blobs = _normal(words), [], []
            for number, item in enumerate(batch.column("item").to_pylist()):
                lo, hi = words.first[number], words.first[number + 1]
                for begin in range(lo, max(lo + 1, hi - WINDOW + 1), PIECE - WINDOW + 1):
                    ids.append(item)
                    blobs.append(hashes[begin : min(hi, begin + PIECE)].tobytes())
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(blobs, pa.binary())], ["item", "words"])

    chosen = tests.select(F.col(id_col).cast("long").alias("item"), F.col(text_col).alias("text"))
    return cut(chosen.dropna().mapInArrow(cut_up, "item long, words binary"), "benchmark")


def overlaps(
    docs: DataFrame | Numbered,
    tests: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    test_id: str = "item_id",
    test_text: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Windows of ``docs`` that match a benchmark item: ``ROW, doc_id, item_id, start, n_words``,
    where ``start`` counts words.

    Words are compared after lower-casing A-Z. Every window with at most ``DIFFERENT`` substituted
    words is found, and every whole shorter item with at most ``allowed`` ones: each holds a hit of a mask, and around each hit all windows are compared.
    Null texts have no words; items without identifier or text are left out; a repeated item is
    found under each of its identifiers.
    """
    known = _pieces_of_items(tests, test_id, test_text)
    total = known.agg(F.sum(F.length("words"))).first()[0] or 0
    blocks = max(1, -(-total // (8 * block_words)))
    source = numbered(docs, F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    counts = [F.lit(0).cast("long").alias(c) for c in ("item_id", "start", "n_words")]
    schema = source.select(ROW, "doc_id", *counts).schema
    out = None
    for number in range(blocks):
        part = known.filter(F.pmod(F.xxhash64("words"), F.lit(blocks)) == number).distinct()
        rows = sorted(part.collect(), key=lambda r: (r["item"], bytes(r["words"])))
        known_items = [r["item"] for r in rows], [bytes(r["words"]) for r in rows]

        def match(batches, known_items=known_items):
            items, blobs = known_items
            block = Block(items, [np.frombuffer(b, np.uint64) for b in blobs])
            for batch in pieces(batches, "text"):
                words = Words(batch.column("text"))
                row, item, start, size = block.overlaps(_normal(words), words.first).T
                own = [batch.column(c).take(pa.array(row)) for c in (ROW, "doc_id")]
                yield pa.record_batch([*own, pa.array(item), pa.array(start), pa.array(size)], schema.names)

        found = source.mapInArrow(match, schema)
        if blocks > 1:  # each pass ends here, and with it the driver's hold on its block
            found = cut(found, "matches")
        out = found if out is None else out.unionByName(found)
    return out


def decontaminate(
    docs: DataFrame, tests: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, contaminated, n_overlaps`` (matching windows),
    ``item_ids`` (sorted) and the row's number (``stage.ROW``). Documents without a match have 0 and
    an empty list. Empty tables give empty results or no matches. Other columns are ignored."""
    rows = numbered(docs, F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = cut(overlaps(Numbered(rows), tests, **options), "overlaps")
    per_row = found.groupBy(ROW).agg(
        F.countDistinct("item_id", "start").alias("n"), F.sort_array(F.collect_set("item_id")).alias("items")
    )
    return rows.select("doc_id", ROW).join(per_row, ROW, "left").select(
        "doc_id",
        F.col("n").isNotNull().alias("contaminated"),
        F.coalesce("n", F.lit(0).cast("long")).alias("n_overlaps"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("item_ids"),
        ROW,
    )


def keep_clean(docs: DataFrame, tests: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any match, with all their columns."""
    own, names, back = apart(docs, "doc_id", "text")
    rows = numbered(own, *own.columns)
    bad = cut(overlaps(Numbered(rows), tests, *names).select(ROW).distinct(), "leaks")
    return rows.join(bad, ROW, "left_anti").select(back)
