"""Substring dedup on words with a compressed FM-index per shard.

The index of a shard is the Burrows-Wheeler transform of its text, held as a wavelet matrix of
packed bits. Documents stream through it from right to left; backward search keeps the interval of
the last words read, cut to the window, and so the matching statistics capped at the window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.repeats import Unit, covered
from daybook.llm.stage import ROW, Numbered, dealt
from daybook.llm.text import pieces

#: Fixed value of the contract: words in a window.
WINDOW = 20
#: Words in the runs that windows are filed under.
ANCHOR = 6


class Bits:
    """A bit vector with rank, 64 bits a word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(np.pad(bits, (0, -len(bits) % 64 + 64)), bitorder="little").view(np.uint64)
        self.words = packed
        self.before = np.cumsum(np.bitwise_count(packed), dtype=np.int64) - np.bitwise_count(packed)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first ``i`` bits."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class Wavelet:
    """A wavelet matrix: one bit vector per binary digit of the symbols, highest first."""

    def __init__(self, symbols: np.ndarray, digits: int):
        self.levels = []
        for digit in range(digits - 1, -1, -1):
            ones = (symbols >> digit) & 1 == 1
            self.levels.append((digit, Bits(ones), int(len(symbols) - ones.sum())))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def ranks(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each ``symbol`` occurs before ``low`` and before ``high``."""
        base = np.zeros_like(low)
        for digit, bits, zeros in self.levels:
            one = (symbol >> digit) & 1 == 1
            r = [bits.rank(x) for x in (base, low, high)]
            base, low, high = (
                np.where(one, zeros + ones, x - ones) for x, ones in zip((base, low, high), r)
            )
        return low - base, high - base


class FmIndex:
    """Index of a text of integer symbols above 0; 0 ends each of its parts. Suffixes are in the
    order of their first ``depth`` symbols, which is all that patterns of that length need."""

    def __init__(self, text: np.ndarray, depth: int):
        self.depth = depth
        size = len(text)
        pad = np.concatenate([text, np.zeros(depth, text.dtype)])
        ranks = {1: pad.astype(np.int64)}

        def dense(high, low):
            key = high * (size + depth + 2) + low
            order = np.argsort(key, kind="stable")
            fresh = np.zeros(len(key), dtype=np.int64)
            fresh[1:] = key[order[1:]] != key[order[:-1]]
            out = np.empty(len(key), dtype=np.int64)
            out[order] = np.cumsum(fresh)
            return out

        def after(rank, k):
            return np.concatenate([rank[k:], np.zeros(min(k, len(rank)), np.int64)])

        def prefix(n):
            """Rank of each suffix by its first ``n`` symbols."""
            if n not in ranks:
                half = 1 << (n - 1).bit_length() - 1
                ranks[n] = dense(prefix(half), after(prefix(n - half), half))
            return ranks[n]

        whole, shorter = prefix(depth)[:size], prefix(depth - 1)[:size]
        self.suffixes = np.argsort(whole, kind="stable")
        self.counts = np.cumsum(np.bincount(text, minlength=int(text.max(initial=0)) + 1))
        self.counts -= np.bincount(text, minlength=len(self.counts))
        last = np.where(self.suffixes > 0, text[self.suffixes - 1], 0)
        self.wavelet = Wavelet(last, max(1, int(text.max(initial=1)).bit_length()))
        self.size = size
        self.wide = self._bounds(shorter)
        equal = self._bounds(whole)
        self.earliest = np.minimum.reduceat(self.suffixes, np.unique(equal[0])) if size else self.suffixes
        self.group = np.cumsum(np.append(False, equal[0][1:] != equal[0][:-1]))

    def _bounds(self, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each place in the order, the interval of suffixes with an equal rank."""
        own = rank[self.suffixes]
        head = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        size = np.diff(head, append=len(own))
        return np.repeat(head, size), np.repeat(head + size, size)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of each pattern with ``symbol`` put before it."""
        before, upto = self.wavelet.ranks(symbol, low, high)
        return self.counts[symbol] + before, self.counts[symbol] + upto

    def shorten(self, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of the first ``depth - 1`` symbols of a pattern of ``depth``."""
        return self.wide[0][low], self.wide[1][low]

    def stream(self, text: np.ndarray, first: np.ndarray, end: np.ndarray):
        """Read documents from right to left, all at once. Yields ``document, place, low, high`` for
        every place whose next ``depth`` symbols occur in the index: their interval.

        Where the symbols from a place on do not occur, no match reaches as far as the last of
        them, and reading goes on from the one before.
        """
        low = np.zeros(len(first), dtype=np.int64)
        high = np.full(len(first), self.size, dtype=np.int64)
        matched = np.zeros(len(first), dtype=np.int64)
        place = end.copy()
        active = np.flatnonzero(place > first)
        while len(active):
            a, b, m = low[active], high[active], matched[active]
            full = m == self.depth
            a[full], b[full] = self.shorten(a[full])
            m[full] -= 1
            at = place[active] - 1
            a, b = self.extend(text[at], a, b)
            some = b > a
            low[active], high[active] = np.where(some, a, 0), np.where(some, b, self.size)
            matched[active] = np.where(some, m + 1, 0)
            place[active] = np.where(some, at, at + m)
            hit = active[matched[active] == self.depth]
            yield hit, place[hit], low[hit], high[hit]
            active = active[place[active] > first[active]]


def earlier_windows(shard: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Windows of a shard's segments that also start earlier, in order of identifier, row and
    place. The shard's segments are indexed in that order, and then streamed through the index."""
    order = np.lexsort([shard["start"], shard[ROW], shard["id"]])
    words = shard["data"].view(np.uint64)
    first, size = shard["offsets"][:-1][order], np.diff(shard["offsets"])[order]
    _, names = np.unique(words, return_inverse=True)
    begin = np.cumsum(size + 1) - (size + 1)
    text = np.zeros(int((size + 1).sum()), dtype=np.int64)
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    text[np.repeat(begin, size) + inside] = names[np.repeat(first, size) + inside] + 1
    index = FmIndex(text, WINDOW)
    segment, window = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for document, place, low, _ in index.stream(text, begin, begin + size):
        again = index.earliest[index.group[low]] < place
        segment.append(order[document[again]])
        window.append((place - begin[document])[again])
    return np.concatenate(segment), np.concatenate(window)


def repeated_windows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``ROW, start, n``: runs of ``n`` windows of ``WINDOW`` words that also start earlier: in a
    row of a smaller integer identifier (null ranks last, then the row number) or earlier in the row."""
    source = dealt(df, F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return covered(source, Unit("words", WINDOW, ANCHOR), False, earlier_windows)


def dedup_words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: ``doc_id, kept_text, n_words, n_removed`` and the row's number.

    Removed is each word in a window that also starts earlier; ``kept_text`` joins the others by a
    space. Null and empty texts have no words. Of repeated rows the first stays whole. An empty
    table gives an empty result.
    """
    rows = dealt(df, F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    runs = repeated_windows(Numbered(rows))
    lists = runs.groupBy(ROW).agg(F.collect_list(F.struct("start", "n")).alias("list"))
    rows = rows.join(lists, ROW, "left")

    def keep(batches):
        for batch in pieces(batches, "text"):
            texts, lists = batch.column("text").cast(pa.binary()), batch.column("list")
            out, total, removed = [], [], []
            for text, runs in zip(texts, lists):
                words = text.as_py().split() if text.is_valid else []  # the same six bytes part words
                total.append(len(words))
                if runs.is_valid:
                    gone = np.zeros(len(words) + 1, dtype=np.int64)
                    start, n = (np.asarray(runs.values.field(i)) for i in range(2))
                    np.add.at(gone, start, 1)
                    np.add.at(gone, start + n + WINDOW - 1, -1)
                    stay = np.cumsum(gone[:-1]) == 0
                    words = [words[i] for i in np.flatnonzero(stay)]
                removed.append(total[-1] - len(words))
                out.append(b" ".join(words))
            columns = [pa.array(out, pa.binary()).cast(pa.string()), pa.array(total), pa.array(removed)]
            yield pa.record_batch([batch.column("doc_id"), *columns, batch.column(ROW)], names)

    names = ["doc_id", "kept_text", "n_words", "n_removed", ROW]
    blank = [F.lit("").alias("kept_text"), *(F.lit(0).cast("long").alias(c) for c in names[2:4])]
    return rows.mapInArrow(keep, rows.select("doc_id", *blank, ROW).schema)


def digests(df: DataFrame) -> DataFrame:
    """``dedup_words`` with the SHA-256 of the kept text in its place."""
    kept = F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    return dedup_words(df).select("doc_id", "n_words", "n_removed", kept)
