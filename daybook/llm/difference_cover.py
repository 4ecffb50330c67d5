"""Substring dedup on bytes with suffix arrays by the difference-cover algorithm.

Texts are dealt to shards by content, so that equal windows meet. In a shard the suffixes at two of
every three places are sorted by their first three symbols, named, and, if names repeat, sorted by
recursion on the names; the others follow from them, and both are merged. Neighbours in the
suffix array then show which windows occur again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.repeats import Unit, covered
from daybook.llm.stage import ROW, Numbered, dealt
from daybook.llm.text import buffer_of, pieces

#: Fixed value of the contract: bytes in a window.
WINDOW = 200
#: Bytes in the runs that windows are filed under.
ANCHOR = 64


def _names(first: np.ndarray, second: np.ndarray, third: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of triples, and the rank of each from 1; equal triples have equal ranks."""
    bound = int(max(x.max(initial=0) for x in (first, second, third))) + 1
    key = (first * bound + second) * bound + third
    order = np.argsort(key, kind="stable")
    fresh = np.ones(len(key), dtype=np.int64)
    fresh[1:] = key[order[1:]] != key[order[:-1]]
    rank = np.empty(len(key), dtype=np.int64)
    rank[order] = np.cumsum(fresh)
    return order, rank


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Places of ``text`` in the order of their suffixes. Symbols are positive and below 2^20, and so
    is the length."""
    n = len(text)
    if n < 4:
        return np.array(sorted(range(n), key=lambda i: text[i:].tolist()), dtype=np.int64)
    t = np.concatenate([text.astype(np.int64), np.zeros(3, np.int64)])
    # The sample: places 1 and 2 modulo 3, and one past the end so that blocks of names part.
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate([one, two])
    order, rank = _names(t[sample], t[sample + 1], t[sample + 2])
    if int(rank.max()) < len(sample):
        order = suffix_array(rank)
        rank[order] = np.arange(1, len(sample) + 1)
    ranks = np.zeros(n + 4, dtype=np.int64)
    ranks[sample] = rank
    sample = sample[order]
    sample = sample[sample < n]

    rest = np.arange(0, n, 3)
    bound = n + 3
    rest = rest[np.argsort(t[rest] * bound + ranks[rest + 1], kind="stable")]
    # Where each of the rest stands among sampled suffixes of either kind.
    is_one = sample % 3 == 1
    first, second = sample[is_one], sample[~is_one]
    place = np.searchsorted(t[first] * bound + ranks[first + 1], t[rest] * bound + ranks[rest + 1])
    symbols = int(t.max()) + 1
    key = (t[second] * symbols + t[second + 1]) * bound + ranks[second + 2]
    place += np.searchsorted(key, (t[rest] * symbols + t[rest + 1]) * bound + ranks[rest + 2])
    place += np.arange(len(rest))
    out = np.empty(n, dtype=np.int64)
    taken = np.zeros(n, dtype=bool)
    taken[place] = True
    out[place] = rest
    out[~taken] = sample
    return out


def repeated(shard: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Windows of a shard's segments that occur again in the shard."""
    first, size = shard["offsets"][:-1], np.diff(shard["offsets"])
    begin = np.cumsum(size + 1) - (size + 1)
    text = np.ones(int((size + 1).sum()), dtype=np.int64)  # 1 ends a segment
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    at = np.repeat(begin, size) + inside
    text[at] = shard["data"][np.repeat(first, size) + inside].astype(np.int64) + 2
    order = suffix_array(text)
    n = shard["n"]
    owner = np.full(len(text), -1, dtype=np.int64)
    window = np.repeat(begin, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    owner[window] = np.repeat(np.arange(len(n)), n)
    order = order[owner[order] >= 0]  # suffixes that begin a window; equal windows are neighbours
    # Adjacent prefixes, eight bytes at a time, as far as they agree.
    data = np.concatenate([(text - 2).astype(np.uint8), np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.sliding_window_view(data, 8)
    same = np.arange(1, len(order))
    for k in range(0, WINDOW, 8):
        k = min(k, WINDOW - 8)
        a, b = order[same - 1] + k, order[same] + k
        same = same[(eight[a] == eight[b]).all(1)]
    again = np.unique(np.concatenate([order[same - 1], order[same]])) if len(order) else order
    return owner[again], again - begin[owner[again]]


def repeated_windows(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``ROW, start, n``: runs of ``n`` windows of ``WINDOW`` bytes that also start anywhere else."""
    source = dealt(df, F.lit(0).cast("long").alias("id"), F.col(text_col).alias("text"))
    return covered(source, Unit("bytes", WINDOW, ANCHOR), True, repeated)


def dedup_bytes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: ``doc_id, kept`` (the remaining bytes of the text in UTF-8),
    ``n_bytes, n_removed, n_spans`` (maximal removed runs) and the row's number.

    Removed is each byte in a window that also starts elsewhere, in whatever row; so of repeated
    rows none keeps what is as long as a window. Null is the empty text. An empty table gives an
    empty result.
    """
    rows = dealt(df, F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    runs = repeated_windows(Numbered(rows))
    lists = runs.groupBy(ROW).agg(F.collect_list(F.struct("start", "n")).alias("list"))
    rows = rows.join(lists, ROW, "left")

    def keep(batches):
        for batch in pieces(batches, "text"):
            data, offsets = buffer_of(batch.column("text"))
            size, lists = np.diff(offsets), batch.column("list")
            out, removed, spans = [], [], []
            for number, runs in enumerate(lists):
                text = data[offsets[number] : offsets[number + 1]]
                many = 0
                if runs.is_valid:
                    gone = np.zeros(len(text) + 1, dtype=np.int64)
                    start, n = (np.asarray(runs.values.field(i)) for i in range(2))
                    np.add.at(gone, start, 1)
                    np.add.at(gone, start + n + WINDOW - 1, -1)
                    lost = np.cumsum(gone[:-1]) > 0
                    many = int(lost[0]) + int((lost[1:] & ~lost[:-1]).sum())
                    text = text[~lost]
                out.append(text.tobytes())
                removed.append(int(size[number]) - len(text))
                spans.append(many)
            columns = [pa.array(out, pa.binary()), *(pa.array(c, pa.int64()) for c in (size, removed, spans))]
            yield pa.record_batch([batch.column("doc_id"), *columns, batch.column(ROW)], names)

    names = ["doc_id", "kept", "n_bytes", "n_removed", "n_spans", ROW]
    blank = [F.lit(b"").alias("kept"), *(F.lit(0).cast("long").alias(c) for c in names[2:5])]
    return rows.mapInArrow(keep, rows.select("doc_id", *blank, ROW).schema)


def digests(df: DataFrame) -> DataFrame:
    """``dedup_bytes`` with the SHA-256 of the kept bytes in their place."""
    return dedup_bytes(df).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
