"""Bringing equal windows of all documents together, without moving the documents.

Every window of a document is filed under the least hash among the short runs of symbols in it
(its anchor). Equal windows have equal anchors. Neighbouring windows with the same anchor form a
segment; segments, not windows, are sorted by anchor and content. What is left of unique text is
dropped there, equal segments collapse, and only distinct segments that share an anchor have to
be looked into, by whatever index the caller builds on them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.stage import ROW, cut, parallelism
from daybook.llm.text import Words, buffer_of, mix, mix_light, pieces, stream

#: Symbols that an index is built on at a time; what one task holds of the corpus.
SHARD = 1 << 20
#: Bytes of text that a task hashes at a time.
PIECE = 2 << 20

COVERED, SHARED, CROWDED = 0, 1, 2
#: Where a null identifier ranks.
LAST_ID = 2**63 - 1
FOUND = ["kind", "anchor", "id", ROW, "start", "n", "copies"]
PLACE_BITS = np.uint64(28)


class Unit:
    """What a document is a sequence of: words or bytes, in windows of ``window`` symbols, filed
    under runs of ``anchor`` symbols."""

    def __init__(self, kind: str, window: int, anchor: int):
        self.kind, self.window, self.anchor = kind, window, anchor

    def read(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all texts as 64-bit hashes, and where each text begins."""
        if self.kind == "words":
            words = Words(column)
            return words.hashes(), words.first
        data, offsets = buffer_of(column)
        return stream(256, 41)[data], offsets

    @property
    def crowd(self) -> int:
        """Distinct segments of one anchor that still fit an index."""
        return SHARD // (2 * self.window)


def _doubled(values: np.ndarray, n: int, join: Callable, last: Callable) -> np.ndarray:
    """Fold each run of ``n`` neighbours, from runs of half the length."""
    if len(values) < n:
        return values[:0]
    size = 1
    while 2 * size <= n:
        values = join(values[: len(values) - size], values[size:])
        size *= 2
    rest = n - size
    return last(values[: len(values) - rest], values[rest:]) if rest else values


def run_hash(symbols: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of ``n`` symbols."""
    first, second = stream(2, 53) | np.uint64(1)

    def join(a, b):
        with np.errstate(over="ignore"):
            return mix_light(a * first) + mix_light(b) * second

    return mix(_doubled(symbols, n, join, lambda a, b: join(b, a)))


def segments(symbols: np.ndarray, first: np.ndarray, unit: Unit) -> dict[str, np.ndarray]:
    """Segments of all texts: ``row``, ``start`` in its text, ``n`` windows, ``anchor`` hash and
    ``content`` hash. The anchor of a window is its leftmost run of least hash, so that no window
    can occur twice in a segment. First and last window cover a segment, so that their hashes stand
    for its content."""
    window = unit.window
    size = np.diff(first)
    grams = run_hash(symbols, unit.anchor)
    place = np.arange(len(grams), dtype=np.uint64)
    if len(grams) >> int(PLACE_BITS):
        raise ValueError("a text of more than 2^28 symbols has to be cut")
    packed = ((grams >> PLACE_BITS) << PLACE_BITS) | place
    least = _doubled(packed, window - unit.anchor + 1, np.minimum, np.minimum)
    at = (least & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    windows = np.maximum(size - window + 1, 0)
    row = np.repeat(np.arange(len(size)), windows)
    start = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
    begin = first[:-1][row] + start
    at = at[begin]
    fresh = np.ones(len(row), dtype=bool)
    fresh[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    head = np.flatnonzero(fresh)
    n = np.diff(head, append=len(row))
    whole = run_hash(symbols, window)
    with np.errstate(over="ignore"):
        content = mix(whole[begin[head]] + mix(whole[begin[head] + n - 1]) + n.astype(np.uint64))
    return {"row": row[head], "start": start[head], "n": n, "anchor": grams[at[head]], "content": content}


FILED = ["anchor", "content", "id", ROW, "start", "n", "copies"]


def _first_copies(content, id, row, start) -> np.ndarray:
    """For each segment of a piece: how many equal ones the piece has, if it is the first of them in
    order of identifier, row and place; else 0."""
    copies = np.ones(len(content), dtype=np.int64)
    order = np.argsort(content, kind="stable")
    head = np.flatnonzero(np.append(True, content[order][1:] != content[order][:-1])[: len(order)])
    size = np.diff(head, append=len(order))
    among = order[np.repeat(size > 1, size)]
    if len(among):
        among = among[np.lexsort([start[among], row[among], id[among], content[among]])]
        size = size[size > 1]
        copies[among] = 0
        copies[among[np.cumsum(size) - size]] = size
    return copies


def _file(found, id, row_no) -> pa.RecordBatch:
    row = found["row"]
    copies = _first_copies(found["content"], id[row], row, found["start"])
    columns = [
        found["anchor"].view(np.int64),
        found["content"].view(np.int64),
        id[row],
        row_no[row],
        found["start"],
        found["n"],
        copies,
    ]
    return pa.record_batch([*map(pa.array, columns)], FILED)


def _filed(source: DataFrame, unit: Unit) -> DataFrame:
    def file(batches):
        for batch in pieces(batches, "text", PIECE):
            found = segments(*unit.read(batch.column("text")), unit)
            id = np.asarray(batch.column("id").fill_null(LAST_ID))
            yield _file(found, id, np.asarray(batch.column(ROW)))

    return source.mapInArrow(file, ", ".join(f"{c} long" for c in FILED))


def _collapse(filed: DataFrame, crowd: int, all_copies: bool) -> DataFrame:
    """What the segments' order by anchor and content tells.

    Kind ``COVERED``: every window of the segment occurs elsewhere: in an equal segment that comes
    earlier or, with ``all_copies``, in any equal segment. Kind ``SHARED``: one segment of each
    content under an anchor that has several contents, or of the only one if it has copies and
    ``all_copies`` is off. Kind ``CROWDED``: the same, of anchors with more than ``crowd`` contents.
    A task keeps no more than that of one anchor, and no copies. Copies that were found where the
    segment was made (``copies`` is 0) pass through, and are dealt by row.
    """

    def emit(kind, rows, copies):
        columns = [np.full(len(rows), kind), rows[:, 0], rows[:, 2], rows[:, 3], rows[:, 4], rows[:, 5], copies]
        return pa.record_batch([pa.array(np.ascontiguousarray(c, dtype=np.int64)) for c in columns], FOUND)

    def collapse(batches):
        rows = np.zeros((0, 7), dtype=np.int64)  # distinct segments of the last anchor
        copies = np.zeros(0, dtype=np.int64)
        crowded = None  # the last anchor, if it has too many

        def settle(rows, copies):
            """Distinct segments of whole anchors."""
            fresh = np.ones(len(rows), dtype=bool)
            fresh[1:] = rows[1:, 0] != rows[:-1, 0]
            contents = np.diff(np.flatnonzero(fresh), append=len(rows))
            contents = np.repeat(contents, contents)
            many = np.full(len(rows), False) if crowded is None else rows[:, 0] == crowded
            if all_copies:
                yield emit(COVERED, rows[copies > 1], copies[copies > 1])
                shared = (contents > 1) & ~many
            else:
                shared = ((contents > 1) | (copies > 1)) & ~many
            yield emit(SHARED, rows[shared], copies[shared])
            yield emit(CROWDED, rows[many], copies[many])

        for batch in batches:
            if not batch.num_rows:
                continue
            new = np.stack([np.asarray(batch.column(c)) for c in FILED], 1)
            known = new[:, 6] == 0
            yield emit(COVERED, new[known], new[known, 6])
            new = new[~known]
            every = np.concatenate([rows, new])
            if not len(every):
                continue
            weight = np.concatenate([copies, new[:, 6]])
            fresh = np.ones(len(every), dtype=bool)
            fresh[1:] = (every[1:, :2] != every[:-1, :2]).any(1)
            yield emit(COVERED, every[~fresh], weight[~fresh])
            copies = np.add.reduceat(weight, np.flatnonzero(fresh))
            rows = every[fresh]
            last = int(np.searchsorted(rows[:, 0], rows[-1, 0]))
            yield from settle(rows[:last], copies[:last])
            rows, copies = rows[last:], copies[last:]
            if len(rows) > crowd or crowded == rows[-1, 0]:
                crowded = rows[-1, 0]
                yield from settle(rows[:-1], copies[:-1])
                rows, copies = rows[-1:], copies[-1:]
        if len(rows):
            yield from settle(rows, copies)

    n = parallelism(filed.sparkSession)
    order = ["anchor", "content", "id", ROW, "start"]
    by = F.when(F.col("copies") > 0, F.col("anchor")).otherwise(F.xxhash64(ROW, "start"))
    dealt = filed.repartition(n, by).sortWithinPartitions(*order).select(FILED)
    return cut(dealt.mapInArrow(collapse, ", ".join(f"{c} long" for c in FOUND)), "segments")


def _with_text(found: DataFrame, source: DataFrame) -> DataFrame:
    """``ROW, text, list``: the documents that segments lie in, with those segments."""
    fields = F.struct("start", "n", "anchor", "id", "copies")
    lists = found.groupBy(ROW).agg(F.collect_list(fields).alias("list"))
    return source.select(ROW, "text").join(lists, ROW)


def _lists(batch: pa.RecordBatch) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Row numbers in the batch and fields of all segments of all its lists."""
    lists = batch.column("list")
    sizes = np.diff(np.asarray(lists.offsets))
    flat = lists.flatten()
    return np.repeat(np.arange(len(sizes)), sizes), {
        f.name: np.asarray(flat.field(f.name)) for f in flat.type
    }


def _contents(found: DataFrame, source: DataFrame, unit: Unit) -> DataFrame:
    """The symbols of each segment, as bytes (eight for a word)."""

    def read(batches):
        for batch in pieces(batches, "text", PIECE):
            row, seg = _lists(batch)
            if unit.kind == "words":
                symbols, first = unit.read(batch.column("text"))
            else:
                symbols, first = buffer_of(batch.column("text"))
            begin = first[row] + seg["start"]
            end = begin + seg["n"] + unit.window - 1
            blobs = [symbols[a:b].tobytes() for a, b in zip(begin.tolist(), end.tolist())]
            columns = [seg["anchor"], seg["id"], np.asarray(batch.column(ROW))[row], seg["start"], seg["n"], seg["copies"]]
            names = ["anchor", "id", ROW, "start", "n", "copies", "symbols"]
            yield pa.record_batch([*map(pa.array, columns), pa.array(blobs, pa.binary())], names)

    schema = f"anchor long, id long, {ROW} long, start long, n long, copies long, symbols binary"
    return _with_text(found, source).mapInArrow(read, schema)


def _single_windows(found: DataFrame, source: DataFrame, unit: Unit) -> DataFrame:
    """The windows of crowded segments, each filed under its own hash."""

    def file(batches):
        for batch in pieces(batches, "text", PIECE):
            row, seg = _lists(batch)
            symbols, first = unit.read(batch.column("text"))
            n = seg["n"]
            of = np.repeat(np.arange(len(n)), n)
            start = seg["start"][of] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            whole = run_hash(symbols, unit.window)
            key = whole[first[row[of]] + start].view(np.int64)
            windows = {"row": row[of], "start": start, "n": np.ones(len(of), np.int64), "anchor": key, "content": key}
            id = np.full(batch.num_rows, LAST_ID)
            id[row] = seg["id"]
            yield _file(windows, id, np.asarray(batch.column(ROW)))

    return _with_text(found, source).mapInArrow(file, ", ".join(f"{c} long" for c in FILED))


def shards(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[dict[str, np.ndarray]]:
    """Segments of whole anchors, as many as make ``SHARD`` symbols of ``width`` bytes, from batches
    in order of anchor."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += int(np.sum(np.diff(buffer_of(batch.column("symbols"))[1]))) // width
        if size >= SHARD // 2:
            every = pa.Table.from_batches(held).combine_chunks()
            anchor = np.asarray(every.column("anchor"))
            last = int(np.searchsorted(anchor, anchor[-1]))
            yield from _split(every.slice(0, last), width)
            held = every.slice(last).to_batches()
            size = sum(int(np.sum(np.diff(buffer_of(b.column("symbols"))[1]))) for b in held) // width
    if held:
        yield from _split(pa.Table.from_batches(held).combine_chunks(), width)


def _split(table: pa.Table, width: int) -> Iterator[dict[str, np.ndarray]]:
    if not table.num_rows:
        return
    batch = table.to_batches()[0]
    data, offsets = buffer_of(batch.column("symbols"))
    fields = {c: np.asarray(batch.column(c)) for c in ("anchor", "id", ROW, "start", "n", "copies")}
    anchor = fields["anchor"]
    heads = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    begin = 0
    while begin < len(anchor):
        room = offsets[begin] + SHARD * width
        far = int(np.searchsorted(offsets, room, "right")) - 1
        after = heads[(heads > begin) & (heads <= far)]
        stop = int(after[-1]) if len(after) and far < len(anchor) else len(anchor)
        if far < len(anchor) and not len(after):  # one anchor with more than a shard
            later = heads[heads > begin]
            stop = int(later[0]) if len(later) else len(anchor)
        out = {c: v[begin:stop] for c, v in fields.items()}
        out["data"] = data[offsets[begin] : offsets[stop]]
        out["offsets"] = (offsets[begin : stop + 1] - offsets[begin]) // width
        yield out
        begin = stop


def covered(source: DataFrame, unit: Unit, all_copies: bool, look: Callable) -> DataFrame:
    """``ROW, start, n``: runs of ``n`` windows that occur elsewhere (``all_copies``) or earlier.

    ``source`` has ``ROW, id`` (an integer) and ``text``. ``look`` gets shards of segments that share
    anchors and returns, as arrays ``segment, window``, which windows of which segment occur again.
    """
    found = _collapse(_filed(source, unit), unit.crowd, all_copies)
    known = found.filter(F.col("kind") == COVERED).select(ROW, "start", "n")
    width = 8 if unit.kind == "words" else 1

    def index(batches):
        for shard in shards(batches, width):
            segment, window = look(shard)
            columns = [shard[ROW][segment], shard["start"][segment] + window, np.ones(len(segment), np.int64)]
            order = np.lexsort(columns[1::-1])
            row, start = columns[0][order], columns[1][order]
            fresh = np.ones(len(row), dtype=bool)
            fresh[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)
            head = np.flatnonzero(fresh)
            n = np.diff(head, append=len(row))
            yield pa.record_batch([pa.array(row[head]), pa.array(start[head]), pa.array(n)], [ROW, "start", "n"])

    spark = source.sparkSession
    shared = _contents(found.filter(F.col("kind") == SHARED), source, unit)
    dealt = shared.repartition(parallelism(spark), "anchor").sortWithinPartitions("anchor")
    looked = cut(dealt.mapInArrow(index, f"{ROW} long, start long, n long"), "matches")
    out = known.unionByName(looked)
    crowd = found.filter(F.col("kind") == CROWDED)
    if crowd.limit(1).count():
        single = _collapse(_single_windows(crowd, source, unit), unit.crowd, all_copies)
        out = out.unionByName(single.filter(F.col("kind") == COVERED).select(ROW, "start", "n"))
    return out
