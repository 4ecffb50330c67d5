"""N-gram Jaccard join by PartEnum signatures.

Two sets of shingles with a Jaccard similarity of at least G differ in few features, for their
size. The feature domain is dealt into parts and each part into cells; by the pigeonhole principle
similar sets agree on some subset of a part's cells, and so share its signature.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.stage import ROW, Numbered, apart, cut, numbered, parallelism
from daybook.llm.text import GOLDEN, Words, buffer_of, mix, pack, pieces, rolling, stream, unpack

SHINGLE = 4
#: Least similarity, in hundredths: intersection * 100 >= PERCENT * union.
PERCENT = 85

#: Sizes of a band span this factor.
BAND = 1.4
#: Cells of a part, of which one may differ.
CELLS = 3
#: So many parts beyond what the pigeonhole principle asks for, plus one for each so many differences.
SPARE_EVERY = 20
#: Portions in which signatures are dealt; more of them need less disk and more time.
PASSES = 2
#: Least bits of a set's sketch.
SKETCH = 1024
#: Bits of a feature's hash in the final comparison.
KEPT_BITS = 56
#: Members of one signature that a task compares with as many others.
BLOCK = 2048
#: A key is hot if it has more than one in so many times as many rows as there are shuffle partitions.
SPREAD = 4


def shingle_sets(column: pa.Array, n: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text: runs of ``n`` words after lower-casing A-Z; of
    fewer words the whole sequence; none without words."""
    words = Words(column)
    hashes = words.hashes(lower=True)
    runs = rolling(hashes, n, seed=n)
    sets = []
    for first, size in zip(words.first[:-1].tolist(), words.counts.tolist()):
        if size >= n:
            sets.append(np.unique(runs[first : first + size - n + 1]))
        elif size:
            sets.append(rolling(hashes[first : first + size], size, seed=size))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def band_edges(largest: int) -> np.ndarray:
    edges = [1]
    while edges[-1] <= largest:
        edges.append(max(edges[-1] + 1, int(edges[-1] * BAND)))
    return np.array(edges)


def differences(largest: np.ndarray | int, percent: int = PERCENT):
    """Most features in which two sets of at most ``largest`` can differ and still be similar."""
    return 2 * largest * (100 - percent) // (100 + percent)


def set_keys(sets: list[np.ndarray], size: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each whole set."""
    flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
    of = np.repeat(np.arange(len(sets)), size)
    return _joined(*_halves(of, flat, len(sets), 5)) ^ mix(size.astype(np.uint64))


def _halves(of: np.ndarray, features: np.ndarray, n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``n`` groups of features the sums of both halves of their hashes; exact."""
    with np.errstate(over="ignore"):
        keys = mix(features + stream(1, seed)[0])
    low = np.bincount(of, (keys & np.uint64(0xFFFFFFFF)).astype(np.float64), n)
    return low, np.bincount(of, (keys >> np.uint64(32)).astype(np.float64), n)


def _joined(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(low.astype(np.uint64) * GOLDEN ^ mix(high.astype(np.uint64)))


def sketches(sets: list[np.ndarray]) -> list[bytes]:
    """Per set, which classes of features have an odd number of members; there are about twice as
    many classes as features. Where two sketches differ there is a feature that only one set has, so
    that the number of differing bits never exceeds the number of features in which sets differ."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    if not len(size):
        return []
    bits = np.maximum(SKETCH, 1 << np.ceil(np.log2(2 * np.maximum(size, 1))).astype(np.int64))
    base = np.cumsum(bits) - bits
    flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
    of = np.repeat(np.arange(len(sets)), size)
    place = (mix(flat ^ GOLDEN) & (bits[of] - 1).astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(base[of] + place, minlength=int(bits.sum())) & 1).astype(bool)
    packed = np.packbits(odd)
    return [packed[b : b + n].tobytes() for b, n in zip((base >> 3).tolist(), (bits >> 3).tolist())]


class Sketches:
    """A column of sketches. Their lengths are powers of two, and folding one in half gives the
    sketch with half the classes."""

    def __init__(self, column: pa.Array):
        data, offsets = buffer_of(column)
        self.words, self.start = np.frombuffer(data.tobytes(), np.uint64), offsets[:-1] >> 3
        self.size = np.diff(offsets) >> 3

    def _folded(self, rows: np.ndarray, size: int, to: int) -> np.ndarray:
        x = self.words[self.start[rows][:, None] + np.arange(size)]
        while size > to:
            size >>= 1
            x = x[:, :size] ^ x[:, size:]
        return x

    def apart(self, rows: np.ndarray, other: Sketches, its: np.ndarray) -> np.ndarray:
        """In how many classes ``rows`` differ from rows ``its`` of the other column."""
        out = np.zeros(len(rows), dtype=np.int64)
        m, n = self.size[rows], other.size[its]
        for both in np.unique(m * (1 << 32) + n):
            a, b = int(both >> 32), int(both & 0xFFFFFFFF)
            at = np.flatnonzero((m == a) & (n == b))
            to = min(a, b)
            x, y = self._folded(rows[at], a, to), other._folded(its[at], b, to)
            out[at] = np.bitwise_count(x ^ y).sum(1, dtype=np.int64)
        return out


def may_link(x: Sketches, i, y: Sketches, j, m: np.ndarray, n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Whether the sets of rows ``i`` and ``j``, of sizes ``m`` and ``n``, can be similar; never
    wrongly no."""
    good = (100 * np.minimum(m, n) >= percent * np.maximum(m, n)) & (n > 0)
    at = np.flatnonzero(good)
    good[at] = x.apart(i[at], y, j[at]) <= differences(m[at] + n[at], percent) // 2
    return good


def signatures(sets: list[np.ndarray], percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of each set, and the number of the set each belongs to.

    A set takes part in the band of its own size and, if a similar set can lie there, in the next
    one. In a band whose sets may differ in ``k`` features there are ``k // 2 + spare`` parts of
    ``CELLS`` cells, and a signature for each choice of all but one cell of a part. At least ``spare``
    parts hold at most one difference, and so agree on all but one cell. A choice without features
    says little: a set with such choices in fewer than ``spare`` parts leaves them out, which still
    leaves an equal signature. Sets too small to differ have none; only equal ones are similar.
    """
    size = np.array([len(s) for s in sets], dtype=np.int64)
    edges = band_edges(int(size.max(initial=0)) * 2 + 2)
    flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
    begin = np.cumsum(size) - size
    own = np.searchsorted(edges, size, side="right") - 1
    out, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for ahead in (0, 1):
        band = own + ahead
        chosen = size > 0
        if ahead:
            chosen &= size * 100 >= percent * edges[np.minimum(band, len(edges) - 1)]
        k = differences(edges[np.minimum(band + 1, len(edges) - 1)] - 1, percent)
        number = np.flatnonzero(chosen & (k > 0))
        if not len(number):
            continue
        k, band, many = k[number], band[number], size[number]
        spare = 1 + k // SPARE_EVERY
        parts = k // 2 + spare
        cells = CELLS * parts
        first = np.cumsum(cells) - cells
        of = np.repeat(np.arange(len(number)), many)
        inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        features = flat[np.repeat(begin[number], many) + inside]
        with np.errstate(over="ignore"):
            place = mix(features + mix(band.astype(np.uint64) + np.uint64(977))[of])
            cell = ((place >> np.uint64(32)) * cells[of].astype(np.uint64)) >> np.uint64(32)
        at = first[of] + cell.astype(np.int64)
        total = int(cells.sum())
        row = np.repeat(np.arange(len(number)), cells)
        local = np.arange(total) - np.repeat(first, cells)
        # Of each part, all cells but one: sums over the part less those of the cell.
        low, high = (x - np.repeat(x.reshape(-1, CELLS).sum(1), CELLS) for x in _halves(at, features, total, 17))
        filled = np.bincount(at, minlength=total)
        filled = np.repeat(filled.reshape(-1, CELLS).sum(1), CELLS) - filled
        with np.errstate(over="ignore"):
            name = mix(band[row].astype(np.uint64) * np.uint64(1 << 32) + local.astype(np.uint64))
            code = mix(_joined(-low, -high) + name)
        hollow = (filled == 0).reshape(-1, CELLS).any(1)
        drops = np.bincount(row[::CELLS], hollow, len(number)) < spare
        keep = (filled > 0) | ~drops[row]
        out.append(code[keep])
        owners.append(number[row[keep]])
    return np.concatenate(out), np.concatenate(owners)


def _documents(source: DataFrame, shingle: int) -> DataFrame:
    """``ROW, doc_id, n_shingles, node, sketch``: the node is the hash of the set, so that equal sets
    are one node."""

    def read(batches):
        for batch in pieces(batches, "text"):
            sets = shingle_sets(batch.column("text"), shingle)
            size = np.array([len(s) for s in sets], dtype=np.int64)
            node = set_keys(sets, size).view(np.int64)
            own = [batch.column(ROW), batch.column("doc_id"), pa.array(size), pa.array(node)]
            yield pa.record_batch([*own, pa.array(sketches(sets), pa.binary())], names)

    names = [ROW, "doc_id", "n_shingles", "node", "sketch"]
    blank = [*(F.lit(0).cast("long").alias(c) for c in names[2:4]), F.lit(b"").alias("sketch")]
    return cut(source.mapInArrow(read, source.select(ROW, "doc_id", *blank).schema), "sets")


def _buckets(source: DataFrame, percent: int, shingle: int) -> DataFrame:
    """``sig, node, head, size``: members of signatures that several nodes share, ``head`` being the
    least of them. Nodes reach a task sorted by signature, and are read in one pass. Signatures
    are dealt in ``PASSES`` portions, so that only one portion is on the way at a time."""
    out = None
    for portion in range(PASSES):
        part = _portion(source, percent, shingle, portion)
        out = part if out is None else out.unionByName(part)
    return out


def _portion(source: DataFrame, percent: int, shingle: int, portion: int) -> DataFrame:
    def sign(batches):
        for batch in pieces(batches, "text"):
            sets = shingle_sets(batch.column("text"), shingle)
            node = set_keys(sets, np.array([len(s) for s in sets], dtype=np.int64))
            _, first = np.unique(node, return_index=True)
            code, owner = signatures([sets[i] for i in first], percent)
            own = code % np.uint64(PASSES) == portion
            columns = [code[own].view(np.int64), node[first][owner[own]].view(np.int64)]
            yield pa.record_batch([pa.array(c) for c in columns], ["sig", "node"])

    def share(batches):
        tail = np.zeros((0, 2), dtype=np.int64)  # the last run, which the next batch may go on with
        head = None  # (sig, least node) of a run that earlier batches began and that was passed on

        def runs(rows, head):
            fresh = np.ones(len(rows), dtype=bool)
            fresh[1:] = (rows[1:] != rows[:-1]).any(1)
            rows = rows[fresh]
            start = np.ones(len(rows), dtype=bool)
            start[1:] = rows[1:, 0] != rows[:-1, 0]
            first = np.flatnonzero(start)
            size = np.diff(first, append=len(rows))
            least = np.repeat(rows[first, 1], size)
            size = np.repeat(size, size)
            if head is not None:
                of_head = rows[:, 0] == head[0]
                least[of_head] = head[1]
                size[of_head] = 3  # it has more members than one batch
            keep = size > 1
            return pa.record_batch(
                [pa.array(c) for c in (rows[keep, 0], rows[keep, 1], least[keep], size[keep])],
                ["sig", "node", "head", "size"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([np.asarray(batch.column(c)) for c in range(2)], 1)
            rows = np.concatenate([tail, rows])
            last = int(np.searchsorted(rows[:, 0], rows[-1, 0]))
            if len(rows) - last > 1 << 16:  # a run larger than memory may hold is passed on in parts
                known = head if head is not None and head[0] == rows[-1, 0] else None
                yield runs(rows, head)
                head = known or (rows[-1, 0], rows[last, 1])
                tail = rows[-1:]
            else:
                yield runs(rows[:last], head)
                tail = rows[last:]
        yield runs(tail, head)

    signed = source.select("text").mapInArrow(sign, "sig long, node long")
    dealt = signed.repartition(parallelism(source.sparkSession), "sig").sortWithinPartitions("sig", "node")
    return cut(dealt.mapInArrow(share, "sig long, node long, head long, size long"), "buckets")


def _promising(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` that their sketches and sizes do not rule out."""

    def sift(batches):
        for batch in batches:
            x, y = Sketches(batch.column("x")), Sketches(batch.column("y"))
            m, n = np.asarray(batch.column("m")), np.asarray(batch.column("n"))
            row = np.arange(batch.num_rows)
            yield batch.select(["a", "b"]).filter(pa.array(may_link(x, row, y, row, m, n, percent)))

    left, right = nodes.toDF("a", "m", "x"), nodes.toDF("b", "n", "y")
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "m", "n", "x", "y")
    return cut(both.mapInArrow(sift, "a long, b long"), "pairs")


def _star_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Of each signature one member, picked by a hash, with every member of another component that
    the sketches do not rule out."""

    def sift(batches):
        for batch in batches:
            x, y = Sketches(batch.column("x")), Sketches(batch.column("sketch"))
            m, n = np.asarray(batch.column("m")), np.asarray(batch.column("n_shingles"))
            row = np.arange(batch.num_rows)
            good = may_link(x, row, y, row, m, n, percent)
            pair = np.stack([np.asarray(batch.column("center")), np.asarray(batch.column("node"))], 1)
            pair = np.sort(pair[good], axis=1)
            yield pa.record_batch([pa.array(pair[:, 0]), pa.array(pair[:, 1])], ["a", "b"])

    center = F.min(F.struct(F.xxhash64("sig", "node"), "node", "label", "n_shingles", "sketch")).alias("c")
    centers = members.groupBy("sig").agg(center).select(
        "sig",
        F.col("c.node").alias("center"),
        F.col("c.label").alias("its"),
        F.col("c.n_shingles").alias("m"),
        F.col("c.sketch").alias("x"),
    )
    both = members.join(centers, "sig").filter("label != its")
    return both.select("center", "node", "m", "n_shingles", "x", "sketch").mapInArrow(sift, "a long, b long")


def _cross_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes of a signature that have different labels and that sketches do not rule out.

    ``members``: ``sig, node, label, n_shingles, sketch, total``, the last being the number of members
    of the signature. They are dealt to blocks, and every pair of blocks is a group of its own, so
    that no task holds more than two blocks or gives out anything but promising pairs.
    """

    def compare(batches):
        held, at = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {c: np.asarray(batch.column(c)) for c in ("sig", "low", "high", "own", "node", "label", "n_shingles")}
            key = np.stack([rows["sig"], rows["low"], rows["high"]], 1)
            head = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(1)))
            for begin, end in zip(head, np.append(head[1:], len(key))):
                now = tuple(key[begin])
                if now != at and held:
                    yield within(held)
                    held = []
                at = now
                held.append(
                    {c: v[begin:end] for c, v in rows.items()}
                    | {"sketch": batch.column("sketch").slice(begin, end - begin)}
                )
        if held:
            yield within(held)

    def within(held):
        rows = {c: np.concatenate([h[c] for h in held]) for c in held[0] if c != "sketch"}
        sketch = Sketches(pa.concat_arrays([h["sketch"] for h in held]))
        first = rows["own"] == rows["low"]
        x, y = np.flatnonzero(first), np.flatnonzero(rows["own"] == rows["high"])
        out = [np.zeros((0, 2), np.int64)]
        step = max(1, (1 << 17) // max(1, len(y)))
        for begin in range(0, len(x), step):
            i, j = (v.ravel() for v in np.meshgrid(x[begin : begin + step], y, indexing="ij"))
            good = rows["label"][i] != rows["label"][j]
            if rows["low"][0] == rows["high"][0]:
                good &= i < j
            i, j = i[good], j[good]
            m, n = rows["n_shingles"][i], rows["n_shingles"][j]
            good = may_link(sketch, i, sketch, j, m, n, percent)
            pair = np.stack([rows["node"][i[good]], rows["node"][j[good]]], 1)
            out.append(np.sort(pair, axis=1))
        pairs = np.concatenate(out)
        return pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    blocks = F.ceil(F.col("total") / BLOCK)
    dealt = members.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), "blocks"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
    dealt = dealt.select("sig", "low", "high", "own", "node", "label", "n_shingles", "sketch")
    n = parallelism(members.sparkSession)
    dealt = dealt.repartition(n, "sig", "low", "high").sortWithinPartitions("sig", "low", "high")
    return dealt.mapInArrow(compare, "a long, b long").distinct()


def _verified(
    pairs: DataFrame, docs: DataFrame, source: DataFrame, percent: int, shingle: int
) -> DataFrame:
    """The pairs ``a, b`` whose sets are similar, by counting common features. Of a feature's hash
    ``KEPT_BITS`` travel, by differences of neighbours: enough to tell the features of two sets
    apart."""

    def sets_of(batches):
        for batch in pieces(batches, "text"):
            sets = shingle_sets(batch.column("text"), shingle)
            blobs = [pack(s >> np.uint64(64 - KEPT_BITS), sort=True) for s in sets]
            size = pa.array([len(s) for s in sets], pa.int64())
            yield pa.record_batch([batch.column("node"), size, pa.array(blobs, pa.binary())], names)

    def compare(batches):
        for batch in batches:
            keep = []
            for x, m, y, n in zip(*(batch.column(c) for c in ("x", "m", "y", "n"))):
                x = unpack(x.as_buffer(), m.as_py(), np.uint64, sort=True)
                y = unpack(y.as_buffer(), n.as_py(), np.uint64, sort=True)
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(both) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    one = docs.groupBy("node").agg(F.min(ROW).alias(ROW)).join(wanted, "node")
    texts = source.select(ROW, "text").join(one, ROW).select("node", "text")
    names = ["node", "size", "features"]
    sets = cut(texts.mapInArrow(sets_of, "node long, size long, features binary"), "features")
    left, right = sets.toDF("a", "m", "x"), sets.toDF("b", "n", "y")
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "m", "x", "n", "y")
    return cut(both.mapInArrow(compare, "a long, b long"), "links")


def _looked_up(rows: DataFrame, key: str, found: DataFrame, total: int) -> DataFrame:
    """``rows`` (stored, ``total`` of them) with the value that ``found`` (``key``, value; a row for
    every key of ``rows``) holds for their ``key``.

    Keys with more than one in ``SPREAD`` times as many rows as there are shuffle partitions are looked
    up where their rows are: there can be no more of them than that, so their values are broadcast. The
    others meet ``found`` by a shuffle, in which the rows that need nothing any more are dealt evenly.
    """
    most = SPREAD * parallelism(rows.sparkSession)
    value = next(c for c in found.columns if c != key)
    hot = rows.groupBy(key).count().filter(F.col("count") * most > total).select(key)
    known = found.join(F.broadcast(hot), key).select(key, F.col(value).alias("hot"))
    rows = rows.join(F.broadcast(known), key, "left")
    done = F.col("hot").isNotNull()
    rows = rows.withColumn("spare", F.when(done, F.xxhash64(*rows.columns).bitwiseOR(1)).otherwise(0))
    rows = rows.join(found.withColumn("spare", F.lit(0).cast("long")), [key, "spare"], "left")
    return rows.withColumn(value, F.coalesce("hot", value)).drop("hot", "spare")


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links``: the least node that it is connected with. Each
    round a node takes the least of its label, its neighbours' labels and the label of its label,
    until none changes. A component or a neighbourhood of any size is dealt over the tasks."""
    both = links.select("a", "b").union(links.select("b", "a")).distinct()
    both = cut(both, "edges")
    labels = cut(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    edges, nodes = both.count(), labels.count()
    while True:
        near = _looked_up(both, "b", labels.toDF("b", "near"), edges)
        near = near.groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        jump = _looked_up(labels, "label", labels.toDF("label", "further"), nodes)
        step = jump.join(near, "node").select(
            "node", F.col("label").alias("was"), F.least("label", "further", "near").alias("label"))
        step = cut(step, "labels")
        changed = step.filter("was != label").limit(1).count()
        labels = step.select("node", "label")
        if not changed:
            return labels


def jaccard_links(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    shingle: int = SHINGLE,
) -> tuple[DataFrame, DataFrame]:
    """Documents with the node of their set (``ROW, doc_id, n_shingles, node``), and links ``a, b``
    between nodes, enough to connect all that similar pairs connect.

    Nodes that share a signature are first compared with the least of them, and then, where they
    are in different components, with one that a hash picks for each signature. What that leaves in
    different components is compared pair by pair, so no link between components is lost, and a
    large group of near copies is not expanded into pairs. Sketches come first each time, and only
    what they cannot rule out is counted on whole sets.
    """
    source = numbered(df, F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    docs = _documents(source, shingle)
    nodes = docs.filter("n_shingles > 0").groupBy("node").agg(
        F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
    buckets = _buckets(source.select(ROW, "text"), percent, shingle)
    star = buckets.filter("node != head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    star = _promising(star, nodes, percent)
    links = _verified(star, docs, source, percent, shingle)
    labels = components(links)

    star = cut(_star_pairs(_open(buckets, labels, nodes), percent).distinct(), "pairs")
    more = _verified(star, docs, source, percent, shingle)
    links = links.unionByName(more)
    labels = components(links)
    rest = cut(_cross_pairs(_open(buckets, labels, nodes), percent), "pairs")
    return docs, links.unionByName(_verified(rest, docs, source, percent, shingle))


def _open(buckets: DataFrame, labels: DataFrame, nodes: DataFrame) -> DataFrame:
    """``sig, node, label, n_shingles, sketch, total``: members of signatures that hold several
    components. ``total`` counts the members of the signature."""
    named = buckets.filter("size > 2").select("sig", "node").distinct().join(labels, "node", "left")
    named = named.select("sig", "node", F.coalesce("label", "node").alias("label"))
    mixed = named.groupBy("sig").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("total"))
    mixed = mixed.filter("low != high").select("sig", "total")
    return named.join(mixed, "sig").join(nodes, "node")


def jaccard_classes(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    shingle: int = SHINGLE,
) -> DataFrame:
    """One row per row of ``df``: ``doc_id, n_shingles, component_id`` and the row's number
    (``stage.ROW``).

    Documents are connected when ``100 * |intersection| >= percent * |union|`` of their shingle
    sets. ``component_id`` is the least identifier of a component (null only if all are null).
    Null and empty texts have no shingles and stay alone, each with its own identifier. Repeated
    rows are separate documents with equal sets. An empty table gives an empty result.
    """
    return _classes(df, id_col, text_col, percent, shingle).drop("label")


def _classes(df: DataFrame, id_col="doc_id", text_col="text", percent=PERCENT, shingle=SHINGLE) -> DataFrame:
    """``jaccard_classes`` with a label per component; null for a text without words."""
    docs, links = jaccard_links(df, id_col, text_col, percent, shingle)
    labels = components(links)
    nodes = docs.filter("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    nodes = nodes.join(labels, "node", "left").select("node", "least", F.coalesce("label", "node").alias("label"))
    nodes = cut(nodes, "nodes")
    heads = nodes.groupBy("label").agg(F.struct(F.min("least").alias("component_id")).alias("head"))
    nodes = _looked_up(nodes, "label", heads, nodes.count()).select("node", "head.component_id", "label")
    nodes = cut(nodes, "components")
    columns = ["doc_id", "n_shingles", "component_id", "label", ROW]
    none = F.lit(None).cast("long").alias("label")
    alone = docs.filter("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), none, ROW)
    classed = docs.filter("n_shingles > 0").join(nodes, "node").select(columns)
    return classed.unionByName(alone)


def keep_one(df: DataFrame, **options) -> DataFrame:
    """The rows of ``df`` that stay, with all their columns: of each component the one with the
    least identifier, of equal ones the first row; every document without words. ``options`` are
    those of ``jaccard_classes``."""
    own, names, back = apart(df, "doc_id", "text")
    rows = numbered(own, *own.columns)
    classes = _classes(Numbered(rows), *names, **options)
    first = classes.filter("label IS NOT NULL").groupBy("label").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", ROW)).alias("best"))
    stay = first.select(F.col(f"best.{ROW}").alias(ROW))
    stay = cut(stay.union(classes.filter("label IS NULL").select(ROW)), "stay")
    return rows.join(stay, ROW, "left_semi").select(back)
