"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is wanted a fractional number of times. Pairs of fractions trade words,
with the sum kept, until one of the two is integral; a reduction tree over blocks does the rest.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.stage import ROW, Numbered, apart, counted_once, cut, numbered, parallelism
from daybook.llm.text import Words, mix, pieces

#: Fixed values of the contract: weights of the sources in turn, words of the mix as a share of
#: all words, and how often a text may be taken.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2

#: Documents in a leaf block, and blocks that one merge of the tree takes in.
BLOCK = 4096
FAN = 64

UNITS = "source_no long, block long, row long, key long, size long, p double, state int, out int"
PENDING = -1


def count_words(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """``df`` with the number of words of ``text_col`` in its place."""
    text_no = df.columns.index(text_col)
    kept = [c for c in df.columns if c != text_col]

    def count(batches):
        for batch in pieces(batches, text_no):
            sizes = pa.array(Words(batch.column(text_no)).counts.astype(np.int64))
            yield pa.record_batch([*(batch.column(c) for c in kept), sizes], [*kept, out])

    schema = df.select(*kept, F.lit(0).cast("long").alias(out)).schema
    return df.mapInArrow(count, schema)


def ranked(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` with column ``rank``, from 0, in the given order; sorted over all tasks. Only the
    number of rows in each partition comes to the driver."""
    n = parallelism(df.sparkSession)
    dealt = cut(
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
        .withColumn("place", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)),
        "ranks",
    )
    counts = {r["part"]: r["n"] for r in dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, offsets = 0, []
    for part in sorted(counts):
        offsets += [F.lit(part), F.lit(before).cast("long")]
        before += counts[part]
    offset = F.create_map(*offsets)[F.col("part")] if offsets else F.lit(0)
    return dealt.withColumn("rank", offset + F.col("place")).drop("part", "place")


def source_targets(rows: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Per source: ``source_no, source_size, n_docs, target``.

    Targets share ``share`` times all words by weight; what is above ``most`` times a source's own
    words goes to the others by weight, until nothing is above.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    listed = ranked(sizes, [F.col("source").isNull(), F.col("source")])
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    listed = listed.withColumnRenamed("rank", "source_no").withColumn(
        "weight", cycle[F.col("source_no") % len(weights)]
    )
    room = F.col("source_size") * float(most)
    level = -1.0  # words for one unit of weight
    while True:
        full = room <= F.col("weight") * level
        sums = listed.agg(
            F.sum(F.col("source_size")).alias("all"),
            F.sum(F.when(full, room).otherwise(0.0)).alias("capped"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("free"),
        ).first()
        left = share * (sums["all"] or 0) - (sums["capped"] or 0)
        raised = left / sums["free"] if sums["free"] else level
        if raised <= level:
            break
        level = raised
    return listed.withColumn("target", F.least(room, F.col("weight") * F.lit(max(level, 0.0))))


def _coin(a: int, b: int) -> float:
    """A number in [0, 1) that depends on the two units only."""
    with np.errstate(over="ignore"):
        x = mix(mix(np.array([a], np.int64).view(np.uint64)) ^ np.array([b], np.int64).view(np.uint64))
    return float(x[0] >> np.uint64(11)) / 2.0**53


def _trade(a: list, b: list) -> None:
    """Move words between two fractional units, their sum kept, until one is integral. Which way is
    chosen at random so that neither's expected share changes."""
    words = a[4] * a[5] + b[4] * b[5]
    low, high = max(0.0, (words - b[4]) / a[4]), min(1.0, words / a[4])
    if high > low:
        a[5] = high if _coin(a[3], b[3]) * (high - low) < a[5] - low else low
    b[5] = (words - a[4] * a[5]) / b[4]
    for unit in (a, b):
        if unit[5] < 1e-9 or unit[5] > 1 - 1e-9:
            unit[5] = unit[6] = round(unit[5])
    if a[6] == PENDING and b[6] == PENDING:  # by rounding errors only
        b[5] = b[6] = round(b[5])


class _Group:
    """One block of one source: the unit still fractional, and for each size class a decided unit
    of either kind that the last step may turn over."""

    def __init__(self) -> None:
        self.open: list | None = None
        self.spares: dict[tuple[int, int], list] = {}
        self.decided: list[list] = []
        self.turned: list[list] = []

    def spare(self, unit: list) -> None:
        kind = (unit[4].bit_length(), unit[6])
        if kind not in self.spares or unit[3] < self.spares[kind][3]:
            self.spares[kind] = unit

    def add(self, unit: list) -> None:
        if unit[6] != PENDING:
            self.spare(unit)
        elif self.open is None:
            self.open = unit
        else:
            _trade(self.open, unit)
            for done in (self.open, unit):
                if done[6] != PENDING:
                    self.decided.append(done)
                    self.spare(done)
            self.open = next((u for u in (self.open, unit) if u[6] == PENDING), None)

    def finish(self) -> None:
        """Round the last unit of the source at random, then turn over units, one or two of the
        spares and itself at a time, while that brings the words taken nearer to what they should be."""
        if self.open is None:
            return
        unit = self.open
        unit[6] = int(_coin(unit[3], 1) < unit[5])
        error = unit[4] * (unit[6] - unit[5])
        self.decided.append(unit)
        spares = sorted([unit, *self.spares.values()], key=lambda u: (-u[4], u[3]))
        steps = [u[4] if u[6] == 0 else -u[4] for u in spares]
        while True:
            sums = [(steps[i], (i,)) for i in range(len(steps))]
            sums += [(x + steps[j], (i, j)) for x, (i,) in sums for j in range(i)]
            best = min(((abs(error + x), x, turned) for x, turned in sums), default=(abs(error),))
            if best[0] >= abs(error):
                break
            error += best[1]
            for i in sorted(best[2], reverse=True):
                self.turned.append([*spares[i][:6], 1 - spares[i][6]])
                del spares[i], steps[i]
        self.open, self.spares = None, {}


def _merge(units: DataFrame, last: bool) -> DataFrame:
    """One round of the tree: the units of a block are settled in order of size, largest first.
    Rows with ``out`` 0 are decisions, those with 2 overrule them, those with 1 go to the next
    round."""
    names = [x.split()[0] for x in UNITS.split(", ")]

    def settle(batches):
        group, at = _Group(), None

        def emit(rows):
            columns = list(zip(*rows)) if rows else [[] for _ in names]
            kinds = [pa.int64()] * 5 + [pa.float64(), pa.int32(), pa.int32()]
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        def leave(group):
            if last:
                group.finish()
            rows = [[*u[:7], 0] for u in group.decided]
            carried = [*([group.open] if group.open else []), *group.spares.values()]
            return rows + [[*u[:7], 2] for u in group.turned] + [[*u[:7], 1] for u in carried]

        for batch in batches:
            rows = []
            for unit in zip(*(batch.column(c).to_pylist() for c in names[:7])):
                if unit[:2] != at:
                    rows += leave(group)
                    group, at = _Group(), unit[:2]
                group.add(list(unit))
            rows += [[*u[:7], 0] for u in group.decided]
            group.decided = []
            yield emit(rows)
        yield emit(leave(group))

    n = parallelism(units.sparkSession)
    order = ["source_no", "block", F.col("size").desc(), "key", "row"]
    dealt = units.repartition(n, "source_no", "block").sortWithinPartitions(*order)
    return dealt.mapInArrow(settle, UNITS)


def mix_sources(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    block: int = BLOCK,
    fan: int = FAN,
) -> DataFrame:
    """One row per row of ``df``: ``doc_id, size, source_size, target, copies, taken`` and the row's
    number (``stage.ROW``).

    ``size`` counts the words of the whole text, null as none. A document is wanted ``target /
    source_size`` times; the whole part is given, the rest is a unit for the tree. Leaf blocks hold
    about ``block`` units of one source, dealt by a hash, so that a source of any size is spread
    over tasks, and a merge takes in ``fan`` blocks. Besides its one open unit a block hands on a
    spare per size class; at the root they make up for rounding the last unit. No document exceeds
    ``most`` copies.

    A null source is a source of its own, in the last place. Documents without words, sources
    without words and empty tables give zeros. Repeated rows are separate documents. Randomness is
    a hash of identifier and text, so reruns agree.
    """
    rows = counted_once(
        df, F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("t")
    )
    rows = rows.withColumn("key", F.xxhash64("doc_id", "t"))
    rows = cut(count_words(rows, "t", "size"), "sizes")
    listed = source_targets(rows, weights, share, most)
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    blocks = F.ceil(F.col("n_docs") / block)
    listed = listed.withColumn("wanted", wanted).withColumn("blocks", blocks)
    listed = listed.withColumn("given", F.floor("wanted").cast("int"))
    listed = listed.select("source", "source_no", "source_size", "target", "wanted", "given", "blocks")
    named = listed.withColumnRenamed("source", "named")
    docs = rows.join(named, F.col("source").eqNullSafe(F.col("named")))

    rest = F.col("wanted") - F.col("given")
    units = docs.filter((rest > 0) & (F.col("size") > 0)).select(
        "source_no",
        F.pmod("key", "blocks").alias("block"),
        F.col(ROW).alias("row"),
        "key",
        "size",
        rest.alias("p"),
        F.lit(PENDING).alias("state"),
    )
    left = listed.agg(F.max("blocks")).first()[0] or 1
    rounds = []
    while True:
        rounds.append(cut(_merge(units, last=left <= 1), "pivots"))
        if left <= 1:
            break
        left = -(-left // fan)
        up = rounds[-1].filter("out = 1").drop("out")
        units = up.withColumn("block", (F.col("block") / fan).cast("long"))
    decided = None
    for number, done in enumerate(rounds):
        part = done.filter("out != 1").select("row", F.lit(number).alias("round"), "out", "state")
        decided = part if decided is None else decided.unionByName(part)
    decided = decided.groupBy("row").agg(F.max_by("state", F.struct("round", "out")).alias("extra"))
    copies = F.col("given") + F.coalesce("extra", F.lit(0))
    return docs.join(decided.withColumnRenamed("row", ROW), ROW, "left").select(
        "doc_id",
        "size",
        F.col("source_size"),
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"),
        ROW,
    )


def take_mix(df: DataFrame, **options) -> DataFrame:
    """The rows of ``df`` that the mix takes, with all their columns and, beside them, ``copies``,
    ``size``, ``source_size``, ``target`` and ``taken``; columns of ``df`` with these names are
    replaced."""
    own, names, back = apart(df, "doc_id", "text", "source")
    rows = numbered(own, *own.columns)
    mixed = mix_sources(Numbered(rows), *names, **options).drop("doc_id").filter("taken > 0")
    more = [c for c in mixed.columns if c != ROW]
    kept = [column for column, name in zip(back, df.columns) if name not in more]
    return rows.join(mixed, ROW).select(*kept, *more)
