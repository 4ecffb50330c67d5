"""Katz backoff language model: Good-Turing discounted counts in partitioned tables.

Every word seen in training has an identity of its own, its 64-bit hash. The unigram table lies in
parts by word, the bigram table in parts by context; what one needs of the other (the counts of its
words) is asked for by part, so that no task and no driver holds the vocabulary.

Rows are blocks of keys, packed: within a block, words are numbered by a sorted dictionary of hashes,
and a pair is ``context << HALF | word`` in these numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.stage import ROW, crc_rest, cut, drop, numbered, parallelism, recording
from daybook.llm.text import GOLDEN, Words, mix, pack, pieces, stream, unpack

#: Counts up to this are discounted (Katz's k).
GOOD_TURING = 5
#: Training tokens for which a part of the bigram table is made; bounds what a task holds. Contexts
#: with more than half as many are dealt to several parts, by the next word.
PART_TOKENS = 3 << 20
#: Bytes of text that a task turns into keys at a time.
PIECE = 8 << 20
#: Texts are scored in so many portions, so that only one's keys are on disk.
PORTIONS = 4
#: Ranges of contexts in which the blocks of a part are merged.
MERGES = 8

END, START, RARE = stream(5, 71)[2:]
HALF = np.uint64(32)
LOW = (np.uint64(1) << HALF) - np.uint64(1)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, each closed by ``END``, and where each text begins."""
    words = Words(column)
    n = len(words.counts)
    out = np.full(len(words.start) + n, END, dtype=np.uint64)
    out[np.arange(len(words.start)) + words.row] = words.hashes(lower=True)
    return out, words.first + np.arange(n + 1)


def counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sum of their weights."""
    if weights is None:
        keys = np.sort(keys)
        head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
        return keys[head], np.diff(head, append=len(keys))
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[head], np.add.reduceat(weights, head) if len(head) else weights


def blocks(parts: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs of equal parts in an ascending array: ``part, begin, end``."""
    head = np.flatnonzero(np.append(True, parts[1:] != parts[:-1])[: len(parts)])
    return list(zip(parts[head].tolist(), head.tolist(), np.append(head[1:], len(parts)).tolist()))


def part_of_word(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Ascending with the hash."""
    return (((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


@dataclass
class Classes:
    """Figures of the unigram table. Words unseen in training form one class. With a ``share``, so do
    words with less than one in ``share`` tokens; ``own`` has the others, by hash."""

    n_tokens: int
    n_words: int
    by_count: list[int]  # how many words occur once, twice, ...
    share: int | None = None
    own: np.ndarray | None = None
    own_counts: np.ndarray | None = None

    def __post_init__(self):
        self.discount = discounts(self.by_count)
        if self.share is None:
            self.own_tokens, self.own_words = self.n_tokens, self.n_words
            r = np.arange(1, GOOD_TURING + 1)
            off = ((1 - self.discount[r]) * r * np.array(self.by_count[:GOOD_TURING])).sum()
        else:
            c = self.own_counts
            self.own_tokens, self.own_words = int(c.sum()), len(c)
            off = ((1 - self.discount[np.minimum(c, GOOD_TURING + 1)]) * c).sum()
        total = (self.own_tokens - off) / max(self.n_tokens, 1)
        # The class has what is left, at least what one more token would have.
        least = 1.0 / (self.n_tokens + 1)
        self.factor = (1 - least) / total if total > 1 - least else 1.0
        self.left = 1 - total * self.factor

    def owned(self, counts: np.ndarray) -> np.ndarray:
        return counts > 0 if self.share is None else (counts > 0) & (counts * self.share >= self.n_tokens)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """Words as bigrams have them."""
        if self.share is None:
            return hashes
        return np.where(located(self.own, hashes)[1], hashes, RARE)

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        """Discounted probability of words by their counts; the class's if they have none of their own."""
        p = self.discount[np.minimum(counts, GOOD_TURING + 1)] * counts / max(self.n_tokens, 1) * self.factor
        return np.where(self.owned(counts), p, self.left)

    def within(self, counts: np.ndarray) -> np.ndarray:
        """Probability of a word within its class; all unseen words together are one."""
        rest = self.n_tokens - self.own_tokens + self.n_words - self.own_words + 1
        return np.where(self.owned(counts), 1.0, (counts + 1.0) / rest)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1.0) / (self.n_tokens + self.n_words + 1.0))


def located(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key is in a sorted array, and whether it is."""
    if not len(known):
        return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return at, known[at] == keys


def part_of_pair(known: np.ndarray, keys: np.ndarray, hot: np.ndarray, salts: np.ndarray, parts: int) -> np.ndarray:
    """The part of each pair, given as numbers of a dictionary: that of its context, or if that is hot,
    one of as many as it has ``salts``, picked by the next word."""
    context = (keys >> HALF).astype(np.uint32)
    part = (mix(known) % np.uint64(parts)).astype(np.min_scalar_type(parts))[context]
    at, is_hot = located(hot, known)
    salted = np.flatnonzero(is_hot[context])
    first, second = known[context[salted]], known[keys[salted] & LOW]
    with np.errstate(over="ignore"):
        salt = mix(second) % salts[at[context[salted]]] + np.uint64(1)
        part[salted] = mix(first + salt * GOLDEN) % np.uint64(parts)
    return part


def record(rows: list[tuple], schema: str) -> pa.RecordBatch:
    """A batch of rows in a schema of ``long`` and ``binary`` columns."""
    fields = [f.split() for f in schema.split(", ")]
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    columns = zip(*rows) if rows else [[]] * len(fields)
    return pa.record_batch([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


def discounts(by_count: list[int]) -> np.ndarray:
    """Katz's Good-Turing factor for each count up to ``GOOD_TURING``, then 1. Where the counts of
    counts give none between 0 and 1, as in very small corpora, half a count is taken off."""
    n = [0, *by_count]
    out = np.ones(GOOD_TURING + 2)
    for r in range(1, GOOD_TURING + 1):
        d = 0.0
        if n[1] and n[r]:
            common = (GOOD_TURING + 1) * n[GOOD_TURING + 1] / n[1]
            if common < 1:
                d = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common)
        out[r] = d if 0 < d < 1 else 1 - 0.5 / r
    return out


TEXTS = "piece long, n long, row_nos binary, held_out binary, sizes binary, n_words long, words binary, m long, ids binary"
COUNTS = "part long, n long, keys binary, counts binary"
PAIRS = COUNTS + ", n_contexts long, contexts binary, n_words long, words binary"


def tokenised(source: DataFrame) -> DataFrame:
    """The stored texts of ``ROW, text, held_out``, many in a row: a dictionary of their words, and the
    number of each token in it. What is tokenised stays as it is."""
    if "ids" in source.columns:
        return source

    def read(batches):
        for batch in pieces(batches, "text", PIECE):
            hashes, first = tokens(batch.column("text"))
            words, ids = np.unique(hashes, return_inverse=True)
            row = np.asarray(batch.column(ROW)).astype(np.int64)
            held = np.asarray(pc.fill_null(batch.column("held_out"), True).cast(pa.uint8()))
            sizes = np.diff(first).astype(np.int64)
            yield record([(
                int(row[0]), len(row), pack(row, sort=True), pack(held), pack(sizes),
                len(words), pack(words, sort=True), len(ids), pack(ids.astype(np.uint32)),
            )], TEXTS)

    return cut(source.select(ROW, "text", "held_out").mapInArrow(read, TEXTS), "tokens")


def learned(row: dict) -> np.ndarray:
    """Which tokens of a row of ``TEXTS`` are learned from."""
    held = unpack(row["held_out"], row["n"], np.uint8)
    return np.repeat(held == 0, unpack(row["sizes"], row["n"], np.int64))


def keyed(row: dict, classes: Classes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a row of ``TEXTS``: a dictionary, the pair that each token ends, and where in the dictionary
    each of its words is."""
    words = unpack(row["words"], row["n_words"], np.uint64, sort=True)
    known, at = np.unique(np.append(classes.of(words), START), return_inverse=True)
    at = at.astype(np.uint64)
    own = at[:-1][unpack(row["ids"], row["m"], np.uint32)]
    sizes = unpack(row["sizes"], row["n"], np.int64)
    before = np.empty_like(own)
    before[1:] = own[:-1]
    before[np.cumsum(sizes) - sizes] = at[-1]
    before <<= HALF
    before |= own
    return known, before, at[:-1].astype(np.int64)


def packed_pairs(known: np.ndarray, keys: np.ndarray) -> tuple[tuple, np.ndarray]:
    """Ascending pairs with dictionaries of their own (``keys, n_contexts, contexts, n_words, words``),
    and where in ``known`` these words are."""
    contexts, c = np.unique(keys >> HALF, return_inverse=True)
    words, w = np.unique(keys & LOW, return_inverse=True)
    own = (c.astype(np.uint64) << HALF) | w.astype(np.uint64)
    words = words.astype(np.int64)
    first, second = known[contexts.astype(np.int64)], known[words]
    return (pack(own, sort=True), len(first), pack(first, sort=True), len(second), pack(second, sort=True)), words


def unpacked_pairs(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (
        unpack(row["contexts"], row["n_contexts"], np.uint64, sort=True),
        unpack(row["words"], row["n_words"], np.uint64, sort=True),
        unpack(row["keys"], row["n"], np.uint64, sort=True),
    )


def _merged(rows: DataFrame, label: str) -> DataFrame:
    """The stored table: one row per part, its distinct keys and their counts."""

    def merge(batches):
        held, at = [], None

        def table():
            keys, counts = counted(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
            row = [[at], [len(keys)], [pack(keys, sort=True)], [pack(counts)]]
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            return pa.record_batch([pa.array(c, k) for c, k in zip(row, kinds)], names)

        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != at and held:
                    yield table()
                    held = []
                at = row["part"]
                held.append((
                    unpack(row["keys"], row["n"], np.uint64, sort=True),
                    unpack(row["counts"], row["n"], np.int64),
                ))
        if held:
            yield table()

    names = ["part", "n", "keys", "counts"]
    n = parallelism(rows.sparkSession)
    return cut(rows.repartition(n, "part").sortWithinPartitions("part").mapInArrow(merge, COUNTS), label)


def _word_counts(texts: DataFrame, word_parts: int) -> DataFrame:
    def count(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["ids"], row["m"], np.uint32)[learned(row)]
                words = unpack(row["words"], row["n_words"], np.uint64, sort=True)
                counts = np.bincount(ids, minlength=len(words)).astype(np.int64)
                keys, counts = words[counts > 0], counts[counts > 0]
                rows = blocks(part_of_word(keys, word_parts))
                yield record([(p, b - a, pack(keys[a:b], sort=True), pack(counts[a:b])) for p, a, b in rows], COUNTS)

    return _merged(texts.mapInArrow(count, COUNTS), "unigrams")


def _pair_counts(
    texts: DataFrame, classes: Classes, hot: np.ndarray, salts: np.ndarray, pair_parts: int
) -> DataFrame:
    """The bigram table: a row per part, sorted by context."""

    def count(batches):
        for batch in batches:
            for row in batch.to_pylist():
                known, pairs, _ = keyed(row, classes)
                keys, counts = counted(pairs[learned(row)])
                part = part_of_pair(known, keys, hot, salts, pair_parts)
                order = np.argsort(part, kind="stable")
                keys, counts, part = keys[order], counts[order], part[order]
                for p, a, b in blocks(part):
                    own, *dictionaries = packed_pairs(known, keys[a:b])[0]
                    yield record([(p, b - a, own, pack(counts[a:b]), *dictionaries)], PAIRS)

    def merge(batches):
        held, at = [], None

        def table():
            contexts, words = (np.unique(np.concatenate([h[i] for h in held])) for i in (0, 1))
            edges, cut_up = np.linspace(0, len(contexts), MERGES + 1).astype(np.int64), []
            while held:
                first, second, own, some = held.pop()
                c, w = np.searchsorted(contexts, first), np.searchsorted(words, second).astype(np.uint64)
                ends = np.searchsorted(own, np.searchsorted(c, edges).astype(np.uint64) << HALF)
                cut_up.append((c.astype(np.uint64) << HALF, w, own, some, ends))
            done = []
            for k in range(MERGES):  # a range of contexts at a time, to bound the temporary arrays
                spans = [(c, w, own[e[k] : e[k + 1]], some[e[k] : e[k + 1]]) for c, w, own, some, e in cut_up]
                keys = np.concatenate([c[own >> HALF] | w[own & LOW] for c, w, own, _ in spans])
                done.append(counted(keys, np.concatenate([some for *_, some in spans]).astype(np.int64)))
            del cut_up, spans
            keys, counts = (np.concatenate([d[i] for d in done]) for i in (0, 1))
            del done
            dictionaries = [len(contexts), pack(contexts, sort=True), len(words), pack(words, sort=True)]
            return record([(at, len(keys), pack(keys, sort=True), pack(counts), *dictionaries)], PAIRS)

        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != at and held:
                    yield table()
                    pa.default_memory_pool().release_unused()
                at = row["part"]
                counts = unpack(row["counts"], row["n"], np.int64).astype(np.uint32)  # of one piece of texts
                held.append((*unpacked_pairs(row), counts))
        if held:
            yield table()

    rows = texts.mapInArrow(count, PAIRS)
    n = parallelism(rows.sparkSession)
    return cut(rows.repartition(n, "part").sortWithinPartitions("part").mapInArrow(merge, PAIRS), "bigrams")


def _counts_of(table: DataFrame, asker: str, words: DataFrame, word_parts: int) -> DataFrame:
    """``asker, part, n, counts``: what the unigram table has for the dictionary ``words`` of each row of
    a table, in as many pieces as it has parts of words; in their order they follow the dictionary."""

    def ask(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys = unpack(row["words"], row["n_words"], np.uint64, sort=True)
                rows = blocks(part_of_word(keys, word_parts))
                yield record([(p, 1, row["asker"], b - a, pack(keys[a:b], sort=True), None) for p, a, b in rows], asked)

    def answer(batches):
        at, known, counts = None, np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != at:
                    at, known, counts = row["part"], np.zeros(0, np.uint64), np.zeros(0, np.int64)
                keys = unpack(row["keys"], row["n"], np.uint64, sort=True)
                if row["kind"] == 0:
                    known, counts = keys, unpack(row["counts"], row["n"], np.int64)
                    continue
                place, there = located(known, keys)
                found = np.zeros(len(keys), dtype=np.int64)
                found[there] = counts[place[there]]
                yield record([(row["asker"], at, len(keys), pack(found))], answers)

    asked = "part long, kind long, asker long, n long, keys binary, counts binary"
    answers = "asker long, part long, n long, counts binary"
    given = words.select("part", F.lit(0).cast("long").alias("kind"), F.lit(0).cast("long").alias("asker"), "n", "keys", "counts")
    rows = given.union(table.select(F.col(asker).alias("asker"), "n_words", "words").mapInArrow(ask, asked))
    dealt = rows.repartition(parallelism(table.sparkSession), "part").sortWithinPartitions("part", "kind")
    return dealt.mapInArrow(answer, answers)


def _with_counts(table: DataFrame, asker: str, words: DataFrame, word_parts: int, use, schema: str) -> DataFrame:
    """``use(row, counts)`` of each row of a table and the counts of its dictionary ``words``."""

    def join(batches):
        held, counts = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["__kind"] == 0:
                    if held is not None:
                        yield from use(held, np.concatenate(counts))
                    held, counts = row, []
                else:
                    counts.append(unpack(row["__counts"], row["__n"], np.int64))
        if held is not None:
            yield from use(held, np.concatenate(counts))

    answers = _counts_of(table, asker, words, word_parts).select(
        F.col("asker").alias(asker), F.lit(1).alias("__kind"), F.col("part").alias("__order"),
        F.col("n").alias("__n"), F.col("counts").alias("__counts"),
    )
    rows = table.withColumn("__kind", F.lit(0)).unionByName(answers, allowMissingColumns=True)
    dealt = rows.repartition(parallelism(table.sparkSession), asker).sortWithinPartitions(asker, "__kind", "__order")
    return dealt.mapInArrow(join, schema)


def _count_of_counts(table: DataFrame) -> list[int]:
    """Tokens, distinct keys, and how many keys have count 1, 2, ... of a table."""

    def tally(batches):
        total = np.zeros(3 + GOOD_TURING, dtype=np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                counts = unpack(row["counts"], row["n"], np.int64)
                total[0] += counts.sum()
                total[1] += len(counts)
                total[2:] += np.bincount(np.minimum(counts, GOOD_TURING + 2), minlength=GOOD_TURING + 3)[1:-1]
        yield pa.record_batch([pa.array([v]) for v in total], names)

    names = [f"c{i}" for i in range(3 + GOOD_TURING)]
    sums = table.select("n", "counts").mapInArrow(tally, ", ".join(f"{c} long" for c in names))
    return [v or 0 for v in sums.agg(*[F.sum(c) for c in names]).first()]


@dataclass
class Model:
    classes: Classes
    words: DataFrame  # unigram table, in parts by hash
    pairs: DataFrame  # bigram table, in parts by context
    contexts: DataFrame  # sums of the contexts of each part
    word_parts: int
    pair_parts: int
    discount: np.ndarray
    hot: np.ndarray  # contexts that are dealt to several parts
    salts: np.ndarray  # to how many
    hot_scale: np.ndarray  # what the discounted counts of a context are divided by
    hot_backoff: np.ndarray


def _frequent(words: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Words that occur at least so often, sorted, and their counts."""

    def frequent(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys = unpack(row["keys"], row["n"], np.uint64, sort=True)
                counts = unpack(row["counts"], row["n"], np.int64)
                own = counts >= least
                yield pa.record_batch([pa.array(keys[own].view(np.int64)), pa.array(counts[own])], ["key", "n"])

    own = words.mapInArrow(frequent, "key long, n long").toArrow()
    keys, counts = np.asarray(own["key"]).astype(np.int64).view(np.uint64), np.asarray(own["n"]).astype(np.int64)
    order = np.argsort(keys)
    return keys[order], counts[order]


def fit(source: DataFrame, share: int | None = None, part_tokens: int = PART_TOKENS) -> Model:
    """Count, store and normalise. ``source`` has ``text`` and ``held_out``, or is tokenised; rows held
    out are not learned from. Every word is learned by itself, unless a caller asks for a ``share`` below
    which words are merged; the words above it then come to the driver, else only the hot contexts do, of
    which there are at most two for each part."""
    texts = tokenised(source)
    word_parts = parallelism(source.sparkSession)
    words = _word_counts(texts, word_parts)
    n_tokens, n_words, *by_count = _count_of_counts(words)
    own = _frequent(words, -(-n_tokens // share)) if share is not None else (None, None)
    classes = Classes(n_tokens, n_words, by_count, share, *own)

    least = part_tokens // 2 + 1
    hot, often = _frequent(words, least)
    often = dict(zip(hot.tolist(), often.tolist()))
    if int(END) in often:  # a text begins as often as one ends
        often[int(START)] = often[int(END)]
    if n_tokens - classes.own_tokens >= least:
        often[int(RARE)] = n_tokens - classes.own_tokens
    hot = np.array(sorted(often), dtype=np.uint64)
    salts = np.array([-(-2 * often[h] // part_tokens) for h in sorted(often)], dtype=np.uint64)
    pair_parts = max(1, -(-n_tokens // part_tokens))
    pairs = _pair_counts(texts, classes, hot, salts, pair_parts)
    discount = discounts(_count_of_counts(pairs)[2:])

    def sums_of(row, word_counts):
        keys = unpack(row["keys"], row["n"], np.uint64, sort=True)
        counts = unpack(row["counts"], row["n"], np.int64)
        at = np.searchsorted(keys >> HALF, np.arange(row["n_contexts"], dtype=np.uint64))
        total = np.add.reduceat(counts.astype(np.float64), at)
        mass = np.add.reduceat(discount[np.minimum(counts, GOOD_TURING + 1)] * counts, at)
        del counts
        keys &= LOW
        seen = np.add.reduceat(classes.unigram(word_counts)[keys], at)
        sums = np.concatenate([total, mass, seen])
        yield record([(row["part"], row["n_contexts"], row["contexts"], pack(sums))], kept)

    kept = "part long, n_contexts long, contexts binary, sums binary"
    contexts = cut(_with_counts(pairs, "part", words, word_parts, sums_of, kept), "contexts")

    def of_hot(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys = unpack(row["contexts"], row["n_contexts"], np.uint64, sort=True)
                own = located(hot, keys)[1]
                sums = unpack(row["sums"], 3 * len(keys), np.float64).reshape(3, -1)[:, own]
                yield pa.record_batch([pa.array(keys[own].view(np.int64)), *map(pa.array, sums)], ["context", *names])

    names = ["total", "mass", "seen"]
    sums = contexts.mapInArrow(of_hot, "context long, total double, mass double, seen double").groupBy("context")
    sums = sums.agg(*[F.sum(c).alias(c) for c in names]).toArrow()
    found = np.zeros((3, len(hot)))
    at = np.searchsorted(hot, np.asarray(sums["context"]).astype(np.int64).view(np.uint64))
    for line, name in zip(found, names):
        line[at] = np.asarray(sums[name]).astype(float)
    return Model(classes, words, pairs, contexts, word_parts, pair_parts, discount, hot, salts, *normalised(*found))


def normalised(total: np.ndarray, mass: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per context: the divisor of its discounted counts, and the backoff weight.

    ``total`` counts its tokens, ``mass`` is their discounted sum, ``seen`` the unigram probability
    of the classes seen after it. Discounted shares and backoff sum to one. A context whose counts
    are all too large to be discounted is divided by one more; one that was followed by every class
    needs no backoff, one never seen backs off entirely.
    """
    unseen = 1 - seen
    never, every = total <= 0, (total > 0) & (unseen < 1e-9)
    scale = np.where(total - mass > 1e-9 * np.maximum(total, 1), total, total + 1)
    scale = np.where(every, mass, np.where(never, 1, scale))
    left = np.where(never, 1.0, 1 - mass / scale)
    return scale, np.where(every, 0.0, left / np.where(every | never, 1.0, unseen))


LOOKED = (
    "part long, kind long, piece long, n long, keys binary, counts binary, n_contexts long, contexts binary, "
    "n_words long, words binary, word_counts binary, m long, texts binary, n_rows long, row_nos binary, sums binary"
)


def _keys_of_texts(texts: DataFrame, model: Model) -> DataFrame:
    """What has to be looked up: blocks of distinct pairs with the texts each occurs in and the counts of
    their words; and, as kind 3, the sums per text that these counts give by themselves."""
    classes, hot, salts, pair_parts = model.classes, model.hot, model.salts, model.pair_parts

    def read(row, counts):
        known, pairs, at = keyed(row, classes)
        sizes = unpack(row["sizes"], row["n"], np.int64)
        text = np.repeat(np.arange(row["n"], dtype=np.uint32), sizes)
        ids = unpack(row["ids"], row["m"], np.uint32)
        place, n = row["piece"], row["n"]
        sums = [sizes.astype(np.float64)]
        for x in ((counts > 0).astype(np.float64), classes.base(counts), np.log10(classes.within(counts))):
            sums.append(np.bincount(text, x[ids], n))
        blank = [None] * 10
        yield record([(place % pair_parts, 3, place, *blank, n, row["row_nos"], pack(np.concatenate(sums)))], LOOKED)
        of_class = np.zeros(len(known), dtype=np.int64)
        own = classes.owned(counts)
        of_class[at[own]] = counts[own]
        del ids
        order = np.argsort(pairs)
        keys, text = pairs[order], text[order]
        del pairs, order
        head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
        size, keys = np.diff(head, append=len(keys)), keys[head]
        part = part_of_pair(known, keys, hot, salts, pair_parts)
        by_part = np.argsort(part, kind="stable")
        head, size, keys, part = head[by_part], size[by_part], keys[by_part], part[by_part]
        for p, a, b in blocks(part):
            own = text[np.repeat(head[a:b], size[a:b]) + _inside(size[a:b])]
            (packed, *dictionaries), words = packed_pairs(known, keys[a:b])
            yield record([(
                p, 2, place, b - a, packed, pack(size[a:b].astype(np.uint32)), *dictionaries,
                pack(of_class[words]), len(own), pack(own), n, row["row_nos"], None,
            )], LOOKED)

    return _with_counts(texts, "piece", model.words, model.word_parts, read, LOOKED)


def _inside(size: np.ndarray) -> np.ndarray:
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)


def score_rows(source: DataFrame, model: Model) -> DataFrame:
    """``ROW, n_tokens, n_known, base_score, score`` of every text.

    Each token is scored where the part of the table that its context is in lies: by the discounted
    count if the pair was seen, else by the backoff weight and the unigram of its word, whose count
    came along. The sums per text of a piece of texts travel together, and are added up.
    """
    classes, discount = model.classes, model.discount
    hot, hot_scale, hot_backoff = model.hot, model.hot_scale, model.hot_backoff

    def look(batches):
        at, none = None, np.zeros(0, np.uint64)
        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != at:
                    at, contexts, words, known, counts = row["part"], none, none, none, none
                    pa.default_memory_pool().release_unused()
                    scale, backoff = np.ones(0), np.ones(0)
                if row["kind"] == 0:
                    contexts, words, known = unpacked_pairs(row)
                    counts = unpack(row["counts"], row["n"], np.int64)
                    continue
                if row["kind"] == 1:
                    scale, backoff = normalised(*unpack(row["sums"], 3 * row["n_contexts"], np.float64).reshape(3, -1))
                    continue
                if row["kind"] == 3:
                    yield record([(row["piece"], row["n_rows"], row["row_nos"], row["sums"])], kept)
                    continue
                first, second, keys = unpacked_pairs(row)
                context, word = (keys >> HALF).astype(np.int64), (keys & LOW).astype(np.int64)
                c, c_there = located(contexts, first)
                w, w_there = located(words, second)
                divisor, weight = np.ones(len(first)), np.ones(len(first))
                divisor[c_there], weight[c_there] = scale[c[c_there]], backoff[c[c_there]]
                h, h_there = located(hot, first)
                divisor[h_there], weight[h_there] = hot_scale[h[h_there]], hot_backoff[h[h_there]]
                pair = (c.astype(np.uint64) << HALF)[context] | w.astype(np.uint64)[word]
                place, there = located(known, pair)
                there &= c_there[context] & w_there[word]
                found = np.zeros(len(keys), dtype=np.int64)
                found[there] = counts[place[there]]
                unigram = classes.unigram(unpack(row["word_counts"], row["n_words"], np.int64))
                direct = discount[np.minimum(found, GOOD_TURING + 1)] * found / divisor[context]
                p = np.where(found > 0, direct, weight[context] * unigram[word])
                with np.errstate(divide="ignore"):
                    logs = np.log10(p)
                size = unpack(row["counts"], row["n"], np.uint32)
                text = unpack(row["texts"], row["m"], np.uint32)
                sums = np.zeros((4, row["n_rows"]))
                sums[3] = np.bincount(text, np.repeat(logs, size), row["n_rows"])
                yield record([(row["piece"], row["n_rows"], row["row_nos"], pack(sums.ravel()))], kept)

    def add(batches):
        held, sums, at = None, None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["piece"] != at:
                    if held is not None:
                        yield rows_of(held, sums)
                    at, held, sums = row["piece"], unpack(row["row_nos"], row["n"], np.int64, sort=True), 0.0
                sums = sums + unpack(row["sums"], 4 * row["n"], np.float64)
        if held is not None:
            yield rows_of(held, sums)

    def rows_of(number, sums):
        sums = sums.reshape(4, -1)
        whole = [pa.array(np.rint(x).astype(np.int64)) for x in sums[:2]]
        return pa.record_batch([pa.array(number), *whole, *map(pa.array, sums[2:])], names)

    kept = "piece long, n long, row_nos binary, sums binary"
    names = [ROW, "n_tokens", "n_known", "base_score", "score"]
    pairs = model.pairs.withColumn("kind", F.lit(0).cast("long"))
    tables = pairs.unionByName(model.contexts.withColumn("kind", F.lit(1).cast("long")), allowMissingColumns=True)
    texts, n = tokenised(source), parallelism(source.sparkSession)
    scored = None
    for portion in range(PORTIONS):
        some = texts.filter(F.pmod(F.xxhash64("piece"), F.lit(PORTIONS)) == portion)
        rows = tables.unionByName(_keys_of_texts(some, model), allowMissingColumns=True)
        parts = rows.repartition(n, "part").sortWithinPartitions("part", "kind").mapInArrow(look, kept)
        by_piece = parts.repartition(n, "piece").sortWithinPartitions("piece")
        schema = f"{ROW} long, n_tokens long, n_known long, base_score double, score double"
        done = cut(by_piece.mapInArrow(add, schema), "scores")
        scored = done if scored is None else scored.union(done)
    return scored


def log_probabilities(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score``.

    The model learns from rows whose ``crc32(id) mod 7`` is not 2 and scores all rows. Words are
    compared after lower-casing A-Z; null and empty texts have the end as their one token. Repeated
    rows count and are scored as often as they occur. If there is nothing to learn from, every text
    is one of unseen words, and its score that of their class.
    """
    held_out = (crc_rest(F.col(id_col), 7) == 2).alias("held_out")
    with recording() as made:
        source = numbered(df, F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), held_out)
    texts = tokenised(source)
    rows = source.select(ROW, "doc_id", "held_out")
    if made:  # the texts are not read again
        rows = cut(rows, "rows")
        drop(df.sparkSession, made)
    model = fit(texts)
    sums = score_rows(texts, model)
    return rows.join(sums, ROW).select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(model.classes.n_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
