"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded, a gated attention network, learned from
document labels alone, weighs the passages, and the weighted sum is scored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.stage import apart, crc_rest, sampled
from daybook.llm.text import Words, pieces

#: Words in a passage; the last passage of a text is shorter, an empty text has one empty passage.
PASSAGE = 64
#: The model is fitted on at most so many labelled documents, those of least hash, and at most so many
#: passages of each, evenly spaced.
SAMPLE = 3000
SAMPLE_PASSAGES = 128

HIDDEN, GATE = 24, 12
BUCKETS = 32

#: Classes of bytes whose shares describe a passage.
CLASSES = [
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"abcdefghijklmnopqrstuvwxyz",
    b"0123456789",
    b".,;:?'\"()-",
    b"!",
    b"#$%&*@^~+=<>/\\_{}[]`",
    b"|",
    b"\n\r",
    b" \t",
    bytes(range(128, 256)),
]
CLASS_OF = np.full(256, len(CLASSES), dtype=np.uint8)
for number, members in enumerate(CLASSES):
    CLASS_OF[list(members)] = number
N_FEATURES = len(CLASSES) + 8 + BUCKETS


def passages(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage, and how many passages each text has."""
    words = Words(column)
    counts = words.counts
    bags = np.maximum(1, -(-counts // PASSAGE))
    total = int(bags.sum())
    text = np.repeat(np.arange(len(counts)), bags)
    first_bag = np.cumsum(bags) - bags
    inside = np.arange(total) - first_bag[text]
    word_lo = words.first[:-1][text] + inside * PASSAGE
    word_hi = np.minimum(word_lo + PASSAGE, words.first[1:][text])
    n_words = word_hi - word_lo
    starts = np.append(words.start, len(words.data))
    byte_lo = np.where(inside == 0, words.offsets[:-1][text], starts[np.minimum(word_lo, len(starts) - 1)])
    byte_hi = np.append(byte_lo[1:], len(words.data))
    n_bytes = byte_hi - byte_lo

    out = np.zeros((total, N_FEATURES), dtype=np.float32)
    part = np.repeat(np.arange(total), n_bytes)
    kinds = len(CLASSES) + 1
    seen = np.bincount(part * kinds + CLASS_OF[words.data], minlength=total * kinds)
    out[:, : len(CLASSES)] = seen.reshape(total, kinds)[:, :-1] / np.maximum(n_bytes, 1)[:, None]
    column_no = len(CLASSES)
    if len(words.start):
        per = np.maximum(n_words, 1)
        of = np.repeat(np.arange(total), n_words)
        length = (words.end - words.start).astype(np.float64)
        mean = np.bincount(of, length, total) / per
        square = np.bincount(of, length * length, total) / per
        hashes = words.hashes()
        big = (words.data[words.start] >= 65) & (words.data[words.start] <= 90)
        last = words.data[words.end - 1]
        key = (of.astype(np.uint64) << np.uint64(32)) | (hashes >> np.uint64(32))
        key.sort()
        fresh = np.ones(len(key), dtype=bool)
        fresh[1:] = key[1:] != key[:-1]
        distinct = np.bincount((key[fresh] >> np.uint64(32)).astype(np.int64), minlength=total)
        same = np.zeros(len(of))
        same[1:] = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
        bucket = (hashes % np.uint64(BUCKETS)).astype(np.int64)
        sign = np.where(hashes >> np.uint64(63), 1.0, -1.0)
        rows = [
            mean / 10,
            np.sqrt(np.maximum(square - mean * mean, 0)) / 10,
            distinct / per,
            np.bincount(of, same, total) / per,
            np.bincount(of, big, total) / per,
            np.bincount(of, last == 33, total) / per,
            np.bincount(of, CLASS_OF[last] == 5, total) / per,
        ]
        for row in rows:
            out[:, column_no] = row
            column_no += 1
        out[:, column_no] = np.log1p(n_words) / np.log1p(PASSAGE)
        hashed = np.bincount(of * BUCKETS + bucket, sign, total * BUCKETS).reshape(total, BUCKETS)
        out[:, column_no + 1 :] = hashed / np.sqrt(per)[:, None]
    return out, bags


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, bags: np.ndarray) -> dict[str, np.ndarray]:
        """``x``: standardised passages, bag after bag."""
        w, first = self.weights, np.cumsum(bags) - bags
        h = np.tanh(x @ w["encode"] + w["encode0"])
        t, g = np.tanh(h @ w["value"]), _sigmoid(h @ w["gate"])
        e = (t * g) @ w["attend"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, first), bags))
        a = e / np.repeat(np.add.reduceat(e, first), bags)
        z = np.add.reduceat(a[:, None] * h, first)
        return {"h": h, "t": t, "g": g, "a": a, "z": z, "p": _sigmoid(z @ w["out"] + w["out0"])}

    def score(self, column: pa.Array) -> np.ndarray:
        x, bags = passages(column)
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        return self.forward(x, bags)["p"].astype(np.float64)


def gradients(model: Model, x, bags, y) -> dict[str, np.ndarray]:
    """Of the mean log loss, by backpropagation through attention and encoder."""
    w, f, first = model.weights, model.forward(x, bags), np.cumsum(bags) - bags
    d_out = (f["p"] - y) / len(y)
    d_z = np.repeat(d_out[:, None] * w["out"], bags, axis=0)
    d_a = (d_z * f["h"]).sum(1)
    d_e = f["a"] * (d_a - np.repeat(np.add.reduceat(f["a"] * d_a, first), bags))
    d_tg = d_e[:, None] * w["attend"]
    d_t = d_tg * f["g"] * (1 - f["t"] ** 2)
    d_g = d_tg * f["t"] * f["g"] * (1 - f["g"])
    d_h = f["a"][:, None] * d_z + d_t @ w["value"].T + d_g @ w["gate"].T
    d_x = d_h * (1 - f["h"] ** 2)
    return {
        "encode": x.T @ d_x,
        "encode0": d_x.sum(0),
        "value": f["h"].T @ d_t,
        "gate": f["h"].T @ d_g,
        "attend": (f["t"] * f["g"]).T @ d_e,
        "out": f["z"].T @ d_out,
        "out0": d_out.sum(keepdims=True),
    }


def train(x, bags, y, epochs: int = 60, batch: int = 128, rate: float = 0.005, decay: float = 1e-4) -> Model:
    """Adam on minibatches of documents, in an order fixed by a seed."""
    rng = np.random.default_rng(7)
    mean, scale = x.mean(0), x.std(0) + 0.02
    x = np.clip((x - mean) / scale, -8, 8).astype(np.float64)

    def some(*shape):
        return rng.normal(0, 1 / np.sqrt(shape[0]), shape)

    share = np.clip(y.mean(), 0.02, 0.98)
    weights = {
        "encode": some(N_FEATURES, HIDDEN),
        "encode0": np.zeros(HIDDEN),
        "value": some(HIDDEN, GATE),
        "gate": some(HIDDEN, GATE),
        "attend": some(GATE),
        "out": some(HIDDEN),
        "out0": np.array([np.log(share / (1 - share))]),
    }
    model = Model(mean, scale, weights)
    first = np.cumsum(bags) - bags
    moment = {k: np.zeros_like(v) for k, v in weights.items()}
    energy = {k: np.zeros_like(v) for k, v in weights.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for lo in range(0, len(order), batch):
            chosen = order[lo : lo + batch]
            size = bags[chosen]
            rows = np.repeat(first[chosen] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            step += 1
            for k, g in gradients(model, x[rows], size, y[chosen]).items():
                g = g + decay * weights[k] * (k in ("encode", "out"))
                moment[k] = 0.9 * moment[k] + 0.1 * g
                energy[k] = 0.999 * energy[k] + 0.001 * g * g
                fixed = moment[k] / (1 - 0.9**step)
                weights[k] -= rate * fixed / (np.sqrt(energy[k] / (1 - 0.999**step)) + 1e-8)
    return model


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = SAMPLE,
    most_passages: int = SAMPLE_PASSAGES,
) -> Model | None:
    """Learn from the labelled documents that are not held out (``crc32(id) mod 3 = 1``).

    At most ``sample`` of those in ``docs`` are used, the same ones in every run, of any length; the
    labels of the sample, so few rows that they are broadcast, pick them from ``docs``, and of rows with
    one identifier the text of least hash stands for all. Only features of passages reach the driver,
    ``most_passages`` of a document. Null labels and identifiers are no labels; a document labelled both
    ways counts as what most of its labels say, ties as 1. ``None`` if nothing is labelled.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label"))
    known = known.dropna().filter(crc_rest(F.col("id"), 3) != 1)
    known = known.groupBy("id").agg(F.round(F.avg("label")).alias("label"))
    known = sampled(known.join(texts.select("id"), "id", "left_semi"), sample, F.col("id"))
    rows = texts.join(F.broadcast(known), "id").groupBy("id", "label")
    rows = rows.agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one"))
    rows = rows.select("id", "label", "one.text")

    def encode(batches):
        for batch in pieces(batches, "text"):
            x, bags = passages(batch.column("text"))
            blobs = []
            for end, n in zip(np.cumsum(bags), bags):
                some = np.arange(n) if n <= most_passages else np.arange(most_passages) * n // most_passages
                blobs.append(x[end - n + some].tobytes())
            yield pa.record_batch(
                [batch.column("id"), batch.column("label"), pa.array(blobs, pa.binary())], ["id", "label", "x"]
            )

    schema = T.StructType([rows.schema["id"], rows.schema["label"], T.StructField("x", T.BinaryType())])
    found = rows.select("id", "label", "text").mapInArrow(encode, schema).collect()
    if not found:
        return None
    found.sort(key=lambda r: (str(r.id), r.x))
    bags = [np.frombuffer(r.x, np.float32).reshape(-1, N_FEATURES) for r in found]
    return train(np.concatenate(bags), np.array([len(b) for b in bags]), np.array([r.label for r in found]))


def with_score(df: DataFrame, model: Model | None, text_col: str = "text", out: str = "score") -> DataFrame:
    """``df`` with the probability of label 1 as column ``out``; 0.5 without a model. Null counts
    as the empty text, which is scored too. ``out`` must not be a column of ``df``."""
    if out in df.columns:
        raise ValueError(f"column {out} exists")
    text_no = df.columns.index(text_col)

    def score(batches):
        for batch in pieces(batches, text_no):
            p = np.full(batch.num_rows, 0.5) if model is None else model.score(batch.column(text_no))
            yield pa.record_batch([*batch.columns, pa.array(p)], [*batch.schema.names, out])

    return df.mapInArrow(score, T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType())]))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    model = fit(docs, labels)
    scored = with_score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        (crc_rest(F.col("doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are predicted good, with all their columns."""
    own, (text,), back = apart(docs, "text")
    return with_score(own, fit(docs, labels), text).filter(F.col("score") >= 0.5).select(back)
