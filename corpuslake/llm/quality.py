"""Document quality by attention over passages, learned from document labels.

A document is a bag of passages of 1,024 bytes. Each is encoded by shares of byte
classes and hashed byte pairs, and by its words' lengths and repetition. Gated attention
weighs the passages, and a logistic unit scores the weighted mean. Only documents are
labelled, so the attention learns from them which passages tell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslake.llm.common import slices, table

PASSAGE = 1024
PAIRS = 48
GATE = 16
#: The model is fitted on at most so many labelled documents, those with the smallest hashes.
MAX_SAMPLE = 8_000
EPOCHS, BATCH, RATE = 60, 64, 0.01
THRESHOLD = 0.3
#: Texts are encoded in runs of about so many bytes; an array of 8 bytes for each is one of ten that are held.
RUN_BYTES = 1_000_000

_CLASSES = np.full(256, 9, np.uint8)  # 9: any other mark
for _members, _class in ((range(97, 123), 0), (range(65, 91), 1), (range(48, 58), 2), (b" ", 3), (b"\n", 4), (b".,;:", 5), (b"!?", 6), (b"\"'()", 7), (range(128, 256), 8), (range(0, 9), 10)):
    for _byte in _members:
        _CLASSES[_byte] = _class
N_CLASSES = 11
FEATURES = N_CLASSES + 5 + PAIRS
_POWERS = np.random.default_rng(7).integers(1, 2**63, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all passages and the first row of each text; an empty text has one row of zeros.

    A row depends on its own text only, whatever other texts are encoded with it.
    """
    lengths = np.array([len(t) for t in texts], np.int64)
    counts = np.maximum(1, -(-lengths // PASSAGE))
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    data = np.frombuffer(b"".join(texts), np.uint8)
    out = np.zeros((int(counts.sum()), FEATURES), np.float32)
    if not len(data):
        return out, first
    begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    inside = np.arange(len(data)) - np.repeat(begin, lengths)
    passage = np.repeat(first, lengths) + inside // PASSAGE
    rows = len(out)
    filled = np.bincount(passage, minlength=rows)
    size = np.maximum(1, filled)[:, None]
    classes = _CLASSES[data]
    out[:, :N_CLASSES] = np.bincount(passage * N_CLASSES + classes, minlength=rows * N_CLASSES).reshape(rows, -1) / size
    pair = (data[:-1].astype(np.uint32) * 31 + data[1:].astype(np.uint32) * 2654435) % PAIRS
    own = inside[1:] > 0  # both bytes of the pair are of one text
    out[:, N_CLASSES + 5 :] = np.bincount(passage[:-1][own] * PAIRS + pair[own], minlength=rows * PAIRS).reshape(rows, -1) / size
    blank = (classes == 3) | (classes == 4) | (inside == 0) & (classes == 10)
    starts = np.flatnonzero(~blank & ((inside == 0) | np.concatenate([[True], blank[:-1]])))
    if len(starts):
        place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data)))) if starts[0] == 0 else None
        if place is None:
            place = np.arange(len(data)) - np.concatenate([np.zeros(starts[0], np.int64), np.repeat(starts, np.diff(np.append(starts, len(data))))])
        letters = np.where(blank, np.uint64(0), data.astype(np.uint64) + np.uint64(1)) * _POWERS[place & 63]
        words = np.add.reduceat(letters, starts)
        long = np.add.reduceat((~blank).astype(np.int32), starts)
        of = passage[starts]
        n = np.maximum(1, np.bincount(of, minlength=rows))
        out[:, N_CLASSES] = np.bincount(of, long, minlength=rows) / n / 10
        key = words ^ (of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, one = np.unique(key, return_index=True)
        out[:, N_CLASSES + 1] = np.bincount(of[one], minlength=rows) / n
        same = (words[1:] == words[:-1]) & (of[1:] == of[:-1])
        out[:, N_CLASSES + 2] = np.bincount(of[1:][same], minlength=rows) / n
        out[:, N_CLASSES + 3] = np.bincount(of, long > 15, minlength=rows) / n
    out[:, N_CLASSES + 4] = filled / PASSAGE
    return out, first


class Attention:
    """Gated attention pooling with a logistic unit, trained by Adam on whole documents."""

    def __init__(self, seed: int = 11):
        random = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(FEATURES, np.float32), np.ones(FEATURES, np.float32)
        self.p = {
            "V": random.normal(0, 0.1, (FEATURES, GATE)), "U": random.normal(0, 0.1, (FEATURES, GATE)),
            "w": random.normal(0, 0.1, GATE), "c": np.zeros(FEATURES), "b": np.zeros(1),
        }

    def forward(self, x: np.ndarray, first: np.ndarray) -> tuple:
        x = np.clip((x - self.mean) / self.scale, -6, 6)
        t, g = np.tanh(x @ self.p["V"]), 1 / (1 + np.exp(-(x @ self.p["U"])))
        e = (t * g) @ self.p["w"]
        counts = np.diff(np.append(first, len(x)))
        weight = np.exp(e - np.repeat(np.maximum.reduceat(e, first), counts))
        weight /= np.repeat(np.add.reduceat(weight, first), counts)
        z = np.add.reduceat(weight[:, None] * x, first)
        logit = np.clip(z @ self.p["c"] + self.p["b"][0], -30, 30)
        return x, t, g, weight, counts, z, 1 / (1 + np.exp(-logit))

    def score(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        """One text at a time: products over more rows may be rounded otherwise, and a score is to follow from its text."""
        alone, ends = np.zeros(1, np.int64), np.append(first[1:], len(x))
        return np.array([self.forward(x[a:b], alone)[-1][0] for a, b in zip(first, ends, strict=True)], np.float64)

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 5) -> Attention:
        """Log loss with a small weight decay; with no bags every score is a half, with one label its share."""
        if not len(bags):
            return self
        share = (labels.sum() + 0.5) / (len(labels) + 1)
        self.p["b"][0] = np.log(share / (1 - share))
        every = np.concatenate(bags)
        self.mean, self.scale = every.mean(0), every.std(0) + 1e-4
        if labels.min() == labels.max():
            return self
        random, step = np.random.default_rng(seed), 0
        m, v = ({k: np.zeros_like(a) for k, a in self.p.items()} for _ in range(2))
        for _ in range(epochs):
            order = random.permutation(len(bags))
            for at in range(0, len(order), BATCH):
                chosen = order[at : at + BATCH]
                bag = [bags[i] for i in chosen]
                first = np.concatenate([[0], np.cumsum([len(b) for b in bag])[:-1]])
                x, t, g, a, counts, z, s = self.forward(np.concatenate(bag), first)
                d = (s - labels[chosen]) / len(chosen)
                dz = np.repeat(d[:, None] * self.p["c"], counts, axis=0)
                da = (dz * x).sum(1)
                de = a * (da - np.repeat(np.add.reduceat(a * da, first), counts))
                dh = de[:, None] * self.p["w"]
                grads = {
                    "V": x.T @ (dh * g * (1 - t * t)), "U": x.T @ (dh * t * g * (1 - g)), "w": (t * g).T @ de,
                    "c": z.T @ d + 1e-4 * self.p["c"], "b": np.array([d.sum()]),
                }
                step += 1
                for k, grad in grads.items():
                    m[k] = 0.9 * m[k] + 0.1 * grad
                    v[k] = 0.999 * v[k] + 0.001 * grad * grad
                    self.p[k] -= RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return self


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", max_sample: int = MAX_SAMPLE) -> Attention:
    """A model fitted on a sample of labelled documents that aren't held out.

    Labels other than 0 and 1, null ids and held-out ids are passed over. An id with
    several labels counts by the largest. The sample are the ``max_sample`` ids with the
    smallest hashes; its passages, some megabytes, are encoded by Spark and fitted on
    the driver.
    """
    usable = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~held_out(F.col(key)))
    chosen = (
        usable.groupBy(F.col(key).alias("id")).agg(F.max(label).cast("int").alias("y"))
        .orderBy(F.xxhash64("id"), "id").limit(max_sample)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, size=RUN_BYTES):
            x, first = encode(texts)
            ends = np.append(first[1:], len(x))
            rows = [x[a:b].tobytes() for a, b in zip(first, ends, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("y"), pa.array(rows, pa.binary())], ["id", "y", "x"])

    body = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")
    kind = body.schema["id"].dataType.simpleString()
    rows = body.select("id", "y", "text").mapInArrow(run, f"id {kind}, y int, x binary").collect()
    rows.sort(key=lambda r: (r["id"], r["x"]))
    bags = [np.frombuffer(r["x"], np.float32).reshape(-1, FEATURES) for r in rows]
    return Attention().fit(bags, np.array([r["y"] for r in rows], np.float64))


def score_quality(docs: DataFrame, model: Attention, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, the model's probability that a document is good.

    Whole texts are scored, passage by passage; a null text counts as empty and an empty
    one is a single passage of zeros. Nothing but the text is read. Every row stays,
    repeated ones too, with all columns; a column named score is replaced. No shuffle.
    """
    plain = docs.drop("score")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, text, RUN_BYTES):
            score = shared.value.score(*encode(texts))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score)], [*part.schema.names, "score"])

    return plain.mapInArrow(run, plain.select("*", F.lit(0.0).alias("score")).schema)


def op5_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
