"""Language identification by sparse multinomial logistic regression.

A text is its TF-IDF weighted character n-grams, hashed. Weights are learned one
document at a time by the follow-the-regularised-leader rule, whose elastic-net
penalty leaves most of them exactly zero, and a temperature, fitted on documents that
the weights haven't seen, turns the scores into calibrated probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslake.llm.common import slices, table

ORDERS = (1, 2, 3)
BITS = 16
BUCKETS = 1 << BITS
#: The weights are fitted on at most so many documents, dealt evenly to the languages.
MAX_SAMPLE = 6_000
#: One sampled document in so many is kept for the temperature.
CALIBRATED = 5
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
UNDETERMINED = "und"
#: Characters are hashed in runs of so many, so that memory beside a text stays bounded.
RUN = 1 << 20

_PLACES = np.random.default_rng(1918).integers(1, 2**31, size=(len(ORDERS), max(ORDERS)), dtype=np.uint32) * np.uint32(2) + np.uint32(1)


class Letters(dict):
    """Whether a code point is a letter, looked up once; the first 65,536 are a table."""

    def __init__(self):
        super().__init__()
        self.plain = np.fromiter((chr(c).isalpha() for c in range(0x10000)), bool, 0x10000)

    def __missing__(self, code: int) -> bool:
        found = self[code] = chr(code).isalpha()
        return found

    def mask(self, codes: np.ndarray) -> np.ndarray:
        high = codes >= 0x10000
        out = self.plain[np.where(high, 0, codes)]
        if high.any():
            out[high] = [self[c] for c in codes[high].tolist()]
        return out


def letters_only(text: str, known: Letters) -> np.ndarray:
    """Code points of the lower-cased letters, every run of other characters as one blank, one at each end."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = known.mask(codes)
    if not letter.any():
        return np.empty(0, np.uint32)
    first_blank = ~letter & np.concatenate([[True], letter[:-1]])
    kept = np.where(letter, codes, np.uint32(32))[letter | first_blank]
    if kept[0] != 32:
        kept = np.concatenate([np.array([32], np.uint32), kept])
    return kept if kept[-1] == 32 else np.concatenate([kept, np.array([32], np.uint32)])


def grams(text: str, known: Letters) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's n-grams, ascending, and how often each occurs; none without letters."""
    codes = letters_only(text, known)
    total = np.zeros(BUCKETS, np.int64)
    for row, order in enumerate(ORDERS):
        for at in range(0, len(codes) - order + 1, RUN):
            part = codes[at : at + RUN + order - 1]
            n = len(part) - order + 1
            value = part[:n] * _PLACES[row, 0]
            for place in range(1, order):
                value += part[place : place + n] * _PLACES[row, place]
            value ^= value >> np.uint32(15)
            value *= np.uint32(0x2C1B3C6D)
            total += np.bincount(value >> np.uint32(32 - BITS), minlength=BUCKETS)
    bucket = np.flatnonzero(total)
    return bucket, total[bucket]


def weighted(bucket: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF of a text's buckets, of length one: (1 + ln count) * idf."""
    value = (1 + np.log(count)) * idf[bucket]
    norm = np.sqrt((value * value).sum())
    return value / norm if norm else value


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


class Leader:
    """Follow-the-regularised-leader for a row of class weights per bucket; the last row is the bias, which has no penalty."""

    def __init__(self, classes: int):
        self.z = np.zeros((BUCKETS + 1, classes))
        self.n = np.zeros((BUCKETS + 1, classes))

    def weights(self, rows: np.ndarray) -> np.ndarray:
        z, n = self.z[rows], self.n[rows]
        l1 = np.where(rows == BUCKETS, 0.0, L1)[:, None]
        kept = np.sign(z) * np.maximum(np.abs(z) - l1, 0)
        return -kept / ((BETA + np.sqrt(n)) / ALPHA + np.where(rows == BUCKETS, 0.0, L2)[:, None])

    def learn(self, rows: np.ndarray, values: np.ndarray, truth: int) -> None:
        w = self.weights(rows)
        d = softmax(values @ w)
        d[truth] -= 1
        g = values[:, None] * d
        n = self.n[rows]
        more = n + g * g
        self.z[rows] += g - (np.sqrt(more) - np.sqrt(n)) / ALPHA * w
        self.n[rows] = more


def fitted_temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """The temperature of least log loss, between a twentieth and 20, by golden sections; one without documents."""
    if not len(truth):
        return 1.0

    def loss(log_t: float) -> float:
        scaled = logits / np.exp(log_t)
        top = scaled.max(1)
        return float((np.log(np.exp(scaled - top[:, None]).sum(1)) + top - scaled[np.arange(len(truth)), truth]).mean())

    low, high, part = -np.log(20), np.log(20), (np.sqrt(5) - 1) / 2
    a, b = high - part * (high - low), low + part * (high - low)
    at_a, at_b = loss(a), loss(b)
    while high - low > 1e-4:
        if at_a <= at_b:
            high, b, at_b = b, a, at_a
            a = high - part * (high - low)
            at_a = loss(a)
        else:
            low, a, at_a = a, b, at_b
            b = low + part * (high - low)
            at_b = loss(b)
    return float(np.exp((low + high) / 2))


@dataclass
class LanguageModel:
    """Languages in ascending order, inverse document frequencies, the weights that aren't zero, and the temperature."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float = 1.0
    known: Letters = field(default_factory=Letters)

    def logits(self, bucket: np.ndarray, count: np.ndarray) -> np.ndarray:
        return weighted(bucket, count, self.idf) @ self.weights[bucket] + self.weights[BUCKETS]

    def predict(self, text: str | None) -> tuple[str, float]:
        bucket, count = grams(text or "", self.known)
        if not len(bucket) or not self.languages:
            return UNDETERMINED, 0.0
        p = softmax(self.logits(bucket, count) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of all texts with letters each bucket occurs, and how many these are; a task sends a number per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen, n = Letters(), np.zeros(BUCKETS + 1, np.int64), 0
        for _, part in slices(batches):
            for text in part:
                bucket, _ = grams(text.decode(), known)
                seen[bucket] += 1
                n += len(bucket) > 0
        seen[BUCKETS] = n
        there = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(seen[there])], ["bucket", "n"])

    sums = texts.select("text").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(BUCKETS + 1, np.int64)
    out[sums["bucket"].to_numpy(np.int64)] = sums["n"].to_numpy(np.int64)
    return out[:BUCKETS], int(out[BUCKETS])


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", max_sample: int = MAX_SAMPLE) -> LanguageModel:
    """A model of the rows that have an id, a text and a label and aren't held out.

    Document frequencies are counted over all of them. The weights are fitted on the
    driver on a sample: of each of L languages the ``max_sample / L`` documents (one at
    least) with the smallest hashes, as n-gram counts of whole texts. Rows with equal id,
    label and text are learned from once. Without such rows the model knows no language.
    """
    usable = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.col(label).cast("string").alias("label")).filter(
        F.col("id").isNotNull() & F.col("text").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("id"))
    )
    rows_of = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    languages = sorted(rows_of)
    if not languages:
        return LanguageModel([], np.zeros(BUCKETS), np.zeros((BUCKETS + 1, 0)))
    frequency, n_docs = document_frequencies(usable)
    idf = np.log((1 + n_docs) / (1 + frequency)) + 1

    # Only hashes so small that a few times the share is left are ranked, so no task ranks a language's rows.
    share = max(1, max_sample // len(languages))
    chance = F.element_at(F.create_map(*[F.lit(x) for name, n in rows_of.items() for x in (name, min(1.0, (3 * share + 100) / n))]), F.col("label"))
    small = usable.withColumn("hash", F.xxhash64("id")).filter((F.col("hash") / 2.0**64 + 0.5) <= chance)
    keys = small.select("id", "label", "hash", F.xxhash64("text").alias("digest")).distinct()
    place = F.row_number().over(Window.partitionBy("label").orderBy("hash", "id", "digest"))
    chosen = keys.withColumn("place", place).filter(F.col("place") <= share).select("id", "label", "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Letters()
        for part, texts in slices(batches):
            found = [grams(t.decode(), known) for t in texts]
            rows = [pa.array([f(x).tobytes() for x in found], pa.binary()) for f in (lambda x: x[0].astype(np.uint16), lambda x: x[1].astype(np.uint32))]
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("label"), *rows], ["id", "label", "bucket", "count"])

    body = usable.withColumn("digest", F.xxhash64("text")).join(F.broadcast(chosen), ["id", "label", "digest"]).select("id", "label", "text")
    kind = body.schema["id"].dataType.simpleString()
    rows = body.mapInArrow(run, f"id {kind}, label string, bucket binary, count binary").distinct().collect()
    rows.sort(key=lambda r: (r["id"], r["label"], r["bucket"], r["count"]))
    sample = [(np.frombuffer(r["bucket"], np.uint16).astype(np.int64), np.frombuffer(r["count"], np.uint32), languages.index(r["label"])) for r in rows if r["bucket"]]
    return fit(languages, idf, sample)


def fit(languages: list[str], idf: np.ndarray, sample: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, seed: int = 3) -> LanguageModel:
    """Weights from four fifths of the sample, the temperature from the rest; with few documents all serve the weights."""
    leader, random = Leader(len(languages)), np.random.default_rng(seed)
    apart = random.permutation(len(sample))
    kept = apart[: len(sample) // CALIBRATED] if len(sample) >= 10 * CALIBRATED else apart[:0]
    learned = np.setdiff1d(apart, kept)
    for _ in range(epochs):
        for i in random.permutation(learned):
            bucket, count, truth = sample[i]
            leader.learn(np.append(bucket, BUCKETS), np.append(weighted(bucket, count, idf), 1.0), truth)
    model = LanguageModel(languages, idf, leader.weights(np.arange(BUCKETS + 1)))
    if len(kept):
        logits = np.array([model.logits(*sample[i][:2]) for i in kept])
        model.temperature = fitted_temperature(logits, np.array([sample[i][2] for i in kept]))
    return model


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the calibrated probability of that language.

    Whole texts count. A null text, one without letters, and every text under a model
    without languages gets ``und`` and a score of 0; of languages as likely the first in
    order is taken. Nothing but the text is read. Every row stays, repeated ones too, with
    all columns; columns with the new names are replaced. Empty in, empty out. No shuffle.
    """
    plain = docs.drop("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, text):
            found = [shared.value.predict(t.decode()) for t in texts]
            new = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*part.columns, *new], [*part.schema.names, "lang_pred", "score"])

    return plain.mapInArrow(run, plain.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema)


def op11_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), train(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
