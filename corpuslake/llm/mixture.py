"""Document rates whose expected domain token totals match target weights.

A softmax classifier learned from the labelled table gives each document a posterior
over domains. Projected gradient descent then fits a nonnegative rate per document so
that the expected tokens of each domain, summed over the corpus, meet the targets in
least squares. A step needs one number per domain from the corpus; a document's rate
follows from its own posterior and the steps so far, so rates are never stored or moved.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslake.llm.common import slices, store, table
from corpuslake.llm.words import WordHashes, split_words

DOMAINS = ("clean", "toxic", "poor")
#: Shares of the expected tokens that the registered query and the pipeline aim at.
TARGETS = {"clean": 0.97, "toxic": 0.02, "poor": 0.01}
FEATURES = 1024
#: The classifier is fitted on at most so many labelled documents, those with the smallest hashes.
MAX_SAMPLE = 6_000
TRAINING_STEPS, TRAINING_RATE = 200, 0.5
MAX_STEPS, TOLERANCE = 60, 1e-6
#: Weight that holds rates at one where the targets leave them free.
HOLD = 1e-6


def _features(texts: list[bytes], known: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashed word shares (square roots, so of length one) and word counts."""
    words = [known.of(split_words(t)) for t in texts]
    n = np.array([len(w) for w in words], np.int64)
    out = np.zeros((len(texts), FEATURES), np.float32)
    for row, w in zip(out, words, strict=True):
        if len(w):
            row[:] = np.sqrt(np.bincount((w >> np.uint64(20)).astype(np.int64) % FEATURES, minlength=FEATURES) / len(w))
    return out, n


@dataclass
class Classifier:
    """Softmax regression; ``weights`` has a row per feature and a column per domain, the last row is the bias."""

    weights: np.ndarray

    def posteriors(self, x: np.ndarray) -> np.ndarray:
        logits = x @ self.weights[:-1] + self.weights[-1]
        e = np.exp(logits - logits.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, domains: int) -> Classifier:
        """Adam on the log loss of all rows; without rows every domain is as likely."""
        model = cls(np.zeros((FEATURES + 1, domains), np.float32))
        if not len(y):
            return model
        m, v = np.zeros_like(model.weights), np.zeros_like(model.weights)
        truth = np.eye(domains, dtype=np.float32)[y]
        for step in range(1, TRAINING_STEPS + 1):
            d = (model.posteriors(x) - truth) / len(y)
            grad = np.vstack([x.T @ d, d.sum(0)]) + 1e-5 * model.weights
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
            model.weights -= TRAINING_RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return model


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", max_sample: int = MAX_SAMPLE) -> Classifier:
    """Domains: poor (quality 0), else toxic (toxic 1), else clean.

    Null ids and labels other than 0 and 1 are passed over; an id with several labels
    takes the smallest quality and the largest toxic. The sample are the ``max_sample``
    ids with the smallest hashes.
    """
    usable = labels.filter(F.col("quality").isin(0, 1) & F.col("toxic").isin(0, 1) & F.col(key).isNotNull())
    chosen = (
        usable.groupBy(F.col(key).alias("id")).agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
        .select("id", F.when(F.col("q") == 0, 2).when(F.col("t") == 1, 1).otherwise(0).alias("y"))
        .orderBy(F.xxhash64("id"), "id").limit(max_sample)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for part, texts in slices(batches):
            x, _ = _features(texts, known)
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("y"), pa.array([r.astype(np.float16).tobytes() for r in x], pa.binary())], ["id", "y", "x"])

    body = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")
    kind = body.schema["id"].dataType.simpleString()
    rows = sorted(body.select("id", "y", "text").mapInArrow(run, f"id {kind}, y int, x binary").collect(), key=lambda r: (r["id"], r["x"]))
    x = np.array([np.frombuffer(r["x"], np.float16) for r in rows], np.float32).reshape(len(rows), FEATURES)
    return Classifier.fit(x, np.array([r["y"] for r in rows], np.int64), len(DOMAINS))


def rates(posteriors: np.ndarray, steps: np.ndarray, hold: float = HOLD) -> np.ndarray:
    """Each document's rate after ``steps`` (one row of domain gradients each), from one on."""
    r = np.ones(len(posteriors))
    for g in steps:
        r = np.maximum(0, r - posteriors @ g - hold * (r - 1))
    return r


def fit_steps(stored: DataFrame, targets: list[float], max_steps: int = MAX_STEPS, tolerance: float = TOLERANCE, hold: float = HOLD) -> np.ndarray:
    """Gradients of the descent for a table of ``n`` (tokens) and ``p`` (posterior).

    The squared error of each domain's expected share is divided by the domain's actual
    share, which bounds the curvature by one, so a step of length one always descends.
    Every step is one job that brings back a sum per domain and task. A domain that no
    document has is left out, as no rate can change it.
    """
    spark, domains = stored.sparkSession, len(targets)

    def expected(steps: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                p = np.array(batch.column("p").flatten()).reshape(-1, domains)
                n = np.array(batch.column("n"), np.float64)
                sums = (rates(p, steps, hold) * n) @ p
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(domains, dtype=np.int32)), pa.array(sums)], ["d", "s"])

        got = {r["d"]: r["s"] for r in stored.mapInArrow(run, "d int, s double").groupBy("d").agg(F.sum("s").alias("s")).collect()}
        return np.array([got.get(d, 0.0) for d in range(domains)])

    start = expected(np.zeros((0, domains)))
    total = start.sum()
    if not total:
        return np.zeros((0, domains))
    share = start / total
    aim = np.array(targets, np.float64) / sum(targets)
    there, steps, now = share > 0, np.zeros((0, domains)), share
    for _ in range(max_steps):
        gap = now - aim
        if np.abs(gap[there]).max() < tolerance:
            break
        steps = np.vstack([steps, np.where(there, gap / np.where(there, share, 1), 0)])
        now = expected(steps) / total
    return steps


def mix(docs: DataFrame, classifier: Classifier, targets: dict[str, float], key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with n_tokens, posterior, rate and copies.

    Targets are shares of the expected tokens, which add up to the corpus' tokens; they
    are scaled to a sum of one. A document is to be read ``rate`` times on average:
    ``copies`` is the rate rounded up or down by a hash of the id, so that its mean is
    the rate. A null or empty text has no tokens, no influence, and a rate like any
    other of its posterior. Every row stays, repeated ones too, with all columns;
    columns with the new names are replaced. Empty in, empty out. No shuffle.
    """
    aims = [float(targets[d]) for d in DOMAINS]
    shared = docs.sparkSession.sparkContext.broadcast(classifier)
    plain = docs.drop("n_tokens", "posterior", "rate", "copies")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for _, texts in slices(batches):
            x, n = _features(texts, known)
            p = shared.value.posteriors(x).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(n), pa.array(list(p), pa.list_(pa.float64()))], ["n", "p"])

    stored, _ = store(plain.select(F.col(text).alias("text")).mapInArrow(measure, "n bigint, p array<double>"), "posteriors")
    steps = fit_steps(stored, aims)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for part, texts in slices(batches, text):
            x, n = _features(texts, known)
            p = shared.value.posteriors(x).astype(np.float64)
            new = [pa.array(n), pa.array(list(p), pa.list_(pa.float64())), pa.array(rates(p, steps))]
            yield pa.RecordBatch.from_arrays([*part.columns, *new], [*part.schema.names, "n_tokens", "posterior", "rate"])

    schema = plain.select(
        "*", F.lit(0).cast("long").alias("n_tokens"), F.array().cast("array<double>").alias("posterior"), F.lit(0.0).alias("rate")
    ).schema
    rated = plain.mapInArrow(apply, schema)
    chance = F.pmod(F.xxhash64(F.lit("copies"), F.col(key)), F.lit(1_000_003)) / 1_000_003
    return rated.withColumn("copies", (F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("long")).cast("long"))


def op9_mixture(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    mixed = mix(docs, train(docs, table(spark, sf_dir, "labels")), TARGETS)
    return mixed.select("doc_id", "n_tokens", *[F.get("posterior", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(DOMAINS)], "rate", "copies")
