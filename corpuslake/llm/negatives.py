"""Hard negatives from exact integer inner products, multiplied by Strassen's recursion.

Anchors are a block of rows held by every task; the candidates stay where they are and
are multiplied with the anchors tile by tile, in 64-bit integers, whose additions are
exact in any order. A first pass keeps, per anchor, a heap of the best rows of its
label, its positives. They set a window of scores for negatives, and a second pass keeps
a heap per anchor and positive of the best rows within it. Heaps of different tiles and
tasks merge, so no task sees more than its own candidates.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslake.llm.common import discard, store, table
from corpuslake.session import shared_folder

POSITIVES, NEGATIVES = 5, 10
SCALE = 256
ANCHOR_STEP, RELABEL_STEP, LABELS = 100, 7, 10
#: A negative's score is between these hundredths of the positive's, both included.
LOW, HIGH = 30, 90
#: Anchors of a block (collected, broadcast and searched together), and a tile's anchors and candidates.
BLOCK, TILE_ANCHORS, TILE = 8_192, 512, 1_024
#: Tiles of at most so many rows, columns or components are multiplied directly.
DIRECT = 32
#: Scaled components beyond this could overflow 64-bit scores.
LARGEST = 1 << 26


def strassen(a: np.ndarray, b: np.ndarray, direct: int = DIRECT) -> np.ndarray:
    """Matrix product of integers by seven half-sized products; odd sides get a row or column of zeros."""
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= direct:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    p1 = strassen(a11 + a22, b11 + b22, direct)
    p2 = strassen(a21 + a22, b11, direct)
    p3 = strassen(a11, b12 - b22, direct)
    p4 = strassen(a22, b21 - b11, direct)
    p5 = strassen(a11 + a12, b22, direct)
    p6 = strassen(a21 - a11, b11 + b12, direct)
    p7 = strassen(a12 - a22, b21 + b22, direct)
    out = np.empty((2 * i, 2 * l), np.int64)
    out[:i, :l], out[:i, l:] = p1 + p4 - p5 + p7, p3 + p5
    out[i:, :l], out[i:, l:] = p2 + p4, p1 - p2 + p3 + p6
    return out[:m, :n]


class Heaps:
    """The ``size`` best entries of every group: higher scores first, ties by smaller id."""

    def __init__(self, groups: int, size: int):
        self.size = size
        self.group = self.score = self.id = np.empty(0, np.int64)
        #: Score of the last entry of a full group; lower ones need not be offered.
        self.floor = np.full(groups, np.iinfo(np.int64).min)

    def merge(self, group: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        if not len(group):
            return
        group, score, id_ = np.concatenate([self.group, group]), np.concatenate([self.score, score]), np.concatenate([self.id, id_])
        order = np.lexsort((id_, ~score, group))
        group = group[order]
        start = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        place = np.arange(len(group)) - np.repeat(start, np.diff(np.append(start, len(group))))
        kept = order[place < self.size]
        self.group, self.score, self.id = group[place < self.size], score[order][place < self.size], id_[kept]
        last = place == self.size - 1
        self.floor[group[last]] = score[order][last]

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(self.group), pa.array(self.score), pa.array(self.id)], ["g", "score", "id"])


@dataclass
class Anchors:
    """A block of anchors; ``windows`` has the least and largest score of a negative per anchor and positive."""

    vectors: np.ndarray
    labels: np.ndarray
    lows: np.ndarray | None = None
    highs: np.ndarray | None = None


def matrix(column: pa.Array, scale: int, width: int | None = None) -> np.ndarray:
    """``floor(scale * x)`` per component, a row per vector; components a vector lacks are zero."""
    lengths = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    if len(flat) and np.abs(flat).max() > LARGEST:
        raise OverflowError(f"scaled components beyond {LARGEST} have no exact 64-bit scores")
    most = int(lengths.max(initial=0))
    out = np.zeros((len(lengths), max(most, width or 0)), np.int64)
    if len(flat):
        row = np.repeat(np.arange(len(lengths)), lengths)
        out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat.astype(np.int64)
    return out if width is None else out[:, :width]


def usable(rows: DataFrame, key: str, vector: str, label: str, step: int, labels: int) -> DataFrame:
    """``id``, ``label`` and ``vector`` of the rows that take part, every ``step``-th id relabelled."""
    named = rows.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = named.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    return whole.withColumn("label", F.when(F.col("id") % step == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))) if step else whole


def _tiles(batches: Iterator[pa.RecordBatch], anchors: Anchors, scale: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """Anchors' part, scores (an anchor a row), and the candidates' ids and labels."""
    width = anchors.vectors.shape[1]
    for batch in batches:
        for at in range(0, batch.num_rows, TILE):
            part = batch.slice(at, TILE)
            vectors = np.ascontiguousarray(matrix(part.column("vector"), scale, width).T)
            ids, labels = (part.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("id", "label"))
            for first in range(0, len(anchors.vectors), TILE_ANCHORS):
                some = slice(first, first + TILE_ANCHORS)
                yield some, strassen(anchors.vectors[some], vectors), ids, labels


def _merged(heaps: DataFrame, size: int) -> DataFrame:
    """``g``, ``score``, ``id`` and ``rank`` of the best entries over all tasks' heaps."""
    order = Window.partitionBy("g").orderBy(F.desc("score"), "id")
    return heaps.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)


def best_positives(candidates: DataFrame, anchors: Anchors, size: int, scale: int) -> DataFrame:
    """The ``size`` best rows of an anchor's label; ``g`` is the anchor's place."""
    shared = candidates.sparkSession.sparkContext.broadcast(anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        heaps = Heaps(len(block.vectors), size)
        for some, scores, ids, labels in _tiles(batches, block, scale):
            fits = (labels[None, :] == block.labels[some, None]) & (scores >= heaps.floor[some, None])
            row, column = np.nonzero(fits)
            heaps.merge(row + some.start, scores[row, column], ids[column])
        yield heaps.batch()

    return _merged(candidates.mapInArrow(run, "g bigint, score bigint, id bigint"), size)


def best_negatives(candidates: DataFrame, anchors: Anchors, size: int, scale: int) -> DataFrame:
    """The ``size`` best rows of other labels in every window; ``g`` is anchor times windows plus window."""
    shared = candidates.sparkSession.sparkContext.broadcast(anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        windows = block.lows.shape[1]
        heaps = Heaps(block.lows.size, size)
        for some, scores, ids, labels in _tiles(batches, block, scale):
            other = labels[None, :] != block.labels[some, None]
            number = np.arange(some.start, some.start + len(scores)) * windows
            for w in range(windows):
                low = np.maximum(block.lows[some, w], heaps.floor[number + w])
                row, column = np.nonzero(other & (scores >= low[:, None]) & (scores <= block.highs[some, w, None]))
                heaps.merge(number[row] + w, scores[row, column], ids[column])
        yield heaps.batch()

    return _merged(candidates.mapInArrow(run, "g bigint, score bigint, id bigint"), size)


def windows_of(found: list, ids: np.ndarray, own: np.ndarray, positives: int, low: int, high: int) -> tuple[np.ndarray, ...]:
    """Per anchor its positives' ids, scores and windows; the anchor's own row, one entry with its id and score, is no positive."""
    held: list[list[tuple[int, int]]] = [[] for _ in ids]
    for r in sorted(found, key=lambda r: (r["g"], r["rank"])):
        held[r["g"]].append((r["id"], r["score"]))
    shape = (len(ids), positives)
    chosen, scores, there = np.zeros(shape, np.int64), np.zeros(shape, np.int64), np.zeros(shape, bool)
    for i, entries in enumerate(held):
        if (int(ids[i]), int(own[i])) in entries:
            entries.remove((int(ids[i]), int(own[i])))
        for j, (id_, score) in enumerate(entries[:positives]):
            chosen[i, j], scores[i, j], there[i, j] = id_, score, True
    # 30 * p <= 100 * s <= 90 * p over integers s; a window that isn't there is empty.
    lows, highs = -((-low * scores) // 100), (high * scores) // 100
    return chosen, scores, np.where(there, lows, 1), np.where(there, highs, 0)


def mine(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES,
    low: int = LOW, high: int = HIGH, scale: int = SCALE, anchor_step: int = ANCHOR_STEP, relabel_step: int = RELABEL_STEP, labels: int = LABELS, block: int = BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Rows with a null id, label, vector or component, or one that isn't finite, take no
    part. Every ``anchor_step``-th id is an anchor; its positives are the first other rows
    of its label, its negatives per positive the first rows of other labels whose score is
    at least ``low`` and at most ``high`` hundredths of the positive's. Vectors of different
    lengths are compared as if the shorter one had zeros; an empty one scores zero. Repeated
    rows and equal ids are rows of their own, also as anchors. An anchor without positives
    or negatives gives no row, nor does an empty table. Other columns are not read. Scaled
    components beyond 2^26 are an error.

    Anchors are worked on in blocks of about ``block``, each a pass over all rows per heap,
    whose results are stored, so what a task or the driver holds does not grow.
    """
    spark = rows.sparkSession
    candidates = usable(rows, key, vector, label, relabel_step, labels)
    distinct, folder = store(candidates.filter(F.col("id") % anchor_step == 0).groupBy("id", "label", "vector").agg(F.count("*").alias("times")), "anchors")
    out = shared_folder(spark, "negatives")
    blocks = max(1, -(-distinct.count() // block))
    for number in range(blocks):
        own = distinct.filter(F.pmod(F.xxhash64("id", "label", "vector"), F.lit(blocks)) == number).toArrow()
        own = own.combine_chunks().sort_by([("id", "ascending"), ("label", "ascending")])
        vectors = own.column("vector").combine_chunks()
        vectors = vectors if isinstance(vectors, pa.Array) else pa.concat_arrays(vectors.chunks)
        held = matrix(vectors, scale)
        ids, its_label = own.column("id").to_numpy(), own.column("label").to_numpy()
        anchors = Anchors(held, its_label)
        found = best_positives(candidates, anchors, positives + 1, scale).collect() if len(ids) else []
        chosen, scores, anchors.lows, anchors.highs = windows_of(found, ids, (held * held).sum(1), positives, low, high)
        named = spark.createDataFrame(
            pa.table({
                "g": np.arange(chosen.size), "anchor_id": np.repeat(ids, positives), "positive_id": chosen.ravel(),
                "positive_score": scores.ravel(), "times": np.repeat(own.column("times").to_numpy(), positives),
            })
        )
        best = best_negatives(candidates, anchors, negatives, scale).join(F.broadcast(named), "g")
        each = best.withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
        each.select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        ).write.mode("append").parquet(out)
    discard(spark, folder)
    return spark.read.parquet(out)


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    return mine(table(spark, sf_dir, "embeddings"))


ORACLE = f"""
WITH usable AS (
  SELECT row_number() OVER () AS row, vec_id AS id, CASE WHEN vec_id % {RELABEL_STEP} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
),
scored AS (
  SELECT a.row AS a, a.id AS anchor_id, r.row AS r, r.id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM usable a JOIN usable r ON a.row <> r.row WHERE a.id % {ANCHOR_STEP} = 0
),
positive AS (
  SELECT a, r, id, score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id, r) <= {POSITIVES}
)
SELECT s.anchor_id, p.id AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.id AS negative_id,
       p.score AS positive_score, s.score AS negative_score
FROM positive p JOIN scored s USING (a)
WHERE NOT s.same AND {LOW} * p.score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.score
WINDOW w AS (PARTITION BY p.a, p.r ORDER BY s.score DESC, s.id, s.r)
QUALIFY row_number() OVER w <= {NEGATIVES}
"""
