"""Stored vectors by cell, and exact cosine search that reads only the cells that matter.

Vectors lie with their nearest centroid, in a partition sorted by the angle between the
two. Angles obey the triangle inequality, so a cell's least and largest angle bound the
similarity of a query to anything in it: cells that can't reach a query's k-th score are
not read, and of the others only the stretch of angles that some query may still need.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslake.operators.best import TaskBest
from corpuslake.operators.lexical import top_k
from corpuslake.operators.vector import list_matrix, product_rows, unit_rows
from corpuslake.session import shared_folder, written
from corpuslake.settings import SCORE_DIGITS

#: Centroids are fitted on at most so many vectors, those with the smallest hashes; there are at most so many of them.
MAX_SAMPLE, MAX_CELLS, FIT_ROUNDS = 10_000, 4_096, 6
#: Cells that every query reads first; its k-th score there is what the others have to reach.
PROBED = 2
#: Vectors without direction score zero with every query and have a cell of their own.
NO_DIRECTION = -1
#: The driver holds some numbers per query of a block and cell.
QUERIES_PER_SEARCH = 1_024
#: Angles are rounded in floating point by less than this.
ANGLE_SLACK = 1e-6


def fitted_centroids(sample: np.ndarray, cells: int) -> np.ndarray:
    """Unit centroids by spherical k-means, started at rows that are far apart in the sample's order."""
    sample = sample[np.linalg.norm(sample, axis=1) > 0]
    if not len(sample):
        return np.zeros((0, sample.shape[1]))
    places = sample[np.linspace(0, len(sample) - 1, min(cells, len(sample))).astype(np.int64)]
    for _ in range(FIT_ROUNDS):
        own = (sample @ places.T).argmax(1)
        sums = np.zeros_like(places)
        np.add.at(sums, own, sample)
        empty = np.linalg.norm(sums, axis=1) == 0
        places = np.where(empty[:, None], places, unit_rows(sums))
    return places


def angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1, 1))


@dataclass(frozen=True)
class VectorIndex:
    """A table of vectors by cell, with all columns it was written with, and the cells' centroids and angles."""

    spark: SparkSession
    path: str
    key: str = "chunk_id"
    column: str = "embedding"

    @property
    def vectors(self) -> DataFrame:
        layout = self.spark.read.parquet(f"{self.path}/layout").first()["columns"]
        return self.spark.read.schema(T.StructType.fromJson(json.loads(layout))).parquet(f"{self.path}/vectors")

    @property
    def cells(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/cells")

    @classmethod
    def write(cls, vectors: DataFrame, path: str, key: str = "chunk_id", column: str = "embedding", cells: int | None = None) -> VectorIndex:
        """Store ``vectors``, whose ``column`` has one length, in place of any other; null vectors are left out.

        Without ``cells`` there are about as many as the square root of the rows. The
        vectors are stored first, for they are counted, sampled and placed, and making
        them may be most of the work.
        """
        spark = vectors.sparkSession
        vectors = written(vectors.filter(F.col(column).isNotNull()), "vectors-made")
        cells = min(MAX_CELLS, cells or max(1, int(vectors.count() ** 0.5)))
        sample = vectors.select(column).orderBy(F.xxhash64(key), key).limit(MAX_SAMPLE).toArrow().column(column).combine_chunks()
        sample = sample if isinstance(sample, pa.Array) else pa.concat_arrays(sample.chunks)
        dims = len(sample[0]) if len(sample) else 0
        places = fitted_centroids(unit_rows(list_matrix(sample, dims)), cells)
        shared = spark.sparkContext.broadcast(places)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            step = product_rows(len(shared.value))
            for batch in batches:
                for at in range(0, batch.num_rows, step):
                    part = batch.slice(at, step)
                    rows = unit_rows(list_matrix(part.column(column), dims))
                    near = rows @ shared.value.T if len(shared.value) else np.zeros((len(rows), 1))
                    cell = near.argmax(1)
                    away = angles(near[np.arange(len(rows)), cell])
                    lost = ~rows.any(1)
                    cell, away = np.where(lost, NO_DIRECTION, cell), np.where(lost, 0, away)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell.astype(np.int32)), pa.array(away)], [*part.schema.names, "cell", "away"])

        kinds = T.StructType([*vectors.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("away", T.DoubleType())])
        (
            vectors.mapInArrow(place, kinds).hint("rebalance", "cell").sortWithinPartitions("cell", "away", key)
            .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("cell").parquet(f"{path}/vectors")
        )
        spark.createDataFrame([(kinds.json(),)], "columns string").write.mode("overwrite").parquet(f"{path}/layout")
        self = cls(spark, path, key, column)
        centroid = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(places)] + [(NO_DIRECTION, None)], "cell int, centroid array<double>")
        held = self.vectors.groupBy("cell").agg(F.min("away").alias("nearest"), F.max("away").alias("farthest"), F.count("*").alias("n"))
        centroid.join(held, "cell").coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")
        return self


def similarity_bounds(toward: np.ndarray, nearest: np.ndarray, farthest: np.ndarray) -> np.ndarray:
    """The highest cosine of a query to a vector of a cell, from its angle to the centroid and the cell's angles."""
    apart = np.maximum.reduce([toward - farthest, nearest - toward, np.zeros_like(toward)])
    return np.cos(np.maximum(0, apart - ANGLE_SLACK))


def _best(index: VectorIndex, pairs: dict[int, list[int]], queries: tuple, k: int, lang: str | None, stretch: dict[int, tuple[float, float]], schema) -> DataFrame:
    """Each task's best ``k`` vectors per query; ``pairs`` has the queries that a cell is searched for."""
    names, matrix = queries
    key, column = index.key, index.column
    shared = index.spark.sparkContext.broadcast((names, matrix, pairs))
    rows = index.vectors.filter(F.col("cell").isin(sorted(pairs)))
    if lang:
        rows = rows.filter(F.col("content_lang") == lang)
    if stretch:
        low, high = min(a for a, _ in stretch.values()), max(b for _, b in stretch.values())
        within = F.lit(False)
        for cell, (a, b) in stretch.items() if len(stretch) <= 100 else ():
            within |= (F.col("cell") == cell) & F.col("away").between(a, b)
        rows = rows.filter(F.col("away").between(low, high))
        rows = rows.filter(within) if len(stretch) <= 100 else rows
    id_arrow = pa.string() if isinstance(schema.fields[0].dataType, T.StringType) else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, wanted, of = shared.value
        best, kind, step = TaskBest(ids, k), None, product_rows(len(ids))
        for batch in batches:
            kind = batch.schema.field(key).type
            cells = batch.column("cell").to_numpy()
            for cell in np.unique(cells).tolist():
                own = np.flatnonzero(cells == cell)
                for at in range(0, len(own), step):
                    part = batch.take(pa.array(own[at : at + step]))
                    scores = np.full((part.num_rows, len(ids)), -np.inf)
                    near = unit_rows(list_matrix(part.column(column), wanted.shape[1])) @ wanted[of[cell]].T
                    scores[:, of[cell]] = np.round(near, SCORE_DIGITS) + 0.0
                    best.add(scores, part.column(key))
        found = best.rows()
        if found:
            q, keys, scores = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(q, id_arrow), pa.array(keys, kind), pa.array(scores, pa.float64())], ["query_id", key, "score"])

    return rows.select(key, column, "cell").mapInArrow(run, schema)


def _search_block(index: VectorIndex, queries: list, k: int, lang: str | None, probed: int, schema) -> DataFrame:
    spark, key = index.spark, index.key
    cells = sorted(index.cells.collect(), key=lambda r: r["cell"])
    if not cells:
        return spark.createDataFrame([], schema)
    ids = [q["query_id"] for q in queries]
    matrix = unit_rows(np.array([q["embedding"] for q in queries], np.float64))
    numbers = np.array([c["cell"] for c in cells])
    places = np.array([c["centroid"] or [0.0] * matrix.shape[1] for c in cells], np.float64)
    nearest, farthest = (np.array([c[n] for c in cells]) for n in ("nearest", "farthest"))
    toward = angles(matrix @ places.T)
    bounds = similarity_bounds(toward, nearest, farthest)
    # Without a direction on either side the score is zero.
    bounds[~matrix.any(1)] = 0
    bounds[:, numbers == NO_DIRECTION] = 0
    tried = np.zeros(bounds.shape, bool)
    order = np.argsort(-bounds, axis=1, kind="stable")[:, :probed]
    np.put_along_axis(tried, order, True, axis=1)

    def searched(chosen: np.ndarray, stretch: dict) -> DataFrame:
        pairs = {int(numbers[c]): np.flatnonzero(chosen[:, c]) for c in np.flatnonzero(chosen.any(0))}
        return top_k(_best(index, pairs, (ids, matrix), k, lang, stretch, schema), k, key).select(schema.names)

    found = written(searched(tried, {}), "probed-cells")
    reach = {r["query_id"]: r["least"] for r in found.groupBy("query_id").agg(F.min("score").alias("least"), F.count("*").alias("n")).filter(F.col("n") >= k).collect()}
    least = np.array([reach.get(i, -np.inf) for i in ids])
    hopeful = (bounds + 10.0**-SCORE_DIGITS >= least[:, None]) & ~tried
    if not hopeful.any():
        return found
    # How far from the centroid a vector can lie that still reaches a query's k-th score.
    turn = np.where(np.isfinite(least), angles(np.where(np.isfinite(least), least - 2 * 10.0**-SCORE_DIGITS, 0)), np.pi) + ANGLE_SLACK
    stretch = {}
    for c in np.flatnonzero(hopeful.any(0)):
        q = np.flatnonzero(hopeful[:, c])
        plain = numbers[c] == NO_DIRECTION or not matrix[q].any(1).all()
        stretch[int(numbers[c])] = (0.0, 4.0) if plain else (float((toward[q, c] - turn[q]).min()), float((toward[q, c] + turn[q]).max()))
    return found.unionByName(searched(hopeful, stretch))


def cosine_top_k(
    queries: DataFrame, index: VectorIndex, k: int, lang: str | None = None, probed: int = PROBED, max_block: int = QUERIES_PER_SEARCH
) -> DataFrame:
    """``(query_id, key, score, rank)``, the same as a search of all stored vectors.

    Every query searches the ``probed`` cells with the highest bounds; the other cells are
    searched for the queries whose k-th score they may reach. Queries are counted first and
    worked on in blocks of ``max_block``, whose results are stored.
    """
    spark, queries = index.spark, queries.select("query_id", "embedding")
    schema = T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType), T.StructField(index.key, index.vectors.schema[index.key].dataType), T.StructField("score", T.DoubleType()),
    ])
    blocks = max(1, -(-queries.count() // max_block))
    numbered = queries.withColumn("_b", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
    folder = shared_folder(spark, "cells")
    for block in range(blocks):
        asked = numbered.filter(F.col("_b") == block).drop("_b").collect()
        found = _search_block(index, asked, k, lang, probed, schema) if asked else spark.createDataFrame([], schema)
        found.write.mode("append").parquet(folder)
    return top_k(spark.read.schema(schema).parquet(folder), k, index.key)
