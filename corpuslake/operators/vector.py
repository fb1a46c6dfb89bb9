"""Exact cosine top-k over chunk vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslake.operators.best import TaskBest
from corpuslake.operators.lexical import top_k
from corpuslake.session import shared_folder, written
from corpuslake.settings import MAX_QUERY_BLOCK, SCORE_DIGITS

ROWS_PER_PRODUCT = 4096
#: A product has at most so many scores, whatever the number of queries.
SCORES_PER_PRODUCT = 1 << 20


def product_rows(queries: int) -> int:
    """How many vectors are multiplied with so many queries at a time."""
    return max(1, min(ROWS_PER_PRODUCT, SCORES_PER_PRODUCT // max(1, queries)))


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(norms == 0.0, 1.0, norms)


def list_matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A list column as a float64 matrix; every list must have ``dims`` values."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) != len(column) * dims:
        raise ValueError(f"vectors must have {dims} values")
    return flat.reshape(len(column), dims).astype(np.float64)


def _partial_top_k(vectors: DataFrame, queries: list, k: int, key: str, column: str) -> DataFrame:
    """Each task's own best ``k`` rows per query.

    Tasks multiply blocks of vectors with the query matrix and keep ``k`` candidates
    per query, so what leaves a task is bounded by ``k`` and the number of queries,
    never by the number of pairs.
    """
    id_type = T.StringType() if queries and isinstance(queries[0]["query_id"], str) else T.LongType()
    schema = T.StructType(
        [
            T.StructField("query_id", id_type),
            T.StructField(key, vectors.schema[key].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )

    if not queries:
        return vectors.sparkSession.createDataFrame([], schema)
    dims = len(queries[0]["embedding"])
    ids = [q["query_id"] for q in queries]
    matrix = unit_rows(np.array([q["embedding"] for q in queries], dtype=np.float64))
    shared = vectors.sparkSession.sparkContext.broadcast((ids, matrix))
    id_arrow = pa.string() if id_type == T.StringType() else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, wanted = shared.value
        best, key_type, step = TaskBest(names, k), None, product_rows(len(names))
        for batch in batches:
            key_type = batch.schema.field(key).type
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                rows = unit_rows(list_matrix(part.column(column), dims))
                best.add(np.round(rows @ wanted.T, SCORE_DIGITS) + 0.0, part.column(key))
        rows_out = best.rows()
        if rows_out:
            ids_out, keys_out, scores_out = zip(*rows_out)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids_out, id_arrow),
                    pa.array(keys_out, key_type),
                    pa.array(scores_out, pa.float64()),
                ],
                names=["query_id", key, "score"],
            )

    return vectors.select(key, column).mapInArrow(run, schema)


def cosine_top_k(
    queries: DataFrame,
    vectors: DataFrame,
    k: int,
    lang: str | None = None,
    key: str = "chunk_id",
    column: str = "embedding",
    max_block: int = MAX_QUERY_BLOCK,
) -> DataFrame:
    """``(query_id, key, score, rank)``: the ``k`` nearest vectors of every query.

    ``queries`` has ``query_id`` and ``embedding``. Any language filters the vectors
    before they are scored. Queries are counted first: up to ``max_block`` of them
    go to the tasks in one piece; a larger table is answered block after block, each
    block's exact result being written below the shared folder.
    """
    if lang:
        vectors = vectors.filter(F.col("content_lang") == lang)
    queries = queries.select("query_id", "embedding")
    head = queries.limit(max_block + 1).collect()
    if len(head) <= max_block:
        return top_k(_partial_top_k(vectors, head, k, key, column), k, key)
    spark = vectors.sparkSession
    blocks = -(-queries.count() // (max_block // 2))
    folder = shared_folder(spark, "cosine")
    numbered = queries.withColumn("_b", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
    for block in range(blocks):
        wanted = numbered.filter(F.col("_b") == block).drop("_b").collect()
        if wanted:
            ranked = top_k(_partial_top_k(vectors, wanted, k, key, column), k, key)
            ranked.write.mode("overwrite").parquet(f"{folder}/block={block}")
    return spark.read.parquet(folder).drop("block")


def label_centroids(vectors: DataFrame, label: str = "label", column: str = "embedding") -> DataFrame:
    """Mean vector per label as a query table, one row per label."""
    means = (
        vectors.select(label, F.posexplode(column).alias("pos", "x"))
        .groupBy(label, "pos")
        .agg(F.round(F.avg(F.col("x").cast("double")), SCORE_DIGITS).alias("x"))
    )
    ordered = F.array_sort(F.collect_list(F.struct("pos", "x")))
    return means.groupBy(F.col(label).cast("long").alias("query_id")).agg(
        F.transform(ordered, lambda p: p["x"]).alias("embedding")
    )


def with_payload(ranked: DataFrame, chunks: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Add the chunk's text and metadata to ranked hits.

    They are at most ``k`` per query and stored first, as in the lexical search.
    """
    return written(ranked, "near").join(chunks.drop("embedding"), key)


def count_points(vectors: DataFrame | None) -> int:
    return 0 if vectors is None else vectors.count()
