"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslake.session import shared_folder

__all__ = ["discard", "join_counted", "join_many", "row_key", "slices", "store", "table"]

# Texts are worked on in slices of about so many bytes, whatever the size of an Arrow batch.
SLICE_BYTES = 4_000_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """``df`` written below the shared folder and read again, and the folder's path."""
    folder = shared_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder), folder


def discard(spark: SparkSession, folder: str) -> None:
    """Delete a folder that ``store`` made and that no later plan reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def row_key(*columns: str) -> Column:
    """128-bit key of a row's values; nulls and empty strings differ, and so do neighbours' borders."""
    parts = [F.when(F.col(c).isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string"))) for c in columns]
    return F.unhex(F.md5(F.concat(*parts)))


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows in runs of about ``size`` bytes of text, with the texts as UTF-8 (null: empty)."""
    for batch in batches:
        column = batch.column(text).cast(pa.large_binary())
        at, held, first = 0, 0, 0
        lengths = [0 if n is None else n for n in pa.compute.binary_length(column).to_pylist()]
        while at < len(lengths):
            held += lengths[at]
            at += 1
            if held >= size or at == len(lengths):
                part = batch.slice(first, at - first)
                yield part, [t or b"" for t in column.slice(first, at - first).to_pylist()]
                first, held = at, 0


def join_counted(left: DataFrame, right: DataFrame, key: str, n: str, total: int, share: float = 0.001) -> DataFrame:
    """Inner join to ``right``, whose ``key`` is unique and whose ``n`` counts the key's rows on the left.

    The counts add up to ``total`` at most, so no more than ``1 / share`` keys are frequent.
    Those rows are broadcast and the hot keys' left rows stay where they are; the rest is
    joined by shuffle.
    """
    hot = F.col(n) >= max(2.0, total * share)
    few = F.broadcast(right.filter(hot))
    rest = left.join(few.select(key), key, "left_anti").join(right.filter(~hot), key)
    return left.join(few, key).unionByName(rest)


def join_many(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join to ``right``, whose ``key`` is unique, by one plan for tables of all sizes.

    Both sides are sorted by key. A key with very many rows on the left makes a large
    partition, which the adaptive plan cuts into pieces that each meet the one row on the
    right. The result should be stored or shuffled by another key, not grouped by this one.
    """
    return left.join(right.hint("merge"), key)
