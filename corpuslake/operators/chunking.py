"""Overlapping text windows cut at spaces."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslake.functions.keys import chunk_id, first_filled
from corpuslake.operators.runs import text_runs
from corpuslake.settings import CHUNK_CHARS, CHUNK_OVERLAP, UNKNOWN_LANG

CHUNK_COLUMNS = (
    "chunk_id", "content_hash", "chunk_index", "text", "char_start", "char_end", "feed_id",
    "title", "content_lang", "feed_lang", "silver_s3_uri", "canonical_url",
)


def windows(text: str, size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Start and end offsets of the windows over ``text``.

    A window that does not reach the end is shortened to the last space inside it,
    found in the sorted list of space offsets. The next one begins ``overlap``
    characters before the cut, and always moves on by at least one character.
    """
    n = len(text)
    spaces: list[int] = []
    at = text.find(" ")
    while at >= 0:
        spaces.append(at)
        at = text.find(" ", at + 1)
    begin = 0
    while True:
        cut = begin + size
        if cut >= n:
            yield begin, n
            return
        last = bisect_left(spaces, cut) - 1
        if last >= 0 and spaces[last] > begin:
            cut = spaces[last]
        yield begin, cut
        begin = max(cut - overlap, begin + 1)


def split_text(text: str | None, size: int, overlap: int) -> list[tuple[int, str, int, int]]:
    """Chunks ``(index, text, start, end)`` of one text; offsets are those before trimming."""
    body = (text or "").strip()
    if not body:
        return []
    if len(body) > size and overlap >= size:
        raise ValueError("overlap must be smaller than the chunk size")
    pieces = ((body[a:b].strip(), a, b) for a, b in windows(body, size, overlap))
    filled = (piece for piece in pieces if piece[0])
    return [(i, piece, a, b) for i, (piece, a, b) in enumerate(filled)]


def explode_chunks(
    df: DataFrame,
    text: str = "text",
    size: int = CHUNK_CHARS,
    overlap: int = CHUNK_OVERLAP,
) -> DataFrame:
    """One row per chunk: the other columns of ``df`` and the chunk's own.

    Documents are independent, so nothing is shuffled. Only the text becomes Python
    strings, a run of documents at a time; the other columns are repeated by Arrow.
    """
    kept = [f for f in df.schema.fields if f.name != text]
    own = [
        T.StructField("chunk_index", T.IntegerType()),
        T.StructField(text, T.StringType()),
        T.StructField("char_start", T.IntegerType()),
        T.StructField("char_end", T.IntegerType()),
    ]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_runs(batches, text):
            parents, chunks = [], []
            for row, body in enumerate(batch.column(text).to_pylist()):
                pieces = split_text(body, size, overlap)
                parents.extend([row] * len(pieces))
                chunks.extend(pieces)
            rows = batch.select([f.name for f in kept]).take(pa.array(parents, pa.int32()))
            index, texts, starts, ends = zip(*chunks) if chunks else ((), (), (), ())
            arrays = [
                pa.array(index, pa.int32()), pa.array(texts, pa.string()),
                pa.array(starts, pa.int32()), pa.array(ends, pa.int32()),
            ]
            names = [f.name for f in kept] + [f.name for f in own]
            yield pa.RecordBatch.from_arrays(rows.columns + arrays, names=names)

    return df.mapInArrow(cut, T.StructType(kept + own))


def silver_chunks(
    silver: DataFrame, size: int = CHUNK_CHARS, overlap: int = CHUNK_OVERLAP
) -> DataFrame:
    """Chunks of silver documents with the metadata a citation needs."""
    lang = first_filled(F.col("content_lang"), F.col("feed_lang"), F.lit(UNKNOWN_LANG))
    documents = silver.select(
        "content_hash", "feed_id", "title", lang.alias("content_lang"), "feed_lang",
        "silver_s3_uri", "canonical_url", "text",
    )
    chunks = explode_chunks(documents, "text", size, overlap)
    return chunks.withColumn(
        "chunk_id", chunk_id(F.col("content_hash"), F.col("chunk_index"))
    ).select(*CHUNK_COLUMNS)
