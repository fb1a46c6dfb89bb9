"""Text to vector: a batch encoder interface and the built-in hashing encoder."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslake.settings import EMBEDDING_DIMS

Encoder = Callable[[list], np.ndarray]
EncoderFactory = Callable[[], Encoder]


def hashing_encoder(dims: int = EMBEDDING_DIMS) -> EncoderFactory:
    """Signed feature hashing of words, ``1 + ln(tf)`` weights, unit length.

    The first 8 hex digits of a word's MD5 give its dimension and the next one its
    sign, so passages, questions and later runs share one space without any fitted
    state.
    """

    def load() -> Encoder:
        word = re.compile(r"[^\W_]+")

        @lru_cache(maxsize=1 << 17)
        def slot(token: str) -> tuple[int, float]:
            digest = hashlib.md5(token.encode()).hexdigest()
            return int(digest[:8], 16) % dims, 1.0 if digest[8] < "8" else -1.0

        def encode(texts: list) -> np.ndarray:
            at, weight = [], []
            for row, text in enumerate(texts):
                base = row * dims
                for token, n in Counter(word.findall((text or "").lower())).items():
                    place, sign = slot(token)
                    at.append(base + place)
                    weight.append(sign * (1.0 + log(n)))
            size = len(texts) * dims
            out = np.bincount(np.array(at, np.int64), weight, size).reshape(len(texts), dims)
            norms = np.linalg.norm(out, axis=1, keepdims=True)
            return out / np.where(norms == 0.0, 1.0, norms)

        return encode

    return load


def encode(
    df: DataFrame,
    text: str = "text",
    out: str = "embedding",
    encoder: EncoderFactory | None = None,
    batch: int = 256,
) -> DataFrame:
    """Add the vector of ``text`` to every row, one model load per task.

    ``encoder`` is a factory called once per task; the function it returns maps a
    list of texts to a matrix with one row each.
    """
    factory = encoder or hashing_encoder()
    schema = T.StructType(df.schema.fields + [T.StructField(out, T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = factory()
        for record in batches:
            for start in range(0, record.num_rows, batch):
                part = record.slice(start, batch)
                texts = part.column(text).to_pylist()
                matrix = np.asarray(model(texts), dtype=np.float32)
                if matrix.ndim != 2 or len(matrix) != len(texts):
                    raise ValueError("the encoder must return one vector per text")
                offsets = np.arange(len(texts) + 1, dtype=np.int32) * matrix.shape[1]
                vectors = pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()))
                yield pa.RecordBatch.from_arrays(
                    part.columns + [vectors], names=[f.name for f in schema.fields]
                )

    return df.mapInArrow(run, schema)


def dimension_report(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows per vector length; a sound collection has exactly one length."""
    return vectors.groupBy(F.size(column).alias("dims")).agg(F.count("*").alias("n"))


def collection_dimension(vectors: DataFrame, column: str = "embedding") -> int:
    """The collection's vector length; raises when lengths differ or it is empty."""
    dims = [r["dims"] for r in dimension_report(vectors, column).limit(2).collect()]
    if len(dims) != 1 or dims[0] < 1:
        raise ValueError(f"expected one vector length, found {sorted(dims)}")
    return dims[0]
