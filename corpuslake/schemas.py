"""Schemas written as ``name type`` lists; usable before a session exists."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(),
    "double": T.DoubleType(), "timestamp": T.TimestampType(), "floats": T.ArrayType(T.FloatType()),
}


def struct(text: str) -> T.StructType:
    """``struct("id long, name string")`` as a schema of nullable columns."""
    pairs = (part.split() for part in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])
