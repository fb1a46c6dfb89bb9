"""Cosine search over cells: the same results as a scan, and cells that aren't read."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuslake.operators import vector, vector_index
from corpuslake.operators.vector_index import VectorIndex
from tests.test_retrieval import vectors

COLUMNS = ["query_id", "chunk_id", "score", "rank"]


def rows_of(df):
    return sorted(map(tuple, df.select(COLUMNS).collect()))


def asked(spark, matrix):
    return spark.createDataFrame([(i, m.tolist()) for i, m in enumerate(matrix)], "query_id long, embedding array<double>")


@pytest.mark.parametrize("cells,probed,max_block", [(1, 1, 100), (None, 2, 100), (40, 1, 3), (40, 3, 100)])
def test_search_equals_a_scan(spark, tmp_path, cells, probed, max_block):
    """Small integers: many ties, vectors and queries without direction, equal and opposite ones."""
    df, m = vectors(spark)
    rng = np.random.default_rng(4)
    zero = spark.createDataFrame([(f"z{i}", "fr", [0.0] * 8) for i in range(12)] + [("null", "fr", None)], df.schema)
    wanted = asked(spark, np.vstack([m[:4], -m[5:7], rng.normal(size=(3, 8)), np.zeros((1, 8))]))
    index = VectorIndex.write(df.unionByName(zero), str(tmp_path), cells=cells)
    kept = df.unionByName(zero).filter("embedding IS NOT NULL")
    for lang in (None, "fr"):
        got = vector_index.cosine_top_k(wanted, index, 7, lang, probed=probed, max_block=max_block)
        assert rows_of(got) == rows_of(vector.cosine_top_k(wanted, kept, 7, lang))
    assert index.vectors.count() == 512 and rows_of(vector_index.cosine_top_k(wanted, index, 600)) == rows_of(vector.cosine_top_k(wanted, kept, 600))


def grouped(spark, n=2_000, groups=25):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(groups, 16))
    m = centres[np.arange(n) % groups] + rng.normal(size=(n, 16)) * 0.05
    df = spark.createDataFrame([(f"c{i:05d}", "fr", v.tolist()) for i, v in enumerate(m)], "chunk_id string, content_lang string, embedding array<float>")
    return df, m


def test_cells_out_of_reach_are_not_read(spark, tmp_path, monkeypatch):
    df, m = grouped(spark)
    index = VectorIndex.write(df, str(tmp_path), cells=25)
    read = []
    best = vector_index._best
    monkeypatch.setattr(vector_index, "_best", lambda index, pairs, *rest: (read.append(sorted(pairs)), best(index, pairs, *rest))[1])
    wanted = asked(spark, m[:3])
    got = vector_index.cosine_top_k(wanted, index, 5)
    assert rows_of(got) == rows_of(vector.cosine_top_k(wanted, df, 5))
    assert len(set(sum(read, []))) <= 8
    pruned = index.vectors.filter(F.col("cell").isin(1, 2))
    assert "PartitionFilters: [cell" in pruned._jdf.queryExecution().executedPlan().toString()
    assert pruned.select(F.input_file_name()).distinct().count() <= 2


def test_bounds_hold_for_every_vector():
    rng = np.random.default_rng(3)
    places = vector.unit_rows(rng.normal(size=(9, 5)))
    rows, queries = vector.unit_rows(rng.normal(size=(400, 5))), vector.unit_rows(rng.normal(size=(30, 5)))
    own = (rows @ places.T).argmax(1)
    away = vector_index.angles((rows * places[own]).sum(1))
    near = np.array([away[own == c].min() for c in range(9)])
    far = np.array([away[own == c].max() for c in range(9)])
    bounds = vector_index.similarity_bounds(vector_index.angles(queries @ places.T), near, far)
    assert ((queries @ rows.T) <= bounds[:, own] + 1e-12).all()


def test_nothing_stored_or_asked(spark, tmp_path):
    df, m = vectors(spark)
    index = VectorIndex.write(df, str(tmp_path / "a"))
    assert vector_index.cosine_top_k(asked(spark, m[:0]), index, 5).count() == 0
    none = VectorIndex.write(df.limit(0), str(tmp_path / "b"))
    assert vector_index.cosine_top_k(asked(spark, m[:2]), none, 5).count() == 0
