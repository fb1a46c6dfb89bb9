"""Inputs as folders, and tasks whose memory does not follow the size of a batch or a group."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corpuslake.operators import chunking, langid, lexical, lexical_index, runs, vector, vector_index
from corpuslake.plans.queries import QUERIES
from corpuslake.streaming import ingest


def test_streams_read_folders_of_files_with_any_names(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, "b", "x"), (4, "b", None)], "doc_id long, source string, text string")
    rows.repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    rows.limit(1).write.parquet(f"{tmp_path}/labels.parquet")
    assert QUERIES["stream_dedup"](spark, str(tmp_path)).count() == 3
    assert {r["url"]: r["doc_id"] for r in QUERIES["stream_upsert"](spark, str(tmp_path)).collect() if r["doc_id"] != 4}.popitem()[1] == 1


def test_streams_read_one_file_and_empty_tables(spark, tmp_path):
    import pyarrow.parquet as pq

    for name, n in (("some", 2), ("none", 0)):
        (tmp_path / name).mkdir()
        table = pa.table({"doc_id": pa.array(range(n), pa.int64()), "source": pa.array(["a"] * n, pa.string()), "text": pa.array(["x", "y"][:n], pa.string())})
        pq.write_table(table, f"{tmp_path}/{name}/documents.parquet")
        assert QUERIES["stream_dedup"](spark, f"{tmp_path}/{name}").count() == n
    schema = spark.read.parquet(f"{tmp_path}/some/documents.parquet").schema
    assert ingest.stream_table(spark, f"{tmp_path}/some", "documents", schema).isStreaming


def test_runs_hold_every_row_once_in_order_and_are_bounded():
    texts = ["abc" * 9, None, "", "x" * 500, "é" * 20, "y"] * 7
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(range(len(texts)))], ["text", "at"])
    parts = list(runs.text_runs(iter([batch, batch.slice(0, 0), batch]), "text", 100))
    assert [i for p in parts for i in p.column("at").to_pylist()] == [*range(len(texts)), *range(len(texts))]
    for p in parts:
        lengths = [len((t or "").encode()) for t in p.column("text").to_pylist()]
        assert sum(lengths) - max(lengths) <= 200


def test_language_scores_hold_one_run_at_a_time(monkeypatch):
    model = langid.LangProfiles(("de", "en"), np.ones(langid.PLACES, bool), np.random.default_rng(1).random((langid.PLACES, 2)), np.array([-9.0, -9.0]))
    texts = [" ein satz und noch einer ", None, " ", " a ", " many other words here "] * 40
    whole, held = langid.score(texts, model), []
    points = langid.code_points
    monkeypatch.setattr(langid, "RUN_CHARS", 60)
    monkeypatch.setattr(langid, "code_points", lambda some: (held.append(sum(len(t or "") for t in some)), points(some))[1])
    assert langid.score(texts, model) == whole
    assert max(held) < 200


def test_profiles_count_places_of_all_code_points(spark, monkeypatch):
    monkeypatch.setattr(langid, "HELD_LANGS", 1)
    texts = [("가힣 나다", "KO"), ("𐐀𐐁𐐂", "x"), ("ab, ab", "de"), ("ab ab", "de"), ("abc", " "), ("abc", None), (None, "de"), ("", "de"), ("abc", "DE")]
    table = langid.profile_table(spark.createDataFrame(texts, "text string, lang string").coalesce(1))
    got = {(r["lang"], r["place"]): r["n"] for r in table.collect()}
    want: dict = {}
    for text, lang in ((" 가힣 나다 ", "ko"), (" " + "𐐀𐐁𐐂".lower() + " ", "x"), (" ab ab ", "de"), (" ab ab ", "de"), (" abc ", "de")):
        for a, b, c in zip(text, text[1:], text[2:]):
            place = (ord(a) * langid.FACTORS[0] + ord(b) * langid.FACTORS[1] + ord(c) * langid.FACTORS[2]) % langid.PLACES
            want[lang, place] = want.get((lang, place), 0) + 1
    assert got == want


def test_chunks_are_cut_a_run_of_documents_at_a_time(spark):
    docs = spark.createDataFrame([(i, "word " * 3_000) for i in range(300)], "id long, text string").coalesce(1)
    sizes = chunking.explode_chunks(docs).mapInArrow(
        lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"]) for b in batches), "n long")
    assert chunking.explode_chunks(docs).groupBy("id").count().filter("count = 22").count() == 300
    assert sizes.agg(F.sum("n")).first()[0] == 300 * 22
    batch = pa.RecordBatch.from_arrays([pa.array(["word " * 3_000] * 300, pa.string())], ["text"])
    assert max(p.num_rows for p in runs.text_runs(iter([batch]), "text")) < 80


def test_a_product_of_vectors_is_bounded_whatever_the_queries(spark, monkeypatch):
    assert vector.product_rows(4_096) * 4_096 <= vector.SCORES_PER_PRODUCT and vector.product_rows(10**9) == 1
    rng = np.random.default_rng(5)
    rows = [(i, rng.integers(-3, 4, 4).astype(float).tolist()) for i in range(200)]
    vectors = spark.createDataFrame(rows, "chunk_id long, embedding array<double>")
    asked = spark.createDataFrame([(i, v) for i, v in rows[:20]], "query_id long, embedding array<double>")
    want = sorted(vector.cosine_top_k(asked, vectors, 5).collect())
    monkeypatch.setattr(vector, "SCORES_PER_PRODUCT", 20)
    assert sorted(vector.cosine_top_k(asked, vectors, 5).collect()) == want


def test_a_vector_index_makes_its_vectors_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def make(batches):
        for b in batches:
            made.add(b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("chunk_id"), pa.array([[float(i % 7), 1.0] for i in b.column("chunk_id").to_pylist()])], ["chunk_id", "embedding"])

    rows = spark.range(50).select(F.col("id").alias("chunk_id")).mapInArrow(make, "chunk_id long, embedding array<double>")
    index = vector_index.VectorIndex.write(rows, f"{tmp_path}/index")
    assert index.vectors.count() == 50 and made.value == 50


def test_named_blocks_grow_with_the_documents(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lexical_index, "DOCS_PER_BLOCK", 10)
    docs = spark.createDataFrame([(f"h{i}", f"t{i}", f"word{i % 9} und text") for i in range(100)], "content_hash string, title string, text string")
    index = lexical_index.LexicalIndex.write(docs, f"{tmp_path}/index", blocks=3)
    assert index.blocks == 10
    asked = spark.createDataFrame([("q", "word4 text")], "query_id string, question string")
    changed = docs.filter(F.col("content_hash").isin("h4", "h5")).withColumn("text", F.lit("word4 word4 only"))
    index.update(changed, removed=docs.filter("content_hash = 'h13'").select("content_hash"))
    now = docs.filter("content_hash NOT IN ('h4', 'h5', 'h13')").unionByName(changed)
    assert sorted(lexical_index.search_index(asked, index).collect()) == sorted(lexical.search(asked, now.withColumn("content_lang", F.lit("de"))).collect())
