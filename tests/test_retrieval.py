import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuslake.operators import encode, fusion, lexical, lexical_index, vector
from corpuslake.settings import RetrievalSettings

WORDS = "crue népal himalaya pluie fleuve pont route village secours météo".split()


def corpus(spark, n=60, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        title = " ".join(rng.choices(WORDS, k=rng.randint(0, 3)))
        body = " ".join(rng.choices(WORDS + ["le", "la"], k=rng.randint(1, 40)))
        rows.append((f"h{i:03d}", title, body, rng.choice(["fr", "en"]), f"f{i % 3}", f"u{i}", f"s3://l/silver/{i}"))
    schema = "content_hash string, title string, text string, content_lang string, feed_id string, canonical_url string, silver_s3_uri string"
    df = spark.createDataFrame(rows, schema)
    docs = df.withColumns(
        {
            f"{c}_{lang}": F.when(F.col("content_lang") == lang, F.col(c)).otherwise("")
            for c in ("title", "text") for lang in ("fr", "en")
        }
    )
    return docs, rows


def brute_bm25(rows, query, k):
    fields = {"title": {r[0]: r[1].split() for r in rows}, "text": {r[0]: r[2].split() for r in rows}}
    best = {}
    for name, boost in (("title", 2.0), ("text", 1.0)):
        held = {h: t for h, t in fields[name].items() if t}
        n, avg = len(held), sum(map(len, held.values())) / len(held)
        total = {}
        for term in set(query.split()):
            df = sum(term in t for t in held.values())
            for h, t in held.items():
                tf = t.count(term)
                if tf:
                    idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
                    w = idf * tf / (tf + 1.2 * (0.25 + 0.75 * len(t) / avg))
                    total[h] = total.get(h, 0.0) + w
        for h, s in total.items():
            best[h] = max(best.get(h, 0.0), boost * s)
    return sorted(((round(s, 6), h) for h, s in best.items()), key=lambda x: (-x[0], x[1]))[:k]


QUERIES = [(1, "crue népal"), (2, "pont route village secours"), (3, "absent"), (4, "le la météo")]


def ranked(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.score, r[1]))
    return out


@pytest.mark.parametrize("max_pairs", [1000, 2])
def test_bm25_equals_brute_force(spark, max_pairs):
    docs, rows = corpus(spark)
    asked = spark.createDataFrame(QUERIES, "query_id long, question string")
    got = ranked(lexical.search(asked, docs, 7, max_pairs=max_pairs).select("query_id", "content_hash", "score", "rank"))
    want = {q: brute_bm25(rows, text, 7) for q, text in QUERIES}
    assert got == {q: v for q, v in want.items() if v}


@pytest.mark.parametrize("max_pairs", [1000, 2])
def test_stored_index_gives_the_same(spark, tmp_path, max_pairs):
    docs, _ = corpus(spark)
    asked = spark.createDataFrame(QUERIES, "query_id long, question string")
    lexical_index.LexicalIndex.write(docs, str(tmp_path), blocks=4)
    index = lexical_index.LexicalIndex.read(spark, str(tmp_path))
    cols = ["query_id", "content_hash", "score", "rank"]
    assert ranked(lexical_index.search_index(asked, index, 7, max_pairs=max_pairs).select(cols)) == ranked(
        lexical.search(asked, docs, 7).select(cols)
    )


def test_language_search_uses_its_fields(spark):
    docs, rows = corpus(spark)
    asked = spark.createDataFrame([(1, "le népal")], "query_id long, question string")
    found = lexical.search(asked, docs, 50, lang="fr").join(docs, "content_hash").collect()
    assert {r.content_lang for r in found} == {"fr"}
    other = lexical.search(asked, docs, 50, lang="de").join(docs, "content_hash").collect()
    assert {r.content_lang for r in other} == {"fr", "en"}


def test_hits_show_a_matched_term(spark):
    docs, _ = corpus(spark)
    asked = spark.createDataFrame([(1, "crue")], "query_id long, question string")
    hits = lexical.with_hits(lexical.search(asked, docs, 5), docs, asked).collect()
    assert hits and all("crue" in r.snippet or "crue" in r.title for r in hits)


def vectors(spark, n=500, d=8, seed=1):
    rng = np.random.default_rng(seed)
    m = rng.integers(-2, 3, (n, d)).astype(float)  # small integers give many ties
    df = spark.createDataFrame(
        [(f"c{i:04d}", "fr" if i % 2 else "en", m[i].tolist()) for i in range(n)],
        "chunk_id string, content_lang string, embedding array<float>",
    ).repartition(7)
    return df, m


@pytest.mark.parametrize("max_block", [100, 3])
def test_cosine_equals_brute_force(spark, max_block):
    df, m = vectors(spark)
    q = np.random.default_rng(2).integers(-2, 3, (10, 8)).astype(float)
    asked = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "query_id long, embedding array<float>")
    got = ranked(vector.cosine_top_k(asked, df, 6, max_block=max_block).select("query_id", "chunk_id", "score", "rank"))
    scores = np.round(vector.unit_rows(q) @ vector.unit_rows(m).T, 6) + 0.0
    for i in range(10):
        want = sorted(((s, f"c{j:04d}") for j, s in enumerate(scores[i])), key=lambda x: (-x[0], x[1]))[:6]
        assert got[i] == want


def test_cosine_filters_any_language_first(spark):
    df, _ = vectors(spark)
    asked = df.limit(1).select(F.lit(1).cast("long").alias("query_id"), "embedding")
    found = vector.cosine_top_k(asked, df, 300, lang="fr").join(df, "chunk_id")
    assert found.count() == 250 and found.filter("content_lang <> 'fr'").isEmpty()
    assert vector.cosine_top_k(asked, df, 5, lang="xx").isEmpty()


def test_no_queries_no_rows(spark):
    df, _ = vectors(spark)
    none = spark.createDataFrame([], "query_id long, embedding array<float>")
    assert vector.cosine_top_k(none, df, 5).isEmpty()


def test_encoder_contract(spark):
    df = spark.createDataFrame([(1, "a b"), (2, ""), (3, None)], "id int, text string")
    rows = encode.encode(df, encoder=encode.hashing_encoder(16)).orderBy("id").collect()
    assert [len(r.embedding) for r in rows] == [16] * 3
    assert abs(sum(x * x for x in rows[0].embedding) - 1) < 1e-6 and not any(rows[1].embedding)

    def own():
        return lambda texts: np.ones((len(texts), 3))

    assert encode.collection_dimension(encode.encode(df, encoder=own)) == 3
    mixed = spark.createDataFrame([([1.0],), ([1.0, 2.0],)], "embedding array<float>")
    with pytest.raises(ValueError):
        encode.collection_dimension(mixed)


# --- fusion -------------------------------------------------------------------

PASSAGE = (
    "query_id long, list int, rank int, text string, source string, chunk_index int, content_hash string, "
    "feed_id string, title string, content_lang string, canonical_url string, silver_s3_uri string, "
    "lexical_score double, vector_score double"
)


def passage(q, list_, rank, text="t", chunk=None, digest="h", title=None, uri=None, lex=None, vec=None):
    return (q, list_, rank, text, ("bm25", "vector")[list_], chunk, digest, None, title, None, None, uri, lex, vec)


def fuse(spark, rows, limit=10):
    return fusion.fuse(spark.createDataFrame(rows, PASSAGE), limit).orderBy("query_id", "rank").collect()


def test_article_and_chunk_of_one_article_stay_apart(spark):
    rows = fuse(spark, [passage(1, 0, 1, lex=3.0), passage(1, 1, 1, chunk=0, vec=0.9)])
    assert [(r.sources, r.score) for r in rows] == [("bm25", round(1 / 61, 9)), ("vector", round(1 / 61, 9))]


def test_equal_keys_merge(spark):
    rows = fuse(
        spark,
        [
            passage(1, 0, 2, "short", digest=None, uri="u", lex=2.0),
            passage(1, 1, 1, "a longer text", digest=None, uri="u", title="T", vec=0.5),
            passage(1, 0, 1, "other", digest="x", lex=5.0),
        ],
    )
    merged = rows[0]
    assert merged.sources == "bm25+vector" and merged.text == "a longer text" and merged.title == "T"
    assert merged.score == round(1 / 62 + 1 / 61, 9)
    assert (merged.lexical_score, merged.vector_score) == (2.0, 0.5)


def test_single_list_keeps_raw_scores(spark):
    rows = fuse(spark, [passage(1, 1, i, chunk=0, digest="same", vec=1 - i / 10) for i in (1, 2, 3)], limit=2)
    assert [(r.rank, r.score) for r in rows] == [(1, 0.9), (2, 0.8)]


def test_fusion_is_per_query(spark):
    rows = fuse(spark, [passage(1, 0, 1, lex=3.0), passage(2, 1, 1, chunk=1, vec=0.4)])
    assert [(r.query_id, r.score) for r in rows] == [(1, 3.0), (2, 0.4)]


def test_passage_key_cascade(spark):
    df = spark.createDataFrame(
        [passage(1, 0, 1), passage(2, 1, 1, chunk=3), passage(3, 0, 1, digest="", uri="u"), passage(4, 0, 1, "x" * 90, digest=None)],
        PASSAGE,
    )
    keys = [r[0] for r in df.orderBy("query_id").select(fusion.passage_key()).collect()]
    assert keys == ["h:article", "h:3", "u", "x" * 80]


@pytest.mark.parametrize("threshold,kept", [(0.45, 2), (0.0, 3), (0.9, 1)])
def test_gate(spark, threshold, kept):
    rows = [passage(1, 0, 1, lex=1.0), passage(1, 1, 1, chunk=0, vec=0.44), passage(1, 1, 2, chunk=1, vec=0.45)]
    fused = fusion.fuse(spark.createDataFrame(rows, PASSAGE), 10)
    assert fusion.relevant(fused, threshold).count() == kept


def test_settings_are_clamped():
    assert RetrievalSettings(top_k=99).top_k == 20 and RetrievalSettings(top_k=0).top_k == 1
    assert RetrievalSettings(min_vector_score=7).min_vector_score == 1.0
    assert RetrievalSettings(top_k=4).per_engine == 10 and RetrievalSettings(top_k=15).per_engine == 15
    assert RetrievalSettings(depth=3).per_engine == 3
    with pytest.raises(ValueError):
        RetrievalSettings(lexical=False, vector=False)


def test_blank_questions_are_rejected(spark):
    df = spark.createDataFrame([(1, " x "), (2, "  "), (3, None)], "query_id long, question string")
    good, bad = fusion.reject_blank(df)
    assert [r.question for r in good.collect()] == ["x"] and bad.count() == 2


def test_a_search_needs_an_index_of_its_language(spark, tmp_path):
    docs, _ = corpus(spark)
    lexical_index.LexicalIndex.write(docs, str(tmp_path), lang="fr", blocks=2)
    index = lexical_index.LexicalIndex.read(spark, str(tmp_path), "fr")
    asked = spark.createDataFrame(QUERIES, "query_id long, question string")
    with pytest.raises(ValueError):
        fusion.hybrid_retrieve(asked, docs, None, RetrievalSettings(vector=False), index=index)
