"""Hybrid retrieval: two ranked lists, rank fusion and the relevance gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslake.functions.keys import blank_to_null
from corpuslake.operators import encode, lexical, lexical_index, vector
from corpuslake.settings import (
    LABEL_TITLE_CHARS,
    PASSAGE_KEY_CHARS,
    RRF_K,
    SEARCH_TEXT_CHARS,
    UNTITLED,
    RetrievalSettings,
)

LEXICAL, VECTOR = "bm25", "vector"
METADATA = ("content_hash", "feed_id", "title", "content_lang", "canonical_url", "silver_s3_uri")
# A list position: lists in order, then ranks inside them.
LIST_STRIDE = 1_000_000


def lexical_passages(hits: DataFrame) -> DataFrame:
    """Article hits in the common passage shape; an article hit has no chunk index."""
    return hits.select(
        "query_id", F.lit(0).alias("list"), "rank", F.col("snippet").alias("text"),
        F.lit(LEXICAL).alias("source"), F.lit(None).cast("int").alias("chunk_index"), *METADATA,
        F.col("score").alias("lexical_score"), F.lit(None).cast("double").alias("vector_score"),
    )


def vector_passages(hits: DataFrame) -> DataFrame:
    return hits.select(
        "query_id", F.lit(1).alias("list"), "rank", F.coalesce("text", F.lit("")).alias("text"),
        F.lit(VECTOR).alias("source"), "chunk_index", *METADATA,
        F.lit(None).cast("double").alias("lexical_score"), F.col("score").alias("vector_score"),
    )


def passage_key() -> Column:
    """Chunk, else article, else object, else the start of the text."""
    return F.coalesce(
        F.concat(F.col("content_hash"), F.lit(":"), F.col("chunk_index").cast("string")),
        F.concat(blank_to_null(F.col("content_hash")), F.lit(":article")),
        blank_to_null(F.col("silver_s3_uri")),
        F.substring("text", 1, PASSAGE_KEY_CHARS),
    )


def citation_label(title: Column, chunk_index: Column) -> Column:
    short = F.substring(F.coalesce(blank_to_null(title), F.lit(UNTITLED)), 1, LABEL_TITLE_CHARS)
    return F.when(
        chunk_index.isNotNull(), F.concat(short, F.lit(" [chunk "), chunk_index.cast("string"), F.lit("]"))
    ).otherwise(short)


def _earliest(name: str, at: Column) -> Column:
    """The value of the earliest passage that has one (empty text and 0 do not count)."""
    empty = F.lit(0.0) if name.endswith("_score") else F.lit("")
    value = F.nullif(F.col(name), empty)
    return F.min_by(value, F.when(value.isNotNull(), at)).alias(name)


def fuse(passages: DataFrame, limit: int, rrf_k: int = RRF_K) -> DataFrame:
    """Fuse the ranked lists of every query by reciprocal ranks and cut to ``limit``.

    Passages with one key are merged: scores add up, the longest text wins, other
    fields come from the earliest passage that has them. A query with a single
    non-empty list keeps that list's raw scores and order. Groups hold at most one
    depth of passages per list.
    """
    at = F.col("list") * LIST_STRIDE + F.col("rank")
    per_query = Window.partitionBy("query_id")
    lists = (F.min("list").over(per_query) != F.max("list").over(per_query)).alias("_both")
    keyed = passages.select("*", lists).withColumn(
        # Without fusion nothing is merged, so every passage is its own group.
        "_key", F.when(F.col("_both"), passage_key()).otherwise(at.cast("string"))
    )
    sources = F.array_sort(F.collect_list(F.struct(at.alias("at"), F.col("source"))))
    merged = keyed.groupBy("query_id", "_both", "_key").agg(
        F.sum(1.0 / (rrf_k + F.col("rank"))).alias("_rrf"),
        F.min(at).alias("_at"),
        F.max_by("text", F.struct(F.length("text"), -at)).alias("text"),
        F.array_join(F.array_distinct(F.transform(sources, lambda s: s["source"])), "+").alias("sources"),
        F.max_by("chunk_index", F.when(F.col("chunk_index").isNotNull(), at)).alias("chunk_index"),
        *[_earliest(c, at) for c in (*METADATA, "lexical_score", "vector_score")],
    )
    raw = F.coalesce("lexical_score", "vector_score", F.lit(0.0))
    score = F.round(F.when(F.col("_both"), F.col("_rrf")).otherwise(raw), 9)
    ranked = merged.withColumn("score", score)
    best = Window.partitionBy("query_id").orderBy(
        F.when(F.col("_both"), F.col("score")).desc(), F.asc("_at")
    )
    return (
        ranked.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= limit)
        .drop("_both", "_key", "_rrf", "_at")
    )


def relevant(passages: DataFrame, min_vector_score: float) -> DataFrame:
    """Drop passages found by similarity alone below the threshold; 0 keeps all."""
    if min_vector_score <= 0:
        return passages
    lexical_hit = F.array_contains(F.split("sources", r"\+"), LEXICAL)
    return passages.filter(lexical_hit | (F.col("vector_score") >= min_vector_score))


def numbered(passages: DataFrame) -> DataFrame:
    """Number the passages of every query 1..n in rank order."""
    order = Window.partitionBy("query_id").orderBy("rank")
    return passages.withColumn("n", F.row_number().over(order))


def hybrid_retrieve(
    questions: DataFrame,
    documents: DataFrame,
    chunk_vectors: DataFrame,
    settings: RetrievalSettings | None = None,
    encoder: encode.EncoderFactory | None = None,
    index: lexical_index.LexicalIndex | None = None,
    payload: DataFrame | None = None,
) -> DataFrame:
    """Passages for a batch of ``(query_id, question)``, best first.

    The cut to ``top_k`` precedes the relevance gate, so a query may keep fewer.
    ``documents`` are lexical documents and ``chunk_vectors`` chunks with an
    ``embedding``; a stored ``index`` replaces the scan of the documents. ``payload``
    holds the chunks' texts where ``chunk_vectors`` does not.
    """
    settings = settings or RetrievalSettings()
    if index is not None and settings.lexical and index.lang != settings.lang:
        raise ValueError(f"the index holds language {index.lang!r}, the search asks for {settings.lang!r}")
    branches = []
    if settings.lexical:
        depth = settings.per_engine
        ranked = (
            lexical_index.search_index(questions, index, depth, rewrite=True)
            if index is not None
            else lexical.search(questions, documents, depth, settings.lang, rewrite=True)
        )
        branches.append(lexical_passages(lexical.with_hits(ranked, documents, questions, True, settings.lang)))
    if settings.vector:
        wanted = encode.encode(questions, "question", "embedding", encoder)
        ranked = vector.cosine_top_k(wanted, chunk_vectors, settings.per_engine, settings.lang)
        branches.append(vector_passages(vector.with_payload(ranked, chunk_vectors if payload is None else payload)))
    passages = branches[0] if len(branches) == 1 else branches[0].unionByName(branches[1])
    return relevant(fuse(passages, settings.top_k, settings.rrf_k), settings.min_vector_score)


def search_response(passages: DataFrame) -> DataFrame:
    """The public search row: rounded score and at most 800 characters of text."""
    return passages.select(
        "query_id", "rank", "title", F.round("score", 4).alias("score"), "sources",
        "content_hash", "chunk_index", "feed_id", "content_lang", "canonical_url",
        "silver_s3_uri", F.substring(F.coalesce("text", F.lit("")), 1, SEARCH_TEXT_CHARS).alias("text"),
    )


def reject_blank(questions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split questions into trimmed usable ones and blank ones with an error."""
    trimmed = questions.withColumn("question", F.trim("question"))
    blank = F.coalesce(F.col("question"), F.lit("")) == ""
    return trimmed.filter(~blank), trimmed.filter(blank).withColumn("error", F.lit("empty query"))


