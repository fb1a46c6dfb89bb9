"""The engine's tables derived from the given data set (documents, pages, events, …)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslake.functions import keys
from corpuslake.operators import chunking, encode, lexical
from corpuslake.session import spread, written
from corpuslake.settings import STATUSES

BUCKET = "lake"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """A table with long texts, spread over all cores when it is a single split."""
    return spread(read(spark, sf_dir, name))


def _minutes(n: Column) -> Column:
    return F.timestamp_add("MINUTE", n, F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")))


def _keyed(d: DataFrame) -> DataFrame:
    """Documents with the catalog's identity columns."""
    key = F.concat(F.lit("doc-"), F.col("doc_id"))
    return d.select(
        "*", key.alias("item_key"), keys.content_hash(key).alias("content_hash"),
        F.date_format(_minutes(F.col("doc_id")), "yyyy-MM-dd").alias("dt"),
        F.regexp_extract("text", r"^[^.\n]*", 0).alias("title"),
    )


def _uri(layer: str) -> Column:
    return keys.object_uri(
        BUCKET, keys.object_key(layer, F.col("source"), F.col("dt"), F.col("content_hash"))
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog: one row per document, fetched a minute apart, statuses in turn.

    English rows carry no feed language, so that it is looked up in the registry.
    """
    d = _keyed(read(spark, sf_dir, "documents"))
    status = F.element_at(
        F.array(*[F.lit(s) for s in STATUSES]), (F.col("doc_id") % len(STATUSES) + 1).cast("int")
    )
    return d.select(
        F.col("doc_id").alias("id"), F.col("source").alias("feed_id"),
        F.concat(F.lit("https://x.example/"), F.col("doc_id")).alias("url"), "item_key",
        "content_hash", _uri("bronze").alias("s3_uri"),
        F.when(status != "fetched", _uri("silver")).alias("silver_s3_uri"), "title",
        _minutes(F.col("doc_id")).alias("published_at"), status.alias("status"),
        _minutes(F.col("doc_id") + 60).alias("fetched_at"),
        _minutes(F.col("doc_id") + 60).alias("updated_at"),
        F.when(F.col("lang") != "en", F.col("lang")).alias("feed_lang"),
        F.when(status != "fetched", F.col("lang")).alias("content_lang"),
    )


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver documents: the whole texts in their labelled language."""
    d = _keyed(text_table(spark, sf_dir))
    return d.select(
        "doc_id", F.lit(1).alias("schema_version"), F.col("source").alias("feed_id"), "content_hash",
        "title", F.concat(F.lit("https://x.example/"), F.col("doc_id")).alias("canonical_url"),
        F.lit(None).cast("string").alias("author"), F.col("dt").alias("published"),
        F.concat(F.col("dt"), F.lit("T00:00:00+00:00")).alias("parsed_at"), "text",
        F.lit("rss_summary").alias("text_source"), _uri("bronze").alias("bronze_s3_uri"),
        F.col("lang").alias("feed_lang"), F.col("lang").alias("content_lang"),
        F.lit(None).cast("double").alias("content_lang_confidence"), "dt",
        _uri("silver").alias("silver_s3_uri"),
    )


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed entries: keys by id, guid or link depending on the language.

    Copies of one text share guid and url, within a feed and across feeds.
    """
    d = read(spark, sf_dir, "documents")
    digest = F.sha2("text", 256)
    none = F.lit(None).cast("string")
    lang = F.col("lang")
    return d.select(
        "doc_id", F.col("source").alias("feed_id"),
        F.regexp_extract("text", r"^[^.\n]*", 0).alias("title"),
        F.concat(F.lit("https://x.example/"), digest).alias("link"),
        F.when(lang == "en", "").when(lang == "de", F.concat(F.lit("id-"), "doc_id", F.lit(" "))).alias("id"),
        F.when(lang != "es", F.concat(F.lit(" "), digest)).alias("guid"),
        F.col("text").alias("summary"), none.alias("published"), none.alias("updated"),
        none.alias("author"), _minutes(F.col("doc_id")).alias("published_ts"),
        "lang",
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds: one row per source; a source's language is the first in the alphabet."""
    return (
        read(spark, sf_dir, "documents").groupBy(F.col("source").alias("id"))
        .agg(F.min("lang").alias("lang"))
    )


def worker_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(
        F.col("event_type").alias("job"), F.col("ts").alias("finished_at"),
        F.col("value").cast("int").alias("new_items"),
        F.get_json_object("props", "$.k").cast("int").alias("errors"),
    )


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("question")
    )


def lexical_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.lexical_documents(silver(spark, sf_dir))


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.silver_chunks(silver(spark, sf_dir))


def chunk_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunk vectors with the columns a search filters and orders by."""
    return encode.encode(chunks(spark, sf_dir).select("chunk_id", "content_lang", "text")).drop("text")


def stored_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks with vectors and texts, encoded once and stored; searches read what they need."""
    return written(encode.encode(chunks(spark, sf_dir)), "chunks")


def eval_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation cases: questions paired with the labels of equal number."""
    labels = read(spark, sf_dir, "labels")
    return (
        read(spark, sf_dir, "benchmark").join(labels, F.col("item_id") == F.col("doc_id"), "left")
        .select(
            F.col("item_id").alias("case_id"), F.col("text").alias("question"),
            F.when(F.col("quality") == 1, "grounded").otherwise("refuse").alias("expect"),
            F.when(F.col("toxic") == 1, "hard").otherwise("one_shot").alias("difficulty"),
        )
    )


def generated_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers written elsewhere: the first assistant turn of a conversation."""
    turns = read(spark, sf_dir, "conversations").filter(F.col("role") == "assistant")
    return turns.groupBy(F.col("conv_id").alias("query_id")).agg(
        F.min_by("text", "turn").alias("answer")
    )
