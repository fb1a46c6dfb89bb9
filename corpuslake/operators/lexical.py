"""BM25 over articles: corpus statistics, index tables and batch search."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslake.functions.keys import first_filled
from corpuslake.functions.text import analyzed, analyzed_counts, best_fragment, lexical_query
from corpuslake.operators.best import TaskBest
from corpuslake.session import written
from corpuslake.settings import (
    ANALYZED_LANGS,
    BM25_B,
    BM25_K1,
    MAX_BROADCAST_ROWS,
    MIN_DEPTH,
    SCORE_DIGITS,
    TITLE_BOOST,
    UNKNOWN_LANG,
)

FIELDS = ("title", "text")
# A term no analysis yields; in a stored index its entries carry the lengths.
MARKER = ""
# Sizes of the blocks whose term weights are multiplied.
DOCS_PER_PRODUCT, QUERIES_PER_PRODUCT = 256, 256
#: Fields whose terms are looked up at a time.
FIELDS_PER_LOOKUP = 512


def lexical_documents(silver: DataFrame) -> DataFrame:
    """Index documents: empty strings for nulls, and copies of text per analysed language."""
    feed_lang = first_filled(F.col("feed_lang"), F.lit(UNKNOWN_LANG))
    lang = first_filled(F.col("content_lang"), feed_lang)
    filled = lambda name: F.coalesce(F.col(name), F.lit(""))
    copies = [
        F.when(lang == code, filled(field)).otherwise("").alias(f"{field}_{code}")
        for code in ANALYZED_LANGS
        for field in FIELDS
    ]
    return silver.select(
        "content_hash", "feed_id", feed_lang.alias("feed_lang"), lang.alias("content_lang"),
        filled("title").alias("title"), "text", *copies,
        filled("canonical_url").alias("canonical_url"), "bronze_s3_uri", "silver_s3_uri",
        filled("author").alias("author"), "parsed_at", "published",
    )


def search_fields(documents: DataFrame, lang: str | None) -> DataFrame:
    """``(content_hash, title, text)`` of the fields a search in ``lang`` uses.

    A language with its own analysis restricts the search to its articles; any other
    value searches the common fields of all of them.
    """
    if lang in ANALYZED_LANGS:
        documents = documents.filter(F.col("content_lang") == lang)
        return documents.select(
            "content_hash",
            F.col(f"title_{lang}").alias("title"),
            F.col(f"text_{lang}").alias("text"),
        )
    return documents.select("content_hash", "title", "text")


def field_terms(fields: DataFrame, lang: str | None = None, stemmer=None) -> DataFrame:
    """``(content_hash, field, dl, terms)`` for every field that has a token."""
    analysis = lang if lang in ANALYZED_LANGS else None
    arrays = F.array(
        *[
            F.struct(F.lit(f).alias("field"), analyzed_counts(F.col(f), analysis, stemmer).alias("counts"))
            for f in FIELDS
        ]
    )
    counted = fields.select("content_hash", F.inline(arrays))
    return counted.select("content_hash", "field", "counts.dl", "counts.terms").filter(F.col("dl") > 0)


def postings(terms: DataFrame) -> DataFrame:
    """``(content_hash, field, dl, term, tf)``: the inverted index, without a shuffle."""
    return terms.select("content_hash", "field", "dl", F.inline("terms"))


def term_stats(index: DataFrame) -> DataFrame:
    """Document frequency per field and term."""
    return index.groupBy("field", "term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


def field_stats(terms: DataFrame) -> DataFrame:
    """Number of documents that have the field, and their mean length."""
    return terms.groupBy("field").agg(
        F.count("*").alias("n_docs"), F.avg("dl").alias("avg_dl"), F.sum("dl").alias("n_tokens")
    )


def query_terms(
    questions: DataFrame,
    rewrite: bool = True,
    lang: str | None = None,
    stemmer: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """``(query_id, term)``: distinct analysed terms of ``(query_id, question)``."""
    text = lexical_query(F.col("question")) if rewrite else F.col("question")
    analysis = lang if lang in ANALYZED_LANGS else None
    return (
        questions.select("query_id", text.alias("_q"))
        .filter(F.col("_q").isNotNull())
        .select("query_id", F.explode(F.array_distinct(analyzed(F.col("_q"), analysis, stemmer))).alias("term"))
    )


MATCHED = "content_hash string, title_dl bigint, text_dl bigint, slots array<int>, tfs array<bigint>"


@dataclass(frozen=True)
class QueryBatch:
    """Queries with their terms: a term's place, and per query the places of its terms."""

    terms: list[str]
    queries: list
    places: list[np.ndarray]

    @classmethod
    def of(cls, pairs: list) -> QueryBatch:
        terms = sorted({p["term"] for p in pairs})
        place = {t: i for i, t in enumerate(terms)}
        by_query: dict = {}
        for p in pairs:
            by_query.setdefault(p["query_id"], []).append(place[p["term"]])
        return cls(terms, list(by_query), [np.array(v, np.int64) for v in by_query.values()])


def _matched(fields: DataFrame, batch: QueryBatch) -> DataFrame:
    """One row per document: field lengths, and the wanted terms it holds, by slot.

    A slot is a term's place, plus the number of terms for the text field. The fields
    of a document follow each other, so they are put together where they are.
    """
    shared = fields.sparkSession.sparkContext.broadcast(batch.terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(shared.value, pa.string())
        pending: list | None = None

        def out(rows: list) -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                ["content_hash", "title_dl", "text_dl", "slots", "tfs"],
            )

        for part in (batch.slice(at, FIELDS_PER_LOOKUP) for batch in batches for at in range(0, batch.num_rows, FIELDS_PER_LOOKUP)):
            rows = []
            terms = part.column("terms")
            entries = terms.flatten()
            at = pc.index_in(entries.field("term"), value_set=wanted)
            places = at.fill_null(-1).to_numpy(zero_copy_only=False)
            tfs = entries.field("tf").to_numpy(zero_copy_only=False)
            ends = np.cumsum(pc.list_value_length(terms).to_numpy(zero_copy_only=False))
            hashes, names = part.column("content_hash").to_pylist(), part.column("field").to_pylist()
            for i, dl in enumerate(part.column("dl").to_pylist()):
                if pending is None or pending[0] != hashes[i]:
                    if pending is not None:
                        rows.append(pending)
                    pending = [hashes[i], None, None, [], []]
                own = slice(ends[i - 1] if i else 0, ends[i])
                hit = places[own] >= 0
                is_text = names[i] != FIELDS[0]
                pending[2 if is_text else 1] = dl
                pending[3] = pending[3] + (places[own][hit] + is_text * len(wanted)).tolist()
                pending[4] = pending[4] + tfs[own][hit].tolist()
            if rows:
                yield out(rows)
        if pending is not None:
            yield out([pending])

    return fields.select("content_hash", "field", "dl", "terms").mapInArrow(run, MATCHED)


def _statistics(matched: DataFrame, n_terms: int) -> tuple[np.ndarray, list, list]:
    """Document frequency per slot, and documents and mean length per field."""
    frequencies = np.zeros(2 * n_terms)
    for row in matched.select(F.explode("slots").alias("slot")).groupBy("slot").count().collect():
        frequencies[row["slot"]] = row["count"]
    lengths = matched.agg(*[f(f"{n}_dl") for n in FIELDS for f in (F.count, F.avg)]).first()
    return frequencies, [lengths[0], lengths[2]], [lengths[1], lengths[3]]


class Scorer:
    """Scores of blocks of documents for a batch of queries, and the best ``k`` documents of each.

    ``statistics`` are the document frequency of every slot (a term's place, plus the
    number of terms for the text field) and each field's documents and mean length. Only
    the queries marked in ``chosen`` are answered.
    """

    def __init__(self, asked: QueryBatch, statistics: tuple, k: int, chosen: np.ndarray | None = None):
        frequencies, n_docs, self.avg_dl = statistics
        self.n, self.blocks = len(asked.terms), []
        for at in range(0, len(asked.queries), QUERIES_PER_PRODUCT):
            some = slice(at, at + QUERIES_PER_PRODUCT)
            own = None if chosen is None else chosen[some]
            if own is not None and not own.any():
                continue
            places = asked.places[some]
            used = np.unique(np.concatenate(places))
            column = np.full(self.n, -1)
            column[used] = np.arange(len(used))
            holds = np.zeros((len(used), len(places)))
            for q, terms in enumerate(places):
                holds[column[terms], q] = 1
            self.blocks.append((column, holds, own, TaskBest(asked.queries[some], k)))
        self.idf = np.concatenate([
            np.log1p((d - f + 0.5) / (f + 0.5)) for d, f in zip(n_docs, np.split(frequencies, 2), strict=True)
        ]) if self.n else np.zeros(0)

    def scores(self, n_rows: int, row: np.ndarray, slots: np.ndarray, tf: np.ndarray, dl: np.ndarray) -> Iterator[tuple]:
        """Per block of queries, its best rows so far and the scores of ``n_rows`` rows; entries have a row, slot, count and length."""
        is_text = slots >= self.n
        length = dl / np.where(is_text, self.avg_dl[1] or 1, self.avg_dl[0] or 1)
        weight = self.idf[slots] * tf / (tf + BM25_K1 * (1 - BM25_B + BM25_B * length))
        for column, holds, own, best in self.blocks:
            score = np.zeros((n_rows, holds.shape[1]))
            for picked, boost in ((~is_text, TITLE_BOOST), (is_text, 1.0)):
                where = column[slots[picked] % self.n] if self.n else slots[picked]
                inside = where >= 0
                weights = np.zeros((n_rows, len(holds)))
                weights[row[picked][inside], where[inside]] = weight[picked][inside]
                score = np.maximum(score, boost * (weights @ holds))
            yield best, score if own is None else np.where(own, score, 0)

    def add(self, row: np.ndarray, slots: np.ndarray, tf: np.ndarray, dl: np.ndarray, keys: pa.Array) -> None:
        for best, score in self.scores(len(keys), row, slots, tf, dl):
            best.add(np.where(score > 0, np.round(score, SCORE_DIGITS), -np.inf), keys)

    def batch(self, id_type: T.DataType) -> pa.RecordBatch:
        """What was kept, as (query_id, content_hash, score)."""
        found = [r for *_, best in self.blocks for r in best.rows()]
        ids, keys, scores = zip(*found, strict=True) if found else ((), (), ())
        kind = pa.string() if id_type == T.StringType() else pa.int64()
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, kind), pa.array(keys, pa.string()), pa.array(scores, pa.float64())], ["query_id", "content_hash", "score"]
        )


def _best_documents(matched: DataFrame, batch: QueryBatch, statistics: tuple, k: int, id_type: T.DataType) -> DataFrame:
    """Each task's own best ``k`` documents per query.

    A block of documents is a matrix of term weights; its product with the terms of a
    block of queries gives their scores. What leaves a task is bounded by ``k`` and the
    number of queries; no (query, document) or (query, posting) row is ever made.
    """
    schema = T.StructType([
        T.StructField("query_id", id_type), T.StructField("content_hash", T.StringType()), T.StructField("score", T.DoubleType())
    ])
    shared = matched.sparkSession.sparkContext.broadcast((batch, statistics))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, known = shared.value
        scorer, n = Scorer(asked, known, k), len(asked.terms)
        for part in batches:
            for start in range(0, part.num_rows, DOCS_PER_PRODUCT):
                some = part.slice(start, DOCS_PER_PRODUCT)
                slots = some.column("slots").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                tf = some.column("tfs").flatten().to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(some.num_rows), pc.list_value_length(some.column("slots")).to_numpy(zero_copy_only=False))
                dl = [np.nan_to_num(some.column(f"{f}_dl").cast(pa.float64()).to_numpy(zero_copy_only=False)) for f in FIELDS]
                scorer.add(row, slots, tf, np.where(slots >= n, dl[1][row], dl[0][row]), some.column("content_hash"))
        yield scorer.batch(id_type)

    return matched.mapInArrow(run, schema)


def top_k(scored: DataFrame, k: int, key: str) -> DataFrame:
    """Best ``k`` rows per query; each task keeps only its own best before the shuffle."""
    window = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc(key))
    return scored.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def query_batches(terms: DataFrame, max_pairs: int) -> Iterator[QueryBatch]:
    """The queries in as many batches as their counted (query, term) pairs need, each bounded."""
    count = max(1, -(-terms.count() // max_pairs))
    numbered = terms.withColumn("_b", F.pmod(F.xxhash64("query_id"), F.lit(count)))
    for number in range(count):
        yield QueryBatch.of(numbered.filter(F.col("_b") == number).select("query_id", "term").collect())


def answered(spark, parts: list[DataFrame], k: int, id_type: T.DataType) -> DataFrame:
    if not parts:
        schema = T.StructType([T.StructField("query_id", id_type), T.StructField("content_hash", T.StringType()), T.StructField("score", T.DoubleType())])
        parts = [spark.createDataFrame([], schema)]
    return top_k(reduce(DataFrame.unionByName, parts), k, "content_hash")


def search(
    questions: DataFrame,
    documents: DataFrame,
    k: int = MIN_DEPTH,
    lang: str | None = None,
    rewrite: bool = False,
    stemmer: Callable[[Column], Column] | None = None,
    max_pairs: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """``(query_id, content_hash, score, rank)`` for a batch of questions.

    ``documents`` are those of :func:`lexical_documents`. One pass analyses them and
    stores, per document, its lengths and the wanted terms it holds; a pass over that
    small table scores. The terms go to all tasks in batches of ``max_pairs`` counted
    (query, term) pairs; more queries take more passes of the same kind.
    """
    terms = query_terms(questions, rewrite, lang, stemmer)
    fields = field_terms(search_fields(documents, lang), lang, stemmer)
    id_type, parts = questions.schema["query_id"].dataType, []
    for batch in query_batches(terms, max_pairs):
        if batch.queries:
            matched = written(_matched(fields, batch), "matches")
            statistics = _statistics(matched, len(batch.terms))
            parts.append(_best_documents(matched, batch, statistics, k, id_type))
    return answered(questions.sparkSession, parts, k, id_type)


def with_hits(
    ranked: DataFrame, documents: DataFrame, questions: DataFrame, rewrite: bool = False, lang: str | None = None
) -> DataFrame:
    """Add the article's metadata and a snippet to ranked hits.

    The snippet is the fragment with most of the question's terms, as the search analyses
    them. Hits are at most ``k`` per question; they are stored first, so that Spark knows
    their size and scans the corpus past them rather than shuffle it.
    """
    ranked = written(ranked, "hits")
    asked = query_terms(questions, rewrite, lang).groupBy("query_id").agg(F.collect_set("term").alias("_terms"))
    hits = ranked.join(asked, "query_id").join(
        documents.select(
            "content_hash", "feed_id", "title", "content_lang", "canonical_url",
            "silver_s3_uri", "text",
        ),
        "content_hash",
    )
    analysis = lang if lang in ANALYZED_LANGS else None
    return hits.withColumn("snippet", best_fragment(F.col("text"), F.col("_terms"), analysis)).drop("text", "_terms")


def count_documents(documents: DataFrame | None) -> int:
    return 0 if documents is None else documents.count()
