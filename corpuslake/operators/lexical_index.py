"""A stored BM25 index by blocks of documents: building, updating and bounded search.

A document belongs to a block by the hash of its id, and a block is a partition of the
index table. It holds, per field and term, which of its documents have the term and how
often, with the sums and extremes that searches and statistics need. A changed document
touches one block, so an update rewrites the touched partitions and no other, and the
statistics of the corpus are sums over blocks. A search first bounds the best score that
any document of a block can have for a query; blocks that can't reach a query's k-th
score are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslake.operators.best import TaskBest
from corpuslake.operators.lexical import (
    FIELDS,
    MARKER,
    QueryBatch,
    Scorer,
    answered,
    field_terms,
    query_batches,
    query_terms,
    search_fields,
    top_k,
)
from corpuslake.session import written
from corpuslake.settings import COMPRESSION, MAX_BROADCAST_ROWS, MIN_DEPTH, SCORE_DIGITS

#: A block is built, updated and searched whole by one task, so this bounds a task's memory.
DOCS_PER_BLOCK = 2_048
#: Blocks that every query reads first; their best scores are what the others have to reach.
PROBED = 2
DOCS_PER_PRODUCT = 256
#: Partitions are named to the scan one by one up to so many; more are joined.
MAX_NAMED_BLOCKS = 10_000

LISTS = (
    "doc_block int, field string, term string, df bigint, cf bigint, max_tf bigint, min_dl bigint, "
    "docs array<int>, tfs array<bigint>, hashes array<string>"
)
_LIST_TYPES = [
    pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(),
    pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.string()),
]
_LIST_NAMES = [f.strip().split(" ")[0] for f in LISTS.split(", ")]


def doc_block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


@dataclass
class _Entries:
    """The postings of a block, one entry per document, field and term, and each field's lengths."""

    hashes: list[str]
    doc: np.ndarray
    field: np.ndarray
    term: pa.Array
    tf: np.ndarray
    lengths: np.ndarray  # a row per field; 0 where a document lacks it

    @classmethod
    def of_documents(cls, rows: pa.Table) -> _Entries:
        """From rows of (content_hash, field, dl, terms); a second row of a document's field is passed over."""
        names, fields = rows.column("content_hash").to_pylist(), rows.column("field").to_pylist()
        place = {h: i for i, h in enumerate(dict.fromkeys(h for h, f in zip(names, fields, strict=True) if f is not None))}
        seen: set = set()
        kept = [i for i, pair in enumerate(zip(names, fields, strict=True)) if pair[1] is not None and not (pair in seen or seen.add(pair))]
        rows = rows.take(pa.array(kept, pa.int64()))
        doc = np.array([place[names[i]] for i in kept], np.int64)
        field = np.array([FIELDS.index(fields[i]) for i in kept], np.int64)
        lengths = np.zeros((len(FIELDS), len(place)), np.int64)
        lengths[field, doc] = rows.column("dl").to_numpy()
        terms = rows.column("terms").combine_chunks()
        terms = terms if isinstance(terms, pa.Array) else pa.concat_arrays(terms.chunks)
        of = np.repeat(np.arange(len(kept)), pc.list_value_length(terms).to_numpy(zero_copy_only=False).astype(np.int64))
        flat = terms.flatten()
        return cls(list(place), doc[of], field[of], flat.field("term"), flat.field("tf").to_numpy(zero_copy_only=False).astype(np.int64), lengths)

    @classmethod
    def of_lists(cls, lists: pa.Table, gone: set) -> _Entries:
        """From a block's stored lists, without the documents in ``gone``."""
        terms = np.array(lists.column("term").to_pylist(), object)
        fields = np.array([FIELDS.index(f) if f else -1 for f in lists.column("field").to_pylist()], np.int64)
        held: list[str] = []
        for row in np.flatnonzero(fields < 0):
            held = lists.column("hashes")[int(row)].as_py() or []
        stays = np.array([h not in gone for h in held], bool)
        place = np.cumsum(stays) - 1
        columns = [lists.column(c).combine_chunks() for c in ("docs", "tfs")]
        columns = [c if isinstance(c, pa.Array) else pa.concat_arrays(c.chunks) for c in columns]
        of = np.repeat(np.arange(len(terms)), pc.list_value_length(columns[0]).to_numpy(zero_copy_only=False).astype(np.int64))
        docs, tfs = (c.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in columns)
        left = stays[docs] if len(held) else np.zeros(0, bool)
        of, docs, tfs = of[left], place[docs[left]] if len(held) else docs[:0], tfs[left]
        length = terms[of] == MARKER
        lengths = np.zeros((len(FIELDS), int(stays.sum())), np.int64)
        lengths[fields[of[length]], docs[length]] = tfs[length]
        kept = of[~length]
        return cls(
            [h for h, s in zip(held, stays, strict=True) if s], docs[~length], fields[kept],
            pa.array(terms[kept].tolist(), pa.string()), tfs[~length], lengths,
        )

    def with_more(self, other: _Entries) -> _Entries:
        return _Entries(
            self.hashes + other.hashes, np.concatenate([self.doc, other.doc + len(self.hashes)]), np.concatenate([self.field, other.field]),
            pa.concat_arrays([a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a for a in (self.term, other.term)]),
            np.concatenate([self.tf, other.tf]), np.concatenate([self.lengths, other.lengths], axis=1),
        )

    def lists(self, block: int) -> pa.Table:
        """The rows stored for the block: its documents, each field's lengths, and a list per field and term."""
        names = pc.dictionary_encode(self.term)
        codes, words = names.indices.to_numpy(zero_copy_only=False).astype(np.int64), names.dictionary.to_pylist()
        sorted_words = sorted(range(len(words)), key=words.__getitem__)
        rank = np.empty(len(words), np.int64)
        rank[sorted_words] = np.arange(len(words))
        codes = rank[codes] if len(words) else codes
        order = np.lexsort((self.doc, self.field, codes))
        code, field, doc, tf = codes[order], self.field[order], self.doc[order], self.tf[order]
        start = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (field[1:] != field[:-1])])) if len(code) else np.zeros(0, np.int64)
        ends = np.append(start, len(code))
        lengths = self.lengths[field, doc]
        has = [np.flatnonzero(own) for own in self.lengths]
        columns = {
            "field": ["", *FIELDS, *[FIELDS[f] for f in field[start]]],
            "term": [MARKER] * (1 + len(FIELDS)) + [words[sorted_words[c]] for c in code[start]],
            "df": np.concatenate([[len(self.hashes)], [len(h) for h in has], np.diff(ends)]),
            "cf": np.concatenate([[0], self.lengths.sum(1), np.add.reduceat(tf, start) if len(start) else []]),
            "max_tf": np.concatenate([[0], self.lengths.max(1, initial=0), np.maximum.reduceat(tf, start) if len(start) else []]),
            "min_dl": np.concatenate([[0] * (1 + len(FIELDS)), np.minimum.reduceat(lengths, start) if len(start) else []]),
        }
        offsets = np.cumsum([0, 0, *[len(h) for h in has], *np.diff(ends)])
        many = len(columns["term"])
        parts = [
            pa.array(np.full(many, block), _LIST_TYPES[0]), pa.array(columns["field"], pa.string()), pa.array(columns["term"], pa.string()),
            *[pa.array(columns[c].astype(np.int64)) for c in ("df", "cf", "max_tf", "min_dl")],
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([*has, doc]).astype(np.int32))),
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([*[o[h] for o, h in zip(self.lengths, has, strict=True)], tf]).astype(np.int64))),
            pa.array([self.hashes] + [None] * (many - 1), _LIST_TYPES[-1]),
        ]
        return pa.Table.from_arrays(parts, _LIST_NAMES)


@dataclass(frozen=True)
class LexicalIndex:
    """The stored index of one language's fields; write it once and update it by document."""

    spark: SparkSession
    path: str
    lang: str | None = None

    @property
    def lists(self) -> DataFrame:
        return self.spark.read.schema(LISTS).parquet(f"{self.path}/lists")

    @property
    def blocks(self) -> int:
        return self.spark.read.parquet(f"{self.path}/layout").first()["blocks"]

    def _terms(self, documents: DataFrame, blocks: int, stemmer=None) -> DataFrame:
        terms = field_terms(search_fields(documents, self.lang), self.lang, stemmer)
        return terms.withColumn("doc_block", doc_block(F.col("content_hash"), blocks))

    def _store(self, lists: DataFrame, mode: str) -> None:
        ordered = lists.sortWithinPartitions("doc_block", "term", "field")
        ordered.write.mode("overwrite").option("partitionOverwriteMode", mode).option("compression", COMPRESSION).partitionBy("doc_block").parquet(f"{self.path}/lists")

    @classmethod
    def write(cls, documents: DataFrame, path: str, lang: str | None = None, stemmer=None, blocks: int | None = None) -> LexicalIndex:
        """Build the index of ``documents``, whose content hashes are unique, in place of any other.

        There are ``blocks`` of them at least, and as many as it takes for about
        ``DOCS_PER_BLOCK`` documents each; a corpus that has grown far beyond it is better
        written anew.
        """
        self = cls(documents.sparkSession, path, lang)
        blocks = max(blocks or 1, -(-documents.count() // DOCS_PER_BLOCK))

        def build(rows: pa.Table) -> pa.Table:
            return _Entries.of_documents(rows).lists(rows.column("doc_block")[0].as_py())

        self._store(self._terms(documents, blocks, stemmer).groupBy("doc_block").applyInArrow(build, LISTS), "static")
        self.spark.createDataFrame([(blocks,)], "blocks int").write.mode("overwrite").parquet(f"{path}/layout")
        return self

    @classmethod
    def read(cls, spark: SparkSession, path: str, lang: str | None = None) -> LexicalIndex:
        return cls(spark, path, lang)

    def update(self, documents: DataFrame, removed: DataFrame | None = None, stemmer=None) -> None:
        """Put ``documents`` in place of those with their content hashes, and drop the ``removed`` hashes.

        Only the blocks of these documents are read and rewritten. The new partitions are
        complete before the old ones are replaced, and an update that failed can be repeated.
        """
        blocks = self.blocks
        hashes = documents.select("content_hash")
        if removed is not None:
            hashes = hashes.unionByName(removed.select("content_hash"))
        gone = hashes.distinct().withColumn("doc_block", doc_block(F.col("content_hash"), blocks))
        touched = sorted(r["doc_block"] for r in gone.select("doc_block").distinct().collect())
        if not touched:
            return
        fresh = self._terms(documents, blocks, stemmer)
        none = [F.lit(None).cast(fresh.schema[c].dataType).alias(c) for c in ("field", "dl", "terms")]
        changes = fresh.unionByName(gone.select("doc_block", "content_hash", *none))

        def rewrite(key: tuple, old: pa.Table, new: pa.Table) -> pa.Table:
            kept = _Entries.of_lists(old, set(new.column("content_hash").to_pylist()))
            return kept.with_more(_Entries.of_documents(new)).lists(key[0].as_py())

        lists = within(self.lists, touched).groupBy("doc_block").cogroup(changes.groupBy("doc_block")).applyInArrow(rewrite, LISTS)
        self._store(written(lists, "lists"), "dynamic")


def within(lists: DataFrame, blocks: list[int]) -> DataFrame:
    """The lists of some blocks; the scan skips the other partitions."""
    if len(blocks) <= MAX_NAMED_BLOCKS:
        return lists.filter(F.col("doc_block").isin(blocks))
    wanted = lists.sparkSession.createDataFrame([(b,) for b in blocks], "doc_block int")
    return lists.join(F.broadcast(wanted), "doc_block", "left_semi")


def _corpus(index: LexicalIndex) -> tuple[list, list]:
    """Documents and mean length per field."""
    marked = index.lists.filter(F.col("term") == MARKER).groupBy("field").agg(F.sum("df").alias("n"), F.sum("cf").alias("tokens")).collect()
    of = {r["field"]: (r["n"], r["tokens"] / r["n"] if r["n"] else 0) for r in marked}
    return [of.get(f, (0, 0))[0] for f in FIELDS], [of.get(f, (0, 0))[1] for f in FIELDS]


def _scored_pairs(index: LexicalIndex, batch: QueryBatch, statistics: tuple, keys: DataFrame, pairs: DataFrame, named: list[int], k: int, out) -> DataFrame:
    """The best ``k`` documents of every (block, query) of ``pairs``, which has a row of queries per block."""
    shared = index.spark.sparkContext.broadcast((batch, statistics))
    id_type = out.fields[0].dataType

    def run(lists: pa.Table, wanted: pa.Table) -> pa.Table:
        asked, known = shared.value
        chosen = np.zeros(len(asked.queries), bool)
        chosen[wanted.column("queries").combine_chunks().flatten().to_numpy(zero_copy_only=False)] = True
        places = lists.column("place").to_numpy()
        held: list[str] = []
        lengths: dict[int, tuple] = {}
        for row in np.flatnonzero(places < 0).tolist():
            field = lists.column("field")[row].as_py()
            if field == "":
                held = lists.column("hashes")[row].as_py()
            else:
                lengths[FIELDS.index(field)] = tuple(lists.column(c)[row].values.to_numpy(zero_copy_only=False) for c in ("docs", "tfs"))
        dl = np.zeros((len(FIELDS), len(held)), np.float64)
        for field, (docs, own) in lengths.items():
            dl[field, docs] = own
        terms = lists.filter(pc.greater_equal(lists.column("place"), 0))
        slot = terms.column("place").to_numpy().astype(np.int64) + np.array([len(asked.terms) * FIELDS.index(f) for f in terms.column("field").to_pylist()], np.int64)
        columns = [pa.concat_arrays(terms.column(c).chunks) if terms.column(c).num_chunks else pa.array([], pa.list_(pa.int64())) for c in ("docs", "tfs")]
        slot = np.repeat(slot, pc.list_value_length(columns[0]).to_numpy(zero_copy_only=False).astype(np.int64))
        docs, tfs = (c.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in columns)
        order = np.argsort(docs, kind="stable")
        docs, tfs, slot = docs[order], tfs[order], slot[order]
        length = dl[(slot >= len(asked.terms)).astype(np.int64), docs]
        scorer = Scorer(asked, known, k, chosen)
        names = pa.array(held, pa.string())
        for first in range(0, len(held), DOCS_PER_PRODUCT):
            a, b = np.searchsorted(docs, [first, first + DOCS_PER_PRODUCT])
            if b > a:
                some = names.slice(first, DOCS_PER_PRODUCT)
                scorer.add(docs[a:b] - first, slot[a:b], tfs[a:b], length[a:b], some)
        return pa.Table.from_batches([scorer.batch(id_type)])

    lists = within(index.lists, named).join(F.broadcast(keys), "term").select("doc_block", "field", "place", "docs", "tfs", "hashes")
    return lists.groupBy("doc_block").cogroup(pairs.groupBy("doc_block")).applyInArrow(lambda a, b: run(a, b), out)


def _bounds(blocks: DataFrame, batch: QueryBatch, statistics: tuple) -> Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]]:
    """Per batch of rows of ``blocks``, the block numbers and the highest score that any document can have, per query."""
    shared = blocks.sparkSession.sparkContext.broadcast((batch, statistics))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        asked, known = shared.value
        scorer = Scorer(asked, known, 1)
        for part in batches:
            for at in range(0, part.num_rows, DOCS_PER_PRODUCT):
                some = part.slice(at, DOCS_PER_PRODUCT)
                lists = [some.column(c) for c in ("slots", "tfs", "dls")]
                row = np.repeat(np.arange(some.num_rows), pc.list_value_length(lists[0]).to_numpy(zero_copy_only=False).astype(np.int64))
                slots, tfs, dls = (c.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in lists)
                bound = np.concatenate([score for _, score in scorer.scores(some.num_rows, row, slots, tfs, dls)], axis=1)
                # What a document gets is rounded.
                yield some.column("doc_block").to_numpy(), np.where(bound > 0, bound + 10.0**-SCORE_DIGITS, -np.inf)

    return run


def _search_batch(index: LexicalIndex, batch: QueryBatch, corpus: tuple[list, list], k: int, out, probed: int) -> DataFrame:
    spark, n = index.spark, len(batch.terms)
    keys = spark.createDataFrame([(-1, MARKER), *enumerate(batch.terms)], "place int, term string")
    slot = (F.col("place") + F.when(F.col("field") == FIELDS[0], 0).otherwise(n)).cast("int").alias("slot")
    stats = written(
        index.lists.select("doc_block", "field", "term", "df", "max_tf", "min_dl").join(F.broadcast(keys.filter("place >= 0")), "term")
        .select("doc_block", slot, "df", "max_tf", "min_dl"), "wanted-lists"
    )
    frequencies = np.zeros(2 * n)
    for r in stats.groupBy("slot").agg(F.sum("df").alias("df")).collect():
        frequencies[r["slot"]] = r["df"]
    statistics = (frequencies, *corpus)
    entry = F.collect_list(F.struct("slot", "max_tf", "min_dl"))
    blocks = written(
        stats.groupBy("doc_block").agg(entry.alias("e"))
        .select("doc_block", F.col("e.slot").alias("slots"), F.col("e.max_tf").alias("tfs"), F.col("e.min_dl").alias("dls")), "block-bounds"
    )
    bounds = _bounds(blocks, batch, statistics)

    def likeliest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = TaskBest(list(range(len(batch.queries))), probed)
        for numbers, bound in bounds(batches):
            best.add(bound, pa.array(numbers))
        rows = best.rows()
        if rows:
            q, b, s = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(b, pa.int32()), pa.array(s, pa.float64())], ["query_id", "doc_block", "score"])

    first = top_k(blocks.mapInArrow(likeliest, "query_id bigint, doc_block int, score double"), probed, "doc_block").select("query_id", "doc_block").collect()
    tried: dict[int, list[int]] = {}
    for r in first:
        tried.setdefault(r["doc_block"], []).append(r["query_id"])

    def best_of(pairs: DataFrame, named: list[int]) -> DataFrame:
        return _scored_pairs(index, batch, statistics, keys, pairs, named, k, out)

    probe = spark.createDataFrame(list(tried.items()), "doc_block int, queries array<int>")
    found = written(top_k(best_of(probe, sorted(tried)), k, "content_hash").select(out.names), "probed")
    reach = {r["query_id"]: r["least"] for r in found.groupBy("query_id").agg(F.min("score").alias("least"), F.count("*").alias("n")).filter(F.col("n") >= k).collect()}
    least = np.array([reach.get(q, -np.inf) for q in batch.queries])

    def hopeful(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for numbers, bound in bounds(batches):
            able = (bound >= least) & (bound > -np.inf)
            for i, number in enumerate(numbers.tolist()):
                able[i, tried.get(number, [])] = False
            kept = np.flatnonzero(able.any(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers[kept], pa.int32()), pa.array([np.flatnonzero(able[i]).astype(np.int32) for i in kept], pa.list_(pa.int32()))], ["doc_block", "queries"]
            )

    rest = written(blocks.mapInArrow(hopeful, "doc_block int, queries array<int>"), "hopeful-blocks")
    named = sorted(r["doc_block"] for r in rest.select("doc_block").collect())
    return found if not named else found.unionByName(best_of(rest, named))


def search_index(
    questions: DataFrame, index: LexicalIndex, k: int = MIN_DEPTH, rewrite: bool = False,
    stemmer: Callable[[Column], Column] | None = None, max_pairs: int = MAX_BROADCAST_ROWS, probed: int = PROBED,
) -> DataFrame:
    """``(query_id, content_hash, score, rank)``, the same as a search of the indexed documents.

    Of every query the ``probed`` blocks with the highest bounds are searched first. The
    others are searched for the queries whose k-th score they may reach, and blocks that
    can reach none are not read. What the driver holds is bounded by the queries of a batch
    and by one number per block.
    """
    terms = query_terms(questions, rewrite, index.lang, stemmer)
    out = answered(index.spark, [], k, questions.schema["query_id"].dataType).drop("rank").schema
    corpus, parts = _corpus(index), []
    for batch in query_batches(terms, max_pairs):
        if batch.queries:
            parts.append(_search_batch(index, batch, corpus, k, out, probed))
    return answered(index.spark, parts, k, questions.schema["query_id"].dataType)
