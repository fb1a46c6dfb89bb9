"""The stored lexical index: the same results as a scan, updates by document, and blocks that aren't read."""

import random

import pytest
from pyspark.sql import functions as F

from corpuslake.operators import lexical, lexical_index
from corpuslake.operators.lexical_index import LexicalIndex, search_index
from tests.test_retrieval import QUERIES, corpus, ranked

COLUMNS = ["query_id", "content_hash", "score", "rank"]


def same(spark, index, docs, k=7, lang=None, asked=QUERIES, **how):
    asked = spark.createDataFrame(asked, "query_id long, question string")
    got = ranked(search_index(asked, index, k, **how).select(COLUMNS))
    assert got == ranked(lexical.search(asked, docs, k, lang).select(COLUMNS))
    return got


@pytest.mark.parametrize("blocks,probed", [(1, 1), (5, 1), (5, 2), (64, 3)])
def test_search_equals_a_scan(spark, tmp_path, blocks, probed):
    docs, _ = corpus(spark)
    index = LexicalIndex.write(docs, str(tmp_path), blocks=blocks)
    assert same(spark, index, docs, probed=probed)
    assert same(spark, LexicalIndex.read(spark, str(tmp_path)), docs, k=200, probed=probed)


@pytest.mark.parametrize("lang", ["fr", "en"])
def test_search_by_language(spark, tmp_path, lang):
    docs, _ = corpus(spark)
    index = LexicalIndex.write(docs, str(tmp_path), lang, blocks=6)
    same(spark, index, docs, lang=lang)


def test_updates_equal_a_new_index(spark, tmp_path):
    """Random changes, additions, removals, repeated ones too; statistics and lists are those of an index made anew."""
    docs, _ = corpus(spark)
    docs = docs.withColumn("part", F.pmod(F.xxhash64("content_hash"), F.lit(4))).cache()
    index = LexicalIndex.write(docs.filter("part < 2").withColumn("text", F.upper(F.concat("text", F.lit(" crue crue")))), str(tmp_path / "a"), blocks=9)
    index.update(docs.filter("part IN (0, 3)"), removed=docs.filter("part = 1").select("content_hash"))
    index.update(docs.filter("part IN (0, 3)"))
    index.update(docs.filter("part = 1").withColumn("title", F.lit("other")), removed=docs.limit(0).select("content_hash"))
    index.update(docs.filter("part IN (1, 2)"))
    index.update(docs.limit(0))
    anew = LexicalIndex.write(docs, str(tmp_path / "b"), blocks=9)

    def content(at):
        held = at.lists.filter("field = ''").select("doc_block", F.posexplode("hashes").alias("place", "content_hash"))
        lists = at.lists.filter("field <> ''").select("doc_block", "field", "term", "df", "cf", "max_tf", "min_dl", F.explode(F.arrays_zip("docs", "tfs")).alias("e"))
        rows = lists.join(held, (lists.doc_block == held.doc_block) & (lists.e.docs == held.place)).select(
            lists.doc_block, "field", "term", "df", "cf", "max_tf", "min_dl", "content_hash", "e.tfs"
        )
        return sorted(map(tuple, rows.collect()))

    assert content(index) == content(anew)
    same(spark, index, docs)


def test_emptied_and_filled_again(spark, tmp_path):
    docs, _ = corpus(spark)
    index = LexicalIndex.write(docs, str(tmp_path), blocks=3)
    index.update(docs.limit(0), removed=docs.select("content_hash"))
    asked = spark.createDataFrame(QUERIES, "query_id long, question string")
    assert search_index(asked, index, 5).count() == 0
    index.update(docs)
    same(spark, index, docs)


def test_nothing_to_index_or_ask(spark, tmp_path):
    docs, _ = corpus(spark)
    index = LexicalIndex.write(docs.limit(0), str(tmp_path))
    asked = spark.createDataFrame(QUERIES, "query_id long, question string")
    assert search_index(asked, index, 5).count() == 0
    index.update(docs)
    same(spark, index, docs)
    assert search_index(asked.limit(0), index, 5).count() == 0


def test_an_update_rewrites_its_blocks_only(spark, tmp_path):
    docs, _ = corpus(spark)
    index = LexicalIndex.write(docs, str(tmp_path), blocks=40)
    before = {p.name: {f.name for f in p.iterdir()} for p in (tmp_path / "lists").glob("doc_block=*")}
    one = docs.orderBy("content_hash").limit(1)
    index.update(one.withColumn("text", F.lit("new words")))
    after = {p.name: {f.name for f in p.iterdir()} for p in (tmp_path / "lists").glob("doc_block=*")}
    block = one.select(lexical_index.doc_block(F.col("content_hash"), 40)).first()[0]
    assert [name for name in before if before[name] != after[name]] == [f"doc_block={block}"]


def test_blocks_out_of_reach_are_not_read(spark, tmp_path, monkeypatch):
    """A rare word is in one block; the common one can't lift the others to its documents."""
    rng = random.Random(2)
    rows = [(f"h{i:04d}", "x", "common " * rng.randint(1, 3) + ("rare word " * 3 if i in (5, 6, 7) else "plain")) for i in range(600)]
    docs = spark.createDataFrame(rows, "content_hash string, title string, text string").withColumn("content_lang", F.lit("de"))
    where = {r[0]: r[1] for r in docs.select("content_hash", lexical_index.doc_block(F.col("content_hash"), 30)).collect()}
    index = LexicalIndex.write(docs, str(tmp_path), blocks=30)
    read = []
    keep = lexical_index.within
    monkeypatch.setattr(lexical_index, "within", lambda lists, blocks: (read.append(blocks), keep(lists, blocks))[1])
    found = same(spark, index, docs, k=3, asked=[(1, "common rare")], probed=2)
    assert {h for _, h in found[1]} == {"h0005", "h0006", "h0007"}
    assert set(read[0]) | set(read[-1]) <= {where[h] for h in ("h0005", "h0006", "h0007")} and len(sum(read, [])) <= 3
    plan = keep(index.lists, [3, 4])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [doc_block" in plan
