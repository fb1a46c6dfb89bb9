"""The registered corpus queries against their SQL, and the pipeline's stages."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from corpuslake.llm import decontaminate, line_dedup, minhash, queries
from corpuslake.llm.common import table
from tests import check_oracle


@pytest.fixture(scope="module")
def con(sf):
    return check_oracle.connect(sf)


def test_all_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, sf, con, name):
    problem = check_oracle.compare(spark, con, name, sf)
    assert problem is None, problem


@pytest.fixture(scope="module")
def kept(spark, sf, tmp_path_factory):
    """Input and output of every stage."""
    docs, out = table(spark, sf, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        folder = str(tmp_path_factory.mktemp("stage"))
        stage(spark, docs, sf).write.mode("overwrite").parquet(folder)
        after = spark.read.parquet(folder)
        out.append((name, docs, after))
        docs = after
    return out


def test_stages_keep_columns_and_ids(kept):
    for name, before, after in kept[:-1]:
        assert after.dtypes == before.dtypes, name
        assert after.join(before, "doc_id", "left_anti").count() == 0
    assert {"rate", "copies"} <= set(kept[-1][2].columns)


def test_quality_stage_rejects_bad_and_keeps_good(spark, sf, kept):
    _, _, after = kept[0]
    labels = table(spark, sf, "labels")
    left = labels.join(after, "doc_id").toPandas()
    good, bad = labels.filter("quality = 1").count(), labels.filter("quality = 0").count()
    assert (left["quality"] == 1).sum() > 0.97 * good and (left["quality"] == 0).sum() < 0.2 * bad


def test_line_stage_equals_sql(con, kept):
    _, before, after = kept[1]
    con.register("stage_in", before.toPandas())
    want = con.execute(f"SELECT doc_id, text FROM ({line_dedup.KEPT_SQL.format(docs='stage_in')}) WHERE n_removed = 0 OR trim(text) <> ''").fetchall()
    assert sorted(want) == sorted((r["doc_id"], r["text"]) for r in after.collect())


def test_near_duplicate_stage_equals_sql(con, kept):
    _, before, after = kept[2]
    con.register("near_in", before.toPandas())
    want = con.execute(minhash.COMPONENT_SQL.format(docs="near_in", size=5, percent=80)).fetchall()
    assert sorted(r[0] for r in want if r[3]) == sorted(r["doc_id"] for r in after.collect())


def test_benchmark_stage_drops_what_the_search_finds(spark, sf, kept):
    _, before, after = kept[3]
    found = decontaminate.find_leaks(before, table(spark, sf, "benchmark")).filter(F.size("leaks") > 0)
    assert after.count() == before.count() - found.count()
    assert after.join(found, "doc_id", "left_semi").count() == 0


def test_stages_of_empty_and_repeated_rows(spark, sf, awkward):
    docs = table(spark, sf, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0
    rows = awkward.selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "CAST(length(text) AS BIGINT) AS n_chars")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, rows, sf).count() <= rows.count()
    near = corpus_pipeline.one_of_each_group(spark, rows, sf)
    assert sorted(r["doc_id"] for r in near.collect()) == [0, 1, 2, 3, 4, 5, 6, 50, 52, 53]


def test_stages_leave_columns_with_their_own_names_alone(spark, sf):
    """Columns named like the operators' results keep their values, as do odd types and a missing n_chars."""
    docs = table(spark, sf, "documents").drop("n_chars").selectExpr(
        "*", "-1 AS score", "'n' AS n", "2 AS rows", "'w' AS n_words", "array(doc_id) AS leaks", "'i' AS leak_items", "3 AS n_lines",
        "4 AS n_removed", "'p' AS posterior", "5 AS n_tokens", "'r' AS rate", "named_struct('a.b', doc_id) AS `a.b`", "6 AS component", "7 AS id", "'d' AS doc",
    )
    own = {r["doc_id"]: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, sf)
        last = name == corpus_pipeline.STAGES[-1][0]
        assert after.columns == [*[c for c in docs.columns if not last or c != "rate"], *(["rate", "copies"] if last else [])], name
        rows = after.collect()
        assert rows
        for r in rows:
            assert all(r[c] == own[r["doc_id"]][c] for c in docs.columns if c != "text" and not (last and c == "rate")), name


def test_pipeline_runs(spark, sf, kept):
    assert entry.queries()["pipeline"](spark, sf).count() == kept[-1][2].count()
