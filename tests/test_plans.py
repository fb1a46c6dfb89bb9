"""Plans hold no cross join, push filters down, and read only the columns they need."""

import pytest

import __spark_entry__ as entry
from corpuslake.operators import lexical
from corpuslake.plans import tables


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    [
        "catalog_status_counts", "feed_language", "dedup_first_seen", "insert_if_absent", "status_transition",
        "gauges_long", "lake_audit", "text_source_cascade", "bm25_topk", "cosine_topk", "lexical_branch",
        "rrf_fusion", "answer_routing", "case_scores", "centroid_topk",
    ],
)
def test_no_cross_joins(spark, sf, name):
    plan = plan_of(entry.queries()[name](spark, sf))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scans_are_pruned(spark, sf):
    plan = plan_of(entry.queries()["catalog_status_counts"](spark, sf))
    assert "ReadSchema: struct<doc_id:bigint>" in plan


def test_filters_reach_the_scan(spark, sf):
    plan = plan_of(entry.queries()["answer_citations"](spark, sf))
    assert "EqualTo(role,assistant)" in plan


def test_scores_are_picked_before_the_query_shuffle(spark, sf):
    """Only each task's best rows per query move; no (query, document) row is made or shuffled."""
    found = lexical.search(tables.questions(spark, sf), tables.lexical_docs(spark, sf), 10)
    plan = plan_of(found)
    assert plan.count("hashpartitioning(query_id") == 1 and "hashpartitioning(content_hash" not in plan
    assert "MapInArrow" in plan and "Join" not in plan


def test_pages_skip_what_they_do_not_show(spark, sf):
    plan = plan_of(entry.queries()["recent_articles"](spark, sf))
    assert "TakeOrderedAndProject" in plan


def test_summaries_are_extracted_once(spark, sf):
    """The branches of the cascade read stored summaries; only the pages are extracted in its plan."""
    plan = plan_of(entry.queries()["text_source_cascade"](spark, sf))
    assert "_summary" in plan and "Scan parquet" in plan and "<p>" not in plan


def test_read_requests_cut_catalog_and_texts_first(spark, sf):
    plan = plan_of(entry.queries()["read_silver"](spark, sf))
    # One for the catalog, inside which no window runs before it, and one for the texts.
    assert plan.count("LeftSemi") >= 2
    assert plan.index("Window [row_number()") < plan.index("LeftSemi")


def test_a_page_and_its_total_are_one_plan(spark, sf):
    plan = plan_of(entry.queries()["articles_page_total"](spark, sf))
    assert "Subquery subquery#" in plan and "Join" not in plan
