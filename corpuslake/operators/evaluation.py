"""Mechanical scoring of answers, and recall over an evaluation set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslake.operators.answers import REFUSAL, SOURCES_MARK

# --- Fixed values: allowed labels ----------------------------------------------
EXPECTATIONS = ("grounded", "refuse")
DIFFICULTIES = ("one_shot", "hard")
# ------------------------------------------------------------------------------


def case_problem() -> Column:
    """Why an evaluation case is invalid, null when it is sound."""
    return (
        F.when(~F.coalesce(F.col("expect").isin(*EXPECTATIONS), F.lit(False)), "unknown expect")
        .when(~F.coalesce(F.col("difficulty").isin(*DIFFICULTIES), F.lit(False)), "unknown difficulty")
        .when(F.coalesce(F.trim("question"), F.lit("")) == "", "empty question")
    )


def has_citation(answer: Column) -> Column:
    return F.coalesce(answer.contains("[1]") | answer.contains(SOURCES_MARK), F.lit(False))


def score_cases(
    cases: DataFrame, answers: DataFrame, retrieve_only: bool, refusal: str = REFUSAL
) -> DataFrame:
    """Score every case against its answer row ``(query_id, n_passages, answer, refused)``.

    A refuse case passes when nothing was found or the answer refuses. A grounded case
    needs passages and, unless only retrieval is judged, an answer that cites.
    """
    found = F.coalesce(F.col("n_passages") > 0, F.lit(False))
    refused = F.coalesce(F.col("refused"), F.lit(False)) | F.coalesce(
        F.trim("answer") == refusal.strip(), F.lit(False)
    )
    cited = has_citation(F.col("answer"))
    verdict = (
        F.when(
            F.col("expect") == "refuse",
            F.when(~found | refused, "pass: refused").otherwise("fail: passages found"),
        )
        .when(~found, "fail: nothing retrieved")
        .when(F.lit(retrieve_only), "pass: passages found")
        .when(refused, "fail: refused despite passages")
        .when(~cited, "fail: no citation")
        .otherwise("pass: grounded with citation")
    )
    return cases.join(answers, cases["case_id"] == answers["query_id"], "left").select(
        "case_id", "difficulty", "expect",
        verdict.startswith("pass").alias("ok"),
        found.alias("retrieve_nonempty"), refused.alias("refused"), cited.alias("has_citation"),
        F.regexp_replace(verdict, "^[a-z]+: ", "").alias("reason"),
    )


def eval_summary(scores: DataFrame) -> DataFrame:
    """Passed and total cases per difficulty, and over all as ``(all)``."""
    return (
        scores.rollup("difficulty")
        .agg(
            F.count_if("ok").alias("passed"), F.count("*").alias("total"),
            F.grouping("difficulty").alias("_all"),
        )
        .select(
            F.when(F.col("_all") == 1, "(all)").otherwise(F.col("difficulty")).alias("difficulty"),
            "passed", "total",
        )
    )


def case_hits(cases: DataFrame, passages: DataFrame) -> DataFrame:
    """``(case_id, expect, hit)``: whether retrieval returned anything for the case.

    The list of hits and misses stays a table, however many cases there are.
    """
    found = passages.select(F.col("query_id").alias("case_id")).distinct().withColumn("_hit", F.lit(True))
    return cases.join(found, "case_id", "left").select(
        "case_id", "expect", F.col("_hit").isNotNull().alias("hit")
    )


def recall_report(
    hits: DataFrame, model: str, vector_size: int, k: int, eval_set: str
) -> DataFrame:
    """One row: share of grounded cases with a passage, and refuse cases without one."""
    grounded = F.col("expect") == "grounded"
    counts = hits.agg(
        F.count_if(grounded).alias("n_grounded"),
        F.count_if(grounded & F.col("hit")).alias("n_hits"),
        F.count_if(~grounded).alias("n_refuse"),
        F.count_if(~grounded & ~F.col("hit")).alias("n_refuse_ok"),
    )
    return counts.select(
        F.lit(model).alias("model"), F.lit(vector_size).alias("vector_size"), F.lit(k).alias("k"),
        F.lit(eval_set).alias("eval_set"),
        F.when(F.col("n_grounded") > 0, F.col("n_hits") / F.col("n_grounded"))
        .otherwise(0.0).alias("recall_at_k"),
        "n_grounded", "n_hits", "n_refuse", "n_refuse_ok",
    )


def evaluate_recall(cases: DataFrame, retrieve, **labels) -> tuple[DataFrame, DataFrame]:
    """Run ``retrieve(questions)`` over the cases; returns the report and the case table."""
    questions = cases.select(F.col("case_id").alias("query_id"), "question")
    hits = case_hits(cases, retrieve(questions))
    return recall_report(hits, **labels), hits


def against_baseline(report: DataFrame, registry: DataFrame) -> DataFrame:
    """Compare a report with the last registered baseline of its evaluation set."""
    last = registry.groupBy("eval_set").agg(
        F.max_by(F.struct("model", "vector_size", "recall_at_k"), "registered_at").alias("b")
    )
    worse = F.col("recall_at_k") < F.col("b.recall_at_k")
    advice = F.when(
        worse,
        F.concat(
            F.lit("roll back to "), F.col("b.model"), F.lit(" ("),
            F.col("b.vector_size").cast("string"), F.lit(" dimensions), then embed again"),
        ),
    ).otherwise("keep")
    return report.join(last, "eval_set", "left").select(
        "eval_set", "model", "recall_at_k", F.col("b.model").alias("baseline_model"),
        F.col("b.recall_at_k").alias("baseline_recall"), F.coalesce(worse, F.lit(False)).alias("worse"),
        advice.alias("advice"),
    )
