"""Evaluation cases, experiment parameters, reports and the baseline registry."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslake.operators.evaluation import case_problem
from corpuslake.settings import EMBEDDING_DIMS, TOP_K_DEFAULT

CASE_SCHEMA = "case_id string, question string, expect string, difficulty string"
REGISTRY_SCHEMA = (
    "model string, vector_size int, k int, recall_at_k double, eval_set string, registered_at string"
)


def checked_cases(cases: DataFrame) -> DataFrame:
    """The cases, trimmed; raises when one is invalid or there is none."""
    trimmed = cases.select(
        "case_id", F.trim("question").alias("question"), F.trim("expect").alias("expect"),
        F.coalesce(F.trim("difficulty"), F.lit("one_shot")).alias("difficulty"),
    ).withColumn("problem", case_problem())
    first = trimmed.filter(F.col("problem").isNotNull()).select("case_id", "problem").first()
    if first:
        raise ValueError(f"case {first['case_id']!r}: {first['problem']}")
    if trimmed.isEmpty():
        raise ValueError("the evaluation set has no case")
    return trimmed.drop("problem")


def eval_cases(spark: SparkSession, cases: Iterable[Mapping[str, str]]) -> DataFrame:
    rows = [(c["id"], c.get("question"), c.get("expect"), c.get("difficulty")) for c in cases]
    return checked_cases(spark.createDataFrame(rows, CASE_SCHEMA))


def read_eval_cases(spark: SparkSession, path: str) -> DataFrame:
    return checked_cases(spark.read.schema(CASE_SCHEMA).json(path))


def embed_params(values: Mapping | None = None) -> dict:
    """Experiment parameters with their defaults."""
    given = dict(values or {})
    return {
        "model": str(given.get("model") or "hashing").strip(),
        "vector_size": int(given.get("vector_size") or EMBEDDING_DIMS),
        "top_k": int(given.get("top_k") or TOP_K_DEFAULT),
    }


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def register(report: DataFrame, path: str, registered_at: str) -> None:
    """Append a report to the registry; the last one of an evaluation set is its baseline."""
    row = report.select(
        "model", "vector_size", "k", "recall_at_k", "eval_set",
        F.lit(registered_at).alias("registered_at"),
    )
    row.write.mode("append").json(path)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REGISTRY_SCHEMA).json(path)
