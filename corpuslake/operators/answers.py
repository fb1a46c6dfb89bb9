"""Prompt assembly, source footers, refusal and answer routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslake.functions.keys import blank_to_null, first_filled, strip
from corpuslake.operators.fusion import citation_label, numbered
from corpuslake.settings import LAKE_NAME, UNKNOWN_URI, UNTITLED

# --- Fixed values: answer formats ---------------------------------------------
SOURCES_MARK = f"Sources {LAKE_NAME}"
FOOTER_START = f"\n\n---\n**{SOURCES_MARK}**"
RETRIEVE_ONLY_PREFIX = "(retrieve seul)\n"
PROMPT_HEADING = "Extraits du corpus :\n\n"
PROMPT_QUESTION = "\n\nQuestion : "
# ------------------------------------------------------------------------------

# Default wording, this project's own; prompts and refusals may be given instead.
REFUSAL = "Aucun extrait de ce corpus ne permet de répondre."
SYSTEM_PROMPT = "Réponds à la question à l'aide des extraits qui suivent et indique entre crochets le numéro de ceux qui servent."


def _joined(block: Column, separator: str) -> Column:
    """Blocks of one query in passage order; a query has at most top-k of them."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col("n"), block.alias("block"))))
    return F.array_join(F.transform(ordered, lambda b: b["block"]), separator)


def _number() -> Column:
    return F.concat(F.lit("["), F.col("n").cast("string"), F.lit("]"))


def _title() -> Column:
    return F.coalesce(blank_to_null(F.col("title")), F.lit(UNTITLED))


def extract_block() -> Column:
    """One numbered extract of the prompt."""
    return F.concat(
        _number(), F.lit(" ("), F.col("sources"), F.lit(") "), _title(),
        F.lit("\n    feed: "), F.coalesce(blank_to_null(F.col("feed_id")), F.lit("?")),
        F.lit("\n    silver: "), F.coalesce(blank_to_null(F.col("silver_s3_uri")), F.lit(UNKNOWN_URI)),
        F.lit("\n    extrait: "), strip(F.col("text")),
    )


def source_line() -> Column:
    url = first_filled(F.col("canonical_url"), F.col("silver_s3_uri"), F.lit("?"))
    return F.concat(F.lit("- "), _number(), F.lit(" "), _title(), F.lit(" — "), url)


def label_line() -> Column:
    return F.concat(_number(), F.lit(" "), citation_label(F.col("title"), F.col("chunk_index")))


def passage_texts(passages: DataFrame) -> DataFrame:
    """Per query: passage count, prompt context, sources footer and label preview."""
    return numbered(passages).groupBy("query_id").agg(
        F.count("*").alias("n_passages"),
        _joined(extract_block(), "\n\n").alias("context"),
        F.concat(F.lit(FOOTER_START + "\n"), _joined(source_line(), "\n")).alias("footer"),
        F.concat(F.lit(RETRIEVE_ONLY_PREFIX), _joined(label_line(), "\n")).alias("preview"),
    )


def prompts(questions: DataFrame, passages: DataFrame, system: str = SYSTEM_PROMPT) -> DataFrame:
    """System and user message of every question that has passages."""
    return questions.join(passage_texts(passages), "query_id").select(
        "query_id",
        F.lit(system).alias("system_message"),
        F.concat(
            F.lit(PROMPT_HEADING), F.col("context"), F.lit(PROMPT_QUESTION), strip(F.col("question"))
        ).alias("user_message"),
    )


def route_answers(
    questions: DataFrame,
    passages: DataFrame,
    generated: DataFrame | None = None,
    retrieve_only: bool = False,
    refusal: str = REFUSAL,
) -> DataFrame:
    """The answer of every question: refusal, label preview, or text plus footer.

    ``generated`` holds ``(query_id, answer)`` written by a model elsewhere.
    """
    base = questions.join(passage_texts(passages), "query_id", "left").withColumn(
        "n_passages", F.coalesce("n_passages", F.lit(0))
    )
    none = F.col("n_passages") == 0
    if retrieve_only or generated is None:
        answer = F.when(none, refusal).otherwise(F.col("preview"))
    else:
        base = base.join(
            generated.select("query_id", F.col("answer").alias("_generated")), "query_id", "left"
        )
        answer = F.when(none, refusal).otherwise(
            F.concat(F.coalesce("_generated", F.lit("")), F.col("footer"))
        )
    return base.select(
        "query_id", "question", "n_passages", answer.alias("answer"), none.alias("refused")
    )


def last_user_message(turns: DataFrame) -> DataFrame:
    """Last non-blank user message of every conversation; an error where there is none."""
    text = strip(F.col("text"))
    asked = (F.col("role") == "user") & (text != "")
    return (
        turns.groupBy("conv_id")
        .agg(F.max_by(F.when(asked, text), F.when(asked, F.col("turn"))).alias("question"))
        .withColumn("error", F.when(F.col("question").isNull(), F.lit("no user message")))
    )
