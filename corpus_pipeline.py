"""The corpus pipeline: quality, line dedup, near-duplicates, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet and
read again as the next one's ``docs``. All but the last return the columns they got,
with the values they had but for the text and its length after line dedup. Columns other
than doc_id and text travel packed in one, so their names may be anything, also those
that an operator gives its results. Every stage takes null and empty texts, null ids,
repeated rows and empty tables; what becomes of them is said at the stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslake.llm import decontaminate, line_dedup, minhash, mixture, quality
from corpuslake.llm.common import row_key, store, table


_REST = "__rest"


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the other columns as one."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(F.lit(True).alias(_REST), *rest).alias(_REST))


def unpacked(found: DataFrame, docs: DataFrame, **changed) -> DataFrame:
    """The columns of ``docs``, those named in ``changed`` with other values."""
    values = {c: F.col(c) if c in ("doc_id", "text") else F.col(_REST)[c] for c in docs.columns} | changed
    return found.select(*[values[c].alias(c) for c in docs.columns])


def keep_good(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject.

    Null and empty texts are scored like any other, all alike. Rows with equal texts, also
    repeated ones, have equal scores and stay or go together.
    """
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return unpacked(quality.score_quality(packed(docs), model).filter(F.col("score") >= quality.THRESHOLD), docs)


def without_repeated_lines(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines, n_chars made to fit; one of which nothing is left goes.

    Null, empty and blank texts that lost no line stay as they are. Rows with equal id and
    text are one document, and all of them get its result.
    """
    left = line_dedup.dedup_lines(packed(docs))
    kept = left.filter((F.col("n_removed") == 0) | (F.length(F.trim("text")) > 0))
    if "n_chars" not in docs.columns:
        return unpacked(kept, docs)
    fitting = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col(_REST)["n_chars"])
    return unpacked(kept, docs, n_chars=fitting.cast(docs.schema["n_chars"].dataType))


def one_of_each_group(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group, five words at 0.8.

    Of repeated rows (same id and text) with words one stays. Empty texts are no
    duplicates and all stay. Rows with a null id stay only where their group has no id.
    """
    found = minhash.near_duplicates(docs, size=5, threshold=0.8)
    kept, _ = store(
        found.filter(F.col("id").eqNullSafe(F.col("component"))).groupBy(F.col("doc").alias("__doc"))
        .agg(F.count("*").alias("__rows"), F.max("n").alias("__n")), "kept"
    )
    marked = packed(docs).withColumn("__doc", row_key("doc_id", "text")).join(kept, "__doc")
    once = (F.col("__rows") == 1) | (F.col("__n") == 0)
    return unpacked(marked.filter(once), docs).unionByName(unpacked(marked.filter(~once).dropDuplicates(["__doc"]), docs))


def without_benchmark(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    Null and empty texts have none and stay; rows with equal texts stay or go together.
    """
    found = decontaminate.find_leaks(packed(docs), table(spark, sf_dir, "benchmark"))
    return unpacked(found.filter(F.size("leaks") == 0), docs)


def mixed(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a rate above zero, with that rate and the number of copies to read.

    Columns named rate and copies are replaced. Null and empty texts have no tokens, and
    the rate of their posterior. Equal texts have equal rates; copies also depend on the id.
    """
    plain = docs.drop("rate", "copies")
    model = mixture.train(docs, table(spark, sf_dir, "labels"))
    found = mixture.mix(packed(plain), model, mixture.TARGETS).filter("rate > 0")
    columns = [F.col(c) if c in ("doc_id", "text") else F.col(_REST)[c].alias(c) for c in plain.columns]
    return found.select(*columns, "rate", "copies")


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", without_repeated_lines),
    ("MinHash near-dedup", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("mixing to target weights", mixed),
]

#: A trained classifier decides in the first and the last stage, which SQL can't express.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    """All stages over the documents; every stage but the last is stored in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs, _ = store(docs, "stage")
    return docs
