"""Exact duplicates with frequent digests split off.

A Misra-Gries summary names every digest that may have more than one row in a
thousand. Those are counted exactly, and their winners, a thousand or so rows, are
broadcast, so that rows of a large group are decided where they are. All other rows
are shuffled by digest, where no group is large.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslake.llm.common import store, table

#: A digest with at least this share of the rows is certain to be found as frequent.
HOT_SHARE = 0.001


def exact_groups(docs: DataFrame, text: str = "text", key: str = "doc_id", hot_share: float = HOT_SHARE) -> DataFrame:
    """Key, keep_id, group_size, kept and text_sha256 of every row of ``docs``.

    Rows are copies when their texts are identical byte by byte; a null text counts as
    empty. Of each group the row with the largest key stays. Of rows that share both key
    and text exactly one stays. A null key is smaller than all others; ``keep_id`` is
    null where every key of a group is. An empty table gives no rows. Other columns of
    ``docs`` are not read, whatever their names.
    """
    digests = docs.select(
        F.col(key).alias("id"), F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256).alias("digest")
    )
    rows, _ = store(digests.withColumn("row", F.monotonically_increasing_id()), "digests")
    frequent = rows.stat.freqItems(["digest"], hot_share).select(F.explode("digest_freqItems").alias("digest"))
    best = F.max(F.struct(F.col("id"), F.col("row")))
    # At most 1 / hot_share digests; their rows are counted within the tasks before the shuffle.
    winners, _ = store(
        rows.join(F.broadcast(frequent), "digest", "left_semi").groupBy("digest").agg(F.count("*").alias("size"), best.alias("best")),
        "winners",
    )
    hot = rows.join(F.broadcast(winners), "digest")
    group = Window.partitionBy("digest")
    cold = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti").select(
        "digest", "id", "row", F.count("*").over(group).alias("size"), best.over(group).alias("best")
    )
    return hot.select("digest", "id", "row", "size", "best").unionByName(cold).select(
        F.col("id").alias(key), F.col("best.id").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"), F.col("digest").alias("text_sha256"),
    )


def op10_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


ORACLE = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
