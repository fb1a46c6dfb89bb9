"""Lines that repeat elsewhere, found by overlapping windows of three lines.

Every run of three consecutive lines is hashed; windows that occur more than once are
found over the whole corpus; all their occurrences but the first are marked, and the
marked lines are removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslake.llm.common import row_key, store, table

WINDOW = 3
#: Windows with at least this share of all occurrences are joined by broadcast: 1,000 at most.
HOT_SHARE = 0.001


def _windows(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """key, row key, position and 128-bit hash of every window that isn't blank."""
    lines = docs.select(
        F.col(key).alias("id"), row_key(key, text).alias("doc"),
        F.transform(F.split(F.col(text), "\n", -1), lambda line: F.trim(line)).alias("lines"),
    ).filter(F.size("lines") >= size)
    positions = F.sequence(F.lit(0), F.size("lines") - size)

    def window(at):
        parts = [F.get("lines", at + i) for i in range(size)]
        return F.struct(
            at.alias("at"), F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(size), *parts[::-1]).alias("b"),
            (F.length(F.concat(*parts)) > 0).alias("filled"),
        )

    return lines.select("id", "doc", F.inline(F.transform(positions, window))).filter("filled").drop("filled")


def repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """``doc`` (key of the row's id and text) and ``gone``, its line numbers to remove.

    The first occurrence of a window is the one with the smallest id, then text key,
    then position; it stays, even where a later one of the same window overlaps it.
    """
    windows = _windows(docs, key, text, size)
    place = F.struct("id", "doc", "at")
    repeated, _ = store(
        windows.groupBy("a", "b").agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1"), "windows"
    )
    total = repeated.agg(F.sum("n")).first()[0] or 0
    # Counts add up to the total, so at most 1 / HOT_SHARE windows are frequent.
    hot = F.col("n") >= F.greatest(F.lit(2.0), F.lit(total * HOT_SHARE))
    few = F.broadcast(repeated.filter(hot).drop("n"))
    found = windows.join(few, ["a", "b"]).unionByName(
        windows.join(few.select("a", "b"), ["a", "b"], "left_anti").join(repeated.filter(~hot).drop("n"), ["a", "b"])
    )
    same = F.col("doc") == F.col("first.doc")
    start = F.when(same, F.greatest(F.col("at"), F.col("first.at") + size)).otherwise(F.col("at"))
    covered = found.filter(~(same & (F.col("at") == F.col("first.at")))).select(
        "doc", F.explode(F.sequence(start, F.col("at") + size - 1)).alias("line")
    )
    return covered.groupBy("doc").agg(F.collect_set("line").alias("gone"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``, and columns n_lines, n_removed.

    Lines end at a newline and are compared without spaces around them; windows of blank
    lines only are not compared. A text of fewer than ``size`` lines, an empty and a null
    text stay as they are (null: no lines). A text of which nothing is left becomes empty.
    Rows alike in id and text count as one document and fare alike. All columns of
    ``docs`` stay; columns named n_lines or n_removed are replaced. Empty in, empty out.
    """
    gone = repeated_lines(docs, key, text, size).withColumnRenamed("doc", "__doc").withColumnRenamed("gone", "__gone")
    plain = docs.drop("n_lines", "n_removed")
    joined = plain.withColumn("__doc", row_key(key, text)).join(gone, "__doc", "left")
    lines = F.split(F.col(text), "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__gone"))
    kept = F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")
    whole = F.col("__gone").isNull()
    return joined.select(
        *[F.when(whole, F.col(text)).otherwise(kept).alias(c) if c == text else F.col(f"`{c}`") for c in plain.columns],
        F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(whole, 0).otherwise(F.size("__gone")).cast("long").alias("n_removed"),
    )


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


KEPT_SQL = """
WITH lines AS (
  SELECT doc_id, text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos,
         unnest(string_split(text, chr(10))) AS line
  FROM {docs}
), windows AS (
  SELECT doc_id, pos, trim(line) AS l1, lead(trim(line), 1) OVER d AS l2, lead(trim(line), 2) OVER d AS l3
  FROM lines WINDOW d AS (PARTITION BY doc_id ORDER BY pos)
), ranked AS (
  SELECT doc_id, pos, first_value(doc_id) OVER w AS first_doc, first_value(pos) OVER w AS first_at
  FROM windows WHERE l3 IS NOT NULL AND concat(l1, l2, l3) <> ''
  WINDOW w AS (PARTITION BY l1, l2, l3 ORDER BY doc_id, pos)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(
    CASE WHEN doc_id = first_doc THEN greatest(pos, first_at + 3) ELSE pos END, pos + 3)) AS pos
  FROM ranked WHERE (doc_id, pos) <> (first_doc, first_at)
), left_over AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.pos) AS n_removed,
         coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL), '') AS text
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos
  GROUP BY l.doc_id
)
SELECT d.* REPLACE (CASE WHEN d.text IS NULL THEN NULL ELSE o.text END AS text),
       coalesce(o.n_lines, 0) AS n_lines, coalesce(o.n_removed, 0) AS n_removed
FROM {docs} d LEFT JOIN left_over o ON d.doc_id = o.doc_id
"""
ORACLE = f"SELECT doc_id, n_lines, n_removed, text FROM ({KEPT_SQL.format(docs='documents')})"
