"""Queries and guarded status transitions over the article catalog."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslake.functions.keys import blank_to_null, first_filled, uri_key
from corpuslake.operators.dedup import first_per_key
from corpuslake.operators.joins import lookup, wanted_only
from corpuslake.session import broadcast_if_small
from corpuslake.settings import (
    PAGE_LIMIT_DEFAULT,
    PAGE_LIMIT_MAX,
    READ_CHARS_DEFAULT,
    READ_CHARS_MAX,
    READ_CHARS_MIN,
    UNKNOWN_LANG,
    clamp,
)

PAGE_COLUMNS = (
    "id", "feed_id", "url", "item_key", "content_hash", "s3_uri", "silver_s3_uri",
    "title", "published_at", "status", "fetched_at", "updated_at",
)
# target status -> statuses it may be reached from
TRANSITIONS = {
    "parsed": ("fetched",),
    "indexed": ("parsed",),
    "embedded": ("indexed", "embedded"),
}


def matching(catalog: DataFrame, **equals) -> DataFrame:
    """Rows that match all given column values; ``None`` means no condition."""
    conditions = [F.col(k) == F.lit(v) for k, v in equals.items() if v is not None]
    return catalog.filter(reduce(lambda a, b: a & b, conditions, F.lit(True)))


def _oldest_first(df: DataFrame, limit: int | None) -> DataFrame:
    return df if limit is None else df.orderBy("fetched_at", "id").limit(limit)


def with_status(catalog: DataFrame, status: str, limit: int | None = None) -> DataFrame:
    """Rows in one status; with a limit, the oldest fetched first."""
    return _oldest_first(catalog.filter(F.col("status") == status), limit)


def to_index(catalog: DataFrame, rebuild: bool = False, limit: int | None = None) -> DataFrame:
    """Rows the lexical index still needs; a rebuild takes every parsed article."""
    wanted = ("parsed", "indexed", "embedded") if rebuild else ("parsed",)
    return _oldest_first(catalog.filter(F.col("status").isin(*wanted)), limit)


def to_embed(catalog: DataFrame, rebuild: bool = False, limit: int | None = None) -> DataFrame:
    wanted = ("indexed", "embedded") if rebuild else ("indexed",)
    return _oldest_first(catalog.filter(F.col("status").isin(*wanted)), limit)


def page(
    catalog: DataFrame,
    feed_id: str | None = None,
    status: str | None = None,
    limit: int = PAGE_LIMIT_DEFAULT,
    offset: int = 0,
) -> DataFrame:
    """One page of the catalog, newest fetched first, ties by id."""
    return (
        matching(catalog, feed_id=feed_id, status=status)
        .select(*PAGE_COLUMNS)
        .orderBy(F.desc("fetched_at"), F.desc("id"))
        .offset(max(0, offset))
        .limit(clamp(limit, 1, PAGE_LIMIT_MAX))
    )


def page_with_total(
    catalog: DataFrame,
    feed_id: str | None = None,
    status: str | None = None,
    limit: int = PAGE_LIMIT_DEFAULT,
    offset: int = 0,
) -> DataFrame:
    """A page whose rows carry the ``total`` of matching rows, counted in the same job."""
    total = count_rows(catalog, feed_id=feed_id, status=status)
    return page(catalog, feed_id, status, limit, offset).withColumn("total", total.scalar())


def count_rows(catalog: DataFrame, **equals) -> DataFrame:
    return matching(catalog, **equals).agg(F.count("*").alias("total"))


def recent(catalog: DataFrame, limit: int = 5) -> DataFrame:
    return catalog.orderBy(F.desc("fetched_at"), F.desc("id")).limit(limit)


def by_id(catalog: DataFrame, article_id: int) -> DataFrame:
    return catalog.filter(F.col("id") == article_id).select(*PAGE_COLUMNS)


def by_content_hash(catalog: DataFrame, digest: str) -> DataFrame:
    columns = ("feed_id", "title", "url", "content_hash", "status", "silver_s3_uri")
    return catalog.filter(F.col("content_hash") == digest).select(*columns).limit(1)


def status_counts(catalog: DataFrame) -> DataFrame:
    """Rows per status, and the grand total under the status ``(total)``."""
    return (
        catalog.rollup("status")
        .agg(F.count("*").alias("n"), F.grouping("status").alias("_all"))
        .select(F.when(F.col("_all") == 1, F.lit("(total)")).otherwise(F.col("status")).alias("status"), "n")
        .orderBy("status")
    )


def feed_summary(catalog: DataFrame) -> DataFrame:
    return (
        catalog.groupBy("feed_id")
        .agg(
            F.count("*").alias("n"),
            F.min("fetched_at").alias("first_fetched"),
            F.max("fetched_at").alias("last_fetched"),
        )
        .orderBy(F.desc("n"), "feed_id")
    )


def resolve_feed_lang(catalog: DataFrame, feeds: DataFrame) -> DataFrame:
    """Feed language of every row: catalog value, registry value, or ``und``.

    The registry has one row per feed and is broadcast after its rows are counted, so a
    feed with much of the catalog does not gather in one task.
    """
    registry = broadcast_if_small(
        feeds.select(F.col("id").alias("feed_id"), F.col("lang").alias("_lang"))
    )
    return (
        catalog.join(registry, "feed_id", "left")
        .withColumn("feed_lang", first_filled(F.col("feed_lang"), F.col("_lang"), F.lit(UNKNOWN_LANG)))
        .drop("_lang")
    )


def advance(
    catalog: DataFrame,
    done: DataFrame,
    target: str,
    run_ts: Column,
    reparse: bool = False,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Move the articles whose url is in ``done`` to ``target`` where that is allowed.

    ``carry`` names columns of ``done`` that overwrite the catalog's on a move.
    ``done`` is reduced to one row per url first, so repeated urls cannot skew the
    join.
    """
    if target not in TRANSITIONS:
        raise ValueError(f"no transition to {target!r}")
    if reparse and target != "parsed":
        raise ValueError("only the parsed status can be reached by a reparse")
    marks = done.groupBy("url").agg(
        F.lit(True).alias("_done"), *[F.max(c).alias(f"_{c}") for c in carry]
    )
    allowed = F.lit(True) if reparse else F.col("status").isin(*TRANSITIONS[target])
    moved = F.col("_done").isNotNull() & allowed
    joined = catalog.join(marks, "url", "left")
    updates = {c: F.when(moved, F.col(f"_{c}")).otherwise(F.col(c)) for c in carry}
    updates["status"] = F.when(moved, F.lit(target)).otherwise(F.col("status"))
    updates["updated_at"] = F.when(moved, run_ts).otherwise(F.col("updated_at"))
    return joined.withColumns(updates).select(*catalog.columns)


def read_silver(
    requests: DataFrame,
    catalog: DataFrame,
    silver: DataFrame,
    max_chars: int = READ_CHARS_DEFAULT,
) -> DataFrame:
    """Answer read requests ``(request_id, content_hash, silver_s3_uri)`` in one batch.

    Exactly one of the two identifiers must be given, only objects below
    ``silver/`` are served, and the text is cut to ``max_chars`` with a flag.
    """
    cap = clamp(int(max_chars), READ_CHARS_MIN, READ_CHARS_MAX)
    wanted = requests.select(
        "request_id",
        blank_to_null(F.trim("content_hash")).alias("_hash"),
        blank_to_null(F.trim("silver_s3_uri")).alias("_uri"),
    )
    # Few requests meet a large catalog and large texts: both are cut to what is wanted first.
    held = wanted_only(catalog.withColumnRenamed("content_hash", "_hash"), wanted, "_hash")
    # Two feeds may carry the same item, hence the same hash: serve the first row.
    known = first_per_key(held, ["_hash"], F.col("id")).select(
        "_hash", F.struct("title", "url", "feed_id", "status", "silver_s3_uri").alias("_row")
    )
    located = lookup(wanted, known, "_hash").withColumn(
        "_at", F.coalesce("_uri", F.col("_row.silver_s3_uri"))
    )
    bodies = silver.select(
        F.col("silver_s3_uri").alias("_at"),
        F.struct(
            "content_hash", "title", "feed_id", "canonical_url", "text_source",
            "content_lang", F.length("text").alias("n_text"),
            F.substring("text", 1, cap).alias("text"),
        ).alias("_doc"),
    )
    key = uri_key(F.col("_at"))
    error = (
        F.when(F.col("_uri").isNotNull() & F.col("_hash").isNotNull(), "both identifiers given")
        .when(F.col("_uri").isNull() & F.col("_hash").isNull(), "no identifier given")
        .when(F.col("_uri").isNull() & F.col("_row").isNull(), "unknown content_hash")
        .when(F.col("_at").isNull(), "not parsed yet")
        .when(key.isNull(), "invalid uri")
        .when(~key.startswith("silver/"), "outside silver/")
        .when(F.col("_doc").isNull(), "object not found")
    )
    doc = lambda name: F.when(F.col("error").isNull(), F.col(f"_doc.{name}"))
    return (
        lookup(located, wanted_only(bodies, located, "_at"), "_at")
        .withColumn("error", error)
        .select(
            "request_id",
            "error",
            F.col("_row.status").alias("status"),
            F.col("_at").alias("silver_s3_uri"),
            F.coalesce(doc("content_hash"), F.col("_hash")).alias("content_hash"),
            F.coalesce(blank_to_null(doc("title")), F.col("_row.title")).alias("title"),
            F.coalesce(blank_to_null(doc("feed_id")), F.col("_row.feed_id")).alias("feed_id"),
            F.coalesce(blank_to_null(doc("canonical_url")), F.col("_row.url")).alias("canonical_url"),
            doc("text_source").alias("text_source"),
            doc("content_lang").alias("content_lang"),
            (doc("n_text") > cap).alias("truncated"),
            doc("text").alias("text"),
        )
    )
