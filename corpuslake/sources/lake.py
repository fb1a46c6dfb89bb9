"""Bronze, silver and gold objects in the lake: envelopes, reads and writes."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslake.functions import keys
from corpuslake.operators.contracts import split_valid
from corpuslake.operators.dedup import latest_per_key
from corpuslake.schemas import struct
from corpuslake.session import broadcast_if_small, folder_exists, written
from corpuslake.settings import COMPRESSION, ENTRY_SOURCE, SCHEMA_VERSION

# --- Fixed values: field names of the envelopes ---------------------------------
ENTRY_FIELDS = (
    "title", "link", "id", "guid", "summary", "published", "updated", "author", "tags",
)
SILVER_FIELDS = (
    "schema_version", "feed_id", "content_hash", "title", "canonical_url", "author", "published",
    "parsed_at", "text", "text_source", "bronze_s3_uri", "feed_lang", "content_lang",
)
# ------------------------------------------------------------------------------
KEEP_NULLS = {"ignoreNullFields": "false"}


def identified(entries: DataFrame, run_ts: Column) -> DataFrame:
    """Entries with ``item_key``, ``content_hash``, ``seen_key`` and ``dt``.

    The key is null for an item without id, guid and link.
    """
    published = (
        F.col("published_ts") if "published_ts" in entries.columns
        else keys.published_timestamp(F.col("published"))
    )
    key = keys.item_key(F.col("id"), F.col("guid"), F.col("link"))
    return (
        entries.withColumn("item_key", key)
        .withColumn("published_ts", published)
        .withColumns(
            {
                "content_hash": keys.content_hash(F.col("item_key")),
                "seen_key": keys.seen_key(F.col("feed_id"), F.col("item_key")),
                "dt": keys.partition_date(F.col("published_ts"), run_ts),
            }
        )
    )


def raw_entry_json(entries: DataFrame) -> Column:
    """The whitelisted fields an entry has, as JSON; absent ones are left out."""
    return F.to_json(F.struct(*[F.col(f) for f in ENTRY_FIELDS if f in entries.columns]))


def bronze_json(entries: DataFrame, fetched_at: Column) -> Column:
    """Bronze envelope of an identified entry.

    Top-level nulls are written and nulls inside ``raw`` are not, so the two parts are
    rendered apart and joined.
    """
    head = F.to_json(
        F.struct(
            F.lit(SCHEMA_VERSION).alias("schema_version"), "feed_id", "item_key", "content_hash",
            "title", "link", "published", fetched_at.alias("fetched_at"),
            F.lit(ENTRY_SOURCE).alias("source"),
        ),
        KEEP_NULLS,
    )
    return F.concat(
        F.substr(head, F.lit(1), F.length(head) - 1), F.lit(',"raw":'), raw_entry_json(entries), F.lit("}")
    )


def silver_json() -> Column:
    """Silver object of a silver row: nulls stay, only a null confidence is left out."""
    head = F.to_json(F.struct(*SILVER_FIELDS), KEEP_NULLS)
    tail = F.to_json(F.struct("content_lang_confidence"))
    return F.when(F.col("content_lang_confidence").isNull(), head).otherwise(
        F.concat(F.substr(head, F.lit(1), F.length(head) - 1), F.lit(","), F.substr(tail, F.lit(2), F.length(tail)))
    )


def read_objects(spark: SparkSession, path: str) -> DataFrame:
    """Whole JSON files below ``path`` as ``(path, raw_json)``, pretty-printed or not."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json").load(path)
    )
    return files.select("path", F.col("content").cast("string").alias("raw_json"))


def inventory(spark: SparkSession, path: str, max_keys: int | None = 50) -> DataFrame:
    """Objects below ``path``; the file contents are not read."""
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        .select("path", "length", "modificationTime")
    )
    return listed if max_keys is None else listed.orderBy("path").limit(max_keys)


def write_layer(objects: DataFrame, layer: str, path: str, run: str | None = None) -> DataFrame:
    """Add valid objects of one layer as JSON lines by source and day.

    ``objects`` has ``feed_id``, ``dt``, ``content_hash`` and ``raw_json``. Returns the
    rejected rows. Files are rebalanced by size, so a busy feed is written in parallel. A
    ``run`` that is repeated replaces what it wrote into a day; without one, rows are added.
    """
    good, bad = split_valid(objects, layer)
    lines = good.select(
        F.col("feed_id").alias("source"), "dt", F.lit(run or uuid.uuid4().hex).alias("run"), F.col("raw_json").alias("value")
    )
    _by_day(lines).text(path)
    return bad


def _by_day(rows: DataFrame):
    """Writer that replaces the folders of source, day and run which ``rows`` fill, and no others."""
    return (
        rows.hint("rebalance", "source", "dt").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("source", "dt", "run")
    )


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """Objects written by :func:`write_layer` as ``(path, raw_json)``."""
    lines = spark.read.format("text").option("recursiveFileLookup", True).load(path)
    return lines.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw_json"))


OBJECT_SCHEMA = struct(
    "uri string, content_hash string, raw_json string, written_at timestamp, source string, dt string, run string"
)
UNPLACED = "none"


def _places(uri: Column) -> dict[str, Column]:
    """Source and day of an object, read from its URI, so that a pointer leads to the folder."""
    return {
        name: F.coalesce(keys.blank_to_null(keys.path_value(uri, name)), F.lit(UNPLACED)) for name in ("source", "dt")
    }


@dataclass(frozen=True)
class ObjectLayer:
    """Objects of a layer in plain Parquet files by source and day, as the stages write them.

    A run has a folder of its own in every day it writes to, so that a repeated one
    replaces its objects. The object written at the latest time counts. Lookups by
    URI read the days of the wanted objects only.
    """

    spark: SparkSession
    path: str

    def versions(self) -> DataFrame:
        """All written objects, also those that later runs wrote again."""
        if not folder_exists(self.spark, self.path):
            return self.spark.createDataFrame([], OBJECT_SCHEMA)
        return self.spark.read.schema(OBJECT_SCHEMA).parquet(self.path)

    def versions_for(self, wanted: DataFrame) -> DataFrame:
        """Written objects whose ``uri`` is in ``wanted``; nulls find nothing.

        The days are broadcast when they are few, which prunes the others from the scan.
        """
        uris = wanted.filter(F.length("uri") > 0).select("uri").distinct()
        places = written(uris.withColumns(_places(F.col("uri"))), "pointers")
        days = places.filter(F.length("uri") > 0).select("source", "dt").distinct()
        near = self.versions().join(broadcast_if_small(days), ["source", "dt"], "left_semi")
        return near.join(places.select("uri"), "uri", "left_semi")

    def current(self) -> DataFrame:
        return self._newest(self.versions())

    def current_for(self, wanted: DataFrame) -> DataFrame:
        """The newest version of every object whose ``uri`` is in ``wanted``."""
        return self._newest(self.versions_for(wanted))

    @staticmethod
    def _newest(rows: DataFrame) -> DataFrame:
        # The URI says source and day. By it alone a join to the pointers needs no second shuffle of the objects.
        return latest_per_key(rows, ["uri"], F.struct("written_at", "run"))

    def write(self, objects: DataFrame, written_at: Column, run: str | None = None) -> None:
        """Write objects ``(uri, content_hash, raw_json)``; a busy day is written by many tasks."""
        placed = objects.select(
            "uri", "content_hash", "raw_json", written_at.alias("written_at"), F.lit(run or uuid.uuid4().hex).alias("run")
        )
        _by_day(placed.withColumns(_places(F.col("uri")))).option("compression", COMPRESSION).parquet(self.path)
