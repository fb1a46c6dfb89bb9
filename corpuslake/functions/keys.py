"""Identity, layout and URI columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuslake.settings import UUID_NAMESPACE_URL


def strip(col: Column) -> Column:
    """Remove Unicode white space at both ends (``trim`` only removes spaces)."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def first_filled(*cols: Column) -> Column:
    """First value that is neither null nor empty."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def item_key(entry_id: Column, guid: Column, link: Column) -> Column:
    """Stable key of a feed item; null marks an item that has none."""
    return strip(first_filled(entry_id, guid, link))


def content_hash(key: Column) -> Column:
    return F.sha2(key, 256)


def seen_key(feed_id: Column, key: Column) -> Column:
    return F.concat(feed_id, F.lit(":"), key)


def partition_date(published: Column, run_ts: Column) -> Column:
    return F.date_format(F.coalesce(published, run_ts), "yyyy-MM-dd")


def object_key(layer: str, feed_id: Column, dt: Column, digest: Column) -> Column:
    return F.concat(
        F.lit(f"{layer}/source="), feed_id, F.lit("/dt="), dt, F.lit("/"), digest, F.lit(".json")
    )


def object_uri(bucket: str, key: Column) -> Column:
    return F.concat(F.lit(f"s3://{bucket}/"), key)


_URI = r"(?s)^s3://([^/]+)/(.+)$"


def uri_bucket(uri: Column) -> Column:
    """Bucket of an object URI, null unless bucket and key are both present."""
    return blank_to_null(F.regexp_extract(uri, _URI, 1))


def uri_key(uri: Column) -> Column:
    return blank_to_null(F.regexp_extract(uri, _URI, 2))


def path_value(path: Column, name: str) -> Column:
    """Value of a ``name=value`` path segment, empty when absent."""
    return F.regexp_extract(path, name + "=([^/]+)", 1)


def chunk_id(digest: Column, index: Column) -> Column:
    return F.concat_ws(":", digest, index.cast("string"))


def uuid5_url(name: Column) -> Column:
    """RFC 4122 name-based (SHA-1) UUID in the URL namespace, without a UDF."""
    digest = F.sha1(
        F.concat(F.unhex(F.lit(UUID_NAMESPACE_URL)), F.encode(name, "UTF-8"))
    )
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"),
        F.substring(digest, 9, 4), F.lit("-5"),
        F.substring(digest, 14, 3), F.lit("-"),
        variant, F.substring(digest, 18, 3), F.lit("-"),
        F.substring(digest, 21, 12),
    )


def published_timestamp(text: Column) -> Column:
    """Timestamp of an RFC 822 or ISO 8601 date text, null when it is neither."""
    rfc = F.regexp_replace(text, r"^[A-Za-z]{3},\s*", "")
    return F.coalesce(
        F.try_to_timestamp(rfc, F.lit("d MMM yyyy HH:mm:ss z")),
        F.try_to_timestamp(rfc, F.lit("d MMM yyyy HH:mm:ss Z")),
        F.try_to_timestamp(text),
    )
