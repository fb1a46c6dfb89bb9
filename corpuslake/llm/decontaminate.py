"""Documents that hold passages of a benchmark, found by Wu-Manber search over words.

The alphabet are the words of the benchmark; any other word is one symbol that no
pattern has. A table tells for each block of two words how far the search may move on;
where it may not, the block's bucket lists the patterns that end with it, and those are
compared word by word.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslake.llm.common import slices, store, table

WINDOW = 10
BLOCK = 2
#: A benchmark is searched for in blocks of about so many characters, one pass over the documents each.
MAX_BLOCK_CHARS = 2_000_000

# Bytes that separate words become blanks, A-Z become lower case, all others stay.
_NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


class Search:
    """Shift tables and suffix buckets of all patterns of one length."""

    def __init__(self, patterns: dict[tuple[int, ...], set]):
        self.length = len(next(iter(patterns)))
        self.block = min(BLOCK, self.length)
        self.far = self.length - self.block + 1
        self.shift: dict = {}
        self.buckets: dict = {}
        for pattern, items in patterns.items():
            for end in range(self.block, self.length + 1):
                block = pattern[end - self.block : end]
                self.shift[block] = min(self.shift.get(block, self.far), self.length - end)
            self.buckets.setdefault(pattern[-self.block :], []).append((list(pattern), items))

    def run(self, words: list[int], hit: bytearray, items: set) -> None:
        """Mark the words of every occurrence and collect the items it belongs to."""
        length, size, far, shift, buckets = self.length, self.block, self.far, self.shift, self.buckets
        at, n = length, len(words)
        while at <= n:
            block = tuple(words[at - size : at])
            move = shift.get(block, far)
            if move:
                at += move
                continue
            window = words[at - length : at]
            for pattern, owners in buckets[block]:
                if pattern[0] == window[0] and pattern == window:
                    hit[at - length : at] = b"\1" * length
                    items |= owners
            at += 1


class Benchmark:
    """Words, windows and searches of a block of items."""

    def __init__(self, items: list[tuple], window: int):
        self.ids: dict[bytes, int] = {}
        lengths: dict[int, dict[tuple[int, ...], set]] = {}
        for name, text in items:
            words = [self.ids.setdefault(w, len(self.ids) + 1) for w in words_of((text or "").encode())]
            size = min(window, len(words))
            for at in range(len(words) - size + 1 if words else 0):
                lengths.setdefault(size, {}).setdefault(tuple(words[at : at + size]), set()).add(str(name))
        self.searches = [Search(p) for p in lengths.values()]

    def find(self, words: list[bytes]) -> tuple[bytearray, set]:
        hit, items = bytearray(len(words)), set()
        known = [self.ids.get(w, 0) for w in words]
        for search in self.searches:
            search.run(known, hit, items)
        return hit, items


def _runs(hit: bytearray) -> list[int]:
    """Begin and end of each run of marked words, one after the other."""
    out, at = [], hit.find(1)
    while at >= 0:
        end = hit.find(0, at)
        end = len(hit) if end < 0 else end
        out += [at, end]
        at = hit.find(1, end)
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", item: str = "item_id", max_block_chars: int = MAX_BLOCK_CHARS) -> DataFrame:
    """``docs`` with n_words, leaks (begin and end of each run of hit words, flat) and leak_items.

    An item's windows are its runs of ``window`` words, or all its words when it has
    fewer; a null or empty item has none, and one with a null id is left out. Rows that
    share an item id are one item. A null or empty document has no words. Every row of
    ``docs`` stays, repeated ones too, with all columns; columns with the three new names
    are replaced. Without items nothing is hit. The documents are not shuffled.

    The items travel to the tasks in blocks of about ``max_block_chars`` characters,
    which the driver counts first; a larger benchmark takes as many passes as blocks.
    """
    spark = docs.sparkSession
    listed = benchmark.filter(F.col(item).isNotNull()).select(F.col(item).alias("item"), F.col(text).alias("body"))
    total = listed.agg(F.sum(F.length("body"))).first()[0] or 0
    blocks = max(1, math.ceil(total / max_block_chars))
    numbered = listed.withColumn("block", F.pmod(F.xxhash64("item", "body"), F.lit(blocks)))
    plain = docs.drop("n_words", "leaks", "leak_items")
    found = plain.select(
        "*", F.lit(0).cast("long").alias("n_words"), F.array().cast("array<int>").alias("leaks"), F.array().cast("array<string>").alias("leak_items")
    )
    for block in range(blocks):
        items = [(r["item"], r["body"]) for r in numbered.filter(F.col("block") == block).collect()]
        shared = spark.sparkContext.broadcast(items)
        schema = pa.schema([("n_words", pa.int64()), ("leaks", pa.list_(pa.int32())), ("leak_items", pa.list_(pa.string()))])

        def run(batches: Iterator[pa.RecordBatch], shared=shared, schema=schema) -> Iterator[pa.RecordBatch]:
            patterns = Benchmark(shared.value, window)
            for part, texts in slices(batches, text):
                rows = []
                earlier = zip(part.column("leaks").to_pylist(), part.column("leak_items").to_pylist(), strict=True)
                for body, (leaks, names) in zip(texts, earlier, strict=True):
                    words = words_of(body)
                    hit, items = patterns.find(words)
                    for begin, end in zip(leaks[::2], leaks[1::2], strict=True):
                        hit[begin:end] = b"\1" * (end - begin)
                    rows.append((len(words), _runs(hit), sorted(items.union(names))))
                new = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)]
                kept = [part.column(i) for i, f in enumerate(part.schema) if f.name not in schema.names]
                names = [f.name for f in part.schema if f.name not in schema.names]
                yield pa.RecordBatch.from_arrays(kept + new, names + schema.names)

        found = found.mapInArrow(run, found.schema)
        if block < blocks - 1:
            found, _ = store(found, "leaks")
    return found


def op2_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark"))
    lengths = F.transform("leaks", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
    n_hit = F.aggregate(lengths, F.lit(0), lambda a, b: a + b).cast("long")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("leak_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("leak_items", ","), 256).alias("items_sha256"), (F.size("leaks") > 0).alias("contaminated"),
    )


ORACLE = """
WITH lower AS (
  SELECT 0 AS kind, doc_id AS id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL
  SELECT 1, item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark
), words AS (
  SELECT kind, id, coalesce(regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w FROM lower
), items AS (
  SELECT id, w, least(10, len(w)) AS size FROM words WHERE kind = 1 AND len(w) > 0
), windows AS (
  SELECT DISTINCT id, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: w[i:i + size - 1])) AS s FROM items
), places AS (
  SELECT id, size, unnest(range(1, len(w) - size + 2)) AS pos, w
  FROM words, (SELECT DISTINCT size FROM windows) WHERE kind = 0 AND len(w) >= size
), found AS (
  SELECT p.id AS doc_id, p.pos, p.size, x.id AS item
  FROM places p JOIN windows x ON p.size = x.size AND p.w[p.pos:p.pos + p.size - 1] = x.s
), hits AS (
  SELECT doc_id, count(DISTINCT word) AS n FROM (
    SELECT doc_id, unnest(range(pos, pos + size)) AS word FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT w.id AS doc_id, len(w) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(m.n, 0) AS n_items,
       sha256(coalesce(m.items, '')) AS items_sha256, h.n IS NOT NULL AS contaminated
FROM words w LEFT JOIN hits h ON h.doc_id = w.id LEFT JOIN named m ON m.doc_id = w.id WHERE kind = 0
"""
