"""Near-duplicate documents: fast similarity sketches, banding and exact verification.

A sketch has ``COORDINATES`` bins. Round i throws every shingle into a hashed bin with a
value from [i, i + 1); from round ``COORDINATES`` on, round i puts all of them into bin
i - ``COORDINATES``. A bin keeps its smallest value and the rounds end when all are
filled, after one or two for long texts and surely after twice as many as there are bins.

Texts with equal shingle sets are one class. Classes meet in the buckets of their bands;
in a bucket all are compared with a leader, the member that shares its buckets with most
others and so is nearest to what they are copies of. In the buckets whose members are not
all connected then, members too many of whose shingles no other text has leave, and the others
are compared within tasks, block by block. Every comparison is made on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslake.llm.common import join_many, row_key, slices, store, table
from corpuslake.llm.components import components
from corpuslake.llm.words import WordHashes, mixed, shingle_set, similar

COORDINATES = 128
#: Coordinates in a band. At similarity 0.85 a pair shares no band with probability 6e-11, at 0.8 with 5e-8.
BAND = 4
#: Members and shingles of a block, and columns of an incidence matrix, in the comparison of what is left over.
GROUP_BLOCK, GROUP_SHINGLES, COLUMNS = 1_000, 2_000_000, 4_096


def sketches(sets: list[np.ndarray], coordinates: int = COORDINATES) -> np.ndarray:
    """One sketch per non-empty set, as a matrix of 64-bit values."""
    unset = np.uint64(2**64 - 1)
    out = np.full((len(sets), coordinates), unset, np.uint64)
    flat = out.reshape(-1)
    items = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets), dtype=np.int64) * coordinates, [len(s) for s in sets])
    for i in range(2 * coordinates):
        salted = mixed(items + np.uint64((i + 1) * 0x9E3779B97F4A7C15 % 2**64))
        place = (salted & np.uint64(coordinates - 1)).astype(np.int64) if i < coordinates else i - coordinates
        np.minimum.at(flat, owner + place, (np.uint64(i) << np.uint64(48)) | (salted >> np.uint64(16)))
        unfilled = (out == unset).any(axis=1)
        if not unfilled.any():
            break
        left = unfilled[owner // coordinates]
        if not left.all():
            items, owner = items[left], owner[left]
    return out


def band_keys(sketch: np.ndarray, band: int = BAND) -> np.ndarray:
    """One 64-bit key per band of each sketch."""
    parts = sketch.reshape(len(sketch), -1, band)
    keys = np.broadcast_to(np.arange(parts.shape[1], dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(band):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return keys.view(np.int64)


def _sketched(docs: DataFrame, size: int) -> DataFrame:
    """doc, id, n, set (digest of the shingle set, null when empty) and the band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for part, texts in slices(batches):
            sets = [shingle_set(t, size, known) for t in texts]
            filled = [s for s in sets if len(s)]
            keys = iter(band_keys(sketches(filled))) if filled else iter(())
            yield pa.RecordBatch.from_arrays([
                part.column("doc"), part.column("id"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64())),
            ], ["doc", "id", "n", "set", "bands"])

    id_type = docs.schema["id"].dataType.simpleString()
    return docs.select("doc", "id", "text").mapInArrow(run, f"doc binary, id {id_type}, n bigint, set binary, bands array<bigint>")


def _links(pairs: DataFrame, texts: DataFrame, size: int, threshold: float) -> DataFrame:
    """The pairs (a, b) of classes whose full shingle sets are similar; ``texts`` has one per class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, last, mine = WordHashes(), None, None
        for batch in batches:
            found = []
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            left, right = batch.column("a_text"), batch.column("b_text")
            for i in range(len(a)):
                if a[i] != last:  # rows come sorted by a
                    last, mine = a[i], shingle_set((left[i].as_py() or "").encode(), size, known)
                if similar(mine, shingle_set((right[i].as_py() or "").encode(), size, known), threshold):
                    found.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([c[i] for i in found], pa.int64()) for c in (a, b)], ["a", "b"])

    one = pairs.join(texts.select(F.col("nr").alias("b"), F.col("text").alias("b_text")), "b")
    two = one.join(texts.select(F.col("nr").alias("a"), F.col("text").alias("a_text")).hint("merge"), "a")
    return two.select("a", "b", "a_text", "b_text").mapInArrow(run, "a bigint, b bigint")


def _shared(texts: DataFrame, size: int) -> DataFrame:
    """Per class, how many of its shingles another one of ``texts`` has too: nr, n, shared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for part, bodies in slices(batches):
            numbers = part.column("nr").to_pylist()
            sets = [shingle_set(t, size, known) for t in bodies]
            nr = np.repeat(np.array(numbers, np.int64), [len(s) for s in sets])
            yield pa.RecordBatch.from_arrays([pa.array(nr), pa.array(np.concatenate(sets).view(np.int64))], ["nr", "shingle"])

    each = texts.select("nr", "text").mapInArrow(run, "nr bigint, shingle bigint")
    once = each.groupBy("shingle").agg(F.count("*").alias("k"), F.min("nr").alias("nr")).filter("k = 1")
    alone = once.groupBy("nr").agg(F.count("*").alias("alone"))
    return texts.select("nr", "n").join(alone, "nr", "left").select("nr", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("shared"))


def _block_links(mine: list[np.ndarray], theirs: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all similar pairs of two lists of sets, by exact counts of common elements.

    Elements that only one set has can't be common; the others are the columns of two
    incidence matrices, multiplied some thousand columns at a time.
    """
    owner = np.repeat(np.arange(len(mine) + len(theirs)), [len(s) for s in (*mine, *theirs)])
    names, place, times = np.unique(np.concatenate([*mine, *theirs]), return_inverse=True, return_counts=True)
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    common = np.zeros((len(mine), len(theirs)), np.float32)
    often = times[place] > 1
    place, owner = place[often], owner[often]
    for first in range(0, len(names), COLUMNS):
        low, high = np.searchsorted(place, [first, first + COLUMNS])
        if high > low:
            columns, at = np.unique(place[low:high], return_inverse=True)
            held = np.zeros((len(mine) + len(theirs), len(columns)), np.float32)
            held[owner[low:high], at] = 1
            common += held[: len(mine)] @ held[len(mine) :].T
    sizes = np.array([len(s) for s in mine])[:, None] + np.array([len(s) for s in theirs])[None, :]
    return np.nonzero(100 * common >= percent * (sizes - common))


def _leftover_links(held: DataFrame, roots: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame | None:
    """Links between unconnected members of a bucket, or None when all buckets are connected.

    One of two such members is outside the bucket's largest component. A member of whose
    shingles too few occur in any other text is certain not to be linked. The others are
    compared on their full sets, group by group, a group being all that meet one largest
    component; a group is dealt out in pairs of blocks, whose size is bounded in members and
    in shingles, and of the links of a member to a component one is passed on.
    """

    def parts(members: DataFrame, stored: str) -> DataFrame | None:
        """Members of the buckets with several components, with the largest one's root."""
        sizes = members.groupBy("band", "root").agg(F.count("*").alias("n"))
        several = sizes.groupBy("band").agg(
            F.count("*").alias("roots"), F.sum("n").alias("members"), F.max(F.struct("n", "root"))["root"].alias("main")
        ).filter("roots > 1").drop("roots")
        several, _ = store(several, "open-buckets")
        return None if several.isEmpty() else store(join_many(members, several, "band"), stored)[0]

    rooted = held.filter("n > 2").drop("n").join(roots.withColumnRenamed("node", "nr"), "nr", "left").withColumn("root", F.coalesce("root", "nr"))
    rooted, _ = store(rooted, "rooted-members")
    apart = parts(rooted, "open-members")
    if apart is None:
        return None
    shared = _shared(texts.join(apart.select("nr").distinct(), "nr", "left_semi"), size)
    able, _ = store(shared.filter(100 * F.col("shared") >= percent * F.col("n")).select("nr", F.col("n").alias("size")), "sharing-members")
    able_members, _ = store(apart.drop("main", "members").join(able.select("nr"), "nr", "left_semi").filter("nr <> leader"), "sharing-members")
    rest = parts(able_members, "leftover-members")
    if rest is None:
        return None
    met, _ = store(rest.select("main", "nr", "root").distinct().join(able, "nr"), "leftover-groups")
    outside = (F.col("root") != F.col("main"))
    many = lambda n, shingles: F.greatest(F.ceil(n / GROUP_BLOCK), F.ceil(shingles / GROUP_SHINGLES))
    blocks = met.groupBy("main").agg(
        many(F.count("*"), F.sum("size")).alias("m_blocks"), many(F.count_if(outside), F.sum(F.when(outside, F.col("size")).otherwise(0))).alias("o_blocks")
    )
    dealt, _ = store(join_many(met, blocks, "main"), "dealt-members")
    own = lambda n: F.pmod(F.xxhash64("nr"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    sides = dealt.select("main", "nr", "root", F.lit(False).alias("out"), own("m_blocks").alias("m"), every("o_blocks").alias("o")).unionByName(
        dealt.filter(outside).select("main", "nr", "root", F.lit(True).alias("out"), own("o_blocks").alias("o"), every("m_blocks").alias("m"))
    )

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        o, m = pdf[pdf["out"]], pdf[~pdf["out"]]
        sets = [[np.frombuffer(s, np.uint64) for s in side["shingles"]] for side in (o, m)]
        if not len(o) or not len(m):
            return pd.DataFrame({"a": [], "b": []})
        at, to = _block_links(*sets, percent)
        found = pd.DataFrame({"a": o["nr"].to_numpy()[at], "b": m["nr"].to_numpy()[to], "x": o["root"].to_numpy()[at], "y": m["root"].to_numpy()[to]})
        return found[found["x"] != found["y"]].drop_duplicates(["a", "y"])[["a", "b"]]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for part, bodies in slices(batches):
            yield pa.RecordBatch.from_arrays([part.column("nr"), pa.array([shingle_set(t, size, known).tobytes() for t in bodies], pa.binary())], ["nr", "shingles"])

    wanted = texts.join(met.select("nr").distinct(), "nr", "left_semi").select("nr", "text")
    sets_of, _ = store(wanted.mapInArrow(measured, "nr bigint, shingles binary"), "leftover-sets")
    return sides.join(sets_of, "nr").groupBy("main", "o", "m").applyInPandas(compare, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, size: int = 5, threshold: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc (128-bit key of id and text), id, n (set size) and component of every row.

    Words are runs without blanks, A-Z lower-cased. A text's set are its distinct runs of
    ``size`` words, or its whole sequence when shorter; without words it is empty and
    linked with nothing, as is a null text. Two rows are linked from a Jaccard similarity
    of ``threshold`` on, given in hundredths; ``component`` is the smallest id reachable.
    A null id is passed over unless all of a component are null. Repeated rows each give
    a row. Other columns are not read, whatever their names. Empty in, empty out.

    Copies are one class and never paired. A bucket costs a comparison per member; members
    that are neither connected nor excluded then are compared within tasks, which pass
    on links only.
    """
    rows = docs.select(row_key(key, text).alias("doc"), F.col(key).alias("id"), F.col(text).alias("text"))
    sketched, _ = store(_sketched(rows, size), "sketches")
    filled = sketched.filter("n > 0")
    grouped = filled.groupBy("set").agg(F.min("id").alias("low"), F.min("doc").alias("doc"), F.max("n").alias("n"))
    classes, _ = store(grouped.withColumn("nr", F.monotonically_increasing_id()), "classes")
    members, _ = store(
        filled.select("doc", "set", "bands").join(classes.select("nr", "doc", "set"), ["doc", "set"]).dropDuplicates(["nr"])
        .select("nr", F.explode("bands").alias("band")), "members"
    )
    buckets = members.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    met, _ = store(join_many(members, buckets, "band"), "bucket-members")
    met_by, _ = store(met.groupBy("nr").agg(F.sum("n").alias("met")), "met")
    leaders, _ = store(
        met.join(met_by.hint("merge"), "nr").groupBy("band").agg(F.max(F.struct("met", "nr"))["nr"].alias("leader")), "leaders"
    )
    held, _ = store(join_many(met, leaders, "band"), "led-members")
    texts, _ = store(
        rows.join(classes.join(met_by, "nr", "left_semi").select("nr", "n", "doc"), "doc").select("nr", "n", "text").dropDuplicates(["nr"]), "class-texts"
    )
    pairs = held.filter("nr <> leader").select(F.col("leader").alias("a"), F.col("nr").alias("b")).distinct()
    links, _ = store(_links(pairs, texts, size, threshold), "links")
    roots, _ = store(components(links, "a", "b"), "roots")
    more = _leftover_links(held, roots, texts, size, round(100 * threshold))
    if more is not None:
        # A component found so far counts as links of its members to its root.
        found = roots.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
        links, _ = store(found.unionByName(more), "links")
        roots, _ = store(components(links, "a", "b"), "roots")
    low = classes.join(roots.withColumnRenamed("node", "nr"), "nr", "left").select("set", "low", F.coalesce("root", "nr").alias("root"))
    low, _ = store(low, "class-roots")
    ends = low.groupBy("root").agg(F.min("low").alias("component"))
    by_class, _ = store(join_many(low, ends, "root").select("set", "component"), "class-components")
    linked = join_many(filled.select("doc", "id", "n", "set"), by_class, "set")
    alone = sketched.filter("n = 0").select("doc", "id", "n", F.col("id").alias("component"))
    return linked.select("doc", "id", "n", "component").unionByName(alone)


def op1_minhash_dedup(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), size=3, threshold=0.85)
    return found.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


COMPONENT_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM {docs}
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {size} THEN [w]
    ELSE list_transform(range(1, len(w) - {size} + 2), lambda i: w[i:i + {size} - 1]) END) AS s
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= {percent} * (x.n + y.n - common)
), reach AS (
  SELECT doc_id, doc_id AS other FROM {docs}
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
)
SELECT r.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id, r.doc_id = min(other) AS kept
FROM reach r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id
"""
ORACLE = COMPONENT_SQL.format(docs="documents", size=3, percent=85)
