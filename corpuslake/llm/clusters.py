"""Integer k-means in which a vantage-point tree finds the nearest centroid.

The centroids, a few hundred integers each, are broadcast every round with a tree over
them. Tasks search it best first for all vectors of a batch together: every vector
follows its own order of nodes and skips those that can't hold a centroid as near as its
best one. Sums per centroid and component come back, and the driver divides them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslake.llm.common import store, table

COMPONENTS, SCALE = 64, 64
CENTROIDS, ROUNDS = 16, 3
LEAF = 2
#: Vectors searched together.
BLOCK = 4_096
#: Scaled components beyond this could overflow 64-bit distances.
LARGEST = 1 << 27
#: Lower bounds are rounded in floating point; by this share they may be too high.
SLACK = 1e-9


@dataclass
class Node:
    """A centroid with its two sides, or a leaf's centroids; ``spans`` are the least and largest distances of each side."""

    vantage: int = -1
    members: tuple[int, ...] = ()
    children: tuple[int, ...] = ()
    spans: tuple[tuple[float, float], ...] = ()


class VantageTree:
    """Best-first nearest-centroid search with exact integer distances; of centroids as near the smaller number wins."""

    def __init__(self, centroids: np.ndarray, leaf: int = LEAF):
        self.centroids, self.leaf, self.nodes = centroids, leaf, []
        if len(centroids):
            self._build(list(range(len(centroids))))

    def _build(self, members: list[int]) -> int:
        number = len(self.nodes)
        self.nodes.append(Node())
        if len(members) <= self.leaf:
            self.nodes[number].members = tuple(members)
            return number
        vantage, rest = members[0], np.array(members[1:])
        away = self.centroids[rest] - self.centroids[vantage]
        distance = np.sqrt((away * away).sum(1).astype(np.float64))
        order = np.argsort(distance, kind="stable")
        half = (len(rest) + 1) // 2
        children, spans = [], []
        for side in (order[:half], order[half:]):
            if len(side):
                spans.append((float(distance[side].min()), float(distance[side].max())))
                children.append(self._build(rest[side].tolist()))
        self.nodes[number] = Node(vantage, (), tuple(children), tuple(spans))
        return number

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid and squared distance for each row of integers."""
        n = len(vectors)
        best, found = np.full(n, np.iinfo(np.int64).max), np.full(n, -1, np.int64)
        bound = np.full((n, len(self.nodes)), np.inf)
        bound[:, :1] = 0

        def try_centroid(rows: np.ndarray, number: int) -> np.ndarray:
            away = vectors[rows] - self.centroids[number]
            squared = (away * away).sum(1)
            nearer = (squared < best[rows]) | (squared == best[rows]) & (number < found[rows])
            best[rows[nearer]], found[rows[nearer]] = squared[nearer], number
            return squared

        open_rows = np.arange(n)
        while len(open_rows):
            node = bound[open_rows].argmin(1)
            low = bound[open_rows, node]
            # A bound equal to the best distance may still hide a tie with a smaller number.
            useful = (low < np.inf) & (low * (1 - SLACK) <= np.sqrt(best[open_rows].astype(np.float64)))
            open_rows, node, low = open_rows[useful], node[useful], low[useful]
            bound[open_rows, node] = np.inf
            for number in np.unique(node):
                here, rows = self.nodes[number], open_rows[node == number]
                for member in here.members:
                    try_centroid(rows, member)
                if here.vantage >= 0:
                    distance = np.sqrt(try_centroid(rows, here.vantage).astype(np.float64))
                    above = low[node == number]
                    for child, (least, largest) in zip(here.children, here.spans, strict=True):
                        bound[rows, child] = np.maximum.reduce([above, least - distance, distance - largest, np.zeros(len(rows))])
        return found, best


def usable(vector: Column, components: int) -> Column:
    """Whether the vector has exactly so many components, none null or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) == components) & finite, F.lit(False))


def scaled(column: pa.Array, components: int, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of all components; an error where exact distances wouldn't fit 64 bits."""
    x = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    if len(x) and np.abs(x).max() > LARGEST:
        raise OverflowError(f"scaled components beyond {LARGEST} have no exact 64-bit distances")
    return x.astype(np.int64).reshape(-1, components)


def initial(vectors: DataFrame, count: int, components: int, scale: int) -> np.ndarray:
    """The vectors whose ids have the smallest hashes; of equal ids those with smaller components come first."""
    first = (
        vectors.filter(F.col("id").isNotNull()).withColumn("hash", F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")), 256))
        .orderBy("hash", "vector").limit(count).toArrow()
    )
    kept = [scaled(pa.array([v], pa.list_(pa.float64())), components, scale)[0] for v in first.column("vector").to_pylist()]
    return np.array(kept, np.int64).reshape(-1, components)


def assigned(vectors: DataFrame, tree: VantageTree, components: int, scale: int) -> DataFrame:
    """``id``, ``cluster`` and ``distance`` of every vector."""
    kind = vectors.schema["id"].dataType.simpleString()
    shared = vectors.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                found, squared = shared.value.nearest(scaled(part.column("vector"), components, scale))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(found.astype(np.int32)), pa.array(squared)], ["id", "cluster", "distance"])

    return vectors.select("id", "vector").mapInArrow(run, f"id {kind}, cluster int, distance bigint")


def moved(vectors: DataFrame, tree: VantageTree, components: int, scale: int) -> np.ndarray:
    """Every centroid's new place: componentwise ``floor(sum / count)`` of its vectors, its old one without any."""
    shared = vectors.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(shared.value.centroids)
        sums, counts = np.zeros((k, components), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                block = scaled(batch.slice(at, BLOCK).column("vector"), components, scale)
                found, _ = shared.value.nearest(block)
                np.add.at(sums, found, block)
                counts += np.bincount(found, minlength=k)
        some = np.flatnonzero(counts)
        place = np.tile(np.arange(components + 1, dtype=np.int32), len(some))
        values = np.concatenate([sums[some], counts[some, None]], axis=1).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(some, components + 1).astype(np.int32)), pa.array(place), pa.array(values)], ["cluster", "place", "value"])

    totals = vectors.select("vector").mapInArrow(run, "cluster int, place int, value bigint").groupBy("cluster", "place").agg(F.sum("value").alias("value"))
    of = {(r["cluster"], r["place"]): r["value"] for r in totals.collect()}
    out = tree.centroids.copy()
    for c in {cluster for cluster, _ in of}:
        out[c] = [of[c, i] // of[c, components] for i in range(components)]
    return out


def cluster(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", centroids: int = CENTROIDS, rounds: int = ROUNDS,
    components: int = COMPONENTS, scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray]:
    """``id``, ``cluster`` and squared ``distance`` of every usable vector, and the centroids.

    Usable are vectors of exactly ``components`` finite components, which become
    ``floor(scale * x)``; other rows get no result, nor does an empty table. A null id
    takes part, but never as a first centroid. Repeated rows and equal ids are vectors of
    their own; copies of one vector may all be centroids, of which the first gets every
    vector and the others stay. With fewer usable ids there are fewer centroids. Other
    columns are not read. Scaled components beyond 2^27 are an error. Nothing but sums
    moves: a number per centroid, component and task.
    """
    vectors = rows.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("vector")).filter(usable(F.col("vector"), components))
    places = initial(vectors, centroids, components, scale)
    if not len(places):  # no id to start from: without centroids nothing is assigned
        return vectors.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0), places
    for _ in range(rounds):
        places = moved(vectors, VantageTree(places), components, scale)
    return assigned(vectors, VantageTree(places), components, scale), places


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def op13_centroids(spark, sf_dir: str) -> DataFrame:
    found, places = cluster(table(spark, sf_dir, "embeddings"))
    stored, _ = store(found, "clusters")
    sums = {r["cluster"]: r["inertia"] for r in stored.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    per_cluster = spark.createDataFrame(
        [(c, sums.get(c, 0), sum(sums.values()), digest(p)) for c, p in enumerate(places)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return stored.join(F.broadcast(per_cluster), "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _oracle() -> str:
    """The rounds written out; a vector is a row per component."""
    parts = [
        f"""kept AS (
  SELECT row_number() OVER () AS row, vec_id, embedding FROM embeddings
  WHERE len(embedding) = {COMPONENTS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {COMPONENTS}
)""",
        f"""flat AS (
  SELECT row, vec_id, unnest(range({COMPONENTS})) AS i, CAST(floor({SCALE} * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM kept
)""",
        f"""c0 AS (
  SELECT c, i, x FROM flat JOIN (
    SELECT row, row_number() OVER (ORDER BY sha256('1:' || vec_id), embedding) - 1 AS c FROM kept WHERE vec_id IS NOT NULL
    QUALIFY c < {CENTROIDS}
  ) USING (row)
)""",
    ]
    for n in range(ROUNDS + 1):
        parts.append(f"""a{n} AS (
  SELECT row, vec_id, c, CAST(d AS BIGINT) AS d FROM (
    SELECT row, vec_id, c, sum((f.x - k.x) * (f.x - k.x)) AS d FROM flat f JOIN c{n} k USING (i) GROUP BY row, vec_id, c
  ) QUALIFY row_number() OVER (PARTITION BY row ORDER BY d, c) = 1
)""")
        if n < ROUNDS:
            parts.append(f"""c{n + 1} AS (
  SELECT c, i, CASE WHEN n IS NULL THEN x ELSE (s - ((s % n) + n) % n) // n END AS x FROM c{n} LEFT JOIN (
    SELECT c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM a{n} JOIN flat USING (row) GROUP BY c, i
  ) USING (c, i)
)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha AS centroid_sha256
FROM a{ROUNDS} JOIN (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS sha FROM c{ROUNDS} GROUP BY c) USING (c)"""


ORACLE = _oracle()
