"""Connected components of an undirected graph, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslake.llm.common import discard, join_many, store


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, of every node with an edge.

    Each round hangs the larger neighbours of a node on its smallest one, then the
    smaller neighbours; it ends when every node has one smaller neighbour and no larger
    ones, or only larger ones. Rounds and the nearest neighbours are stored in the shared
    folder, so the lineage stays short, nothing is computed twice, and lost executors cost
    one round. Rows with a null end and loops link nothing.
    """
    spark = edges.sparkSession
    oriented = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    e, folder = store(oriented.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "components")
    while True:
        both = e.select("u", "v", F.lit(1).alias("up")).unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"), F.lit(0).alias("up")))
        nearest, near_folder = store(both.groupBy("u").agg(F.min("v").alias("m"), F.sum("up").alias("ups"), F.count("*").alias("n")), "nearest")
        if nearest.filter("ups > 1 OR (ups = 1 AND n > 1)").isEmpty():
            discard(spark, near_folder)
            break
        large, large_folder = store(
            join_many(both.filter("up = 0").select("u", "v"), nearest.select("u", "m"), "u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct(), "large-stars"
        )
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = join_many(large, smallest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = moved.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct()
        following, new_folder = store(small, "components")
        for done in (folder, near_folder, large_folder):
            discard(spark, done)
        e, folder = following, new_folder
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
