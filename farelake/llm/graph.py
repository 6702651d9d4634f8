"""Connected components of an edge table by contraction.

Each round every vertex points to the lowest ranked of itself and its
neighbours (a partial aggregate), and both ends of every edge move along the
pointers; edges inside a vertex vanish and the rest are made distinct. Ranks
hold for two rounds: in the first two they are the ids, which finishes a star
of any size, and then hashes, new ones each time, of which a constant share of
the vertices vanishes whatever the graph looks like: a chain of n takes about log
n rounds. At the end every component is named by its smallest vertex. Edges
and the map of vertices are stored in the shared folder after every round, and
those of the round before removed. Nothing is gathered on the driver.

Null ends are dropped; loops and repeated edges change nothing; no edges give
no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm.common import discard, stored


def components(spark: SparkSession, edges: DataFrame, scratch: list[str] | None = None) -> DataFrame:
    """(node, root) for every vertex of ``edges`` (a, b: long); root is the component's smallest vertex.

    The result is a stored table, added to ``scratch``.
    """
    edges = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    used: list[str] = []
    edges, nodes, kept, n = stored(spark, edges, "edges", used), None, [], 0
    while True:
        rank = lambda c: F.struct((F.col(c) if n < 2 else F.xxhash64(c, F.lit(n // 2))).alias("h"),  # noqa: E731, B023
                                  F.col(c).alias("v"))
        both = edges.union(edges.select("b", "a"))
        to = both.groupBy("a").agg(F.min(rank("b")).alias("m")).select(
            F.col("a").alias("v"), F.least(rank("a"), F.col("m"))["v"].alias("to"))
        to = stored(spark, to, "pointers", used)
        n += 1
        if nodes is None:
            nodes = to.select(F.col("v").alias("node"), F.col("to").alias("root"))
        else:
            nodes = nodes.join(to, nodes["root"] == to["v"], "left").select(
                "node", F.coalesce("to", "root").alias("root"))
        used += kept
        kept = []
        nodes = stored(spark, nodes, "roots", kept)
        moved = (edges.join(to, edges["a"] == to["v"]).select(F.col("to").alias("a"), "b"))
        moved = (moved.join(to, moved["b"] == to["v"]).select("a", F.col("to").alias("b"))
                 .where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        later: list[str] = []
        edges = stored(spark, moved, "edges", later)
        discard(spark, used)
        used = later
        if edges.isEmpty() and n <= 2:   # ranked by id: each root is its component's smallest vertex
            discard(spark, used)
            if scratch is not None:
                scratch += kept
            return nodes
        if edges.isEmpty():
            names = nodes.groupBy(F.col("root").alias("_r")).agg(F.min("node").alias("name"))
            named: list[str] = []
            out = stored(spark, nodes.join(names, nodes["root"] == names["_r"]).select("node", F.col("name").alias("root")),
                         "components", named)
            discard(spark, used + kept)
            if scratch is not None:
                scratch += named
            return out
