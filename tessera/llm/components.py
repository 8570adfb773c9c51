"""Connected components of a graph held as a table of edges.

Alternating large-star and small-star steps (Kiveris et al., 2014): each step joins
every node with its smallest neighbour, so rounds grow with the logarithm of a
component's diameter, and no node's neighbours are gathered in one place: a step is
an aggregated minimum joined back to the edges, which adaptive execution splits where
one node has very many. Edges are written to the shared folder after every round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import saved


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node on an edge (a, b): root is its component's least node."""
    edges = saved(edges.select("a", "b").filter("a <> b").distinct())
    seen = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        state = (state["n"], state["h"])
        if state == seen or not state[0]:
            break
        seen = state
        edges = saved(_small_star(_large_star(edges)))
    own = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(own)
