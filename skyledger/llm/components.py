"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skyledger.staging import StagingArea


#: A node with more edges than this is joined by broadcasting, of such nodes the ``MOST_CENTRES`` with most.
CENTRE_EDGES, MOST_CENTRES = 1024, 10_000


def _linked_to_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """(u, v) -> (v, least neighbour of u); ``least`` is a written table (u, m, n)."""
    centres = F.broadcast(
        least.where(F.col("n") > CENTRE_EDGES).orderBy(F.desc("n"), "u").limit(MOST_CENTRES).select("u", "m")
    )
    others = edges.join(centres.select("u"), "u", "left_anti").join(least.select("u", "m"), "u")
    return edges.join(centres, "u").unionByName(others).select(F.col("v").alias("u"), F.col("m").alias("v"))


def components(edges: DataFrame, area: StagingArea) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the least node reachable.

    A round links every node first to its least neighbour's side (large star),
    then the smaller neighbours to the least of them (small star). Both are a
    grouped minimum and a join back; the edges of a node with very many of them
    are joined where they lie. Rounds grow with the logarithm of the longest
    chain; each is written, so a lost executor repeats one round. They end when
    no edge has changed.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    pairs = area.table(pairs.distinct(), "edges")
    changed = not pairs.isEmpty()
    while changed:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
        large = area.table(_linked_to_least(both.where("v > u"), area.table(least, "least")).distinct(), "large-star")
        least = area.table(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "least")
        small = _linked_to_least(large, least).where("u <> v").unionByName(least.select("u", F.col("m").alias("v")))
        before, pairs = pairs, area.table(small.distinct(), "small-star")
        changed = pairs.count() != before.count() or not pairs.join(before, ["u", "v"], "left_anti").isEmpty()
    own = pairs.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return own.unionByName(roots.join(own.select("node"), "node", "left_anti"))
