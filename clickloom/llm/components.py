"""Connected components of a link table, by randomised contraction.

In each round every node points at the neighbour (or itself) with the least seeded hash, and the
graph is contracted along these pointers. Hashes change each round, so long chains shrink by a
constant factor as well, and a hub with a third of all links costs one partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import settle


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node in ``links(a, b)``; nodes joined by a path share ``root``.

    Links may be repeated, in either direction, or loops. Null ends are ignored; no links give an
    empty table. ``root`` is some node of the component, not necessarily its least.
    """
    edges = settle(links.filter("a is not null and b is not null").select("a", "b")
                   .filter("a != b").distinct(), "links")
    nodes = edges.select("a").union(edges.select("b")).distinct().select(
        F.col("a").alias("node"), F.col("a").alias("root"))
    roots = settle(nodes, "roots")
    turn = 0
    while not edges.isEmpty():
        turn += 1
        rank = F.xxhash64(F.lit(turn), "b")
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        best = both.groupBy("a").agg(F.min(F.struct(rank.alias("h"), F.col("b"))).alias("m"))
        own = F.struct(F.xxhash64(F.lit(turn), "a").alias("h"), F.col("a").alias("b"))
        step = settle(best.select(F.col("a").alias("old"),
                                  F.least("m", own)["b"].alias("new")), "step")
        at_a = step.select(F.col("old").alias("a"), F.col("new").alias("na"))
        at_b = step.select(F.col("old").alias("b"), F.col("new").alias("nb"))
        edges = settle(edges.join(at_a, "a").join(at_b, "b").filter("na != nb")
                       .select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b"))
                       .distinct(), "links")
        roots = settle(roots.join(step, roots["root"] == step["old"], "left")
                       .select("node", F.coalesce("new", "root").alias("root")), "roots")
    return roots
