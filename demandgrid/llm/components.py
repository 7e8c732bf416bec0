"""Connected components of a link table by DataFrame rounds.

Every round maps each node to the neighbour (itself included) with the smallest
hash and contracts the links; a hash that changes by round makes even a long path
shrink by a constant share, so the number of rounds is logarithmic. All group-bys
are minima, which are combined before the shuffle, so a hub with very many links
is no hot group. Each round is a written table: lineage stays short and a lost
executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandgrid.llm.base import materialize


def _contract(links: DataFrame, turn: int) -> DataFrame:
    """(node, parent) for every node that has a link."""
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
        links.select(F.col("b").alias("node"), F.col("a").alias("other"))
    )
    rank = lambda c: F.xxhash64(F.lit(turn), F.col(c))
    nearest = both.groupBy("node").agg(F.min(F.struct(rank("other").alias("r"), F.col("other").alias("id"))).alias("m"))
    own = F.struct(rank("node").alias("r"), F.col("node").alias("id"))
    return nearest.select("node", F.least(F.col("m"), own)["id"].alias("parent"))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): every node of a link with the smallest node it is joined to.

    Self links, repeated links and links in both directions are allowed; rows with
    a null end are no links. No link gives an empty table.
    """
    start = materialize(
        links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null").distinct(),
        "links",
    )
    left, levels = start.where("a != b"), []
    while not left.isEmpty():
        parents = materialize(_contract(left, len(levels)), "parents")
        levels.append(parents)
        moved = (
            left.join(parents.toDF("a", "pa"), "a").join(parents.toDF("b", "pb"), "b").where("pa != pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct()
        )
        left = materialize(moved, "links")
    nodes = start.select(F.col("a").alias("node")).union(start.select(F.col("b").alias("node"))).distinct()
    tops = None
    for parents in reversed(levels):  # the root of each level's nodes, from the last level to the first
        if tops is None:
            tops = parents.select("node", F.col("parent").alias("top"))
            continue
        joined = parents.join(tops.select(F.col("node").alias("parent"), "top"), "parent", "left")
        tops = materialize(joined.select("node", F.coalesce("top", "parent").alias("top")), "tops")
    if tops is None:
        return nodes.select("node", F.col("node").alias("root"))
    named = materialize(nodes.join(tops, "node", "left").select("node", F.coalesce("top", "node").alias("top")), "tops")
    smallest = named.groupBy("top").agg(F.min("node").alias("root"))
    return named.join(smallest, "top").select("node", "root")
