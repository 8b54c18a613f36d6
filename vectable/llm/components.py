"""Connected components of a link table, by contraction.

Each round every node that has links picks the smallest node, by a hash that changes with
the round, within two links of it, and all links are renamed to the picks. Loops and repeats
vanish: a star is gone after one round, and a chain loses most of its nodes in each, so the
number of rounds is logarithmic. Nothing is gathered by node: picks are minima, which Spark
combines before the shuffle, and renaming is a join that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectable.llm.scratch import kept


def _ranked(column: str, turn: int) -> Column:
    return F.struct(F.xxhash64(F.col(column), F.lit(turn)).alias("rank"), F.col(column).alias("node"))


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``(node, root)`` for every node that occurs in ``links``; equal roots, same component.

    Links have no direction; loops are allowed. The root is some node of the component. Nulls
    link with nothing. An empty link table gives no rows.
    """
    pairs = links.select(F.col(left).alias("a"), F.col(right).alias("b"))
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = kept(both.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct())
    rounds: list[DataFrame] = []
    while not edges.isEmpty():
        turn = len(rounds)
        near = F.least(_ranked("a", turn), F.min(_ranked("b", turn)))
        nearest = edges.groupBy("a").agg(near.alias("best")).withColumnRenamed("a", "b")
        # The least of what the neighbours found is within two links, and no larger than what the node found.
        picks = edges.join(nearest, "b").groupBy("a").agg(F.min("best")["node"].alias("pick"))
        picks = kept(picks)
        rounds.append(picks)
        first = picks.select("a", F.col("pick").alias("left_pick"))
        second = picks.select(F.col("a").alias("b"), F.col("pick").alias("right_pick"))
        renamed = edges.join(first, "a").join(second, "b")
        edges = kept(
            renamed.where("left_pick <> right_pick")
            .select(F.col("left_pick").alias("a"), F.col("right_pick").alias("b"))
            .distinct()
        )
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("root"))
    roots = rounds[0].select(F.col("a").alias("node"), F.col("pick").alias("root"))
    for picks in rounds[1:]:  # logarithmically many
        moved = picks.select(F.col("a").alias("root"), "pick")
        roots = roots.join(moved, "root", "left").select("node", F.coalesce("pick", "root").alias("root"))
    return kept(roots)
