"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendscope.session import stored


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) for the nodes of ``links`` (a long, b long).

    Each round every node moves to its neighbour of the lowest rank, itself included, where
    ranks are new random numbers; links between moved nodes make the next, smaller graph.
    The number of rounds grows with the logarithm of the longest path. Rounds are written to
    the shared folder, so lost executors cost nothing. Only their row counts reach the driver.
    """
    links = stored(links.where(F.col("a") != F.col("b")).select("a", "b"), "links")
    levels: list[DataFrame] = []
    while not links.isEmpty():
        turn = len(levels)
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank, own = (F.struct(F.xxhash64(c, F.lit(turn)).alias("rank"), F.col(c).alias("node")) for c in "ba")
        best = both.groupBy("a").agg(F.min(rank).alias("best"))
        moves = best.select(F.col("a").alias("node"), F.least(own, "best")["node"].alias("to"))
        moves = stored(moves, "moves")
        levels.append(moves)
        ends = [moves.select(F.col("node").alias(c), F.col("to").alias(f"to_{c}")) for c in "ab"]
        moved = links.join(ends[0], "a").join(ends[1], "b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))
        moved = moved.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        links = stored(moved.distinct(), "links")
    if not levels:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    place = levels[0]
    for moves in levels[1:]:
        step = moves.select(F.col("node").alias("to"), F.col("to").alias("next"))
        place = place.join(step, "to", "left").select("node", F.coalesce("next", "to").alias("to"))
    return place.withColumnRenamed("to", "component")
