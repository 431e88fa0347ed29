"""Connected components by repeated contraction, for graphs of any size and shape.

Each round every node moves to the best node of its closed neighbourhood (highest degree,
ties by a hash that changes with the round), edges are relabelled, loops and repeats go.  A
star vanishes in one round, a long chain loses a constant fraction of its nodes in each, so
the number of rounds grows with the logarithm of the number of nodes.  Degrees and best neighbours are partial
aggregates, so a hub is summed up before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.base import cut


def connected_components(edges: DataFrame) -> DataFrame:
    """(u, v) -> (node, root): nodes of one component share ``root``, one of its nodes.

    Loops, repeated and reversed edges and edges with a null end are allowed (the last are
    ignored); a node without any other edge than a loop isn't returned.
    """
    live = edges.select("u", "v").where("u <> v")
    live = cut(live.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    moves: list[DataFrame] = []
    while not live.isEmpty():
        both = live.unionByName(live.select(F.col("v").alias("u"), F.col("u").alias("v")))
        rank = both.groupBy("u").agg(F.count("*").alias("n")).select("u", F.struct("n", F.xxhash64("u", F.lit(len(moves))).alias("h"), F.col("u").alias("id")).alias("rank"))
        rank = cut(rank, "ranks")
        best = both.join(rank.select(F.col("u").alias("v"), "rank"), "v").groupBy("u").agg(F.max("rank").alias("best"))
        move = cut(rank.join(best, "u").select("u", F.greatest("rank", "best")["id"].alias("to")), "moves")
        moves.append(move)
        a = live.join(move, "u").select(F.col("to").alias("u"), "v")
        b = a.join(move.select(F.col("u").alias("v"), F.col("to")), "v").select("u", F.col("to").alias("v")).where("u <> v")
        live = cut(b.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    if not moves:
        return live.select(F.col("u").alias("node"), F.col("v").alias("root"))
    out = moves[0].select(F.col("u").alias("node"), F.col("to").alias("root"))
    for move in moves[1:]:
        step = move.select(F.col("u").alias("root"), F.col("to"))
        out = out.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return out
