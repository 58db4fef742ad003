"""Connected components of an edge table by alternating star contractions.

Nodes are longs.  Each round is two grouped minima and two equi-joins; nothing
is collected, a hub is only ever one key of a partially aggregated minimum, and
the joins on a hub key are ordinary equi-joins that adaptive execution splits.
Every round is cut by a reliable checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (both.where("b > a").join(low, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    return (down.join(low, "a")
            .select(F.explode(F.array(F.struct(F.col("a").alias("x")), F.struct(F.col("b").alias("x"))))
                    .alias("s"), "m")
            .select(F.col("s.x").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): component is the smallest
    node reachable.  Null ends and loops are dropped; an empty table gives no rows.

    Stops when every edge points from a node to a root; the number of rounds is
    logarithmic in the longest path for practical graphs and bounded by
    ``max_rounds`` only as a guard that raises.
    """
    now = stored(edges.where("a is not null and b is not null and a <> b")
                 .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(max_rounds):
        open_ends = now.select(F.col("b").alias("a")).join(now.select("a"), "a", "left_semi")
        twice = now.groupBy("a").count().where("count > 1").select("a")
        if open_ends.union(twice).isEmpty():
            return (now.select(F.col("a").alias("node"), F.col("b").alias("component"))
                    .union(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())
        now = stored(_small_star(_large_star(now)))
    raise RuntimeError("components did not settle")
