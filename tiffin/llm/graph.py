"""Connected components of an edge table, with joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.llm.store import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable from each node that an edge names.

    Alternates two steps until nothing changes: each node ties its larger neighbours to the smallest node it sees, then its
    smaller ones. The number of rounds grows with the logarithm of the longest path. Every round is written out, so it depends
    on the last one alone; the smallest neighbour is found before the shuffle, so a node with very many edges is one row a task.
    Edges with a null end are ignored, loops give a component of one node, repeated edges count once.
    """
    named = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null")
    loops = named.filter("u = v").select(F.col("u").alias("node"), F.col("v").alias("component")).distinct()
    now = stored(named.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = _mark(now)
    while True:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = tied.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).unionAll(
            least.select("u", F.col("m").alias("v"))
        )
        now = stored(small.distinct(), "edges")
        after = _mark(now)
        if after == seen:
            break
        seen = after
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots).distinct().unionAll(
        loops.join(now.select(F.col("u").alias("node")).unionAll(now.select(F.col("v").alias("node"))).distinct(), "node", "left_anti")
    )


def _mark(edges: DataFrame) -> tuple:
    """Count and checksum of a set of edges: equal if a round changed nothing."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
