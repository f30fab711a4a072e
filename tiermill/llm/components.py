"""Connected components of a graph given as edges, by alternating star contraction.

Each round writes its edges to the shared folder, so a lost executor costs one round's tasks. A hot
node's smallest neighbour comes from a partial aggregate. The join that carries it back has that aggregate on
one side, so all edges of a node meet in one task; a round leaves a node's edges spread over other nodes, and
edges are given as spanning links, a few per node. Only two numbers per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.common import stored

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    joined = both.join(least, "u").withColumn("m", F.least("m", "u"))
    return joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    return joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        least.select("u", F.col("m").alias("v"))
    )


def components(edges: DataFrame) -> DataFrame:
    """``(u, v)`` edges in, ``(node, root)`` out for every node of an edge; root is the least node.

    Loops, null ends and repeated edges change nothing; no edges give no rows.
    """
    now = stored(
        edges.filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    seen = None
    for _ in range(MAX_ROUNDS):
        now = stored(_small_star(_large_star(now).distinct()).distinct(), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
