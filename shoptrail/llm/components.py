"""Distributed union-find: components of a graph whose edges are a table.

Every round hooks the neighbours of each node to the smallest of them, first the larger neighbours
("large star"), then the smaller ones ("small star"). Edges never grow in number, and the rounds
needed grow with the logarithm of the number of nodes. A node's minimum is combined inside the tasks before
the shuffle and then joined back, so a node with very many edges is only a large key of a
join, which adaptive execution splits. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.common import stage


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One hooking step on rows (a, b), a > b; gives such rows again."""
    if larger:  # every node looks at all its neighbours and hooks the larger ones
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:  # every node looks at its smaller neighbours and hooks itself and them
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = near.join(least, "u")
    if larger:
        hooked = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        hooked = joined.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return hooked.where("a <> b").distinct()


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """Rows (node, component) for each node with an edge; component is the smallest node reachable.

    Nodes are of any ordered type. Loops, repeated edges and edges given both ways change nothing;
    edges with a null end are left out. Without edges the result is empty.
    """
    now = stage(
        edges.where(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col(left) != F.col(right)))
        .select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b"))
        .distinct(),
        "edges",
    )
    state = None
    while True:
        # the same edges as a round before: each node is tied to its component's smallest one
        known = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if known == state or not known[0]:
            break
        state = known
        now = stage(_star(_star(now, larger=True), larger=False), "edges")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
