"""Connected components of a large graph, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import settled

MAX_ROUNDS = 50


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction of (node, to) with node > to.

    Large: a node's larger neighbours go to its smallest. Small: its smaller ones do. Neighbours
    are never gathered; the smallest one meets them in a join, which splits a hot node.
    """
    both = edges if not large else edges.unionByName(edges.selectExpr("to AS node", "node AS to"))
    least = both.groupBy("node").agg(F.least(F.min("to"), F.col("node")).alias("least"))
    met = both.join(least, "node")
    if large:
        moved = met.filter("to > node").selectExpr("to AS node", "least AS to")
    else:
        moved = met.selectExpr("to AS node", "least AS to").unionByName(
            least.selectExpr("node", "least AS to")
        )
    return moved.filter("node > to").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node that is not its component's smallest, with that smallest one.

    ``edges`` is (node, to) of one comparable type; loops and null ends are dropped. Rounds grow
    with the logarithm of the longest path. Each is written to the shared folder, which cuts the
    lineage; the test for the end compares a count and a checksum, nothing else reaches the driver.
    """
    edges = settled(
        edges.filter("node <> to")
        .selectExpr("greatest(node, to) AS node", "least(node, to) AS to")
        .distinct(),
        "edges",
    )
    last = None
    for _ in range(MAX_ROUNDS):
        now = edges.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("node", "to")), F.min("to"), F.max("node")
        ).first()
        if now == last or now[0] == 0:
            return edges.withColumnRenamed("to", "root")
        last = now
        edges = settled(_star(_star(edges, large=True), large=False), "edges")
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
