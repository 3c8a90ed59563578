"""Connected components of a graph that is held as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labtide.llm.staging import staged


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Re-link neighbours to the smallest one among a node and its neighbours.

    The large star moves a node's greater neighbours, the small star its smaller ones and the node itself. The smallest
    neighbour is a flat aggregate, combined before the shuffle, and comes back by a join: no neighbourhood is gathered.
    The aggregate is written out, so that the join has exchanges of its own and adaptive execution can split the links of
    a node that many links lead to.
    """
    ends = links
    if large:
        ends = links.unionAll(links.select(F.col("low").alias("node"), F.col("node").alias("low")))
    least = staged(ends.groupBy("node").agg(F.least(F.min("low"), F.col("node")).alias("least")), "least")
    moved = ends.join(least, "node")
    if large:
        moved = moved.where("low > node").select(F.col("low").alias("node"), F.col("least").alias("low"))
    else:
        moved = moved.select(F.col("low").alias("node"), F.col("least").alias("low")).unionAll(
            least.select("node", F.col("least").alias("low"))
        )
    return moved.where("node <> low").distinct()


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """Node and the smallest node that links lead to, for every node of a link except the smallest ones themselves.

    Large and small stars alternate until the links stay the same; each round is written out. Links with a null end and
    links of a node with itself are left out; an empty table of links gives an empty result.
    """
    now = staged(
        links.where(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col(left) != F.col(right)))
        .select(F.greatest(left, right).alias("node"), F.least(left, right).alias("low"))
        .distinct(),
        "links",
    )
    before = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("node", "low").cast("decimal(38,0)"))).first()
        if mark == before or mark[0] == 0:
            return now.select("node", F.col("low").alias("component"))
        before = mark
        moved = staged(_star(now, large=True), "moved")
        now = staged(_star(moved, large=False), "links")
