"""Connected components of a link table, by rounds of joins and no driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punji.runtime import cut


def connected_components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links``; the component is its smallest node.

    Alternates large-star and small-star steps, each one shuffle with map-side minima, until a round changes
    nothing. Rounds are logarithmic in the longest chain. An empty link table gives an empty result; links that are
    null on either side are left out, and a link to itself keeps its node. Raises if ``max_rounds`` doesn't suffice.
    """
    pairs = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null")
    loops = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    edges = cut(pairs.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(small, "u")
        after = cut(
            joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .unionByName(joined.select("u", F.col("m").alias("v")))
            .distinct()
        )
        same = after.join(edges, ["u", "v"], "left_anti").isEmpty() and edges.join(after, ["u", "v"], "left_anti").isEmpty()
        edges = after
        if same:
            roots = edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
            return loops.join(roots, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    raise RuntimeError(f"components not settled after {max_rounds} rounds")
