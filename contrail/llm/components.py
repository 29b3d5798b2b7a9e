"""Connected components by alternating large and small stars, on edge tables.

Each round groups edges by node with a partial minimum and joins the minimum
back, salted, so the many edges of a hub go to many tasks. The edges of a round
are written to the shared folder; the rounds grow with the logarithm of the
longest path, not with the number of nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import salted_join
from contrail.session import materialize_at, remove_staged


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """edges: u, v with u > v. Large: every larger neighbour of u to u's least
    neighbour or itself; small: u and its smaller neighbours to the least of them."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both if large else edges
    least = near.groupBy("u").agg(F.min("v").alias("m"))
    if large:
        least = least.select("u", F.least("u", "m").alias("m"))
    moved = salted_join(near, least, ["u"], ["v"])
    if large:
        out = moved.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            least.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges``: long columns u, v. Returns node, component (the least node of
    its component), one row for each node that has an edge to another."""
    spark = edges.sparkSession
    e = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    current, path = materialize_at(e.distinct(), "edges")
    state = None
    while True:
        mark = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
        if mark == state or not mark[0]:
            break
        state = mark
        following, new_path = materialize_at(_stars(_stars(current, True), False), "edges")
        remove_staged(spark, path)
        current, path = following, new_path
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionAll(current.select(F.col("v").alias("node"),
                                         F.col("v").alias("component")).distinct())
