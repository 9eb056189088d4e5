"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reached) for the nodes of ``u, v`` edges.

    Each round points every node's neighbours at the smallest of them, first
    the larger neighbours, then the smaller; rounds grow with the logarithm of
    the longest path.  Minima are pre-aggregated before their shuffle and
    joined back, so a node of very many links is split like any skewed join.
    """
    big, small = F.greatest("u", "v"), F.least("u", "v")
    now = stored(edges.filter("u <> v").select(big.alias("u"), small.alias("v")).distinct(), "edges")
    seen = _state(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        to_low = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(to_low.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        state = _state(now)
        if state == seen:
            break
        seen = state
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _state(edges: DataFrame):
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
    ).first()
    return row["n"], row["h"]
