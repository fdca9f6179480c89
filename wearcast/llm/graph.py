"""Connected components by alternating large-star and small-star steps
(Kiveris et al., 2014), as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop_cut


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (BIGINT columns a, b);
    the component is its smallest node.  Self-edges and repeats are fine; an
    empty frame gives an empty one."""
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = cut(pairs)
    seen = None
    while (state := _state(now)) != seen:
        seen = state
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(
            "u <> v").distinct()
        large = cut(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            low.select("u", F.col("m").alias("v"))).distinct()
        after = cut(small)
        drop_cut(now)
        drop_cut(large)
        now = after
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionAll(leaves.select(F.col("component").alias("node"), "component").distinct())
