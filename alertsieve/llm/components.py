"""Connected components of a link table, by alternating star contraction in Spark.

Every round links each node's larger neighbours to its smallest one (large star), then its
smaller neighbours to the smallest (small star), until every component is one star.  Only the
links move, each round is written to the shared folder, and nothing but one count reaches the
driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _with_low(pairs: DataFrame) -> DataFrame:
    """pairs (u, v) with m: the smallest of u and its neighbours.  The minimum is written first:
    the join back is then two plain shuffles, which Spark splits where one node has many links."""
    low = stored(pairs.groupBy("u").agg(F.min("v").alias("m")), "star")
    return pairs.join(low, "u").withColumn("m", F.least("u", "m"))


def _is_stars(links: DataFrame) -> bool:
    """Every upper end has one link, and no lower end is also an upper one."""
    ends = links.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")),
                                          F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))).alias("e"))
    odd = (ends.groupBy("e.node").agg(F.sum("e.up").alias("ups"), F.count(F.lit(1)).alias("n"))
           .filter("ups > 1 OR (ups = 1 AND n > 1)"))
    return odd.agg(F.count(F.lit(1))).first()[0] == 0


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that has a link; root is the smallest node of its component."""
    links = stored(links.filter(F.col(a) != F.col(b))
                   .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")), "links")
    while not _is_stars(links):
        both = links.select(F.explode(F.array(F.struct("u", "v"), F.struct(
            F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")
        large = _with_low(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _with_low(large)
        links = stored(small.select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.*").filter("u != v").distinct(), "links")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def relabel(rows: DataFrame, roots: DataFrame, column: str = "class") -> DataFrame:
    """``rows`` and ``root``: the root of their node, or the node itself where it has no link."""
    named = roots.select(F.col("node").alias(column), "root")
    return rows.join(named, column, "left").withColumn("root", F.coalesce("root", column))
