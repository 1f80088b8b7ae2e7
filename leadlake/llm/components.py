"""Connected components of a link table, as Spark jobs.

Alternating large-star and small-star steps replace every link by one to the
smallest neighbour until all links point to their component's smallest node.
Links stay in tables of the shared folder; only a count and a checksum per round
reach the driver. A node of high degree is reduced by partial aggregation, and
its join partition is one that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.llm.common import written


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("v", "u"))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.union(low.select("u", "m")).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of a link: the smallest node it reaches. ``links``: columns u, v (long).

    Null ends and links of a node to itself are no links; without links the result is empty."""
    now = written(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                  "links")
    state = None
    while True:
        new = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == state or new[0] == 0:
            break
        state = new
        now = written(_small_star(_large_star(now)), "links")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())
