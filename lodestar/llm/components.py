"""Connected components by alternating large-star and small-star rounds.

Every round reconnects each node's neighbours to the smallest node it knows, with
two aggregations and joins on the node; rounds end when the links no longer
change.  Links are checkpointed to the shared folder each round, so no lineage
grows and nothing but two counters reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.session import shared_dir


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every non-root node of the links ``(u, v)`` (longs); the root
    is the smallest node of the component.  No links: no rows."""
    shared_dir(links.sparkSession)
    now = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct().checkpoint()
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        now = (small.where(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
               .unionByName(low.select("u", F.col("m").alias("v"))).distinct().checkpoint())
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
