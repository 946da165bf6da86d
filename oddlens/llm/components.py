"""Connected components of a link table, by alternating large and small stars.

Each round writes the links to the shared folder. A node of any degree is handled by
minimum aggregation and a join, never by a list of its neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddlens.llm.common import written


def _print(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("s")).first()
    return row.n, row.s


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) of long nodes -> (node, root) for every node above its root, the
    smallest node of its component. Roots themselves and unlinked nodes have no row."""
    a, b = F.col("a"), F.col("b")
    links = links.where(a != b).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()
    seen = None
    while True:
        both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(links.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (
            large.join(lowest, "hi")
            .select(F.explode(F.array(F.struct(F.col("hi").alias("hi"), F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e"))
            .select("e.hi", "e.lo")
            .where("hi != lo")
            .distinct()
        )
        links = written(small, "links")
        now = _print(links)
        if now == seen:
            return links.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        seen = now
