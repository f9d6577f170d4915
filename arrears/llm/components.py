"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.sources.staging import stage


def star_components(links: DataFrame) -> DataFrame:
    """Columns ``node`` and ``root`` for every node with a link, root the smallest one.

    ``links`` has two long columns ``a`` and ``b`` in either order. Nulls, self-links and
    repeats do no harm; a table without links gives an empty result. Alternates two steps
    that keep components: every node sends its larger neighbours to its smallest one, then
    every node sends its smaller neighbours and itself there. The links end as one star per
    component. Each round shrinks towards that in a few rounds even for long chains. A hub
    is never gathered in one task: minima are combined before the shuffle, and the join
    back is an equi-join whose large partitions adaptive execution splits.
    """
    now = stage(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = None
    while True:
        state = now.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
        ).first()
        if state == before:
            break
        before = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.join(least.select("a", F.least("a", "m").alias("m")), "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        large = stage(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stage(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
