"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookfuse.llm.common import stored

#: Links that fit into as many tasks as run at once; only the number of files depends on it.
FEW_LINKS = 5_000_000


def _smallest(edges: DataFrame) -> DataFrame:
    """Rows (u, v, m): each edge with the smallest of u and its neighbours. Minima are taken before the join."""
    least = edges.groupBy("u").agg(F.min("v").alias("least")).withColumnRenamed("u", "at")
    return edges.join(least, F.col("u") == F.col("at")).select("u", "v", F.least("u", "least").alias("m"))


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of ``links`` (a, b) reaches.

    Large star and small star by turns: every node hands its larger, then its smaller neighbours to the smallest node
    it knows, until nothing moves; the number of turns grows with the logarithm of the longest path. Each turn is
    written to the shared folder, and the driver sees one row of sums. Links with a null end or from a node to itself
    join nothing; repeated links are one.
    """
    edges = stored(
        links.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    # Small tables in many partitions would cost more in tasks than in work.
    few = edges.count() < FEW_LINKS
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _smallest(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        # What large star leaves points from a node to a smaller one.
        least = _smallest(large)
        small = least.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = stored(small.coalesce(max(1, small.sparkSession.sparkContext.defaultParallelism)) if few else small, "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == state:
            return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
        state = now
