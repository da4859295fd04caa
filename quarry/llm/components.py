"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import drop_stored, stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Link every neighbour (large: with a greater id; small: not greater)
    of a node to the least node around it. Only minima are aggregated, so a
    hub with any number of links is pre-aggregated before the shuffle."""
    if large:
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = around.join(least, "a")
    if large:
        out = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = (joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
               .unionByName(least.select("a", F.col("m").alias("b"))))
    return out.filter(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): for every id in the links the smallest id that links
    reach. Self links give the id itself; repeated links count once.

    Large and small star steps alternate until nothing changes (about the
    logarithm of the component size); each round is a table in the shared
    folder, the previous one is removed."""
    ids = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a is not null and b is not null")
    edges = stored(ids.filter("a != b").distinct(), "links")
    mark = None
    while True:
        after = stored(_stars(_stars(edges, large=True), large=False), "links")
        seen = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        drop_stored(edges)
        edges = after
        if seen == mark:
            break
        mark = seen
    stars = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return stars.unionByName(roots)
