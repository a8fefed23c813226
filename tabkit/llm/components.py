"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.session import discard, store


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Large star: a node's greater neighbours go to its least one; small star: its smaller neighbours and itself do.

    The least neighbour is found with map-side combining; a node with very many links is split by the skewed join.
    """
    if large:
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).select(F.col("a").alias("x"), "m")
    joined = both.join(least, both["a"] == least["x"])
    if large:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("x").alias("a"), F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links(a, b)`` but the least of each component, whose label it is.

    Every step writes a table into the shared folder, so that lineage stays short and lost executors cost one step.
    """
    now = store(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    marks = lambda t: tuple(t.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    mark = marks(now)
    while True:
        before, now = now, store(_stars(_stars(now, large=True), large=False))
        discard(before)
        seen = marks(now)
        if mark == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("label"))
        mark = seen
