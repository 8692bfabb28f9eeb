"""Connected components of a table of links, by alternating star contractions.

Each round replaces links by links to smaller nodes, until every component is
a star around its smallest node.  Nodes and links never leave the executors;
rounds are cut by written tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _large_star(links: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest of all."""
    both = links.union(links.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("u", "m"))


def components(links: DataFrame) -> DataFrame:
    """``node, root``: the smallest node that each node of ``links`` (two long columns) reaches.

    Only nodes that have a link are returned, roots included.  Links in either
    direction, repeated links and links to oneself are fine; null ends aren't links.
    """
    a, b = links.columns
    e = staged(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).dropna()
               .filter("a <> b").distinct(), "links")
    state = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
        e = staged(_small_star(_large_star(e)).filter("a <> b").distinct(), "links")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select("b", "b").distinct())
