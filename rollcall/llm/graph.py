"""Connected components of links between nodes, by DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.storage import land


def components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for every node of ``links`` (columns a, b; a != b).

    Large-star and small-star in turn: each node's neighbours are hung on the smallest of them, until every
    node hangs on its root alone. The smallest neighbour is an aggregation with partial sums, and it meets
    the links of its node by a join whose long keys Spark can split, so a node with very many links is not
    gathered anywhere. Each round is written to the shared folder; ``rows`` is about how many links there are, if that is known.
    """
    links = land(_ordered(links.select("a", "b")), "links", rows)  # a > b
    rows = links.count()
    state = None
    while True:
        # Large star: neighbours above a node hang on the smallest node around it.
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = _ordered(large)
        # Small star: a node and its neighbours below it hang on the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
        small = large.join(least, F.col("a") == F.col("n"))
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b").union(least.select(F.col("n").alias("a"), F.col("m").alias("b")))
        links = land(_ordered(small), "links", rows)
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    below = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return below.union(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _ordered(links: DataFrame) -> DataFrame:
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct()
