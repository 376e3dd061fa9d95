"""Connected components by alternating stars: the rounds grow with the logarithm of the longest path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.session import release, stored


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1]


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """edges (a, b), long ids.  node, component (smallest id reachable) of every id on an edge between two ids.

    Every round hangs each node's larger neighbours, then its smaller ones, under the
    smallest; it stops when nothing changes.  No neighbourhood is collected: minima are
    aggregated before the shuffle and joined back.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stored(spark, edges, "components")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        last, edges = edges, stored(spark, small, "components")
        del both, low, large, least, small
        release(spark, last)  # a round's files go before the next round's come
        now = _state(edges)
        if now == state:
            break
        state = now
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
