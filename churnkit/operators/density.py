"""Density clustering with noise (C6, re-aimed).

The reference's HDBSCAN needs all pairwise (mutual-reachability) distances.
Here density is measured on a grid instead, so the work stays linear:

1. every point falls in a cell of side ``cell`` (low-dimensional space, e.g. PCA);
2. a cell is dense when it holds >= ``min_points`` points (one aggregate —
   a cell holding a third of the table is one count, not a hot task);
3. dense cells touching each other (Chebyshev distance 1) are linked — the
   edge list is bounded by 3^d x dense cells (so few dimensions);
4. connected components of the cell graph by alternating stars (rounds grow
   with the logarithm of the longest chain; the loop ends when nothing changes);
5. components with fewer than ``min_cluster_size`` points, and points of
   sparse cells, are noise (-1); clusters are numbered 0.. by their smallest cell.

This is a flat density cut, not HDBSCAN's stability-based hierarchy.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from churnkit.operators.components import components
from churnkit.session import stored


def _cell_cols(dims: Sequence[str], cell: float) -> list:
    return [F.floor(F.col(d) / F.lit(float(cell))).cast("long").alias(f"_g{i}") for i, d in enumerate(dims)]


def grid_density_clusters(df: DataFrame, key: str, dims: Sequence[str], cell: float, min_points: int = 5,
                          min_cluster_size: int = 50, out: str = "cluster", keep: Sequence[str] = ()) -> DataFrame:
    """``key``, ``dims``, ``keep`` and the cluster number of every point."""
    spark = df.sparkSession
    nd = len(dims)
    g = [f"_g{i}" for i in range(nd)]
    carried = list(dict.fromkeys([key, *dims, *keep]))
    pts = df.select(*carried, *_cell_cols(dims, cell))
    counts = pts.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"))
    # Cells get numbers of their own: no hash can make two cells one.
    dense = stored(spark, counts.where(F.col("_n") >= min_points).withColumn("_cid", F.monotonically_increasing_id()), "cells")
    # neighbour cells of each dense cell, matched against dense cells; a pair is met from one side
    offsets = [o for o in itertools.product((-1, 0, 1), repeat=nd) if o > (0,) * nd]
    off_arr = F.array(*[F.array(*[F.lit(v) for v in o]) for o in offsets])
    nb = dense.select("_cid", *g, F.explode(off_arr).alias("_o")).select(
        F.col("_cid").alias("a"), *[(F.col(g[i]) + F.col("_o")[i]).alias(g[i]) for i in range(nd)])
    edges = nb.join(dense.select(F.col("_cid").alias("b"), *g), g).select("a", "b")
    comp = components(spark, edges).withColumnRenamed("node", "_cid")
    cells = dense.join(comp, "_cid", "left").withColumn("_comp", F.coalesce("component", "_cid"))
    sizes = cells.groupBy("_comp").agg(F.sum("_n").alias("_size"), F.min(F.struct(*g)).alias("_lab"))
    kept = sizes.where(F.col("_size") >= min_cluster_size).withColumn("_one", F.lit(1))
    # numbered by the smallest cell: a count of the clusters before, summed over ranges of cells
    order = F.struct(*[F.col("_lab")[c] for c in g])
    first = kept.repartitionByRange(order).select("_comp", "_lab", F.spark_partition_id().alias("_part"))
    first = stored(spark, first, "clusters")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    sums = first.groupBy("_part").agg(F.count(F.lit(1)).alias("_k")).select("_part", F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_off"))
    numbered = first.join(sums, "_part").select(
        "_comp", (F.col("_off") + F.row_number().over(Window.partitionBy("_part").orderBy("_lab")) - 1).cast("int").alias(out))
    cell_cluster = cells.join(numbered, "_comp").select(*g, out)
    return pts.join(cell_cluster, g, "left").select(*carried, F.coalesce(F.col(out), F.lit(-1)).alias(out))


def cluster_count(df: DataFrame, cluster: str, noise: int = -1) -> int:
    """Number of clusters without the noise label (fixes D1)."""
    return df.where(F.col(cluster) != noise).select(cluster).distinct().count()
