"""Saturation curves: all subsamples in one pass.

A subsample of exactly p reads is the first p by a hash salted with p, so that samples of unlike sizes are
independent.  Each read is hashed once for each point; only reads in the ranges of the hash that a sample
needs are shuffled, and every later step is grouped by point.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spotweave.operators import dedup


def saturation_points(n_reads: int, points: Sequence[int] | None = None) -> list[int]:
    """The points below the number of reads, in order; by default floor(1000 + 1000 e**x) for x from 0 to 14."""
    chosen = points if points is not None else [math.floor(1e3 + math.exp(x) * 1e3) for x in range(15)]
    kept = sorted(p for p in chosen if p < n_reads)
    if not kept:
        raise ValueError("all saturation points are above the number of reads")
    return kept


def subsamples(reads: DataFrame, points: Sequence[int], key: str) -> DataFrame:
    """The reads with ``point``: of each point exactly so many, by order of md5(point, key).

    Ranks are taken within 256 ranges of the hash, so no task holds a whole point.
    """
    salted = reads.withColumn("point", F.explode(F.array(*[F.lit(int(p)).cast("long") for p in points])))
    salted = salted.withColumn("draw", F.md5(F.concat_ws("_", F.col("point").cast("string"), F.col(key).cast("string"))))
    salted = salted.withColumn("range", F.substring("draw", 1, 2))
    sizes = salted.groupBy("point", "range").agg(F.count("*").alias("n"))
    before = sizes.select("point", "range", F.coalesce(F.sum("n").over(Window.partitionBy("point").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    near = salted.join(F.broadcast(before.where(F.col("before") < F.col("point"))), ["point", "range"])
    rank = F.row_number().over(Window.partitionBy("point", "range").orderBy("draw", key)) + F.col("before")
    return near.withColumn("rank", rank).where(F.col("rank") <= F.col("point")).drop("draw", "range", "before", "rank")


def saturation_curve(reads: DataFrame, points: Sequence[int], key: str, offset: int = 250, mismatches: int = 1, algorithm: str = "AdjacentBi", disable_umi: bool = False) -> DataFrame:
    """(point, reads, genes, avg_genes, avg_reads) of every subsample."""
    sampled = subsamples(reads, points, key)
    # the point travels with the gene, so that groups of unlike points never meet
    tagged = sampled.withColumn("gene", F.struct("point", "gene"))
    unique = dedup.raw_counts(tagged) if disable_umi else dedup.unique_counts(tagged, offset, mismatches, algorithm)
    spots = unique.select(F.col("gene.point").alias("point"), F.col("gene.gene").alias("gene"), "x", "y", "count")
    by_spot = spots.groupBy("point", "x", "y").agg(F.sum("count").alias("reads"), F.count("*").alias("genes"))
    totals = by_spot.groupBy("point").agg(F.sum("reads").alias("reads"), F.avg("genes").alias("avg_genes"), F.avg("reads").alias("avg_reads"))
    genes = spots.groupBy("point").agg(F.count_distinct("gene").alias("genes"))
    return totals.join(genes, "point").select("point", "reads", "genes", "avg_genes", "avg_reads")
