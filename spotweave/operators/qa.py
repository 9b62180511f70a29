"""Quality report of one matrix: statistics and plot-ready frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.operators.counts import dataset_stats, per_spot


def qa_stats(counts: DataFrame) -> DataFrame:
    """One row: dataset statistics, and the largest and least cell with the implicit zeros."""
    cells = counts.where("count <> 0").agg(F.max("count").alias("max_count"), F.min("count").alias("least"), F.count("*").alias("cells"))
    stats = dataset_stats(counts).join(cells)
    full = F.col("cells") == F.col("barcodes_found") * F.col("genes_found")
    return stats.withColumn("min_count", F.when(full, F.col("least")).otherwise(F.lit(0))).drop("least", "cells")


def threshold_counts(counts: DataFrame, by: str, thresholds: Sequence[int] = (0, 1, 2)) -> DataFrame:
    """Per spot (``by`` = "spot") or gene: total, and cells above each threshold."""
    return counts.groupBy(by).agg(F.sum("count").alias("total"), *[F.count_if(F.col("count") > t).alias(f"above_{t}") for t in thresholds])


def histogram(values: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """(bin, low, high, n) of equal widths over [least, largest]; the last bin is closed; empty bins are absent.

    If all values are equal the range is half a unit to either side.
    """
    ends = values.agg(F.min(column).cast("double").alias("mn"), F.max(column).cast("double").alias("mx"))
    ends = ends.select(F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn")).alias("mn"), F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx")).alias("mx"))
    width = (F.col("mx") - F.col("mn")) / bins
    number = F.least(F.floor((F.col(column) - F.col("mn")) / (F.col("mx") - F.col("mn")) * bins), F.lit(bins - 1)).cast("int")
    placed = values.select(F.col(column).cast("double").alias(column)).join(F.broadcast(ends)).select(number.alias("bin"), (F.col("mn") + number * width).alias("low"), (F.col("mn") + (number + 1) * width).alias("high"))
    return placed.where("bin IS NOT NULL").groupBy("bin").agg(F.first("low").alias("low"), F.first("high").alias("high"), F.count("*").alias("n"))


def density(values: DataFrame, column: str, points: int = 100) -> DataFrame:
    """(at, density): Gaussian kernel density with Scott's bandwidth on an even grid of three bandwidths beyond the ends.

    Values are counted before they meet the grid, so the work is distinct values times points.
    """
    v = F.col(column).cast("double")
    row = values.agg(F.count(v).alias("n"), F.min(v).alias("mn"), F.max(v).alias("mx"), F.stddev_samp(v).alias("sd")).first()
    spark = values.sparkSession
    if not row["n"]:
        return spark.createDataFrame([], "at double, density double")
    width = (row["sd"] or 1.0) * row["n"] ** -0.2
    low, high = row["mn"] - 3 * width, row["mx"] + 3 * width
    at = F.explode(F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.lit(low) + i * ((high - low) / (points - 1))))
    each = values.where(v.isNotNull()).groupBy(v.alias("v")).agg(F.count("*").alias("n")).select("v", "n", at.alias("at"))
    kernel = F.exp(-0.5 * F.pow((F.col("at") - F.col("v")) / width, 2)) / (width * 2.5066282746310002)
    return each.groupBy("at").agg((F.sum(F.col("n") * kernel) / row["n"]).alias("density"))


def spot_scatter(counts: DataFrame) -> DataFrame:
    """(x, y, reads, genes) of each spot, for maps and scatter plots."""
    xy = F.split("spot", "x")
    return per_spot(counts).select(xy[0].cast("double").alias("x"), xy[1].cast("double").alias("y"), "reads", "genes")


def report_lines(stats: dict) -> list[str]:
    """The text report of one row of qa_stats."""
    # The labels of the report, which scripts read.
    named = (
        ("Number of spots", "barcodes_found"), ("Number of reads present", "reads_after_duplicates_removal"), ("Number of unique genes present", "genes_found"),
        ("Max number of genes over all spots", "max_genes_feature"), ("Min number of genes over all spots", "min_genes_feature"), ("Max number of reads over all spots", "max_reads_feature"),
        ("Min number of reads over all spots", "min_reads_feature"), ("Average number genes per spots", "average_genes_feature"), ("Average number reads per spot", "average_reads_feature"),
        ("Std number genes per spot", "std_genes_feature"), ("Std number reads per spot", "std_reads_feature"), ("Max number of reads over all spots/genes", "max_count"), ("Min number of reads over all spots/genes", "min_count"),
    )
    return [f"{text}: {stats[key]}" for text, key in named]
