"""Count matrices in long form, their statistics and their wide form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spot_label(x: str = "x", y: str = "y") -> Column:
    return F.concat_ws("x", F.col(x).cast("string"), F.col(y).cast("string"))


def counts_long(unique: DataFrame) -> DataFrame:
    """COUNTS: x, y, spot, gene, count; no rows of zero."""
    return unique.where("count > 0").select("x", "y", spot_label().alias("spot"), "gene", F.col("count").cast("long").alias("count"))


def gene_list(counts: DataFrame) -> list[str]:
    """The genes in order; as many as the wide form has columns."""
    return [r["gene"] for r in counts.select("gene").distinct().orderBy("gene").collect()]


def pivot_counts(counts: DataFrame, genes: Sequence[str] | None = None) -> DataFrame:
    """One row per spot and one column per gene, 0 where there is no count; for output alone."""
    genes = list(genes) if genes is not None else gene_list(counts)
    wide = counts.groupBy("spot").pivot("gene", genes).agg(F.sum("count"))
    return wide.na.fill(0)


def melt_counts(wide: DataFrame) -> DataFrame:
    """Long form of a wide matrix without its zeros; the first column names the spot."""
    spot, *genes = wide.columns
    pairs = F.explode(F.array(*[F.struct(F.lit(g).alias("gene"), F.col(f"`{g}`").cast("long").alias("count")) for g in genes])).alias("p")
    return wide.select(F.col(f"`{spot}`").alias("spot"), pairs).select("spot", "p.gene", "p.count").where("count <> 0")


def per_spot(counts: DataFrame) -> DataFrame:
    """(spot, reads, genes)."""
    return counts.groupBy("spot").agg(F.sum("count").alias("reads"), F.count_if(F.col("count") != 0).alias("genes"))


def dataset_stats(counts: DataFrame, duplicates: DataFrame | None = None) -> DataFrame:
    """One row of statistics; deviations are of the whole population.

    ``duplicates``, if given, is a frame with columns reads and count whose difference is duplicates_found.
    """
    spots = per_spot(counts).agg(
        F.max("genes").alias("max_genes_feature"), F.min("genes").alias("min_genes_feature"), F.max("reads").alias("max_reads_feature"), F.min("reads").alias("min_reads_feature"),
        F.avg("reads").alias("average_reads_feature"), F.avg("genes").alias("average_genes_feature"), F.stddev_pop("reads").alias("std_reads_feature"), F.stddev_pop("genes").alias("std_genes_feature"),
        F.sum("reads").alias("reads_after_duplicates_removal"), F.count("*").alias("barcodes_found"),
    )
    genes = counts.agg(F.count_distinct("gene").alias("genes_found"))
    removed = duplicates.agg((F.sum("reads") - F.sum("count")).alias("duplicates_found")) if duplicates is not None else None
    one = spots.join(genes)
    return one.join(removed) if removed is not None else one


def duplicates_found(unique: DataFrame) -> DataFrame:
    return unique.agg((F.sum("reads") - F.sum("count")).alias("duplicates_found"))


def reads_bed(representatives: DataFrame) -> DataFrame:
    """The nine columns of the reads file."""
    return representatives.select("chrom", "start", "end", "clear_name", "mapping_quality", "strand", "gene", "x", "y")
