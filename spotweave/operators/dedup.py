"""Unique molecules per gene and spot: gap sessions, then clusters of identifiers within each session.

Sessions, distinct identifiers and counts all use one shuffle on (gene, x, y).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spotweave.functions import umi
from spotweave.functions.cigar import clipped_interval

ALGORITHMS = ("AdjacentBi", "Adjacent", "hierarchical")
GROUP = ("gene", "x", "y")


def transcripts(alignments: DataFrame) -> DataFrame:
    """TRANSCRIPT rows: chrom, start, end, clear_name, mapping_quality, strand, umi, gene, x, y.

    Start and end have the soft clips laid out and change places on the minus strand.  A missing location is
    (-1, -1), a missing gene and umi the word None.
    """
    strand = F.when(F.col("flag").bitwiseAND(16) > 0, "-").otherwise("+")
    rows = alignments.withColumn("strand", strand)
    start, end = clipped_interval("cigar", "pos", "strand")
    return rows.select(
        "chrom", start.alias("start"), end.alias("end"), F.col("name").alias("clear_name"), F.col("mapq").alias("mapping_quality"), "strand",
        F.coalesce("umi", F.lit("None")).alias("umi"), F.coalesce("gene", F.lit("None")).alias("gene"), F.coalesce("x", F.lit(-1)).alias("x"), F.coalesce("y", F.lit(-1)).alias("y"),
    )


def sessions(reads: DataFrame, offset: int) -> DataFrame:
    """Adds ``session``: a read begins one if it starts more than ``offset`` behind the read before it, or on the other strand.

    Reads are in order of strand and start; a chain of close starts is one session, however long.
    """
    order = Window.partitionBy(*GROUP).orderBy("strand", "start")
    fresh = (F.col("strand") != F.lag("strand").over(order)) | (F.col("start") - F.lag("start").over(order) > offset)
    return reads.withColumn("session", F.sum(F.coalesce(fresh, F.lit(True)).cast("int")).over(order.rangeBetween(Window.unboundedPreceding, 0)))


def session_umis(reads: DataFrame, offset: int) -> DataFrame:
    """(gene, x, y, session, reads, umis): the distinct identifiers of each session, sorted."""
    flagged = sessions(reads, offset)
    return flagged.groupBy(*GROUP, "session").agg(F.count("*").alias("reads"), F.array_sort(F.collect_set("umi")).alias("umis"))


def unique_counts(reads: DataFrame, offset: int = 250, mismatches: int = 1, algorithm: str = "AdjacentBi", fix_pair_rule: bool = False) -> DataFrame:
    """(gene, x, y, reads, count): reads and unique molecules."""
    if algorithm not in ALGORITHMS:
        raise ValueError(f"unknown algorithm {algorithm}; there are {ALGORITHMS}")
    grouped = session_umis(reads, offset)
    if algorithm == "AdjacentBi":
        kept = umi.component_count("umis", mismatches)
    elif algorithm == "hierarchical":
        kept = umi.hierarchical_count("umis", mismatches, fix_pair_rule)
    else:
        kept = F.when(F.size("umis") == 1, 1).otherwise(F.size(umi.cluster_column(F.when(F.size("umis") > 1, F.col("umis")), mismatches, "Adjacent")))
    counted = grouped.withColumn("kept", kept.cast("long"))
    return counted.groupBy(*GROUP).agg(F.sum("reads").alias("reads"), F.sum("kept").alias("count"))


def raw_counts(reads: DataFrame) -> DataFrame:
    """(gene, x, y, reads, count) with every read a molecule."""
    return reads.groupBy(*GROUP).agg(F.count("*").alias("reads"), F.count("*").alias("count"))


def representative_reads(reads: DataFrame, offset: int = 250, mismatches: int = 1, algorithm: str = "AdjacentBi") -> DataFrame:
    """One read for each unique molecule: of the reads of a kept identifier in its session the least by name."""
    if algorithm not in ALGORITHMS:
        raise ValueError(f"unknown algorithm {algorithm}; there are {ALGORITHMS}")
    flagged = sessions(reads, offset)
    columns = [c for c in reads.columns if c not in GROUP]
    by_umi = flagged.groupBy(*GROUP, "session", "umi").agg(F.min_by(F.struct(*columns), F.struct("clear_name", *[c for c in columns if c != "clear_name"])).alias("read"))
    grouped = by_umi.groupBy(*GROUP, "session").agg(F.array_sort(F.collect_list(F.struct("umi", "read"))).alias("members"))
    umis = F.transform("members", lambda m: m["umi"])
    if algorithm == "AdjacentBi":
        small = F.size("members") <= umi.NATIVE_LIMIT
        labels = umi.component_labels(umis, mismatches)
        native = F.transform(F.array_distinct(labels), lambda i: umis[i])
        kept = F.when(F.size("members") == 1, umis).when(small, native).otherwise(umi.cluster_column(F.when(~small, umis), mismatches))
    else:
        kept = umi.cluster_column(umis, mismatches, algorithm)
    chosen = grouped.withColumn("kept", kept).withColumn("member", F.explode(F.filter("members", lambda m: F.array_contains("kept", m["umi"]))))
    return chosen.select(*GROUP, "member.read.*")
