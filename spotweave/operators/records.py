"""Splitting and merging of record tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spotweave.storage import stored


def numbered(records: DataFrame, order: list[str], name: str = "idx") -> DataFrame:
    """Adds consecutive numbers from 0 in the given order, which must be total.

    Ranges of the order are numbered side by side, from the sums of the sizes of the ranges before.  The ranges
    are drawn by sampling, so they are written down before they are used twice.
    """
    ranged = stored(records.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    ranged = ranged.withColumn("_in", F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1)
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select(F.col("_part").alias("_of"), F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return ranged.join(F.broadcast(before), F.col("_part") == F.col("_of")).withColumn(name, F.col("_before") + F.col("_in")).drop("_part", "_in", "_of", "_before")


def split_chunks(records: DataFrame, parts: int, idx: str = "idx") -> DataFrame:
    """Adds ``chunk``: consecutive chunks of ceil(n / parts) records by their number."""
    if parts < 1:
        raise ValueError("at least one part")
    total = records.agg(F.max(idx).alias("last")).select((F.coalesce("last", F.lit(-1)) + 1).alias("n"))
    size = F.greatest(F.ceil(F.col("n") / parts), F.lit(1))
    return records.join(F.broadcast(total)).withColumn("chunk", F.floor(F.col(idx) / size)).drop("n")


def merge(frames: list[DataFrame]) -> DataFrame:
    """All records of all frames, with ``part``, the frame's number."""
    if not frames:
        raise ValueError("nothing to merge")
    return reduce(DataFrame.unionByName, [f.withColumn("part", F.lit(i)) for i, f in enumerate(frames)])


def split_mapped(alignments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Mapped and unmapped alignments, by their flag."""
    unmapped = F.col("flag").bitwiseAND(4) > 0
    return alignments.where(~unmapped), alignments.where(unmapped)


def primary(alignments: DataFrame) -> DataFrame:
    """Neither secondary nor supplementary."""
    return alignments.where(F.col("flag").bitwiseAND(0x900) == 0)


def accepted(alignments: DataFrame, min_length: int = 0, min_score: int = 0, min_score_ratio: float = 0.0, min_matched_ratio: float = 0.0, max_loci: int | None = None) -> DataFrame:
    """Alignments above thresholds on matched bases, score (``score``) and loci (``loci``), where they are known."""
    matched = F.aggregate(F.regexp_extract_all("cigar", F.lit("([0-9]+)[M=X]"), F.lit(1)), F.lit(0).cast("long"), lambda s, n: s + n.cast("long"))
    rule = (matched >= min_length) & (matched >= min_matched_ratio * F.length("seq"))
    if "score" in alignments.columns:
        rule = rule & F.coalesce((F.col("score") >= min_score) & (F.col("score") >= min_score_ratio * F.length("seq")), F.lit(True))
    if max_loci is not None and "loci" in alignments.columns:
        rule = rule & F.coalesce(F.col("loci") <= max_loci, F.lit(True))
    return alignments.where(rule)
