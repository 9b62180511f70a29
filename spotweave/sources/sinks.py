"""Writers.  Each overwrites its path; a path is a folder of part files unless ``single`` is asked for."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotweave.operators.counts import gene_list, pivot_counts


def _text(lines: DataFrame, path: str, single: bool, compression: str | None = None) -> None:
    writer = (lines.coalesce(1) if single else lines).write.mode("overwrite")
    (writer.option("compression", compression) if compression else writer).text(path)


def fastq_record() -> Column:
    return F.concat(F.lit("@"), "name", F.lit("\n"), "seq", F.lit("\n+\n"), "qual").alias("value")


def write_fastq(reads: DataFrame, path: str, single: bool = False, compression: str | None = None) -> None:
    """Records (name, seq, qual) of four lines."""
    _text(reads.select(fastq_record()), path, single, compression)


def merge_fastq(spark, run_path: str, samples: list[str], out_path: str) -> None:
    """For each sample and mate, the files named after it as one compressed set, in order of file name and read.

    A sample's files are those with its name between word bounds, so S1 doesn't take S10's.
    """
    from spotweave.sources.reads import read_fastq

    for sample in samples:
        for mate in ("R1", "R2"):
            reads = read_fastq(spark, f"{run_path}/*{sample}*{mate}*.fastq*")
            name = F.element_at(F.split("file", "/"), -1)
            own = reads.where(name.rlike(rf"(^|[^A-Za-z0-9]){sample}([^A-Za-z0-9]|$)")).orderBy("file", "read_idx")
            write_fastq(own, f"{out_path}/{sample}_{mate}.fastq.gz", compression="gzip")


def write_sam(alignments: DataFrame, path: str, single: bool = False, by_coordinate: bool = False) -> None:
    """ALIGNMENT rows as SAM lines with their tags; positions are written from 1.

    ``by_coordinate`` sorts them by reference, position and name, unaligned ones last; part files are in this order.
    """
    if by_coordinate:
        alignments = alignments.orderBy(F.col("chrom").asc_nulls_last(), "pos", "name", "flag")

    def star(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit("*"))

    def tag(name: str, c: str, kind: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{name}:{kind}:"), F.col(c).cast("string"))) if c in alignments.columns else F.lit(None).cast("string")

    tags = [tag("B0", "barcode", "Z"), tag("B1", "x", "i"), tag("B2", "y", "i"), tag("B3", "umi", "Z"), tag("XF", "gene", "Z")]
    line = F.concat_ws("\t", "name", F.col("flag").cast("string"), star("chrom"), (F.coalesce("pos", F.lit(-1)) + 1).cast("string"), F.coalesce("mapq", F.lit(0)).cast("string"), star("cigar"), F.lit("*"), F.lit("0"), F.lit("0"), star("seq"), star("qual"), *tags)
    _text(alignments.select(line.alias("value")), path, single)


def filtered_alignments(filtered: DataFrame) -> DataFrame:
    """Kept reads of the filter as unaligned ALIGNMENT rows."""
    null = F.lit(None)
    return filtered.where("drop_reason IS NULL").select("name", F.lit(4).alias("flag"), null.cast("string").alias("chrom"), F.lit(-1).cast("long").alias("pos"), F.lit(0).alias("mapq"), null.cast("string").alias("cigar"), "seq", "qual", "barcode", "umi")


def write_bed(bed: DataFrame, path: str, single: bool = False) -> None:
    (bed.coalesce(1) if single else bed).write.mode("overwrite").option("sep", "\t").csv(path)


def write_matrix(counts: DataFrame, path: str, single: bool = True) -> None:
    """Wide matrix as tab-separated text with a leading empty header cell; counts are integers."""
    genes = gene_list(counts)
    wide = pivot_counts(counts, genes)
    out = wide.select(F.col("spot").alias(" "), *[F.col(f"`{g}`") for g in genes])
    (out.coalesce(1) if single else out).write.mode("overwrite").option("sep", "\t").option("header", True).option("ignoreLeadingWhiteSpace", True).csv(path)


def write_stats(stats: dict, path: str, spark) -> None:
    """A dictionary as a JSON text."""
    spark.createDataFrame([(json.dumps(stats, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def append_text(lines: list[str], path: str, spark) -> None:
    """Lines appended to a text path."""
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.mode("append").text(path)


def write_table(frame: DataFrame, path: str) -> None:
    """A small result as tab-separated text with a header."""
    frame.coalesce(1).write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)
