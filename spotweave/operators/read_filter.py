"""Filtering and trimming of read pairs: one projection, no shuffle.

A read is charged to the first rule that it fails, which one CASE expression says.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotweave.functions import seq

REASONS = ("umi_template", "umi_quality", "at_content", "gc_content", "adaptor", "too_short")


@dataclass(frozen=True)
class ReadFilter:
    """Parameters of the filter; the defaults are those of the command line."""

    barcode_start: int = 0
    barcode_length: int = 18
    overhang: int = 0
    umi_start: int = 18
    umi_end: int = 27
    umi_template: str | None = None
    umi_quality_bases: int = 6
    min_quality: int = 20
    min_length: int = 20
    at_content: float = 90
    gc_content: float = 90
    poly_a: int = 10
    poly_t: int = 10
    poly_g: int = 10
    poly_c: int = 10
    poly_n: int = 10
    homopolymer_mismatches: int = 0
    phred: int = 33
    disable_umi: bool = False
    disable_barcode: bool = False
    disable_trimming: bool = False


def pair_reads(forward: DataFrame, reverse: DataFrame) -> DataFrame:
    """Mates by position: READ_PAIR with ``same_name``, whether the first words of their names agree."""
    first = forward.select("read_idx", F.col("name").alias("r1_name"), F.col("seq").alias("r1_seq"), F.col("qual").alias("r1_qual"))
    second = reverse.select("read_idx", "name", F.col("seq").alias("r2_seq"), F.col("qual").alias("r2_qual"))
    same = F.split("r1_name", r"\s+")[0] == F.split("name", r"\s+")[0]
    return first.join(second, "read_idx").select("read_idx", "name", "r1_seq", "r1_qual", "r2_seq", "r2_qual", same.alias("same_name"))


def trim_homopolymers(rows: DataFrame, p: ReadFilter) -> DataFrame:
    """Lowers ``cut``, the length of the read r2, by runs of A, T, G, C and N in this order, each from its first hit on.

    Each base is a step of its own, so that no expression repeats the ones before it.
    """
    for base, run in (("A", p.poly_a), ("T", p.poly_t), ("G", p.poly_g), ("C", p.poly_c), ("N", p.poly_n)):
        if run >= 5:
            place = seq.adaptor_position(F.substring("r2", F.lit(1), F.col("cut")), base, run, p.homopolymer_mismatches)
            usable = (F.col("cut") > p.min_length) & (F.length("r2") == F.length("q2"))
            rows = rows.withColumn("cut", F.coalesce(F.when(usable, place), F.col("cut")))
    return rows


def filter_reads(pairs: DataFrame, p: ReadFilter = ReadFilter()) -> DataFrame:
    """FILTERED: read_idx, name, barcode, umi, seq, qual and drop_reason; a null reason means kept.

    Dropped reads keep their untrimmed sequence.  An empty reverse read has no content and falls to the
    length rules.
    """
    r1, q1, r2, q2 = (F.col(c) for c in ("r1_seq", "r1_qual", "r2_seq", "r2_qual"))
    none = F.lit(None).cast("string")
    umi = none if p.disable_umi else seq.slice_between(r1, p.umi_start, p.umi_end)
    barcode = none if p.disable_barcode else seq.barcode_slice(r1, p.barcode_start, p.barcode_length, p.overhang)
    rows = pairs.select("read_idx", F.split("name", r"\s+")[0].alias("name"), barcode.alias("barcode"), umi.alias("umi"), r1.alias("r1"), q1.alias("q1"), r2.alias("r2"), q2.alias("q2"))
    if p.disable_trimming:
        return rows.select("read_idx", "name", "barcode", "umi", F.col("r2").alias("seq"), F.col("q2").alias("qual"), none.alias("drop_reason"))
    rows = trim_homopolymers(rows.withColumn("cut", F.length("r2")), p)
    trimmed, quality = F.substring("r2", F.lit(1), F.col("cut")), F.substring("q2", F.lit(1), F.col("cut"))
    rows = rows.withColumn("kept", F.when(F.col("cut") >= p.min_length, seq.quality_trim_length(trimmed, quality, p.min_quality, p.min_length, p.phred)))
    filled = F.length("r2") > 0
    rules = []
    if not p.disable_umi:
        if p.umi_template:
            rules.append((~seq.matches_template("umi", seq.iupac_regex(p.umi_template)), "umi_template"))
        rules.append((seq.low_quality_bases(seq.slice_between("q1", p.umi_start, p.umi_end), p.min_quality, p.phred) > p.umi_quality_bases, "umi_quality"))
    for bases, limit, name in (("AT", p.at_content, "at_content"), ("GC", p.gc_content, "gc_content")):
        if limit > 0:
            rules.append((F.when(filled, seq.content_percent("r2", bases) >= limit).otherwise(False), name))
    rules += [(F.col("cut") < p.min_length, "adaptor"), (F.coalesce(F.col("kept"), F.lit(0)) == 0, "too_short")]
    reason = none
    for rule, name in reversed(rules):
        reason = F.when(rule, F.lit(name)).otherwise(reason)
    rows = rows.withColumn("drop_reason", reason)
    length = F.when(F.col("drop_reason").isNull(), F.col("kept")).otherwise(F.length("r2"))
    return rows.select("read_idx", "name", "barcode", "umi", F.substring("r2", F.lit(1), length).alias("seq"), F.substring("q2", F.lit(1), length).alias("qual"), "drop_reason")


def filter_counts(filtered: DataFrame) -> DataFrame:
    """Reads by reason (``kept`` for those that stay)."""
    return filtered.groupBy(F.coalesce("drop_reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("reads"))


def clip_reads(reads: DataFrame, five_prime: int = 0, three_prime: int = 0) -> DataFrame:
    """Reads without so many bases at either end."""
    keep = F.greatest(F.length("seq") - (five_prime + three_prime), F.lit(0))
    return reads.withColumns({c: F.substring(c, F.lit(five_prime + 1), keep) for c in ("seq", "qual")})
