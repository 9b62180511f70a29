"""The whole pipeline as one graph of DataFrames, and its files."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.config import PipelineConfig
from spotweave.operators import annotate, counts, dedup, demux, read_filter, records, saturation
from spotweave.sources import reads as read_sources
from spotweave.sources import sinks, tables
from spotweave.storage import stored


@dataclass
class Outcome:
    """Frames of a run: filtered reads (or None), annotated transcripts, long counts, unique reads, curve (or None)."""

    filtered: DataFrame | None
    matched: DataFrame | None
    annotated: DataFrame
    transcripts: DataFrame
    unique: DataFrame
    counts: DataFrame
    representatives: DataFrame
    curve: DataFrame | None
    metrics: dict[str, int]


def filter_step(pairs: DataFrame, barcodes: DataFrame | None, config: PipelineConfig) -> DataFrame:
    length = 0 if barcodes is None else tables.barcode_length(barcodes)
    return read_filter.filter_reads(pairs, config.read_filter(length))


def align_step(alignments: DataFrame, filtered: DataFrame | None, config: PipelineConfig) -> DataFrame:
    """Aligned reads; with filtered reads, theirs alone, with barcode and identifier from the filter."""
    mapped, _ = records.split_mapped(alignments)
    if config.disable_multimap:
        mapped = records.accepted(records.primary(mapped), max_loci=1)
    if filtered is None:
        return mapped
    kept = filtered.where("drop_reason IS NULL").select(F.col("name").alias("read"), F.col("barcode").alias("read_barcode"), F.col("umi").alias("read_umi"))
    return mapped.join(kept, F.split("name", r"\s+")[0] == F.col("read")).drop("barcode", "umi", "read").withColumnsRenamed({"read_barcode": "barcode", "read_umi": "umi"})


def locate_step(aligned: DataFrame, barcodes: DataFrame | None, config: PipelineConfig) -> DataFrame:
    """Reads with locations: matched barcodes alone, or all where barcodes are disabled."""
    if barcodes is None or config.disable_barcode:
        return aligned
    reads = aligned.drop("x", "y")
    return demux.demultiplex(reads, barcodes, config.demultiplexing_mismatches, config.demultiplexing_metric, config.demultiplexing_multiple_hits_keep_one, config.demultiplexing_trim_sequences or None)


def annotate_step(located: DataFrame, gff: DataFrame | None, config: PipelineConfig) -> DataFrame:
    """Reads with gene and ``assigned``.  Every alignment is annotated by its place, equal places once."""
    if config.transcriptome:
        return annotate.transcriptome_genes(located).withColumn("assigned", F.lit(True))
    if config.disable_annotation or gff is None:
        return located.withColumn("assigned", F.lit(True))
    features = annotate.select_features(gff, tuple(config.htseq_features), stranded=config.strandness)
    place = F.concat_ws("\t", "chrom", F.col("pos").cast("string"), "cigar", F.col("flag").cast("string"))
    keyed = located.drop("gene").withColumn("place", place)
    distinct = keyed.select(F.col("place").alias("id"), "flag", "chrom", "pos", "mapq", "cigar").dropDuplicates(["id"])
    labels = annotate.annotate(distinct, features, config.htseq_mode, config.strandness)
    named = keyed.join(labels, F.col("place") == F.col("id")).drop("place", "id")
    return annotate.keep_annotated(named, config.include_non_annotated, config.htseq_no_ambiguous)


def build(spark: SparkSession, config: PipelineConfig, pairs: DataFrame | None, alignments: DataFrame, barcodes: DataFrame | None, gff: DataFrame | None, contaminants: DataFrame | None = None) -> Outcome:
    """All steps over given inputs.  The located, annotated reads are written once, as several results use them."""
    metrics: dict[str, int] = {}
    filtered = None
    if pairs is not None:
        filtered = stored(filter_step(pairs, barcodes, config))
        by_reason = {r["reason"]: r["reads"] for r in read_filter.filter_counts(filtered).collect()}
        metrics |= {"input_reads_forward": sum(by_reason.values()), "input_reads_reverse": sum(by_reason.values()), "reads_after_trimming_forward": by_reason.get("kept", 0), "reads_after_trimming_reverse": by_reason.get("kept", 0)}
        metrics |= {f"dropped_{k}": n for k, n in by_reason.items() if k != "kept"}
        if contaminants is not None:
            filtered = demux.shared_words(filtered, contaminants, config.contaminant_word, "read_idx", "seq")
            metrics["reads_after_rRNA_trimming"] = filtered.where("drop_reason IS NULL").count()
    aligned = align_step(alignments, filtered, config)
    matched = locate_step(aligned, barcodes, config)
    located = matched.where("category IN ('Perfect', 'Imperfect') OR matched IS NOT NULL") if "category" in matched.columns else matched
    annotated = stored(annotate_step(located, gff, config))
    rows = dedup.transcripts(annotated.where("assigned"))
    if config.disable_umi:
        unique, kept = dedup.raw_counts(rows), rows
    else:
        unique = stored(dedup.unique_counts(rows, config.umi_counting_offset, config.umi_allowed_mismatches, config.umi_cluster_algorithm))
        kept = dedup.representative_reads(rows, config.umi_counting_offset, config.umi_allowed_mismatches, config.umi_cluster_algorithm)
    n = annotated.agg(F.count("*").alias("all"), F.count_if("assigned").alias("assigned")).first()
    metrics |= {"reads_after_mapping": aligned.count(), "reads_after_demultiplexing": n["all"], "reads_after_annotation": n["assigned"]}
    curve = None
    if config.compute_saturation:
        points = saturation.saturation_points(n["assigned"], config.saturation_points or None)
        named = rows.withColumn("key", F.concat_ws("\t", "clear_name", "chrom", F.col("start").cast("string"), F.col("end").cast("string"), "gene"))
        curve = saturation.saturation_curve(named, points, "key", config.umi_counting_offset, config.umi_allowed_mismatches, config.umi_cluster_algorithm, config.disable_umi)
    return Outcome(filtered, matched if "category" in matched.columns else None, annotated, rows, unique, counts.counts_long(unique), kept, curve, metrics)


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(name, seq) of a FASTA file: records begin with >."""
    parts = F.split("value", "\n", 2)
    return spark.read.option("lineSep", ">").text(path).where("value <> ''").select(F.trim(parts[0]).alias("name"), F.regexp_replace(F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")), r"\s", "").alias("seq"))


def run(spark: SparkSession, config: PipelineConfig) -> dict:
    """Reads the inputs, writes counts, reads, discarded reads, curve and statistics, and returns the statistics."""
    config.check()
    pairs = None
    if config.fastq_files:
        pairs = read_filter.pair_reads(*[read_sources.read_fastq(spark, path) for path in config.fastq_files])
    barcodes = tables.read_barcodes(spark, config.ids) if config.ids and not config.disable_barcode else None
    gff = tables.read_gff(spark, config.ref_annotation) if config.ref_annotation else None
    contaminants = read_fasta(spark, config.contaminant_index) if config.contaminant_index else None
    outcome = build(spark, config, pairs, read_sources.read_alignments(spark, config.alignments), barcodes, gff, contaminants)
    base = f"{config.output_folder}/{config.exp_name}"
    sinks.write_matrix(outcome.counts, f"{base}_stdata.tsv")
    sinks.write_bed(counts.reads_bed(outcome.representatives), f"{base}_reads.bed")
    if outcome.curve is not None:
        sinks.write_table(outcome.curve.orderBy("point"), f"{base}_saturation.tsv")
    if config.keep_discarded_files:
        if outcome.filtered is not None:
            sinks.write_fastq(outcome.filtered.where("drop_reason IS NOT NULL"), f"{base}_discarded.fastq")
        sinks.write_sam(outcome.annotated.where("NOT assigned"), f"{base}_annotation_discarded.sam")
        sinks.write_sam(outcome.annotated.where("assigned"), f"{base}_annotated.sam")
    stats = outcome.metrics | counts.dataset_stats(outcome.counts, outcome.unique).first().asDict()
    stats |= {"input_parameters": [f"{k}={v}" for k, v in asdict(config).items()], "pipeline_version": "1.0"}
    sinks.write_stats(stats, f"{base}_stats.json", spark)
    return stats
