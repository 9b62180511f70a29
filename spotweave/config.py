"""Parameters of the read-to-counts pipeline and the rules that they obey."""

from __future__ import annotations

import argparse
from dataclasses import MISSING, dataclass, field, fields

from spotweave.functions.seq import IUPAC
from spotweave.operators.annotate import MODES, STRANDED
from spotweave.operators.dedup import ALGORITHMS
from spotweave.operators.demux import METRICS
from spotweave.operators.read_filter import ReadFilter
from spotweave.sources.reads import FASTQ_SUFFIXES

ANNOTATION_SUFFIXES = (".gtf", ".gff", ".gff3", ".gtf.gz", ".gff.gz", ".gff3.gz")


def option(flag: str, default, low=None, high=None, choices=None, many=None):
    """A field with its command-line flag and allowed values."""
    extra = {"flag": flag, "low": low, "high": high, "choices": choices, "many": many}
    return field(default=default, metadata=extra) if not isinstance(default, list) else field(default_factory=lambda: list(default), metadata=extra)


@dataclass(frozen=True)
class PipelineConfig:
    """All options.  Those of the external aligner are accepted and recorded; alignment itself is an input."""

    fastq_files: list[str] = option("fastq_files", [], many=2)
    ids: str | None = option("--ids", None)
    ref_map: str | None = option("--ref-map", None)
    ref_annotation: str | None = option("--ref-annotation", None)
    exp_name: str | None = option("--expName", None)
    contaminant_index: str | None = option("--contaminant-index", None)
    contaminant_word: int = option("--contaminant-word", 24, 8)
    alignments: str | None = option("--alignments", None)
    no_clean_up: bool = option("--no-clean-up", False)
    verbose: bool = option("--verbose", False)
    threads: int = option("--threads", 8, 1, 80)
    bin_path: str | None = option("--bin-path", None)
    log_file: str | None = option("--log-file", None)
    output_folder: str = option("--output-folder", ".")
    temp_folder: str | None = option("--temp-folder", None)
    keep_discarded_files: bool = option("--keep-discarded-files", False)
    qual_64: bool = option("--qual-64", False)
    min_length_qual_trimming: int = option("--min-length-qual-trimming", 20, 5, 150)
    min_quality_trimming: int = option("--min-quality-trimming", 20, 1, 60)
    remove_polyA: int = option("--remove-polyA", 10, 0, 34)
    remove_polyT: int = option("--remove-polyT", 10, 0, 34)
    remove_polyG: int = option("--remove-polyG", 10, 0, 34)
    remove_polyC: int = option("--remove-polyC", 10, 0, 34)
    remove_polyN: int = option("--remove-polyN", 10, 0, 34)
    homopolymer_mismatches: int = option("--homopolymer-mismatches", 0, 0, 8)
    filter_AT_content: int = option("--filter-AT-content", 90, 0, 100)
    filter_GC_content: int = option("--filter-GC-content", 90, 0, 99)
    mapping_rv_trimming: int = option("--mapping-rv-trimming", 0, 0, 50)
    inverse_mapping_rv_trimming: int = option("--inverse-mapping-rv-trimming", 0, 0, 50)
    disable_multimap: bool = option("--disable-multimap", False)
    disable_clipping: bool = option("--disable-clipping", False)
    min_intron_size: int = option("--min-intron-size", 1, 1)
    max_intron_size: int = option("--max-intron-size", 1, 1)
    star_two_pass_mode: bool = option("--star-two-pass-mode", False)
    star_genome_loading: str = option("--star-genome-loading", "NoSharedMemory")
    star_sort_mem_limit: int = option("--star-sort-mem-limit", 0, 0)
    star_min_score: int = option("--star-min-score", 0, 0)
    star_min_score_ratio: float = option("--star-min-score-ratio", 0.66, 0)
    star_min_matched_bases: int = option("--star-min-matched-bases", 0, 0)
    star_min_matched_bases_ratio: float = option("--star-min-matched-bases-ratio", 0.66, 0)
    demultiplexing_mismatches: int = option("--demultiplexing-mismatches", 2, 0, 30)
    demultiplexing_kmer: int = option("--demultiplexing-kmer", 6, 1, 50)
    demultiplexing_overhang: int = option("--demultiplexing-overhang", 0, 0, 10)
    demultiplexing_start: int = option("--demultiplexing-start", 0, 0)
    demultiplexing_metric: str = option("--demultiplexing-metric", "Subglobal", choices=METRICS)
    demultiplexing_multiple_hits_keep_one: bool = option("--demultiplexing-multiple-hits-keep-one", False)
    demultiplexing_trim_sequences: list[int] = option("--demultiplexing-trim-sequences", [], many="*")
    demultiplexing_chunk_size: int = option("--demultiplexing-chunk-size", 100_000, 100)
    htseq_mode: str = option("--htseq-mode", "intersection-nonempty", choices=MODES)
    htseq_no_ambiguous: bool = option("--htseq-no-ambiguous", False)
    htseq_features: list[str] = option("--htseq-features", ["exon"], many="+")
    strandness: str = option("--strandness", "yes", choices=STRANDED)
    include_non_annotated: bool = option("--include-non-annotated", False)
    umi_cluster_algorithm: str = option("--umi-cluster-algorithm", "AdjacentBi", choices=ALGORITHMS)
    umi_allowed_mismatches: int = option("--umi-allowed-mismatches", 1, 0, 8)
    umi_start_position: int = option("--umi-start-position", 18, 0)
    umi_end_position: int = option("--umi-end-position", 27, 0)
    umi_filter: bool = option("--umi-filter", False)
    umi_filter_template: str = option("--umi-filter-template", "WSNNWSNNV")
    umi_quality_bases: int = option("--umi-quality-bases", 6, 0, 12)
    umi_counting_offset: int = option("--umi-counting-offset", 250, 0)
    compute_saturation: bool = option("--compute-saturation", False)
    saturation_points: list[int] = option("--saturation-points", [], many="+")
    disable_trimming: bool = option("--disable-trimming", False)
    disable_mapping: bool = option("--disable-mapping", False)
    disable_annotation: bool = option("--disable-annotation", False)
    disable_barcode: bool = option("--disable-barcode", False)
    disable_umi: bool = option("--disable-umi", False)
    transcriptome: bool = option("--transcriptome", False)

    def check(self) -> "PipelineConfig":
        """Self, or ValueError naming the first rule that is broken."""
        for f in fields(self):
            value, meta = getattr(self, f.name), f.metadata
            if meta["choices"] and value not in meta["choices"]:
                raise ValueError(f"{meta['flag']}: {value} is none of {', '.join(meta['choices'])}")
            if meta["low"] is not None and value < meta["low"] or meta["high"] is not None and value > meta["high"]:
                raise ValueError(f"{meta['flag']}: {value} is outside {meta['low']}..{meta['high'] if meta['high'] is not None else ''}")
        if not self.exp_name:
            raise ValueError("--expName is missing")
        if self.fastq_files and len(self.fastq_files) != 2:
            raise ValueError("two FASTQ files are needed")
        for name in self.fastq_files:
            if not name.endswith(FASTQ_SUFFIXES):
                raise ValueError(f"not a FASTQ file name: {name}")
        if not self.fastq_files and not self.alignments:
            raise ValueError("no reads: give two FASTQ files, alignments, or both")
        if not self.alignments:
            raise ValueError("alignment is not done here: give --alignments, a SAM, BAM or Parquet path")
        if self.ref_annotation and not self.ref_annotation.endswith(ANNOTATION_SUFFIXES):
            raise ValueError(f"not an annotation file name: {self.ref_annotation}")
        if not self.ref_annotation and not self.transcriptome and not self.disable_annotation:
            raise ValueError("--ref-annotation is missing, and --transcriptome is not set")
        if not self.ids and not self.disable_barcode:
            raise ValueError("--ids is missing, and --disable-barcode is not set")
        length = self.umi_end_position - self.umi_start_position
        if not self.disable_umi:
            if length <= 0:
                raise ValueError("the identifier ends before it starts")
            if self.umi_filter and set(self.umi_filter_template.upper()) - IUPAC.keys():
                raise ValueError(f"not a template: {self.umi_filter_template}")
            if self.umi_filter and len(self.umi_filter_template) != length:
                raise ValueError("the template's length isn't the identifier's")
            if self.umi_allowed_mismatches > length:
                raise ValueError("more mismatches than the identifier has bases")
            if not self.disable_barcode and self.umi_start_position < self.demultiplexing_start < self.umi_end_position:
                raise ValueError("the barcode starts inside the identifier")
        if not self.disable_barcode and self.demultiplexing_mismatches > self.demultiplexing_kmer:
            raise ValueError("more mismatches than the length of a word")
        if len(self.demultiplexing_trim_sequences) % 2:
            raise ValueError("trimmed pieces come as pairs of start and end")
        return self

    def read_filter(self, barcode_length: int) -> ReadFilter:
        """The filter's parameters; the overhang counts for metrics with edits alone."""
        return ReadFilter(
            barcode_start=self.demultiplexing_start, barcode_length=barcode_length, overhang=self.demultiplexing_overhang if self.demultiplexing_metric != "Hamming" else 0,
            umi_start=self.umi_start_position, umi_end=self.umi_end_position, umi_template=self.umi_filter_template if self.umi_filter else None, umi_quality_bases=self.umi_quality_bases,
            min_quality=self.min_quality_trimming, min_length=self.min_length_qual_trimming, at_content=self.filter_AT_content, gc_content=self.filter_GC_content,
            poly_a=self.remove_polyA, poly_t=self.remove_polyT, poly_g=self.remove_polyG, poly_c=self.remove_polyC, poly_n=self.remove_polyN, homopolymer_mismatches=self.homopolymer_mismatches,
            phred=64 if self.qual_64 else 33, disable_umi=self.disable_umi, disable_barcode=self.disable_barcode, disable_trimming=self.disable_trimming,
        )


#: Options for the slides of another maker.
VISIUM = {"demultiplexing_mismatches": 1, "demultiplexing_kmer": 4, "umi_allowed_mismatches": 2, "umi_start_position": 16, "umi_end_position": 28}


def argument_parser() -> argparse.ArgumentParser:
    """A parser with one argument per field."""
    parser = argparse.ArgumentParser(description="From paired reads to counts of genes by location.")
    for f in fields(PipelineConfig):
        flag, many = f.metadata["flag"], f.metadata["many"]
        default = f.default if f.default_factory is MISSING else f.default_factory()
        if not flag.startswith("-"):
            parser.add_argument(flag, nargs="*", default=default)
        elif isinstance(default, bool):
            parser.add_argument(flag, dest=f.name, action="store_true")
        else:
            kind = type(default) if default is not None and not isinstance(default, list) else (int if "int" in str(f.type) else str)
            parser.add_argument(flag, dest=f.name, type=kind, default=default, choices=f.metadata["choices"], **({"nargs": many} if many else {}))
    parser.add_argument("--version", action="version", version="spotweave 1.0")
    return parser


def from_arguments(arguments: list[str]) -> PipelineConfig:
    return PipelineConfig(**vars(argument_parser().parse_args(arguments)))
