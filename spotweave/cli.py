"""Command-line tools: the pipeline, the two reports, and four matrix and file tools.

``python -m spotweave.cli TOOL ...`` with a tool of TOOLS.
"""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.config import from_arguments
from spotweave.operators import matrix, multi_qa, qa
from spotweave.plans import pipeline
from spotweave.sources import sinks, tables

log = logging.getLogger("spotweave")


def session() -> SparkSession:
    return SparkSession.builder.appName("spotweave").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def base_name(path: str) -> str:
    return path.rstrip("/").split("/")[-1].split(".")[0]


def count_reads(spark: SparkSession, arguments: list[str]) -> None:
    stats = pipeline.run(spark, from_arguments(arguments))
    for key, value in stats.items():
        log.info("%s: %s", key, value)


def matrix_report(spark: SparkSession, arguments: list[str]) -> None:
    """Statistics as text, and the frames of the plots."""
    p = argparse.ArgumentParser()
    p.add_argument("--input-data", required=True)
    p.add_argument("--output", default=".")
    a = p.parse_args(arguments)
    counts = tables.read_matrix(spark, a.input_data)
    out = f"{a.output}/{base_name(a.input_data)}"
    sinks.append_text(qa.report_lines(qa.qa_stats(counts).first().asDict()), f"{out}_qa_stats.txt", spark)
    by_spot, by_gene = qa.threshold_counts(counts, "spot"), qa.threshold_counts(counts, "gene")
    for kind, frame in (("spot", by_spot), ("gene", by_gene)):
        for column in ("total", "above_0", "above_1", "above_2"):
            sinks.write_table(qa.histogram(frame, column, 50 if column == "total" else 20).orderBy("bin"), f"{out}_hist_{kind}_{column}.tsv")
    sinks.write_table(qa.density(by_spot, "total").orderBy("at"), f"{out}_density_reads.tsv")
    sinks.write_table(qa.density(by_spot, "above_0").orderBy("at"), f"{out}_density_genes.tsv")
    sinks.write_table(qa.spot_scatter(counts), f"{out}_spots.tsv")


def named_datasets(spark: SparkSession, paths: list[str]) -> DataFrame:
    frames = [tables.read_matrix(spark, path).withColumn("dataset", F.lit(base_name(path))) for path in paths]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def compare_matrices(spark: SparkSession, arguments: list[str]) -> None:
    """Similarities and correlations of two or more matrices, their violins and their principal components."""
    p = argparse.ArgumentParser()
    p.add_argument("--counts-table-files", nargs="+", required=True)
    p.add_argument("--outdir", default=".")
    p.add_argument("--use-log-scale", action="store_true")
    a = p.parse_args(arguments)
    if len(a.counts_table_files) < 2:
        raise ValueError("at least two matrices")
    counts = named_datasets(spark, a.counts_table_files)
    names = [base_name(path) for path in a.counts_table_files]
    for frame, value, name in ((multi_qa.gene_similarity(counts), "similarity", "gene_similarities"), (multi_qa.gene_correlation(counts, a.use_log_scale), "correlation", "gene_correlations")):
        sinks.write_table(frame.groupBy("dataset1").pivot("dataset2", names).agg(F.first(value)).orderBy("dataset1"), f"{a.outdir}/{name}.tsv")
    for frame, name in ((multi_qa.violin_stats(counts), "violins"), (multi_qa.pca(counts), "pca"), (multi_qa.shared_with_all(counts), "shared_genes"), (multi_qa.gene_pairs(counts), "gene_pairs")):
        sinks.write_table(frame, f"{a.outdir}/{name}.tsv")


def merge_fastq(spark: SparkSession, arguments: list[str]) -> None:
    p = argparse.ArgumentParser()
    p.add_argument("--run-path", required=True)
    p.add_argument("--out-path", required=True)
    p.add_argument("--identifiers", nargs="+", required=True)
    a = p.parse_args(arguments)
    sinks.merge_fastq(spark, a.run_path, a.identifiers, a.out_path)


def filter_gene_type_matrix(spark: SparkSession, arguments: list[str]) -> None:
    p = argparse.ArgumentParser()
    p.add_argument("--counts-matrix", required=True)
    p.add_argument("--gene-types-keep", nargs="+", required=True)
    p.add_argument("--annotation", required=True)
    p.add_argument("--ensembl-ids", action="store_true")
    p.add_argument("--outfile")
    a = p.parse_args(arguments)
    types = matrix.gene_type_table(tables.read_gff(spark, a.annotation), a.ensembl_ids)
    kept = matrix.filter_gene_types(tables.read_matrix(spark, a.counts_matrix), types, a.gene_types_keep)
    sinks.write_matrix(kept, a.outfile or f"filtered_{base_name(a.counts_matrix)}.tsv")


def convert_ensembl_to_names(spark: SparkSession, arguments: list[str]) -> None:
    p = argparse.ArgumentParser()
    p.add_argument("--counts", required=True)
    p.add_argument("--annotation", required=True)
    p.add_argument("--output")
    a = p.parse_args(arguments)
    counts, names = tables.read_matrix(spark, a.counts), matrix.gene_name_table(tables.read_gff(spark, a.annotation))
    if names.select("gene_id").distinct().count() < counts.select("gene").distinct().count():
        raise ValueError("the annotation has fewer genes than the matrix")
    sinks.write_matrix(matrix.rename_genes(counts, names), a.output or f"renamed_{base_name(a.counts)}.tsv")


def adjust_matrix_coordinates(spark: SparkSession, arguments: list[str]) -> None:
    p = argparse.ArgumentParser()
    p.add_argument("--counts-matrix", required=True)
    p.add_argument("--coordinates-file", required=True)
    p.add_argument("--update-coordinates", action="store_true")
    p.add_argument("--outfile")
    a = p.parse_args(arguments)
    adjusted = matrix.adjust_coordinates(tables.read_matrix(spark, a.counts_matrix), tables.read_coordinates(spark, a.coordinates_file), a.update_coordinates)
    sinks.write_matrix(adjusted, a.outfile or f"adjusted_{base_name(a.counts_matrix)}.tsv")


TOOLS = {
    "count_reads": count_reads, "matrix_report": matrix_report, "compare_matrices": compare_matrices, "merge_fastq": merge_fastq,
    "filter_gene_type_matrix": filter_gene_type_matrix, "convert_ensembl_to_names": convert_ensembl_to_names, "adjust_matrix_coordinates": adjust_matrix_coordinates,
}


def main(arguments: list[str] | None = None) -> int:
    arguments = sys.argv[1:] if arguments is None else arguments
    if not arguments or arguments[0] not in TOOLS:
        print(f"usage: spotweave.cli TOOL ...; tools: {', '.join(TOOLS)}", file=sys.stderr)
        return 2
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    try:
        TOOLS[arguments[0]](session(), arguments[1:])
    except Exception as error:
        log.error("%s failed: %s", arguments[0], error)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
