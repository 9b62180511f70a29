"""Matrix clean-up on long counts (spot, gene, count and, where order matters, column)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spotweave.storage import small_side as small

def spot_coordinates(counts: DataFrame) -> DataFrame:
    """Adds sx and sy, read from the spot's label; fractional labels are read too."""
    parts = F.split("spot", "x")
    return counts.withColumns({"sx": parts[0].cast("double"), "sy": parts[1].cast("double")})


def adjust_coordinates(counts: DataFrame, coordinates: DataFrame, update: bool = False, legacy_under_tissue: bool = False) -> DataFrame:
    """Counts of the spots in the coordinates file; with ``update`` their labels are the new coordinates.

    Coordinates are (x, y, new_x, new_y, under_tissue); of repeated spots the last line (``line_no``) holds.
    Spots outside the tissue are left out; ``legacy_under_tissue`` takes any flag for inside.  Genes without
    counts disappear, as the long form has no rows for them.
    """
    known = coordinates if legacy_under_tissue else coordinates.where(F.coalesce("under_tissue", F.lit(1)) != 0)
    order = "line_no" if "line_no" in coordinates.columns else "new_x"
    known = known.groupBy("x", "y").agg(F.max_by(F.struct("new_x", "new_y"), order).alias("to"))
    known = small(known.select(F.col("x").cast("double").alias("sx"), F.col("y").cast("double").alias("sy"), "to"))
    label = F.concat_ws("x", F.round("to.new_x", 2).cast("string"), F.round("to.new_y", 2).cast("string")) if update else F.col("spot")
    return spot_coordinates(counts).join(known, ["sx", "sy"]).select(label.alias("spot"), "gene", "count").where("count > 0")


def rename_genes(counts: DataFrame, names: DataFrame) -> DataFrame:
    """Gene ids become names; of several ids of one name only the first column takes it.

    Counts need ``column``, the gene's place in the matrix; names are (gene_id, gene_name, line_no), of which
    the last line of an id holds.  Ids without a name stay, and a name taken by one isn't registered.
    """
    last = names.groupBy("gene_id").agg(F.max_by("gene_name", "line_no").alias("gene_name"))
    genes = counts.groupBy("gene").agg(F.min("column").alias("column"))
    found = genes.join(last, F.col("gene") == F.col("gene_id"), "left")
    first = F.row_number().over(Window.partitionBy("gene_name").orderBy("column", "gene")) == 1
    new = found.select(F.col("gene").alias("old"), F.when(F.col("gene_name").isNotNull() & first, F.col("gene_name")).otherwise(F.col("gene")).alias("name"))
    return counts.join(small(new), F.col("gene") == F.col("old")).select("spot", F.col("name").alias("gene"), "count", "column")


def repeated_genes(columns: DataFrame) -> DataFrame:
    """(gene, columns) of genes that head more than one column."""
    return columns.groupBy("gene").agg(F.count("*").alias("columns")).where("columns > 1")


def filter_gene_types(counts: DataFrame, types: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Counts of genes of the types to keep and of genes without a known type.

    Types are (gene, type, line_no); of repeated genes the last line holds.
    """
    last = types.groupBy("gene").agg(F.max_by("type", "line_no").alias("type"))
    dropped = last.where(~F.col("type").isin(*keep)).select("gene")
    return counts.join(small(dropped), "gene", "left_anti")


def gene_type_table(gff: DataFrame, by_id: bool = False) -> DataFrame:
    """(gene, type, line_no) of GFF rows: keyed by gene_id or gene_name; the type is gene_type or gene_biotype."""
    gene = F.try_element_at("attrs", F.lit("gene_id" if by_id else "gene_name"))
    kind = F.coalesce(F.try_element_at("attrs", F.lit("gene_type")), F.try_element_at("attrs", F.lit("gene_biotype")))
    return gff.select(gene.alias("gene"), kind.alias("type"), "line_no").where("gene IS NOT NULL AND type IS NOT NULL")


def gene_name_table(gff: DataFrame) -> DataFrame:
    """(gene_id, gene_name, line_no) of GFF rows; a line without either is an error."""
    def need(key: str):
        return F.coalesce(F.try_element_at("attrs", F.lit(key)), F.raise_error(F.lit(f"an annotation line lacks {key}")).cast("string")).alias(key)

    return gff.select(need("gene_id"), need("gene_name"), "line_no")
