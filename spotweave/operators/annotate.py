"""Genes of reads: features as a step function, an interval join by bins, and an ordered fold.

Features become elementary intervals with the set of genes over each.  Blocks of reads and intervals meet
in bins of BIN bases by equi-join with the overlap as a residual condition, so no range join is planned.
The intervals that a read meets are folded in order of block and position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spotweave.functions.cigar import aligned_blocks

BIN = 4_096
ENDLESS = 1 << 40  # beyond any position
MODES = ("union", "intersection-nonempty", "intersection-strict")
STRANDED = ("yes", "no", "reverse")


def validate(mode: str, stranded: str, feature_types: list[str] | None = None) -> None:
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode}; there are {MODES}")
    if stranded not in STRANDED:
        raise ValueError(f"unknown strandedness {stranded}; there are {STRANDED}")
    if feature_types is not None and not feature_types:
        raise ValueError("no feature types")


def invert_strand(strand: str | Column) -> Column:
    """The other strand; any other value is an error."""
    s = F.col(strand) if isinstance(strand, str) else strand
    return F.when(s == "+", "-").when(s == "-", "+").otherwise(F.raise_error(F.concat(F.lit("no strand to invert: "), F.coalesce(s, F.lit("null")))))


def select_features(gff: DataFrame, feature_types: tuple[str, ...] = ("exon",), id_attribute: str = "gene_id", stranded: str = "yes") -> DataFrame:
    """FEATURES chrom, low, high, strand, gene of GFF rows; one without the attribute, or without a strand if it matters, is an error."""
    rows = gff.where(F.col("feature").isin(*feature_types))
    gene = F.coalesce(F.try_element_at("attrs", F.lit(id_attribute)), F.raise_error(F.lit(f"a feature lacks {id_attribute}")).cast("string"))
    strand = F.col("strand") if stranded == "no" else F.when(F.col("strand").isin("+", "-"), F.col("strand")).otherwise(F.raise_error(F.lit("a feature has no strand")).cast("string"))
    return rows.select(F.col("seqname").alias("chrom"), (F.col("start") - 1).alias("low"), F.col("end").alias("high"), strand.alias("strand"), gene.alias("gene"))


def feature_steps(features: DataFrame, stranded: bool = True, gaps: bool = False) -> DataFrame:
    """(chrom, strand, low, high, genes): elementary intervals, neighbours of equal genes joined.

    Without strandedness all strands are one, called a dot.  With ``gaps`` intervals without genes are
    given too, from before the first to beyond the last feature.
    """
    strand = F.col("strand") if stranded else F.lit(".")
    features = features.select("chrom", strand.alias("strand"), "low", "high", "gene")
    by_place = Window.partitionBy("chrom", "strand").orderBy("low")
    cuts = features.select("chrom", "strand", F.explode(F.array("low", "high")).alias("low")).distinct()
    spans = cuts.withColumn("high", F.lead("low").over(by_place)).where("high IS NOT NULL")
    bins = F.explode(F.sequence(F.floor(F.col("low") / BIN), F.floor((F.col("high") - 1) / BIN)))
    left = spans.select("chrom", "strand", "low", "high", bins.alias("bin"))
    right = features.where("high > low").select("chrom", "strand", F.col("low").alias("from"), F.col("high").alias("to"), "gene", bins.alias("bin"))
    over = left.join(right, ["chrom", "strand", "bin"]).where((F.col("low") < F.col("to")) & (F.col("high") > F.col("from")))
    genes = over.groupBy("chrom", "strand", "low", "high").agg(F.array_sort(F.collect_set("gene")).alias("genes"))
    if gaps:
        genes = spans.join(genes, ["chrom", "strand", "low", "high"], "left").withColumn("genes", F.coalesce("genes", F.array().cast("array<string>")))
        ends = features.groupBy("chrom", "strand").agg(F.min("low").alias("first"), F.max("high").alias("last"))
        outer = F.explode(F.array(F.struct(F.lit(-ENDLESS).cast("long").alias("low"), F.col("first").cast("long").alias("high")), F.struct(F.col("last").cast("long").alias("low"), F.lit(ENDLESS).cast("long").alias("high"))))
        genes = genes.unionByName(ends.select("chrom", "strand", outer.alias("o")).select("chrom", "strand", "o.low", "o.high", F.array().cast("array<string>").alias("genes")))
    # gaps and islands: a run of touching intervals with equal genes is one
    fresh = ~((F.lag("high").over(by_place) == F.col("low")) & (F.lag("genes").over(by_place) == F.col("genes")))
    runs = genes.withColumn("run", F.sum(F.coalesce(fresh, F.lit(True)).cast("int")).over(by_place.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("chrom", "strand", "run").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.first("genes").alias("genes")).drop("run")


def fold_genes(steps: Column, mode: str) -> Column:
    """Genes of a read from its ordered arrays of genes.

    An intersection that has become empty starts anew with the next array; the nonempty mode skips empty
    arrays, the strict mode doesn't.
    """
    if mode == "union":
        return F.array_sort(F.array_distinct(F.flatten(steps)))
    used = F.filter(steps, lambda g: F.size(g) > 0) if mode == "intersection-nonempty" else steps
    empty = F.array().cast("array<string>")
    return F.array_sort(F.aggregate(used, empty, lambda s, g: F.when(F.size(s) > 0, F.array_intersect(s, g)).otherwise(g)))


def gene_label(genes: Column) -> Column:
    """One gene is the label; none and several have labels of their own."""
    many = F.concat(F.lit("__ambiguous["), F.array_join(genes, "+"), F.lit("]"))
    return F.when(F.size(genes) == 1, F.try_element_at(genes, F.lit(1))).when(F.size(genes) == 0, "__no_feature").otherwise(many)


def annotate(alignments: DataFrame, features: DataFrame, mode: str = "intersection-nonempty", stranded: str = "yes", key: str = "id", min_mapq: int = 0) -> DataFrame:
    """(key, gene): the label of every alignment; key names alignments uniquely.

    Alignments are (key, flag, chrom, pos from 0, mapq, cigar).  Unaligned reads are ``__not_aligned`` and
    those below the mapping quality ``__too_low_aQual``.
    """
    validate(mode, stranded)
    ordinary = F.when(F.col("flag").bitwiseAND(16) > 0, "-").otherwise("+")
    strand = F.lit(".") if stranded == "no" else ordinary if stranded == "yes" else invert_strand(ordinary)
    lost = (F.col("flag").bitwiseAND(4) > 0) | F.col("chrom").isNull()
    state = F.when(lost, "__not_aligned").when(F.col("mapq") < min_mapq, "__too_low_aQual")
    marked = alignments.select(key, state.alias("state"), "chrom", "pos", "cigar", strand.alias("strand"))
    # every alignment has a row at least, so that labels need no second join with the alignments
    aligned = F.when(F.col("state").isNull(), aligned_blocks("cigar", "pos"))
    blocks = marked.select(key, "state", "chrom", "strand", F.explode_outer(aligned).alias("b")).select(key, "state", "chrom", "strand", "b.block", "b.low", "b.high")
    steps = feature_steps(features, stranded != "no", gaps=mode == "intersection-strict")
    none = F.array().cast("array<string>")
    tail = F.lit(None).cast(f"struct<block:{blocks.schema['block'].dataType.simpleString()},from:bigint,genes:array<string>>")
    if mode == "intersection-strict":
        # the endless steps at a reference's ends are no steps of bins: that before all features changes nothing, as
        # an empty intersection starts anew; that behind the last begins at a place which its blocks are given
        ends = steps.where(F.col("high") == ENDLESS).select("chrom", "strand", F.col("low").alias("last"))
        steps = steps.where((F.col("low") > -ENDLESS) & (F.col("high") < ENDLESS))
        blocks = blocks.join(ends, ["chrom", "strand"], "left")
        tail = F.when(F.col("l.high") > F.col("l.last"), F.struct("l.block", F.col("l.last").alias("from"), none.alias("genes")))
    bins = F.sequence(F.floor(F.col("low") / BIN), F.floor((F.col("high") - 1) / BIN))
    left = blocks.withColumn("bin", F.explode_outer(F.when(F.col("low").isNotNull(), bins))).alias("l")
    right = steps.select("chrom", "strand", F.col("low").alias("from"), F.col("high").alias("to"), "genes", F.explode(bins).alias("bin")).alias("r")
    over = (F.col("l.chrom") == F.col("r.chrom")) & (F.col("l.strand") == F.col("r.strand")) & (F.col("l.bin") == F.col("r.bin")) & (F.col("l.low") < F.col("r.to")) & (F.col("l.high") > F.col("r.from"))
    met = left.join(right, over, "left").select(f"l.{key}", "l.state", F.when(F.col("r.from").isNotNull(), F.struct("l.block", "r.from", "r.genes")).alias("step"), tail.alias("tail"))
    found = met.groupBy(key).agg(F.max("state").alias("state"), F.array_sort(F.concat(F.collect_set("step"), F.collect_set("tail"))).alias("steps"))
    genes = fold_genes(F.transform("steps", lambda s: s["genes"]), mode)
    return found.withColumn("genes", genes).select(key, F.coalesce("state", gene_label(F.col("genes"))).alias("gene"))


def keep_annotated(annotated: DataFrame, include_non_annotated: bool = False, no_ambiguous: bool = False) -> DataFrame:
    """Adds ``assigned``: whether the label names a gene that counts."""
    dropped = F.col("gene").isin("__not_aligned", "__too_low_aQual", *([] if include_non_annotated else ["__no_feature"]))
    if no_ambiguous:
        dropped = dropped | F.col("gene").contains("__ambiguous")
    return annotated.withColumn("assigned", ~dropped)


def transcriptome_genes(alignments: DataFrame) -> DataFrame:
    """Alignments to transcripts: the gene is the first word of the reference's name."""
    return alignments.withColumn("gene", F.split("chrom", r"\s+")[0])


def gene_ends(gff: DataFrame, id_attribute: str = "gene_id") -> DataFrame:
    """(gene, chrom, end): the largest end of each gene over all feature types, the earliest line on ties."""
    gene = F.try_element_at("attrs", F.lit(id_attribute))
    rows = gff.select(gene.alias("gene"), "seqname", "end", "line_no").where("gene IS NOT NULL")
    return rows.groupBy("gene").agg(F.max_by("seqname", F.struct("end", -F.col("line_no"))).alias("chrom"), F.max("end").alias("end"))


def label_ends(labels: DataFrame, ends: DataFrame) -> DataFrame:
    """(gene, chrom, end) of the distinct labels in ``gene``; an ambiguous one ends with the last of its members, the earlier on ties.

    Labels without a known gene are left out.
    """
    distinct = labels.select("gene").distinct()
    inside = F.regexp_extract("gene", r"(?s)^__ambiguous\[(.*)\]$", 1)
    members = F.when(inside != "", F.split(inside, r"\+")).otherwise(F.array("gene"))
    each = distinct.select(F.col("gene").alias("label"), F.posexplode(members).alias("place", "gene")).join(ends, "gene")
    last = each.groupBy("label").agg(F.max_by(F.struct("chrom", "end"), F.struct("end", -F.col("place"))).alias("e"))
    return last.select(F.col("label").alias("gene"), "e.chrom", "e.end")
