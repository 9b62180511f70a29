"""Comparison of several datasets: long counts with a column ``dataset``.

Everything works on gene totals per dataset, which are aggregated first; pairs of datasets are formed from
these totals by a join on the gene, never from cells.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.storage import small_side


def gene_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("dataset", "gene").agg(F.sum("count").alias("total"))


def all_genes(counts: DataFrame) -> DataFrame:
    return counts.select("gene").distinct()


def common_genes(counts: DataFrame) -> DataFrame:
    """Genes of every dataset."""
    per_gene = counts.select("dataset", "gene").distinct().groupBy("gene").agg(F.count("*").alias("n"))
    n = counts.select("dataset").distinct().agg(F.count("*").alias("datasets"))
    return per_gene.join(F.broadcast(n), F.col("n") == F.col("datasets")).select("gene")


def filled_totals(counts: DataFrame) -> DataFrame:
    """(dataset, gene, total) for every dataset and every gene of any, 0 where a dataset lacks the gene.

    A gene's totals are put in a map and read for each dataset name, so nothing is crossed.
    """
    totals = gene_totals(counts)
    names = totals.agg(F.array_sort(F.collect_set("dataset")).alias("names"))
    by_gene = totals.groupBy("gene").agg(F.map_from_entries(F.collect_list(F.struct("dataset", "total"))).alias("has"))
    each = by_gene.join(F.broadcast(names)).select("gene", "has", F.explode("names").alias("dataset"))
    return each.select("dataset", "gene", F.coalesce(F.try_element_at("has", F.col("dataset")), F.lit(0).cast("long")).alias("total"))


def gene_pairs(counts: DataFrame) -> DataFrame:
    """(dataset1, dataset2, gene, total1, total2) of the genes that two datasets share, in both orders and with itself."""
    totals = gene_totals(counts)
    one = totals.select(F.col("dataset").alias("dataset1"), "gene", F.col("total").alias("total1"))
    two = totals.select(F.col("dataset").alias("dataset2"), "gene", F.col("total").alias("total2"))
    return one.join(two, "gene")


def gene_similarity(counts: DataFrame) -> DataFrame:
    """(dataset1, dataset2, similarity): share of the first's genes that the second has; pairs without any have none."""
    shared = gene_pairs(counts).groupBy("dataset1", "dataset2").agg(F.count("*").alias("n"))
    own = gene_totals(counts).groupBy("dataset").agg(F.count("*").alias("genes"))
    return shared.join(small_side(own), F.col("dataset1") == F.col("dataset")).select("dataset1", "dataset2", (F.col("n") / F.col("genes")).alias("similarity"))


def shared_with_all(counts: DataFrame) -> DataFrame:
    """(dataset, share): share of a dataset's genes that all datasets have."""
    genes = gene_totals(counts)
    hit = genes.join(common_genes(counts).withColumn("common", F.lit(1)), "gene", "left")
    return hit.groupBy("dataset").agg((F.count("common") / F.count("*")).alias("share"))


def gene_correlation(counts: DataFrame, use_log: bool = False) -> DataFrame:
    """(dataset1, dataset2, correlation): Pearson's over the totals of shared genes, of their logarithms if asked.

    Null where either side does not vary.
    """
    pairs = gene_pairs(counts)
    a, b = (F.log("total1"), F.log("total2")) if use_log else (F.col("total1").cast("double"), F.col("total2").cast("double"))
    spread = F.nullif(F.stddev_pop(a) * F.stddev_pop(b), F.lit(0.0))
    return pairs.groupBy("dataset1", "dataset2").agg((F.covar_pop(a, b) / spread).alias("correlation"))


def violin_stats(counts: DataFrame) -> DataFrame:
    """Per dataset and measure (reads, genes): least, quartiles, largest and mean over its spots."""
    spots = counts.groupBy("dataset", "spot").agg(F.sum("count").alias("reads"), F.count_if(F.col("count") > 0).alias("genes"))
    pair = F.explode(F.array(F.struct(F.lit("reads").alias("measure"), F.col("reads").alias("value")), F.struct(F.lit("genes").alias("measure"), F.col("genes").alias("value")))).alias("m")
    long = spots.select("dataset", pair).select("dataset", "m.measure", F.col("m.value").cast("double").alias("value"))
    quantile = [F.percentile("value", q).alias(n) for q, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))]
    return long.groupBy("dataset", "measure").agg(F.min("value").alias("least"), *quantile, F.max("value").alias("largest"), F.avg("value").alias("mean"))


#: Datasets compared by PCA at most: their Gram matrix is solved on the driver.
PCA_DATASETS = 2_000


def pca(counts: DataFrame) -> DataFrame:
    """(dataset, pc1, pc2): whitened principal components of log1p gene totals; the sign makes the largest entry positive.

    With few datasets and many genes the Gram matrix of the datasets holds all that is needed; it is summed
    over genes in Spark, from the genes' own totals, and is datasets squared in size.
    """
    spark = counts.sparkSession
    logs = gene_totals(counts).select("dataset", "gene", F.log1p("total").alias("v"))
    names = sorted(r["dataset"] for r in logs.select("dataset").distinct().collect())
    n = len(names)
    if n > PCA_DATASETS:
        raise ValueError(f"{n} datasets; at most {PCA_DATASETS} are compared")
    if n < 2:
        return spark.createDataFrame([(d, 0.0, 0.0) for d in names], "dataset string, pc1 double, pc2 double")
    dots = logs.select(F.col("dataset").alias("a"), "gene", F.col("v").alias("va")).join(logs.select(F.col("dataset").alias("b"), "gene", F.col("v").alias("vb")), "gene")
    gram = np.zeros((n, n))
    at = {d: i for i, d in enumerate(names)}
    for r in dots.groupBy("a", "b").agg(F.sum(F.col("va") * F.col("vb")).alias("dot")).collect():
        gram[at[r["a"]], at[r["b"]]] = r["dot"]
    centre = np.eye(n) - 1 / n
    values, vectors = np.linalg.eigh(centre @ gram @ centre)
    order = np.argsort(-values)[:2]
    score = vectors[:, order] * np.sqrt(n - 1)
    score[:, values[order] < 1e-9] = 0
    score *= np.where(score[np.abs(score).argmax(0), range(score.shape[1])] < 0, -1, 1)
    score = np.pad(score, ((0, 0), (0, 2 - score.shape[1])))
    return spark.createDataFrame([(d, float(score[i, 0]), float(score[i, 1])) for i, d in enumerate(names)], "dataset string, pc1 double, pc2 double")
