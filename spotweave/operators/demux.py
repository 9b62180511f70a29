"""Assignment of reads to locations by approximate barcode match.

Observed barcodes are made distinct first, which shrinks the reads to the barcodes' variety.  Those that
occur in the table match exactly; only the others search.  Candidates share an unchanged piece with the
barcode: with at most k errors one of k + 1 pieces is unchanged, at its place for Hamming distance and up to
k places away for edits.  So the search is an equi-join on pieces, and every candidate is verified.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spotweave.functions.seq import hamming, join_slices
from spotweave.storage import small_side

METRICS = ("Hamming", "Levenshtein", "Subglobal")
#: Barcode tables of at most so many rows are broadcast.
BROADCAST_BARCODES = 2_000_000
#: Characters of the pieces in which long strings are searched.
PIECE = 256


def free_end_distances(texts: list[str], patterns: list[str]) -> np.ndarray:
    """Edit distance of each pattern to the nearest part of its text, all pairs of a batch at once.

    A table's row is kept for all pairs; the step along a row is a running minimum.
    """
    width, height = max(map(len, texts), default=0), max(map(len, patterns), default=0)
    # paddings are unlike each other and all characters
    text = np.array([[*map(ord, t)] + [-1] * (width - len(t)) for t in texts], np.int32).reshape(len(texts), width)
    pattern = np.array([[*map(ord, p)] + [-2] * (height - len(p)) for p in patterns], np.int32).reshape(len(texts), height)
    length, inside = np.array([len(p) for p in patterns]), np.arange(width + 1) <= np.array([len(t) for t in texts])[:, None]
    at = np.arange(width + 1, dtype=np.int32)
    row = np.zeros((len(texts), width + 1), np.int32)
    out = np.zeros(len(texts), np.int32)
    for i in range(height):
        new = row + 1
        new[:, 1:] = np.minimum(new[:, 1:], row[:, :-1] + (text != pattern[:, i : i + 1]))
        row = np.minimum.accumulate(new - at, axis=1) + at
        ended = length == i + 1
        out[ended] = np.where(inside, row, np.iinfo(np.int32).max)[ended].min(1)
    return out


def subglobal(observed: str, barcode: str) -> Column:
    """Edit distance of the barcode to the observed string whose ends are free; an Arrow UDF."""

    @F.pandas_udf("int")
    def distances(texts: pd.Series, patterns: pd.Series) -> pd.Series:
        known = (texts.notna() & patterns.notna()).to_numpy()
        out = pd.Series([None] * len(texts), dtype="Int32")
        out[known] = free_end_distances(list(texts[known]), list(patterns[known]))
        return out

    return distances(observed, barcode)


def _pieces(barcode: Column, k: int) -> Column:
    """Array of (piece, text): k + 1 pieces."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(k)),
        lambda i: F.struct(
            i.alias("piece"),
            F.substring(barcode, F.floor(F.length(barcode) * i / (k + 1)).cast("int") + 1, (F.floor(F.length(barcode) * (i + 1) / (k + 1)) - F.floor(F.length(barcode) * i / (k + 1))).cast("int")).alias("text"),
        ),
    )


def _distance(metric: str, observed: str, barcode: str, k: int) -> Column:
    if metric == "Hamming":
        return hamming(observed, barcode)
    if metric == "Levenshtein":
        d = F.levenshtein(F.col(observed), F.col(barcode), k)
        return F.when(d >= 0, d)
    return subglobal(observed, barcode)


def match_barcodes(observed: DataFrame, barcodes: DataFrame, max_distance: int = 2, metric: str = "Hamming", keep_one: bool = False) -> DataFrame:
    """One row per distinct observed barcode: category, distance, barcode, x, y.

    Categories: Perfect (in the table), Imperfect (one nearest within the distance), Ambiguous (several;
    only with ``keep_one`` the least of them is given) and Unmatched.  Null barcodes are Unmatched.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric}; there are {METRICS}")
    table = barcodes.groupBy("barcode").agg(F.min(F.struct("x", "y")).alias("at")).select(F.col("barcode").alias("known"), "at.x", "at.y")
    table = small_side(table, BROADCAST_BARCODES)
    distinct = observed.select("observed").distinct()
    exact = distinct.join(table, F.col("observed") == F.col("known"), "left")
    perfect = exact.where("known IS NOT NULL").select("observed", F.lit("Perfect").alias("category"), F.lit(0).alias("distance"), F.col("known").alias("barcode"), "x", "y")
    rest = exact.where("known IS NULL").select("observed")
    k, slack = max_distance, 0 if metric == "Hamming" else max_distance
    keyed = table.select("known", "x", "y", F.explode(_pieces(F.col("known"), k)).alias("p")).select("known", "x", "y", "p.piece", F.col("p.text").alias("text"))
    # the observed string offers the texts of its pieces, moved by up to ``slack`` places (anywhere if ends are free)
    lengths = table.select(F.length("known").alias("n")).distinct()
    sizes = sorted(r["n"] for r in lengths.collect())
    offers = []
    for n in sizes:
        for i in range(k + 1):
            low, high = n * i // (k + 1), n * (i + 1) // (k + 1)
            if metric == "Subglobal":
                places = F.sequence(F.lit(1), F.greatest(F.length("observed") - (high - low) + 1, F.lit(1)))
            else:
                places = F.sequence(F.lit(max(0, low - slack) + 1), F.lit(low + slack + 1))
            offers.append(_offers(places, i, high - low))
    if offers:
        found = rest.where("observed IS NOT NULL").select("observed", F.explode(F.array_distinct(F.flatten(F.array(*offers)))).alias("o")).select("observed", "o.piece", "o.text")
        pairs = found.join(keyed, ["piece", "text"]).select("observed", "known", "x", "y").distinct()
        near = pairs.withColumn("distance", _distance(metric, "observed", "known", k)).where(F.col("distance") <= k)
        best = near.groupBy("observed", "distance").agg(F.count("*").alias("hits"), F.min(F.struct("known", "x", "y")).alias("hit"))
        best = best.groupBy("observed").agg(F.min(F.struct("distance", "hits", "hit")).alias("b")).select(F.col("observed").alias("of"), "b.distance", "b.hits", "b.hit")
    else:
        best = rest.where("false").select(F.col("observed").alias("of"), F.lit(0).alias("distance"), F.lit(0).cast("long").alias("hits"), F.lit(None).cast("struct<known:string,x:int,y:int>").alias("hit"))
    joined = rest.join(best, F.col("observed") == F.col("of"), "left")
    category = F.when(F.col("hits").isNull(), "Unmatched").when(F.col("hits") == 1, "Imperfect").otherwise("Ambiguous")
    given = (F.col("hits") == 1) | (F.lit(keep_one) & (F.col("hits") > 1))
    others = joined.select("observed", category.alias("category"), "distance", *[F.when(given, F.col("hit")[c]).alias(a) for c, a in (("known", "barcode"), ("x", "x"), ("y", "y"))])
    return perfect.unionByName(others)


def _offers(places: Column, piece: int, size: int) -> Column:
    """Array of (piece, text): what the observed string has at each place."""
    return F.transform(places, lambda start: F.struct(F.lit(piece).alias("piece"), F.substring("observed", start, F.lit(size)).alias("text")))


def demultiplex(reads: DataFrame, barcodes: DataFrame, max_distance: int = 2, metric: str = "Hamming", keep_one: bool = False, trim: list[int] | None = None) -> DataFrame:
    """The reads with category, distance, matched barcode and location.

    ``trim`` lists start, end, ... of the pieces of the read's barcode that are compared.
    """
    used = join_slices("barcode", trim) if trim else F.col("barcode")
    named = reads.withColumn("observed", used)
    matches = match_barcodes(named.select("observed"), barcodes, max_distance, metric, keep_one).withColumnRenamed("barcode", "matched")
    return named.join(matches.withColumnRenamed("observed", "of"), F.col("observed").eqNullSafe(F.col("of"))).drop("of")


def category_counts(matched: DataFrame) -> DataFrame:
    return matched.groupBy("category").agg(F.count("*").alias("reads"))


def shared_words(reads: DataFrame, reference: DataFrame, k: int, key: str = "id", sequence: str = "seq") -> DataFrame:
    """Reads that share no string of k characters with the reference (a stand-in for aligning to contaminants).

    The reference's strings are made distinct; if they are few they are broadcast, and the reads' strings are
    looked up where they arise.
    """

    def words(frame: DataFrame, *keep: str) -> DataFrame:
        # by way of pieces: a place is found by counting from the start of its string
        starts = F.explode(F.sequence(F.lit(1), F.length(sequence) - (k - 1), F.lit(PIECE))).alias("start")
        pieces = frame.where(F.length(sequence) >= k).select(*keep, sequence, starts).select(*keep, F.substring(sequence, F.col("start"), F.lit(PIECE + k - 1)).alias("piece"))
        places = F.explode(F.sequence(F.lit(1), F.length("piece") - (k - 1))).alias("place")
        return pieces.select(*keep, "piece", places).select(*keep, F.substring("piece", F.col("place"), F.lit(k)).alias("word"))

    known = small_side(words(reference).distinct(), BROADCAST_BARCODES)
    hit = words(reads, key).join(known, "word", "left_semi").select(key).distinct()
    return reads.join(hit, key, "left_anti")
