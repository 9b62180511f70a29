"""Mixing sources to target weights.

Word totals per source give each source a target; target over total is its repetition rate.  A
document is emitted floor(rate) times, plus once more if a hash of its id and text, read as a number in
[0, 1), is below the fraction of the rate.  All steps are built-in column expressions; the totals are
pre-aggregated per task, so a source that holds most rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WORD = r"[^\x20\x09-\x0D]+"
#: Up to so many sources the targets are broadcast; beyond it they are joined by shuffle.
BROADCAST_SOURCES = 20_000


def word_count(text: str | Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_fraction(doc_id: Column, source: Column, text: Column, seed: str) -> Column:
    """A number in [0, 1) from 52 bits of a hash of seed, id and text; rows without an id are told apart by their source too."""
    who = F.coalesce(doc_id.cast("string"), F.concat(F.lit("null:"), F.coalesce(source, F.lit("null"))))
    digest = F.md5(F.concat(F.lit(seed + ":"), who, F.lit(":"), F.md5(F.coalesce(text, F.lit("")))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_targets(totals: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Adds ``target`` to (source, source_size): ``share`` of all words dealt by weight, capped at ``most`` times.

    Weights repeat over the sources in code-point order, null last.  The capped sources are a prefix
    of the order by cap per weight: a source is capped if what is left for it and all later ones, dealt
    by weight, would lift it above its cap.
    """
    ordinal = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (ordinal % len(weights) + 1).cast("int"))
    whole = Window.partitionBy(F.lit(1))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    dealt = (
        totals.withColumn("weight", weight)
        .withColumn("cap", F.lit(float(most)) * F.col("source_size"))
        .withColumn("budget", F.lit(float(share)) * F.sum("source_size").over(whole))
        .withColumn("level", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
        .withColumn("capped", F.col("cap") <= F.col("level") * F.col("weight"))
    )
    left = F.col("budget") - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0.0)).over(whole)
    free = F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("weight"))).over(whole)
    return dealt.withColumn("target", F.when(F.col("capped"), F.col("cap")).otherwise(left / free * F.col("weight"))).select("source", "source_size", "target")


def mix_plan(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: str = "mix", doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per input row: ``row`` (all columns), ``doc_id``, ``size``, ``source_size``, ``target`` and ``copies``.

    A null source is a source of its own; a null or empty text has size 0 and its copies count no
    words.  Sources without words have target 0 and emit nothing.  Rows of one id, or without an id, draw apart if their texts differ;
    rows equal in id and text draw alike.
    The same ids, texts and seed give the same copies in every run.
    """
    sized = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[doc_id].alias("doc_id"), docs[source].alias("source"), word_count(docs[text]).alias("size"), hash_fraction(docs[doc_id], docs[source], docs[text], seed).alias("draw"))
    totals = docs.select(docs[source].alias("source"), word_count(docs[text]).alias("size")).groupBy("source").agg(F.sum("size").alias("source_size"))
    rows = totals.limit(BROADCAST_SOURCES + 1).collect()
    if len(rows) <= BROADCAST_SOURCES:
        targets = F.broadcast(source_targets(docs.sparkSession.createDataFrame(rows, totals.schema), weights, share, most))
    else:
        targets = source_targets(totals, weights, share, most)
    targets = targets.withColumnRenamed("source", "of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    extra = F.col("draw") < rate - F.floor(rate)
    return sized.join(targets, F.col("source").eqNullSafe(F.col("of"))).select("row", "doc_id", "size", "source_size", "target", (F.floor(rate) + extra.cast("long")).alias("copies"))


def mix(docs: DataFrame, **parameters) -> DataFrame:
    """The mix itself: the rows of ``docs`` as often as planned, with a number ``copy`` from 1 on.

    If ``docs`` has a column ``copy`` already, the number is called ``copy_number``, and so on with
    further underscores until the name is free.
    """
    name = "copy"
    while name in docs.columns:
        name = "copy_number" if name == "copy" else name + "_"
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return mix_plan(docs, **parameters).where("copies > 0").select("row.*", copies.alias(name))
