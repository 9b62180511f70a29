"""CIGAR strings as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spotweave.functions.seq import col


def operations(cigar: str | Column) -> Column:
    """Array of (op, n)."""
    return F.transform(F.regexp_extract_all(col(cigar), F.lit("([0-9]+[MIDNSHP=X])"), F.lit(1)), lambda t: F.struct(F.right(t, F.lit(1)).alias("op"), F.left(t, F.length(t) - 1).cast("long").alias("n")))


def reference_length(cigar: str | Column) -> Column:
    """Reference bases that the alignment covers."""
    return F.aggregate(operations(cigar), F.lit(0).cast("long"), lambda s, o: s + F.when(o["op"].isin("M", "D", "N", "=", "X"), o["n"]).otherwise(0))


def aligned_blocks(cigar: str | Column, position: str | Column) -> Column:
    """Array of (block, low, high): reference intervals of M, = and X operations, from 0, half open."""
    kinds = operations(cigar)

    def step(state: Column, o: Column) -> Column:
        takes = o["op"].isin("M", "=", "X") & (o["n"] > 0)
        moves = F.when(o["op"].isin("M", "D", "N", "=", "X"), o["n"]).otherwise(0)
        block = F.struct(F.size(state["blocks"]).alias("block"), state["at"].alias("low"), (state["at"] + o["n"]).alias("high"))
        return F.struct((state["at"] + moves).alias("at"), F.when(takes, F.concat(state["blocks"], F.array(block))).otherwise(state["blocks"]).alias("blocks"))

    empty = F.array().cast("array<struct<block:int,low:bigint,high:bigint>>")
    return F.aggregate(kinds, F.struct(col(position).cast("long").alias("at"), empty.alias("blocks")), step)["blocks"]


def clip_lengths(cigar: str | Column) -> tuple[Column, Column]:
    """Soft-clipped bases at the start and at the end; hard clips may stand outside them."""
    c = col(cigar)

    def number(pattern: str) -> Column:
        found = F.regexp_extract(c, pattern, 1)
        return F.when(found == "", 0).otherwise(F.try_to_number(found, F.lit("9999999999"))).cast("long")

    return number(r"^(?:[0-9]+H)?([0-9]+)S"), number(r"([0-9]+)S(?:[0-9]+H)?$")


def clipped_interval(cigar: str | Column, position: str | Column, strand: str | Column) -> tuple[Column, Column]:
    """Start and end of the read with its soft clips laid out; for the minus strand they change places."""
    head, tail = clip_lengths(cigar)
    low = col(position).cast("long") - head
    high = col(position).cast("long") + reference_length(cigar) + tail
    minus = col(strand) == "-"
    return F.when(minus, high).otherwise(low), F.when(minus, low).otherwise(high)
