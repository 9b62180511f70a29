"""Annotation lines (GTF, GFF3) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spotweave.functions.seq import col

# The format's columns, and below its separators.
FIXED = ("seqname", "source", "feature", "start", "end", "score", "strand", "frame")


def clean_value(value: Column) -> Column:
    """Without quotes at the ends; empty, a single dot and NA are null."""
    bare = F.btrim(value, F.lit("\"'"))
    return F.when(~bare.isin("", ".", "NA"), bare)


def attribute_map(attributes: str | Column) -> Column:
    """Map of a line's attributes.

    They are parted by semicolons; key and value by the first white space or equals sign.  One without a
    value is called INFO and its number from 1; of repeated keys the last holds, and keys whose value is
    null are left out.
    """
    parts = F.filter(F.split(col(attributes), r"\s*;\s*"), lambda p: F.length(F.trim(p)) > 0)
    pairs = F.transform(parts, lambda p, i: F.split(F.trim(p), r"\s+|\s*=\s*", 2))

    def entry(pair: Column, i: Column) -> Column:
        keyed = F.size(pair) > 1
        key = F.when(keyed, pair[0]).otherwise(F.concat(F.lit("INFO"), (i + 1).cast("string")))
        return F.struct(key.alias("key"), clean_value(F.when(keyed, F.try_element_at(pair, F.lit(2))).otherwise(pair[0])).alias("value"))

    entries = F.transform(pairs, entry)
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.greatest(F.size(entries), F.lit(1))), lambda later: later["key"] == e["key"]))
    return F.map_from_entries(F.filter(last, lambda e: e["value"].isNotNull()))


def list_value(value: str | Column) -> Column:
    """A value as a list, parted by commas."""
    return F.split(col(value), r"\s*,\s*")


def attribute_lists(attributes: str | Column) -> Column:
    """Map of a line's attributes with each value as a list; a value without commas is a list of one."""
    return F.transform_values(attribute_map(attributes), lambda _, value: list_value(value))
