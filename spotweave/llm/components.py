"""Connected components of a table of links, by label spreading with pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.storage import release, stored


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(id, component): the least id that links reach, for every id in a link.

    In each round an edge list is rewritten so that larger ends point to the least neighbour, first from
    all neighbours and then from the smaller ones alone (large star, small star); the edges shrink to stars
    in about log(longest path) rounds.  Every round is aggregations and joins; nothing comes to the driver but
    the number of edges and one hash of them all, by which a round without a change is known.
    """

    def print_of(frame: DataFrame) -> tuple:
        return tuple(frame.agg(F.count("*"), F.bit_xor(F.xxhash64("v", "u"))).first())

    edges = stored(links.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).where("u < v").distinct())
    before = print_of(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("m", "v").alias("m"))
        large = both.where("u > v").join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        lower = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(lower, "v").select(F.explode(F.array(F.struct(F.col("u").alias("v"), F.col("m").alias("u")), F.struct(F.col("v"), F.col("m").alias("u")))).alias("e")).select("e.v", "e.u").where("u < v").distinct()
        after = stored(small)
        release(edges)
        edges, now = after, print_of(after)
        if now == before:
            break
        before = now
    stars = edges.select(F.col("v").alias("id"), F.col("u").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("id"), "component").distinct())
