"""Counting genes over a stream of alignments in order of position.

A gene is complete, and is counted and forgotten, as soon as the input has passed its end: position is the
stream's progress and the gene's end the end of its window.  State is kept per gene by
``applyInPandasWithState``; genes without an end wait for the end of the stream.
"""

from __future__ import annotations

from collections.abc import Iterator
from io import StringIO

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from spotweave.functions.umi import ALGORITHMS

OUTPUT = "gene string, x int, y int, reads long, count long"
STATE = "rows string"


def unique_in_spot(rows: pd.DataFrame, offset: int, mismatches: int, algorithm: str) -> int:
    """Unique molecules of one spot's reads: gap sessions by strand and start, clusters within each."""
    total = 0
    for _, strand in rows.sort_values("start", kind="stable").groupby("strand", sort=True):
        session = (strand["start"].diff() > offset).cumsum()
        total += sum(len(ALGORITHMS[algorithm](sorted(set(u)), mismatches)) for _, u in strand.groupby(session)["umi"])
    return total


def count_genes(reads: DataFrame, ends: DataFrame, offset: int = 250, mismatches: int = 1, algorithm: str = "AdjacentBi") -> DataFrame:
    """(gene, x, y, reads, count) of a stream of TRANSCRIPT rows that have ``position`` and ``progress``.

    ``progress`` is the largest position of the row's micro-batch on its chromosome, or null at the end of the
    stream; ``ends`` are static (gene, chrom, end).  A gene seen again after it was given is given again.
    """
    known = ends.select(F.col("gene").alias("of"), F.col("end").alias("gene_end"))
    rows = reads.join(known, F.col("gene") == F.col("of"), "left").select("gene", "x", "y", "strand", "start", "umi", "progress", "gene_end")

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = [pd.read_json(StringIO(state.get[0]), orient="split", dtype={"umi": str, "strand": str})] if state.exists else []
        new = list(parts)
        everything = pd.concat([*held, *new], ignore_index=True) if held or new else pd.DataFrame()
        if everything.empty:
            return
        end = everything["gene_end"].dropna()
        progress = everything["progress"]
        done = progress.isna().any() or (len(end) and progress.max() > end.max())
        if not done:
            state.update((everything.to_json(orient="split"),))
            return
        if state.exists:
            state.remove()
        spots = everything[everything["umi"].notna()].groupby(["x", "y"], sort=True)
        out = [(key[0], int(x), int(y), len(g), unique_in_spot(g, offset, mismatches, algorithm)) for (x, y), g in spots]
        if out:
            yield pd.DataFrame(out, columns=["gene", "x", "y", "reads", "count"])

    return rows.groupBy("gene").applyInPandasWithState(step, OUTPUT, STATE, "append", GroupStateTimeout.NoTimeout)


def stream_reads(spark: SparkSession, path: str, schema) -> DataFrame:
    """A stream of Parquet files of TRANSCRIPT rows, one file a micro-batch in order of arrival."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
