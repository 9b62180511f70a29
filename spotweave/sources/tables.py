"""Readers of annotation, barcode, matrix and coordinate files; all by Spark's text reader."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotweave.functions.gff import FIXED, attribute_map, clean_value


def read_gff(spark: SparkSession, path: str) -> DataFrame:
    """GFF rows of a GTF or GFF3 file, plain or compressed; lines that begin with # are skipped."""
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("line_no"), F.rtrim("value").alias("value"))
    return parse_gff(lines.where(~F.col("value").startswith("#") & (F.col("value") != "")))


def parse_gff(lines: DataFrame) -> DataFrame:
    """GFF of (line_no, value)."""
    parts = F.split("value", "\t")
    fields = [clean_value(F.try_element_at(parts, F.lit(i + 1))).alias(name) for i, name in enumerate(FIXED)]
    rows = lines.select("line_no", *fields, attribute_map(F.coalesce(F.try_element_at(parts, F.lit(9)), F.lit(""))).alias("attrs"))
    return rows.withColumns({c: F.col(c).cast("long") for c in ("start", "end")})


def read_barcodes(spark: SparkSession, path: str) -> DataFrame:
    """BARCODE rows: barcode, x and y parted by any white space."""
    parts = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).where(F.trim("value") != "").select(parts[0].alias("barcode"), parts[1].cast("int").alias("x"), parts[2].cast("int").alias("y"))


def barcode_length(barcodes: DataFrame) -> int:
    row = barcodes.select(F.length("barcode")).first()
    return row[0] if row else 0


def unique_headers(names: list[str]) -> list[str]:
    """Repeated headers get .1, .2 and so on."""
    seen: dict[str, int] = {}
    out = []
    for name in names:
        n = seen.get(name, 0)
        seen[name] = n + 1
        out.append(f"{name}.{n}" if n else name)
    return out


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """(spot, gene, count, column) of a tab-separated matrix; zeros are absent.

    The header may have a cell above the spots or not.
    """
    lines = spark.read.text(path)
    first = lines.first()
    if first is None:
        return spark.createDataFrame([], "spot string, gene string, count long, column int")
    head = first["value"].rstrip("\r\n").split("\t")
    # the first line is told from the others by its text: a line of numbers never equals it
    rows = lines.where((F.col("value") != first["value"]) & (F.trim("value") != ""))
    cells = F.split("value", "\t")
    width = rows.select(F.size(cells).alias("n")).first()
    names = unique_headers(head if width is None or width["n"] > len(head) else head[1:])
    genes = F.split(F.lit("\t".join(names)), "\t")
    melted = rows.select(cells[0].alias("spot"), F.posexplode(F.slice(cells, 2, max(1, len(names)))).alias("column", "cell"))
    melted = melted.select("spot", F.try_element_at(genes, F.col("column") + 1).alias("gene"), F.col("cell").cast("double").cast("long").alias("count"), "column")
    return melted.where("count <> 0")


def matrix_spots(spark: SparkSession, path: str) -> DataFrame:
    """All spots of a matrix file, those without counts too."""
    lines = spark.read.text(path)
    first = lines.first()
    return lines.where((F.col("value") != (first["value"] if first else "")) & (F.trim("value") != "")).select(F.split("value", "\t")[0].alias("spot"))


def read_coordinates(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, x, y, new_x, new_y, pixel_x, pixel_y, under_tissue) of lines of 4, 6 or 7 words; other counts are an error.

    A line that begins with x is a header.
    """
    t = F.split(F.trim("value"), r"\s+")
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("line_no"), t.alias("t")).where("t[0] <> ''")
    fits = F.when(F.size("t").isin(4, 6, 7), F.col("t")).otherwise(F.raise_error(F.lit("a line of coordinates has 4, 6 or 7 words")).cast("array<string>"))
    rows = lines.select("line_no", fits.alias("t")).where("t[0] <> 'x'")

    def word(i: int, kind: str):
        return F.try_element_at("t", F.lit(i + 1)).cast(kind)

    return rows.select("line_no", word(0, "int").alias("x"), word(1, "int").alias("y"), F.round(word(2, "double"), 2).alias("new_x"), F.round(word(3, "double"), 2).alias("new_y"), word(4, "double").alias("pixel_x"), word(5, "double").alias("pixel_y"), word(6, "double").cast("int").alias("under_tissue"))


def read_stats(spark: SparkSession, path: str) -> dict:
    """A statistics file as a dictionary."""
    return json.loads("\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()))
