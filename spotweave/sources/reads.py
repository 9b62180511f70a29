"""Readers of FASTQ, SAM and BAM files."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

FASTQ_SUFFIXES = (".fastq", ".fq", ".fastq.gz", ".fq.gz", ".fastq.bz2", ".fq.bz2")
ALIGNMENT = "name string, flag int, chrom string, pos long, mapq int, cigar string, seq string, qual string, barcode string, x int, y int, umi string, gene string, score int, loci int"


def check_fastq_name(path: str) -> None:
    if not path.endswith(FASTQ_SUFFIXES):
        raise ValueError(f"not a FASTQ file name: {path}")


def read_fastq(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, read_idx, name, seq, qual): records of four lines, numbered from 0 in each file.

    Works on any file system and on splits of one file: lines are numbered within each split, splits by
    their place in the file, and a record's lines meet by its number.  Gzip and bzip2 files are read too.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("line"), "value"
    )
    splits = lines.groupBy("file", "split").agg(F.min("line").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = splits.select("file", "split", "first", before.alias("before"))
    number = F.col("line") - F.col("first") + F.col("before")
    rows = lines.join(placed, ["file", "split"]).select("file", F.floor(number / 4).alias("read_idx"), (number % 4).alias("part"), "value")
    part = {name: F.max(F.when(F.col("part") == i, F.col("value"))).alias(name) for i, name in ((0, "head"), (1, "seq"), (3, "qual"))}
    records = rows.groupBy("file", "read_idx").agg(*part.values())
    return records.where("head IS NOT NULL AND qual IS NOT NULL").select("file", "read_idx", F.substring("head", 2, 1 << 30).alias("name"), "seq", "qual")


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """ALIGNMENT rows of SAM text; positions from 0.  Tags B0 to B3 and XF become columns."""
    t = F.split("value", "\t")
    lines = spark.read.text(path).where(~F.col("value").startswith("@") & (F.col("value") != "")).select(t.alias("t"))

    def tag(name: str):
        hit = F.filter(F.slice("t", F.lit(12), F.size("t")), lambda x: x.startswith(f"{name}:"))
        return F.substring(F.try_element_at(hit, F.lit(1)), 6, 1 << 30)

    def known(i: int):
        return F.when(F.col("t")[i] != "*", F.col("t")[i])

    return lines.select(
        F.col("t")[0].alias("name"), F.col("t")[1].cast("int").alias("flag"), known(2).alias("chrom"), (F.col("t")[3].cast("long") - 1).alias("pos"), F.col("t")[4].cast("int").alias("mapq"),
        known(5).alias("cigar"), known(9).alias("seq"), known(10).alias("qual"), tag("B0").alias("barcode"), tag("B1").cast("int").alias("x"), tag("B2").cast("int").alias("y"), tag("B3").alias("umi"),
        tag("XF").alias("gene"), tag("AS").cast("int").alias("score"), tag("NH").cast("int").alias("loci"),
    )


def bam_records(raw: bytes) -> Iterator[tuple]:
    """Alignments of a BAM file, which is a chain of gzip members."""
    parts, rest = [], raw
    while rest:
        member = zlib.decompressobj(31)
        parts.append(member.decompress(rest) + member.flush())
        rest = member.unused_data
    data = b"".join(parts)
    if data[:4] != b"BAM\1":
        raise ValueError("not a BAM file")
    at = 8 + struct.unpack_from("<i", data, 4)[0]
    n, at = struct.unpack_from("<i", data, at)[0], at + 4
    names = []
    for _ in range(n):
        size = struct.unpack_from("<i", data, at)[0]
        names.append(data[at + 4 : at + 3 + size].decode())
        at += 8 + size
    sizes = {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
    codes = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}
    while at < len(data):
        length, ref, pos, name_size, mapq, _, n_ops, flag, n_bases, _, _, _ = struct.unpack_from("<iiiBBHHHiiii", data, at)
        end, p = at + 4 + length, at + 36
        name = data[p : p + name_size - 1].decode()
        p += name_size
        ops = struct.unpack_from(f"<{n_ops}I", data, p)
        p += 4 * n_ops
        packed = data[p : p + (n_bases + 1) // 2]
        p += (n_bases + 1) // 2
        bases = "".join("=ACMGRSVTWYHKDBN"[b >> 4] + "=ACMGRSVTWYHKDBN"[b & 15] for b in packed)[:n_bases]
        quality = data[p : p + n_bases]
        p += n_bases
        tags: dict = {}
        while p < end:
            key, kind = data[p : p + 2].decode(), chr(data[p + 2])
            p += 3
            if kind in "ZH":
                stop = data.index(b"\0", p)
                tags[key], p = data[p:stop].decode(), stop + 1
            elif kind == "B":
                p += 5 + sizes[chr(data[p])] * struct.unpack_from("<i", data, p + 1)[0]
            elif kind == "A":
                tags[key], p = chr(data[p]), p + 1
            else:
                tags[key], p = struct.unpack_from("<" + codes[kind], data, p)[0], p + sizes[kind]
        at = end
        cigar = "".join(f"{op >> 4}{'MIDNSHP=X'[op & 15]}" for op in ops) or None
        text = None if not n_bases or quality[:1] == b"\xff" else "".join(chr(q + 33) for q in quality)
        spot = [None if tags.get(k) is None else int(tags[k]) for k in ("B1", "B2")]
        yield (name, flag, names[ref] if ref >= 0 else None, pos, mapq, cigar, bases or None, text, tags.get("B0"), *spot, tags.get("B3"), tags.get("XF"), tags.get("AS"), tags.get("NH"))


def read_bam(spark: SparkSession, path: str) -> DataFrame:
    """ALIGNMENT rows of BAM files; a file is decoded by one task and must be under 2 GB, as Spark hands it over whole."""
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
    fields = [f.split(" ") for f in ALIGNMENT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0):
                held: list[tuple] = []
                for record in bam_records(raw.as_py()):
                    held.append(record)
                    if len(held) == 10_000:
                        yield packed(held)
                        held = []
                yield packed(held)

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * len(fields)
        return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, ALIGNMENT)


def read_alignments(spark: SparkSession, path: str) -> DataFrame:
    """ALIGNMENT rows of a .sam, .bam or Parquet path."""
    if path.endswith(".sam"):
        return read_sam(spark, path)
    return read_bam(spark, path) if path.endswith(".bam") else spark.read.parquet(path)
