"""Readers, writers, the whole pipeline, the tools and the stream."""

import bz2
import gzip
import json
import os
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from spotweave import cli
from spotweave.config import VISIUM, PipelineConfig, from_arguments
from spotweave.plans import pipeline
from spotweave.sources import reads, sinks, tables
from spotweave.streaming import genes


def text_of(path):
    path = str(path)
    parts = sorted(p for p in os.listdir(path) if p.startswith("part-"))
    opener = gzip.open if parts and parts[0].endswith(".gz") else open
    return "".join(opener(f"{path}/{p}", "rt").read() for p in parts)


def fastq(records):
    return "".join(f"@{n}\n{s}\n+\n{q}\n" for n, s, q in records)


@pytest.mark.parametrize("suffix", ["", ".gz", ".bz2"])
def test_fastq(spark, tmp_path, suffix):
    records = [(f"read{i} 1:N", "ACGT" * (i % 9 + 1), "@III" * (i % 9 + 1)) for i in range(3000)]
    path = tmp_path / f"a.fastq{suffix}"
    path.write_bytes({"": lambda b: b, ".gz": gzip.compress, ".bz2": bz2.compress}[suffix](fastq(records).encode()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        got = reads.read_fastq(spark, str(path)).orderBy("read_idx").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r["name"], r["seq"], r["qual"]) for r in got] == records and [r["read_idx"] for r in got] == list(range(3000))
    sinks.write_fastq(reads.read_fastq(spark, str(path)).orderBy("read_idx"), str(tmp_path / "out"), single=True)
    assert text_of(tmp_path / "out") == fastq(records)


def test_fastq_names_and_merge(spark, tmp_path):
    with pytest.raises(ValueError):
        reads.check_fastq_name("a.txt")
    for name in ("S1_R1_001", "S1_R2_001", "S1_R1_002", "S10_R1_001"):
        (tmp_path / f"{name}.fastq").write_text(fastq([(name, "ACGT", "IIII")]))
    sinks.merge_fastq(spark, str(tmp_path), ["S1"], str(tmp_path / "out"))
    assert text_of(tmp_path / "out/S1_R1.fastq.gz") == fastq([("S1_R1_001", "ACGT", "IIII"), ("S1_R1_002", "ACGT", "IIII")])


def bam(records, names):
    body = b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", len(names)) + b"".join(struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", 9999) for n in names)
    for name, flag, ref, pos, cigar, seq, tags in records:
        ops = b"".join(struct.pack("<I", n << 4 | "MIDNSHP=X".index(o)) for n, o in cigar)
        codes = ["=ACMGRSVTWYHKDBN".index(c) for c in seq] + [0]
        packed = bytes(codes[i] << 4 | codes[i + 1] for i in range(0, len(seq), 2))
        data = struct.pack("<iiBBHHHiiii", ref, pos, len(name) + 1, 60, 0, len(cigar), flag, len(seq), -1, -1, 0) + name.encode() + b"\0" + ops + packed + bytes([40] * len(seq)) + tags
        body += struct.pack("<i", len(data)) + data
    half = len(body) // 2
    out = b""
    for part in (body[:half], body[half:], b""):
        c = zlib.compressobj(6, zlib.DEFLATED, 31)
        out += c.compress(part) + c.flush()
    return out


def test_bam_and_sam(spark, tmp_path):
    tags = b"B1i" + struct.pack("<i", 3) + b"B2C" + bytes([4]) + b"B3ZACGT\0XFZg1\0ZZBc" + struct.pack("<i", 2) + b"\1\2ASs" + struct.pack("<h", -5)
    raw = bam([("r1", 16, 0, 99, [(5, "S"), (4, "M")], "ACGTNACGT", tags), ("r2", 4, -1, -1, [], "ACG", b"")], ["chr1"])
    (tmp_path / "a.bam").write_bytes(raw)
    rows = reads.read_alignments(spark, str(tmp_path / "a.bam")).orderBy("name").collect()
    one = rows[0].asDict()
    assert (one["chrom"], one["pos"], one["cigar"], one["seq"], one["qual"], one["x"], one["y"], one["umi"], one["gene"], one["score"]) == ("chr1", 99, "5S4M", "ACGTNACGT", "I" * 9, 3, 4, "ACGT", "g1", -5)
    assert rows[1]["chrom"] is None and rows[1]["cigar"] is None
    sinks.write_sam(reads.read_alignments(spark, str(tmp_path / "a.bam")), str(tmp_path / "b.sam"))
    back = reads.read_alignments(spark, str(tmp_path / "b.sam")).orderBy("name").collect()
    same = [c for c in back[0].asDict() if c not in ("score", "loci")]
    assert [[r[c] for c in same] for r in back] == [[r[c] for c in same] for r in rows]


def test_tables(spark, tmp_path):
    (tmp_path / "a.gff.gz").write_bytes(gzip.compress(b'##gff\nchr1\tsrc\tgene\t1\t1000\t.\t+\t.\tID=gene1;Name="Gene1"\n\n'))
    row = tables.read_gff(spark, str(tmp_path / "a.gff.gz")).first()
    assert (row["seqname"], row["start"], row["end"], row["score"], row["attrs"]) == ("chr1", 1, 1000, None, {"ID": "gene1", "Name": "Gene1"})
    (tmp_path / "ids.txt").write_text("ACGT   1  2\nTTTT\t3\t4\n")
    codes = tables.read_barcodes(spark, str(tmp_path / "ids.txt"))
    assert sorted(map(tuple, codes.collect())) == [("ACGT", 1, 2), ("TTTT", 3, 4)] and tables.barcode_length(codes) == 4
    for head in ("\ta\tb\ta\n", "a\tb\ta\n"):
        (tmp_path / "m.tsv").write_text(head + "1x1\t5\t0\t10.0\n2x2\t0\t0\t0\n")
        got = tables.read_matrix(spark, str(tmp_path / "m.tsv"))
        assert sorted(map(tuple, got.collect())) == [("1x1", "a", 5, 0), ("1x1", "a.1", 10, 2)]
        assert tables.matrix_spots(spark, str(tmp_path / "m.tsv")).count() == 2
    (tmp_path / "c.txt").write_text("x y new_x new_y\n1 2 10.126 20\n3 4 1 2 7 8\n5 6 1 2 7 8 0\n")
    at = {r["x"]: r for r in tables.read_coordinates(spark, str(tmp_path / "c.txt")).collect()}
    assert at[1]["new_x"] == 10.13 and at[3]["pixel_y"] == 8 and at[5]["under_tissue"] == 0
    (tmp_path / "bad.txt").write_text("1 2 3\n")
    with pytest.raises(Exception):
        tables.read_coordinates(spark, str(tmp_path / "bad.txt")).collect()


def test_config_rules():
    good = {"exp_name": "e", "alignments": "a.sam", "ids": "i", "ref_annotation": "a.gtf"}
    assert PipelineConfig(**good).check().umi_end_position == 27
    assert PipelineConfig(**good, **VISIUM).check().umi_start_position == 16
    bad = [
        {"exp_name": None}, {"alignments": None}, {"ids": None}, {"ref_annotation": None}, {"ref_annotation": "a.txt"}, {"threads": 0}, {"htseq_mode": "x"}, {"fastq_files": ["a.fq"]}, {"fastq_files": ["a.fq", "b.txt"]},
        {"demultiplexing_mismatches": 9, "demultiplexing_kmer": 6}, {"umi_start_position": 30}, {"umi_filter": True, "umi_filter_template": "NN"}, {"umi_filter": True, "umi_filter_template": "XSNNWSNNV"}, {"demultiplexing_start": 20},
        {"demultiplexing_trim_sequences": [1]}, {"umi_allowed_mismatches": 8, "umi_start_position": 0, "umi_end_position": 4},
    ]
    for change in bad:
        with pytest.raises(ValueError):
            PipelineConfig(**{**good, **change}).check()
    parsed = from_arguments(["a.fq", "b.fq", "--expName", "x", "--umi-filter", "--saturation-points", "5", "10", "--htseq-features", "exon", "gene", "--star-min-score-ratio", "0.5"])
    assert parsed.fastq_files == ["a.fq", "b.fq"] and parsed.umi_filter and parsed.saturation_points == [5, 10] and parsed.htseq_features == ["exon", "gene"] and parsed.star_min_score_ratio == 0.5


def test_whole_pipeline_and_tools(spark, tmp_path):
    codes = {"ACGTACGTAC": (1, 2), "TTGGCCAATT": (3, 4)}
    (tmp_path / "ids.txt").write_text("".join(f"{b} {x} {y}\n" for b, (x, y) in codes.items()))
    (tmp_path / "a.gtf").write_text("".join(f'chr1\ts\texon\t{a}\t{b}\t.\t+\t.\tgene_id "{g}"; gene_name "n{g}"; gene_type "{t}";\n' for a, b, g, t in ((1, 1000, "g1", "coding"), (2001, 3000, "g2", "other"))))
    fw, rv, sam = [], [], ["@HD\tVN:1.6"]
    for i in range(40):
        code = list(codes)[i % 2]
        wrong = code if i % 5 else "G" + code[1:]
        umi = "ACGT" if i < 20 else "TTTT"
        fw.append((f"r{i} 1", wrong + umi, "I" * 14))
        rv.append((f"r{i} 2", "ACGTTGCA" * 5, "I" * 40 if i != 7 else "!" * 40))
        sam.append(f"r{i}\t0\tchr1\t{100 if i % 4 < 2 else 2100}\t60\t40M\t*\t0\t0\t{'ACGTTGCA' * 5}\t{'I' * 40}")
    (tmp_path / "f.fastq").write_text(fastq(fw))
    (tmp_path / "r.fastq").write_text(fastq(rv))
    (tmp_path / "al.sam").write_text("\n".join(sam) + "\n")
    (tmp_path / "rrna.fa").write_text(">x\nGGGGGGGGGGGGGGGG\nGGGGGGGGGGGGGG\n>y\nTTTTTTTTTTTTTTTTTTTTTTTTTTTTT\n")
    stats = pipeline.run(spark, from_arguments([
        str(tmp_path / "f.fastq"), str(tmp_path / "r.fastq"), "--expName", "e", "--ids", str(tmp_path / "ids.txt"), "--ref-annotation", str(tmp_path / "a.gtf"), "--alignments", str(tmp_path / "al.sam"), "--output-folder", str(tmp_path),
        "--umi-start-position", "10", "--umi-end-position", "14", "--demultiplexing-metric", "Hamming", "--demultiplexing-mismatches", "1", "--keep-discarded-files", "--compute-saturation", "--saturation-points", "5", "20",
        "--contaminant-index", str(tmp_path / "rrna.fa"),
    ]))
    assert stats["input_reads_forward"] == 40 and stats["reads_after_trimming_reverse"] == 39 and stats["reads_after_demultiplexing"] == 39
    assert stats["reads_after_duplicates_removal"] == 8 and stats["duplicates_found"] == 31 and stats["genes_found"] == 2 and stats["barcodes_found"] == 2
    assert json.loads(text_of(tmp_path / "e_stats.json"))["genes_found"] == 2
    assert tables.read_stats(spark, str(tmp_path / "e_stats.json"))["barcodes_found"] == 2
    assert len(text_of(tmp_path / "e_reads.bed").splitlines()) == 8
    assert text_of(tmp_path / "e_discarded.fastq").startswith("@r7")
    assert len(text_of(tmp_path / "e_saturation.tsv").splitlines()) == 3
    matrix = str(tmp_path / "e_stdata.tsv")
    table = tables.read_matrix(spark, matrix)
    assert sorted((r["spot"], r["gene"], r["count"]) for r in table.collect()) == [("1x2", "g1", 2), ("1x2", "g2", 2), ("3x4", "g1", 2), ("3x4", "g2", 2)]
    (tmp_path / "coords.txt").write_text("1 2 10 20\n")
    run = lambda tool, *a: cli.TOOLS[tool](spark, list(a))
    run("adjust_matrix_coordinates", "--counts-matrix", matrix, "--coordinates-file", str(tmp_path / "coords.txt"), "--update-coordinates", "--outfile", str(tmp_path / "adj.tsv"))
    assert text_of(tmp_path / "adj.tsv").splitlines()[1].split("\t") == ["10.0x20.0", "2", "2"]
    run("convert_ensembl_to_names", "--counts", matrix, "--annotation", str(tmp_path / "a.gtf"), "--output", str(tmp_path / "names.tsv"))
    assert text_of(tmp_path / "names.tsv").splitlines()[0].split("\t")[1:] == ["ng1", "ng2"]
    run("filter_gene_type_matrix", "--counts-matrix", matrix, "--gene-types-keep", "coding", "--annotation", str(tmp_path / "a.gtf"), "--ensembl-ids", "--outfile", str(tmp_path / "typed.tsv"))
    assert text_of(tmp_path / "typed.tsv").splitlines()[0].split("\t")[1:] == ["g1"]
    run("matrix_report", "--input-data", matrix, "--output", str(tmp_path))
    assert "Number of spots: 2" in text_of(tmp_path / "e_stdata_qa_stats.txt")
    run("compare_matrices", "--counts-table-files", matrix, str(tmp_path / "names.tsv"), "--outdir", str(tmp_path))
    assert "names" in text_of(tmp_path / "gene_similarities.tsv")
    with pytest.raises(ValueError):
        run("compare_matrices", "--counts-table-files", matrix)
    assert cli.main(["nothing"]) == 2


def test_stream_gives_a_gene_once_its_end_is_passed(spark, tmp_path):
    schema = "gene string, x int, y int, strand string, start long, umi string, progress long"
    batches = [[("g1", 1, 1, "+", 10, "AAAA", 20), ("g1", 1, 1, "+", 12, "AAAT", 20), ("g2", 1, 1, "+", 15, "CCCC", 20)], [("g1", None, None, None, None, None, 2000), ("g2", 2, 2, "+", 1500, "GGGG", 2000)], [("g2", None, None, None, None, None, None)]]
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.parquet(str(tmp_path / f"in/b{i}"))
    ends = spark.createDataFrame([("g1", "c", 1000), ("g2", "c", 9000)], "gene string, chrom string, end long")
    got = []
    os.makedirs(tmp_path / "src")
    for i in range(3):
        stream = genes.stream_reads(spark, str(tmp_path / "src"), spark.createDataFrame([], schema).schema)
        for j in range(i + 1):
            part = next(p for p in os.listdir(tmp_path / f"in/b{j}") if p.endswith(".parquet"))
            if not os.path.exists(tmp_path / f"src/b{j}.parquet"):
                (tmp_path / f"src/b{j}.parquet").write_bytes((tmp_path / f"in/b{j}/{part}").read_bytes())
        query = genes.count_genes(stream, ends, 250, 1).writeStream.foreachBatch(lambda f, _: got.extend(map(tuple, f.collect()))).option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").start()
        query.processAllAvailable()
        query.stop()
        if i == 1:
            assert got == [("g1", 1, 1, 2, 1)]
    assert sorted(got) == [("g1", 1, 1, 2, 1), ("g2", 1, 1, 1, 1), ("g2", 2, 2, 1, 1)]


def test_registered_queries_match_their_sql(spark):
    """The whole registry is compared by the driver; here a few cheap ones over the smallest tables."""
    duckdb = pytest.importorskip("duckdb")
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no tables")
    from spotweave.plans.queries import oracle_sql, queries

    con = duckdb.connect()
    for name in os.listdir(folder):
        con.execute(f"create view {name.split('.')[0]} as select * from '{folder}/{name}'")
    for name in ("umi_count_components", "read_filter_rows", "annotate_nonempty", "demux_hamming", "gff_parse"):
        frame = queries()[name](spark, folder)
        columns = sorted(frame.columns)
        mine = sorted(tuple(r[c] for c in columns) for r in frame.fillna("-").select(*[F.col(c).cast("string").alias(c) for c in columns]).fillna("-").collect())
        theirs = sorted(tuple("-" if v is None else str(v) for v in r) for r in con.execute(f"select {', '.join(chr(34) + c + chr(34) for c in columns)} from ({oracle_sql()[name]})").fetchall())
        assert mine == theirs, name
